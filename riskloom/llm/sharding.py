"""Shards of near equal size from whole groups: the minimax contiguous partition."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.prefix import with_running_totals
from riskloom.session import stage

#: Group ends that one look at the groups brings to the driver, at most; with many shards the
#: stretches that a run's end may fall in need more, see ``_summary``.
SUMMARY = 65_536


class _Ends:
    """Some of the group ends, in order, and whether others lie before each of them."""

    def __init__(self) -> None:
        self.at = np.zeros(1, np.int64)
        self.hidden = np.zeros(1, bool)

    def add(self, rows: list, low: int, high: int) -> None:
        """Replace what is known of ``(low, high]`` by buckets: first end, last end, ends."""
        kept = (self.at <= low) | (self.at > high)
        new = [(first, False) for first, last, _ in rows if first < last]
        new += [(last, n > 2) for _, last, n in rows]
        new = np.array(new, np.int64).reshape(-1, 2)
        at = np.concatenate([self.at[kept], new[:, 0]])
        hidden = np.concatenate([self.hidden[kept], new[:, 1].astype(bool)])
        order = np.argsort(at, kind="stable")
        self.at, self.hidden = at[order], hidden[order]

    def runs(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Ends of greedy runs over the known ends; ``hopeful`` takes a hidden end as there."""
        ends, total = [0], int(self.at[-1])
        while len(ends) <= shards and ends[-1] < total:
            limit = ends[-1] + capacity
            i = int(np.searchsorted(self.at, limit, side="right")) - 1
            reach = int(self.at[i])
            if hopeful and i + 1 < len(self.at) and self.hidden[i + 1]:
                reach = limit
            ends.append(max(reach, ends[-1]))
        return ends[1:]

    def gaps(self, spans: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
        """Where ends are hidden that touch the spans, as ``most`` ranges or fewer."""
        found = []
        for k in np.flatnonzero(self.hidden):
            low, high = int(self.at[k - 1]), int(self.at[k])
            if any(low < b and high > a for a, b in spans):
                if found and found[-1][1] == low:
                    found[-1] = (found[-1][0], high)
                else:
                    found.append((low, high))
        while len(found) > most:
            i = min(range(1, len(found)), key=lambda i: found[i][0] - found[i - 1][1])
            found[i - 1 : i + 1] = [(found[i - 1][0], found[i][1])]
        return found

    def smallest(self, low: int, high: int, shards: int, hopeful: bool) -> int:
        total = int(self.at[-1])
        while low < high:
            middle = (low + high) // 2
            runs = self.runs(middle, shards, hopeful)
            low, high = (low, middle) if runs and runs[-1] >= total else (middle + 1, high)
        return low


def _summary(ends: DataFrame, ranges: list[tuple[int, int]], shards: int) -> list:
    """First end, last end and number of ends of each bucket of the ranges ``(low, high]``.

    The k-th run's end is uncertain by k buckets, so 64 buckets per pair of shards always narrow.
    """
    buckets = max(SUMMARY, 64 * shards * shards)
    width = max(1, -(-sum(high - low for low, high in ranges) // (buckets - len(ranges))))
    bucket = F.lit(None)
    for i, (low, high) in enumerate(ranges):
        inside = (F.col("end") > low) & (F.col("end") <= high)
        bucket = F.when(
            inside, F.struct(F.lit(i).alias("i"), F.floor((F.col("end") - low - 1) / width).alias("b"))
        ).otherwise(bucket)
    # row groups outside the ranges are skipped, as the ends are stored in order
    near = functools.reduce(
        lambda x, y: x | y, [F.col("end").between(low + 1, high) for low, high in ranges]
    )
    found = ends.filter(near).groupBy(bucket.alias("b")).agg(
        F.min("end"), F.max("end"), F.count("end")
    )
    return [(r[0]["i"], *r[1:]) for r in found.collect()]


def minimax_cuts(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity that ``shards`` contiguous runs of groups can keep, and their ends.

    ``ends`` holds the running total at the end of each group in column ``end``.  The driver holds
    a bounded number of ends per look (``SUMMARY``).  A capacity is checked greedily by binary search over those
    ends, once as if no other end existed and once as if one lay wherever others may be; between
    the two smallest capacities only the stretches that a run's end may fall in are looked at
    again, in buckets finer by that factor, until both agree.
    """
    known = _Ends()
    ranges = [(0, total)]
    low, high = max(-(-total // shards), largest), -(-total // shards) + largest
    while True:
        rows = _summary(ends, ranges, shards)
        for i, (start, stop) in enumerate(ranges):
            known.add([r[1:] for r in rows if r[0] == i], start, stop)
        # a bucket's last end may lie below the bound, so the known ends may need more than it
        high = known.smallest(low, max(high, total), shards, hopeful=False)
        low = known.smallest(low, high, shards, hopeful=True)
        if low == high:
            return high, known.runs(high, shards, hopeful=False)
        least = known.runs(low, shards, hopeful=False)
        most = known.runs(high, shards, hopeful=True)
        most += [total] * (len(least) - len(most))
        ranges = known.gaps(list(zip(least, most, strict=False)), 4 * shards)


def shard_by_bytes(
    docs: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Deal documents to ``shards`` runs of whole groups so that the largest run is smallest.

    A document's size is the UTF-8 bytes of its text plus 1.  Documents of equal text form an
    atomic group (null counts as empty); groups are ordered by their smallest id, members by id
    and then text digest.  The law is ``bytes``: no partition of the ordered groups into as many
    runs has a smaller largest shard.  A group above the even share fills a shard of its own.

    Returns ``id_column, size, text_crc32, shard, slot``, one row per input row, repeated rows
    included.  Null ids come first.  An empty table gives no rows; with fewer groups than shards
    some shards stay empty.  Other columns are left out, whatever their names.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("_digest"),
    )
    rows = stage(rows, "shard-rows")
    groups = rows.groupBy("_digest").agg(
        F.min("_id").alias("_first"), F.sum("size").alias("_size")
    )
    # groups can share their first id where ids are null or repeated; the digest settles it
    ends = with_running_totals(groups, ["_first", "_digest"], {"_start": "_size"}, "shard-groups")
    ends = stage(
        ends.select("_digest", "_first", (F.col("_start") + F.col("_size")).alias("end"), "_size"),
        "shard-ends",
    )
    total, largest = ends.agg(F.max("end"), F.max("_size")).first()
    cuts = minimax_cuts(ends, total, largest, shards)[1] if total else []
    shard = F.lit(0)
    for end in cuts[:-1]:
        shard = shard + (F.col("end") > end).cast("int")
    placed = (
        rows.join(ends.select("_digest", "_first", shard.alias("shard")), "_digest")
        .withColumn("_one", F.lit(1).cast("long"))
    )
    # the order goes on to the members, so a group of any size spans parts
    ranked = with_running_totals(
        placed, ["shard", "_first", "_digest", "_id"], {"_rank": "_one"}, "shard-order"
    )
    firsts = ranked.groupBy("shard").agg(F.min("_rank").alias("_shard_first"))
    return ranked.join(F.broadcast(firsts), "shard").select(  # one row per shard
        F.col("_id").alias(id_column),
        "size",
        "text_crc32",
        "shard",
        (F.col("_rank") - F.col("_shard_first")).alias("slot"),
    )
