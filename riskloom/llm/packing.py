"""Packing token sequences into fixed windows by non-negative least squares."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.prefix import PART, part_bases
from riskloom.llm.tokens import encoder, id_type
from riskloom.session import TEXT_BYTES, stage

#: Ids of padding that are left rather than cut a document for them.
TOLERATED = 16
#: Rounds of multiplicative updates that solve the least squares.
ROUNDS = 200
#: Step between the middle lengths of combinations of three.
TRIPLE_STEP = 16
#: Rows of per-part bases up to which they are broadcast (some 30 bytes each); beyond, a join.
BROADCAST_ROWS = 1_000_000
#: Documents whose ids a task hands on at a time.
OUT_ROWS = 500


@dataclass
class Plan:
    """Where the k-th item of each length goes: runs of items, in order of their rank.

    A run ``(low, sequence, offset, cut, rest)`` says that item ``low + k`` of this length stands at
    ``offset`` of sequence ``sequence + k`` with its first ``cut`` ids; what is left of it is item
    ``rest + k`` of the shorter length.  There are as many runs as distinct combinations times
    their depth, whatever the number of documents.
    """

    window: int
    runs: dict[int, np.ndarray] = field(default_factory=dict)
    sequences: int = 0

    def place(self, length: int, rank: int) -> Iterator[tuple[int, int, int]]:
        """(ids, sequence, offset) of each piece of one item."""
        while length:
            runs = self.runs[length]
            low, sequence, offset, cut, rest = runs[np.searchsorted(runs[:, 0], rank, side="right") - 1]
            k = rank - low
            yield int(cut), int(sequence + k), int(offset)
            length, rank = length - int(cut), int(rest + k)


def combinations(window: int, lengths: np.ndarray) -> list[tuple[int, ...]]:
    """Two or three of the present lengths that fill the window exactly."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    found: list[tuple[int, ...]] = [(a, window - a) for a in lengths if 2 * a >= window and there[window - a]]
    for b in range(1, window, TRIPLE_STEP):
        a = np.arange(max(b, (window - b + 1) // 2), window - b)
        c = window - a - b
        ok = there[b] & there[a] & there[c] & (c <= b)
        found += [(int(x), b, int(y)) for x, y in zip(a[ok], c[ok], strict=True)]
    return found


def solve(found: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Repeats x >= 0 of each combination that come nearest to the histogram, by least squares.

    Multiplicative updates keep every repeat non-negative and never raise the error.
    """
    at = np.concatenate([np.full(len(c), i) for i, c in enumerate(found)])
    length = np.concatenate([np.array(c) for c in found])
    n = len(histogram)
    target = np.bincount(at, histogram[length].astype(float), len(found))
    x = np.full(len(found), histogram.sum() / len(length))
    for _ in range(ROUNDS):
        fitted = np.bincount(length, x[at], n)
        x = x * target / np.maximum(np.bincount(at, fitted[length], len(found)), 1e-12)
    return x


def plan_packing(histogram: np.ndarray, window: int) -> Plan:
    """Sequences for ``histogram[l]`` items of each length l < window.

    Whole repeats of the least squares' solution come first, as far as items last.  What is left
    is packed greedily, longest first with the longest that still fits; where nothing fits a gap
    of over ``TOLERATED`` ids, the shortest item left is cut to fill it and its rest is an item of
    its own.  A greedy combination is repeated until one of its lengths is used up.
    """
    plan = Plan(window)
    left = histogram.astype(np.int64).copy()
    total = left.copy()  # ranks given out so far, rests included
    used = np.zeros_like(left)
    runs: dict[int, list[tuple[int, ...]]] = {}

    def use(lengths: list[int], count: int, cut: int = 0) -> None:
        """``count`` sequences of these items; of the last, only the first ``cut`` ids if given."""
        offset = 0
        for i, length in enumerate(lengths):
            ids, rest = length, 0
            if cut and i == len(lengths) - 1:
                ids, rest = cut, int(total[length - cut])
                total[length - cut] += count
                left[length - cut] += count
            runs.setdefault(length, []).append((int(used[length]), plan.sequences, offset, ids, rest))
            used[length] += count
            left[length] -= count
            offset += ids
        plan.sequences += count

    found = combinations(window, np.flatnonzero(left))
    if found:
        repeats = solve(found, left)
        for i in np.argsort(-repeats, kind="stable"):
            lengths = list(found[i])
            count = min([int(repeats[i]), *[int(left[x]) // lengths.count(x) for x in lengths]])
            if count:
                use(lengths, count)
    while left.any():
        room = left.copy()
        lengths, gap, cut = [], window, 0
        while gap > 0:
            fitting = np.flatnonzero(room[: gap + 1])
            if len(fitting):
                lengths.append(int(fitting[-1]))
                room[lengths[-1]] -= 1
                gap -= lengths[-1]
                continue
            if gap > TOLERATED and len(longer := np.flatnonzero(room)):
                lengths.append(int(longer[0]))
                cut = gap
            break
        use(lengths, min(int(left[x]) // lengths.count(x) for x in lengths), cut)
    plan.runs = {k: np.array(v, np.int64) for k, v in runs.items()}
    return plan


def encode_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    window: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Ids of all texts, stored once: ``id_column, ids, n, class, rank, full_rank, _part``.

    ``ids`` are little-endian and as wide as the vocabulary needs.  ``class`` is the length beyond
    whole windows, ``rank`` numbers the documents of a class within their task, ``full_rank`` the
    whole windows.  The numbers of a task that is run again are its own, as only one is stored.
    """

    end = np.array([end_id], id_type(tokenizer)).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(window, np.int64)
        full = 0
        small = (b.slice(i, OUT_ROWS) for b in batches for i in range(0, b.num_rows, OUT_ROWS))
        for batch in small:
            ids, sizes, ranks, full_ranks = [], [], [], []
            for found in encoder(tokenizer).encode(batch.column(1)):
                n = len(found) + 1
                ids.append(found.tobytes() + end)
                sizes.append(n)
                ranks.append(seen[n % window])
                full_ranks.append(full)
                seen[n % window] += 1
                full += n // window
            sizes = np.array(sizes, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ids, pa.binary()),
                    pa.array(sizes),
                    pa.array((sizes % window).astype(np.int32)),
                    pa.array(ranks, pa.int64()),
                    pa.array(full_ranks, pa.int64()),
                    pa.array(np.full(len(sizes), part, np.int32)),
                ],
                [id_column, "ids", "n", "class", "rank", "full_rank", PART],
            )

    rows = docs.select(F.col(id_column).cast("long").alias(id_column), F.col(text_column).cast("string"))
    return stage(
        rows.mapInArrow(
            encode,
            f"`{id_column}` long, ids binary, n long, class int, rank long, full_rank long, {PART} int",
        ),
        "packing-ids",
        TEXT_BYTES,
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    window: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` ids.

    A document is its ids and ``end_id``.  Whole windows of it are sequences of their own; what is
    left has a length below the window, and the histogram of these lengths (``window`` numbers) is
    all that the driver sees.  ``plan_packing`` turns it into runs of sequences, and every document
    finds its pieces from its rank within its length: the rank within its task, stored with the
    ids, plus a prefix sum over tasks.  Text and ids are never shuffled.

    Returns one row per piece: ``id_column, start, length, doc_tokens, sequence_id, offset, ids``
    with the piece's ids as little-endian unsigned 32-bit numbers.  Pieces of a document cover it
    without overlap, pieces of a sequence fill it from offset 0 without gaps.  Null and empty
    texts are packed as the end id alone; repeated rows and null ids are documents like others.
    An empty table gives no rows.  Other columns are left out.
    """
    kind = id_type(tokenizer).str
    stored = encode_documents(docs, tokenizer, end_id, window, id_column, text_column)
    counts = stage(
        stored.groupBy(PART, "class").agg(
            F.count("n").alias("_n"), F.sum(F.floor(F.col("n") / window)).alias("_full")
        ),
        "packing-counts",
    )
    histogram = np.zeros(window, np.int64)
    for row in counts.filter("class > 0").groupBy("class").agg(F.sum("_n")).collect():
        histogram[row[0]] = row[1]
    plan = plan_packing(histogram, window)
    classes = part_bases(counts.select(PART, "class", "_n"), ["_n"], ["class"])
    fulls = part_bases(counts.groupBy(PART).agg(F.sum("_full").alias("_full")), ["_full"])
    bases = stage(classes.join(fulls, PART), "packing-bases")
    if bases.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    based = stored.join(bases, [PART, "class"]).select(
        id_column,
        "ids",
        "class",
        (F.col("rank") + F.col("_base__n")).alias("rank"),
        (F.col("full_rank") + F.col("_base__full") + plan.sequences).alias("full"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (b.slice(i, OUT_ROWS) for b in batches for i in range(0, b.num_rows, OUT_ROWS))
        for batch in small:
            out: tuple[list, ...] = ([], [], [], [], [], [], [])

            def piece(doc, tokens, start, length, sequence, offset, out=out):
                values = doc, start, length, len(tokens), sequence, offset
                for column, value in zip(out, values, strict=False):
                    column.append(value)
                out[6].append(tokens[start : start + length].astype("<u4").tobytes())

            columns = [batch.column(i).to_pylist() for i in range(5)]
            for doc, ids, rest, rank, full in zip(*columns, strict=True):
                tokens = np.frombuffer(ids, kind)
                whole = len(tokens) // window
                for k in range(whole):
                    piece(doc, tokens, k * window, window, full + k, 0)
                start = whole * window
                for length, sequence, offset in plan.place(rest, rank):
                    piece(doc, tokens, start, length, sequence, offset)
                    start += length
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, kinds, strict=True)],
                [id_column, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    return based.mapInArrow(
        cut,
        f"`{id_column}` long, start long, length long, doc_tokens long, sequence_id long,"
        " offset long, ids binary",
    )
