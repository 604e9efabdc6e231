"""Near-duplicate texts by HyperMinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.components import components
from riskloom.llm.prefix import partitions
from riskloom.session import TEXT_BYTES, stage

SHINGLE = 5
#: Registers per text, a power of two, and how many of them make a band.  At a similarity of 0.75
#: a pair shares one of the 32 bands but for five in a million.
REGISTERS = 128
ROWS = 4
BANDS = REGISTERS // ROWS
#: Mantissa bits kept beside the count of leading zeros; 6 + 10 bits make a register.
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
#: Standard errors by which the estimate may fall short before a pair is not verified.
SLACK = 5.0
#: Shingles that a task compares at a time; larger groups of candidates are cut into blocks.
BLOCK_SHINGLES = 400_000
#: Share that links, in hundredths: 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75

_MULTIPLIERS = np.array(
    [int.from_bytes(xxhash.xxh3_128(bytes([i])).digest()[:8], "little") | 1 for i in range(SHINGLE)],
    np.uint64,
)
#: For an empty register, the registers it asks for a value, in order; the same for all texts.
_ASKED = np.array(
    [
        [xxhash.xxh3_64_intdigest(bytes([i, j])) % REGISTERS for j in range(128)]
        for i in range(REGISTERS)
    ]
)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text.

    A-Z are lower-cased and words divided by the bytes 0x20 and 0x09-0x0D, which is what bytes
    do.  Fewer words than a shingle make one shingle; no word makes none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    digest = xxhash.xxh3_64_intdigest
    hashes = np.array([digest(w) for w in words], np.uint64)
    n = len(hashes)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(hashes.tobytes(), n)], np.uint64) if n else hashes
    mixed = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        mixed = _mixed((mixed ^ hashes[k : n - SHINGLE + 1 + k]) * _MULTIPLIERS[k])
    return np.unique(mixed)


def registers(found: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set: per bucket of the top bits, its least value, compressed.

    A register holds the leading zeros of the least value and the MANTISSA bits after its leading
    one; buckets without a shingle hold EMPTY.
    """
    out = np.full(REGISTERS, EMPTY, np.uint16)
    top = np.uint64(64 - REGISTERS.bit_length() + 1)
    buckets = (found >> top).astype(np.int64)
    first = np.flatnonzero(np.diff(buckets, prepend=-1))
    value = (found[first] << np.uint64(REGISTERS.bit_length() - 1)) | np.uint64(1)
    fraction, exponent = np.frexp(value.astype(np.float64))
    zeros = np.minimum(64 - exponent, 62)  # a value rounded up to the next power counts for it
    bits = ((fraction - 0.5) * (2 << MANTISSA)).astype(np.int64)
    out[buckets[first]] = (np.maximum(zeros, 0) << MANTISSA) | bits
    return out


def densified(sketch: np.ndarray) -> np.ndarray:
    """The sketch with each empty register taken from the first full one that it asks."""
    empty = sketch == EMPTY
    if not empty.any() or empty.all():
        return sketch
    asked = _ASKED[empty]
    full = ~empty[asked]
    first = full.argmax(axis=1)
    out = sketch.copy()
    fallback = np.flatnonzero(~empty)[0]
    out[empty] = sketch[np.where(full.any(axis=1), asked[np.arange(len(asked)), first], fallback)]
    return out


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Registers that two disjoint sets of these sizes share by chance, on average.

    The approximation published with HyperMinHash, for sizes far below the counters' range.
    """
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    return 0.169919487159739093975315012348 * REGISTERS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2


def estimates(one: np.ndarray, n: int, others: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of a sketch with others, and their registers."""
    either = (one != EMPTY) | (others != EMPTY)
    same = ((one == others) & (one != EMPTY)).sum(axis=1)
    used = np.maximum(either.sum(axis=1), 1)
    return np.maximum(same - expected_collisions(np.full(len(m), n), m), 0) / used, used


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per document: size of its set, digest of the set, and band keys of its sketch; stored."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, high, low, bands = [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                sizes.append(len(found))
                digest = xxhash.xxh3_128_digest(found.tobytes())
                high.append(int.from_bytes(digest[:8], "little", signed=True))
                low.append(int.from_bytes(digest[8:], "little", signed=True))
                if len(found):
                    rows = densified(registers(found)).reshape(BANDS, ROWS).astype(np.uint64)
                    key = np.arange(1, BANDS + 1, dtype=np.uint64)
                    for k in range(ROWS):
                        key = _mixed((key ^ (rows[:, k] + np.uint64(1))) * _MULTIPLIERS[k])
                    bands.append(key.view(np.int64))
                else:
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc", "n", "d1", "d2", "bands"],
            )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text")
    )
    return stage(
        rows.mapInArrow(sketch, "doc long, n long, d1 long, d2 long, bands array<long>"),
        "minhash-sketches",
        TEXT_BYTES,
    )


class _Forest:
    """Links found so far among the documents at hand."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j

    def roots(self) -> np.ndarray:
        up = self.up
        while not np.array_equal(up, up[up]):
            up = up[up]
        self.up = up
        return up


def _links(docs: list[int], sets: list[np.ndarray], side: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect the sets at hand as all their links of enough similarity would.

    A set is compared with those after it that are not connected with it yet (between two blocks,
    only with the other block's): first by estimate, then in full by counting shared shingles.
    """
    order = sorted(range(len(docs)), key=lambda i: docs[i])
    docs, sets, side = [docs[i] for i in order], [sets[i] for i in order], side[order]
    sketch = np.array([registers(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    blocks = len(np.unique(side)) > 1
    forest, found = _Forest(len(docs)), []
    for i in range(len(docs) - 1):
        roots = forest.roots()
        later = np.flatnonzero(roots[i + 1 :] != roots[i]) + i + 1
        if blocks:
            later = later[side[later] != side[i]]
        # the smaller set cannot share more than it has
        small, large = np.minimum(sizes[later], sizes[i]), np.maximum(sizes[later], sizes[i])
        later = later[100 * small >= THRESHOLD * large]
        if not len(later):
            continue
        guess, used = estimates(sketch[i], sizes[i], sketch[later], sizes[later])
        share = THRESHOLD / 100
        later = later[guess >= share - SLACK * np.sqrt(share * (1 - share) / used)]
        if not len(later):
            continue
        joined = np.concatenate([sets[j] for j in later])
        at = np.searchsorted(sets[i], joined)
        hit = sets[i][np.minimum(at, sizes[i] - 1)] == joined
        ends = np.cumsum(sizes[later])
        counted = np.concatenate([[0], np.cumsum(hit)])
        shared = counted[ends] - counted[ends - sizes[later]]
        for j in later[100 * shared >= THRESHOLD * (sizes[i] + sizes[later] - shared)]:
            if forest.join(i, int(j)):
                found.append((docs[i], docs[j]))
    return found


def _verified(candidates: DataFrame) -> DataFrame:
    """Links within each ``(cluster, low, high)`` of rows ``doc, block, text``.

    Rows are dealt by these three and sorted, so a task holds one block or two at a time.
    """
    order = ["cluster", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, sets, side = None, [], [], []

        def done():
            links = _links(docs, sets, np.array(side)) if len(docs) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for i in range(batch.num_rows):
                now = tuple(columns[k][i].as_py() for k in range(3))
                if now != key:
                    if len(docs) > 1:
                        yield done()
                    key, docs, sets, side = now, [], [], []
                docs.append(columns[3][i].as_py())
                side.append(columns[4][i].as_py())
                sets.append(shingles(columns[5][i].as_py()))
        yield done()

    dealt = candidates.select(*order, "doc", "block", "text").repartition(partitions(candidates), *order)
    return dealt.sortWithinPartitions(*order).mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Components of texts whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

    Texts with equal sets are one node, named by their smallest id.  A node's sketch is cut into
    bands, and nodes that share a band are linked to the smallest one there; the components of
    these links hold all candidates.  Within them nodes are compared, first by the estimate that is
    corrected for collisions of compressed registers, then on full sets, skipping those already
    connected.  Components of more than ``BLOCK_SHINGLES`` shingles are cut into blocks by the
    ids' hash, and each pair of blocks is compared by a task of its own, so no pair of candidates
    is left out and no task holds more than two blocks.  Pairs leave a task only as links that
    connect something new.

    Returns ``id_column, n_shingles, component_id, kept``, one row per input row.  Null, empty and
    blank texts have no shingle and are linked with nothing.  A null id is linked with nothing, has
    a null component and is kept.  An id that repeats is one document: its rows' sets may each give
    it links, and every row carries its component.  An empty table gives no rows; other columns
    are left out, whatever their names.
    """
    found = sketches(docs, id_column, text_column)
    filled = found.filter("n > 0 and doc is not null")
    # sums are stored before they are joined back: only a join of plain exchanges can split a hot key
    first = stage(filled.groupBy("d1", "d2").agg(F.min("doc").alias("rep")), "minhash-first")
    named = filled.select("doc", "n", "d1", "d2").join(first, ["d1", "d2"])
    named = stage(named.select("doc", "n", "d1", "d2", "rep"), "minhash-named")
    reps = named.filter("doc = rep").select("doc", "d1", "d2").distinct()
    keys = stage(
        filled.join(reps, ["doc", "d1", "d2"]).select("doc", F.explode("bands").alias("key")),
        "minhash-bands",
    )
    shared = keys.groupBy("key").agg(F.min("doc").alias("first"), F.max("doc").alias("_last"))
    shared = stage(shared.filter("first < _last").select("key", "first"), "minhash-shared")
    stars = keys.join(shared, "key").filter("doc != first").select(F.col("doc").alias("u"), F.col("first").alias("v"))
    # a document whose id repeats with another text also connects the sets
    repeated = named.filter("doc != rep").select(F.col("doc").alias("u"), F.col("rep").alias("v"))
    clusters = stage(components(stars, "minhash-clusters").withColumnRenamed("node", "doc"), "minhash-clusters")
    sizes = named.filter("doc = rep").select("doc", "n").distinct()
    members = clusters.join(sizes, "doc")
    weights = members.groupBy("component").agg(F.sum("n").alias("_weight"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_weight") / BLOCK_SHINGLES)).cast("int")
    members = members.join(weights, "component").select(
        "doc",
        F.col("component").alias("cluster"),
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("doc"), blocks).cast("int").alias("block"),
    )
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = texts.join(members, "doc").withColumn("_other", other).select(
        "cluster",
        F.least("block", "_other").alias("low"),
        F.greatest("block", "_other").alias("high"),
        "doc",
        "block",
        "text",
    )
    links = stage(_verified(placed).union(repeated), "minhash-links", TEXT_BYTES)
    joined = components(links).withColumnRenamed("node", "doc")
    ids = named.select("doc", "rep").join(joined.withColumnRenamed("doc", "rep"), "rep", "left")
    ids = ids.groupBy("doc").agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
    return found.select("doc", "n").join(ids, "doc", "left").select(
        F.col("doc").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "doc") == F.col("doc"), F.lit(True)).alias("kept"),
    )
