"""How far the sources of a language differ in their words, over a cube of group and term blocks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.prefix import partitions
from riskloom.operators.lookup import lookup
from riskloom.session import stage

#: A term is kept in a language if it occurs in so many of its documents.
LEAST_DOCS = 30
#: Added to every count, and the parts into which a share of 1 is cut.
SMOOTHING = 5
UNIT = 1_000_000_000
#: Ranks of terms that are reported per group.
TOP_TERMS = 50
#: Groups and terms in a block, on average: a cell holds a matrix of twice the one by the other.
GROUP_BLOCK = 32
TERM_BLOCK = 2048
#: Counts a task holds before it sends them on, and bytes of text it cuts into words at once.
HELD = 400_000
SLICE = 1 << 20

#: Stands for the group itself beside its terms; no term is empty.
NO_TERM = b""
#: Bytes of a term, A-Z lower-cased; all other ASCII ends it.
_TERM_BYTES = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)


def _slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a slice that ends between two terms at a time."""
    marked = text.translate(_TERM_BYTES)
    start = 0
    while start < len(marked):
        end = marked.find(b" ", start + SLICE)
        end = len(marked) if end < 0 else end
        yield marked[start:end].split()
        start = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents per (lang, source, term), summed as far as a task holds them."""
    held: dict[tuple[str, str], list[Counter]] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            columns = [
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(terms), np.int64))),
                pa.array([source], pa.string()).take(pa.array(np.zeros(len(terms), np.int64))),
                pa.array(terms, pa.binary()),
                pa.array([n[t] for t in terms], pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for group, text in zip(zip(langs, sources), batch.column(2)):
            n, docs = held.setdefault(group, [Counter(), Counter()])
            before = len(n)
            seen: set[bytes] = set()
            for terms in _slices(text.as_py()):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            docs[NO_TERM] += 1
            n[NO_TERM] += 0
            size += len(n) - before
            if size > HELD:
                yield from sent()
                size = 0
    yield from sent()


def kept_terms(
    docs: DataFrame,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Counts of the kept terms of every group, stored.

    Columns ``lang, source, term`` (bytes), ``n`` (occurrences in the group), ``n_lang`` (in the
    language) and ``first`` (1 on one row of each term of a language).  A row with an empty term
    stands for every (lang, source) that occurs, with or without terms.
    """
    rows = docs.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
            for c, name in ((lang_column, "lang"), (source_column, "source"))
        ],
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    partial = rows.mapInArrow(_count, "lang string, source string, term binary, n long, docs long")
    # dealt by what the window needs, so that sums and window take one shuffle
    dealt = partial.repartition(partitions(docs), "lang", "term")
    summed = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    marked = summed.withColumns(
        {
            "n_lang": F.sum("n").over(term),
            "lang_docs": F.sum("docs").over(term),
            "first": (F.row_number().over(term.orderBy("source")) == 1).cast("long"),
        }
    )
    kept = marked.filter((F.col("term") == NO_TERM) | (F.col("lang_docs") >= least_docs))
    return stage(kept.drop("docs", "lang_docs"), "divergence-terms")


def _share(count: Column, total: Column, vocabulary: Column) -> Column:
    """``1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * vocabulary))``, exactly.

    Divided in two steps, so that no product passes 64 bits below 2.8e14 occurrences; beyond, the
    multiplication fails rather than wraps.  0 without a vocabulary.
    """
    inner, outer = 31_250, UNIT // 31_250
    below = F.when(vocabulary > 0, total + SMOOTHING * vocabulary)
    scaled = (count + SMOOTHING) * inner
    share = 1 + _div(scaled, below) * outer + _div((scaled % below) * outer, below)
    return F.coalesce(share, F.lit(0)).cast("long")


def _div(a: Column, b: Column) -> Column:
    """Whole division of longs at least 0."""
    return F.call_function("div", a, b)


def _cell(table: pa.Table) -> pa.Table:
    """Partial sums of one (group block, group block, term block): a row per pair of its groups.

    A pair's part is the sum over the terms seen in the cell of its difference beyond that of two
    groups without the term; the first term block adds the latter for the whole vocabulary.
    """
    table = table.combine_chunks()
    is_group = pc.equal(table["term"], NO_TERM)
    groups = table.filter(is_group).sort_by("source")
    counts = table.filter(pc.invert(is_group))
    base = groups["base"].to_numpy()
    side = groups["side"].to_numpy()
    if counts.num_rows:
        names = groups["source"].combine_chunks()
        row = pc.index_in(counts["source"], value_set=names).to_numpy(zero_copy_only=False)
        codes = counts["term"].combine_chunks().dictionary_encode()
        shares = np.repeat(base[:, None], len(codes.dictionary), axis=1)
        shares[row, codes.indices.to_numpy()] = counts["share"].to_numpy()
    else:
        shares = np.zeros((len(base), 0), np.int64)
    lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
    terms = groups["vocabulary"][0].as_py() if table["term_block"][0].as_py() == 0 else 0
    left = np.flatnonzero(side == lo)
    right = np.flatnonzero(side == hi)
    found = []
    for i in left:
        others = right[right > i] if lo == hi else right
        apart = np.abs(base[others] - base[i])
        part = np.abs(shares[others] - shares[i]).sum(axis=1) + (terms - shares.shape[1]) * apart
        found.append((np.full(len(others), i), others, part))
    a, b, part = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(3))
    lang = table["lang"].combine_chunks().slice(0, 1).take(pa.array(np.zeros(len(a), np.int64)))
    source = groups["source"].combine_chunks()
    return pa.Table.from_arrays(
        [lang, source.take(pa.array(a)), source.take(pa.array(b)), pa.array(part.astype(np.int64))],
        names=["lang", "a", "b", "part"],
    )


def divergence_audit(
    docs: DataFrame,
    lang_column: str = "lang",
    source_column: str = "source",
    text_column: str = "text",
    least_docs: int = LEAST_DOCS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """Distances between the sources of each language, and the terms that mark each source.

    A group is a (lang, source); its shares are smoothed counts of the language's kept terms.  Part
    ``pair`` gives for every other source of the language the sum of absolute differences of their
    shares; part ``term`` the terms of the group whose share is above the language's, the farthest
    ``top_terms`` of them.  Ranks start at 1 per group and part, by value descending, then by item.

    The pairs are computed over a cube: groups and terms go to blocks by their hash, a slice (group
    block, term block) is sent to each cell of two group blocks and its term block, a task owns
    cells, and their parts are summed along the term axis.  A cell holds two blocks of groups and
    one of terms whatever the number of rows of a source.  Words are counted in the map tasks
    before any shuffle, so a hot source or word is some rows per task.

    Null lang, source and text count as ''.  Texts of any length are cut into terms in slices.
    Repeated rows count as often as they occur.  A group without terms has pairs, all with the
    smallest share (0 in a language without kept terms).  An empty table gives no rows; a source
    alone in its language has no pairs.  Other columns are left out, whatever their names.
    """
    kept = kept_terms(docs, lang_column, source_column, text_column, least_docs)
    is_term = F.col("term") != NO_TERM
    langs = kept.groupBy("lang").agg(
        F.sum(F.when(is_term, F.col("first")).otherwise(0)).alias("vocabulary"),
        F.sum("n").alias("lang_total"),
        F.count_if(~is_term).alias("groups"),
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    vocabulary = F.col("vocabulary")
    # one row per group; the languages are a table aggregated from it
    groups = totals.join(langs, "lang").withColumns(
        {
            "base": _share(F.lit(0).cast("long"), F.col("total"), vocabulary),
            "group_blocks": F.ceil(F.col("groups") / GROUP_BLOCK).cast("int"),
            "term_blocks": F.greatest(F.ceil(vocabulary / TERM_BLOCK), F.lit(1)).cast("int"),
        }
    )
    groups = groups.withColumn("side", F.pmod(F.xxhash64("source"), F.col("group_blocks")).cast("int"))
    groups = stage(groups, "divergence-groups")
    about = ["total", "lang_total", "vocabulary", "base", "side", "group_blocks", "term_blocks"]
    # the table of groups is broadcast only if it is counted to be small
    shares = lookup(kept, groups, ["lang", "source"], about)
    shares = shares.withColumn("share", _share(F.col("n"), F.col("total"), vocabulary))
    ahead = shares.filter(is_term).withColumn(
        "value", F.col("share") - _share(F.col("n_lang"), F.col("lang_total"), vocabulary)
    )
    group = Window.partitionBy("lang", "source")
    terms = (
        ahead.filter("value > 0")
        .withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "term")))
        .filter(F.col("rank") <= top_terms)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    )

    sliced = shares.withColumn(
        "term_block",
        # a group stands in every term block, a term in its own
        F.explode(
            F.when(is_term, F.array(F.pmod(F.xxhash64("term"), F.col("term_blocks")).cast("int"))).otherwise(
                F.sequence(F.lit(0), F.col("term_blocks") - 1)
            )
        ),
    )
    replicated = sliced.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("group_blocks") - 1))).select(
        "lang",
        F.least("side", "other").alias("lo"),
        F.greatest("side", "other").alias("hi"),
        *["term_block", "side", "source", "term", "share", "base", "vocabulary"],
    )
    parts = replicated.groupBy("lang", "lo", "hi", "term_block").applyInArrow(
        _cell, "lang string, a string, b string, part long"
    )
    distances = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    ends = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")])
    pairs = (
        distances.select("lang", F.inline(ends), "value")
        .withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    )
    return pairs.union(terms)
