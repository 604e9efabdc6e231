"""The pipeline against its stages' rules applied one after another."""

from __future__ import annotations

import sys
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from riskloom.llm import minhash, outliers, queries, weaklabel  # noqa: E402

NAMES = ["quality_classifier", "quality_rules", "minhash_dedup", "packing"]


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    assert corpus_pipeline.ORACLE_SQL is None


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)}


def test_as_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in weaklabel.classify(docs).collect() if r.kept}
    left = docs.filter(docs.doc_id.isin(sorted(kept)))
    kept = {r.doc_id for r in outliers.quality_rules(left).collect() if r.kept}
    left = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept)
    up = {}
    for i, text in left:
        up[i] = i
        a = shingle_set(text)
        for j, other in left:
            if j >= i:
                break
            b = shingle_set(other)
            if 100 * len(a & b) >= 75 * len(a | b):
                x, y = i, j
                while up[x] != x:
                    x = up[x]
                while up[y] != y:
                    y = up[y]
                up[max(x, y)] = min(x, y)
    want = {i for i in up if up[i] == i}
    assert 0 < len(want) < docs.count()
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in pieces} == want
    ids, fill = defaultdict(int), defaultdict(int)
    for r in pieces:
        ids[r.doc_id] += r.length
        fill[r.sequence_id] += r.length
    assert all(r.doc_tokens == ids[r.doc_id] for r in pieces)
    assert max(fill.values()) <= 2048 and len(fill) * 2032 <= sum(ids.values()) + 2048


def odd(spark):
    prose = "Plain words make a sentence here, and another one follows it soon after that. It says nothing much, but does so in a calm voice, as many texts do. "
    rows = [(1, prose + "one", "en", None, 1), (1, prose + "one", "en", None, 1), (None, prose + "two words more than that", None, "s", None), (2, None, "en", "s", 0), (3, "", "de", "s", 0), (4, prose + "one", "en", "s", 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, distance int, doc int"
    return spark.createDataFrame([(*x, "x", 1, 2) for x in rows], schema)


@pytest.mark.parametrize("stage", range(3))
def test_filters_keep_columns_and_odd_rows(spark, sf_dir, stage):
    docs = odd(spark)
    for rows in (docs, docs.limit(0)):
        got = corpus_pipeline.STAGES[stage][1](spark, rows, sf_dir)
        assert got.columns == docs.columns
        ids = sorted(str(r.doc_id) for r in got.collect())
        if rows is not docs:
            assert ids == []
        elif stage == 2:
            # one row of each group stays, here of the four like texts one with the smallest id;
            # texts without a word are alike with nothing
            assert ids == ["1", "2", "3"]
        else:
            assert ids == ["1", "1", "4", "None"]


PROSE = "Plain words make a sentence here, and another one follows it soon after that. It says nothing much, but does so in a calm voice, as many texts do. "
OTHER = "The river runs down from the hills past three old mills, and boats go along it in summer. Children swim near the bridge while their parents sit and talk in the shade. "


@pytest.mark.parametrize("stage", range(2))
def test_a_rejected_row_takes_no_other_with_it(spark, sf_dir, stage):
    rows = [(None, PROSE), (None, ""), (None, OTHER), (7, PROSE), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.STAGES[stage][1](spark, docs, sf_dir).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted([("7", PROSE), ("None", PROSE), ("None", OTHER)])


def test_one_row_of_each_group_stays(spark, sf_dir):
    rows = [(None, PROSE), (None, PROSE), (9, OTHER), (9, OTHER), (None, OTHER), (4, OTHER), (None, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.minhash_dedup(spark, docs, sf_dir).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted(
        [("None", PROSE), ("4", OTHER), ("None", "None"), ("3", "None")]
    )


def test_last_stage_on_odd_rows(spark, sf_dir):
    pack = corpus_pipeline.STAGES[3][1]
    assert pack(spark, odd(spark).limit(0), sf_dir).collect() == []
    assert len({r.sequence_id for r in pack(spark, odd(spark), sf_dir).collect()}) == 1


COLUMNS = {
    "op1": "doc_id n_shingles component_id kept",
    "op2": "vec_id n_links component_id kept",
    "op3": "page_id payload_bytes payload_digest record_type refers_to",
    "op4": "doc_id n_pieces ids_crc32",
    "op5": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7": "doc_id start n_tokens ids_crc32",
    "op8": "doc_id kept",
    "op9": "page_id url text n_chars",
    "op10": "doc_id size text_crc32 law shard slot grown_shard",
    "op11": "lang source part item value rank",
    "op12": "anchor_id positive_id rank negative_id positive_score negative_score",
    "op13": "doc_id held_out score predicted",
}
TABLE = {"op2": "embeddings", "op3": "pages", "op9": "pages"}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_their_whole_tables(spark, sf_dir, name):
    op = name.split("_")[0]
    got = queries.QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[op].split()) <= set(got.columns)
    if op == "op11":  # rows per group
        groups = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source").distinct()
        assert got.select("lang", "source").distinct().count() == groups.count()
        return
    if op == "op12":  # rows per anchor
        anchors = {r.anchor_id for r in got.collect()}
        assert anchors and all(i % 100 == 0 for i in anchors)
        return
    key = COLUMNS[op].split()[0]
    table = spark.read.parquet(f"{sf_dir}/{TABLE.get(op, 'documents')}.parquet")
    assert got.select(key).distinct().count() == table.select(key).distinct().count()
    if op != "op5":
        assert got.count() == table.count()


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == set(COLUMNS)
    assert minhash.THRESHOLD == 75


def test_keys_come_from_the_files(spark, tmp_path):
    """Rows of Parquet files need no copy; a table of another origin gets one."""
    rows = spark.range(0, 500, 1, 7).withColumn("_row_key", F.lit("x"))
    rows.write.parquet(str(tmp_path / "p"))
    read = spark.read.parquet(str(tmp_path / "p"))
    keyed, key = corpus_pipeline._keyed(read, "test")
    assert key == "__row_key" and keyed.columns == ["id", "_row_key", key]
    once, again = ({r["id"]: r[key] for r in keyed.collect()} for _ in range(2))
    assert once == again and len(set(once.values())) == 500
    assert set(keyed.inputFiles()) >= set(read.inputFiles())
    for other in (read.join(read.select("id"), "id"), read.union(read), rows):
        copied, key = corpus_pipeline._keyed(other, "test")
        assert copied.select(key).distinct().count() == other.count()
        assert not set(copied.inputFiles()) & set(read.inputFiles())


def test_many_rejected_rows_are_joined_by_shuffle(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_FILES", 0)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in weaklabel.classify(docs).collect() if r.kept}
    got = corpus_pipeline.quality_classifier(spark, docs, sf_dir)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(kept)
