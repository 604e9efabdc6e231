"""The corpus pipeline: classify, apply quality rules, drop near-duplicates, pack.

``run`` applies the stages to ``documents``; each stage's rows are written as Parquet and read
again as the next one's input.  A stage keeps its input's columns, whatever they are, and all but
the last return them.  Each row has its own verdict, whatever its id: a stage judges by a key per
row, its file and its place there, so null and repeated ids neither drop nor keep each other.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from riskloom.llm import minhash, outliers, packing, weaklabel
from riskloom.session import stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: Most rejected rows whose keys are sent to all tasks; more are joined by a shuffle.
BROADCAST_ROWS = 4_000_000
#: Most files whose numbers are sent to all tasks; a table of more is stored anew with its keys.
BROADCAST_FILES = 200_000
#: Bits of a key that number the rows of a file.
ROW_BITS = 40
_SCAN = re.compile(r"[ :+-]*(Project|Filter|SubqueryAlias|Relation)\b")


def _keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The documents with a key that no two rows share, the same in every read, and the key's name.

    Rows of Parquet files have one already: their file and their place in it.  Others are stored
    with a key.
    """
    key = "_row_key"
    while key in docs.columns:
        key = f"_{key}"
    if docs.inputFiles() and all(map(_SCAN.match, docs._jdf.queryExecution().analyzed().toString().strip().splitlines())):
        place, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
        files = docs.select(place.alias("_path")).distinct()
        files = stage(files.select("_path", F.row_number().over(Window.orderBy("_path")).alias("_file")), f"pipeline-{name}-files")
        if files.count() <= BROADCAST_FILES:
            marked = docs.select("*", place.alias(f"{key}_path"), row.alias(f"{key}_row"))
            numbered = marked.join(F.broadcast(files), marked[f"{key}_path"] == files["_path"])
            found = F.shiftleft(F.col("_file").cast("long"), ROW_BITS) + F.col(f"{key}_row")
            return numbered.select(*[docs[c] for c in docs.columns], found.alias(key)), key
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), f"pipeline-{name}-rows"), key


def _without(docs: DataFrame, key: str, gone: DataFrame, name: str) -> DataFrame:
    """The rows whose key is not among the rejected ones; texts are shuffled only if these are many."""
    gone = stage(gone.select(F.col(key).alias("_gone")), f"pipeline-{name}-rejected")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(gone, docs[key] == gone["_gone"], "left_anti").drop(key)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly taught classifier takes for good."""
    rows, key = _keyed(docs, "classifier")
    verdict = weaklabel.classify(rows, id_column=key)
    return _without(rows, key, verdict.filter(~F.col("kept")), "classifier")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base rule and the robust ellipsoid of their language and source."""
    rows, key = _keyed(docs, "rules")
    verdict = outliers.quality_rules(rows, id_column=key)
    return _without(rows, key, verdict.filter(~F.col("kept")), "rules")


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, of those with the smallest id; null ids come last."""
    rows, key = _keyed(docs, "dedup")
    groups = minhash.near_duplicates(rows, id_column=key).select(key, "component_id")
    named = stage(groups.join(rows.select(key, F.col("doc_id").alias("_id")), key), "pipeline-groups")
    # a group of any size meets in as many rows as there are tasks
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col(key).alias("key"))
    chosen = named.groupBy("component_id").agg(F.min(order)["key"].alias(key))
    return _without(rows, key, named.join(chosen.select(key), key, "left_anti"), "dedup")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, packed into sequences of at most 2048 ids."""
    pieces = packing.pack(docs, TOKENIZER, end_id=1, window=2048)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("minhash_dedup", minhash_dedup),
    ("packing", pack),
]

#: The classifier and the estimates cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
