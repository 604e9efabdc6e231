"""Tables laid out for their readers: bucketed by entity, numbered in file order."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import txn as b
from checks.registry import query
from checks.statistics import PROFILE_SQL, rounded_profile, scratch
from checks.txn import COLS, txn, txn_twice
from riskloom.operators import quality
from riskloom.operators.velocity import daily_count
from riskloom.plans import enrich
from riskloom.sources import layout, tables

BUCKETS = 8


def bucketed(spark, sf_dir):
    """Rows and entity lines in buckets of the card."""
    rows = txn(spark, sf_dir)
    counts = daily_count(rows, COLS.entity, COLS.time)
    lines = layout.entity_lines(enrich.fit_entities(rows, COLS, counts), counts, COLS.entity)
    return (layout.write_bucketed(x, [COLS.entity], BUCKETS) for x in (rows, lines))


@query(
    "bucketed_state",
    b.sql(
        f"SELECT pos, daily_txn_count, {PROFILE_SQL} FROM txn_profiled",
        b.distance("txn"),
        b.daily("txn"),
        b.profile("txn"),
        b.profiled("txn", "txn"),
    ),
)
def bucketed_state(spark, sf_dir):
    """Daily count and profile of every row, joined where the rows lie."""
    rows, lines = bucketed(spark, sf_dir)
    joined = layout.with_bucketed_state(rows, lines, COLS.entity, COLS.time)
    return rounded_profile(joined.select("pos", "daily_txn_count", *[c for c in joined.columns if c.startswith("user_")]))


def in_files(df, path: str, files: int) -> None:
    """Write a table as CSV in the order of ``pos``, over some files, without that column."""
    dealt = df.repartitionByRange(files, "pos").sortWithinPartitions("pos")
    tables.write_table(dealt.drop("pos"), path, "csv")


def read_in_order(spark, path: str, df):
    schema = df.drop("pos").schema
    return tables.read_csv(spark, path, schema, position="pos")


@query(
    "file_order",
    """SELECT row_number() OVER (ORDER BY event_id) - 1 AS pos, CAST(event_id AS VARCHAR) AS trans_num,
      user_id AS cc_num, value AS amt FROM events""",
)
def file_order(spark, sf_dir):
    """Positions of rows read from several files that hold none."""
    rows, path = txn(spark, sf_dir), scratch(spark, "ordered")
    in_files(rows, path, 5)
    return read_in_order(spark, path, rows).select("pos", "trans_num", "cc_num", "amt")


@query("dedup_file_order", b.sql("SELECT trans_num, cc_num, amt, state FROM txn_nulls"))
def dedup_file_order(spark, sf_dir):
    """The first row of each id in file order; every id comes again later with another amount."""
    rows, path = txn_twice(spark, sf_dir, extra=1.0), scratch(spark, "twice")
    in_files(rows, path, 7)
    first = quality.dedup_key(read_in_order(spark, path, rows), [COLS.key], ["pos"])
    return first.select("trans_num", "cc_num", "amt", "state")
