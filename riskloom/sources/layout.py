"""Tables laid out for what reads them: bucketed by entity, and numbered in file order."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.operators.lookup import fill_defaults
from riskloom.operators.ordering import ROW_BITS, global_position
from riskloom.operators.velocity import COUNT, PROFILE_COLUMNS, PROFILE_ROWS, unseen_defaults
from riskloom.session import shared_folder

# --- buckets ---------------------------------------------------------------------------------


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str | None = None) -> DataFrame:
    """Store a table in buckets of its keys, sorted by them, and read it back.

    Tables in as many buckets of the same keys join without moving a row.  Each bucket is one file
    from one task, so a key that holds a large share of the rows makes a large file; such tables
    are better joined by :func:`riskloom.operators.lookup.spread_lookup`.
    """
    spark = df.sparkSession
    name = name or f"riskloom_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/riskloom/{name}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


def entity_lines(profile: DataFrame, counts: DataFrame, entity: str) -> DataFrame:
    """One row per entity: its profile, and its daily counts as a map from day to count.

    The map is as long as the entity has days, whatever its rows.
    """
    days = counts.where(F.col("date").isNotNull()).groupBy(entity).agg(
        F.map_from_entries(F.collect_list(F.struct("date", COUNT))).alias("_days")
    )
    return profile.join(days, entity, "left")


def with_bucketed_state(
    rows: DataFrame, lines: DataFrame, entity: str, time: str, unseen: dict[str, float] | None = None, rows_as: str | None = None
) -> DataFrame:
    """What ``with_entity_state`` adds, from rows and lines bucketed alike: no row is moved.

    Daily counts are those behind the lines.  A row without a time has none; an entity without a
    line has no count and the profile of unseen entities.
    """
    values = [*PROFILE_COLUMNS, *([rows_as] if rows_as else [])]
    lines = lines.withColumn(rows_as, F.col(PROFILE_ROWS)) if rows_as else lines
    joined = rows.join(lines.select(entity, *values, "_days").hint("merge"), entity, "left")
    joined = joined.withColumn(COUNT, F.try_element_at("_days", F.to_date(time)))
    joined = fill_defaults(joined, unseen_defaults() if unseen is None else unseen)
    joined = fill_defaults(joined, {rows_as: 0}) if rows_as else joined
    return joined.select(*rows.columns, COUNT, *values)


# --- file order ------------------------------------------------------------------------------


def with_file_position(df: DataFrame, out: str = "pos") -> DataFrame:
    """Number the rows of a table that was read from files as they stand in them, from 0.

    Files come in the order of their paths, their blocks by offset, and rows of a block as they are
    read: metadata of the scan that cost no read of their own.  ``df`` is a scan, or columns of one.
    """
    names, taken = [], {c.lower() for c in df.columns}
    for name in ("_file", "_block", "_row"):
        while name in taken:
            name = f"_{name}"
        names.append(name)
    # a task reads a block from its start, so its running row number orders the block's rows
    running = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    marked = df.select("*", *[x.alias(n) for n, x in zip(names, (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), running))])
    return global_position(marked, names, out).drop(*names)
