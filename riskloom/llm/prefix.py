"""Running totals over a total order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from riskloom.session import stage

PART = "_part"


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def part_bases(totals: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """What stands before each part: ``totals`` has one row per part (and per ``by``).

    The window sorts as many rows as there are parts, per value of ``by``.
    """
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *by,
        PART,
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_base_{v}") for v in values],
    )


def with_running_totals(
    df: DataFrame, order: Sequence[str | Column], values: dict[str, str], name: str
) -> DataFrame:
    """Add, for each ``new: old`` of ``values``, the sum of long ``old`` over all rows before.

    Rows are dealt to parts by ranges of ``order``, summed within a part as they stream by, and
    moved by the part's base, a prefix sum over the parts' totals.  Rows equal in ``order`` get
    distinct totals in any order, so ``order`` should be total.  Nulls count 0.  A key that many
    rows share may span parts if ``order`` goes on after it.
    """
    fields = df.columns
    schema = StructType(
        [
            *df.schema.fields,
            *[StructField(new, LongType()) for new in values],
            StructField(PART, IntegerType()),
        ]
    )

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        carried = dict.fromkeys(values, 0)
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for new, old in values.items():
                x = batch.column(fields.index(old)).fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(x.astype(np.int64)) + carried[new]
                columns.append(pa.array(ends - x))
                carried[new] = int(ends[-1]) if len(ends) else carried[new]
            columns.append(pa.array(np.full(batch.num_rows, part, np.int32)))
            yield pa.RecordBatch.from_arrays(columns, [*fields, *values, PART])

    dealt = df.repartitionByRange(partitions(df), *order).sortWithinPartitions(*order)
    local = stage(dealt.mapInArrow(accumulate, schema), name)
    totals = local.groupBy(PART).agg(*[F.sum(old).alias(new) for new, old in values.items()])
    # one row per part: as many as spark.sql.shuffle.partitions
    moved = local.join(F.broadcast(part_bases(totals, list(values))), PART)
    return moved.select(
        *fields, *[(F.col(new) + F.col(f"_base_{new}")).alias(new) for new in values]
    )
