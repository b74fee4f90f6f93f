"""Ranks inside groups that may hold most of all rows.

A window gathers a group in one task.  Here rows are sorted over all tasks by group and order,
so a large group lies in many partitions; rows are numbered inside their part of a group, the
parts (one row per group and partition) are counted, and each part starts where those before
it end.  No task holds more of a group than a partition has, whatever adaptive execution does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventgauge.sources.kept import kept

_PART, _PLACE = "_rank_part", "_rank_place"


def ranked(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "rank",
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows with their number (from 1) inside their group, nulls first.

    ``totals`` are sums over the group to be added to each of its rows; they come from the same
    counts.  The sorted rows are kept, because the borders of a range partitioning are found by
    a sample and must be the same for rows and counts.
    """
    wanted = totals or {}
    spread = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = kept(
        spread.withColumns(
            {_PART: F.spark_partition_id(), _PLACE: F.monotonically_increasing_id()}
        )
    )
    parts = placed.groupBy(*keys, _PART).agg(
        F.min(_PLACE).alias("_first"),
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(column).alias(f"_sum_{k}") for k, column in wanted.items()],
    )
    # As many rows a group as it has partitions.
    group = W.partitionBy(*keys)
    before = group.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    told = parts.select(
        *[F.col(key).alias(f"_key_{key}") for key in keys],
        F.col(_PART).alias("_part"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        *[F.sum(f"_sum_{k}").over(group).alias(k) for k in wanted],
    )
    same = [F.col(key).eqNullSafe(F.col(f"_key_{key}")) for key in keys]
    joined = placed.join(told, reduce(lambda a, b: a & b, same, F.col(_PART) == F.col("_part")))
    return joined.select(
        *rows.columns, (F.col(_PLACE) + F.col("_shift")).alias(name), *wanted
    )
