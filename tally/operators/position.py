"""Explicit output positions.

Every ordered result carries a ``pos`` column so that its order survives
shuffles and writes. Results that the metric itself keeps few are numbered with
one window. Anything else is ordered by range over all partitions and written
once; a row's position is its place in its part of the written table, after all
rows of the parts before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.storage import stored


def with_position(
    df: DataFrame,
    order: Sequence[str],
    *,
    by: Sequence[str] = (),
    pos: str = "pos",
    few: bool = False,
) -> DataFrame:
    """Number rows from 1 (BIGINT) by ascending ``order`` columns, per group ``by``.

    ``order`` must be a total order within a group; ``by`` are numbers that a metric
    bounds. ``few`` is for frames whose size is bounded by the parameters of a metric
    (a percent floor, a top-k); it numbers each group in one task.

    Otherwise ``df`` runs once, into the shared folder. Positions come from what was
    written, so a task that runs again, or a range cut elsewhere, changes none.
    """
    if few:
        number = F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("bigint")
        return df.withColumn(pos, number)

    placed = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    # Ids rise along a partition without gaps.
    written = stored(
        placed.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()),
        "ordered",
    )
    parts = written.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    starts = parts.select(
        *by, "__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1).alias("__shift")
    )
    # One row for each partition and group, which the metric and the settings bound.
    numbered = written.join(F.broadcast(starts), [*by, "__part"])
    kept = [c for c in df.columns if c != pos]
    return numbered.select(*kept, (F.col("__row") + F.col("__shift")).alias(pos))
