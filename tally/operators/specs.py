"""Small helpers for evaluating several named metrics in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import string_array

# Index of a metric inside its family; absent when the family has one member.
METRIC = "__metric"


def as_column(value: str | Column) -> Column:
    return F.col(f"`{value}`") if isinstance(value, str) else value


def group_keys(count: int) -> list[str]:
    return [METRIC] if count > 1 else []


def stack(
    df: DataFrame, rows: Sequence[tuple[int, Sequence[Column]]], names: Sequence[str]
) -> DataFrame:
    """Several output rows per input row, each given as its metric and its values.

    ``stack`` stays in generated code, unlike building and filtering arrays. Its
    metric is never null; saying so keeps later joins from filtering below the
    aggregation, which would give each reader a scan of its own.
    """
    cells = [part for metric, values in rows for part in (F.lit(metric), *values)]
    stacked = df.select(F.stack(F.lit(len(rows)), *cells).alias(METRIC, *names))
    return stacked.withColumn(METRIC, F.coalesce(METRIC, F.lit(0)))


def kept_per_metric(column: str, excludes: Sequence[Sequence[str] | None]) -> Column:
    """Whether a stacked value is not excluded for its metric; null fails any list."""
    keep = F.lit(True)
    for i, exclude in enumerate(excludes):
        if exclude:
            keep = F.when(F.col(METRIC) == i, ~F.col(column).isin(list(exclude))).otherwise(keep)
    return keep


def pick(values: Sequence[Column]) -> Column:
    """The entry that belongs to the row's metric."""
    if len(values) == 1:
        return values[0]
    return F.element_at(F.array(*values), F.col(METRIC) + 1)


def pick_order(orders: Sequence[Sequence[str] | None]) -> Column:
    if all(order is None for order in orders):
        return F.lit(None).cast("array<string>")
    return pick([string_array(order) for order in orders])


def per_metric(
    frame: DataFrame, value: Column, count: int, *, pin: Sequence[str] = ()
) -> Column:
    """Aggregate ``value`` over each metric of an aggregated frame, as a scalar.

    The lookup holds one entry per metric, so its size is the family's size.
    ``pin`` names columns that ``value`` does not use but other readers of
    ``frame`` do: reading them here too lets all readers share one shuffle.
    """
    result = F.struct(value.alias("value"), *[F.max(c).alias(c) for c in pin])
    if count == 1:
        return frame.agg(result.alias("v")).scalar()["value"]
    totals = frame.groupBy(METRIC).agg(result.alias("v"))
    lookup = F.map_from_entries(F.collect_list(F.struct(METRIC, "v")))
    return F.element_at(totals.agg(lookup.alias("m")).scalar(), F.col(METRIC))["value"]


def name_column(names: Sequence[str]) -> Column:
    return pick([F.lit(name) for name in names])


def yes_flags(df: DataFrame, columns: Sequence[str | Column]) -> list[Column]:
    """Pick flags: boolean columns are taken as they are, others compare to Yes.

    The schema is asked once for all of them.
    """
    values = [as_column(column) for column in columns]
    kinds = [f.dataType.typeName() for f in df.select(*values).schema] if values else []
    return [v if kind == "boolean" else v == F.lit("Yes") for v, kind in zip(values, kinds)]


def named(metrics: dict, what: str) -> tuple[list[str], list]:
    if not metrics:
        raise ValueError(f"at least one {what} is needed")
    return list(metrics), list(metrics.values())
