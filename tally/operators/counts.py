"""Frequency counts of single- and multi-select answers with rare-value suppression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import check_order, keep_values, ordinal_rank, percent_of
from tally.operators.position import with_position
from tally.operators.specs import (
    as_column,
    group_keys,
    kept_per_metric,
    name_column,
    named,
    per_metric,
    pick,
    pick_order,
    stack,
    yes_flags,
)

# Default privacy thresholds and the label of the combined bin.
MIN_PERCENT = 0.5
MIN_COUNT = 5
COMBINED_LABEL = "Other (combined)"

_ACTIONS = ("combine", "drop")
# A floor of this many percent leaves 10,001 bins at most.
_FEW_PERCENT = 0.01


@dataclass(frozen=True)
class SingleCount:
    """How to count one single-choice column."""

    column: str | Column
    order: Sequence[str] | None = None
    exclude: Sequence[str] | None = None
    min_percent: float | None = MIN_PERCENT
    min_count: int | None = MIN_COUNT
    action: str = "combine"

    def __post_init__(self) -> None:
        check_order(self.order)
        _check_action(self.action)

    def few_bins(self) -> bool:
        """Whether the percent floor leaves no more than some thousand bins."""
        return bool(self.min_percent) and self.min_percent >= _FEW_PERCENT


@dataclass(frozen=True)
class MultiCount:
    """How to count the flag columns of one multi-select question."""

    choices: Mapping[str, str | Column]
    min_percent: float | None = MIN_PERCENT
    min_count: int | None = MIN_COUNT
    action: str = "combine"

    def __post_init__(self) -> None:
        _check_action(self.action)
        if not self.choices:
            raise ValueError("a multi-select question needs at least one choice column")


def _check_action(action: str) -> None:
    if action not in _ACTIONS:
        raise ValueError(f"action must be one of {_ACTIONS}, not {action!r}")


def is_rare(
    count: Column, percent: Column, min_percent: float | None, min_count: int | None
) -> Column:
    """Below either floor; a floor of None or 0 is off."""
    rare = F.lit(False)
    if min_percent:
        rare = rare | (percent < F.lit(float(min_percent)))
    if min_count:
        rare = rare | (count < F.lit(int(min_count)))
    return rare


def value_counts(df: DataFrame, metrics: Sequence[SingleCount]) -> DataFrame:
    """(metric, label, n) for all metrics in one scan and one shuffle.

    Partial aggregation runs before the shuffle, so a dominant label costs each
    task one row.
    """
    if len(metrics) == 1:
        value = as_column(metrics[0].column)
        kept = keep_values(df, value, metrics[0].exclude)
        answers = kept.select(value.cast("string").alias("label"))
    else:
        values = [[as_column(metric.column).cast("string")] for metric in metrics]
        answers = stack(df, list(enumerate(values)), ["label"]).filter(
            kept_per_metric("label", [metric.exclude for metric in metrics])
        )
    keys = [*group_keys(len(metrics)), "label"]
    return answers.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def suppress_rare(
    tallied: DataFrame, total: Column, metrics: Sequence[SingleCount]
) -> DataFrame:
    """Combine or drop labels below the floors; the total keeps every row."""
    keys = group_keys(len(metrics))
    if not any(m.min_percent or m.min_count for m in metrics):
        return tallied.withColumn("__combined", F.lit(False))
    share = percent_of(F.col("n"), total)
    rare = pick([is_rare(F.col("n"), share, m.min_percent, m.min_count) for m in metrics])
    flagged = tallied.withColumn("__rare", rare)
    drop = pick([F.lit(m.action == "drop") for m in metrics])
    kept = flagged.filter(~(F.col("__rare") & drop))
    if all(m.action == "drop" for m in metrics):
        return kept.withColumnRenamed("__rare", "__combined")
    label = F.when(~F.col("__rare"), F.col("label"))
    return (
        kept.groupBy(*keys, F.col("__rare").alias("__combined"), label.alias("label"))
        .agg(F.sum("n").alias("n"))
        .withColumn(
            "label",
            F.when(F.col("__combined"), F.lit(COMBINED_LABEL)).otherwise(F.col("label")),
        )
    )


def counts_single_family(df: DataFrame, metrics: Mapping[str, SingleCount]) -> DataFrame:
    """Count several single-choice columns in one pass.

    Returns ``(name, pos, label, count, percent)``, ``pos`` starting at 1 in each
    name. Bins are ordered by the metric's ordinal scale when it has one, then by
    count descending, then by label.
    """
    names, specs = named(dict(metrics), "single-choice metric")
    return single_bins(value_counts(df, specs), names, specs)


def single_bins(
    tallied: DataFrame, names: Sequence[str], specs: Sequence[SingleCount], *, few: bool = False
) -> DataFrame:
    """Bins of :func:`counts_single_family` from its counted labels; ``few`` as in :func:`with_position`."""
    keys = group_keys(len(specs))
    total = per_metric(tallied, F.sum("n"), len(specs))
    bins = suppress_rare(tallied, total, specs).select(
        *keys,
        "label",
        "n",
        "__combined",
        ordinal_rank(F.col("label"), pick_order([m.order for m in specs])).alias("__rank"),
        (-F.col("n")).alias("__most"),
        total.alias("__total"),
    )
    placed = with_position(
        bins,
        ["__rank", "__most", "label", "__combined"],
        by=keys,
        few=few or all(m.few_bins() for m in specs),
    )
    return placed.select(
        name_column(names).alias("name"),
        "pos",
        "label",
        F.col("n").alias("count"),
        percent_of(F.col("n"), F.col("__total")).alias("percent"),
    )


def counts_single(
    df: DataFrame,
    column: str | Column,
    *,
    order: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    min_percent: float | None = MIN_PERCENT,
    min_count: int | None = MIN_COUNT,
    action: str = "combine",
) -> DataFrame:
    """Bins ``(pos, label, count, percent)`` of one single-choice column.

    Excluded values leave the base before percentages are taken. Values below
    ``min_percent`` percent or ``min_count`` rows are combined under one label or
    dropped, while percentages keep the full base.
    """
    metric = SingleCount(column, order, exclude, min_percent, min_count, action)
    return counts_single_family(df, {"": metric}).drop("name")


def counts_multi_family(df: DataFrame, metrics: Mapping[str, MultiCount]) -> DataFrame:
    """Count several multi-select questions in one pass.

    All picks are conditional counts of a single one-row aggregate; the bins are
    then shaped from that row, whose arrays are as long as the declared choices.
    Returns ``(name, pos, label, count, percent)``.
    """
    names, specs = named(dict(metrics), "multi-select metric")
    questions = multi_slots(specs)
    flags = yes_flags(df, [column for metric in specs for column in metric.choices.values()])
    slots = [slot for question in questions for _, slot in question]
    counters = [F.count_if(flag).alias(slot) for flag, slot in zip(flags, slots)]
    row = df.agg(F.count(F.lit(1)).alias("__total"), *counters)
    return multi_bins(row, names, specs)


def multi_slots(specs: Sequence[MultiCount]) -> list[list[tuple[str, str]]]:
    """(choice, column of the one-row aggregate) per metric."""
    return [[(choice, f"__q{q}_{i}") for i, choice in enumerate(m.choices)] for q, m in enumerate(specs)]


def multi_bins(row: DataFrame, names: Sequence[str], specs: Sequence[MultiCount]) -> DataFrame:
    """Bins from one row with ``__total`` and the picks of each choice; none without respondents."""
    return _multi_bins(row.filter(F.col("__total") > 0), names, specs, multi_slots(specs))


def _multi_bins(row: DataFrame, names, specs, questions) -> DataFrame:
    total = F.col("__total")
    blocks = []
    for name, metric, slots in zip(names, specs, questions):
        bins = [
            F.struct(
                (-F.col(slot)).alias("most"),
                F.lit(i).alias("choice_pos"),
                F.lit(choice).alias("label"),
                F.col(slot).alias("count"),
                percent_of(F.col(slot), total).alias("percent"),
            )
            for i, (choice, slot) in enumerate(slots)
        ]
        ranked = F.array_sort(F.array(*bins))
        blocks.append(
            F.struct(F.lit(name).alias("name"), _floor_bins(ranked, metric).alias("bins"))
        )
    exploded = row.select(F.inline(F.array(*blocks))).select("name", F.posexplode("bins"))
    return exploded.select(
        "name",
        (F.col("pos") + 1).alias("pos"),
        F.col("col.label").alias("label"),
        F.col("col.count").alias("count"),
        F.col("col.percent").alias("percent"),
    )


def _floor_bins(ranked: Column, metric: MultiCount) -> Column:
    """Apply the floors to a ranked array of bins; the combined bin goes last."""

    def public(b: Column) -> Column:
        return F.struct(b["label"].alias("label"), b["count"].alias("count"), b["percent"].alias("percent"))

    def rare(b: Column) -> Column:
        return is_rare(b["count"], b["percent"], metric.min_percent, metric.min_count)

    kept = F.transform(F.filter(ranked, lambda b: ~rare(b)), public)
    if metric.action == "drop" or not (metric.min_percent or metric.min_count):
        return kept
    pooled = F.filter(ranked, rare)
    combined = F.struct(
        F.lit(COMBINED_LABEL).alias("label"),
        F.aggregate(pooled, F.lit(0).cast("bigint"), lambda acc, b: acc + b["count"]).alias("count"),
        F.aggregate(pooled, F.lit(0.0), lambda acc, b: acc + b["percent"]).alias("percent"),
    )
    return F.when(F.size(pooled) > 0, F.concat(kept, F.array(combined))).otherwise(kept)


def counts_multi(
    df: DataFrame,
    choices: Mapping[str, str | Column],
    *,
    min_percent: float | None = MIN_PERCENT,
    min_count: int | None = MIN_COUNT,
    action: str = "combine",
) -> DataFrame:
    """Bins ``(pos, label, count, percent)`` of one multi-select question.

    ``choices`` maps each choice to its flag column. Percentages are over all
    rows. Bins go by share, ties in choice order, the combined bin last.
    """
    metric = MultiCount(choices, min_percent, min_count, action)
    return counts_multi_family(df, {"": metric}).drop("name")


def counts_multi_long(
    picks: DataFrame,
    choice: str | Column,
    choices: Sequence[str] | None,
    total: Column,
    *,
    min_percent: float | None = MIN_PERCENT,
    min_count: int | None = MIN_COUNT,
    action: str = "combine",
) -> DataFrame:
    """Multi-select counts from a long table holding one row per pick.

    Long tables lose whoever picked nothing, so ``total`` (a literal or a scalar
    subquery) gives the number of respondents. A pick outside the declared
    ``choices`` fails the query; without declared choices (None) every choice
    picked is counted, ties going by label. Null picks count for nothing.
    """
    value = as_column(choice)
    if choices is None:
        return _open_choices(picks, value, total, SingleCount("", None, None, min_percent, min_count, action))
    metric = MultiCount({c: c for c in choices}, min_percent, min_count, action)
    slots = [(c, f"__q0_{i}") for i, c in enumerate(choices)]
    counters = [F.count_if(value == F.lit(c)).alias(slot) for c, slot in slots]
    row = picks.agg(*counters, _undeclared(value, choices).alias("__other"))
    # The check sits in the base, which every bin reads.
    base = _unless_undeclared(F.col("__other"), total.cast("bigint"))
    row = row.withColumn("__total", base).filter(F.col("__total") > 0)
    return _multi_bins(row, [""], [metric], [slots]).drop("name")


def _undeclared(value: Column, choices: Sequence[str]) -> Column:
    """Aggregate: the smallest pick that no declared choice covers, or null."""
    return F.min(F.when(~value.isin(list(choices)), value.cast("string")))


def _unless_undeclared(other: Column, value: Column) -> Column:
    message = F.concat(F.lit("picks name choices that are not declared, such as "), other)
    return F.when(other.isNotNull(), F.raise_error(message).cast("bigint")).otherwise(value)


def _open_choices(picks: DataFrame, value: Column, total: Column, metric: SingleCount) -> DataFrame:
    """Bins of whatever was picked; the combined bin goes last."""
    base = total.cast("bigint")
    tallied = (
        picks.filter(value.isNotNull())
        .groupBy(value.cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    bins = suppress_rare(tallied, base, [metric]).withColumn("__most", -F.col("n")).withColumn("__total", base)
    placed = with_position(bins, ["__combined", "__most", "label"])
    share = percent_of(F.col("n"), F.col("__total"))
    return placed.select("pos", "label", F.col("n").alias("count"), share.alias("percent"))


def set_totals(df: DataFrame, choices: Mapping[str, str | Column]) -> DataFrame:
    """``(pos, label, count)`` per choice in choice order; unpicked choices show 0."""
    slots = [(choice, f"__n{i}") for i, choice in enumerate(choices)]
    counters = [
        F.count_if(flag).alias(slot) for (_, slot), flag in zip(slots, yes_flags(df, list(choices.values())))
    ]
    rows = [
        F.struct(
            F.lit(i + 1).alias("pos"), F.lit(choice).alias("label"), F.col(slot).alias("count")
        )
        for i, (choice, slot) in enumerate(slots)
    ]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def flags_from_long(
    df: DataFrame, ids: Sequence[str], choice: str | Column, choices: Sequence[str]
) -> tuple[DataFrame, dict[str, str]]:
    """One row per respondent with a boolean column per choice, and the column map.

    Repeated picks collapse, and partial aggregation keeps a respondent with many
    rows from reaching one task as a block. A pick outside ``choices`` fails the query.
    """
    value = as_column(choice)
    columns = {c: f"pick_{i}" for i, c in enumerate(choices)}
    flags = [
        F.coalesce(F.bool_or(value == F.lit(c)), F.lit(False)).alias(name)
        for c, name in columns.items()
    ]
    picked = df.groupBy(*ids).agg(*flags, _undeclared(value, choices).alias("__other"))
    # Every flag carries the check, whichever of them is read.
    checked = [
        (_unless_undeclared(F.col("__other"), F.col(name).cast("bigint")) == 1).alias(name)
        for name in columns.values()
    ]
    return picked.select(*ids, *checked), columns
