"""Exact set combinations of a multi-select question."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.operators.position import with_position
from tally.operators.specs import yes_flags

# Default floor and display cap of the combination report.
MIN_SIZE = 5
MAX_COMBOS = 20

# Sets whose membership one BIGINT of the group key holds.
_SETS_PER_MASK = 62


def combination_sizes(df: DataFrame, choices: Mapping[str, str | Column]) -> DataFrame:
    """``(members, size)`` of every non-empty exact membership, members in set order."""
    flags = [F.coalesce(flag, F.lit(False)) for flag in yes_flags(df, list(choices.values()))]
    labels = [F.lit(choice) for choice in choices]
    masks: list[Column] = []
    for low in range(0, len(flags), _SETS_PER_MASK):
        mask = F.lit(0).cast("bigint")
        for i, flag in enumerate(flags[low : low + _SETS_PER_MASK]):
            mask = mask + F.when(flag, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        masks.append(mask.alias(f"mask{len(masks)}"))
    keys = [f"mask{i}" for i in range(len(masks))]
    sizes = (
        df.select(*masks)
        .filter(" OR ".join(f"{key} > 0" for key in keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("size"))
    )
    bits = []
    for i, name in enumerate(labels):
        mask, place = divmod(i, _SETS_PER_MASK)
        bits.append(F.when(F.col(keys[mask]).bitwiseAND(F.lit(1 << place)) != 0, name))
    return sizes.select(F.array_compact(F.array(*bits)).alias("members"), "size")


def set_combinations(
    df: DataFrame,
    choices: Mapping[str, str | Column],
    *,
    min_size: int = MIN_SIZE,
    max_combos: int = MAX_COMBOS,
) -> DataFrame:
    """The largest exact memberships: ``(pos, members, size, dropped)``.

    ``dropped`` counts the distinct combinations that are not listed, because
    they are smaller than ``min_size`` or beyond ``max_combos``.
    """
    return largest_sizes(combination_sizes(df, choices), min_size=min_size, max_combos=max_combos)


def largest_sizes(sizes: DataFrame, *, min_size: int, max_combos: int) -> DataFrame:
    """Rows of :func:`set_combinations` from ``(members, size)``."""
    shown = F.least(F.count_if(F.col("size") >= min_size), F.lit(max_combos))
    dropped = sizes.agg((F.count(F.lit(1)) - shown).alias("dropped")).scalar()
    top = (
        sizes.filter(F.col("size") >= min_size)
        .withColumn("__most", -F.col("size"))
        .orderBy("__most", "members")
        .limit(max_combos)
    )
    placed = with_position(top, ["__most", "members"], few=True)
    return placed.select(
        "pos", "members", "size", dropped.alias("dropped")
    )


def combinations_dropped(
    df: DataFrame,
    choices: Mapping[str, str | Column],
    *,
    min_size: int = MIN_SIZE,
    max_combos: int = MAX_COMBOS,
) -> DataFrame:
    """One row ``(shown, dropped)``, also when no combination reaches the floor."""
    return dropped_of_sizes(combination_sizes(df, choices), min_size=min_size, max_combos=max_combos)


def dropped_of_sizes(sizes: DataFrame, *, min_size: int, max_combos: int) -> DataFrame:
    """Row of :func:`combinations_dropped` from ``(members, size)``."""
    shown = F.least(F.count_if(F.col("size") >= min_size), F.lit(max_combos).cast("bigint"))
    return sizes.agg(
        shown.alias("shown"), (F.count(F.lit(1)) - shown).alias("dropped")
    )


def totals_of_sizes(sizes: DataFrame, sets: Sequence[str]) -> DataFrame:
    """Set totals ``(pos, label, count)`` added up from combination sizes."""
    slots = [f"__n{i}" for i in range(len(sets))]
    sums = [
        F.coalesce(
            F.sum(F.when(F.array_contains("members", F.lit(label)), F.col("size"))),
            F.lit(0).cast("bigint"),
        ).alias(slot)
        for label, slot in zip(sets, slots)
    ]
    rows = [
        F.struct(
            F.lit(i + 1).alias("pos"), F.lit(label).alias("label"), F.col(slot).alias("count")
        )
        for i, (label, slot) in enumerate(zip(sets, slots))
    ]
    return sizes.agg(*sums).select(F.inline(F.array(*rows)))
