"""Cross-tabulation of two single-choice questions, or of a multi- with a single-choice one.

Results are long and dense: one row for every x label and every y label present.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import keep_values, ordinal_rank, percent_of
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
from tally.storage import stored

# How a cell's value is to be read.
RATE = "rate_pct"
COMPOSITION = "composition_pct"
LIFT = "lift"
CELL_KINDS = {"rate": RATE, "composition": COMPOSITION, "lift": LIFT}

_NORMALIZE = ("global", "x", "y")


@dataclass(frozen=True)
class CrossTab:
    """How to cross two single-choice columns."""

    x: str | Column
    y: str | Column
    normalize: str = "global"
    x_order: Sequence[str] | None = None
    y_order: Sequence[str] | None = None
    x_exclude: Sequence[str] | None = None
    y_exclude: Sequence[str] | None = None

    def __post_init__(self) -> None:
        if self.normalize not in _NORMALIZE:
            raise ValueError(f"normalize must be one of {_NORMALIZE}, not {self.normalize!r}")


def _pair_counts(df: DataFrame, specs: Sequence[CrossTab]) -> DataFrame:
    """(metric, x, y, n): one scan, one shuffle, combined before the shuffle."""
    if len(specs) == 1:
        spec = specs[0]
        x, y = as_column(spec.x), as_column(spec.y)
        kept = keep_values(keep_values(df, x, spec.x_exclude), y, spec.y_exclude)
        pairs = kept.select(x.cast("string").alias("x"), y.cast("string").alias("y"))
    else:
        values = [[as_column(v).cast("string") for v in (s.x, s.y)] for s in specs]
        pairs = stack(df, list(enumerate(values)), ["x", "y"]).filter(
            kept_per_metric("x", [s.x_exclude for s in specs])
            & kept_per_metric("y", [s.y_exclude for s in specs])
        )
    keys = [*group_keys(len(specs)), "x", "y"]
    return pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def crosstab_family(df: DataFrame, metrics: Mapping[str, CrossTab], *, dense: bool = True) -> DataFrame:
    """Cross several pairs of single-choice columns in one pass over the rows.

    Returns ``(name, x_pos, x, y_pos, y, count, value, cell_kind)``. An order list
    moves listed labels to the front and never filters; remaining labels follow
    by count descending, then label. Without ``dense`` only pairs that occur have a
    cell, for questions with many labels.
    """
    names, specs = named(dict(metrics), "crosstab")
    return crosstab_cells(_pair_counts(df, specs), names, specs, dense=dense)


def crosstab_cells(
    pairs: DataFrame, names: Sequence[str], specs: Sequence[CrossTab], *, dense: bool = True, few: bool = False
) -> DataFrame:
    """Cells of :func:`crosstab_family` from its counted pairs, which are written once.

    ``few`` as in :func:`with_position`; such pairs are read as they are.
    """
    keys = group_keys(len(specs))
    if not few:
        pairs = stored(pairs, "pairs")

    # Both label sets are numbered together: side 0 is x, side 1 is y.
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("x").alias("label")),
        F.struct(F.lit(1).alias("side"), F.col("y").alias("label")),
    )
    margins = (
        pairs.select(*keys, "n", F.inline(sides))
        .groupBy(*keys, "side", "label")
        .agg(F.sum("n").alias("label_n"))
    )
    order = F.when(
        F.col("side") == 0, pick_order([_once(s.x_order) for s in specs])
    ).otherwise(pick_order([_once(s.y_order) for s in specs]))
    ranked = margins.withColumn("__rank", ordinal_rank(F.col("label"), order)).withColumn(
        "__most", -F.col("label_n")
    )
    labels = with_position(
        ranked, ["__rank", "__most", "label"], by=[*keys, "side"], few=few
    )
    # Tested together with the position, the side is not pushed below the numbering,
    # which would number each side by a plan of its own.
    side = F.when(F.col("pos") > 0, F.col("side"))
    xs = labels.filter(side == 0).select(
        *keys, F.col("label").alias("x"), F.col("pos").alias("x_pos"), F.col("label_n").alias("x_n")
    )
    ys = labels.filter(side == 1).select(
        *keys, F.col("label").alias("y"), F.col("pos").alias("y_pos"), F.col("label_n").alias("y_n")
    )

    shape = F.struct(
        F.count_if(F.col("side") == 0).alias("x_labels"),
        F.count_if(F.col("side") == 1).alias("y_labels"),
        F.sum(F.when(F.col("side") == 0, F.col("label_n"))).alias("total"),
    )
    shape = per_metric(margins, shape, len(specs))
    sized = xs.withColumn("__shape", shape)
    if not dense:
        placed = _joined(_joined(pairs, sized, [*keys, "x"]), ys, [*keys, "y"])
        return _cells(placed, names, specs)
    filled = _filled(sized, ys.withColumn("__shape", shape), keys)
    counted = pairs.select(
        *[F.col(k).alias(f"__p{k}") for k in keys],
        F.col("x").alias("__px"),
        F.col("y").alias("__py"),
        "n",
    )
    same_cell = F.col("x").eqNullSafe(F.col("__px")) & F.col("y").eqNullSafe(F.col("__py"))
    for k in keys:
        same_cell = same_cell & (F.col(k) == F.col(f"__p{k}"))
    cells = filled.join(counted, same_cell, "left")
    return _cells(cells, names, specs)


def _filled(xs: DataFrame, ys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every x label beside every y label, from labels that know the ``__shape`` of their crosstab.

    Each x row is repeated once per y label and matched by position. Few y positions would send
    all x rows to as few tasks, so the y labels are repeated until they are about as many as
    the x labels, and each x row meets one of the repeats: no key holds more x rows than there
    are y labels.
    """
    shape = F.col("__shape")
    repeats = F.ceil(shape["x_labels"] / shape["y_labels"])
    y_run = F.sequence(F.lit(1).cast("bigint"), shape["y_labels"])
    left = xs.withColumn("__repeat", F.pmod(F.col("x_pos"), repeats)).withColumn("y_pos", F.explode(y_run))
    repeated = F.explode(F.sequence(F.lit(0).cast("bigint"), repeats - 1))
    right = ys.withColumn("__repeat", repeated).drop("__shape")
    return left.join(right, [*keys, "y_pos", "__repeat"])


def _joined(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join by keys of which null is one more value."""
    other = right.select(*[F.col(c).alias(f"__r{c}" if c in keys else c) for c in right.columns])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__r{key}"))
    return left.join(other, same).drop(*[f"__r{key}" for key in keys])


def _cells(cells: DataFrame, names: Sequence[str], specs: Sequence[CrossTab]) -> DataFrame:
    n = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    base = {"global": F.col("__shape.total"), "x": F.col("x_n"), "y": F.col("y_n")}
    return cells.select(
        name_column(names).alias("name"),
        "x_pos",
        "x",
        "y_pos",
        "y",
        n.alias("count"),
        pick([percent_of(n, base[s.normalize]) for s in specs]).alias("value"),
        F.lit(RATE).alias("cell_kind"),
    )


def _once(order: Sequence[str] | None) -> list[str] | None:
    """A crosstab order may repeat a label; only its first mention counts."""
    return None if order is None else list(dict.fromkeys(order))


def crosstab(
    df: DataFrame,
    x: str | Column,
    y: str | Column,
    *,
    normalize: str = "global",
    x_order: Sequence[str] | None = None,
    y_order: Sequence[str] | None = None,
    x_exclude: Sequence[str] | None = None,
    y_exclude: Sequence[str] | None = None,
    dense: bool = True,
) -> DataFrame:
    """Cells ``(x_pos, x, y_pos, y, count, value, cell_kind)``, one for every x and y label.

    ``value`` is a percentage of all kept rows, of the x row or of the y column.
    Without ``dense`` pairs that do not occur are left out.
    """
    spec = CrossTab(x, y, normalize, x_order, y_order, x_exclude, y_exclude)
    return crosstab_family(df, {"": spec}, dense=dense).drop("name")


def crosstab_multi(
    df: DataFrame,
    choices: Mapping[str, str | Column],
    single: str | Column,
    *,
    denominator: str,
    x_order: Sequence[str] | None = None,
    x_exclude: Sequence[str] | None = None,
) -> DataFrame:
    """Cross the traits of a multi-select question (y) with a single choice (x).

    ``rate`` is the share of an x value's rows that have the trait, ``composition``
    the share of a trait's rows that have the x value, and ``lift`` the pair's
    frequency over what independence would give (1.0 where either side is empty).
    """
    if denominator not in CELL_KINDS:
        raise ValueError(f"denominator must be one of {tuple(CELL_KINDS)}, not {denominator!r}")
    cells = trait_counts(df, choices, single, x_order=x_order, x_exclude=x_exclude)
    return trait_values(cells, denominator)


def trait_values(cells: DataFrame, denominator: str) -> DataFrame:
    """Cells of :func:`crosstab_multi` from :func:`trait_counts`."""
    both, in_x, in_trait = F.col("count"), F.col("__x_n"), F.col("__y_n")
    if denominator == "rate":
        value = percent_of(both, in_x)
    elif denominator == "composition":
        value = percent_of(both, in_trait)
    else:
        observed = both.cast("double") * F.col("__total").cast("double")
        expected = in_trait.cast("double") * in_x.cast("double")
        value = F.when((in_trait > 0) & (in_x > 0), observed / expected).otherwise(F.lit(1.0))
    return cells.select(
        "x_pos",
        "x",
        "y_pos",
        "y",
        "count",
        value.alias("value"),
        F.lit(CELL_KINDS[denominator]).alias("cell_kind"),
    )


def trait_counts(
    df: DataFrame,
    choices: Mapping[str, str | Column],
    single: str | Column,
    *,
    x_order: Sequence[str] | None = None,
    x_exclude: Sequence[str] | None = None,
) -> DataFrame:
    """Counts behind :func:`crosstab_multi`: one scan, one conditional count per trait."""
    value = as_column(single)
    slots = trait_slots(len(choices))
    kept = keep_values(df, value, x_exclude)
    flags = [flag.alias(slot) for slot, flag in zip(slots, yes_flags(df, list(choices.values())))]
    per_x = (
        kept.select(value.cast("string").alias("x"), *flags)
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("__x_n"), *[F.count_if(F.col(s)).alias(s) for s in slots])
    )
    return trait_cells(per_x, list(choices), x_order)


def trait_slots(count: int) -> list[str]:
    return [f"__t{i}" for i in range(count)]


def trait_cells(
    per_x: DataFrame, traits: Sequence[str], x_order: Sequence[str] | None, *, few: bool = False
) -> DataFrame:
    """Placed cells from a row per x value: ``x``, its base ``__x_n`` and a count for each trait.

    ``few`` as in :func:`with_position`.
    """
    slots = trait_slots(len(traits))
    # One row: the base and each trait's total.
    sums = F.struct(F.sum("__x_n").alias("total"), F.array(*[F.sum(s) for s in slots]).alias("traits"))
    base = per_x.agg(sums.alias("base")).scalar()
    order = pick_order([_once(x_order)])
    ranked = per_x.withColumn("__rank", ordinal_rank(F.col("x"), order)).withColumn(
        "__most", -F.col("__x_n")
    )
    placed = with_position(ranked.withColumn("__base", base), ["__rank", "__most", "x"], pos="x_pos", few=few)
    rows = [
        F.struct(
            F.lit(i + 1).alias("y_pos"), F.lit(trait).alias("y"), F.col(slot).alias("count")
        )
        for i, (trait, slot) in enumerate(zip(traits, slots))
    ]
    cells = placed.select(
        "x_pos", "x", "__x_n", "__base", F.inline(F.array(*rows))
    )
    return cells.select(
        "x_pos",
        "x",
        "y_pos",
        "y",
        "count",
        "__x_n",
        F.element_at("__base.traits", F.col("y_pos")).alias("__y_n"),
        F.col("__base.total").alias("__total"),
    )
