"""Chart-ready frames shaped from metric frames.

Positions are zero-based here, as chart axes are. Percentages are rounded to one
decimal. All frames are projections or small joins of already aggregated metrics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import map_values, round_tenths
from tally.operators.crosstabs import LIFT
from tally.operators.sets import MIN_SIZE

# Separator of set codes in a combination's name, and axis headroom.
CODE_SEPARATOR = " · "
TOTALS_HEADROOM = 1.6


def bar_series(bins: DataFrame) -> DataFrame:
    """``(draw_pos, label, value)``: bins bottom-up, the first bin drawn last."""
    last = bins.agg(F.max("pos").alias("last")).scalar()
    return bins.select(
        (last - F.col("pos")).alias("draw_pos"),
        "label",
        round_tenths(F.col("percent")).alias("value"),
    )


def heatmap_cells(table: DataFrame) -> DataFrame:
    """``(x_idx, y_idx, value)`` of a crosstab."""
    return table.select(
        (F.col("x_pos") - 1).alias("x_idx"),
        (F.col("y_pos") - 1).alias("y_idx"),
        round_tenths(F.col("value")).alias("value"),
    )


def heatmap_range(
    table: DataFrame, *, low: float | None = None, high: float | None = None
) -> DataFrame:
    """One row ``(low, high)``: the colour scale of a crosstab.

    Lift runs from 0 to 2. Percentages run from the lowest to the highest value,
    widened to whole tens within 0..100. Given bounds win.
    """
    auto_low, auto_high = percent_scale(F.first("cell_kind"), F.min("value"), F.max("value"))
    return table.agg(
        (F.lit(float(low)) if low is not None else auto_low).alias("low"),
        (F.lit(float(high)) if high is not None else auto_high).alias("high"),
    )


def percent_scale(cell_kind: Column, least: Column, most: Column) -> tuple[Column, Column]:
    """Scale ends for cells of one kind: fixed for lift, whole tens around the data else."""
    is_lift, tens = F.coalesce(cell_kind == F.lit(LIFT), F.lit(False)), F.lit(10.0)
    low = F.greatest(F.lit(0.0), F.floor(least / tens).cast("double") * tens)
    high = F.least(F.lit(100.0), F.ceil(most / tens).cast("double") * tens)
    return (
        F.when(is_lift, F.lit(0.0)).when(least.isNull(), F.lit(0.0)).otherwise(low),
        F.when(is_lift, F.lit(2.0)).when(most.isNull(), F.lit(100.0)).otherwise(high),
    )


def likert_segments(
    bins: DataFrame,
    *,
    positive: Sequence[str],
    negative: Sequence[str],
    neutral: Sequence[str],
) -> DataFrame:
    """``(seg_pos, group, label, percent)``: positive, negative, then neutral labels.

    Listed labels without a bin show 0.0, and bins that are not listed are left
    out. The percentages come from one conditional aggregate over the bins.
    """
    groups = (("positive", positive), ("negative", negative), ("neutral", neutral))
    listed = [(group, label) for group, labels in groups for label in labels]
    if not listed:
        raise ValueError("likert_segments needs at least one label")
    shares = [
        F.max(F.when(F.col("label") == F.lit(label), round_tenths(F.col("percent")))).alias(f"__s{i}")
        for i, (_, label) in enumerate(listed)
    ]
    rows = [
        F.struct(
            F.lit(i).alias("seg_pos"),
            F.lit(group).alias("group"),
            F.lit(label).alias("label"),
            F.coalesce(F.col(f"__s{i}"), F.lit(0.0)).alias("percent"),
        )
        for i, (group, label) in enumerate(listed)
    ]
    return bins.agg(*shares).select(F.inline(F.array(*rows)))


def line_series(table: DataFrame) -> DataFrame:
    """``(series_pos, series, x_idx, x, value, unit)``: one line per y label."""
    unit = F.when(F.col("cell_kind") == F.lit(LIFT), F.lit("×")).otherwise(F.lit("%"))
    return table.select(
        (F.col("y_pos") - 1).alias("series_pos"),
        F.col("y").alias("series"),
        (F.col("x_pos") - 1).alias("x_idx"),
        "x",
        round_tenths(F.col("value")).alias("value"),
        unit.alias("unit"),
    )


def rank_stack(distribution: DataFrame) -> DataFrame:
    """``(seg_idx, segment, draw_pos, label, percent)``: items bottom-up per segment."""
    last = distribution.agg(F.max("item_pos").alias("last")).scalar()
    return distribution.select(
        (F.col("seg_pos") - 1).alias("seg_idx"),
        "segment",
        (last - F.col("item_pos")).alias("draw_pos"),
        "label",
        round_tenths(F.col("percent")).alias("percent"),
    )


def _set_rows(sets: Sequence[str]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(i).alias("row"), F.lit(label).alias("set"))
            for i, label in enumerate(sets)
        ]
    )


def upset_matrix(combos: DataFrame, sets: Sequence[str]) -> DataFrame:
    """``(col, row, set, filled)``: every shown combination against every set."""
    cells = combos.select(
        (F.col("pos") - 1).alias("col"), "members", F.inline(_set_rows(sets))
    )
    return cells.select("col", "row", "set", F.array_contains("members", F.col("set")).alias("filled"))


def upset_connectors(combos: DataFrame, sets: Sequence[str]) -> DataFrame:
    """``(col, min_row, max_row)`` of combinations with at least two members."""
    rows = F.transform(
        F.filter(_set_rows(sets), lambda s: F.array_contains("members", s["set"])),
        lambda s: s["row"],
    )
    spans = combos.select((F.col("pos") - 1).alias("col"), rows.alias("rows"))
    return spans.filter(F.size("rows") >= 2).select(
        "col", F.array_min("rows").alias("min_row"), F.array_max("rows").alias("max_row")
    )


def upset_combo_names(combos: DataFrame, codes: Mapping[str, str] | None = None) -> DataFrame:
    """``(col, name, size)``: member codes joined, with the size."""
    short = F.transform("members", lambda m: map_values(m, codes))
    name = F.concat(F.array_join(short, CODE_SEPARATOR), F.lit(": "), F.col("size").cast("string"))
    return combos.select((F.col("pos") - 1).alias("col"), name.alias("name"), "size")


def upset_set_names(totals: DataFrame, codes: Mapping[str, str] | None = None) -> DataFrame:
    """``(row, code, name, total)`` per set; a set without a code shows its name."""
    code = map_values(F.col("label"), codes)
    return totals.select(
        (F.col("pos") - 1).alias("row"),
        code.alias("code"),
        F.concat(code, F.lit(": "), F.col("count").cast("string")).alias("name"),
        F.col("count").alias("total"),
    )


def upset_key(codes: Mapping[str, str] | None) -> str | None:
    """Markdown table of the short codes and what they stand for, or none without codes."""
    if codes is None:
        return None
    rows = [f"| {code} | {full} |" for full, code in codes.items()]
    return "\n".join(["| Code | Statement |", "| --- | --- |", *rows])


def upset_totals_axis(totals: DataFrame) -> DataFrame:
    """One row ``(axis_max)``: room for labels beside the longest total."""
    longest = F.coalesce(F.max("count"), F.lit(1).cast("bigint")).cast("double")
    headroom = F.floor(longest * F.lit(TOTALS_HEADROOM)) + F.lit(1)
    return totals.agg(headroom.cast("bigint").alias("axis_max"))


def dropped_note(dropped: Column, *, min_size: int = MIN_SIZE) -> Column:
    """Sentence about unlisted combinations, null when there are none."""
    reason = f" left out: fewer than {min_size} answers each, or past the last column of the chart."
    noun = F.when(dropped == 1, F.lit(" combination is")).otherwise(F.lit(" combinations are"))
    return F.when(dropped > 0, F.concat(dropped.cast("string"), noun, F.lit(reason)))


def sankey_frame(links: DataFrame) -> DataFrame:
    """``(link_pos, source, target, value)``: links as drawn."""
    return links.select("link_pos", "source", "target", "value")
