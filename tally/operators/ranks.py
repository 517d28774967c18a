"""Distribution of rank positions with band-based points."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import percent_of
from tally.operators.counts import MIN_COUNT
from tally.operators.position import with_position
from tally.operators.specs import (
    as_column,
    group_keys,
    name_column,
    named,
    per_metric,
    pick,
    stack,
)

# Fixed value: label of the share that was not placed in any shown band.
UNRANKED = "Unranked"

Band = tuple[int, int]


@dataclass(frozen=True)
class RankCount:
    """How to distribute one ranking question; ``ranks`` runs from best to worst."""

    ranks: Sequence[str | Column]
    bands: Sequence[Band] | None = None
    min_count: int = MIN_COUNT


def band_labels(bands: Sequence[Band] | None, positions: int) -> list[str]:
    if bands is None:
        return [f"#{p}" for p in range(1, positions + 1)]
    return [f"{low}-{high}" if low != high else f"{low}" for low, high in bands]


def band_index(position: Column, bands: Sequence[Band] | None, positions: int) -> Column:
    """Zero-based first band holding the position, null past the last band."""
    shown = [(p, p) for p in range(1, positions + 1)] if bands is None else bands
    index = F.lit(None).cast("int")
    for i, (low, high) in reversed(list(enumerate(shown))):
        index = F.when(position.between(low, high), F.lit(i)).otherwise(index)
    return index


def _band_counts(placed: DataFrame, specs, sizes, weight: Column | None = None) -> DataFrame:
    """(metric, choice, base, ranked, one count per band) from single placements.

    ``weight`` tells how many placements a row stands for.

    A row with ``asked`` stands for a respondent rather than a placement. ``base``
    counts those, so later filters test an aggregate and cannot slip below the
    shuffle. A placement outside all bands, at whatever position, is ranked only.
    """
    keys = group_keys(len(specs))
    labels = [band_labels(m.bands, n) for m, n in zip(specs, sizes)]
    width = max(len(segments) for segments in labels)
    banded = placed.withColumn(
        "__band", pick([band_index(F.col("position"), m.bands, n) for m, n in zip(specs, sizes)])
    )

    def number(condition: Column) -> Column:
        if weight is None:
            return F.count_if(condition)
        return F.sum(F.when(condition, weight).otherwise(F.lit(0).cast("bigint")))

    per_band = [number(F.col("__band") == i).alias(f"__b{i}") for i in range(width)]
    return banded.groupBy(*keys, "choice").agg(
        number(F.col("asked")).alias("base"),
        number(~F.col("asked")).alias("ranked"),
        *per_band,
    )


def _segments(
    counted: DataFrame, total: Column, names, specs, sizes, few: bool = False
) -> DataFrame:
    """Score, place and unfold the counted choices into one row per segment."""
    keys = group_keys(len(specs))
    labels = [band_labels(m.bands, n) for m, n in zip(specs, sizes)]
    width = max(len(segments) for segments in labels)
    bands = F.array(*[F.col(f"__b{i}") for i in range(width)])
    shown = F.slice(bands, F.lit(1), pick([F.lit(len(segments)) for segments in labels]))
    floor = pick([F.lit(m.min_count) for m in specs])
    items = counted.filter((F.col("base") == 0) & (F.col("ranked") >= floor)).select(
        *keys, "choice", shown.alias("bands")
    )
    points = F.aggregate(
        F.transform("bands", lambda n, i: n * (F.size("bands") - i)),
        F.lit(0).cast("bigint"),
        lambda acc, p: acc + p,
    )
    scored = items.withColumn("score", points).withColumn("__most", -F.col("score")).withColumn("total", total)
    placed = with_position(scored, ["__most", "choice"], by=keys, pos="item_pos", few=few)
    shares = F.transform("bands", lambda n: percent_of(n, F.col("total")))
    rest = F.lit(100.0) - F.aggregate("shares", F.lit(0.0), lambda acc, p: acc + p)
    rest = F.when((rest < 0) & (rest > -1e-9), F.lit(0.0)).otherwise(rest)
    placements = F.aggregate("bands", F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    texts = pick([F.array(*[F.lit(s) for s in [*segments, UNRANKED]]) for segments in labels])
    filled = (
        placed.withColumn("shares", shares)
        .select(
            name_column(names).alias("name"),
            "item_pos",
            F.col("choice").alias("label"),
            "score",
            F.posexplode(
                F.arrays_zip(
                    texts.alias("segment"),
                    F.concat("bands", F.array(F.col("total") - placements)).alias("count"),
                    F.concat("shares", F.array(rest)).alias("percent"),
                )
            ).alias("seg", "cell"),
        )
    )
    return filled.select(
        "name",
        "item_pos",
        "label",
        "score",
        (F.col("seg") + 1).alias("seg_pos"),
        F.col("cell.segment").alias("segment"),
        F.col("cell.count").alias("count"),
        F.col("cell.percent").alias("percent"),
    )


def rank_distribution_family(df: DataFrame, metrics: Mapping[str, RankCount]) -> DataFrame:
    """Distribute several ranking questions in one pass.

    Every respondent also emits one empty placement per question; those rows
    count the base in the same pass and collapse before the shuffle. Returns
    ``(name, item_pos, label, score, seg_pos, segment, count, percent)``.
    """
    names, specs = named(dict(metrics), "ranking metric")
    rows = []
    for q, metric in enumerate(specs):
        rows.append((q, [F.lit(True), F.lit(None).cast("int"), F.lit(None).cast("string")]))
        for p, choice in enumerate(metric.ranks, start=1):
            rows.append((q, [F.lit(False), F.lit(p), as_column(choice).cast("string")]))
    placed = (
        stack(df, rows, ["asked", "position", "choice"])
        .filter(F.col("asked") | (F.col("choice") != ""))
        .select(*group_keys(len(specs)), "asked", "position", "choice")
    )
    return rank_segments(placed, names, specs)


def rank_segments(
    placed: DataFrame, names: Sequence[str], specs: Sequence[RankCount], weight: Column | None = None,
    *, few: bool = False,
) -> DataFrame:
    """Segments of :func:`rank_distribution_family` from ``(asked, position, choice)`` rows.

    ``few`` as in :func:`with_position`.
    """
    sizes = [len(m.ranks) for m in specs]
    counted = _band_counts(placed, specs, sizes, weight)
    shared = [c for c in counted.columns if c == "ranked" or c.startswith("__b")]
    total = per_metric(counted, F.sum("base"), len(specs), pin=shared)
    return _segments(counted, total, names, specs, sizes, few)


def rank_distribution(
    df: DataFrame,
    ranks: Sequence[str | Column],
    *,
    bands: Sequence[Band] | None = None,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """Share of respondents placing each choice in each rank position or band.

    Returns ``(item_pos, label, score, seg_pos, segment, count, percent)``. The
    last segment of an item is what no shown band holds. Choices placed fewer
    than ``min_count`` times at any position are left out. Items go by points:
    with N bands a placement in the i-th is worth ``N - i + 1``.
    """
    metrics = {"": RankCount(ranks, bands, min_count)}
    return rank_distribution_family(df, metrics).drop("name")


def rank_distribution_long(
    placements: DataFrame,
    position: str | Column,
    choice: str | Column,
    total: Column,
    positions: int,
    *,
    bands: Sequence[Band] | None = None,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """:func:`rank_distribution` from a long table with one row per placement.

    ``total`` is the number of respondents, which the long table cannot tell.
    Placements at other positions than 1 to ``positions``, null among them, count
    towards the floor and are part of what is unranked.
    """
    label = as_column(choice).cast("string")
    placed = placements.filter(label != "").select(
        F.lit(False).alias("asked"), as_column(position).cast("int").alias("position"), label.alias("choice")
    )
    metric = RankCount([], bands, min_count)
    counted = _band_counts(placed, [metric], [positions])
    base = total.cast("bigint")
    return _segments(counted, base, [""], [metric], [positions]).drop("name")


def borda_scores(distribution: DataFrame) -> DataFrame:
    """``(item_pos, label, score)``, one row per item."""
    return distribution.filter(F.col("seg_pos") == 1).select("item_pos", "label", "score")
