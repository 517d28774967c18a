"""Staged funnels and two-question flows as link and node frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import keep_values, map_values, percent_of, round_tenths
from tally.operators.counts import MIN_COUNT
from tally.operators.position import with_position
from tally.operators.specs import as_column


@dataclass(frozen=True)
class Stages:
    """A tree of stages: each answer value names the path from the root to its leaf.

    Nodes are shown in the order of ``nodes``; links in the order of their
    endpoints there. Values without a path are outside the funnel's base.
    """

    nodes: tuple[str, ...]
    paths: Mapping[str, tuple[str, ...]]

    def links(self) -> list[tuple[str, str, list[str]]]:
        """(source, target, values passing through), each link once."""
        through: dict[tuple[str, str], list[str]] = {}
        for value, path in self.paths.items():
            for link in zip(path, path[1:]):
                through.setdefault(link, []).append(value)
        place = {node: i for i, node in enumerate(self.nodes)}
        unknown = {end for link in through for end in link if end not in place}
        if unknown:
            raise ValueError(f"stage paths name nodes that are not declared: {sorted(unknown)}")
        ordered = sorted(through, key=lambda link: (place[link[0]], place[link[1]]))
        return [(source, target, through[source, target]) for source, target in ordered]


# Upgrade answers and the stages they pass through.
UPGRADE_STAGES = Stages(
    nodes=(
        "All",
        "Knew",
        "Didn't know",
        "Upgraded",
        "Did not upgrade",
        "No issues",
        "Minor",
        "Moderate",
        "Severe (resolved)",
        "Severe (stuck)",
    ),
    paths={
        "I did not know there was a new stable release.": ("All", "Didn't know"),
        "I have not upgraded.": ("All", "Knew", "Did not upgrade"),
        "I had no issues.": ("All", "Knew", "Upgraded", "No issues"),
        "I had minor issues.": ("All", "Knew", "Upgraded", "Minor"),
        "I had moderate issues.": ("All", "Knew", "Upgraded", "Moderate"),
        "I had severe issues but figured it out after some time.": (
            "All",
            "Knew",
            "Upgraded",
            "Severe (resolved)",
        ),
        "I had severe issues and could not make the upgrade.": (
            "All",
            "Knew",
            "Upgraded",
            "Severe (stuck)",
        ),
    },
)


def staged_funnel(
    df: DataFrame,
    column: str | Column,
    stages: Stages = UPGRADE_STAGES,
    *,
    min_count: int = MIN_COUNT,
    as_percent: bool = False,
) -> DataFrame:
    """Links ``(link_pos, source, target, count, value)`` of a stage tree.

    Each link is one conditional count of a single one-row aggregate. Links below
    ``min_count`` are dropped; inner links keep their full counts. With
    ``as_percent`` the value is the share of rows that have a path, to one decimal.
    """
    value = as_column(column)
    answers = df.filter(value.isin(list(stages.paths))).select(value.alias("value"))
    return funnel_links(answers, stages, min_count=min_count, as_percent=as_percent)


def funnel_links(
    answers: DataFrame, stages: Stages, *, min_count: int, as_percent: bool, weight: Column | None = None
) -> DataFrame:
    """Links of :func:`staged_funnel` from ``(value)`` rows that have a path.

    ``weight`` tells how many answers a row stands for.
    """
    value = F.col("value")
    links = stages.links()

    def number(condition: Column) -> Column:
        if weight is None:
            return F.count_if(condition)
        return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0).cast("bigint"))

    counters = [number(value.isin(values)).alias(f"__l{i}") for i, (_, _, values) in enumerate(links)]
    row = answers.agg(number(value.isin(list(stages.paths))).alias("__base"), *counters)
    rows = [
        F.struct(
            F.lit(source).alias("source"),
            F.lit(target).alias("target"),
            F.col(f"__l{i}").alias("count"),
        )
        for i, (source, target, _) in enumerate(links)
    ]
    kept = F.filter(F.array(*rows), lambda link: link["count"] >= min_count)
    share = as_percent and round_tenths(percent_of(F.col("col.count"), F.col("__base")))
    number = share if as_percent else F.col("col.count")
    return row.select("__base", F.posexplode(kept)).select(
        (F.col("pos") + 1).alias("link_pos"),
        F.col("col.source").alias("source"),
        F.col("col.target").alias("target"),
        F.col("col.count").alias("count"),
        number.cast("double").alias("value"),
    )


def funnel_nodes(links: DataFrame, stages: Stages = UPGRADE_STAGES) -> DataFrame:
    """``(node_pos, node)``: declared nodes touched by a surviving link, in order."""
    ends = links.select(F.explode(F.array("source", "target")).alias("node"))
    # The set holds declared nodes only, so it is as small as the stage list.
    used = ends.agg(F.collect_set("node").alias("used"))
    declared = F.array(*[F.lit(node) for node in stages.nodes])
    return used.select(
        F.posexplode(F.filter(declared, lambda node: F.array_contains("used", node)))
    ).select((F.col("pos") + 1).alias("node_pos"), F.col("col").alias("node"))


@dataclass(frozen=True)
class Flow:
    """How two single-choice columns flow into each other."""

    x: str | Column
    y: str | Column
    id: str | Column
    x_map: Mapping[str, str] | None = None
    y_map: Mapping[str, str] | None = None
    exclude: Sequence[str] | None = None
    min_count: int = MIN_COUNT
    as_percent: bool = False


def flow_label(column: Column, mapping: Mapping[str, str] | None) -> Column:
    return F.coalesce(map_values(column.cast("string"), mapping), F.lit(""))


def _flow_pairs(df: DataFrame, flow: Flow) -> DataFrame:
    """(x, y, n, first): mapped pairs with their first-seen respondent id.

    The labels are never null here; saying so keeps later joins from filtering
    below the aggregation, which would give each branch a shuffle of its own.
    """

    x, y = as_column(flow.x), as_column(flow.y)
    kept = df.filter(x.isNotNull() & y.isNotNull())
    kept = keep_values(keep_values(kept, x, flow.exclude), y, flow.exclude)
    return (
        kept.select(
            flow_label(x, flow.x_map).alias("x"),
            flow_label(y, flow.y_map).alias("y"),
            as_column(flow.id).alias("id"),
        )
        .groupBy("x", "y")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    )


def _margins(pairs: DataFrame) -> DataFrame:
    """(side, label, n, first) of both sides in one shuffle; side 0 is x, side 1 is y."""
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.col("x").alias("label")),
        F.struct(F.lit(1).alias("side"), F.col("y").alias("label")),
    )
    return (
        pairs.select("n", "first", F.inline(sides))
        .groupBy("side", "label")
        .agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    )


def name_collisions(df: DataFrame, flow: Flow) -> DataFrame:
    """``(name)``: labels that occur on both sides after mapping."""
    margins = _margins(_flow_pairs(df, flow))
    x_names = margins.filter(F.col("side") == 0).select(F.col("label").alias("name"))
    return x_names.intersect(margins.filter(F.col("side") == 1).select("label"))


def _surviving(pairs: DataFrame, flow: Flow) -> DataFrame:
    """Pairs at or above the floor with both labels' first appearance and the base.

    A label used on both sides fails the query: it would close a cycle. The check
    runs on every pair, before the floor is applied. All branches read the same
    columns of the pairs and margins, so each is shuffled once.
    """
    # Shuffled once more, by their unique key, pairs are read by all branches as they are.
    pairs = pairs.repartition("x", "y")
    margins = _margins(pairs)
    per_label = margins.groupBy("label").agg(
        F.count(F.lit(1)).alias("sides"),
        F.sum(F.when(F.col("side") == 0, F.col("n"))).alias("n"),
        F.min("first").alias("first"),
    )
    clash = F.col("sides") > 1
    facts = per_label.agg(
        F.count_if(clash).alias("clashes"),
        F.min(F.when(clash, F.col("label"))).alias("example"),
        F.sum("n").alias("total"),
        F.min("first").alias("first"),
    )
    checked = pairs.withColumn("__facts", facts.select(F.struct("*")).scalar())
    message = F.concat(
        F.lit("x-node names collide with y-node names: "),
        F.col("__facts.clashes").cast("string"),
        F.lit(" in all, such as "),
        F.coalesce(F.col("__facts.example"), F.lit("")),
        F.lit("; rename them with x_map or y_map"),
    )
    # The check sits in the count, so the floor cannot be tested without it and it
    # stays above the aggregation.
    failed = F.raise_error(message).cast("bigint")
    kept = (
        checked.withColumn("n", F.when(F.col("__facts.clashes") > 0, failed).otherwise(F.col("n")))
        .filter(F.col("n") >= flow.min_count)
        .select("x", "y", "n", "first", F.col("__facts.total").alias("total"))
    )
    x_first = margins.filter(F.col("side") == 0).select(
        F.col("label").alias("x"), F.col("first").alias("x_first"), F.col("n").alias("x_n")
    )
    y_first = margins.filter(F.col("side") == 1).select(
        F.col("label").alias("y"), F.col("first").alias("y_first"), F.col("n").alias("y_n")
    )
    return kept.join(x_first, "x").join(y_first, "y")


def flow_links(
    df: DataFrame,
    x: str | Column,
    y: str | Column,
    *,
    id: str | Column,
    x_map: Mapping[str, str] | None = None,
    y_map: Mapping[str, str] | None = None,
    exclude: Sequence[str] | None = None,
    min_count: int = MIN_COUNT,
    as_percent: bool = False,
) -> DataFrame:
    """Links ``(link_pos, source, target, count, value)`` between two questions.

    A row is left out when either raw value is null or excluded. Labels are then
    grouped by the maps. Links below ``min_count`` are dropped before percentages
    (share of included rows, to one decimal). Order is by first appearance, which
    ``id`` defines: the row with the smallest id comes first, so it must sort as the
    answers arrived, numbers as numbers.
    """
    flow = Flow(x, y, id, x_map, y_map, exclude, min_count, as_percent)
    return links_of_pairs(_flow_pairs(df, flow), flow)


def links_of_pairs(pairs: DataFrame, flow: Flow, *, few: bool = False) -> DataFrame:
    """Links of :func:`flow_links` from counted pairs ``(x, y, n, first)``; ``few`` as in :func:`with_position`."""
    kept = _surviving(pairs, flow)
    placed = with_position(kept, ["x_first", "x", "y_first", "y"], pos="link_pos", few=few)
    share = round_tenths(percent_of(F.col("n"), F.col("total")))
    number = share if flow.as_percent else F.col("n")
    return placed.select(
        "link_pos",
        F.col("x").alias("source"),
        F.col("y").alias("target"),
        F.col("n").alias("count"),
        number.cast("double").alias("value"),
    )


def flow_nodes(
    df: DataFrame,
    x: str | Column,
    y: str | Column,
    *,
    id: str | Column,
    x_map: Mapping[str, str] | None = None,
    y_map: Mapping[str, str] | None = None,
    exclude: Sequence[str] | None = None,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``(node_pos, node, side)``: x labels, then y labels, by first appearance."""
    flow = Flow(x, y, id, x_map, y_map, exclude, min_count)
    return nodes_of_pairs(_flow_pairs(df, flow), flow)


def nodes_of_pairs(pairs: DataFrame, flow: Flow, *, few: bool = False) -> DataFrame:
    """Nodes of :func:`flow_nodes` from counted pairs ``(x, y, n, first)``; ``few`` as in :func:`with_position`."""
    ends = F.array(
        *[
            F.struct(
                F.lit(i).alias("side_no"),
                F.col(side).alias("node"),
                F.col(f"{side}_first").alias("seen"),
                F.col(f"{side}_n").alias("label_n"),
            )
            for i, side in enumerate("xy")
        ]
    )
    # Only the first appearance is wanted; the maxima keep the shared columns in use.
    pinned = [F.max(c).alias(c) for c in ("label_n", "n", "first", "total")]
    nodes = (
        _surviving(pairs, flow)
        .select("n", "first", "total", F.inline(ends))
        .groupBy("side_no", "node")
        .agg(F.min("seen").alias("seen"), *pinned)
    )
    placed = with_position(nodes, ["side_no", "seen", "node"], pos="node_pos", few=few)
    return placed.select(
        "node_pos",
        "node",
        F.when(F.col("side_no") == 0, F.lit("x")).otherwise(F.lit("y")).alias("side"),
    )
