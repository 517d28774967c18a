"""Declarative reports: rows of charts, all counted in one pass.

Every metric of a report is a count over (metric, key, key) with the first id seen.
``report_counts`` stacks all of them and aggregates once, whatever the number of charts,
and counts once what several metrics count by the same keys; everything after reads that
small table. Counts of several inputs add up, so a growing survey keeps the counts of its
parts. The result is one nested JSON document. A chart's data is what the page displays, so
the document is meant for metrics with a displayable number of labels; metric frames of any
size are written with :func:`write_frames`.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions import round_tenths
from tally.operators.charts import (
    dropped_note,
    percent_scale,
    upset_combo_names,
    upset_connectors,
    upset_key,
    upset_matrix,
    upset_set_names,
    upset_totals_axis,
)
from tally.operators.counts import MultiCount, SingleCount, multi_bins, multi_slots, single_bins
from tally.operators.crosstabs import (
    LIFT,
    CrossTab,
    crosstab_cells,
    trait_cells,
    trait_slots,
    trait_values,
)
from tally.operators.flows import (
    UPGRADE_STAGES,
    Flow,
    Stages,
    flow_label,
    funnel_links,
    links_of_pairs,
    nodes_of_pairs,
)
from tally.operators.ranks import RankCount, rank_segments
from tally.operators.sets import (
    MAX_COMBOS,
    MIN_SIZE,
    dropped_of_sizes,
    largest_sizes,
    totals_of_sizes,
)
from tally.operators.specs import METRIC, as_column, yes_flags
from tally.sources.reports import DEFAULT_SERIES, SCHEMA_VERSION
from tally.storage import stored



@dataclass(frozen=True)
class TraitTab:
    """How to cross a multi-select question with a single-choice column."""

    choices: Mapping[str, str | Column]
    single: str | Column
    denominator: str
    x_order: Sequence[str] | None = None
    x_exclude: Sequence[str] | None = None


@dataclass(frozen=True)
class Funnel:
    column: str | Column
    stages: Stages = UPGRADE_STAGES
    min_count: int = MIN_SIZE
    as_percent: bool = False


@dataclass(frozen=True)
class Combinations:
    choices: Mapping[str, str | Column]
    min_size: int = MIN_SIZE
    max_combos: int = MAX_COMBOS
    codes: Mapping[str, str] | None = None


@dataclass(frozen=True)
class Likert:
    bins: SingleCount
    positive: Sequence[str]
    negative: Sequence[str]
    neutral: Sequence[str]


@dataclass(frozen=True)
class Chart:
    """One chart: its kind, the metric behind it and display options."""

    kind: str
    metric: object
    title: str | None = None
    height: int | None = None
    caption: str | None = None
    low: float | None = None
    high: float | None = None

    def __post_init__(self) -> None:
        allowed = CHART_METRICS.get(self.kind)
        if allowed is None:
            raise ValueError(f"unknown chart kind {self.kind!r}; known: {sorted(CHART_METRICS)}")
        if not isinstance(self.metric, allowed):
            raise TypeError(f"a {self.kind} chart cannot show {type(self.metric).__name__}")


CHART_METRICS = {
    "bar": (SingleCount, MultiCount),
    "lollipop": (SingleCount, MultiCount),
    "heatmap": (CrossTab, TraitTab),
    "line": (CrossTab, TraitTab),
    "rank": (RankCount,),
    "likert": (Likert,),
    "sankey": (Funnel, Flow),
    "upset": (Combinations,),
}


@dataclass(frozen=True)
class ReportRow:
    id: str
    title: str
    question: str
    charts: Sequence[Chart]
    wide: bool = False
    commentary: str | None = None


@dataclass(frozen=True)
class ReportSection:
    id: str
    heading: str
    rows: Sequence[ReportRow]
    note: str | None = None


@dataclass(frozen=True)
class Report:
    year: int
    title: str
    sections: Sequence[ReportSection] = field(default_factory=list)
    series: str = DEFAULT_SERIES
    intro_meta: str | None = None
    intro_paragraphs: Sequence[str] | None = None

    def charts(self) -> dict[str, Chart]:
        """Charts by key ``<row id>/<index>``; row ids must be unique."""
        keyed: dict[str, Chart] = {}
        for section in self.sections:
            for row in section.rows:
                for i, chart in enumerate(row.charts):
                    if keyed.setdefault(f"{row.id}/{i}", chart) is not chart:
                        raise ValueError(f"report row id {row.id!r} is used more than once")
        return keyed


# --- chart data ------------------------------------------------------------


def _ordered(keys: Sequence[str], *values: str) -> Column:
    """Rows of a group as an array of structs in key order."""
    return F.array_sort(F.collect_list(F.struct(*keys, *values)))


def _field(array: Column, name: str) -> Column:
    return F.transform(array, lambda e: e[name])


def _axis(labels: Column) -> Column:
    return F.struct(F.lit("category").alias("type"), labels.alias("data"))


def _option(**parts: Column) -> Column:
    """The named parts as JSON text."""
    return F.to_json(F.struct(*[part.alias(name) for name, part in parts.items()]))


def _options(frame: DataFrame, **parts: Column) -> DataFrame:
    """(key, option) of a frame whose rows are charts."""
    return frame.select("key", _option(**parts).alias("option"))


def _by_key(choices: Mapping[str, Column], otherwise: Column) -> Column:
    """The expression of the row's chart. A filter per chart would be pushed below
    the shared aggregation and give each chart a scan of its own."""
    result = otherwise
    for key, value in choices.items():
        result = F.when(F.col("key") == key, value).otherwise(result)
    return result


def _bar_options(bins: DataFrame, charts: Mapping[str, Chart]) -> DataFrame:
    """Bars bottom-up. A lollipop draws the same values as stems and dots; a
    likert chart stacks its listed labels, 0.0 where a label has no bin."""
    grouped = bins.groupBy(F.col("name").alias("key")).agg(
        _ordered(["pos"], "label", "percent").alias("bins")
    )
    upward = F.reverse("bins")
    values = F.transform(upward, lambda b: round_tenths(b["percent"]))
    stem = F.struct(F.lit("bar").alias("type"), values.alias("data"))
    dots = F.struct(F.lit("pictorialBar").alias("type"), values.alias("data"))
    axis = _axis(_field(upward, "label"))
    lollipop = _option(yAxis=axis, series=F.array(stem, dots))
    special = {key: lollipop for key, chart in charts.items() if chart.kind == "lollipop"}
    special |= {
        key: _option(series=_likert_series(chart.metric))
        for key, chart in charts.items()
        if chart.kind == "likert"
    }
    option = _by_key(special, _option(yAxis=axis, series=F.array(stem)))
    return grouped.select("key", option.alias("option"))


def _likert_series(metric: Likert) -> Column:
    groups = {"positive": metric.positive, "negative": metric.negative, "neutral": metric.neutral}

    def segment(group: str, label: str) -> Column:
        hit = F.filter("bins", lambda b: b["label"] == F.lit(label))
        share = F.coalesce(round_tenths(F.get(hit, F.lit(0))["percent"]), F.lit(0.0))
        return F.struct(
            F.lit(label).alias("name"),
            F.lit("bar").alias("type"),
            F.lit("likert").alias("stack"),
            F.lit(group).alias("group"),
            F.array(share).alias("data"),
        )

    return F.array(*[segment(group, label) for group, labels in groups.items() for label in labels])


def _table_options(table: DataFrame, charts: Mapping[str, Chart]) -> DataFrame:
    """Heatmap and line options from crosstab frames ``(name, x_pos, ..)``."""
    grouped = table.groupBy(F.col("name").alias("key")).agg(
        _ordered(["x_pos", "y_pos"], "x", "y", "value").alias("cells"),
        F.first("cell_kind").alias("cell_kind"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    )
    xs = _field(F.filter("cells", lambda c: c["y_pos"] == 1), "x")
    ys = _field(F.filter("cells", lambda c: c["x_pos"] == 1), "y")
    points = F.transform(
        "cells",
        lambda c: F.array(
            (c["x_pos"] - 1).cast("double"), (c["y_pos"] - 1).cast("double"), round_tenths(c["value"])
        ),
    )
    heat = F.array(F.struct(F.lit("heatmap").alias("type"), points.alias("data")))
    lines = F.transform(
        ys,
        lambda y, i: F.struct(
            y.alias("name"),
            F.lit("line").alias("type"),
            F.transform(
                F.filter("cells", lambda c: c["y_pos"] == i + 1), lambda c: round_tenths(c["value"])
            ).alias("data"),
        ),
    )
    unit = F.when(F.col("cell_kind") == LIFT, F.lit("×")).otherwise(F.lit("%"))
    line = _option(xAxis=_axis(xs), unit=unit, series=lines)
    heatmaps = {
        key: _option(
            xAxis=_axis(xs), yAxis=_axis(ys), visualMap=F.struct(*_scale(chart)), series=heat
        )
        for key, chart in charts.items()
        if chart.kind == "heatmap"
    }
    return grouped.select("key", _by_key(heatmaps, line).alias("option"))


def _scale(chart: Chart) -> list[Column]:
    """Colour scale columns over (cell_kind, least, most)."""
    auto_low, auto_high = percent_scale(F.col("cell_kind"), F.col("least"), F.col("most"))
    low = auto_low if chart.low is None else F.lit(float(chart.low))
    high = auto_high if chart.high is None else F.lit(float(chart.high))
    return [low.alias("min"), high.alias("max")]


def _rank_options(distribution: DataFrame) -> DataFrame:
    grouped = distribution.groupBy(F.col("name").alias("key"), "seg_pos", "segment").agg(
        F.reverse(_ordered(["item_pos"], "label", "percent")).alias("items")
    )
    segments = grouped.groupBy("key").agg(
        _ordered(["seg_pos"], "segment", "items").alias("segments")
    )
    series = F.transform(
        "segments",
        lambda s: F.struct(
            s["segment"].alias("name"),
            F.lit("bar").alias("type"),
            F.lit("total").alias("stack"),
            F.transform(s["items"], lambda e: round_tenths(e["percent"])).alias("data"),
        ),
    )
    labels = _field(F.col("segments")[0]["items"], "label")
    return _options(segments, yAxis=_axis(labels), series=series)


def _sankey_options(counts: DataFrame, key: str, metric: Funnel | Flow) -> DataFrame:
    if isinstance(metric, Funnel):
        links = funnel_links(
            counts.select(F.col("k1").alias("value"), "n"), metric.stages,
            min_count=metric.min_count, as_percent=metric.as_percent, weight=F.col("n"),
        )
        nodes = None
    else:
        pairs = counts.select(F.col("k1").alias("x"), F.col("k2").alias("y"), "n", "first")
        links = links_of_pairs(pairs, metric, few=True)
        nodes = nodes_of_pairs(pairs, metric, few=True).select("node_pos", "node")
    row = links.agg(_ordered(["link_pos"], "source", "target", "value").alias("links"))
    if nodes is None:
        # Declared nodes that a surviving link touches, read off the links themselves.
        ends = F.concat(_field(F.col("links"), "source"), _field(F.col("links"), "target"))
        declared = F.array(*[F.lit(node) for node in metric.stages.nodes])
        names = F.array_intersect(declared, ends)
    else:
        names = nodes.agg(_field(_ordered(["node_pos"], "node"), "node").alias("nodes")).scalar()
    series = F.struct(
        F.lit("sankey").alias("type"),
        F.transform("nodes", lambda n: F.struct(n.alias("name"))).alias("data"),
        F.transform(
            "links", lambda e: F.struct(e["source"].alias("source"), e["target"].alias("target"), e["value"].alias("value"))
        ).alias("links"),
    )
    keyed = row.withColumn("nodes", names).withColumn("key", F.lit(key))
    return _options(keyed, series=F.array(series))


def _upset_options(counts: DataFrame, key: str, metric: Combinations) -> DataFrame:
    sets, codes = list(metric.choices), metric.codes
    limits = {"min_size": metric.min_size, "max_combos": metric.max_combos}
    members = [F.when(F.substring("k1", i + 1, 1) == "1", F.lit(label)) for i, label in enumerate(sets)]
    sizes_ = counts.select(F.array_compact(F.array(*members)).alias("members"), F.col("n").alias("size"))
    combos = largest_sizes(sizes_, **limits)
    totals = totals_of_sizes(sizes_, sets)
    sizes = upset_combo_names(combos, codes).agg(_ordered(["col"], "name", "size").alias("v"))
    dots = upset_matrix(combos, sets).agg(_ordered(["col", "row"], "filled").alias("v"))
    spans = upset_connectors(combos, sets).agg(_ordered(["col"], "min_row", "max_row").alias("v"))
    rows = upset_set_names(totals, codes).agg(_ordered(["row"], "code", "name", "total").alias("v"))
    dropped = dropped_of_sizes(sizes_, **limits).select("dropped").scalar()
    frame = (
        sizes.withColumnRenamed("v", "combos")
        .withColumn("dots", dots.scalar())
        .withColumn("spans", spans.scalar())
        .withColumn("rows", rows.scalar())
        .withColumn("axis_max", upset_totals_axis(totals).scalar())
        .withColumn("dropped", dropped)
        .withColumn("key", F.lit(key))
    )
    bars = F.struct(
        F.lit("bar").alias("type"),
        F.transform(
            "combos", lambda c: F.struct(c["size"].alias("value"), c["name"].alias("name"))
        ).alias("data"),
    )
    matrix = F.struct(
        F.lit("scatter").alias("type"),
        F.transform(
            "dots",
            lambda d: F.struct(
                F.array(d["col"], d["row"]).alias("value"), d["filled"].alias("filled")
            ),
        ).alias("data"),
    )
    connectors = F.transform(
        "spans",
        lambda s: F.struct(
            F.lit("line").alias("type"),
            F.array(F.array(s["col"], s["min_row"]), F.array(s["col"], s["max_row"])).alias("data"),
        ),
    )
    left = F.struct(
        F.lit("bar").alias("type"),
        F.transform(
            "rows", lambda r: F.struct(r["total"].alias("value"), r["name"].alias("name"))
        ).alias("data"),
    )
    return _options(
        frame,
        rowAxis=_axis(_field(F.col("rows"), "code")),
        totalsAxis=F.struct(F.col("axis_max").alias("max")),
        sizes=bars,
        connectors=connectors,
        dots=matrix,
        totals=left,
        subtext=dropped_note(F.col("dropped"), min_size=metric.min_size),
    )


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked


# --- counts ----------------------------------------------------------------

# Flags of an input row that travel and are summed together.
_MASK_FLAGS = 8


def _numbered(report: Report) -> tuple[dict[str, Chart], list[object], dict[str, int]]:
    """Charts by key, the distinct metrics, and the number of each chart's metric."""
    charts = report.charts()
    if not charts:
        raise ValueError("the report has no charts")
    found: dict[int, int] = {}
    metrics: list[object] = []
    numbers = {}
    for key, chart in charts.items():
        metric = chart.metric.bins if isinstance(chart.metric, Likert) else chart.metric
        if id(metric) not in found:
            found[id(metric)] = len(metrics)
            metrics.append(metric)
        numbers[key] = found[id(metric)]
    return charts, metrics, numbers


def _allowed(value: Column, exclude: Sequence[str] | None) -> Column:
    """Whether a value is counted; with a list of exclusions null is not."""
    return F.coalesce(~value.isin(list(exclude)), F.lit(False)) if exclude else F.lit(True)


@dataclass(frozen=True)
class _Use:
    """What one metric takes from a source: all rows, or those of one flag, under keys of its own."""

    metric: int
    flag: int | None = None
    k1: str | None = None
    k2: str | None = None


@dataclass
class _Source:
    """Rows that are counted once for all metrics which count them by the same keys."""

    kept: Column
    k1: Column
    k2: Column
    id: Column | None = None
    flags: list[Column] = field(default_factory=list)
    uses: list[_Use] = field(default_factory=list)


def _name(value: str | Column) -> object:
    """Equal for equal column names; any other expression is only equal to itself."""
    return value if isinstance(value, str) else id(value)


def _sources(metrics: Sequence[object], flags: Sequence[Sequence[Column]]) -> list[_Source]:
    """All that is counted for the metrics, and which metric reads what.

    A row without a second key, or without any, is the base that shares refer to.
    """
    none, yes = F.lit(None).cast("string"), F.lit(True)
    found: dict[tuple, _Source] = {}

    def labels(column: str | Column, exclude: Sequence[str] | None) -> _Source:
        value = as_column(column)
        source = _Source(_allowed(value, exclude), value.cast("string"), none)
        return found.setdefault(("label", _name(column), tuple(exclude or ())), source)

    def everyone() -> _Source:
        return found.setdefault(("all",), _Source(yes, none, none))

    def flagged(source: _Source, number: int, own: Sequence[Column], key: str) -> None:
        for i, flag in enumerate(own):
            source.uses.append(_Use(number, len(source.flags), **{key: str(i)}))
            source.flags.append(F.coalesce(flag, F.lit(False)))

    for number, (metric, own) in enumerate(zip(metrics, flags)):
        if isinstance(metric, RankCount):
            everyone().uses.append(_Use(number))
            for p, column in enumerate(metric.ranks, start=1):
                value = as_column(column)
                placed = _Source(F.coalesce(value != "", F.lit(False)), value.cast("string"), none)
                found.setdefault(("placed", _name(column)), placed).uses.append(_Use(number, k2=str(p)))
            continue
        if isinstance(metric, SingleCount):
            source = labels(metric.column, metric.exclude)
        elif isinstance(metric, MultiCount):
            source = everyone()
            flagged(source, number, own, "k1")
        elif isinstance(metric, TraitTab):
            source = labels(metric.single, metric.x_exclude)
            flagged(source, number, own, "k2")
        elif isinstance(metric, CrossTab):
            x, y = as_column(metric.x), as_column(metric.y)
            kept = _allowed(x, metric.x_exclude) & _allowed(y, metric.y_exclude)
            key = ("pair", _name(metric.x), _name(metric.y), tuple(metric.x_exclude or ()), tuple(metric.y_exclude or ()))
            source = found.setdefault(key, _Source(kept, x.cast("string"), y.cast("string")))
        elif isinstance(metric, Funnel):
            value = as_column(metric.column).cast("string")
            kept = F.coalesce(value.isin(list(metric.stages.paths)), F.lit(False))
            source = found.setdefault(("own", number), _Source(kept, value, none))
        elif isinstance(metric, Flow):
            x, y = as_column(metric.x), as_column(metric.y)
            kept = x.isNotNull() & y.isNotNull() & _allowed(x, metric.exclude) & _allowed(y, metric.exclude)
            ends = flow_label(x, metric.x_map), flow_label(y, metric.y_map)
            source = found.setdefault(("own", number), _Source(kept, *ends, as_column(metric.id)))
        else:
            picked = [F.coalesce(f, F.lit(False)) for f in own]
            bits = F.concat(*[F.when(f, F.lit("1")).otherwise(F.lit("0")) for f in picked])
            source = found.setdefault(("own", number), _Source(F.array_contains(F.array(*picked), True), bits, none))
        source.uses.append(_Use(number))
    return list(found.values())


def report_counts(df: DataFrame, report: Report) -> DataFrame:
    """``(metric, k1, k2, n, first)``: everything the report's charts are made of.

    One scan and one shuffle with partial aggregation, for any number of charts. An input row
    is stacked once for each source of counts, not once for each metric and choice: metrics
    over the same labels share one, and up to ``_MASK_FLAGS`` flags travel as the bits of a
    number and are summed side by side. Add up ``n`` and take the least ``first`` to merge the
    counts of several inputs. Ids of flows are numbers, or all of one type that has an order.
    """
    _, metrics, _ = _numbered(report)
    choices = [list(getattr(m, "choices", {}).values()) for m in metrics]
    flags = iter(yes_flags(df, [c for own in choices for c in own]))
    kind = _id_type(df, [m for m in metrics if isinstance(m, Flow)])
    names = ["source", "kept", "k1", "k2", "id", "mask"]
    cells: list[Column] = []
    uses: list[list[_Use]] = []
    width = 0
    for source in _sources(metrics, [[next(flags) for _ in own] for own in choices]):
        first = F.lit(None) if source.id is None else source.id
        for low in range(0, max(len(source.flags), 1), _MASK_FLAGS):
            own = range(low, min(low + _MASK_FLAGS, len(source.flags)))
            width = max(width, len(own))
            mask = F.lit(0)
            for bit, i in enumerate(own):
                mask = mask.bitwiseOR(F.when(source.flags[i], F.lit(1 << bit)).otherwise(F.lit(0)))
            cell = [F.lit(len(uses)), source.kept, source.k1, source.k2, first.cast(kind), mask]
            cells.append(F.struct(*[part.alias(name) for name, part in zip(names, cell)]))
            # All rows are counted by the first mask; the others only add their flags.
            uses.append([
                replace(use, flag=None if use.flag is None else use.flag - low)
                for use in source.uses if (use.flag in own if use.flag is not None else low == 0)
            ])
    # Not F.stack: so many cells make one generated method that the JVM never compiles.
    kept = df.select(F.filter(F.array(*cells), lambda cell: cell["kept"]).alias("cells"))
    # The outer form, since the optimizer would test the whole array once more below a join.
    stacked = kept.select(F.inline_outer("cells")).filter("source IS NOT NULL")
    sums = [F.sum(F.shiftright("mask", bit).bitwiseAND(F.lit(1)).cast("bigint")) for bit in range(width)]
    counted = stacked.groupBy("source", "k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), *[s.alias(f"flag{bit}") for bit, s in enumerate(sums)]
    )
    return _used(counted, uses, width)


def _used(counted: DataFrame, uses: Sequence[Sequence[_Use]], width: int) -> DataFrame:
    """The counts of sources under the numbers and keys of the metrics that read them."""
    schema = "array<struct<metric int, flag int, k1 string, k2 string>>"
    of = F.array(*[
        F.array(*[
            F.struct(F.lit(use.metric), F.lit(use.flag).cast("int"), _text(use.k1), _text(use.k2)) for use in own
        ]).cast(schema)
        for own in uses
    ])
    found = counted.withColumn("use", F.explode_outer(F.element_at(of, F.col("source") + 1)))
    # The first entry counts all rows, those after it the flags.
    numbers = F.array("n", *[f"flag{bit}" for bit in range(width)])
    return found.select(
        F.col("use.metric").alias("metric"),
        F.coalesce("use.k1", "k1").alias("k1"),
        F.coalesce("use.k2", "k2").alias("k2"),
        F.element_at(numbers, F.coalesce(F.col("use.flag") + 2, F.lit(1))).alias("n"),
        "first",
    ).filter("n > 0")


def _id_type(df: DataFrame, flows: Sequence[Flow]) -> T.DataType:
    """The type of the ids that tell which row of a flow came first; of any numbers, one that holds all."""
    kinds = df.select(*[as_column(flow.id).alias(f"id{i}") for i, flow in enumerate(flows)]).schema.fields
    keys = {field.dataType for field in kinds if not isinstance(field.dataType, T.NumericType)}
    if not keys:
        return T.DecimalType(38, 0)
    if len(keys) > 1 or any(isinstance(field.dataType, T.NumericType) for field in kinds):
        raise ValueError("the ids of a report's flows must have one type")
    return keys.pop()


def merged_counts(counts: DataFrame) -> DataFrame:
    """Counts of several inputs as one."""
    return counts.groupBy("metric", "k1", "k2").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


def _family(counts: DataFrame, numbers: Sequence[int]) -> DataFrame:
    """Counts of some metrics, numbered by their place in the family where it has several."""
    if len(numbers) == 1:
        return counts.filter(F.col("metric") == numbers[0])
    # A metric that several charts show stands once for each.
    places: dict[int, list[int]] = {}
    for place, number in enumerate(numbers):
        places.setdefault(number, []).append(place)
    of = F.lit(None).cast("array<int>")
    for number, own in places.items():
        of = F.when(F.col("metric") == number, F.array(*[F.lit(p) for p in own])).otherwise(of)
    kept = counts.filter(F.col("metric").isin(list(places)))
    return kept.withColumn(METRIC, F.explode(of)).withColumn(METRIC, F.coalesce(METRIC, F.lit(0)))


def chart_options(counts: DataFrame, report: Report) -> DataFrame:
    """``(key, option)``: the data of every chart that has any, as JSON text, from its counts."""
    charts, metrics, numbers = _numbered(report)
    frames = []

    def of(*types: type) -> dict[str, Chart]:
        return {k: c for k, c in charts.items() if isinstance(metrics[numbers[k]], types)}

    def family(chosen: Mapping[str, Chart]) -> tuple[DataFrame, list[str], list]:
        own = [numbers[k] for k in chosen]
        return _family(counts, own), list(chosen), [metrics[number] for number in own]

    def keyed(frame: DataFrame, *columns: Column) -> DataFrame:
        return frame.select(*[c for c in frame.columns if c == METRIC], *columns)

    k1, k2, n = F.col("k1"), F.col("k2"), F.col("n")
    if singles := of(SingleCount):
        rows, names, specs = family(singles)
        frames.append(_bar_options(single_bins(keyed(rows, k1.alias("label"), n), names, specs, few=True), singles))
    if multis := of(MultiCount):
        rows, names, specs = family(multis)
        place = F.col(METRIC) if len(specs) > 1 else F.lit(0)
        picks = [
            F.coalesce(F.sum(F.when((place == q) & (k1 == str(i)), n)), F.lit(0).cast("bigint")).alias(slot)
            for q, slots in enumerate(multi_slots(specs))
            for i, (_, slot) in enumerate(slots)
        ]
        base = F.coalesce(F.sum(F.when((place == 0) & k1.isNull(), n)), F.lit(0).cast("bigint"))
        frames.append(_bar_options(multi_bins(rows.agg(base.alias("__total"), *picks), names, specs), multis))
    if ranks := of(RankCount):
        rows, names, specs = family(ranks)
        placed = keyed(rows, k2.isNull().alias("asked"), k2.cast("int").alias("position"), k1.alias("choice"), n)
        frames.append(_rank_options(rank_segments(placed, names, specs, weight=n, few=True)))
    if tables := of(CrossTab):
        rows, names, specs = family(tables)
        pairs = keyed(rows, k1.alias("x"), k2.alias("y"), n)
        frames.append(_table_options(crosstab_cells(pairs, names, specs, few=True), tables))
    if tabs := of(TraitTab):
        cells = [_trait_table(counts.filter(F.col("metric") == numbers[k]), k, c.metric) for k, c in tabs.items()]
        frames.append(_table_options(_stack(cells), tabs))
    for key, chart in of(Funnel, Flow).items():
        frames.append(_sankey_options(counts.filter(F.col("metric") == numbers[key]), key, chart.metric))
    for key, chart in of(Combinations).items():
        frames.append(_upset_options(counts.filter(F.col("metric") == numbers[key]), key, chart.metric))
    return _stack(frames)


def _trait_table(counts: DataFrame, key: str, metric: TraitTab) -> DataFrame:
    n, trait = F.col("n"), F.col("k2")
    sums = [
        F.coalesce(F.sum(F.when(trait == str(i), n)), F.lit(0).cast("bigint")).alias(slot)
        for i, slot in enumerate(trait_slots(len(metric.choices)))
    ]
    base = F.coalesce(F.sum(F.when(trait.isNull(), n)), F.lit(0).cast("bigint"))
    per_x = counts.groupBy(F.col("k1").alias("x")).agg(base.alias("__x_n"), *sums)
    cells = trait_cells(per_x, list(metric.choices), metric.x_order, few=True)
    return trait_values(cells, metric.denominator).withColumn("name", F.lit(key))


# --- the document ----------------------------------------------------------


def _text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def _empty_option(chart: Chart) -> str:
    """The option of a chart without data: the axes and series of its kind, empty."""
    axis = {"type": "category", "data": []}

    def series(*kinds: str) -> list[dict]:
        return [{"type": kind, "data": []} for kind in kinds]

    if chart.kind == "likert":
        groups = {"positive": chart.metric.positive, "negative": chart.metric.negative, "neutral": chart.metric.neutral}
        bars = [
            {"name": label, "type": "bar", "stack": "likert", "group": group, "data": [0.0]}
            for group, labels in groups.items() for label in labels
        ]
        return json.dumps({"series": bars})
    low, high = 0.0 if chart.low is None else float(chart.low), 100.0 if chart.high is None else float(chart.high)
    options = {
        "bar": {"yAxis": axis, "series": series("bar")},
        "lollipop": {"yAxis": axis, "series": series("bar", "pictorialBar")},
        "heatmap": {"xAxis": axis, "yAxis": axis, "visualMap": {"min": low, "max": high}, "series": series("heatmap")},
        "line": {"xAxis": axis, "unit": "%", "series": []},
        "rank": {"yAxis": axis, "series": []},
    }
    return json.dumps(options.get(chart.kind, {}))


def _chart_node(key: str, chart: Chart) -> Column:
    """A chart as VARIANT; height, caption and key appear only when set."""
    option = F.coalesce(F.try_element_at("__options", F.lit(key)), F.lit(_empty_option(chart)))
    caption = chart.caption
    if isinstance(chart.metric, Combinations) and caption is None:
        caption = upset_key(chart.metric.codes)
    legend = None
    if isinstance(chart.metric, Likert):
        labels = [*chart.metric.positive, *chart.metric.negative, *chart.metric.neutral]
        legend = F.array(*[F.struct(F.lit(label).alias("label")) for label in labels])
    parts = [F.parse_json(option).alias("option")]
    if chart.title is not None:
        parts.append(F.lit(chart.title).alias("title"))
    if chart.height is not None:
        parts.append(F.lit(chart.height).alias("height"))
    if caption is not None:
        parts.append(F.lit(caption).alias("caption"))
    if legend is not None:
        parts.append(legend.alias("key"))
    return F.parse_json(F.to_json(F.struct(F.lit(chart.kind).alias("kind"), *parts)))


def _row_node(row: ReportRow) -> Column:
    if row.commentary is not None:
        commentary = F.lit(row.commentary)
    else:
        missing = F.raise_error(F.lit(f"no commentary for row {row.id}")).cast("string")
        commentary = F.coalesce(F.try_element_at("__notes", F.lit(row.id)), missing)
    charts = [_chart_node(f"{row.id}/{i}", chart) for i, chart in enumerate(row.charts)]
    return F.struct(
        F.lit(row.id).alias("id"),
        F.lit(row.title).alias("title"),
        F.lit(row.question).alias("question"),
        commentary.alias("commentary"),
        F.array(*charts).alias("charts"),
        F.lit(row.wide).alias("wide"),
    )


def _section_node(section: ReportSection) -> Column:
    return F.struct(
        F.lit(section.id).alias("id"),
        F.lit(section.heading).alias("heading"),
        _text(section.note).alias("note"),
        F.array(*[_row_node(row) for row in section.rows]).alias("rows"),
    )


def build_report(
    df: DataFrame, report: Report, commentary: DataFrame | None = None
) -> DataFrame:
    """The report as one row ``(series, year, document)``, ``document`` being JSON.

    Counts ``df`` once, into the shared folder, and makes all charts from the counts.
    """
    return report_of_counts(stored(report_counts(df, report), "report-counts"), report, commentary)


def report_of_counts(
    counts: DataFrame, report: Report, commentary: DataFrame | None = None
) -> DataFrame:
    """The report as :func:`build_report` gives it, from :func:`report_counts`.

    Keys come in a fixed order. ``note`` and ``intro_*`` stay as null, optional
    chart fields are left out. ``commentary`` is ``(section_id, body)``; a row
    that brings no commentary of its own must have a section there. The two
    lookup maps hold one entry per chart and per report row.
    """
    options = F.map_from_entries(F.collect_list(F.struct("key", "option")))
    base = chart_options(counts, report).agg(options.alias("__options"))
    if commentary is None:
        notes = F.lit(None).cast("map<string,string>")
    else:
        wanted = [row.id for section in report.sections for row in section.rows]
        used = commentary.filter(F.col("section_id").isin(wanted))
        notes = used.agg(
            F.map_from_entries(F.collect_list(F.struct("section_id", "body"))).alias("m")
        ).scalar()
    intro = report.intro_paragraphs
    paragraphs = (
        F.lit(None).cast("array<string>") if intro is None else F.array(*[F.lit(p) for p in intro])
    )
    page = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(report.series).alias("series"),
        F.lit(report.year).alias("year"),
        F.lit(report.title).alias("title"),
        _text(report.intro_meta).alias("intro_meta"),
        paragraphs.alias("intro_paragraphs"),
        F.array(*[_section_node(section) for section in report.sections]).alias("sections"),
    )
    return base.withColumn("__notes", notes).select(
        F.lit(report.series).alias("series"),
        F.lit(report.year).alias("year"),
        F.to_json(page, {"ignoreNullFields": "false"}).alias("document"),
    )
