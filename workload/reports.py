"""Report documents."""

import uuid

from pyspark.sql import functions as F

from tally.operators import CrossTab, Flow, MultiCount, RankCount, SingleCount
from tally.plans import (
    Chart,
    Combinations,
    Funnel,
    Likert,
    Report,
    ReportRow,
    ReportSection,
    TraitTab,
    build_report,
)
from tally.sources import parse_reports, publish_run, published_frame, published_reports, report_index, report_page
from tally.storage import shared_folder
from workload.counts import OFF, PRIORITIES
from workload.crosstabs import orders_with_traits, traits
from workload.flows import STAGE_LINKS_SQL, STAGES, X_MAP, Y_MAP
from workload.registry import query, table, tenths


def order_report() -> Report:
    """A report with every chart kind over orders and their lines."""
    tab = CrossTab("o_orderpriority", "o_orderstatus", "y", x_order=PRIORITIES)
    year = F.year("o_orderdate").cast("string")
    return Report(
        year=2025,
        title="Orders",
        intro_meta="All orders",
        sections=[
            ReportSection("basics", "Basics", note="Small groups are hidden.", rows=[
                ReportRow("priority", "Priority", "Which priority?", [
                    Chart("bar", SingleCount("o_orderpriority", order=PRIORITIES)),
                    Chart("likert", Likert(SingleCount("o_orderpriority", **OFF),
                                           PRIORITIES[:2], ["5-LOW"], PRIORITIES[2:])),
                    Chart("sankey", Funnel("o_orderpriority", STAGES, as_percent=True)),
                ], wide=True),
                ReportRow("year", "Year", "Ordered when?", [Chart("lollipop", SingleCount(year))]),
            ]),
            ReportSection("crossed", "Crossed", rows=[
                ReportRow("flags", "Return flags", "Which flags occur?", [
                    Chart("bar", MultiCount(traits())),
                    Chart("upset", Combinations(traits(), codes={"R": "returned"}), height=560),
                    Chart("heatmap", TraitTab(traits(), "o_orderpriority", "rate")),
                    Chart("heatmap", TraitTab(traits(), "o_orderpriority", "lift")),
                ]),
                ReportRow("status", "Status", "Which status?", [
                    Chart("heatmap", tab),
                    Chart("line", tab),
                    Chart("rank", RankCount(["o_orderpriority", "o_orderstatus"])),
                    Chart("sankey", Flow("o_orderpriority", "o_orderstatus", "o_orderkey",
                                         X_MAP, Y_MAP, as_percent=True)),
                ]),
            ]),
        ],
    )


def order_rows(spark, d):
    return orders_with_traits(spark, d).join(
        table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey"
    )


_OPTION = """
    kind string, option struct<
        xAxis: struct<data: array<string>>, yAxis: struct<data: array<string>>,
        series: array<struct<data: string, links: array<struct<source: string, target: string, value: double>>>>,
        sizes: struct<data: array<struct<value: double, name: string>>>>
"""


def drawn_points(reports):
    """``(row_id, chart, series, i, label, value)``: everything a report's charts draw."""
    rows = reports.select(F.explode(F.flatten(F.transform("sections", lambda s: s["rows"]))).alias("r"))
    charts = rows.select(F.col("r.id").alias("row_id"), F.posexplode("r.charts").alias("chart", "c"))
    read = charts.select("row_id", "chart", F.from_json(F.to_json("c"), _OPTION).alias("c")).select(
        "row_id", "chart", "c.kind", "c.option.*"
    )
    x, y = F.col("xAxis.data"), F.col("yAxis.data")
    point = F.struct

    def listed(e, i):
        label = F.get(F.coalesce(y, x), i)
        return point(i.alias("i"), label.alias("label"), e.alias("value"))

    def cell(e, i):
        label = F.concat_ws("|", F.get(x, e[0].cast("int")), F.get(y, e[1].cast("int")))
        return point(i.alias("i"), label.alias("label"), e[2].alias("value"))

    def link(e, i):
        return point(i.alias("i"), F.concat_ws(">", e["source"], e["target"]).alias("label"), e["value"].alias("value"))

    def size(e, i):
        return point(i.alias("i"), e["name"].alias("label"), e["value"].alias("value"))

    def drawn(s):
        return (
            F.when(F.col("kind") == "heatmap", F.transform(F.from_json(s["data"], "array<array<double>>"), cell))
            .when(F.col("kind") == "sankey", F.transform(s["links"], link))
            .otherwise(F.transform(F.from_json(s["data"], "array<double>"), listed))
        )

    series = F.when(F.col("kind") == "upset", F.array(F.transform("sizes.data", size))).otherwise(
        F.transform("series", drawn)
    )
    points = read.select("row_id", "chart", F.posexplode(series).alias("series", "points"))
    return points.select("row_id", "chart", "series", F.inline("points"))


_IN_ORDER = f"coalesce(list_position({PRIORITIES!r}, {{0}}), 5)"


def _bars_sql(head: str, row_id: str, chart: int, series: str = "0") -> str:
    """Bars bottom-up from ``bins(pos, label, percent)``."""
    return f"""
    SELECT '{row_id}' AS row_id, {chart} AS chart, {series} AS series,
           CAST((SELECT max(pos) FROM {head}) - pos AS INTEGER) AS i, label, {tenths('percent')} AS value FROM {head}
    """


_REPORT_SQL = f"""
WITH total AS (SELECT count(*) AS t FROM orders),
priority AS (
    SELECT o_orderpriority AS label, count(*) AS n, any_value(t) AS t, count(*) / any_value(t) * 100.0::DOUBLE AS percent,
           row_number() OVER (ORDER BY {_IN_ORDER.format('o_orderpriority')}, count(*) DESC, o_orderpriority) AS pos
    FROM orders, total GROUP BY 1
),
scale(series, label) AS (VALUES (0, '1-URGENT'), (1, '2-HIGH'), (2, '5-LOW'), (3, '3-MEDIUM'), (4, '4-NOT SPECIFIED')),
{STAGE_LINKS_SQL.replace('links AS', 'steps AS')},
funnel AS (SELECT *, row_number() OVER (ORDER BY link_order) - 1 AS i FROM steps WHERE n >= 5),
years AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS label, count(*) AS n FROM orders GROUP BY 1),
rare_years AS (SELECT *, n / t * 100.0::DOUBLE < 0.5 OR n < 5 AS rare FROM years, total),
shown_years AS (
    SELECT label, n, t FROM rare_years WHERE NOT rare
    UNION ALL SELECT 'Other (combined)', CAST(sum(n) AS BIGINT), max(t) FROM rare_years WHERE rare HAVING count(*) > 0
),
year AS (SELECT label, n / t * 100.0::DOUBLE AS percent, row_number() OVER (ORDER BY n DESC, label) AS pos FROM shown_years),
flags AS (SELECT DISTINCT l_orderkey AS k, l_returnflag AS f FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
picked AS (
    SELECT f AS label, n / t * 100.0::DOUBLE AS percent, row_number() OVER (ORDER BY n DESC, f) AS pos
    FROM (SELECT f, count(*) AS n FROM flags GROUP BY 1), total
),
combos AS (
    SELECT m, n, row_number() OVER (ORDER BY n DESC, m) - 1 AS i
    FROM (SELECT m, count(*) AS n FROM (SELECT k, list(f ORDER BY f) AS m FROM flags GROUP BY 1) GROUP BY 1) WHERE n >= 5
),
px AS (SELECT o_orderpriority AS x, count(*) AS xn, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS xi FROM orders GROUP BY 1),
fy AS (SELECT f AS y, count(*) AS yn, row_number() OVER (ORDER BY f) - 1 AS yi FROM flags GROUP BY 1),
both_ AS (SELECT o_orderpriority AS x, f AS y, count(*) AS n FROM orders JOIN flags ON k = o_orderkey GROUP BY 1, 2),
traits AS (SELECT x, y, xi, yi, xn, yn, coalesce(n, 0) AS n, t FROM px CROSS JOIN fy CROSS JOIN total LEFT JOIN both_ USING (x, y)),
sy AS (SELECT o_orderstatus AS y, count(*) AS yn, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) - 1 AS yi FROM orders GROUP BY 1),
sx AS (SELECT o_orderpriority AS x, row_number() OVER (ORDER BY {_IN_ORDER.format('o_orderpriority')}, count(*) DESC, o_orderpriority) - 1 AS xi
       FROM orders GROUP BY 1),
crossed AS (SELECT o_orderpriority AS x, o_orderstatus AS y, count(*) AS n FROM orders GROUP BY 1, 2),
tab AS (SELECT x, y, xi, yi, coalesce(n, 0) / yn * 100.0::DOUBLE AS value FROM sx CROSS JOIN sy LEFT JOIN crossed USING (x, y)),
placed AS (
    SELECT o_orderpriority AS label, count(*) AS a, 0 AS b FROM orders GROUP BY 1
    UNION ALL SELECT o_orderstatus, 0, count(*) FROM orders GROUP BY 1
),
ranked AS (SELECT label, a / t * 100.0::DOUBLE AS a, b / t * 100.0::DOUBLE AS b, row_number() OVER (ORDER BY 2 * a + b DESC, label) AS pos
           FROM placed, total WHERE a + b >= 5),
mapped AS (
    SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Expedited' WHEN o_orderpriority = '3-MEDIUM' THEN 'Standard'
                ELSE o_orderpriority END AS x,
           CASE o_orderstatus WHEN 'F' THEN 'Filled' ELSE 'Pending' END AS y, o_orderkey AS id FROM orders
),
pairs AS (SELECT x, y, count(*) AS n, min(id) AS first FROM mapped GROUP BY 1, 2),
flow AS (
    SELECT x, y, n / t * 100.0::DOUBLE AS percent, row_number() OVER (ORDER BY xf, x, yf, y) - 1 AS i
    FROM pairs JOIN (SELECT x, min(first) AS xf FROM pairs GROUP BY 1) USING (x)
    JOIN (SELECT y, min(first) AS yf FROM pairs GROUP BY 1) USING (y), total WHERE n >= 5
)
{_bars_sql('priority', 'priority', 0)}
UNION ALL SELECT 'priority', 1, series, 0, NULL, coalesce({tenths('percent')}, 0.0::DOUBLE) FROM scale LEFT JOIN priority USING (label)
UNION ALL SELECT 'priority', 2, 0, i, source || '>' || target, {tenths('n / total * 100.0::DOUBLE')} FROM funnel
UNION ALL {_bars_sql('year', 'year', 0)} UNION ALL {_bars_sql('year', 'year', 0, '1')}
UNION ALL {_bars_sql('picked', 'flags', 0)}
UNION ALL SELECT 'flags', 1, 0, i,
    array_to_string(list_transform(m, lambda f: CASE f WHEN 'R' THEN 'returned' ELSE f END), ' · ') || ': ' || n, n FROM combos
UNION ALL SELECT 'flags', 2, 0, xi * (SELECT count(*) FROM fy) + yi, x || '|' || y, {tenths('n / xn * 100.0::DOUBLE')} FROM traits
UNION ALL SELECT 'flags', 3, 0, xi * (SELECT count(*) FROM fy) + yi, x || '|' || y,
    {tenths('(n * t)::DOUBLE / (yn * xn)::DOUBLE')} FROM traits
UNION ALL SELECT 'status', 0, 0, xi * (SELECT count(*) FROM sy) + yi, x || '|' || y, {tenths('value')} FROM tab
UNION ALL SELECT 'status', 1, yi, xi, x, {tenths('value')} FROM tab
UNION ALL SELECT 'status', 2, 0, (SELECT max(pos) FROM ranked) - pos, label, {tenths('a')} FROM ranked
UNION ALL SELECT 'status', 2, 1, (SELECT max(pos) FROM ranked) - pos, label, {tenths('b')} FROM ranked
UNION ALL SELECT 'status', 2, 2, (SELECT max(pos) FROM ranked) - pos, label, {tenths('100.0::DOUBLE - (a + b)')} FROM ranked
UNION ALL SELECT 'status', 3, 0, i, x || '>' || y, {tenths('percent')} FROM flow
"""
_REPORT_SQL = f"""
SELECT row_id, CAST(chart AS INTEGER) AS chart, CAST(series AS INTEGER) AS series, CAST(i AS INTEGER) AS i, label,
       CAST(value AS DOUBLE) AS value FROM ({_REPORT_SQL})
"""


@query("report_document", _REPORT_SQL)
def document(spark, d):
    """The whole document is built and read back; the rows are all points that its charts draw."""
    built = build_report(order_rows(spark, d), order_report(), order_notes(spark, d))
    return drawn_points(parse_reports(built, "document"))


def order_notes(spark, d):
    return table(spark, d, "orders").agg(F.count(F.lit(1)).cast("string").alias("n")).select(
        F.explode(F.array(*[F.lit(r) for r in ("priority", "year", "flags", "status")])).alias(
            "section_id"
        ),
        F.concat("n", F.lit(" orders")).alias("body"),
    )


@query(
    "report_rows",
    """
    SELECT row_id, title, question, n || ' orders' AS commentary, wide, CAST(charts AS INTEGER) AS charts
    FROM (VALUES ('priority', 'Priority', 'Which priority?', true, 3), ('year', 'Year', 'Ordered when?', false, 1),
                 ('flags', 'Return flags', 'Which flags occur?', false, 4), ('status', 'Status', 'Which status?', false, 4))
         r(row_id, title, question, wide, charts), (SELECT count(*) AS n FROM orders)
    """,
)
def document_rows(spark, d):
    built = build_report(order_rows(spark, d), order_report(), order_notes(spark, d))
    reports = parse_reports(built, "document")
    rows = reports.select(F.explode(F.flatten(F.transform("sections", lambda s: s["rows"]))).alias("r"))
    return rows.select(
        F.col("r.id").alias("row_id"), "r.title", "r.question", "r.commentary", "r.wide", F.size("r.charts").alias("charts")
    )


def yearly_reports(spark, d):
    """One stored report document per order year; the year 2000 stands for a demonstration."""
    orders = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    row = F.struct(
        F.lit("orders").alias("id"),
        F.lit("Orders").alias("title"),
        F.lit("How many?").alias("question"),
        F.concat(F.col("n").cast("string"), F.lit(" orders")).alias("commentary"),
        F.array(F.struct(F.struct("n").alias("option"))).alias("charts"),
    )
    section = F.struct(
        F.lit("all").alias("id"), F.lit("All").alias("heading"), F.array(row).alias("rows")
    )
    page = F.struct(
        F.lit(1).alias("schema_version"),
        F.when(F.col("y") % 2 == 0, F.lit("orders")).alias("series"),
        F.when(F.col("y") == 2000, F.lit(9999)).otherwise(F.col("y")).alias("year"),
        F.concat(F.lit("Year "), F.col("y").cast("string")).alias("title"),
        F.array(section).alias("sections"),
    )
    return orders.select(F.to_json(page).alias("document"))


_YEARS = """
    SELECT CASE WHEN y % 2 = 0 THEN 'orders' ELSE 'community' END AS series,
           CAST(CASE WHEN y = 2000 THEN 9999 ELSE y END AS INTEGER) AS year,
           'Year ' || y AS title, n
    FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)
"""


@query("report_index", f"SELECT series, year, title FROM ({_YEARS}) WHERE year <> 9999")
def index(spark, d):
    return report_index(parse_reports(yearly_reports(spark, d), "document"))


@query(
    "read_reports",
    f"""
    SELECT 1 AS schema_version, series, year, title, 'orders' AS row_id, n || ' orders' AS commentary,
           false AS wide, '[{{"option":{{"n":' || n || '}}}}]' AS charts
    FROM ({_YEARS})
    """,
)
def stored(spark, d):
    reports = parse_reports(yearly_reports(spark, d), "document")
    rows = reports.select(
        "schema_version", "series", "year", "title", F.explode(F.col("sections")[0]["rows"]).alias("r")
    )
    return rows.select(
        "schema_version",
        "series",
        "year",
        "title",
        F.col("r.id").alias("row_id"),
        F.col("r.commentary").alias("commentary"),
        F.col("r.wide").alias("wide"),
        F.to_json("r.charts").alias("charts"),
    )


@query(
    "written_reports",
    f"""
    SELECT series, year, title, n || ' orders' AS commentary,
           (SELECT count(DISTINCT o_orderstatus) FROM orders o WHERE year(o.o_orderdate) = (CASE WHEN y.year = 9999 THEN 2000 ELSE y.year END)) AS bins
    FROM ({_YEARS}) y
    """,
)
def written(spark, d):
    """All yearly reports with a frame each, published as a run; a second run replaces the odd years with the same."""
    path = f"{shared_folder(spark)}/published-{uuid.uuid4().hex}"
    reports = yearly_reports(spark, d).select(
        F.coalesce(F.get_json_object("document", "$.series"), F.lit("community")).alias("series"),
        F.get_json_object("document", "$.year").cast("int").alias("year"), "document",
    )
    year = F.year("o_orderdate")
    statuses = table(spark, d, "orders").groupBy(
        F.when(year % 2 == 0, F.lit("orders")).otherwise(F.lit("community")).alias("series"),
        F.when(year == 2000, F.lit(9999)).otherwise(year).alias("year"), F.col("o_orderstatus").alias("label"),
    ).agg(F.count(F.lit(1)).alias("count"))
    publish_run(path, reports, {"statuses": statuses})
    publish_run(path, reports.where("series = 'community'"))
    bins = published_frame(spark, path, "statuses").groupBy("series", "year").agg(F.count(F.lit(1)).alias("bins"))
    return published_reports(spark, path).join(bins, ["series", "year"]).select(
        "series", "year", "title", F.col("sections")[0]["rows"][0]["commentary"].alias("commentary"), "bins"
    )


@query("report_page", f"SELECT series, year, title FROM ({_YEARS}) WHERE series = 'orders' AND year = 1996")
def page(spark, d):
    reports = parse_reports(yearly_reports(spark, d), "document")
    return report_page(reports, "orders", 1996).select("series", "year", "title")
