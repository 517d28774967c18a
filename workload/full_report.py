"""A report of full width: 46 rows with 51 charts over orders, each chart next to its SQL.

A column or a condition is written once, as SQL that Spark and the oracle both read.
"""

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
from tally.sources import parse_reports
from workload.flows import STAGES
from workload.registry import query, table, tenths
from workload.reports import drawn_points

PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
WEALTH = ["debt", "some", "rich"]
COLUMNS = {
    "priority": "o_orderpriority",
    "status": "o_orderstatus",
    "year": "CAST(year(o_orderdate) AS STRING)",
    "month": "CAST(month(o_orderdate) AS STRING)",
    "segment": "c_mktsegment",
    "nation": "concat('nation ', CAST(c_nationkey AS STRING))",
    "wealth": "CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'some' ELSE 'rich' END",
    "basket": "CASE WHEN n_lines IS NULL THEN 'none' WHEN n_lines < 3 THEN 'few' ELSE 'many' END",
    "agreed": "CASE WHEN o_orderstatus = 'F' THEN 'yes' WHEN o_orderstatus = 'O' THEN 'No' ELSE 'so so' END",
    "price": "o_totalprice",
    "account": "c_acctbal",
    "id": "o_orderkey",
    "returned": "coalesce(r, false)",
    "open": "coalesce(o, false)",
    "kept": "coalesce(a, false)",
}
_WIDE = f"""
    SELECT {', '.join(f'{sql} AS {name}' for name, sql in COLUMNS.items())}
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN (
        SELECT l_orderkey, count(*) AS n_lines, bool_or(l_returnflag = 'R') AS r,
               bool_or(l_returnflag = 'A') AS a, bool_or(l_linestatus = 'O') AS o
        FROM lineitem GROUP BY 1) lines ON l_orderkey = o_orderkey
"""


def wide(spark, d):
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.expr("count(*) AS n_lines"), F.expr("bool_or(l_returnflag = 'R') AS r"),
        F.expr("bool_or(l_returnflag = 'A') AS a"), F.expr("bool_or(l_linestatus = 'O') AS o"),
    )
    orders = table(spark, d, "orders").join(table(spark, d, "customer"), F.expr("c_custkey = o_custkey"))
    joined = orders.join(lines, F.expr("l_orderkey = o_orderkey"), "left")
    return joined.select(*[F.expr(f"{sql} AS {name}") for name, sql in COLUMNS.items()])


def choices(i: int) -> dict[str, str]:
    """Choices of the i-th multi-select question, and the condition of each."""
    return {
        "returned": "returned", "open": "open",
        f"price over {10_000 * (i + 1)}": f"price > {10_000 * (i + 1)}",
        f"account over {600 * i}": f"account > {600 * i}",
        f"year {1992 + i % 7}": f"year = '{1992 + i % 7}'",
    }


def flags(asked: dict[str, str]) -> dict:
    return {label: F.expr(condition) for label, condition in asked.items()}


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _rank(label: str, order) -> str:
    return f"coalesce(list_position({_list(order)}, {label}) - 1, {len(order)})" if order else "0"


def single(column, *, order=None, exclude=(), min_percent=0.5, action="combine", kind="bar"):
    """What makes a bar chart of one column, and the SQL of its bars, bottom-up."""
    metric = SingleCount(column, order, list(exclude) or None, min_percent, 5, action)
    where = f"WHERE {column} NOT IN ({', '.join(repr(e) for e in exclude)})" if exclude else ""
    rare = "n < 5" + (f" OR n / t * 100.0::DOUBLE < {min_percent}" if min_percent else "")
    other = "UNION ALL SELECT 'Other (combined)', CAST(sum(n) AS BIGINT), max(t), true FROM f WHERE rare HAVING count(*) > 0"
    sql = f"""
        WITH c AS (SELECT {column} AS label, count(*) AS n FROM wide {where} GROUP BY 1),
        s AS (SELECT *, sum(n) OVER () AS t FROM c), f AS (SELECT *, {rare} AS rare FROM s),
        b AS (SELECT label, n, t, false AS late FROM f WHERE NOT rare {other if action == 'combine' else ''}),
        p AS (SELECT *, row_number() OVER (ORDER BY {_rank('label', order)}, n DESC, label, late) AS pos FROM b)
        SELECT 0 AS series, (SELECT max(pos) FROM p) - pos AS i, label, {tenths('n / t * 100.0::DOUBLE')} AS value FROM p
    """
    return (lambda: Chart(kind, metric)), sql


def multi(asked):
    counts = ", ".join(f"count(*) FILTER ({condition})" for condition in asked.values())
    sql = f"""
        WITH c AS (SELECT unnest({_list(asked)}) AS label, unnest(range({len(asked)})) AS cp, unnest([{counts}]) AS n,
                          count(*) AS t FROM wide),
        s AS (SELECT *, n / t * 100.0::DOUBLE AS percent FROM c), f AS (SELECT *, n < 5 OR percent < 0.5 AS rare FROM s),
        b AS (SELECT 0 AS late, cp, label, n, percent FROM f WHERE NOT rare
              UNION ALL SELECT 1, 0, 'Other (combined)', sum(n), sum(percent) FROM f WHERE rare HAVING count(*) > 0),
        p AS (SELECT *, row_number() OVER (ORDER BY late, n DESC, cp) AS pos FROM b)
        SELECT 0 AS series, (SELECT max(pos) FROM p) - pos AS i, label, {tenths('percent')} AS value FROM p
    """
    return (lambda: Chart("bar", MultiCount(flags(asked)))), sql


def likert(column, positive, negative, neutral):
    levels = [*positive, *negative, *neutral]
    metric = SingleCount(column, min_percent=None, min_count=None)
    sql = f"""
        WITH s AS (SELECT unnest({_list(levels)}) AS level, unnest(range({len(levels)})) AS series),
        c AS (SELECT {column} AS level, count(*) / (SELECT count(*) FROM wide) * 100.0::DOUBLE AS percent FROM wide GROUP BY 1)
        SELECT series, 0 AS i, NULL AS label, coalesce({tenths('percent')}, 0.0::DOUBLE) AS value FROM s LEFT JOIN c USING (level)
    """
    return (lambda: Chart("likert", Likert(metric, positive, negative, neutral))), sql


def funnel(column, stages):
    links = [
        f"SELECT {i} AS nth, '{source}>{target}' AS label, count(*) FILTER ({column} IN ({', '.join(map(repr, values))})) AS n"
        f", count(*) FILTER ({column} IN ({', '.join(map(repr, stages.paths))})) AS t FROM wide"
        for i, (source, target, values) in enumerate(stages.links())
    ]
    sql = f"""
        SELECT 0 AS series, row_number() OVER (ORDER BY nth) - 1 AS i, label, {tenths('n / t * 100.0::DOUBLE')} AS value
        FROM ({' UNION ALL '.join(links)}) WHERE n >= 5
    """
    return (lambda: Chart("sankey", Funnel(column, stages, as_percent=True))), sql


def flow(x, y, x_map=None, exclude=()):
    mapped = f"CASE {x} {' '.join(f'WHEN {k!r} THEN {v!r}' for k, v in x_map.items())} ELSE {x} END" if x_map else x
    where = " AND ".join(f"{c} NOT IN ({', '.join(map(repr, exclude))})" for c in (x, y)) if exclude else "true"
    sql = f"""
        WITH p AS (SELECT {mapped} AS x, {y} AS y, count(*) AS n, min(id) AS first FROM wide WHERE {where} GROUP BY 1, 2),
        l AS (SELECT *, min(first) OVER (PARTITION BY x) AS xf, min(first) OVER (PARTITION BY y) AS yf, sum(n) OVER () AS t FROM p)
        SELECT 0 AS series, row_number() OVER (ORDER BY xf, x, yf, y) - 1 AS i, x || '>' || y AS label,
               {tenths('n / t * 100.0::DOUBLE')} AS value FROM l WHERE n >= 5
    """
    return (lambda: Chart("sankey", Flow(x, y, "id", x_map, None, list(exclude) or None, as_percent=True))), sql


def upset(asked, max_combos=20):
    member = ", ".join(f"CASE WHEN {condition} THEN '{label}' END" for label, condition in asked.items())
    sql = f"""
        WITH m AS (SELECT list_filter([{member}], lambda x: x IS NOT NULL) AS m FROM wide),
        s AS (SELECT m, count(*) AS n FROM m WHERE len(m) > 0 GROUP BY 1),
        p AS (SELECT *, row_number() OVER (ORDER BY n DESC, m) - 1 AS i FROM s WHERE n >= 5)
        SELECT 0 AS series, i, array_to_string(m, ' · ') || ': ' || n AS label, n AS value FROM p WHERE i < {max_combos}
    """
    return (lambda: Chart("upset", Combinations(flags(asked), max_combos=max_combos))), sql


def traits(asked, x, denominator, x_order=None):
    pairs = " UNION ALL ".join(
        f"SELECT x, {i} AS yi, '{label}' AS y, count(*) FILTER (f{i}) AS n, count(*) AS xn FROM w GROUP BY x"
        for i, label in enumerate(asked)
    )
    value = "n / xn * 100.0::DOUBLE" if denominator == "rate" else (
        "CASE WHEN yn > 0 AND xn > 0 THEN (n::DOUBLE * t::DOUBLE) / (yn::DOUBLE * xn::DOUBLE) ELSE 1.0 END"
    )
    sql = f"""
        WITH w AS (SELECT {x} AS x, {', '.join(f'({c}) AS f{i}' for i, c in enumerate(asked.values()))} FROM wide),
        p AS ({pairs}),
        xs AS (SELECT x, row_number() OVER (ORDER BY {_rank('x', x_order)}, count(*) DESC, x) - 1 AS xi FROM w GROUP BY x),
        c AS (SELECT *, sum(n) OVER (PARTITION BY yi) AS yn, (SELECT count(*) FROM w) AS t FROM p JOIN xs USING (x))
        SELECT 0 AS series, xi * {len(asked)} + yi AS i, x || '|' || y AS label, {tenths(value)} AS value FROM c
    """
    return (lambda: Chart("heatmap", TraitTab(flags(asked), x, denominator, x_order))), sql


def crossed(x, y, kind, x_order=None, y_order=None):
    place = "0 AS series, xi * (SELECT count(*) FROM ys) + yi AS i, x || '|' || y AS label"
    if kind == "line":
        place = "yi AS series, xi AS i, x AS label"
    sql = f"""
        WITH p AS (SELECT {x} AS x, {y} AS y, count(*) AS n FROM wide GROUP BY 1, 2),
        xs AS (SELECT x, row_number() OVER (ORDER BY {_rank('x', x_order)}, sum(n) DESC, x) - 1 AS xi FROM p GROUP BY 1),
        ys AS (SELECT y, sum(n) AS yn, row_number() OVER (ORDER BY {_rank('y', y_order)}, sum(n) DESC, y) - 1 AS yi FROM p GROUP BY 1),
        c AS (SELECT x, y, xi, yi, coalesce(n, 0) / yn * 100.0::DOUBLE AS value FROM xs CROSS JOIN ys LEFT JOIN p USING (x, y))
        SELECT {place}, {tenths('value')} AS value FROM c
    """
    return (lambda: Chart(kind, CrossTab(x, y, "y", x_order, y_order))), sql


def ranked(columns, bands=None):
    shown = bands or [(p, p) for p in range(1, len(columns) + 1)]
    placed = " UNION ALL ".join(f"SELECT {c} AS label, {p} AS p FROM wide" for p, c in enumerate(columns, start=1))
    counters = ", ".join(f"count(*) FILTER (p BETWEEN {a} AND {b}) AS c{i}" for i, (a, b) in enumerate(shown))
    score = " + ".join(f"c{i} * {len(shown) - i}" for i in range(len(shown)))
    shares = [f"c{i} / t * 100.0::DOUBLE" for i in range(len(shown))]
    shares.append(f"100.0::DOUBLE - (0.0::DOUBLE + {' + '.join(shares)})")
    series = " UNION ALL ".join(
        f"SELECT {i} AS series, (SELECT max(pos) FROM q) - pos AS i, label, {tenths(share)} AS value FROM q"
        for i, share in enumerate(shares)
    )
    sql = f"""
        WITH c AS (SELECT label, count(*) AS placements, {counters}, (SELECT count(*) FROM wide) AS t FROM ({placed}) GROUP BY 1),
        q AS (SELECT *, row_number() OVER (ORDER BY {score} DESC, label) AS pos FROM c WHERE placements >= 5)
        {series}
    """
    return (lambda: Chart("rank", RankCount(columns, bands))), sql


BANDS = [(1, 1), (2, 3), (4, 4)]
SECTIONS = {
    "people": {
        **{c: [single(c, min_percent=None, action="drop")] for c in ("nation", "segment", "status", "month", "basket", "priority")},
        "age": [single("wealth", order=WEALTH, min_percent=None, action="drop")],
        "practice": [single("year", order=[str(y) for y in range(1992, 1999)], min_percent=None, action="drop")],
    },
    "technology": {
        **{f"tools_{i}": [multi(choices(i))] for i in range(10)},
        "edition": [single("year", min_percent=0.1)],
    },
    "experience": {
        "upgrade": [
            likert("priority", PRIORITY[:2], PRIORITY[4:], PRIORITY[2:4]),
            funnel("priority", STAGES),
            flow("priority", "segment", {"1-URGENT": "Expedited", "2-HIGH": "Expedited"}, ["5-LOW"]),
        ],
        **{f"habits_{i}": [multi(choices(i))] for i in (10, 11, 12)},
        "kinds": [multi(choices(13)), upset(choices(13))],
        "tenure": [single("wealth", order=WEALTH, min_percent=None)],
        "skill": [single("priority", order=PRIORITY, min_percent=None)],
        "success": [single("basket", order=["none", "few", "many"], min_percent=None)],
        "heard_which": [single("nation")], "heard_how": [single("month")], "toolset": [single("segment")],
        "discovery": [flow("status", "segment")],
        **{
            f"{name}_{denominator}": [traits(choices(i), x, denominator, order)]
            for denominator in ("rate", "lift")
            for name, i, x, order in (("part", 14, "wealth", WEALTH), ("who", 15, "priority", PRIORITY), ("when", 15, "year", None))
        },
        "skill_by_tenure": [crossed("wealth", "priority", kind, WEALTH, PRIORITY) for kind in ("heatmap", "line")],
        "tenure_by_skill": [crossed("priority", "wealth", "heatmap", PRIORITY, WEALTH)],
    },
    "workplace": {
        "uses": [single("agreed", order=["yes", "No"], min_percent=None)],
        "decides": [single("status", order=["O", "F"], min_percent=None)],
    },
    "rest": {
        "contribution": [multi(choices(14)), upset(choices(14), 25)],
        "incentives": [multi(choices(15))],
        "aims": [ranked(["priority", "status", "segment", "nation"], BANDS)],
        "objects": [ranked(["segment", "nation", "year", "priority"], BANDS)],
        "resources": [ranked(["year", "month", "wealth"])],
    },
}


def full_report() -> Report:
    return Report(2025, "Orders in full", [
        ReportSection(section, section.title(), [
            ReportRow(row_id, row_id, f"{row_id}?", [chart() for chart, _ in charts], commentary="")
            for row_id, charts in rows.items()
        ])
        for section, rows in SECTIONS.items()
    ])


_PARTS = " UNION ALL ".join(
    f"SELECT '{row_id}' AS row_id, {n} AS chart, series, i, label, value FROM ({sql})"
    for rows in SECTIONS.values() for row_id, charts in rows.items() for n, (_, sql) in enumerate(charts)
)


@query(
    "report_full",
    f"""
    WITH wide AS MATERIALIZED ({_WIDE})
    SELECT row_id, CAST(chart AS INTEGER) AS chart, CAST(series AS INTEGER) AS series, CAST(i AS INTEGER) AS i, label,
           CAST(value AS DOUBLE) AS value FROM ({_PARTS})
    """,
)
def full_document(spark, d):
    """All points that the 51 charts draw, read back from the document."""
    return drawn_points(parse_reports(build_report(wide(spark, d), full_report()), "document"))
