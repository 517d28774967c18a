"""Funnels and flows."""

from pyspark.sql import functions as F

from tally.functions import map_values_join
from tally.operators import (
    UPGRADE_STAGES,
    Flow,
    Stages,
    flow_links,
    flow_nodes,
    funnel_nodes,
    name_collisions,
    staged_funnel,
)
from tally.sources import Survey
from workload.registry import query, table, tenths

STAGES = Stages(
    nodes=("All", "Expedited", "Standard", "Unspecified", "Urgent", "High", "Medium", "Low"),
    paths={
        "1-URGENT": ("All", "Expedited", "Urgent"),
        "2-HIGH": ("All", "Expedited", "High"),
        "3-MEDIUM": ("All", "Standard", "Medium"),
        "4-NOT SPECIFIED": ("All", "Unspecified"),
        "5-LOW": ("All", "Standard", "Low"),
    },
)

STAGE_LINKS_SQL = """
    stage(value, link_order, source, target) AS (VALUES
        ('1-URGENT', 1, 'All', 'Expedited'), ('2-HIGH', 1, 'All', 'Expedited'),
        ('3-MEDIUM', 2, 'All', 'Standard'), ('5-LOW', 2, 'All', 'Standard'),
        ('4-NOT SPECIFIED', 3, 'All', 'Unspecified'),
        ('1-URGENT', 4, 'Expedited', 'Urgent'), ('2-HIGH', 5, 'Expedited', 'High'),
        ('3-MEDIUM', 6, 'Standard', 'Medium'), ('5-LOW', 7, 'Standard', 'Low')),
    links AS (SELECT link_order, source, target, count(*) AS n,
                     (SELECT count(*) FROM orders) AS total
              FROM orders JOIN stage ON o_orderpriority = value GROUP BY 1, 2, 3)
"""


def _funnel_sql(value: str) -> str:
    return f"""
    WITH {STAGE_LINKS_SQL}
    SELECT CAST(row_number() OVER (ORDER BY link_order) AS INTEGER) AS link_pos, source, target,
           n AS count, CAST({value} AS DOUBLE) AS value
    FROM links WHERE n >= 5
    """


@query("staged_funnel", _funnel_sql("n"))
def funnel(spark, d):
    return staged_funnel(table(spark, d, "orders"), "o_orderpriority", STAGES)


@query("staged_funnel_percent", _funnel_sql(tenths("n / total * 100.0::DOUBLE")))
def funnel_percent(spark, d):
    return staged_funnel(table(spark, d, "orders"), "o_orderpriority", STAGES, as_percent=True)


@query(
    "funnel_nodes",
    f"""
    WITH {STAGE_LINKS_SQL},
    used AS (SELECT source AS node FROM links WHERE n >= 5
             UNION SELECT target FROM links WHERE n >= 5)
    SELECT CAST(row_number() OVER (ORDER BY list_position(['All', 'Expedited', 'Standard',
               'Unspecified', 'Urgent', 'High', 'Medium', 'Low'], node)) AS INTEGER) AS node_pos, node
    FROM used
    """,
)
def nodes_of_funnel(spark, d):
    return funnel_nodes(funnel(spark, d), STAGES)


X_MAP = {"1-URGENT": "Expedited", "2-HIGH": "Expedited", "3-MEDIUM": "Standard"}
Y_MAP = {"F": "Filled", "P": "Pending", "O": "Pending"}
FLOW = {"id": "o_orderkey", "x_map": X_MAP, "y_map": Y_MAP, "exclude": ["5-LOW"]}

PAIRS_SQL = """
    mapped AS (
        SELECT o_orderkey AS id,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Expedited'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'Standard' ELSE o_orderpriority END AS x,
               CASE WHEN o_orderstatus = 'F' THEN 'Filled' ELSE 'Pending' END AS y
        FROM orders WHERE o_orderpriority <> '5-LOW'),
    pairs AS (SELECT x, y, count(*) AS n, (SELECT count(*) FROM mapped) AS total
              FROM mapped GROUP BY 1, 2 HAVING count(*) >= 5),
    xf AS (SELECT x, min(id) AS x_first FROM mapped GROUP BY 1),
    yf AS (SELECT y, min(id) AS y_first FROM mapped GROUP BY 1)
"""


def _flow_sql(value: str) -> str:
    return f"""
    WITH {PAIRS_SQL}
    SELECT row_number() OVER (ORDER BY x_first, y_first) AS link_pos, x AS source, y AS target,
           n AS count, CAST({value} AS DOUBLE) AS value
    FROM pairs JOIN xf USING (x) JOIN yf USING (y)
    """


@query("flow_links", _flow_sql("n"))
def links(spark, d):
    return flow_links(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", **FLOW)


@query("flow_links_percent", _flow_sql(tenths("n / total * 100.0::DOUBLE")))
def links_percent(spark, d):
    orders = table(spark, d, "orders")
    return flow_links(orders, "o_orderpriority", "o_orderstatus", as_percent=True, **FLOW)


@query(
    "flow_nodes",
    f"""
    WITH {PAIRS_SQL},
    ends AS (SELECT DISTINCT 0 AS side_no, x AS node, x_first AS first FROM pairs JOIN xf USING (x)
             UNION SELECT DISTINCT 1, y, y_first FROM pairs JOIN yf USING (y))
    SELECT row_number() OVER (ORDER BY side_no, first) AS node_pos, node,
           CASE WHEN side_no = 0 THEN 'x' ELSE 'y' END AS side
    FROM ends
    """,
)
def nodes_of_flow(spark, d):
    return flow_nodes(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", **FLOW)


@query(
    "flow_links_many_labels",
    """
    WITH pairs AS (SELECT 'part ' || l_partkey AS x, 'supplier ' || l_suppkey AS y, count(*) AS n,
                          min(l_orderkey * 10000 + l_linenumber * 1000
                              + CAST(l_quantity AS BIGINT)) AS first
                   FROM lineitem GROUP BY 1, 2),
    xf AS (SELECT x, min(first) AS x_first FROM pairs GROUP BY 1),
    yf AS (SELECT y, min(first) AS y_first FROM pairs GROUP BY 1)
    SELECT row_number() OVER (ORDER BY x_first, x, y_first, y) AS link_pos, x AS source, y AS target,
           n AS count, CAST(n AS DOUBLE) AS value
    FROM pairs JOIN xf USING (x) JOIN yf USING (y) WHERE n >= 2
    """,
)
def links_between_many_labels(spark, d):
    lines = table(spark, d, "lineitem").select(
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("part"),
        F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("supplier"),
        (
            F.col("l_orderkey") * 10000
            + F.col("l_linenumber") * 1000
            + F.col("l_quantity").cast("bigint")
        ).alias("id"),
    )
    return flow_links(lines, "part", "supplier", id="id", min_count=2)


@query(
    "name_collisions",
    """
    SELECT DISTINCT c_mktsegment AS name FROM customer
    INTERSECT
    SELECT DISTINCT CASE WHEN c_nationkey < 5 THEN 'BUILDING' ELSE 'Nation ' || c_nationkey END
    FROM customer
    """,
)
def collisions(spark, d):
    nation = F.when(F.col("c_nationkey") < 5, F.lit("BUILDING")).otherwise(
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"))
    )
    return name_collisions(table(spark, d, "customer"), Flow("c_mktsegment", nation, "c_custkey"))


UPGRADES = list(UPGRADE_STAGES.paths)
_ANSWER_SQL = f"""
    SELECT CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'Skipped' ELSE
           {UPGRADES!r}[1 + (o_custkey + o_orderkey) % {len(UPGRADES)}] END AS answer FROM orders
"""


@query(
    "staged_funnel_upgrades",
    f"""
    WITH answers AS ({_ANSWER_SQL}),
    steps(link_pos, source, target, first, last) AS (VALUES
        (1, 'All', 'Knew', 2, 7), (2, 'All', 'Didn''t know', 1, 1), (3, 'Knew', 'Upgraded', 3, 7),
        (4, 'Knew', 'Did not upgrade', 2, 2), (5, 'Upgraded', 'No issues', 3, 3), (6, 'Upgraded', 'Minor', 4, 4),
        (7, 'Upgraded', 'Moderate', 5, 5), (8, 'Upgraded', 'Severe (resolved)', 6, 6),
        (9, 'Upgraded', 'Severe (stuck)', 7, 7))
    SELECT CAST(row_number() OVER (ORDER BY link_pos) AS INTEGER) AS link_pos, source, target, n AS count,
           CAST(n AS DOUBLE) AS value
    FROM (SELECT link_pos, source, target, count(answer) AS n FROM steps JOIN answers
          ON list_position({UPGRADES!r}, answer) BETWEEN first AND last GROUP BY 1, 2, 3)
    WHERE n >= 5
    """,
)
def funnel_of_upgrades(spark, d):
    """The default stages, over orders as answers."""
    options = F.array(*[F.lit(a) for a in UPGRADES])
    answer = F.when(
        (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F"), F.lit("Skipped")
    ).otherwise(F.get(options, ((F.col("o_custkey") + F.col("o_orderkey")) % len(UPGRADES)).cast("int")))
    return staged_funnel(table(spark, d, "orders"), answer)


def _flow_sql(pairs: str) -> str:
    return f"""
    WITH pairs AS ({pairs}),
    xf AS (SELECT x, min(first) AS x_first FROM pairs GROUP BY 1),
    yf AS (SELECT y, min(first) AS y_first FROM pairs GROUP BY 1)
    SELECT row_number() OVER (ORDER BY x_first, x, y_first, y) AS link_pos, x AS source, y AS target,
           n AS count, CAST(n AS DOUBLE) AS value
    FROM pairs JOIN xf USING (x) JOIN yf USING (y) WHERE n >= 5
    """


@query(
    "flow_links_large_map",
    _flow_sql("""
        SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'supplier ' || l_suppkey ELSE 'band ' || l_suppkey % 7 END AS x,
               l_returnflag AS y, count(*) AS n, min(l_orderkey) AS first FROM lineitem GROUP BY 1, 2
    """),
)
def links_with_a_large_map(spark, d):
    """Labels grouped by a mapping with an entry for each supplier but every third."""
    supplier = F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))
    bands = table(spark, d, "supplier").where("s_suppkey % 3 <> 0").select(
        F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string")).alias("key"),
        F.concat(F.lit("band "), (F.col("s_suppkey") % 7).cast("string")).alias("band"),
    )
    lines = table(spark, d, "lineitem").select(supplier.alias("supplier"), "l_returnflag", "l_orderkey")
    banded = map_values_join(lines, "supplier", bands, key="key", label="band")
    return flow_links(banded, "supplier", "l_returnflag", id="l_orderkey")


@query(
    "flow_links_numeric_order",
    _flow_sql("""
        SELECT 'segment ' || c_mktsegment AS x, 'nation ' || c_nationkey AS y, count(*) AS n, min(c_custkey) AS first
        FROM customer GROUP BY 1, 2
    """),
)
def links_in_order_of_arrival(spark, d):
    """Respondents whose ids came as text: 9 arrived before 10."""
    wide = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("f0"),
        F.concat(F.lit("segment "), "c_mktsegment").alias("f1"),
        F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")).alias("f2"),
    )
    bindings = {
        "segment": {"type": "single", "prompt": "Segment?", "fields": 1},
        "nation": {"type": "single", "prompt": "Nation?", "fields": 2},
    }
    survey = Survey(wide.withColumn("respondent_id", F.col("f0").cast("bigint")), bindings)
    return flow_links(survey.frame, survey.segment, survey.nation, id="respondent_id")
