"""Cross-tabulations."""

from pyspark.sql import functions as F

from tally.operators import CrossTab, crosstab, crosstab_family, crosstab_multi
from workload.registry import query, table

FLAGS = ("A", "N", "R")

PAIRS_SQL = """
    pairs AS (SELECT o_orderpriority AS x, o_orderstatus AS y, count(*) AS n FROM orders GROUP BY 1, 2),
    xs AS (SELECT x, sum(n) AS xn, row_number() OVER (ORDER BY sum(n) DESC, x) AS x_pos FROM pairs GROUP BY 1),
    ys AS (SELECT y, sum(n) AS yn, row_number() OVER (ORDER BY sum(n) DESC, y) AS y_pos FROM pairs GROUP BY 1),
    cells AS (SELECT x_pos, xs.x, y_pos, ys.y, coalesce(n, 0) AS n, xn, yn,
                     (SELECT count(*) FROM orders) AS total
              FROM xs CROSS JOIN ys LEFT JOIN pairs USING (x, y))
"""


def _cells_sql(base: str) -> str:
    return f"""
    WITH {PAIRS_SQL}
    SELECT x_pos, x, y_pos, y, n AS count, n / {base} * 100.0::DOUBLE AS value,
           'rate_pct' AS cell_kind
    FROM cells
    """


def _register(normalize: str, base: str) -> None:
    @query(f"crosstab_{normalize}", _cells_sql(base))
    def run(spark, d):
        orders = table(spark, d, "orders")
        return crosstab(orders, "o_orderpriority", "o_orderstatus", normalize=normalize)


for _normalize, _base in (("global", "total"), ("x", "xn"), ("y", "yn")):
    _register(_normalize, _base)


@query(
    "crosstab_ordered_excluded",
    """
    WITH kept AS (SELECT p_type AS x, p_brand AS y FROM part
                  WHERE p_type NOT IN ('PROMO') AND p_brand NOT IN ('Brand#1', 'Brand#2')),
    pairs AS (SELECT x, y, count(*) AS n FROM kept GROUP BY 1, 2),
    xs AS (SELECT x, sum(n) AS xn, row_number() OVER (ORDER BY
               coalesce(list_position(['SMALL', 'HUGE', 'LARGE'], x), 99), sum(n) DESC, x) AS x_pos
           FROM pairs GROUP BY 1),
    ys AS (SELECT y, row_number() OVER (ORDER BY
               coalesce(list_position(['Brand#9', 'Brand#3'], y), 99), sum(n) DESC, y) AS y_pos
           FROM pairs GROUP BY 1)
    SELECT x_pos, xs.x, y_pos, ys.y, coalesce(n, 0) AS count,
           coalesce(n, 0) / xn * 100.0::DOUBLE AS value, 'rate_pct' AS cell_kind
    FROM xs CROSS JOIN ys LEFT JOIN pairs USING (x, y)
    """,
)
def crosstab_ordered_excluded(spark, d):
    return crosstab(
        table(spark, d, "part"),
        "p_type",
        "p_brand",
        normalize="x",
        x_order=["SMALL", "HUGE", "LARGE"],
        y_order=["Brand#9", "Brand#3"],
        x_exclude=["PROMO"],
        y_exclude=["Brand#1", "Brand#2"],
    )


@query(
    "crosstab_family",
    f"""
    WITH {PAIRS_SQL}
    SELECT 'by_priority' AS name, x_pos, x, y_pos, y, n AS count,
           n / xn * 100.0::DOUBLE AS value, 'rate_pct' AS cell_kind FROM cells
    UNION ALL
    SELECT 'by_status', y_pos, y, x_pos, x, n, n / xn * 100.0::DOUBLE, 'rate_pct' FROM cells
    """,
)
def crosstabs_in_one_pass(spark, d):
    return crosstab_family(
        table(spark, d, "orders"),
        {
            "by_priority": CrossTab("o_orderpriority", "o_orderstatus", "x"),
            "by_status": CrossTab("o_orderstatus", "o_orderpriority", "y"),
        },
    )


def orders_with_traits(spark, d):
    """Orders with one flag per return flag among their lines; lineless orders stay."""
    lines = table(spark, d, "lineitem")
    flags = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        *[F.bool_or(F.col("l_returnflag") == flag).alias(flag) for flag in FLAGS]
    )
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return orders.join(flags, "o_orderkey", "left")


def traits() -> dict:
    return {flag: F.coalesce(F.col(flag), F.lit(False)) for flag in FLAGS}


TRAITS_SQL = """
    flags AS (SELECT DISTINCT l_orderkey, l_returnflag AS y FROM lineitem),
    kept AS (SELECT o_orderkey, o_orderpriority AS x FROM orders WHERE o_orderpriority <> '5-LOW'),
    xs AS (SELECT x, count(*) AS xn, row_number() OVER (ORDER BY
               coalesce(list_position(['3-MEDIUM', '1-URGENT'], x), 99), count(*) DESC, x) AS x_pos
           FROM kept GROUP BY 1),
    pairs AS (SELECT x, y, count(*) AS n FROM kept JOIN flags ON l_orderkey = o_orderkey GROUP BY 1, 2),
    ys AS (SELECT y, CAST(row_number() OVER (ORDER BY y) AS INTEGER) AS y_pos, sum(n) AS yn
           FROM pairs GROUP BY 1),
    cells AS (SELECT x_pos, xs.x, y_pos, ys.y, coalesce(n, 0) AS n, xn, CAST(yn AS BIGINT) AS yn,
                     (SELECT count(*) FROM kept) AS total
              FROM xs CROSS JOIN ys LEFT JOIN pairs USING (x, y))
"""


def trait_table(spark, d, denominator):
    return crosstab_multi(
        orders_with_traits(spark, d),
        traits(),
        "o_orderpriority",
        denominator=denominator,
        x_order=["3-MEDIUM", "1-URGENT"],
        x_exclude=["5-LOW"],
    )


def _register_multi(denominator: str, kind: str, value: str) -> None:
    sql = f"""
    WITH {TRAITS_SQL}
    SELECT x_pos, x, y_pos, y, n AS count, {value} AS value, '{kind}' AS cell_kind FROM cells
    """

    @query(f"crosstab_multi_{denominator}", sql)
    def run(spark, d):
        return trait_table(spark, d, denominator)


_register_multi("rate", "rate_pct", "n / xn * 100.0::DOUBLE")
_register_multi("composition", "composition_pct", "n / yn * 100.0::DOUBLE")
_register_multi("lift", "lift", "(n * total) / (yn * xn)")


@query(
    "crosstab_many_labels",
    """
    WITH pairs AS (SELECT CAST(l_partkey AS VARCHAR) AS x, CAST(l_suppkey AS VARCHAR) AS y, count(*) AS n
                   FROM lineitem GROUP BY 1, 2),
    xs AS (SELECT x, sum(n) AS xn, row_number() OVER (ORDER BY sum(n) DESC, x) AS x_pos FROM pairs GROUP BY 1),
    ys AS (SELECT y, row_number() OVER (ORDER BY sum(n) DESC, y) AS y_pos FROM pairs GROUP BY 1)
    SELECT x_pos, x, y_pos, y, n AS count, n / xn * 100.0::DOUBLE AS value, 'rate_pct' AS cell_kind
    FROM pairs JOIN xs USING (x) JOIN ys USING (y)
    """,
)
def crosstab_of_many_labels(spark, d):
    return crosstab(table(spark, d, "lineitem"), "l_partkey", "l_suppkey", normalize="x", dense=False)
