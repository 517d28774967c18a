"""Single- and multi-select counts with suppression."""

from pyspark.sql import functions as F

from tally.operators import (
    MultiCount,
    SingleCount,
    counts_multi,
    counts_multi_family,
    counts_multi_long,
    counts_single,
    counts_single_family,
    flags_from_long,
    set_totals,
)
from workload.registry import EVENT_TYPES, PICKS_SQL, query, table, visit_flags, visits

OFF = {"min_percent": None, "min_count": None}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query(
    "counts_single_plain",
    """
    SELECT row_number() OVER (ORDER BY n DESC, label) AS pos, label, n AS count,
           n / sum(n) OVER () * 100.0::DOUBLE AS percent
    FROM (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1)
    """,
)
def counts_single_plain(spark, d):
    return counts_single(table(spark, d, "orders"), "o_orderpriority", **OFF)


_BRANDS = """
    WITH c AS (SELECT p_brand AS label, count(*) AS n FROM part GROUP BY 1),
    t AS (SELECT label, n, (SELECT count(*) FROM part) AS total,
                 n / (SELECT count(*) FROM part) * 100.0::DOUBLE < 4.0 OR n < 5 AS rare FROM c)
"""


@query(
    "counts_single_combine",
    _BRANDS
    + """,
    b AS (SELECT label, n, total FROM t WHERE NOT rare
          UNION ALL
          SELECT 'Other (combined)', CAST(sum(n) AS BIGINT), max(total) FROM t WHERE rare
          HAVING count(*) > 0)
    SELECT row_number() OVER (ORDER BY n DESC, label) AS pos, label, n AS count,
           n / total * 100.0::DOUBLE AS percent
    FROM b
    """,
)
def counts_single_combine(spark, d):
    return counts_single(table(spark, d, "part"), "p_brand", min_percent=4.0)


@query(
    "counts_single_drop",
    _BRANDS
    + """
    SELECT row_number() OVER (ORDER BY n DESC, label) AS pos, label, n AS count,
           n / total * 100.0::DOUBLE AS percent
    FROM t WHERE NOT rare
    """,
)
def counts_single_drop(spark, d):
    return counts_single(table(spark, d, "part"), "p_brand", min_percent=4.0, action="drop")


@query(
    "counts_single_ordinal_exclude",
    """
    SELECT row_number() OVER (ORDER BY coalesce(list_position(
               ['4-NOT SPECIFIED', '2-HIGH', '3-MEDIUM'], label), 99), n DESC, label) AS pos,
           label, n AS count, n / sum(n) OVER () * 100.0::DOUBLE AS percent
    FROM (SELECT o_orderpriority AS label, count(*) AS n FROM orders
          WHERE o_orderpriority <> '5-LOW' GROUP BY 1)
    """,
)
def counts_single_ordinal_exclude(spark, d):
    return counts_single(
        table(spark, d, "orders"),
        "o_orderpriority",
        order=["4-NOT SPECIFIED", "2-HIGH", "3-MEDIUM"],
        exclude=["5-LOW"],
        **OFF,
    )


@query(
    "counts_single_many_labels",
    """
    SELECT row_number() OVER (ORDER BY n DESC, label) AS pos, label, n AS count,
           n / sum(n) OVER () * 100.0::DOUBLE AS percent
    FROM (SELECT CAST(l_partkey AS VARCHAR) AS label, count(*) AS n FROM lineitem GROUP BY 1)
    """,
)
def counts_single_many_labels(spark, d):
    return counts_single(table(spark, d, "lineitem"), "l_partkey", **OFF)


@query(
    "counts_single_family",
    """
    WITH answers AS (
        SELECT 'priority' AS name, o_orderpriority AS label FROM orders
        WHERE o_orderpriority <> '5-LOW'
        UNION ALL SELECT 'status', o_orderstatus FROM orders
        UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR) FROM orders
    ),
    c AS (SELECT name, label, count(*) AS n FROM answers GROUP BY 1, 2),
    t AS (SELECT *, sum(n) OVER (PARTITION BY name) AS total FROM c),
    f AS (SELECT *, name = 'year' AND n / total * 100.0::DOUBLE < 12.0 AS rare FROM t),
    b AS (SELECT name, label, n, total FROM f WHERE NOT rare
          UNION ALL
          SELECT name, 'Other (combined)', CAST(sum(n) AS BIGINT), max(total) FROM f
          WHERE rare GROUP BY 1)
    SELECT name, row_number() OVER (PARTITION BY name ORDER BY
               CASE WHEN name = 'status' THEN coalesce(list_position(['P', 'F'], label), 99) END,
               n DESC, label) AS pos,
           label, n AS count, n / total * 100.0::DOUBLE AS percent
    FROM b
    """,
)
def counts_single_in_one_pass(spark, d):
    return counts_single_family(
        table(spark, d, "orders"),
        {
            "priority": SingleCount("o_orderpriority", exclude=["5-LOW"], **OFF),
            "status": SingleCount("o_orderstatus", order=["P", "F"], **OFF),
            "year": SingleCount(F.year("o_orderdate"), min_percent=12.0),
        },
    )


_MULTI = """
    SELECT CAST(row_number() OVER (ORDER BY late, n DESC, choice_pos) AS INTEGER) AS pos,
           label, n AS count, percent
    FROM b
"""
_SHARES = f"""
    WITH {PICKS_SQL},
    s AS (SELECT *, n / total * 100.0::DOUBLE AS percent FROM pick_counts)
"""
_FLOORED = (
    _SHARES
    + """,
    f AS (SELECT *, percent < 40.1 OR n < 5 AS rare FROM s)
    """
)


@query(
    "counts_multi_plain",
    _SHARES + ", b AS (SELECT *, 0 AS late FROM s)" + _MULTI,
)
def counts_multi_plain(spark, d):
    return counts_multi(visits(spark, d), visit_flags(), **OFF)


@query(
    "counts_multi_combine",
    _FLOORED
    + """,
    b AS (SELECT 0 AS late, choice_pos, label, n, percent FROM f WHERE NOT rare
          UNION ALL
          SELECT 1, 0, 'Other (combined)', CAST(sum(n) AS BIGINT),
                 list_reduce(list_prepend(0.0::DOUBLE,
                     list(percent ORDER BY n DESC, choice_pos)), lambda a, p : a + p)
          FROM f WHERE rare HAVING count(*) > 0)
    """
    + _MULTI,
)
def counts_multi_combine(spark, d):
    return counts_multi(visits(spark, d), visit_flags(), min_percent=40.1)


@query(
    "counts_multi_drop",
    _FLOORED + ", b AS (SELECT *, 0 AS late FROM f WHERE NOT rare)" + _MULTI,
)
def counts_multi_drop(spark, d):
    return counts_multi(visits(spark, d), visit_flags(), min_percent=40.1, action="drop")


def picks(spark, d):
    """One row per visit and event type."""
    events = table(spark, d, "events")
    return events.select("user_id", F.to_date("ts").alias("day"), "event_type").distinct()


def visit_count(spark, d):
    return visits(spark, d).agg(F.count(F.lit(1))).scalar()


@query(
    "counts_multi_long",
    f"""
    WITH {PICKS_SQL}
    SELECT CAST(row_number() OVER (ORDER BY n DESC, choice_pos) AS INTEGER) AS pos,
           label, n AS count, n / total * 100.0::DOUBLE AS percent
    FROM pick_counts
    """,
)
def counts_multi_from_picks(spark, d):
    return counts_multi_long(picks(spark, d), "event_type", EVENT_TYPES, visit_count(spark, d), **OFF)


@query(
    "counts_multi_long_all_picks",
    f"""
    WITH {PICKS_SQL}
    SELECT row_number() OVER (ORDER BY n DESC, label) AS pos, label, n AS count,
           n / total * 100.0::DOUBLE AS percent
    FROM pick_counts
    """,
)
def counts_multi_of_all_picks(spark, d):
    return counts_multi_long(picks(spark, d), "event_type", None, visit_count(spark, d), **OFF)


@query(
    "counts_multi_family",
    """
    WITH c AS (
        SELECT 'flag' AS name, * FROM (
            SELECT unnest(['A', 'N', 'R']) AS label, unnest([0, 1, 2]) AS choice_pos,
                   unnest([count(*) FILTER (l_returnflag = 'A'),
                           count(*) FILTER (l_returnflag = 'N'),
                           count(*) FILTER (l_returnflag = 'R')]) AS n,
                   count(*) AS total FROM lineitem)
        UNION ALL
        SELECT 'deal', * FROM (
            SELECT unnest(['bulk', 'cheap', 'untaxed']), unnest([0, 1, 2]),
                   unnest([count(*) FILTER (l_quantity >= 25), count(*) FILTER (l_discount >= 0.05),
                           count(*) FILTER (l_tax = 0)]), count(*) FROM lineitem))
    SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY n DESC, choice_pos) AS INTEGER)
               AS pos, label, n AS count, n / total * 100.0::DOUBLE AS percent
    FROM c
    """,
)
def counts_multi_in_one_pass(spark, d):
    flags = {flag: F.col("l_returnflag") == flag for flag in "ANR"}
    deals = {
        "bulk": F.col("l_quantity") >= 25,
        "cheap": F.col("l_discount") >= 0.05,
        "untaxed": F.col("l_tax") == 0,
    }
    return counts_multi_family(
        table(spark, d, "lineitem"),
        {"flag": MultiCount(flags, **OFF), "deal": MultiCount(deals, **OFF)},
    )


@query(
    "set_totals",
    f"""
    WITH {PICKS_SQL}
    SELECT CAST(choice_pos + 1 AS INTEGER) AS pos, label, n AS count FROM pick_counts
    """,
)
def totals_per_set(spark, d):
    return set_totals(visits(spark, d), visit_flags())


@query(
    "flags_from_long",
    """
    SELECT user_id, bool_or(event_type = 'click') AS pick_0, bool_or(event_type = 'error') AS pick_1,
           bool_or(event_type = 'purchase') AS pick_2, bool_or(event_type = 'signup') AS pick_3,
           bool_or(event_type = 'view') AS pick_4
    FROM events GROUP BY 1
    """,
)
def picks_to_flags(spark, d):
    return flags_from_long(table(spark, d, "events"), ["user_id"], "event_type", EVENT_TYPES)[0]
