"""Rank distributions: a visit ranks its event types by first occurrence."""

from pyspark.sql import functions as F

from tally.operators import (
    RankCount,
    borda_scores,
    rank_distribution,
    rank_distribution_family,
    rank_distribution_long,
)
from workload.registry import EVENT_TYPES, VISITS_SQL, query, table, visits

BANDS = [(1, 1), (2, 3)]


def ranked_visits(spark, d):
    """Visits with columns ``rank_1..rank_5`` holding event types, nulls at the end."""
    firsts = F.array_sort(
        F.array_compact(
            F.array(
                *[
                    F.when(
                        F.col(f"first_{kind}").isNotNull(),
                        F.struct(F.col(f"first_{kind}").alias("id"), F.lit(kind).alias("kind")),
                    )
                    for kind in EVENT_TYPES
                ]
            )
        )
    )
    placed = visits(spark, d).select(firsts.alias("firsts"))
    return placed.select(
        *[F.get("firsts", F.lit(i))["kind"].alias(f"rank_{i + 1}") for i in range(len(EVENT_TYPES))]
    )


RANKS = [f"rank_{i}" for i in range(1, len(EVENT_TYPES) + 1)]

_PLACES = f"""
    WITH {VISITS_SQL},
    firsts AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type AS label, min(event_id) AS id
               FROM events GROUP BY 1, 2, 3),
    places AS (SELECT label, row_number() OVER (PARTITION BY user_id, day ORDER BY id) AS p FROM firsts)
"""


def _rank_sql(segments: list[tuple[str, int, int]], *, head: str = _PLACES) -> str:
    """Distribution over the given (name, low, high) segments."""
    size = len(segments)
    counters = ", ".join(
        f"count(*) FILTER (p BETWEEN {low} AND {high}) AS c{i}"
        for i, (_, low, high) in enumerate(segments)
    )
    score = " + ".join(f"c{i} * {size - i}" for i in range(size))
    shares = [f"c{i} / total * 100.0::DOUBLE" for i in range(size)]
    rest = f"100.0::DOUBLE - (0.0::DOUBLE + {' + '.join(shares)})"
    rest = f"CASE WHEN {rest} < 0 AND {rest} > -1e-9 THEN 0.0 ELSE {rest} END"
    names = ", ".join(f"'{name}'" for name, _, _ in segments) + ", 'Unranked'"
    counts = ", ".join(f"c{i}" for i in range(size))
    placed = " + ".join(f"c{i}" for i in range(size))
    return f"""{head},
    items AS (SELECT label, count(*) AS ranked, {counters},
                     (SELECT count(*) FROM visits) AS total
              FROM places GROUP BY 1 HAVING count(*) >= 5),
    scored AS (SELECT *, CAST({score} AS BIGINT) AS score FROM items),
    placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, label) AS item_pos FROM scored)
    SELECT item_pos, label, score,
           unnest({[i + 1 for i in range(size + 1)]}) AS seg_pos,
           unnest([{names}]) AS segment,
           unnest([{counts}, total - ({placed})]) AS count,
           unnest([{', '.join(shares)}, {rest}]) AS percent
    FROM placed
    """


PLAIN_SQL = _rank_sql([(f"#{i}", i, i) for i in range(1, 6)])
BANDED_SQL = _rank_sql([("1", 1, 1), ("2-3", 2, 3)])


@query("rank_distribution_plain", PLAIN_SQL)
def ranks_plain(spark, d):
    return rank_distribution(ranked_visits(spark, d), RANKS)


@query("rank_distribution_banded", BANDED_SQL)
def ranks_banded(spark, d):
    return rank_distribution(ranked_visits(spark, d), RANKS, bands=BANDS)


@query("rank_distribution_long", BANDED_SQL)
def ranks_from_placements(spark, d):
    wide = ranked_visits(spark, d)
    placements = wide.select(F.posexplode(F.array(*RANKS))).select(
        (F.col("pos") + 1).alias("position"), F.col("col").alias("choice")
    )
    total = wide.agg(F.count(F.lit(1))).scalar()
    return rank_distribution_long(placements, "position", "choice", total, 5, bands=BANDS)


@query(
    "rank_distribution_family",
    f"""
    SELECT 'plain' AS name, * FROM ({PLAIN_SQL})
    UNION ALL SELECT 'banded', * FROM ({BANDED_SQL})
    """,
)
def ranks_in_one_pass(spark, d):
    return rank_distribution_family(
        ranked_visits(spark, d), {"plain": RankCount(RANKS), "banded": RankCount(RANKS, BANDS)}
    )


@query("borda_scores", f"SELECT DISTINCT item_pos, label, score FROM ({BANDED_SQL})")
def scores(spark, d):
    return borda_scores(ranks_banded(spark, d))


_ANY_PLACES = """
    WITH visits AS (SELECT o_orderkey FROM orders),
    places AS (SELECT p_brand AS label, l_linenumber - 2 AS p
               FROM lineitem JOIN part ON p_partkey = l_partkey)
"""


@query("rank_distribution_long_any_position", _rank_sql([("#1", 1, 1), ("#2", 2, 2), ("#3", 3, 3)], head=_ANY_PLACES))
def ranks_at_any_position(spark, d):
    """Brands placed by line number less two: positions from -1 on, of which 1 to 3 are shown."""
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    lines = table(spark, d, "lineitem").join(parts, "l_partkey")
    total = table(spark, d, "orders").agg(F.count(F.lit(1))).scalar()
    return rank_distribution_long(lines, F.col("l_linenumber") - 2, "p_brand", total, 3)
