"""Set combinations; member lists are shown as text."""

from pyspark.sql import functions as F

from tally.operators import combination_sizes, combinations_dropped, set_combinations
from workload.registry import PICKS_SQL, query, visit_flags, visits

COMBOS_SQL = f"""{PICKS_SQL},
    members AS (SELECT user_id, day, string_agg(choice, '|' ORDER BY choice) AS members
                FROM picks GROUP BY 1, 2),
    sizes AS (SELECT members, count(*) AS size FROM members GROUP BY 1)
"""


@query("combination_sizes", f"WITH {COMBOS_SQL} SELECT members, size FROM sizes")
def sizes(spark, d):
    found = combination_sizes(visits(spark, d), visit_flags())
    return found.select(F.array_join("members", "|").alias("members"), "size")


@query(
    "set_combinations",
    f"""
    WITH {COMBOS_SQL},
    top AS (SELECT members, size, row_number() OVER (ORDER BY size DESC, string_split(members, '|')) AS pos
            FROM sizes WHERE size >= 5)
    SELECT pos, members, size,
           (SELECT count(*) FROM sizes) - (SELECT count(*) FROM top WHERE pos <= 12) AS dropped
    FROM top WHERE pos <= 12
    """,
)
def combinations(spark, d):
    found = set_combinations(visits(spark, d), visit_flags(), max_combos=12)
    return found.select("pos", F.array_join("members", "|").alias("members"), "size", "dropped")


@query(
    "combinations_dropped",
    f"""
    WITH {COMBOS_SQL}
    SELECT least(count(*) FILTER (size >= 30), 12) AS shown,
           count(*) - least(count(*) FILTER (size >= 30), 12) AS dropped
    FROM sizes
    """,
)
def dropped(spark, d):
    return combinations_dropped(visits(spark, d), visit_flags(), min_size=30, max_combos=12)
