"""Chart frames over the metric queries."""

from pyspark.sql import functions as F

from tally.operators import (
    bar_series,
    dropped_note,
    heatmap_cells,
    heatmap_range,
    likert_segments,
    line_series,
    rank_stack,
    sankey_frame,
    set_combinations,
    set_totals,
    upset_combo_names,
    upset_connectors,
    upset_matrix,
    upset_set_names,
    upset_totals_axis,
)
from workload.counts import counts_single_combine, counts_single_plain
from workload.crosstabs import PAIRS_SQL, TRAITS_SQL, trait_table
from workload.flows import links_percent
from workload.ranks import BANDED_SQL, ranks_banded
from workload.registry import EVENT_TYPES, ORACLES, PICKS_SQL, query, table, tenths, visit_flags, visits
from workload.sets import COMBOS_SQL
from tally.operators import crosstab

CODES = {"click": "C", "error": "E", "view": "V"}
_CODE = "CASE {0} WHEN 'click' THEN 'C' WHEN 'error' THEN 'E' WHEN 'view' THEN 'V' ELSE {0} END"


@query(
    "bar_series",
    f"""
    SELECT (SELECT count(*) FROM ({ORACLES['counts_single_combine']})) - pos AS draw_pos, label,
           {tenths('percent')} AS value
    FROM ({ORACLES['counts_single_combine']})
    """,
)
def bars(spark, d):
    return bar_series(counts_single_combine(spark, d))


def order_table(spark, d):
    return crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", normalize="y")


@query(
    "heatmap_cells",
    f"""
    WITH {PAIRS_SQL}
    SELECT x_pos - 1 AS x_idx, y_pos - 1 AS y_idx, {tenths('n / yn * 100.0::DOUBLE')} AS value FROM cells
    """,
)
def heatmap(spark, d):
    return heatmap_cells(order_table(spark, d))


@query(
    "heatmap_range_percent",
    f"""
    WITH {PAIRS_SQL}
    SELECT greatest(0.0::DOUBLE, floor(min(n / yn * 100.0::DOUBLE) / 10) * 10) AS low,
           least(100.0::DOUBLE, ceil(max(n / yn * 100.0::DOUBLE) / 10) * 10) AS high
    FROM cells
    """,
)
def percent_range(spark, d):
    return heatmap_range(order_table(spark, d))


@query(
    "heatmap_range_lift",
    f"WITH {TRAITS_SQL} SELECT DISTINCT 0.0::DOUBLE AS low, 2.0::DOUBLE AS high FROM cells",
)
def lift_range(spark, d):
    return heatmap_range(trait_table(spark, d, "lift"))


@query(
    "likert_segments",
    f"""
    WITH bins AS ({ORACLES['counts_single_plain']})
    SELECT seg_pos, "group", s.label, coalesce({tenths('percent')}, 0.0::DOUBLE) AS percent
    FROM (VALUES (0, 'positive', '1-URGENT'), (1, 'positive', '2-HIGH'), (2, 'negative', '5-LOW'),
                 (3, 'negative', '6-NEVER'), (4, 'neutral', '3-MEDIUM')) s(seg_pos, "group", label)
    LEFT JOIN bins USING (label)
    """,
)
def likert(spark, d):
    return likert_segments(
        counts_single_plain(spark, d),
        positive=["1-URGENT", "2-HIGH"],
        negative=["5-LOW", "6-NEVER"],
        neutral=["3-MEDIUM"],
    )


@query(
    "line_series",
    f"""
    WITH {TRAITS_SQL}
    SELECT y_pos - 1 AS series_pos, y AS series, x_pos - 1 AS x_idx, x,
           {tenths('(n * total) / (yn * xn)')} AS value, '×' AS unit
    FROM cells
    """,
)
def lines(spark, d):
    return line_series(trait_table(spark, d, "lift"))


@query(
    "rank_stack",
    f"""
    WITH items AS ({BANDED_SQL})
    SELECT seg_pos - 1 AS seg_idx, segment, (SELECT max(item_pos) FROM items) - item_pos AS draw_pos,
           label, {tenths('percent')} AS percent
    FROM items
    """,
)
def stack(spark, d):
    return rank_stack(ranks_banded(spark, d))


def combos(spark, d):
    return set_combinations(visits(spark, d), visit_flags())


_TOP_SQL = f"""{COMBOS_SQL},
    top AS (SELECT string_split(members, '|') AS members, size,
                   row_number() OVER (ORDER BY size DESC, string_split(members, '|')) AS pos
            FROM sizes WHERE size >= 5 QUALIFY pos <= 20)
"""


@query(
    "upset_matrix",
    f"""
    WITH {_TOP_SQL}
    SELECT pos - 1 AS col, choice_pos AS row, choice AS set, list_contains(members, choice) AS filled
    FROM top CROSS JOIN choices
    """,
)
def matrix(spark, d):
    return upset_matrix(combos(spark, d), EVENT_TYPES)


@query(
    "upset_connectors",
    f"""
    WITH {_TOP_SQL}
    SELECT pos - 1 AS col, min(choice_pos) AS min_row, max(choice_pos) AS max_row
    FROM top JOIN choices ON list_contains(members, choice) GROUP BY 1 HAVING count(*) >= 2
    """,
)
def connectors(spark, d):
    return upset_connectors(combos(spark, d), EVENT_TYPES)


@query(
    "upset_combo_names",
    f"""
    WITH {_TOP_SQL}
    SELECT pos - 1 AS col, string_agg({_CODE.format('choice')}, ' · ' ORDER BY choice_pos)
           || ': ' || size AS name, size
    FROM top JOIN choices ON list_contains(members, choice) GROUP BY pos, size
    """,
)
def combo_names(spark, d):
    return upset_combo_names(combos(spark, d), CODES)


@query(
    "upset_set_names",
    f"""
    WITH {PICKS_SQL}
    SELECT choice_pos AS row, {_CODE.format('label')} AS code,
           {_CODE.format('label')} || ': ' || n AS name, n AS total
    FROM pick_counts
    """,
)
def set_names(spark, d):
    return upset_set_names(set_totals(visits(spark, d), visit_flags()), CODES)


@query(
    "upset_totals_axis",
    f"WITH {PICKS_SQL} SELECT CAST(floor(max(n) * 1.6::DOUBLE) AS BIGINT) + 1 AS axis_max FROM pick_counts",
)
def totals_axis(spark, d):
    return upset_totals_axis(set_totals(visits(spark, d), visit_flags()))


@query(
    "upset_dropped_note",
    f"""
    WITH {_TOP_SQL}
    SELECT pos, CASE WHEN (SELECT count(*) FROM sizes) > (SELECT count(*) FROM top)
           THEN ((SELECT count(*) FROM sizes) - (SELECT count(*) FROM top))
                || CASE WHEN (SELECT count(*) FROM sizes) - (SELECT count(*) FROM top) = 1
                   THEN ' combination is' ELSE ' combinations are' END
                || ' left out: fewer than 5 answers each, or past the last column of the chart.' END AS note
    FROM top
    """,
)
def note(spark, d):
    return combos(spark, d).select("pos", dropped_note(F.col("dropped")).alias("note"))


@query(
    "sankey_frame",
    f"SELECT link_pos, source, target, value FROM ({ORACLES['flow_links_percent']})",
)
def sankey(spark, d):
    return sankey_frame(links_percent(spark, d))
