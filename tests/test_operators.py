"""Hand-computed cases per operator."""

import pytest
from pyspark.sql import functions as F

from tally.functions import (
    clean_single,
    first_semver,
    map_values,
    map_values_join,
    round_tenths,
    yes_no,
)
from tally.operators import (
    UPGRADE_STAGES,
    COMBINED_LABEL,
    CrossTab,
    Flow,
    MultiCount,
    RankCount,
    SingleCount,
    Stages,
    borda_scores,
    combination_sizes,
    combinations_dropped,
    counts_multi,
    counts_multi_family,
    counts_multi_long,
    counts_single,
    counts_single_family,
    crosstab,
    crosstab_family,
    crosstab_multi,
    flags_from_long,
    flow_links,
    flow_nodes,
    funnel_nodes,
    name_collisions,
    rank_distribution,
    rank_distribution_family,
    rank_distribution_long,
    set_combinations,
    set_totals,
    staged_funnel,
    totals_of_sizes,
    with_position,
)

OFF = {"min_percent": None, "min_count": None}


def bins(df):
    return [(r.label, r["count"], r.percent) for r in df.orderBy("pos").collect()]


def labels(df):
    return [label for label, _, _ in bins(df)]


# --- cleaning ----------------------------------------------------------------


def test_clean_single(frame):
    df = frame(v=["plum jam", "\tplum jam ", "   ", None, "", "\r\n"])
    got = [r[0] for r in df.orderBy("id").select(clean_single(F.col("v"))).collect()]
    assert got == ["plum jam"] * 2 + ["Skipped"] * 4


def test_yes_no(frame):
    words = ["Y", " yeah", "YES!", "nah ", "No :(", "N", "yessir", "0", "\t", None, "skipped"]
    df = frame(v=words)
    got = [r[0] for r in df.orderBy("id").select(yes_no(F.col("v"))).collect()]
    assert got == ["Yes"] * 3 + ["No"] * 3 + ["Other"] * 2 + ["Skipped"] * 2 + ["Other"]
    known = df.orderBy("id").select(yes_no(F.col("v"), skipped_label="SKIPPED")).collect()
    assert known[10][0] == "Skipped"


def test_yes_no_custom_aliases_replace_defaults(frame):
    df = frame(v=["tak", "nie", "yes", "no"])
    column = yes_no(F.col("v"), yes_aliases=["tak"], no_aliases=["nie"])
    assert [r[0] for r in df.orderBy("id").select(column).collect()] == ["Yes", "No", "Other", "Other"]


@pytest.mark.parametrize(
    "text, version",
    [
        ("0.0.7", "0.0.7"),
        ("\t40.1.902\n", "40.1.902"),
        ("jam-6.0.11rc", "6.0.11"),
        ("was 5.5.5, is 5.5.6", "5.5.5"),
        ("9.8.7.6.5", "9.8.7"),
        ("3.04.1", "No Match"),
        ("003.4.1 then 3.4.10", "3.4.10"),
        ("1.2 and 3.4", "No Match"),
        ("newest", "No Match"),
        (" ", "Skipped"),
        (None, "Skipped"),
        ("Skipped", "Skipped"),
    ],
)
def test_first_semver(frame, text, version):
    assert frame(v=[text]).select(first_semver(F.col("v"))).first()[0] == version


def test_round_tenths_follows_the_stored_value(spark):
    values = [0.25, 0.35, 1.05, 6.25, 0.75, 2.5, 99.95, 0.05, 0.15, 12.345, 100.0, 0.0, -0.25, 45.45]
    values += [c / 7 * 100 for c in range(60)] + [c / 800 * 100 for c in range(200)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select("v", round_tenths(F.col("v")).alias("r")).collect()
    assert [r.r for r in got] == [round(r.v, 1) for r in got]


def test_map_values_join(frame, spark):
    mapping = spark.createDataFrame([("a", "A+"), ("b", "A+")], "k string, g string")
    df = map_values_join(frame(v=["a", "b", "c"]), "v", mapping, key="k", label="g")
    assert [r.v for r in df.orderBy("id").collect()] == ["A+", "A+", "c"]


# --- positions -----------------------------------------------------------------


def test_positions_in_parallel_equal_one_window(spark):
    df = spark.range(5000).select(
        F.col("id"),
        (F.col("id") % 3).alias("g"),
        # One value holds a third of the rows; ties are settled by id.
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 400).alias("k"),
    )
    many = with_position(df, ["k", "id"], by=["g"])
    one = with_position(df, ["k", "id"], by=["g"], few=True)
    assert many.exceptAll(one).count() == 0
    flat = with_position(df.drop("g"), ["k", "id"])
    assert flat.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()[0:] == (1, 5000, 5000)
    wrong = flat.withColumnRenamed("pos", "p1").join(
        with_position(df.drop("g"), ["k", "id"], few=True), ["k", "id"]
    )
    assert wrong.filter("p1 <> pos").count() == 0


@pytest.mark.parametrize("size", [0, 1, 40, 3000])
def test_positions_take_one_path_at_any_size(spark, size):
    """Long texts with a common start, nulls and an extra column."""
    start = F.when(F.col("id") % 7 == 0, F.lit("x" * 40)).otherwise(F.lit(""))
    df = spark.range(size).select(
        F.when(F.col("id") % 11 != 0, F.concat(start, F.col("id").cast("string"))).alias("k"), "id", F.lit(1.5).alias("v")
    )
    placed = with_position(df, ["k", "id"])
    rows = placed.orderBy("pos").collect()
    assert [r.pos for r in rows] == list(range(1, size + 1)) and placed.count() == size
    assert [r.id for r in rows] == [r.id for r in df.orderBy("k", "id").collect()]
    assert "functions=[partial" in placed._jdf.queryExecution().executedPlan().toString()


def test_maps_of_any_size(frame):
    words = [f"w{i}" for i in range(300)]
    df = frame(v=[*words, "other", None])
    for size in (1, 8, 9, 64, 65, 300):
        grouped = df.orderBy("id").select(map_values(F.col("v"), {w: w.upper() for w in words[:size]})).collect()
        assert [r[0] for r in grouped] == [w.upper() for w in words[:size]] + words[size:] + ["other", None]


# --- single counts ---------------------------------------------------------------


def test_single_basic_and_ties(frame):
    df = frame(v=["b", "a", "c", "c", "b", "a", "c", "d"])
    assert bins(counts_single(df, "v", **OFF)) == [
        ("c", 3, 37.5), ("a", 2, 25.0), ("b", 2, 25.0), ("d", 1, 12.5),
    ]


def test_single_order_and_exclude(frame):
    df = frame(v=["x", "low", "high", "Skipped", "low", "y", None])
    got = counts_single(df, "v", order=["high", "low"], exclude=["Skipped"], **OFF)
    assert bins(got) == [("high", 1, 20.0), ("low", 2, 40.0), ("x", 1, 20.0), ("y", 1, 20.0)]


def test_single_repeated_order_is_rejected(frame):
    with pytest.raises(ValueError, match="more than once"):
        counts_single(frame(v=["a"]), "v", order=["a", "b", "a"])


@pytest.mark.parametrize(
    "counts, options, expected",
    [
        ({"oak": 61, "ash": 2, "elm": 1}, {"min_percent": 4.0}, [("oak", 61), (COMBINED_LABEL, 3)]),
        ({"oak": 61, "ash": 3, "elm": 1}, {"min_percent": None, "min_count": 3}, [("oak", 61), ("ash", 3), (COMBINED_LABEL, 1)]),
        ({"oak": 40, "ash": 9, "elm": 1}, {"min_percent": 10.0, "min_count": 11}, [("oak", 40), (COMBINED_LABEL, 10)]),
        ({"oak": 40, "ash": 4, "elm": 4}, {"min_percent": None, "action": "drop"}, [("oak", 40)]),
        ({"Other": 20, "fir": 20, "yew": 1}, {"min_percent": 7.0}, [("Other", 20), ("fir", 20), (COMBINED_LABEL, 1)]),
        ({"oak": 5, "ash": 3, "elm": 3}, {"min_percent": None}, [(COMBINED_LABEL, 6), ("oak", 5)]),
        ({"oak": 7, COMBINED_LABEL: 8, "elm": 1}, {"min_percent": None}, [(COMBINED_LABEL, 8), ("oak", 7), (COMBINED_LABEL, 1)]),
        ({"oak": 1}, {"min_percent": 0, "min_count": 0}, [("oak", 1)]),
    ],
)
def test_single_suppression(frame, counts, options, expected):
    df = frame(v=[label for label, n in counts.items() for _ in range(n)])
    got = bins(counts_single(df, "v", **options))
    total = sum(counts.values())
    assert [(label, n) for label, n, _ in got] == expected
    assert [p for _, _, p in got] == [n / total * 100 for _, n in expected]


def test_single_combined_goes_last_under_an_order(frame):
    df = frame(v=["A"] * 6 + ["B"] * 4 + ["C"] * 4)
    assert labels(counts_single(df, "v", order=["A", "B", "C"], min_percent=None)) == ["A", COMBINED_LABEL]


def test_single_empty(frame):
    assert bins(counts_single(frame(v=["Skipped"]), "v", exclude=["Skipped"])) == []


def test_single_family_equals_single_metrics(frame):
    df = frame(a=["x", "y", "y", "Skipped"] * 5, b=["p", "q", "r", None] * 5)
    metrics = {
        "a": SingleCount("a", exclude=["Skipped"], **OFF),
        "b": SingleCount("b", order=["r", "p"], min_percent=None, min_count=6),
        "c": SingleCount("a", min_percent=30.0, action="drop"),
    }
    family = counts_single_family(df, metrics)
    for name, m in metrics.items():
        alone = counts_single(
            df, m.column, order=m.order, exclude=m.exclude,
            min_percent=m.min_percent, min_count=m.min_count, action=m.action,
        )
        assert bins(family.filter(F.col("name") == name)) == bins(alone)


# --- multi counts ------------------------------------------------------------------


def test_multi_basic_order_and_ties(frame):
    # Of 16 walks: fox on every fourth, owl on 4 of the first 5, hare and newt never, toad on all but one.
    df = frame(
        newt=["No"] * 16, owl=["Yes"] * 3 + [None, "Yes"] + ["No"] * 11, hare=[None] * 16,
        fox=["No", "No", "No", "Yes"] * 4, toad=["Yes"] * 9 + [None] + ["Yes"] * 6,
    )
    animals = {c: c for c in ("newt", "owl", "hare", "fox", "toad")}
    assert bins(counts_multi(df, animals, **OFF)) == [
        ("toad", 15, 93.75), ("owl", 4, 25.0), ("fox", 4, 25.0), ("newt", 0, 0.0), ("hare", 0, 0.0),
    ]
    totals = set_totals(df, animals).orderBy("pos").collect()
    assert [(r.label, r["count"]) for r in totals] == [("newt", 0), ("owl", 4), ("hare", 0), ("fox", 4), ("toad", 15)]


def test_multi_suppression(frame):
    df = frame(oak=["Yes"] * 40, ash=["Yes"] * 3 + ["No"] * 37, elm=["Yes"] + [None] * 39)
    choices = {c: c for c in ("oak", "ash", "elm")}
    assert bins(counts_multi(df, choices)) == [("oak", 40, 100.0), (COMBINED_LABEL, 4, 10.0)]
    assert labels(counts_multi(df, choices, min_percent=None, action="drop")) == ["oak"]
    assert labels(counts_multi(df, choices, min_percent=5.0, min_count=None)) == ["oak", "ash", COMBINED_LABEL]


def test_multi_combined_bin_of_unpicked_choices(frame):
    df = frame(tea=["Yes", None] * 8, milk=[None] * 16, rum=["No"] * 16, ice=["Yes"] * 7 + ["No"] * 9)
    got = bins(counts_multi(df, {c: c for c in ("rum", "tea", "milk", "ice")}))
    assert got == [("tea", 8, 50.0), ("ice", 7, 43.75), (COMBINED_LABEL, 0, 0.0)]


def test_multi_empty_family_and_long(frame, spark):
    df = frame(A=["Yes", "No", "Yes"], B=["No", "No", "Yes"])
    choices = {"A": "A", "B": "B"}
    assert bins(counts_multi(df.filter("id < 0"), choices)) == []
    family = counts_multi_family(df, {"m": MultiCount(choices, **OFF), "n": MultiCount({"B": "B"}, **OFF)})
    assert bins(family.filter("name = 'm'")) == bins(counts_multi(df, choices, **OFF))
    assert bins(family.filter("name = 'n'")) == bins(counts_multi(df, {"B": "B"}, **OFF))
    picks = spark.createDataFrame([(0, "A"), (2, "A"), (2, "B"), (2, "B")], "id int, c string")
    flat, columns = flags_from_long(picks, ["id"], "c", ["A", "B"])
    assert flat.count() == 2 and set(columns) == {"A", "B"}
    assert bins(counts_multi(flat, columns, **OFF)) == [("A", 2, 100.0), ("B", 1, 50.0)]
    long = counts_multi_long(picks.distinct(), "c", ["A", "B"], F.lit(3), **OFF)
    assert bins(long) == bins(counts_multi(df, choices, **OFF))


def test_undeclared_picks_fail_or_count(spark):
    picks = spark.createDataFrame([("A",)] * 3 + [("Z",)] * 4 + [("Q",), (None,)], "c string")
    with pytest.raises(Exception, match="not declared, such as Q"):
        counts_multi_long(picks, "c", ["A", "B"], F.lit(8), **OFF).collect()
    with pytest.raises(Exception, match="not declared, such as Q"):
        flags_from_long(picks.withColumn("id", F.lit(1)), ["id"], "c", ["A", "B"])[0].select("pick_1").collect()
    assert bins(counts_multi_long(picks, "c", None, F.lit(8), **OFF)) == [("Z", 4, 50.0), ("A", 3, 37.5), ("Q", 1, 12.5)]
    floored = counts_multi_long(picks, "c", None, F.lit(8), min_percent=None, min_count=4)
    assert bins(floored) == [("Z", 4, 50.0), (COMBINED_LABEL, 4, 50.0)]
    assert counts_multi_long(picks.filter("c = 'A'"), "c", ["A"], F.lit(8), **OFF).count() == 1


# --- crosstabs -----------------------------------------------------------------------


def cells(df):
    rows = df.orderBy("x_pos", "y_pos").collect()
    return [(r.x, r.y, r["count"], r.value) for r in rows]


# Trips by day and vehicle: 8 on Monday, 4 on Friday, none by ferry on Friday or by bus on Monday.
TRIPS = {("Mon", "tram"): 3, ("Mon", "ferry"): 5, ("Fri", "tram"): 1, ("Fri", "bus"): 3}


@pytest.mark.parametrize(
    "normalize, values",
    [
        ("global", [25.0, 125 / 3, 0.0, 25 / 3, 0.0, 25.0]),
        ("x", [37.5, 62.5, 0.0, 25.0, 0.0, 75.0]),
        ("y", [75.0, 100.0, 0.0, 25.0, 0.0, 100.0]),
    ],
)
def test_crosstab_is_dense(frame, normalize, values):
    trips = [pair for pair, n in TRIPS.items() for _ in range(n)]
    df = frame(day=[day for day, _ in trips], by=[by for _, by in trips])
    got = crosstab(df, "day", "by", normalize=normalize, x_order=["Mon"], y_order=["tram", "ferry"])
    assert [(x, y, n) for x, y, n, _ in cells(got)] == [
        ("Mon", "tram", 3), ("Mon", "ferry", 5), ("Mon", "bus", 0), ("Fri", "tram", 1), ("Fri", "ferry", 0), ("Fri", "bus", 3),
    ]
    assert [v for *_, v in cells(got)] == pytest.approx(values)
    assert got.first().cell_kind == "rate_pct"


def test_crosstab_label_order(frame):
    df = frame(x=["c", "a", "b", "b", "Skipped", None], y=["1", "1", "2", "2", "1", "2"])
    got = crosstab(df, "x", "y", x_order=["zz", "c", "c"], x_exclude=["Skipped"])
    assert [(x, y) for x, y, _, _ in cells(got)] == [
        ("c", "1"), ("c", "2"), ("b", "1"), ("b", "2"), ("a", "1"), ("a", "2"),
    ]


def test_crosstab_empty(frame):
    assert cells(crosstab(frame(x=["a"], y=["b"]), "x", "y", x_exclude=["a"])) == []


def test_crosstab_keeps_null_labels(frame):
    df = frame(x=["a", None], y=["p", "p"])
    assert sorted(cells(crosstab(df, "x", "y")), key=str) == [("a", "p", 1, 50.0), (None, "p", 1, 50.0)]


@pytest.mark.parametrize("n_x,n_y", [(2000, 3), (3, 500), (7, 7), (1, 1), (10, 4)])
def test_dense_fill_holds_no_key_with_many_rows(spark, n_x, n_y):
    from tally.operators.crosstabs import _filled

    def labels(side, n):
        shape = F.struct(F.lit(n_x).cast("bigint").alias("x_labels"), F.lit(n_y).cast("bigint").alias("y_labels"))
        return spark.range(1, n + 1).select(
            F.col("id").alias(f"{side}_pos"), F.concat(F.lit(side), "id").alias(side), shape.alias("__shape")
        )

    filled = _filled(labels("x", n_x), labels("y", n_y), [])
    pairs = {(r.x_pos, r.x, r.y_pos, r.y) for r in filled.collect()}
    assert pairs == {(i, f"x{i}", j, f"y{j}") for i in range(1, n_x + 1) for j in range(1, n_y + 1)}
    assert filled.count() == n_x * n_y
    assert filled.groupBy("y_pos", "__repeat").count().agg(F.max("count")).first()[0] <= n_y


def test_crosstab_family(frame):
    df = frame(x=["A", "A", "B", "C"], y=["P", "Q", "P", "Q"])
    specs = {
        "one": CrossTab("x", "y", "x"),
        "two": CrossTab("y", "x", "y", x_order=["Q"], y_exclude=["C"]),
    }
    family = crosstab_family(df, specs)
    assert cells(family.filter("name = 'one'")) == cells(crosstab(df, "x", "y", normalize="x"))
    alone = crosstab(df, "y", "x", normalize="y", x_order=["Q"], y_exclude=["C"])
    assert cells(family.filter("name = 'two'")) == cells(alone)


@pytest.fixture
def pets(frame):
    """Of 12 homes: 6 in town, 4 on farms, 2 unknown. Dogs in 1, 4 and 0 of them, cats in 3, 2 and 2, no newts."""
    return frame(
        dog=["Yes"] + ["No"] * 5 + ["Yes"] * 4 + [None] * 2,
        cat=["No", "Yes", "Yes", "Yes", "No", None] + ["Yes", "No"] * 2 + ["Yes"] * 2,
        newt=["No"] * 12,
        home=["town"] * 6 + ["farm"] * 4 + ["unknown"] * 2,
    )


@pytest.mark.parametrize(
    "denominator, kind, values",
    [
        # Farm first: dog, cat, newt; then town. Without the unknown there are 5 dogs and 5 cats in 10 homes.
        ("rate", "rate_pct", [100.0, 50.0, 0.0, 100 / 6, 50.0, 0.0]),
        ("composition", "composition_pct", [80.0, 40.0, 0.0, 20.0, 60.0, 0.0]),
        ("lift", "lift", [2.0, 1.0, 1.0, 1 / 3, 1.0, 1.0]),
    ],
)
def test_crosstab_multi(pets, denominator, kind, values):
    animals = ("dog", "cat", "newt")
    got = crosstab_multi(
        pets, {c: c for c in animals}, "home", denominator=denominator, x_order=["farm"], x_exclude=["unknown"],
    )
    assert [(x, y) for x, y, _, _ in cells(got)] == [(x, y) for x in ("farm", "town") for y in animals]
    assert [n for *_, n, _ in cells(got)] == [4, 2, 0, 1, 3, 0]
    assert [v for *_, v in cells(got)] == pytest.approx(values)
    assert got.first().cell_kind == kind


# --- ranks -----------------------------------------------------------------------------


def ranked(df):
    out = {}
    for r in df.orderBy("item_pos", "seg_pos").collect():
        out.setdefault(r.label, []).append(r.percent)
    return out


def rank_frame(frame, rows):
    return frame(**{f"r{i}": [row[i] for row in rows] for i in range(len(rows[0]))}), [
        f"r{i}" for i in range(len(rows[0]))
    ]


def test_rank_positions(frame):
    df, ranks = rank_frame(frame, ["KLM", "KLM", "MKL", "LKM", "KML"])
    got = rank_distribution(df, ranks, min_count=1)
    assert ranked(got) == {"K": [60, 40, 0, 0], "L": [20, 40, 40, 0], "M": [20, 20, 60, 0]}
    assert list(ranked(got)) == ["K", "L", "M"]
    assert {r.segment for r in got.collect()} == {"#1", "#2", "#3", "Unranked"}
    assert [tuple(r) for r in borda_scores(got).orderBy("item_pos").collect()] == [
        (1, "K", 13), (2, "L", 9), (3, "M", 8),
    ]


def test_rank_points_by_band(frame):
    """Three placements in the lower band are worth less than two in the upper one."""
    df, ranks = rank_frame(frame, [["tea", None, "rum"]] * 2 + [["", None, "rum"]])
    assert list(ranked(rank_distribution(df, ranks, bands=[(1, 2), (3, 3)], min_count=1))) == ["tea", "rum"]
    assert list(ranked(rank_distribution(df, ranks, bands=[(1, 3)], min_count=1))) == ["rum", "tea"]


def test_rank_tail_is_unranked(frame):
    df, ranks = rank_frame(frame, ["PQR", "PRQ", "PQR", "QPR"])
    got = ranked(rank_distribution(df, ranks, bands=[(1, 1)], min_count=3))
    assert got == {"P": [75, 25], "Q": [25, 75], "R": [0, 100]}


def test_rank_floor_counts_any_position(frame):
    df, ranks = rank_frame(frame, ["VW", "WV", "VX", "XV", "VY", "YV"])
    assert list(ranked(rank_distribution(df, ranks))) == ["V"]


def test_rank_long_keeps_placements_at_any_position(spark):
    rows = [(1, "K")] * 3 + [(0, "K")] * 2 + [(None, "K"), (9, "K"), (2, "L"), (0, "L"), (1, "")]
    long = spark.createDataFrame(rows, "p int, c string")
    got = rank_distribution_long(long, "p", "c", F.lit(10), 2, min_count=2)
    assert ranked(got) == {"K": [30, 0, 70], "L": [0, 10, 90]}
    assert got.count() == len(got.collect()) == 6


def test_rank_band_names_and_duplicates(frame):
    df, ranks = rank_frame(frame, ["ABCA", "ABCA"])
    got = rank_distribution(df, ranks, bands=[(1, 2), (3, 3)], min_count=1)
    assert {r.segment for r in got.collect()} == {"1-2", "3", "Unranked"}
    assert ranked(got)["A"] == [100, 0, 0]


def test_rank_empty_family_and_long(frame, spark):
    df, ranks = rank_frame(frame, ["AB", "BA", ["A", None]])
    assert ranked(rank_distribution(df.filter("id < 0"), ranks)) == {}
    family = rank_distribution_family(
        df, {"x": RankCount(ranks, None, 1), "y": RankCount(ranks, [(1, 2)], 1)}
    )
    assert ranked(family.filter("name = 'x'")) == ranked(rank_distribution(df, ranks, min_count=1))
    assert ranked(family.filter("name = 'y'")) == ranked(
        rank_distribution(df, ranks, bands=[(1, 2)], min_count=1)
    )
    long = spark.createDataFrame(
        [(1, "A"), (2, "B"), (1, "B"), (2, "A"), (1, "A")], "p int, c string"
    )
    assert ranked(rank_distribution_long(long, "p", "c", F.lit(3), 2, min_count=1)) == ranked(
        rank_distribution(df, ranks, min_count=1)
    )


# --- flows --------------------------------------------------------------------------------

# How often each answer of the default stages is given here, in the order of their paths.
TIMES = (4, 9, 25, 16, 11, 7, 5)
ANSWERS = {**dict(zip(UPGRADE_STAGES.paths, TIMES)), "Skipped": 6, "no idea": 1}


def links(df):
    return [(r.source, r.target, r.value) for r in df.orderBy("link_pos").collect()]


def answers(frame, **override):
    counts = {**ANSWERS, **override}
    return frame(v=[a for a, n in counts.items() for _ in range(n)])


def test_funnel_counts_and_nodes(frame):
    got = staged_funnel(answers(frame), "v")
    upgraded = sum(TIMES[2:])
    found = {link[:2]: link[2] for link in links(staged_funnel(answers(frame), "v", min_count=0))}
    assert found["All", "Knew"] == upgraded + 9 and found["All", "Didn't know"] == 4
    assert found["Knew", "Upgraded"] == upgraded and found["Knew", "Did not upgrade"] == 9
    assert [found["Upgraded", leaf] for leaf in UPGRADE_STAGES.nodes[5:]] == list(TIMES[2:])
    touched = [r.node for r in funnel_nodes(got).orderBy("node_pos").collect()]
    assert touched == [n for n in UPGRADE_STAGES.nodes if n != "Didn't know"]


def test_funnel_floor_keeps_inner_counts(frame):
    stuck = list(UPGRADE_STAGES.paths)[-1]
    got = staged_funnel(answers(frame, **{stuck: 1}), "v")
    assert ("Knew", "Upgraded", float(sum(TIMES[2:-1]) + 1)) in links(got)
    assert "Severe (stuck)" not in [r.node for r in funnel_nodes(got).collect()]


def test_funnel_percent(frame):
    got = {link[:2]: link[2] for link in links(staged_funnel(answers(frame), "v", min_count=0, as_percent=True))}
    assert got["All", "Didn't know"] == round(4 / sum(TIMES) * 100, 1)
    assert got["Upgraded", "Minor"] == round(16 / sum(TIMES) * 100, 1)


def test_funnel_other_stages(frame):
    stages = Stages(("root", "left", "right"), {"l": ("root", "left"), "r": ("root", "right")})
    assert links(staged_funnel(frame(v=["l", "r", "l"]), "v", stages, min_count=0)) == [
        ("root", "left", 2), ("root", "right", 1),
    ]
    with pytest.raises(ValueError, match="not declared"):
        Stages(("root",), {"l": ("root", "left")}).links()


def flow(df, **options):
    return flow_links(df, "x", "y", id="id", **options)


def test_flow_order_floor_and_nodes(frame):
    df = frame(
        x=["b"] * 6 + ["a"] * 6 + ["c"] * 2 + [None, "b"],
        y=["q"] * 3 + ["p"] * 3 + ["p"] * 6 + ["r"] * 2 + ["p", None],
    )
    assert links(flow(df, min_count=3)) == [("b", "q", 3), ("b", "p", 3), ("a", "p", 6)]
    nodes = flow_nodes(df, "x", "y", id="id", min_count=3).orderBy("node_pos").collect()
    assert [(n.node, n.side) for n in nodes] == [("b", "x"), ("a", "x"), ("q", "y"), ("p", "y")]


def test_flow_maps_after_excluding_raw_values(frame):
    # Ports of one sea go together; a raw value that is left out stays out whatever its map says.
    df = frame(
        x=["Riga", "Kiel", "Oslo", "Riga", "Cork", "Kiel", "Riga", "lost", "Oslo"],
        y=["salt", "hemp", "salt", "gone", "hemp", "salt", "hemp", "salt", "hemp"],
    )
    got = flow(
        df, x_map={"Riga": "Baltic", "Kiel": "Baltic", "lost": "Baltic"}, y_map={"gone": "salt"},
        exclude=["lost", "gone"], min_count=2,
    )
    assert links(got) == [("Baltic", "salt", 2), ("Baltic", "hemp", 2)]


def test_flow_percent_uses_the_base_before_the_floor(frame):
    # 16 rows in all: links of 7, 5, 3 and 1, of which two stay. 31.25 goes to the even tenth.
    df = frame(x=["dawn"] * 7 + ["noon"] * 8 + ["dusk"], y=["swim"] * 7 + ["walk"] * 5 + ["swim"] * 3 + ["rest"])
    assert links(flow(df, as_percent=True)) == [("dawn", "swim", 43.8), ("noon", "walk", 31.2)]
    assert len(links(flow(df, as_percent=True, min_count=1))) == 4


def test_flow_collision(frame):
    df = frame(x=["pine", "oak", "oak", "fir"], y=["oak", "ash", "pine", "ash"])
    with pytest.raises(Exception, match="collide with y-node names: 2 in all, such as oak"):
        flow(df, min_count=99).collect()
    assert sorted(r.name for r in name_collisions(df, Flow("x", "y", "id")).collect()) == ["oak", "pine"]
    with pytest.raises(Exception, match="1 in all, such as oak"):
        flow(df, y_map={"pine": "pine wood"}, min_count=1).collect()
    renamed = flow(df, y_map={"pine": "pine wood", "oak": "oak wood"}, min_count=1)
    assert links(renamed) == [("pine", "oak wood", 1), ("oak", "ash", 1), ("oak", "pine wood", 1), ("fir", "ash", 1)]


# --- sets ---------------------------------------------------------------------------------------


def combos(df):
    return [(tuple(r.members), r.size, r.dropped) for r in df.orderBy("pos").collect()]


def test_set_combinations(frame):
    # Nine bags: rope and lamp in 3, lamp alone in 2, knife alone in 2, all three in 1, none in 1.
    bags = ["RL", "L", "RL", "K", "", "RLK", "L", "K", "RL"]
    df = frame(**{name: ["Yes" if c in bag else "No" if i % 2 else None for i, bag in enumerate(bags)]
                  for name, c in (("rope", "R"), ("knife", "K"), ("lamp", "L"))})
    tools = {c: c for c in ("rope", "knife", "lamp")}
    assert combos(set_combinations(df, tools, min_size=1)) == [
        (("rope", "lamp"), 3, 0), (("knife",), 2, 0), (("lamp",), 2, 0), (("rope", "knife", "lamp"), 1, 0),
    ]
    assert combos(set_combinations(df, tools, min_size=2)) == [
        (("rope", "lamp"), 3, 1), (("knife",), 2, 1), (("lamp",), 2, 1),
    ]
    assert combos(set_combinations(df, tools, min_size=1, max_combos=1)) == [(("rope", "lamp"), 3, 3)]
    assert combos(set_combinations(df, tools, min_size=4)) == []
    totals = totals_of_sizes(combination_sizes(df, tools), [*tools, "map"]).orderBy("pos").collect()
    assert [(r.label, r["count"]) for r in totals] == [("rope", 4), ("knife", 3), ("lamp", 6), ("map", 0)]
    assert tuple(combinations_dropped(df, tools, min_size=3).first()) == (1, 3)


def test_set_members_follow_set_order(frame):
    df = frame(A=["Yes"], B=["Yes"])
    assert combos(set_combinations(df, {"B": "B", "A": "A"}, min_size=1)) == [(("B", "A"), 1, 0)]


def test_many_sets_equal_few_sets(frame):
    df = frame(A=["Yes", "No"], B=["Yes", "Yes"])
    wide = {"A": "A", "B": "B", **{f"n{i}": F.lit(False) for i in range(70)}}
    assert combos(set_combinations(df, wide, min_size=1)) == combos(
        set_combinations(df, {"A": "A", "B": "B"}, min_size=1)
    )


def test_the_large_map_has_every_supplier(spark, tmp_path):
    from workload import QUERIES

    keys = [1, 1499, 1500, 1501, 1601]
    suppliers = spark.createDataFrame([(k,) for k in keys], "s_suppkey bigint")
    lines = spark.createDataFrame(
        [(k, "N", 10 * k + i) for k in keys for i in range(5)], "l_suppkey bigint, l_returnflag string, l_orderkey bigint"
    )
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = QUERIES["flow_links_large_map"](spark, str(tmp_path)).orderBy("link_pos").collect()
    assert [(r.source, r["count"]) for r in rows] == [("band 1", 10), ("supplier 1500", 5), ("band 3", 5), ("band 5", 5)]
