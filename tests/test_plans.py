"""What the executed plans must look like, whatever the data size."""

from collections import Counter

import pytest
from plans import executed_operators, nested_loops, rows_made, scanned
from pyspark import TaskContext
from pyspark.sql import functions as F

from tally.operators import (
    CrossTab,
    Flow,
    MultiCount,
    RankCount,
    SingleCount,
    Stages,
    counts_multi_family,
    counts_single,
    counts_single_family,
    crosstab,
    crosstab_family,
    crosstab_multi,
    flow_links,
    flow_nodes,
    rank_distribution,
    rank_distribution_family,
    set_combinations,
    staged_funnel,
)
from tally.operators import crosstabs, position
from tally.operators.position import with_position
from tally.plans import (
    Chart,
    Combinations,
    Funnel,
    Report,
    ReportRow,
    ReportSection,
    TraitTab,
    report_counts,
)
from tally.storage import stored

SF_DIR = "/root/testdata/sf0.001"
OFF = {"min_percent": None, "min_count": None}


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF_DIR}/orders.parquet")


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


def flags():
    return {flag: F.col("l_returnflag") == flag for flag in "ANR"}


@pytest.fixture
def written(monkeypatch):
    """Frames that operators write while a test runs."""
    frames = []

    def keep(df, name):
        frames.append(df)
        return stored(df, name)

    for module in (position, crosstabs):
        monkeypatch.setattr(module, "stored", keep)
    return frames


def plans(orders, lines):
    cross = ("o_orderpriority", "o_orderstatus")
    return {
        "single": lambda: counts_single(orders, "o_orderpriority"),
        "single unbounded": lambda: counts_single(orders, "o_custkey", **OFF),
        "single family": lambda: counts_single_family(
            orders, {"a": SingleCount("o_orderpriority"), "b": SingleCount("o_custkey", **OFF)}
        ),
        "multi family": lambda: counts_multi_family(lines, {"m": MultiCount(flags()), "n": MultiCount(flags())}),
        "crosstab": lambda: crosstab(orders, *cross, normalize="x"),
        "crosstab family": lambda: crosstab_family(
            orders, {"a": CrossTab(*cross), "b": CrossTab(*cross, normalize="y")}
        ),
        "rank family": lambda: rank_distribution_family(
            orders, {"a": RankCount(list(cross)), "b": RankCount(list(cross), [(1, 2)])}
        ),
        "crosstab multi": lambda: crosstab_multi(lines, flags(), "l_linestatus", denominator="lift"),
        "ranks": lambda: rank_distribution(orders, list(cross)),
        "sets": lambda: set_combinations(lines, flags()),
        "funnel": lambda: staged_funnel(orders, "o_orderpriority"),
        "flow": lambda: flow_links(orders, *cross, id="o_orderkey"),
        "nodes": lambda: flow_nodes(orders, *cross, id="o_orderkey"),
    }


def test_one_scan_and_no_nested_loops(orders, lines, written):
    """Of the input, over all that an operator writes and returns."""
    for name, made in plans(orders, lines).items():
        written.clear()
        df = made()
        frames = [df, *written]
        read = Counter()
        for frame in frames:
            operators = executed_operators(frame)
            read += Counter(path.split("/")[-1] for path in scanned(frame))
            # What is joined without keys is one row.
            assert nested_loops(operators) == 0, name
            assert operators["ArrowEvalPythonExec"] == 0, name
        assert sum(n for path, n in read.items() if path in ("orders.parquet", "lineitem.parquet")) == 1, name


def test_positions_over_many_and_few_rows(spark):
    """Ranges of any number of labels, equal keys of a group apart, and no rows at all."""
    for rows, partitions in ((0, 3), (1, 5), (100_000, 7)):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            df = spark.range(rows).selectExpr("id % 3 AS g", "id % 1000 AS k", "id AS tie", "concat('r', id) AS label")
            whole = with_position(df, ["k", "tie"])
            by = with_position(df, ["k", "tie"], by=["g"])
            assert whole.columns == [*df.columns, "pos"]
            places = [r.pos for r in whole.orderBy("k", "tie").collect()]
            assert places == list(range(1, rows + 1))
            window = "row_number() OVER (PARTITION BY g ORDER BY k, tie)"
            assert by.selectExpr("pos", f"{window} AS nth").where("pos <> nth").count() == 0
            assert whole.schema["pos"].dataType.simpleString() == "bigint"
            # Read again, rows keep their places.
            assert sorted(map(tuple, by.collect())) == sorted(map(tuple, by.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_positions_after_a_killed_task(spark):
    """A task that fails after half its rows and runs again leaves the same positions."""
    df = spark.range(2_000).selectExpr("id", "pmod(hash(id), 100) AS k")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def failing(x):
        if TaskContext.get().attemptNumber() == 0 and x == 1_500:
            seen.add(1)
            raise RuntimeError("lost")
        return x

    tried = spark.conf.get("spark.task.maxFailures", "1")
    broken = df.withColumn("id", failing("id"))
    if tried == "1":  # local sessions of one attempt: the job fails whole, and is run anew
        with pytest.raises(Exception, match="lost"):
            with_position(broken, ["k", "id"])
    expected = {r.id: r.pos for r in with_position(df, ["k", "id"], few=True).collect()}
    assert {r.id: r.pos for r in with_position(df, ["k", "id"]).collect()} == expected


def test_scans_are_pruned_and_filtered(orders):
    df = counts_single(orders, "o_orderpriority", exclude=["5-LOW"])
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderpriority:string>" in text
    assert "PushedFilters: [Not(In" in text or "PushedFilters: [IsNotNull(o_orderpriority), Not(" in text


def test_partition_count_does_not_change_results(spark, orders, lines):
    def results(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spread = plans(orders.repartition(partitions), lines.repartition(partitions))
        return {name: sorted(map(str, made().collect())) for name, made in spread.items()}

    try:
        assert results(2) == results(7)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_invariants(orders, lines):
    total = orders.count()
    cells = crosstab(orders, "o_orderpriority", "o_orderstatus")
    assert cells.agg(F.sum("value")).first()[0] == pytest.approx(100)
    assert cells.agg(F.sum("count")).first()[0] == total
    for axis in ("x", "y"):
        sums = crosstab(orders, "o_orderpriority", "o_orderstatus", normalize=axis).groupBy(axis).agg(
            F.sum("value").alias("s")
        )
        assert all(r.s == pytest.approx(100) for r in sums.collect())
    ranks = rank_distribution(orders, ["o_orderpriority", "o_orderstatus"]).groupBy("label").agg(
        F.sum("percent").alias("s"), F.sum("count").alias("n")
    )
    assert all(r.s == pytest.approx(100) and r.n == total for r in ranks.collect())
    independent = lines.select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("s"), "l_returnflag")
    lift = crosstab_multi(independent, flags(), "s", denominator="lift")
    assert all(r.value == pytest.approx(1) for r in lift.collect())


def test_a_report_scans_its_input_once(spark, orders, lines):
    """However many charts there are; the charts themselves read the counts."""
    flagged = lines.select("l_orderkey", "l_returnflag", "l_linestatus")
    traits = flags()
    charts = [
        Chart("bar", SingleCount("l_linestatus")), Chart("bar", MultiCount(traits)),
        Chart("rank", RankCount(["l_returnflag", "l_linestatus"])),
        Chart("heatmap", CrossTab("l_returnflag", "l_linestatus")),
        Chart("line", TraitTab(traits, "l_linestatus", "rate")), Chart("upset", Combinations(traits)),
        Chart("sankey", Funnel("l_linestatus", Stages(("a", "b"), {"O": ("a", "b")}))),
        Chart("sankey", Flow("l_returnflag", "l_linestatus", "l_orderkey")),
    ]
    for times in (1, 6):
        rows = [ReportRow(f"r{i}", "t", "q", charts, commentary="") for i in range(times)]
        counts = report_counts(flagged, Report(2025, "t", [ReportSection("s", "s", rows)]))
        operators = executed_operators(counts)
        assert operators["FileSourceScanExec"] == 1 and operators["ShuffleExchangeExec"] == 1
        assert nested_loops(operators) == 0


def test_a_report_stacks_a_row_once_for_what_metrics_share(spark, lines):
    """Four questions of 3 choices and five charts of one column: two masks of flags and one label for each row."""
    charts = [Chart("bar", MultiCount({**flags(), "none": F.lit(None).cast("boolean")})) for _ in range(4)]
    charts += [Chart("bar", SingleCount("l_linestatus")) for _ in range(4)]
    charts += [Chart("line", TraitTab(flags(), "l_linestatus", "rate"))]
    rows = [ReportRow("r", "t", "q", charts, commentary="")]
    counts = report_counts(lines, Report(2025, "t", [ReportSection("s", "s", rows)]))
    stacked = rows_made(counts, "GenerateExec")
    total = lines.count()
    assert max(stacked) == 3 * total
    got = {(r["metric"], r.k1, r.k2): r.n for r in counts.collect()}
    picked = {str(i): lines.where(F.col("l_returnflag") == flag).count() for i, flag in enumerate("ANR")}
    expected = {(q, None, None): total for q in range(4)} | {(q, i, None): n for q in range(4) for i, n in picked.items()}
    for r in lines.groupBy("l_linestatus").count().collect():
        expected |= {(q, r.l_linestatus, None): r["count"] for q in range(4, 9)}
    for r in lines.groupBy("l_linestatus", "l_returnflag").count().collect():
        expected[8, r.l_linestatus, str("ANR".index(r.l_returnflag))] = r["count"]
    assert got == expected


def test_plans_with_generated_code(spark, orders):
    """The other tests interpret their plans; one family with whole-stage code gives the same rows."""
    def rows():
        family = {"a": SingleCount("o_orderpriority"), "b": SingleCount("o_orderstatus", **OFF)}
        return sorted(map(tuple, counts_single_family(orders, family).collect()))

    interpreted = rows()
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    try:
        assert rows() == interpreted
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "false")
