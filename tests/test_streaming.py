import json
from types import SimpleNamespace

import pytest

from tally.operators import Flow, MultiCount, SingleCount, counts_single
from tally.plans import Chart, Report, ReportRow, ReportSection
from tally.sources import question_catalog, read_reports
from tally.sources.responses import RESPONDENT
from tally.streaming import checkpoint_folder, start_live_report, stream_counts, stream_fields
from tally.streaming.live import totals_folder

HEADERS = ["Level?", "Stove? [Gas]", "Stove? [Wood]"]
QUESTIONS = [
    {"id": "level", "prompt": "Level?", "type": "single"},
    {"id": "stove", "prompt": "Stove?", "type": "multiple", "choices": ["Gas", "Wood"]},
]
OFF = {"min_percent": None, "min_count": None}


def arrive(folder, name, rows):
    lines = [",".join(f'"{cell}"' for cell in row) for row in [HEADERS, *rows]]
    (folder / name).write_text("\n".join(lines) + "\n")


def report_of(survey):
    return Report(2025, "Live", [ReportSection("s", "S", [
        ReportRow("level", "Level", survey.prompt("level"), commentary="", charts=[
            Chart("bar", SingleCount(survey.level, **OFF)),
            Chart("bar", MultiCount(survey.stove, **OFF)),
        ]),
    ])])


def test_live_report_covers_all_files_so_far(spark, tmp_path):
    folder, output = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run():
        query = start_live_report(
            spark, question_catalog(spark, QUESTIONS), report_of,
            folder=str(folder), headers=HEADERS, landed=str(tmp_path / "landed"),
            output=output, checkpoint=str(tmp_path / "progress"), once=True,
        )
        query.awaitTermination()
        assert query.exception() is None
        charts = read_reports(spark, output).first().sections[0].rows[0].charts
        return [json.loads(c.toJson())["option"] for c in charts]

    arrive(folder, "a.csv", [("Low", "Yes", "No"), ("High", "No", "No")])
    level, stove = run()
    assert level["series"][0]["data"] == [50.0, 50.0] and stove["series"][0]["data"] == [0.0, 50.0]
    arrive(folder, "b.csv", [("Low", "Yes", "Yes"), ("Low", "No", "No")])
    level, stove = run()
    assert level["yAxis"]["data"] == ["High", "Low"] and level["series"][0]["data"] == [25.0, 75.0]
    assert stove["series"][0]["data"] == [25.0, 50.0]
    assert run() == [level, stove]


def test_the_work_of_a_batch_does_not_grow_with_their_number(spark, tmp_path):
    folder, landed = tmp_path / "in", tmp_path / "landed"
    folder.mkdir()

    def run():
        start_live_report(
            spark, question_catalog(spark, QUESTIONS), report_of, folder=str(folder), headers=HEADERS,
            landed=str(landed), output=str(tmp_path / "out"), checkpoint=str(tmp_path / "progress"), once=True,
        ).awaitTermination()

    kept = []
    for number in range(5):
        arrive(folder, f"{number}.csv", [("Low", "Yes", "No"), (f"Level {number}", "No", "No")])
        run()
        files = [f.relative_to(landed) for f in landed.rglob("*.parquet")]
        kept.append({f.parts[0] for f in files})
        # A batch reads the totals before it, and nothing of the batches that they hold.
        before = [f for f in files if f.parts[0] == f"through={number - 1}"]
        assert len(before) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert kept[-1] == {"through=3", "through=4"} and all(len(names) <= 2 for names in kept)
    totals = spark.read.parquet(totals_folder(str(landed), 4)).where("metric = 0")
    assert {r.k1: r.n for r in totals.collect()} == {"Low": 5, **{f"Level {i}": 1 for i in range(5)}}


def test_flows_of_a_live_report_keep_the_order_of_arrival(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    questions = [{"id": i, "prompt": f"{i}?", "type": "single"} for i in ("was", "is")]

    def flow_report(survey):
        chart = Chart("sankey", Flow(survey["was"], survey["is"], RESPONDENT, min_count=0))
        return Report(2025, "Live", [ReportSection("s", "S", [ReportRow("f", "F", "?", [chart], commentary="")])])

    def run():
        start_live_report(
            spark, question_catalog(spark, questions), flow_report, folder=str(folder), headers=["was?", "is?"],
            landed=str(tmp_path / "landed"), output=str(tmp_path / "out"), checkpoint=str(tmp_path / "progress"),
            once=True,
        ).awaitTermination()
        chart = read_reports(spark, str(tmp_path / "out")).first().sections[0].rows[0].charts[0]
        series = json.loads(chart.toJson())["option"]["series"][0]
        return [n["name"] for n in series["data"]], [(e["source"], e["target"], e["value"]) for e in series["links"]]

    (folder / "z.csv").write_text("was?,is?\nwalk,tram\nbike,train\n")
    assert run()[0] == ["walk", "bike", "tram", "train"]
    # A later batch comes after, whatever its file is called; inside it files go by name.
    (folder / "b.csv").write_text("was?,is?\nroller,ferry\n")
    (folder / "a.csv").write_text("was?,is?\ncar,tram\nbike,train\n")
    nodes, links = run()
    assert nodes == ["walk", "bike", "car", "roller", "tram", "train", "ferry"]
    assert links == [("walk", "tram", 1.0), ("bike", "train", 2.0), ("car", "tram", 1.0), ("roller", "ferry", 1.0)]


def test_running_counts_equal_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    arrive(folder, "a.csv", [("Low", "Yes", "No"), ("High", "No", "No")])
    metrics = {"level": SingleCount("f0"), "gas": SingleCount("f1", exclude=["No"])}
    running = stream_counts(stream_fields(spark, str(folder), HEADERS), metrics)
    query = (
        running.writeStream.outputMode("complete").format("memory").queryName("running_counts")
        .option("checkpointLocation", str(tmp_path / "progress")).start()
    )
    try:
        query.processAllAvailable()
        arrive(folder, "b.csv", [("Low", "Yes", "Yes")])
        query.processAllAvailable()
    finally:
        query.stop()
    got = {(r.name, r.label): r["count"] for r in spark.table("running_counts").collect()}
    assert got == {("level", "Low"): 2, ("level", "High"): 1, ("gas", "Yes"): 2}
    batch = spark.read.option("header", True).csv(str(folder)).toDF("f0", "f1", "f2")
    expected = {r.label: r["count"] for r in counts_single(batch, "f0", **OFF).collect()}
    assert {label: n for (name, label), n in got.items() if name == "level"} == expected


def test_a_file_with_swapped_columns_fails_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("Level?,Stove? [Wood],Stove? [Gas]\nLow,Yes,No\n")
    query = (
        stream_fields(spark, str(folder), HEADERS).writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    )
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        query.awaitTermination()
    with pytest.raises(ValueError, match="repeated names"):
        stream_fields(spark, str(folder), ["A", "a"])


def test_checkpoint_folder_comes_from_the_session():
    def session(settings):
        return SimpleNamespace(conf=SimpleNamespace(get=settings.get))

    assert checkpoint_folder(session({"spark.checkpoint.dir": "/shared/cp/"}), "x") == "/shared/cp/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
        checkpoint_folder(session({}), "x")
