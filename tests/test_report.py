import json

import pytest
from pyspark.sql import functions as F

from tally.functions import first_semver
from tally.operators import (
    CrossTab,
    Flow,
    MultiCount,
    RankCount,
    SingleCount,
    bar_series,
    counts_single,
    crosstab,
    crosstab_multi,
    dropped_note,
    heatmap_cells,
    heatmap_range,
    likert_segments,
    line_series,
    rank_distribution,
    rank_stack,
    sankey_frame,
    set_combinations,
    set_totals,
    staged_funnel,
    upset_combo_names,
    upset_connectors,
    upset_key,
    upset_matrix,
    upset_set_names,
    upset_totals_axis,
)
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
from tally.sources import (
    load_catalog,
    load_commentary,
    publish_run,
    published,
    published_frame,
    published_reports,
    read_reports,
    read_responses,
    report_index,
    report_page,
    write_frames,
    write_report,
)

OFF = {"min_percent": None, "min_count": None}
SEASONS = ["First", "Some", "Many", "All my life"]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- chart frames ----------------------------------------------------------------


def test_bar_series_is_bottom_up(frame):
    df = frame(v=["a"] * 2 + ["b"])
    assert rows(bar_series(counts_single(df, "v", **OFF)), "draw_pos") == [(0, "b", 33.3), (1, "a", 66.7)]


@pytest.fixture
def table(frame):
    df = frame(x=["a"] * 8 + ["b"] * 7, y=["p"] * 6 + ["q"] * 2 + ["q"] * 7)
    return crosstab(df, "x", "y", normalize="x", x_order=["a"], y_order=["p"])


def test_heatmap(table):
    assert rows(heatmap_cells(table), "x_idx", "y_idx") == [
        (0, 0, 75.0), (0, 1, 25.0), (1, 0, 0.0), (1, 1, 100.0),
    ]
    assert tuple(heatmap_range(table).first()) == (0.0, 100.0)
    assert tuple(heatmap_range(table.filter("x = 'a'")).first()) == (20.0, 80.0)
    assert tuple(heatmap_range(table, low=5, high=50).first()) == (5.0, 50.0)
    assert tuple(heatmap_range(table.filter("x = 'none'")).first()) == (0.0, 100.0)


def test_heatmap_range_of_lift(frame):
    df = frame(A=["Yes", "No"], s=["x", "y"])
    lift = crosstab_multi(df, {"A": "A"}, "s", denominator="lift")
    assert tuple(heatmap_range(lift).first()) == (0.0, 2.0)
    assert tuple(heatmap_range(lift, high=3).first()) == (0.0, 3.0)


def test_line_series(table):
    assert rows(line_series(table).drop("series", "x"), "series_pos", "x_idx") == [
        (0, 0, 75.0, "%"), (0, 1, 0.0, "%"), (1, 0, 25.0, "%"), (1, 1, 100.0, "%"),
    ]


def test_likert_segments(frame):
    bins = counts_single(frame(v=["good", "bad", "bad", "odd"]), "v", **OFF)
    got = likert_segments(bins, positive=["great", "good"], negative=["bad"], neutral=["meh"])
    assert rows(got, "seg_pos") == [
        (0, "positive", "great", 0.0), (1, "positive", "good", 25.0),
        (2, "negative", "bad", 50.0), (3, "neutral", "meh", 0.0),
    ]


def test_rank_stack(frame):
    df = frame(r1=["A", "A", "B"], r2=["B", "B", None])
    got = rank_stack(rank_distribution(df, ["r1", "r2"], min_count=1))
    assert rows(got, "seg_idx", "draw_pos") == [
        (0, "#1", 0, "B", 33.3), (0, "#1", 1, "A", 66.7),
        (1, "#2", 0, "B", 66.7), (1, "#2", 1, "A", 0.0),
        (2, "Unranked", 0, "B", 0.0), (2, "Unranked", 1, "A", 33.3),
    ]


def test_upset_frames(frame):
    # Nine answers name the kettle and the stove, seven all three, two the pan alone.
    sets = ["kettle", "stove", "pan"]
    yes, no = ["Yes"], ["No"]
    df = frame(kettle=yes * 16 + no * 2, stove=yes * 16 + no * 2, pan=no * 9 + yes * 9)
    choices = {c: c for c in sets}
    combos, totals = set_combinations(df, choices, min_size=2), set_totals(df, choices)
    assert rows(combos.select("pos", "members", "size"), "pos") == [
        (1, ["kettle", "stove"], 9), (2, sets, 7), (3, ["pan"], 2),
    ]
    filled = [(c, r) for c, r, _, on in rows(upset_matrix(combos, sets), "col", "row") if on]
    assert upset_matrix(combos, sets).count() == 9
    assert filled == [(0, 0), (0, 1), (1, 0), (1, 1), (1, 2), (2, 2)]
    assert rows(upset_connectors(combos, sets), "col") == [(0, 0, 1), (1, 0, 2)]
    codes = {"kettle": "kt", "pan": "pn"}
    assert rows(upset_combo_names(combos, codes), "col") == [
        (0, "kt · stove: 9", 9), (1, "kt · stove · pn: 7", 7), (2, "pn: 2", 2),
    ]
    assert rows(upset_set_names(totals, codes), "row") == [
        (0, "kt", "kt: 16", 16), (1, "stove", "stove: 16", 16), (2, "pn", "pn: 9", 9),
    ]
    assert upset_totals_axis(totals).first()[0] == int(16 * 1.6) + 1
    assert upset_key(codes).splitlines()[2:] == ["| kt | kettle |", "| pn | pan |"]
    assert upset_key(None) is None
    found = df.sparkSession.range(3).orderBy("id").select(dropped_note(F.col("id"), min_size=30)).collect()
    assert found[0][0] is None and found[1][0].startswith("1 combination is left out: fewer than 30 answers")
    assert found[2][0].startswith("2 combinations are")


def test_sankey_frame_keeps_links(frame):
    links = staged_funnel(frame(v=["I had no issues."] * 5), "v")
    assert sankey_frame(links).columns == ["link_pos", "source", "target", "value"]
    assert sankey_frame(links).count() == links.count() == 3


# --- the document -------------------------------------------------------------------


@pytest.fixture(scope="module")
def survey(spark, data_dir):
    _, catalog = load_catalog(spark, str(data_dir / "survey.yaml"))
    return read_responses(spark, str(data_dir / "responses.csv"), catalog)


def full_report(survey):
    crops = survey.multi("grows")
    plot, seasons = survey.col("plot"), survey.col("seasons")
    tab = CrossTab(plot, seasons, "y", y_order=SEASONS)
    return Report(
        year=2025,
        title="Allotments",
        intro_paragraphs=["One.", "Two."],
        sections=[
            ReportSection("people", "People", note="Small groups are hidden.", rows=[
                ReportRow("plot", "Plots", survey.prompt("plot"),
                          [Chart("bar", SingleCount(plot, **OFF), height=240)]),
                ReportRow("seasons", "Seasons", survey.prompt("seasons"),
                          [Chart("lollipop", SingleCount(seasons, order=SEASONS, **OFF))]),
            ]),
            ReportSection("tools", "Tools", rows=[
                ReportRow("grows", "Crops", survey.prompt("grows"), wide=True, charts=[
                    Chart("bar", MultiCount(crops, **OFF)),
                    Chart("upset", Combinations(crops, min_size=2, codes={"Beans": "bn"}), height=560),
                    Chart("heatmap", TraitTab(crops, seasons, "rate", x_order=SEASONS), low=0, high=100),
                    Chart("heatmap", TraitTab(crops, seasons, "lift", x_order=SEASONS)),
                ]),
                ReportRow("mixed", "Mixed", "q", commentary="Own words.", charts=[
                    Chart("bar", SingleCount(first_semver(survey.col("station")), **OFF)),
                    Chart("rank", RankCount(survey.ranking("chores"), bands=[(1, 2)])),
                    Chart("heatmap", tab), Chart("line", tab),
                    Chart("sankey", Flow(plot, seasons, "respondent_id", min_count=1)),
                    Chart("sankey", Funnel(seasons)),
                    Chart("likert", Likert(SingleCount(seasons, **OFF), ["Many"], ["First"], [])),
                    Chart("bar", SingleCount(plot, exclude=["Brook", "Hill", "Orchard"])),
                ]),
            ]),
        ],
    )


@pytest.fixture(scope="module")
def built(spark, survey, data_dir):
    notes = load_commentary(spark, str(data_dir / "commentary.md"))
    return build_report(survey.frame, full_report(survey), notes).persist()


@pytest.fixture(scope="module")
def document(built):
    row = built.first()
    assert (row.series, row.year) == ("community", 2025)
    return json.loads(row.document)


def test_document_structure(document):
    assert list(document) == [
        "schema_version", "series", "year", "title", "intro_meta", "intro_paragraphs", "sections",
    ]
    assert document["schema_version"] == 1 and document["intro_meta"] is None
    people, tools = document["sections"]
    assert list(people) == ["id", "heading", "note", "rows"]
    assert people["note"] == "Small groups are hidden." and tools["note"] is None
    row = people["rows"][0]
    assert list(row) == ["id", "title", "question", "commentary", "charts", "wide"]
    assert row["commentary"] == "The brook floods; people stay." and row["wide"] is False
    assert tools["rows"][0]["wide"] is True and tools["rows"][0]["commentary"] == ""


def test_optional_chart_fields(document):
    plots = document["sections"][0]["rows"][0]["charts"][0]
    assert plots["height"] == 240 and "caption" not in plots and "key" not in plots
    seasons = document["sections"][0]["rows"][1]["charts"][0]
    assert "height" not in seasons


def test_bar_data(document):
    option = document["sections"][0]["rows"][0]["charts"][0]["option"]
    assert option["yAxis"]["data"] == ["Orchard", "Hill", "Brook"]
    assert [s["data"] for s in option["series"]] == [[18.2, 36.4, 45.5]]
    lollipop = document["sections"][0]["rows"][1]["charts"][0]["option"]
    assert [s["type"] for s in lollipop["series"]] == ["bar", "pictorialBar"]
    assert lollipop["series"][1]["data"] == [9.1, 36.4, 27.3, 27.3]
    crops = document["sections"][1]["rows"][0]["charts"][0]["option"]
    assert crops["yAxis"]["data"] == ["Plums", "Leeks", "Kale", "Beans"]
    assert crops["series"][0]["data"] == [36.4, 36.4, 36.4, 54.5]


def test_other_chart_data(document):
    grows, mixed = document["sections"][1]["rows"]
    upset = grows["charts"][1]
    assert upset["caption"].endswith("| bn | Beans |")
    assert upset["option"]["rowAxis"]["data"] == ["bn", "Kale", "Leeks", "Plums"]
    # Beans with kale, beans with leeks, and plums alone stand twice each; four others once.
    assert [b["value"] for b in upset["option"]["sizes"]["data"]] == [2, 2, 2]
    assert len(upset["option"]["dots"]["data"]) == 4 * 3
    assert upset["option"]["subtext"].startswith("4 combinations are")
    rate, lift = grows["charts"][2]["option"], grows["charts"][3]["option"]
    assert rate["xAxis"]["data"] == SEASONS and rate["yAxis"]["data"] == ["Beans", "Kale", "Leeks", "Plums"]
    assert rate["visualMap"] == {"min": 0, "max": 100} and lift["visualMap"] == {"min": 0, "max": 2}
    assert len(rate["series"][0]["data"]) == 16
    version, rank, heat, line, flow, funnel, likert, empty = (c["option"] for c in mixed["charts"])
    assert version["yAxis"]["data"] == ["2.9.14", "Skipped", "No Match", "3.1.0", "3.0.1"]
    assert [s["name"] for s in rank["series"]] == ["1-2", "Unranked"]
    assert all(abs(sum(parts) - 100) < 0.2 for parts in zip(*(s["data"] for s in rank["series"])))
    assert [s["name"] for s in line["series"]] == SEASONS
    points = {(x, y): v for x, y, v in heat["series"][0]["data"]}
    assert [s["data"] for s in line["series"]] == [
        [points[x, y] for x in range(3)] for y in range(4)
    ]
    assert {n["name"] for n in flow["series"][0]["data"]} == {
        e for link in flow["series"][0]["links"] for e in (link["source"], link["target"])
    }
    assert funnel["series"][0] == {"type": "sankey", "data": [], "links": []}
    assert [(s["name"], s["data"]) for s in likert["series"]] == [("Many", [36.4]), ("First", [27.3])]
    assert mixed["charts"][6]["key"] == [{"label": "Many"}, {"label": "First"}]
    assert empty == {"yAxis": {"type": "category", "data": []}, "series": [{"type": "bar", "data": []}]}


def test_missing_commentary_fails(spark, survey):
    report = Report(2025, "t", [ReportSection("s", "S", [
        ReportRow("lonely", "L", "q", [Chart("bar", SingleCount(survey.col("seasons")))]),
    ])])
    notes = spark.createDataFrame([("other", "x")], "section_id string, body string")
    with pytest.raises(Exception, match="no commentary for row lonely"):
        build_report(survey.frame, report, notes).collect()


def test_chart_kinds_are_checked(survey):
    with pytest.raises(ValueError, match="unknown chart kind"):
        Chart("pie", SingleCount("x"))
    with pytest.raises(TypeError, match="cannot show"):
        Chart("rank", SingleCount("x"))
    row = ReportRow("same", "", "", [Chart("bar", SingleCount("x"))])
    twice = ReportRow("same", "", "", [Chart("bar", SingleCount("y"))])
    with pytest.raises(ValueError, match="more than once"):
        Report(1, "t", [ReportSection("s", "S", [row, twice])]).charts()


def test_write_read_and_index(spark, built, tmp_path):
    path = str(tmp_path / "reports")
    write_report(built, path)
    other = built.withColumn("year", F.lit(9999)).withColumn(
        "document", F.replace("document", F.lit('"year":2025'), F.lit('"year":9999'))
    )
    older = built.withColumn("year", F.lit(2024)).withColumn(
        "document", F.replace("document", F.lit('"year":2025'), F.lit('"year":2024'))
    )
    write_report(other, path)
    write_report(older, path)
    reports = read_reports(spark, path)
    assert reports.count() == 3
    assert [tuple(r) for r in report_index(reports).collect()] == [
        ("community", 2025, "Allotments"), ("community", 2024, "Allotments"),
    ]
    page = report_page(reports, "community", 2025).first()
    assert page.sections[0].rows[0].charts[0].toPython()["height"] == 240


def test_a_run_is_seen_whole_or_not_at_all(spark, built, frame, tmp_path):
    path = str(tmp_path / "published")
    bins = counts_single(frame(v=["a", "b", "b"]), "v", **OFF).withColumn("series", F.lit("community"))

    def titles():
        return sorted((r.year, r.title) for r in published_reports(spark, path).collect())

    assert titles() == [] and published(spark, path).count() == 0
    with pytest.raises(ValueError, match="no run has published"):
        published_frame(spark, path, "letters")
    both = built.unionByName(built.withColumn("year", F.lit(2024)).withColumn(
        "document", F.replace("document", F.lit('"year":2025'), F.lit('"year":2024'))))
    frames = {"letters": bins.withColumn("year", F.lit(2025)).unionByName(bins.withColumn("year", F.lit(2024)))}
    assert publish_run(path, both, frames) == 1
    assert titles() == [(2024, "Allotments"), (2025, "Allotments")]
    # The second run breaks off in its frame: its report is written, and not seen.
    newer = built.withColumn("document", F.replace("document", F.lit("Allotments"), F.lit("Gardens")))
    broken = bins.withColumn("year", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        publish_run(path, newer, {"letters": broken})
    assert len(list((tmp_path / "published" / "runs").iterdir())) == 2
    assert titles() == [(2024, "Allotments"), (2025, "Allotments")]
    assert published_frame(spark, path, "letters").count() == 4
    # A run replaces the years that it brings, and those only.
    fewer = {"letters": bins.limit(1).withColumn("year", F.lit(2025))}
    assert publish_run(path, newer, fewer) == 2
    assert titles() == [(2024, "Allotments"), (2025, "Gardens")]
    counts = published_frame(spark, path, "letters").groupBy("year").count().collect()
    assert {r.year: r["count"] for r in counts} == {2024: 2, 2025: 1}


def test_reader_defaults_and_version(spark, tmp_path):
    good = {"schema_version": 1, "year": 2020, "title": "Old", "sections": [
        {"id": "s", "heading": "S", "rows": [{"id": "r", "title": "R", "question": "q", "commentary": "", "charts": []}]},
    ]}
    (tmp_path / "good.json").write_text(json.dumps(good))
    row = read_reports(spark, str(tmp_path / "good.json")).first()
    assert row.series == "community" and row.sections[0].rows[0].wide is False
    (tmp_path / "good.json").write_text(json.dumps(good, indent=2) + "\n")
    assert read_reports(spark, str(tmp_path / "good.json")).first().title == "Old"
    (tmp_path / "lines.json").write_text(json.dumps(good) + "\n" + json.dumps({**good, "year": 2021}) + "\n")
    assert read_reports(spark, str(tmp_path / "lines.json"), multi_line=False).count() == 2
    (tmp_path / "bad.json").write_text(json.dumps({**good, "schema_version": 2}))
    with pytest.raises(Exception, match="unsupported report version 2"):
        read_reports(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "broken.json").write_text('{"schema_version": "one"}')
    with pytest.raises(Exception):
        read_reports(spark, str(tmp_path / "broken.json")).collect()


def test_write_frames(spark, frame, tmp_path):
    bins = counts_single(frame(v=["a", "b", "b"]), "v", **OFF)
    write_frames({"letters": bins}, str(tmp_path), series="s", year=2025)
    write_frames({"letters": bins.limit(1)}, str(tmp_path), series="s", year=2024)
    back = spark.read.parquet(str(tmp_path / "letters"))
    assert back.filter("year = 2025").count() == 2 and back.filter("year = 2024").count() == 1
