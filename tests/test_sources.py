import json

import pytest
from pyspark.sql import functions as F

from tally.functions import bracket_base, bracket_suffix, normalize_text, rank_position
from tally.operators import counts_multi, counts_single
from tally.functions import first_semver
from tally.sources import (
    attach_commentary,
    choice_mismatches,
    header_frame,
    land_responses,
    load_catalog,
    load_commentary,
    match_headers,
    missing_questions,
    question_catalog,
    read_responses,
    rows_without_commentary,
    split_sections,
)
from tally.storage import shared_folder


@pytest.fixture(scope="module")
def survey(spark, data_dir):
    title, catalog = load_catalog(spark, str(data_dir / "survey.yaml"))
    assert title == "Allotment Survey"
    return read_responses(spark, str(data_dir / "responses.csv"), catalog)


def single(name, prompt, choices=None):
    return {"id": name, "prompt": prompt, "type": "single", "choices": choices}


def write(path, text):
    path.write_text(text)
    return str(path)


def test_catalog_keeps_order_types_and_choices(spark, data_dir):
    rows = load_catalog(spark, str(data_dir / "survey.yaml"))[1].orderBy("position").collect()
    assert [r.question_id for r in rows] == ["plot", "grows", "chores", "station", "seasons", "water", "fence"]
    assert [r.type for r in rows] == ["single", "multiple", "ranking", "text", "single", "multiple", "single"]
    assert rows[1].choices == ["Beans", "Kale", "Leeks", "Plums"]
    assert rows[3].choices is None
    assert rows[6].choices == ["Yes", "No"]
    asked = "Did the council ask you before it moved the fence and the gate of your plot?"
    assert rows[6].norm_prompt == asked


def test_catalog_from_json(spark, tmp_path):
    document = {"title": "t", "questions": [single("a", "A?", ["x", 2.5])]}
    title, catalog = load_catalog(spark, write(tmp_path / "q.json", json.dumps(document)))
    assert title == "t" and catalog.first().choices == ["x", "2.5"]


@pytest.mark.parametrize(
    "questions, message",
    [
        ([{"prompt": "hi", "type": "single"}], "it has no id"),
        ([single("1bad", "hi")], "no attribute name"),
        ([single("dup", "a"), single("dup", "b")], "taken by an earlier entry"),
        ([{"id": "a", "prompt": "a", "type": "slider"}], "its type is unknown"),
    ],
)
def test_catalog_rejects(spark, questions, message):
    with pytest.raises(ValueError, match=message):
        question_catalog(spark, questions)


@pytest.mark.parametrize(
    "raw, normal",
    [
        ("  hello   world ", "hello world"),
        ("a\nb\tc", "a b c"),
        ("a\r\nb", "a b"),
        ("a b", "a b"),
        ('run ""this"" now', 'run "this" now'),
        ("a &gt; b &amp;amp; c", "a > b &amp; c"),
        ("list:\n  - one\n  - two", "list: one two"),
        ("tail&nbsp;", "tail"),
        (None, None),
    ],
)
def test_normalize_text(spark, raw, normal):
    df = spark.createDataFrame([(raw,)], "s string")
    once = df.select(normalize_text(F.col("s")).alias("s"))
    assert once.first().s == normal
    if raw is None or "&amp;" not in raw:
        assert once.select(normalize_text(F.col("s"))).first()[0] == normal


@pytest.mark.parametrize(
    "header, base, suffix, rank",
    [
        ("Which OS? [GNU/Linux]", "Which OS?", "GNU/Linux", None),
        ("Rank priorities. [Rank 3]", "Rank priorities.", "Rank 3", 3),
        ("Where do you live?", "Where do you live?", None, None),
        ("Some [topic] question. [answer]", "Some [topic] question.", "answer", None),
        ("Two\nlines [a &gt; b] ", "Two\nlines", "a > b", None),
        ("Ranks [Rank 1a]", "Ranks", "Rank 1a", None),
    ],
)
def test_bracket_suffix(spark, header, base, suffix, rank):
    df = spark.createDataFrame([(header,)], "h string")
    found = df.select(bracket_base(F.col("h")), bracket_suffix(F.col("h")).alias("s"))
    row = found.withColumn("r", rank_position(F.col("s"))).first()
    assert tuple(row) == (base, suffix, rank)


def test_questions_are_matched_by_prompt(survey):
    assert list(survey) == ["plot", "grows", "chores", "station", "seasons", "water", "fence"]
    assert survey.frame.count() == 11
    assert survey.choices("water") == ["Well", "Rain"]
    assert len(survey.ranking("chores")) == 2
    assert survey.prompt("plot") == "Which plot is yours?"
    assert survey.type("chores") == "ranking"


def test_blank_answers(survey):
    station = [r[0] for r in survey.frame.select(survey["station"]).collect()]
    assert station.count("Skipped") == 2
    second_rank = [r[0] for r in survey.frame.select(survey.chores[1]).collect()]
    assert second_rank.count(None) == 3


def test_golden_counts(survey):
    off = {"min_percent": None, "min_count": None}

    def shares(df):
        return [(r.label, r["count"], r.percent) for r in df.orderBy("pos").collect()]

    def of(*pairs):
        return [(label, n, pytest.approx(100 * n / 11)) for label, n in pairs]

    plot = counts_single(survey.frame, survey.col("plot"), **off)
    assert shares(plot) == of(("Brook", 5), ("Hill", 4), ("Orchard", 2))
    scale = ["First", "Some", "Many", "All my life"]
    seasons = counts_single(survey.frame, survey.col("seasons"), order=scale, **off)
    assert shares(seasons) == of(("First", 3), ("Some", 3), ("Many", 4), ("All my life", 1))
    grows = counts_multi(survey.frame, survey.multi("grows"), **off)
    assert shares(grows) == of(("Beans", 6), ("Kale", 4), ("Leeks", 4), ("Plums", 4))
    assert shares(counts_multi(survey.frame, survey.multi("water"), **off)) == of(("Rain", 8), ("Well", 3))
    fence = counts_single(survey.frame, survey.col("fence"), **off)
    assert shares(fence) == of(("No", 7), ("Yes", 3), ("Skipped", 1))
    version = counts_single(survey.frame, first_semver(survey.col("station")), **off)
    assert shares(version) == of(("3.0.1", 3), ("3.1.0", 3), ("No Match", 2), ("Skipped", 2), ("2.9.14", 1))


def test_all_faults_of_a_catalog_are_named_together(spark):
    wrong = [single("ok", "A"), {"prompt": "B", "type": "single"}, {**single("ok", "C"), "type": "dial"}]
    with pytest.raises(ValueError) as error:
        question_catalog(spark, wrong)
    assert [line.split(":")[0] for line in str(error.value).splitlines()[1:]] == [
        "entry 1 (no id)", "entry 2 (ok)", "entry 2 (ok)",
    ]


def test_unknown_question_names_close_ones(survey):
    with pytest.raises(KeyError, match="nothing under 'waters'; close to it: water"):
        survey["waters"]
    with pytest.raises(AttributeError, match="nothing under 'nope'"):
        survey.nope
    with pytest.raises(TypeError, match="'water' was asked as multiple"):
        survey.col("water")
    assert [h[h.index("["):] for h in survey.headers("water")] == ["[Well]", "[Rain]"]
    assert len(survey.headers("seasons")) == 1


def test_missing_column(spark, tmp_path):
    path = write(tmp_path / "r.csv", '"Something else"\n"value"\n')
    for kind in ("single", "multiple"):
        catalog = question_catalog(spark, [{"id": "q", "prompt": "Q?", "type": kind}])
        with pytest.raises(ValueError, match="q: no column fits its prompt: 'Q[?]'"):
            read_responses(spark, path, catalog)


def test_all_binding_faults_are_named_together(spark, tmp_path):
    path = write(tmp_path / "r.csv", '"Tree? [oak]","Tree? [fig]","Best [Rank 1]","Best [Later]"\n"Yes","No","a","b"\n')
    questions = [
        {"id": "tree", "prompt": "Tree?", "type": "multiple", "choices": ["oak", "elm", "ash"]},
        {"id": "best", "prompt": "Best", "type": "ranking"},
    ]
    with pytest.raises(ValueError) as error:
        read_responses(spark, path, question_catalog(spark, questions))
    assert str(error.value).splitlines()[1:] == [
        "best: a column of a ranking names no rank: 'Best [Later]'",
        "tree: a column offers an undeclared choice: 'fig'",
        "tree: a declared choice has no column: 'ash'",
        "tree: a declared choice has no column: 'elm'",
    ]


def test_ranks_sort_by_number_and_open_choices_keep_column_order(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        '"R [Rank 10]","R [Rank 2]","M [z]","M [a]"\n"ten","two","Yes","No"\n',
    )
    questions = [
        {"id": "r", "prompt": "R", "type": "ranking"},
        {"id": "m", "prompt": "M", "type": "multiple"},
    ]
    survey = read_responses(spark, path, question_catalog(spark, questions))
    assert list(survey.frame.select(*survey.ranking("r")).first()) == ["two", "ten"]
    assert survey.choices("m") == ["z", "a"]


def test_headers_with_one_normal_form_last_wins(spark, tmp_path):
    path = write(tmp_path / "r.csv", '" Q3 ","Q3"\n"first","last"\n')
    survey = read_responses(spark, path, question_catalog(spark, [single("q", "Q3")]))
    assert survey.frame.select(survey.q).first()[0] == "last"


def test_header_and_cells_with_line_breaks_quotes_and_dots(spark, tmp_path):
    path = write(
        tmp_path / "r.csv",
        '"Say ""x.y""\nin `two` lines","T"\n"a\nb","007"\n"\t ","2.10"\n',
    )
    catalog = question_catalog(
        spark, [single("q", 'Say "x.y" in `two` lines'), {"id": "t", "prompt": "T", "type": "text"}]
    )
    survey = read_responses(spark, path, catalog, multi_line=True)
    rows = survey.frame.select(survey.q.alias("q"), survey.t.alias("t")).collect()
    assert [tuple(r) for r in rows] == [("a\nb", "007"), ("Skipped", "2.10")]


def test_frame_level_checks(spark):
    questions = [
        {"id": "m", "prompt": "M", "type": "multiple", "choices": ["a", "b"]},
        single("gone", "Gone?"),
    ]
    catalog = question_catalog(spark, questions)
    matched = match_headers(header_frame(spark, ["M [a]", "M [c]"]), catalog)
    assert [r.question_id for r in missing_questions(catalog, matched).collect()] == ["gone"]
    found = {(r.side, r.choice) for r in choice_mismatches(catalog, matched).collect()}
    assert found == {("columns", "c"), ("declared", "b")}


def test_long_answers_and_landing(survey, tmp_path):
    landed = land_responses(survey, str(tmp_path / "landed"))
    for source in (survey, landed):
        answers = source.long_answers()
        kinds = {r.kind: r["count"] for r in answers.groupBy("kind").count().collect()}
        assert kinds == {"single": 33, "text": 11, "multiple": 29, "ranking": 18}
    picks = landed.long_answers().filter("question_id = 'grows'").groupBy("choice").count()
    assert {r.choice: r["count"] for r in picks.collect()} == {"Beans": 6, "Kale": 4, "Leeks": 4, "Plums": 4}


def test_explicit_respondent_id_is_a_number(spark, tmp_path):
    path = write(tmp_path / "r.csv", '"id","Q"\n"10","a"\n"9","b"\n"11","a"\n')
    catalog = question_catalog(spark, [single("q", "Q")])
    survey = read_responses(spark, path, catalog, id_header="id")
    assert dict(survey.frame.dtypes)["respondent_id"] == "bigint"
    assert [r.f0 for r in survey.frame.orderBy("respondent_id").collect()] == ["9", "10", "11"]
    odd = write(tmp_path / "odd.csv", '"id","Q"\n"r9","a"\n')
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_responses(spark, odd, catalog, id_header="id").frame.collect()


def test_repeated_headers_need_a_single_file(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        write(folder / name, '"Q3","Q3"\n"first","last"\n')
    with pytest.raises(ValueError, match="one file only"):
        read_responses(spark, str(folder), question_catalog(spark, [single("q", "Q3")]))


def test_commentary(spark, data_dir):
    notes = {r.section_id: r.body for r in load_commentary(spark, str(data_dir / "commentary.md")).collect()}
    assert notes == {
        "seasons": "Old hands are few.\n\n### Of the first-timers\n\nHalf left by June.",
        "grows": "",
        "plot": "The brook floods; people stay.",
    }


def test_commentary_of_a_folder_has_one_body_per_section(spark, tmp_path):
    write(tmp_path / "1.md", "## a\nold\n## b\nonly\n")
    write(tmp_path / "2.md", "## a\nnew\n")
    assert {r.section_id: r.body for r in load_commentary(spark, str(tmp_path)).collect()} == {"a": "new", "b": "only"}
    rows = spark.createDataFrame([("a",)], "row_id string")
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "section_id string, body string")
    assert [r.commentary for r in attach_commentary(rows, twice).collect()] == ["y"]


def test_sections_edge_cases(spark):
    text = (
        "lost\r\n## a\r\none\r\n##  b  \x0btwo\n## 9bad\n##c\n## d e\n"
        "## a\nnewer\n\n## tail"
    )
    df = spark.createDataFrame([(1, text), (2, "no headings"), (3, None)], "k int, t string")
    rows = split_sections(df, "t", ["k"]).orderBy("k", "pos").collect()
    assert [tuple(r) for r in rows] == [
        (1, 1, "a", "newer"),
        (1, 2, "b", "two\n## 9bad\n##c\n## d e"),
        (1, 3, "tail", ""),
    ]


def test_attach_commentary(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "row_id string")
    notes = spark.createDataFrame([("a", "text"), ("c", "")], "section_id string, body string")
    assert [r.row_id for r in rows_without_commentary(rows, notes).collect()] == ["b"]
    assert attach_commentary(rows.filter("row_id = 'a'"), notes).first().commentary == "text"
    with pytest.raises(Exception, match="no commentary for row b"):
        attach_commentary(rows, notes).collect()


def test_arrival_over_several_files_is_that_of_one(spark, tmp_path):
    """Rows of three files, each read in several splits, are numbered as if they stood in one."""
    folder = tmp_path / "answers"
    folder.mkdir()
    whole = []
    for name, rows in (("a", 700), ("b", 1), ("c", 350)):
        answers = [f"{name}{i}" for i in range(rows)]
        (folder / f"{name}.csv").write_text("How?\n" + "".join(f"{a}\n" for a in answers))
        whole += answers
    catalog = question_catalog(spark, [{"id": "how", "prompt": "How?", "type": "text"}])
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        survey = read_responses(spark, str(folder), catalog)
        assert survey.frame.select("f0").rdd.getNumPartitions() > 3
        for _ in range(2):
            got = {r.respondent_id: r.f0 for r in survey.frame.collect()}
            assert got == dict(enumerate(whole, start=1))
        landed = land_responses(survey, str(tmp_path / "landed"))
        assert {r.respondent_id: r.f0 for r in landed.frame.collect()} == got
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_a_cluster_without_a_shared_folder_is_refused():
    class Session:
        def __init__(self, **settings):
            self.conf = self
            self.settings = settings

        def get(self, name, default=None):
            return self.settings.get(name, default)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
            shared_folder(Session(**{"spark.master": master}))
    assert shared_folder(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "/shared/x/"})) == "/shared/x"
