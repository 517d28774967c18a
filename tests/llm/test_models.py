"""Language, quality and the whole pipeline on held-out and odd documents."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tally.llm import language, quality
from tally.llm.queries import QUERIES, held_out
from tally.llm.storage import stored
from tally.llm.words import words_of
from tests.llm.test_texts import brute_classes, brute_lines, brute_repeats, ordered

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, "  \n"), (4, "12 34 !!"), (5, "x" * 200_000), (None, "a b"), (6, "the"), (6, "the")]


def slow_code_length(counts, text):
    """Bits of a text by escape and exclusion, one byte at a time."""
    bits = 0.0
    for i, byte in enumerate(text):
        excluded, sizes = set(), range(min(i, 3), -1, -1)
        for size in sizes:
            seen = {b: n for b, n in counts.get(text[i - size : i], {}).items() if b not in excluded}
            if not seen:
                continue
            total = sum(seen.values()) + len(seen)
            if byte in seen:
                bits -= math.log2(seen[byte] / total)
                break
            bits -= math.log2(len(seen) / total)
            excluded |= set(seen)
        else:
            bits += math.log2(256 - len(excluded))
    return bits


def test_code_lengths_are_exact():
    draw = random.Random(1)
    training = {"x": b"abracadabra, abra", "y": b"mississippi abba"}
    counts = {lang: {} for lang in training}
    for lang, text in training.items():
        for i, byte in enumerate(text):
            for size in range(min(i, 3) + 1):
                own = counts[lang].setdefault(text[i - size : i], {})
                own[byte] = own.get(byte, 0) + 1
    rows = [
        (lang, len(c), int.from_bytes(c, "big"), b, n) for lang, own in counts.items() for c, bs in own.items() for b, n in bs.items()
    ]
    model = language.Model(rows)
    texts = ["".join(draw.choice("abcrmisp ,é") for _ in range(draw.randrange(0, 30))) for _ in range(40)]
    for data, first, part in language.texts_of(pa.array(texts)):
        got = model.lengths(data, first)
        expected = [[slow_code_length(counts[lang], t.encode()) for lang in model.langs] for t in texts[part]]
        assert np.allclose(got, expected, rtol=1e-5)


def test_language_of_held_out_documents(spark):
    found = QUERIES["op5_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 200 and sum(r.lang == r.lang_pred for r in rows) > 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_have_a_language(spark, documents):
    learned = [(10 + i, t) for i, t in enumerate(["alpha beta", "beta alpha"])]
    docs = documents(ODD + learned)
    model = language.fit(docs, F.col("doc_id") >= 10)
    rows = language.predicted(docs, model).collect()
    assert len(rows) == len(ODD) + 2
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert [by_id[i] for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert by_id[5] == by_id[6] == ("xx", 1.0)
    untaught = language.predicted(docs, language.fit(docs, F.lit(False))).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert language.predicted(docs.limit(0), model).collect() == []


def test_quality_of_held_out_documents(spark):
    found = QUERIES["op6_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = found.where("held_out").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    better = sum(g > b for g in good for b in bad) + 0.5 * sum(g == b for g in good for b in bad)
    assert better > 0.95 * len(good) * len(bad)
    assert sum(g >= 0.7 for g in good) > 0.97 * len(good)


def test_odd_texts_have_a_score(spark, documents):
    docs = documents(ODD)
    labels = spark.createDataFrame(
        [(4, 0, 0), (5, 1, 0), (6, 1, None), (6, 1, 0), (2, None, 1), (None, 1, 0), (3, 0, 0), (3, 1, 0), (77, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    small = quality.Settings(buckets=4096, dim=8, hidden=4, epochs=3)
    for known in (labels, labels.where("quality = 1"), labels.limit(0)):
        model = quality.fit(docs, known, F.lit(True), small)
        rows = quality.scored(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows} == {0.5}
    assert quality.scored(docs.limit(0), model).collect() == []


def test_temperature_calibrates():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(4000, 3))
    chance = 1 / (1 + np.exp(-x[:, 0]))
    y = (draw.random(4000) < chance).astype(float)
    net = quality.train(x, y, hidden=16, epochs=15, seed=1)
    assert np.abs(net.score(x) - chance).mean() < 0.08


def test_a_repeated_word_has_another_form():
    [words] = words_of(pa.array(["ab ab cd", "cd"]))
    _, form = quality.token_ids(words, 4096)
    assert form[0] != form[1] and form[2] == form[3]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Inputs and outputs of all stages, each written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0)], docs.schema))
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs, after
        docs = after
    return out


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stage_columns(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "minhash_near_dedup", "substring_dedup", "best_fit_packing"]
    for name in names[:-1]:
        before, after = stages[name]
        assert after.schema == before.schema


def test_quality_stage_keeps_clean_documents(spark, stages):
    _, after = stages["quality_classifier"]
    kept = {i for i, _ in texts(after)}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").where(held_out(4, 2)).collect()]
    good, bad = [r.doc_id in kept for r in labels if r.quality == 1], [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.2 * len(bad)


def shortened(rows):
    return ordered((i, kept) for i, _, n, kept in rows if not n or WORD.search(kept))


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    assert ordered(texts(after)) == shortened(brute_lines(texts(before), 1))


def test_near_stage(stages):
    before, after = stages["minhash_near_dedup"]
    rows = texts(before)
    expected = [row for row, (*_, kept) in zip(rows, brute_classes(rows, 5, 80)) if kept]
    assert ordered(texts(after)) == ordered(expected)


def test_substring_stage(stages):
    before, after = stages["substring_dedup"]
    rows = brute_repeats(texts(before), corpus_pipeline.REPEATED_WORDS)
    same = dict(texts(before))
    # Texts without a repeated passage stay byte by byte.
    expected = [(i, n, m, kept if m else same[i]) for i, n, m, kept in rows]
    assert ordered(texts(after)) == shortened(expected)


def test_packing_stage(stages):
    before, after = stages["best_fit_packing"]
    assert after.agg(F.sum("length")).first()[0] == sum(len(WORD.findall(t)) + 1 for _, t in texts(before) if t is not None)


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").where("length > 0").count() > 50


@pytest.mark.parametrize("labelled", ["none", "bad", "good"])
def test_a_classifier_without_both_labels_rejects_nothing(spark, tmp_path, labelled):
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    quality_of = {"none": None, "bad": 0, "good": 1}[labelled]
    labels = spark.read.parquet(f"{source}/labels.parquet").withColumn("quality", F.lit(quality_of).cast("int"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = corpus_pipeline.quality_filter(spark, docs, str(tmp_path))
    assert kept.columns == corpus_pipeline.COLUMNS and kept.exceptAll(docs.select(kept.columns)).count() == 0
    assert kept.count() == docs.count()


@pytest.mark.parametrize("with_labels", [True, False])
def test_run_on_empty_documents(spark, tmp_path, with_labels):
    source = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        rows = spark.read.parquet(f"{source}/{name}.parquet")
        rows = rows if with_labels and name == "labels" else rows.limit(0)
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_without_labels_keeps_documents(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{source}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).where("length > 0")
    assert packed.select("doc_id").distinct().count() > docs.count() / 2


def test_repeated_rows_and_rows_without_ids_end_as_one(spark):
    """Clean texts of the corpus that stand twice, under the same id and under none."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    draw = random.Random(8)
    made = [" ".join(f"{draw.choice('abcdefgh')}{draw.randrange(10**5)}" for _ in range(60)) for _ in range(3)]
    rows = [(10**7, made[0]), (10**7, made[0]), (None, made[1]), (None, made[1]), (10**7 + 1, made[2])]
    other = made[1].split()
    rows.append((None, " ".join([*other[:-1], "changed"])))  # without an id too, and linked
    rows += [(10**7 + 2, ""), (None, None)]
    kept = docs.limit(0).unionByName(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], docs.schema))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        kept = stored(stage(spark, kept, SF), name)
    found = texts(kept)
    assert [found.count((10**7 + i, t)) for i, t in ((0, made[0]), (1, made[2]), (2, ""))] == [1, 1, 1]
    [alone] = [t for i, t in found if i is None and t is not None]
    assert alone in (made[1], rows[5][1])
    assert len(found) == 5
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).where("length > 1").groupBy("doc_id").agg(F.sum("length"))
    assert sorted(map(tuple, packed.collect()), key=str) == [(10**7, 61), (10**7 + 1, 61), (None, 61)]
