"""The question catalog and its match against the header of a response file."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.functions import bracket_base, bracket_suffix, normalize_text, rank_position

# The closed set of question types.
QUESTION_TYPES = ("single", "multiple", "ranking", "text")

CATALOG_SCHEMA = (
    "question_id string, position int, prompt string, type string, choices array<string>"
)
HEADER_SCHEMA = "pos int, raw string"


def question_catalog(spark: SparkSession, questions: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Catalog frame ``(question_id, position, prompt, type, choices, norm_prompt)``.

    Choices that a YAML reader turned into booleans read Yes and No again. Entries
    that break a rule of :func:`catalog_faults` are refused, all of them at once.
    """
    rows = [
        (
            None if q.get("id") is None else str(q["id"]),
            place,
            q.get("prompt"),
            q.get("type"),
            None if q.get("choices") is None else [_choice_text(c) for c in q["choices"]],
        )
        for place, q in enumerate(questions)
    ]
    catalog = spark.createDataFrame(rows, CATALOG_SCHEMA)
    # As many rows as the questionnaire has faulty entries.
    faults = catalog_faults(catalog).orderBy("position", "fault").collect()
    if faults:
        lines = [f"entry {f.position} ({f.question_id or 'no id'}): {f.fault}" for f in faults]
        raise ValueError("the questionnaire cannot be used:\n" + "\n".join(lines))
    return with_normal_prompts(catalog)


def with_normal_prompts(catalog: DataFrame) -> DataFrame:
    return catalog.withColumn("norm_prompt", normalize_text(F.col("prompt")))


def catalog_faults(catalog: DataFrame) -> DataFrame:
    """``(position, question_id, fault)``: entries of a catalog that break a rule.

    Every question has an id that can serve as an attribute name, no two share
    one, and its type is one of ``QUESTION_TYPES``.
    """
    name = F.col("question_id")
    checks = {
        "it has no id": name.isNull(),
        "its id is no attribute name": ~name.rlike(r"^[\p{L}_][\p{L}\p{Nd}_]*$"),
        "its id is taken by an earlier entry": F.col("uses") > 1,
        "its type is unknown": ~F.coalesce(F.col("type").isin(*QUESTION_TYPES), F.lit(False)),
    }
    by_id = F.row_number().over(W.partitionBy("question_id").orderBy("position"))
    numbered = catalog.withColumn("uses", F.when(name.isNotNull(), by_id))
    found = F.array_compact(F.array(*[F.when(broken, F.lit(text)) for text, broken in checks.items()]))
    return numbered.select("position", "question_id", F.explode(found).alias("fault"))


def _choice_text(choice: Any) -> str:
    if isinstance(choice, bool):
        return "Yes" if choice else "No"
    return str(choice)


def load_catalog(spark: SparkSession, path: str) -> tuple[str, DataFrame]:
    """Title and catalog of a questionnaire kept as one YAML or JSON document."""
    text = spark.read.text(path, wholetext=True).first()[0]
    if path.endswith(".json"):
        document = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:
            raise ImportError("reading a YAML questionnaire needs PyYAML; use JSON") from error
        document = yaml.safe_load(text)
    return document["title"], question_catalog(spark, document["questions"])


def header_frame(spark: SparkSession, headers: Sequence[str]) -> DataFrame:
    """The header line as a frame, with normal forms."""
    return header_forms(spark.createDataFrame(list(enumerate(headers)), HEADER_SCHEMA))


def header_forms(headers: DataFrame) -> DataFrame:
    """Normal forms of ``(pos, raw)``: ``(pos, raw, norm, norm_base, suffix, rank)``."""
    raw = F.col("raw")
    suffixed = headers.select(
        "pos",
        "raw",
        normalize_text(raw).alias("norm"),
        normalize_text(bracket_base(raw)).alias("norm_base"),
        bracket_suffix(raw).alias("suffix"),
    )
    return suffixed.withColumn("rank", rank_position(F.col("suffix")))


def match_headers(headers: DataFrame, catalog: DataFrame) -> DataFrame:
    """``(question_id, position, type, pos, raw, suffix, rank)`` per matched column.

    Single and text questions match a whole header, multiple and ranking questions
    the part before a bracketed suffix. Of headers with one normal form (and
    suffix) the last one wins.
    """
    whole = F.col("type").isin("single", "text")
    plain = catalog.filter(whole).join(headers, F.col("norm_prompt") == F.col("norm"))
    plain = plain.withColumn("suffix", F.lit(None).cast("string"))
    parts = catalog.filter(~whole).join(
        headers.filter(F.col("suffix").isNotNull()), F.col("norm_prompt") == F.col("norm_base")
    )
    keys = ["question_id", "position", "type", "suffix"]
    matched = plain.unionByName(parts)
    # Ranking columns keep every header; the others are unique per suffix.
    slot = F.when(F.col("type") == "ranking", F.col("pos"))
    return (
        matched.groupBy(*keys, slot.alias("slot"))
        .agg(F.max("pos").alias("pos"), F.max_by("raw", "pos").alias("raw"), F.first("rank").alias("rank"))
        .drop("slot")
    )


def missing_questions(catalog: DataFrame, matched: DataFrame) -> DataFrame:
    """Catalog rows that no column matches."""
    return catalog.join(matched.select("question_id").distinct(), "question_id", "left_anti")


def choice_mismatches(catalog: DataFrame, matched: DataFrame) -> DataFrame:
    """``(question_id, side, choice)``: choices on one side only, where any are declared.

    ``side`` is ``columns`` for columns without a declared choice and ``declared``
    for declared choices without a column.
    """
    closed = catalog.filter((F.col("type") == "multiple") & F.col("choices").isNotNull())
    declared = closed.select("question_id", F.explode("choices").alias("choice"), F.lit(1).alias("side"))
    present = matched.join(closed.select("question_id"), "question_id", "left_semi").select(
        "question_id", F.col("suffix").alias("choice"), F.lit(2).alias("side")
    )
    # Both sides meet in one aggregation: a bit for each says where a choice was seen.
    seen = declared.unionByName(present).groupBy("question_id", "choice").agg(F.bit_or("side").alias("sides"))
    side = F.when(F.col("sides") == 2, F.lit("columns")).otherwise(F.lit("declared"))
    return seen.filter("sides <> 3").select("question_id", side.alias("side"), "choice")


def binding_faults(catalog: DataFrame, matched: DataFrame) -> DataFrame:
    """``(question_id, fault, detail)``: what keeps questions from being bound to columns."""
    lonely = missing_questions(catalog, matched).select(
        "question_id", F.lit("no column fits its prompt").alias("fault"), F.col("prompt").alias("detail")
    )
    side = F.when(F.col("side") == "columns", F.lit("a column offers an undeclared choice")).otherwise(
        F.lit("a declared choice has no column")
    )
    choices = choice_mismatches(catalog, matched).select("question_id", side.alias("fault"), F.col("choice").alias("detail"))
    rankless = matched.filter((F.col("type") == "ranking") & F.col("rank").isNull()).select(
        "question_id", F.lit("a column of a ranking names no rank").alias("fault"), F.col("raw").alias("detail")
    )
    return lonely.unionByName(choices).unionByName(rankless)


def bind_questions(catalog: DataFrame, headers: DataFrame) -> dict[str, dict[str, Any]]:
    """Per question id: type, prompt, the header positions of its columns and the headers.

    Everything collected here is as small as the header line. All faults of
    :func:`binding_faults` are reported together.
    """
    matched = match_headers(headers, catalog)
    faults = binding_faults(catalog, matched).orderBy("question_id", "fault", "detail").collect()
    if faults:
        lines = [f"{f.question_id}: {f.fault}: {f.detail!r}" for f in faults]
        raise ValueError("questions and columns do not fit:\n" + "\n".join(lines))
    own: dict[str, list] = {}
    for row in matched.collect():
        own.setdefault(row["question_id"], []).append(row)
    bound = {}
    for question in catalog.orderBy("position").collect():
        qid, kind = question["question_id"], question["type"]
        found = sorted(own[qid], key=lambda r: r["pos"])
        if kind == "multiple":
            places = {r["suffix"]: r["pos"] for r in found}
            fields = {choice: places[choice] for choice in question["choices"] or places}
        elif kind == "ranking":
            fields = [r["pos"] for r in sorted(found, key=lambda r: r["rank"])]
        else:
            fields = found[0]["pos"]
        bound[qid] = {
            "type": kind, "prompt": question["prompt"], "fields": fields, "headers": [r["raw"] for r in found]
        }
    return bound
