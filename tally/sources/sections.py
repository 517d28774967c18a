"""Sectioned text: ``## identifier`` headings with bodies, and commentary lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions import strip_all_space

# Line ends that text readers recognise, all folded to \n first.
_LINE_ENDS = r"\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
# Fixed value: a second-level heading holding one identifier and nothing else.
_HEADING = r"(?Umd)^##[^\S\n]+([A-Za-z_][A-Za-z0-9_]*)[^\S\n]*$"


def sections(text: Column) -> Column:
    """``ARRAY<STRUCT<section_id, body>>`` of a text.

    Text before the first heading is dropped and bodies are trimmed; headings of
    other levels stay in the body. A repeated id keeps its first place and its
    last body.
    """
    lines = F.regexp_replace(text, _LINE_ENDS, "\n")
    ids = F.regexp_extract_all(lines, F.lit(_HEADING), F.lit(1))
    parts = F.split(lines, _HEADING)
    # A one-element transform binds both arrays, so the text is scanned once.
    once = F.array(F.struct(ids.alias("ids"), parts.alias("parts")))
    return F.transform(once, _latest_sections)[0]


def _latest_sections(text: Column) -> Column:
    ids, parts = text["ids"], text["parts"]

    def section(sid: Column) -> Column:
        # parts[0] precedes the first heading, so heading i (1-based) owns parts[i].
        last = F.size(ids) - F.array_position(F.reverse(ids), sid) + 1
        body = F.element_at(parts, (last + 1).cast("int"))
        return F.struct(sid.alias("section_id"), strip_all_space(body).alias("body"))

    return F.transform(F.array_distinct(ids), section)


def split_sections(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, pos, section_id, body)``: one row per section, no shuffle."""
    rows = df.select(*keep, F.posexplode(sections(F.col(text))).alias("__pos", "__section"))
    return rows.select(
        *keep,
        (F.col("__pos") + 1).alias("pos"),
        F.col("__section.section_id").alias("section_id"),
        F.col("__section.body").alias("body"),
    )


def load_commentary(spark: SparkSession, path: str) -> DataFrame:
    """``(section_id, body)`` of the commentary in one document or a folder of them.

    A section that several documents have takes the body of the last path.
    """
    documents = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("path"))
    found = split_sections(documents, "value", ["path"])
    return found.groupBy("section_id").agg(F.max_by("body", "path").alias("body"))


def attach_commentary(rows: DataFrame, commentary: DataFrame, *, key: str = "row_id") -> DataFrame:
    """Add ``commentary`` to report rows; a row without a section fails the query.

    Rows never multiply: of several bodies of a section the greatest is taken.
    """
    notes = commentary.groupBy(F.col("section_id").alias(key)).agg(F.max(F.struct("body")).alias("__note"))
    missing = F.raise_error(F.concat(F.lit("no commentary for row "), F.col(key))).cast("string")
    return (
        rows.join(notes, key, "left")
        .withColumn(
            "commentary",
            F.when(F.col("__note").isNull(), missing).otherwise(F.col("__note.body")),
        )
        .drop("__note")
    )


def rows_without_commentary(
    rows: DataFrame, commentary: DataFrame, *, key: str = "row_id"
) -> DataFrame:
    """Report rows that have no section."""
    return rows.join(commentary.select(F.col("section_id").alias(key)), key, "left_anti")
