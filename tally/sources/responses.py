"""Response files as one wide frame with questions looked up by id."""

from __future__ import annotations

import difflib
from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.functions import clean_single
from tally.sources.catalog import bind_questions, header_frame

RESPONDENT = "respondent_id"
ARRIVAL = "arrival"
# Counts of so many splits, of some 200 bytes each, may travel to every executor.
_FEW_SPLITS = 50_000


class Survey:
    """Responses of one survey: a lazy wide frame plus the question bindings.

    ``frame`` has ``respondent_id`` and string columns ``f0..fn``; nothing but the
    bindings lives on the driver. Questions are looked up by id, as items or
    attributes.
    """

    def __init__(self, frame: DataFrame, bindings: dict[str, dict[str, Any]]) -> None:
        self.frame = frame
        self._bindings = bindings

    def __getitem__(self, qid: str) -> Column | dict[str, Column] | list[Column]:
        kind = self._binding(qid)["type"]
        if kind == "multiple":
            return self.multi(qid)
        return self.ranking(qid) if kind == "ranking" else self.col(qid)

    def __getattr__(self, qid: str):
        bindings = self.__dict__.get("_bindings", {})
        if qid not in bindings:
            raise AttributeError(f"the survey asks nothing under {qid!r}")
        return self[qid]

    def __iter__(self) -> Iterator[str]:
        return iter(self._bindings)

    def __contains__(self, qid: object) -> bool:
        return qid in self._bindings

    def __len__(self) -> int:
        return len(self._bindings)

    def keys(self):
        return self._bindings.keys()

    def _binding(self, qid: str, *kinds: str) -> dict[str, Any]:
        binding = self._bindings.get(qid)
        if binding is None:
            near = difflib.get_close_matches(qid, self._bindings, n=3)
            hint = f"; close to it: {', '.join(near)}" if near else ""
            raise KeyError(f"the survey asks nothing under {qid!r}{hint}")
        if kinds and binding["type"] not in kinds:
            raise TypeError(f"{qid!r} was asked as {binding['type']}; this reads {' and '.join(kinds)} questions")
        return binding

    def type(self, qid: str) -> str:
        return self._binding(qid)["type"]

    def prompt(self, qid: str) -> str:
        return self._binding(qid)["prompt"]

    def headers(self, qid: str) -> list[str]:
        """Headers of the question's columns as written, in column order."""
        return list(self._binding(qid).get("headers", ()))

    def choices(self, qid: str) -> list[str]:
        return list(self._binding(qid, "multiple")["fields"])

    def col(self, qid: str) -> Column:
        """Cleaned answer of a single or text question."""
        return clean_single(F.col(f"f{self._binding(qid, 'single', 'text')['fields']}"))

    def multi(self, qid: str) -> dict[str, Column]:
        """Pick flags of a multiple question, by choice in choice order."""
        fields = self._binding(qid, "multiple")["fields"]
        return {choice: F.col(f"f{pos}") == F.lit("Yes") for choice, pos in fields.items()}

    def ranking(self, qid: str) -> list[Column]:
        """Rank columns of a ranking question, best first."""
        return [F.col(f"f{pos}") for pos in self._binding(qid, "ranking")["fields"]]

    def long_answers(self) -> DataFrame:
        """All answers unpivoted in one scan.

        ``(respondent_id, question_id, kind, choice, choice_pos, value)``. Multi
        and ranking answers keep only what was picked or placed.
        """
        rows = []
        for qid, binding in self._bindings.items():
            kind = binding["type"]
            if kind == "multiple":
                rows += [
                    (qid, kind, choice, i, F.when(flag, F.lit("Yes")))
                    for i, (choice, flag) in enumerate(self.multi(qid).items(), start=1)
                ]
            elif kind == "ranking":
                rows += [
                    (qid, kind, None, p, F.nullif(value, F.lit("")))
                    for p, value in enumerate(self.ranking(qid), start=1)
                ]
            else:
                rows.append((qid, kind, None, None, self.col(qid)))
        cells = []
        for qid, kind, choice, pos, value in rows:
            choice_cell = F.lit(choice).cast("string")
            cells += [F.lit(qid), F.lit(kind), choice_cell, F.lit(pos).cast("int"), value]
        answers = F.stack(F.lit(len(rows)), *cells).alias(
            "question_id", "kind", "choice", "choice_pos", "value"
        )
        # Only what was not picked or placed is null here: answers are cleaned.
        return self.frame.select(RESPONDENT, answers).filter(F.col("value").isNotNull())


def read_header(spark: SparkSession, path: str, *, multi_line: bool = False) -> list[str]:
    """Header fields as written, quotes removed and inner line breaks kept."""
    rows = spark.read.options(**csv_options(multi_line)).option("header", False).csv(path)
    first = rows.first()
    if first is None:
        raise ValueError(f"no header line in {path!r}")
    return ["" if value is None else value for value in first]


def csv_options(multi_line: bool) -> dict[str, str | bool | int]:
    """Fields stay text as written; only quotes are taken off."""
    return {
        "multiLine": multi_line,
        "quote": '"',
        "escape": '"',
        "maxCharsPerColumn": -1,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }


def comparable(headers: Sequence[str]) -> bool:
    """Whether Spark can compare a file's header with these names."""
    return all(headers) and len({h.lower() for h in headers}) == len(headers)


def header_schema(headers: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in headers])


def split_of_files(rows: DataFrame) -> DataFrame:
    """Rows straight from files as ``f0..fn`` and ``arrival (file, block)``, the split they come from."""
    split = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quoted = ["`{}`".format(name.replace("`", "``")) for name in rows.columns]
    fields = [F.col(name).alias(f"f{i}") for i, name in enumerate(quoted)]
    return rows.select(*fields, split.alias(ARRIVAL))


def with_arrival(rows: DataFrame, *before: Column) -> DataFrame:
    """Complete ``arrival`` to ``(.., file, block, row)`` on rows as they come from the scan.

    The key orders rows as their files lie, by path, by the place of the split in its
    file, and by row; a task that runs again gives the same keys. The rows of a split
    must still follow one another.
    """
    row = F.monotonically_increasing_id().alias("row")
    return rows.withColumn(ARRIVAL, F.struct(*before, F.col(f"{ARRIVAL}.file"), F.col(f"{ARRIVAL}.block"), row))


def numbered_arrival(rows: DataFrame, name: str) -> DataFrame:
    """Replace ``arrival`` by a BIGINT without gaps, from 1, in the same order.

    Rows are counted per split, and a split starts after all rows of the splits before
    it. Only the counts, one row for each split of the input, are put in order. They
    travel to the rows where their number is known to be small; else both sides are
    dealt by split, which are of one size.
    """
    splits_at_most = rows.rdd.getNumPartitions() + len(rows.inputFiles())
    key = [F.col(f"{ARRIVAL}.file").alias("__file"), F.col(f"{ARRIVAL}.block").alias("__block")]
    placed = rows.select("*", *key, F.col(f"{ARRIVAL}.row").alias("__row"))
    splits = placed.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = W.orderBy("__file", "__block").rowsBetween(W.unboundedPreceding, -1)
    starts = splits.select(
        "__file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    number = F.col("__start") + F.col("__row") - F.col("__first") + 1
    if splits_at_most <= _FEW_SPLITS:
        starts = F.broadcast(starts)
    joined = placed.join(starts, ["__file", "__block"]).withColumn(name, number)
    return joined.drop(ARRIVAL, "__file", "__block", "__row", "__first", "__start")


def read_fields(
    spark: SparkSession, path: str, headers: list[str], *, multi_line: bool = False
) -> DataFrame:
    """All fields as strings named ``f0..fn`` and their ``arrival``, in one lazy scan.

    Files whose header differs from ``headers`` fail the read. Headers with an
    empty or a repeated name, which Spark cannot compare, are allowed in a single
    file only. Files are read in splits; ``multi_line`` allows line breaks inside
    fields but reads each file in one task.
    """
    reader = spark.read.options(**csv_options(multi_line)).option("header", True)
    if comparable(headers):
        rows = reader.option("enforceSchema", False).schema(header_schema(headers)).csv(path)
    else:
        rows = reader.schema(header_schema([f"f{i}" for i in range(len(headers))])).csv(path)
        if len(rows.inputFiles()) > 1:
            raise ValueError("a header with an empty or repeated name can be read from one file only")
    return with_arrival(split_of_files(rows))


def read_responses(
    spark: SparkSession,
    path: str,
    catalog: DataFrame,
    *,
    id_header: str | None = None,
    multi_line: bool = False,
) -> Survey:
    """Match a response CSV to the catalog and return the survey.

    ``respondent_id`` (BIGINT) orders respondents by arrival. ``id_header`` names
    a column of whole numbers that do; anything else in it fails the query, and
    the text stays in its field. Without it rows are numbered from 1 without gaps, file
    after file by path, as if the files stood in one; that counts the rows of each split
    by a scan of its own. Set ``multi_line`` where fields or headers hold line breaks.
    """
    headers = read_header(spark, path, multi_line=multi_line)
    bindings = bind_questions(catalog, header_frame(spark, headers))
    fields = read_fields(spark, path, headers, multi_line=multi_line)
    if id_header is None:
        return Survey(numbered_arrival(fields, RESPONDENT), bindings)
    respondent = F.col(f"f{headers.index(id_header)}").cast("bigint")
    return Survey(fields.drop(ARRIVAL).withColumn(RESPONDENT, respondent), bindings)


def land_responses(survey: Survey, path: str) -> Survey:
    """Write the wide frame as Parquet once and go on from there.

    Later scans read only the questions they need, in splits of any number.
    """
    survey.frame.write.mode("overwrite").parquet(path)
    frame = survey.frame.sparkSession.read.schema(survey.frame.schema).parquet(path)
    return Survey(frame, survey._bindings)
