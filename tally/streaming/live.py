"""Live mode: recompute when new response files arrive.

``stream_counts`` keeps running counts as streaming state, one row per metric and
label. ``start_live_report`` counts each micro-batch once, adds its counts to the
totals so far and rebuilds the report from the totals, as a rerun over all files would.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tally.operators.counts import SingleCount, value_counts
from tally.operators.specs import name_column, named
from tally.plans.report import Report, merged_counts, report_counts, report_of_counts
from tally.sources.catalog import bind_questions, header_frame
from tally.sources.reports import write_report
from tally.sources.responses import (
    ARRIVAL,
    RESPONDENT,
    Survey,
    comparable,
    csv_options,
    header_schema,
    split_of_files,
    with_arrival,
)
from tally.storage import discard


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """Folder for a stream's progress under the cluster's shared checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set; pass a checkpoint folder")
    return f"{shared.rstrip('/')}/{name}"


def stream_fields(
    spark: SparkSession, folder: str, headers: Sequence[str], *, multi_line: bool = False
) -> DataFrame:
    """Response files of a folder as a stream of fields ``f0..fn`` and the split they come from, ``arrival``.

    A file whose header differs from ``headers`` fails the stream, so the names
    must be given and differ from one another.
    """
    if not comparable(headers):
        raise ValueError("a stream of files needs headers without empty or repeated names")
    rows = (
        spark.readStream.options(**csv_options(multi_line))
        .option("header", True)
        .option("enforceSchema", False)
        .schema(header_schema(headers))
        .csv(folder)
    )
    return split_of_files(rows)


def totals_folder(landed: str, batch_id: int) -> str:
    """Where the counts of all micro-batches up to this one lie."""
    return f"{landed}/through={batch_id}"


def stream_counts(stream: DataFrame, metrics: Mapping[str, SingleCount]) -> DataFrame:
    """Running ``(name, label, count)`` of single-choice metrics, without suppression.

    The counts are raw; apply the privacy floors with :func:`counts_single_family`
    before publishing.
    """
    names, specs = named(dict(metrics), "single-choice metric")
    return value_counts(stream, specs).select(
        name_column(names).alias("name"), "label", F.col("n").alias("count")
    )


def start_live_report(
    spark: SparkSession,
    catalog: DataFrame,
    report_of: Callable[[Survey], Report],
    *,
    folder: str,
    headers: Sequence[str],
    landed: str,
    output: str,
    commentary: DataFrame | None = None,
    checkpoint: str | None = None,
    multi_line: bool = False,
    once: bool = False,
) -> StreamingQuery:
    """Rebuild and write the report whenever response files arrive in ``folder``.

    A micro-batch reads its own files and the totals left by the one before, and writes
    new totals under ``landed``; no response is read twice, and the work does not grow
    with the number of batches. A batch that is run again after a failure starts from the
    same totals and replaces its own; totals no batch can need any more are removed.
    ``respondent_id`` is the batch, the file, the split and the row in it, which orders
    respondents by arrival. With ``once`` the query stops after the files present now. A
    changed report needs a new ``landed`` folder.
    """
    bindings = bind_questions(catalog, header_frame(spark, headers))

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        arrived = with_arrival(batch, F.lit(batch_id).cast("bigint").alias("batch"))
        survey = Survey(arrived.withColumnRenamed(ARRIVAL, RESPONDENT), bindings)
        report = report_of(survey)
        counts = report_counts(survey.frame, report)
        read = session.read.schema(counts.schema).parquet
        if batch_id > 0:
            counts = merged_counts(counts.unionByName(read(totals_folder(landed, batch_id - 1))))
        counts.write.mode("overwrite").parquet(totals_folder(landed, batch_id))
        write_report(report_of_counts(read(totals_folder(landed, batch_id)), report, commentary), output)
        if batch_id > 1:
            discard(session, totals_folder(landed, batch_id - 2))

    writer = (
        stream_fields(spark, folder, headers, multi_line=multi_line)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint or checkpoint_folder(spark, "live-report"))
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
