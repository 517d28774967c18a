"""Report documents and metric frames on storage."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The document version this reader accepts, the series a document
# without one belongs to, and the year that marks demonstration documents.
SCHEMA_VERSION = 1
DEFAULT_SERIES = "community"
DEMO_YEAR = 9999

REPORT_SCHEMA = """
    schema_version int,
    series string,
    year int,
    title string,
    intro_meta string,
    intro_paragraphs array<string>,
    sections array<struct<
        id: string,
        heading: string,
        note: string,
        rows: array<struct<
            id: string,
            title: string,
            question: string,
            commentary: string,
            charts: array<variant>,
            wide: boolean
        >>
    >>
"""


def write_report(report: DataFrame, path: str) -> None:
    """Write built reports as JSON lines, one folder per series and year.

    Only the folders of the given reports are replaced.
    """
    (
        report.select("series", "year", "document")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("series", "year")
        .text(path)
    )


def write_frames(frames: Mapping[str, DataFrame], path: str, *, series: str, year: int) -> None:
    """Write metric frames of any size as Parquet under ``<path>/<name>``."""
    for name, frame in frames.items():
        (
            frame.withColumn("series", F.lit(series))
            .withColumn("year", F.lit(year))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("series", "year")
            .parquet(f"{path}/{name}")
        )


# What a run published: its place in the order of runs, and the folder under it that holds a
# series and year of a kind (report or frame) and name.
MANIFEST_SCHEMA = "run long, kind string, name string, series string, year int, folder string"


def publish_run(path: str, reports: DataFrame, frames: Mapping[str, DataFrame] | None = None) -> int:
    """Write reports ``(series, year, document)`` and metric frames as one run; returns its number.

    Frames have columns ``series`` and ``year``. All files of a run lie in a folder of its
    own, which nobody reads before the run's manifest is there; the manifest is one file,
    written last. A run that breaks off before leaves files that are never seen, and what
    earlier runs published stays as it was. A later run replaces the series and years that it
    brings, each kind and name for itself. One writer publishes at a time.
    """
    spark = reports.sparkSession
    folder = f"runs/{uuid.uuid4().hex}"
    written = {("report", "report"): f"{folder}/report"}
    write_report(reports, f"{path}/{folder}/report")
    for name, frame in (frames or {}).items():
        written["frame", name] = f"{folder}/frames/{name}"
        frame.write.partitionBy("series", "year").parquet(f"{path}/{folder}/frames/{name}")
    run = (_manifest(spark, path).agg(F.max("run")).first()[0] or 0) + 1
    parts = []
    for (kind, name), place in written.items():
        source = reports if kind == "report" else frames[name]
        held = source.select(F.col("series").cast("string"), F.col("year").cast("int")).distinct()
        parts.append(held.select(
            F.lit(run).cast("long").alias("run"), F.lit(kind).alias("kind"), F.lit(name).alias("name"), "series", "year",
            F.lit(place).alias("folder"),
        ))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows.coalesce(1).write.json(f"{path}/manifests/run={run}")
    return run


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifests of all runs that were published whole."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifests")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", True).json(folder.toString())


def published(spark: SparkSession, path: str) -> DataFrame:
    """``(kind, name, series, year, run, folder)``: what can be read, from the latest run that has it."""
    keys = ["kind", "name", "series", "year"]
    latest = _manifest(spark, path).groupBy(*keys).agg(F.max(F.struct("run", "folder")).alias("latest"))
    return latest.select(*keys, "latest.run", "latest.folder")


def _published_parts(spark: SparkSession, path: str, kind: str, name: str) -> list[tuple[str, DataFrame]]:
    """The folders of a kind and name, and the series and years to take from each; one row a run and year."""
    found = published(spark, path).where((F.col("kind") == kind) & (F.col("name") == name))
    folders = [row.folder for row in found.select("folder").distinct().orderBy("folder").collect()]
    return [(f"{path}/{folder}", found.where(F.col("folder") == folder).select("series", "year")) for folder in folders]


def published_reports(spark: SparkSession, path: str) -> DataFrame:
    """The reports that runs published, as :func:`read_reports` gives them."""
    parts = _published_parts(spark, path, "report", "report")
    if not parts:
        return _checked(spark.createDataFrame([], REPORT_SCHEMA))
    frames = [read_reports(spark, folder, multi_line=False).join(held, ["series", "year"], "left_semi") for folder, held in parts]
    return _all(frames)


def published_frame(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A metric frame that runs published."""
    parts = _published_parts(spark, path, "frame", name)
    if not parts:
        raise ValueError(f"no run has published a frame {name!r}")
    return _all([spark.read.parquet(folder).join(held, ["series", "year"], "left_semi") for folder, held in parts])


def _all(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def read_reports(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Report documents with the enforced schema and defaults filled in.

    A file holds one document, indented or not; without ``multi_line`` it holds
    one on each line. Malformed documents and other versions fail the read. Series
    and year come from the documents, not from folder names.
    """
    documents = (
        spark.read.schema(REPORT_SCHEMA)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("recursiveFileLookup", True)
        .json(path)
    )
    return _checked(documents)


def parse_reports(df: DataFrame, document: str) -> DataFrame:
    """Like :func:`read_reports` for documents held in a string column."""
    parsed = F.from_json(document, REPORT_SCHEMA, {"mode": "FAILFAST"})
    return _checked(df.select(parsed.alias("__report")).select("__report.*"))


def _checked(documents: DataFrame) -> DataFrame:
    version = F.col("schema_version")
    found = F.coalesce(version.cast("string"), F.lit("(none)"))
    wrong = F.raise_error(F.concat(F.lit("unsupported report version "), found))
    checked = F.when(version == SCHEMA_VERSION, version).otherwise(wrong.cast("int"))
    rows = F.transform(
        "sections",
        lambda s: s.withField(
            "rows",
            F.transform(
                s["rows"],
                lambda r: r.withField("wide", F.coalesce(r["wide"], F.lit(False))),
            ),
        ),
    )
    return documents.withColumns(
        {
            "schema_version": checked,
            "series": F.coalesce("series", F.lit(DEFAULT_SERIES)),
            "sections": rows,
        }
    )


def report_index(reports: DataFrame) -> DataFrame:
    """``(series, year, title)`` of published reports, newest year first."""
    return (
        reports.filter(F.col("year") != DEMO_YEAR)
        .select("series", "year", "title")
        .orderBy(F.desc("year"), "series")
    )


def report_page(reports: DataFrame, series: str, year: int) -> DataFrame:
    """The report of one series and year."""
    return reports.filter((F.col("series") == series) & (F.col("year") == year))
