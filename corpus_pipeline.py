"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm import quality
from tally.llm.lines import without_later_lines
from tally.llm.minhash import Banding, first_of_each
from tally.llm.packing import Sizes, best_fit
from tally.llm.queries import held_out, table
from tally.llm.storage import stored
from tally.llm.substrings import without_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
QUALITY_FLOOR = 0.7
REPEATED_WORDS = 35


def _with_text(found: DataFrame) -> DataFrame:
    """Put shortened texts in place; documents of which nothing is left go."""
    blank = F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")
    left = found.where((F.col("n_removed") == 0) | blank)
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).withColumn("text", F.col("kept_text")).select(COLUMNS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; without labels of both kinds none is rejected."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out(4, 2))
    if not model.fitted:
        return docs.select(COLUMNS)
    return quality.scored(docs, model, carry=tuple(COLUMNS)).where(F.col("score") >= QUALITY_FLOOR).select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of lines go, whatever stands around them."""
    return _with_text(without_later_lines(docs, gram=1, window=1, carry=("doc_id", "lang", "source", "n_chars")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, also where rows repeat or have no id."""
    return first_of_each(docs, Banding()).select(COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur again go wherever they stand; texts without any stay as they are."""
    columns = ("doc_id", "lang", "source", "n_chars")
    return _with_text(without_repeats(docs, window=REPEATED_WORDS, carry=columns, rejoin=False))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return best_fit(docs, Sizes())


STAGES = [
    ("quality_classifier", quality_filter),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", packing),
]

# Neither the classifier nor the packing can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
