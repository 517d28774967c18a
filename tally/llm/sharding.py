"""Shards of nearly equal size by sampled splitters, in DataFrame operations only.

Records are ordered by the hash of their text, then by the hash of the record. Splitters
taken from a sample that prefers large records cut that order into ranges of about equal
size, also inside a text that fills many records; ranges that turn out overfull are cut again
by splitters of their own. The exact sizes of the ranges before it then give each record its
place in the whole order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tally.llm.storage import stored

_OVERHEAD = 16
_TWO_63 = 2.0**63


def _uniform(*columns: str) -> Column:
    """A repeatable number above 0 and at most 1."""
    return (F.xxhash64(*columns).cast("double") + _TWO_63 + 1024.0) / (2 * _TWO_63 + 2048.0)


def _drawn() -> Column:
    """Records with the smallest of these numbers are a draw with chances by size."""
    return -F.log(_uniform("key", "tie")) / F.col("size")


def splitters(records: DataFrame, ranges: int, sample: int) -> Column:
    """At most ``ranges - 1`` sorted positions that cut the records into ranges of equal size."""
    keys = (
        records.select(F.struct("key", "tie").alias("at"), _drawn().alias("draw"))
        .orderBy("draw", "at").limit(sample)
        .agg(F.sort_array(F.collect_list("at")).alias("cuts"))  # ``sample`` positions at most
    )
    every = f"(i * {ranges}) DIV size(cuts) > ((i - 1) * {ranges}) DIV size(cuts)"
    return keys.select(F.expr(f"array_distinct(filter(cuts, (c, i) -> i > 0 AND {every}))")).scalar()


def _range_of(cuts: str) -> Column:
    return F.expr(f"size(filter({cuts}, c -> c <= struct(key, tie)))")


def _subdivided(located: DataFrame, mean: Column, per_part: int) -> DataFrame:
    """Add ``part``: ranges of more than 3/2 of the mean are cut by splitters drawn inside them."""
    weighed = located.groupBy("range").agg(F.sum("size").alias("weight"))
    parts = weighed.select("range", F.ceil(F.col("weight") / mean).cast("int").alias("parts"))
    over = parts.where("parts > 1").join(
        weighed.where(F.col("weight") > 1.5 * mean).select("range"), "range"
    )
    order = W.partitionBy("range").orderBy("draw", "at")
    drawn = (
        located.join(F.broadcast(over), "range")  # a row for each range at most
        .select("range", "parts", F.struct("key", "tie").alias("at"), _drawn().alias("draw"))
        .withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= F.col("parts") * per_part)
    )
    every = "(i * parts) DIV size(cuts) > ((i - 1) * parts) DIV size(cuts)"
    cuts = drawn.groupBy("range", "parts").agg(F.sort_array(F.collect_list("at")).alias("cuts")).select(
        "range", F.expr(f"array_distinct(filter(cuts, (c, i) -> i > 0 AND {every}))").alias("own_cuts")
    )
    return located.join(F.broadcast(cuts), "range", "left").select(
        *located.columns, F.coalesce(_range_of("own_cuts"), F.lit(0)).alias("part")
    )


def shards(docs: DataFrame, shard_count: int, sample: int = 8192, ranges_per_shard: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs(doc_id, text, ...)``.

    The law is ``bytes``: a record counts the UTF-8 bytes of its text (none for null) plus
    16. Records are laid end to end in the order of their texts' hashes, and the line is cut
    into ``shard_count`` equal lengths; a record goes where its middle lies. So a shard
    differs from the mean by less than the records at its two ends, equal texts lie side by
    side, and a text that fills more than a shard is spread over several. ``slot`` numbers a
    shard's records from 0 without gaps. Null texts form one group, with a null
    ``text_crc32``; rows that repeat id and text are told apart in any order. ``grown_shard``
    is null under this law. Other columns are ignored. ``sample`` bounds the splitters' sample
    and with it what is broadcast; the shards do not depend on it.
    """
    if shard_count < 1:
        raise ValueError("there is at least one shard")
    records = docs.select(
        F.col("doc_id").cast("bigint"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + _OVERHEAD).cast("bigint").alias("size"),
        F.crc32("text").alias("text_crc32"),
        F.xxhash64("text").alias("key"),
    ).withColumn(
        # The row's place in the written table parts rows that repeat id and text.
        "tie", F.struct(F.xxhash64("doc_id", "key").alias("hash"), F.monotonically_increasing_id().alias("row"))
    )
    records = stored(records, "records")
    ranges = shard_count * ranges_per_shard
    located = records.withColumn("cuts", splitters(records, ranges, sample)).select(
        *records.columns, _range_of("cuts").alias("range")
    )
    located = stored(located, "located")
    total = located.agg(F.sum("size").alias("total"))
    mean = total.select(F.col("total") / ranges).scalar()
    fine = stored(_subdivided(located, mean, sample // ranges + 1), "ranges")
    along = W.orderBy("range", "part").rowsBetween(W.unboundedPreceding, -1)
    # A row for each range and part: about ``ranges`` of them, whatever the input.
    starts = fine.groupBy("range", "part").agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n")).select(
        "range", "part",
        F.coalesce(F.sum("weight").over(along), F.lit(0)).alias("weight_before"),
        F.coalesce(F.sum("n").over(along), F.lit(0)).alias("n_before"),
    )
    inside = W.partitionBy("range", "part").orderBy("key", "tie", "doc_id")
    placed = (
        fine.withColumn("nth", F.row_number().over(inside))
        .withColumn("until", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
        .join(F.broadcast(starts), ["range", "part"])
        .withColumn("total", total.scalar())
        .withColumn("place", F.col("n_before") + F.col("nth"))
        # Twice the middle of the record, on a line of twice the total.
        .withColumn("middle", 2 * (F.col("weight_before") + F.col("until")) - F.col("size"))
        .withColumn("shard", F.expr(f"CAST(least(middle * {shard_count} DIV (2 * total), {shard_count - 1}) AS INT)"))
        .select("doc_id", "size", "text_crc32", "shard", "place")
    )
    placed = stored(placed, "placed")
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))  # ``shard_count`` rows at most
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
