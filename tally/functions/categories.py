"""Free text or raw values to categories, as column expressions."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.text import SKIPPED, blank_to_null, strip_space

# Default spellings counted as yes and as no.
YES_ALIASES = ("yes", "y", "yep", "yeah", "yes.", "yes!")
NO_ALIASES = ("no", "n", "nope", "nah", "no.", "no!", "no :(")
# Categories a yes/no answer may take, in display order.
YES_NO_LABELS = ("Yes", "No", "Other", SKIPPED)
# Fixed value: label of text that holds no version.
NO_MATCH = "No Match"
# Fixed value: major.minor.patch without leading zeros, not touching other digits.
SEMVER_PATTERN = (
    r"(?:^|[^0-9])((?:0|[1-9]\d*)\.(?:0|[1-9]\d*)\.(?:0|[1-9]\d*))(?:$|[^0-9])"
)
# Every version contains this.
_DOTTED = r"[0-9]\.[0-9]+\.[0-9]"

# Literal maps are scanned, so a larger mapping is dealt into maps of about this size.
_ENTRIES_PER_MAP = 8


def yes_no(
    value: Column,
    *,
    yes_aliases: Iterable[str] | None = None,
    no_aliases: Iterable[str] | None = None,
    skipped_label: str | None = None,
) -> Column:
    """Classify free text as Yes, No, Other or Skipped.

    Given alias sets replace the defaults. Text that was already replaced by a
    skipped label counts as Other unless ``skipped_label`` names that label.
    """
    yes = sorted(YES_ALIASES if yes_aliases is None else yes_aliases)
    no = sorted(NO_ALIASES if no_aliases is None else no_aliases)
    text = F.lower(strip_space(value.cast("string")))
    skipped = text.isNull() | (text == "")
    if skipped_label is not None:
        skipped = skipped | (text == skipped_label.lower())
    return (
        F.when(skipped, F.lit(SKIPPED))
        .when(text.isin(yes), F.lit("Yes"))
        .when(text.isin(no), F.lit("No"))
        .otherwise(F.lit("Other"))
    )


def first_semver(
    value: Column, *, skipped_label: str = SKIPPED, no_match_label: str = NO_MATCH
) -> Column:
    """First ``major.minor.patch`` in the text, or the skipped / no-match label."""
    text = F.coalesce(blank_to_null(value), F.lit(skipped_label))
    # Most text fails the plain test, which is far cheaper than the extraction.
    found = F.when(text.rlike(_DOTTED), F.nullif(F.regexp_extract(text, SEMVER_PATTERN, 1), F.lit("")))
    return F.when(text == skipped_label, F.lit(skipped_label)).otherwise(
        F.coalesce(found, F.lit(no_match_label))
    )


def keep_values(df: DataFrame, column: Column, exclude: Sequence[str] | None) -> DataFrame:
    """Drop rows whose value is excluded; with a list, nulls are dropped too."""
    return df.filter(~column.isin(list(exclude))) if exclude else df


def map_values(value: Column, mapping: Mapping[str, str] | None) -> Column:
    """Group values by a mapping of any size; unmapped values pass through.

    The mapping becomes part of the plan: a value's checksum names the one short
    map that may hold it. :func:`map_values_join` takes mappings kept in a table.
    """
    if not mapping:
        return value
    count = -(-len(mapping) // _ENTRIES_PER_MAP)
    dealt: list[list[Column]] = [[] for _ in range(count)]
    for entry in mapping.items():
        dealt[zlib.crc32(entry[0].encode()) % count] += [F.lit(part) for part in entry]
    maps = F.array(*[F.create_map(*pairs).cast("map<string,string>") for pairs in dealt])
    own = F.get(maps, (F.crc32(value) % count).cast("int"))
    return F.coalesce(F.try_element_at(own, value), value)


def map_values_join(
    df: DataFrame, column: str, mapping: DataFrame, *, key: str, label: str
) -> DataFrame:
    """Like :func:`map_values` for a mapping kept in a table of any size.

    The join strategy is left to the optimizer, which broadcasts only a side
    whose size it knows to be small. ``key`` must be unique in ``mapping``.
    """
    lookup = mapping.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    joined = df.join(lookup, df[column] == F.col("__key"), "left")
    mapped = F.coalesce(F.col("__label"), F.col(column))
    return joined.withColumn(column, mapped).drop("__key", "__label")


def check_order(order: Sequence[str] | None) -> None:
    """An ordinal scale must not list a value twice."""
    if order is not None and len(set(order)) != len(order):
        repeated = sorted({v for v in order if list(order).count(v) > 1})
        raise ValueError(f"values listed more than once in an order: {repeated}")


def string_array(values: Sequence[str] | None) -> Column:
    if values is None:
        return F.lit(None).cast("array<string>")
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def ordinal_rank(value: Column, order: Column) -> Column:
    """Zero-based index of the value in an order array; unlisted values rank last.

    A null order gives every value rank 0.
    """
    index = F.nullif(F.array_position(order, value), F.lit(0).cast("bigint")) - 1
    rank = F.coalesce(index, F.size(order).cast("bigint"))
    return F.when(order.isNull(), F.lit(0).cast("bigint")).otherwise(rank)
