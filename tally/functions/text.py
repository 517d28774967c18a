"""Text cleaning as column expressions.

Everything stays in the JVM except HTML entity decoding, which has no built-in
and goes through one Arrow-batched pandas UDF over the standard library decoder.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label that stands for "no answer".
SKIPPED = "Skipped"

# Unicode White_Space, and the four ASCII separators that text
# readers also fold. Explicit sets trim natively; F.trim strips only U+0020.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SEPARATORS = "\x1c\x1d\x1e\x1f"

# On whole texts the Unicode class is faster than a set of this many ranges.
_SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
_BRACKETED = r"(?s)^(.*)(?U:\s*)\[([^\]]+)\](?U:\s*)$"


def strip_space(value: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(value, F.lit(WHITE_SPACE))


def strip_all_space(value: Column) -> Column:
    """Like :func:`strip_space`, ASCII separators included."""
    return F.btrim(value, F.lit(WHITE_SPACE + SEPARATORS))


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip_space(value.cast("string")), F.lit(""))


def clean_single(value: Column, skipped_label: str = SKIPPED) -> Column:
    """Trimmed answer text; null, empty and blank become the skipped label."""
    return F.coalesce(blank_to_null(value), F.lit(skipped_label))


@F.pandas_udf(T.StringType())
def decode_entities(values: pd.Series) -> pd.Series:
    """Decode HTML character references, one pass (``&amp;gt;`` -> ``&gt;``)."""
    return values.map(html.unescape, na_action="ignore")


def normalize_text(value: Column) -> Column:
    """Canonical form of a prompt, used to compare prompts with headers.

    White space runs (no-break space included) fold to one space, doubled double
    quotes to one, entities are decoded, list markers ``" - "`` become a space,
    and the ends are trimmed.
    """
    folded = F.regexp_replace(value, _SPACE_RUN, " ")
    unquoted = F.replace(folded, F.lit('""'), F.lit('"'))
    decoded = decode_entities(unquoted)
    unlisted = F.replace(decoded, F.lit(" - "), F.lit(" "))
    return strip_all_space(F.regexp_replace(unlisted, _SPACE_RUN, " "))


def bracket_base(header: Column) -> Column:
    """Text before a trailing ``[suffix]``; the header itself when there is none."""
    base = F.rtrim(F.regexp_extract(header, _BRACKETED, 1), F.lit(WHITE_SPACE + SEPARATORS))
    return F.when(header.rlike(_BRACKETED), base).otherwise(header)


def bracket_suffix(header: Column) -> Column:
    """Trimmed, entity-decoded content of a trailing ``[suffix]``, else null."""
    inner = strip_all_space(F.regexp_extract(header, _BRACKETED, 2))
    return F.when(header.rlike(_BRACKETED), decode_entities(inner))


def rank_position(suffix: Column) -> Column:
    """Position of a ``Rank <n>`` suffix as INT, null for any other suffix."""
    digits = F.regexp_extract(suffix, r"(?U)^Rank\s+(\d+)$", 1)
    return F.nullif(digits, F.lit("")).cast("int")
