from tally.functions.categories import (
    check_order,
    first_semver,
    keep_values,
    map_values,
    map_values_join,
    ordinal_rank,
    string_array,
    yes_no,
)
from tally.functions.numeric import percent_of, round_tenths
from tally.functions.text import (
    bracket_base,
    bracket_suffix,
    clean_single,
    decode_entities,
    normalize_text,
    rank_position,
    strip_all_space,
    strip_space,
)

__all__ = [
    "bracket_base",
    "bracket_suffix",
    "check_order",
    "clean_single",
    "decode_entities",
    "first_semver",
    "keep_values",
    "map_values",
    "map_values_join",
    "normalize_text",
    "ordinal_rank",
    "percent_of",
    "rank_position",
    "round_tenths",
    "string_array",
    "strip_all_space",
    "strip_space",
    "yes_no",
]
