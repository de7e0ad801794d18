"""Column-level helpers: hashing, text formats, vector arithmetic."""

from tagloom.functions.hashing import unit_hash, unit_hash_sql
from tagloom.functions.text import (
    clean_tag_name,
    decode_byte_escapes,
    parse_number_list,
    parse_printed_list,
)
from tagloom.functions.vectors import (
    array_dot,
    dot_columns,
    features_array,
    round_sig,
    round_sig_sql,
)

__all__ = [
    "array_dot",
    "clean_tag_name",
    "decode_byte_escapes",
    "dot_columns",
    "features_array",
    "parse_number_list",
    "parse_printed_list",
    "round_sig",
    "round_sig_sql",
    "unit_hash",
    "unit_hash_sql",
]
