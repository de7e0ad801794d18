"""Column expressions for tag names and the legacy text formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Shapes of the legacy text records.
#   track line      ('TRACKID', (['tag1', 'tag2'], [1.0, 2.0, ...]))
#   tag-count line  ('tag',123)
#   metric lines    Area Under ROC = x / Area Under Precision-Recall = x / Total time: s
# ---------------------------------------------------------------------------

# Whole track line: id, the tag list body (greedy, so a ']' inside a tag is
# kept), and the number list body (no brackets inside).
TRACK_LINE_PATTERN = r"^\('((?:[^'\\]|\\.)*)', \(\[(.*)\], \[([^\[\]]*)\]\)\)\s*$"
# One quoted item of a printed list, single- or double-quoted.
QUOTED_ITEM_PATTERN = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
# Lazy bracket groups, the older way to find the two lists of a track line.
BRACKET_GROUP_PATTERN = r"\[.*?\]"
# Tag-count line.
TAG_COUNT_LINE_PATTERN = r"^\('(.*)',\s*(-?\d+)\)\s*$"
# Characters removed by the older tag-count cleaner.
TAG_COUNT_STRIP_PATTERN = r"['()]"


def clean_tag_name(tag: Column | str) -> Column:
    """File-safe tag name: spaces to underscores, backslashes dropped."""
    c = F.col(tag) if isinstance(tag, str) else tag
    return F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("\\"), F.lit(""))


def decode_byte_escapes(s: Column) -> Column:
    r"""Turn printed byte escapes (``am\xc3\xa9ricain``) back into UTF-8 text.

    ``\xNN`` becomes ``%NN`` and the result goes through ``try_url_decode``;
    literal ``%`` and ``+`` are escaped first so they survive. Strings without
    a byte escape are returned as they are.
    """
    escaped = F.replace(F.replace(s, F.lit("%"), F.lit("%25")), F.lit("+"), F.lit("%2B"))
    as_url = F.regexp_replace(escaped, r"\\x([0-9a-fA-F]{2})", "%$1")
    decoded = F.try_url_decode(as_url)
    return F.when(s.contains("\\x"), F.coalesce(decoded, s)).otherwise(s)


def unquote_item(item: Column) -> Column:
    """Strip the surrounding quotes of one printed item and undo escapes."""
    inner = F.substring(item, F.lit(2), F.length(item) - F.lit(2))
    unescaped = F.regexp_replace(inner, r"\\(['\"\\])", "$1")
    return decode_byte_escapes(unescaped)


def parse_printed_list(body: Column) -> Column:
    """ARRAY<STRING> from the body of a printed list of strings."""
    items = F.regexp_extract_all(body, F.lit(QUOTED_ITEM_PATTERN), 0)
    return F.transform(items, unquote_item)


def parse_number_list(body: Column) -> Column:
    """ARRAY<DOUBLE> from ``1.0, 2, -3.5``; unparsable items become NULL."""
    cleaned = F.regexp_replace(body, r"[\[\]\s]", "")
    parsed = F.transform(F.split(cleaned, ","), lambda x: x.try_cast("double"))
    return F.when(cleaned == "", F.array().cast("array<double>")).otherwise(parsed)
