"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the code points a Unicode-wide strip removes
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def between_bytes(byte: Column, low: int, high: int) -> Column:
    return byte.between(F.lit(bytes([low])), F.lit(bytes([high])))


def strip(text: Column) -> Column:
    """Remove white space of any script from both ends.

    Trimming a character set walks the whole text. The outer bytes tell for
    most texts that there is nothing to trim: white space is either ASCII up
    to a blank, or a character led by byte C2, E1, E2 or E3.
    """
    raw = text.cast("binary")
    first, last, before = F.substring(raw, 1, 1), F.substring(raw, -1, 1), F.substring(raw, -2, 1)
    clean_start = (
        between_bytes(first, 0x21, 0x7F)
        | between_bytes(first, 0xC3, 0xE0)
        | between_bytes(first, 0xE4, 0xFF)
    )
    # a two-byte character at the end, or a single byte
    clean_end = between_bytes(last, 0x21, 0x7F) | between_bytes(before, 0xC3, 0xDF)
    return F.when(clean_start & clean_end, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def strip_line(line: Column) -> Column:
    """``strip`` for JSON lines: one that already starts and ends with a brace is left alone."""
    bare = line.startswith("{") & line.endswith("}")
    return F.when(bare, line).otherwise(strip(line))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def is_blank(text: Column) -> Column:
    return F.ltrim(text_or_empty(text), F.lit(WHITESPACE)) == ""


def end_with_dot(text: Column) -> Column:
    return F.when(text.endswith("."), text).otherwise(F.concat(text, F.lit(".")))


def key_hash(*texts: Column) -> Column:
    """A narrow, exact-in-practice stand-in for a tuple of texts of any length.

    A digest of the parts' digests: no two tuples run together, and null
    differs from empty. Shuffles move 32 bytes instead of whole texts, and
    each text expression is evaluated once.
    """
    parts = [F.coalesce(F.sha2(t, 256), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat_ws("/", *parts), 256))


def code_point_sum(text: Column) -> Column:
    """Sum of the code points of a text, 0 for null or empty."""
    letters = F.filter(F.split(text_or_empty(text), ""), lambda c: c != "")
    return F.aggregate(letters, F.lit(0).cast("bigint"), lambda total, c: total + F.ascii(c))
