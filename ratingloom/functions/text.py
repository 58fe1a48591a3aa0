"""Text expressions: splitting, trimming, lenient number parsing, slugs."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.fixed_values import FIELD_SEPARATOR

_BLANKS = "".join(map(chr, range(0x21)))

# Fixed value: what a browser's numeric test of a string accepts (blank, decimal, hex, binary, octal, Infinity).
NUMERIC_ID_PATTERN = (
    r"^\s*([+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|Infinity)|0[xX][0-9a-fA-F]+|0[bB][01]+|0[oO][0-7]+)?\s*$"
)


def trimmed(text: Column) -> Column:
    """Strip every character up to U+0020 from both ends, so tabs and other control characters go too."""
    return F.btrim(text, F.lit(_BLANKS))


def line_fields(line: Column) -> Column:
    """All `::` fields, empty ones included."""
    return F.split(line, FIELD_SEPARATOR, -1)


def field(parts: Column, position: int) -> Column:
    """One field, NULL where the line is too short (`getItem` would fail under ANSI)."""
    return F.get(parts, F.lit(position))


def has_field_count(parts: Column, count: int) -> Column:
    """exactly `count` fields once empty fields at the end are dropped."""
    size = F.size(parts)
    last_is_filled = field(parts, count - 1) != ""
    rest_is_empty = F.concat_ws("", F.slice(parts, F.lit(count + 1), F.greatest(size, F.lit(1)))) == ""
    return (size >= count) & last_is_filled & ((size == count) | rest_is_empty)


def whole_number(text: Column, data_type: str = "int") -> Column:
    """An integer, with a fraction cut off (`1.9` is 1); NULL if it is no number or out of range.

    A cast that fails is slow, so it gets only text that starts like a number and has no fraction, or digits already
    picked out.
    """
    looks_plain = (text < ":") & (text != "") & ~text.contains(".")
    digits = F.regexp_extract(text, r"^[\x00-\x20]*([+-]?\d+)(?:\.\d*)?[\x00-\x20]*$", 1)
    return F.when(looks_plain, text).otherwise(F.nullif(digits, F.lit(""))).try_cast(data_type)


def real_number(text: Column) -> Column:
    """A double, NULL if it is no number. NaN and Infinity count only in exactly that spelling.

    Here too the cast gets only text that starts like a number.
    """
    starts_with_digit = (text >= "0") & (text < ":")
    starts_like_number = text.rlike(r"^[\x00-\x20]*[+-]?([0-9.]|NaN|Infinity)")
    return F.when(starts_with_digit | starts_like_number, text).try_cast("double")


def strip_slashes(text: Column) -> Column:
    """Drop one slash at either end."""
    return F.regexp_replace(text, "^/|/$", "")


def is_numeric_id(text: Column) -> Column:
    """Ids that stand for a number, as opposed to slugs."""
    return text.rlike(NUMERIC_ID_PATTERN)


def words_from_slug(slug: Column) -> Column:
    """C14: hyphens to spaces and the first ASCII letter of each word to upper case; everything else stays."""
    pieces = F.split(F.translate(slug, "-", " "), "(?<![A-Za-z0-9_])(?=[a-z])")

    def capitalised(piece: Column) -> Column:
        first = F.translate(F.substring(piece, 1, 1), string.ascii_lowercase, string.ascii_uppercase)
        return F.concat(first, F.substr(piece, F.lit(2)))

    return F.array_join(F.transform(pieces, capitalised), "")
