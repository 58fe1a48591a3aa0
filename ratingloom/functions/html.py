"""Expressions over the text of an HTML page.

Pages are matched as text. A row runs from `<tr>` to the next row, the next `</tr>` or the end of its table, so end tags
may be missing; a table inside a table cell is not told apart. Attribute values are taken as written, in double or
single quotes, without decoding entities.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.fixed_values import PAGE_ROW_CLASS, RATED_CLASS_PREFIX
from ratingloom.functions.text import strip_slashes

_ROW_REST = r".*?(?=</?tr[\s>]|</t(?:able|body|foot|head)[\s>]|\z)"

# What marks a row, a user link and a rating on a page.
ROW_PATTERN = rf"(?is)<tr(?:\s[^>]*)?>{_ROW_REST}"
MARKED_ROW_PATTERN = (
    rf"""(?is)<tr\s(?:[^>]*?\s)?class\s*=\s*["'](?:[^"'>]*\s)?{PAGE_ROW_CLASS}(?:\s[^"'>]*)?["'][^>]*>{_ROW_REST}"""
)
LINK_PATTERN = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']([^"'>]*/[^"'>]*)["']"""
RATED_CLASS_PATTERN = rf"""(?is)<[a-z][^>]*?\sclass\s*=\s*["']([^"'>]*{RATED_CLASS_PREFIX}[^"'>]*)["']"""
RATED_TOKEN_PATTERN = rf"(?:^|\s){RATED_CLASS_PREFIX}([+-]?\d+)(?:\s|$)"


def marked_rows(html: Column) -> Column:
    """The table rows of the marked class."""
    return F.regexp_extract_all(html, F.lit(MARKED_ROW_PATTERN), F.lit(0))


def all_rows(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(ROW_PATTERN), F.lit(0))


def links(html: Column) -> Column:
    """Targets of all links that contain a slash."""
    return F.regexp_extract_all(html, F.lit(LINK_PATTERN), F.lit(1))


def first_link(html: Column) -> Column:
    return F.regexp_extract(html, LINK_PATTERN, 1)


def user_name(link: Column) -> Column:
    """The single path segment a link consists of; NULL if there is none or more than one."""
    name = strip_slashes(link)
    return F.when((name != "") & ~name.contains("/"), name)


def rated_class(html: Column) -> Column:
    """The class attribute of the first element that has `rated-` in it."""
    return F.regexp_extract(html, RATED_CLASS_PATTERN, 1)


def raw_rating(class_attribute: Column) -> Column:
    """N of the first class `rated-N`; NULL unless it is a positive number."""
    value = F.regexp_extract(class_attribute, RATED_TOKEN_PATTERN, 1).try_cast("int")
    return F.when(value > 0, value)


def scaled_rating(raw: Column) -> Column:
    """From 1..10 to 0.5..5.0."""
    return raw / F.lit(2.0)
