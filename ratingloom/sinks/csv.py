"""CSV and tab-separated outputs (K1, K2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quotes are doubled, and blanks around a value are part of it, so that reading back gives the same values.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Written, a NULL is nothing and an empty text is `""`. Readers have to name a NULL that no file contains to tell the two
# apart again.
CSV_READ_OPTIONS = {**CSV_OPTIONS, "nullValue": "\u0000"}


def on_one_line(text: Column) -> Column:
    """`text` with its line breaks written as `\\n` and `\\r`, as readers take a file line by line."""
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def write_csv(rows: DataFrame, path: str) -> None:
    """K1: replace the CSV output at `path`.

    AQE merges the partitions of a small sorted result, which becomes one file; a large one is written by many tasks.
    """
    rows.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_strict_means(lines: DataFrame, path: str) -> None:
    """K2: replace the text output at `path` with the lines of `ratingloom.operators.stats.strict_mean_lines`."""
    lines.write.mode("overwrite").text(path)
