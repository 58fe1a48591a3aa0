"""Rating and movie lines.

Each parser takes a DataFrame with a `value` column, so the same code serves text files, tables and streams. Three levels
of strictness exist on purpose: lenient (any line, bad fields become NULL), strict (exactly four fields) and, in
`ratingloom.streaming.normalise`, the stream form (movie and rating must be there).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.fixed_values import LINE_FIELD_COUNT
from ratingloom.functions.once import computed_once
from ratingloom.functions.text import field, has_field_count, line_fields, real_number, trimmed, whole_number


def read_lines(spark: SparkSession, path: str, charset: str | None = None) -> DataFrame:
    """Text lines as `value`. Text is UTF-8 unless another `charset` is named."""
    lines = spark.read.text(path)
    if charset is None:
        return lines
    return lines.select(F.decode(F.col("value").cast("binary"), charset).alias("value"))


def _split(lines: DataFrame, line: Column, *keep: str) -> DataFrame:
    return computed_once(lines, "parts", line_fields(line), *keep)


def lenient_ratings(lines: DataFrame) -> DataFrame:
    """Every non-NULL line as userId, movieId, rating, timestamp."""
    parts = F.col("parts")
    return _split(lines.where(F.col("value").isNotNull()), F.col("value")).select(
        whole_number(field(parts, 0)).alias("userId"),
        whole_number(field(parts, 1)).alias("movieId"),
        real_number(field(parts, 2)).alias("rating"),
        whole_number(field(parts, 3), "bigint").alias("timestamp"),
    )


def lenient_movies(lines: DataFrame) -> DataFrame:
    """Every non-NULL line as movieId, title, genres."""
    parts = F.col("parts")
    return _split(lines.where(F.col("value").isNotNull()), F.col("value")).select(
        whole_number(field(parts, 0)).alias("movieId"),
        field(parts, 1).alias("title"),
        field(parts, 2).alias("genres"),
    )


def _complete_lines(lines: DataFrame, *keep: str) -> DataFrame:
    """`parts` of the trimmed lines of exactly four fields; an empty line has only one."""
    split = _split(lines, trimmed(F.col("value")), *keep)
    return split.where(has_field_count(F.col("parts"), LINE_FIELD_COUNT))


def strict_ratings(lines: DataFrame) -> DataFrame:
    """S3: movieId and rating of complete lines, both still text."""
    parts = F.col("parts")
    return _complete_lines(lines).select(field(parts, 1).alias("movieId"), field(parts, 2).alias("rating"))


def replay_lines(lines: DataFrame) -> DataFrame:
    """Complete lines whole, without the blanks around them, and the movie they belong to."""
    return _complete_lines(lines, "value").select(
        field(F.col("parts"), 1).alias("movieId"), trimmed(F.col("value")).alias("line")
    )


def read_ratings(spark: SparkSession, path: str, charset: str | None = None) -> DataFrame:
    return lenient_ratings(read_lines(spark, path, charset))


def read_movies(spark: SparkSession, path: str, charset: str | None = None) -> DataFrame:
    return lenient_movies(read_lines(spark, path, charset))


def read_strict_ratings(spark: SparkSession, path: str) -> DataFrame:
    return strict_ratings(read_lines(spark, path))
