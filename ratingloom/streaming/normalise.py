"""From raw messages to one form: userId, movieId, rating, source, event_ts.

movieId stays text, because slugs are ids too. event_ts is epoch milliseconds; lines carry seconds. Works on batches and
streams alike. A message without a movie or a rating is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.fixed_values import LINE_SOURCE
from ratingloom.functions.once import computed_once
from ratingloom.functions.text import field, line_fields, real_number, whole_number
from ratingloom.sources.messages import is_json, json_ratings, message_fields, parsed_message


def _rated(rows: DataFrame) -> DataFrame:
    """F4, F5."""
    return rows.where(F.col("movieId").isNotNull() & F.col("rating").isNotNull())


def _line_columns(source: str) -> dict[str, Column]:
    """The normalised columns of a line split into `parts`."""
    parts = F.col("parts")
    seconds = whole_number(field(parts, 3), "bigint")
    return {
        "userId": field(parts, 0),
        "movieId": field(parts, 1),
        "rating": real_number(field(parts, 2)),
        "source": F.lit(source),
        "event_ts": F.try_multiply(seconds, F.lit(1000).cast("bigint")),
    }


def from_lines(messages: DataFrame, source: str = LINE_SOURCE) -> DataFrame:
    """`raw` rating lines; `source` is the tag of their origin."""
    split = computed_once(messages, "parts", line_fields(F.col("raw")))
    return _rated(split.select(*[column.alias(name) for name, column in _line_columns(source).items()]))


def from_json_messages(messages: DataFrame, schema: str = schemas.JSON_MESSAGE) -> DataFrame:
    """`raw` JSON messages; they name their source themselves."""
    return _rated(json_ratings(messages, schema).withColumnRenamed("timestamp", "event_ts"))


def from_mixed(
    messages: DataFrame, source: str = LINE_SOURCE, schema: str = schemas.OLDER_JSON_MESSAGE
) -> DataFrame:
    """Both formats in one `raw` column, told apart by the first character.

    Each row takes one of two branches of an expression; a union of two filtered branches would read the topic twice.
    """
    raw, json = F.col("raw"), F.col("json")
    told_apart = messages.where(raw.isNotNull()).select("raw", is_json(raw).alias("json"))
    parsed = computed_once(told_apart, "data", parsed_message(F.when(json, raw), schema), "raw", "json")
    split = computed_once(parsed, "parts", line_fields(F.when(~json, raw)), "json", "data")
    of_message = message_fields("data")
    of_message["event_ts"] = of_message.pop("timestamp")
    return _rated(
        split.select(
            *[
                F.when(json, of_message[name]).otherwise(column).alias(name)
                for name, column in _line_columns(source).items()
            ]
        )
    )


def unify(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both."""
    return first.unionByName(second)
