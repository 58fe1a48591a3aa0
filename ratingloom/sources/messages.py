"""JSON rating messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom import schemas
from ratingloom.fixed_values import JSON_FIRST_CHARACTER
from ratingloom.functions.once import computed_once

_REJECTED = "_rejected"


def text_of(payload: Column) -> Column:
    """Message bytes as text."""
    return payload.cast("string")


def is_json(raw: Column) -> Column:
    """Told by the first character, without trimming."""
    return raw.startswith(JSON_FIRST_CHARACTER)


def parsed_message(raw: Column, schema: str = schemas.JSON_MESSAGE) -> Column:
    """The message as a struct, NULL for text that is no JSON object; `message_fields` takes it apart."""
    # Lines that got among the messages are told by their first character; that spares them a failing parse.
    text = F.when(F.ltrim(raw, F.lit(" \t\r\n")).startswith(JSON_FIRST_CHARACTER), raw)
    return F.from_json(text, f"{schema}, {_REJECTED} STRING", {"columnNameOfCorruptRecord": _REJECTED})


def message_fields(data: str) -> dict[str, Column]:
    """P5: userId, movieId, rating, source, timestamp of the parsed column `data`.

    A message counts as a whole: one declared field of the wrong type makes all fields NULL.
    """
    accepted = F.col(f"{data}.{_REJECTED}").isNull()
    return {
        name: F.when(accepted, F.col(f"{data}.{name}")) for name in ("userId", "movieId", "rating", "source", "timestamp")
    }


def json_ratings(messages: DataFrame, schema: str = schemas.JSON_MESSAGE) -> DataFrame:
    """The fields of the `raw` column, all NULL for a message that is rejected."""
    parsed = computed_once(messages, "data", parsed_message(F.col("raw"), schema))
    return parsed.select(*[column.alias(name) for name, column in message_fields("data").items()])
