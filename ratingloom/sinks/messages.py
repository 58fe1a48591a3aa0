"""Keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.fixed_values import JSON_SOURCE
from ratingloom.functions.keys import clock_ms


def line_messages(replayed: DataFrame) -> DataFrame:
    """key = movie, value = the whole line, from `movieId` and `line`."""
    return replayed.select(F.col("movieId").alias("key"), F.col("line").alias("value"))


def json_messages(ratings: DataFrame, now_ms: int | None = None, source: str = JSON_SOURCE) -> DataFrame:
    """key = movie, value = a JSON message, from userId, movieId, rating, ratingRaw and, if there, timestamp."""
    timestamp = F.col("timestamp") if "timestamp" in ratings.columns else clock_ms(now_ms)
    body = F.struct(
        "userId", "movieId", "rating", "ratingRaw", F.lit(source).alias("source"), timestamp.alias("timestamp")
    )
    return ratings.select(F.col("movieId").alias("key"), F.to_json(body).alias("value"))


def publish(messages: DataFrame, target: str, servers: str | None = None) -> None:
    """Append to topic `target` of the brokers `servers`, or without brokers to the parquet folder `target`."""
    if servers is not None:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", target).save()
    else:
        messages.write.mode("append").parquet(target)
