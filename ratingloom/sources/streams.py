"""Unbounded sources (S4-S6, T1). All of them yield a `raw` text column.

Kafka needs its connector on the class path; the file form reads the same messages from a folder that grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.session import is_directory
from ratingloom.sources.messages import text_of


def kafka_options(servers: str, topic: str, offsets_per_trigger: int | None = None) -> dict[str, str]:
    """From the earliest offset, going on when the broker has already dropped some."""
    # Where a stream starts and what it does about lost offsets.
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, offsets_per_trigger: int | None = None) -> DataFrame:
    """S4-S6 from a broker."""
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topic, offsets_per_trigger)).load()
    return stream.select(text_of(F.col("value")).alias("raw"))


def read_text_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, when_read: str | None = None
) -> DataFrame:
    """S4-S6 from a folder of text files, one message per line.

    `when_read` is the source's `cleanSource`: with "delete", files go when a batch after theirs is done. Only one
    query may then read the folder.
    """
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if when_read is not None:
        reader = reader.option("cleanSource", when_read)
    return reader.text(path).select(F.col("value").alias("raw"))


def read_message_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """S4-S6 from a folder of parquet files of keyed messages, as `ratingloom.sinks.messages` writes them."""
    return read_table_stream(spark, path, "key STRING, value STRING", files_per_trigger).select(
        F.col("value").alias("raw")
    )


def read_table_stream(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table as a stream; `path` may be a folder or a single file."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if is_directory(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)
