"""Sizing and reading the state of streaming aggregates.

A checkpoint keeps the number of state partitions its query first started with. Each of them is a store with files of its
own in every micro-batch, so a small query wants few, and one over all movies of a large archive many.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """Queries started inside have `count` state partitions, unless their checkpoint says otherwise. None changes nothing."""
    if count is None:
        yield
        return
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, count)
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """key, value and partition_id of all entries of the state after the last committed batch."""
    return spark.read.format("statestore").load(checkpoint).select("key", "value", "partition_id")


def state_summary(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row for the stateful operator of a query: operator, partitions, entries, and those of its largest partition."""
    kept = spark.read.format("state-metadata").load(checkpoint).select("operatorName", "numPartitions").first()
    sizes = state_rows(spark, checkpoint).groupBy("partition_id").agg(F.count("*").alias("entries"))
    return sizes.agg(
        F.lit(kept.operatorName).alias("operator"),
        F.lit(kept.numPartitions).cast("bigint").alias("partitions"),
        F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"),
        F.coalesce(F.max("entries"), F.lit(0)).alias("largest"),
    )
