"""Outputs of micro-batches: a folder per batch, and tables that are merged from such parts.

A batch that is repeated replaces its own folder. A folder counts once Spark has marked it as written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from ratingloom.session import folder_names, path_exists, remove_folder


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def numbered(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers of the folders `key`=number in `path`, in order."""
    parts = (name.partition("=") for name in folder_names(spark, path))
    return sorted(int(number) for name, _, number in parts if name == key and number.isdigit())


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Batches whose write has been committed as a whole, in order."""
    return [
        number
        for number in numbered(spark, path, "batch_id")
        if path_exists(spark, f"{batch_folder(path, number)}/_SUCCESS")
    ]


@dataclass(frozen=True)
class MergedTable:
    """A table that grows by small parts, is merged on reading and folded together now and then.

    `merge` turns parts, or merged rows, into merged rows; it must not matter in what order or how often. What a batch
    writes depends on its own part only. Folding writes a whole table and removes the parts and whole tables that the one
    *before* it has made superfluous, so readers may take as long as it is between two foldings.
    Batch ids must grow, so the table belongs to the checkpoint of the query that writes it.
    """

    spark: SparkSession
    path: str
    schema: str
    merge: Callable[[DataFrame], DataFrame]

    @property
    def parts(self) -> str:
        return f"{self.path}/parts"

    @property
    def wholes(self) -> str:
        return f"{self.path}/whole"

    def append(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(batch_folder(self.parts, batch_id))

    def read(self, until: int | None = None) -> DataFrame:
        """The merged rows of all batches, or of those up to `until`."""
        wanted = [number for number in complete_batches(self.spark, self.wholes) if until is None or number <= until]
        last = wanted[-1] if wanted else -1
        folders = [batch_folder(self.wholes, last)] if wanted else []
        folders += [
            batch_folder(self.parts, number)
            for number in complete_batches(self.spark, self.parts)
            if number > last and (until is None or number <= until)
        ]
        reader = self.spark.read.schema(self.schema)
        if not folders:
            return self.merge(self.spark.createDataFrame([], self.schema))
        return self.merge(reduce(DataFrame.unionByName, [reader.parquet(folder) for folder in folders]))

    def fold(self, batch_id: int) -> None:
        """Write all up to `batch_id` as one table."""
        before = [number for number in complete_batches(self.spark, self.wholes) if number < batch_id]
        self.read(batch_id).write.mode("overwrite").parquet(batch_folder(self.wholes, batch_id))
        if not before:
            return
        for number in numbered(self.spark, self.parts, "batch_id"):
            if number <= before[-1]:
                remove_folder(self.spark, batch_folder(self.parts, number))
        for number in before[:-1]:
            remove_folder(self.spark, batch_folder(self.wholes, number))

    def update(self, rows: DataFrame, batch_id: int, fold_every: int) -> None:
        """Append a batch, and fold after every `fold_every` of them."""
        self.append(rows, batch_id)
        if (batch_id + 1) % fold_every == 0:
            self.fold(batch_id)
