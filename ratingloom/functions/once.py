"""Evaluating an expensive expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """The columns `keep` and `value` as column `name`.

    A filter on a plain `select` is pushed below it, and would compute `value` again for each of its uses: a split or a
    JSON parse per condition. It is not pushed below a generator, here one over an array of a single element.
    """
    return rows.select(*keep, F.explode(F.array(value)).alias(name))
