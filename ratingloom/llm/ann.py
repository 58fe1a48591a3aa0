"""Approximate nearest neighbours by cosine: inverted lists, and an adaptive scan of dimensions within each probed list.

Vectors are divided by their length and rotated at random, so that any first few dimensions say about as much of a distance
as any others. Each goes to the list of its nearest centre; centres are fitted on at most `SAMPLE` vectors, a bounded
sample, but every vector is indexed. A query probes the lists with the nearest centres. Within one, candidates are read in
blocks of dimensions: after each block, a hypothesis test compares the partial distance, scaled up to all dimensions, with
the distance of the k-th nearest so far, and drops candidates that are very unlikely to be nearer. What is left gets its
exact cosine, in double precision on the original vectors.

Lists are dealt out in parts of about `PART` vectors, so a list, or a vector, that a third of all rows share is scanned by
many tasks; each sends the k nearest it found of each query, which are merged in a second step.

The queries of a list are dealt out in blocks of about `QUERIES` too, so neither side of a task grows with the table.

Defined cases: vectors that are null, of another length than `dimensions`, zero, or hold null or non-finite components take
no part, as queries or candidates; ties go to the smaller id; rows with the same id are candidates each, but not of that id
as a query; query rows of one id and vector are one query, those of one id and several vectors one each; queries without candidates have no rows; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE = 20_000
LISTS = 128
# Vectors without clusters have near ones in many lists: 0.97 of the nearest five are found with so many.
PROBES = 80
PART = 4_000
QUERIES = 4_000
BLOCK = 16
# How far, in standard deviations of the estimate, a partial distance must be beyond the k-th one.
CONFIDENCE = 2.1
SEED = 7


def usable(rows: DataFrame, dimensions: int) -> DataFrame:
    """vec_id and vector, of rows whose embedding can be compared. Doubles, so that no large float is lost."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    ) & F.exists("vector", lambda x: x != 0)
    return rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & (F.size("vector") == dimensions) & finite
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fitted(sample: np.ndarray, lists: int, steps: int = 12, seed: int = SEED) -> np.ndarray:
    """Centres of unit vectors, by spherical k-means."""
    sample = np.unique(sample, axis=0)
    numbers = np.random.default_rng(seed)
    centres = sample[numbers.permutation(len(sample))[:lists]]
    for _ in range(steps):
        nearest = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, dimensions)))[0]


def scanned(
    query: np.ndarray, rotated: np.ndarray, k: int, block: int = BLOCK, confidence: float = CONFIDENCE
) -> np.ndarray:
    """Places of the candidates among `rotated` that the tests leave, at least the k nearest found."""
    n, dimensions = rotated.shape
    if n <= 2 * k:
        return np.arange(n)
    # The first partial distances choose the k candidates whose full distance is the first bound.
    partial = ((rotated[:, :block] - query[:block]) ** 2).sum(axis=1)
    first = np.argpartition(partial, k - 1)[:k]
    bound = ((rotated[first] - query) ** 2).sum(axis=1).max()
    alive, done = np.arange(n), block
    while True:
        # Under the hypothesis that a candidate is within the bound, its scaled partial distance hardly exceeds this.
        limit = bound * (done / dimensions) * (1 + confidence / np.sqrt(done)) ** 2 + 1e-12
        stay = partial <= (limit if done < dimensions else bound + 1e-12)
        alive, partial = alive[stay], partial[stay]
        if done >= dimensions:
            return alive
        if len(alive) > k:
            near = alive[np.argpartition(partial, k - 1)[:k]]
            bound = min(bound, ((rotated[near] - query) ** 2).sum(axis=1).max())
        end = min(done + block, dimensions)
        partial = partial + ((rotated[alive, done:end] - query[done:end]) ** 2).sum(axis=1)
        done = end


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    dimensions: int = 64,
    lists: int = LISTS,
    probes: int = PROBES,
    sample: int = SAMPLE,
    part: int = PART,
    block: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows to every row for which `is_query` holds.

    `rows` needs vec_id and embedding.
    """
    vectors = usable(rows, dimensions)
    drawn = vectors.select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    turn = rotation(dimensions)
    if len(drawn):
        centres = fitted(unit(np.stack(drawn.vector.to_numpy())) @ turn, lists)
    else:
        centres = np.zeros((1, dimensions))

    def filed(frames: Iterable[pd.DataFrame], count: int) -> Iterator[pd.DataFrame]:
        """The nearest lists of every vector."""
        for frame in frames:
            for at in range(0, len(frame), 2000):
                some = frame.iloc[at : at + 2000]
                near = unit(np.stack(some.vector.to_numpy())) @ turn @ centres.T
                chosen = np.argsort(-near, axis=1, kind="stable")[:, :count]
                yield pd.DataFrame({"vec_id": some.vec_id, "vector": some.vector, "list": list(chosen.astype("int32"))})

    schema = "vec_id long, vector array<double>, list array<int>"
    candidates = vectors.mapInPandas(lambda frames: filed(frames, 1), schema).withColumn("list", F.col("list")[0])
    # By id and vector, so that repeated rows are searched once.
    wanted = vectors.filter(is_query).withColumn("query", F.xxhash64("vector")).dropDuplicates(["vec_id", "query"])
    wanted = wanted.select("vec_id", "vector").mapInPandas(lambda frames: filed(frames, probes), schema)
    sizes = candidates.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("queries"))
    sizes = sizes.collect()  # as many rows as there are lists
    blocks = max(1, -(-sum(row.queries for row in sizes) // block))
    parts = {row.list: max(1, -(-row.n // part)) for row in sizes}
    of_list = F.create_map(*(F.lit(x) for pair in (parts or {0: 1}).items() for x in pair))
    dealt = candidates.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), of_list[F.col("list")]).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = (
        wanted.select("vec_id", "vector", F.explode("list").alias("list"))
        .filter(F.col("list").isin(list(parts) or [-1]))
        .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).cast("int"))
        .select("vec_id", "vector", F.xxhash64("vector").alias("query"), "list", "block", F.explode(F.sequence(F.lit(0), (of_list[F.col("list")] - 1).cast("int"))).alias("part"))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            ids, vectors = left.vec_id.to_numpy(), np.stack(left.vector.to_numpy())
            rotated = unit(vectors) @ turn
            scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            lengths = np.sqrt((scaled * scaled).sum(axis=1))
            queries = np.stack(right.vector.to_numpy())
            turned = unit(queries) @ turn
            asking, in_order = right.vec_id.to_numpy(), np.sort(ids)
            own = np.searchsorted(in_order, asking, "right") - np.searchsorted(in_order, asking)
            for query_id, number, same, query, around in zip(asking, right["query"].to_numpy(), own, queries, turned, strict=True):
                # As many more than asked for as rows of the query's id are there. Row sums add up alike for equal rows.
                stay = scanned(around, rotated, k + same)
                stay = stay[ids[stay] != query_id]
                one = query / np.abs(query).max()
                score = (scaled[stay] * one).sum(axis=1) / (lengths[stay] * np.sqrt((one * one).sum()))
                order = np.lexsort((ids[stay], -score))[:k]
                found.append(pd.DataFrame({"query_id": query_id, "query": number, "vec_id": ids[stay][order], "score": score[order]}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "query": "int64", "vec_id": "int64"})

    near = dealt.groupBy("list", "part", "block").cogroup(asked.groupBy("list", "part", "block")).applyInPandas(
        search, "query_id long, query long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
