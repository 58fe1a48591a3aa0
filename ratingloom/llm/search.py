"""Ranked lexical search over geometrically blocked posting lists.

Documents become vectors over the terms that the items ask for, and an index holds them in shards of bounded size. In a
shard, the posting list of every term is clustered by the similarity of its documents: some of them are pivots, each
document goes to the nearest pivot, and a cluster makes one block or several. With each block its summary is stored, the
largest impact in any of its documents, rounded up to a byte, of every term that some item asks for together with the term of
the list; no other item looks at the block.

A search takes an item's blocks in descending order of the bound that their summaries give, and scores all documents of a
block exactly. Blocks whose bound is below the score of the item's k-th best so far are skipped, and only those: a document
that could come in, also by its id at an equal score, is in a block that is not. The best of each task are merged by a rank
limit on a window.

Items are taken in blocks of about `BLOCK_PAIRS` pairs of item and term; the documents are read once for each such block. Only
the terms of one block, their weights and the table of numbers of documents that hold them reach the driver and the tasks.

Defined cases: null and empty texts have no terms; an item without terms, or whose terms are in no document, has no
rows; rows with equal item ids are one item with the terms of its different texts; rows with equal doc ids are documents of their own; a
document without an id counts, but is no result; an empty table gives an empty result. Only the named columns are
read, whatever else there is. Scores are sums of 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ratingloom.llm.shared import Written, in_arrow

K = 10
BLOCK_PAIRS = 16_384
BLOCK_DOCUMENTS = 128
SHARD_DOCUMENTS = 2_048
SHARD_CELLS = 32 << 20  # documents times terms, a byte each
SHARD_POSTINGS = 1_000_000
TASK_SHARDS = 4  # of these, about, a task makes the index
SKETCH = 32
STEP = 4_096  # impacts are below a million, so that their bytes are below 245
TEXT_BYTES = 8 << 20

# Characters of terms, and the constants of the score.
TERM_BYTES = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32 for byte in range(256)
)
SCALE, TF_SCALE, M_SCALE, FLAT, SLOPE = 1_000_000_000, 1_000, 8, 25, 75

VECTORS = "doc_id long, n long, terms array<int>, tfs array<long>"
# Arrays of numbers as bytes, which pass through Spark as they are.
ARRAYS = {
    "doc_ids": "<i8",
    "row_ends": "<i4",
    "terms": "<i4",
    "impacts": "<i4",
    "list_ends": "<i4",
    "block_ends": "<i4",
    "members": "<i4",
    "summary_ends": "<i4",
    "summary_terms": "<i4",
    "summary": "u1",
}
INDEX = ", ".join(f"{name} binary" for name in ARRAYS)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times of every term of every item."""
    fields = items.select("item_id").schema.add("term", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                terms = terms_of(batch.column("text")[at].as_py())
                if terms:
                    same = batch.column("item_id").take(pa.array(np.full(len(terms), at)))
                    yield pa.RecordBatch.from_arrays([same, pa.array(terms, pa.binary())], names=fields.names)

    texts = items.select("item_id", "text").distinct()
    return in_arrow(texts, run, fields).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def vectors(documents: DataFrame, terms) -> DataFrame:
    """doc_id, n (all terms), and numbers and frequencies of the terms in the broadcast list, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: k for k, term in enumerate(terms.value)}
        size = max(len(number), 1)

        def counted(ids: list, words: list[int], lengths: list[int]) -> pa.RecordBatch:
            n = np.array(lengths, np.int64)
            found = np.array(words, np.int64)
            keys = np.repeat(np.arange(len(n)) * size, n)
            keys, tfs = np.unique((keys + found)[found >= 0], return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(n) + 1) * size).astype(np.int32)
            lists = [
                pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                for values in ((keys % size).astype(np.int32), tfs.astype(np.int64))
            ]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])

        for batch in batches:
            ids, words, lengths, read = [], [], [], 0
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms_of(text.as_py())
                ids.append(key)
                lengths.append(len(found))
                words += [number.get(word, -1) for word in found]
                read += len(found) * 8
                if read > TEXT_BYTES:
                    yield counted(ids, words, lengths)
                    ids, words, lengths, read = [], [], [], 0
            if ids:
                yield counted(ids, words, lengths)

    return in_arrow(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, VECTORS)


def impacts(tfs: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term adds to the score of a document of n terms, before its weight."""
    m = FLAT + (SLOPE * n * documents) // total
    return (SCALE * tfs) // (TF_SCALE * tfs + M_SCALE * m)


def clustered(sketches: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the documents of one list, and the ends of its blocks in that order."""
    n = len(sketches)
    if n <= block:
        return np.arange(n), np.array([n])
    pivots = sketches[np.linspace(0, n - 1, -(-n // block)).astype(np.int64)]
    nearest = np.argmax(sketches @ pivots.T, axis=1)
    order = np.argsort(nearest, kind="stable")
    sizes = np.bincount(nearest, minlength=len(pivots))
    ends = []
    at = 0
    for size in sizes[sizes > 0].tolist():
        ends += range(at + block, at + size, block)
        at += size
        ends.append(at)
    return order, np.array(ends)


class Companions:
    """For each term, the terms that some item asks for together with it; None where these are half of all, or more."""

    def __init__(self, items: list[np.ndarray], count: int):
        self.items, self.count = items, count
        self.of_term: list[list[int]] = [[] for _ in range(count)]
        for item, terms in enumerate(items):
            for term in terms.tolist():
                self.of_term[term].append(item)
        self.known: dict[int, np.ndarray | None] = {}

    def __getitem__(self, term: int) -> np.ndarray | None:
        if term not in self.known:
            together = np.unique(np.concatenate([self.items[item] for item in self.of_term[term]]))
            self.known[term] = together if len(together) < self.count // 2 else None
        return self.known[term]


def shard(
    doc_ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, values: np.ndarray, count: int, block: int, companions: Companions
) -> dict[str, np.ndarray]:
    """The index of some documents: vectors by document, blocks of members by term, and summaries by block."""
    rows = np.repeat(np.arange(len(doc_ids)), np.diff(ends, prepend=0))
    dense = np.zeros((len(doc_ids), count), np.uint8)
    dense[rows, terms] = -(-values // STEP)
    directions = np.random.default_rng(0).standard_normal((count, SKETCH)).astype(np.float32)
    sketches = np.zeros((len(doc_ids), SKETCH), np.float32)
    step = max(1, (16 << 20) // (4 * count + 1))
    for at in range(0, len(doc_ids), step):
        sketches[at : at + step] = dense[at : at + step].astype(np.float32) @ directions
    sketches /= np.maximum(np.linalg.norm(sketches, axis=1, keepdims=True), 1e-9)

    by_term = np.argsort(terms, kind="stable")
    lists = np.searchsorted(terms[by_term], np.arange(count + 1))
    members, block_ends, list_ends, widths, columns, maxima = [], [], [], [], [], []
    blocks = 0
    for term in range(count):
        first, last = int(lists[term]), int(lists[term + 1])
        if last > first:
            docs = rows[by_term[first:last]]
            order, block_end = clustered(sketches[docs], block)
            docs = docs[order]
            together = companions[term]
            held = dense[docs] if together is None else dense[docs[:, None], together]
            summary = np.maximum.reduceat(held, np.concatenate([[0], block_end[:-1]]), axis=0)
            at, column = np.nonzero(summary)
            members.append(docs)
            block_ends.append(first + block_end)
            widths.append(np.bincount(at, minlength=len(block_end)))
            columns.append(column if together is None else together[column])
            maxima.append(summary[at, column])
            blocks += len(block_end)
        list_ends.append(blocks)
    joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
    return {
        "doc_ids": doc_ids,
        "row_ends": ends,
        "terms": terms,
        "impacts": values,
        "list_ends": np.array(list_ends),
        "block_ends": joined(block_ends),
        "members": joined(members),
        "summary_ends": np.cumsum(joined(widths)),
        "summary_terms": joined(columns),
        "summary": joined(maxima),
    }


def index(found: DataFrame, items, terms: int, documents: int, total: int, block: int = BLOCK_DOCUMENTS) -> DataFrame:
    """One row per shard of the documents `found`, all with an id and some terms; `items` is a broadcast list of the terms of each item."""
    most = max(64, min(SHARD_DOCUMENTS, SHARD_CELLS // max(terms, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        companions = Companions(items.value, terms)
        held: list[pa.RecordBatch] = []
        count = postings = 0

        def made() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks()
            lists = some.column("terms").combine_chunks()
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            n = np.repeat(some.column("n").to_numpy(), np.diff(ends, prepend=0))
            tfs = some.column("tfs").combine_chunks().flatten().to_numpy()
            values = impacts(tfs, n, documents, total)
            one = shard(some.column("doc_id").to_numpy(), ends, lists.flatten().to_numpy(), values, terms, block, companions)
            columns = [pa.array([one[name].astype(kind).tobytes()], pa.binary()) for name, kind in ARRAYS.items()]
            return pa.RecordBatch.from_arrays(columns, names=list(ARRAYS))

        for batch in batches:
            widths = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                room = np.searchsorted(np.cumsum(widths[at:]), max(SHARD_POSTINGS - postings, 1), "right")
                take = int(min(most - count, max(int(room), 0 if count else 1), batch.num_rows - at))
                if take:
                    held.append(batch.slice(at, take))
                    count += take
                    postings += int(widths[at : at + take].sum())
                    at += take
                if count >= most or (at < batch.num_rows and take == 0) or postings >= SHARD_POSTINGS:
                    yield made()
                    held.clear()
                    count = postings = 0
        if held:
            yield made()

    return in_arrow(found, run, INDEX)


class Shard:
    """A row of the index, ready to be searched."""

    def __init__(self, row: dict[str, np.ndarray], terms: int):
        self.doc_ids, self.ends = row["doc_ids"], np.concatenate([[0], row["row_ends"]])
        self.terms, self.impacts = row["terms"], row["impacts"].astype(np.int64)
        self.lists = np.concatenate([[0], row["list_ends"]])
        self.blocks, self.members = np.concatenate([[0], row["block_ends"]]), row["members"]
        widths = np.diff(row["summary_ends"], prepend=0)
        self.summary = np.zeros((len(widths), terms), np.uint8)
        self.summary[np.repeat(np.arange(len(widths)), widths), row["summary_terms"]] = row["summary"]

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        starts, widths = self.ends[docs], self.ends[docs + 1] - self.ends[docs]
        firsts = np.cumsum(widths) - widths
        at = np.arange(int(widths.sum())) + np.repeat(starts - firsts, widths)
        return np.add.reduceat(weights[self.terms[at]] * self.impacts[at], firsts)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], k: int) -> tuple[tuple, int, int]:
        """The `k` best (scores, ids) of `best` and this shard; how many blocks the item has here, and how many were scored.

        `weights` has a place for each term of the index, zero where the item lacks it.
        """
        ranges = [np.arange(self.lists[term], self.lists[term + 1]) for term in terms]
        blocks = np.concatenate([np.zeros(0, np.int64), *ranges])
        if not len(blocks):
            return best, 0, 0
        bounds = self.summary[np.ix_(blocks, terms)].astype(np.int64) @ weights[terms] * STEP
        order = np.argsort(-bounds, kind="stable")
        blocks, bounds = blocks[order], bounds[order]
        seen = np.zeros(len(self.doc_ids), bool)
        at, step = 0, 1
        while at < len(blocks):
            least = best[0][-1] if len(best[0]) == k else 1
            end = min(at + step, int(np.searchsorted(-bounds, -least, "right")))
            if end <= at:
                break
            docs = np.unique(np.concatenate([self.members[self.blocks[b] : self.blocks[b + 1]] for b in blocks[at:end]]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            if len(docs):
                scores, ids = self.scores(docs, weights), self.doc_ids[docs]
                above = scores >= least
                scores, ids = np.concatenate([best[0], scores[above]]), np.concatenate([best[1], ids[above]])
                first = np.lexsort((ids, -scores))[:k]
                best = scores[first], ids[first]
            at, step = end, step * 2
        return best, len(blocks), at


def found_in(shards: DataFrame, queries, terms: int, k: int = K) -> DataFrame:
    """item (its number), doc_id, score of the best of each task. `queries` is a broadcast list of (terms, weights)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        best = [none] * len(queries.value)
        weights = np.zeros(terms, np.int64)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: np.frombuffer(batch.column(name)[at].as_buffer(), kind) for name, kind in ARRAYS.items()}
                one = Shard(row, terms)
                for item, (asked, worth) in enumerate(queries.value):
                    weights[asked] = worth
                    best[item], _, _ = one.search(asked, weights, best[item], k)
                    weights[asked] = 0
        numbers = np.repeat(np.arange(len(best)), [len(scores) for scores, _ in best])
        columns = [pa.array(numbers.astype(np.int32))]
        for part in (1, 0):
            columns.append(pa.array(np.concatenate([none[0], *(one[part] for one in best)])))
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return in_arrow(shards, run, "item int, doc_id long, score long")


def search_block(documents: DataFrame, items: list[list[tuple[bytes, int]]], written: Written, k: int) -> DataFrame:
    """item (its place in `items`, which have terms and how often), doc_id and score: the `k` best of each task."""
    spark = documents.sparkSession
    terms = sorted({term for item in items for term, _ in item})
    number = {term: at for at, term in enumerate(terms)}
    found = written(vectors(documents, spark.sparkContext.broadcast(terms)), "vectors")
    counted, total, holds = found.agg(F.count_if(F.col("n") > 0), F.sum("n"), F.count_if(F.size("terms") > 0)).first()
    # A row for each term of the items.
    holding = dict(found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect())
    queries = []
    for item in items:
        asked = [(number[term], times) for term, times in item if number[term] in holding]
        worth = [times * weight(counted, holding[at]) for at, times in asked]
        queries.append((np.array([at for at, _ in asked], np.int64), np.array(worth, np.int64)))
    asked = spark.sparkContext.broadcast([query for query, _ in queries])
    # Vectors are small, so a task that reads a file's worth of them would have far too much to do.
    dealt = found.filter(F.col("doc_id").isNotNull() & (F.size("terms") > 0)).repartition(1 + holds // (TASK_SHARDS * SHARD_DOCUMENTS))
    shards = written(index(dealt, asked, len(terms), counted, total or 1), "index")
    written.remove(1)
    return found_in(shards, spark.sparkContext.broadcast(queries), len(terms), k)


def search(documents: DataFrame, items: DataFrame, written: Written, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` documents with the highest scores for each item, ties to the smaller id."""
    spark = documents.sparkSession
    asked = written(item_terms(items), "items")
    blocks = max(1, -(-asked.count() // BLOCK_PAIRS))
    fields = items.select("item_id").schema.add("doc_id", "long").add("score", "long")
    results = spark.createDataFrame([], fields)
    for block in range(blocks):
        some = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else asked
        pairs: dict = {}
        for item, term, times in some.collect():  # about BLOCK_PAIRS
            pairs.setdefault(item, []).append((bytes(term), times))
        if not pairs:
            continue
        tables = Written(spark, written.label)
        kind = fields["item_id"].dataType.simpleString()
        names = spark.createDataFrame(list(enumerate(pairs)), f"item int, item_id {kind}")
        rows = search_block(documents, list(pairs.values()), tables, k).join(F.broadcast(names), "item")
        rows = rows.select("item_id", "doc_id", "score")
        if blocks > 1:
            rows = tables(rows, "found")
            tables.remove(1)
        results = results.unionByName(rows)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
