"""Removal of repeated passages: every byte inside a string of 100 bytes that also starts earlier, by prefix doubling.

Ranks are names: 64-bit numbers that are equal where the strings are, as order does not matter here. The name of a string
of 2n bytes is made of the pair of names n bytes apart, so a task names all strings of 50 bytes of a text in six doublings.
Spark then sorts what is left by rank, drops what is unique, and ranks the rest again at a longer length:

1. Of the positions, one stands for a run of windows: the leftmost smallest name of 50 bytes inside a window of 100. It
   depends on the window alone, so equal windows have equal ones at equal distances. About one in 26 positions is left.
   Spark sorts them by rank and place, over ranges, so that a rank of a third of all rows is spread over many tasks.
   Ranks that occur once are dropped.
2. What shares a rank is ranked by its whole run, (rank, run) as a pair. Of runs that are equal, all but the first go.
3. Only where runs of one rank differ, at the ends of matches, the windows of the first of each kind are ranked singly, by
   the pair of their names at offsets 0 and 50. Of those that are equal, all but the first go.

No step pairs positions with each other: each group is reduced to its first place, on the map side first.

Defined cases: a null text counts as empty, which loses nothing; a null id comes before all others; rows with the same id
are ordered by a hash of their text, and rows that agree in both are one document, so they get equal results; an empty
table gives an empty result. Strings of different names differ; that two different strings share a pair of names is as
likely as for a hash of 128 bits. Further columns are carried in `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ratingloom.llm.shared import Written, in_arrow

LENGTH = 100
HALF = LENGTH // 2
# Windows of one run; a place is packed as its start and the number of windows in its run.
SPREAD = LENGTH - HALF + 1
PACKED = 1 << 6
BATCH_BYTES = 1 << 20
M1, M2, M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One name for each pair of names."""
    out = first * M1 + (second ^ (second >> np.uint64(31))) * M2
    out ^= out >> np.uint64(32)
    out *= M3
    out ^= out >> np.uint64(29)
    return out


def names(data: np.ndarray, length: int = HALF) -> np.ndarray:
    """The name of the `length` bytes at every place that has so many."""
    name, n = BYTES[data], 1
    if len(data) < length:
        return name[:0]
    while n < length:
        step = min(n, length - n)
        name, n = paired(name[:-step], name[step:]), n + step
    return name


def smallest(name: np.ndarray, width: int = SPREAD) -> np.ndarray:
    """The place of the leftmost smallest name among the next `width`, for every place that has so many."""
    place, n = np.arange(len(name), dtype=np.int64), 1
    while n < width:
        step = min(n, width - n)
        later = name[step:] < name[:-step]
        name = np.where(later, name[step:], name[:-step])
        place, n = np.where(later, place[step:], place[:-step]), n + step
    return place


def runs(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rank, name, start and number of windows of every run of windows with the same smallest name."""
    name = names(data)
    if len(data) < LENGTH:
        return name[:0], name[:0], np.zeros(0, np.int64), np.zeros(0, np.int64)
    chosen = smallest(name)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:], len(chosen)] - 1
    whole = paired(paired(name[first], name[first + HALF]), paired(name[last], name[last + HALF]))
    shape = ((last - first) * LENGTH + chosen[first] - first).astype(np.uint64)
    return name[chosen[first]], paired(whole, shape * M2), first, last - first + 1


def signed(name: np.ndarray) -> pa.Array:
    return pa.array(name.view(np.int64))


def bytes_of(texts: pa.Array) -> Iterator[np.ndarray]:
    for text in texts.cast(pa.binary()).to_pylist():
        yield np.frombuffer(text or b"", np.uint8)


def with_copy(documents: DataFrame) -> DataFrame:
    """Documents as text, `row` of all other columns, and the two columns that tell them apart."""
    others = [F.col(f"`{name}`") for name in documents.columns if name != "text"]
    return documents.select(
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.struct(*others).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.hash("text").alias("copy"),
    )


def ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of every document."""
    for batch in batches:
        at, out, size = [], [], 0
        for k, data in enumerate(bytes_of(batch.column("text"))):
            found = runs(data)
            at.append(np.full(len(found[0]), k, np.int64))
            out.append(found)
            size += len(data)
            if size >= BATCH_BYTES or k == batch.num_rows - 1:
                rank, run, start, count = (np.concatenate(column) for column in zip(*out, strict=True))
                rows = pa.array(np.concatenate(at))
                columns = [signed(rank), signed(run), batch.column("doc_id").take(rows), batch.column("copy").take(rows)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(start * PACKED + count - 1)], names=["a", "b", "doc_id", "copy", "place"]
                )
                at, out, size = [], [], 0


def singles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows in the places named by `places` of every document, each with its pair of names."""
    for batch in batches:
        for k, (data, places) in enumerate(zip(bytes_of(batch.column("text")), batch.column("places"), strict=True)):
            place = np.array(places.as_py(), np.int64)
            name = names(data)
            start, count = place // PACKED, place % PACKED + 1
            window = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            row = pa.array(np.full(len(window), k, np.int64))
            columns = [batch.column("doc_id").take(row), batch.column("copy").take(row)]
            yield pa.RecordBatch.from_arrays(
                [signed(name[window]), signed(name[window + HALF]), *columns, pa.array(window * PACKED)],
                names=["a", "b", "doc_id", "copy", "place"],
            )


def shared_only(by: list[str]):
    """Drops the rows of sorted batches that differ from both neighbours; the ends of a batch stay, as they may not."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            same = np.ones(batch.num_rows - 1, bool)
            for name in by:
                values = batch.column(name).to_numpy()
                same &= values[1:] == values[:-1]
            yield batch.filter(pa.array(np.r_[True, same] | np.r_[same, True]))

    return run


RANKS = "a long, b long, doc_id long, copy int, place long"


def repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows that share the columns `by` with another, and a few more. Sorted over ranges, so that hot ranks are split."""
    dealt = rows.repartitionByRange(*by, "doc_id", "copy", "place").sortWithinPartitions(*by)
    return in_arrow(dealt, shared_only(by), RANKS)


def place() -> Column:
    return F.struct("doc_id", "copy", "place")


def firsts(rows: DataFrame) -> DataFrame:
    """The first place of every pair of names."""
    return rows.groupBy("a", "b").agg(F.min(place()).alias("first"), F.count(F.lit(1)).alias("n"))


def doubled(documents: DataFrame, written: Written) -> DataFrame:
    """Places (doc_id, copy, place) of the repeated windows of documents as `with_copy` gives them."""
    texts, own = documents.select("text", "doc_id", "copy"), Written(documents.sparkSession, written.label)
    held = own(repeated(in_arrow(texts, ranked, RANKS), ["a"]), "ranks")
    first = firsts(held)
    kinds = first.groupBy("a").agg((F.count(F.lit(1)) > 1).alias("mixed"))
    # A run of its own kind, in a rank without other kinds, has nothing to be compared with.
    open_ = first.join(kinds, "a").filter((F.col("n") > 1) | F.col("mixed"))
    judged = written(
        held.join(open_, ["a", "b"])
        .withColumn("later", place() > F.col("first"))
        .filter(F.col("later") | F.col("mixed"))
        .select("doc_id", "copy", "place", "later"),
        "runs",
    )
    own.remove()
    ends = (
        judged.filter("NOT later")
        .groupBy(F.col("doc_id").alias("in_id"), F.col("copy").alias("in_copy"))
        .agg(F.array_distinct(F.collect_list("place")).alias("places"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("copy") == F.col("in_copy"))
    near = texts.join(ends, same).select("text", "places", "doc_id", "copy")
    windows = written(repeated(in_arrow(near, singles, RANKS), ["a", "b"]), "windows")
    late = windows.join(firsts(windows).filter("n > 1"), ["a", "b"]).filter(place() > F.col("first"))
    return judged.filter("later").select("doc_id", "copy", "place").union(late.select("doc_id", "copy", "place"))


def cut(as_text: bool):
    """Every document without its stretches, packed as places. As text, characters cut in two go as a whole."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, size, out = 0, 0, []
            for k, (data, places) in enumerate(zip(bytes_of(batch.column("text")), batch.column("places"), strict=True)):
                gone = begun = 0
                kept = data
                if places.is_valid and len(places):
                    place = places.values.to_numpy()
                    start = place // PACKED
                    step = np.bincount(start, minlength=len(data) + 1)
                    step -= np.bincount(start + place % PACKED + LENGTH, minlength=len(data) + 1)
                    inside = np.cumsum(step)[:-1] > 0
                    gone = int(inside.sum())
                    begun = int(inside[0]) + int(np.count_nonzero(inside[1:] & ~inside[:-1]))
                    kept = data[~inside]
                left = kept.tobytes()
                out.append((left.decode(errors="ignore") if as_text else left, len(data), gone, begun))
                size += len(data)
                if size >= BATCH_BYTES or k == batch.num_rows - 1:
                    kinds = (pa.string() if as_text else pa.binary(), pa.int64(), pa.int64(), pa.int64())
                    columns = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("row").slice(at, k + 1 - at), *columns],
                        names=["row", "kept", "n_bytes", "n_removed", "n_spans"],
                    )
                    at, size, out = k + 1, 0, []

    return run


def without_repeats(documents: DataFrame, written: Written, as_text: bool = False) -> DataFrame:
    """Every document: `row` with its columns but text, what is `kept` of it, n_bytes, n_removed and n_spans.

    `documents` needs doc_id and text; strings are judged on the input, not on what is left. `kept` is binary, or, with
    `as_text`, a string without the characters of which only a part is left.
    """
    told = with_copy(documents)
    places = (
        doubled(told, written)
        .groupBy(F.col("doc_id").alias("in_id"), F.col("copy").alias("in_copy"))
        .agg(F.collect_list("place").alias("places"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("in_id")) & (F.col("copy") == F.col("in_copy"))
    joined = told.join(places, same, "left").select("text", "row", "places")
    schema = StructType([joined.schema["row"]]).add("kept", "string" if as_text else "binary")
    schema = schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    return in_arrow(joined, cut(as_text), schema)


def digests(found: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
