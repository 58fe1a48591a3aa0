"""Token files: ids of documents as Parquet list columns, for selective reads of tokens and of what describes them.

Documents are range-partitioned and sorted by `doc_id` before they are encoded, so every file holds a stretch of them and
the files follow one another. A row has `part` (number of the file's partition), `doc_id`, `at` and `until` (ids of the part
before this document, and with it), `n_tokens` and `ids`. The ids are dictionary-encoded; the other columns ascend or are small and are delta-encoded.
Row groups have about `GROUP_BYTES`, pages about `PAGE_BYTES` and at most `PAGE_ROWS` rows, and each page is in the page index,
so a filter on `doc_id`, `at` or `until` reads the pages it needs, and a query on lengths or counts reads no ids.
The index table has one row per part: documents, tokens, and `start`, the ids of all parts before. With it, any
stretch of the corpus-wide sequence of ids is a filter on two columns.

Ids are those of the tokenizers library. Text is cut where the pre-token pattern always begins a new match; the ids of pieces
seen before are looked up, in at most about `KEPT_BYTES` a worker; unknown words need the merges only.

Defined cases: a null or empty text has the end id alone; the text of a special token is that token, as in the tokenizers
library; a null id comes first; repeated rows are kept each, next to each other, in any order among equals; an empty table
gives no files, an empty index and empty results. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

import os
import re
import string
from codecs import charmap_decode
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.llm.shared import in_arrow
from ratingloom.session import setting

END = 0
GROUP_BYTES = 32 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 1_000
KEPT_BYTES = 112 << 20
LONGEST_KEPT = 64
ROWS = 2_000
TEXT_BYTES = 4 << 20
BATCH_BYTES = 4 << 20
INDEX = "part int, documents long, tokens long, start long"

# A blank before a visible character always begins a new match.
CUT = re.compile(r" (?=\S)")
# Elsewhere than singly between two visible characters, or of another kind, white space is left to the pattern.
ODD = ["  ", " \n", "\n ", "\n\n", "\0"] + [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
# Letters, with a blank before them or not, and ASCII after them.
LETTERS = re.compile(r"( ?[^\W\d_]+)([\0-\x7f]*)").fullmatch
# A match of ASCII letters ends before these, and what they are encoded to does not depend on it.
MARKS = string.punctuation
# Letters up to here are letters in any version of Unicode that a library may have.
LAST_LETTER = "\u052f"
# What is after letters and kept, at most about so many.
MOST_TAILS = 10_000
# Byte-level vocabularies spell visible characters of Latin-1 as themselves, and other bytes, in order, from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLING = {byte: chr(256 + k) for k, byte in enumerate(b for b in range(256) if b not in SHOWN)}
SPELLED = "".join(SPELLING.get(byte, chr(byte)) for byte in range(256))


def is_plain(text: str) -> bool:
    return text == text.strip(" \n") and not any(odd in text for odd in ODD)


def halved(pieces: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Different strings, which of them the pieces are made of, one after another, and how many each is made of: ASCII letters and
    the marks after them by themselves, so that a word is known whatever follows it; any other piece whole."""
    words = pc.ascii_rtrim(pieces, MARKS)
    two = pc.and_(pc.ascii_is_alpha(pc.ascii_ltrim(words, " ")), pc.not_equal(words, pieces))
    marks = pc.ascii_ltrim(pieces.filter(two), " " + string.ascii_letters)
    strings = pa.concat_arrays([pc.if_else(two, words, pieces), marks]).dictionary_encode()
    which, two = strings.indices.to_numpy(), two.to_numpy(zero_copy_only=False)
    counts = 1 + two.astype(np.int64)
    places = np.cumsum(counts)
    halves = np.empty(len(which), which.dtype)
    halves[places - counts] = which[: len(pieces)]
    halves[places[two] - 1] = which[len(pieces) :]
    return strings.dictionary.to_numpy(zero_copy_only=False).tolist(), halves, counts


def lists_of(ids: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(one) // 4 for one in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


class Encoder:
    """Ids of texts by a tokenizer file."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.of_id = [number.to_bytes(4, "little") for number in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.kept: dict[str, bytes] = {}
        self.age()

    def age(self) -> None:
        """Begin a new table; what the one before has is found there until this one is full as well."""
        self.before, self.tails = self.kept, {"": b""}
        self.kept = {"": b"", "\n": self.each(["\n"])[0]}
        self.kept_bytes = 0

    def each(self, texts: list[str]) -> list[bytes]:
        """Ids of any texts, by the whole tokenizer."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of different unknown pieces. Letters are one match with the blank before them, and need the tokenizer's merges alone,
        or none if they are known by themselves; what is after them begins another match."""
        kept, before, merge = self.kept.get, self.before.get, self.tokenizer.model.tokenize
        new, rest, split, tails, of_id = {}, [], [], self.tails, self.of_id
        for piece, ids in zip(pieces, map(before, pieces), strict=True):
            if ids is not None:
                new[piece] = ids
                continue
            body = piece[1:] if piece[0] == " " else piece
            if body.isascii() and body.isalpha():
                new[piece] = b"".join([of_id[token.id] for token in merge(body if body is piece else SPELLED[32] + body)])
                continue
            found = LETTERS(piece)
            if found is None:
                rest.append(piece)
                continue
            word, tail = found.groups()
            body = word[1:] if word[0] == " " else word
            if not body.isalpha() or not (ascii_ := body.isascii()) and max(body) > LAST_LETTER:
                rest.append(piece)
                continue
            ids = (kept(word) or before(word) or new.get(word)) if tail else None
            if ids is None:
                spelled = word if ascii_ and body is word else charmap_decode(word.encode(), "strict", SPELLED)[0]
                ids = b"".join([of_id[token.id] for token in merge(spelled)])
            if tail in tails:
                new[piece] = ids + tails[tail]
            else:
                split.append((piece, ids, tail))
        new.update(zip(rest, self.each(rest), strict=True))
        of_tail = {tail: kept(tail) or before(tail) or new.get(tail) for _, _, tail in split}
        unknown = [tail for tail, ids in of_tail.items() if ids is None]
        of_tail.update(zip(unknown, self.each(unknown), strict=True))
        new.update((piece, ids + of_tail[tail]) for piece, ids, tail in split)
        if len(tails) < MOST_TAILS:
            tails.update((tail, ids) for tail, ids in of_tail.items() if len(tail) <= LONGEST_KEPT)
        return new

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        if self.kept_bytes > KEPT_BYTES // 2:
            self.age()
        ids = list(map(self.kept.get, pieces))
        gaps = [at for at, known in enumerate(ids) if known is None]
        new = self.learn([pieces[at] for at in gaps])
        for at in gaps:
            ids[at] = new[pieces[at]]
        for piece in [piece for piece in new if len(piece) > LONGEST_KEPT]:
            del new[piece]
        self.kept.update(new)
        # Two objects and their place in the table, besides what they say.
        self.kept_bytes += sum(map(len, new)) + sum(map(len, new.values())) + 180 * len(new)
        return ids

    def of_plain(self, texts: pa.LargeStringArray) -> list[bytes]:
        """Ids of texts that `is_plain` holds for: cut, and equal pieces found, for all of them at once."""
        marked = pc.replace_substring(pc.replace_substring(texts, " ", "\0 "), "\n", "\0\n\0")
        cut = pc.split_pattern(marked, "\0")
        pieces = cut.flatten().dictionary_encode()
        names, halves, counts = halved(pieces.dictionary)
        lists = lists_of(self.of_pieces(names)).take(pa.array(halves))
        ends = lists.offsets.to_numpy()[np.concatenate([[0], np.cumsum(counts)])]
        lists, widths = pa.ListArray.from_arrays(pa.array(ends), lists.values), np.diff(ends)
        at = pieces.indices
        data = memoryview(lists.take(at).flatten().to_numpy()).cast("B")
        of_piece = np.concatenate([[0], np.cumsum(widths[at.to_numpy()], dtype=np.int64)])
        of_text = np.concatenate([[0], np.cumsum(cut.value_lengths().to_numpy(zero_copy_only=False))])
        bounds = (4 * of_piece[of_text]).tolist()
        return [bytes(data[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def of_other(self, text: str) -> bytes:
        """Ids of any text."""
        if any(token in text for token in self.special):
            return self.each([text])[0]
        first, *rest = CUT.split(text)
        pieces = [first, *(" " + piece for piece in rest)]
        known = dict.fromkeys(pieces)
        known.update(zip(known, self.of_pieces(list(known)), strict=True))
        return b"".join(map(known.__getitem__, pieces))

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for at, text in enumerate(texts):
            if not is_plain(text) or any(token in text for token in self.special):
                out[at] = self.of_other(text)
            elif text:
                plain.append(at)
        if plain:
            for at, ids in zip(plain, self.of_plain(pa.array([texts[at] for at in plain], pa.large_string())), strict=True):
                out[at] = ids
        return out


@lru_cache(maxsize=1)
def encoder_of(file: str) -> Encoder:
    return Encoder(file)


@dataclass
class TokenFiles:
    folder: str
    rows: DataFrame
    index: DataFrame


def parts_of(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows in parts of at most ROWS, and of about TEXT_BYTES by their `sizes`; a longer text is one by itself."""
    first = 0
    ends = np.cumsum(sizes, dtype=np.int64)
    while first < len(sizes):
        before = ends[first] - sizes[first]
        last = int(np.searchsorted(ends, before + TEXT_BYTES, "right"))
        last = min(max(last, first + 1), first + ROWS)
        yield batch.slice(first, last - first)
        first = last


def schema_of(doc_id: T.DataType) -> T.StructType:
    fields = T.StructType().add("part", "integer").add("doc_id", doc_id).add("at", "long").add("until", "long").add("n_tokens", "long")
    return fields.add("ids", T.ArrayType(T.IntegerType()))


def opened(spark: SparkSession, folder: str, doc_id: T.DataType | None = None) -> TokenFiles:
    """Token files written before; `doc_id` is the type of the ids, a long unless given."""
    rows = spark.read.schema(schema_of(doc_id or T.LongType())).parquet(f"{folder}/tokens")
    return TokenFiles(folder, rows, spark.read.schema(INDEX).parquet(f"{folder}/index"))


def write(documents: DataFrame, file: str, folder: str, end: int = END) -> TokenFiles:
    """Write the ids of all documents, each followed by `end`, in ascending order of `doc_id`, to `folder`.

    `file` names a vocabulary of the tokenizers library. Texts are shuffled once, as range partitions; rows of one id are
    spread by their text and place, so that many equal ids share no task.
    """
    spark = documents.sparkSession
    with open(file, encoding="utf-8") as source:  # a few megabytes
        shipped = spark.sparkContext.broadcast(source.read())
    key = documents.select("doc_id").schema[0].dataType
    order = ["doc_id", "copy", "place"]
    dealt = (
        documents.select("doc_id", "text", F.xxhash64("text").alias("copy"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    fields = schema_of(key)
    arrow_ids = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, mark = encoder_of(shipped.value), np.array([end], "<u4").tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            for some in parts_of(batch, sizes):
                ids = [one + mark for one in encode([text or "" for text in some.column("text").to_pylist()])]
                ends = np.cumsum([0] + [len(one) // 4 for one in ids])
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), part, np.int32)),
                        some.column("doc_id"),
                        pa.array(at + ends[:-1]),
                        pa.array(at + ends[1:]),
                        pa.array(np.diff(ends)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat).cast(arrow_ids),
                    ],
                    names=fields.names,
                )
                at += int(ends[-1])

    rows = (
        in_arrow(dealt, run, fields)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "v2")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
    )
    # Texts come to the workers in batches of bounded bytes, which both sides hold.
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        rows.parquet(f"{folder}/tokens")
    totals = (
        spark.read.schema(fields).parquet(f"{folder}/tokens")
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens"))
        .collect()  # one row for each task of the write
    )
    start, index = 0, []
    for part, count, tokens in sorted(totals):
        index.append((part, count, tokens, start))
        start += tokens
    spark.createDataFrame(index, INDEX).coalesce(1).write.parquet(f"{folder}/index")
    return opened(spark, folder, key)


def with_start(files: TokenFiles, *columns: str) -> DataFrame:
    """`columns` of the token files, and `start`: how many ids all documents before have."""
    starts = files.index.select("part", F.col("start").alias("before"))
    return files.rows.join(F.broadcast(starts), "part").select(*columns, (F.col("before") + F.col("at")).alias("start"))


def tokens_between(files: TokenFiles, start: int, end: int) -> DataFrame:
    """doc_id, start and ids of what lies in the stretch [start, end) of all ids, documents at its ends being cut.

    The parts it touches are found in the index, which is small, and become filters on `part` and `at`.
    """
    touched = files.index.filter((F.col("start") < end) & (F.col("start") + F.col("tokens") > start)).collect()
    within = F.lit(False)
    for part, _, _, before in touched:
        first, last = start - before, end - before
        within = within | ((F.col("part") == part) & (F.col("at") < last) & (F.col("until") > first))
    some = TokenFiles(files.folder, files.rows.filter(within), files.index)
    skip = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    count = F.least(F.lit(end), F.col("start") + F.col("n_tokens")) - F.col("start") - skip
    return with_start(some, "doc_id", "n_tokens", "ids").select(
        "doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), count.cast("int")).alias("ids")
    )


def digests(files: TokenFiles) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, all from the files."""
    rows = with_start(files, "doc_id", "ids")
    fields = rows.select("doc_id", "start").schema.add("n_tokens", "long").add("ids_crc32", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            data = memoryview(lists.values.to_numpy(zero_copy_only=True).astype("<u4", copy=False)).cast("B")
            ends = lists.offsets.to_numpy()
            sums = [crc32(data[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
                names=fields.names,
            )

    return in_arrow(rows, run, fields)
