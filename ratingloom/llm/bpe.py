"""Byte-level BPE: encoding by a rank queue on a hierarchical bitmap, and decoding.

Each match of the pre-token pattern is merged on its own. Its parts are a linked list. Positions whose pair has a rank wait
in a bucket of that rank; two levels of bitmaps over the ranks give the lowest rank that waits by finding the first set bit;
entries that a merge has made stale are skipped when they come up. A merge costs the same whatever the length of the
pre-token, so one of a million letters is no trouble.

Most text is words seen before. A text is cut before every blank that a visible character follows, which the pattern never
reads across, and the ids of short cut pieces are kept in each Python worker, up to about `KEPT_BYTES`; so are those of
pre-tokens, up to half as much.

Defined cases: a null or empty text has no ids; decoding ids that the vocabulary lacks raises; repeated rows give repeated
results; an empty table gives an empty result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEPT = 1_000_000
KEPT_BYTES = 224 << 20
ENTRY_BYTES = 180  # two objects and their place in a table, besides what they say
LONGEST_KEPT = 48
WORD_BITS = 8
# A blank before a visible character always begins a new match: the pattern takes it together with what follows.
CUT = re.compile(r" (?=\S)")


class Vocabulary:
    """Ranks of byte strings; the ranks are the ids."""

    def __init__(self, file: bytes, pattern: str):
        import regex

        pairs = (line.split() for line in file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        # The bitmaps of the queue: one bit a rank, in words, and one bit a word. Both are zero between pre-tokens.
        self.words = [0] * ((max(self.ranks.values()) >> WORD_BITS) + 1)
        self.matches = regex.compile(pattern).findall
        # What is kept is in two tables: when the newer is full it becomes the older, and the older is forgotten.
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.kept_bytes = self.parts_bytes = 0
        self.known = np.isin(np.arange(max(self.tokens) + 1), list(self.tokens))
        self.by_id = np.array([self.tokens.get(rank, b"") for rank in range(max(self.tokens) + 1)], object)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        rank_of, words, mask = self.ranks.get, self.words, (1 << WORD_BITS) - 1
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        # A linked list of parts: where the next and the previous one start, and the rank of a part with the next one.
        after, before, rank_at = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
        buckets: dict[int, list[int]] = {}
        top = 0
        waiting = [(i, rank) for i in range(n - 1) if (rank := rank_of(piece[i : i + 2])) is not None]
        while True:
            for i, rank in waiting:
                rank_at[i] = rank
                bucket = buckets.get(rank)
                if bucket:
                    heappush(bucket, i)
                else:
                    buckets[rank] = [i]
                    word = rank >> WORD_BITS
                    words[word] |= 1 << (rank & mask)
                    top |= 1 << word
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = words[word]
            rank = (word << WORD_BITS) | ((bits & -bits).bit_length() - 1)
            bucket, waiting = buckets[rank], []
            # New pairs are longer than this one, so none has its rank; those seen before go on unless one has a lower.
            while bucket and not waiting:
                i = heappop(bucket)
                if rank_at[i] != rank:
                    continue
                gone = after[i]
                end = after[i] = after[gone]
                rank_at[gone] = rank_at[i] = -1
                if end < n:
                    before[end] = i
                    new = rank_of(piece[i : after[end]])
                    if new is not None:
                        waiting.append((i, new))
                left = before[i]
                if left >= 0:
                    rank_at[left] = -1
                    new = rank_of(piece[left:end])
                    if new is not None:
                        waiting.append((left, new))
            if not bucket:
                words[word] = bits & (bits - 1)
                if not words[word]:
                    top &= top - 1
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(piece[i : after[i]]))
            i = after[i]
        return ids

    def cut_ids(self, cut: str) -> bytes:
        found, parts = self.matches(cut), self.parts
        if self.parts_bytes > KEPT_BYTES // 2:
            parts.clear()
            self.parts_bytes = 0
        out = []
        for match in found:
            ids = parts.get(match)
            if ids is None:
                ids = array("I", self.merged(match.encode())).tobytes()
                # Matches that are a piece by themselves are kept as pieces.
                if len(found) > 1 and len(match) <= LONGEST_KEPT:
                    parts[match] = ids
                    self.parts_bytes += len(match) + len(ids) + ENTRY_BYTES
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        first, *rest = CUT.split(text)
        pieces = [first, *(" " + piece for piece in rest)]
        try:
            return b"".join(map(self.kept.__getitem__, pieces))
        except KeyError:
            pass
        if self.kept_bytes > KEPT_BYTES // 2:
            self.before, self.kept, self.kept_bytes = self.kept, {}, 0
        kept, before, out = self.kept, self.before, []
        for piece in pieces:
            ids = kept.get(piece)
            if ids is None:
                ids = before.get(piece)
                if ids is None:
                    ids = self.cut_ids(piece)
                if len(piece) <= LONGEST_KEPT:
                    kept[piece] = ids
                    self.kept_bytes += len(piece) + len(ids) + ENTRY_BYTES
            out.append(ids)
        return b"".join(out)

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.by_id) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        return b"".join(self.by_id[ids].tolist())


@lru_cache(maxsize=2)
def vocabulary(file: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(file, pattern)


def list_column(parts: list[bytes], width: int, kind: pa.DataType) -> pa.Array:
    """A list column of fixed-width numbers from their bytes."""
    ends = np.cumsum([0, *(len(part) // width for part in parts)], dtype="int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.Array.from_buffers(kind, int(ends[-1]), [None, pa.py_buffer(b"".join(parts))]))


def encode(documents: DataFrame, file: str, pattern: str, rows: int = 500) -> DataFrame:
    """doc_id and `ids`, an array of int, of every document. `file` names the ranks, one base64 token and rank a line."""
    with open(file, "rb") as opened:  # about a megabyte
        shipped = documents.sparkSession.sparkContext.broadcast(opened.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shipped.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                some = batch.slice(start, rows)
                parts = [words.encode(text or "") for text in some.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), list_column(parts, 4, pa.int32())], names=["doc_id", "ids"]
                )

    schema = documents.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType()))
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, file: str, pattern: str, rows: int = 500) -> DataFrame:
    """doc_id, `ids` and `bytes`, the bytes that the ids stand for."""
    with open(file, "rb") as opened:
        shipped = encoded.sparkSession.sparkContext.broadcast(opened.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(shipped.value, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                some = batch.slice(start, rows)
                ids = some.column("ids")
                # A null list has no length.
                ends, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
                parts = [words.decode(values[at:to]) for at, to in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("ids"), pa.array(parts, pa.binary())],
                    names=["doc_id", "ids", "bytes"],
                )

    schema = encoded.select("doc_id", "ids").schema.add("bytes", "binary")
    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(documents: DataFrame, file: str, pattern: str) -> DataFrame:
    """The digest columns of the contract: each text is encoded and its ids are decoded, in one step and one worker a core."""
    with open(file, "rb") as opened:
        shipped = documents.sparkSession.sparkContext.broadcast(opened.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        words = vocabulary(shipped.value, pattern)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch.column("text"):
                ids = words.encode(text.as_py() or "")
                counts.append(len(ids) // 4)
                of_ids.append(sha256(ids).hexdigest())
                of_bytes.append(sha256(words.decode(np.frombuffer(ids, "<u4"))).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = documents.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string")
    return documents.select("doc_id", "text").mapInArrow(run, schema.add("decoded_sha256", "string"))
