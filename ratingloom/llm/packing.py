"""Packing: documents into sequences of equal length, balanced by an estimate of what attention over them costs.

A document of n tokens costs LINEAR * n + QUADRATIC * n * n, as attention stays inside a document. Whole sequences are cut
off the front of long documents. What is left of each is assigned in descending order of length to the sequence with the
lowest cost so far that has room; when none has, it is cut at the room of the emptiest. The sequences opened hold exactly
the tokens at hand: full ones, and powers of two for the last few, so that nothing is padded.

Each input partition is packed by itself, in groups of about `GROUP_TOKENS` tokens, so a task holds no more than that
and the longest document, and nothing is shuffled. Ids of sequences are unique over partitions. Texts are encoded as for token
files (`tokens.Encoder`).

Defined cases: a null or empty text has the end-of-document id alone; the text of a special token is that token, as in the
tokenizers library; repeated rows and ids are packed each; an empty table gives an empty result. Only the named columns are
read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom.llm.tokens import encoder_of, parts_of

LENGTH = 2048
END = 1
GROUP_TOKENS = 4_000_000
LINEAR, QUADRATIC = 1.0, 1.0 / 1024


def sequences_for(tokens: int, length: int) -> list[int]:
    """Lengths of sequences that hold exactly so many tokens."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def assigned(lengths: list[int], length: int = LENGTH) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(document, start, length, sequence, offset) of every piece of documents with these lengths, and how many sequences."""
    pieces, left, count = [], [], 0
    for document, n in enumerate(lengths):
        for start in range(0, n - length + 1, length):
            pieces.append((document, start, length, count, 0))
            count += 1
        if n % length:
            left.append((n % length, document, n - n % length))
    left.sort(key=lambda one: (-one[0], one[1]))
    sizes = np.array(sequences_for(sum(one[0] for one in left), length), dtype=np.int64)
    room, cost = sizes.copy(), np.zeros(len(sizes))
    for n, document, start in left:
        while n:
            fits = np.flatnonzero(room >= n)
            to = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room))
            part = min(n, int(room[to]))
            pieces.append((document, start, part, count + to, int(sizes[to] - room[to])))
            room[to] -= part
            cost[to] += LINEAR * part + QUADRATIC * part * part
            n, start = n - part, start + part
    return pieces, count + len(sizes)


def pack(documents: DataFrame, file: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, `ids` (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    `file` names a vocabulary of the tokenizers library.
    """
    with open(file, encoding="utf-8") as opened:  # a few megabytes
        shipped = documents.sparkSession.sparkContext.broadcast(opened.read())
    fields = documents.select("doc_id").schema
    for name in ("start", "length"):
        fields = fields.add(name, "long")
    fields = fields.add("ids", "binary")
    for name in ("doc_tokens", "sequence_id", "offset"):
        fields = fields.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(shipped.value)
        mark = np.array([end], "<u4").tobytes()
        next_id = TaskContext.get().partitionId() << 40
        keys, texts, tokens = [], [], 0

        def packed() -> pa.RecordBatch:
            nonlocal next_id
            pieces, count = assigned([len(text) // 4 for text in texts], length)
            at = [piece[0] for piece in pieces]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(keys).take(pa.array(at, pa.int64())),
                    pa.array([piece[1] for piece in pieces], pa.int64()),
                    pa.array([piece[2] for piece in pieces], pa.int64()),
                    pa.array([texts[d][4 * start : 4 * (start + n)] for d, start, n, _, _ in pieces], pa.binary()),
                    pa.array([len(texts[d]) // 4 for d in at], pa.int64()),
                    pa.array([next_id + piece[3] for piece in pieces], pa.int64()),
                    pa.array([piece[4] for piece in pieces], pa.int64()),
                ],
                names=fields.names,
            )
            next_id += count
            keys.clear()
            texts.clear()
            return batch

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            for some in parts_of(batch, sizes):
                new = [one + mark for one in encode([text or "" for text in some.column("text").to_pylist()])]
                keys.append(some.column("doc_id"))
                texts.extend(new)
                tokens += sum(map(len, new)) // 4
                if tokens >= GROUP_TOKENS:
                    yield packed()
                    tokens = 0
        if texts:
            yield packed()

    return documents.select("doc_id", "text").mapInArrow(run, fields)


def digests(packed: DataFrame) -> DataFrame:
    """The columns of the contract."""
    checksum = F.crc32("ids").cast(T.LongType()).alias("ids_crc32")
    return packed.select("doc_id", "start", "length", checksum, "doc_tokens", "sequence_id", "offset")
