from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratingloom.llm import packing

FILE = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.integers(1, 300), max_size=60))
def test_pieces_fill_sequences(lengths):
    pieces, count = packing.assigned(lengths, 64)
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for document, start, n, sequence, offset in pieces:
        by_document[document].append((start, n))
        by_sequence[sequence].append((offset, n))
    for document, length in enumerate(lengths):
        end = 0
        for start, n in sorted(by_document[document]):
            assert start == end and n > 0
            end += n
        assert end == length
    assert set(by_sequence) == set(range(count))
    for parts in by_sequence.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end & (end - 1) == 0 and end <= 64


def test_costs_are_balanced():
    choose = np.random.default_rng(1)
    lengths = choose.integers(1, 2048, 3000).tolist()
    pieces, _ = packing.assigned(lengths)
    cost, size = defaultdict(float), defaultdict(int)
    for _, _, n, sequence, _ in pieces:
        cost[sequence] += n + n * n / 1024
        size[sequence] += n
    full = [cost[s] for s in cost if size[s] == packing.LENGTH]
    assert np.std(full) < 0.35 * np.mean(full)


def test_query(spark):
    texts = {None: None, 1: "", 2: "Étion dans\n" * 3000, 3: "a<|endoftext|>b", 4: "the end", 5: "x" * 9000}
    rows = [(i, t, 7) for i, t in texts.items()] + [(4, texts[4], 7)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, start int").coalesce(1)
    found = packing.digests(packing.pack(documents, FILE)).collect()
    tokenizer = Tokenizer.from_file(FILE)
    total = 0
    for row in found:
        ids = np.array(tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert row.doc_tokens == len(ids)
        assert row.ids_crc32 == crc32(ids[row.start : row.start + row.length].tobytes())
        total += row.length
    assert total == sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)


def test_empty(spark):
    assert packing.digests(packing.pack(spark.createDataFrame([], "doc_id long, text string"), FILE)).collect() == []


def test_ids_are_kept_in_bounded_bytes():
    """Packing keeps what it has seen in the table of the token files, which is bounded in bytes and not in entries."""
    from ratingloom.llm import tokens

    assert packing.encoder_of is tokens.encoder_of and packing.parts_of is tokens.parts_of
