"""Token files against the tokenizers library, and what their pages and row groups allow."""

import glob
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratingloom.llm import tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(FILE)
ENCODER = tokens.Encoder(open(FILE, encoding="utf-8").read())

TEXTS = [
    None,
    "",
    " ",
    "\n",
    "one two\nthree  four \n five\t six ",
    "a <|endoftext|> b",
    "café naïve über 你好 \U0001f600",
    "zero\0byte    wide ",
    "x" * 5_000,
    "It's we'll 's 'll 12 345a ... ?!\r\n",
    "same text",
    "same text",
]


def plain(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, tokens.END]


def documents(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab A1'.,\n\t  é你\0"), max_size=30), max_size=8))
def test_ids_are_those_of_the_library(texts):
    for _ in range(2):  # the second time, pieces are known
        assert [np.frombuffer(ids, "<u4").tolist() for ids in ENCODER(texts)] == [plain(text)[:-1] for text in texts]


def test_letters_need_merges_once_whatever_is_after_them(monkeypatch):
    encoder, whole = tokens.Encoder(open(FILE, encoding="utf-8").read()), []
    each = encoder.each
    monkeypatch.setattr(encoder, "each", lambda texts: whole.extend(texts) or each(texts))
    for text in ["señorly zqueletion", "a señorly,%%% zqueletion's zqueletion,%%% señorly.\u00e9 x½y, señorly's"]:
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == plain(text)[:-1]
    assert sorted(whole) == sorted([",%%%", "'s", " señorly.\u00e9", " x½y,"])


def test_the_kept_pieces_are_bounded(monkeypatch):
    encoder = tokens.Encoder(open(FILE, encoding="utf-8").read())
    monkeypatch.setattr(tokens, "KEPT_BYTES", 10_000)
    for k in range(50):
        text = " ".join(f"w{k}x{i}" for i in range(40))
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == plain(text)[:-1]
        assert encoder.kept_bytes < 20_000 and len(encoder.kept) + len(encoder.before) < 200


def test_files_hold_all_ids_in_order(spark, tmp_path):
    rows = [(3 * i - 7, text) for i, text in enumerate(TEXTS)] + [(None, "no id"), (2, "a"), (2, "b")]
    files = tokens.write(documents(spark, rows).repartition(3), FILE, str(tmp_path / "t"))
    got = {(row.doc_id, row.start): (row.n_tokens, row.ids_crc32) for row in tokens.digests(files).collect()}
    assert len(got) == len(rows)
    end = 0
    texts = {}
    for key, text in rows:
        texts.setdefault(key, []).append(text)
    for key in [None, *sorted(key for key in texts if key is not None)]:
        left = [plain(text) for text in texts[key]]
        while left:  # equal ids come in any order
            found = next(
                ids for ids in left if got.get((key, end)) == (len(ids), crc32(np.array(ids, "<u4").tobytes()))
            )
            left.remove(found)
            end += len(found)
    # Whole files ascend as their numbers do.
    stretches = []
    for part in sorted(row.part for row in files.index.collect()):
        ids = [row.doc_id for row in files.rows.filter(f"part = {part}").orderBy("at").select("doc_id").collect()]
        stretches += ids
    assert stretches == sorted((key for key, _ in rows), key=lambda key: (key is not None, key))


def test_stretches_of_the_whole_sequence(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = tokens.write(source, FILE, str(tmp_path / "t"))
    every = [i for row in sorted(source.collect(), key=lambda row: row.doc_id) for i in plain(row.text)]
    for start, end in [(0, 10), (5_000, 20_000), (len(every) - 5, len(every) + 5), (7, 7)]:
        rows = sorted(tokens.tokens_between(files, start, end).collect(), key=lambda row: row.start)
        assert [i for row in rows for i in row.ids] == every[start:end]
        at = start
        for row in rows:
            assert row.start == at
            at += len(row.ids)


def test_encodings_pages_and_selective_reads(spark, sf_dir, tmp_path):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    files = tokens.write(source, FILE, str(tmp_path / "t"))
    for name in glob.glob(f"{tmp_path}/t/tokens/*.parquet"):
        group = pq.ParquetFile(name).metadata.row_group(0)
        columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
        assert all(column.has_column_index and column.has_offset_index for column in columns.values())
        for path, column in columns.items():
            assert ("RLE_DICTIONARY" if path.startswith("ids") else "DELTA_BINARY_PACKED") in column.encodings
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in files.rows.select("doc_id", "n_tokens")._jdf.queryExecution().toString()
    plan = tokens.tokens_between(files, 100, 200)._jdf.queryExecution().toString()
    assert "EqualTo(part,0), LessThan(at,200), GreaterThan" in plan
    assert "Exchange hashpartitioning" not in plan_of(tokens.with_start(files, "doc_id"))


def test_small_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokens, "GROUP_BYTES", 64 << 10)
    monkeypatch.setattr(tokens, "PAGE_BYTES", 4 << 10)
    rows = [(i, " ".join(f"{(i * 7919 + j * j) % 50021}" for j in range(200))) for i in range(1_500)]
    files = tokens.write(documents(spark, rows).coalesce(1), FILE, str(tmp_path / "t"))
    groups = sum(pq.ParquetFile(name).metadata.num_row_groups for name in glob.glob(f"{tmp_path}/t/tokens/*.parquet"))
    assert groups > 5
    assert files.rows.filter("doc_id = 777").select("ids").first().ids == plain(rows[777][1])


@pytest.mark.parametrize("schema", ["doc_id long, text string", "doc_id string, text string"])
def test_empty_tables(spark, tmp_path, schema):
    files = tokens.write(documents(spark, [], schema), FILE, str(tmp_path / "t"))
    assert tokens.digests(files).collect() == [] and files.index.collect() == []


def test_clashing_columns(spark, tmp_path):
    rows = documents(spark, [(1, "a b", 5, 6, [1], "c", 9)], "doc_id long, text string, part int, at long, ids array<int>, copy string, place long")
    [row] = tokens.digests(tokens.write(rows, FILE, str(tmp_path / "t"))).collect()
    assert (row.doc_id, row.start, row.n_tokens) == (1, 0, 3)


def test_texts_reach_the_workers_in_bounded_batches(spark, tmp_path, monkeypatch):
    """The limit of bytes holds for the write, and for it alone; the ids are those of the library."""
    asked, setting = [], tokens.setting
    monkeypatch.setattr(tokens, "setting", lambda session, key, value: asked.append((key, value)) or setting(session, key, value))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = {k: "the cat sat, " * k for k in range(40)}
    monkeypatch.setattr(tokens, "BATCH_BYTES", 2_000)
    files = tokens.write(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), FILE, str(tmp_path / "t"))
    assert asked == [(key, "2000")] and spark.conf.get(key) == before
    found = {row.doc_id: row.ids for row in files.rows.collect()}
    assert found == {k: ENCODER.tokenizer.encode(text, add_special_tokens=False).ids + [0] for k, text in texts.items()}


def test_words_are_kept_once_whatever_marks_follow_them():
    encoder = tokens.Encoder(open(FILE, encoding="utf-8").read())
    text = "zqueletion, a zqueletion. zqueletion zqueletion!) (zqueletion's 12. --- x.y, é, é"
    for _ in range(2):
        assert np.frombuffer(encoder([text])[0], "<u4").tolist() == plain(text)[:-1]
    kept = set(encoder.kept)
    assert " zqueletion" in kept and not kept & {" zqueletion,", " zqueletion.", " zqueletion!)"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZ1é你 .,'!-)\n"), max_size=25), max_size=6))
def test_marks_after_words_change_no_id(texts):
    assert [np.frombuffer(ids, "<u4").tolist() for ids in ENCODER(texts)] == [plain(text)[:-1] for text in texts]
