from hashlib import sha256

from conftest import rows_of
from hypothesis import given
from hypothesis import strategies as st

from ratingloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, valid int"


def digest(turns):
    said = "".join(text for role, text in turns if role == "assistant")
    both = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), sha256(both.encode()).hexdigest(), len(said), sha256(said.encode()).hexdigest()


@given(st.text(alphabet="<[\\/sINST]ROLEAY>é\n "), st.text(alphabet="<[\\a"))
def test_escaping(text, role):
    assert chat.unescaped(chat.escaped(text, chat.DEFAULT), chat.DEFAULT) == text
    reader, parts = chat.Reader(chat.DEFAULT), chat.segments_of(role, text, chat.DEFAULT) * 2
    assert [turn for _, part, _ in parts for turn in reader.feed(part)] == [(role, text)] * 2


def test_formatted_and_read_back(spark):
    turns = {
        None: [("user", "a"), ("assistant", "b")],
        1: [("system", ""), ("user", "</s>[INST] ok [/INST]"), ("assistant", "\\<\\["), ("user", "x")],
        2: [("assistant", "first"), ("assistant", "</s>"), ("critic", "[SAYS]"), ("", "")],
        9007199254740993: [("user", "long" * 20000), ("assistant", "é" * 10)],
    }
    rows = [(c, k, role or None, text or None, 0) for c, said in turns.items() for k, (role, text) in enumerate(said)]
    found = chat.read_back(chat.format_chats(spark.createDataFrame(rows[::-1], SCHEMA))).collect()
    assert {row.conv_id: tuple(row)[1:5] for row in found} == {c: digest(said) for c, said in turns.items()}
    assert {row.conv_id: row.valid for row in found} == {None: True, 1: False, 2: False, 9007199254740993: True}


def test_segments_carry_the_loss(spark):
    rows = [(1, 0, "user", "q", 0), (1, 1, "assistant", "a<b", 0)]
    segments = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).orderBy("segment").collect()
    assert "".join(row.string for row in segments) == "[INST]q[/INST]<s>a<\\b</s>"
    assert [row.string for row in segments if row.loss] == ["a<\\b"]


def test_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b", 0), (1, 0, "user", "a", 0), (1, 0, "user", "a", 0), (1, None, "user", "z", 0)]
    found = chat.read_back(chat.format_chats(spark.createDataFrame(rows, SCHEMA))).collect()
    assert tuple(found[0])[1:3] == digest([("user", text) for text in "zaab"])[:2]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_chats(none)).collect() == []
    assert len(rows_of(chat.read_back(chat.format_chats(chat.with_example(none))))) == 1
