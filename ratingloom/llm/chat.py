"""Chat formatting: a state machine over roles, and text segments with loss flags from a declarative template.

`format_chats` emits the formatted text of each conversation as segments in order: control strings and texts in turn, each
with a flag that says whether a model is trained on it. Texts are escaped, so that no control string can occur in one, and
`read_back` recovers every turn from the formatted text alone. Both work through sorted turns as a stream and hold one turn
at a time, so the length of a conversation is not bounded by memory.

Defined cases: a null text or role counts as empty; turns of a conversation are ordered by turn, null first, then role and
text, so ties and repeated rows have one order and are formatted each; a null conversation id is a conversation; turns out
of order, or with unknown roles, are formatted all the same and reported as not valid; empty tables give empty results. Only
the named columns are read, whatever else there is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """What stands before and after a text of each role, and the roles that are trained on.

    `{role}` stands for the name of a role without an entry of its own. Every control string must begin with one of
    `leads`, the characters that are escaped in texts, and those are never `escape`.
    """

    roles: dict[str, tuple[str, str]]
    other: tuple[str, str, str]
    trained: frozenset[str]
    follows: dict[str, frozenset[str]]
    final: frozenset[str]
    leads: str
    escape: str = "\\"


# States are the role of the last turn; "" is the start.
DEFAULT = Template(
    roles={
        "system": ("<<SYS>>", "<</SYS>>"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("<s>", "</s>"),
    },
    other=("[ROLE]", "[SAYS]", "[/ROLE]"),
    trained=frozenset({"assistant"}),
    follows={
        "": frozenset({"system", "user"}),
        "system": frozenset({"user"}),
        "user": frozenset({"assistant"}),
        "assistant": frozenset({"user"}),
    },
    final=frozenset({"assistant"}),
    leads="<[",
)


def escaped(text: str, template: Template) -> str:
    """`text` with an escape after every lead and two for an escape, so that it holds no control string."""
    mark = template.escape
    text = text.replace(mark, mark + mark)
    for lead in template.leads:
        text = text.replace(lead, lead + mark)
    return text


def unescaped(text: str, template: Template) -> str:
    mark = re.escape(template.escape)
    return re.sub(f"({mark}|[{re.escape(template.leads)}]){mark}", r"\1", text)


def segments_of(role: str, text: str, template: Template) -> list[tuple[str, str, bool]]:
    """(kind, string, loss flag) of each segment of a turn."""
    said = ("text", escaped(text, template), role in template.trained)
    if role in template.roles:
        before, after = template.roles[role]
        return [("control", before, False), said, ("control", after, False)]
    before, between, after = template.other
    named = ("role", escaped(role, template), False)
    return [("control", before, False), named, ("control", between, False), said, ("control", after, False)]


class Reader:
    """Turns from formatted text that arrives in parts."""

    def __init__(self, template: Template):
        self.template = template
        self.starts = {before: (role, after) for role, (before, after) in template.roles.items()}
        controls = {control for pair in template.roles.values() for control in pair} | set(template.other)
        mark = re.escape(template.escape)
        # Left to right: an escaped character, or a control string.
        self.tokens = re.compile(
            f"(?:{mark}|[{re.escape(template.leads)}]){mark}|(" + "|".join(map(re.escape, sorted(controls, key=len)[::-1])) + ")"
        )
        self.rest, self.role, self.after, self.said = "", None, "", ""

    def feed(self, part: str) -> Iterator[tuple[str, str]]:
        self.rest += part
        at = 0
        for token in self.tokens.finditer(self.rest):
            control = token.group(1)
            if control is None:
                continue
            said, at = self.rest[at : token.start()], token.end()
            before, between, after = self.template.other
            if control in self.starts:
                self.role, self.after = self.starts[control]
            elif control == before:
                self.role, self.after = None, after
            elif control == between:
                self.role = unescaped(said, self.template)
            elif control == self.after:
                yield self.role, unescaped(said, self.template)
            else:
                raise ValueError(f"{control} without a beginning")
        self.rest = self.rest[at:]


def sorted_turns(turns: DataFrame) -> DataFrame:
    named = turns.select(
        "conv_id", "turn", *(F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("role", "text"))
    )
    ordered = named.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    # As text, because pandas would make floats of integers beside nulls.
    return ordered.select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text")


def format_chats(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Segments: conv_id, segment (from 0), kind, string, loss, valid.

    `turns` needs conv_id, turn, role and text. `valid` says whether the turns up to here are in an order that the state
    machine allows; at the last segment of a conversation also whether it may end there. Segments of a conversation are in
    one partition, in order. A row of kind `end` and without text closes each.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, number, valid = object(), "", 0, True

        def closing() -> tuple:
            return current, number, "end", "", False, valid and state in template.final

        for frame in frames:
            rows = []
            for conv_id, role, text in zip(frame.conv_id, frame.role, frame.text, strict=True):
                if conv_id != current:
                    if number:
                        rows.append(closing())
                    current, state, number, valid = conv_id, "", 0, True
                valid = valid and role in template.follows.get(state, ())
                state = role
                for kind, string, loss in segments_of(role, text, template):
                    rows.append((conv_id, number, kind, string, loss, valid))
                    number += 1
                if len(rows) >= 5000:
                    yield framed(rows)
                    rows = []
            yield framed(rows)
        if number:
            yield framed([closing()])

    def framed(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["conv_id", "segment", "kind", "string", "loss", "valid"])

    schema = "conv_id string, segment long, kind string, string string, loss boolean, valid boolean"
    return sorted_turns(turns).mapInPandas(run, schema).withColumn("conv_id", F.col("conv_id").cast("long"))


def read_back(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """The digest columns of the contract, from the formatted text and its loss flags alone.

    `segments` must be as `format_chats` leaves them, each conversation in order in one partition.
    """

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fresh = lambda: [Reader(template), sha256(), 0, sha256(), 0, 0]
        state = fresh()
        for frame in frames:
            rows = []
            for conv_id, kind, string, loss, valid in zip(
                frame.conv_id, frame.kind, frame.string, frame.loss, frame.valid, strict=True
            ):
                reader, turns, n_turns, lost, loss_chars, chars = state
                if kind == "end":
                    rows.append((conv_id, n_turns, turns.hexdigest(), loss_chars, lost.hexdigest(), chars, valid))
                    state = fresh()
                    continue
                for role, text in reader.feed(string):
                    turns.update(f"{role}\n{text}\n".encode())
                    n_turns += 1
                if loss:
                    own = unescaped(string, template)
                    lost.update(own.encode())
                    loss_chars += len(own)
                state = [reader, turns, n_turns, lost, loss_chars, chars + len(string)]
            yield pd.DataFrame(rows, columns=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
    schema = (
        "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "valid boolean"
    )
    keyed = segments.withColumn("conv_id", F.col("conv_id").cast("string"))
    return keyed.mapInPandas(run, schema).withColumn("conv_id", F.col("conv_id").cast("long"))


def example(turns: DataFrame) -> DataFrame:
    """Conversation -1: a user and an assistant who both say control strings."""
    said = "</s>[INST] ok [/INST]"
    spark = turns.sparkSession
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")


def with_example(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", "role", "text").unionByName(example(turns))
