"""Chat formatting whose output a deterministic parser reads back exactly."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.arrow import map_batches, texts

START, END = "###", "</turn>"
#: What the parser looks at: an escaped control string or backslash, then bare control strings.
CONTROL = re.compile(r"\\(\\|###|</turn>)|###|</turn>")
HEADER = re.compile(r"### ((?:[^\\:]|\\[\\:])*+): ")
#: Escapes in the order they are tried: none, control strings only, backslashes too.
ESCAPES = (None, re.compile(r"###|</turn>"), re.compile(r"\\|###|</turn>"))
LOSS_ROLE = "assistant"


def escape(text: str, level: int) -> str:
    pattern = ESCAPES[level]
    return pattern.sub(lambda m: "\\" + m[0], text) if pattern else text


def parse(formatted: str) -> list[tuple[str, str, int, int]] | None:
    """The turns (role, text, start and end of the text in ``formatted``), or None if it is no sequence of turns.

    Grammar: turns = { "### " role ": " text "</turn>\\n" }. In a text a backslash before a backslash, "###" or
    "</turn>" stands for what follows; bare "###" can't occur and bare "</turn>" ends the text.
    """
    out, at = [], 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        if head is None:
            return None
        start = done = head.end()
        parts = []
        for m in CONTROL.finditer(formatted, start):
            parts.append(formatted[done : m.start()])
            done = m.end()
            if m[1] is not None:
                parts.append(m[1])
            elif m[0] == START:
                return None
            else:
                break
        else:
            return None
        if formatted[done : done + 1] != "\n":
            return None
        out.append((re.sub(r"\\([\\:])", r"\1", head[1]), "".join(parts), start, done - len(END)))
        at = done + 1
    return out


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and its text's start and end: escapes more and more until the parser gives the source back."""
    head = "### " + re.sub(r"([\\:])", r"\\\1", role) + ": "
    for level in range(len(ESCAPES)):
        formatted = f"{head}{escape(text, level)}{END}\n"
        turns = parse(formatted)
        if turns is not None and [t[:2] for t in turns] == [(role, text)]:
            return formatted, turns[0][2], turns[0][3]
    raise AssertionError("a fully escaped text always reads back")


def format_turns(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per turn: conv_id, turn, role, formatted, mask_start, mask_end.

    A conversation's training text is its turns' ``formatted`` in order; the loss mask is the span
    [mask_start, mask_end) of code points in each turn of ``loss_role``, null in others. No shuffle.

    Defined cases: null texts and roles are empty; rows may repeat, and each is a turn of its own; an
    empty table gives no rows; further columns are dropped.
    """

    def render(batch: pa.RecordBatch) -> pa.RecordBatch:
        roles = texts(batch.column(2))
        made = [render_turn(r, t) for r, t in zip(roles, texts(batch.column(3)))]
        masked = [(a, b) if r == loss_role else (None, None) for r, (_, a, b) in zip(roles, made)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(roles, pa.string()),
                pa.array([m[0] for m in made], pa.string()),
                pa.array([a for a, _ in masked], pa.int64()),
                pa.array([b for _, b in masked], pa.int64()),
            ],
            names=["conv_id", "turn", "role", "formatted", "mask_start", "mask_end"],
        )

    source = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return map_batches(source, render, "conv_id long, turn long, role string, formatted string, mask_start long, mask_end long")


READ_BACK = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, what its formatted text holds: counts and digests of the turns and of the text under the mask.

    A digest of a whole conversation needs its turns in order, so turns are dealt by conversation, sorted
    within each partition and streamed: a task keeps two hash states and never a conversation.
    Turns are ordered by turn, nulls first, then by formatted text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, fresh = None, [], True

        def state(conv):
            return {"conv": conv, "n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def result(s):
            return (s["conv"], s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"])

        def batch_of(rows):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[c.split()[0] for c in READ_BACK.split(", ")])

        for batch in batches:
            for conv, formatted, a, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if fresh or conv != now["conv"]:
                    if not fresh:
                        done.append(result(now))
                    now, fresh = state(conv), False
                for role, text, start, end in parse(formatted):
                    now["n"] += 1
                    now["turns"].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    if a is not None:
                        if (a, b) != (start, end):
                            raise ValueError("the loss mask is not a turn's text")
                        now["loss"].update(text.encode("utf-8", "surrogatepass"))
                        now["loss_chars"] += len(text)
                now["chars"] += len(formatted)
            if done:
                yield batch_of(done)
                done = []
        if not fresh:
            yield batch_of([result(now)])

    dealt = turns.select("conv_id", "turn", "formatted", "mask_start", "mask_end").repartition("conv_id")
    ordered = dealt.sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "formatted")
    return ordered.select("conv_id", "formatted", "mask_start", "mask_end").mapInArrow(run, READ_BACK)
