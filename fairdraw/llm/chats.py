"""Chats as training texts, with the spans of their turns found by rendering.

A template is a black box: a function from messages to a text. A chat's turn
prefixes are rendered one after another. Where a rendering begins with the one
before, the rest is the span of the new turn; where it does not, the template has
rewritten history, and the text so far becomes a sample of its own, so that no
loss falls on a text that a later rendering changed or took away. The place of a
message inside its span comes from two further renderings, with one character
each in its stead: they part at the first character of the message.

The given template, :func:`marked`, writes ``<|im_start|>role``, the message and
``<|im_end|>``. A message can't forge these marks: in ``<|``, also with backslashes
in between, one backslash is put in, and taken out again on reading.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.storage import new_folder, written

START, END = "<|im_start|>", "<|im_end|>"
Message = tuple[str, str]
Template = Callable[[Sequence[Message]], str]

# Two characters for private use, which no template has a meaning for.
_PROBES = "", ""
SPAN = "struct<turn: int, first: int, last: int, text_first: int, text_last: int, loss: boolean>"
SAMPLE = f"conv_id long, sample int, n_turns int, rewritten_at int, formatted string, spans array<{SPAN}>"


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


_ROLE = {"\\": "\\\\", "\n": "\\n", "|": "\\p"}


def escaped_role(role: str) -> str:
    return re.sub(r"[\\\n|]", lambda m: _ROLE[m[0]], role)


def unescaped_role(role: str) -> str:
    back = {v[1]: k for k, v in _ROLE.items()}
    return re.sub(r"\\(.)", lambda m: back[m[1]], role)


def _message(role: str, text: str) -> str:
    return f"{START}{escaped_role(role)}\n{escaped(text)}{END}\n"


_remembered = lru_cache(1024)(_message)


def marked(messages: Sequence[Message]) -> str:
    return "".join([(_remembered if len(text) < 4096 else _message)(role, text) for role, text in messages])


def read_marked(formatted: str) -> list[Message]:
    """The messages of a text that :func:`marked` made."""
    out, at = [], 0
    while at < len(formatted):
        line = formatted.find("\n", at)
        end = formatted.find(END, line)
        if not formatted.startswith(START, at) or line < 0 or end < 0 or formatted[end + len(END)] != "\n":
            raise ValueError(f"no turn at {at}")
        out.append((unescaped_role(formatted[at + len(START) : line]), unescaped(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return out


@dataclass
class Sample:
    """A rendered text and its turns' spans: turn, first and last place (not
    included) of the turn and of its message, whether loss falls on it."""

    formatted: str = ""
    n_turns: int = 0
    rewritten_at: int | None = None
    spans: list[tuple[int, int, int, int, int, bool]] = field(default_factory=list)


def samples(messages: Sequence[Message], template: Template, learned: frozenset[str]) -> Iterator[Sample]:
    """The texts to learn from, one unless the template rewrites history. A
    turn's span begins where its rendering parts from the one before. A message
    that can't be located, as the template drops or changes it, has an empty span
    at the turn's end and no loss."""
    now = Sample(formatted=template([]))
    for turn, (role, _) in enumerate(messages):
        text = template(messages[: turn + 1])
        first = _parting(now.formatted, text, 0)
        if first < len(now.formatted):
            now.rewritten_at = turn
            yield now
            now = Sample()
        low, high = _located(messages, turn, template, text, first)
        found = low >= 0
        now.spans.append((turn, first, len(text), low if found else len(text), high if found else len(text), found and role in learned))
        now.formatted, now.n_turns = text, turn + 1
    yield now


def _parting(a: str, b: str, low: int) -> int:
    """The first place at which two texts differ, known to be ``low`` or later."""
    high = min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _located(messages: Sequence[Message], turn: int, template: Template, text: str, first: int) -> tuple[int, int]:
    """Where the message of a turn stands in a rendering; -1 if it doesn't."""
    head = list(messages[:turn])
    role = messages[turn][0]
    a, b = (template([*head, (role, probe)]) for probe in _PROBES)
    low = _parting(a, b, 0 if a[:first] != b[:first] else min(first, len(a), len(b)))
    behind = a[low + 1 :]
    inside = low < len(a) and a[low] == _PROBES[0] and b[low : low + 1] == _PROBES[1] and b[low + 1 :] == behind
    if not inside or text[:low] != a[:low] or not text.endswith(behind) or len(text) - len(behind) < low:
        return -1, -1
    return low, len(text) - len(behind)


_SPANS = pa.list_(
    pa.struct([(c, pa.int32()) for c in ("turn", "first", "last", "text_first", "text_last")] + [("loss", pa.bool_())])
)
_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("sample", pa.int32()), ("n_turns", pa.int32()), ("rewritten_at", pa.int32()), ("formatted", pa.string())]
    + [("spans", _SPANS)]
)
# Characters of a result batch.
_BATCH = 4 << 20


def _chats(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Message]]]:
    """Chats of sorted rows, one in memory at a time."""
    chat, messages = None, []
    for batch in batches:
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if messages and (conv_id is None or conv_id != chat):
                yield chat, messages
                messages = []
            chat = conv_id
            messages.append((role, text))
    if messages:
        yield chat, messages


def formatted_chats(conversations: DataFrame, template: Template = marked, learned: frozenset[str] = frozenset({"assistant"})) -> DataFrame:
    """``conv_id, sample, n_turns, rewritten_at, formatted, spans``: a row per
    chat, or several where the template rewrites history: each ends before the
    turn ``rewritten_at`` (counted from 0), whose rendering no longer begins with
    it. Together they have every located message of a ``learned`` role under the
    loss once.

    Turns are ordered by ``turn``, null first, then by role and text; null roles
    and texts are empty. Each row without ``conv_id`` is a chat of its own, so that
    they don't make one long chat. Rows that repeat are turns of their own. An
    empty table gives no row. Other columns are not read. A chat is one task's
    work, as its rendering is; its cost grows with the square of its turns, its
    memory with its text.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    given = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[x.alias(c) for c, x in text.items()])
    # Rows without id are dealt by what they hold.
    dealt = given.repartition(F.coalesce("conv_id", F.xxhash64("turn", "role", "text")))
    ordered = dealt.sortWithinPartitions(*[F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []
        size = 0
        for conv_id, messages in _chats(batches):
            for number, s in enumerate(samples(messages, template, learned)):
                spans = [dict(zip(("turn", "first", "last", "text_first", "text_last", "loss"), x, strict=True)) for x in s.spans]
                made.append((conv_id, number, s.n_turns, s.rewritten_at, s.formatted, spans))
                size += len(s.formatted)
                if size > _BATCH:
                    yield _batch(made)
                    made, size = [], 0
        if made:
            yield _batch(made)

    return ordered.mapInArrow(run, SAMPLE)


def _batch(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


_READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            messages = read_marked(row["formatted"])
            turns = hashlib.sha256("".join([f"{role}\n{text}\n" for role, text in messages]).encode())
            loss = [unescaped(row["formatted"][s["text_first"] : s["text_last"]]) for s in row["spans"] if s["loss"]]
            digest = hashlib.sha256("".join(loss).encode()).hexdigest()
            out.append((row["conv_id"], len(messages), turns.hexdigest(), sum(map(len, loss)), digest, len(row["formatted"])))
        if out:
            columns = list(zip(*out, strict=True))
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_back(formatted: DataFrame) -> DataFrame:
    """What texts that :func:`marked` made say: per row ``conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(_read, _READ)


def round_trip(conversations: DataFrame) -> DataFrame:
    """Format all chats, write them, and return what the files say of each."""
    folder = new_folder(conversations.sparkSession, "chats")
    files = written(formatted_chats(conversations), folder, "formatted")
    return written(read_back(files), folder, "read", rows=64)
