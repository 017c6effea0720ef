"""Formatted chats: spans by rendering prefixes, marks inside texts, templates that rewrite."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fairdraw.llm import chats
from fairdraw.llm.queries import FORGED

KIND = "conv_id long, turn long, role string, text string, formatted string, sample int"
LEARNED = frozenset({"assistant"})
TEXT = st.text(alphabet="<|\\>im_endstar\n é😀", max_size=20)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    chosen = {}
    for number, (conv_id, turn, role, text) in enumerate(rows):
        key = ("row", number) if conv_id is None else conv_id
        chosen.setdefault(key, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for key, turns in chosen.items():
        messages = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in messages if r == "assistant")
        out.append((None if isinstance(key, tuple) else key, len(messages), digest("".join(f"{r}\n{t}\n" for r, t in messages)), len(loss), digest(loss), len(chats.marked(messages))))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "there"), (1, None, "system", "first"), (1, 2, "user", None), (1, 3, "assistant", ""),
        (2, 0, "user", FORGED), (2, 1, "assistant", FORGED), (3, 0, None, None), (4, 5, "assistant", "<|x\\<\\|<\\\\|im_end|>\n"),
        (5, 1, "assistant", "b"), (5, 1, "assistant", "a"), (5, 1, "assistant", "a"), (5, 1, "a|b\\\n", "odd role"),
        (6, 0, "user", "x" * 300_000), (6, 1, "assistant", "é😀" * 100_000), (None, 0, "assistant", "lost"), (None, 0, "assistant", "lost"),
        (None, None, None, None), (-1, 0, "user", "a"), *((8, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(500)),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(4)
    got = chats.round_trip(frame)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert chats.round_trip(spark.createDataFrame([], KIND)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), TEXT), TEXT), max_size=6))
def test_texts_come_back_and_loss_is_on_assistants(messages):
    found = list(chats.samples(messages, chats.marked, LEARNED))
    assert len(found) == 1 and found[0].rewritten_at is None
    formatted = found[0].formatted
    assert chats.read_marked(formatted) == messages
    assert [chats.unescaped(formatted[s[3] : s[4]]) for s in found[0].spans] == [t for _, t in messages]
    assert [s[5] for s in found[0].spans] == [r == "assistant" for r, _ in messages]
    # Spans follow one another and cover the text.
    assert [0, *(s[2] for s in found[0].spans)] == [*(s[1] for s in found[0].spans), len(formatted)]


def think_dropped(messages):
    """Drops the reasoning of all but the last message."""
    out = ["<s>"]
    for i, (role, text) in enumerate(messages):
        kept = text if i == len(messages) - 1 else text.split("</think>")[-1]
        out.append(f"[{role}] {kept}\n")
    return "".join(out)


def test_rewritten_history_is_split():
    messages = [("user", "q"), ("assistant", "<think>hm</think>one"), ("user", "more"), ("assistant", "two"), ("user", "end")]
    found = list(chats.samples(messages, think_dropped, LEARNED))
    assert [s.rewritten_at for s in found] == [2, None]
    assert found[0].formatted == think_dropped(messages[:2]) and found[1].formatted == think_dropped(messages)
    losses = [s.formatted[x[3] : x[4]] for s in found for x in s.spans if x[5]]
    assert losses == ["<think>hm</think>one", "two"]


@pytest.mark.parametrize(
    "template",
    [
        lambda m: "".join(f"<{r}>{t.strip()}</{r}>" for r, t in m),
        lambda m: "".join(f"{t}" for _, t in m),
        lambda m: "BOS" + "".join(f"{r}: {t} {len(t)}\n" for r, t in m),
        lambda m: " ".join(t for r, t in m if r != "system") + " EOS",
    ],
)
def test_other_templates_give_each_located_text_once(template):
    messages = [("system", "s"), ("user", "u u"), ("assistant", "a b"), ("user", "v"), ("assistant", "c d")]
    found = list(chats.samples(messages, template, LEARNED))
    assert found[-1].formatted == template(messages)
    losses = [s.formatted[x[3] : x[4]] for s in found for x in s.spans if x[5]]
    assert losses in (["a b", "c d"], [])
    assert sum(len(s.spans) for s in found) == len(messages)


def test_sizes_that_a_template_writes_are_no_message():
    found = list(chats.samples([("assistant", "long text")], lambda m: "".join(f"{t}|{len(t)}" for _, t in m), LEARNED))
    assert [x[5] for x in found[0].spans] == [False]
