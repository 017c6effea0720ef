"""Aligned tokens against a plain walk over the decoded bytes of whole texts."""

from __future__ import annotations

import hashlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from samples import prose
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fairdraw.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [
    "", None, " ", "   ", "é 中文😀 x\n", "a  b ", "  lead", "end  ", "\n\n x", "▁a", "a ▁ b", "x  y   z", "\u0085 x",
    "<|endoftext|> </s> <s> <unk> <0x41>", "ﷺ ﬁ ①", "a\tb  \n c", "İstanbul ß", "𝔘𝔫𝔦 🧑‍🚀 क्षि", "x" * 3000, "no\x00nul a",
    "don't I'll we're 'tis", "́x y", "a　　 b", "ab " * 3000, "😀" * 500, "été  où  ça", "a\r\n b",
]


def tokens_of(text):
    """Ids and ends of both tokenizers; None if a text isn't given back."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table, whole = alignment._bytes_of_a(a), (" " + (text or "")).encode()
    ids = a.encode(whole.decode(), add_special_tokens=False).ids, b.encode(text or "")
    pieces = [b.id_to_piece(i) for i in ids[1]]
    parts = [table[i] for i in ids[0]], [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids[1], pieces)]
    if not text or any(b"".join(p) != whole for p in parts):
        return None
    return [(i, np.cumsum([len(x) for x in p]).tolist()) for i, p in zip(ids, parts, strict=True)]


def expected(rows):
    found, counts = [(i, tokens_of(t)) for i, t in rows], Counter()
    links = []
    for _, both in found:
        mine = []
        if both:
            (ia, ea), (ib, eb) = both
            starts = [0, *ea[:-1]], [0, *eb[:-1]]
            j = 0
            for x, s, e in zip(ia, starts[0], ea):
                while eb[j] <= s:
                    j += 1
                k = j
                while k < len(ib) and starts[1][k] < e:
                    mine.append((x, ib[k]))
                    k += 1
        links.append(mine)
        counts.update(mine)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (i, both), mine in zip(found, links, strict=True):
        if not both:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        (ia, ea), (ib, eb) = both
        cut = sorted(set(ea) & set(eb))
        names = []
        for low, high in zip([0, *cut], cut):
            groups = [",".join(str(x) for x, e in zip(ids, ends) if low < e <= high) for ids, ends in both]
            names.append("|".join(groups))
        digest = hashlib.sha256(";".join(names).encode()).hexdigest()
        n_best = sum(counts[p] == best[p[1]] for p in mine)
        out.append((i, len(ia), len(ib), len(cut), len(mine), n_best, sum(counts[p] for p in mine), digest))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_against_the_bytes(documents):
    rows = [*enumerate(t for t in AWKWARD if len(t or "") < 1000), *((100 + i, prose(i, 60 + i)) for i in range(40))]
    rows += [(None, "no id"), (None, None), (3, "again"), (3, "again")]
    got = alignment.aligned_documents(documents(rows), A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ordered(got.collect()) == ordered(expected(rows))


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(Path(A).read_text(), Path(B).read_bytes())


@pytest.mark.parametrize("parts", [1, 7, 200_000])
def test_units_give_what_whole_texts_give(aligner, monkeypatch, parts):
    """Long texts in rounds, units from memory and not."""
    monkeypatch.setattr(alignment, "ROUND", parts)
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    texts = [t for t in AWKWARD if t]
    found = alignment._documents(aligner, [t.encode() for t in texts])
    assert aligner.separable
    for text, got in zip(texts, found, strict=True):
        both = tokens_of(text)
        assert got.good == (both is not None), text[:20]
        if both:
            assert got.sizes.tolist()[:2] == [len(ids) for ids, _ in both]
            assert got.linked()[1].sum() == len(set(both[0][1]) | set(both[1][1]))


def test_units_are_encoded_in_short_texts(aligner, monkeypatch):
    """A byte of a long text takes the tokenizers more time."""
    units, sizes, a = [f" w{i}x,é".encode() for i in range(6000)], [], aligner.a

    class Seen:
        def encode(self, text, **how):
            sizes.append(len(text.encode()))
            return a.encode(text, **how)

    monkeypatch.setattr(aligner, "a", Seen())
    made = aligner.align(units)
    assert max(sizes) < 8192 and len(sizes) < 30
    assert made[::500] == [aligner.align([u])[0] for u in units[::500]]


def test_other_tokenizers_take_whole_texts(aligner):
    whole = alignment.Aligner(Path(A).read_text(), Path(B).read_bytes())
    whole.separable = False
    texts = [t.encode() for t in AWKWARD if t]
    for x, y in zip(alignment._documents(aligner, texts), alignment._documents(whole, texts), strict=True):
        assert x.good == y.good and (not x.good or x.digest.digest() == y.digest.digest())


def test_spans_are_refined_by_bytes():
    # Tokens of 1, 1, 2 and 3 bytes; the first three share the character that ends at 4.
    start, end = np.array([0, 0, 0, 4]), np.array([4, 4, 4, 7])
    assert alignment.refined(start, end, np.array([1, 1, 2, 3])).tolist() == [1, 2, 4, 7]
    # Byte fallback: only the last byte's span is not empty.
    assert alignment.refined(np.array([0, 1, 1, 1]), np.array([1, 1, 1, 4]), np.array([1, 1, 1, 1])).tolist() == [1, 2, 3, 4]


def test_empty_table_and_none_with_tokens(documents):
    assert alignment.aligned_documents(documents([]), A, B).collect() == []
    got = alignment.aligned_documents(documents([(1, None), (2, "")]), A, B).collect()
    assert ordered(got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
