"""Alignment of the tokens of two tokenizers, by the spans both report.

A byte-level BPE (A) and a sentencepiece model with byte fallback (B) encode the
same bytes, a space and the text. Their spans, character offsets of A and byte
spans of B, are coarse cuts: a token's end is known where its span is not empty
and the next one starts behind it. Tokens that share a character (parts of a
multibyte one) and byte-fallback tokens are placed between the cuts by the
lengths of their decoded bytes. Offsets where tokens of both end cut the text
into groups; a link is a pair of overlapping tokens.

Neither tokenizer joins a character with a space behind it, so a text is cut into
units, each a run of spaces and what follows it, whose tokens don't depend on
what stands around them. A Python worker remembers the aligned units by their
bytes. This is checked on the tokenizers' files; with others a text is one unit.

How often a pair of ids is linked is counted over the corpus: a chunk, some
megabytes of text, lists its distinct pairs once, and each document holds numbers
of that list. Only the lists are shuffled and joined with the totals.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.llm.storage import new_folder, written
from fairdraw.llm.text import numbered, rows

#: Bytes of text whose pairs are listed together.
CHUNK = 4 << 20
#: Units handled at once; a long text takes several rounds.
ROUND = 400_000
# Units a worker remembers, twice this at most, and the longest of them.
REMEMBERED, UNIT_BYTES = 200_000, 48
# Bytes of units that are encoded as one text. Both tokenizers take more time a byte
# for longer ones; a few kilobytes outweigh what a call costs.
JOINED = 1 << 12

_SPACE = "▁"
_CHUNKS = (
    "chunk long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "digests array<string>, uses binary, pairs array<long>, counts array<long>"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# Tokens of some bytes: how many of A and B, the number of groups, these as text,
# and the linked pairs, ``a << 32 | b``, as bytes of 64-bit numbers. None of them
# where tokens don't give the bytes back. Millions are made: plain tuples.
Unit = tuple[int, int, int, bytes, bytes]
_LOST: Unit = (0, 0, 0, b"", b"")
_SPAN = attrgetter("id", "end")


def _cut_bytes() -> np.ndarray:
    """Bytes a space may be cut from: visible ASCII, or the end of a character of
    two bytes; no blank character ends so but those that begin with 0xC2."""
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = 1
    kinds[128:192] = 2
    return kinds


_BEFORE = _cut_bytes()


def unit_starts(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where units start: at every text's first byte, and at a run of spaces
    behind a visible character, unless the run ends the text."""
    n = len(data)
    kind = _BEFORE[data]
    lead = np.zeros(n, bool)
    lead[1:] = (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
    visible = (kind == 1) | ((kind == 2) & lead)
    starts = np.zeros(n, bool)
    starts[1:] = (data[1:] == 32) & visible[:-1]
    # A run that reaches the end of its text belongs to the unit before.
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        at = high
        while at > low and data[at - 1] == 32:
            at -= 1
        starts[at:high] = False
    starts[first[:-1]] = True
    return np.flatnonzero(starts)


class Aligner:
    """Both tokenizers, and the units that were aligned before."""

    def __init__(self, a: str, b: bytes) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b)
        self.bytes_a = _bytes_of_a(self.a)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [self._bytes_of_b(i, p) for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # The tables of names one behind the other, and where each begins.
        names = [_names(len(t), mark) for t, marks in ((self.bytes_a, ",|"), (self.bytes_b, ",;")) for mark in marks]
        self.names = np.array(list(chain.from_iterable(names)), object), np.cumsum([0, *map(len, names[:-1])]).tolist()
        kind = json.loads(a).get("pre_tokenizer") or {}
        parted = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not json.loads(a).get("normalizer")
        self.separable = bool(parted) and not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.all_a, self.all_b = (np.array(t, object) for t in (self.bytes_a, self.bytes_b))
        self.new: dict[bytes, Unit] = {}
        self.old: dict[bytes, Unit] = {}

    def _bytes_of_b(self, number: int, piece: str) -> bytes:
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace(_SPACE, " ").encode()

    def units(self, distinct: list[bytes]) -> list[Unit]:
        """The units of some distinct bytes."""
        found = list(map(self.new.get, distinct))
        missed = [i for i, x in enumerate(found) if x is None]
        older = list(map(self.old.get, [distinct[i] for i in missed]))
        unknown = [i for i, x in zip(missed, older, strict=True) if x is None]
        made = iter(self.align([distinct[i] for i in unknown]))
        if len(self.new) > REMEMBERED:
            # Of the new ones, those in use go on.
            self.old, self.new = self.new, {u: x for u, x in zip(distinct, found, strict=True) if x is not None}
        for i, x in zip(missed, older, strict=True):
            found[i] = unit = x or next(made) or _LOST
            if len(distinct[i]) <= UNIT_BYTES:
                self.new[distinct[i]] = unit
        return found

    def align(self, units: list[bytes]) -> list[Unit | None]:
        out: list[Unit | None] = [None] * len(units)
        run, size = [], 0
        for i, unit in enumerate(units):
            # Only what ends like a unit within a text may be followed by another.
            joins = self.separable and (33 <= unit[-1] < 127 or (len(unit) > 1 and unit[-1] >= 128 and 0xC3 <= unit[-2] < 0xE0))
            if not joins:
                out[i] = self._aligned([unit])[0]
                continue
            run.append(i)
            size += len(unit)
            if size > JOINED:
                self._fill(out, units, run)
                run, size = [], 0
        self._fill(out, units, run)
        return out

    def _fill(self, out: list, units: list[bytes], run: list[int]) -> None:
        if not run:
            return
        done = self._aligned([units[i] for i in run])
        # One that can't be given back may have moved the spans of the others.
        done = [self._aligned([units[i]])[0] for i in run] if any(x is None for x in done) and len(run) > 1 else done
        for i, unit in zip(run, done, strict=True):
            out[i] = unit

    def _aligned(self, units: list[bytes]) -> list[Unit | None]:
        whole = b"".join(units)
        text = whole.decode("utf-8", "replace")
        coded = self.a.encode(text, add_special_tokens=False)
        ids_a = np.array(coded.ids, np.int64)
        pieces = self.b.encode(text[1:], return_type="proto").pieces
        known = np.fromiter(chain.from_iterable(map(_SPAN, pieces)), np.int64, 2 * len(pieces)).reshape(-1, 2)
        ids_b = known[:, 0]
        given = b"".join(self.all_a[ids_a].tolist()), b"".join(self.all_b[ids_b].tolist())
        if given[0] != whole or given[1] != whole or not whole:
            return [None] * len(units)
        data = np.frombuffer(whole, np.uint8)
        chars = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        offsets = np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(ids_a))
        ends_a = refined(chars[offsets[::2]], chars[offsets[1::2]], self.size_a[ids_a])
        # The space before the text is not in B's spans; each starts where the one
        # before ends, and the last byte of a character ends all of its bytes.
        ends = known[:, 1] + 1
        ends_b = refined(np.concatenate(([0], ends[:-1])), ends, self.size_b[ids_b])
        return _grouped(np.cumsum([len(u) for u in units]), ids_a, ends_a, ids_b, ends_b, self.names)


def _names(size: int, mark: str) -> list[bytes]:
    """Each id as text, followed by a mark."""
    return [f"{i}{mark}".encode() for i in range(size)]


def _bytes_of_a(tokenizer) -> list[bytes]:
    """The bytes of each entry: printable bytes stand for themselves, the others
    for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    entries = tokenizer.get_vocab(with_added_tokens=False)
    out = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        out[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
    return out


def refined(start: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where tokens end, from byte spans that are right only where a token shares
    no character with the next, and the lengths of the decoded bytes."""
    n = len(end)
    sure = end > start
    sure[:-1] &= start[1:] >= end[:-1]
    total = np.cumsum(size)
    last = np.maximum.accumulate(np.where(sure, np.arange(n), -1))
    base = np.where(last >= 0, end[last], 0)
    return base + total - np.where(last >= 0, total[last], 0)


def _grouped(bounds, ids_a, ends_a, ids_b, ends_b, names) -> list[Unit | None]:
    """The units that end at ``bounds``, from all tokens and their ends."""
    if max(ends_a.max(), ends_b.max()) > bounds[-1]:
        return [None] * len(bounds)
    marks = np.zeros(bounds[-1] + 1, np.uint8)
    marks[ends_a] = 1
    marks[ends_b] |= 2
    cuts, common = np.flatnonzero(marks), np.flatnonzero(marks == 3)
    pairs = ids_a[np.searchsorted(ends_a, cuts)] << 32 | ids_b[np.searchsorted(ends_b, cuts)]
    # The ids as text in the order of the groups, A's before B's in each.
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    upto_a, upto_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
    table, (comma_a, bar, comma_b, semicolon) = names
    # A place left out would lie beyond the table.
    text = np.full(len(ids_a) + len(ids_b), len(table))
    text[np.arange(len(ids_a)) + np.concatenate(([0], upto_b))[group_a]] = ids_a + np.where(marks[ends_a] == 3, bar, comma_a)
    text[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b + np.where(marks[ends_b] == 3, semicolon, comma_b)
    at = [np.searchsorted(x, bounds, "right") for x in (ends_a, ends_b, common, cuts)]
    if not len(common) or (common[at[2] - 1] != bounds).any():
        return [None] * len(bounds)
    parts, raw, starts = table[text].tolist(), pairs.tobytes(), [np.concatenate(([0], x[:-1])) for x in at]
    sizes = [(x - y).tolist() for x, y in zip(at[:3], starts[:3], strict=True)]
    # A unit's groups lie in one piece; the mark behind the last is left out.
    upto, whole = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts))), b"".join(parts)
    last = upto[at[0] + at[1] - 1]
    first = np.concatenate(([0], last[:-1]))
    places = first.tolist(), (last - 1).tolist(), (starts[3] * 8).tolist(), (at[3] * 8).tolist()
    return [
        (a, b, g, whole[low:high], raw[x:y]) for a, b, g, low, high, x, y in zip(*sizes, *places, strict=True)
    ]


class _Document:
    """What is known of a document so far."""

    def __init__(self) -> None:
        self.sizes = np.zeros(3, np.int64)
        self.digest, self.good, self.pairs = hashlib.sha256(), True, []

    def add(self, sizes: np.ndarray, groups: list[bytes], pairs: np.ndarray) -> None:
        if self.sizes[2]:
            self.digest.update(b";")
        self.digest.update(b";".join(groups))
        self.sizes += sizes
        self.pairs.append(np.unique(pairs, return_counts=True))

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and how often each is linked."""
        if len(self.pairs) == 1:
            return self.pairs[0]
        pairs, at = np.unique(np.concatenate([p for p, _ in self.pairs]), return_inverse=True)
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, at, np.concatenate([n for _, n in self.pairs]))
        return pairs, counts


def _documents(aligner: Aligner, texts: list[bytes]) -> list[_Document]:
    documents = [_Document() for _ in texts]
    filled = [i for i, t in enumerate(texts) if t]
    whole = b"".join(b" " + texts[i] for i in filled)
    data = np.frombuffer(whole, np.uint8)
    first = np.concatenate(([0], np.cumsum([len(texts[i]) + 1 for i in filled], dtype=np.int64)))
    starts = unit_starts(data, first) if aligner.separable else first[:-1]
    owner = np.searchsorted(first, starts, "right") - 1
    ends = np.append(starts[1:], len(data))
    for low in range(0, len(starts), ROUND):
        high = min(low + ROUND, len(starts))
        order, place = numbered(data, starts[low:high], ends[low:high])
        distinct = zip(starts[low:high][place].tolist(), ends[low:high][place].tolist(), strict=True)
        units = aligner.units([whole[s:e] for s, e in distinct])
        *numbers, groups, pairs = zip(*units, strict=True)
        sizes = np.array(numbers, np.int64).T
        good = sizes[:, 0] > 0
        table = np.frombuffer(b"".join(pairs), np.int64)
        n_pairs = np.fromiter(map(len, pairs), np.int64, len(pairs)) // 8
        begin = np.cumsum(n_pairs) - n_pairs
        which = order.tolist()
        bounds = [*np.flatnonzero(np.diff(owner[low:high], prepend=-1)).tolist(), high - low]
        for at, to in zip(bounds, bounds[1:], strict=False):
            document, mine = documents[filled[owner[low + at]]], order[at:to]
            if not document.good or not good[mine].all():
                document.good = False
                continue
            n = n_pairs[mine]
            upto = np.cumsum(n)
            place = np.repeat(begin[mine] - (upto - n), n) + np.arange(upto[-1])
            document.add(sizes[mine].sum(axis=0), [groups[i] for i in which[at:to]], table[place])
    return documents


def _chunk(number: int, doc_ids: list[int | None], documents: list[_Document]) -> dict:
    linked = [d.linked() if d.good and d.pairs else (np.empty(0, np.int64),) * 2 for d in documents]
    pairs, at = np.unique(np.concatenate([p for p, _ in linked]), return_inverse=True)
    n = np.concatenate([c for _, c in linked])
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, at, n)
    sizes = np.array([len(p) for p, _ in linked], "<u4")
    raw = sizes.tobytes() + at.astype("<u4").tobytes() + n.astype("<u4").tobytes()
    sums = np.array([d.sizes if d.good else (0, 0, 0) for d in documents], np.int64).reshape(-1, 3)
    return {
        "chunk": number,
        "doc_ids": doc_ids,
        "n_a": sums[:, 0],
        "n_b": sums[:, 1],
        "n_groups": sums[:, 2],
        "n_links": np.array([c.sum() for _, c in linked], np.int64),
        "digests": [d.digest.hexdigest() if d.good and d.pairs else "" for d in documents],
        "uses": struct.pack("<QQ", len(documents), len(at)) + pa.compress(raw, "zstd", asbytes=True),
        "pairs": pairs,
        "counts": counts,
    }


def _uses(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document the number of its distinct pairs; their numbers in the
    chunk's list, and how often each is linked."""
    docs, size = struct.unpack_from("<QQ", data)
    raw = pa.decompress(data[16:], 4 * docs + 8 * size, "zstd", asbytes=True)
    sizes, rest = np.frombuffer(raw, "<u4", docs), np.frombuffer(raw, "<u4", offset=4 * docs)
    return sizes.astype(np.int64), rest[:size], rest[size:].astype(np.int64)


_CHUNK_SCHEMA = pa.schema(
    [("chunk", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links"))]
    + [("digests", pa.list_(pa.string())), ("uses", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
)
_ALIGNERS: dict[str, Aligner] = {}


def chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """All texts aligned: a row per chunk of documents with its list of pairs."""
    with open(path_a, encoding="utf-8") as file:
        a = file.read()
    with open(path_b, "rb") as file:
        b = file.read()
    # Two files of a megabyte or two, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast((a, b))
    key = hashlib.sha256(a.encode() + b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[key] = Aligner(*shared.value)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in rows(batch, "text", CHUNK):
                whole = texts.data.tobytes()
                found = [whole[s:e] for s, e in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)]
                row = _chunk(number, part.column("doc_id").to_pylist(), _documents(_ALIGNERS[key], found))
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _CHUNK_SCHEMA], schema=_CHUNK_SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _CHUNKS)


def totals(listed: DataFrame) -> DataFrame:
    """``pair, total, best`` over all chunks: how often a pair is linked, and
    whether no other pair of its B id is linked more often."""
    summed = listed.groupBy("pair").agg(F.sum("n").alias("total"))
    # A B id has as many pairs as A has entries, at most.
    most = F.max("total").over(Window.partitionBy(F.expr("pair & 4294967295")))
    return summed.select("pair", "total", (F.col("total") == most).alias("best"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in batch.schema.names}
            sizes, at, n = _uses(row["uses"].as_py())
            known = row["known"].values
            length = 0 if known is None else len(known)
            total, best = np.zeros(length, np.int64), np.zeros(length, np.int64)
            if length:
                place = np.asarray(known.field("at"))
                total[place], best[place] = np.asarray(known.field("total")), np.asarray(known.field("best").cast(pa.int64()))
            sums = [np.concatenate(([0], np.cumsum(n * x[at]))) for x in (best, total)]
            upto = np.concatenate(([0], np.cumsum(sizes)))
            made = [pa.array(s[upto[1:]] - s[upto[:-1]]) for s in sums]
            given = [row[c].values for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays(
                [*given, *made, row["digests"].values],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def aligned_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the numbers of tokens ``n_a, n_b``, of
    groups and of links, ``n_best`` links whose pair is its B id's most frequent
    one (ties included), ``count_sum`` of the links' frequencies, and the digest
    of the groups.

    Null and empty texts, and those that either tokenizer doesn't give back
    byte by byte, have no tokens: zeros and an empty digest. Rows that repeat are
    documents of their own and count as often; a null ``doc_id`` stays null. An
    empty table gives no row. Only ``doc_id`` and ``text`` are read. A very long
    text is a chunk of its own and is aligned in rounds of units.
    """
    folder = new_folder(docs.sparkSession, "alignment")
    made = written(chunks(docs, path_a, path_b), folder, "chunks", rows=2048)
    listed = made.select("chunk", F.expr("posexplode(arrays_zip(pairs, counts)) as (at, entry)"))
    listed = listed.select("chunk", "at", F.col("entry.pairs").alias("pair"), F.col("entry.counts").alias("n"))
    counted = written(totals(listed), folder, "totals")
    known = listed.join(counted, "pair").groupBy("chunk").agg(F.collect_list(F.struct("at", "total", "best")).alias("known"))
    # A chunk's list is bounded by its text.
    rest = made.drop("pairs", "counts").join(known, "chunk", "left")
    return written(rest.mapInArrow(_summed, _RESULT), folder, "documents", rows=1)
