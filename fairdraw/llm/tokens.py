"""Token ids of documents in compressed files that decode in parallel.

Documents are tokenized, put into ascending ``doc_id`` order by a range
partitioning and written one file per partition, each file a run of blocks:

    magic, bytes of the index, bytes of the coded ids, checksum of both, flags
    index: number of documents, their ids, which ids are null, tokens of each
    coded ids: see :mod:`fairdraw.llm.rans`

A block ends with a document once it has ``BLOCK`` tokens; a document longer
than that goes on in further blocks (flag 1). The blocks from one that starts
a document up to the next such block are a unit. The manifest, a table, has a
checkpoint per unit: file, offset, number of blocks and the tokens before it.
Units decode independently, block by block, so the memory of a task is bounded
by a block whatever the length of a document.

The folder stands alone: beside ``files`` and ``manifest`` it has a table
``model`` of one row, the frequencies all blocks share, the end id, and the
digest of the tokenizer the ids belong to. :func:`open_tokens` needs no more.

Nulls: a null text is an empty text; a null ``doc_id`` comes first and is kept
as null. Rows with the same ``doc_id`` are documents of their own, in the order
of their ids. Every document ends with the end id, empty ones hold only that.
An empty table gives no file and no row. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairdraw.llm import rans
from fairdraw.llm.storage import attempt_name, filesystem, new_folder, published, remove, written
from fairdraw.llm.text import BLANK, Texts, bounds_of, hashes_of, numbered, rows

BLOCK = 1 << 18
# Pieces a Python worker remembers with their ids: up to twice so many, of which
# the last used stay. Longer pieces are not remembered. Words the model gets at a time.
REMEMBERED, WORD_BYTES, WORDS = 250_000, 40, 1000
_HEAD = struct.Struct("<4sIIII")
_MAGIC = b"RTK1"
UNIT = "file string, file_no int, unit_no long, place long, blocks int, docs long, tokens long, tokens_before long"
DECODED = "doc_id long, place long, n_tokens long, ids_crc32 long, file_no int, tokens_before long"

_STEM = np.zeros(256, bool)
_STEM[48:58] = _STEM[65:91] = _STEM[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[33:127] = True
_MARK[_STEM | (np.arange(256) == 39)] = False


# The tokenizer's byte-level alphabet: printable bytes stand for themselves,
# the others for the characters from 256 on. A space parts words.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = np.arange(256, dtype="<u2")
_others = np.setdiff1d(np.arange(256), _PRINTABLE)
_ALPHABET[_others] = 256 + np.arange(len(_others))
_ALPHABET[32] = 32
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _latin(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Which words hold only ASCII letters and letters from U+00C0 to U+01FF that
    the tokenizer's normal form leaves or maps to one lower-case letter: not U+0130.
    ``data`` has the words with a space between."""
    lead, follows = (data >= 0xC3) & (data <= 0xC7), (data & 0xC0) == 0x80
    bad = ~(_LETTER[data] | lead | follows | (data == 32))
    before = np.zeros(len(data), bool)
    before[1:] = lead[:-1]
    bad |= before != follows
    two = data[:-1].astype(np.uint16) << 8 | data[1:]
    bad[:-1] |= (two == 0xC397) | (two == 0xC3B7) | (two == 0xC4B0)
    return ~np.logical_or.reduceat(bad, begin)


def _places(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs that begin at ``begin``, one run after the other."""
    upto = np.cumsum(size)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin - upto + size, size)


class Known:
    """Pieces with their ids, found by a hash and compared byte by byte."""

    def __init__(self, kind: np.dtype) -> None:
        self.hashes, self.number = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.data, self.ids = np.empty(0, np.uint8), np.empty(0, kind)
        # Per piece: where its bytes and its ids begin, how many, when last used.
        self.table = np.empty((5, 0), np.int64)
        self.now = 0

    def find(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The numbers of pieces of ``data``, -1 for new ones."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return out
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = self.number[at]
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.table[1, number] == size))
        number, size = number[hit], size[hit]
        differs = data[_places(start[hit], size)] != self.data[_places(self.table[0, number], size)]
        if differs.any():
            same = np.bincount(np.repeat(np.arange(len(hit)), size), differs, len(hit)) == 0
            hit, number = hit[same], number[same]
        out[hit] = number
        self.now += 1
        self.table[4, number] = self.now
        return out

    def add(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray, begin: np.ndarray, n: np.ndarray) -> None:
        """Keep new pieces; of those with one hash the first."""
        hashes, first = np.unique(hashes, return_index=True)
        at = np.searchsorted(self.hashes, hashes)
        if len(self.hashes):
            free = self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes
            hashes, first, at = hashes[free], first[free], at[free]
        start, size, begin, n = start[first], size[first], begin[first], n[first]
        rows = [len(self.data) + np.cumsum(size) - size, size, len(self.ids) + np.cumsum(n) - n, n, np.full(len(first), self.now)]
        self.number = np.insert(self.number, at, self.table.shape[1] + np.arange(len(first)))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.table = np.concatenate((self.table, rows), axis=1)
        self.data = np.concatenate((self.data, data[_places(start, size)]))
        self.ids = np.concatenate((self.ids, ids[_places(begin, n)]))
        if len(self.hashes) > 2 * REMEMBERED:
            self._keep(np.sort(np.argsort(self.table[4], kind="stable")[-REMEMBERED:]))

    def _keep(self, kept: np.ndarray) -> None:
        renamed = np.full(self.table.shape[1], -1, np.int64)
        renamed[kept] = np.arange(len(kept))
        number = renamed[self.number]
        self.hashes, self.number = self.hashes[number >= 0], number[number >= 0]
        start, size, begin, n, used = self.table[:, kept]
        self.data, self.ids = self.data[_places(start, size)], self.ids[_places(begin, n)]
        self.table = np.stack((np.cumsum(size) - size, size, np.cumsum(n) - n, n, used))


class Encoder:
    """Ids of words, those of frequent words from memory.

    The tokenizer never joins characters across white space, nor a letter or
    digit with a following mark other than the apostrophe, so the ids of a text
    are those of its pieces. Pieces are told apart by their bytes; a new piece
    goes through the tokenizer, plain Latin words straight to its model, many at
    a time: the last id of each says that the word ends.
    """

    def __init__(self, tokenizer: str, kind: np.dtype) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        # A task has one core; a thread per core of the machine would only hold memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.kind = kind
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        # Their strings stand for themselves only in a text as a whole.
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(kind)

    def ids_of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces, and where each one's begin and how many they are."""
        n = np.zeros(len(pieces), np.int64)
        if not pieces:
            return np.empty(0, self.kind), n, n
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        plain = _latin(np.frombuffer(b" ".join(pieces), np.uint8), np.cumsum(size + 1) - size - 1)
        order = np.flatnonzero(plain & (size <= WORD_BYTES))
        rest = np.flatnonzero(~plain | (size > WORD_BYTES))
        found = []
        for low in range(0, len(order), WORDS):
            now = order[low : low + WORDS]
            letters = np.frombuffer(b" ".join([pieces[i] for i in now.tolist()]).decode().lower().encode(), np.uint8)
            mapped = _ALPHABET[letters].tobytes().decode("utf-16-le")
            ids = np.array(self.words.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(now):
                raise ValueError("words that do not end")
            n[now] = np.diff(ends, prepend=-1)
            found.append(ids)
        for low in range(0, len(rest), 500):
            now = rest[low : low + 500].tolist()
            texts = [pieces[i].decode("utf-8", "replace") for i in now]
            for i, coded in zip(now, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = coded.ids
                n[i] = len(ids)
                found.append(np.array(ids, self.kind))
        begin, both = np.empty(len(pieces), np.int64), np.concatenate((order, rest))
        begin[both] = np.cumsum(n[both]) - n[both]
        return np.concatenate(found), begin, n

    def __call__(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin."""
        ids, first = self._pieced(texts)
        data = texts.data.tobytes()
        if not any(word in data for word in self.special):
            return ids, first
        parts = [ids[first[i] : first[i + 1]] for i in range(len(texts))]
        for i, (low, high) in enumerate(zip(texts.offsets, texts.offsets[1:], strict=False)):
            if any(data.find(word, low, high) >= 0 for word in self.special):
                whole = self.tokenizer.encode(data[low:high].decode("utf-8", "replace"), add_special_tokens=False)
                parts[i] = np.array(whole.ids, self.kind)
        return np.concatenate(parts), np.cumsum([0, *map(len, parts)])

    def _pieced(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        data = texts.data
        start, end, first = bounds_of(texts, BLANK, _cuts(data))
        hashes = hashes_of(data, start, end)
        which, place = numbered(data, start, end, hashes)
        hashes, start, size = hashes[place], start[place], (end - start)[place]
        number = self.known.find(hashes, data, start, size)
        new = np.flatnonzero(number < 0)
        whole = data.tobytes()
        pieces = [whole[s:e] for s, e in zip(start[new].tolist(), (start + size)[new].tolist(), strict=True)]
        ids, at, count = self.ids_of(pieces)
        old = self.known.ids
        table, begin, n = np.concatenate((old, ids)), np.empty(len(place), np.int64), np.empty(len(place), np.int64)
        if len(old):
            begin[:], n[:] = self.known.table[2:4, number]
        begin[new], n[new] = len(old) + at, count
        short = size[new] <= WORD_BYTES
        self.known.add(hashes[new][short], data, start[new][short], size[new][short], ids, at[short], count[short])
        n = n[which]
        return table[_places(begin[which], n)], np.concatenate(([0], np.cumsum(n)))[first]


def id_type(size: int) -> np.dtype:
    """The narrowest type for ids below ``size``."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where an ASCII mark follows an ASCII letter or digit."""
    cuts = np.zeros(len(data), bool)
    cuts[1:] = _MARK[data[1:]] & _STEM[data[:-1]]
    return cuts


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``doc_id`` and the ids of each text with the end id, as bytes of
    little-endian unsigned numbers of the narrowest type."""
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = id_type(vocabulary_size(tokenizer_path, end_id))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, kind)
        for batch in batches:
            for part, texts in rows(batch, "text", 2 << 20):
                ids, first = encoder(texts)
                ends = np.insert(ids, first[1:], end_id)
                first = first + np.arange(len(first))
                data = ends.astype(encoder.kind).tobytes()
                offsets = pa.py_buffer((first * encoder.kind.itemsize).astype(np.int32).tobytes())
                column = pa.Array.from_buffers(pa.binary(), len(texts), [None, offsets, pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids binary"
    )


_ENCODERS: dict[int, Encoder] = {}


def _encoder(tokenizer, kind: np.dtype) -> Encoder:
    """One per Python worker: what it remembers serves its next tasks."""
    key = zlib.crc32(tokenizer.value.encode()) ^ kind.itemsize
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tokenizer.value, kind)
    return _ENCODERS[key]


def counts_of(tokens: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs: ``size`` numbers, whatever the data."""

    kind = id_type(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            ids = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].view(kind)
            for low in range(0, len(ids), BLOCK):
                counts += np.bincount(ids[low : low + BLOCK], minlength=size)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["id", "n"])

    total = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in total.collect():
        out[row["id"]] = row["n"]
    return out


class _Blocks:
    """Cuts a run of documents into blocks."""

    def __init__(self, model: rans.Model, most: int) -> None:
        self.model, self.most, self.open, self.size = model, most, [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple[bytes, bool, int, int]]:
        """Coded blocks as they fill: bytes, whether it goes on with a document
        of the block before, documents that start in it, tokens."""
        low, goes_on = 0, False
        while len(ids) - low > self.most:
            if self.open:
                yield self.close()
            self.open, self.size = [(doc_id, ids[low : low + self.most])], self.most
            yield self.close(goes_on)
            low, goes_on = low + self.most, True
        if goes_on:
            self.open, self.size = [(doc_id, ids[low:])], len(ids) - low
            yield self.close(True)
            return
        self.open.append((doc_id, ids))
        self.size += len(ids)
        if self.size >= self.most:
            yield self.close()

    def close(self, goes_on: bool = False) -> tuple[bytes, bool, int, int]:
        entries, size = self.open, self.size
        self.open, self.size = [], 0
        index = struct.pack("<I", len(entries))
        index += np.array([d or 0 for d, _ in entries], "<i8").tobytes()
        index += np.array([d is None for d, _ in entries], np.uint8).tobytes()
        index += np.array([len(x) for _, x in entries], "<u4").tobytes()
        coded = rans.encode(np.concatenate([x for _, x in entries]), self.model)
        head = _HEAD.pack(_MAGIC, len(index), len(coded), rans.checksum(index + coded), int(goes_on))
        return head + index + coded, goes_on, len(entries) - goes_on, size


def write_files(tokens: DataFrame, model: rans.Model, folder: str, partitions: int, block: int = BLOCK) -> DataFrame:
    """Write the coded files and return the manifest, a row per unit."""
    shared = tokens.sparkSession.sparkContext.broadcast(model.frequency)
    kind = id_type(len(model.frequency))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(rans.Model.of_frequency(shared.value), block)
        number = TaskContext.get().partitionId()
        name, units, place, before = attempt_name(f"tokens-{number:06d}", "rtk"), [], 0, 0

        def put(stream, made) -> None:
            nonlocal place, before
            for data, goes_on, docs, size in made:
                stream.write(data)
                if goes_on:
                    units[-1]["blocks"] += 1
                    units[-1]["tokens"] += size
                else:
                    units.append(
                        {"file": name, "file_no": number, "unit_no": len(units), "place": place, "blocks": 1}
                        | {"docs": docs, "tokens": size, "tokens_before": before}
                    )
                place, before = place + len(data), before + size

        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        with published(folder, name) as stream:
            batch: pa.RecordBatch | None = first
            while batch is not None:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                    put(stream, blocks.add(doc_id, np.frombuffer(ids.as_buffer(), kind)))
                batch = next(batches, None)
            if blocks.open:
                put(stream, [blocks.close()])
        yield pa.RecordBatch.from_pylist(units, schema=_UNIT_SCHEMA)

    # Documents of one id are split by their first ids, which keeps their order.
    head = F.substring("ids", 1, 64)
    ordered = tokens.repartitionByRange(partitions, F.asc_nulls_first("doc_id"), head).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "ids"
    )
    return ordered.mapInArrow(run, UNIT)


_UNIT_SCHEMA = pa.schema(
    [("file", pa.string()), ("file_no", pa.int32()), ("unit_no", pa.int64()), ("place", pa.int64())]
    + [("blocks", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("tokens_before", pa.int64())]
)


def _blocks_at(stream, place: int, blocks: int, model: rans.Model):
    """Entries of a unit's blocks: doc_id, its ids in this block, whether it goes on."""
    stream.seek(place)
    for _ in range(blocks):
        magic, n_index, n_coded, check, flags = _HEAD.unpack(stream.read(_HEAD.size))
        data = stream.read(n_index + n_coded)
        if magic != _MAGIC or rans.checksum(data) != check:
            raise ValueError(f"damaged block at {place}")
        (n,) = struct.unpack_from("<I", data)
        doc_ids = np.frombuffer(data, "<i8", n, 4).tolist()
        nulls = np.frombuffer(data, np.uint8, n, 4 + 8 * n)
        sizes = np.frombuffer(data, "<u4", n, 4 + 9 * n)
        ids = rans.decode(data[n_index:], model)
        at = 0
        for i, size in enumerate(sizes.tolist()):
            yield None if nulls[i] else doc_ids[i], ids[at : at + size], bool(flags) and i == 0
            at += size


def decode_files(manifest: DataFrame, model: rans.Model, folder: str, partitions: int) -> DataFrame:
    """Per document of the files its number of tokens and the checksum of its
    ids; ``place`` is the tokens before it in its unit."""
    shared = manifest.sparkSession.sparkContext.broadcast(model.frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Model.of_frequency(shared.value)
        for batch in batches:
            for unit in batch.to_pylist():
                where, path = filesystem(f"{folder}/{unit['file']}")
                out, before = [], 0
                with where.open_input_file(path) as stream:
                    for doc_id, ids, goes_on in _blocks_at(stream, unit["place"], unit["blocks"], table):
                        data = ids.astype("<u4").tobytes()
                        if goes_on:
                            out[-1][2] += len(ids)
                            out[-1][3] = zlib.crc32(data, out[-1][3])
                        else:
                            out.append([doc_id, before, len(ids), zlib.crc32(data)])
                        before += len(ids)
                if before != unit["tokens"]:
                    raise ValueError("a unit does not hold its tokens")
                columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)]
                n = len(out)
                columns += [pa.array([unit["file_no"]] * n, pa.int32()), pa.array([unit["tokens_before"]] * n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "place", "n_tokens", "ids_crc32", "file_no", "tokens_before"])

    # A number given explicitly: manifest rows are few bytes but much work.
    return manifest.repartition(partitions, "file_no", "unit_no").mapInArrow(run, DECODED)


def read_ids(files: TokenFiles) -> DataFrame:
    """The ids themselves, a row per document and block: ``doc_id, part, ids``."""
    spark, folder = files.manifest.sparkSession, f"{files.folder}/files"
    shared = spark.sparkContext.broadcast(files.model.frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Model.of_frequency(shared.value)
        for unit in (u for batch in batches for u in batch.to_pylist()):
            where, path = filesystem(f"{folder}/{unit['file']}")
            part = 0
            with where.open_input_file(path) as stream:
                for doc_id, ids, goes_on in _blocks_at(stream, unit["place"], unit["blocks"], table):
                    part = part + 1 if goes_on else 0
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": doc_id, "part": part, "ids": ids.tolist()}],
                        schema=pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(pa.int64()))]),
                    )

    units = files.manifest.repartition(files.partitions, "file_no", "unit_no")
    return units.mapInArrow(run, "doc_id long, part int, ids array<long>")


def vocabulary_size(tokenizer_path: str, end_id: int) -> int:
    """One more than the largest id. Read from the file: a tokenizer loaded for
    that would stay in the driver's memory."""
    with open(tokenizer_path, encoding="utf-8") as file:
        said = json.load(file)
    added = [token["id"] for token in said.get("added_tokens") or []]
    return max(*said["model"]["vocab"].values(), *added, end_id) + 1


def write_tokens(
    docs: DataFrame, tokenizer_path: str, end_id: int, folder: str, partitions: int | None = None, block: int = BLOCK
) -> None:
    """Tokenize, count, and write the files, their manifest and the shared model.

    The ids are written once before they are ordered, so that sampling the
    order and counting the frequencies do not tokenize again; that copy is removed.
    """
    spark = docs.sparkSession
    tokens = written(tokenize(docs, tokenizer_path, end_id), folder, "ids")
    model = rans.Model.of_counts(counts_of(tokens, vocabulary_size(tokenizer_path, end_id)))
    partitions = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens.rdd.getNumPartitions())
    written(write_files(tokens, model, f"{folder}/files", partitions, block), folder, "manifest", rows=256)
    with open(tokenizer_path, "rb") as file:
        digest = hashlib.sha256(file.read()).hexdigest()
    row = (model.frequency.astype("<u4").tobytes(), end_id, digest, partitions)
    kind = "frequency binary, end_id int, tokenizer_sha256 string, partitions int"
    spark.createDataFrame([row], kind).write.parquet(f"{folder}/model")
    remove(spark, f"{folder}/ids")


@dataclass
class TokenFiles:
    """A folder of token files, opened: ``partitions`` tasks decode it well."""

    folder: str
    manifest: DataFrame
    model: rans.Model
    end_id: int
    tokenizer_sha256: str
    partitions: int


def open_tokens(spark: SparkSession, folder: str) -> TokenFiles:
    row = spark.read.parquet(f"{folder}/model").first()
    model = rans.Model.of_frequency(np.frombuffer(row["frequency"], "<u4").astype(np.int64))
    manifest = spark.read.schema(UNIT).parquet(f"{folder}/manifest")
    return TokenFiles(folder, manifest, model, row["end_id"], row["tokenizer_sha256"], row["partitions"])


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write all documents as token files and read them back: per document
    ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    write_tokens(docs, tokenizer_path, end_id, folder)
    return documents_of(open_tokens(spark, folder))


def documents_of(files: TokenFiles) -> DataFrame:
    """Per document of the files its place, its number of tokens and the checksum
    of its ids: ``doc_id, start, n_tokens, ids_crc32``."""
    manifest = files.manifest
    made = decode_files(manifest, files.model, f"{files.folder}/files", files.partitions)
    decoded = written(made, new_folder(manifest.sparkSession, "decoded"), "documents", rows=16)
    # One row per file: the tokens of all files before it.
    totals = manifest.groupBy("file_no").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("file_no", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("file_start"))
    return decoded.join(offsets, "file_no").select(
        "doc_id",
        (F.col("file_start") + F.col("tokens_before") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
