"""Documents that hold passages of a benchmark, by spaced seeds.

Each mask picks some of ``SPAN`` consecutive words and ignores the others. The
picked words of every place of a document and of every place of a benchmark
item are hashed and the hashes joined. Around a hit the words of both sides are
compared one to one: the item is found where a window of ``WINDOW`` words
agrees in all but ``SUBSTITUTED`` places. The masks are chosen so that any such
window has a place that one of them matches, wherever the differing words are.

A place of a document whose hash no item has is dropped in its task by a bitmap
of fixed size made from the items' hashes; the join decides what remains. Words
are runs of letters, digits and non-ASCII characters, with A-Z in lower case.

Items with fewer words than a window must occur whole and unchanged. Items with
fewer than ``LEAST_WORDS`` are no evidence and match nothing, as do null items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.bitmap import bitmap_of, may_contain, without
from fairdraw.llm.carried import carried
from fairdraw.llm.storage import new_folder, written
from fairdraw.llm.text import LOWER, MARKS, Words, mix, rows, words_of

WINDOW, SUBSTITUTED, SPAN = 13, 2, 9
MASKS = ((0, 1, 2, 5, 7, 8), (0, 2, 3, 4, 7, 8))
LEAST_WORDS = SPAN
#: Rows of the benchmark's side that are broadcast at most.
BROADCAST_ROWS = 100_000
# Words compared around a hit, those before it first.
_AROUND = 2 * WINDOW - SPAN
_BEFORE = WINDOW - SPAN

SEED = "hash long, key long, doc_id long, place int, around binary"


def masked(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all places and masks, and the places."""
    n = len(words.hashes)
    count = np.maximum(np.diff(words.first) - SPAN + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    places = words.first[owner] + np.arange(len(owner)) - np.concatenate(([0], np.cumsum(count)))[owner]
    padded = np.concatenate((words.hashes, np.zeros(SPAN, np.uint64)))
    out = []
    for number, mask in enumerate(MASKS):
        total = np.full(n, number + 1, np.uint64)
        for i, at in enumerate(mask):
            total += padded[at : at + n] * np.uint64((2 * i + 3) * 0x9E3779B97F4A7C15 % 2**64 | 1)
        out.append(mix(total[places]))
    return np.concatenate(out), np.tile(places, len(MASKS))


def _around(words: Words, places: np.ndarray, filler: int) -> np.ndarray:
    """The words about each place, with a filler beyond the text's ends."""
    owner = np.searchsorted(words.first, places, "right") - 1
    low, high = words.first[owner], words.first[owner + 1]
    at = places[:, None] - _BEFORE + np.arange(_AROUND)
    inside = (at >= low[:, None]) & (at < high[:, None])
    found = words.hashes[np.clip(at, 0, max(len(words.hashes) - 1, 0))]
    return np.where(inside, found, np.uint64(filler))


def _binary(table: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(table, "<u8")
    offsets = np.arange(len(data) + 1, dtype=np.int32) * (8 * data.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def _seeds(rows_: DataFrame, key: str, filler: int, bitmap=None) -> DataFrame:
    """Places of the texts with their hashes; with a bitmap, those it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in rows(batch, "text", 1 << 20):
                words = words_of(texts, MARKS, LOWER)
                hashes, places = masked(words)
                if bitmap is not None:
                    keep = may_contain(bitmap.value, hashes)
                    hashes, places = hashes[keep], places[keep]
                owner = np.searchsorted(words.first, places, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes.view(np.int64)),
                        part.column("key").take(pa.array(owner)),
                        part.column("doc_id").take(pa.array(owner)),
                        pa.array((places - words.first[owner]).astype(np.int32)),
                        _binary(_around(words, places, filler)),
                        pa.array(np.diff(words.first)[owner].astype(np.int32)),
                    ],
                    ["hash", "key", "doc_id", "place", "around", "n_words"],
                )

    texts = rows_.select(F.expr(key).alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, f"{SEED}, n_words int")


def _agreeing(docs: np.ndarray, items: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per hit the most words of a window that agree, and the window's start
    relative to the hit. A short item's window is the item itself."""
    same = docs == items
    sums = np.concatenate((np.zeros((len(same), 1), np.int64), np.cumsum(same, axis=1)), axis=1)
    windows = sums[:, WINDOW:] - sums[:, :-WINDOW]
    best = windows.argmax(axis=1)
    most = windows[np.arange(len(windows)), best]
    whole = np.minimum(n_words, WINDOW)
    need = np.where(n_words < WINDOW, whole, WINDOW - SUBSTITUTED)
    return np.where(most >= need, most, 0), best - _BEFORE


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Where documents hold benchmark items: ``key, doc_id, item_id, offset``
    (of the item's first word in the document; may lie before it),
    ``first_word``, ``last_word`` (of the agreeing windows) and ``agreeing``,
    the most words of a window that agree. A row per document, item and offset.

    ``key`` is a hash of the text, so a null or repeated ``doc_id`` does not
    mix documents up. Null and empty texts hold nothing; repeated rows are
    found each; an empty table on either side gives no row.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "benchmark")
    numbered = benchmark.select(F.col("item_id").cast("long").alias("doc_id"), "text")
    items = written(_seeds(numbered, "0L", 1).where(f"n_words >= {LEAST_WORDS}"), folder, "items")
    bitmap = spark.sparkContext.broadcast(bitmap_of(items.select("hash")))
    found = _seeds(docs.withColumn("text", F.col("text").cast("string")), "xxhash64(text)", 2, bitmap).drop("n_words")
    sides = items.selectExpr("hash", "doc_id as item_id", "place as item_place", "around as item_around", "n_words")
    sides = F.broadcast(sides) if items.count() <= BROADCAST_ROWS else sides

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(column: pa.Array) -> np.ndarray:
            joined = b"".join(x.as_buffer().to_pybytes() for x in column)
            return np.frombuffer(joined, "<u8").reshape(-1, _AROUND)

        for batch in batches:
            if not batch.num_rows:
                continue
            most, start = _agreeing(table(batch.column("around")), table(batch.column("item_around")), np.asarray(batch.column("n_words")))
            place = np.asarray(batch.column("place"))
            columns = [batch.column("key"), batch.column("doc_id"), batch.column("item_id")]
            columns += [pa.array((place - np.asarray(batch.column("item_place"))).astype(np.int32))]
            columns += [pa.array((place + start).astype(np.int32)), pa.array(most.astype(np.int32))]
            hits = pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "item_id", "offset", "first", "agreeing"])
            yield hits.filter(pa.array(most > 0))

    # Written in between, so that no task holds two Python workers.
    joined = written(found.join(sides, "hash"), folder, "joined")
    hits = joined.mapInArrow(run, "key long, doc_id long, item_id long, offset int, first int, agreeing int")
    return hits.groupBy("key", "doc_id", "item_id", "offset").agg(
        F.greatest(F.min("first"), F.lit(0)).alias("first_word"),
        (F.max("first") + (WINDOW - 1)).alias("last_word"),
        F.max("agreeing").alias("agreeing"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns.
    Null and empty texts hold none and stay, rows that repeat stay as often. Names
    starting with ``__`` are refused."""
    _, columns = carried(docs)
    folder = new_folder(docs.sparkSession, "benchmark")
    bad = written(contaminated(docs, benchmark).select(F.col("key").alias("__text_key")).distinct(), folder, "bad")
    keyed = docs.withColumn("__text_key", F.xxhash64(F.col("text").cast("string")))
    return without(keyed, bad, ["__text_key"]).select(*columns)
