"""Document quality by a generalised additive model with pairwise interactions.

The text alone gives some measures. Each measure is cut into bins; boosting
goes round the measures in a cycle, adding a shallow tree over the bins of one
at a time, so the model is a lookup table per measure. The pairs of measures
that explain most of what is left get a table each in the same way. A score is
the sigmoid of a sum of looked-up numbers, added for all rows of a batch at once.

Null and empty texts have measures like any other text (all counts zero).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.storage import BATCH_ROWS, new_folder, written
from fairdraw.llm.text import Texts, rows, shingles_of, words_of

#: Labelled rows the model is fitted on at most: the first by a hash of their id.
FIT_ROWS = 60_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 120, 60, 0.15, 1.0

BATCH = 512

MEASURES = (
    "words", "bytes", "word_length", "upper", "marks", "digits", "non_ascii", "distinct_words",
    "top_word", "repeated_word", "distinct_phrases", "lines", "distinct_lines", "ends_in_mark",
)

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_WIDE = _BYTE >= 128
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122))
_MARKS = (_BYTE > 32) & (_BYTE < 127) & ~_LETTER & ~_DIGIT
_STOP = np.isin(_BYTE, [33, 46, 63])
_NEWLINE = _BYTE == 10


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)


def _runs(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of distinct hashes and the largest count of one."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    distinct = np.bincount(o[at], minlength=n).astype(float)
    most = np.zeros(n)
    np.maximum.at(most, o[at], np.diff(np.append(at, len(h))))
    return distinct, most


def measure(texts: Texts) -> np.ndarray:
    """A row of ``MEASURES`` per text."""
    data, offsets = texts.data, texts.offsets
    words, lines = words_of(texts), words_of(texts, _NEWLINE)
    n_bytes = np.diff(offsets).astype(float)
    n_words, n_lines = np.diff(words.first).astype(float), np.diff(lines.first).astype(float)
    distinct, most = _runs(words.hashes, words.first)
    again = np.zeros(len(words.hashes), bool)
    again[1:] = words.hashes[1:] == words.hashes[:-1]
    again[words.first[:-1][n_words > 0]] = False
    phrases, phrase_first = shingles_of(words, 3)
    different_phrases, _ = _runs(phrases, phrase_first)
    different_lines, _ = _runs(lines.hashes, lines.first)
    size, count = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    ended = _STOP[data[lines.end - 1]] if len(lines.end) else np.empty(0, bool)
    columns = [
        np.log1p(n_words),
        np.log1p(n_bytes),
        _per_text(words.end - words.start, words.first) / count,
        _per_text(_UPPER[data], offsets) / size,
        _per_text(_MARKS[data], offsets) / size,
        _per_text(_DIGIT[data], offsets) / size,
        _per_text(_WIDE[data], offsets) / size,
        distinct / count,
        most / count,
        _per_text(again, words.first) / count,
        different_phrases / np.maximum(np.diff(phrase_first), 1),
        np.log1p(n_lines),
        different_lines / np.maximum(n_lines, 1),
        _per_text(ended, lines.first) / np.maximum(n_lines, 1),
    ]
    return np.column_stack(columns).astype(np.float32)


@dataclass
class Model:
    """Cut points, a table per measure, and per pair coarser cuts and a table."""

    base: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, measures: np.ndarray) -> np.ndarray:
        total = np.full(len(measures), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, measures[:, j])]
        for i, j, cuts_i, cuts_j, table in self.pairs:
            total += table[np.searchsorted(cuts_i, measures[:, i]), np.searchsorted(cuts_j, measures[:, j])]
        return 1 / (1 + np.exp(-total))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    inner = np.unique(np.quantile(values, np.arange(1, bins) / bins))
    return inner[inner < values.max()] if len(values) else inner


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _split(g: np.ndarray, h: np.ndarray) -> int:
    """The best place to cut a run of bins in two; 0 if none helps."""
    if len(g) < 2:
        return 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    best = int(np.argmax(gains))
    return best + 1 if gains[best] > 1e-9 else 0


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values, by bin, of a tree of some depth over a run of bins."""
    at = _split(g, h) if depth else 0
    if not at:
        return np.full(len(g), RATE * g.sum() / (h.sum() + RIDGE))
    return np.concatenate((_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)))


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The tree over two measures that cuts each once: its gain and its values."""
    corner_g, corner_h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))

    def parts(c: np.ndarray) -> list[np.ndarray]:
        a, top, left = c[1:-1, 1:-1], c[1:-1, -1:], c[-1:, 1:-1]
        return [a, top - a, left - a, c[-1, -1] - top - left + a]

    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    all_g, all_h = parts(corner_g), parts(corner_h)
    gains = sum(_gain(x, y) for x, y in zip(all_g, all_h, strict=True))
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = [RATE * x[i, j] / (y[i, j] + RIDGE) for x, y in zip(all_g, all_h, strict=True)]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gains[i, j]), out


def fit(measures: np.ndarray, labels: np.ndarray) -> Model:
    """Boost the tables on labelled rows. Without rows of both labels the model
    is a constant."""
    model, y = Model(), labels.astype(float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    model.base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return model
    model.cuts = [_cuts(measures[:, j], BINS) for j in range(measures.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, measures[:, j]) for j, c in enumerate(model.cuts)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for table, where in zip(model.tables, bins, strict=True):
            g, h = (np.bincount(where, weights=w, minlength=len(table)) for w in slopes())
            step = _tree(g, h)
            table += step
            total += step[where]

    coarse = [_cuts(measures[:, j], PAIR_BINS) for j in range(measures.shape[1])]
    cells = [np.searchsorted(c, measures[:, j]) for j, c in enumerate(coarse)]

    def grids(i: int, j: int) -> list[np.ndarray]:
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        where = cells[i] * shape[1] + cells[j]
        return [np.bincount(where, weights=w, minlength=shape[0] * shape[1]).reshape(shape) for w in slopes()]

    ranked = sorted(combinations(range(measures.shape[1]), 2), key=lambda p: -_quadrants(*grids(*p))[0])
    model.pairs = [(i, j, coarse[i], coarse[j], np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1))) for i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, _, _, table in model.pairs:
            _, step = _quadrants(*grids(i, j))
            table += step
            total += step[cells[i], cells[j]]
    return model


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, measures`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in rows(batch, "text", 1 << 20):
                values = measure(texts)
                offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1])
                column = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), column], ["doc_id", "measures"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, measures array<float>"
    )


def remainder(modulus: int) -> str:
    """SQL text: the fold of a document, by its id."""
    return f"coalesce(crc32(cast(doc_id as string)) % {modulus}, -1)"


def fitted(features: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model of at most ``fit_rows`` labelled rows outside the held-out fold.
    Rows without label or id are not learned from; a repeated row counts again."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label"))
    known = known.where(f"label in (0, 1) and doc_id is not null and {remainder(3)} <> 1")
    taken = features.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    found = taken.select("measures", "label").toArrow()
    values = found.column("measures").combine_chunks()
    table = np.asarray(values.flatten(), np.float32).reshape(-1, len(MEASURES))
    return fit(table, np.asarray(found.column("label")))


def scored(features: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of measured rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.asarray(batch.column("measures").flatten(), np.float32).reshape(-1, len(MEASURES))
            scores = pa.array(model.score(table))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    rated = features.mapInArrow(run, "doc_id long, score double")
    return rated.select(
        "doc_id", F.expr(f"{remainder(3)} = 1").alias("held_out"), "score", F.expr("if(score >= 0.5, 1, 0)").alias("predicted")
    )


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Every whole text is measured once. Null and empty texts get a score like
    any other; a null ``doc_id`` stays null and is not held out; rows that
    repeat are scored each. Without usable labels all scores are 0.5. An empty
    table gives no row. Only ``doc_id`` and ``text`` are read of ``docs``.
    """
    features = written(measured(docs), new_folder(docs.sparkSession, "quality"), "measured")
    return scored(features, fitted(features, labels, fit_rows))


def accepted(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that the model predicts to be of good quality, with
    all their columns. Null and empty texts are scored like any other, rows that
    repeat stay or go together. Whole rows are not shuffled: the text is measured again.

    That happens when the result is read, so the session's batches for Python
    are set to ``BATCH`` rows and stay so: whole rows are long."""
    features = written(measured(docs), new_folder(docs.sparkSession, "quality"), "measured")
    model = fitted(features, labels, fit_rows)
    # Functions over Arrow batches need plain names.
    plain = [f"c{i}" for i in range(len(docs.columns))]
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in rows(batch, plain[at], 1 << 20):
                yield part.filter(pa.array(model.score(measure(texts)) >= 0.5))

    docs.sparkSession.conf.set(BATCH_ROWS, str(BATCH))
    return docs.toDF(*plain).mapInArrow(run, docs.toDF(*plain).schema).toDF(*docs.columns)
