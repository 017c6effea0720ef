"""Toxic passages as maximum-scoring segments, and a score per document.

Words, and beginnings of words for the sake of inflected forms, get log-odds of
toxic against other labelled documents, by the number of documents that hold
them, with a Dirichlet prior in proportion to the classes. One counts as evidence where the lower bound of its log-odds is positive; in
a second count, a toxic document credits only those of its words that are about
as telling as its most telling one, so words that merely accompany an insult
lose their standing. A word scores as much as the best evidence in it; any other
word costs ``PENALTY``.

A linear scan finds all maximal segments of a text: runs of words whose score
cannot be raised by a longer or shorter run. By the extreme-value distribution
of the best segment of random texts, a score S among n words has the reduced
value ``rate * S - log(n)``, from which a segment's expected number of equals
follows. The rate is that of the words of the other labelled documents, each
occurrence counted. A document's best reduced value is turned into a score by a logistic
curve fitted on the labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.storage import new_folder, written
from fairdraw.llm.text import LOWER, MARKS, Texts, Words, heads_of, mix, rows, words_of

#: Labelled rows the model is fitted on at most: the first by a hash of their
#: id. Their words bound the table of evidence, too.
FIT_ROWS = 60_000
PRIOR, DEVIATIONS, PENALTY = 2.0, 2.0, 0.5
# A document credits words of this share of its best word's standing.
CREDIT = 0.5
# Bytes of the beginnings that count besides whole words.
HEADS = (4, 5)
#: Segments of which random texts of that length hold more are not significant.
EXPECTED = 0.05

SEGMENTS = "array<struct<first_word: int, last_word: int, score: double, expected: double>>"


@dataclass
class Evidence:
    """Sorted word hashes and their scores; ``rate`` is that of the extreme values."""

    words: np.ndarray
    scores: np.ndarray
    rate: float = 1.0

    def of(self, hashes: np.ndarray, default: float) -> np.ndarray:
        if not len(self.words):
            return np.full(len(hashes), default)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.scores[at], default)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as first and last place and score, in time
    linear in the scores; only positive ones start or extend a segment."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[tuple[int, int, float, float]] = []
    for place in np.flatnonzero(scores > 0).tolist():
        first, last, left, right = place, place, total[place], total[place + 1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                found.append((first, last, left, right))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(first, last, float(right - left)) for first, last, left, right in found]


def _tokens(texts: Texts) -> tuple[Words, list[np.ndarray]]:
    """The words, and for each its own hash and those of its beginnings."""
    words = words_of(texts, MARKS, LOWER)
    heads = [mix(heads_of(texts, words, size) + np.uint64(size)) for size in HEADS]
    return words, [words.hashes, *heads]


def _distinct(words: Words, kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and beginnings of each text: owner and hash."""
    owner = np.tile(np.repeat(np.arange(len(words.first) - 1), np.diff(words.first)), len(kinds))
    hashes = np.concatenate(kinds)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def _counted(train: DataFrame, standing: Evidence | None = None) -> DataFrame:
    """``word, toxic, other``: labelled documents that hold a word. With a
    standing, toxic documents count for the words they credit, and others for
    the words of the standing only."""
    shared = None if standing is None else train.sparkSession.sparkContext.broadcast(standing)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in rows(batch, "text"):
                toxic = np.asarray(part.column("label")) == 1
                owner, hashes = _distinct(*_tokens(texts))
                if shared is not None:
                    level = shared.value.of(hashes, -1.0)
                    best = np.full(len(texts), -1.0)
                    np.maximum.at(best, owner, level)
                    keep = (level > 0) & (~toxic[owner] | (level >= CREDIT * best[owner]))
                    owner, hashes = owner[keep], hashes[keep]
                words, which = np.unique(hashes, return_inverse=True)
                counts = [np.bincount(which, weights=flag[owner], minlength=len(words)).astype(np.int64) for flag in (toxic, ~toxic)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), *map(pa.array, counts)], ["word", "toxic", "other"]
                )

    counts = train.select("text", "label").mapInArrow(run, "word long, toxic long, other long")
    return counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _log_odds(counts: DataFrame, share: float) -> DataFrame:
    """Adds ``odds`` and their ``deviation``; 0 odds for a word never seen."""
    a, b = PRIOR * share, PRIOR * (1 - share)
    return counts.withColumns(
        {
            "odds": F.expr(f"ln((toxic + {a}) / (other + {b})) - ln({share} / {1 - share})"),
            "deviation": F.expr(f"sqrt(1 / (toxic + {a}) + 1 / (other + {b}))"),
        }
    )


def _evidence(found: DataFrame, value: str) -> Evidence:
    """The positive words, by their number in the labelled rows bounded, with a
    value each."""
    table = found.where(f"toxic >= 2 and {value} > 0").selectExpr("word", f"{value} as value").toArrow()
    words = np.asarray(table.column("word")).view(np.uint64)
    order = np.argsort(words)
    return Evidence(words[order], np.asarray(table.column("value"))[order])


def _occurrences(train: DataFrame, evidence: Evidence) -> tuple[np.ndarray, int]:
    """How many words of the other labelled documents have their score from each
    piece of evidence, and how many words these documents have."""
    shared = train.sparkSession.sparkContext.broadcast(evidence)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total, counts = 0, np.zeros(len(known.words), np.int64)
        for batch in batches:
            for _, texts in rows(batch, "text"):
                words, kinds = _tokens(texts)
                total += len(words.hashes)
                levels, hashes = np.stack([known.of(h, -PENALTY) for h in kinds]), np.stack(kinds)
                best = np.argmax(levels, axis=0)[None]
                hot = np.take_along_axis(levels, best, 0)[0] > 0
                counts += np.bincount(np.searchsorted(known.words, np.take_along_axis(hashes, best, 0)[0, hot]), minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], total))], ["at", "n"])

    table = train.where("label = 0").select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    at, n = np.asarray(table.column("at"), np.int64), np.asarray(table.column("n"), np.int64)
    counts = np.zeros(len(evidence.words), np.int64)
    counts[at[at >= 0]] = n[at >= 0]
    return counts, int(n[at < 0].sum())


def _rate(scores: np.ndarray, counts: np.ndarray, total: float) -> float:
    """The rate of the extreme-value distribution: the positive solution of
    ``mean(exp(rate * score)) = 1`` over the ``total`` words of other documents,
    ``counts`` of them with each score. Every score counts once more than seen."""
    weights = (counts + 1.0) / (total + len(counts) + 1.0)
    rest = max(1 - weights.sum(), 1e-9)
    low, high = 1e-3, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        mean = rest * np.exp(-PENALTY * middle) + float((weights * np.exp(np.minimum(middle * scores, 500))).sum())
        low, high = (low, middle) if mean > 1 else (middle, high)
    return low


def fold(labels: DataFrame, fit_rows: int) -> DataFrame:
    """``doc_id, label`` of the rows to learn from, ``fit_rows`` at most."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("label"))
    known = known.where("label in (0, 1) and doc_id is not null and crc32(cast(doc_id as string)) % 5 <> 0")
    return known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)


def learn(docs: DataFrame, taken: DataFrame) -> Evidence:
    """Words that are evidence of toxicity, from the labelled documents."""
    train = docs.join(F.broadcast(taken), "doc_id").select("text", "label")
    classes = {r["label"]: r["n"] for r in taken.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = classes.get(1, 0), classes.get(0, 0)
    if not toxic or not other:
        return Evidence(np.empty(0, np.uint64), np.empty(0))
    share = toxic / (toxic + other)
    bound = f"odds - {DEVIATIONS} * deviation"
    standing = _evidence(_log_odds(_counted(train), share).where(f"{bound} > 0"), "odds / deviation")
    evidence = _evidence(_log_odds(_counted(train, standing), share), f"{bound} - {PENALTY}")
    evidence.rate = _rate(evidence.scores, *_occurrences(train, evidence))
    return evidence


def scan(docs: DataFrame, evidence: Evidence) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, the best segment's reduced value (null
    without a segment) and the significant segments."""
    shared = docs.sparkSession.sparkContext.broadcast(evidence)
    kind = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part, texts in rows(batch, "text"):
                words, kinds = _tokens(texts)
                scores = np.max([known.of(hashes, -PENALTY) for hashes in kinds], axis=0)
                n = np.diff(words.first)
                hot = np.searchsorted(words.first, np.flatnonzero(scores > 0), "right") - 1
                values: list[float | None] = [None] * len(n)
                kept: list[list] = [[] for _ in n]
                for i in np.unique(hot).tolist():
                    offset = float(np.log(n[i]))
                    found = segments(scores[words.first[i] : words.first[i + 1]])
                    values[i] = max(known.rate * s for _, _, s in found) - offset
                    rated = [(a, b, s, float(np.exp(min(offset - known.rate * s, 50.0)))) for a, b, s in found]
                    kept[i] = [dict(zip(("first_word", "last_word", "score", "expected"), x, strict=True)) for x in rated if x[3] <= EXPECTED]
                columns = [part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(values, pa.float64()), pa.array(kept, kind)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "value", "passages"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(run, f"doc_id long, n_words long, value double, passages {SEGMENTS}")


def _curve(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a little
    shrinkage of the slope."""
    slope, intercept = 0.0, 0.0
    x = np.column_stack((values, np.ones(len(values))))
    ridge = np.diag([1e-2, 1e-6])
    for _ in range(50):
        w = np.array([slope, intercept])
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ w)
        slope, intercept = slope + step[0], intercept + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(slope), float(intercept)


def score_documents(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``, and its
    ``n_passages`` and the ``passages`` that are significant.

    Null and empty texts, like all texts without a segment, get the share of
    toxic ones among the labelled documents without a segment. A null
    ``doc_id`` stays null and is not held out; rows that repeat are scored
    each. Without usable labels of both kinds all scores are 0.5 at most. An
    empty table gives no row. Only ``doc_id`` and ``text`` are read of ``docs``.
    """
    folder = new_folder(docs.sparkSession, "toxicity")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    taken = written(fold(labels, fit_rows), folder, "taken")
    scanned = written(scan(docs, learn(docs, taken)), folder, "scanned")
    table = scanned.select("doc_id", "value").join(F.broadcast(taken), "doc_id").select("value", "label").toArrow()
    values, known = np.asarray(table.column("value"), float), np.asarray(table.column("label"), float)
    bare = np.isnan(values)
    nothing = min(float((known[bare].sum() + 0.5) / (bare.sum() + 1)), 0.5 if bare.sum() else 0.0)
    slope, intercept = _curve(values[~bare], known[~bare]) if (~bare).any() else (0.0, 0.0)
    return scanned.select(
        "doc_id",
        F.expr("coalesce(crc32(cast(doc_id as string)) % 5, -1) = 0").alias("held_out"),
        F.expr(f"if(value is null, {nothing}D, 1 / (1 + exp(-({slope}D * value + {intercept}D))))").alias("score"),
        F.size("passages").alias("n_passages"),
        "passages",
    ).withColumn("predicted", F.expr("if(score >= 0.5, 1, 0)"))
