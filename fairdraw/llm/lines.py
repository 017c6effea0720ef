"""Repeated lines, equal or one edit apart, by a deletion-neighbourhood join.

Lines are compared as they stand. Equal lines are one line with a first place in
the corpus, by ``doc_id`` and line number. A line of at least ``SHORT``
characters also repeats an earlier line that one inserted, deleted or replaced
character makes equal (``EDITS`` = 1, the edit bound); shorter lines must be equal.

Which lines can have a partner is found first: of two lines one edit apart, either
the first half or the rest is the same in both, so each line emits the hashes of
these parts, for its own length and for the next shorter one. Only lines that
share a part with another emit their deletion neighbourhood: the hash of the
line and the hashes of all variants with one character left out, each with the
place of the gap. Two lines that share a variant with the same gap differ by a
replacement there; a line equal to another's variant by an insertion. So the
earliest line of a group of variants stands for all others in it, no pairs within
a group are needed, and the pairs that come out are verified on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.bitmap import bitmap_of, may_contain
from fairdraw.llm.carried import carried
from fairdraw.llm.storage import new_folder, written
from fairdraw.llm.text import mix

EDITS, SHORT = 1, 8
_LAST = f"{2**63 - 1}L"
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PARTS = ("p0", "p1", "p2", "p3")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def parts_of(line: str) -> list[int]:
    """Hashes of the halves that a partner must share, for both lengths."""
    out, n = [], len(line)
    for length in (n, n - 1):
        half = length // 2
        for kind, part in ((0, line[:half]), (1, line[n - (length - half) :])):
            out.append(xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass"), seed=2 * length + kind))
    return out


def variants_of(line: str) -> np.ndarray:
    """Hashes of the line and of the line without each of its characters, in
    time linear in its length."""
    letters = mix(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(_BASE))
    powers = np.full(len(letters), _BASE, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters * powers, dtype=np.uint64)))
    without = sums[:-1] + (sums[-1] - sums[1:]) * np.uint64(_INVERSE)
    sizes = np.full(len(without) + 1, len(letters) - 1, np.uint64)
    sizes[0] += np.uint64(1)
    return mix(np.concatenate((sums[-1:], without)) + sizes * np.uint64(0x2545F4914F6CDD1D))


def within_one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > EDITS:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    if len(a) == len(b):
        return a[same + 1 :] == b[same + 1 :]
    return a[same + 1 :] == b[same:] if len(a) > len(b) else a[same:] == b[same + 1 :]


def _occurrences(docs: DataFrame) -> DataFrame:
    """All lines but blank ones: their place, their hash, and, if they are long
    enough to have a partner, the hashes of their parts."""
    kind = f"doc_id long, text_key long, line_no int, hash long, {', '.join(f'{p} long' for p in _PARTS)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, numbers, hashes, parts, has = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for number, line in enumerate((text or "").split("\n")):
                    if line.strip():
                        owner.append(i)
                        numbers.append(number)
                        hashes.append(_hash(line))
                        has.append(len(line) >= SHORT - EDITS)
                        parts.append(parts_of(line) if has[-1] else (0, 0, 0, 0))
            table = np.array(parts, np.uint64).reshape(-1, 4).view(np.int64)
            missing = ~np.array(has, bool)
            at = pa.array(owner, pa.int64())
            columns = [batch.column("doc_id").take(at), batch.column("text_key").take(at), pa.array(numbers, pa.int32()), _signed(hashes)]
            columns += [pa.array(np.ascontiguousarray(table[:, j]), mask=missing) for j in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "line_no", "hash", *_PARTS])

    return docs.mapInArrow(run, kind)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``hash, line`` of the wanted lines."""
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted.select("hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, str] = {}
            for text in batch.column("text").to_pylist():
                lines = [line for line in (text or "").split("\n") if len(line) >= SHORT - EDITS]
                hashes = [_hash(line) for line in lines]
                keep = may_contain(bitmap.value, np.array(hashes, np.uint64))
                found.update((h, line) for h, line, k in zip(hashes, lines, keep.tolist(), strict=True) if k)
            yield pa.RecordBatch.from_arrays([_signed(list(found)), pa.array(list(found.values()), pa.string())], ["hash", "line"])

    lines = docs.select("text").mapInArrow(run, "hash long, line string")
    # Equal lines of different batches meet here, hot ones after a first pass in each task.
    return lines.join(wanted.select("hash"), "hash", "left_semi").dropDuplicates(["hash"])


def _neighbourhood(lines: DataFrame) -> DataFrame:
    """``key, gap, hash``: the line itself with gap -1, and its variants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line, own in zip(batch.column("line").to_pylist(), batch.column("hash").to_pylist(), strict=True):
                keys = variants_of(line)
                gaps = np.arange(-1, len(keys) - 1, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(gaps), pa.array(np.full(len(keys), own, np.int64))], ["key", "gap", "hash"]
                )

    return lines.mapInArrow(run, "key long, gap int, hash long")


def _near(lines: DataFrame, firsts: DataFrame, folder: str) -> DataFrame:
    """Hashes of the lines that repeat an earlier line by one edit."""
    emitted = written(_neighbourhood(lines), folder, "variants")
    shared = emitted.groupBy("key").agg(F.min("hash").alias("x"), F.max("hash").alias("y")).where("x <> y").select("key")
    members = emitted.join(shared, "key").join(firsts.select("hash", "first"), "hash").distinct()
    members = written(members, folder, "members")
    earliest = F.min(F.struct("first", "hash")).alias("earliest")
    replaced = members.where("gap >= 0").groupBy("key", "gap").agg(earliest)
    whole = members.where("gap = -1").selectExpr("key", "struct(first, hash) as earliest")
    shorter = members.where("gap >= 0").groupBy("key").agg(earliest)
    pairs = (
        members.join(replaced, ["key", "gap"])
        .select("hash", "first", "earliest")
        .unionByName(members.where("gap >= 0").join(whole, "key").select("hash", "first", "earliest"))
        .unionByName(members.where("gap = -1").join(shorter, "key").select("hash", "first", "earliest"))
        .where("earliest.first < first")
        .selectExpr("hash", "earliest.hash as other")
        .distinct()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("line").to_pylist(), batch.column("other_line").to_pylist(), strict=True)
            yield batch.select(["hash"]).filter(pa.array([len(a) >= SHORT and within_one_edit(a, b) for a, b in both], pa.bool_()))

    compared = pairs.join(lines, "hash").join(lines.selectExpr("hash as other", "line as other_line"), "other")
    return written(compared.select("hash", "line", "other_line").mapInArrow(run, "hash long").distinct(), folder, "near")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with ``text`` without repeated lines,
    and ``n_lines`` and ``n_kept`` (blank lines count in both).

    A line is dropped if the corpus has an earlier one that equals it or, from
    ``SHORT`` characters on, is one edit away, however long that one is and
    whether or not it is dropped itself. Earlier is the smaller ``doc_id``, null last, then a hash of
    the text, then the line number. Blank lines always stay. A null text stays
    null, an empty one empty, both with ``n_lines`` 0. Rows that repeat both
    ``doc_id`` and text keep the same lines. An empty table gives no row.
    Columns named ``n_lines`` or ``n_kept`` are replaced; names starting with
    ``__`` are reserved.
    """
    folder = new_folder(docs.sparkSession, "lines")
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    narrow = narrow.withColumn("text_key", F.xxhash64("text"))
    places = written(_occurrences(narrow), folder, "places")
    rank = F.expr(f"struct(coalesce(doc_id, {_LAST}) as doc, text_key, line_no)")
    firsts = places.groupBy("hash").agg(F.min(rank).alias("first"), *[F.first(p).alias(p) for p in _PARTS])
    firsts = written(firsts, folder, "firsts")

    parted = firsts.where("p0 is not null").select("hash", F.explode(F.array_distinct(F.array(*_PARTS))).alias("part"))
    shared = parted.groupBy("part").agg(F.min("hash").alias("x"), F.max("hash").alias("y")).where("x <> y").select("part")
    wanted = written(parted.join(shared, "part").select("hash").distinct(), folder, "wanted")
    lines = written(_texts(narrow, wanted), folder, "lines")
    near = _near(lines, firsts, folder)

    kept = firsts.select("hash", "first").join(near, "hash", "left_anti")
    kept = kept.groupBy("first.doc", "first.text_key").agg(F.collect_list("first.line_no").alias("__kept"))
    kept = kept.withColumnsRenamed({"doc": "__doc", "text_key": "__key"})
    rest, columns = carried(docs, ("n_lines", "n_kept"))
    keyed = docs.select(*columns).withColumn("__text_key", F.xxhash64(F.col("text").cast("string")))
    same = F.expr(f"coalesce(cast(doc_id as long), {_LAST}) = __doc and __text_key = __key")
    # Functions over Arrow batches need plain names.
    plain = [c.alias(f"c{i}") for i, c in enumerate(columns)]
    schema = docs.select(*plain, F.lit(0).alias("n_lines"), F.lit(0).alias("n_kept")).schema
    at = [c.lower() for c in rest].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, after = [], [], []
            for text, numbers in zip(batch.column(at).to_pylist(), batch.column("__kept").to_pylist(), strict=True):
                numbers, lines = set(numbers or ()), text.split("\n") if text else []
                left = [line for i, line in enumerate(lines) if i in numbers or not line.strip()]
                texts.append("\n".join(left) if text is not None else None)
                before.append(len(lines))
                after.append(len(left))
            given = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays([*given, pa.array(before, pa.int32()), pa.array(after, pa.int32())], schema.names)

    return keyed.join(kept, same, "left").select(*plain, "__kept").mapInArrow(run, schema).toDF(*rest, "n_lines", "n_kept")
