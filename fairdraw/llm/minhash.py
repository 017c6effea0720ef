"""Near-duplicate documents by circulant MinHash.

A document's set are its distinct shingles. Two permutations make the whole
signature: the first scatters the shingles over a universe of 2^32 places, the
second, shifted circularly by 0, 1, 2, ... places, gives one coordinate each,
the least value of the set. Documents that share a band of coordinates are
candidates; a link is confirmed on the full sets of 64-bit shingle hashes.

With ``BANDS`` bands of ``ROWS`` coordinates a pair at the threshold of 0.75 is
a candidate but for odds of (1 - 0.75^4)^32, about 5 in a million.

Equal sets are one node. Links are confirmed without emitting all pairs of a
group, in three steps:

1. Every member of a bucket against one member of it; the links make a first
   set of components. This settles most of a large group in one pass.
2. In buckets of at most ``COLD`` nodes: the pairs that are still in different
   components.
3. Larger buckets that are not one component yet: overlapping ones are put
   together, their nodes cut into chunks, and pairs of chunks compared as
   matrices inside a task. A task returns links that join components there, not
   pairs; chunks of one component are not compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.bitmap import without
from fairdraw.llm.carried import carried
from fairdraw.llm.components import components
from fairdraw.llm.storage import new_folder, written
from fairdraw.llm.text import Texts, mix, rows, shingles_of, texts_of, words_of

WORDS, BANDS, ROWS = 5, 32, 4
# Links hold at LINK[0] * intersection >= LINK[1] * union.
LINK = (100, 75)
# Most nodes of a bucket whose open pairs are listed, and of a chunk.
COLD, CHUNK = 64, 128
# Shingles that a comparison of chunks takes at a time.
_WIDTH = 16_384


def _place(hashes: np.ndarray) -> np.ndarray:
    """The first permutation: a shingle's place in the universe."""
    return (mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.uint32)


def _value(places: np.ndarray, shift: int) -> np.ndarray:
    """The second permutation of 32-bit numbers, shifted circularly."""
    x = places - np.uint32(shift)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def sets_of(texts: Texts, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, first = shingles_of(words_of(texts), k)
    return [np.unique(hashes[first[i] : first[i + 1]]) for i in range(len(texts))]


def signature(sets: list[np.ndarray], bands: int = BANDS, size: int = ROWS) -> np.ndarray:
    """The band keys of each set, a row of ``bands`` numbers; sets are not empty."""
    if not sets:
        return np.empty((0, bands), np.uint64)
    first = np.cumsum([0, *(len(s) for s in sets)])[:-1]
    places = _place(np.concatenate(sets))
    keys = np.empty((len(sets), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(sets), band + 1, np.uint64)
        for shift in range(band * size, (band + 1) * size):
            least = np.minimum.reduceat(_value(places, shift), first)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + least.astype(np.uint64))
        keys[:, band] = key
    return keys


def signatures(docs: DataFrame, k: int = WORDS, bands: int = BANDS, size: int = ROWS) -> DataFrame:
    """Per document: the size of its set, a 64-bit key of the set (its node),
    the band keys, and a key of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in rows(batch, "text", 1 << 20):
                sets = sets_of(texts, k)
                n = np.array([len(s) for s in sets], np.int64)
                full = [s for s in sets if len(s)]
                keys = signature(full, bands, size)
                nodes = np.array([mix(s).sum() for s in full], np.uint64)
                node = np.zeros(len(sets), np.uint64)
                node[n > 0] = mix(nodes + n[n > 0].astype(np.uint64))
                sizes = np.where(n > 0, bands, 0)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                columns = [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array(n),
                    pa.array(node.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel().view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n", "node", "bands"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n long, node long, bands array<long>")


def _linked(common: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    return LINK[0] * common >= LINK[1] * (n_a + n_b - common)


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The pairs of nodes that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [sets_of(texts_of(batch.column(c)), k) for c in ("text_a", "text_b")]
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*sides, strict=True)])
            n_a, n_b = (np.array([len(s) for s in side]) for side in sides)
            keep = pa.array(_linked(common, n_a, n_b).astype(bool))
            yield batch.select(["a", "b"]).filter(keep)

    sides = [texts.withColumnsRenamed({"node": c, "n": f"n_{c}", "text": f"text_{c}"}) for c in "ab"]
    # Sets whose sizes differ more cannot reach the threshold.
    near = f"{LINK[0]} * least(n_a, n_b) >= {LINK[1]} * greatest(n_a, n_b)"
    joined = pairs.join(sides[0], "a").join(sides[1], "b").where(near)
    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _chunk_links(side_a: list[tuple], side_b: list[tuple]) -> list[tuple[int, int]]:
    """Links between two chunks that join different components, as few as join
    them. An entry is a node, its component and its set."""
    sets = [e[2] for e in side_a + side_b]
    m, n = len(side_a), np.array([len(s) for s in sets])
    universe, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), n)
    seen_a = np.bincount(column[row < m], minlength=len(universe)) > 0
    seen_b = np.bincount(column[row >= m], minlength=len(universe)) > 0
    shared = seen_a & seen_b
    rank = np.cumsum(shared) - 1
    row, column = row[shared[column]], rank[column[shared[column]]]
    common = np.zeros((m, len(sets) - m), np.float64)
    for low in range(0, int(shared.sum()), _WIDTH):
        now = (column >= low) & (column < low + _WIDTH)
        table = np.zeros((len(sets), _WIDTH), np.float32)
        table[row[now], column[now] - low] = 1
        common += table[:m] @ table[m:].T
    linked = _linked(common, n[:m, None], n[None, m:])
    labels = np.array([e[1] for e in side_a + side_b])
    linked &= labels[:m, None] != labels[None, m:]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = root(int(labels[i])), root(int(labels[m + j]))
        if x != y:
            parent[x] = y
            out.append((side_a[i][0], side_b[j][0]))
    return out


def _large_links(open_members: DataFrame, texts: DataFrame, folder: str, k: int) -> DataFrame:
    """Links between components inside the large buckets."""
    blobs = components(open_members.select("node", "center"), folder, "blobs")
    nodes = open_members.select("node", "label").distinct()
    nodes = nodes.join(blobs.withColumnRenamed("id", "node"), "node", "left").select(
        "node", "label", F.coalesce("component", "node").alias("blob")
    )
    sizes = nodes.groupBy("blob", "label").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.select("blob", "label", "size", F.expr(f"if(size >= {CHUNK}, label, null)").alias("whole"))
    parts = sizes.groupBy(F.col("blob").alias("of_blob"), F.col("whole").alias("of_whole")).agg(
        F.ceil(F.sum("size") / CHUNK).alias("parts")
    )
    plan = sizes.join(parts, F.expr("blob = of_blob and whole <=> of_whole")).select("blob", "label", "whole", "parts")
    chunked = written(
        nodes.join(plan, ["blob", "label"]).select(
            "blob", "whole", "node", "label", F.expr("xxhash64(blob, whole, pmod(xxhash64(node, 'chunk'), parts))").alias("chunk")
        ),
        folder,
        "chunks",
    )
    content = chunked.join(texts, "node").groupBy("chunk").agg(F.collect_list(F.struct("node", "label", "text")).alias("entries"))
    ids = chunked.select("blob", "whole", "chunk").distinct()
    sides = [ids.withColumnsRenamed({"whole": f"whole_{c}", "chunk": f"chunk_{c}"}) for c in "ab"]
    pairs = sides[0].join(sides[1], "blob").where("chunk_a <= chunk_b and not (whole_a is not null and whole_a <=> whole_b)")
    joined = pairs.join(content.withColumnsRenamed({"chunk": "chunk_a", "entries": "entries_a"}), "chunk_a").join(
        content.withColumnsRenamed({"chunk": "chunk_b", "entries": "entries_b"}), "chunk_b"
    )

    def entries(value: pa.ListScalar) -> list[tuple]:
        found = value.values
        node, label = found.field("node").to_pylist(), found.field("label").to_pylist()
        return list(zip(node, label, sets_of(texts_of(found.field("text")), k), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column("entries_a"), batch.column("entries_b"), strict=True):
                links = _chunk_links(entries(a), entries(b))
                yield pa.RecordBatch.from_pydict(
                    {"a": [x for x, _ in links], "b": [y for _, y in links]},
                    schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]),
                )

    links = joined.select("chunk_a", "chunk_b", "entries_a", "entries_b").repartition(F.col("chunk_a"), F.col("chunk_b"))
    return written(links.mapInArrow(run, "a long, b long"), folder, "large", rows=4)


def _grouped(docs: DataFrame, k: int) -> DataFrame:
    """Per row ``doc_id``, a key of its text, the size of its set, and a label
    that rows of one component share; null without words."""
    spark = docs.sparkSession
    folder = new_folder(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    signed = written(signatures(docs, k), folder, "signed")

    nodes = signed.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"),
        F.coalesce(F.min_by("text_key", "doc_id"), F.min("text_key")).alias("text_key"),
        F.first("n").alias("n"),
        F.first("bands").alias("bands"),
    )
    nodes = written(nodes, folder, "nodes")
    banded = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    buckets = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("center"))
    members = written(banded.join(buckets.where("size > 1"), "bucket"), folder, "members")

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "n", F.col("first_id"), F.col("text_key").alias("wanted_key")
    )
    is_its_text = F.expr("doc_id <=> first_id and text_key = wanted_key")
    texts = docs.join(wanted, is_its_text).select("node", "n", "text").dropDuplicates(["node"])
    texts = written(texts, folder, "texts")

    tested = members.where("node <> center").selectExpr("least(node, center) as a", "greatest(node, center) as b").distinct()
    tested = written(tested, folder, "tested")
    stars = written(_confirmed(tested, texts, k), folder, "stars", rows=256)
    settled = components(stars, folder, "settled")

    labelled = members.join(settled.withColumnRenamed("id", "node"), "node", "left").select(
        "bucket", "node", "n", "size", "center", F.coalesce("component", "node").alias("label")
    )
    labelled = written(labelled, folder, "labelled")
    is_open = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    still = written(labelled.join(is_open.select("bucket"), "bucket"), folder, "open")

    cold = still.where(f"size <= {COLD}").select("bucket", "node", "n", "label")
    sides = [cold.withColumnsRenamed({"node": c, "n": f"n_{c}", "label": f"label_{c}"}) for c in "ab"]
    near = f"{LINK[0]} * least(n_a, n_b) >= {LINK[1]} * greatest(n_a, n_b)"
    pairs = sides[0].join(sides[1], "bucket").where(f"a < b and label_a <> label_b and {near}").select("a", "b").distinct()
    pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), folder, "pairs")
    cold_links = written(_confirmed(pairs, texts, k), folder, "cold", rows=256)
    large_links = _large_links(still.where(f"size > {COLD}"), texts, folder, k)

    links = settled.selectExpr("id as a", "component as b").union(cold_links).union(large_links)
    joined = components(links, folder, "joined").withColumnRenamed("id", "node")
    placed = signed.select("doc_id", "text_key", "n", "node").join(joined, "node", "left").select(
        "doc_id", "text_key", "n", F.expr("if(n > 0, coalesce(component, node), null)").alias("label")
    )
    return written(placed, folder, "placed")


def near_duplicates(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * intersection >= 75 * union of their sets of
    ``k``-word shingles; ``component_id`` is the smallest ``doc_id`` reachable
    by links. A document with fewer words has its whole sequence as its one
    shingle; one with no word, empty or null, has none and is linked with
    nothing. Rows that repeat a ``doc_id`` are compared each with its own text.
    A null ``doc_id`` takes part but names no component: only a component
    without any other id has a null ``component_id``. An empty table gives no
    row. Only ``doc_id`` and ``text`` are read.
    """
    placed = _grouped(docs, k)
    smallest = placed.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    return placed.join(smallest, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.expr("if(label is null, doc_id, smallest)").alias("component_id"),
        F.expr("label is null or doc_id <=> smallest").alias("kept"),
    )


def deduplicated(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, with all columns of
    ``docs``: that with the smallest ``doc_id``, null last. Equal rows, and texts
    without words, are no reason to drop a row, except that a row whose
    ``doc_id`` and text both repeat stays once. Names starting with ``__`` are
    refused. Rows that stay are hardly moved.
    """
    _, columns = carried(docs)
    placed = _grouped(docs, k)
    rank = F.expr(f"struct(coalesce(doc_id, {2**63 - 1}L) as doc_id, text_key)")
    first = placed.where("label is not null").groupBy("label").agg(F.min(rank).alias("first"))
    worse = placed.join(first, "label").where(rank != F.col("first")).select("doc_id", "text_key")
    folder = new_folder(docs.sparkSession, "minhash")
    dropped = written(worse.distinct(), folder, "dropped")
    repeated = placed.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key")
    repeated = written(repeated, folder, "repeated")

    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__text_key": F.xxhash64(F.col("text").cast("string"))})
    names = {"doc_id": "__id", "text_key": "__text_key"}
    kept = without(keyed, dropped.withColumnsRenamed(names), list(names.values()))
    if repeated.isEmpty():
        return kept.select(*columns)
    keys = repeated.withColumnsRenamed(names)
    same = F.expr("a.__id <=> b.__id and a.__text_key = b.__text_key")
    once = kept.alias("a").join(keys.alias("b"), same, "left_semi")
    once = once.dropDuplicates(["__id", "__text_key"])
    return without(kept, keys, list(names.values())).unionByName(once).select(*columns)
