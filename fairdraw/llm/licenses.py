"""License texts in documents by diagonal voting, in DataFrame operations only.

Documents and templates are runs of words. Every pair of consecutive words is
hashed; a document's pairs are joined with the templates' pairs. A match of the
pair at place p with that at place q of a template votes for the diagonal p - q.
Votes are counted per document, template and diagonal. Neighbouring diagonals,
where a word was put in or left out, are merged, and a merged group is a span of
the license if enough of the template's pairs are there.

``PHRASES`` are found exactly: a phrase stands where its diagonal has the votes
of all its pairs. ``TEXTS`` are notices, headers and bodies of licenses, found by
the share of their pairs. A span is verified: its parts follow one another in the
template as in the document, no pair of the template counts twice, and most of
the span's own words belong to the template, too. Both tables have a fixed size
and are broadcast by their nature.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fairdraw.llm.license_texts import PHRASES, TEXTS
from fairdraw.llm.storage import new_folder, written

#: Pairs of a template that a span must hold, and words of a span that must be
#: those of the template, in hundredths; the most words that
#: may be put in or left out between two parts of a span.
SHARE, GAP = 70, 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Separators: all ASCII but digits and letters.
_WORDS = r"split(translate(coalesce(cast(text as string), ''), '{upper}', '{lower}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(
    upper=_UPPER, lower=_UPPER.lower()
)
_END = "xxhash64('the end of the document', -1)"


def templates(spark: SparkSession, texts: Mapping[str, str] = TEXTS) -> DataFrame:
    """``hash, template, label, exact, at, pairs``: a row per pair of words, and
    one that every document's end matches."""
    rows, named = [], [(p, label, True) for p, label in PHRASES.items()] + [(t, label, False) for t, label in texts.items()]
    for number, (phrase, label, exact) in enumerate(named):
        words = phrase.split()
        rows += [(a, b, number, label, exact, at, len(words) - 1) for at, (a, b) in enumerate(zip(words, words[1:], strict=False))]
    kind = "first string, second string, template int, label string, exact boolean, at int, pairs int"
    pairs = spark.createDataFrame(rows, kind).select(F.expr("xxhash64(first, second)").alias("hash"), "template", "label", "exact", "at", "pairs")
    end = spark.range(1).select(
        F.expr(_END).alias("hash"),
        F.lit(-1).alias("template"),
        F.lit(None).cast("string").alias("label"),
        F.lit(False).alias("exact"),
        F.lit(0).alias("at"),
        F.lit(0).alias("pairs"),
    )
    return pairs.unionByName(end)


def votes(docs: DataFrame, texts: Mapping[str, str] = TEXTS) -> DataFrame:
    """``doc_id, text_key, n_words, template, label, exact, pairs, at, place``: a
    row per matching pair, and a row with template -1 per document."""
    words = docs.select(
        F.col("doc_id").cast("long"),
        F.expr("xxhash64(cast(text as string))").alias("text_key"),
        F.expr(f"filter({_WORDS}, w -> w <> '')").alias("words"),
    )
    # The array of pairs ends with a mark that the end's row of the templates matches.
    paired = words.select(
        "doc_id",
        "text_key",
        F.size("words").cast("long").alias("n_words"),
        F.expr(
            f"concat(zip_with(words, slice(words, 2, greatest(size(words) - 1, 0)), (a, b) -> xxhash64(a, b)), array({_END}))"
        ).alias("pairs_of"),
    )
    places = paired.select("doc_id", "text_key", "n_words", F.posexplode("pairs_of").alias("place", "hash"))
    return places.join(F.broadcast(templates(docs.sparkSession, texts)), "hash").drop("hash")


def spans(found: DataFrame) -> DataFrame:
    """Places of licenses: ``doc_id, text_key, label, exact, first_word,
    last_word, share`` (of the template's pairs that are there)."""
    key = ["doc_id", "text_key", "n_words", "template", "label", "exact", "pairs"]
    diagonals = (
        found.where("template >= 0")
        .withColumn("diagonal", F.col("place") - F.col("at"))
        .groupBy(*key, "diagonal")
        # A template's places are few.
        .agg(
            F.collect_set("at").alias("places"),
            F.min("at").alias("low"),
            F.max("at").alias("high"),
        )
    )
    whole = diagonals.where("exact and size(places) = pairs").select(
        "doc_id", "text_key", "label", "exact",
        F.col("diagonal").cast("long").alias("first_word"),
        (F.col("diagonal") + F.col("pairs")).cast("long").alias("last_word"),
        F.lit(1.0).alias("share"),
    )
    # Neighbouring diagonals: each goes on where the one before, in the order of
    # their places in the document, lies at most GAP away.
    loose = diagonals.where("not exact")
    along = Window.partitionBy("doc_id", "text_key", "n_words", "template").orderBy(F.expr("diagonal + low"), "diagonal")
    starts = F.expr("diagonal") - F.lag("diagonal").over(along)
    ahead = (F.col("diagonal") + F.col("low")) - F.lag(F.col("diagonal") + F.col("high")).over(along)
    rising = F.col("low") > F.lag("high").over(along)
    joins = (F.abs(starts) <= GAP) & (ahead >= 0) & (ahead <= GAP + 1) & rising
    marked = loose.withColumn("new", F.when(joins, 0).otherwise(1)).withColumn("span", F.sum("new").over(along))
    grouped = marked.groupBy(*key, "span").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.min(F.expr("diagonal + low")).cast("long").alias("first_word"),
        F.max(F.expr("diagonal + high + 1")).cast("long").alias("last_word"),
    )
    grouped = grouped.withColumns(
        {"n": F.size("places"), "words": F.expr("size(array_union(places, transform(places, q -> q + 1)))")}
    )
    verified = f"100 * n >= {SHARE} * pairs and 100 * words >= {SHARE} * (last_word - first_word + 1)"
    enough = grouped.where(verified).select(
        "doc_id", "text_key", "label", "exact", "first_word", "last_word", F.expr("n / pairs").alias("share")
    )
    return whole.unionByName(enough)


def scan(docs: DataFrame, texts: Mapping[str, str] = TEXTS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score``. ``texts`` are the templates besides ``PHRASES``.

    ``n_base`` counts all places of ``PHRASES``; ``first_word`` and
    ``last_word`` are the smallest and largest place one starts at, null
    without any; label lists are sorted and joined by commas, empty without
    any; ``score`` is the largest share of a template found. Null and empty
    texts have no words. Rows that repeat ``doc_id`` and text are counted and
    come back as often; a ``doc_id``, null included, may have several texts.
    An empty table gives no row. Only ``doc_id`` and ``text`` are read.
    """
    folder = new_folder(docs.sparkSession, "licenses")
    found = written(votes(docs, texts), folder, "votes")
    places = spans(found)
    ends = found.where("template = -1").select("doc_id", "text_key", "n_words", F.lit(1).alias("row"))
    rows = places.unionByName(ends, allowMissingColumns=True)
    joined = "array_join(sort_array(collect_set({})), ',')"
    return (
        rows.groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.expr("count_if(coalesce(exact, false))").alias("n_base"),
            F.expr("min(if(exact, first_word, null))").alias("first_word"),
            F.expr("max(if(exact, first_word, null))").alias("last_word"),
            F.expr(joined.format("if(exact, label, null)")).alias("base_labels"),
            F.expr(joined.format("label")).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
            F.sum("row").alias("rows"),
        )
        .withColumn("row", F.explode(F.expr("sequence(1, rows)")))
        .drop("text_key", "row", "rows")
    )
