"""A synthetic viewing population with weighted categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairdraw.functions.columns import name, only_if, report_round

# Fixed values of the population.
CONTENT_TYPES = {"Sports": 0.45, "Entertainment": 0.55}
SPORTS = ("Football", "Tennis", "Padel", "Motorsports", "Basketball", "Cricket", "Swimming")
GENRES = ("Drama", "Action", "Horror", "Comedy", "PG", "Thriller", "Romance")
LANGUAGES = {"Arabic": 0.35, "English": 0.40, "Turkish": 0.10, "French": 0.08, "Hindi": 0.07}
COUNTRIES_V1 = {
    "UAE": 0.25, "Qatar": 0.20, "Egypt": 0.18, "Kuwait": 0.12, "Saudi Arabia": 0.12, "Bahrain": 0.07, "Jordan": 0.06,
}
COUNTRIES_V2 = {
    "UAE": 0.30, "Qatar": 0.25, "Egypt": 0.20, "Kuwait": 0.10, "Saudi Arabia": 0.07, "Bahrain": 0.04,
    "Iraq": 0.025, "Palestine": 0.015,
}
MEAN_MINUTES = 50.0
MEAN_COUNT = 500.0
STRATA = ("ContentType", "Genre", "Country", "Language", "SportsName")


@dataclass(frozen=True)
class Profile:
    countries: Mapping[str, float]
    first_user: int
    last_user: int


PROFILES = {
    "v1": Profile(COUNTRIES_V1, 101, 200),
    "v2": Profile(COUNTRIES_V2, 101, 300),
    "v3": Profile(COUNTRIES_V2, 101, 10_000),
}


# Each md5 of a row gives four numbers of eight hexadecimal digits.
DIGITS = 8
NUMBERS = ("user", "content", "kind", "country", "language", "minutes", "count")


def _chances(rows: DataFrame, row_id: str, seed: int) -> DataFrame:
    """The id with a number in [0, 1) per purpose, from seed and id alone."""
    per_hash = 32 // DIGITS
    hashes = [
        F.expr(f"md5(concat('{seed}|{i}|', cast({name(row_id)} as string)))").alias(f"_fd_hash{i}")
        for i in range(-(-len(NUMBERS) // per_hash))
    ]
    number = "cast(conv(substring(_fd_hash{h}, {at}, {n}), 16, 10) as double) / {size}"
    return rows.select(row_id, *hashes).select(
        row_id,
        *[
            F.expr(number.format(h=i // per_hash, at=1 + i % per_hash * DIGITS, n=DIGITS, size=16**DIGITS)).alias(f"_fd_{p}")
            for i, p in enumerate(NUMBERS)
        ],
    )


def _choose(chance: Column, options: Mapping[str, float] | Sequence[str]) -> Column:
    """Weighted choice: the first option whose cumulative chance lies above."""
    if not isinstance(options, Mapping):
        return F.element_at(
            F.array(*[F.lit(o) for o in options]), F.floor(chance * len(options)).cast("int") + 1
        )
    *front, last = options
    choice, reached = None, 0.0
    for option in front:
        reached = round(reached + options[option], 6)
        choice = (F if choice is None else choice).when(chance < F.lit(reached), F.lit(option))
    return choice.otherwise(F.lit(last))


def viewing_population(
    rows: DataFrame, row_id: str, profile: str = "v2", *, seed: int = 42
) -> DataFrame:
    """One viewing record per row of ``rows``, decided by its id alone, so the
    table is the same under any partitioning. The id stays in front."""
    kind = PROFILES[profile]
    users = kind.last_user - kind.first_user + 1
    chance = {p: F.col(f"_fd_{p}") for p in NUMBERS}
    sports = chance["content"] < CONTENT_TYPES["Sports"]
    return _chances(rows, row_id, seed).select(
        row_id,
        (F.floor(chance["user"] * users) + kind.first_user).cast("int").alias("UserID"),
        only_if(sports, _choose(chance["kind"], SPORTS)).alias("SportsName"),
        _choose(chance["content"], CONTENT_TYPES).alias("ContentType"),
        only_if(~sports, _choose(chance["kind"], GENRES)).alias("Genre"),
        _choose(chance["country"], kind.countries).alias("Country"),
        only_if(~sports, _choose(chance["language"], LANGUAGES)).alias("Language"),
        report_round(-MEAN_MINUTES * F.log(1 - chance["minutes"]), 1).alias("TotalMins"),
        F.floor(-MEAN_COUNT * F.log(1 - chance["count"])).cast("int").alias("TotalCNT"),
    )


def generate_population(spark: SparkSession, n: int, profile: str = "v2", *, seed: int = 42) -> DataFrame:
    """``n`` viewing records with a ``row_id`` from 0."""
    return viewing_population(spark.range(n).withColumnRenamed("id", "row_id"), "row_id", profile, seed=seed)
