"""Validated film inserts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from reelhouse.functions.periods import day_literal
from reelhouse.operators.change import Change, like_table
from reelhouse.operators.joins import hot_join, in_keys
from reelhouse.operators.numbering import assign_keys, number_rows
from reelhouse.sources.session import checkpointed

Tables = Mapping[str, DataFrame]

# Fixed values of a new film.
RENTAL_DURATION = 3
RENTAL_RATE = "4.99"
REPLACEMENT_COST = "19.99"
DEFAULT_LANGUAGE = "Klingon"


class MovieBatch(NamedTuple):
    """Films after the batch, and its rows with the new id or the reason they were refused."""

    state: DataFrame
    accepted: DataFrame
    rejected: DataFrame


def add_movies(t: Tables, batch: DataFrame, as_of: dt.date | None = None, row_id: str = "row_id") -> MovieBatch:
    """Insert films given as (title, release_year, language), in ``row_id`` order.

    A null title, an unknown language, or a film that exists already with the same
    title in any case, language and year is refused; so is the second of two equal
    films in the batch. A null year is the current one, a null language the default.
    Without a ``row_id`` column the batch is taken in order of its values.
    """
    if row_id not in batch.columns:
        batch = number_rows(batch, ["title", "release_year", "language"], name=row_id)
    languages = t["language"].groupBy(F.upper("name").alias("_language")).agg(F.min("language_id").alias("language_id"))
    rows = (
        batch.select(
            row_id,
            "title",
            F.coalesce("release_year", F.year(day_literal(as_of))).alias("release_year"),
            F.coalesce("language", F.lit(DEFAULT_LANGUAGE)).alias("language"),
        )
        .withColumn("_language", F.upper("language"))
        .withColumn("_title", F.upper("title"))
    )
    rows = checkpointed(hot_join(rows, languages, ["_language"], "left"))
    key = ["_title", "language_id", "release_year"]
    existing = t["film"].select(F.upper("title").alias("_title"), "language_id", "release_year")
    known = in_keys(existing, rows, key).distinct().withColumn("_known", F.lit(True))
    # The first row of each key is marked by its own id: joining on the id and not on
    # the key keeps a title that fills a third of the batch from meeting in one task.
    firsts = rows.groupBy(*key).agg(F.min(row_id).alias(row_id)).select(row_id, F.lit(True).alias("_first"))
    # The messages.
    reason = (
        F.when(F.col("title").isNull(), F.lit("Movie title cannot be null"))
        .when(F.col("language_id").isNull(), F.format_string('Language "%s" does not exist', "language"))
        .when(
            F.col("_known").isNotNull() | F.col("_first").isNull(),
            F.format_string('Film "%s" (%s / %s) already exists', "title", "language", F.col("release_year").cast("string")),
        )
    )
    judged = hot_join(rows, known, key, "left").join(firsts, row_id, "left").withColumn("reason", reason)

    films = judged.where(F.col("reason").isNull()).select(
        row_id,
        "title",
        "release_year",
        "language_id",
        F.lit(RENTAL_DURATION).alias("rental_duration"),
        F.lit(RENTAL_RATE).cast("decimal(4,2)").alias("rental_rate"),
        F.lit(REPLACEMENT_COST).cast("decimal(5,2)").alias("replacement_cost"),
    )
    keyed = assign_keys(films, t["film"], "film_id", [row_id], unique=True)
    rejected = judged.where(F.col("reason").isNotNull()).select(row_id, "title", "release_year", "language", "reason")
    return MovieBatch(
        t["film"].unionByName(like_table(keyed, t["film"])),
        keyed.select(row_id, "film_id", "title", "release_year", "language_id"),
        rejected,
    )


def new_movie(
    t: Tables, title: str | None, release_year: int | None = None, language: str | None = DEFAULT_LANGUAGE
) -> tuple[int, Change]:
    """Insert one film and return its id and the change; a refused film raises."""
    spark = t["film"].sparkSession
    row = spark.createDataFrame([(0, title, release_year, language)], "row_id INT, title STRING, release_year INT, language STRING")
    batch = add_movies(t, row)
    refused = batch.rejected.select("reason").head(1)
    if refused:
        raise ValueError(refused[0]["reason"])
    film_id = batch.accepted.head(1)[0]["film_id"]
    return film_id, Change(batch.state, batch.state.where(F.col("film_id") == film_id))
