"""Reports over the rental tables.

``t`` maps table names to DataFrames with the columns of ``sources.schemas.RENTAL``
that a report names; other columns and tables may be missing.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from reelhouse.functions import RATING_AGES, exact, expected_age, full_address, month_of, quarter_of, same_text, within, year_of
from reelhouse.functions.periods import Day
from reelhouse.operators.joins import hot_join

Tables = Mapping[str, DataFrame]


def _by_name() -> list[Column]:
    return [F.col("last_name").asc_nulls_last(), F.col("first_name").asc_nulls_last()]


def _first(ranked: DataFrame, k: int | None) -> DataFrame:
    return ranked if k is None else ranked.limit(k)


def _name_is(name: Column, wanted: str, any_case: bool) -> Column:
    return same_text(name, F.lit(wanted)) if any_case else name == wanted


def films_in_category(
    t: Tables, category: str, year_lo: int, year_hi: int, min_rate: float, any_case: bool = False
) -> DataFrame:
    """Films of a category released in the closed year range with a rate above ``min_rate``."""
    wanted = t["category"].where(_name_is(F.col("name"), category, any_case))
    members = t["film_category"].join(wanted, "category_id", "left_semi").select("film_id")
    films = t["film"].where(F.col("release_year").between(year_lo, year_hi) & (F.col("rental_rate") > exact(min_rate)))
    return (
        films.select("film_id", "title", "release_year", "rental_rate")
        .join(members, "film_id")
        .orderBy(F.col("title").asc_nulls_last(), "film_id")
        .select("title", "release_year", "rental_rate")
    )


def _revenue_by_copy(t: Tables, payments: DataFrame) -> DataFrame:
    by_rental = payments.groupBy("rental_id").agg(F.sum("amount").alias("amount"))
    return (
        t["rental"]
        .select("rental_id", "inventory_id")
        .join(by_rental, "rental_id")
        .groupBy("inventory_id")
        .agg(F.sum("amount").alias("amount"))
    )


def store_revenue_since(t: Tables, since: Day, per_address: bool = False) -> DataFrame:
    """Revenue per store from payments on or after ``since``.

    Stores are kept apart even at the same address; ``per_address`` merges them.
    """
    payments = t["payment"].where(F.col("payment_date") >= F.lit(since).cast("date"))
    by_store = (
        t["inventory"]
        .select("inventory_id", "store_id")
        .join(_revenue_by_copy(t, payments), "inventory_id")
        .groupBy("store_id")
        .agg(F.sum("amount").alias("revenue"))
    )
    labelled = (
        by_store.join(t["store"].select("store_id", "address_id"), "store_id")
        .join(t["address"].select("address_id", "address", "address2"), "address_id")
        .withColumn("full_address", full_address(F.col("address"), F.col("address2")))
    )
    if per_address:
        merged = labelled.groupBy("full_address").agg(F.sum("revenue").alias("revenue"))
        return merged.orderBy(F.col("full_address").asc_nulls_last())
    return labelled.orderBy(F.col("full_address").asc_nulls_last(), "store_id").select("full_address", "revenue")


def top_actors_since(t: Tables, year: int, k: int | None = 5, include_zero: bool = False) -> DataFrame:
    """The ``k`` actors with the most distinct films released after ``year``, or all."""
    recent = t["film"].where(F.col("release_year") > year).select("film_id")
    # A plain join would be partitioned by film, which the distinct count could build on;
    # then a film with a third of all credits could not be split any more.
    counts = (
        hot_join(t["film_actor"].select("actor_id", "film_id"), recent, ["film_id"], "left_semi")
        .groupBy("actor_id")
        .agg(F.count_distinct("film_id").alias("num_movies"))
    )
    actors = t["actor"].select("actor_id", "first_name", "last_name")
    ranked = actors.join(counts, "actor_id", "left" if include_zero else "inner")
    ranked = ranked.withColumn("num_movies", F.coalesce("num_movies", F.lit(0)))
    ranked = ranked.orderBy(F.col("num_movies").desc(), *_by_name(), "actor_id")
    return _first(ranked, k).select("first_name", "last_name", "num_movies")


def category_counts_by_year(
    t: Tables, categories: list[str], any_case: bool = True, all_years: bool = False
) -> DataFrame:
    """Films per release year, one ``num_<category>`` column for each category named.

    ``all_years`` keeps years in which none of the categories appears, counts a film once
    per category however often it is listed in it, and counts none of those without a year.
    """
    tests = {c: _name_is(F.col("name"), c, any_case) for c in categories}
    wanted = F.lit(False)
    for test in tests.values():
        wanted = wanted | test
    listed = (
        t["film_category"]
        .select("film_id", "category_id")
        .join(t["category"].where(wanted), "category_id")
        .groupBy("film_id")
        .agg(*[F.count_if(test).alias(f"n_{i}") for i, test in enumerate(tests.values())])
    )
    films = t["film"].select("film_id", "release_year").join(listed, "film_id", "left" if all_years else "inner")
    counts = []
    for i, category in enumerate(categories):
        n = F.col(f"n_{i}")
        if all_years:
            n = F.when((n > 0) & F.col("release_year").isNotNull(), 1).otherwise(0)
        counts.append(F.sum(n).alias(f"num_{category.lower()}"))
    return films.groupBy("release_year").agg(*counts).orderBy(F.col("release_year").desc_nulls_first())


def top_staff_by_revenue(
    t: Tables, year: int, k: int | None = 3, all_payments: bool = False, strict_reference: bool = False
) -> DataFrame:
    """The ``k`` staff members with the most revenue in ``year``, or all, and the store of their last payment.

    Payments without a rental are left out unless ``all_payments`` is set; they have no
    store either way, and staff without any amount are left out then. The year runs to the end of 31 December; ``strict_reference``
    stops at its first instant instead.
    """
    paid_at = F.col("payment_date")
    start, end = year_of(year)
    in_year = paid_at.between(start, F.date_sub(end, 1)) if strict_reference else within(paid_at, (start, end))
    payments = t["payment"].where(in_year).select("payment_id", "staff_id", "rental_id", "amount", "payment_date")
    stores = (
        t["rental"]
        .select("rental_id", "inventory_id")
        .join(t["inventory"].select("inventory_id", "store_id"), "inventory_id")
        .select("rental_id", "store_id", F.lit(True).alias("has_store"))
    )
    paid_order = F.struct("payment_date", "payment_id")
    per_staff = (
        payments.join(stores, "rental_id", "left" if all_payments else "inner")
        .groupBy("staff_id")
        .agg(
            F.max_by("store_id", F.when(F.col("has_store"), paid_order)).alias("last_store_id"),
            F.sum("amount").alias("total_revenue"),
        )
    )
    if all_payments:
        per_staff = per_staff.where(F.col("total_revenue").isNotNull())
    ranked = (
        t["staff"]
        .select("staff_id", "first_name", "last_name")
        .join(per_staff, "staff_id")
        .orderBy(F.col("total_revenue").desc_nulls_last(), *_by_name(), "staff_id")
    )
    return _first(ranked, k).select("first_name", "last_name", "last_store_id", "total_revenue")


def _rentals_by_film(t: Tables) -> DataFrame:
    by_copy = t["rental"].groupBy("inventory_id").agg(F.count("rental_id").alias("rentals"))
    return (
        t["inventory"]
        .select("inventory_id", "film_id")
        .join(by_copy, "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("rentals").alias("rentals"))
    )


def most_rented_films(t: Tables, k: int | None = 5, rated_only: bool = False, include_unrented: bool = False) -> DataFrame:
    """The ``k`` films rented most, or all, and the age of the audience their rating suits."""
    films = t["film"].select("film_id", "title", "rating")
    if rated_only:
        films = films.where(F.col("rating").isin(*RATING_AGES))
    ranked = (
        films.join(_rentals_by_film(t), "film_id", "left" if include_unrented else "inner")
        .withColumn("rentals", F.coalesce("rentals", F.lit(0)))
        .orderBy(F.col("rentals").desc(), F.col("title").asc_nulls_last(), "film_id")
    )
    return _first(ranked, k).select("title", "rentals", expected_age(F.col("rating")).alias("expected_age"))


def actor_inactivity(t: Tables, as_of_year: int = 2025, include_unreleased: bool = False) -> DataFrame:
    """Years since each actor's latest release.

    ``include_unreleased`` keeps actors without a film, with nulls, listed first.
    """
    latest = (
        t["film_actor"]
        .select("actor_id", "film_id")
        .join(t["film"].select("film_id", "release_year"), "film_id")
        .groupBy("actor_id")
        .agg(F.max("release_year").alias("last_release"))
    )
    return (
        t["actor"]
        .select("actor_id", "first_name", "last_name")
        .join(latest, "actor_id", "left" if include_unreleased else "inner")
        .withColumn("inactivity_years", F.lit(as_of_year) - F.col("last_release"))
        .orderBy(F.col("inactivity_years").desc_nulls_first(), *_by_name(), "actor_id")
        .select("first_name", "last_name", "last_release", "inactivity_years")
    )


def actor_max_gap(t: Tables) -> DataFrame:
    """Longest gap between consecutive distinct release years of each actor, 0 with one year only.

    The distinct step runs first, so the window sees an actor's years and not their
    credits: a handful of rows however many films the actor is in.
    """
    years = (
        t["film_actor"]
        .select("actor_id", "film_id")
        .join(t["film"].select("film_id", "release_year"), "film_id")
        .select("actor_id", "release_year")
        .distinct()
    )
    following = F.lead("release_year").over(Window.partitionBy("actor_id").orderBy("release_year"))
    gaps = (
        years.select("actor_id", F.coalesce(following - F.col("release_year"), F.lit(0)).alias("gap"))
        .groupBy("actor_id")
        .agg(F.max("gap").alias("max_gap"))
    )
    return (
        t["actor"]
        .select("actor_id", "first_name", "last_name")
        .join(gaps, "actor_id")
        .orderBy(F.col("max_gap").desc(), *_by_name(), "actor_id")
        .select("first_name", "last_name", "max_gap")
    )


def sales_by_category_quarter(t: Tables, as_of: Day = None) -> DataFrame:
    """Revenue per category in the calendar quarter of ``as_of``, today if not given.

    A film in two categories counts in both. Categories without revenue are left out.
    """
    payments = t["payment"].where(within("payment_date", quarter_of(as_of)))
    by_film = (
        t["inventory"]
        .select("inventory_id", "film_id")
        .join(_revenue_by_copy(t, payments), "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("amount").alias("amount"))
        .join(t["film"].select("film_id"), "film_id", "left_semi")
    )
    by_category = (
        t["film_category"].select("film_id", "category_id").join(by_film, "film_id").groupBy("category_id").agg(F.sum("amount").alias("amount"))
    )
    return (
        t["category"]
        .select("category_id", F.col("name").alias("category"))
        .join(by_category, "category_id")
        .groupBy("category")
        .agg(F.sum("amount").alias("total_revenue"))
        .where(F.col("total_revenue") > 0)
    )


def most_popular_films_by_country(t: Tables, countries: list[str], by_title: bool = False) -> DataFrame:
    """The film rented most by the customers of each country, names compared in any case.

    Ties go to the first title, then the lowest film id. Films are told apart by id;
    ``by_title`` adds up films that share a title.
    """
    if not countries:  # Fixed value: the message.
        raise ValueError("No countries supplied")
    wanted = t["country"].where(F.upper("country").isin(*[F.upper(F.lit(c)) for c in countries]))
    customers = (
        t["customer"]
        .select("customer_id", "address_id")
        .join(
            t["address"]
            .select("address_id", "city_id")
            .join(t["city"].select("city_id", "country_id").join(wanted, "country_id"), "city_id"),
            "address_id",
        )
        .select("customer_id", "country")
    )
    by_copy = (
        t["rental"]
        .select("customer_id", "inventory_id")
        .join(customers, "customer_id")
        .groupBy("country", "inventory_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_film = (
        by_copy.join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .groupBy("country", "film_id")
        .agg(F.sum("n").alias("n"))
        .join(t["film"].select("film_id", "title"), "film_id")
    )
    if by_title:
        by_film = by_film.groupBy("country", "title").agg(F.sum("n").alias("n"))
    # The smallest of (-rentals, title, id) is the winner; unlike a ranked window this
    # aggregate is combined on the map side, so a country with most rows stays cheap.
    rank = F.struct((-F.col("n")).alias("n"), "title", *([] if by_title else ["film_id"]))
    return (
        by_film.groupBy("country")
        .agg(F.min(rank).alias("first"))
        .select("country", F.col("first.title").alias("film_title"), (-F.col("first.n")).alias("rentals"))
        .orderBy("country")
    )


def rewards_report(t: Tables, min_purchases: int, min_amount: float, as_of: Day = None) -> DataFrame:
    """Customers with enough purchases and enough spent in the calendar month of ``as_of``."""
    spent = (
        t["payment"]
        .where(within("payment_date", month_of(as_of)))
        .groupBy("customer_id")
        .agg(
            F.count("payment_id").alias("purchases"),
            F.count(F.lit(1)).alias("payments"),
            F.sum("amount").alias("total_spent"),
        )
        .where((F.col("payments") >= min_purchases) & (F.col("total_spent") >= exact(min_amount)))
    )
    return (
        t["customer"]
        .select("customer_id", "first_name", "last_name", "email")
        .join(spent, "customer_id")
        .select("customer_id", "first_name", "last_name", "email", "purchases", "total_spent")
    )
