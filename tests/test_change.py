from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import change, movies
from rental import table, ts, values


@pytest.fixture(scope="module")
def actors(spark):
    return table(spark, "actor", "actor_id first_name last_name last_update", [(3, "Al", "A", "2020-01-01"), (7, "Bo", "B", "2020-01-01")])


def names(spark, rows):
    return spark.createDataFrame(rows, "first_name STRING, last_name STRING")


def test_insert_if_absent(spark, actors):
    batch = names(spark, [("Zoe", "Z"), ("Bo", "B"), ("Cy", "C"), ("Bo", None)])
    done = change.insert_if_absent(actors, batch, ["first_name", "last_name"], "actor_id")
    new = sorted(r[:3] for r in values(done.returning))
    assert [r[0] for r in new] == [8, 9, 10]
    assert {r[1:] for r in new} == {("Bo", None), ("Cy", "C"), ("Zoe", "Z")}
    assert done.state.count() == 5 and done.state.schema == actors.schema


def test_insert_if_absent_twice_equals_once(spark, actors):
    batch = names(spark, [("Cy", "C"), ("Di", "D")])
    once = change.insert_if_absent(actors, batch, ["first_name", "last_name"], "actor_id").state
    again = change.insert_if_absent(once, batch, ["first_name", "last_name"], "actor_id")
    assert again.returning.isEmpty()
    assert sorted(values(again.state)) == sorted(values(once))


def test_insert_sees_the_table_before_the_insert(spark, actors):
    batch = names(spark, [("Cy", "C"), ("Cy", "C")])
    key = ["first_name", "last_name"]
    assert change.insert_if_absent(actors, batch, key, "actor_id").returning.count() == 2
    assert change.insert_if_absent(actors, batch, key, "actor_id", once_per_key=True).returning.count() == 1


def test_insert_into_empty_table_starts_at_one(spark, actors):
    done = change.insert_if_absent(actors.limit(0), names(spark, [("B", "B"), ("A", "A")]), ["first_name", "last_name"], "actor_id")
    assert sorted(r[:2] for r in values(done.state)) == [(1, "A"), (2, "B")]


def test_insert_films_with_arrays_and_nulls(spark):
    films = table(spark, "film", "film_id title release_year", [(41, "Heat", 1995)])
    batch = spark.createDataFrame(
        [("Heat", 1995, 7, ["Trailers"]), ("Heat", 2010, 7, ["Behind the Scenes"]), ("Casino", 1995, 14, ["Trailers", "Deleted Scenes"])],
        "title STRING, release_year INT, rental_duration SMALLINT, special_features ARRAY<STRING>",
    ).withColumn("rental_rate", F.lit("4.99").cast("decimal(4,2)"))
    done = change.insert_if_absent(films, batch, ["title", "release_year"], "film_id")
    got = [(r["film_id"], r["title"], r["release_year"], r["special_features"], r["original_language_id"]) for r in done.returning.collect()]
    assert sorted(got) == [(42, "Casino", 1995, ["Trailers", "Deleted Scenes"], None), (43, "Heat", 2010, ["Behind the Scenes"], None)]


@pytest.fixture(scope="module")
def shop(spark):
    return {
        "film": table(
            spark,
            "film",
            "film_id title release_year language_id rental_rate",
            [(1, "Alpha", 2010, 1, 4.99), (2, "Beta", 1972, 1, 9.99), (3, "Gamma", 2001, 1, 1.99), (4, "Alpha", 1999, 2, 0.99)],
        ),
        "language": table(spark, "language", "language_id name", [(1, "English"), (2, "Klingon")]),
        "actor": table(spark, "actor", "actor_id first_name last_name", [(1, "Al", "A"), (2, "Bo", "B")]),
        "film_actor": table(spark, "film_actor", "actor_id film_id last_update", [(1, 1, "2020-01-01")]),
        "store": table(spark, "store", "store_id", [(2,), (1,)]),
        "staff": table(spark, "staff", "staff_id store_id", [(9, 1), (8, 1), (5, 2)]),
        "inventory": table(spark, "inventory", "inventory_id film_id store_id", [(10, 1, 2), (11, 2, 1), (12, 3, 1), (13, 3, 1), (14, 1, 1)]),
        "customer": table(
            spark,
            "customer",
            "customer_id first_name last_name email",
            [(1, "C", "One", "1@x"), (2, "C", "Two", "2@x"), (3, "C", "Three", "3@x")],
        ),
        "rental": table(
            spark,
            "rental",
            "rental_id rental_date inventory_id customer_id return_date staff_id",
            [
                (1, "2017-01-01T00:00:00", 10, 2, "2017-01-02T00:00:00", 9),
                (2, "2017-01-03T00:00:00", 11, 2, None, 9),
                (3, "2017-01-03T00:00:00", 12, 3, None, 9),
                (4, "2017-01-04T00:00:00", 12, 3, None, 9),
            ],
        ),
        "payment": table(
            spark,
            "payment",
            "payment_id customer_id rental_id amount payment_date",
            [(1, 2, 1, 1.0, "2017-01-01T00:00:00"), (2, 2, 2, 1.0, "2017-01-03T00:00:00"), (3, 3, 3, 1.0, "2017-01-03T00:00:00"), (4, 3, 4, 1.0, "2017-01-04T00:00:00")],
        ),
    }


def test_link_film_actors(spark, shop):
    pairs = spark.createDataFrame(
        [("Alpha", 2010, "Al", "A"), ("Alpha", 2010, "Bo", "B"), ("Beta", 1972, "Bo", "B"), ("Beta", 1973, "Bo", "B"), ("Beta", 1972, "No", "One")],
        "title STRING, release_year INT, first_name STRING, last_name STRING",
    )
    done = change.link_film_actors(shop, pairs, "2024-05-01")
    assert sorted(values(done.returning)) == [(2, 1, dt.date(2024, 5, 1)), (2, 2, dt.date(2024, 5, 1))]
    again = change.link_film_actors({**shop, "film_actor": done.state}, pairs, "2024-06-01")
    assert again.returning.isEmpty()


def test_stock_films(spark, shop):
    films = spark.createDataFrame([("Alpha", 2010), ("Beta", 1972), ("Alpha", 1999)], "title STRING, release_year INT")
    done = change.stock_films(shop, films, "2024-05-01")
    assert values(done.returning) == [(15, 4, 1, dt.date(2024, 5, 1))]


def test_heavy_customer_is_the_lowest_id_with_enough_of_both(shop):
    assert values(change.heavy_customers(shop, 2, 2)) == [(2,)]
    assert sorted(values(change.heavy_customers(shop, 2, 2, first_only=False))) == [(2,), (3,)]
    done = change.rename_heavy_customer(shop, 2, 2, {"first_name": "New", "email": "n@x"}, "2024-05-01")
    assert [(r[0], r[2], r[3], r[4]) for r in values(done.returning)] == [(2, "New", "Two", "n@x")]
    assert done.state.count() == 3
    assert change.rename_heavy_customer(shop, 3, 2, {"first_name": "New"}).returning.isEmpty()


def test_update_to_null_counts_as_an_update(spark, shop):
    changes = spark.createDataFrame([(1, None)], "customer_id INT, email STRING")
    done = change.update_from(shop["customer"], changes, ["customer_id"])
    assert [(r[0], r[4]) for r in values(done.returning)] == [(1, None)]


def test_open_and_return_rental(spark, shop):
    customers = spark.createDataFrame([(3,), (1,)], "customer_id INT")
    opened = change.open_rental(shop, customers, ts("2024-01-01T09:00:00"))
    got = {r["rental_id"]: (r["customer_id"], r["inventory_id"], r["staff_id"], r["return_date"]) for r in opened.returning.collect()}
    assert got == {5: (1, 10, 5, None), 6: (3, 10, 5, None)}
    back = change.return_latest_rental({**shop, "rental": opened.state}, customers, ts("2024-01-02T09:00:00"))
    assert sorted(r["rental_id"] for r in back.returning.collect()) == [5, 6]
    assert back.state.where("return_date IS NULL").count() == 3


def test_remove_activity(spark, shop):
    customers = spark.createDataFrame([(2,)], "customer_id INT")
    done = change.remove_activity(shop, customers)
    assert sorted(r["payment_id"] for r in done["payment"].returning.collect()) == [1, 2]
    assert sorted(r["rental_id"] for r in done["rental"].state.collect()) == [3, 4]
    left = {**shop, **{name: c.state for name, c in done.items()}}
    assert sorted(values(change.activity_counts(left, shop["customer"]))) == [(1, 0, 0), (2, 0, 0), (3, 2, 2)]


def test_delete_where_keeps_rows_with_a_null_outcome(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a INT")
    done = change.delete_where(df, F.col("a") > 1)
    assert sorted(values(done.state), key=str) == [(1,), (None,)] and values(done.returning) == [(2,)]


def test_rent_and_pay(spark, shop):
    requests = spark.createDataFrame([(1, "Alpha"), (1, "Gamma"), (2, "Beta")], "customer_id INT, title STRING")
    done = change.rent_and_pay(shop, requests, "2017-02-15", "2017-02-17", "2024-05-01")
    rented = sorted((r["customer_id"], r["inventory_id"], r["staff_id"]) for r in done["rental"].returning.collect())
    assert rented == [(1, 12, 8), (1, 13, 8), (1, 14, 8), (2, 11, 8)]
    paid = done["payment"].returning.collect()
    assert sorted(float(r["amount"]) for r in paid) == [1.99, 1.99, 4.99, 9.99]
    assert {r["rental_id"] for r in paid} == {r["rental_id"] for r in done["rental"].returning.collect()} == {5, 6, 7, 8}
    after = {**shop, **{name: c.state for name, c in done.items()}}
    again = change.rent_and_pay(after, requests, "2017-02-15", "2017-02-17")
    assert again["rental"].returning.isEmpty() and again["payment"].returning.isEmpty()


def test_bulk_load_and_delete(spark):
    done = change.delete_every_nth(change.bulk_load(spark, 12))
    assert done.state.count() == 8
    assert sorted(int(r[0].removeprefix(change.LONG_PREFIX)) for r in values(done.returning)) == [3, 6, 9, 12]


def test_add_movies(spark, shop):
    batch = spark.createDataFrame(
        [
            (1, None, 2020, "English"),
            (2, "New", 2020, "Elvish"),
            (3, "ALPHA", 2010, "english"),
            (4, "Alpha", 2010, "Klingon"),
            (5, "alpha", 2010, "klingon"),
            (6, "Fresh", None, None),
        ],
        "row_id INT, title STRING, release_year INT, language STRING",
    )
    done = movies.add_movies(shop, batch, dt.date(2025, 3, 1))
    assert sorted(r["row_id"] for r in done.accepted.collect()) == [4, 6]
    fresh = done.state.where("title = 'Fresh'").collect()[0]
    assert (fresh["film_id"], fresh["release_year"], fresh["language_id"], fresh["rental_duration"]) == (6, 2025, 2, 3)
    assert (float(fresh["rental_rate"]), float(fresh["replacement_cost"])) == (4.99, 19.99)
    reasons = {r["row_id"]: r["reason"] for r in done.rejected.collect()}
    assert reasons == {
        1: "Movie title cannot be null",
        2: 'Language "Elvish" does not exist',
        3: 'Film "ALPHA" (english / 2010) already exists',
        5: 'Film "alpha" (klingon / 2010) already exists',
    }


def test_new_movie(shop):
    film_id, done = movies.new_movie(shop, "Example", 2025, "English")
    assert film_id == 5 and done.state.count() == 5 and done.returning.count() == 1
    for title, language, message in [(None, "English", "cannot be null"), ("X", "Elvish", "does not exist")]:
        with pytest.raises(ValueError, match=message):
            movies.new_movie(shop, title, 2025, language)
    with pytest.raises(ValueError, match="already exists"):
        movies.new_movie({**shop, "film": done.state}, "EXAMPLE", 2025, "ENGLISH")
