from __future__ import annotations

import pytest

from reelhouse.operators import reports
from reelhouse.plans.views import create_views
from rental import table, values


@pytest.fixture(scope="module")
def films(spark):
    return {
        "film": table(
            spark,
            "film",
            "film_id title release_year rental_rate rating",
            [
                (1, "Early", 2016, 2.99, "G"),
                (2, "First", 2017, 2.99, "PG"),
                (3, "Cheap", 2018, 1.00, "PG-13"),
                (4, "Last", 2019, 1.01, "R"),
                (5, "After", 2020, 2.99, None),
                (6, "Drama", 2018, 2.99, "NC-17"),
            ],
        ),
        "category": table(spark, "category", "category_id name", [(1, "Animation"), (2, "DRAMA"), (3, "Travel"), (4, "animation")]),
        "film_category": table(
            spark, "film_category", "film_id category_id", [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 2), (2, 3), (6, 4)]
        ),
        "actor": table(
            spark, "actor", "actor_id first_name last_name", [(1, "Al", "Zed"), (2, "Bo", "Able"), (3, "Cy", "Able"), (4, "Di", "None")]
        ),
        "film_actor": table(
            spark, "film_actor", "actor_id film_id", [(1, 1), (1, 2), (1, 2), (1, 5), (2, 1), (2, 4), (3, 1), (3, 6)]
        ),
    }


def test_films_in_category_is_closed_on_years_and_strict_on_rate(films):
    assert values(reports.films_in_category(films, "Animation", 2017, 2019, 1)) == [("First", 2017, 2.99), ("Last", 2019, 1.01)]


def test_films_in_category_any_case_takes_both_spellings(films):
    found = values(reports.films_in_category(films, "ANIMATION", 2017, 2019, 1, any_case=True))
    assert [row[0] for row in found] == ["Drama", "First", "Last"]


def test_top_actors_counts_distinct_films_after_the_year(films):
    assert values(reports.top_actors_since(films, 2016, 2)) == [("Al", "Zed", 2), ("Bo", "Able", 1)]
    everyone = values(reports.top_actors_since(films, 2016, 10, include_zero=True))
    assert everyone[-1] == ("Di", "None", 0) and len(everyone) == 4


def test_category_counts(films):
    found = values(reports.category_counts_by_year(films, ["Drama", "Travel"]))
    assert found == [(2018, 1, 0), (2017, 0, 1)]
    exact = values(reports.category_counts_by_year(films, ["Drama", "Travel"], any_case=False))
    assert exact == [(2017, 0, 1)]
    every_year = values(reports.category_counts_by_year(films, ["Drama", "Travel"], all_years=True))
    assert every_year == [(2020, 0, 0), (2019, 0, 0), (2018, 1, 0), (2017, 0, 1), (2016, 0, 0)]


def test_actor_inactivity(films):
    assert values(reports.actor_inactivity(films, 2025)) == [
        ("Cy", "Able", 2018, 7),
        ("Bo", "Able", 2019, 6),
        ("Al", "Zed", 2020, 5),
    ]
    first = values(reports.actor_inactivity(films, 2025, include_unreleased=True))[0]
    assert first == ("Di", "None", None, None)


def test_actor_max_gap(spark):
    t = {
        "film": table(spark, "film", "film_id release_year", [(1, 2010), (2, 2014), (3, 2014), (4, 2020)]),
        "actor": table(spark, "actor", "actor_id first_name last_name", [(1, "A", "A"), (2, "B", "B")]),
        "film_actor": table(spark, "film_actor", "actor_id film_id", [(1, 1), (1, 2), (1, 3), (1, 4), (2, 4)]),
    }
    assert values(reports.actor_max_gap(t)) == [("A", "A", 6), ("B", "B", 0)]


@pytest.fixture(scope="module")
def shop(spark):
    return {
        "film": table(spark, "film", "film_id title rating", [(1, "One", "G"), (2, "Two", None), (3, "Three", "PG"), (4, "Unrented", "R")]),
        "film_category": table(spark, "film_category", "film_id category_id", [(1, 1), (1, 2), (2, 2), (3, 3)]),
        "category": table(spark, "category", "category_id name", [(1, "Action"), (2, "Drama"), (3, "Free")]),
        "inventory": table(spark, "inventory", "inventory_id film_id store_id", [(1, 1, 1), (2, 2, 2), (3, 3, 3)]),
        "rental": table(
            spark,
            "rental",
            "rental_id inventory_id customer_id",
            [(1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 3, 2), (5, 1, 3)],
        ),
        "payment": table(
            spark,
            "payment",
            "payment_id customer_id staff_id rental_id amount payment_date",
            [
                (1, 1, 1, 1, 5.00, "2017-03-31T23:59:59"),
                (2, 1, 1, 2, 7.00, "2017-04-01T00:00:00"),
                (3, 2, 2, 3, 2.00, "2017-06-30T23:59:59"),
                (4, 2, 2, 4, 0.00, "2017-05-01T10:00:00"),
                (5, 3, 1, 5, 1.00, "2017-12-31T12:00:00"),
                (6, 3, 3, None, 50.00, "2017-05-05T12:00:00"),
                (7, 3, 2, 1, 4.00, "2018-05-05T12:00:00"),
                (8, 2, 2, 5, 3.00, "2017-06-30T23:59:59"),
            ],
        ),
        "store": table(spark, "store", "store_id address_id", [(1, 1), (2, 2), (3, 3)]),
        "address": table(
            spark,
            "address",
            "address_id address address2 city_id",
            [(1, "1 Road", None, 1), (2, "1 Road", None, 1), (3, "2 Street", "Floor 3", 2)],
        ),
        "staff": table(spark, "staff", "staff_id store_id first_name last_name", [(1, 1, "S", "One"), (2, 2, "S", "Two"), (3, 3, "S", "Three")]),
        "customer": table(
            spark,
            "customer",
            "customer_id first_name last_name email address_id",
            [(1, "C", "One", "1@x", 1), (2, "C", "Two", "2@x", 3), (3, "C", "Three", "3@x", 3)],
        ),
        "city": table(spark, "city", "city_id country_id", [(1, 1), (2, 2)]),
        "country": table(spark, "country", "country_id country", [(1, "Latvia"), (2, "POLAND")]),
    }


def test_store_revenue_starts_on_the_day_and_keeps_stores_apart(shop):
    assert values(reports.store_revenue_since(shop, "2017-04-01")) == [
        ("1 Road ", 8.0),
        ("1 Road ", 9.0),
        ("2 Street Floor 3", 0.0),
    ]
    merged = values(reports.store_revenue_since(shop, "2017-04-01", per_address=True))
    assert merged == [("1 Road ", 17.0), ("2 Street Floor 3", 0.0)]


def test_top_staff_takes_the_store_of_the_last_payment(shop):
    # staff 2 has two payments at the same instant: the higher payment id decides
    assert values(reports.top_staff_by_revenue(shop, 2017)) == [("S", "One", 1, 13.0), ("S", "Two", 1, 5.0)]


def test_top_staff_options(shop):
    strict = values(reports.top_staff_by_revenue(shop, 2017, strict_reference=True))
    assert strict[0] == ("S", "One", 2, 12.0)
    every = values(reports.top_staff_by_revenue(shop, 2017, all_payments=True))
    assert every[0] == ("S", "Three", None, 50.0)


def test_most_rented_films(shop):
    assert values(reports.most_rented_films(shop)) == [("One", 2, 0), ("Two", 2, None), ("Three", 1, 10)]
    assert values(reports.most_rented_films(shop, rated_only=True)) == [("One", 2, 0), ("Three", 1, 10)]
    assert values(reports.most_rented_films(shop, include_unrented=True))[-1] == ("Unrented", 0, 17)


def test_sales_by_category_quarter_counts_a_film_in_each_category_and_drops_zero(shop):
    found = sorted(values(reports.sales_by_category_quarter(shop, "2017-05-15")))
    assert found == [("Action", 3.0), ("Drama", 12.0)]
    assert values(reports.sales_by_category_quarter(shop)) == []


def test_most_popular_films(shop):
    found = values(reports.most_popular_films_by_country(shop, ["latvia", "Poland", "Nowhere"]))
    assert found == [("Latvia", "One", 1), ("POLAND", "One", 1)]
    for nothing in ([], None):
        with pytest.raises(ValueError, match="No countries supplied"):
            reports.most_popular_films_by_country(shop, nothing)


def test_popular_titles_add_up_films_of_one_title(spark, shop):
    film = table(spark, "film", "film_id title", [(1, "Zulu"), (2, "Same"), (3, "Same")])
    t = {**shop, "film": film}
    by_id = values(reports.most_popular_films_by_country(t, ["poland"]))
    assert by_id == [("POLAND", "Same", 1)]
    assert values(reports.most_popular_films_by_country(t, ["poland"], by_title=True)) == [("POLAND", "Same", 2)]


def test_rewards_report_meets_both_thresholds_exactly(shop):
    assert values(reports.rewards_report(shop, 2, 5, "2017-06-01")) == [(2, "C", "Two", "2@x", 2, 5.0)]
    assert values(reports.rewards_report(shop, 2, 5.01, "2017-06-01")) == []
    assert values(reports.rewards_report(shop, 1, 50, "2017-05-31")) == [(3, "C", "Three", "3@x", 1, 50.0)]


def test_views(spark, shop):
    create_views(shop)
    assert spark.sql("SELECT category, total_revenue FROM sales_revenue_by_category_qtr").collect() == []
    assert spark.table("customer_public_info").columns == ["customer_id", "first_name", "last_name"]
