"""The table functions called from SQL give the rows of the Python operators."""

from __future__ import annotations

import pytest

from reelhouse.operators import reports, stock
from reelhouse.plans.sql_functions import create_functions
from rental import table, values


@pytest.fixture(scope="module")
def shop(spark):
    t = {
        "country": table(spark, "country", "country_id country", [(1, "Peru"), (2, "CUBA"), (3, "Chad")]),
        "city": table(spark, "city", "city_id country_id", [(1, 1), (2, 2), (3, 3)]),
        "address": table(spark, "address", "address_id city_id", [(1, 1), (2, 2), (3, 3)]),
        "customer": table(
            spark, "customer", "customer_id first_name last_name email address_id", [(1, "A", "B", "a@b", 1), (2, "C", "D", None, 2)]
        ),
        "film": table(spark, "film", "film_id title", [(1, "Love A"), (2, "In LOVE"), (3, "Love B"), (4, "Love B")]),
        "inventory": table(spark, "inventory", "inventory_id film_id", [(1, 1), (2, 1), (3, 2), (4, 3), (5, 4)]),
        "category": table(spark, "category", "category_id name", [(1, "Drama"), (2, "Empty")]),
        "film_category": table(spark, "film_category", "film_id category_id", [(1, 1), (2, 1), (3, 2)]),
        "rental": table(
            spark,
            "rental",
            "rental_id inventory_id customer_id return_date",
            [(1, 1, 1, "2024-05-01T10:00:00"), (2, 3, 1, "2024-05-02T10:00:00"), (3, 4, 2, None), (4, 3, 2, None), (5, 3, 2, "2024-06-01T00:00:00")],
        ),
        "payment": table(
            spark,
            "payment",
            "payment_id customer_id rental_id amount payment_date",
            [(1, 1, 1, 2.50, "2024-04-01T00:00:00"), (2, 1, 2, 4.00, "2024-06-30T23:59:59"), (3, 1, 1, 9.00, "2024-07-01T00:00:00"),
             (4, 2, 3, 0.00, "2024-05-01T00:00:00"), (5, 1, 1, 1.00, "2024-06-01T00:00:00")],
        ),
    }
    create_functions(t)
    return t


@pytest.mark.parametrize(
    ("call", "expected"),
    [
        ("get_sales_revenue_by_category_qtr(DATE'2024-05-15')", lambda t: reports.sales_by_category_quarter(t, "2024-05-15")),
        ("get_sales_revenue_by_category_qtr()", lambda t: reports.sales_by_category_quarter(t)),
        ("get_sales_revenue_by_category_qtr(p_ref_date => DATE'2024-09-30')", lambda t: reports.sales_by_category_quarter(t, "2024-09-30")),
        ("most_popular_films_by_countries(array('peru', 'Cuba', 'Chad', 'none'))", lambda t: reports.most_popular_films_by_country(t, ["peru", "Cuba", "Chad", "none"])),
        ("films_in_stock_by_title('%love%')", lambda t: stock.films_in_stock_by_title(t, "%love%")),
        ("films_in_stock_by_title('love _')", lambda t: stock.films_in_stock_by_title(t, "love _")),
        ("films_in_stock_by_title('%100\\\\%')", lambda t: stock.films_in_stock_by_title(t, "%100\\%")),
        ("rewards_report(2, 5, DATE'2024-06-10')", lambda t: reports.rewards_report(t, 2, 5, "2024-06-10")),
        ("rewards_report(1, 0, DATE'2024-05-10')", lambda t: reports.rewards_report(t, 1, 0, "2024-05-10")),
        ("rewards_report(1, 0)", lambda t: reports.rewards_report(t, 1, 0)),
    ],
)
def test_rows_of_the_operators(spark, shop, call, expected):
    assert sorted(map(str, values(spark.sql(f"SELECT * FROM {call}")))) == sorted(map(str, values(expected(shop))))


@pytest.mark.parametrize(
    ("call", "message"),
    [
        ("most_popular_films_by_countries(array())", "No countries supplied"),
        ("most_popular_films_by_countries(NULL)", "No countries supplied"),
        ("films_in_stock_by_title(NULL)", "Title pattern cannot be null"),
    ],
)
def test_messages(spark, shop, call, message):
    with pytest.raises(Exception, match=message):
        spark.sql(f"SELECT * FROM {call}").collect()


def test_boolean_function_per_row_and_in_a_filter(spark, shop):
    rows = spark.sql("SELECT inventory_id, inventory_in_stock(inventory_id) FROM inventory").collect()
    assert {tuple(r) for r in rows} == {(1, True), (2, True), (3, False), (4, False), (5, True)}
    kept = spark.sql("SELECT inventory_id FROM inventory WHERE NOT inventory_in_stock(inventory_id)").collect()
    assert {r[0] for r in kept} == {3, 4}


def test_dates_reach_the_reader(spark, shop, tmp_path):
    shop["payment"].write.parquet(f"{tmp_path}/payment")
    create_functions({**shop, "payment": spark.read.parquet(f"{tmp_path}/payment")}, "stored_", ["get_sales_revenue_by_category_qtr"])
    df = spark.sql("SELECT category FROM stored_get_sales_revenue_by_category_qtr(DATE'2024-05-15')")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert "GreaterThanOrEqual(payment_date,2024-04-01T00:00" in plan and "LessThan(payment_date,2024-07-01T00:00" in plan
