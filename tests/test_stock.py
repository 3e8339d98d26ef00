from __future__ import annotations

import datetime as dt

import pytest

from reelhouse.operators import lists, stock
from rental import table, values


@pytest.fixture(scope="module")
def shop(spark):
    return {
        "film": table(
            spark,
            "film",
            "film_id title rental_rate rental_duration last_update",
            [(1, "Love A", 2.00, 3, "2020-01-01"), (2, "In LOVE", 4.00, 2, "2021-01-01"), (3, "Love B", 1.00, 1, None), (4, "War", 1.00, 1, None)],
        ),
        # copy 1 open, 2 returned, 3 never rented, 4 the only copy of film 3 and out
        "inventory": table(spark, "inventory", "inventory_id film_id store_id", [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 3, 1), (5, 4, 1)]),
        "rental": table(
            spark,
            "rental",
            "rental_id rental_date inventory_id customer_id return_date",
            [
                (1, "2020-01-01T10:00:00", 1, 1, None),
                (2, "2020-01-01T10:00:00", 2, 1, "2020-01-09T09:00:00"),
                (3, "2020-01-05T10:00:00", 4, 2, None),
                (4, "2020-01-02T10:00:00", 2, 2, "2020-01-03T10:00:00"),
                (5, "2020-02-01T10:00:00", 3, 2, "2020-02-02T10:00:00"),
            ],
        ),
        "payment": table(
            spark,
            "payment",
            "payment_id customer_id amount payment_date",
            [(1, 1, 3.00, "2020-01-10T23:59:00"), (2, 1, 9.00, "2020-01-11T00:00:00"), (3, 2, 1.00, "2020-01-05T10:00:00")],
        ),
        "customer": table(spark, "customer", "customer_id", [(1,), (2,), (3,)]),
        "actor": table(spark, "actor", "actor_id first_name last_name", [(1, "Bo", "B"), (2, "Al", "A")]),
        "film_actor": table(spark, "film_actor", "actor_id film_id", [(1, 1), (2, 1), (2, 1), (2, 2)]),
    }


def test_copies(shop):
    assert sorted(r[0] for r in values(stock.film_in_stock(shop))) == [2, 3, 5]
    assert sorted(r[0] for r in values(stock.film_not_in_stock(shop))) == [1, 4]
    assert values(stock.film_in_stock(shop, film_id=1, store_id=2)) == [(2, 1, 2)]
    assert values(stock.film_in_stock(shop, film_id=1, store_id=1)) == []
    flags = {r[0]: r[3] for r in values(stock.inventory_in_stock(shop))}
    assert flags == {1: False, 2: True, 3: True, 4: False, 5: True}


def test_held_copies(shop):
    assert sorted(r[:3] for r in values(stock.inventory_held_by_customer(shop))) == [(1, 1, 1), (2, 4, 3)]
    assert [r[1] for r in values(stock.inventory_held_by_customer(shop, 2))] == [4]


def test_balance(shop):
    # customer 1: 2 + 2 charged; kept 9 and 8 days for 3 allowed, so 6 + 5 days late; 3.00 paid by the 10th
    # customer 2: 1 + 2 charged; 5 days for 1 allowed, 1 day for 3 allowed; the February rental is ignored
    found = {r[0]: r[1:] for r in values(stock.customer_balance(shop, dt.date(2020, 1, 10), 0.5))}
    assert found == {1: (4.0, 5.5, 3.0, 6.5), 2: (3.0, 2.0, 1.0, 4.0), 3: (0.0, 0.0, 0.0, 0.0)}


def test_films_in_stock_by_title(shop):
    assert values(stock.films_in_stock_by_title(shop, "%love%")) == [(1, 2, "In LOVE"), (2, 1, "Love A")]
    assert values(stock.films_in_stock_by_title(shop, "love b")) == [(1, None, "No films found in stock for pattern: love b")]
    with pytest.raises(ValueError, match="cannot be null"):
        stock.films_in_stock_by_title(shop, None)


def test_lists(shop):
    assert sorted(values(lists.film_actor_lists(shop))) == [(1, "Love A", "Al A, Bo B"), (2, "In LOVE", "Al A")]
    repeated = lists.group_concat(shop["film_actor"], ["film_id"], "actor_id", separator="'", distinct=False)
    assert sorted(values(repeated)) == [(1, "1'2'2"), (2, "2")]


def test_last_updated(shop):
    assert values(lists.last_updated(shop["film"])) == [(dt.date(2021, 1, 1),)]
    assert dict(values(lists.last_updated(shop["film"], ["film_id"])))[3] is None
