"""Data changes as new table states.

Every operator takes the current state and returns a ``Change``: the state after the
change and the rows it touched. Nothing is written here; ``sources.publish`` does that.
A batch that acts on one person in a script takes a DataFrame of keys instead, so one
run serves any number of them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.functions.periods import Day, day_literal, moment, within
from reelhouse.operators.joins import hot_join, in_keys, not_in_keys
from reelhouse.operators.numbering import assign_keys
from reelhouse.sources.session import checkpointed

Tables = Mapping[str, DataFrame]

# Fixed value: text in front of the number in the bulk-load experiment.
LONG_PREFIX = "veeeeeeery_long_string"


class Change(NamedTuple):
    """A table after a change, and the rows inserted, updated or deleted."""

    state: DataFrame
    returning: DataFrame


def like_table(rows: DataFrame, target: DataFrame) -> DataFrame:
    """``rows`` with the columns, order and types of ``target``; columns they lack are null."""
    return rows.select(
        *[
            (F.col(field.name) if field.name in rows.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in target.schema.fields
        ]
    )


def not_yet_in(rows: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` whose key is not in ``target``; a null in the key never matches.

    The target is first reduced to the keys of the batch, so that a small batch costs a
    scan of the target's key columns and no shuffle of them.
    """
    present = in_keys(target.select(*key), rows, key)
    return not_in_keys(rows, present, key)


def insert_if_absent(
    target: DataFrame,
    rows: DataFrame,
    natural_key: list[str],
    id_column: str | None = None,
    once_per_key: bool = False,
) -> Change:
    """Insert the rows whose natural key the target does not hold yet.

    As with ``INSERT … WHERE NOT EXISTS`` the check sees the table before the insert,
    so a key repeated inside ``rows`` goes in as often as it is there;
    ``once_per_key`` keeps the least of its rows. New ids follow the largest one in key
    order. The batch is computed once, so the state and the rows returned always agree.
    """
    new = not_yet_in(checkpointed(rows), target, natural_key)
    if once_per_key:
        others = [c for c in new.columns if c not in natural_key]
        if others:
            least = new.groupBy(*natural_key).agg(F.min(F.struct(*others)).alias("_least"))
            new = least.select(*natural_key, "_least.*").select(*new.columns)
        else:
            new = new.distinct()
    if id_column is not None:
        new = assign_keys(new.drop(id_column), target, id_column, natural_key)
    new = like_table(new, target)
    return Change(target.unionByName(new), new)


def resolve(rows: DataFrame, lookup: DataFrame, on: Mapping[str, str], take: list[str]) -> DataFrame:
    """Add the ``take`` columns of the lookup rows whose columns match; rows without a match drop out."""
    keys = lookup.select(*[F.col(theirs).alias(f"_{theirs}") for theirs in on.values()], *take)
    condition = [F.col(ours) == F.col(f"_{theirs}") for ours, theirs in on.items()]
    return rows.join(keys, condition).drop(*[f"_{theirs}" for theirs in on.values()])


def link_film_actors(t: Tables, pairs: DataFrame, as_of: Day = None) -> Change:
    """Link films to actors given as (title, release_year, first_name, last_name)."""
    linked = resolve(pairs, t["film"], {"title": "title", "release_year": "release_year"}, ["film_id"])
    linked = resolve(linked, t["actor"], {"first_name": "first_name", "last_name": "last_name"}, ["actor_id"])
    links = linked.select("actor_id", "film_id").withColumn("last_update", day_literal(as_of))
    return insert_if_absent(t["film_actor"], links, ["actor_id", "film_id"])


def stock_films(t: Tables, films: DataFrame, as_of: Day = None) -> Change:
    """Give the store with the lowest id one copy of each film (title, release_year) it does not hold."""
    store_id = t["store"].agg(F.min("store_id")).scalar()
    copies = resolve(films, t["film"], {"title": "title", "release_year": "release_year"}, ["film_id"]).select(
        "film_id", store_id.alias("store_id"), day_literal(as_of).alias("last_update")
    )
    return insert_if_absent(t["inventory"], copies, ["film_id", "store_id"], "inventory_id")


def update_from(target: DataFrame, changes: DataFrame, key: list[str]) -> Change:
    """Overwrite the non-key columns in ``changes`` for the rows whose key is there.

    Should a key be given more than once, the greatest of its rows is used.
    """
    columns = [c for c in changes.columns if c not in key]
    one_each = changes.groupBy(*key).agg(F.max(F.struct(*columns)).alias("_new"))
    marked = hot_join(target, one_each, key, "left").withColumn("_hit", F.col("_new").isNotNull())
    updated = marked.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new.{f.name}").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in columns
            else F.col(f.name)
            for f in target.schema.fields
        ],
        "_hit",
    )
    return Change(updated.drop("_hit"), updated.where("_hit").drop("_hit"))


def heavy_customers(t: Tables, min_rentals: int, min_payments: int, first_only: bool = True) -> DataFrame:
    """Customers with enough rentals and enough payments; the lowest id only, unless all are asked for."""
    rentals = t["rental"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("rentals"))
    payments = t["payment"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("payments"))
    heavy = (
        rentals.where(F.col("rentals") >= min_rentals)
        .join(payments.where(F.col("payments") >= min_payments), "customer_id")
        .select("customer_id")
    )
    if first_only:
        return heavy.agg(F.min("customer_id").alias("customer_id")).where(F.col("customer_id").isNotNull())
    return heavy


def rename_heavy_customer(
    t: Tables, min_rentals: int, min_payments: int, values: Mapping[str, str], as_of: Day = None
) -> Change:
    """Overwrite columns of the first customer with enough rentals and payments."""
    changes = heavy_customers(t, min_rentals, min_payments).select(
        "customer_id", *[F.lit(v).alias(c) for c, v in values.items()], day_literal(as_of).alias("last_update")
    )
    return update_from(t["customer"], changes, ["customer_id"])


def open_rental(t: Tables, customers: DataFrame, rented_at: dt.datetime | str) -> Change:
    """Open one rental for each customer with the lowest copy and the lowest staff member."""
    copy = t["inventory"].agg(F.min("inventory_id")).scalar()
    staff = t["staff"].agg(F.min("staff_id")).scalar()
    rows = customers.select(
        "customer_id",
        moment(rented_at).alias("rental_date"),
        copy.alias("inventory_id"),
        staff.alias("staff_id"),
    )
    new = like_table(assign_keys(rows, t["rental"], "rental_id", ["customer_id"]), t["rental"])
    return Change(t["rental"].unionByName(new), new)


def return_latest_rental(t: Tables, customers: DataFrame, returned_at: dt.datetime | str) -> Change:
    """Set the return date of each customer's rental with the highest id."""
    latest = (
        in_keys(t["rental"].select("customer_id", "rental_id"), customers, ["customer_id"])
        .groupBy("customer_id")
        .agg(F.max("rental_id").alias("rental_id"))
        .select("rental_id", moment(returned_at).alias("return_date"))
    )
    return update_from(t["rental"], latest, ["rental_id"])


def delete_matching(target: DataFrame, keys: DataFrame, on: list[str]) -> Change:
    """Delete the rows whose ``on`` columns appear in ``keys``."""
    return Change(not_in_keys(target, keys, on), in_keys(target, keys, on))


def delete_where(target: DataFrame, condition: Column) -> Change:
    """Delete the rows on which ``condition`` holds; where it is null the row stays."""
    hit = F.coalesce(condition, F.lit(False))
    return Change(target.where(~hit), target.where(hit))


def remove_activity(t: Tables, customers: DataFrame) -> dict[str, Change]:
    """Delete the payments for the customers' rentals, then the rentals."""
    rentals = in_keys(t["rental"], customers, ["customer_id"])
    return {
        "payment": delete_matching(t["payment"], rentals, ["rental_id"]),
        "rental": delete_matching(t["rental"], customers, ["customer_id"]),
    }


def activity_counts(t: Tables, customers: DataFrame) -> DataFrame:
    """Rentals and payments each of the customers has left."""
    counted = customers.select("customer_id").distinct()
    for table, name in (("rental", "rentals"), ("payment", "payments")):
        rows = in_keys(t[table].select("customer_id"), customers, ["customer_id"])
        rows = rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias(name))
        counted = counted.join(rows, "customer_id", "left")
    return counted.select(
        "customer_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rentals", "payments")]
    )


class RentAndPay(Mapping[str, Change]):
    """The changes of the tables ``rental`` and ``payment``; the payments are worked out when they are first asked for."""

    def __init__(self, rental: Change, pay: Callable[[], Change]) -> None:
        self._rental, self._pay, self._payment = rental, pay, None

    def __getitem__(self, table: str) -> Change:
        if table == "rental":
            return self._rental
        if table != "payment":
            raise KeyError(table)
        if self._payment is None:
            self._payment = self._pay()
        return self._payment

    def __iter__(self) -> Iterator[str]:
        return iter(("rental", "payment"))

    def __len__(self) -> int:
        return 2


def rent_and_pay(
    t: Tables, requests: DataFrame, rented_on: Day, returned_on: Day, as_of: Day = None, share_copies: bool = False
) -> RentAndPay:
    """Rent and pay the films that customers ask for as (customer_id, title).

    Each customer is served by the store with the lowest id that holds one of their
    titles, by its staff member with the lowest id. All copies of a title there go to the
    customer with the lowest id of those the store serves and who ask for it, as a copy can
    be out only once; with ``share_copies`` every such customer rents every copy, which
    gives as many rows as customers times copies. Payments at the film's rate follow for
    all rentals of that day by the customers who asked that are not paid yet. Both steps
    skip what is there already, so a repeat adds nothing.
    """
    requests = checkpointed(requests.select("customer_id", "title").distinct())
    titles = requests.select("title").distinct()
    films = t["film"].select("film_id", "title").join(titles, "title", "left_semi")
    copies = checkpointed(
        t["inventory"].select("inventory_id", "film_id", "store_id").join(films, "film_id").select("title", "store_id", "inventory_id")
    )

    # The store is settled on one row per title, before any copy is matched.
    nearest = copies.groupBy("title").agg(F.min("store_id").alias("title_store"))
    asked = hot_join(requests, nearest, ["title"])
    served = asked.groupBy("customer_id").agg(F.min("title_store").alias("store_id"))
    wanted = hot_join(requests, served, ["customer_id"]).select("title", "store_id", "customer_id")
    if share_copies:
        to_rent = copies.join(wanted, ["title", "store_id"])
    else:
        first = wanted.groupBy("title", "store_id").agg(F.min("customer_id").alias("customer_id"))
        to_rent = hot_join(copies, first, ["title", "store_id"])
    staff = t["staff"].groupBy("store_id").agg(F.min("staff_id").alias("staff_id"))
    rented_at = F.lit(rented_on).cast("date").cast("timestamp_ntz")
    to_rent = hot_join(to_rent, staff, ["store_id"], "left").select(
        "customer_id",
        "inventory_id",
        rented_at.alias("rental_date"),
        F.lit(returned_on).cast("date").cast("timestamp_ntz").alias("return_date"),
        "staff_id",
        day_literal(as_of).alias("last_update"),
    )
    rentals = insert_if_absent(t["rental"], to_rent, ["inventory_id", "customer_id", "rental_date"], "rental_id")

    def pay() -> Change:
        day = F.lit(rented_on).cast("date")
        of_that_day = rentals.state.where(within("rental_date", (day, F.date_add(day, 1))))
        due = checkpointed(
            in_keys(of_that_day, requests, ["customer_id"]).select("rental_id", "customer_id", "staff_id", "inventory_id")
        )
        # Only the copies of this batch are priced.
        priced = in_keys(t["inventory"].select("inventory_id", "film_id"), due, ["inventory_id"])
        rates = priced.join(t["film"].select("film_id", F.col("rental_rate").alias("amount")), "film_id")
        due = hot_join(due, rates.select("inventory_id", "amount"), ["inventory_id"])
        due = due.select("customer_id", "staff_id", "rental_id", "amount", rented_at.alias("payment_date"))
        return insert_if_absent(t["payment"], due, ["rental_id"], "payment_id")

    return RentAndPay(rentals, pay)


def bulk_load(spark: SparkSession, rows: int, prefix: str = LONG_PREFIX) -> DataFrame:
    """``rows`` synthetic strings: the prefix and a running number from 1."""
    return prefixed(spark.range(1, rows + 1), "id", prefix)


def prefixed(df: DataFrame, number: str, prefix: str = LONG_PREFIX) -> DataFrame:
    """The numbers of a column as synthetic strings."""
    return df.select(F.concat(F.lit(prefix), F.col(number).cast("string")).alias("col"))


def delete_every_nth(df: DataFrame, n: int = 3, prefix: str = LONG_PREFIX) -> Change:
    """Delete the strings whose number is a multiple of ``n``."""
    number = F.replace("col", F.lit(prefix), F.lit("")).cast("bigint")
    return delete_where(df, number % n == 0)
