"""Stock, held copies and customer balances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from reelhouse.functions import exact, late_days
from reelhouse.functions.periods import Day
from reelhouse.operators.numbering import number_rows

Tables = Mapping[str, DataFrame]


def _copies_out(t: Tables) -> DataFrame:
    """Copies with an open rental, each once."""
    return t["rental"].where(F.col("return_date").isNull()).select("inventory_id").distinct()


def _copies(t: Tables, film_id: int | None, store_id: int | None) -> DataFrame:
    copies = t["inventory"].select("inventory_id", "film_id", "store_id")
    if film_id is not None:
        copies = copies.where(F.col("film_id") == film_id)
    if store_id is not None:
        copies = copies.where(F.col("store_id") == store_id)
    return copies


def film_in_stock(t: Tables, film_id: int | None = None, store_id: int | None = None) -> DataFrame:
    """Copies that can be rented now, of all films and stores or of those given."""
    return _copies(t, film_id, store_id).join(_copies_out(t), "inventory_id", "left_anti")


def film_not_in_stock(t: Tables, film_id: int | None = None, store_id: int | None = None) -> DataFrame:
    """Copies that are out."""
    return _copies(t, film_id, store_id).join(_copies_out(t), "inventory_id", "left_semi")


def inventory_in_stock(t: Tables) -> DataFrame:
    """Every copy with a flag that tells whether it can be rented now."""
    out = _copies_out(t).withColumn("out", F.lit(True))
    return (
        _copies(t, None, None)
        .join(out, "inventory_id", "left")
        .select("inventory_id", "film_id", "store_id", F.col("out").isNull().alias("in_stock"))
    )


def inventory_held_by_customer(t: Tables, customer_id: int | None = None) -> DataFrame:
    """Copies rented and not returned, for every customer or for one."""
    held = t["rental"].where(F.col("return_date").isNull())
    if customer_id is not None:
        held = held.where(F.col("customer_id") == customer_id)
    return held.select("customer_id", "inventory_id", "rental_id", "rental_date")


def customer_balance(t: Tables, as_of: Day, late_fee_per_day: float) -> DataFrame:
    """What every customer owes at the end of ``as_of``: charges and late fees less payments.

    Rentals and payments after ``as_of`` are ignored. A rental still open then is
    charged, and is late for the days it is over its rental duration by then. Rentals and
    payments of nobody in ``customer`` are left out.
    """
    day = F.lit(as_of).cast("date")
    until = F.date_add(day, 1)
    terms = t["inventory"].select("inventory_id", "film_id").join(
        t["film"].select("film_id", "rental_rate", "rental_duration"), "film_id"
    )
    late = late_days(
        F.to_date("rental_date"), F.to_date("return_date"), F.col("rental_duration"), day
    )
    nothing = F.lit(None)
    rented = (
        t["rental"]
        .where((F.col("rental_date") < until) & F.col("customer_id").isNotNull())
        .select("customer_id", "inventory_id", "rental_date", "return_date")
        .join(terms, "inventory_id")
        .select("customer_id", F.col("rental_rate").alias("charge"), late.alias("days"), nothing.alias("paid"), F.lit(False).alias("known"))
    )
    paid = t["payment"].where((F.col("payment_date") < until) & F.col("customer_id").isNotNull())
    paid = paid.select("customer_id", nothing.alias("charge"), nothing.alias("days"), F.col("amount").alias("paid"), F.lit(False).alias("known"))
    customers = t["customer"].select("customer_id", *[nothing.alias(c) for c in ("charge", "days", "paid")], F.lit(True).alias("known"))
    # One stream of events, folded once: customers without any have a row of their own in it.
    folded = (
        rented.unionByName(paid)
        .unionByName(customers)
        .groupBy("customer_id")
        .agg(F.sum("charge").alias("charges"), F.sum("days").alias("days"), F.sum("paid").alias("payments"), F.bool_or("known").alias("known"))
        .where("known")
        .withColumn("late_fees", F.col("days") * exact(late_fee_per_day))
    )
    none = F.lit(0).cast("decimal(28,2)")
    amounts = [F.coalesce(c, none).cast("decimal(28,2)").alias(c) for c in ("charges", "late_fees", "payments")]
    return folded.select("customer_id", *amounts).withColumn(
        "balance", (F.col("charges") + F.col("late_fees") - F.col("payments")).cast("decimal(28,2)")
    )


def films_in_stock_by_title(t: Tables, pattern: str | None) -> DataFrame:
    """Numbered list of the films whose title matches ``pattern`` in any case and that have a copy in stock.

    When there is none the result is one row with a message.
    """
    # This message and the one below.
    if pattern is None:
        raise ValueError("Title pattern cannot be null")
    matching = t["film"].where(F.like(F.upper("title"), F.upper(F.lit(pattern)))).select("film_id", "title")
    copies = t["inventory"].select("inventory_id", "film_id").join(matching, "film_id", "left_semi")
    in_stock = copies.join(_copies_out(t), "inventory_id", "left_anti").select("film_id").distinct()
    films = matching.join(in_stock, "film_id", "left_semi")
    numbered = number_rows(films, ["title", "film_id"], unique=True).select("row_num", "film_id", "title")

    spark = numbered.sparkSession
    message = spark.range(1).select(
        F.lit(1).cast("long").alias("row_num"),
        F.lit(None).cast(numbered.schema["film_id"].dataType).alias("film_id"),
        F.format_string("No films found in stock for pattern: %s", F.lit(pattern)).alias("title"),
    )
    return numbered.unionByName(message.where(~numbered.exists()))
