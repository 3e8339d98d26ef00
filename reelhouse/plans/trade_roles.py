"""Role maps: which trade table and column plays film, rental, payment and so on.

A role map holds renaming projections, built when they are first asked for, so the operators run on the trade
tables as they are and Catalyst still prunes the columns an operator does not name.
Money is stored as doubles there and becomes ``decimal(18,2)``, which adds up exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.functions import moment
from reelhouse.sources.catalog import Catalog
from reelhouse.sources.schemas import TRADE


FIRST_YEAR = 1950  # a part's size becomes a film's release year after this one
OPEN_SINCE = "2001-07-01"  # lines not billed and shipped since then count as open rentals
TYPE_RATINGS = {"ECONOMY": "G", "SMALL": "PG", "MEDIUM": "PG-13", "STANDARD": "R", "LARGE": "NC-17"}


class Roles(Mapping[str, DataFrame]):
    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def but(self, **tables: DataFrame) -> Roles:
        """The same roles with some of them played by other tables."""
        return self.also({name: lambda df=df: df for name, df in tables.items()})

    def also(self, others: Roles | Mapping[str, Callable[[], DataFrame]]) -> Roles:
        builders = others._builders if isinstance(others, Roles) else others
        return Roles({**self._builders, **builders})


def trade(spark: SparkSession, root: str) -> Catalog:
    return Catalog(spark, root, TRADE, suffix=".parquet")


def renamed(column: str, role: str) -> Column:
    return F.col(column).alias(role)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def _first_last(name: str) -> tuple[Column, Column]:
    return F.split_part(name, F.lit("#"), F.lit(1)), F.split_part(name, F.lit("#"), F.lit(2))


def people(df: DataFrame, key: str, name: str, id_column: str, *others: Column) -> DataFrame:
    first, last = _first_last(name)
    return df.select(F.col(key).alias(id_column), first.alias("first_name"), last.alias("last_name"), *others)


def places(s: Catalog) -> Roles:
    """Nations as stores, addresses, cities and countries; the region is the second address line."""
    key = "n_nationkey"

    def address() -> DataFrame:
        address2 = F.when(F.col("r_name") != "AFRICA", F.col("r_name")).alias("address2")
        named = s["nation"].join(s["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        return named.select(renamed(key, "address_id"), renamed("n_name", "address"), address2, renamed(key, "city_id"))

    return Roles(
        {
            "store": lambda: s["nation"].select(renamed(key, "store_id"), renamed(key, "address_id")),
            "address": address,
            "city": lambda: s["nation"].select(renamed(key, "city_id"), renamed(key, "country_id")),
            "country": lambda: s["nation"].select(renamed(key, "country_id"), renamed("n_name", "country")),
        }
    )


def parties(s: Catalog) -> Roles:
    def customer() -> DataFrame:
        email = F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email")
        return people(s["customer"], "c_custkey", "c_name", "customer_id", email, renamed("c_nationkey", "address_id"))

    return Roles(
        {
            "customer": customer,
            "staff": lambda: people(s["supplier"], "s_suppkey", "s_name", "staff_id", renamed("s_nationkey", "store_id")),
        }
    )


def named_categories(df: DataFrame, column: str) -> DataFrame:
    """The values of a column as categories that are their own key."""
    return df.select(renamed(column, "category_id")).distinct().withColumn("name", F.col("category_id"))


def orders_as_rentals(s: Catalog) -> Roles:
    """An order rents a customer's copy, its lines are the payments, market segments are the categories."""

    def rental() -> DataFrame:
        returned = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
        return s["orders"].select(
            renamed("o_orderkey", "rental_id"),
            renamed("o_orderdate", "rental_date"),
            renamed("o_custkey", "inventory_id"),
            renamed("o_custkey", "customer_id"),
            returned.alias("return_date"),
            F.lit(None).cast("bigint").alias("staff_id"),
        )

    return places(s).also(parties(s)).also(
        {
            "payment": lambda: s["lineitem"].select(
                renamed("l_orderkey", "payment_id"),
                renamed("l_orderkey", "rental_id"),
                renamed("l_suppkey", "staff_id"),
                money("l_extendedprice").alias("amount"),
                renamed("l_shipdate", "payment_date"),
            ),
            "rental": rental,
            "inventory": lambda: s["customer"].select(
                renamed("c_custkey", "inventory_id"), renamed("c_custkey", "film_id"), renamed("c_nationkey", "store_id")
            ),
            "film": lambda: s["customer"].select(renamed("c_custkey", "film_id"), renamed("c_name", "title")),
            "film_category": lambda: s["customer"].select(renamed("c_custkey", "film_id"), renamed("c_mktsegment", "category_id")),
            "category": lambda: named_categories(s["customer"], "c_mktsegment"),
        }
    )


def lines_as_rentals(s: Catalog) -> Roles:
    """A part is a film with one copy, an order line rents it, suppliers are the actors, orders the payments."""

    def film() -> DataFrame:
        rating = F.create_map(*[F.lit(x) for pair in TYPE_RATINGS.items() for x in pair])[F.col("p_type")]
        return s["part"].select(
            renamed("p_partkey", "film_id"),
            renamed("p_name", "title"),
            (F.col("p_size") + FIRST_YEAR).alias("release_year"),
            money("p_retailprice").alias("rental_rate"),
            renamed("p_size", "rental_duration"),
            rating.alias("rating"),
        )

    def rental() -> DataFrame:
        still_open = (F.col("l_linestatus") == "O") & (F.col("l_shipdate") >= moment(OPEN_SINCE))
        return s["lineitem"].select(
            renamed("l_orderkey", "rental_id"),
            renamed("l_partkey", "inventory_id"),
            F.when(~still_open, F.col("l_shipdate")).alias("return_date"),
            renamed("l_suppkey", "staff_id"),
        )

    return places(s).also(parties(s)).also(
        {
            "film": film,
            "film_category": lambda: s["part"].select(renamed("p_partkey", "film_id"), renamed("p_type", "category_id")),
            "category": lambda: named_categories(s["part"], "p_type"),
            "film_actor": lambda: s["lineitem"].select(renamed("l_suppkey", "actor_id"), renamed("l_partkey", "film_id")),
            "actor": lambda: people(s["supplier"], "s_suppkey", "s_name", "actor_id"),
            "inventory": lambda: s["part"].select(
                renamed("p_partkey", "inventory_id"),
                renamed("p_partkey", "film_id"),
                (F.col("p_partkey") % 25).cast("int").alias("store_id"),
            ),
            "rental": rental,
            "payment": lambda: s["orders"].select(
                renamed("o_orderkey", "payment_id"),
                renamed("o_custkey", "customer_id"),
                renamed("o_orderkey", "rental_id"),
                money("o_totalprice").alias("amount"),
                renamed("o_orderdate", "payment_date"),
            ),
        }
    )


def lines_with_customers(s: Catalog) -> Roles:
    """``lines_as_rentals`` with the customer and date of each line's order."""
    lines = lines_as_rentals(s)

    def rental() -> DataFrame:
        orders = s["orders"].select(
            renamed("o_orderkey", "rental_id"), renamed("o_custkey", "customer_id"), renamed("o_orderdate", "rental_date")
        )
        return lines["rental"].join(orders, "rental_id")

    return lines.also({"rental": rental})


def customers_as_actors(s: Catalog, year: Column | None = None) -> Roles:
    """A customer acts in each of their orders; ``year`` is the release year of an order."""

    def film() -> DataFrame:
        released = F.year("o_orderdate") if year is None else year
        return s["orders"].select(renamed("o_orderkey", "film_id"), released.alias("release_year"))

    return Roles(
        {
            "actor": lambda: people(s["customer"], "c_custkey", "c_name", "actor_id"),
            "film": film,
            "film_actor": lambda: s["orders"].select(renamed("o_custkey", "actor_id"), renamed("o_orderkey", "film_id")),
        }
    )
