"""Data changes, integrity, access and storage on the trade tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.operators import access, change, footprint, integrity, movies, numbering, seeding
from reelhouse.plans import trade_roles as roles
from reelhouse.plans.registry import Registry, doubles
from reelhouse.sources import create_table_as, snapshots
from reelhouse.sources.catalog import ColumnGrant, RestrictedTables, RowPolicy
from reelhouse.sources.session import scratch_folder

registry = Registry()
query = registry.query

AS_OF = "2001-08-02"


# --- inserts -------------------------------------------------------------------------

_NAMES = """
people AS (
    SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name FROM customer),
candidates AS (
    SELECT first_name, last_name FROM people
    UNION ALL SELECT split_part(s_name, '#', 1), split_part(s_name, '#', 2) FROM supplier),
fresh AS (
    SELECT first_name, last_name FROM candidates c
    WHERE NOT EXISTS (SELECT 1 FROM people p WHERE p.first_name = c.first_name AND p.last_name = c.last_name)),
added AS (
    SELECT (SELECT MAX(id) FROM people) + row_number() OVER (ORDER BY first_name, last_name) AS id, first_name, last_name
    FROM fresh)"""


def _insert_people(spark: SparkSession, root: str) -> change.Change:
    """Customers are the actors on file; the batch names them all again, and the suppliers."""
    s = roles.trade(spark, root)
    actors = roles.people(s["customer"], "c_custkey", "c_name", "actor_id")
    batch = actors.drop("actor_id").unionByName(roles.people(s["supplier"], "s_suppkey", "s_name", "x").drop("x"))
    return change.insert_if_absent(actors, batch, ["first_name", "last_name"], "actor_id")


@query(f"WITH {_NAMES} SELECT id AS actor_id, first_name, last_name FROM people UNION ALL SELECT * FROM added")
def insert_if_absent(spark: SparkSession, root: str) -> DataFrame:
    return _insert_people(spark, root).state


@query(
    """
    SELECT o_custkey AS customer_id, o_orderpriority AS priority, MIN(o_orderkey) AS order_id FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING' AND o_orderpriority = '1-URGENT')
    GROUP BY o_custkey, o_orderpriority
    UNION ALL SELECT c_custkey, '1-URGENT', CAST(NULL AS BIGINT) FROM customer WHERE c_mktsegment = 'BUILDING'"""
)
def insert_if_absent_once(spark: SparkSession, root: str) -> DataFrame:
    """One row for each customer and priority out of all orders; some customers have their urgent one already."""
    s = roles.trade(spark, root)
    urgent = s["customer"].where(F.col("c_mktsegment") == "BUILDING").select(
        F.col("c_custkey").alias("customer_id"), F.lit("1-URGENT").alias("priority"), F.lit(None).cast("bigint").alias("order_id")
    )
    batch = s["orders"].select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("order_id")
    )
    return change.insert_if_absent(urgent, batch, ["customer_id", "priority"], once_per_key=True).state


@query(f"WITH {_NAMES} SELECT id AS actor_id, first_name, last_name FROM added")
def insert_if_absent_returning(spark: SparkSession, root: str) -> DataFrame:
    return _insert_people(spark, root).returning


@query(
    """
    SELECT o_custkey AS actor_id, o_orderkey AS film_id,
           CASE WHEN o_orderstatus = 'F' THEN '1995-01-01' ELSE '2001-08-02' END AS last_update
    FROM orders"""
)
def link_film_actors(spark: SparkSession, root: str) -> DataFrame:
    """Finished orders are linked already; the batch names the customer of every order."""
    s = roles.trade(spark, root)
    orders = s["orders"]
    title = F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title")
    year = F.year("o_orderdate").alias("release_year")
    t = {
        "film": orders.select(F.col("o_orderkey").alias("film_id"), title, year),
        "actor": roles.people(s["customer"], "c_custkey", "c_name", "actor_id"),
        "film_actor": orders.where(F.col("o_orderstatus") == "F").select(
            F.col("o_custkey").alias("actor_id"), F.col("o_orderkey").alias("film_id"), F.lit("1995-01-01").cast("date").alias("last_update")
        ),
    }
    pairs = orders.select(
        title, year, F.lit("Customer").alias("first_name"), F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("last_name")
    )
    return change.link_film_actors(t, pairs, AS_OF).state.withColumn("last_update", F.col("last_update").cast("string"))


@query(
    """
    WITH held AS (
        SELECT MIN(p_partkey) AS inventory_id, p_brand, p_size, CAST(0 AS INTEGER) AS store_id FROM part
        WHERE p_type = 'PROMO' GROUP BY p_brand, p_size),
    films AS (SELECT p_brand, p_size, MIN(p_partkey) AS film_id FROM part GROUP BY p_brand, p_size),
    stocked AS (SELECT inventory_id, film_id, store_id FROM held JOIN films USING (p_brand, p_size)),
    fresh AS (SELECT film_id FROM films WHERE film_id NOT IN (SELECT film_id FROM stocked))
    SELECT inventory_id, film_id, store_id, '1995-01-01' AS last_update FROM stocked
    UNION ALL
    SELECT (SELECT MAX(inventory_id) FROM stocked) + row_number() OVER (ORDER BY film_id), film_id, CAST(0 AS INTEGER), '2001-08-02'
    FROM fresh"""
)
def stock_films(spark: SparkSession, root: str) -> DataFrame:
    """A brand and size is a film; those with a promotional part are stocked already."""
    s = roles.trade(spark, root)
    title, year = F.col("p_brand").alias("title"), F.col("p_size").alias("release_year")
    films = s["part"].groupBy(title, year).agg(F.min("p_partkey").alias("film_id"))
    promo = s["part"].where(F.col("p_type") == "PROMO").groupBy(title, year).agg(F.min("p_partkey").alias("inventory_id"))
    inventory = promo.join(films, ["title", "release_year"]).select(
        "inventory_id", "film_id", F.lit(0).alias("store_id"), F.lit("1995-01-01").cast("date").alias("last_update")
    )
    t = {"film": films, "inventory": inventory, "store": roles.places(s)["store"]}
    wanted = s["part"].select(title, year).distinct()
    return change.stock_films(t, wanted, AS_OF).state.withColumn("last_update", F.col("last_update").cast("string"))


_MOVIES = """
films AS (
    SELECT p_partkey AS film_id, p_name || ' ' || p_brand AS title, p_size AS release_year, CAST(p_size % 5 AS INTEGER) AS language_id
    FROM part WHERE p_type IN ('ECONOMY', 'PROMO')),
tried AS (
    SELECT p_partkey AS row_id, CASE WHEN p_size <> 50 THEN upper(p_name || ' ' || p_brand) END AS title,
           p_size AS release_year,
           CASE WHEN p_type = 'LARGE' THEN 'Elvish' ELSE COALESCE(lower(r_name), 'Klingon') END AS language, r_regionkey
    FROM part LEFT JOIN region ON r_regionkey = p_size % 5),
known AS (
    SELECT tried.*, CASE WHEN language <> 'Elvish' THEN r_regionkey END AS language_id FROM tried),
judged AS (
    SELECT *, row_number() OVER (PARTITION BY title, language_id, release_year ORDER BY row_id) AS place,
           EXISTS (SELECT 1 FROM films f WHERE upper(f.title) = known.title AND f.language_id = known.language_id
                   AND f.release_year = known.release_year) AS present
    FROM known),
reasons AS (
    SELECT *, CASE WHEN title IS NULL THEN 'Movie title cannot be null'
                   WHEN language_id IS NULL THEN 'Language "' || language || '" does not exist'
                   WHEN present OR place > 1 THEN 'Film "' || title || '" (' || language || ' / ' || release_year || ') already exists'
              END AS reason
    FROM judged)"""


def _movie_batch(spark: SparkSession, root: str) -> movies.MovieBatch:
    s = roles.trade(spark, root)
    part = s["part"]
    title = F.concat_ws(" ", "p_name", "p_brand")
    language_id = (F.col("p_size") % 5).cast("int")
    language = s["region"].select(F.col("r_regionkey").alias("language_id"), F.col("r_name").alias("name"))
    films = part.where(F.col("p_type").isin("ECONOMY", "PROMO")).select(
        F.col("p_partkey").alias("film_id"),
        title.alias("title"),
        F.col("p_size").alias("release_year"),
        language_id.alias("language_id"),
        F.lit(3).alias("rental_duration"),
        F.lit(None).cast("decimal(4,2)").alias("rental_rate"),
        F.lit(None).cast("decimal(5,2)").alias("replacement_cost"),
    )
    batch = part.join(language, F.col("language_id") == language_id, "left").select(
        F.col("p_partkey").alias("row_id"),
        F.when(F.col("p_size") != 50, F.upper(title)).alias("title"),
        F.col("p_size").alias("release_year"),
        F.when(F.col("p_type") == "LARGE", F.lit("Elvish")).otherwise(F.lower("name")).alias("language"),
    )
    return movies.add_movies({"film": films, "language": language}, batch)


@query(
    f"""
    WITH {_MOVIES}
    SELECT film_id, title, release_year, language_id, CAST(NULL AS DOUBLE) AS rental_rate, CAST(NULL AS DOUBLE) AS replacement_cost
    FROM films
    UNION ALL
    SELECT (SELECT MAX(film_id) FROM films) + row_number() OVER (ORDER BY row_id), title, release_year, language_id, 4.99, 19.99
    FROM reasons WHERE reason IS NULL"""
)
def add_movies(spark: SparkSession, root: str) -> DataFrame:
    state = _movie_batch(spark, root).state.drop("rental_duration")
    return doubles(state, "rental_rate", "replacement_cost")


@query(f"WITH {_MOVIES} SELECT row_id, title, release_year, language, reason FROM reasons WHERE reason IS NOT NULL")
def add_movies_rejected(spark: SparkSession, root: str) -> DataFrame:
    return _movie_batch(spark, root).rejected


@query(
    """
    SELECT (SELECT MAX(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS new_key, o_orderkey
    FROM orders"""
)
def assign_keys(spark: SparkSession, root: str) -> DataFrame:
    orders = roles.trade(spark, root)["orders"]
    taken = orders.select(F.col("o_orderkey").alias("new_key"))
    rows = orders.select("o_orderdate", "o_orderkey")
    return numbering.assign_keys(rows, taken, "new_key", ["o_orderdate", "o_orderkey"]).select("new_key", "o_orderkey")


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY l_shipdate DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS BIGINT) AS row_num,
           l_orderkey, l_partkey, l_suppkey, l_linenumber
    FROM lineitem"""
)
def number_rows(spark: SparkSession, root: str) -> DataFrame:
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = roles.trade(spark, root)["lineitem"].select("l_shipdate", *keys)
    return numbering.number_rows(lines, [F.col("l_shipdate").desc(), *keys]).select("row_num", *keys)


@query(
    """
    WITH tried AS (
        SELECT s_suppkey - 1000000000 AS row_id, s_name AS location_name, s_nationkey AS city_id FROM supplier
        UNION ALL
        SELECT o_orderkey, c_name, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey),
    fresh AS (
        SELECT MIN(row_id) AS row_id, location_name, city_id FROM tried t
        WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_name = location_name AND s_nationkey = city_id)
        GROUP BY location_name, city_id)
    SELECT s_suppkey AS location_id, s_name AS location_name, s_nationkey AS city_id FROM supplier
    UNION ALL
    SELECT (SELECT MAX(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY row_id), location_name, city_id FROM fresh"""
)
def insert_or_skip(spark: SparkSession, root: str) -> DataFrame:
    """Suppliers are locations; the batch names them again, and the customer of every order with the city in words."""
    s = roles.trade(spark, root)
    locations = s["supplier"].select(
        F.col("s_suppkey").alias("location_id"), F.col("s_name").alias("location_name"), F.col("s_nationkey").alias("city_id")
    )
    named = s["nation"].select(F.col("n_nationkey").alias("nation"), F.lower("n_name").alias("city"))
    again = locations.join(named, F.col("city_id") == F.col("nation")).select(
        (F.col("location_id") - 1_000_000_000).alias("row_id"), "location_name", "city"
    )
    ordering = (
        s["orders"]
        .join(s["customer"], F.col("o_custkey") == F.col("c_custkey"))
        .join(named, F.col("c_nationkey") == F.col("nation"))
        .select(F.col("o_orderkey").alias("row_id"), F.col("c_name").alias("location_name"), "city")
    )
    batch = integrity.scalar_lookup(again.unionByName(ordering), s["nation"], "city", "n_name", "n_nationkey", "city_id")
    return seeding.insert_or_skip(locations, batch, [["location_name", "city_id"]], "location_id").state


@query(
    """
    WITH RECURSIVE entries AS (
        SELECT l_orderkey AS a, l_partkey AS i, l_linenumber AS d,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS n
        FROM lineitem),
    steps AS (
        SELECT o_orderkey AS a, 0::BIGINT AS n, [o_custkey] AS items, [1] AS places FROM orders
        UNION ALL
        SELECT s.a, e.n,
               CASE WHEN list_contains(items, i) OR list_contains(places, d) THEN items ELSE list_append(items, i) END,
               CASE WHEN list_contains(items, i) OR list_contains(places, d) THEN places ELSE list_append(places, d) END
        FROM steps s JOIN entries e ON e.a = s.a AND e.n = s.n + 1),
    done AS (SELECT a, arg_max(items, n) AS items, arg_max(places, n) AS places FROM steps GROUP BY a)
    SELECT a AS auction_id, unnest(items) AS item_id, unnest(places) AS display_order FROM done"""
)
def insert_or_skip_two_keys(spark: SparkSession, root: str) -> DataFrame:
    """Lines as catalogue entries, unique per (order, part) and per (order, line number), tried in date order.

    Each order has an entry already, in the first place and for an item with the customer's number.
    """
    s = roles.trade(spark, root)
    entries = s["orders"].select(
        F.col("o_orderkey").alias("auction_id"), F.col("o_custkey").alias("item_id"), F.lit(1).alias("display_order")
    )
    keys = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    tried = numbering.number_rows(s["lineitem"].select(*keys), keys, name="row_id").select(
        "row_id",
        F.col("l_orderkey").alias("auction_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_linenumber").alias("display_order"),
    )
    unique = [["auction_id", "item_id"], ["auction_id", "display_order"]]
    return seeding.insert_or_skip(entries, tried, unique).state


# --- updates -------------------------------------------------------------------------

_HEAVY = """
heavy AS (
    SELECT MIN(c_custkey) AS id FROM customer
    WHERE (SELECT COUNT(*) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey = c_custkey) >= 43
      AND (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) >= 12)"""
_NEW_NAME = {"first_name": "Heavy", "last_name": "Renter", "email": "heavy.renter@example.com"}


@query(
    f"""
    WITH {_HEAVY}
    SELECT c_custkey AS customer_id,
           CASE WHEN c_custkey = id THEN 'Heavy' ELSE split_part(c_name, '#', 1) END AS first_name,
           CASE WHEN c_custkey = id THEN 'Renter' ELSE split_part(c_name, '#', 2) END AS last_name,
           CASE WHEN c_custkey = id THEN 'heavy.renter@example.com' ELSE lower(c_name) || '@example.com' END AS email,
           CASE WHEN c_custkey = id THEN '2001-08-02' ELSE '1995-01-01' END AS last_update
    FROM customer, heavy"""
)
def rename_heavy_customer(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_with_customers(roles.trade(spark, root))
    customer = t["customer"].drop("address_id").withColumn("last_update", F.lit("1995-01-01").cast("date"))
    t = t.but(customer=customer)
    state = change.rename_heavy_customer(t, 43, 12, _NEW_NAME, AS_OF).state
    return state.withColumn("last_update", F.col("last_update").cast("string"))


@query(
    """
    SELECT c_custkey AS customer_id FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey HAVING COUNT(*) >= 43)
      AND c_custkey IN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 12)"""
)
def heavy_customers(spark: SparkSession, root: str) -> DataFrame:
    return change.heavy_customers(roles.lines_with_customers(roles.trade(spark, root)), 43, 12, first_only=False)


@query(
    """
    WITH latest AS (
        SELECT o_custkey, MAX(o_orderkey) AS id, MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS price FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS customer_id, c_mktsegment AS segment, CAST(COALESCE(price, CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM customer LEFT JOIN latest ON o_custkey = c_custkey"""
)
def update_from(spark: SparkSession, root: str) -> DataFrame:
    """Every customer's balance is overwritten with the largest of their order totals."""
    s = roles.trade(spark, root)
    target = s["customer"].select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), roles.money("c_acctbal").alias("amount")
    )
    totals = s["orders"].select(F.col("o_custkey").alias("customer_id"), roles.money("o_totalprice").alias("amount"))
    return doubles(change.update_from(target, totals, ["customer_id"]).state, "amount")


@query(
    """
    WITH renters AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY'),
    opened AS (
        SELECT (SELECT MAX(o_orderkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS rental_id,
               c_custkey AS customer_id, (SELECT MIN(c_custkey) FROM customer) AS inventory_id, '2001-08-02 10:00' AS rental_date,
               CAST(NULL AS VARCHAR) AS return_date, (SELECT MIN(s_suppkey) FROM supplier) AS staff_id
        FROM renters)
    SELECT o_orderkey AS rental_id, o_custkey AS customer_id, o_custkey AS inventory_id,
           strftime(o_orderdate, '%Y-%m-%d %H:%M') AS rental_date,
           CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS return_date,
           CAST(NULL AS BIGINT) AS staff_id
    FROM orders
    UNION ALL
    SELECT rental_id, customer_id, inventory_id, rental_date,
           CASE WHEN c_acctbal > 0 THEN '2001-08-03 18:30' ELSE return_date END, staff_id
    FROM opened JOIN customer ON c_custkey = customer_id"""
)
def open_and_return_rental(spark: SparkSession, root: str) -> DataFrame:
    """Customers of one segment open a rental; those in credit return their latest one."""
    s = roles.trade(spark, root)
    t = roles.orders_as_rentals(s)
    renters = s["customer"].where(F.col("c_mktsegment") == "MACHINERY").withColumnRenamed("c_custkey", "customer_id")
    opened = change.open_rental(t, renters.select("customer_id"), "2001-08-02 10:00")
    returning = renters.where(F.col("c_acctbal") > 0).select("customer_id")
    state = change.return_latest_rental(t.but(rental=opened.state), returning, "2001-08-03 18:30").state
    shown = "yyyy-MM-dd HH:mm"
    return state.select(
        "rental_id", "customer_id", "inventory_id", "staff_id",
        F.date_format("rental_date", shown).alias("rental_date"), F.date_format("return_date", shown).alias("return_date"),
    )


# --- deletes -------------------------------------------------------------------------

_LEAVING = "SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'"


def _remove(spark: SparkSession, root: str) -> tuple[roles.Roles, DataFrame, dict[str, change.Change]]:
    s = roles.trade(spark, root)
    t = roles.orders_as_rentals(s)
    payment = s["lineitem"].select(
        F.col("l_orderkey").alias("rental_id"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("amount")
    )
    t = t.but(payment=payment)
    leaving = s["customer"].where(F.col("c_mktsegment") == "HOUSEHOLD").select(F.col("c_custkey").alias("customer_id"))
    return t, leaving, change.remove_activity(t, leaving)


@query(
    f"""
    SELECT l_orderkey AS rental_id, l_linenumber AS line, l_extendedprice AS amount
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({_LEAVING}))"""
)
def remove_activity_payments(spark: SparkSession, root: str) -> DataFrame:
    return _remove(spark, root)[2]["payment"].state


@query(
    f"""
    SELECT l_orderkey AS rental_id, l_linenumber AS line, l_extendedprice AS amount
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({_LEAVING}))"""
)
def remove_activity_returning(spark: SparkSession, root: str) -> DataFrame:
    return _remove(spark, root)[2]["payment"].returning


@query(f"SELECT o_orderkey AS rental_id, o_custkey AS customer_id FROM orders WHERE o_custkey NOT IN ({_LEAVING})")
def remove_activity_rentals(spark: SparkSession, root: str) -> DataFrame:
    return _remove(spark, root)[2]["rental"].state.select("rental_id", "customer_id")


@query(
    f"""
    SELECT c_custkey AS customer_id, CAST(COUNT(o_orderkey) FILTER (c_mktsegment <> 'HOUSEHOLD') AS BIGINT) AS rentals,
           CAST(COUNT(o_orderkey) AS BIGINT) AS payments
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey"""
)
def activity_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rentals left per customer after a delete, with their orders as untouched payments."""
    t, _, changes = _remove(spark, root)
    payments = roles.lines_as_rentals(roles.trade(spark, root))["payment"]
    return change.activity_counts({"rental": changes["rental"].state, "payment": payments}, t["customer"])


_LOADED = "SELECT 'veeeeeeery_long_string' || (l_orderkey * 8 + l_linenumber) AS col, l_orderkey * 8 + l_linenumber AS n FROM lineitem"


def _loaded(spark: SparkSession, root: str) -> DataFrame:
    lines = roles.trade(spark, root)["lineitem"]
    return change.prefixed(lines.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("n")), "n")


@query(f"SELECT col FROM ({_LOADED}) WHERE n % 3 <> 0")
def delete_every_third(spark: SparkSession, root: str) -> DataFrame:
    return change.delete_every_nth(_loaded(spark, root)).state


@query(f"SELECT col FROM ({_LOADED}) WHERE n % 3 = 0")
def delete_every_third_returning(spark: SparkSession, root: str) -> DataFrame:
    return change.delete_every_nth(_loaded(spark, root)).returning


@query("SELECT 'veeeeeeery_long_string' || i AS col FROM range(1, (SELECT COUNT(*) + 1 FROM lineitem)) AS r(i)")
def bulk_load(spark: SparkSession, root: str) -> DataFrame:
    """As many strings as there are lines, written as a table and read back."""
    rows = roles.trade(spark, root)["lineitem"].count()
    return create_table_as(change.bulk_load(spark, rows), scratch_folder(spark, "bulk-load"))


# --- changes that write the touched files only -----------------------------------------


def _lines_by_order(spark: SparkSession, root: str) -> snapshots.Snapshot:
    lines = roles.trade(spark, root)["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    return snapshots.create_snapshot(lines, scratch_folder(spark, "lines"), ["l_orderkey"])


def _first_orders(spark: SparkSession, root: str) -> DataFrame:
    """Orders of the first day."""
    orders = roles.trade(spark, root)["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("day"))
    return orders.where(F.col("day") == orders.agg(F.min("day")).scalar()).select("l_orderkey")


_FIRST_ORDERS = "(SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders))"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey NOT IN {_FIRST_ORDERS}")
def delete_in_touched_files(spark: SparkSession, root: str) -> DataFrame:
    """The lines left when those of the first day's orders are deleted from the files that hold them."""
    state, gone = _lines_by_order(spark, root), _first_orders(spark, root)
    done = snapshots.rewrite(state, scratch_folder(spark, "lines"), lambda t: change.delete_matching(t, gone, ["l_orderkey"]), gone, ["l_orderkey"])
    return done.state.table()


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
           CASE WHEN l_orderkey IN {_FIRST_ORDERS} THEN 'X' ELSE l_returnflag END AS l_returnflag
    FROM lineitem"""
)
def update_in_touched_files(spark: SparkSession, root: str) -> DataFrame:
    state = _lines_by_order(spark, root)
    marked = _first_orders(spark, root).withColumn("l_returnflag", F.lit("X"))
    done = snapshots.rewrite(state, scratch_folder(spark, "lines"), lambda t: change.update_from(t, marked, ["l_orderkey"]), marked, ["l_orderkey"])
    return done.state.table()


@query()
def rewrite_footprint(spark: SparkSession, root: str) -> DataFrame:
    """Files, rows and bytes before and after the delete, and of the files it leaves dead; SQL knows no files."""
    state, gone = _lines_by_order(spark, root), _first_orders(spark, root)
    done = snapshots.rewrite(state, scratch_folder(spark, "lines"), lambda t: change.delete_matching(t, gone, ["l_orderkey"]), gone, ["l_orderkey"])
    return footprint.rewrite_footprint(spark, state.paths(), done.state.paths())


# --- rent and pay --------------------------------------------------------------------

_RENT = """
copies AS (
    SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type, p_size) AS title,
           CAST(p_partkey % 25 AS INTEGER) AS store_id, p_retailprice FROM part),
requests AS (
    SELECT DISTINCT o_custkey, title
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN copies ON p_partkey = l_partkey),
served AS (SELECT o_custkey, MIN(store_id) AS store_id FROM requests JOIN copies USING (title) GROUP BY o_custkey),
staff AS (SELECT s_nationkey AS store_id, MIN(s_suppkey) AS staff_id FROM supplier GROUP BY s_nationkey),
owner AS (SELECT title, store_id, MIN(o_custkey) AS o_custkey FROM requests JOIN served USING (o_custkey) GROUP BY title, store_id),
rented AS (
    SELECT (SELECT MAX(o_orderkey) FROM orders) + row_number() OVER (ORDER BY p_partkey, o_custkey) AS rental_id,
           o_custkey AS customer_id, p_partkey AS inventory_id, staff_id, p_retailprice AS amount
    FROM owner JOIN copies USING (title, store_id) LEFT JOIN staff USING (store_id))"""


def _rent(spark: SparkSession, root: str) -> dict[str, change.Change]:
    """Everybody asks once more for everything they ordered."""
    s = roles.trade(spark, root)
    t = roles.lines_with_customers(s)
    film = s["part"].select(
        F.col("p_partkey").alias("film_id"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type", F.col("p_size").cast("string")).alias("title"),
        roles.money("p_retailprice").alias("rental_rate"),
    )
    t = t.but(film=film)
    requests = t["rental"].join(t["inventory"], "inventory_id").join(t["film"], "film_id").select("customer_id", "title")
    t = t.but(rental=roles.orders_as_rentals(s)["rental"])
    return change.rent_and_pay(t, requests, "2001-09-01", "2001-09-03", AS_OF)


@query(f"WITH {_RENT} SELECT rental_id, customer_id, inventory_id, staff_id FROM rented")
def rent_copies(spark: SparkSession, root: str) -> DataFrame:
    return _rent(spark, root)["rental"].returning.select("rental_id", "customer_id", "inventory_id", "staff_id")


@query(
    f"""
    WITH {_RENT}
    SELECT (SELECT MAX(o_orderkey) FROM orders) + row_number() OVER (ORDER BY rental_id) AS payment_id,
           customer_id, rental_id, amount, '2001-09-01' AS payment_date
    FROM rented"""
)
def pay_rentals(spark: SparkSession, root: str) -> DataFrame:
    paid = _rent(spark, root)["payment"].returning
    return doubles(paid, "amount").withColumn("payment_date", F.date_format("payment_date", "yyyy-MM-dd"))


# --- integrity -----------------------------------------------------------------------


def _line_checks():
    return {
        **integrity.not_null("l_orderkey", "l_partkey"),
        "discount below 0.1": F.col("l_discount") < 0.1,
        "shipped after 1995-01-31": integrity.after("l_shipdate", "1995-01-31"),
        "price at least 1000": F.col("l_extendedprice") >= 1000,
        "flag allowed": F.col("l_returnflag").isin("A", "N"),
        "tax null or positive": F.col("l_tax").isNull() | (F.col("l_tax") > 0),
    }


_BROKEN = {
    "l_orderkey not null": "l_orderkey IS NULL",
    "l_partkey not null": "l_partkey IS NULL",
    "discount below 0.1": "l_discount >= 0.1",
    "shipped after 1995-01-31": "l_shipdate <= TIMESTAMP '1995-01-31'",
    "price at least 1000": "l_extendedprice < 1000",
    "flag allowed": "l_returnflag NOT IN ('A', 'N')",
    "tax null or positive": "l_tax <= 0",
}


@query(" UNION ALL ".join(f"SELECT '{n}' AS rule, COUNT(*) FILTER ({c}) AS violations FROM lineitem" for n, c in _BROKEN.items()))
def violation_counts(spark: SparkSession, root: str) -> DataFrame:
    return integrity.violation_counts(roles.trade(spark, root)["lineitem"], _line_checks())


_BROKEN_LIST = "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _BROKEN.items()) + ")"


@query(
    f"""
    SELECT * FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, {_BROKEN_LIST} AS violations FROM lineitem)
    WHERE violations <> ''"""
)
def violating_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = integrity.violating_rows(roles.trade(spark, root)["lineitem"], _line_checks())
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice", F.array_join("violations", ", ").alias("violations"))


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def duplicate_keys(spark: SparkSession, root: str) -> DataFrame:
    return integrity.duplicate_keys(roles.trade(spark, root)["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT o_orderkey, COUNT(*) AS n_rows FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey"""
)
def orphan_keys(spark: SparkSession, root: str) -> DataFrame:
    """Orders as references to their lines, which some do not have."""
    s = roles.trade(spark, root)
    return integrity.orphan_keys(s["orders"], ["o_orderkey"], s["lineitem"], ["l_orderkey"])


@query(
    """
    SELECT 'lineitem' AS "table", 'price' AS "constraint", COUNT(*) FILTER (l_extendedprice < 1000) AS violations FROM lineitem
    UNION ALL
    SELECT 'lineitem', 'line key', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
    UNION ALL
    SELECT 'lineitem', 'line order', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL
    SELECT 'orders', 'order key', COUNT(*) - COUNT(DISTINCT o_orderkey) FROM orders
    UNION ALL
    SELECT 'orders', 'order customer', COUNT(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"""
)
def audit_tables(spark: SparkSession, root: str) -> DataFrame:
    rules = {
        "lineitem": integrity.Rules(
            checks={"price": F.col("l_extendedprice") >= 1000},
            keys={"line key": integrity.Unique(("l_orderkey", "l_linenumber"))},
            references={"line order": integrity.ForeignKey(("l_orderkey",), "orders", ("o_orderkey",))},
        ),
        "orders": integrity.Rules(
            checks={},
            keys={"order key": integrity.Unique(("o_orderkey",), primary=True)},
            references={"order customer": integrity.ForeignKey(("o_custkey",), "customer", ("c_custkey",))},
        ),
    }
    return integrity.audit_tables(roles.trade(spark, root), rules)


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows, COUNT(*) AS dated, '2001-08-02' AS earliest, '2001-08-02' AS latest FROM {t}"
        for t in _TABLES
    )
)
def add_record_date(spark: SparkSession, root: str) -> DataFrame:
    """Every table gets the day; asking again with another day changes none."""
    dated = integrity.add_record_date(roles.trade(spark, root), AS_OF)
    again = integrity.add_record_date(dated, "2024-01-01")
    counts = [
        df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("record_ts").alias("dated"),
            F.min("record_ts").cast("string").alias("earliest"),
            F.max("record_ts").cast("string").alias("latest"),
        ).withColumn("table_name", F.lit(name))
        for name, df in again.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- access and storage --------------------------------------------------------------

CLIENT = "segment_client"


def _as_client(spark: SparkSession, root: str) -> RestrictedTables:
    """A principal that sees one segment's customers, their orders, and the lines of those orders."""
    s = roles.trade(spark, root)
    own = s["customer"].where(F.col("c_mktsegment") == "BUILDING")
    own_orders = s["orders"].join(own.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi")
    policies = [
        RowPolicy("customer", CLIENT, condition=F.col("c_mktsegment") == "BUILDING"),
        RowPolicy("orders", CLIENT, keys=own.select(F.col("c_custkey").alias("o_custkey")), on=("o_custkey",)),
        RowPolicy("lineitem", CLIENT, keys=own_orders.select(F.col("o_orderkey").alias("l_orderkey")), on=("l_orderkey",)),
        RowPolicy("lineitem", CLIENT, condition=F.col("l_returnflag") == "R"),
    ]
    grants = [
        ColumnGrant("customer", CLIENT, ("c_custkey", "c_name")),
        ColumnGrant("orders", CLIENT, ("o_orderkey", "o_custkey", "o_orderstatus")),
        ColumnGrant("lineitem", CLIENT, ("l_orderkey", "l_linenumber", "l_extendedprice")),
        ColumnGrant("supplier", CLIENT),
    ]
    return RestrictedTables(s, CLIENT, policies, grants, {"customer", "orders", "lineitem", "supplier"})


_OWN = "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def visible_customers(spark: SparkSession, root: str) -> DataFrame:
    return _as_client(spark, root)["customer"]


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN {_OWN}")
def visible_orders(spark: SparkSession, root: str) -> DataFrame:
    return _as_client(spark, root)["orders"]


@query(
    f"""
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_returnflag = 'R' OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN {_OWN})"""
)
def visible_lines(spark: SparkSession, root: str) -> DataFrame:
    return _as_client(spark, root)["lineitem"]


@query(
    f"""
    SELECT 'customer' AS table_name, COUNT(*) FILTER (c_mktsegment = 'BUILDING') AS visible FROM customer
    UNION ALL SELECT 'orders', COUNT(*) FROM orders WHERE o_custkey IN {_OWN}
    UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
              WHERE l_returnflag = 'R' OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN {_OWN})
    UNION ALL SELECT 'supplier', 0"""
)
def visible_row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows that each secured table shows; the one with a grant but no policy shows none."""
    t = _as_client(spark, root)
    counts = [t[n].agg(F.count(F.lit(1)).alias("visible")).withColumn("table_name", F.lit(n)) for n in ("customer", "orders", "lineitem", "supplier")]
    return reduce(DataFrame.unionByName, counts)


def _grants(spark: SparkSession, root: str) -> DataFrame:
    """What users did to tables, read as what they were granted."""
    return roles.trade(spark, root)["events"].select(
        F.when(F.col("event_type") == "error", F.lit("audit")).otherwise(F.lit("public")).alias("table_schema"),
        F.concat(F.lit("table_"), (F.floor(F.col("value")) % 7).cast("string")).alias("table_name"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("grantee"),
        F.upper("event_type").alias("privilege_type"),
    ).distinct()


_GRANTS = """
    SELECT DISTINCT 'public' AS table_schema, 'table_' || CAST(floor(value) % 7 AS BIGINT) AS table_name,
           'user_' || user_id AS grantee, upper(event_type) AS privilege_type
    FROM events WHERE event_type <> 'error'"""


@query(_GRANTS)
def table_privileges(spark: SparkSession, root: str) -> DataFrame:
    return access.table_privileges(_grants(spark, root), "public")


@query(f"SELECT * FROM ({_GRANTS}) WHERE table_name = 'table_3'")
def table_privileges_of_one(spark: SparkSession, root: str) -> DataFrame:
    return access.table_privileges(_grants(spark, root), "public", "table_3")


@query(
    """
    SELECT DISTINCT c_mktsegment AS role_name, c_name AS member_name
    FROM customer JOIN orders ON o_custkey = c_custkey"""
)
def role_memberships(spark: SparkSession, root: str) -> DataFrame:
    s = roles.trade(spark, root)
    ordering = s["orders"].select(F.col("o_custkey").alias("c_custkey"))
    members = s["customer"].join(ordering, "c_custkey", "left_semi")
    return access.role_memberships(members.select(F.col("c_mktsegment").alias("role_name"), F.col("c_name").alias("member_name")))


@query(
    """
    SELECT 'user_' || user_id AS rolname, bool_or(event_type = 'error') AS rolsuper, bool_or(event_type = 'signup') AS rolcreaterole,
           bool_or(event_type = 'purchase') AS rolcreatedb, bool_or(event_type = 'view') AS rolcanlogin, COUNT(*) AS rolconnlimit
    FROM events GROUP BY user_id"""
)
def role_flags(spark: SparkSession, root: str) -> DataFrame:
    """Users of the event log, flagged by the kinds of event they caused."""
    did = {kind: F.bool_or(F.col("event_type") == kind) for kind in ("error", "signup", "purchase", "view")}
    roles_seen = roles.trade(spark, root)["events"].groupBy(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("rolname")).agg(
        did["error"].alias("rolsuper"),
        did["signup"].alias("rolcreaterole"),
        did["purchase"].alias("rolcreatedb"),
        did["view"].alias("rolcanlogin"),
        F.count(F.lit(1)).alias("rolconnlimit"),
    )
    return access.role_flags(roles_seen)


@query("SELECT 'public' AS schemaname, p_brand || ' ' || p_type AS tablename, bool_or(p_size = 50) AS rowsecurity FROM part GROUP BY p_brand, p_type")
def row_security_flags(spark: SparkSession, root: str) -> DataFrame:
    tables = roles.trade(spark, root)["part"].groupBy("p_brand", "p_type").agg(F.bool_or(F.col("p_size") == 50).alias("rowsecurity"))
    named = tables.select(F.lit("public").alias("schemaname"), F.concat_ws(" ", "p_brand", "p_type").alias("tablename"), "rowsecurity")
    return access.row_security_flags(named, "public")


@query(
    """
    SELECT 'public' AS schemaname, 'orders' AS tablename, 'customer_' || c_custkey AS policyname, lower(c_mktsegment) AS roles,
           'SELECT' AS cmd, '(o_custkey = ' || c_custkey || ')' AS qual, CAST(NULL AS VARCHAR) AS with_check
    FROM customer"""
)
def row_policies(spark: SparkSession, root: str) -> DataFrame:
    """One policy per customer on their own orders."""
    key = F.col("c_custkey").cast("string")
    policies = roles.trade(spark, root)["customer"].select(
        F.lit("public").alias("schemaname"),
        F.lit("orders").alias("tablename"),
        F.concat(F.lit("customer_"), key).alias("policyname"),
        F.lower("c_mktsegment").alias("roles"),
        F.lit("SELECT").alias("cmd"),
        F.concat(F.lit("(o_custkey = "), key, F.lit(")")).alias("qual"),
        F.lit(None).cast("string").alias("with_check"),
    )
    return access.row_policies(policies, "public")


@query(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(1 AS BIGINT) AS files, COUNT(*) AS row_count, TRUE AS has_bytes FROM {t}" for t in _TABLES)
)
def table_footprints(spark: SparkSession, root: str) -> DataFrame:
    """The given tables are one file each; what they take on disk is compared in the tests."""
    found = footprint.footprints(roles.trade(spark, root))
    return found.select("table_name", "files", "row_count", (F.col("table_bytes") > 0).alias("has_bytes"))
