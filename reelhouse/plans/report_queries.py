"""Reports, stock and lists on the trade tables, each with the SQL that must agree with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelhouse.functions import moment
from reelhouse.operators import lists, reports, stock
from reelhouse.plans import sql_functions, trade_roles as roles
from reelhouse.plans.registry import Registry, doubles

registry = Registry()
query = registry.query

# Shared pieces of the SQL side.
_PAID = """
paid AS (
    SELECT l_suppkey AS staff_id, l_orderkey AS rental_id, l_shipdate AS payment_date,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
    FROM lineitem)"""
_FIRST_LAST = "split_part({0}, '#', 1) AS first_name, split_part({0}, '#', 2) AS last_name"
_RATING = """CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 10 WHEN 'MEDIUM' THEN 13
             WHEN 'STANDARD' THEN 17 WHEN 'LARGE' THEN 18 END"""
_OUT = """
copies_out AS (
    SELECT DISTINCT l_partkey FROM lineitem
    WHERE l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '2001-07-01')"""


@query(
    """
    SELECT p_name AS title, CAST(1950 + p_size AS INTEGER) AS release_year, p_retailprice AS rental_rate
    FROM part WHERE p_type = 'ECONOMY' AND p_size BETWEEN 10 AND 30 AND p_retailprice > 950"""
)
def films_in_category(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_as_rentals(roles.trade(spark, root))
    return doubles(reports.films_in_category(t, "Economy", 1960, 1980, 950, any_case=True), "rental_rate")


@query(
    f"""
    WITH {_PAID}
    SELECT n_name || ' ' || CASE WHEN r_name = 'AFRICA' THEN '' ELSE r_name END AS full_address,
           CAST(SUM(amount) AS DOUBLE) AS revenue
    FROM paid JOIN orders ON o_orderkey = rental_id JOIN customer ON c_custkey = o_custkey
         JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE payment_date >= TIMESTAMP '1997-04-01'
    GROUP BY n_nationkey, n_name, r_name"""
)
def store_revenue_since(spark: SparkSession, root: str) -> DataFrame:
    t = roles.orders_as_rentals(roles.trade(spark, root))
    return doubles(reports.store_revenue_since(t, "1997-04-01"), "revenue")


@query(
    f"""
    WITH {_PAID}
    SELECT r_name || ' ' AS full_address, CAST(SUM(amount) AS DOUBLE) AS revenue
    FROM paid JOIN orders ON o_orderkey = rental_id JOIN customer ON c_custkey = o_custkey
         JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE payment_date >= TIMESTAMP '1997-04-01'
    GROUP BY r_name"""
)
def store_revenue_per_address(spark: SparkSession, root: str) -> DataFrame:
    s = roles.trade(spark, root)
    t = roles.orders_as_rentals(s)
    address = s["nation"].join(s["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("address_id"), F.col("r_name").alias("address"), F.lit(None).cast("string").alias("address2")
    )
    t = t.but(address=address)
    return doubles(reports.store_revenue_since(t, "1997-04-01", per_address=True), "revenue")


@query(
    f"""
    SELECT {_FIRST_LAST.format('s_name')}, COUNT(DISTINCT l_partkey) AS num_movies
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    WHERE 1950 + p_size > 1990
    GROUP BY s_suppkey, s_name ORDER BY num_movies DESC, last_name, first_name LIMIT 5"""
)
def top_actors_since(spark: SparkSession, root: str) -> DataFrame:
    return reports.top_actors_since(roles.lines_as_rentals(roles.trade(spark, root)), 1990, 5)


@query(
    f"""
    SELECT {_FIRST_LAST.format('c_name')},
           COUNT(DISTINCT CASE WHEN year(o_orderdate) > 2000 THEN o_orderkey END) AS num_movies
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    GROUP BY c_custkey, c_name"""
)
def top_actors_including_zero(spark: SparkSession, root: str) -> DataFrame:
    return reports.top_actors_since(roles.customers_as_actors(roles.trade(spark, root)), 2000, None, include_zero=True)


@query(
    """
    SELECT CAST(1950 + p_size AS INTEGER) AS release_year,
           CAST(COUNT(*) FILTER (p_type = 'ECONOMY') AS BIGINT) AS num_economy,
           CAST(COUNT(*) FILTER (p_type = 'PROMO') AS BIGINT) AS num_promo,
           CAST(COUNT(*) FILTER (p_type = 'SMALL') AS BIGINT) AS num_small
    FROM part WHERE p_type IN ('ECONOMY', 'PROMO', 'SMALL') GROUP BY p_size"""
)
def category_counts_by_year(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_as_rentals(roles.trade(spark, root))
    return reports.category_counts_by_year(t, ["Economy", "PROMO", "small"])


@query(
    """
    SELECT CAST(1950 + p_size AS INTEGER) AS release_year,
           CAST(COUNT(*) FILTER (p_brand = 'Brand#1') AS BIGINT) AS "num_brand#1",
           CAST(COUNT(*) FILTER (p_brand = 'Brand#2') AS BIGINT) AS "num_brand#2"
    FROM part GROUP BY p_size"""
)
def category_counts_all_years(spark: SparkSession, root: str) -> DataFrame:
    s = roles.trade(spark, root)
    t = roles.lines_as_rentals(s)
    listed = s["part"].select(F.col("p_partkey").alias("film_id"), F.col("p_brand").alias("category_id"))
    t = t.but(film_category=listed, category=roles.named_categories(s["part"], "p_brand"))
    return reports.category_counts_by_year(t, ["Brand#1", "Brand#2"], all_years=True)


def _staff_sql(bounds: str, orders: str = "orders", revenue_join: str = "JOIN") -> str:
    return f"""
    WITH {_PAID},
    placed AS (
        SELECT paid.*, c_nationkey, c_custkey IS NOT NULL AS has_store
        FROM paid {revenue_join} (SELECT * FROM {orders} JOIN customer ON c_custkey = o_custkey) ON o_orderkey = rental_id
        WHERE {bounds}),
    revenue AS (SELECT staff_id, SUM(amount) AS total FROM placed GROUP BY staff_id),
    latest AS (
        SELECT staff_id, c_nationkey,
               row_number() OVER (PARTITION BY staff_id ORDER BY payment_date DESC, rental_id DESC) AS place
        FROM placed WHERE has_store)
    SELECT {_FIRST_LAST.format('s_name')}, c_nationkey AS last_store_id, CAST(total AS DOUBLE) AS total_revenue
    FROM revenue JOIN supplier ON s_suppkey = staff_id
         LEFT JOIN latest ON latest.staff_id = revenue.staff_id AND place = 1
    ORDER BY total DESC, last_name, first_name LIMIT 3"""


_IN_1997 = "payment_date >= TIMESTAMP '1997-01-01' AND payment_date < TIMESTAMP '1998-01-01'"


@query(_staff_sql(_IN_1997))
def top_staff_by_revenue(spark: SparkSession, root: str) -> DataFrame:
    t = roles.orders_as_rentals(roles.trade(spark, root))
    return doubles(reports.top_staff_by_revenue(t, 1997), "total_revenue")


@query(_staff_sql("payment_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"))
def top_staff_strict_year(spark: SparkSession, root: str) -> DataFrame:
    t = roles.orders_as_rentals(roles.trade(spark, root))
    return doubles(reports.top_staff_by_revenue(t, 1997, strict_reference=True), "total_revenue")


@query(
    f"""
    WITH rented AS (SELECT l_orderkey, MIN(l_partkey) AS copy FROM lineitem GROUP BY l_orderkey),
    placed AS (
        SELECT o_custkey, o_orderkey, o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(copy % 25 AS INTEGER) AS store_id
        FROM orders LEFT JOIN rented ON l_orderkey = o_orderkey
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'),
    latest AS (
        SELECT o_custkey, store_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place
        FROM placed WHERE store_id IS NOT NULL),
    revenue AS (SELECT o_custkey, SUM(amount) AS total FROM placed GROUP BY o_custkey HAVING SUM(amount) IS NOT NULL)
    SELECT {_FIRST_LAST.format('c_name')}, store_id AS last_store_id, CAST(total AS DOUBLE) AS total_revenue
    FROM revenue JOIN customer ON c_custkey = revenue.o_custkey
         LEFT JOIN latest ON latest.o_custkey = revenue.o_custkey AND place = 1"""
)
def top_staff_all_payments(spark: SparkSession, root: str) -> DataFrame:
    """Orders as payments to customers as staff, lines as rentals: some orders have no line, so no rental and no store."""
    return doubles(reports.top_staff_by_revenue(_orders_paid_to_customers(spark, root), 1997, None, all_payments=True), "total_revenue")


def _orders_paid_to_customers(spark: SparkSession, root: str) -> roles.Roles:
    s = roles.trade(spark, root)
    rental = s["lineitem"].groupBy(F.col("l_orderkey").alias("rental_id")).agg(F.min("l_partkey").alias("inventory_id"))
    payment = s["orders"].select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_custkey").alias("staff_id"),
        roles.money("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("payment_date"),
    )
    staff = roles.people(s["customer"], "c_custkey", "c_name", "staff_id")
    return roles.lines_as_rentals(s).but(rental=rental, payment=payment, staff=staff)


def _rented_sql(join: str, where: str, limit: int) -> str:
    return f"""
    SELECT p_name AS title, CAST(COALESCE(n, 0) AS BIGINT) AS rentals, CAST({_RATING} AS INTEGER) AS expected_age
    FROM part {join} (SELECT l_partkey, COUNT(*) AS n FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey
    WHERE {where} ORDER BY rentals DESC, title, p_partkey LIMIT {limit}"""


@query(_rented_sql("JOIN", "TRUE", 5))
def most_rented_films(spark: SparkSession, root: str) -> DataFrame:
    return reports.most_rented_films(roles.lines_as_rentals(roles.trade(spark, root)), 5)


@query(_rented_sql("JOIN", "p_type <> 'PROMO'", 20))
def most_rented_rated_films(spark: SparkSession, root: str) -> DataFrame:
    return reports.most_rented_films(roles.lines_as_rentals(roles.trade(spark, root)), 20, rated_only=True)


@query(
    """
    SELECT o_orderpriority AS title, COUNT(l_orderkey) AS rentals,
           CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 13 END AS INTEGER) AS expected_age
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderpriority, o_orderstatus"""
)
def most_rented_including_unrented(spark: SparkSession, root: str) -> DataFrame:
    """Orders as films and their own copies, lines as rentals: some orders have no line."""
    return reports.most_rented_films(_lines_rent_orders(spark, root), None, include_unrented=True)


def _lines_rent_orders(spark: SparkSession, root: str) -> roles.Roles:
    s = roles.trade(spark, root)
    rating = F.when(F.col("o_orderstatus") == "F", "G").when(F.col("o_orderstatus") == "O", "PG-13")
    film = s["orders"].select(F.col("o_orderkey").alias("film_id"), F.col("o_orderpriority").alias("title"), rating.alias("rating"))
    inventory = s["orders"].select(F.col("o_orderkey").alias("inventory_id"), F.col("o_orderkey").alias("film_id"))
    rental = s["lineitem"].select(F.col("l_linenumber").alias("rental_id"), F.col("l_orderkey").alias("inventory_id"))
    return roles.lines_as_rentals(s).but(film=film, inventory=inventory, rental=rental)


@query(
    f"""
    SELECT {_FIRST_LAST.format('c_name')}, CAST(MAX(year(o_orderdate)) AS INTEGER) AS last_release,
           CAST(2025 - MAX(year(o_orderdate)) AS INTEGER) AS inactivity_years
    FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name"""
)
def actor_inactivity(spark: SparkSession, root: str) -> DataFrame:
    return reports.actor_inactivity(roles.customers_as_actors(roles.trade(spark, root)), 2025)


@query(
    """
    SELECT o_orderpriority AS first_name, CAST(o_orderkey AS VARCHAR) AS last_name, CAST(MAX(1950 + p_size) AS INTEGER) AS last_release,
           CAST(2025 - MAX(1950 + p_size) AS INTEGER) AS inactivity_years
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
    GROUP BY o_orderkey, o_orderpriority"""
)
def actor_inactivity_including_unreleased(spark: SparkSession, root: str) -> DataFrame:
    """Orders as actors, lines as their credits: some orders have no line."""
    return reports.actor_inactivity(_orders_as_actors(spark, root), 2025, include_unreleased=True)


def _orders_as_actors(spark: SparkSession, root: str) -> roles.Roles:
    s = roles.trade(spark, root)
    actor = s["orders"].select(
        F.col("o_orderkey").alias("actor_id"), F.col("o_orderpriority").alias("first_name"), F.col("o_orderkey").cast("string").alias("last_name")
    )
    credits = s["lineitem"].select(F.col("l_orderkey").alias("actor_id"), F.col("l_partkey").alias("film_id"))
    return roles.lines_as_rentals(s).but(actor=actor, film_actor=credits)


def _gap_sql(released: str) -> str:
    return f"""
    WITH released AS (SELECT DISTINCT o_custkey, {released} AS y FROM orders),
    gaps AS (SELECT o_custkey, lead(y) OVER (PARTITION BY o_custkey ORDER BY y) - y AS gap FROM released)
    SELECT {_FIRST_LAST.format('c_name')}, CAST(MAX(COALESCE(gap, 0)) AS INTEGER) AS max_gap
    FROM gaps JOIN customer ON c_custkey = o_custkey GROUP BY c_custkey, c_name"""


@query(_gap_sql("year(o_orderdate)"))
def actor_max_gap(spark: SparkSession, root: str) -> DataFrame:
    return reports.actor_max_gap(roles.customers_as_actors(roles.trade(spark, root)))


@query(_gap_sql("date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))"))
def actor_max_gap_days(spark: SparkSession, root: str) -> DataFrame:
    day = F.unix_date(F.to_date("o_orderdate"))
    return reports.actor_max_gap(roles.customers_as_actors(roles.trade(spark, root), day))


@query(
    f"""
    WITH {_PAID}
    SELECT c_mktsegment AS category, CAST(SUM(amount) AS DOUBLE) AS total_revenue
    FROM paid JOIN orders ON o_orderkey = rental_id JOIN customer ON c_custkey = o_custkey
    WHERE year(payment_date) = 1998 AND quarter(payment_date) = 2
    GROUP BY c_mktsegment HAVING SUM(amount) > 0"""
)
def sales_by_category_quarter(spark: SparkSession, root: str) -> DataFrame:
    t = roles.orders_as_rentals(roles.trade(spark, root))
    return doubles(reports.sales_by_category_quarter(t, "1998-05-01"), "total_revenue")


def _popular_sql(key: str) -> str:
    return f"""
    WITH counted AS (
        SELECT n_name, p_name, {key} AS film, COUNT(*) AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
             JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
        WHERE upper(n_name) IN ('NATION_3', 'NATION_7', 'NATION_12', 'NOWHERE')
        GROUP BY n_name, p_name, {key}),
    placed AS (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY n DESC, p_name, film) AS place FROM counted)
    SELECT n_name AS country, p_name AS film_title, n AS rentals FROM placed WHERE place = 1"""


_COUNTRIES = ["nation_3", "NATION_7", "Nation_12", "Nowhere"]


@query(_popular_sql("p_partkey"))
def most_popular_films_by_country(spark: SparkSession, root: str) -> DataFrame:
    return reports.most_popular_films_by_country(roles.lines_with_customers(roles.trade(spark, root)), _COUNTRIES)


@query(_popular_sql("p_name"))
def most_popular_titles_by_country(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_with_customers(roles.trade(spark, root))
    return reports.most_popular_films_by_country(t, _COUNTRIES, by_title=True)


@query(
    f"""
    SELECT c_custkey AS customer_id, {_FIRST_LAST.format('c_name')}, lower(c_name) || '@example.com' AS email,
           COUNT(*) AS purchases, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent
    FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE date_trunc('month', o_orderdate) = DATE '1998-05-01'
    GROUP BY c_custkey, c_name
    HAVING COUNT(*) >= 2 AND SUM(CAST(o_totalprice AS DECIMAL(18,2))) >= 100000"""
)
def rewards_report(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_as_rentals(roles.trade(spark, root))
    return doubles(reports.rewards_report(t, 2, 100000, "1998-05-20"), "total_spent")


@query(
    f"""
    WITH {_OUT}
    SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS row_num, p_partkey AS film_id, p_name AS title
    FROM part WHERE upper(p_name) LIKE '%WIDGET%' AND p_partkey NOT IN (SELECT l_partkey FROM copies_out)"""
)
def films_in_stock_by_title(spark: SparkSession, root: str) -> DataFrame:
    return stock.films_in_stock_by_title(roles.lines_as_rentals(roles.trade(spark, root)), "%Widget%")


@query(
    """
    SELECT CAST(1 AS BIGINT) AS row_num, CAST(NULL AS BIGINT) AS film_id,
           'No films found in stock for pattern: %no such title%' AS title
    WHERE NOT EXISTS (SELECT 1 FROM part WHERE upper(p_name) LIKE '%NO SUCH TITLE%')"""
)
def films_in_stock_message(spark: SparkSession, root: str) -> DataFrame:
    return stock.films_in_stock_by_title(roles.lines_as_rentals(roles.trade(spark, root)), "%no such title%")


def _copies_sql(test: str) -> str:
    return f"""
    WITH {_OUT}
    SELECT p_partkey AS inventory_id, p_partkey AS film_id, CAST(p_partkey % 25 AS INTEGER) AS store_id
    FROM part WHERE p_partkey {test} (SELECT l_partkey FROM copies_out)"""


@query(_copies_sql("NOT IN"))
def film_in_stock(spark: SparkSession, root: str) -> DataFrame:
    return stock.film_in_stock(roles.lines_as_rentals(roles.trade(spark, root)))


@query(_copies_sql("IN"))
def film_not_in_stock(spark: SparkSession, root: str) -> DataFrame:
    return stock.film_not_in_stock(roles.lines_as_rentals(roles.trade(spark, root)))


@query(
    f"""
    WITH {_OUT}
    SELECT p_partkey AS inventory_id, p_partkey AS film_id, CAST(p_partkey % 25 AS INTEGER) AS store_id,
           p_partkey NOT IN (SELECT l_partkey FROM copies_out) AS in_stock
    FROM part"""
)
def inventory_in_stock(spark: SparkSession, root: str) -> DataFrame:
    return stock.inventory_in_stock(roles.lines_as_rentals(roles.trade(spark, root)))


@query(
    """
    SELECT o_custkey AS customer_id, l_partkey AS inventory_id, l_orderkey AS rental_id,
           strftime(o_orderdate, '%Y-%m-%d') AS rental_date
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '2001-07-01'"""
)
def inventory_held_by_customer(spark: SparkSession, root: str) -> DataFrame:
    held = stock.inventory_held_by_customer(roles.lines_with_customers(roles.trade(spark, root)))
    return held.withColumn("rental_date", F.date_format("rental_date", "yyyy-MM-dd"))


@query(
    """
    WITH rented AS (
        SELECT o_custkey, SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS charges,
               SUM(GREATEST(0, date_diff('day', CAST(o_orderdate AS DATE),
                   LEAST(CASE WHEN l_linestatus = 'O' AND l_shipdate >= TIMESTAMP '2001-07-01' THEN DATE '2001-07-10'
                              ELSE CAST(l_shipdate AS DATE) END, DATE '2001-07-10')) - p_size)) AS days
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
        WHERE o_orderdate < TIMESTAMP '2001-07-11' GROUP BY o_custkey),
    paid AS (
        SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS payments
        FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-11' GROUP BY o_custkey)
    SELECT c_custkey AS customer_id, CAST(COALESCE(charges, 0) AS DOUBLE) AS charges,
           CAST(COALESCE(days, 0) * 1.50 AS DOUBLE) AS late_fees, CAST(COALESCE(payments, 0) AS DOUBLE) AS payments,
           CAST(COALESCE(charges, 0) + CAST(COALESCE(days, 0) AS BIGINT) * 1.50 - COALESCE(payments, 0) AS DOUBLE) AS balance
    FROM customer LEFT JOIN rented ON rented.o_custkey = c_custkey LEFT JOIN paid ON paid.o_custkey = c_custkey"""
)
def customer_balance(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_with_customers(roles.trade(spark, root))
    balance = stock.customer_balance(t, "2001-07-10", "1.50")
    return doubles(balance, "charges", "late_fees", "payments", "balance")


@query(
    """
    SELECT p_brand, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS items FROM part GROUP BY p_brand"""
)
def group_concat(spark: SparkSession, root: str) -> DataFrame:
    return lists.group_concat(roles.trade(spark, root)["part"], ["p_brand"], "p_name")


@query(registry.oracle_sql["group_concat"])
def group_concat_in_pieces(spark: SparkSession, root: str) -> DataFrame:
    return lists.group_concat(roles.trade(spark, root)["part"], ["p_brand"], "p_name", in_pieces=True)


@query(
    """
    SELECT p_partkey AS film_id, p_name AS title,
           string_agg(DISTINCT replace(s_name, '#', ' '), ', ' ORDER BY replace(s_name, '#', ' ')) AS actors
    FROM part JOIN lineitem ON l_partkey = p_partkey JOIN supplier ON s_suppkey = l_suppkey
    GROUP BY p_partkey, p_name"""
)
def film_actor_lists(spark: SparkSession, root: str) -> DataFrame:
    return lists.film_actor_lists(roles.lines_as_rentals(roles.trade(spark, root)))


@query(
    """
    SELECT o_custkey, strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_updated FROM orders GROUP BY o_custkey"""
)
def last_updated(spark: SparkSession, root: str) -> DataFrame:
    orders = roles.trade(spark, root)["orders"]
    latest = lists.last_updated(orders, ["o_custkey"], "o_orderdate")
    return latest.withColumn("last_updated", F.date_format("last_updated", "yyyy-MM-dd"))


# --- the same reports called from SQL ---------------------------------------------------


def _called(t: roles.Roles, function: str, arguments: str) -> DataFrame:
    sql_functions.create_functions(t, "trade_", [function])
    return next(iter(t.values())).sparkSession.sql(f"SELECT * FROM trade_{function}({arguments})")


@query(registry.oracle_sql["sales_by_category_quarter"])
def sales_by_category_quarter_function(spark: SparkSession, root: str) -> DataFrame:
    t = roles.orders_as_rentals(roles.trade(spark, root))
    return doubles(_called(t, "get_sales_revenue_by_category_qtr", "DATE'1998-05-01'"), "total_revenue")


@query(registry.oracle_sql["most_popular_films_by_country"])
def most_popular_films_by_country_function(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_with_customers(roles.trade(spark, root))
    return _called(t, "most_popular_films_by_countries", f"array({', '.join(map(repr, _COUNTRIES))})")


@query(registry.oracle_sql["rewards_report"])
def rewards_report_function(spark: SparkSession, root: str) -> DataFrame:
    t = roles.lines_as_rentals(roles.trade(spark, root))
    return doubles(_called(t, "rewards_report", "2, 100000, DATE'1998-05-20'"), "total_spent")


@query(registry.oracle_sql["films_in_stock_by_title"])
def films_in_stock_by_title_function(spark: SparkSession, root: str) -> DataFrame:
    return _called(roles.lines_as_rentals(roles.trade(spark, root)), "films_in_stock_by_title", "'%Widget%'")


@query(registry.oracle_sql["film_in_stock"])
def inventory_in_stock_function(spark: SparkSession, root: str) -> DataFrame:
    """Copies in stock, by a boolean function in the WHERE clause."""
    t = roles.lines_as_rentals(roles.trade(spark, root))
    sql_functions.create_functions(t, "trade_", ["inventory_in_stock"])
    t["inventory"].createOrReplaceTempView("trade_inventory")
    return spark.sql("SELECT inventory_id, film_id, store_id FROM trade_inventory WHERE trade_inventory_in_stock(inventory_id)")
