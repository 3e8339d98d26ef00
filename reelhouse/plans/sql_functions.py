"""The parametrised reports as functions that ``spark.sql`` can call.

Each is a SQL function over temporary views of the tables, so a call is planned together
with the query around it: filters on its output, its constants and its columns reach the
scans as in any other statement. Dates default to the current one, and a
start before which and an end from which nothing counts are constants for the reader.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

_TABLES = [
    "film", "inventory", "rental", "payment", "category", "film_category", "customer", "address", "city", "country",
]

# Fixed values in the bodies: the names of the functions and the three messages.
_FUNCTIONS = {
    "get_sales_revenue_by_category_qtr": """(p_ref_date DATE DEFAULT current_date())
RETURNS TABLE (category STRING, total_revenue DECIMAL(28,2))
RETURN
    WITH quarters AS (SELECT rental_id, amount FROM {payment}
                      WHERE payment_date >= trunc(p_ref_date, 'quarter')
                        AND payment_date < add_months(trunc(p_ref_date, 'quarter'), 3)),
    by_rental AS (SELECT rental_id, SUM(amount) AS amount FROM quarters GROUP BY rental_id),
    by_copy AS (SELECT inventory_id, SUM(amount) AS amount FROM by_rental JOIN {rental} USING (rental_id) GROUP BY inventory_id),
    by_film AS (SELECT film_id, SUM(amount) AS amount
                FROM by_copy JOIN {inventory} USING (inventory_id) LEFT SEMI JOIN {film} USING (film_id) GROUP BY film_id),
    by_category AS (SELECT category_id, SUM(amount) AS amount FROM by_film JOIN {film_category} USING (film_id) GROUP BY category_id)
    SELECT name, CAST(SUM(amount) AS DECIMAL(28,2))
    FROM by_category JOIN {category} USING (category_id) GROUP BY name HAVING SUM(amount) > 0""",
    "most_popular_films_by_countries": """(countries ARRAY<STRING>)
RETURNS TABLE (country STRING, film_title STRING, rentals BIGINT)
RETURN
    WITH people AS (
        SELECT customer_id, c.country
        FROM {country} c JOIN {city} USING (country_id) JOIN {address} USING (city_id) JOIN {customer} USING (address_id)
        WHERE array_contains(transform(countries, x -> upper(x)), upper(c.country))),
    by_copy AS (SELECT country, inventory_id, COUNT(*) AS n FROM {rental} JOIN people USING (customer_id) GROUP BY country, inventory_id),
    by_film AS (SELECT country, film_id, SUM(n) AS n FROM by_copy JOIN {inventory} USING (inventory_id) GROUP BY country, film_id),
    winners AS (SELECT country, min(struct(-n AS n, title, film_id)) AS first FROM by_film JOIN {film} USING (film_id) GROUP BY country)
    SELECT country, first.title, -first.n FROM winners
    UNION ALL
    SELECT raise_error('No countries supplied'), NULL, NULL WHERE countries IS NULL OR size(countries) = 0""",
    "films_in_stock_by_title": """(title_pattern STRING)
RETURNS TABLE (row_num BIGINT, film_id BIGINT, title STRING)
RETURN
    WITH matching AS (SELECT film_id, title FROM {film} WHERE upper(title) LIKE upper(title_pattern)),
    copies AS (SELECT inventory_id, film_id FROM {inventory} LEFT SEMI JOIN matching USING (film_id)),
    taken AS (SELECT inventory_id FROM {rental} WHERE return_date IS NULL),
    shelved AS (SELECT film_id FROM copies LEFT ANTI JOIN taken USING (inventory_id)),
    listed AS (SELECT film_id, title, left(title, 4) AS section FROM matching LEFT SEMI JOIN shelved USING (film_id)),
    counted AS (SELECT section, COUNT(*) AS n FROM listed GROUP BY section),
    sections AS (
        SELECT section, coalesce(SUM(n) OVER (ORDER BY section ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counted),
    numbered AS (
        SELECT before + row_number() OVER (PARTITION BY section ORDER BY title, film_id) AS row_num, film_id, title
        FROM listed JOIN sections USING (section))
    SELECT row_num, film_id, title FROM numbered
    UNION ALL
    SELECT 1, NULL, concat('No films found in stock for pattern: ', title_pattern)
    FROM (SELECT COUNT(*) AS n FROM listed) WHERE n = 0 AND title_pattern IS NOT NULL
    UNION ALL
    SELECT raise_error('Title pattern cannot be null'), NULL, NULL WHERE title_pattern IS NULL""",
    "rewards_report": """(min_monthly_purchases INT, min_dollar_amount_purchased DECIMAL(18,2), p_ref_date DATE DEFAULT current_date())
RETURNS TABLE (customer_id BIGINT, first_name STRING, last_name STRING, email STRING, purchases BIGINT, total_spent DECIMAL(28,2))
RETURN
    WITH spent AS (
        SELECT customer_id, COUNT(payment_id) AS purchases, CAST(SUM(amount) AS DECIMAL(28,2)) AS total_spent
        FROM {payment}
        WHERE payment_date >= trunc(p_ref_date, 'month') AND payment_date < add_months(trunc(p_ref_date, 'month'), 1)
        GROUP BY customer_id
        HAVING COUNT(*) >= min_monthly_purchases AND SUM(amount) >= min_dollar_amount_purchased)
    SELECT customer_id, first_name, last_name, email, purchases, total_spent FROM spent JOIN {customer} USING (customer_id)""",
    "inventory_in_stock": """(p_inventory_id BIGINT)
RETURNS BOOLEAN
RETURN NOT EXISTS (SELECT 1 FROM {rental} r WHERE r.inventory_id = p_inventory_id AND r.return_date IS NULL)""",
}


def create_functions(t: Mapping[str, DataFrame], prefix: str = "", only: list[str] | None = None) -> None:
    """Give the functions, or ``only`` some, and the tables of ``t`` they need temporary names that begin with ``prefix``.

    The list of films in stock is numbered in sections of equal first four letters, so only
    the sections' counts meet in one task, not the films.
    """
    for name in only or _FUNCTIONS:
        body = _FUNCTIONS[name]
        needed = {table: f"{prefix}{table}" for table in _TABLES if "{" + table + "}" in body}
        for table, view in needed.items():
            t[table].createOrReplaceTempView(view)
        spark = t[next(iter(needed))].sparkSession
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}{body.format(**needed)}")
