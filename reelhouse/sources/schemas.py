"""Declared schemas as DDL text; no reader in this package infers one."""

from __future__ import annotations

RENTAL = {
    "film": """film_id INT, title STRING, description STRING, release_year INT, language_id INT,
        original_language_id INT, rental_duration SMALLINT, rental_rate DECIMAL(4,2),
        length SMALLINT, replacement_cost DECIMAL(5,2), rating STRING,
        special_features ARRAY<STRING>, last_update DATE""",
    "actor": "actor_id INT, first_name STRING, last_name STRING, last_update DATE",
    "film_actor": "actor_id INT, film_id INT, last_update DATE",
    "category": "category_id INT, name STRING",
    "film_category": "film_id INT, category_id INT",
    "language": "language_id INT, name STRING",
    "inventory": "inventory_id BIGINT, film_id INT, store_id INT, last_update DATE",
    "rental": """rental_id BIGINT, rental_date TIMESTAMP_NTZ, inventory_id BIGINT, customer_id INT,
        return_date TIMESTAMP_NTZ, staff_id INT, last_update DATE""",
    "payment": """payment_id BIGINT, customer_id INT, staff_id INT, rental_id BIGINT,
        amount DECIMAL(5,2), payment_date TIMESTAMP_NTZ""",
    "customer": """customer_id INT, store_id INT, first_name STRING, last_name STRING, email STRING,
        address_id INT, active INT, create_date DATE, last_update DATE""",
    "staff": "staff_id INT, store_id INT, first_name STRING, last_name STRING",
    "store": "store_id INT, address_id INT",
    "address": "address_id INT, address STRING, address2 STRING, city_id INT",
    "city": "city_id INT, country_id INT",
    "country": "country_id INT, country STRING",
}

# TIME columns are kept as the second of the day: parquet cannot store Spark's TIME type.
AUCTION = {
    "country": "country_id BIGINT, country_name STRING",
    "city": "city_id BIGINT, city_name STRING, country_id BIGINT",
    "category": "category_id BIGINT, category_name STRING, description STRING, parent_category_id BIGINT",
    "address": "address_id BIGINT, street STRING, postal_code STRING, city_id BIGINT",
    "location": "location_id BIGINT, location_name STRING, city_id BIGINT",
    "buyer": "buyer_id BIGINT, buyer_name STRING, contact_number STRING, email STRING, address_id BIGINT",
    "seller": "seller_id BIGINT, seller_name STRING, contact_number STRING, email STRING, address_id BIGINT",
    "auction": """auction_id BIGINT, auction_date DATE, start_time INT, end_time INT,
        location_id BIGINT, category_id BIGINT""",
    "employee": "employee_id BIGINT, name STRING, role STRING, auction_id BIGINT",
    "item": """item_id BIGINT, item_name STRING, description STRING, starting_price DECIMAL(12,2),
        seller_id BIGINT, category_id BIGINT""",
    "auction_item": "auction_id BIGINT, item_id BIGINT, display_order INT, estimated_price DECIMAL(12,2)",
    "lot": "lot_id BIGINT, lot_number STRING, auction_id BIGINT, item_id BIGINT, lot_description STRING",
    "bid": "bid_id BIGINT, lot_id BIGINT, buyer_id BIGINT, bid_amount DECIMAL(12,2), bid_time TIMESTAMP_NTZ",
    "sale": "sale_id BIGINT, lot_id BIGINT, buyer_id BIGINT, final_price DECIMAL(12,2), sale_date DATE",
    "payment": """payment_id BIGINT, sale_id BIGINT, payment_date DATE, payment_amount DECIMAL(12,2),
        payment_method STRING""",
}

TRADE = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}
