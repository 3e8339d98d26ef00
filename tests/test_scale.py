"""Plans: what is pushed down, what is shuffled, and what happens to a hot key."""

from __future__ import annotations

import __spark_entry__ as registered
import pytest
from pyspark.sql import functions as F

from reelhouse.operators import change, lists, reports, stock
from reelhouse.operators.joins import hot_join, in_keys, not_in_keys

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted_plan(spark, df) -> str:
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture
def conf(spark):
    kept = {}

    def put(key, value):
        kept[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in kept.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def split_early(conf) -> None:
    """Thresholds under which even small test tables are shuffled and count as skewed."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")


def test_a_hot_key_is_split_over_tasks(spark, conf, tmp_path):
    """One key holds a third of the rows; the lookup comes out of an aggregate on that key."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    spark.range(300_000).select(hot.alias("k"), F.col("id").alias("v")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    lookup = spark.range(300_000).withColumnRenamed("id", "k").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    split_early(conf)
    for joined, expected in [
        (hot_join(rows, lookup, ["k"]), 300_000),
        (hot_join(rows, lookup.where("k < 10"), ["k"], "left"), 300_000),
        (in_keys(rows, lookup, ["k"]), 300_000),
        (not_in_keys(rows, lookup, ["k"]), 0),
    ]:
        assert len(joined.collect()) == expected
        assert "skew=true" in plan_of(joined)


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """Rental tables in which one film, copy, customer and rental each hold a third of the rows that refer to them."""
    root = tmp_path_factory.mktemp("hot")
    rows, keys = 120_000, 20_000

    def pick(salt: int):
        return F.when((F.col("id") + salt) % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(keys))).cast("int")

    own = F.col("id").cast("int")
    at = F.timestamp_micros(F.lit(1_488_000_000_000_000) + F.col("id") * 1_000_000).cast("timestamp_ntz")
    made = {
        "film": spark.range(keys).select(own.alias("film_id"), F.concat(F.lit("f"), own).alias("title"), (own % 40 + 1980).alias("release_year"),
                                         F.lit(1).cast("decimal(4,2)").alias("rental_rate"), F.lit(3).alias("rental_duration")),
        "actor": spark.range(keys).select(own.alias("actor_id"), F.lit("a").alias("first_name"), F.concat(F.lit("n"), own).alias("last_name")),
        "film_actor": spark.range(rows).select(pick(1).alias("film_id"), (own % keys).alias("actor_id")),
        "inventory": spark.range(keys).select(own.alias("inventory_id"), own.alias("film_id"), (own % 9).alias("store_id")),
        "rental": spark.range(rows).select(own.alias("rental_id"), pick(1).alias("inventory_id"), pick(2).alias("customer_id"), at.alias("rental_date"),
                                           F.when(own % 2 == 0, at).alias("return_date")),
        "payment": spark.range(rows).select(own.alias("payment_id"), pick(1).alias("rental_id"), (own % 11).alias("staff_id"), (own % keys).alias("customer_id"),
                                            F.lit(1).cast("decimal(5,2)").alias("amount"), at.alias("payment_date")),
        "staff": spark.range(11).select(own.alias("staff_id"), F.lit("s").alias("first_name"), F.lit("t").alias("last_name")),
        "customer": spark.range(keys).select(own.alias("customer_id"), own.alias("address_id")),
        "address": spark.range(keys).select(own.alias("address_id"), (own % 50).alias("city_id")),
        "city": spark.range(50).select(own.alias("city_id"), (own % 2).alias("country_id")),
        "country": spark.range(2).select(own.alias("country_id"), F.concat(F.lit("c"), own).alias("country")),
    }
    for name, df in made.items():
        df.write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in made}


HOT_REPORTS = {
    "top_actors_since": lambda t: reports.top_actors_since(t, 1985),
    "actor_inactivity": reports.actor_inactivity,
    "actor_max_gap": reports.actor_max_gap,
    "top_staff_by_revenue": lambda t: reports.top_staff_by_revenue(t, 2017),
    "most_popular_films_by_country": lambda t: reports.most_popular_films_by_country(t, ["c0", "C1"]),
    "customer_balance": lambda t: stock.customer_balance(t, "2017-03-01", 1),
    "remove_activity": lambda t: change.remove_activity(t, t["customer"])["payment"].returning,
    "return_latest_rental": lambda t: change.return_latest_rental(t, t["customer"], "2018-01-01").state,
}


@pytest.mark.parametrize("name", HOT_REPORTS)
def test_joins_of_single_rows_are_split_when_skewed(spark, conf, hot_tables, name):
    split_early(conf)
    df = HOT_REPORTS[name](hot_tables)
    assert df.collect()
    assert "skew=true" in plan_of(df)


@pytest.mark.parametrize("report", [reports.most_rented_films, lambda t: reports.store_revenue_since(t, "2017-01-01")])
def test_aggregates_come_before_joins(spark, conf, hot_tables, report):
    """Every join of these reports meets rows that were summed per key, so there is nothing to split."""
    split_early(conf)
    stores = spark.range(9).select(F.col("id").cast("int").alias("store_id"), F.col("id").cast("int").alias("address_id"))
    address = hot_tables["address"].withColumns({"address": F.lit("a"), "address2": F.lit("b")})
    films = hot_tables["film"].withColumn("rating", F.lit("G"))
    df = report({**hot_tables, "store": stores, "address": address, "film": films})
    assert df.collect()
    plan = plan_of(df)
    assert plan.count("partial_sum") + plan.count("partial_count") >= 2 and "skew=true" not in plan


def test_date_filters_reach_the_scan(spark):
    for name, column in [("store_revenue_since", "l_shipdate"), ("sales_by_category_quarter", "l_shipdate"), ("rewards_report", "o_orderdate")]:
        assert f"GreaterThanOrEqual({column}" in formatted_plan(spark, registered.queries()[name](spark, SMALL)), name


def test_reports_read_only_the_columns_they_need(spark):
    formatted = formatted_plan(spark, registered.queries()["store_revenue_since"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in formatted


def test_a_huge_list_is_sorted_in_pieces(spark, monkeypatch, conf):
    """A group with a third of all rows, most of them equal, is sorted in many tasks."""
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    rows = spark.range(30_000).select(hot.alias("g"), F.when(F.col("id") % 4 > 0, F.lit("v")).otherwise((F.col("id") % 500).cast("string")).alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None), (None, "x"), (None, "a")], "g BIGINT, v STRING"))
    kept = []
    monkeypatch.setattr(lists, "stored", lambda df, of=lists.stored: kept.append(of(df)) or kept[-1])
    for distinct in (False, True):
        pieces = lists.group_concat(rows, ["g"], "v", separator="|", distinct=distinct, in_pieces=True)
        plain = lists.group_concat(rows, ["g"], "v", separator="|", distinct=distinct)
        assert {tuple(r) for r in pieces.collect()} == {tuple(r) for r in plain.collect()}
    sizes = [r["count"] for r in kept[0].where("g = 7").groupBy("_piece").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.5 * sum(sizes)
