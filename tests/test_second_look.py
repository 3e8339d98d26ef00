"""Options that change their result, batches that are read once, wide keys, and bounded work."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import change, integrity, lists, numbering, reports, seeding
from reelhouse.operators.joins import hot_join
from reelhouse.plans import auction, report_queries
from reelhouse.sources.publish import clustered
from rental import table, ts, values

SMALL = "/root/testdata/sf0.001"


@contextmanager
def counted_jobs(spark):
    """The jobs that the body starts, as a list that is filled at its end."""
    group, jobs = f"counted-{id(object())}", []
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        yield jobs
    finally:
        jobs += spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def city(spark, customers: int, copies: int):
    rows = range(copies)
    return {
        "film": table(spark, "film", "film_id title rental_rate", [(1, "Alpha", 2)]),
        "inventory": table(spark, "inventory", "inventory_id film_id store_id", [(i, 1, 1) for i in rows]),
        "staff": table(spark, "staff", "staff_id store_id", [(4, 1)]),
        "rental": table(spark, "rental", "rental_id customer_id inventory_id rental_date", [(7, 1, 0, "2016-01-01T00:00:00")]),
        "payment": table(spark, "payment", "payment_id rental_id", [(3, 7)]),
    }


def test_a_copy_goes_out_once(spark):
    t = city(spark, 50, 40)
    requests = spark.range(1, 51).select(F.col("id").alias("customer_id"), F.lit("Alpha").alias("title"))
    with counted_jobs(spark) as jobs:
        done = change.rent_and_pay(t, requests, "2017-02-15", "2017-02-17")
    rented = done["rental"].returning.collect()
    assert len(rented) == 40 and {r["customer_id"] for r in rented} == {1} and len({r["inventory_id"] for r in rented}) == 40
    assert len(jobs) <= 29
    assert done["payment"].returning.count() == 40 and done["payment"] is done["payment"]
    shared = change.rent_and_pay(t, requests, "2017-02-15", "2017-02-17", share_copies=True)
    assert shared["rental"].returning.count() == 2000
    with pytest.raises(KeyError):
        done["film"]


def test_every_option_changes_the_result(spark):
    t = report_queries._lines_rent_orders(spark, SMALL)
    kept, every = reports.most_rented_films(t, None), reports.most_rented_films(t, None, include_unrented=True)
    assert kept.where("rentals = 0").isEmpty() and every.where("rentals = 0").count() == every.count() - kept.count() > 0
    t = report_queries._orders_paid_to_customers(spark, SMALL)
    assert sorted(values(reports.top_staff_by_revenue(t, 1997, None))) != sorted(values(reports.top_staff_by_revenue(t, 1997, None, all_payments=True)))
    t = report_queries._orders_as_actors(spark, SMALL)
    assert reports.actor_inactivity(t, 2025, include_unreleased=True).count() > reports.actor_inactivity(t, 2025).count()
    zeros = report_queries.top_actors_including_zero(spark, SMALL).where("num_movies = 0").count()
    assert zeros > 0


def test_staff_without_an_amount_are_left_out(spark):
    t = {
        "payment": table(spark, "payment", "payment_id staff_id rental_id amount payment_date", [(1, 1, None, None, "2017-01-02T00:00:00"), (2, 2, None, 3, "2017-01-02T00:00:00")]),
        "rental": table(spark, "rental", "rental_id inventory_id", []),
        "inventory": table(spark, "inventory", "inventory_id store_id", []),
        "staff": table(spark, "staff", "staff_id first_name last_name", [(1, "A", "One"), (2, "B", "Two")]),
    }
    assert values(reports.top_staff_by_revenue(t, 2017, all_payments=True)) == [("B", "Two", None, 3.0)]


def test_two_actors_of_one_name_are_both_listed(spark):
    t = {
        "film": table(spark, "film", "film_id title", [(1, "X")]),
        "actor": table(spark, "actor", "actor_id first_name last_name", [(1, "Al", "A"), (2, "Al", "A"), (3, "Bo", "B")]),
        "film_actor": table(spark, "film_actor", "actor_id film_id", [(1, 1), (2, 1), (3, 1), (3, 1)]),
    }
    assert values(lists.film_actor_lists(t)) == [(1, "X", "Al A, Al A, Bo B")]


def test_a_batch_is_read_once(spark):
    target = spark.range(50).select((F.col("id") % 25).alias("k"), F.lit(0.0).alias("x"))
    batch = spark.range(400).select((F.rand() * 60).cast("bigint").alias("k"), F.rand().alias("x"))
    done = change.insert_if_absent(target, batch, ["k"])
    new = sorted(values(done.returning))
    assert new == sorted(values(done.returning)) and min(k for k, _ in new) >= 25
    assert sorted(values(done.state)) == sorted(values(target) + new)


def test_once_per_key_keeps_the_least_row(spark):
    target = spark.createDataFrame([(1, "a", 0)], "k INT, v STRING, n INT")
    batch = spark.createDataFrame([(1, "z", 1), (2, "b", 9), (2, "a", 5), (2, "a", 3), (3, None, 1), (3, "x", 0)], "k INT, v STRING, n INT")
    done = change.insert_if_absent(target, batch, ["k"], once_per_key=True)
    assert sorted(values(done.returning)) == [(2, "a", 3), (3, None, 1)]
    keys = change.insert_if_absent(target.select("k"), batch.select("k"), ["k"], once_per_key=True)
    assert sorted(values(keys.returning)) == [(2,), (3,)]


def test_a_chain_of_forty_takes_few_jobs_a_round(spark):
    rows = [(i, (i + 1) // 2, i // 2) for i in range(40)]
    batch = spark.createDataFrame(rows, "row_id INT, a INT, b INT")
    with counted_jobs(spark) as jobs:
        kept = seeding.first_without_conflict(batch, [["a"], ["b"]], "row_id")
    assert sorted(r["row_id"] for r in kept.collect()) == list(range(0, 40, 2))
    assert len(jobs) <= 20 * 7


def test_rows_without_any_key_all_go_in(spark):
    batch = spark.createDataFrame([(0, None, None), (1, None, None), (2, 1, None), (3, 1, 2)], "row_id INT, a INT, b INT")
    kept = seeding.first_without_conflict(batch, [["a"], ["b"]], "row_id")
    assert sorted(r["row_id"] for r in kept.collect()) == [0, 1, 2]
    assert seeding.first_without_conflict(batch.limit(0), [["a"], ["b"]], "row_id").isEmpty()


@pytest.mark.parametrize("lay_out", [lambda df: numbering.number_rows(df, ["a"]), lambda df: clustered(df, ["a"])])
def test_equal_rows_are_spread(spark, lay_out):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("a"))
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "16")
    try:
        sizes = [r["count"] for r in lay_out(df).groupBy(F.spark_partition_id().alias("part")).count().collect()]
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert sum(sizes) == 60_000 and max(sizes) < 2 * 60_000 / 16


def test_keys_go_on_past_31_bits(spark):
    rental = table(spark, "rental", "rental_id customer_id", [(2**31 + 5, 1)])
    opened = change.open_rental(
        {"rental": rental, "inventory": table(spark, "inventory", "inventory_id", [(2**40,)]), "staff": table(spark, "staff", "staff_id", [(1,)])},
        spark.createDataFrame([(9,)], "customer_id INT"),
        ts("2024-01-01T00:00:00"),
    )
    assert [(r["rental_id"], r["inventory_id"]) for r in opened.returning.collect()] == [(2**31 + 6, 2**40)]


def test_a_missing_record_date_is_found(spark):
    rules = auction.rules(recorded=True)
    assert all("record_ts not null" in r.checks for r in rules.values())
    assert all("record_ts not null" not in r.checks for r in auction.rules().values())
    rows = spark.createDataFrame([(1, "LT", dt.date(2024, 1, 1)), (2, "LV", None)], "country_id BIGINT, country_name STRING, record_ts DATE")
    broken = integrity.violating_rows(rows, {"record_ts not null": rules["country"].checks["record_ts not null"]})
    assert [r["country_id"] for r in broken.collect()] == [2]


def test_a_hot_key_crosses_the_shuffle_once(spark):
    rows = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("n"))
    joined = hot_join(rows, lookup, ["k"])
    assert joined.columns == ["k", "v", "n"] and joined.where("n <> 2 * k").isEmpty() and joined.count() == 100
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    sides = [line.split("Project ")[1] for line in plan.splitlines() if "AS _key" in line]
    assert len(sides) == 2
    for side in sides:
        assert " AS k#" not in side
    assert hot_join(rows, lookup.where("k < 3"), ["k"], "left_anti").columns == ["k", "v"]
