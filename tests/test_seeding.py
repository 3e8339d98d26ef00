from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import integrity, numbering, seeding
from reelhouse.plans import auction
from rental import values


def one_by_one(target, rows, keys):
    """What a loop of inserts that skip conflicts leaves behind."""
    taken = [{tuple(t[i] for i in key) for t in target if None not in [t[i] for i in key]} for key in keys]
    kept = []
    for row in rows:
        mine = [tuple(row[i] for i in key) for key in keys]
        if any(None not in k and k in seen for k, seen in zip(mine, taken)):
            continue
        kept.append(row)
        for k, seen in zip(mine, taken):
            seen.add(k)
    return kept


@pytest.mark.parametrize("number", range(2))
def test_insert_or_skip_is_the_same_as_one_by_one(spark, number):
    rng = random.Random(number)
    draw = lambda: rng.choice([None, *range(6)])
    target = [(draw(), draw()) for _ in range(2)]
    rows = [(draw(), draw()) for _ in range(40)]
    schema = "a INT, b INT"
    batch = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"row_id INT, {schema}")
    for keys in ([["a"]], [["a"], ["b"]], [["a", "b"], ["b"]]):
        done = seeding.insert_or_skip(spark.createDataFrame(target, schema), batch, keys)
        places = [["ab".index(c) for c in key] for key in keys]
        assert sorted(values(done.returning), key=str) == sorted(one_by_one(target, rows, places), key=str)


def test_long_chain_of_conflicts(spark):
    # each row meets the next one, by turns under a and under b: every other row goes in
    rows = [(i, (i + 1) // 2, i // 2) for i in range(9)]
    batch = spark.createDataFrame(rows, "row_id INT, a INT, b INT")
    done = seeding.insert_or_skip(spark.createDataFrame([], "row_id INT, a INT, b INT"), batch, [["a"], ["b"]])
    assert sorted(r[0] for r in values(done.returning)) == [0, 2, 4, 6, 8]


@pytest.mark.parametrize("shape", ["one chain", "chains behind a row with two blockers"])
def test_a_chain_of_100000_takes_the_logarithm_of_rounds(spark, monkeypatch, shape):
    n = 100_000
    batch = spark.range(n).select(
        F.col("id").alias("row_id"), F.expr("(id + 1) div 2").alias("a"), F.expr("id div 2").alias("b"), F.lit(None).cast("bigint").alias("c")
    )
    if shape != "one chain":
        # Row 4 also meets row 0 under a third key, so it waits for a second round, and the chain after it does.
        batch = batch.withColumn("c", F.when(F.col("row_id").isin(0, 4), F.lit(1)))
    rounds = []
    monkeypatch.setattr(seeding, "stored", lambda df, of=seeding.stored: rounds.append(1) or of(df))
    kept = seeding.first_without_conflict(batch.repartition(8), [["a"], ["b"], ["c"]], "row_id")
    found = sorted(r["row_id"] for r in kept.select("row_id").collect())
    rows = [((i + 1) // 2, i // 2, 1 if shape != "one chain" and i in (0, 4) else None, i) for i in range(n)]
    assert found == [r[3] for r in one_by_one([], rows, [(0,), (1,), (2,)])]
    assert len(rounds) <= (20 if shape == "one chain" else 40)


@pytest.mark.parametrize("seed", range(3))
def test_three_keys_of_any_density(spark, seed):
    rng = random.Random(seed)
    rows = [tuple(rng.choice([None, *range(60 + 40 * seed)]) for _ in range(3)) + (i,) for i in range(300)]
    rows += [(0, None, None, 300 + i) for i in range(100)]
    batch = spark.createDataFrame(rows, "a INT, b INT, c INT, row_id INT").repartition(6)
    kept = seeding.first_without_conflict(batch, [["a"], ["b"], ["c"]], "row_id").collect()
    assert sorted(r["row_id"] for r in kept) == [r[3] for r in one_by_one([], rows, [(0,), (1,), (2,)])]


@pytest.mark.parametrize("few", [0, 100_000])
def test_only_rows_that_meet_others_are_judged_in_rounds(spark, monkeypatch, few):
    rows = [(i, i, -i) for i in range(1_000)] + [(1_000, 5, 5), (1_001, None, -7), (1_002, None, None), (1_003, 2_000, 2_000), (1_004, 3_000, 9), (1_005, 3_000, 3_000)]
    target = [(2_000, 1), (None, -3), (9_999, 9_999), (None, None), (1, 9), (2_000, None)]
    judged, rounds = [], seeding.first_without_conflict
    monkeypatch.setattr(seeding, "_FEW", few, raising=False)
    monkeypatch.setattr(seeding, "first_without_conflict", lambda df, *of: judged.append(df.count()) or rounds(df, *of))
    state = spark.createDataFrame(target, "a BIGINT, b INT")
    done = seeding.insert_or_skip(state, spark.createDataFrame(rows, "row_id BIGINT, a INT, b INT").repartition(5), [["a"], ["b"]])
    expected = one_by_one(target, [r[1:] for r in rows], [(0,), (1,)])
    assert sorted(values(done.returning), key=str) == sorted(expected, key=str)
    assert judged == [5]


def test_ids_follow_the_batch_order(spark):
    target = spark.createDataFrame([(5, "x")], "id BIGINT, name STRING")
    batch = spark.createDataFrame([(0, "c"), (1, "a"), (2, "x"), (3, "c"), (4, "b")], "row_id INT, name STRING")
    done = seeding.insert_or_skip(target, batch, [["name"]], "id")
    assert sorted(values(done.returning)) == [(6, "c"), (7, "a"), (8, "b")]
    again = seeding.insert_or_skip(done.state, batch, [["name"]], "id")
    assert again.returning.isEmpty()


def test_numbering_is_dense_and_ordered_with_a_hot_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("title"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = numbering.number_rows(df, ["title", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = sorted((r["row_num"], r["title"], r["id"]) for r in numbered.collect())
    assert [r[0] for r in rows] == list(range(1, 5001))
    assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)
    sizes = [r[1] for r in numbered.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2500


def test_numbering_nothing(spark):
    assert numbering.number_rows(spark.range(0), ["id"]).collect() == []


def test_lookup_of_two_rows_is_an_error(spark):
    parent = spark.createDataFrame([(1, "ART"), (2, "Art"), (3, "One")], "id INT, name STRING")
    rows = spark.createDataFrame([("one",), ("none",), (None,)], "p STRING")
    found = integrity.scalar_lookup(rows, parent, "p", "name", "id", "parent_id")
    assert sorted(values(found), key=str) == [(3,), (None,), (None,)]
    for missing in ("none", None):
        strict = integrity.scalar_lookup(spark.createDataFrame([(missing,)], "p STRING"), parent, "p", "name", "id", "parent_id", required=True)
        with pytest.raises(Exception, match="no id for"):
            strict.collect()
    twice = integrity.scalar_lookup(spark.createDataFrame([("art",)], "p STRING"), parent, "p", "name", "id", "parent_id")
    with pytest.raises(Exception, match="more than one id for ART"):
        twice.collect()


@pytest.fixture(scope="module")
def seeded(spark):
    """The seeded tables, read back from memory so that each test does not repeat the inserts' last steps."""
    return {name: df.cache() for name, df in auction.seed(auction.empty_tables(spark)).items()}


def test_seed_counts_and_rules(seeded):
    counts = {name: len(df.collect()) for name, df in seeded.items()}
    assert counts == {
        "country": 2, "city": 3, "category": 4, "address": 3, "location": 2, "buyer": 2, "seller": 2, "auction": 2,
        "employee": 3, "item": 3, "auction_item": 3, "lot": 3, "bid": 3, "sale": 2, "payment": 2,
    }
    assert integrity.audit_tables(seeded, auction.rules()).where("violations > 0").collect() == []


def test_seed_golden_rows(seeded):
    top = seeded["bid"].groupBy("lot_id").agg(F.max("bid_amount").alias("top"))
    highest = seeded["lot"].join(top, "lot_id", "left").select("lot_number", "top")
    assert {k: None if v is None else float(v) for k, v in values(highest)} == {"A-01": 650.0, "A-02": None, "B-01": 400.0}


def test_seeding_again(seeded):
    """Tables with a natural key stay, those without one double, and the doubled parent makes a lookup fail."""
    state = dict(seeded)
    for step in auction.SEED[:3]:
        keys = [list(k.columns) for k in auction.rules()[step.table].keys.values()][1:]
        state[step.table] = auction.seed_step(state, step, keys).state
    assert [state[n].count() for n in ("country", "city", "category")] == [2, 3, 6]
    with pytest.raises(Exception, match="more than one category_id for ART"):
        auction.seed_step(state, auction.SEED[3], [["category_name", "parent_category_id"]]).state.collect()
    bid = next(s for s in auction.SEED if s.table == "bid")
    assert auction.seed_step(seeded, bid, []).state.count() == 6
    item = next(s for s in auction.SEED if s.table == "auction_item")
    assert auction.seed_step(seeded, item, [["auction_id", "item_id"], ["auction_id", "display_order"]]).returning.isEmpty()


def test_broken_auction_rows_are_found(spark, seeded):
    more = spark.createDataFrame(
        [
            (3, "1999-12-31", 10, 20, 1, 1),
            (4, "2024-01-01", 20, 20, 9, 1),
            (4, None, None, 20, None, 1),
        ],
        "auction_id BIGINT, auction_date STRING, start_time INT, end_time INT, location_id BIGINT, category_id BIGINT",
    )
    more = more.withColumn("auction_date", F.to_date("auction_date"))
    broken = {**seeded, "auction": seeded["auction"].unionByName(more)}
    found = {r["constraint"]: r["violations"] for r in integrity.audit_table(broken, "auction", auction.rules()["auction"]).where("violations > 0").collect()}
    assert found == {
        "auction_date not null": 1,
        "start_time not null": 1,
        "location_id not null": 1,
        "date floor": 1,
        "ends after start": 1,
        "primary key": 1,
        "location_id in location": 1,
    }
    long_name = {**seeded, "country": spark.createDataFrame([(1, "x" * 100), (2, "x" * 101)], "country_id BIGINT, country_name STRING")}
    found = integrity.audit_table(long_name, "country", auction.rules()["country"]).where("violations > 0").collect()
    assert [(r["constraint"], r["violations"]) for r in found] == [("country_name at most 100 characters", 1)]


def test_numbering_carries_columns_without_an_order(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2})], "id INT, tags MAP<STRING, INT>")
    assert sorted(values(numbering.number_rows(df, ["id"], start=10))) == [(1, {"b": 2}, 10), (2, {"a": 1}, 11)]
