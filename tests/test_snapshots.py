"""Changes that write the touched files only, against the changes of whole tables; footprints against the disk."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import change, footprint
from reelhouse.sources import snapshots
from rental import values


@pytest.fixture(scope="module")
def numbers(spark, tmp_path_factory):
    """10,000 rows in 100 files, in ranges of the id."""
    root = tmp_path_factory.mktemp("snapshots")
    rows = spark.range(10_000).select("id", (F.col("id") % 7).alias("n"), F.lit(None).cast("string").alias("note"))
    ranged = rows.repartitionByRange(100, "id").sortWithinPartitions("id")
    return snapshots.create_snapshot(ranged, f"{root}/numbers/first"), root


def names(state):
    return {r["name"] for r in state.files().collect()}


def test_one_deleted_row_rewrites_one_file(spark, numbers):
    state, root = numbers
    assert len(names(state)) == 100
    keys = spark.createDataFrame([(4321,)], "id BIGINT")
    done = snapshots.rewrite(state, f"{root}/numbers/one", lambda t: change.delete_matching(t, keys, ["id"]), keys, ["id"])
    assert len(done.rewritten) == 1 and done.kept == 99
    assert len(names(done.state) & names(state)) == 99
    whole = change.delete_matching(state.table(), keys, ["id"])
    assert sorted(values(done.state.table())) == sorted(values(whole.state))
    assert values(done.returning) == values(whole.returning) == [(4321, 4321 % 7, None)]
    assert state.table().count() == 10_000  # the state before is still there


def test_update_by_keys_and_return_the_latest(spark, numbers):
    state, root = numbers
    updates = spark.createDataFrame([(5, "a"), (7000, "b"), (7001, "c"), (99_999, "d")], "id BIGINT, note STRING")
    done = snapshots.rewrite(state, f"{root}/numbers/two", lambda t: change.update_from(t, updates, ["id"]), updates, ["id"])
    whole = change.update_from(state.table(), updates, ["id"])
    assert len(done.rewritten) == 2
    assert sorted(values(done.state.table()), key=str) == sorted(values(whole.state), key=str)
    assert sorted(values(done.returning)) == sorted(values(whole.returning))
    again = snapshots.append(done.state, spark.createDataFrame([(20_000, 1, "new")], done.state.schema), f"{root}/numbers/three")
    assert names(done.state) < names(again) and again.table().count() == 10_001
    latest = spark.createDataFrame([(20_000, "newer")], "id BIGINT, note STRING")
    third = snapshots.rewrite(again, f"{root}/numbers/four", lambda t: change.update_from(t, latest, ["id"]), latest, ["id"])
    assert len(third.rewritten) == 1 and values(third.state.table().where("id = 20000")) == [(20_000, 1, "newer")]


def test_delete_by_a_condition(spark, numbers):
    state, root = numbers
    gone = (F.col("id") >= 150) & (F.col("id") < 420)
    done = snapshots.rewrite(state, f"{root}/numbers/five", lambda t: change.delete_where(t, gone), condition=gone)
    assert len(done.rewritten) in (4, 5) and done.state.table().count() == 10_000 - 270
    assert done.state.table().where(gone).isEmpty()


def test_nothing_touched_and_everything_deleted(spark, numbers):
    state, root = numbers
    keys = spark.createDataFrame([(-1,), (None,)], "id BIGINT")
    done = snapshots.rewrite(state, f"{root}/numbers/six", lambda t: change.delete_matching(t, keys, ["id"]), keys, ["id"])
    assert done.rewritten == [] and names(done.state) == names(state) and done.returning.isEmpty()
    none = spark.createDataFrame([], "id BIGINT")
    assert snapshots.touched_files(state, none, ["id"]) == []
    every = F.lit(True)
    empty = snapshots.rewrite(state, f"{root}/numbers/seven", lambda t: change.delete_where(t, every), condition=every)
    assert empty.kept == 0 and empty.state.table().isEmpty()
    more = snapshots.rewrite(empty.state, f"{root}/numbers/eight", lambda t: change.delete_where(t, every), condition=every)
    assert more.state.table().isEmpty() and more.rewritten == names(empty.state) - names(more.state) or more.rewritten == []


def test_a_failed_write_leaves_the_state(spark, numbers):
    state, root = numbers
    keys = spark.createDataFrame([(1,)], "id BIGINT")
    broken = lambda t: change.Change(t.where(F.raise_error(F.lit("broken")).cast("boolean")), t)
    with pytest.raises(Exception, match="broken"):
        snapshots.rewrite(state, f"{root}/numbers/nine", broken, keys, ["id"])
    assert state.table().count() == 10_000
    with pytest.raises(Exception, match="(?i)exist"):
        snapshots.create_snapshot(spark.range(1), f"{root}/numbers/first")


def test_bounds_of_the_keys_reach_the_reader(spark, numbers):
    state, _ = numbers
    keys = spark.createDataFrame([(4321,), (4330,)], "id BIGINT")
    rows = snapshots._within_bounds(state.table().select("id"), keys, ["id"])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "GreaterThanOrEqual(id,4321), LessThanOrEqual(id,4330)" in rows._jdf.queryExecution().explainString(mode)


def test_footprint_of_a_rewrite_is_that_on_disk(spark, numbers):
    state, root = numbers
    keys = spark.createDataFrame([(1,), (5000,)], "id BIGINT")
    done = snapshots.rewrite(state, f"{root}/numbers/ten", lambda t: change.delete_matching(t, keys, ["id"]), keys, ["id"])
    found = {r["table_name"]: r for r in footprint.rewrite_footprint(spark, state.paths(), done.state.paths()).collect()}
    on_disk = lambda paths: sum(Path(p.removeprefix("file:")).stat().st_size for p in paths)
    dead = set(state.paths()) - set(done.state.paths())
    assert {k: (r["files"], r["row_count"], r["table_bytes"]) for k, r in found.items()} == {
        "before": (100, 10_000, on_disk(state.paths())),
        "after": (len(done.state.paths()), 9_998, on_disk(done.state.paths())),
        "dead": (2, 200, on_disk(dead)),
    }


def test_rows_are_counted_in_the_footers(spark, numbers):
    state, _ = numbers
    df = footprint.counted_in_footers(spark, state.paths())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and df.first()["row_count"] == 10_000
    assert "FileScan parquet" in state.table()._jdf.queryExecution().executedPlan().toString()
    (row,) = footprint.files_footprint(spark, [], "none").collect()
    assert (row["files"], row["row_count"], row["table_bytes"]) == (0, 0, 0)
