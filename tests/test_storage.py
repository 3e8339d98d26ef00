from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import size_label
from reelhouse.operators import change, footprint
from reelhouse.sources import create_table_as, drop_table, publish, truncate_table
from rental import values


def test_size_labels(spark):
    # Sizes and labels the published experiment printed, then the edges of a unit.
    known = {602415104: "575 MB", 401653760: "383 MB", 8192: "8192 bytes", 0: "0 bytes", 10239: "10239 bytes", 10240: "10 kB"}
    known |= {1536 * 1024: "1536 kB", 10 * 1024**2 - 513: "10239 kB", 10 * 1024**2 - 512: "10 MB", 20 * 1024**4: "20 TB"}
    df = spark.createDataFrame([(n,) for n in known], "n BIGINT")
    assert dict(values(df.select("n", size_label(F.col("n"))))) == known


def test_footprint_shrinks_after_a_delete(spark, tmp_path):
    before = create_table_as(change.bulk_load(spark, 3000).repartition(3), str(tmp_path / "before"))
    after = create_table_as(change.delete_every_nth(before).state, str(tmp_path / "after"))
    report = footprint.footprints({"before": before, "after": after})
    rows = {r["table_name"]: r for r in report.collect()}
    on_disk = sum(f.stat().st_size for f in (tmp_path / "before").glob("*.parquet"))
    assert (rows["before"]["files"], rows["before"]["row_count"], rows["before"]["table_bytes"]) == (3, 3000, on_disk)
    assert rows["after"]["row_count"] == 2000
    assert rows["after"]["table_bytes"] < rows["before"]["table_bytes"]
    assert [r[0] for r in values(footprint.footprints({"a_x": before, "b": before}, "a%"))] == ["a_x"]


def test_create_refuses_an_existing_folder(spark, tmp_path):
    create_table_as(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exist"):
        create_table_as(spark.range(3), str(tmp_path / "t"))


def test_publish_switches_to_the_new_state(spark, tmp_path):
    name = "published_numbers"
    drop_table(spark, name)
    publish(spark, {name: spark.range(6).withColumn("n", F.col("id") * 2)}, str(tmp_path), "first")
    live = spark.table(name)
    assert live.count() == 6
    done = change.delete_where(live, F.col("n") > 6)
    folders = publish(spark, {name: done.state}, str(tmp_path), "second")
    assert folders == {name: f"{tmp_path}/{name}/second"}
    assert sorted(values(spark.table(name))) == [(0, 0), (1, 2), (2, 4), (3, 6)]
    with pytest.raises(Exception, match="(?i)exist"):
        publish(spark, {name: done.state}, str(tmp_path), "second")
    drop_table(spark, name)


def test_clustered_files_do_not_overlap(spark, tmp_path):
    name = "clustered_days"
    drop_table(spark, name)
    days = spark.range(4000).select(F.expr("IF(id % 3 = 0, 7, pmod(xxhash64(id), 100))").alias("day"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        publish(spark, {name: days}, str(tmp_path), "first", cluster_by={name: ["day"]})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.table(name).groupBy(F.input_file_name().alias("file"))
    ranges = sorted(r[1:] for r in values(files.agg(F.min("day"), F.max("day"), F.count(F.lit(1)))))
    assert len(ranges) > 4 and sum(r[2] for r in ranges) == 4000
    assert all(before[1] <= after[0] for before, after in zip(ranges, ranges[1:]))
    assert max(r[2] for r in ranges) < 1000
    drop_table(spark, name)


def test_truncate(spark, tmp_path):
    name = "table_to_empty"
    drop_table(spark, name)
    spark.sql(f"CREATE TABLE {name} (id BIGINT) USING parquet")
    spark.range(5).write.insertInto(name)
    truncate_table(spark, name)
    assert spark.table(name).isEmpty()
    drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
