from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from reelhouse.operators import integrity
from rental import values


def test_null_outcome_passes_and_rows_name_all_broken_rules(spark):
    df = spark.createDataFrame([(1, 5), (None, -1), (-2, None), (3, 9)], "a INT, b INT")
    checks = {**integrity.not_null("a"), "a positive": F.col("a") > 0, "b small": F.col("b") < 6}
    assert values(integrity.violation_counts(df, checks)) == [("a not null", 1), ("a positive", 1), ("b small", 1)]
    rows = {(r["a"], r["b"]): r["violations"] for r in integrity.violating_rows(df, checks).collect()}
    assert rows == {(None, -1): ["a not null"], (-2, None): ["a positive"], (3, 9): ["b small"]}


def test_keys(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (1, None), (2, "x")], "a INT, b STRING")
    assert values(integrity.duplicate_keys(df, ["a", "b"])) == [(1, "x", 2)]
    primary = sorted(values(integrity.duplicate_keys(df, ["a", "b"], primary=True)), key=str)
    assert primary == [(1, "x", 2), (1, None, 2)]


def test_references(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 9), (4, 9)], "id INT, parent INT")
    assert values(integrity.orphan_keys(tree, ["parent"], tree, ["id"])) == [(9, 2)]


def test_audit(spark):
    tables = {
        "parent": spark.createDataFrame([(1,), (2,)], "id INT"),
        "child": spark.createDataFrame([(1, 1, 5), (1, 3, -5), (None, 3, None), (2, None, 1)], "id INT, parent INT, n INT"),
    }
    rules = integrity.Rules(
        checks={"n": F.col("n") >= 0},
        keys={"id": integrity.Unique(("id",), primary=True)},
        references={"parent": integrity.ForeignKey(("parent",), "parent", ("id",))},
    )
    assert values(integrity.audit_table(tables, "child", rules)) == [("child", "n", 1), ("child", "id", 2), ("child", "parent", 2)]


def test_record_date_is_added_once(spark):
    t = {"a": spark.range(1), "b": spark.range(1)}
    once = integrity.add_record_date(t, "2024-01-01")
    twice = integrity.add_record_date(once, "2025-01-01")
    assert values(twice["a"]) == [(0, dt.date(2024, 1, 1))]
    assert twice["b"].columns == ["id", "record_ts"]


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_an_audit_has_two_shuffles_for_any_number_of_rules(spark):
    child = spark.createDataFrame(
        [(1, 10, 0.0, "a", b"x"), (2, 10, -0.0, "a", b"x"), (None, 11, 1.5, None, None), (4, 99, None, "b", b"y"), (4, None, 2.0, "b", b"z")],
        "id INT, parent INT, d DOUBLE, s STRING, b BINARY",
    )
    parent = spark.createDataFrame([(10, "p"), (11, "q"), (11, "q"), (None, None)], "pid BIGINT, name STRING")
    few = {"child": integrity.Rules({}, {"id": integrity.Unique(("id",), primary=True)}, {"up": integrity.ForeignKey(("parent",), "parent", ("pid",))})}
    many = {
        "child": integrity.Rules(
            {f"id above {i}": F.col("id") > i for i in range(5)} | integrity.not_null("s"),
            {"id": integrity.Unique(("id",), primary=True), "d": integrity.Unique(("d",)), "s, b": integrity.Unique(("s", "b")), "s": integrity.Unique(("s",))}
            | {f"k{i}": integrity.Unique(("id", "parent")) for i in range(5)},
            {"up": integrity.ForeignKey(("parent",), "parent", ("pid",)), "odd": integrity.ForeignKey(("d",), "parent", ("pid",))},
        ),
        "parent": integrity.Rules({}, {"pid": integrity.Unique(("pid",), primary=True)}, {"down": integrity.ForeignKey(("pid",), "child", ("parent",))}),
    }
    t = {"child": child, "parent": parent}
    assert exchanges(integrity.audit_tables(t, few)) == exchanges(integrity.audit_tables(t, many)) == 2
    found = {(r["table"], r["constraint"]): r["violations"] for r in integrity.audit_tables(t, many).collect()}
    assert len(found) == 19
    assert {k: v for k, v in found.items() if v} == {
        ("child", "id above 1"): 1, ("child", "id above 2"): 2, ("child", "id above 3"): 2, ("child", "id above 4"): 4,
        ("child", "s not null"): 1, ("child", "id"): 2, ("child", "d"): 1, ("child", "s, b"): 1, ("child", "s"): 2,
        ("child", "up"): 1, ("child", "odd"): 4, ("parent", "pid"): 2,
    }
    empty = {name: df.limit(0) for name, df in t.items()}
    none = integrity.audit_tables(empty, many).collect()
    assert len(none) == 19 and all(r["violations"] == 0 for r in none)
