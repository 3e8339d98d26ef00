"""Value rules, keys and references, reported as data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reelhouse.functions.periods import Day, day_literal
from reelhouse.operators.joins import hot_join

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Unique:
    """A unique key; as a ``primary`` key it may hold no null either."""

    columns: tuple[str, ...]
    primary: bool = False


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Rules:
    """What must hold for one table."""

    checks: Mapping[str, Column]
    keys: Mapping[str, Unique]
    references: Mapping[str, ForeignKey]


def not_null(*columns: str) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}


def at_most(lengths: Mapping[str, int]) -> dict[str, Column]:
    """Texts no longer than so many characters."""
    return {f"{c} at most {n} characters": F.length(c) <= n for c, n in lengths.items()}


def after(column: str, floor: str) -> Column:
    """A date later than ``floor``."""
    return F.col(column) > F.lit(floor).cast("date")


def _broken(condition: Column) -> Column:
    return ~F.coalesce(condition, F.lit(True))


def violating_rows(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows that break a check, with the names of those broken; a null outcome passes."""
    names = F.array_compact(F.array(*[F.when(_broken(c), F.lit(n)) for n, c in checks.items()]))
    return df.withColumn("violations", names).where(F.size("violations") > 0)


def violation_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows that break each check, all checks in one pass over the table."""
    counted = df.agg(*[F.count_if(_broken(c)).alias(f"_{i}") for i, c in enumerate(checks.values())])
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"_{i}").alias("violations")) for i, n in enumerate(checks)]
    return counted.select(F.inline(F.array(*pairs)))


def _any_null(columns: tuple[str, ...] | list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def duplicate_keys(df: DataFrame, columns: list[str], primary: bool = False) -> DataFrame:
    """Keys held by more than one row, and how many rows hold them.

    Nulls differ from each other under a unique key, so keys with one are left out.
    Under a primary key any null is a violation in itself.
    """
    rows = df.select(*columns)
    if not primary:
        rows = rows.where(~_any_null(columns))
    grouped = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return grouped.where((F.col("n_rows") > 1) | _any_null(columns))


def orphan_keys(child: DataFrame, columns: list[str], parent: DataFrame, parent_columns: list[str]) -> DataFrame:
    """Referenced keys that the parent does not hold, and how many rows refer to them.

    The child is counted per key before the join. A reference with a null passes.
    """
    used = child.where(~_any_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    held = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns, strict=True)])
    return used.join(held, list(columns), "left_anti")


def audit_table(t: Tables, table: str, rules: Rules) -> DataFrame:
    """Rows (table, constraint, violations) for every rule of a table; see :func:`audit_tables`."""
    return audit_tables(t, {table: rules})


_CHECK, _UNIQUE, _REFERENCE = range(3)


def _comparable(df: DataFrame, column: str, other: DataFrame | None = None, theirs: str | None = None) -> Column:
    """A key column as text that is equal where the values are, in the type both sides of a reference compare in."""
    value, kind = F.col(f"`{column}`"), df.schema[column].dataType.simpleString()
    if other is not None:
        kind = df.select(F.coalesce(F.lit(None).cast(kind), F.lit(None).cast(other.schema[theirs].dataType)).alias("k")).schema["k"].dataType.simpleString()
        value = value.cast(kind)
    if kind in ("float", "double"):
        value = value + F.lit(0.0).cast(kind)  # -0.0 equals 0.0
    return F.hex(value) if kind == "binary" else value.cast("string")


def _entry(rule: int, kind: int, key: Column, rows: int, held: bool) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), key.alias("key"), F.lit(rows).cast("long").alias("n"), F.lit(held).alias("held"))


def audit_tables(t: Tables, rules: Mapping[str, Rules]) -> DataFrame:
    """Rows (table, constraint, violations) for every rule of the tables, all rules in one pass.

    Every row is expanded once to the (rule, key) pairs it takes part in: values that break
    a check, unique keys, keys that refer to a parent, and keys that a parent holds. One
    aggregate counts duplicates and orphans of all rules, so the plan has the same two
    shuffles for any number of rules, and a key with a third of the rows is folded before
    the first of them. A duplicated key counts the rows beyond its first, or all of them if
    it has a null; a reference with a null passes.
    """
    names: list[tuple[int, str, str]] = []
    entries: dict[str, list[Column]] = {}

    def add(table: str, entry: Column, condition: Column) -> None:
        entries.setdefault(table, []).append(F.when(condition, entry))

    no_key = F.lit(None).cast("array<string>")
    for table, of_table in rules.items():
        df = t[table]

        def number(name: str, table: str = table) -> int:
            names.append((len(names), table, name))
            return len(names) - 1

        for name, condition in of_table.checks.items():
            add(table, _entry(number(name), _CHECK, no_key, 1, True), _broken(condition))
        for name, key in of_table.keys.items():
            columns = F.array(*[_comparable(df, c) for c in key.columns])
            add(table, _entry(number(name), _UNIQUE, columns, 1, True), F.lit(True) if key.primary else ~_any_null(key.columns))
        for name, ref in of_table.references.items():
            parent, rule = t[ref.parent], number(name)
            pairs = list(zip(ref.columns, ref.parent_columns, strict=True))
            add(table, _entry(rule, _REFERENCE, F.array(*[_comparable(df, c, parent, p) for c, p in pairs]), 1, False), ~_any_null(ref.columns))
            add(ref.parent, _entry(rule, _REFERENCE, F.array(*[_comparable(parent, p, df, c) for c, p in pairs]), 0, True), ~_any_null(ref.parent_columns))
    spark = t[next(iter(rules))].sparkSession
    # Rules that no row takes part in are reported too.
    zeros = spark.range(1).select(F.inline(F.array(*[_entry(rule, _CHECK, no_key, 0, True) for rule, _, _ in names])))
    parts = [t[table].select(F.inline(F.array_compact(F.array(*found)))) for table, found in entries.items()]
    grouped = reduce(DataFrame.unionByName, parts, zeros).groupBy("rule", "key").agg(
        F.max("kind").alias("kind"), F.sum("n").alias("n"), F.bool_or("held").alias("held")
    )
    surplus = F.col("n") - F.when(F.exists("key", F.isnull), 0).otherwise(1)
    violations = F.when(F.col("kind") == _CHECK, F.col("n")).when(F.col("kind") == _UNIQUE, surplus).otherwise(F.when(~F.col("held"), F.col("n")).otherwise(0))
    totals = grouped.groupBy("rule").agg(F.sum(violations).alias("violations"))
    labels = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(name).alias("constraint")) for _, table, name in names])
    label = F.get(labels, F.col("rule"))
    # As many rows as rules, in their order.
    return totals.coalesce(1).sortWithinPartitions("rule").select(label["table"].alias("table"), label["constraint"].alias("constraint"), "violations")


def add_column_if_missing(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column filled with ``value``; one that is there stays as it is."""
    return df if name in df.columns else df.withColumn(name, value)


def add_record_date(t: Tables, as_of: Day = None, name: str = "record_ts") -> dict[str, DataFrame]:
    """Give every table the column with the day its rows were recorded."""
    return {table: add_column_if_missing(df, name, day_literal(as_of)) for table, df in t.items()}


def scalar_lookup(
    rows: DataFrame,
    parent: DataFrame,
    match: str,
    against: str | Column,
    value: str,
    name: str,
    any_case: bool = True,
    required: bool = False,
) -> DataFrame:
    """Replace the text in ``match`` by the ``value`` of the parent row it names, as column ``name``.

    No such row gives null, which is an error if the column is ``required``; more than
    one row is always an error, as for a scalar subquery.
    """
    against = F.col(against) if isinstance(against, str) else against
    fold = F.upper if any_case else (lambda c: c)
    found = parent.groupBy(fold(against).alias("_match")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_value")
    )
    joined = hot_join(rows.withColumn("_match", fold(F.col(match))), found, ["_match"], "left")
    kind = parent.schema[value].dataType
    named = F.coalesce(F.col("_match"), F.lit("null"))
    many = F.raise_error(F.concat(F.lit(f"more than one {value} for "), named)).cast(kind)
    missing = F.raise_error(F.concat(F.lit(f"no {value} for "), named)).cast(kind)
    resolved = F.when(F.col("_n") > 1, many)
    if required:
        resolved = resolved.when(F.col("_value").isNull(), missing)
    resolved = resolved.otherwise(F.col("_value"))
    drop = {"_match", "_n", "_value", match} - {name}
    return joined.withColumn(name, resolved).drop(*drop)
