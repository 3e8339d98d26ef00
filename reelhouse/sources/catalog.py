"""Table access, with row policies and column grants applied at the door."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelhouse.operators.joins import hot_join, in_keys

Tables = Mapping[str, DataFrame]


class Catalog(Mapping[str, DataFrame]):
    """Parquet tables under one root, read with their declared schemas."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str], suffix: str = "") -> None:
        self._spark = spark
        self._root = root.rstrip("/")
        self._schemas = schemas
        self._suffix = suffix

    def path(self, name: str) -> str:
        return f"{self._root}/{name}{self._suffix}"

    def __getitem__(self, name: str) -> DataFrame:
        return self._spark.read.schema(self._schemas[name]).parquet(self.path(name))

    def __iter__(self) -> Iterator[str]:
        return iter(self._schemas)

    def __len__(self) -> int:
        return len(self._schemas)

    def register_views(self) -> None:
        """Give every table a temporary view of the same name for ``spark.sql``."""
        for name in self:
            self[name].createOrReplaceTempView(name)


@dataclass(frozen=True)
class RowPolicy:
    """Rows of ``table`` that ``principal`` may see.

    Either ``condition`` holds on the row itself, or the row's ``on`` columns appear
    in ``keys``, a DataFrame with those columns taken from another table.
    """

    table: str
    principal: str
    condition: Column | None = None
    keys: DataFrame | None = None
    on: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if (self.condition is None) == (self.keys is None):
            raise ValueError("a row policy needs either a condition or keys")
        if self.keys is not None and not self.on:
            raise ValueError("a policy through another table needs the columns to match on")


@dataclass(frozen=True)
class ColumnGrant:
    """Columns of ``table`` that ``principal`` may read, all of them if none are named."""

    table: str
    principal: str
    columns: tuple[str, ...] | None = None


def visible_rows(df: DataFrame, policies: list[RowPolicy]) -> DataFrame:
    """Rows that at least one policy lets through; none at all without a policy.

    Conditions are met first, on the row itself: only the rows that they leave are matched
    with keys, so what a condition lets through is never shuffled.
    """
    if not policies:
        return df.where(F.lit(False))
    conditions = [F.coalesce(p.condition, F.lit(False)) for p in policies if p.condition is not None]
    keyed = [p for p in policies if p.keys is not None]
    passed = reduce(Column.__or__, conditions) if conditions else None
    if not keyed:
        return df.where(passed)
    rest = df if passed is None else df.where(~passed)
    if len(keyed) == 1:
        found = in_keys(rest, keyed[0].keys, list(keyed[0].on))
    else:
        marks = []
        for number, policy in enumerate(keyed):
            marks.append(f"_policy_{number}")
            keys = policy.keys.select(*policy.on).distinct().withColumn(marks[-1], F.lit(True))
            rest = hot_join(rest, keys, list(policy.on), "left")
        found = rest.where(reduce(Column.__or__, [F.col(m).isNotNull() for m in marks])).select(*df.columns)
    return found if passed is None else df.where(passed).unionByName(found)


class RestrictedTables(Mapping[str, DataFrame]):
    """The tables as one principal sees them.

    ``secured`` names the tables under row security: without a policy for the
    principal such a table shows no rows, and other tables are not filtered. With
    ``grants``, a table or column not granted to the principal raises when it is asked
    for; without them every column is open.
    """

    def __init__(
        self,
        tables: Tables,
        principal: str,
        policies: list[RowPolicy] = (),
        grants: list[ColumnGrant] | None = None,
        secured: frozenset[str] | set[str] = frozenset(),
    ) -> None:
        self._tables = tables
        self._principal = principal
        self._policies = [p for p in policies if p.principal == principal]
        self._grants = None if grants is None else [g for g in grants if g.principal == principal]
        self._secured = set(secured)

    def __getitem__(self, name: str) -> DataFrame:
        return self.read(name)

    def __iter__(self) -> Iterator[str]:
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)

    def allowed_columns(self, name: str) -> list[str]:
        columns = self._tables[name].columns
        if self._grants is None:
            return columns
        granted = {c for g in self._grants if g.table == name for c in (g.columns or columns)}
        if not granted:
            raise PermissionError(f"{self._principal} may not read {name}")
        return [c for c in columns if c in granted]

    def read(self, name: str, columns: list[str] | None = None) -> DataFrame:
        allowed = self.allowed_columns(name)
        wanted = allowed if columns is None else columns
        denied = [c for c in wanted if c not in allowed]
        if denied:
            raise PermissionError(f"{self._principal} may not read {', '.join(denied)} of {name}")
        df = self._tables[name]
        if name in self._secured:
            df = visible_rows(df, [p for p in self._policies if p.table == name])
        return df.select(*wanted)
