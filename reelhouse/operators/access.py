"""Audit reports over access metadata that is supplied as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def table_privileges(grants: DataFrame, schema: str, table: str | None = None) -> DataFrame:
    """Grants (table_schema, table_name, grantee, privilege_type) of a schema or one of its tables."""
    rows = grants.where(F.col("table_schema") == schema)
    if table is not None:
        rows = rows.where(F.col("table_name") == table)
    columns = ["table_schema", "table_name", "grantee", "privilege_type"]
    return rows.select(*columns).orderBy("table_name", "grantee", "privilege_type")


def role_flags(roles: DataFrame) -> DataFrame:
    """Roles with what they may do, by name."""
    flags = ["rolsuper", "rolcreaterole", "rolcreatedb", "rolcanlogin", "rolconnlimit"]
    return roles.select("rolname", *flags).orderBy("rolname")


def role_memberships(members: DataFrame) -> DataFrame:
    """Pairs of group role and member."""
    return members.select("role_name", "member_name").orderBy("role_name", "member_name")


def row_security_flags(tables: DataFrame, schema: str) -> DataFrame:
    """Which tables of a schema are under row security."""
    return (
        tables.where(F.col("schemaname") == schema)
        .select("schemaname", "tablename", "rowsecurity")
        .orderBy("tablename")
    )


def row_policies(policies: DataFrame, schema: str) -> DataFrame:
    """Row policies of a schema by table and name."""
    return (
        policies.where(F.col("schemaname") == schema)
        .select("schemaname", "tablename", "policyname", "roles", "cmd", "qual", "with_check")
        .orderBy("tablename", "policyname")
    )
