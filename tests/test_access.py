from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import access
from reelhouse.sources import Catalog, ColumnGrant, RestrictedTables, RowPolicy
from rental import values

CLIENT = "client_two"


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "rental": spark.createDataFrame([(1, 2), (2, 2), (3, 5), (4, None)], "rental_id INT, customer_id INT"),
        "sale": spark.createDataFrame([(1, 2), (2, 1)], "sale_id INT, buyer_id INT"),
        "payment": spark.createDataFrame(
            [(1, 1, dt.date(2024, 3, 16), 650, "CARD"), (2, 2, dt.date(2024, 4, 21), 400, "TRANSFER")],
            "payment_id INT, sale_id INT, payment_date DATE, payment_amount INT, payment_method STRING",
        ),
        "customer": spark.createDataFrame([(1, "A", "a@x")], "customer_id INT, first_name STRING, email STRING"),
    }


@pytest.fixture(scope="module")
def client(tables):
    own_sales = tables["sale"].where("buyer_id = 1")
    policies = [
        RowPolicy("rental", CLIENT, condition=F.col("customer_id") == 2),
        RowPolicy("sale", CLIENT, condition=F.col("buyer_id") == 1),
        RowPolicy("payment", CLIENT, keys=own_sales.select("sale_id"), on=("sale_id",)),
        RowPolicy("payment", "somebody_else", condition=F.lit(True)),
    ]
    grants = [ColumnGrant("customer", CLIENT, ("customer_id",)), ColumnGrant("customer", CLIENT, ("first_name",))]
    grants += [ColumnGrant(name, CLIENT) for name in ("rental", "sale", "payment")]
    return RestrictedTables(tables, CLIENT, policies, grants, {"rental", "sale", "payment"})


def test_own_rows_only(client):
    assert values(client["rental"].select("customer_id").distinct()) == [(2,)]
    assert values(client["sale"].select("buyer_id").distinct()) == [(1,)]
    assert values(client["payment"]) == [(2, 2, dt.date(2024, 4, 21), 400, "TRANSFER")]


def test_no_policy_means_no_rows(tables):
    nobody = RestrictedTables(tables, "nobody", secured={"rental"})
    assert nobody["rental"].isEmpty()
    assert nobody["sale"].count() == 2


def test_several_policies_add_up(tables):
    policies = [
        RowPolicy("payment", CLIENT, keys=tables["sale"].where("buyer_id = 1"), on=("sale_id",)),
        RowPolicy("payment", CLIENT, keys=tables["sale"].where("buyer_id = 1"), on=("sale_id",)),
        RowPolicy("payment", CLIENT, condition=F.col("payment_method") == "CARD"),
    ]
    assert RestrictedTables(tables, CLIENT, policies, secured={"payment"})["payment"].count() == 2


def test_columns(client):
    assert client["customer"].columns == ["customer_id", "first_name"]
    with pytest.raises(PermissionError, match="email of customer"):
        client.read("customer", ["email"])


def test_a_table_without_a_grant_is_denied(tables):
    grants = [ColumnGrant("customer", "somebody_else"), ColumnGrant("sale", CLIENT)]
    client = RestrictedTables(tables, CLIENT, grants=grants)
    assert client["sale"].columns == ["sale_id", "buyer_id"]
    with pytest.raises(PermissionError, match="may not read customer"):
        client["customer"]


def test_a_policy_needs_one_kind_of_predicate(tables):
    with pytest.raises(ValueError):
        RowPolicy("payment", CLIENT)
    with pytest.raises(ValueError):
        RowPolicy("payment", CLIENT, keys=tables["sale"])


def test_audits(spark):
    grants = spark.createDataFrame(
        [("public", "rental", "r", "UPDATE"), ("public", "customer", "u", "SELECT"), ("public", "customer", "p", "DELETE"), ("other", "x", "p", "SELECT")],
        "table_schema STRING, table_name STRING, grantee STRING, privilege_type STRING",
    )
    assert [r[1:3] for r in values(access.table_privileges(grants, "public"))] == [("customer", "p"), ("customer", "u"), ("rental", "r")]
    assert [r[2] for r in values(access.table_privileges(grants, "public", "customer"))] == ["p", "u"]

    members = spark.createDataFrame([("b", "m"), ("a", "z"), ("a", "m")], "role_name STRING, member_name STRING")
    assert values(access.role_memberships(members)) == [("a", "m"), ("a", "z"), ("b", "m")]

    flags = spark.createDataFrame(
        [("rental", False, False, False, False, -1), ("postgres", True, True, True, True, -1)],
        "rolname STRING, rolsuper BOOLEAN, rolcreaterole BOOLEAN, rolcreatedb BOOLEAN, rolcanlogin BOOLEAN, rolconnlimit INT",
    )
    assert [r[0] for r in values(access.role_flags(flags))] == ["postgres", "rental"]

    secured = spark.createDataFrame([("public", "store", False), ("public", "actor", True), ("x", "a", True)], "schemaname STRING, tablename STRING, rowsecurity BOOLEAN")
    assert values(access.row_security_flags(secured, "public")) == [("public", "actor", True), ("public", "store", False)]

    policies = spark.createDataFrame(
        [("public", "sale", "b", "r", "SELECT", "q", None), ("public", "sale", "a", "r", "SELECT", "q", None)],
        "schemaname STRING, tablename STRING, policyname STRING, roles STRING, cmd STRING, qual STRING, with_check STRING",
    )
    assert [r[2] for r in values(access.row_policies(policies, "public"))] == ["a", "b"]


def test_catalog_reads_declared_schemas(spark, tmp_path):
    spark.createDataFrame([(1, "x", 9)], "id INT, name STRING, extra INT").write.parquet(str(tmp_path / "thing.parquet"))
    catalog = Catalog(spark, str(tmp_path), {"thing": "id INT, name STRING"}, suffix=".parquet")
    assert catalog["thing"].dtypes == [("id", "int"), ("name", "string")]
    catalog.register_views()
    assert spark.sql("SELECT name FROM thing").collect()[0][0] == "x"


def test_what_a_condition_lets_through_is_not_matched_with_keys(spark):
    rows = spark.createDataFrame([(i, i % 5, None if i % 7 == 0 else "R" if i % 3 else "N") for i in range(200)], "id INT, k INT, flag STRING")
    keys = [spark.createDataFrame([(k,), (k,)], "k INT") for k in (1, 3)]
    by_flag = RowPolicy("t", "me", condition=F.col("flag") == "R")
    by_key = [RowPolicy("t", "me", keys=k, on=("k",)) for k in keys]
    for policies, expected in (
        ([by_flag, by_key[0]], lambda i: (i % 7 and i % 3) or i % 5 == 1),
        ([by_flag, *by_key], lambda i: (i % 7 and i % 3) or i % 5 in (1, 3)),
        (by_key, lambda i: i % 5 in (1, 3)),
        ([by_flag], lambda i: i % 7 and i % 3),
    ):
        seen = RestrictedTables({"t": rows}, "me", policies, secured={"t"})["t"]
        assert sorted(r["id"] for r in seen.collect()) == [i for i in range(200) if expected(i)]
    plan = RestrictedTables({"t": rows}, "me", [by_flag, by_key[0]], secured={"t"})["t"]._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join") :]
    assert "NOT coalesce((flag" in below and "LeftSemi" in below
