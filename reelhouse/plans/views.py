"""Temporary views for users of ``spark.sql``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from reelhouse.operators.reports import sales_by_category_quarter


def create_views(t: Mapping[str, DataFrame]) -> None:
    """Register the revenue of the current quarter, and the customer columns that are open to everyone."""
    # The names of the views.
    sales_by_category_quarter(t).createOrReplaceTempView("sales_revenue_by_category_qtr")
    t["customer"].select("customer_id", "first_name", "last_name").createOrReplaceTempView("customer_public_info")
