"""Rebuild of the dimensional model from the current versions of the memory tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from siltworks.operators.model import (
    TIME_DAYS,
    TIME_START,
    build_dim,
    build_dim_country,
    build_dim_product,
    build_dim_time,
    build_fact,
    resolve_country,
    sales_by_employee,
)
from siltworks.plans.views import enrichment_views, in_force


def _as_is(_: str, df: DataFrame) -> DataFrame:
    return df


def build_dimensions(
    spark: SparkSession,
    views: dict[str, DataFrame],
    load_ts: datetime | None = None,
    time_start: str = TIME_START,
    time_days: int = TIME_DAYS,
    keep: Callable[[str, DataFrame], DataFrame] = _as_is,
) -> dict[str, DataFrame]:
    """All dimensions from the enrichment views, parents before children.

    ``keep`` may store a finished dimension and return the stored one. Those that come later
    then read it instead of building it again, and Spark knows its size when it plans their
    joins, so that a small one is broadcast and a large one is not.
    """
    tables: dict[str, DataFrame] = {"dim_time": keep("dim_time", build_dim_time(spark, time_start, time_days))}
    if "enr_dim_countries" in views:
        tables["dim_country"] = keep("dim_country", build_dim_country(views["enr_dim_countries"]))

    def placed(dim: DataFrame) -> DataFrame:
        return resolve_country(dim, tables["dim_country"]) if "dim_country" in tables else dim

    def dimension(name: str, view: str, key: str, attributes: list[str], has_country: bool = False) -> DataFrame:
        dim = build_dim(views[view], key, attributes, f"{name.removeprefix('dim_')}_key", load_ts)
        return placed(dim) if has_country else dim

    tables["dim_category"] = keep(
        "dim_category", dimension("dim_category", "enr_dim_categories", "category_id", ["category_name"])
    )
    supplier = dimension("dim_supplier", "enr_dim_suppliers", "supplier_id", ["company_name", "country"], True)
    tables["dim_supplier"] = keep("dim_supplier", supplier.drop("country"))
    customer = ["company_name", "city", "country", "region"]
    tables["dim_customer"] = keep(
        "dim_customer", dimension("dim_customer", "enr_dim_customers", "customer_id", customer, True)
    )
    employee = ["full_name", "title", "city", "country", "region", "hire_date"]
    tables["dim_employee"] = keep(
        "dim_employee", dimension("dim_employee", "enr_dim_employees", "employee_id", employee, True)
    )
    tables["dim_product"] = keep(
        "dim_product",
        build_dim_product(views["enr_dim_products"], tables["dim_category"], tables["dim_supplier"], load_ts),
    )
    return tables


def fact_from(memory: dict[str, DataFrame], dimensions: dict[str, DataFrame], load_ts: datetime | None = None) -> DataFrame:
    """The fact, from the current order headers and lines and finished dimensions."""
    return build_fact(
        in_force(memory["order_details"]),
        in_force(memory["orders"]),
        dimensions["dim_product"],
        dimensions["dim_customer"],
        dimensions["dim_employee"],
        dimensions["dim_time"],
        load_ts,
    )


def rebuild_model(
    spark: SparkSession,
    memory: dict[str, DataFrame],
    load_ts: datetime | None = None,
    time_start: str = TIME_START,
    time_days: int = TIME_DAYS,
    keep: Callable[[str, DataFrame], DataFrame] = _as_is,
) -> dict[str, DataFrame]:
    """Dimensions, then the fact; ``keep`` as in ``build_dimensions``, for the fact as well."""
    views = enrichment_views(memory, register=False)
    tables = build_dimensions(spark, views, load_ts, time_start, time_days, keep)
    return {**tables, "fact_table": keep("fact_table", fact_from(memory, tables, load_ts))}


def sales_by_employee_view(tables: dict[str, DataFrame], register: bool = False) -> DataFrame:
    """The published data product."""
    view = sales_by_employee(tables["fact_table"], tables["dim_employee"], tables["dim_time"])
    if register:
        view.createOrReplaceTempView("vw_sales_by_employee")
    return view
