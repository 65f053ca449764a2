"""Enrichment views over the memory tables; each is a DataFrame and a named view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import full_name, is_one
from siltworks.operators.history import current_rows
from siltworks.operators.model import sales_lines
from siltworks.operators.typed import to_typed
from siltworks.schemas import ENTITIES
from siltworks.sources.tables import stamp

# Entities that the model is built from.
MODEL_SOURCES = ("categories", "suppliers", "products", "customers", "employees", "orders", "order_details")


def in_force(df: DataFrame) -> DataFrame:
    """Current versions, or all rows of a table that keeps no history."""
    return current_rows(df) if "active" in df.columns else df


def products_view(products: DataFrame) -> DataFrame:
    return in_force(products).select(
        "product_id",
        "product_name",
        "supplier_id",
        "category_id",
        "quantity_per_unit",
        "unit_price",
        is_one("discontinued").alias("is_discontinued"),
    )


def employees_view(employees: DataFrame) -> DataFrame:
    return in_force(employees).select(
        "employee_id",
        full_name("first_name", "last_name").alias("full_name"),
        "title",
        "city",
        "country",
        "region",
        "hire_date",
    )


def customers_view(customers: DataFrame) -> DataFrame:
    return in_force(customers).select("customer_id", "company_name", "city", "country", "region")


def categories_view(categories: DataFrame) -> DataFrame:
    return in_force(categories).select("category_id", "category_name")


def suppliers_view(suppliers: DataFrame) -> DataFrame:
    """The country comes along so that the supplier dimension can resolve its country key."""
    return in_force(suppliers).select("supplier_id", "company_name", "country")


def sales_view(order_details: DataFrame, orders: DataFrame) -> DataFrame:
    return sales_lines(in_force(order_details), in_force(orders))


def countries_view(countries: DataFrame) -> DataFrame:
    return in_force(countries).select(
        "country_name",
        "abbreviation",
        "capital_city",
        "latitude",
        "longitude",
        "population",
        "gdp",
        "currency_code",
        "official_language",
        F.col("unemployment_rate_percent"),
        "cpi",
    )


def empty_memory(spark: SparkSession, entity: str) -> DataFrame:
    """A memory table without rows, as it is before its first load or while the gate blocks it."""
    typed = to_typed(spark.createDataFrame([], ENTITIES[entity].text_schema), entity)
    return stamp(typed.withColumn("active", F.lit(True)))


def with_empty_tables(spark: SparkSession, memory: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The memory tables, with an empty one for each that the model needs and memory lacks."""
    return {**{e: empty_memory(spark, e) for e in MODEL_SOURCES if e not in memory}, **memory}


def enrichment_views(memory: dict[str, DataFrame], register: bool = True) -> dict[str, DataFrame]:
    """All views over the memory tables, by name; country needs the country table."""
    views = {
        "enr_dim_products": products_view(memory["products"]),
        "enr_dim_employees": employees_view(memory["employees"]),
        "enr_dim_customers": customers_view(memory["customers"]),
        "enr_dim_categories": categories_view(memory["categories"]),
        "enr_dim_suppliers": suppliers_view(memory["suppliers"]),
        "enr_fact_table": sales_view(memory["order_details"], memory["orders"]),
    }
    if "countries" in memory:
        views["enr_dim_countries"] = countries_view(memory["countries"])
    if register:
        for name, view in views.items():
            view.createOrReplaceTempView(name)
    return views
