"""The exploratory profile of the staged tables: every report by name, each a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siltworks.functions import UNSIGNED_INTEGER
from siltworks.operators import profiling
from siltworks.operators.cleaning import castable_numbers
from siltworks.schemas import COMPLETENESS_COLUMNS, ENTITIES


def exploratory_profile(text: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Counts, completeness, cardinality, distribution and extremes of whatever is staged."""
    reports = {"row_counts": profiling.row_counts({ENTITIES[e].text_table: df for e, df in text.items()})}
    for entity, columns in COMPLETENESS_COLUMNS.items():
        if entity in text:
            reports[f"completeness_{entity}"] = profiling.completeness(
                text[entity], columns, ENTITIES[entity].text_table
            )
    masters = {e: (text[e], ENTITIES[e].keys[0]) for e in ("customers", "products", "suppliers") if e in text}
    if masters:
        reports["cardinality"] = profiling.cardinality(masters)
    origins = {e: (text[e], "country") for e in ("customers", "suppliers") if e in text}
    if origins:
        reports["countries_per_origin"] = profiling.distinct_per_source(origins)
    if "products" in text:
        reports |= _product_reports(text["products"])
    if "products" in text and "categories" in text:
        reports["products_per_category"] = profiling.count_by_parent(
            text["products"], "category_id", text["categories"], "category_id", "category_name", "product_count"
        )
    if "orders" in text:
        freight = castable_numbers(text["orders"], "freight")
        reports["highest_freight"] = profiling.top_rows(
            freight, "freight", "order_id", ["order_id", "customer_id", "ship_country", "freight"]
        )
    if "orders" in text and "customers" in text:
        reports["top_customers"] = profiling.top_groups(
            text["orders"], "customer_id", text["customers"], "customer_id", "customer_name", "order_count"
        )
    return reports


def _product_reports(products: DataFrame) -> dict[str, DataFrame]:
    priced = castable_numbers(products, "unit_price")
    stocked = castable_numbers(products, "units_in_stock", UNSIGNED_INTEGER)
    price, stock = ["product_name", "unit_price"], ["product_name", "units_in_stock"]
    return {
        "price_range": profiling.numeric_range(products, "unit_price"),
        "dearest_products": profiling.top_rows(priced, "unit_price", "product_id", price),
        "cheapest_products": profiling.bottom_rows(priced, "unit_price", "product_id", price),
        "most_stock": profiling.top_rows(stocked, "units_in_stock", "product_id", stock),
        "least_stock": profiling.bottom_rows(stocked, "units_in_stock", "product_id", stock, above_zero=True),
    }
