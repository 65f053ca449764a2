"""Snowflake model: time, business dimensions, countries, the sales fact and its product."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import any_of, date_key, line_amount, normalised_name
from siltworks.operators.keys import assign_keys
from siltworks.sources.staging import generate_days
from siltworks.sources.tables import stamp

# First day and number of days of the standard time dimension.
TIME_START = "1996-01-01"
TIME_DAYS = 15001


def build_dim_time(spark: SparkSession, start: str = TIME_START, days: int = TIME_DAYS) -> DataFrame:
    day = F.col("full_date")
    return generate_days(spark, start, days).select(
        date_key(day).alias("date_key"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("quarter"),
        F.dayofmonth(day).alias("day"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    )


def build_dim(
    source: DataFrame, business_key: str, attributes: list[str], key_name: str, load_ts: datetime | None = None
) -> DataFrame:
    """Business key and attributes with a generated key; the business key must be unique."""
    return stamp(assign_keys(source.select(business_key, *attributes), business_key, key_name), load_ts)


def build_dim_product(
    products: DataFrame, dim_category: DataFrame, dim_supplier: DataFrame, load_ts: datetime | None = None
) -> DataFrame:
    """Products with the keys of both arms; a product whose parent is missing stays, with a null key.

    Products are numbered before the joins, so the joins run once. The arms carry no hint: Spark
    broadcasts whichever it finds small enough, and splits a hot category or supplier otherwise.
    """
    numbered = assign_keys(
        products.select("product_id", "product_name", "category_id", "supplier_id", "is_discontinued"),
        "product_id",
        "product_key",
    )
    return stamp(link_products(numbered, dim_category, dim_supplier), load_ts)


def link_products(numbered: DataFrame, dim_category: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    """Products that have their own key, with those of their category and supplier."""
    return (
        numbered.join(dim_category.select("category_id", "category_key"), "category_id", "left")
        .join(dim_supplier.select("supplier_id", "supplier_key"), "supplier_id", "left")
        .select(
            "product_key",
            "product_id",
            "product_name",
            "category_key",
            "supplier_key",
            F.col("is_discontinued").alias("discontinued"),
        )
    )


def sales_lines(order_details: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their header's customer, seller and day, and the line amount.

    A line that names its own seller keeps it.
    """
    own_seller = "employee_id" in order_details.columns
    header = ["order_id", "customer_id", "order_date", *([] if own_seller else ["employee_id"])]
    return order_details.join(orders.select(*header), "order_id").select(
        "order_id",
        "product_id",
        "customer_id",
        "employee_id",
        date_key("order_date").alias("date_key"),
        "quantity",
        "unit_price",
        "discount",
        line_amount("unit_price", "quantity", "discount").alias("total_amount"),
    )


FACT_COLUMNS = [
    "fact_key",
    "product_key",
    "customer_key",
    "employee_key",
    "date_key",
    "quantity",
    "unit_price",
    "discount",
    "total_amount",
]
# Columns of the fact that the data product is summed from.
SUMMED = ["date_key", "employee_key", "quantity", "total_amount"]


def build_fact(
    order_details: DataFrame,
    orders: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_time: DataFrame,
    load_ts: datetime | None = None,
) -> DataFrame:
    """Sales lines under surrogate keys. A line with an unknown member of any dimension drops out.

    What an order header knows (day, customer, and the seller unless the line names its own) is
    looked up once per order, before the lines: the largest table is joined to slim headers and
    to products only, of which the id and the key are read. The row is identified by order and
    product: ``fact_key`` joins the two ids, so it needs no numbering of the lines, and is unique
    if they are in ``order_details``. ``dropped_lines`` counts what is lost.
    """
    employees = dim_employee.select("employee_id", "employee_key")
    own_seller = "employee_id" in order_details.columns
    headers = (
        orders.withColumn("date_key", date_key("order_date"))
        .join(dim_time.select("date_key"), "date_key")
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id")
    )
    if own_seller:
        headers = headers.select("order_id", "date_key", "customer_key")
        lines = order_details.join(employees, "employee_id")
    else:
        headers = headers.join(employees, "employee_id").select("order_id", "date_key", "customer_key", "employee_key")
        lines = order_details
    fact = (
        lines.join(dim_product.select("product_id", "product_key"), "product_id")
        .join(headers, "order_id")
        .withColumn("fact_key", F.concat_ws("-", "order_id", "product_id"))
        .withColumn("total_amount", line_amount("unit_price", "quantity", "discount"))
    )
    return stamp(fact.select(*FACT_COLUMNS), load_ts)


def dropped_lines(
    order_details: DataFrame,
    orders: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_time: DataFrame,
) -> DataFrame:
    """Lines with a header, lines kept in the fact, and lines without a match per dimension.

    The joins are those of ``build_fact`` as left joins, each bringing one flag. Of a dimension
    only the business id is read, so any table that holds each id once will do.
    """

    def flagged(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
        return df.join(dim.select(key, F.lit(True).alias(f"_has_{key}")), key, "left")

    lines = flagged(order_details, dim_product, "product_id")
    headers = flagged(orders.withColumn("date_key", date_key("order_date")), dim_time, "date_key")
    headers = flagged(headers, dim_customer, "customer_id")
    if "employee_id" in order_details.columns:
        lines = flagged(lines, dim_employee, "employee_id")
        headers = headers.drop("employee_id")
    else:
        headers = flagged(headers, dim_employee, "employee_id")
    missing = {key: F.col(f"_has_{key}").isNull() for key in ("product_id", "customer_id", "employee_id", "date_key")}
    return lines.join(headers, "order_id").agg(
        F.count(F.lit(1)).alias("lines_in"),
        F.count_if(~any_of(list(missing.values()))).alias("lines_kept"),
        F.count_if(missing["product_id"]).alias("unknown_product"),
        F.count_if(missing["customer_id"]).alias("unknown_customer"),
        F.count_if(missing["employee_id"]).alias("unknown_employee"),
        F.count_if(missing["date_key"]).alias("unknown_date"),
    )


def build_dim_country(countries: DataFrame) -> DataFrame:
    """Eleven attributes of the current country rows, cut to their declared sizes, with a key."""
    return assign_keys(
        countries.select(
            F.substring("country_name", 1, 100).alias("country_name"),
            F.col("abbreviation"),
            F.substring("capital_city", 1, 100).alias("capital_city"),
            F.col("latitude").cast("decimal(10,6)").alias("latitude"),
            F.col("longitude").cast("decimal(10,6)").alias("longitude"),
            F.col("population"),
            F.col("gdp").cast("decimal(18,2)").alias("gdp"),
            F.col("currency_code"),
            F.substring("official_language", 1, 50).alias("official_language"),
            F.col("unemployment_rate_percent").cast("decimal(5,2)").alias("unemployment_rate"),
            F.col("cpi").cast("decimal(10,2)").alias("cpi"),
        ),
        "country_name",
        "country_key",
    )


def resolve_country(dim: DataFrame, dim_country: DataFrame, column: str = "country") -> DataFrame:
    """Fill ``country_key`` by country name, whatever its case and surrounding spaces.

    Of several countries with one name in that form the least key counts, so that no row is ever
    multiplied (``near_duplicate_names`` reports them). A name without a match gives a null key.
    """
    names = dim_country.groupBy(normalised_name("country_name").alias("_country")).agg(F.min("country_key").alias("country_key"))
    kept = [c for c in dim.columns if c != "country_key"]
    return dim.select(*kept).join(names, normalised_name(column) == F.col("_country"), "left").select(*kept, "country_key")


def seller_sums(fact: DataFrame, dim_time: DataFrame, sign: int = 1) -> DataFrame:
    """Sums of the fact per seller key, year and quarter, which can be added to those of other rows.

    ``sign`` -1 gives what has to be taken off when the rows go. The fact is summed before anything else
    is joined: a seller with a large share of the lines is combined on the map side.
    """
    measures = fact.select(*SUMMED)
    return (
        measures.join(dim_time.select("date_key", "year", "quarter"), "date_key")
        .groupBy("employee_key", "year", "quarter")
        .agg(
            (F.sum("total_amount") * F.lit(sign)).cast("decimal(28,2)").alias("revenue"),
            (F.count(F.lit(1)) * F.lit(sign)).alias("lines"),
            (F.sum("quantity").cast("long") * F.lit(sign)).alias("units"),
        )
    )


def sales_from_sums(sums: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Revenue, lines, mean line value and units per seller, year and quarter, from any number of partial sums.

    Groups whose lines have all gone have no row.
    """
    totals = (
        sums.groupBy("employee_key", "year", "quarter")
        .agg(
            F.sum("revenue").cast("decimal(18,2)").alias("total_revenue"),
            F.sum("lines").alias("total_orders"),
            F.sum("units").alias("total_units_sold"),
        )
        .filter("total_orders > 0")
    )
    return _with_sellers(totals, dim_employee)


def _with_sellers(totals: DataFrame, dim_employee: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    mean = (F.col("total_revenue") / F.col("total_orders").cast("decimal(20,0)")).cast("decimal(18,2)")
    return totals.join(dim_employee.select("employee_key", "full_name", "country"), "employee_key").select(
        "employee_key",
        "full_name",
        "country",
        "year",
        "quarter",
        "total_revenue",
        "total_orders",
        mean.alias("average_order_value"),
        "total_units_sold",
        *more,
    )


def sales_by_employee(
    fact: DataFrame, dim_employee: DataFrame, dim_time: DataFrame, distinct_orders: bool = False
) -> DataFrame:
    """Revenue, lines, mean line value and units per seller, year and quarter.

    ``total_orders`` counts order lines, the published meaning. The fact is summed per seller key
    and quarter before seller attributes are joined, so only sums meet the seller dimension.
    ``distinct_orders`` adds the number of distinct orders under its own name, which can't be had from partial sums.
    """
    if not distinct_orders:
        return sales_from_sums(seller_sums(fact, dim_time), dim_employee)
    totals = (
        fact.join(dim_time.select("date_key", "year", "quarter"), "date_key")
        .groupBy("employee_key", "year", "quarter")
        .agg(
            F.sum("total_amount").cast("decimal(18,2)").alias("total_revenue"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("quantity").cast("long").alias("total_units_sold"),
            F.count_distinct(F.substring_index("fact_key", "-", 1)).alias("distinct_orders"),
        )
    )
    return _with_sellers(totals, dim_employee, ("distinct_orders",))
