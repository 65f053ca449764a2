"""Surrogate keys, dimensions, fact, product."""

from datetime import date
from decimal import Decimal

from sorted_rows import as_tuples
from pyspark.sql import functions as F

from siltworks.operators import model
from siltworks.operators.keys import assign_keys


def test_keys_are_dense_and_depend_on_the_values_only(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    first = assign_keys(df.repartition(3), "k", "sk")
    second = assign_keys(df.repartition(11, "v"), "k", "sk")
    assert as_tuples(first, "k", "sk") == as_tuples(second, "k", "sk")
    assert first.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first() == (1, 5000, 5000)


def test_keys_of_composite_and_null_parts(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "a")], "a int, b string")
    assert sorted(r.sk for r in assign_keys(df, ["a", "b"], "sk").collect()) == [1, 2, 3]


def test_keys_need_no_single_task_sort_of_the_data(spark):
    keyed = assign_keys(spark.range(1000), "id", "sk")
    keyed.collect()
    plan = keyed._jdf.queryExecution().optimizedPlan().toString()
    # The one window without partitions numbers bucket counts, never rows.
    unpartitioned = [line for line in plan.splitlines() if "Window" in line and "windowspecdefinition(_bucket" in line and "sum(count" in line]
    rows = [line for line in plan.splitlines() if "Window" in line and "row_number" in line]
    assert len(unpartitioned) == 1 and len(rows) == 1 and "windowspecdefinition(_bucket" in rows[0]


def test_time_dimension(spark):
    dim = model.build_dim_time(spark)
    assert dim.count() == 15001
    saturday = dim.filter("full_date = DATE '1998-01-03'").first()
    assert tuple(saturday) == (19980103, date(1998, 1, 3), 1998, 1, "Q1", 3, True)
    assert dim.filter("is_weekend").select(F.min(F.weekday("full_date"))).first()[0] == 5


def snowflake(spark):
    products = spark.createDataFrame([(1, "p1", 10, 5, True), (2, "p2", 99, 5, False), (3, "p3", None, None, False)], "product_id int, product_name string, supplier_id int, category_id int, is_discontinued boolean")
    categories = model.build_dim(spark.createDataFrame([(5, "c")], "category_id int, category_name string"), "category_id", ["category_name"], "category_key")
    suppliers = model.build_dim(spark.createDataFrame([(10, "s")], "supplier_id int, company_name string"), "supplier_id", ["company_name"], "supplier_key")
    return model.build_dim_product(products, categories, suppliers)


def test_product_keeps_rows_without_parents(spark):
    assert as_tuples(snowflake(spark), "product_id", "category_key", "supplier_key", "discontinued") == [
        (1, 1, 1, True),
        (2, 1, None, False),
        (3, None, None, False),
    ]


def sales(spark):
    dims = {
        "dim_product": snowflake(spark),
        "dim_customer": model.build_dim(spark.createDataFrame([("A",), ("B",)], "customer_id string"), "customer_id", [], "customer_key"),
        "dim_employee": model.build_dim(spark.createDataFrame([(1, "Ann Lee", "UK"), (2, None, "UK")], "employee_id int, full_name string, country string"), "employee_id", ["full_name", "country"], "employee_key"),
        "dim_time": model.build_dim_time(spark),
    }
    orders = spark.createDataFrame([(1, "A", 1, date(1998, 1, 1)), (2, "X", 1, date(1998, 1, 1)), (3, "B", 2, date(1995, 12, 31)), (4, "B", 9, date(1998, 4, 1)), (5, "B", 1, date(1998, 2, 1))], "order_id int, customer_id string, employee_id int, order_date date")
    details = spark.createDataFrame([(1, 1, "10.00", 3, "0.10"), (1, 2, "1.00", 1, "0"), (2, 1, "5.00", 1, "0"), (3, 1, "5.00", 1, "0"), (4, 1, "5.00", 1, "0"), (5, 7, "5.00", 1, "0"), (5, 3, "0.01", 1, "0"), (8, 1, "5.00", 1, "0")], "order_id int, product_id int, unit_price string, quantity int, discount string")
    return details.withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")).withColumn("discount", F.col("discount").cast("decimal(4,2)")), orders, dims


def test_fact_and_what_it_drops(spark):
    details, orders, dims = sales(spark)
    fact = model.build_fact(details, orders, **dims)
    assert as_tuples(fact, "fact_key", "date_key", "total_amount") == [
        ("1-1", 19980101, Decimal("27.00")),
        ("1-2", 19980101, Decimal("1.00")),
        ("5-3", 19980201, Decimal("0.01")),
    ]
    dropped = model.dropped_lines(details, orders, **dims).first()
    # The line of order 8 has no header; it is no sales line.
    assert tuple(dropped) == (7, 3, 1, 1, 1, 1)


def test_seller_on_the_line(spark):
    details, orders, dims = sales(spark)
    by_line = model.build_fact(details.withColumn("employee_id", F.lit(2)), orders.drop("employee_id"), **dims)
    assert by_line.count() == 4
    assert by_line.select("employee_key").distinct().count() == 1


def test_sales_product(spark):
    details, orders, dims = sales(spark)
    fact = model.build_fact(details, orders, **dims)
    view = model.sales_by_employee(fact, dims["dim_employee"], dims["dim_time"], distinct_orders=True)
    got = as_tuples(view, "full_name", "quarter", "total_revenue", "total_orders", "average_order_value", "total_units_sold", "distinct_orders")
    # 28.01 / 3 = 9.3366…
    assert got == [("Ann Lee", "Q1", Decimal("28.01"), 3, Decimal("9.34"), 5, 2)]


def test_country_keys(spark):
    countries = spark.createDataFrame([("France ",), ("UK",)], "country_name string")
    dim = spark.createDataFrame([(1, " france"), (2, "uk"), (3, "Mars"), (4, None)], "id int, country string")
    resolved = model.resolve_country(dim, assign_keys(countries, "country_name", "country_key"))
    keys = {r.id: r.country_key for r in resolved.collect()}
    assert keys[3] is None and keys[4] is None and sorted([keys[1], keys[2]]) == [1, 2]
