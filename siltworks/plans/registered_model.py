"""Registered queries: dimensions, fact, data product, catalog operations."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators import catalog, cleaning, model
from siltworks.operators.integrity import union_all
from siltworks.operators.quality import RESULT_SCHEMA
from siltworks.plans import views
from siltworks.plans.rebuild import rebuild_model, sales_by_employee_view
from siltworks.plans.registered_checks import supplied_nations
from siltworks.plans.registered_loading import typed_country_frame
from siltworks.plans.testbed import (
    CUSTOMERS,
    LOADED,
    ORDER_DETAILS,
    ORDERS,
    PRODUCTS,
    SELLERS,
    TXT_COUNTRIES,
    TXT_CUSTOMERS,
    Catalogue,
    table,
)
from siltworks.plans.warehouse import Warehouse
from siltworks.session import scratch_path

catalogue = Catalogue()

# The test orders begin before the standard time dimension does.
START, DAYS = "1995-01-01", model.TIME_DAYS


def _arms(part: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categories and suppliers of the products: their types and their brands."""
    categories = part.selectExpr("p_type AS category_id", "p_type AS category_name").distinct()
    brands = part.selectExpr("p_brand AS supplier_id", "p_brand AS company_name", "'none' AS country").distinct()
    return categories, brands


def memory_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The driver's tables as memory tables of the warehouse."""
    categories, brands = _arms(table(spark, folder, "part"))
    return {
        "products": PRODUCTS.frame(spark, folder),
        "customers": CUSTOMERS.frame(spark, folder),
        "employees": SELLERS.frame(spark, folder),
        "categories": categories,
        "suppliers": brands,
        "orders": ORDERS.frame(spark, folder),
        "order_details": ORDER_DETAILS.frame(spark, folder),
    }


def ranked(key: str) -> str:
    """The number ``assign_keys`` gives, in SQL."""
    return f"row_number() OVER (ORDER BY substring(md5(CAST({key} AS VARCHAR)), 1, 4), {key})"


_DAY = f"(SELECT CAST(DATE '{START}' + CAST(i AS INTEGER) AS DATE) AS d FROM range({DAYS}) t(i))"
_DIM_TIME = f"""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
    CAST(month(d) AS INTEGER) AS month, 'Q' || quarter(d) AS quarter, CAST(day(d) AS INTEGER) AS day,
    isodow(d) IN (6, 7) AS is_weekend FROM {_DAY}"""


@catalogue.register(
    f"""SELECT t.*, coalesce(o.n, 0) AS order_count FROM ({_DIM_TIME}) t
        LEFT JOIN (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS k, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1) o ON o.k = t.date_key"""
)
def dim_time_usage(spark, folder) -> DataFrame:
    """Every day of the time dimension with the orders that fall on it."""
    from siltworks.functions import date_key

    per_day = table(spark, folder, "orders").groupBy(date_key("o_orderdate").alias("date_key")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    calendar = model.build_dim_time(spark, START, DAYS)
    return calendar.join(per_day, "date_key", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0)))


@catalogue.register(
    f"""SELECT {ranked('customer_id')} AS customer_key, customer_id, company_name, city, country, region,
               DATE '2020-01-01' AS load_date FROM ({CUSTOMERS.sql})"""
)
def dim_customer(spark, folder) -> DataFrame:
    dim = model.build_dim(
        views.customers_view(CUSTOMERS.frame(spark, folder)),
        "customer_id",
        ["company_name", "city", "country", "region"],
        "customer_key",
        LOADED,
    )
    return dim.withColumn("load_date", F.to_date("load_date"))


_DIM_EMPLOYEE = f"""SELECT {ranked('employee_id')} AS employee_key, employee_id, first_name || ' ' || last_name AS full_name,
    title, city, country, region, hire_date FROM ({SELLERS.sql})"""


@catalogue.register(_DIM_EMPLOYEE)
def dim_employee(spark, folder) -> DataFrame:
    return _dim_employee(spark, folder).drop("load_date")


def _dim_employee(spark, folder) -> DataFrame:
    return model.build_dim(
        views.employees_view(SELLERS.frame(spark, folder)),
        "employee_id",
        ["full_name", "title", "city", "country", "region", "hire_date"],
        "employee_key",
        LOADED,
    )


_DIM_CATEGORY = f"SELECT {ranked('category_id')} AS category_key, category_id FROM (SELECT DISTINCT p_type AS category_id FROM part)"
_DIM_SUPPLIER = f"SELECT {ranked('supplier_id')} AS supplier_key, supplier_id FROM (SELECT DISTINCT p_brand AS supplier_id FROM part)"
_DIM_PRODUCT = f"""SELECT {ranked('product_id')} AS product_key, product_id, product_name, category_key, supplier_key,
    coalesce(discontinued = 1, FALSE) AS discontinued FROM ({PRODUCTS.sql}) p
    LEFT JOIN ({_DIM_CATEGORY}) c ON p.category_id = c.category_id LEFT JOIN ({_DIM_SUPPLIER}) s ON p.supplier_id = s.supplier_id"""


@catalogue.register(_DIM_PRODUCT)
def dim_product(spark, folder) -> DataFrame:
    """Both arms of the snowflake; a product of an unknown category keeps its row."""
    return _dim_product(spark, folder).drop("load_date")


def _kept(spark: SparkSession):
    """Stores a finished table, so that those that use it don't build it again."""

    def keep(name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


def _product_keys(spark, folder) -> DataFrame:
    """Id and key of the products: all that the lines need of them."""
    products = views.products_view(PRODUCTS.frame(spark, folder))
    return model.build_dim(products, "product_id", [], "product_key", LOADED)


def _dim_product(spark, folder) -> DataFrame:
    """The arms are stored before the products meet them, as in a run."""
    keep = _kept(spark)
    categories, arms = _arms(table(spark, folder, "part"))
    categories = keep(
        "categories",
        model.build_dim(views.categories_view(categories), "category_id", ["category_name"], "category_key", LOADED),
    )
    arms = keep(
        "arms", model.build_dim(views.suppliers_view(arms), "supplier_id", ["company_name"], "supplier_key", LOADED)
    )
    return model.build_dim_product(views.products_view(PRODUCTS.frame(spark, folder)), categories, arms, LOADED)


_SALES = f"""SELECT d.order_id, d.product_id, o.customer_id, d.employee_id, CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_key,
    d.quantity, d.unit_price, d.discount,
    CAST(CAST(d.unit_price * d.quantity AS DECIMAL(18,2)) * (1 - d.discount) AS DECIMAL(12,2)) AS total_amount
    FROM ({ORDER_DETAILS.sql}) d JOIN ({ORDERS.sql}) o ON d.order_id = o.order_id"""


@catalogue.register(_SALES)
def sales_lines(spark, folder) -> DataFrame:
    return views.sales_view(ORDER_DETAILS.frame(spark, folder), ORDERS.frame(spark, folder))


# Customers in debt are not in the dimension, so their lines drop out of this fact.
_SOLVENT = f"SELECT {ranked('customer_id')} AS customer_key, customer_id FROM ({CUSTOMERS.sql}) WHERE region IS NOT NULL"
_FACT = f"""SELECT CAST(s.order_id AS VARCHAR) || '-' || CAST(s.product_id AS VARCHAR) AS fact_key, product_key, customer_key, employee_key, s.date_key,
    quantity, unit_price, discount, total_amount FROM ({_SALES}) s
    JOIN ({_DIM_PRODUCT}) p ON s.product_id = p.product_id JOIN ({_SOLVENT}) c ON s.customer_id = c.customer_id
    JOIN ({_DIM_EMPLOYEE}) e ON s.employee_id = e.employee_id JOIN ({_DIM_TIME}) t ON s.date_key = t.date_key"""


def _solvent_customers(spark, folder) -> DataFrame:
    return model.build_dim(
        views.customers_view(CUSTOMERS.frame(spark, folder)).filter("region IS NOT NULL"),
        "customer_id",
        ["company_name"],
        "customer_key",
        LOADED,
    )


@catalogue.register(_FACT)
def fact_sales(spark, folder) -> DataFrame:
    return model.build_fact(
        ORDER_DETAILS.frame(spark, folder),
        ORDERS.frame(spark, folder),
        _product_keys(spark, folder),
        _solvent_customers(spark, folder),
        _dim_employee(spark, folder),
        model.build_dim_time(spark, START, DAYS),
        LOADED,
    ).drop("load_date")


@catalogue.register(
    f"""WITH s AS ({_SALES}), c AS ({_SOLVENT})
        SELECT CAST(count(*) AS BIGINT) AS lines_in, CAST(count(*) FILTER (known AND dated) AS BIGINT) AS lines_kept,
               CAST(0 AS BIGINT) AS unknown_product, CAST(count(*) FILTER (NOT known) AS BIGINT) AS unknown_customer,
               CAST(0 AS BIGINT) AS unknown_employee, CAST(count(*) FILTER (NOT dated) AS BIGINT) AS unknown_date
        FROM (SELECT customer_id IN (SELECT customer_id FROM c) AS known, date_key >= 19960101 AS dated FROM s)"""
)
def dropped_lines(spark, folder) -> DataFrame:
    """What the inner joins lose: customers in debt, and days before the standard calendar."""
    return model.dropped_lines(
        ORDER_DETAILS.frame(spark, folder),
        ORDERS.frame(spark, folder),
        PRODUCTS.frame(spark, folder),
        views.customers_view(CUSTOMERS.frame(spark, folder)).filter("region IS NOT NULL"),
        SELLERS.frame(spark, folder),
        model.build_dim_time(spark),
    )


def _by_seller(sales: str) -> str:
    """Revenue per seller and quarter; the mean is rounded half up in whole numbers."""
    return f"""SELECT employee_key, full_name, country, year, quarter, CAST(rev AS DECIMAL(18,2)) AS total_revenue,
        CAST(n AS BIGINT) AS total_orders,
        CAST(CAST((CAST(rev * 100 AS HUGEINT) * 2 + n) // (2 * n) AS DECIMAL(20,2)) / 100 AS DECIMAL(18,2)) AS average_order_value,
        CAST(units AS BIGINT) AS total_units_sold FROM (
            SELECT employee_key, full_name, country, CAST(floor(date_key / 10000) AS INTEGER) AS year,
                   'Q' || CAST((date_key // 100) % 100 + 2 AS INTEGER) // 3 AS quarter,
                   sum(total_amount) AS rev, count(*) AS n, sum(quantity) AS units
            FROM ({sales}) s JOIN ({_DIM_EMPLOYEE}) e ON s.employee_id = e.employee_id GROUP BY ALL)"""


@catalogue.register(_by_seller(_SALES))
def sales_by_seller_quarter(spark, folder) -> DataFrame:
    """The data product over the whole order history: lines, keys, fact, seller and quarter."""
    employees = _dim_employee(spark, folder)
    calendar = model.build_dim_time(spark, START, DAYS)
    customers = model.build_dim(
        views.customers_view(CUSTOMERS.frame(spark, folder)), "customer_id", ["company_name"], "customer_key", LOADED
    )
    products = _product_keys(spark, folder)
    lines, orders = ORDER_DETAILS.frame(spark, folder), ORDERS.frame(spark, folder)
    fact = model.build_fact(lines, orders, products, customers, employees, calendar, LOADED)
    return model.sales_by_employee(fact, employees, calendar)


@catalogue.register(
    f"""SELECT 'dim_time' AS table_name, CAST({DAYS} AS BIGINT) AS row_count UNION ALL SELECT 'dim_category', count(DISTINCT p_type) FROM part
        UNION ALL SELECT 'dim_supplier', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'dim_customer', count(*) FROM customer
        UNION ALL SELECT 'dim_employee', count(*) FROM supplier UNION ALL SELECT 'dim_product', count(*) FROM part
        UNION ALL SELECT 'fact_table', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def model_rebuild(spark, folder) -> DataFrame:
    """All tables of a rebuild, counted."""
    tables = rebuild_model(spark, memory_tables(spark, folder), LOADED, START, DAYS, _kept(spark))
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t, df in tables.items()]
    )


@catalogue.register(_by_seller(_SALES))
def model_rebuild_product(spark, folder) -> DataFrame:
    """The published view over a rebuilt model."""
    return sales_by_employee_view(rebuild_model(spark, memory_tables(spark, folder), LOADED, START, DAYS, _kept(spark)))


@catalogue.register(
    f"""WITH t AS ({TXT_COUNTRIES.sql})
        SELECT {ranked('country_name')} AS country_key, country_name, substring(nullif(abbreviation, 'NULL'), 1, 5) AS abbreviation,
               nullif(capital_city, '') AS capital_city, CAST(latitude AS DECIMAL(10,6)) AS latitude,
               CAST(CASE WHEN longitude LIKE '%.' THEN NULL ELSE longitude END AS DECIMAL(10,6)) AS longitude,
               CAST(replace(population, ',', '') AS BIGINT) AS population, CAST(trim(replace(gdp, '$', '')) AS DECIMAL(18,2)) AS gdp,
               substring(currency_code, 1, 10) AS currency_code, official_language,
               CAST(replace(unemployment_rate_percent, '%', '') AS DECIMAL(5,2)) AS unemployment_rate,
               CAST(replace(cpi, ',', '') AS DECIMAL(10,2)) AS cpi FROM t"""
)
def dim_country(spark, folder) -> DataFrame:
    return model.build_dim_country(views.countries_view(typed_country_frame(spark, folder)))


_LARGE = "SELECT * FROM nation WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000)"


@catalogue.register(
    f"""SELECT c.customer_id, c.country, n.country_key FROM ({TXT_CUSTOMERS.sql}) c
        LEFT JOIN (SELECT min(country_key) AS country_key, lower(trim(n_name)) AS n_name
                   FROM (SELECT {ranked('n_name')} AS country_key, n_name FROM (
                       SELECT n_name FROM ({_LARGE}) UNION ALL SELECT ' ' || upper(n_name) FROM ({_LARGE}) WHERE n_regionkey > 1))
                   GROUP BY 2) n
        ON lower(trim(c.country)) = n.n_name"""
)
def country_resolve(spark, folder) -> DataFrame:
    """Country keys by name, whatever its case and spaces; nations without a large supplier are
    unknown to the dimension, and some are in it twice under two spellings."""
    nations = supplied_nations(spark, folder)
    again = nations.filter("n_regionkey > 1").selectExpr("' ' || upper(n_name) AS country_name")
    nations = nations.selectExpr("n_name AS country_name").unionByName(again)
    countries = model.assign_keys(nations, "country_name", "country_key")
    customers = TXT_CUSTOMERS.frame(spark, folder).select("customer_id", "country")
    return model.resolve_country(customers, countries)


@catalogue.register(
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' WHEN 'AUTOMOBILE' THEN 'Vehicles' ELSE c_mktsegment END AS c_mktsegment,
              coalesce(r_name, CAST(c_nationkey AS VARCHAR)) AS place
       FROM customer LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA') n
       ON n_nationkey = c_nationkey"""
)
def country_recode(spark, folder) -> DataFrame:
    """Listed values replaced, by a literal mapping and by a mapping table; others stay."""
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey", "c_mktsegment", "CAST(c_nationkey AS STRING) AS place"
    )
    regions = table(spark, folder, "region").filter("r_name <> 'ASIA'")
    mapping = (
        table(spark, folder, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("CAST(n_nationkey AS STRING) AS code", "r_name")
    )
    recoded = cleaning.recode(customers, "c_mktsegment", {"BUILDING": "Construction", "AUTOMOBILE": "Vehicles"})
    return cleaning.recode_with(recoded, "place", mapping, "code", "r_name")


@catalogue.register(
    """SELECT c_custkey, CASE WHEN s_acctbal >= 0 THEN s_name ELSE c_name END AS c_name,
              CASE WHEN s_suppkey IS NOT NULL THEN 'PATCHED' ELSE c_mktsegment END AS c_mktsegment
       FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey"""
)
def patch_by_key(spark, folder) -> DataFrame:
    """Attributes overwritten by key; a null in a patch leaves the value."""
    patches = table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS c_custkey", "CASE WHEN s_acctbal >= 0 THEN s_name END AS c_name", "'PATCHED' AS c_mktsegment"
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return cleaning.patch_by_key(customers, patches, "c_custkey")


@catalogue.register(
    """SELECT c_nationkey AS nation, c_mktsegment AS segment, 'customer' AS origin FROM (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0)
       UNION ALL
       SELECT DISTINCT s_nationkey, 'BUILDING', 'supplier' FROM supplier s WHERE NOT EXISTS (
           SELECT 1 FROM customer c WHERE c.c_acctbal < 0 AND c.c_nationkey = s.s_nationkey AND c.c_mktsegment = 'BUILDING')"""
)
def insert_if_absent(spark, folder) -> DataFrame:
    known = table(spark, folder, "customer").filter("c_acctbal < 0")
    known = known.selectExpr("c_nationkey AS nation", "c_mktsegment AS segment", "'customer' AS origin").distinct()
    rows = table(spark, folder, "supplier")
    rows = rows.selectExpr("s_nationkey AS nation", "'BUILDING' AS segment", "'supplier' AS origin").distinct()
    return catalog.insert_if_absent(known, rows, ["nation", "segment"])


@catalogue.register(
    """SELECT c_custkey, 'PRIORITY' AS c_mktsegment FROM customer WHERE c_acctbal > 9000"""
)
def update_where(spark, folder) -> DataFrame:
    """Rewrite a column where a condition holds, then list the rows concerned."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    _, listed = catalog.update_and_list(
        customers, F.col("c_acctbal") > 9000, "c_mktsegment", "PRIORITY", F.col("c_mktsegment") == "PRIORITY"
    )
    return listed.select("c_custkey", "c_mktsegment")


# A warehouse that three batches bring to its last state. At first it lacks customers in debt, sellers in
# debt, large products, orders in process and dear lines; urgent orders name a customer that nobody knows, returned lines
# have one piece too many. The batches bring or correct these, and take the customer from finished orders of low priority.
_UNIQUE_LINES = """SELECT l_orderkey AS order_id, l_partkey AS product_id, max(l_suppkey) AS employee_id,
    max(CAST(l_extendedprice AS DECIMAL(10,2))) AS unit_price, max(CAST(l_quantity AS INTEGER)) AS quantity,
    max(CAST(l_discount AS DECIMAL(4,2))) AS discount, max(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2"""
_NOBODY = "-1"
_LAST_ORDERS = f"""SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'F' AND o_orderpriority LIKE '5%' THEN {_NOBODY} ELSE o_custkey END AS customer_id,
    CAST(o_orderdate AS DATE) AS order_date FROM orders"""
_LAST_SALES = f"""SELECT CAST(d.order_id AS VARCHAR) || '-' || CAST(d.product_id AS VARCHAR) AS fact_key, d.product_id, o.customer_id, d.employee_id,
    CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_key, d.quantity, d.unit_price, d.discount,
    CAST(CAST(d.unit_price * d.quantity AS DECIMAL(18,2)) * (1 - d.discount) AS DECIMAL(12,2)) AS total_amount
    FROM ({_UNIQUE_LINES}) d JOIN ({_LAST_ORDERS}) o ON d.order_id = o.order_id WHERE o.customer_id <> {_NOBODY}"""
_BATCH_DAYS = [datetime(2020, 2, d, tzinfo=timezone.utc) for d in (1, 2, 3)]


def _first_state_and_batches(spark, folder) -> tuple[dict[str, DataFrame], list[dict[str, DataFrame]]]:
    memory = memory_tables(spark, folder)
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")).agg(
        F.max("l_suppkey").alias("employee_id"),
        F.max(F.col("l_extendedprice").cast("decimal(10,2)")).alias("unit_price"),
        F.max(F.col("l_quantity").cast("int")).alias("quantity"),
        F.max(F.col("l_discount").cast("decimal(4,2)")).alias("discount"),
        F.max("l_returnflag").alias("flag"),
    )
    lines = _kept(spark)("unique-lines", lines)
    columns = [c for c in lines.columns if c != "flag"]
    returned, dear = F.col("flag") == "R", (F.col("flag") != "R") & (F.col("unit_price") > 50_000)
    one_more = (F.col("quantity") + returned.cast("int")).alias("quantity")

    def heads(condition: str, customer: str) -> DataFrame:
        return orders.filter(condition).selectExpr("o_orderkey AS order_id", f"{customer} AS customer_id", "CAST(o_orderdate AS DATE) AS order_date")

    known = f"CASE WHEN o_orderpriority LIKE '1%' THEN CAST({_NOBODY} AS BIGINT) ELSE o_custkey END"
    low = "o_orderstatus = 'F' AND o_orderpriority LIKE '5%'"
    first = {
        **memory,
        "customers": memory["customers"].filter("region IS NOT NULL"),
        "employees": memory["employees"].filter("last_name IS NOT NULL"),
        "products": memory["products"].filter("discontinued IS NOT NULL"),
        "orders": heads("o_orderstatus <> 'P'", known),
        "order_details": lines.filter(~dear).select(*[one_more if c == "quantity" else c for c in columns]),
    }
    batches = [
        {"customers": memory["customers"].filter("region IS NULL"), "orders": heads("o_orderstatus = 'P'", "o_custkey")},
        {
            "products": memory["products"].filter("discontinued IS NULL"),
            "employees": memory["employees"].filter("last_name IS NULL"),
            "order_details": lines.filter(dear | returned).select(*columns),
        },
        {"orders": heads(f"o_orderpriority LIKE '1%' AND NOT ({low})", "o_custkey").unionByName(heads(low, f"CAST({_NOBODY} AS BIGINT)"))},
    ]
    return first, batches


def _maintained(spark, folder) -> Warehouse:
    first, batches = _first_state_and_batches(spark, folder)
    warehouse = Warehouse(spark, scratch_path(spark, "maintained"))
    warehouse.load_memory(first, spark.createDataFrame([], RESULT_SCHEMA), LOADED, LOADED)
    warehouse.rebuild(LOADED, START, DAYS)
    for n, batch in enumerate(batches):
        warehouse.apply_batch(batch, n + 2, _BATCH_DAYS[n], _BATCH_DAYS[n])
    return warehouse


@catalogue.register(_LAST_SALES)
def model_after_batches(spark, folder) -> DataFrame:
    """The fact after three batches kept up by affected keys, under business ids: what a full rebuild gives."""
    warehouse = _maintained(spark, folder)
    fact = warehouse.model("fact_table").drop("year", "load_date")
    for dim, key_id in (("product", "product_id"), ("customer", "customer_id"), ("employee", "employee_id")):
        fact = fact.join(warehouse.model(f"dim_{dim}").select(f"{dim}_key", key_id), f"{dim}_key").drop(f"{dim}_key")
    return fact


@catalogue.register(f"SELECT * EXCLUDE (employee_key) FROM ({_by_seller(_LAST_SALES)})")
def sales_after_batches(spark, folder) -> DataFrame:
    """The data product from the stored sums of the fact and the changes that three batches have appended."""
    return _maintained(spark, folder).sales_by_employee().drop("employee_key")
