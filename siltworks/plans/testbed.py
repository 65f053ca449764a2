"""The driver's tables in the roles of the warehouse.

Text staging is derived from the typed tables by SQL expressions that Spark and DuckDB read
alike, so that both engines start from the same text. Defects follow from values the rows
have (segment, priority, sign of a balance), never from a selection of ids.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

LOADED = datetime(2020, 1, 1, tzinfo=timezone.utc)
CHANGED = datetime(2020, 2, 1, tzinfo=timezone.utc)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Its footer is read for the schema once per process, not at every use."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


class Derived:
    """A staging or typed table derived from one driver table, for both engines."""

    def __init__(self, source: str, columns: dict[str, str]):
        self.source = source
        self.columns = columns

    def frame(self, spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, self.source).selectExpr(*[f"{e} AS {c}" for c, e in self.columns.items()])

    @property
    def sql(self) -> str:
        listed = ", ".join(f"{e} AS {c}" for c, e in self.columns.items())
        return f"SELECT {listed} FROM {self.source}"


def _money(column: str, precision: int = 12) -> str:
    return f"CAST({column} AS DECIMAL({precision},2))"


_ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"

TXT_CUSTOMERS = Derived(
    "customer",
    {
        "customer_id": "CASE WHEN c_acctbal < -900 THEN '  ' ELSE CAST(c_custkey AS STRING) END",
        "customer_name": "CASE WHEN c_mktsegment = 'FURNITURE' THEN c_name || ' (' || c_mktsegment || ')' ELSE c_name END",
        "regions": "CASE c_mktsegment WHEN 'BUILDING' THEN 'NULL' WHEN 'MACHINERY' THEN '' ELSE c_mktsegment END",
        "country": (
            "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '  NATION_' WHEN 'HOUSEHOLD' THEN 'Nation_' "
            "ELSE 'nation_' END || CAST(c_nationkey AS STRING) || "
            "CASE WHEN c_acctbal < 0 THEN ' ' ELSE '' END"
        ),
        "phone": "CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS STRING) || '-' || CAST(c_custkey AS STRING) END",
        "balance": f"CAST({_money('c_acctbal')} AS STRING)",
    },
)

TXT_ORDERS = Derived(
    "orders",
    {
        "order_id": "CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'P' ELSE '' END || CAST(o_orderkey AS STRING)",
        "customer_id": "CAST(o_custkey AS STRING)",
        "ship_via": "CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'NULL' ELSE substring(o_orderpriority, 1, 1) END",
        "order_date": (
            f"CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN replace({_ORDER_DAY}, '-', '/') || ' 00:00:00' "
            f"WHEN '2' THEN '' WHEN '5' THEN {_ORDER_DAY} || ' 00:00:00.000' ELSE {_ORDER_DAY} || ' 00:00:00' END"
        ),
        "freight": (
            f"CAST({_money('o_totalprice')} AS STRING) || "
            "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '5' ELSE '' END"
        ),
        "shipped": "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE o_orderstatus END",
    },
)

TXT_ORDER_DETAILS = Derived(
    "lineitem",
    {
        "order_id": "CAST(l_orderkey AS STRING)",
        "product_id": "CASE WHEN l_quantity = 50 THEN '' ELSE CAST(l_partkey AS STRING) END",
        "unit_price": f"CAST({_money('l_extendedprice')} AS STRING)",
        "quantity": (
            "CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END || CAST(CAST(l_quantity AS INTEGER) AS STRING) || "
            "CASE WHEN l_quantity = 1 THEN '.0' ELSE '' END"
        ),
        "discount": f"CAST({_money('l_discount', 4)} AS STRING) || CASE WHEN l_linestatus = 'F' THEN '0' ELSE '' END",
    },
)

TXT_PRODUCTS = Derived(
    "part",
    {
        "product_id": "CAST(p_partkey AS STRING)",
        "product_name": "p_name",
        "category": "CASE WHEN p_size > 45 THEN 'NULL' WHEN p_size < 3 THEN '' ELSE p_type END",
        "unit_price": f"CASE WHEN p_size < 10 THEN '$' ELSE '' END || CAST({_money('p_retailprice')} AS STRING)",
        "units_in_stock": "CASE WHEN p_size > 40 THEN '-' ELSE '' END || CAST(p_size AS STRING)",
        "discontinued": "CASE p_type WHEN 'ECONOMY' THEN 'TRUE' WHEN 'SMALL' THEN 'FALSE' WHEN 'LARGE' THEN '1' ELSE '0' END",
        "picture": "CASE WHEN p_size < 5 THEN '0x' || hex(p_name) || 'F' WHEN p_size > 45 THEN 'NULL' ELSE '0x' || hex(p_name) END",
    },
)

_CENTS = "CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT)"

# Thousands separators are placed by hand: both engines lack a common formatting function.
_GROUPED = (
    f"CASE WHEN {_CENTS} >= 1000 THEN substring(CAST({_CENTS} AS STRING), 1, length(CAST({_CENTS} AS STRING)) - 3) "
    f"|| ',' || substring(CAST({_CENTS} AS STRING), length(CAST({_CENTS} AS STRING)) - 2, 3) "
    f"ELSE CAST({_CENTS} AS STRING) END"
)

TXT_COUNTRIES = Derived(
    "supplier",
    {
        "country_name": "s_name",
        "abbreviation": "CASE WHEN s_acctbal < 0 THEN 'NULL' ELSE 'N' || CAST(s_nationkey AS STRING) || CASE WHEN s_acctbal > 9000 THEN '-EXT' ELSE '' END END",
        "calling_code": "'+' || CAST(s_suppkey AS STRING) || CASE WHEN s_acctbal > 9500 THEN ' (extension)' ELSE '' END",
        "currency_code": "CASE WHEN s_acctbal > 9800 THEN 'currency of ' || s_name ELSE 'CUR' END",
        "capital_city": "CASE WHEN s_nationkey > 20 THEN '' ELSE 'City ' || CAST(s_nationkey AS STRING) END",
        "population": _GROUPED,
        "armed_forces_size": "CASE WHEN s_nationkey = 3 THEN 'NULL' WHEN s_nationkey = 4 THEN '' ELSE CAST(s_suppkey AS STRING) END",
        "urban_population": "CAST(s_suppkey AS STRING)",
        "gdp": f"'$' || CAST({_money('s_acctbal')} AS STRING) || ' '",
        "latitude": f"CAST({_money('s_acctbal')} AS STRING)",
        "longitude": "CASE WHEN s_nationkey < 5 THEN '-' || CAST(s_nationkey AS STRING) || '.' ELSE CAST(s_nationkey AS STRING) || '.5' END",
        "unemployment_rate_percent": "CAST(s_nationkey AS STRING) || '.25%'",
        "tax_revenue_percent": "CASE WHEN s_nationkey > 18 THEN '' ELSE CAST(s_nationkey AS STRING) || CASE WHEN s_acctbal > 5000 THEN '.5%' ELSE '.5' END END",
        "birth_rate": "CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(s_nationkey AS STRING) || '.1' END",
        "cpi": "CASE WHEN s_nationkey = 7 THEN '1,100.5' ELSE '110.5' END",
        "official_language": "'Language ' || CAST(s_nationkey AS STRING)",
    },
)

PRODUCTS = Derived(
    "part",
    {
        "product_id": "p_partkey",
        "product_name": "p_name",
        "supplier_id": "p_brand",
        "category_id": "CASE WHEN p_size > 48 THEN 'none' ELSE p_type END",
        "quantity_per_unit": "CAST(p_size AS STRING)",
        "unit_price": _money("p_retailprice", 10),
        "discontinued": "CASE WHEN p_size > 45 THEN NULL WHEN p_size > 40 THEN 1 ELSE 0 END",
    },
)

CUSTOMERS = Derived(
    "customer",
    {
        "customer_id": "c_custkey",
        "company_name": "c_name",
        "city": "c_mktsegment",
        "country": "CAST(c_nationkey AS STRING)",
        "region": "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END",
    },
)

SELLERS = Derived(
    "supplier",
    {
        "employee_id": "s_suppkey",
        "first_name": "substring(s_name, 1, 8)",
        "last_name": "CASE WHEN s_acctbal < 0 THEN NULL ELSE substring(s_name, 10) END",
        "title": "'Seller'",
        "city": "CAST(s_nationkey AS STRING)",
        "country": "CAST(s_nationkey AS STRING)",
        "region": "CAST(NULL AS STRING)",
        "hire_date": "DATE '1995-01-01'",
    },
)

ORDERS = Derived(
    "orders",
    {"order_id": "o_orderkey", "customer_id": "o_custkey", "order_date": "CAST(o_orderdate AS DATE)"},
)

ORDER_DETAILS = Derived(
    "lineitem",
    {
        "order_id": "l_orderkey",
        "product_id": "l_partkey",
        "employee_id": "l_suppkey",
        "unit_price": _money("l_extendedprice", 10),
        "quantity": "CAST(l_quantity AS INTEGER)",
        "discount": _money("l_discount", 4),
    },
)


class Catalogue:
    """Registered queries with the SQL that checks them, where SQL can."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def register(self, sql: str | None = None):
        """Decorator: the function's name is the query's name."""

        def add(function: Query) -> Query:
            self.queries[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return add
