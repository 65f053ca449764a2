"""Registered queries: staging, cleaning, typed load, format rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siltworks.functions import full_name, is_one
from siltworks.operators import cleaning, rules
from siltworks.operators.integrity import pk_duplicates, union_all
from siltworks.operators.typed import quarantine, to_typed
from siltworks.plans.testbed import (
    CHANGED,
    LOADED,
    SELLERS,
    TXT_COUNTRIES,
    TXT_CUSTOMERS,
    TXT_ORDER_DETAILS,
    TXT_ORDERS,
    TXT_PRODUCTS,
    Catalogue,
    Derived,
    table,
)
from siltworks.session import scratch_path
from siltworks.sources import staging, tables

catalogue = Catalogue()

_CLEAN_LINES = (
    "SELECT l_orderkey AS o, l_partkey AS p, CAST(l_extendedprice AS DECIMAL(10,2)) AS price, "
    "CAST(l_quantity AS INTEGER) AS q, CAST(l_discount AS DECIMAL(4,2)) AS d FROM lineitem"
)


@catalogue.register(
    """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
              CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS VARCHAR) AS unit_price,
              CASE WHEN l_returnflag = 'R' THEN 'NULL' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
              CASE WHEN l_linestatus = 'F' THEN NULL ELSE '00' || CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) END AS discount
       FROM lineitem"""
)
def staging_csv(spark, folder) -> DataFrame:
    """Lines written as header CSV, read back as staging: NULL text, empty fields, leading zeros."""
    path = scratch_path(spark, "staging-csv")
    source = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderID"),
        F.col("l_partkey").alias("productID"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("unitPrice"),
        F.when(F.col("l_returnflag") == "R", "NULL").otherwise(F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.when(F.col("l_linestatus") != "F", F.concat(F.lit("00"), F.col("l_tax").cast("decimal(4,2)").cast("string"))).alias("discount"),
    )
    source.write.option("header", True).csv(path)
    return staging.read_staging_csv(spark, path, "order_details", multi_line=False)


# Regions of the warehouse as a text file by hand: descriptions with line breaks and quotes within quotes, and lines
# with a field too many or too few.
_WELL = "o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '4%'"
_MANY, _FEW = "o_orderstatus = 'P'", "o_orderstatus <> 'P' AND o_orderpriority LIKE '4%'"


def _region_lines(spark, folder) -> str:
    path = scratch_path(spark, "malformed-csv")
    broken = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('\nsays ""'), F.col("o_orderstatus"), F.lit('"", so"'))
    line = (
        F.when(F.expr(_MANY), F.concat_ws(",", "o_orderkey", "o_orderpriority", F.lit("surplus")))
        .when(F.expr(_FEW), F.col("o_orderkey").cast("string"))
        .otherwise(F.concat_ws(",", "o_orderkey", F.when(F.col("o_orderpriority").like("1%"), broken).otherwise(F.col("o_orderpriority"))))
    )
    # The text writer puts a line end after each value; there is no header line, so none is skipped.
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    return path


def _staged_regions(spark, folder) -> tuple[DataFrame, DataFrame]:
    return staging.stage_csv(spark, _region_lines(spark, folder), "regions", scratch_path(spark, "staged"), header=False)


@catalogue.register(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS region_id,
               CASE WHEN o_orderpriority LIKE '1%' THEN o_orderpriority || chr(10) || 'says "' || o_orderstatus || '", so' ELSE o_orderpriority END AS region_description
        FROM orders WHERE {_WELL}"""
)
def staged_lines(spark, folder) -> DataFrame:
    """Well-formed lines of a file, line breaks within quotes included."""
    return _staged_regions(spark, folder)[0]


@catalogue.register(
    f"""SELECT CAST(o_orderkey AS VARCHAR) || ',' || o_orderpriority || ',surplus' AS line FROM orders WHERE {_MANY}
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE {_FEW}"""
)
def rejected_lines(spark, folder) -> DataFrame:
    """Lines with a field too many or too few, kept apart with their text."""
    return _staged_regions(spark, folder)[1]


@catalogue.register(
    f"""SELECT CAST(count(*) FILTER ({_WELL}) AS BIGINT) AS rows, CAST(count(*) FILTER (NOT ({_WELL})) AS BIGINT) AS rejected,
               CAST(count(*) FILTER ({_WELL} AND o_orderpriority LIKE '1%') AS BIGINT) AS with_line_break FROM orders"""
)
def counts_while_staging(spark, folder) -> DataFrame:
    """Counts gathered by the write that stages a file: no scan of their own."""
    told = Observation()
    line_break = F.count_if(F.contains("region_description", F.lit("\n"))).alias("with_line_break")
    staging.stage_csv(spark, _region_lines(spark, folder), "regions", scratch_path(spark, "staged"), True, told, line_break, header=False)
    return spark.createDataFrame([told.get], "rows long, rejected long, with_line_break long")


# Constant rows beside a table: codes of market segments, one of which no customer has.
_SEGMENT_CODES = [("AUTOMOBILE", "A"), ("BUILDING", "B"), ("MACHINERY", "M"), ("NONE SUCH", "N")]


@catalogue.register(
    f"""SELECT v.code, CAST(count(c_custkey) AS BIGINT) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS balance
        FROM (VALUES {", ".join(map(str, _SEGMENT_CODES))}) v(segment, code) LEFT JOIN customer ON c_mktsegment = v.segment GROUP BY v.code"""
)
def constant_rows(spark, folder) -> DataFrame:
    """Inline rows as a table that others join; customers are summed before they meet it."""
    codes = staging.rows(spark, _SEGMENT_CODES, "segment string, code string")
    sums = table(spark, folder, "customer").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(F.col("c_acctbal").cast("decimal(12,2)")).alias("balance")
    )
    joined = codes.join(sums, F.col("segment") == F.col("c_mktsegment"), "left")
    return joined.select("code", F.coalesce("customers", F.lit(0)).alias("customers"), "balance")


@catalogue.register(
    f"""WITH t AS ({_CLEAN_LINES})
        SELECT CAST(o AS INTEGER) AS order_id, CAST(p AS INTEGER) AS product_id, price AS unit_price,
               q AS quantity, d AS discount FROM t"""
)
def typed_load_strict(spark, folder) -> DataFrame:
    """Clean order lines as text, cast to their typed table."""
    text = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(10,2)").cast("string").alias("unit_price"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.col("l_discount").cast("decimal(4,2)").cast("string").alias("discount"),
    )
    return to_typed(text, "order_details")


_BAD_LINE = (
    "product_id = '' OR TRY_CAST(CASE WHEN contains(quantity, '.') THEN NULL ELSE quantity END AS INTEGER) IS NULL"
)


def _quarantined(spark, folder) -> tuple[DataFrame, DataFrame]:
    return quarantine(TXT_ORDER_DETAILS.frame(spark, folder), "order_details", scratch_path(spark, "quarantine"))


@catalogue.register(
    f"""WITH t AS ({TXT_ORDER_DETAILS.sql})
        SELECT CAST(order_id AS INTEGER) AS order_id, CAST(product_id AS INTEGER) AS product_id,
               CAST(unit_price AS DECIMAL(10,2)) AS unit_price, CAST(quantity AS INTEGER) AS quantity,
               CAST(discount AS DECIMAL(4,2)) AS discount
        FROM t WHERE NOT ({_BAD_LINE})"""
)
def typed_load_accepted(spark, folder) -> DataFrame:
    return _quarantined(spark, folder)[0]


@catalogue.register(
    f"""WITH t AS ({TXT_ORDER_DETAILS.sql})
        SELECT order_id, product_id, unit_price, quantity, discount,
               concat_ws(',', CASE WHEN product_id = '' THEN 'product_id' END,
                              CASE WHEN contains(quantity, '.') THEN 'quantity' END) AS failed_columns
        FROM t WHERE {_BAD_LINE}"""
)
def typed_load_rejected(spark, folder) -> DataFrame:
    rejected = _quarantined(spark, folder)[1]
    return rejected.withColumn("failed_columns", F.array_join("failed_columns", ","))


@catalogue.register(
    f"""WITH t AS ({TXT_PRODUCTS.sql})
        SELECT CAST(product_id AS BIGINT) AS product_id, nullif(category, 'NULL') AS category,
               CASE discontinued WHEN 'TRUE' THEN 1 WHEN 'FALSE' THEN 0 ELSE CAST(discontinued AS INTEGER) END AS discontinued,
               discontinued IN ('TRUE', '1') AS is_discontinued,
               CASE WHEN regexp_full_match(picture, '(0x)?([0-9A-Fa-f]{{2}})*') THEN decode(unhex(replace(picture, '0x', ''))) END AS picture,
               nullif(trim(category), '') AS category_or_null
        FROM t"""
)
def flags_tokens_and_hex(spark, folder) -> DataFrame:
    """NULL tokens, spelled-out flags, hexadecimal pictures (shown as the text they encode)."""
    from siltworks.functions import empty_to_null, flag_to_int, hex_to_binary

    text = TXT_PRODUCTS.frame(spark, folder)
    tokens = cleaning.null_tokens(text, ["picture"])
    flag = flag_to_int("discontinued")
    return tokens.select(
        F.col("product_id").cast("bigint").alias("product_id"),
        F.nullif("category", F.lit("NULL")).alias("category"),
        flag.alias("discontinued"),
        is_one(flag).alias("is_discontinued"),
        hex_to_binary("picture").cast("string").alias("picture"),
        empty_to_null("category").alias("category_or_null"),
    )


@catalogue.register(
    f"""WITH t AS ({TXT_CUSTOMERS.sql}), o AS ({TXT_ORDERS.sql})
        SELECT 'txt_customers' AS table_name, CAST(count(*) FILTER (regions = 'NULL' OR phone = 'NULL') AS BIGINT) AS rows_touched FROM t
        UNION ALL
        SELECT 'txt_orders', CAST(count(*) FILTER (ship_via = 'NULL') AS BIGINT) FROM o"""
)
def null_token_counts(spark, folder) -> DataFrame:
    customers = cleaning.null_token_counts(TXT_CUSTOMERS.frame(spark, folder), ["regions", "phone"])
    orders = cleaning.null_token_counts(TXT_ORDERS.frame(spark, folder), ["ship_via"])
    return union_all(
        [
            counted.select(F.lit(name).alias("table_name"), "rows_touched")
            for name, counted in {"txt_customers": customers, "txt_orders": orders}.items()
        ]
    )


@catalogue.register(
    f"""WITH t AS ({TXT_COUNTRIES.sql})
        SELECT country_name, trim(replace(population, ',', '')) AS population,
               trim(replace(replace(gdp, '$', ''), ',', '')) AS gdp, replace(cpi, ',', '') AS cpi,
               replace(unemployment_rate_percent, '%', '') AS unemployment_rate_percent,
               nullif(replace(tax_revenue_percent, '%', ''), '') AS tax_revenue_percent,
               nullif(nullif(armed_forces_size, 'NULL'), '') AS armed_forces_size
        FROM t"""
)
def clean_symbols(spark, folder) -> DataFrame:
    """Country text after removal of separators, signs, tokens and blanks."""
    return cleaning.clean_countries(TXT_COUNTRIES.frame(spark, folder)).select(
        "country_name",
        "population",
        "gdp",
        "cpi",
        "unemployment_rate_percent",
        "tax_revenue_percent",
        "armed_forces_size",
    )


@catalogue.register(
    f"""WITH t AS ({TXT_COUNTRIES.sql})
        SELECT country_name, CAST(replace(population, ',', '') AS BIGINT) AS population,
               CAST(trim(replace(gdp, '$', '')) AS DECIMAL(18,2)) AS gdp,
               CAST(nullif(nullif(armed_forces_size, 'NULL'), '') AS INTEGER) AS armed_forces_size,
               substring(nullif(abbreviation, 'NULL'), 1, 5) AS abbreviation,
               substring(calling_code, 1, 10) AS calling_code,
               CAST(replace(cpi, ',', '') AS DECIMAL(10,2)) AS cpi,
               CAST(replace(unemployment_rate_percent, '%', '') AS DECIMAL(5,2)) AS unemployment_rate,
               nullif(capital_city, '') AS capital_city
        FROM t"""
)
def typed_countries(spark, folder) -> DataFrame:
    """The wide country cast: cleaned text to numbers, codes cut to their length."""
    cleaned = typed_country_frame(spark, folder)
    return cleaned.select(
        "country_name",
        "population",
        F.col("gdp").cast("decimal(18,2)").alias("gdp"),
        "armed_forces_size",
        "abbreviation",
        "calling_code",
        F.col("cpi").cast("decimal(10,2)").alias("cpi"),
        F.col("unemployment_rate_percent").cast("decimal(5,2)").alias("unemployment_rate"),
        "capital_city",
    )


def typed_country_frame(spark, folder) -> DataFrame:
    """Typed countries of the test tables; columns the tables cannot give are null."""
    from siltworks.schemas import ENTITIES

    cleaned = cleaning.clean_countries(TXT_COUNTRIES.frame(spark, folder))
    # A longitude that ends in its decimal point is malformed and is left out before the cast.
    cleaned = cleaned.withColumn("longitude", F.when(~F.col("longitude").endswith("."), F.col("longitude")))
    for column in ENTITIES["countries"].columns:
        cleaned = staging.evolve(cleaned, column, "string")
    return to_typed(cleaned, "countries")


@catalogue.register(
    f"""WITH t AS ({SELLERS.sql})
        SELECT employee_id, first_name || ' ' || last_name AS full_name FROM t"""
)
def full_names(spark, folder) -> DataFrame:
    return SELLERS.frame(spark, folder).select("employee_id", full_name("first_name", "last_name").alias("full_name"))


@catalogue.register(
    """SELECT c_custkey, c_name, CAST(NULL AS INTEGER) AS country_key, TRUE AS active,
              DATE '2020-01-01' AS loaded FROM customer
       UNION ALL
       SELECT s_suppkey, s_name, NULL, TRUE, DATE '2020-02-01' FROM supplier"""
)
def refresh_append_evolve(spark, folder) -> DataFrame:
    """Full refresh, then an append, of a stored table that gains columns with defaults."""
    path = scratch_path(spark, "refresh")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS c_custkey", "s_name AS c_name")
    # The second refresh replaces the first; the append adds to it.
    tables.load_overwrite(suppliers, path, LOADED)
    tables.load_overwrite(customers, path, LOADED)
    tables.load_append(suppliers, path, CHANGED)
    stored = spark.read.parquet(path)
    evolved = staging.evolve(staging.evolve(stored, "country_key", "int"), "active", "boolean", True)
    return evolved.withColumn("loaded", F.to_date("load_date")).drop("load_date")


@catalogue.register(
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'"""
)
def staged_batches(spark, folder) -> DataFrame:
    """Two batches in folders of their own; a second try of a batch replaces only that batch."""
    root = scratch_path(spark, "batches")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    tables.reset_staging(orders.filter("o_orderstatus = 'F'"), root, "orders", "1")
    second = tables.reset_staging(orders.filter("o_orderstatus = 'P'"), root, "orders", "2")
    first = tables.reset_staging(orders.filter("o_orderstatus = 'O'"), root, "orders", "1")
    return first.unionByName(second)


# Format rules

_TOKEN = "'NULL', ''"


def _issue(table_name: str, key: str, text: str, condition: str) -> str:
    return f"SELECT '{table_name}' AS table_name, {key} AS row_key, '{text}' AS issue_desc FROM t WHERE {condition}"


def _validation_sql(source, table_name: str, key: str, checks: dict[str, str]) -> str:
    listed = " UNION ALL ".join(_issue(table_name, key, text, condition) for text, condition in checks.items())
    return f"WITH t AS ({source.sql}) {listed}"


def _int_sql(c: str, pattern: str = "[0-9]+") -> str:
    return f"(NOT regexp_full_match({c}, '{pattern}') OR {c} IN ({_TOKEN}))"


def _len_sql(c: str, limit: int) -> str:
    return f"(length({c}) > {limit} OR {c} IN ({_TOKEN}))"


def _dec_sql(c: str) -> str:
    return (
        f"(NOT regexp_full_match({c}, '[0-9]+([.][0-9]{{1,2}})?') OR length(replace({c}, '.', '')) > 10 "
        f"OR {c} IN ({_TOKEN}))"
    )


_TIMESTAMP_SQL = (
    "(NOT regexp_full_match(order_date, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?') "
    f"OR order_date IN ({_TOKEN}))"
)

CUSTOMER_CHECKS = {
    "customer_id is longer than 3": _len_sql("customer_id", 3),
    "customer_name is longer than 20": _len_sql("customer_name", 20),
    "regions is longer than 50": _len_sql("regions", 50),
    "country is longer than 10": _len_sql("country", 10),
    "phone is longer than 5": _len_sql("phone", 5),
    "balance is not a decimal(10,2)": _dec_sql("balance"),
    "phone is null": "phone IS NULL",
    "balance is outside -500..9000": "CAST(balance AS DECIMAL(12,2)) NOT BETWEEN -500 AND 9000",
}


def customer_rules():
    return [
        rules.max_length("customer_id", 3),
        rules.max_length("customer_name", 20),
        rules.max_length("regions", 50),
        rules.max_length("country", 10),
        rules.max_length("phone", 5),
        rules.decimal("balance"),
        rules.not_null("phone"),
        rules.in_range("balance", -500, 9000),
    ]


ORDER_CHECKS = {
    "order_id is not an integer": _int_sql("order_id"),
    "customer_id is longer than 10": _len_sql("customer_id", 10),
    "ship_via is not an integer": _int_sql("ship_via"),
    "order_date is not a timestamp": _TIMESTAMP_SQL,
    "freight is not a decimal(10,2)": _dec_sql("freight"),
    "shipped is not one of 0|1": "shipped NOT IN ('0', '1')",
}


def order_rules():
    return [
        rules.integer("order_id"),
        rules.max_length("customer_id", 10),
        rules.integer("ship_via"),
        rules.timestamp_text("order_date"),
        rules.decimal("freight"),
        rules.domain("shipped", ["0", "1"]),
    ]


LINE_CHECKS = {
    "order_id is not an integer": _int_sql("order_id"),
    "product_id is not an integer": _int_sql("product_id"),
    "unit_price is not a decimal(10,2)": _dec_sql("unit_price"),
    "quantity is not a signed integer": _int_sql("quantity", "-?[0-9]+"),
    "discount is not a decimal(10,2)": _dec_sql("discount"),
}

PRODUCT_CHECKS = {
    "product_id is not an integer": _int_sql("product_id"),
    "product_name is longer than 11": _len_sql("product_name", 11),
    "category is longer than 6": _len_sql("category", 6),
    "unit_price is not a decimal(10,2)": _dec_sql("unit_price"),
    "units_in_stock is not a signed integer": _int_sql("units_in_stock", "-?[0-9]+"),
    "discontinued is not one of 0|1": "discontinued NOT IN ('0', '1')",
    "picture is not hexadecimal": f"(NOT regexp_full_match(picture, '(0x)?([0-9A-Fa-f]{{2}})*') OR picture IN ({_TOKEN}))",
    "units_in_stock has a wrong pattern": f"(NOT regexp_full_match(units_in_stock, '[1-3]?[0-9]') OR units_in_stock IN ({_TOKEN}))",
}


def product_rules():
    return [
        rules.integer("product_id"),
        rules.max_length("product_name", 11),
        rules.max_length("category", 6),
        rules.decimal("unit_price"),
        rules.signed_integer("units_in_stock"),
        rules.domain("discontinued", ["0", "1"]),
        rules.hexadecimal("picture"),
        rules.matches("units_in_stock", r"^[1-3]?[0-9]\z"),
    ]


def _optional(c: str, pattern: str) -> str:
    return f"((NOT regexp_full_match({c}, '{pattern}') AND {c} <> '') OR {c} = 'NULL')"


_SIGNED = "-?[0-9]+([.][0-9]+)?"
_UNSIGNED = "[0-9]+([.][0-9]+)?"

COUNTRY_CHECKS = {
    "abbreviation is longer than 5": "(length(abbreviation) > 5 OR abbreviation = 'NULL')",
    "calling_code is longer than 10": "length(calling_code) > 10",
    "currency_code is longer than 10": "length(currency_code) > 10",
    "armed_forces_size is not an integer": _optional("armed_forces_size", "[0-9]+"),
    "population is not an integer": _optional("population", "[0-9]+"),
    "urban_population is not an integer": _optional("urban_population", "[0-9]+"),
    "gdp is not a number": _optional("gdp", _SIGNED),
    "latitude is not a number": _optional("latitude", _SIGNED),
    "longitude is not a number": _optional("longitude", _SIGNED),
    "a rate or percentage is malformed": (
        f"({_optional('coalesce(birth_rate, 0::VARCHAR)', _UNSIGNED)} OR {_optional('cpi', _UNSIGNED)} "
        f"OR {_optional('tax_revenue_percent', _UNSIGNED)})"
    ),
}


@catalogue.register(_validation_sql(TXT_CUSTOMERS, "txt_customers", "customer_id", CUSTOMER_CHECKS))
def validate_customer(spark, folder) -> DataFrame:
    return rules.validate(TXT_CUSTOMERS.frame(spark, folder), "txt_customers", customer_rules(), "customer_id")


@catalogue.register(_validation_sql(TXT_ORDERS, "txt_orders", "order_id", ORDER_CHECKS))
def validate_orders(spark, folder) -> DataFrame:
    return rules.validate(TXT_ORDERS.frame(spark, folder), "txt_orders", order_rules(), "order_id")


# Order lines whose key lacks a part here and there.
_GAPPED_LINES = Derived(
    "lineitem",
    {
        **TXT_ORDER_DETAILS.columns,
        "product_id": f"CASE WHEN l_quantity = 49 THEN NULL ELSE {TXT_ORDER_DETAILS.columns['product_id']} END",
    },
)


@catalogue.register(
    _validation_sql(
        _GAPPED_LINES, "txt_order_details", "coalesce(order_id, '<null>') || '|' || coalesce(product_id, '<null>')", LINE_CHECKS
    )
)
def validate_lineitem(spark, folder) -> DataFrame:
    """The declared rules of the order lines, under a composite row key that marks missing parts."""
    key = rules.row_key(["order_id", "product_id"])
    lines = _GAPPED_LINES.frame(spark, folder)
    return rules.validate(lines, "txt_order_details", rules.rules_for("order_details"), key)


@catalogue.register(_validation_sql(TXT_PRODUCTS, "txt_products", "product_id", PRODUCT_CHECKS))
def validate_part(spark, folder) -> DataFrame:
    return rules.validate(TXT_PRODUCTS.frame(spark, folder), "txt_products", product_rules(), "product_id")


@catalogue.register(_validation_sql(TXT_COUNTRIES, "txt_countries", "country_name", COUNTRY_CHECKS))
def validate_country(spark, folder) -> DataFrame:
    """The declared country rules: optional numbers, lengths, one composite rule."""
    return rules.validate(
        TXT_COUNTRIES.frame(spark, folder), "txt_countries", rules.rules_for("countries"), "country_name"
    )


def _failures_sql(source, table_name: str, checks: dict[str, str]) -> str:
    counted = " UNION ALL ".join(
        f"SELECT '{table_name}' AS table_name, '{text}' AS issue_desc, count(*) AS rows_checked, "
        f"count(*) FILTER ({condition}) AS failures FROM ({source.sql}) t"
        for text, condition in checks.items()
    )
    return counted


_ALL_FAILURES = " UNION ALL ".join(
    [
        _failures_sql(TXT_CUSTOMERS, "txt_customers", CUSTOMER_CHECKS),
        _failures_sql(TXT_ORDERS, "txt_orders", ORDER_CHECKS),
        _failures_sql(TXT_ORDER_DETAILS, "txt_order_details", LINE_CHECKS),
        _failures_sql(TXT_PRODUCTS, "txt_products", PRODUCT_CHECKS),
    ]
)


_REGISTERED = {
    "txt_customers": (TXT_CUSTOMERS, "customer_id", customer_rules, CUSTOMER_CHECKS),
    "txt_orders": (TXT_ORDERS, "order_id", order_rules, ORDER_CHECKS),
}
_RULES_FOUND = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{text.split()[0]}' AS column_name, FALSE AS is_unique, '{text}' AS description, "
    f"count(*) FILTER ({condition}) AS failures FROM ({source.sql})"
    for name, (source, _, _, checks) in _REGISTERED.items()
    for text, condition in checks.items()
)
_KEYS_FOUND = " UNION ALL ".join(
    f"SELECT '{name}', '{key}', TRUE, '{key} is repeated', CAST(coalesce(sum(n - 1), 0) AS BIGINT) "
    f"FROM (SELECT count(*) AS n FROM ({source.sql}) GROUP BY {key})"
    for name, (source, key, _, _) in _REGISTERED.items()
)


@catalogue.register(f"{_RULES_FOUND} UNION ALL {_KEYS_FOUND}")
def rule_registry(spark, folder) -> DataFrame:
    """Every registered rule, uniqueness of keys among them, with the rows that break it."""
    listed = {name: declared() for name, (_, _, declared, _) in _REGISTERED.items()}
    registry = rules.rule_registry(spark, listed, {name: [key] for name, (_, key, _, _) in _REGISTERED.items()})
    found = []
    for name, (source, key, declared, _) in _REGISTERED.items():
        df = source.frame(spark, folder)
        found.append(rules.rule_failures(df, name, declared()).select("table_name", "issue_desc", "failures"))
        repeats = pk_duplicates(df, key).agg(F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("failures"))
        found.append(repeats.select(F.lit(name).alias("table_name"), F.lit(f"{key} is repeated").alias("issue_desc"), "failures"))
    counted = union_all(found).withColumnRenamed("issue_desc", "description")
    unique = (F.col("rule_type") == "UNIQUE").alias("is_unique")
    return registry.join(counted, ["table_name", "description"]).select(
        "table_name", "column_name", unique, "description", "failures"
    )


def _all_failures(spark, folder) -> DataFrame:
    return union_all(
        [
            rules.rule_failures(TXT_CUSTOMERS.frame(spark, folder), "txt_customers", customer_rules()),
            rules.rule_failures(TXT_ORDERS.frame(spark, folder), "txt_orders", order_rules()),
            rules.rule_failures(
                TXT_ORDER_DETAILS.frame(spark, folder), "txt_order_details", rules.rules_for("order_details")
            ),
            rules.rule_failures(TXT_PRODUCTS.frame(spark, folder), "txt_products", product_rules()),
        ]
    )


@catalogue.register(
    f"SELECT table_name, issue_desc, CAST(rows_checked AS BIGINT) AS rows_checked, CAST(failures AS BIGINT) AS failures FROM ({_ALL_FAILURES})"
)
def rule_failures(spark, folder) -> DataFrame:
    """The rule registry with what each rule found: one aggregate per table."""
    return _all_failures(spark, folder).select("table_name", "issue_desc", "rows_checked", "failures")


@catalogue.register(
    f"""SELECT table_name, CAST(max(rows_checked) AS BIGINT) AS rows_checked, CAST(sum(failures) AS BIGINT) AS errors,
               CASE WHEN sum(failures) > 0 THEN 'WARNING' ELSE 'OK' END AS status
        FROM ({_ALL_FAILURES}) GROUP BY table_name
        UNION ALL
        SELECT 'orders', count(*), 0, 'OK' FROM orders"""
)
def validation_status(spark, folder) -> DataFrame:
    clean = table(spark, folder, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"))
    return rules.validation_status(
        _all_failures(spark, folder).unionByName(rules.rule_failures(clean, "orders", [rules.integer("order_id")]))
    )


@catalogue.register(
    f"""SELECT table_name, issue_desc, CAST(count(*) AS BIGINT) AS issues
        FROM ({_validation_sql(TXT_ORDERS, "txt_orders", "order_id", ORDER_CHECKS)}) GROUP BY ALL"""
)
def validation_summary(spark, folder) -> DataFrame:
    return rules.validation_summary(validate_orders(spark, folder))


@catalogue.register(
    """SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part WHERE p_size >= 10"""
)
def guarded_cast(spark, folder) -> DataFrame:
    """Only prices that look like numbers are cast; the rest never reaches the cast."""
    text = TXT_PRODUCTS.frame(spark, folder).selectExpr("CAST(product_id AS BIGINT) AS p_partkey", "unit_price AS price")
    return cleaning.castable_numbers(text, "price", target="decimal(12,2)")
