"""Registered queries: keys, relations, consistency, profiling, quality rules and gate."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import UNSIGNED_INTEGER, normalised_name
from siltworks.operators import integrity, profiling, quality
from siltworks.operators.catalog import relations_frame
from siltworks.plans.testbed import (
    TXT_CUSTOMERS,
    TXT_ORDER_DETAILS,
    TXT_ORDERS,
    TXT_PRODUCTS,
    Catalogue,
    table,
)
from siltworks.session import scratch_path
from siltworks.sources.tables import VersionedStore

catalogue = Catalogue()

# Keys


@catalogue.register(
    f"""SELECT 'txt_customers' AS table_name, count(*) AS total_rows,
               count(*) FILTER (customer_id IS NULL OR trim(customer_id) = '') AS blank_rows FROM ({TXT_CUSTOMERS.sql})
        UNION ALL
        SELECT 'txt_order_details', count(*), count(*) FILTER (order_id IS NULL OR trim(order_id) = ''
               OR product_id IS NULL OR trim(product_id) = '') FROM ({TXT_ORDER_DETAILS.sql})"""
)
def pk_blank(spark, folder) -> DataFrame:
    return integrity.union_all(
        [
            integrity.pk_blank_count(TXT_CUSTOMERS.frame(spark, folder), "customer_id", "txt_customers"),
            integrity.pk_blank_count(
                TXT_ORDER_DETAILS.frame(spark, folder), ["order_id", "product_id"], "txt_order_details"
            ),
        ]
    )


@catalogue.register(
    f"""SELECT order_id, customer_id, CAST(length(order_id) AS INTEGER) AS order_id_length,
               CAST(length(customer_id) AS INTEGER) AS customer_id_length
        FROM ({TXT_ORDERS.sql}) WHERE NOT regexp_full_match(order_id, '[0-9]+') OR length(customer_id) > 3"""
)
def pk_malformed(spark, folder) -> DataFrame:
    return integrity.pk_malformed(
        TXT_ORDERS.frame(spark, folder),
        {
            "order_id": ~F.col("order_id").rlike(UNSIGNED_INTEGER),
            "customer_id": F.length("customer_id") > 3,
        },
    )


@catalogue.register(
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def pk_duplicates_lineitem(spark, folder) -> DataFrame:
    return integrity.pk_duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@catalogue.register(
    """SELECT l_orderkey, l_partkey, count(*) AS occurrences FROM lineitem
       GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"""
)
def pk_duplicates_order_part(spark, folder) -> DataFrame:
    return integrity.pk_duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"])


@catalogue.register(
    f"SELECT customer_id, count(*) AS occurrences FROM ({TXT_CUSTOMERS.sql}) GROUP BY customer_id HAVING count(*) > 1"
)
def pk_duplicates_text(spark, folder) -> DataFrame:
    return integrity.pk_duplicates(TXT_CUSTOMERS.frame(spark, folder), "customer_id")


# Relations


@catalogue.register(
    """SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
       WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_acctbal >= 0 AND s_suppkey = l_suppkey)"""
)
def fk_orphans_line_supplier(spark, folder) -> DataFrame:
    """Lines of suppliers that are no longer in good standing."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    solvent = table(spark, folder, "supplier").filter("s_acctbal >= 0")
    return integrity.fk_orphans(lines, "l_suppkey", solvent, "s_suppkey")


@catalogue.register(
    """SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def fk_orphans_order_without_line(spark, folder) -> DataFrame:
    """The parent side repeats its keys: it is reduced to distinct values before the join."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return integrity.fk_orphans(orders, "o_orderkey", table(spark, folder, "lineitem"), "l_orderkey", repeated_parent=True)


@catalogue.register(
    """SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""
)
def fk_orphans_document_label(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source")
    return integrity.fk_orphans(documents, "doc_id", table(spark, folder, "labels"), "doc_id")


@catalogue.register(
    """SELECT conv_id, turn, next_turn FROM (SELECT conv_id, turn, CASE WHEN role = 'user' THEN turn + 1 END AS next_turn FROM conversations) c
       WHERE next_turn IS NOT NULL AND NOT EXISTS (
           SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn = c.next_turn)"""
)
def fk_orphans_self(spark, folder) -> DataFrame:
    """Self reference with a composite key: a user's turn points to the turn that answers it."""
    turns = table(spark, folder, "conversations").selectExpr(
        "conv_id", "turn", "CASE WHEN role = 'user' THEN turn + 1 END AS next_turn"
    )
    return integrity.fk_orphans(turns, ["conv_id", "next_turn"], turns, ["conv_id", "turn"])


_SUPPLIED = """SELECT n_name FROM nation WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal > 9000)"""


def supplied_nations(spark, folder) -> DataFrame:
    """Nations with a large supplier: a list of known countries that lacks some."""
    large = table(spark, folder, "supplier").filter("s_acctbal > 9000").select("s_nationkey")
    return table(spark, folder, "nation").join(large, F.col("n_nationkey") == F.col("s_nationkey"), "left_semi")


@catalogue.register(
    f"""SELECT customer_id, country FROM ({TXT_CUSTOMERS.sql}) c WHERE country IS NOT NULL AND country <> ''
        AND NOT EXISTS (SELECT 1 FROM ({_SUPPLIED}) n WHERE lower(trim(n.n_name)) = lower(trim(c.country)))"""
)
def fk_orphans_country_name(spark, folder) -> DataFrame:
    """Names compared without case and surrounding spaces."""
    customers = TXT_CUSTOMERS.frame(spark, folder).select("customer_id", "country")
    return integrity.fk_orphans(customers, "country", supplied_nations(spark, folder), "n_name", normalised_name)


@catalogue.register(
    f"""SELECT 'customer' AS source_table, customer_id AS record_id, country AS bad_value FROM ({TXT_CUSTOMERS.sql}) c
        WHERE trim(country) <> '' AND NOT EXISTS (SELECT 1 FROM ({_SUPPLIED}) n WHERE lower(trim(n.n_name)) = lower(trim(c.country)))
        UNION ALL
        SELECT 'supplier', CAST(s_suppkey AS VARCHAR), 'Nation_' || CAST(s_nationkey AS VARCHAR) FROM supplier
        WHERE NOT EXISTS (SELECT 1 FROM ({_SUPPLIED}) n WHERE lower(n.n_name) = 'nation_' || CAST(s_nationkey AS VARCHAR))"""
)
def unmatched_values_report(spark, folder) -> DataFrame:
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_suppkey", "'Nation_' || CAST(s_nationkey AS STRING) AS country"
    )
    return integrity.unmatched_values_report(
        {
            "customer": (TXT_CUSTOMERS.frame(spark, folder), "customer_id", "country"),
            "supplier": (suppliers, "s_suppkey", "country"),
        },
        supplied_nations(spark, folder),
        "n_name",
    )


@catalogue.register(
    """WITH t AS (SELECT p_partkey AS id, CASE WHEN p_size > 40 THEN upper(p_name) WHEN p_size < 10 THEN ' ' || p_name ELSE p_name END AS spelling FROM part)
       SELECT lower(trim(spelling)) AS name_key, n AS occurrences, id, spelling
       FROM t JOIN (SELECT lower(trim(spelling)) AS k, count(*) AS n FROM t GROUP BY 1 HAVING count(*) > 1) ON k = lower(trim(spelling))"""
)
def near_duplicate_names(spark, folder) -> DataFrame:
    spellings = table(spark, folder, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size > 40 THEN upper(p_name) WHEN p_size < 10 THEN ' ' || p_name ELSE p_name END AS spelling",
    )
    return integrity.near_duplicate_names(spellings, "spelling", "p_partkey")


@catalogue.register(
    r"""SELECT doc_id, lang, source FROM documents WHERE NOT regexp_full_match(text, '[\x20-\x7E]+')"""
)
def non_printable_text(spark, folder) -> DataFrame:
    """Whole texts are searched; the search ends at the first character out of range."""
    return integrity.non_printable_ascii(table(spark, folder, "documents"), "text").select("doc_id", "lang", "source")


_RELATION_SQL = """SELECT '{parent}' AS parent_entity, '{parent_column}' AS parent_column, '{child}' AS child_entity,
    '{child_column}' AS child_column, count(*) AS child_rows,
    count(*) FILTER ({child_column} IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM ({parent_sql}) p WHERE p.{parent_column} = c.{child_column})) AS orphan_rows
    FROM {child} c"""

# Parent, parent column, child, child column, condition that parents must meet.
TEST_RELATIONS = [
    ("orders", "o_orderkey", "lineitem", "l_orderkey", "o_orderstatus <> 'P'"),
    ("part", "p_partkey", "lineitem", "l_partkey", "p_size <= 45"),
    ("supplier", "s_suppkey", "lineitem", "l_suppkey", "s_acctbal >= 0"),
    ("customer", "c_custkey", "orders", "o_custkey", "c_acctbal >= 0"),
    ("nation", "n_nationkey", "customer", "c_nationkey", "TRUE"),
    ("region", "r_regionkey", "nation", "n_regionkey", "r_name <> 'ASIA'"),
    ("customer", "c_custkey", "events", "user_id", "c_mktsegment <> 'BUILDING'"),
    ("documents", "doc_id", "labels", "doc_id", "lang = 'en'"),
]


@catalogue.register(
    " UNION ALL ".join(
        _RELATION_SQL.format(
            parent=parent,
            parent_column=parent_column,
            child=child,
            child_column=child_column,
            parent_sql=f"SELECT {parent_column} FROM {parent} WHERE {condition}",
        )
        for parent, parent_column, child, child_column, condition in TEST_RELATIONS
    )
)
def relationship_check(spark, folder) -> DataFrame:
    """Every relation of the catalog, against the parents that are in force."""
    in_force = {tuple(r[:4]): table(spark, folder, r[0]).filter(r[4]) for r in TEST_RELATIONS}
    children = {r[2]: table(spark, folder, r[2]) for r in TEST_RELATIONS}
    return integrity.relationship_check(list(in_force), children, in_force)


@catalogue.register(
    "SELECT *, 'FK' AS relation_type FROM ("
    + " UNION ALL ".join(
        _RELATION_SQL.format(parent=p, parent_column=pc, child=c, child_column=cc, parent_sql=f"SELECT {pc} FROM {p}")
        for p, pc, c, cc, _ in TEST_RELATIONS
    )
    + ")"
)
def relation_catalogue(spark, folder) -> DataFrame:
    """The relation catalogue, whose rows drive the check, with what each relation found."""
    listed = relations_frame(spark, [r[:4] for r in TEST_RELATIONS])
    names = ["parent_entity", "parent_column", "child_entity", "child_column"]
    relations = [tuple(r) for r in listed.select(*names).collect()]  # the catalogue: a few rows
    tables = {t: table(spark, folder, t) for p, _, c, _ in relations for t in (p, c)}
    return listed.join(integrity.relationship_check(relations, tables), names)


# Profiling

_ALL_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


@catalogue.register(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL_TABLES)
)
def row_counts(spark, folder) -> DataFrame:
    return profiling.row_counts({t: table(spark, folder, t) for t in _ALL_TABLES})


@catalogue.register(
    "SELECT CAST((SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS BIGINT) AS total_rows"
)
def total_rows(spark, folder) -> DataFrame:
    return profiling.total_rows({t: table(spark, folder, t) for t in ("customer", "orders", "lineitem")})


@catalogue.register(
    f"""SELECT 'txt_customers' AS table_name, count(*) AS total_rows,
               count(*) FILTER (regions IS NULL OR regions = '') AS missing_regions,
               count(*) FILTER (phone IS NULL OR phone = '') AS missing_phone,
               count(*) FILTER (customer_id IS NULL OR customer_id = '') AS missing_customer_id FROM ({TXT_CUSTOMERS.sql})"""
)
def completeness_customers(spark, folder) -> DataFrame:
    return profiling.completeness(
        TXT_CUSTOMERS.frame(spark, folder), ["regions", "phone", "customer_id"], "txt_customers"
    )


@catalogue.register(
    f"""SELECT 'txt_order_details' AS table_name, count(*) AS total_rows,
               count(*) FILTER (product_id IS NULL OR product_id = '') AS missing_product_id,
               count(*) FILTER (quantity IS NULL OR quantity = '') AS missing_quantity FROM ({TXT_ORDER_DETAILS.sql})"""
)
def completeness_lines(spark, folder) -> DataFrame:
    return profiling.completeness(
        TXT_ORDER_DETAILS.frame(spark, folder), ["product_id", "quantity"], "txt_order_details"
    )


@catalogue.register(
    """SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS buyers, (SELECT count(DISTINCT l_partkey) FROM lineitem) AS parts_sold,
              (SELECT count(DISTINCT l_suppkey) FROM lineitem) AS sellers"""
)
def cardinality(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return profiling.cardinality(
        {
            "buyers": (table(spark, folder, "orders"), "o_custkey"),
            "parts_sold": (lines, "l_partkey"),
            "sellers": (lines, "l_suppkey"),
        }
    )


@catalogue.register(
    """SELECT 'customer' AS source, count(DISTINCT c_nationkey) AS distinct_values FROM customer
       UNION ALL SELECT 'supplier', count(DISTINCT s_nationkey) FROM supplier"""
)
def distinct_per_source(spark, folder) -> DataFrame:
    return profiling.distinct_per_source(
        {
            "customer": (table(spark, folder, "customer"), "c_nationkey"),
            "supplier": (table(spark, folder, "supplier"), "s_nationkey"),
        }
    )


# The mean is rounded half up in whole numbers: a division in floating point may fall short.
_PRICE = "CAST(CAST(unit_price AS DECIMAL(12,2)) * 100 AS BIGINT)"
_MEAN_PRICE = f"(sum({_PRICE}) * 200 + count(*)) // (2 * count(*))"


@catalogue.register(
    f"""SELECT CAST(min(CAST(unit_price AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS min_value,
               CAST(max(CAST(unit_price AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS max_value,
               CAST(CAST({_MEAN_PRICE} AS DECIMAL(24,4)) / 10000 AS DECIMAL(18,4)) AS avg_value
        FROM ({TXT_PRODUCTS.sql}) WHERE regexp_full_match(unit_price, '[0-9]+([.][0-9]+)?')"""
)
def price_range(spark, folder) -> DataFrame:
    """Least, greatest and mean price over the rows whose text is a number."""
    return profiling.numeric_range(TXT_PRODUCTS.frame(spark, folder), "unit_price")


@catalogue.register(
    """SELECT p_type, CAST(count(*) AS BIGINT) AS line_count FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type"""
)
def part_distribution(spark, folder) -> DataFrame:
    return profiling.count_by_parent(
        table(spark, folder, "lineitem"), "l_partkey", table(spark, folder, "part"), "p_partkey", "p_type", "line_count"
    )


@catalogue.register(
    """SELECT c_name, CAST(count(*) AS BIGINT) AS order_count FROM orders JOIN customer ON o_custkey = c_custkey
       GROUP BY c_name ORDER BY order_count DESC, c_name LIMIT 10"""
)
def top_customers(spark, folder) -> DataFrame:
    return profiling.top_groups(
        table(spark, folder, "orders"),
        "o_custkey",
        table(spark, folder, "customer"),
        "c_custkey",
        "c_name",
        "order_count",
    )


@catalogue.register(
    """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders
       ORDER BY price DESC, o_orderkey LIMIT 5"""
)
def top_prices(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders").withColumn("price", F.col("o_totalprice").cast("decimal(12,2)"))
    return profiling.top_rows(orders, "price", "o_orderkey", ["o_orderkey", "o_custkey", "price"])


@catalogue.register(
    """SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS balance FROM customer WHERE c_acctbal > 0
       ORDER BY balance, c_custkey LIMIT 5"""
)
def bottom_balance(spark, folder) -> DataFrame:
    customers = table(spark, folder, "customer").withColumn("balance", F.col("c_acctbal").cast("decimal(12,2)"))
    return profiling.bottom_rows(customers, "balance", "c_custkey", ["c_custkey", "balance"], above_zero=True)


def _profile_sql(source: str, name: str, types: dict[str, str]) -> str:
    def mean(c: str) -> str:
        total, n = f"sum(length(CAST({c} AS VARCHAR)))", f"count({c})"
        return f"CAST(CAST(({total} * 20000 + {n}) // (2 * {n}) AS DECIMAL(28,4)) / 10000 AS DECIMAL(12,4))"

    def detected(c: str, kind: str) -> str:
        if kind != "text":
            return f"'{kind}'"
        return (
            f"CASE WHEN bool_and(regexp_full_match({c}, '-?[0-9]+')) THEN 'integer' "
            f"WHEN bool_and(regexp_full_match({c}, '-?[0-9]+([.][0-9]+)?')) THEN 'decimal' ELSE 'text' END"
        )

    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
            count(*) FILTER ({c} IS NULL) AS null_count, count(DISTINCT {c}) AS distinct_count,
            CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, {mean(c)} AS avg_length,
            CAST(max(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length, {detected(c, kind)} AS detected_type FROM ({source})"""
        for c, kind in types.items()
    )


@catalogue.register(
    _profile_sql(
        TXT_CUSTOMERS.sql,
        "txt_customers",
        {
            "customer_id": "text",
            "customer_name": "text",
            "regions": "text",
            "country": "text",
            "phone": "text",
            "balance": "text",
        },
    )
)
def profile_customer(spark, folder) -> DataFrame:
    return profiling.profile_table(TXT_CUSTOMERS.frame(spark, folder), "txt_customers")


@catalogue.register(
    _profile_sql(
        "SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_shipdate AS DATE) AS shipped FROM lineitem",
        "lineitem",
        {
            "l_orderkey": "bigint",
            "l_partkey": "bigint",
            "l_linenumber": "int",
            "l_returnflag": "text",
            "price": "decimal(12,2)",
            "shipped": "date",
        },
    )
)
def profile_lineitem(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
        "CAST(l_shipdate AS DATE) AS shipped",
    )
    return profiling.profile_table(lines, "lineitem")


# Lines as three batches, by their return flag. Distinct counts of the united sketches lie within five percent of the exact
# ones, three times the standard error of a sketch.
_UNITED = """SELECT l_orderkey, l_partkey, l_returnflag, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_shipdate AS DATE) AS shipped FROM lineitem"""
_UNITED_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_returnflag": "text", "price": "decimal(12,2)", "shipped": "date"}


@catalogue.register(f"SELECT *, TRUE AS distinct_is_near FROM ({_profile_sql(_UNITED, 'lineitem', _UNITED_TYPES)})")
def profile_united(spark, folder) -> DataFrame:
    """A profile from stored sketches of three batches, none of them read again, next to the exact distinct counts."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_returnflag",
        "CAST(l_extendedprice AS DECIMAL(12,2)) AS price",
        "CAST(l_shipdate AS DATE) AS shipped",
    )
    path = scratch_path(spark, "sketches")
    for flag in ("A", "N", "R"):
        batch = lines.filter(F.col("l_returnflag") == flag)
        profiling.sketches(batch, "lineitem", flag).write.mode("append").partitionBy("batch").parquet(path)
    united = profiling.profile_of(spark.read.parquet(path)).drop("median").withColumnRenamed("distinct_count", "estimate")
    exact = profiling.profile_table(lines, "lineitem").select("column_name", "distinct_count")
    near = F.abs(F.col("estimate") - F.col("distinct_count")) * 20 <= F.col("distinct_count")
    return united.join(exact, "column_name").withColumn("distinct_is_near", near).drop("estimate")


# Quality rules

CHECKED_AT = datetime(2025, 1, 1, 12, 0, tzinfo=timezone.utc)
AN_HOUR_AND_MORE_LATER = datetime(2025, 1, 1, 13, 30, tzinfo=timezone.utc)

TEST_RULES = [
    quality.validity_rule("BALANCE_STRICT", "customer", "c_acctbal", "c_acctbal < 0", "0.00"),
    quality.validity_rule("BALANCE_TOLERANT", "customer", "c_acctbal", "c_acctbal < 0", "50.00"),
    quality.completeness_rule("CUSTOMER_NAME", "customer", "c_name", or_empty=True),
    quality.completeness_rule("ORDER_DATE", "orders", "o_orderdate"),
    quality.validity_rule("ORDER_STATUS", "orders", "o_orderstatus", "o_orderstatus = 'P'", "40.00"),
    quality.validity_rule("LINE_DISCOUNT", "lineitem", "l_discount", "l_discount > 0.05", "1.00"),
    quality.consistency_rule("LINE_SUPPLIER", "lineitem", "l_suppkey", "solvent_supplier", "s_suppkey"),
    quality.consistency_rule("LINE_ORDER", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    quality.consistency_rule("ORDER_CUSTOMER", "orders", "o_custkey", "customer", "c_custkey"),
    quality.QualityRule(
        "PART_PRICE_SQL",
        "prices must lie below 999",
        "part",
        "p_retailprice",
        quality.VALIDITY,
        statement="SELECT COUNT(*) FROM siltworks_part WHERE p_retailprice >= 999",
    ),
    quality.QualityRule(
        "PART_SIZE_UNLIMITED",
        "sizes, without a threshold",
        "part",
        "p_size",
        quality.VALIDITY,
        threshold=None,
        condition="p_size > 1",
    ),
]


def _rule_result_sql(rule: quality.QualityRule) -> str:
    source = "(SELECT * FROM supplier WHERE s_acctbal >= 0)" if rule.parent == "solvent_supplier" else rule.parent
    if rule.parent:
        failed = f"{rule.column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {source} p WHERE p.{rule.parent_key} = {rule.column})"
    elif rule.statement:
        failed = "p_retailprice >= 999"
    else:
        failed = rule.condition.replace(" OR o_orderdate = ''", "")
    threshold = "NULL" if rule.threshold is None else str(rule.threshold)
    return (
        f"SELECT '{rule.name}' AS rule_name, '{rule.table}' AS target_table, '{rule.rule_type}' AS rule_type, "
        f"CAST({threshold} AS DECIMAL(5,2)) AS threshold_pct, count(*) AS n, count(*) FILTER ({failed}) AS f FROM {rule.table}"
    )


_RESULTS_SQL = f"""SELECT rule_name, target_table, rule_type, threshold_pct, CAST(n AS BIGINT) AS rows_evaluated,
    CAST(f AS BIGINT) AS rows_failed,
    CAST(CAST((f * 20000 + n) // (2 * n) AS DECIMAL(18,2)) / 100 AS DECIMAL(5,2)) AS failed_pct,
    CASE WHEN f * 100 > threshold_pct * n THEN '{quality.REJECTED}' ELSE '{quality.APPROVED}' END AS verdict
    FROM ({" UNION ALL ".join(_rule_result_sql(r) for r in TEST_RULES)})"""


def _results(spark, folder) -> DataFrame:
    tables = {name: table(spark, folder, name) for name in ("customer", "orders", "lineitem", "part", "supplier")}
    tables["solvent_supplier"] = tables["supplier"].filter("s_acctbal >= 0")
    tables["part"].createOrReplaceTempView("siltworks_part")
    return quality.run_all_checks(tables, _stored_rules(spark), 1, CHECKED_AT)


def _stored_rules(spark) -> list[quality.QualityRule]:
    """The rules by way of a stored catalogue, whose older thresholds an upsert has replaced."""
    older = quality.rules_frame(spark, TEST_RULES[:4]).withColumn("threshold_pct", F.lit(99).cast("decimal(5,2)"))
    path = scratch_path(spark, "rules")
    quality.upsert_rules(older, quality.rules_frame(spark, TEST_RULES)).write.parquet(path)
    return quality.load_catalog(spark.read.parquet(path), {r.name: r for r in TEST_RULES})


@catalogue.register(_RESULTS_SQL)
def quality_results(spark, folder) -> DataFrame:
    """Completeness, validity, consistency and SQL rules; one scan per table for the conditions."""
    return _results(spark, folder).drop("run_id", "executed_at")


@catalogue.register(
    f"""WITH r AS ({_RESULTS_SQL}), u(unit, target_table) AS (VALUES ('customer', 'customer'), ('sales', 'orders'), ('sales', 'lineitem'), ('part', 'part'), ('nation', 'nation'))
        SELECT unit, CAST(count(rule_name) AS BIGINT) AS rejections, CASE WHEN count(rule_name) > 0 THEN 'blocked' ELSE 'passed' END AS decision
        FROM u LEFT JOIN r ON r.target_table = u.target_table AND r.verdict = '{quality.REJECTED}' GROUP BY unit"""
)
def gate_decision(spark, folder) -> DataFrame:
    """Headers and lines pass or fail together; a table without results passes."""
    units = {"customer": ("customer",), "sales": ("orders", "lineitem"), "part": ("part",), "nation": ("nation",)}
    return quality.rejections(_results(spark, folder), units, CHECKED_AT)


@catalogue.register(
    f"""WITH r AS ({_RESULTS_SQL}) SELECT DISTINCT target_table AS unit, CAST(0 AS BIGINT) AS rejections, 'passed' AS decision FROM r"""
)
def gate_after_an_hour(spark, folder) -> DataFrame:
    """Rejections older than the window no longer block."""
    units = {t: (t,) for t in ("customer", "orders", "lineitem", "part")}
    return quality.rejections(_results(spark, folder), units, AN_HOUR_AND_MORE_LATER)


@catalogue.register(
    """SELECT 'customer' AS table_name, c_custkey AS id, DATE '2024-01-01' AS loaded FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT 'supplier', s_suppkey, DATE '2025-01-01' FROM supplier"""
)
def gated_load(spark, folder) -> DataFrame:
    """A rejected table keeps its old content; a passing one is refreshed."""
    store = VersionedStore(spark, scratch_path(spark, "gated"))
    customers = table(spark, folder, "customer")
    suppliers = table(spark, folder, "supplier")
    old = {
        "customer": customers.filter("c_acctbal >= 0").selectExpr("c_custkey AS id", "DATE '2024-01-01' AS loaded"),
        "supplier": suppliers.selectExpr("s_suppkey AS id", "DATE '2024-01-01' AS loaded"),
    }
    new = {
        "customer": customers.selectExpr("c_custkey AS id", "DATE '2025-01-01' AS loaded"),
        "supplier": suppliers.selectExpr("s_suppkey AS id", "DATE '2025-01-01' AS loaded"),
    }
    store.publish({name: store.write(name, df) for name, df in old.items()})
    tables = {"customer": customers, "supplier": suppliers}
    gate_rules = [
        quality.validity_rule("BALANCE", "customer", "c_acctbal", "c_acctbal < 0"),
        quality.completeness_rule("SUPPLIER_KEY", "supplier", "s_suppkey"),
    ]
    results = quality.run_all_checks(tables, gate_rules, 1, CHECKED_AT)
    for name, df in new.items():
        quality.gated_load({name: df}, results, CHECKED_AT, lambda t, d: store.publish({t: store.write(t, d)}))
    return integrity.union_all([store.current(t).select(F.lit(t).alias("table_name"), "id", "loaded") for t in old])


@catalogue.register(
    """SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) + 1 AS price FROM part"""
)
def publish_or_discard(spark, folder) -> DataFrame:
    """The first batch passes and is published; the second breaks a strict rule and leaves no trace."""
    store = VersionedStore(spark, scratch_path(spark, "published"))
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(12,2)").alias("price"))
    strict = [quality.validity_rule("PRICE_POSITIVE", "part", "price", "price <= 0")]

    def check(tables):
        return quality.run_all_checks(tables, strict, 7, CHECKED_AT)

    store.publish({"part": store.write("part", parts)})
    raised = store.current("part").withColumn("price", (F.col("price") + 1).cast("decimal(12,2)"))
    quality.publish_or_discard(store, {"part": raised}, check, 7)
    lowered = store.current("part").withColumn("price", (F.col("price") - 950).cast("decimal(12,2)"))
    quality.publish_or_discard(store, {"part": lowered}, check, 7)
    return store.current("part").withColumn("price", F.col("price").cast("decimal(13,2)"))


# A rule per supplier, and rules that arrive for suppliers and customers with a negative balance.
_CATALOG = """SELECT 'RULE_' || s_name AS rule_name, 'balance of ' || s_name AS description, 'supplier' AS target_table,
    's_acctbal' AS target_column,
    CASE WHEN s_nationkey < 8 THEN 'Validez' WHEN s_nationkey < 16 THEN 'Completitud' ELSE 'Consistencia' END AS rule_type,
    CAST(s_nationkey AS DECIMAL(5,2)) AS threshold_pct, 's_acctbal < 0' AS check_sql FROM supplier"""
_NEW_RULES = """SELECT 'RULE_' || s_name AS rule_name, 'negative balance of ' || s_name AS description, 'changed' AS target_table,
    'changed' AS target_column, 'changed' AS rule_type, CAST(0 AS DECIMAL(5,2)) AS threshold_pct,
    's_acctbal < -1' AS check_sql FROM supplier WHERE s_acctbal < 0
    UNION ALL
    SELECT 'RULE_' || c_name, 'negative balance of ' || c_name, 'customer', 'c_acctbal', 'Validez', CAST(1.5 AS DECIMAL(5,2)),
    'c_acctbal < 0' FROM customer WHERE c_acctbal < 0"""


def _rule_tables(spark, folder) -> tuple[DataFrame, DataFrame]:
    suppliers, customers = table(spark, folder, "supplier"), table(spark, folder, "customer")
    known = suppliers.selectExpr(
        "'RULE_' || s_name AS rule_name",
        "'balance of ' || s_name AS description",
        "'supplier' AS target_table",
        "'s_acctbal' AS target_column",
        "CASE WHEN s_nationkey < 8 THEN 'Validez' WHEN s_nationkey < 16 THEN 'Completitud' ELSE 'Consistencia' END AS rule_type",
        "CAST(s_nationkey AS DECIMAL(5,2)) AS threshold_pct",
        "'s_acctbal < 0' AS check_sql",
    )
    changed = suppliers.filter("s_acctbal < 0").selectExpr(
        "'RULE_' || s_name AS rule_name",
        "'negative balance of ' || s_name AS description",
        "'changed' AS target_table",
        "'changed' AS target_column",
        "'changed' AS rule_type",
        "CAST(0 AS DECIMAL(5,2)) AS threshold_pct",
        "'s_acctbal < -1' AS check_sql",
    )
    added = customers.filter("c_acctbal < 0").selectExpr(
        "'RULE_' || c_name AS rule_name",
        "'negative balance of ' || c_name AS description",
        "'customer' AS target_table",
        "'c_acctbal' AS target_column",
        "'Validez' AS rule_type",
        "CAST(1.5 AS DECIMAL(5,2)) AS threshold_pct",
        "'c_acctbal < 0' AS check_sql",
    )
    return known, changed.unionByName(added)


@catalogue.register(
    f"""WITH k AS ({_CATALOG}), n AS ({_NEW_RULES})
        SELECT coalesce(k.rule_name, n.rule_name) AS rule_name, coalesce(n.description, k.description) AS description,
               coalesce(k.target_table, n.target_table) AS target_table, coalesce(k.target_column, n.target_column) AS target_column,
               coalesce(k.rule_type, n.rule_type) AS rule_type, coalesce(n.threshold_pct, k.threshold_pct) AS threshold_pct,
               coalesce(n.check_sql, k.check_sql) AS check_sql
        FROM k FULL JOIN n ON k.rule_name = n.rule_name"""
)
def rules_upsert(spark, folder) -> DataFrame:
    """Known rules take the new description, threshold and check, and keep everything else."""
    return quality.upsert_rules(*_rule_tables(spark, folder))


@catalogue.register(f"SELECT * FROM ({_CATALOG}) WHERE rule_type IN ('Validez', 'Completitud')")
def rule_audit(spark, folder) -> DataFrame:
    return quality.list_rules(_rule_tables(spark, folder)[0])
