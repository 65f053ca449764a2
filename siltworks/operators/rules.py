"""Format rules on staged text: declared once, checked in one scan, listed as a catalog.

A null never breaks a rule, except ``not_null``. Empty text and the text NULL break every rule
that is not told to allow them.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import (
    HEX_TEXT,
    MONEY_TEXT,
    NULL_TOKEN,
    SIGNED_INTEGER,
    SIGNED_NUMBER,
    TIMESTAMP_TEXT,
    UNSIGNED_INTEGER,
    UNSIGNED_NUMBER,
    any_of,
)
from siltworks.sources.staging import rows


@dataclass(frozen=True)
class FieldRule:
    """``broken`` is true for a row that breaks the rule; null counts as not broken."""

    column: str
    rule_type: str
    rule_param: str
    issue: str
    broken: Column


def _placeholders(column: str, allow_empty: bool, allow_token: bool) -> list[Column]:
    refused = [v for v, allowed in ((NULL_TOKEN, allow_token), ("", allow_empty)) if not allowed]
    return [F.col(column).isin(refused)] if refused else []


def _pattern_rule(column, pattern, rule_type, rule_param, issue, allow_empty, extra=()) -> FieldRule:
    mismatch = ~F.col(column).rlike(pattern)
    if allow_empty:
        mismatch = mismatch & (F.col(column) != "")
    broken = any_of([mismatch, *extra, *_placeholders(column, allow_empty, allow_token=False)])
    return FieldRule(column, rule_type, rule_param, issue, broken)


def integer(column: str, allow_empty: bool = False) -> FieldRule:
    return _pattern_rule(column, UNSIGNED_INTEGER, "TYPE", "INTEGER", f"{column} is not an integer", allow_empty)


def signed_integer(column: str, allow_empty: bool = False) -> FieldRule:
    return _pattern_rule(
        column, SIGNED_INTEGER, "TYPE", "SIGNED INTEGER", f"{column} is not a signed integer", allow_empty
    )


def max_length(column: str, limit: int, allow_empty: bool = False, allow_token: bool = False) -> FieldRule:
    broken = any_of([F.length(column) > limit, *_placeholders(column, allow_empty, allow_token)])
    return FieldRule(column, "LENGTH", str(limit), f"{column} is longer than {limit}", broken)


def decimal(column: str, scale: int = 2, digits: int = 10, allow_empty: bool = False) -> FieldRule:
    """Unsigned number with at most ``scale`` decimals and ``digits`` digits in all."""
    pattern = MONEY_TEXT if scale == 2 else rf"^[0-9]+(\.[0-9]{{1,{scale}}})?\z"
    too_many = F.length(F.replace(F.col(column), F.lit("."), F.lit(""))) > digits
    return _pattern_rule(
        column,
        pattern,
        "FORMAT",
        f"DECIMAL({digits},{scale})",
        f"{column} is not a decimal({digits},{scale})",
        allow_empty,
        extra=[too_many],
    )


def number(column: str, signed: bool = True, allow_empty: bool = True) -> FieldRule:
    pattern = SIGNED_NUMBER if signed else UNSIGNED_NUMBER
    return _pattern_rule(column, pattern, "TYPE", "NUMERIC", f"{column} is not a number", allow_empty)


def timestamp_text(column: str, strict: bool = False) -> FieldRule:
    """Shape ``yyyy-MM-dd HH:mm:ss[.fff]``; ``strict`` also wants an existing date and time."""
    extra = [F.col(column).isNotNull() & F.col(column).try_cast("timestamp").isNull()] if strict else []
    return _pattern_rule(
        column,
        TIMESTAMP_TEXT,
        "FORMAT",
        "YYYY-MM-DD HH24:MI:SS.MS",
        f"{column} is not a timestamp",
        False,
        extra=extra,
    )


def hexadecimal(column: str) -> FieldRule:
    return _pattern_rule(column, HEX_TEXT, "TYPE", "BYTEA", f"{column} is not hexadecimal", False)


def domain(column: str, values: list[str]) -> FieldRule:
    listed = "|".join(values)
    return FieldRule(column, "DOMAIN", listed, f"{column} is not one of {listed}", ~F.col(column).isin(values))


def matches(column: str, pattern: str, allow_empty: bool = False) -> FieldRule:
    return _pattern_rule(column, pattern, "REGEX", pattern, f"{column} has a wrong pattern", allow_empty)


def not_null(column: str) -> FieldRule:
    return FieldRule(column, "NOT_NULL", "", f"{column} is null", F.col(column).isNull())


def in_range(column: str, low, high) -> FieldRule:
    """Numeric text outside [low, high]; text that is no number is another rule's concern."""
    value = F.col(column).try_cast("decimal(38,10)")
    broken = ~value.between(F.lit(low), F.lit(high))
    return FieldRule(column, "RANGE", f"{low}..{high}", f"{column} is outside {low}..{high}", broken)


def any_rule(label: str, rules: list[FieldRule], issue: str) -> FieldRule:
    """One issue when any of the rules is broken."""
    broken = any_of([F.coalesce(r.broken, F.lit(False)) for r in rules])
    return FieldRule(label, "COMPOSITE", ",".join(r.column for r in rules), issue, broken)


# The rules of each staged file, in the order of its columns. Each entry names a
# rule constructor of this module, the column, and the rule's parameters.
DECLARED_RULES: dict[str, list[tuple]] = {
    "categories": [("integer", "category_id"), ("max_length", "category_name", 50), ("hexadecimal", "picture")],
    "customers": [
        ("max_length", "customer_id", 10),
        ("max_length", "customer_name", 100),
        ("max_length", "contact_name", 100),
        ("max_length", "contact_title", 100),
        ("max_length", "address", 200),
        ("max_length", "city", 50),
        ("max_length", "regions", 50),
        ("max_length", "postal_code", 20),
        ("max_length", "country", 50),
        ("max_length", "phone", 50),
        ("max_length", "fax", 50),
    ],
    "employee_territories": [("integer", "employee_id"), ("max_length", "territory_id", 20)],
    "employees": [
        ("integer", "employee_id"),
        ("max_length", "last_name", 50),
        ("max_length", "first_name", 50),
        ("max_length", "title", 100),
        ("max_length", "title_of_courtesy", 50),
        ("timestamp_text", "birth_date"),
        ("timestamp_text", "hire_date"),
        ("max_length", "address", 200),
        ("max_length", "city", 50),
        ("max_length", "region", 50),
        ("max_length", "postal_code", 20),
        ("max_length", "country", 50),
        ("max_length", "home_phone", 50),
        ("max_length", "extension", 10),
        ("hexadecimal", "photo"),
        ("integer", "reports_to"),
        ("max_length", "photo_path", 200),
    ],
    "shippers": [("integer", "shipper_id"), ("max_length", "company_name", 100), ("max_length", "phone", 50)],
    "suppliers": [
        ("integer", "supplier_id"),
        ("max_length", "company_name", 100),
        ("max_length", "contact_name", 100),
        ("max_length", "contact_title", 100),
        ("max_length", "address", 200),
        ("max_length", "city", 50),
        ("max_length", "region", 50),
        ("max_length", "postal_code", 20),
        ("max_length", "country", 50),
        ("max_length", "phone", 50),
        ("max_length", "fax", 50),
    ],
    "products": [
        ("integer", "product_id"),
        ("max_length", "product_name", 100),
        ("integer", "supplier_id"),
        ("integer", "category_id"),
        ("max_length", "quantity_per_unit", 100),
        ("decimal", "unit_price"),
        ("signed_integer", "units_in_stock"),
        ("signed_integer", "units_on_order"),
        ("signed_integer", "reorder_level"),
        ("domain", "discontinued", ["0", "1"]),
    ],
    "orders": [
        ("integer", "order_id"),
        ("max_length", "customer_id", 10),
        ("integer", "employee_id"),
        ("timestamp_text", "order_date"),
        ("timestamp_text", "required_date"),
        ("timestamp_text", "shipped_date"),
        ("integer", "ship_via"),
        ("decimal", "freight"),
        ("max_length", "ship_name", 100),
        ("max_length", "ship_address", 200),
        ("max_length", "ship_city", 50),
        ("max_length", "ship_region", 50),
        ("max_length", "ship_postal_code", 20),
        ("max_length", "ship_country", 50),
    ],
    "order_details": [
        ("integer", "order_id"),
        ("integer", "product_id"),
        ("decimal", "unit_price"),
        ("signed_integer", "quantity"),
        ("decimal", "discount"),
    ],
    "regions": [("integer", "region_id"), ("max_length", "region_description", 100)],
    "territories": [
        ("max_length", "territory_id", 20),
        ("max_length", "territory_description", 100),
        ("integer", "region_id"),
    ],
}


def rules_for(entity: str) -> list[FieldRule]:
    """The declared rules of an entity."""
    if entity == "countries":
        return _country_rules()
    return [globals()[kind](*arguments) for kind, *arguments in DECLARED_RULES[entity]]


def _country_rules() -> list[FieldRule]:
    rates = [
        matches(column, UNSIGNED_NUMBER, allow_empty=True)
        for column in ("birth_rate", "cpi", "tax_revenue_percent")
    ]
    return [
        max_length("abbreviation", 5, allow_empty=True),
        max_length("calling_code", 10, allow_empty=True, allow_token=True),
        max_length("currency_code", 10, allow_empty=True, allow_token=True),
        integer("armed_forces_size", allow_empty=True),
        integer("population", allow_empty=True),
        integer("urban_population", allow_empty=True),
        number("gdp"),
        number("latitude"),
        number("longitude"),
        any_rule("rates", rates, "a rate or percentage is malformed"),
    ]


def rule_registry(
    spark: SparkSession, rules: dict[str, list[FieldRule]], keys: dict[str, list[str]] | None = None
) -> DataFrame:
    """The declared rules as a table, the same objects that the checks run; with ``keys``, also
    that these are unique, which ``integrity.pk_duplicates`` checks."""
    unique = {table: "|".join(columns) for table, columns in (keys or {}).items()}
    return rows(
        spark,
        [(table, r.column, r.rule_type, r.rule_param, r.issue) for table, listed in rules.items() for r in listed]
        + [(table, key, "UNIQUE", None, f"{key} is repeated") for table, key in unique.items()],
        "table_name string, column_name string, rule_type string, rule_param string, description string",
    )


def row_key(keys: list[str]) -> Column:
    """The key of a row as text. A missing part is marked, so that parts never change places."""
    parts = [F.col(k).cast("string") for k in keys]
    return parts[0] if len(parts) == 1 else F.concat_ws("|", *[F.coalesce(p, F.lit("<null>")) for p in parts])


def validate(
    df: DataFrame,
    table: str,
    rules: list[FieldRule],
    key: str | Column,
    run_id: int | None = None,
    created_at: datetime | None = None,
) -> DataFrame:
    """One row per broken rule and row, from a single scan of the table and without a shuffle.

    Every rule gives its text or null; the nulls are dropped after the rows are spread. That
    form is compiled as a whole, unlike a filter on the array.
    """
    issues = F.array(*[F.when(r.broken, F.lit(r.issue)) for r in rules])
    row_key = (F.col(key) if isinstance(key, str) else key).cast("string")
    spread = df.select(row_key.alias("row_key"), F.explode(issues).alias("issue_desc"))
    found = spread.filter(F.col("issue_desc").isNotNull())
    columns = [F.lit(table).alias("table_name"), "row_key", "issue_desc"]
    if run_id is not None:
        columns = [F.lit(run_id).cast("long").alias("log_id"), *columns]
    if created_at is not None:
        columns.append(F.lit(created_at).alias("created_at"))
    return found.select(*columns)


def rule_failures(df: DataFrame, table: str, rules: list[FieldRule]) -> DataFrame:
    """Rows checked and rows failing per rule: one aggregate, so only counts are shuffled."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(r.broken).alias(f"_rule_{i}") for i, r in enumerate(rules)],
    )
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.column).alias("column_name"),
                F.lit(r.rule_type).alias("rule_type"),
                F.lit(r.issue).alias("issue_desc"),
                F.col(f"_rule_{i}").alias("failures"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), F.col("_rows").alias("rows_checked"), F.inline(per_rule))


def failure_measures(rules: list[FieldRule], among: Column) -> list[Column]:
    """What to count while a table is written, so that ``counted_failures`` needs no scan: rows ``among`` which a rule is broken."""
    return [F.count_if(among & r.broken).alias(f"_rule_{i}") for i, r in enumerate(rules)]


def counted_failures(spark: SparkSession, table: str, rules: list[FieldRule], counts: dict[str, int]) -> DataFrame:
    """``rule_failures`` from counts that the write of the table has gathered: ``rows``, and a measure per rule."""
    found = [(table, counts["rows"], r.column, r.rule_type, r.issue, counts[f"_rule_{i}"]) for i, r in enumerate(rules)]
    return rows(spark, found, "table_name string, rows_checked long, column_name string, rule_type string, issue_desc string, failures long")


def validation_status(failures: DataFrame) -> DataFrame:
    """Errors and status per table: OK without any error, WARNING otherwise."""
    total = F.sum("failures")
    return failures.groupBy("table_name").agg(
        F.max("rows_checked").alias("rows_checked"),
        total.alias("errors"),
        F.when(total > 0, "WARNING").otherwise("OK").alias("status"),
    )


def validation_summary(issues: DataFrame) -> DataFrame:
    """Issues counted by table and kind, from stored issue rows."""
    return issues.groupBy("table_name", "issue_desc").agg(F.count(F.lit(1)).alias("issues"))
