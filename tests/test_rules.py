"""Format rules at their boundaries, one scan, and the declared catalog."""

import pytest
from pyspark.sql import functions as F

from siltworks.operators import rules

HAND_MADE = [
    ("null", None),
    ("empty", ""),
    ("token", "NULL"),
    ("int", "12"),
    ("negative", "-5"),
    ("newline", "12\n"),
    ("two_decimals", "12.34"),
    ("three_decimals", "12.345"),
    ("ten_digits", "12345678.90"),
    ("eleven_digits", "123456789.01"),
    ("blank", "  "),
    ("hex", "0xAB"),
    ("odd_hex", "0xABC"),
    ("timestamp", "2024-01-31 10:00:00.000"),
    ("month_13", "2024-13-01 00:00:00"),
    ("one", "1"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(HAND_MADE, "id string, v string").cache()


def broken(df, rule):
    return {r.row_key for r in rules.validate(df, "t", [rule], "id").collect()}


INTS = {"int", "one"}
ALL = {name for name, _ in HAND_MADE} - {"null"}


def test_integer(texts):
    assert broken(texts, rules.integer("v")) == ALL - INTS


def test_signed_integer(texts):
    assert broken(texts, rules.signed_integer("v")) == ALL - INTS - {"negative"}


def test_decimal_counts_decimals_and_digits(texts):
    assert broken(texts, rules.decimal("v")) == ALL - INTS - {"two_decimals", "ten_digits"}


def test_max_length_is_inclusive(texts):
    limit = len("12345678.90")
    longer = {name for name, v in HAND_MADE if v is not None and len(v) > limit}
    assert broken(texts, rules.max_length("v", limit)) == longer | {"empty", "token"}
    assert broken(texts, rules.max_length("v", limit, allow_empty=True)) == longer | {"token"}
    assert broken(texts, rules.max_length("v", limit, allow_empty=True, allow_token=True)) == longer


def test_timestamp_shape_and_strict(texts):
    assert broken(texts, rules.timestamp_text("v")) == ALL - {"timestamp", "month_13"}
    assert broken(texts, rules.timestamp_text("v", strict=True)) == ALL - {"timestamp"}


def test_hexadecimal_wants_whole_bytes(texts):
    assert broken(texts, rules.hexadecimal("v")) == ALL - {"hex", "int"}


def test_domain(texts):
    assert broken(texts, rules.domain("v", ["0", "1"])) == ALL - {"one"}


def test_optional_number(texts):
    numbers = INTS | {"negative", "two_decimals", "three_decimals", "ten_digits", "eleven_digits"}
    assert broken(texts, rules.number("v")) == ALL - numbers - {"empty"}
    assert broken(texts, rules.integer("v", allow_empty=True)) == ALL - INTS - {"empty"}


def test_not_null_and_range(texts):
    assert broken(texts, rules.not_null("v")) == {"null"}
    assert broken(texts, rules.in_range("v", 0, 12)) == {
        "negative",
        "two_decimals",
        "three_decimals",
        "ten_digits",
        "eleven_digits",
    }


def test_composite_gives_one_issue(spark):
    df = spark.createDataFrame([("a", "x", "y"), ("b", "1", "y"), ("c", "1", "2"), ("d", None, "z")], "id string, p string, q string")
    rule = rules.any_rule("pq", [rules.integer("p"), rules.integer("q")], "bad pair")
    assert sorted(r.row_key for r in rules.validate(df, "t", [rule], "id").collect()) == ["a", "b", "d"]


def test_all_rules_share_one_scan_without_a_shuffle(spark, tmp_path):
    df = spark.createDataFrame([("1", "2", "x", "3", "4")], "order_id string, product_id string, unit_price string, quantity string, discount string")
    df.write.parquet(str(tmp_path / "t"))
    issues = rules.validate(spark.read.parquet(str(tmp_path / "t")), "t", rules.rules_for("order_details"), "order_id")
    plan = issues._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert [r.issue_desc for r in issues.collect()] == ["unit_price is not a decimal(10,2)"]


def test_failures_agree_with_issues(texts):
    listed = [rules.integer("v"), rules.decimal("v"), rules.hexadecimal("v"), rules.not_null("v")]
    counted = {r.issue_desc: r.failures for r in rules.rule_failures(texts, "t", listed).collect()}
    found = {r.issue_desc: r.issues for r in rules.validation_summary(rules.validate(texts, "t", listed, "id")).collect()}
    assert {k: v for k, v in counted.items() if v} == found


def test_status_of_clean_and_dirty_tables(spark, texts):
    clean = texts.filter("id = 'int'")
    failures = rules.rule_failures(clean, "clean", [rules.integer("v")]).unionByName(
        rules.rule_failures(texts, "dirty", [rules.integer("v")])
    )
    status = {r.table_name: (r.rows_checked, r.errors, r.status) for r in rules.validation_status(failures).collect()}
    assert status == {"clean": (1, 0, "OK"), "dirty": (16, 13, "WARNING")}


def test_catalog_size(spark):
    declared = {e: rules.rules_for(e) for e in [*rules.DECLARED_RULES, "countries"]}
    assert sum(len(r) for e, r in declared.items() if e != "countries") == 81
    assert sum(map(len, declared.values())) == 91
    registry = rules.rule_registry(spark, declared)
    assert registry.count() == 91
    assert registry.filter(F.col("rule_param") == "100").count() > 0
