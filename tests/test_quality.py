"""Profiling, thresholds, gate and publication."""

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from sorted_rows import as_tuples
from pyspark.sql import functions as F

from siltworks.operators import profiling, quality
from siltworks.sources.tables import VersionedStore

NOW = datetime(2025, 1, 1, 12, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def hundred(spark):
    return spark.range(200).select("id", F.when(F.col("id") >= 2, F.col("id")).alias("v"), F.lit("").alias("e"))


def verdicts(spark, df, rules, tables=None):
    results = quality.run_quality_checks({"t": df, **(tables or {})}, "t", rules, 1, NOW)
    return {r.rule_name: (r.rows_evaluated, r.rows_failed, r.failed_pct, r.verdict) for r in results.collect()}


def test_threshold_is_strict_and_unrounded(spark, hundred):
    rules = [
        quality.completeness_rule("at", "t", "v"),
        quality.completeness_rule("above", "t", "v", threshold="0.99"),
        quality.completeness_rule("empty_text", "t", "e", or_empty=True),
        quality.validity_rule("none", "t", "v", "v < 0"),
        quality.QualityRule("unlimited", "", "t", "v", quality.VALIDITY, None, condition="TRUE"),
        # One failing row in 200 is 0.5 %; 0.4999… is not representable, so test the cut itself.
        quality.validity_rule("half", "t", "id", "id = 7", "0.50"),
        quality.validity_rule("just_above", "t", "id", "id = 7", "0.49"),
    ]
    assert verdicts(spark, hundred, rules) == {
        "at": (200, 2, Decimal("1.00"), quality.APPROVED),
        "above": (200, 2, Decimal("1.00"), quality.REJECTED),
        "empty_text": (200, 200, Decimal("100.00"), quality.REJECTED),
        "none": (200, 0, Decimal("0.00"), quality.APPROVED),
        "unlimited": (200, 200, Decimal("100.00"), quality.APPROVED),
        "half": (200, 1, Decimal("0.50"), quality.APPROVED),
        "just_above": (200, 1, Decimal("0.50"), quality.REJECTED),
    }


def test_share_that_rounds_to_the_threshold_is_still_rejected(spark):
    rows = spark.range(30000)
    got = verdicts(spark, rows, [quality.validity_rule("tiny", "t", "id", "id = 1")])
    assert got == {"tiny": (30000, 1, Decimal("0.00"), quality.REJECTED)}


def test_empty_table_fails_nothing(spark, hundred):
    parents = {"p": spark.range(1)}
    rules = [quality.completeness_rule("c", "t", "v"), quality.consistency_rule("fk", "t", "v", "p", "id")]
    assert verdicts(spark, hundred.limit(0), rules, parents) == {
        "c": (0, 0, Decimal("0.00"), quality.APPROVED),
        "fk": (0, 0, Decimal("0.00"), quality.APPROVED),
    }


def test_consistency_and_statement_rules(spark, hundred):
    hundred.createOrReplaceTempView("quality_t")
    rules = [
        quality.consistency_rule("fk", "t", "v", "p", "id"),
        quality.QualityRule("sql", "", "t", "v", quality.VALIDITY, Decimal("50"), statement="SELECT COUNT(*) FROM quality_t WHERE v > 150"),
    ]
    got = verdicts(spark, hundred, rules, {"p": spark.range(190)})
    assert got == {
        "fk": (200, 10, Decimal("5.00"), quality.REJECTED),
        "sql": (200, 49, Decimal("24.50"), quality.APPROVED),
    }


def test_conditions_share_one_scan(spark, hundred, tmp_path):
    hundred.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rules = [quality.validity_rule(f"r{i}", "t", "v", f"v = {i}") for i in range(9)]
    results = quality.run_quality_checks({"t": df}, "t", rules, 1, NOW)
    assert results._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_catalogued_rules_run_by_their_sql(spark, hundred):
    hundred.createOrReplaceTempView("quality_t")
    spark.range(190).createOrReplaceTempView("quality_p")
    rules = [
        quality.completeness_rule("c", "quality_t", "e", or_empty=True),
        quality.validity_rule("v", "quality_t", "v", "v > 150", "50.00"),
        quality.consistency_rule("fk", "quality_t", "v", "quality_p", "id"),
    ]
    tables = {"quality_t": hundred, "quality_p": spark.range(190)}
    direct = quality.run_quality_checks(tables, "quality_t", rules, 1, NOW)
    stored = quality.load_rules(quality.rules_frame(spark, rules), "quality_t")
    by_sql = quality.run_quality_checks(tables, "quality_t", stored, 1, NOW)
    assert [bool(r.condition) for r in stored] == [True, False, True] and stored[1].statement
    assert as_tuples(direct, *direct.columns) == as_tuples(by_sql, *direct.columns)


def results_frame(spark, rows):
    schema = "rule_name string, target_table string, threshold_pct decimal(5,2), run_id long, executed_at timestamp, verdict string"
    return spark.createDataFrame([(f"r{i}", t, Decimal(th), run, at, v) for i, (t, th, run, at, v) in enumerate(rows)], schema)


def test_gate_by_unit_and_age(spark):
    results = results_frame(
        spark,
        [
            ("orders", "1", 1, NOW, quality.APPROVED),
            ("lines", "1", 1, NOW - timedelta(minutes=60), quality.REJECTED),
            ("products", "1", 1, NOW - timedelta(minutes=61), quality.REJECTED),
        ],
    )
    units = {"sales": ("orders", "lines"), "orders": ("orders",), "products": ("products",), "none": ("x",)}
    got = as_tuples(quality.rejections(results, units, NOW), "unit", "rejections", "decision")
    assert got == [("none", 0, "passed"), ("orders", 0, "passed"), ("products", 0, "passed"), ("sales", 1, "blocked")]
    loaded = []
    assert not quality.gated_load({"orders": None, "lines": None}, results, NOW, lambda t, d: loaded.append(t))
    assert quality.gated_load({"orders": None}, results, NOW, lambda t, d: loaded.append(t))
    assert loaded == ["orders"]


def test_only_critical_rejections_of_the_run_discard(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path))

    def outcome(threshold, run, verdict):
        def check(written):
            assert written["t"].count() == 3
            return results_frame(spark, [("t", threshold, run, NOW, verdict)])

        return quality.publish_or_discard(store, {"t": spark.range(3)}, check, 5)

    assert not outcome("0.00", 5, quality.REJECTED)
    assert store.current("t") is None
    assert outcome("1.00", 5, quality.REJECTED)
    assert outcome("0.00", 4, quality.REJECTED)
    assert outcome("0.00", 5, quality.APPROVED)
    assert store.current("t").count() == 3


def test_rule_upsert_and_audit(spark):
    first = quality.rules_frame(spark, quality.STAGING_RULES + quality.MODEL_RULES)
    changed = quality.validity_rule("DETALLE_PRECIO_VALIDEZ", "elsewhere", "other", "unit_price < 1", "2.00")
    added = quality.completeness_rule("NEW", "t", "c")
    after = quality.upsert_rules(first, quality.rules_frame(spark, [changed, added]))
    assert after.count() == 18
    row = after.filter("rule_name = 'DETALLE_PRECIO_VALIDEZ'").first()
    assert (row.target_table, row.target_column, row.threshold_pct) == ("tmp_order_details", "unit_price", Decimal("2.00"))
    assert row.check_sql == "SELECT COUNT(*) FROM elsewhere WHERE unit_price < 1"
    listed = [(r.rule_type, r.rule_name) for r in quality.list_rules(after).collect()]
    assert listed == sorted(listed) and len(listed) == 14


def test_profile(spark):
    df = spark.createDataFrame([("1", "a", 5), ("22", None, 5), ("1", "b", None)], "n string, t string, i int")
    expected = [
        ("i", 3, 1, 1, "5", "5", Decimal("1.0000"), 1, "int"),
        ("n", 3, 0, 2, "1", "22", Decimal("1.3333"), 2, "integer"),
        ("t", 3, 1, 2, "a", "b", Decimal("1.0000"), 1, "text"),
    ]
    columns = ["column_name", "row_count", "null_count", "distinct_count", "min_value", "max_value", "avg_length", "max_length", "detected_type"]
    assert as_tuples(profiling.profile_table(df, "t"), *columns) == expected
    assert as_tuples(profiling.profile_table(df, "t", approximate=True), *columns) == expected


def test_profile_reads_the_table_once(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 AS k", "string(id) AS t").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for approximate in (False, True):
        plan = profiling.profile_table(df, "t", approximate)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1


def test_profile_of_odd_columns(spark):
    """No rows, nulls only, more columns than one aggregate lays out, names with dots."""
    empty = profiling.profile_table(spark.createDataFrame([], "a int, `b.c` string"), "t")
    assert as_tuples(empty, "column_name", "row_count", "distinct_count", "min_value") == [("a", 0, 0, None), ("b.c", 0, 0, None)]
    nulls = profiling.profile_table(spark.createDataFrame([(None, 1.5), (None, -0.5)], "a string, d double"), "t")
    assert as_tuples(nulls, "column_name", "null_count", "avg_length", "min_value", "detected_type") == [
        ("a", 2, None, None, None),
        ("d", 0, Decimal("3.5000"), "-0.5", "double"),
    ]
    wide = spark.range(3).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(130)])
    found = {r.column_name: (r.distinct_count, r.max_value) for r in profiling.profile_table(wide, "t").collect()}
    assert len(found) == 130 and found["c0"] == (1, "0") and found["c129"] == (3, "258")


def test_sketches_of_batches_are_united(spark):
    whole = spark.range(30_000).selectExpr("id % 7000 AS k", "string(id % 3 * 5) AS t", "CAST(id AS DOUBLE) - 15000 AS x", "CAST(NULL AS INT) AS n")
    bounds = [(-15000, -10000), (-10000, 4000), (4000, 15000)]
    parts = [profiling.sketches(whole.filter((F.col("x") >= a) & (F.col("x") < b)), "w", str(a)) for a, b in bounds]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2])
    exact = {r.column_name: r for r in profiling.profile_table(whole, "w").collect()}
    for r in profiling.profile_of(stored).collect():
        e = exact[r.column_name]
        assert (r.row_count, r.null_count, r.min_value, r.max_value, r.avg_length, r.max_length, r.detected_type) == (
            e.row_count, e.null_count, e.min_value, e.max_value, e.avg_length, e.max_length, e.detected_type,
        )
        assert abs(r.distinct_count - e.distinct_count) <= 0.05 * e.distinct_count
        if r.column_name == "x":
            assert abs(r.median) <= 0.0165 * 30_000
        assert r.column_name != "t" or r.median is None


def test_ranges_groups_and_extremes(spark):
    df = spark.createDataFrame([("1", "5"), ("2", "10.5"), ("3", "x"), ("4", None), ("5", "0"), ("6", "5")], "id string, v string")
    assert tuple(profiling.numeric_range(df, "v").first()) == (Decimal("0.0000"), Decimal("10.5000"), Decimal("5.1250"))
    numbers = df.withColumn("n", F.col("v").try_cast("decimal(10,2)"))
    assert [r.id for r in profiling.top_rows(numbers, "n", "id", ["id"], 3).collect()] == ["2", "1", "6"]
    assert [r.id for r in profiling.bottom_rows(numbers, "n", "id", ["id"], 2).collect()] == ["5", "1"]
    assert [r.id for r in profiling.bottom_rows(numbers, "n", "id", ["id"], 2, above_zero=True).collect()] == ["1", "6"]
    child = spark.createDataFrame([(1,)] * 3 + [(2,)] * 3 + [(3,)] * 5 + [(None,)], "fk int")
    parent = spark.createDataFrame([(1, "b"), (2, "a"), (4, "none")], "k int, label string")
    assert [tuple(r) for r in profiling.top_groups(child, "fk", parent, "k", "label", "n", 2).collect()] == [("a", 3), ("b", 3)]
    counts = profiling.cardinality({"x": (child, "fk"), "y": (parent, "label")}).first()
    assert tuple(counts) == (3, 3)
    missing = profiling.completeness(df.withColumn("e", F.lit("")), ["v", "e"], "t").first()
    assert tuple(missing) == ("t", 6, 1, 6)
