"""Cleaning, typed load, staging sources and stored tables."""

from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from sorted_rows import as_tuples
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltworks import functions as fn
from siltworks.operators import cleaning
from siltworks.operators.typed import quarantine, to_typed
from siltworks.plans.warehouse import patch_countries
from siltworks.schemas import ENTITIES
from siltworks.session import shared_folder
from siltworks.sources import staging, tables


def one(spark, expression, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, (str, type(None))) else 'int'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("r")).first().r


def test_expressions(spark):
    assert one(spark, fn.null_token("v"), v="NULL") is None
    assert one(spark, fn.null_token("v"), v="null") == "null"
    assert one(spark, fn.empty_to_null("v"), v="  ") is None
    assert one(spark, fn.strip_characters("v", ",$"), v="$1,234.50 ") == "1234.50"
    assert [one(spark, fn.flag_to_int("v"), v=t) for t in ("TRUE", "FALSE", "1", None)] == [1, 0, 1, None]
    assert [one(spark, fn.is_one("v"), v=t) for t in (1, 0, 2)] == [True, False, False]
    assert one(spark, fn.is_one(F.col("v").cast("int")), v=None) is False
    assert one(spark, fn.full_name("a", "b"), a="Ann", b="Lee") == "Ann Lee"
    assert one(spark, fn.full_name("a", "b"), a="Ann", b=None) is None
    assert one(spark, fn.date_key(F.to_date("d")), d="1998-01-09") == 19980109
    assert one(spark, fn.hex_to_binary("v"), v="0x4142") == bytearray(b"AB")
    assert one(spark, fn.hex_to_binary("v"), v="0x414") is None
    assert one(spark, fn.normalised_name("v"), v=" \tUK ") == "\tuk"
    assert one(spark, fn.guarded_number("v"), v="1e5") is None


def test_line_amount_rounds_once_half_away_from_zero(spark):
    def amount(price, quantity, discount):
        return one(
            spark,
            fn.line_amount(F.col("p").cast("decimal(10,2)"), F.col("q").cast("int"), F.col("d").cast("decimal(4,2)")),
            p=price,
            q=quantity,
            d=discount,
        )

    assert amount("38.00", "20", "0.15") == Decimal("646.00")
    assert amount("0.10", "1", "0.05") == Decimal("0.10")
    assert amount("0.50", "1", "0.01") == Decimal("0.50")
    assert amount("-0.50", "1", "0.01") == Decimal("-0.50")


def test_strict_hex_and_cast_fail_the_job(spark):
    with pytest.raises(PySparkException):
        one(spark, fn.hex_to_binary("v", strict=True), v="0xZZ")
    bad = spark.createDataFrame([("x", "2", "1.0", "1", "0")], ",".join(f"{c} string" for c in ENTITIES["order_details"].columns))
    with pytest.raises(PySparkException):
        to_typed(bad, "order_details").collect()
    too_long = spark.createDataFrame([("1", "t" * 21)], "employee_id string, territory_id string")
    with pytest.raises(PySparkException):
        to_typed(too_long, "employee_territories").collect()


def test_quarantine_splits_rows_and_names_columns(spark, tmp_path):
    columns = list(ENTITIES["products"].columns)
    rows = [
        ("1", "ok", "NULL", "2", "box", "NULL", "-3", "0", "1", "TRUE"),
        ("x", "bad key and flag", "1", "2", "box", "1.50", "3", "0", "1", "maybe"),
        ("3", "p" * 101, "1", "2", "box", "1.50", "3", "0", "1", "0"),
        (None, None, None, None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    good, rejected = quarantine(df, "products", str(tmp_path / "q"))
    assert as_tuples(good, "product_id", "supplier_id", "unit_price", "units_in_stock", "discontinued") == [
        (1, None, None, -3, 1),
        (None, None, None, None, None),
    ]
    assert as_tuples(rejected, "product_id", "failed_columns") == [
        ("3", ["product_name"]),
        ("x", ["product_id", "discontinued"]),
    ]


def test_dates_and_trimmed_text(spark):
    df = spark.createDataFrame([(" 1", "East   ", "2")], "territory_id string, territory_description string, region_id string")
    assert to_typed(df, "territories").first() == (" 1", "East", 2)
    row = {c: "NULL" for c in ENTITIES["orders"].columns} | {"order_id": "7", "order_date": "1998-01-01 00:00:00.000"}
    typed = to_typed(spark.createDataFrame([row], ENTITIES["orders"].text_schema), "orders").first()
    assert typed.order_date == date(1998, 1, 1) and typed.freight is None and typed.ship_city == "NULL"


def country_row(**values):
    return {c: values.get(c, "") for c in ENTITIES["countries"].columns}


def test_country_file(spark):
    rows = [
        country_row(country_name="A", population="1,234", gdp="$1,234.50 ", unemployment_rate_percent="12.5%", minimum_wage="$1.20 ", abbreviation="TOOLONG", cpi="1,110.5", armed_forces_size="NULL", latitude="-1.5"),
        country_row(country_name="Tonga", abbreviation="TO", capital_city="Nukuʻalofa"),
        country_row(country_name="Palestinian National Authority"),
    ]
    text = spark.createDataFrame(rows, ENTITIES["countries"].text_schema)
    typed = to_typed(cleaning.clean_countries(text), "countries")
    a = typed.filter("country_name = 'A'").first()
    assert (a.population, a.gdp, a.unemployment_rate_percent, a.minimum_wage) == (1234, Decimal("1234.5"), Decimal("12.5"), Decimal("1.2"))
    assert (a.abbreviation, a.cpi, a.armed_forces_size, a.latitude, a.capital_city) == ("TOOLO", Decimal("1110.5"), None, Decimal("-1.5"), None)
    patched = patch_countries(spark, typed)
    assert as_tuples(patched, "country_name", "abbreviation", "capital_city") == [
        ("A", "TOOLO", None),
        ("Palestinian National Authority", "PS", "Ramallah"),
        ("Tonga", "TO", "Nuku'alofa"),
    ]


def test_recode_and_patch(spark):
    df = spark.createDataFrame([(1, "UK"), (2, "Peru"), (3, None)], "id int, country string")
    assert as_tuples(cleaning.recode(df, "country", {"UK": "United Kingdom"}), "country") == [("Peru",), ("United Kingdom",), (None,)]
    mapping = spark.createDataFrame([("UK", "GB"), ("Chad", "TD")], "f string, t string")
    assert as_tuples(cleaning.recode_with(df, "country", mapping, "f", "t"), "id", "country") == [(1, "GB"), (2, "Peru"), (3, None)]
    counts = cleaning.null_token_counts(df, ["country"], token="UK").first()
    assert (counts.rows_touched, counts.country_changed) == (1, 1)


def test_evolve_keeps_an_existing_column(spark):
    df = spark.createDataFrame([(1,)], "active int")
    assert staging.evolve(df, "active", "boolean", True).schema.simpleString() == "struct<active:int>"
    assert staging.evolve(df, "n", "decimal(5,2)", 3).first().n == Decimal("3.00")


def test_generated_days(spark):
    days = staging.generate_days(spark, "1996-01-01", 15001).agg(F.min("full_date"), F.max("full_date")).first()
    assert tuple(days) == (date(1996, 1, 1), date(2037, 1, 25))


def test_versions_are_published_together(spark, tmp_path):
    store = tables.VersionedStore(spark, str(tmp_path))
    assert store.current("a") is None
    first = {"a": store.write("a", spark.range(3)), "b": store.write("b", spark.range(2))}
    assert store.current("a") is None
    store.publish(first)
    again = tables.VersionedStore(spark, str(tmp_path))
    assert (again.current("a").count(), again.current("b").count()) == (3, 2)
    # A version may be built from the one in force, and an empty one can be read.
    again.publish({"a": again.write("a", again.current("a").filter("id < 0"))})
    assert store.published()["b"] == first["b"]
    assert tables.VersionedStore(spark, str(tmp_path)).current("a").count() == 0


def test_refresh_and_append(spark, tmp_path):
    path, when = str(tmp_path / "t"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    tables.load_overwrite(spark.range(5), path, when)
    tables.load_overwrite(spark.range(2), path, when)
    tables.load_append(spark.range(1), path, when)
    stored = spark.read.parquet(path)
    assert stored.count() == 3 and stored.select("load_date").distinct().count() == 1


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
