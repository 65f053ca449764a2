"""Two sample batches end to end, against facts computed from their files.

Runs only where SAMPLE_BATCHES names a folder with the CSV files of a first and a second batch
in subfolders that sort in that order; ``test_warehouse.py`` covers the same run without them.
"""

import glob
import os
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from sorted_rows import as_tuples

from siltworks.operators.quality import validity_rule
from siltworks.plans.exploration import exploratory_profile
from siltworks.plans.warehouse import Warehouse
from siltworks.schemas import ENTITIES
from siltworks.sources.staging import read_staging_csv

SAMPLES = os.environ.get("SAMPLE_BATCHES", "")

pytestmark = pytest.mark.skipif(not os.path.isdir(SAMPLES), reason="SAMPLE_BATCHES names no folder")


def batch_files(number: int) -> dict[str, str]:
    """CSV files of a batch by entity: the file name up to its first blank or dot."""
    folders = sorted({os.path.dirname(f) for f in glob.glob(f"{SAMPLES}/**/*.csv", recursive=True)})
    files = glob.glob(f"{folders[number - 1]}/*.csv")
    return {os.path.basename(f).replace(".", " ").split()[0]: f for f in files}

NOW = datetime(2025, 1, 1, 12, 0, tzinfo=timezone.utc)
LATER = datetime(2025, 1, 2, 12, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Warehouse after the first batch, with an empty sales history."""
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    text = warehouse.stage("1", batch_files(1))
    for entity in ("orders", "order_details"):
        text[entity] = read_staging_csv(spark, batch_files(2)[entity], entity).limit(0)
    typed = warehouse.typed(text)
    results = warehouse.check_quality(typed, 1, NOW)
    decisions = warehouse.load_memory(typed, results, NOW, NOW)
    return warehouse, text, typed, decisions


@pytest.fixture(scope="module")
def updated(loaded):
    warehouse = loaded[0]
    text = warehouse.stage("2", batch_files(2))
    typed = warehouse.typed(text)
    relations = {tuple(r)[:4]: r.orphan_rows for r in warehouse.check_relations(typed).collect()}
    published = warehouse.apply_batch(typed, 2, LATER, LATER)
    return warehouse, typed, relations, published


def test_row_counts_of_the_files(loaded):
    _, text, typed, _ = loaded
    expected = {
        "categories": 8,
        "customers": 91,
        "employees": 9,
        "employee_territories": 49,
        "products": 77,
        "regions": 4,
        "shippers": 6,
        "suppliers": 29,
        "territories": 53,
    }
    assert {e: text[e].count() for e in expected} == expected
    assert {e: typed[e].count() for e in expected} == expected


def test_leading_zeros_and_tokens_survive_staging(loaded):
    _, text, typed, _ = loaded
    assert text["territories"].filter("territory_id = '01581'").count() == 1
    assert text["customers"].filter("regions = 'NULL'").count() == 60
    assert typed["customers"].filter("region IS NULL").count() == 60
    assert typed["customers"].filter("fax IS NULL").count() == 22
    assert typed["employees"].filter("reports_to IS NULL").count() == 1
    assert typed["suppliers"].filter("homepage IS NULL").count() == 24
    assert text["customers"].filter("city = ' 12Rio de Janeiro'").count() == 1


def test_typed_values(loaded):
    typed = loaded[2]
    row = typed["products"].selectExpr("min(unit_price) a", "max(unit_price) b", "sum(unit_price) c").first()
    assert (row.a, row.b, row.c) == (Decimal("2.50"), Decimal("263.50"), Decimal("2222.71"))
    assert typed["products"].filter("discontinued = 1").count() == 8
    assert typed["categories"].selectExpr("min(length(picture)) n").first().n == 127
    assert isinstance(typed["employees"].first().hire_date, date)


def test_format_issues_are_the_null_tokens(loaded):
    warehouse, text, _, _ = loaded
    issues = warehouse.validate({e: text[e] for e in ("customers", "suppliers", "employees", "products")}, 1)
    counted = {(r.table_name, r.issue_desc): r.n for r in issues.groupBy("table_name", "issue_desc").agg({"*": "count"}).toDF("table_name", "issue_desc", "n").collect()}
    assert counted == {
        ("txt_customers", "regions is longer than 50"): 60,
        ("txt_customers", "postal_code is longer than 20"): 1,
        ("txt_customers", "fax is longer than 50"): 22,
        ("txt_suppliers", "region is longer than 50"): 20,
        ("txt_suppliers", "fax is longer than 50"): 16,
        ("txt_employees", "region is longer than 50"): 4,
        ("txt_employees", "reports_to is not an integer"): 1,
    }
    status = {r.table_name: r.status for r in warehouse.validation_status(text).collect()}
    assert status["txt_customers"] == "WARNING" and status["txt_products"] == "OK"


def test_keys_are_clean_and_gate_passes(loaded):
    warehouse, text, _, decisions = loaded
    for row in warehouse.check_keys(text).collect():
        assert (row.blank_rows, row.duplicate_keys) == (0, 0)
    assert all(decisions.values())


def test_exploratory_profile(loaded):
    text = loaded[1]
    reports = exploratory_profile(text)
    assert [tuple(r) for r in reports["products_per_category"].collect()] == [
        ("Confections", 13),
        ("Beverages", 12),
        ("Condiments", 12),
        ("Seafood", 12),
        ("Dairy Products", 10),
        ("Grains/Cereals", 7),
        ("Meat/Poultry", 6),
        ("Produce", 5),
    ]
    assert as_tuples(reports["countries_per_origin"], "source", "distinct_values") == [("customers", 21), ("suppliers", 16)]
    assert tuple(reports["cardinality"].first()) == (91, 77, 29)
    # 2222.71 / 77 = 28.866363…
    assert [str(v) for v in reports["price_range"].first()] == ["2.5000", "263.5000", "28.8664"]
    assert tuple(reports["completeness_customers"].first()) == ("txt_customers", 91, 0, 0, 0)
    assert [str(r.unit_price.normalize()) for r in reports["dearest_products"].collect()][0] == "263.5"
    assert reports["least_stock"].filter("units_in_stock <= 0").count() == 0
    assert loaded[0].malformed_keys(text).count() == 0


def test_first_batch_has_no_orphans(loaded):
    warehouse, _, typed, _ = loaded
    assert {r.orphan_rows for r in warehouse.check_relations(typed).collect()} == {0}


def test_only_the_unknown_customer_is_an_orphan(updated):
    relations = updated[2]
    assert {r: n for r, n in relations.items() if n} == {("customers", "customer_id", "orders", "customer_id"): 1}


def test_versions_after_the_second_batch(updated):
    warehouse, _, _, published = updated
    assert published
    products, customers = warehouse.memory("products"), warehouse.memory("customers")
    assert (products.count(), products.filter("active").count()) == (80, 77)
    assert (customers.count(), customers.filter("active").count()) == (93, 91)
    prices = {r.product_id: (r.unit_price, r.units_in_stock) for r in products.filter("active AND product_id IN (6, 7, 12)").collect()}
    assert prices == {6: (Decimal("27.00"), 80), 7: (Decimal("33.10"), 30), 12: (Decimal("41.20"), 94)}
    assert customers.filter("NOT active").count() == 2


def test_orphan_order_is_absent_from_the_fact(updated):
    warehouse = updated[0]
    assert warehouse.memory("order_details").count() == 14
    assert warehouse.model("fact_table").count() == 12


def test_sales_by_employee(updated):
    view = updated[0].sales_by_employee()
    got = {
        r.full_name.split()[-1]: (str(r.total_revenue), r.total_orders, str(r.average_order_value), r.total_units_sold)
        for r in view.filter("year = 1998 AND quarter = 'Q1'").collect()
    }
    assert got == {
        "Davolio": ("602.40", 2, "301.20", 47),
        "Fuller": ("187.00", 3, "62.33", 17),
        "Buchanan": ("1692.80", 3, "564.27", 76),
        "King": ("140.00", 1, "140.00", 20),
        "Callahan": ("852.00", 3, "284.00", 63),
    }


def test_same_batch_again_changes_nothing(updated):
    warehouse, typed, _, _ = updated
    before = {e: warehouse.memory(e).count() for e in ("products", "customers", "orders", "order_details")}
    assert warehouse.apply_batch(typed, 3, LATER, LATER)
    assert {e: warehouse.memory(e).count() for e in before} == before


def test_rejected_batch_publishes_nothing(updated, spark):
    warehouse, typed, _, _ = updated
    before = warehouse.store.published()
    strict = validity_rule("NO_SALES_ALLOWED", "fact_table", "quantity", "quantity > 0")
    changed = {"products": typed["products"].withColumn("unit_price", typed["products"].unit_price + 1)}
    assert not warehouse.apply_batch(changed, 4, LATER, LATER, [strict])
    assert warehouse.store.published() == before


def test_countries_are_standardised(updated):
    warehouse = updated[0]
    warehouse.standardise_countries()
    names = {r.country for r in warehouse.memory("customers").select("country").distinct().collect()}
    assert {"United Kingdom", "United States", "Republic of Ireland"} <= names
    assert not {"UK", "USA", "Ireland"} & names


def test_batches_only_add_to_a_history(updated):
    """The base stays where it was when later batches came, and a batch adds the rows it changes."""
    store = updated[0].store
    base, *added = store.published()["dwm_products"].folders
    assert base and len(added) == 1


def test_country_keys_reach_the_dimensions(updated, spark):
    """With a country table in memory, customers and employees are resolved by name."""
    warehouse = updated[0]
    columns = ENTITIES["countries"].columns
    rows = [
        {c: "" for c in columns} | {"country_name": name, "abbreviation": code, "population": "1,000", "capital_city": capital}
        for name, code, capital in [
            ("United Kingdom", "GB", "London"),
            (" united states", "US", "Washington"),
            ("Brazil", "BR", "Bras\u00edlia"),
        ]
    ]
    text = spark.createDataFrame(rows, ENTITIES["countries"].text_schema)
    typed = warehouse.typed({"countries": text})
    assert warehouse.apply_batch(typed, 9, LATER, LATER)
    warehouse.standardise_countries()
    warehouse.rebuild(LATER)
    countries = warehouse.model("dim_country")
    assert as_tuples(countries, "country_name", "capital_city", "population")[1] == ("Brazil", "Brasilia", 1000)
    placed = warehouse.model("dim_customer").join(countries, "country_key")
    assert placed.filter("country = 'United States'").count() == 13
    assert {r.country for r in placed.select("country").distinct().collect()} == {"United Kingdom", "United States", "Brazil"}
    assert warehouse.model("dim_employee").filter("country_key IS NULL").count() == 0
    assert "country_key" in warehouse.model("dim_supplier").columns
    leftovers = warehouse.country_leftovers()
    assert leftovers["unmatched"].filter("bad_value = 'Germany'").count() > 0
    assert leftovers["unmatched"].filter("bad_value = 'United States'").count() == 0
    assert leftovers["near_duplicates"].count() == 0 and leftovers["non_printable"].count() == 0
