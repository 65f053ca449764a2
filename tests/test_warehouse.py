"""A first and a second batch of invented files, end to end."""

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from sorted_rows import as_tuples
from pyspark.sql import functions as F

from siltworks.operators.quality import validity_rule
from siltworks.plans.exploration import exploratory_profile
from siltworks.plans.warehouse import Warehouse
from siltworks.schemas import ENTITIES
from siltworks.sources.staging import read_staging_csv
from siltworks.sources.tables import ConflictError, VersionedStore

NOW = datetime(2025, 1, 1, 12, 0, tzinfo=timezone.utc)
LATER = datetime(2025, 1, 2, 12, 0, tzinfo=timezone.utc)

FIRST = {
    "categories": ["1,Tea,leaves,0x4142", "2,Tools,NULL,0x43"],
    "customers": [
        "ANNA1,Anna Ltd,Anna,Owner,1 Road,Leeds,NULL,05021,UK,1,NULL",
        "BERT2,Bert & Co,Bert,Agent,2 Road,Lima,Callao,NULL,Peru,2,22",
        "CARL3,Carl Inc,Carl,Owner,3 Road,Reno,NV,89501,USA,3,NULL",
    ],
    "employees": [
        "1,Lee,Kim,Rep,Mx.,1970-01-02 00:00:00.000,1995-02-03 00:00:00.000,a,Leeds,NULL,L1,UK,1,11,0x01,n,2,p",
        "2,Roe,Sam,Head,Mx.,1960-01-02 00:00:00.000,1990-02-03 00:00:00.000,b,Reno,NV,R1,USA,2,12,0x02,n,NULL,p",
    ],
    "employee_territories": ["1,00123", "2,00456"],
    "products": [
        "1,Green tea,7,1,box,4.00,10,0,5,0",
        "2,Hammer,7,2,each,12.50,3,0,1,1",
        "3,Black tea,7,1,box,3.50,0,5,5,0",
    ],
    "regions": ["1,North   ", "2,South"],
    "shippers": ["1,Fast,11"],
    "suppliers": ["7,Goods plc,Joe,Owner,x,Leeds,NULL,L2,UK,4,NULL,NULL"],
    "territories": ["00123,Hill  ,1", "00456,Vale,2"],
    "orders": [],
    "order_details": [],
}
SECOND = {
    "customers": [
        "ANNA1,Anna Ltd,Anna,Owner,9 Street,Leeds,NULL,05021,UK,1,NULL",
        "BERT2,Bert & Co,Bert,Agent,2 Road,Lima,Callao,NULL,Peru,2,22",
        "DORA4,Dora SA,Dora,Owner,4 Road,Rio,NULL,1,Brazil,4,NULL",
    ],
    "products": ["2,Hammer,7,2,each,13.00,3,0,1,0"],
    "orders": [
        "10,ANNA1,1,1998-01-05 00:00:00.000,NULL,NULL,1,4.50,s,a,c,NULL,1,UK",
        "11,NOONE,1,1998-01-06 00:00:00.000,NULL,NULL,1,4.50,s,a,c,NULL,1,UK",
        "12,DORA4,2,1998-05-01 00:00:00.000,NULL,NULL,1,4.50,s,a,c,NULL,1,UK",
    ],
    "order_details": ["10,1,4.00,10,0.1", "10,2,13.00,1,0", "11,1,4.00,1,0", "12,3,3.50,3,0.15"],
}


def write_files(folder, batch):
    files = {}
    for entity, lines in batch.items():
        path = folder / f"{entity}.csv"
        header = ",".join(c.title().replace("_", "") for c in ENTITIES[entity].columns)
        path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
        files[entity] = str(path)
    return files


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    text = warehouse.stage("1", write_files(tmp_path_factory.mktemp("first"), FIRST))
    typed = warehouse.typed(text)
    decisions = warehouse.load_memory(typed, warehouse.check_quality(typed, 1, NOW), NOW, NOW)
    return warehouse, text, typed, decisions


@pytest.fixture(scope="module")
def updated(loaded, tmp_path_factory):
    warehouse = loaded[0]
    typed = warehouse.typed(warehouse.stage("2", write_files(tmp_path_factory.mktemp("second"), SECOND)))
    orphans = {tuple(r)[:4]: r.orphan_rows for r in warehouse.check_relations(typed).collect() if r.orphan_rows}
    return warehouse, typed, orphans, warehouse.apply_batch(typed, 2, LATER, LATER)


def test_staging_keeps_text_as_it_is(loaded):
    text, typed = loaded[1], loaded[2]
    assert as_tuples(text["territories"], "territory_id", "territory_description") == [("00123", "Hill  "), ("00456", "Vale")]
    assert text["customers"].filter("regions = 'NULL'").count() == 1
    assert as_tuples(typed["customers"], "customer_id", "region", "fax") == [
        ("ANNA1", None, None),
        ("BERT2", "Callao", "22"),
        ("CARL3", "NV", None),
    ]
    assert as_tuples(typed["regions"], "region_description") == [("North",), ("South",)]
    assert typed["categories"].first().picture == bytearray(b"AB")


def test_empty_field_is_null_and_needs_no_rule(spark, tmp_path):
    (tmp_path / "s.csv").write_text("shipperID,companyName,phone\n1,,\n")
    assert read_staging_csv(spark, str(tmp_path / "s.csv"), "shippers").first() == ("1", None, None)


def test_issues_and_status(loaded):
    warehouse, text, _, _ = loaded
    issues = warehouse.validate({e: text[e] for e in ("customers", "employees", "suppliers")}, 1)
    assert as_tuples(issues, "table_name", "row_key", "issue_desc", "log_id") == [
        ("txt_customers", "ANNA1", "fax is longer than 50", 1),
        ("txt_customers", "ANNA1", "regions is longer than 50", 1),
        ("txt_customers", "BERT2", "postal_code is longer than 20", 1),
        ("txt_customers", "CARL3", "fax is longer than 50", 1),
        ("txt_employees", "1", "region is longer than 50", 1),
        ("txt_employees", "2", "reports_to is not an integer", 1),
        ("txt_suppliers", "7", "fax is longer than 50", 1),
        ("txt_suppliers", "7", "region is longer than 50", 1),
    ]
    status = {r.table_name: (r.rows_checked, r.errors, r.status) for r in warehouse.validation_status(text).collect()}
    assert status["txt_customers"] == (3, 4, "WARNING") and status["txt_orders"] == (0, 0, "OK")


def test_keys_gate_and_profile(loaded):
    warehouse, text, _, decisions = loaded
    assert {(r.blank_rows, r.duplicate_keys) for r in warehouse.check_keys(text).collect()} == {(0, 0)}
    assert warehouse.malformed_keys(text).count() == 0
    assert set(decisions) == set(FIRST) and all(decisions.values())
    reports = exploratory_profile(text)
    assert [tuple(r) for r in reports["products_per_category"].collect()] == [("Tea", 2), ("Tools", 1)]
    assert as_tuples(reports["least_stock"], "product_name") == [("Green tea",), ("Hammer",)]


def test_gate_blocks_headers_with_their_lines(spark, loaded, tmp_path):
    _, text, typed, _ = loaded
    warehouse = Warehouse(spark, str(tmp_path))
    bad = {
        "orders": spark.createDataFrame([(1, None)], "order_id int, order_date date"),
        "order_details": spark.createDataFrame([(1, 1, 2)], "order_id int, product_id int, unit_price int"),
        "shippers": typed["shippers"],
    }
    results = warehouse.check_quality(bad, 1, NOW)
    assert warehouse.load_memory(bad, results, NOW) == {"orders": False, "order_details": False, "shippers": True}
    assert warehouse.memory("orders") is None and warehouse.memory("shippers").count() == 1


def test_second_batch(updated):
    warehouse, _, orphans, published = updated
    assert published
    # The parents are the batch together with memory, so only the unknown customer is missing.
    assert orphans == {("customers", "customer_id", "orders", "customer_id"): 1}
    customers = warehouse.memory("customers")
    assert as_tuples(customers, "customer_id", "address", "active") == [
        ("ANNA1", "1 Road", False),
        ("ANNA1", "9 Street", True),
        ("BERT2", "2 Road", True),
        ("CARL3", "3 Road", True),
        ("DORA4", "4 Road", True),
    ]
    assert as_tuples(warehouse.memory("products").filter("product_id = 2"), "unit_price", "active") == [
        (Decimal("12.50"), False),
        (Decimal("13.00"), True),
    ]


def test_fact_and_product(updated):
    warehouse = updated[0]
    assert as_tuples(warehouse.model("fact_table"), "fact_key", "total_amount", "year") == [
        ("10-1", Decimal("36.00"), 1998),
        ("10-2", Decimal("13.00"), 1998),
        # 3.50 * 3 * 0.85 = 8.925
        ("12-3", Decimal("8.93"), 1998),
    ]
    view = warehouse.sales_by_employee()
    columns = ["full_name", "quarter", "total_revenue", "total_orders", "average_order_value", "total_units_sold"]
    assert as_tuples(view, *columns) == [
        ("Kim Lee", "Q1", Decimal("49.00"), 2, Decimal("24.50"), 11),
        ("Sam Roe", "Q2", Decimal("8.93"), 1, Decimal("8.93"), 3),
    ]
    assert as_tuples(warehouse.model("dim_product"), "product_id", "discontinued") == [(1, False), (2, False), (3, False)]


def test_same_batch_again_and_closed_versions_in_place(updated):
    warehouse, typed, _, _ = updated
    before = as_tuples(warehouse.memory("customers"), "customer_id", "address", "active", "load_date")
    assert warehouse.apply_batch(typed, 3, LATER, LATER)
    assert as_tuples(warehouse.memory("customers"), "customer_id", "address", "active", "load_date") == before
    folders = warehouse.store.published()["dwm_customers"].folders
    # The base, and what the second batch has changed; the same batch again changes nothing, so it adds nothing.
    assert len(folders) == 2
    added = warehouse.spark.read.parquet(f"{warehouse.store.root}/{folders[1]}")
    assert as_tuples(added, "customer_id", "_batch") == [("ANNA1", 1), ("DORA4", 1)]


def test_rejected_and_repeated_batches_publish_nothing(updated):
    warehouse, typed, _, _ = updated
    before = warehouse.store.published()
    strict = validity_rule("NO_SALES_ALLOWED", "fact_table", "quantity", "quantity > 0")
    assert not warehouse.apply_batch({"products": typed["products"]}, 4, LATER, LATER, [strict])
    with pytest.raises(ValueError, match="repeated key"):
        warehouse.apply_batch({"products": typed["products"].union(typed["products"])}, 5, LATER)
    assert warehouse.store.published() == before


def test_countries(updated, spark):
    """A country table in memory: recoded names, corrected capitals, keys in the dimensions."""
    warehouse = updated[0]
    columns = ENTITIES["countries"].columns
    lands = [("United Kingdom", "GB", "London"), (" united states", "US", "Washington"), ("Brazil", "BR", "Brasília")]
    rows = [{c: "" for c in columns} | {"country_name": n, "abbreviation": a, "capital_city": c} for n, a, c in lands]
    typed = warehouse.typed({"countries": spark.createDataFrame(rows, ENTITIES["countries"].text_schema)})
    assert warehouse.apply_batch(typed, 9, LATER, LATER)
    assert as_tuples(warehouse.country_leftovers()["non_printable"], "country_name") == [("Brazil",)]
    warehouse.standardise_countries()
    warehouse.rebuild(LATER)
    placed = warehouse.model("dim_customer").join(warehouse.model("dim_country"), "country_key", "left")
    assert as_tuples(placed, "customer_id", "country", "capital_city") == [
        ("ANNA1", "United Kingdom", "London"),
        ("BERT2", "Peru", None),
        ("CARL3", "United States", "Washington"),
        ("DORA4", "Brazil", "Brasilia"),
    ]
    leftovers = warehouse.country_leftovers()
    # Suppliers are not recoded, so their "UK" stays unknown.
    assert as_tuples(leftovers["unmatched"], "source_table", "record_id", "bad_value") == [
        ("dwm_customers", "BERT2", "Peru"),
        ("dwm_suppliers", "7", "UK"),
    ]
    assert leftovers["near_duplicates"].count() == 0 and leftovers["non_printable"].count() == 0


@pytest.fixture
def small(spark, tmp_path):
    """A warehouse of its own with the first batch, and a function that applies further lines."""
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    first = warehouse.typed(warehouse.stage("1", write_files(tmp_path, FIRST)))
    warehouse.load_memory(first, warehouse.check_quality(first, 1, NOW), NOW, NOW)

    def apply(batch, run_id=2):
        folder = tmp_path / f"run{run_id}"
        folder.mkdir()
        return warehouse.apply_batch(warehouse.typed(warehouse.stage(str(run_id), write_files(folder, batch))), run_id, LATER, LATER)

    return warehouse, apply


def test_countries_of_one_name_multiply_nothing(small, spark):
    warehouse, apply = small
    assert apply(SECOND)
    revenue = as_tuples(warehouse.model("fact_table"), "fact_key", "total_amount")
    columns = ENTITIES["countries"].columns
    rows = [{c: "" for c in columns} | {"country_name": n} for n in ("UK", " uk", "Peru")]
    typed = warehouse.typed({"countries": spark.createDataFrame(rows, ENTITIES["countries"].text_schema)})
    assert warehouse.apply_batch(typed, 3, LATER, LATER)
    assert warehouse.model("dim_customer").count() == 4
    assert as_tuples(warehouse.model("fact_table"), "fact_key", "total_amount") == revenue
    assert as_tuples(warehouse.country_leftovers()["near_duplicates"], "spelling") == [(" uk",), ("UK",)]
    assert {r.orphan_rows for r in warehouse.check_model().collect()} == {0}


def test_a_blocked_table_is_empty(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    typed = warehouse.typed(warehouse.stage("1", write_files(tmp_path, FIRST)))
    results = warehouse.check_quality(typed, 1, NOW)
    blocked = results.withColumn("verdict", F.when(F.col("target_table") == "tmp_categories", "Rechazado").otherwise(F.col("verdict")))
    assert not warehouse.load_memory(typed, blocked, NOW, NOW)["categories"]
    assert warehouse.apply_batch({"products": typed["products"]}, 2, LATER, LATER)
    assert warehouse.model("dim_category").count() == 0
    assert warehouse.model("dim_product").filter("category_key IS NULL").count() == 3


def test_the_calendar_stays(small):
    warehouse, apply = small
    early = {**SECOND, "orders": [*SECOND["orders"], "9,ANNA1,1,1995-01-05 00:00:00.000,NULL,NULL,1,4.50,s,a,c,NULL,1,UK"]}
    early["order_details"] = [*SECOND["order_details"], "9,1,4.00,1,0"]
    result = apply(early)
    assert result.dropped.first().unknown_date == 1
    warehouse.rebuild(LATER, "1990-01-01", 20_000)
    assert warehouse.model("fact_table").count() == 4
    assert apply({"products": ["1,Green tea,7,1,box,4.10,10,0,5,0"]}, 3)
    assert warehouse.model("fact_table").count() == 4


def test_every_entity_of_a_batch_is_taken_and_counted(small, spark):
    warehouse, apply = small
    result = apply({"employees": ["3,Doe,Jan,Rep,Mx.,1980-01-02 00:00:00.000,1999-02-03 00:00:00.000,a,Leeds,NULL,L1,UK,1,11,0x01,n,2,p"], "products": SECOND["products"]})
    assert result and as_tuples(warehouse.model("dim_employee"), "employee_id") == [(1,), (2,), (3,)]
    assert as_tuples(result.changes, "entity", "status", "row_count") == [("employees", "inserted", 1), ("products", "updated", 1)]
    assert spark.table("enr_dim_employees").count() == 3


def test_changes_of_the_fact_are_stored_slim(small, spark, tmp_path):
    """Beside the row to append, a change holds only what the sums lose by the row that it replaces."""
    warehouse, apply = small
    assert apply(SECOND) and apply({"order_details": ["10,1,4.00,12,0.1"]}, 3)
    store = warehouse.store.root
    changes = spark.read.parquet(f"{store}/fact_changes/*")
    assert changes.columns == ["row", "_gone", "was"]
    assert changes.select("was.*").columns == ["date_key", "employee_key", "quantity", "total_amount"]
    assert all(f.endswith(".zstd.parquet") for f in changes.inputFiles())


def test_a_batch_adds_a_folder_and_compaction_makes_one(small):
    warehouse, apply = small
    assert apply(SECOND)
    first = warehouse.store.published()
    for n, price in enumerate(("13.50", "14.50")):
        assert apply({"products": [f"2,Hammer,7,2,each,{price},3,0,1,0"]}, 10 + n)
    now = warehouse.store.published()
    assert now["dwm_products"].folders[:2] == first["dwm_products"].folders and len(now["dwm_products"].folders) == 4
    # A price is no attribute of the model, so nothing of it is written.
    assert {t for t in now if now[t] != first.get(t)} == {"dwm_products"}
    before = {t: as_tuples(warehouse._read(t, v), *warehouse._read(t, v).columns) for t, v in now.items()}
    versions = as_tuples(warehouse.memory("products"), "product_id", "unit_price", "active")
    assert len([v for v in versions if v[0] == 2]) == 4 and sum(v[2] for v in versions) == 3
    assert warehouse.compact(2) == ["dwm_customers", "dwm_order_details", "dwm_orders", "dwm_products"]
    after = warehouse.store.published()
    assert all(len(v.folders) == 1 for v in after.values())
    assert {t: as_tuples(warehouse._read(t, v), *warehouse._read(t, v).columns) for t, v in after.items()} == before
    assert as_tuples(warehouse.memory("products"), "product_id", "unit_price", "active") == versions
    assert apply({"products": ["2,Hammer,7,2,each,15.00,3,0,1,0"]}, 20)
    assert as_tuples(warehouse.memory_tables()["products"].filter("product_id = 2"), "unit_price") == [(Decimal("15.00"),)]


def model_as_seen(warehouse):
    """The model under business ids, whatever its surrogate keys."""
    fact = warehouse.model("fact_table").drop("year", "load_date")
    for dim, key in (("product", "product_id"), ("customer", "customer_id"), ("employee", "employee_id")):
        fact = fact.join(warehouse.model(f"dim_{dim}").select(f"{dim}_key", key), f"{dim}_key").drop(f"{dim}_key")
    products = warehouse.model("dim_product").drop("load_date", "product_key")
    for dim in ("category", "supplier"):
        products = products.join(warehouse.model(f"dim_{dim}").select(f"{dim}_key", f"{dim}_id"), f"{dim}_key", "left").drop(f"{dim}_key")
    seen = {"fact": fact, "product": products, "sales": warehouse.sales_by_employee().drop("employee_key")}
    for dim in ("category", "supplier", "customer", "employee"):
        seen[dim] = warehouse.model(f"dim_{dim}").drop("load_date", f"{dim}_key")
    return {name: as_tuples(df, *sorted(df.columns)) for name, df in seen.items()}


def order_line(order, customer, employee, day):
    return f"{order},{customer},{employee},{day} 00:00:00.000,NULL,NULL,1,4.50,s,a,c,NULL,1,UK"


def test_a_maintained_model_equals_a_rebuilt_one(small):
    """Batches that create, change and lose rows of every kind: the model is what a rebuild makes."""
    warehouse, apply = small
    person = "{},{},{},Rep,Mx.,1980-01-02 00:00:00.000,1999-02-03 00:00:00.000,a,Leeds,NULL,L1,UK,1,11,0x01,n,2,p"
    assert apply(SECOND)
    batches = [
        # A customer that an order waited for; products of an unknown category and supplier; orders that change their day, seller
        # and customer, one of them to a customer that nobody knows, one to a seller that nobody knows.
        {
            "customers": ["NOONE,Noone,Nil,Owner,1 Road,Leeds,NULL,1,UK,1,NULL"],
            "products": ["4,Saw,8,3,each,9.00,1,0,1,0", "5,Axe,8,3,each,8.00,1,0,1,0"],
            "orders": [order_line(10, "BERT2", 2, "1999-07-01"), order_line(12, "LOST9", 2, "1998-05-01"), order_line(13, "CARL3", 9, "1998-08-01")],
            "order_details": ["13,5,8.00,1,0"],
        },
        # The category, supplier and seller that others waited for, another name for a seller, a new and a changed line.
        {
            "categories": ["3,Blades,x,0x44"],
            "suppliers": ["8,Steel plc,Joe,Owner,x,Leeds,NULL,L2,UK,4,NULL,NULL"],
            "employees": [person.format(9, "Ash", "Ida"), person.format(1, "Lee", "Kimberley")],
            "order_details": ["10,4,9.00,2,0", "10,1,4.00,12,0.1"],
        },
        # An order comes back, one lies outside the calendar, one loses its customer; a product changes its category.
        {
            "orders": [order_line(12, "DORA4", 1, "1998-05-02"), order_line(14, "ANNA1", 1, "1990-01-01"), order_line(11, "GONE0", 1, "1998-01-06")],
            "order_details": ["14,1,4.00,1,0", "12,3,3.50,4,0.15"],
            "products": ["1,Best tea,7,3,box,4.00,10,0,5,1"],
        },
    ]
    for n, batch in enumerate(batches):
        before = warehouse.store.published()["dim_time"]
        assert apply(batch, 10 + n)
        assert warehouse.store.published()["dim_time"] == before  # not rebuilt
    maintained = model_as_seen(warehouse)
    assert [r[2] for r in maintained["fact"]] and len(warehouse.store.published()["fact_table"].folders) > 3
    assert {r[0] for r in as_tuples(warehouse.model("dim_customer"), "customer_key")} == set(range(1, 6))
    warehouse.rebuild(LATER)
    assert model_as_seen(warehouse) == maintained
    assert warehouse.store.published()["fact_table"].folders[1:] == ()


def test_fact_rows_written_are_those_that_change(small):
    warehouse, apply = small
    assert apply(SECOND)
    assert apply({"orders": [order_line(12, "NOBODY", 2, "1998-05-01")], "order_details": ["10,1,4.00,11,0.1", "10,2,13.00,1,0"]}, 3)
    folders = warehouse.store.published()["fact_table"].folders
    rows = warehouse.spark.read.parquet(f"{warehouse.store.root}/{folders[1]}")
    assert as_tuples(rows, "fact_key", "_gone") == [("10-1", False), ("12-3", True)]
    sums = warehouse.store.published()["sales_sums"].folders
    changes = warehouse.spark.read.parquet(f"{warehouse.store.root}/{sums[1]}")
    assert as_tuples(changes, "quarter", "revenue", "lines", "units") == [
        ("Q1", Decimal("3.60"), 0, 1),
        ("Q2", Decimal("-8.93"), -1, -3),
    ]
    assert len(as_tuples(warehouse.sales_by_employee(), "full_name")) == 1


def test_malformed_lines_are_kept_apart_and_counted(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    lines = ['1,"North\n""far"", cold"', "2,South,surplus", "3", "4,East", '5,"a,b"', ""]
    text = warehouse.stage("1", write_files(tmp_path, {"regions": lines, "shippers": ["1,Fast,11"]}))
    assert as_tuples(text["regions"], "region_id", "region_description") == [("1", 'North\n"far", cold'), ("4", "East"), ("5", "a,b")]
    assert as_tuples(warehouse.rejected_lines("1"), "table_name", "line") == [("txt_regions", "2,South,surplus"), ("txt_regions", "3")]
    assert as_tuples(warehouse.staged_counts(), "table_name", "row_count", "rejected_lines") == [("txt_regions", 3, 2), ("txt_shippers", 1, 0)]
    # A row per line, where it is known to hold: the same fields, and pieces of a broken line don't fit.
    plain = read_staging_csv(spark, str(tmp_path / "regions.csv"), "regions", multi_line=False)
    assert ("4", "East") in as_tuples(plain, "region_id", "region_description")


def test_status_from_the_counts_of_the_write(loaded, spark, tmp_path):
    warehouse, text, _, _ = loaded
    counted = as_tuples(warehouse.validation_status(text), "table_name", "rows_checked", "errors", "status")
    again = {e: df.select("*") for e, df in text.items()}  # frames of which nothing is known: scanned
    assert as_tuples(warehouse.validation_status(again), "table_name", "rows_checked", "errors", "status") == counted
    for rows in warehouse._counts.values():
        assert set(rows[1]) >= {"rows", "rejected"}
    broken = Warehouse(spark, str(tmp_path / "x"))
    with pytest.raises(Exception):
        broken.stage("1", {"regions": str(tmp_path / "missing.csv")})
    assert broken._counts == {}


def test_a_stored_threshold_decides(small, spark):
    warehouse, apply = small
    typed = {"order_details": spark.createDataFrame([(1, 1, -1), (1, 2, 5)], "order_id int, product_id int, unit_price int")}
    verdict = lambda run: {r.rule_name: r.verdict for r in warehouse.check_quality(typed, run, NOW).collect()}
    first = verdict(5)
    assert len(first) == 13 and first["DETALLE_PRECIO_VALIDEZ"] == "Rechazado" and first["REGION_ID_COMPLETITUD"] == "Aprobado"
    looser = warehouse.rules().filter("rule_name = 'DETALLE_PRECIO_VALIDEZ'")
    warehouse.upsert_rules(looser.withColumn("threshold_pct", F.lit(60).cast("decimal(5,2)")))
    assert verdict(6)["DETALLE_PRECIO_VALIDEZ"] == "Aprobado"


def test_of_two_writers_one_is_refused(spark, tmp_path):
    first, second = VersionedStore(spark, str(tmp_path)), VersionedStore(spark, str(tmp_path))
    first.publish({"t": first.write("t", spark.range(1))})
    seen = second.published()
    first.publish({"t": first.write("t", spark.range(2))}, first.published())
    with pytest.raises(ConflictError):
        second.publish({"t": second.write("t", spark.range(3))}, seen)
    assert second.current("t").count() == 2
