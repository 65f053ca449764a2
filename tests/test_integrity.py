"""Keys, relations, names: small tables and brute force."""

import random

import pytest
from sorted_rows import as_tuples
from pyspark.sql import functions as F

from siltworks.functions import normalised_name
from siltworks.operators import catalog, integrity


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")], "id int, fk string")


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([("a",), ("b",), ("b",)], "k string")


def test_blank_and_malformed_keys(spark):
    df = spark.createDataFrame([("1", "x"), (None, "x"), ("  ", "x"), ("2a", ""), ("123456", "y")], "a string, b string")
    assert integrity.pk_blank_count(df, ["a", "b"], "t").first()[1:] == (5, 3)
    found = integrity.pk_malformed(df, {"a": ~F.col("a").rlike(r"^[0-9]+\z") | (F.length("a") > 5)})
    assert as_tuples(found, "a", "a_length") == [("  ", 2), ("123456", 6), ("2a", 2)]


def test_duplicates_group_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (2, "x")], "a int, b string")
    assert as_tuples(integrity.pk_duplicates(df, ["a", "b"]), "a", "b", "occurrences") == [(1, None, 2)]
    with pytest.raises(ValueError, match="repeated key"):
        integrity.require_unique(df, ["a", "b"], "t")
    integrity.require_unique(df.filter("b = 'x'"), ["a", "b"], "t")
    with pytest.raises(ValueError, match="null in key"):
        integrity.require_unique(spark.createDataFrame([(1, None), (2, 3)], "a int, b int"), ["a", "b"], "t")


def test_orphans(child, parent):
    for repeated in (False, True):
        assert as_tuples(integrity.fk_orphans(child, "fk", parent, "k", repeated_parent=repeated), "id") == [(4,)]
    assert integrity.fk_orphan_count(child, "fk", parent, "k").first() == (5, 1)


def test_orphans_of_an_empty_parent_and_child(child, parent):
    assert integrity.fk_orphans(child, "fk", parent.limit(0), "k").count() == 4
    assert integrity.fk_orphan_count(child.limit(0), "fk", parent, "k").first() == (0, 0)


def test_self_reference(spark):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "employee_id int, reports_to int")
    assert as_tuples(integrity.fk_orphans(staff, "reports_to", staff, "employee_id"), "employee_id") == [(3,)]


def test_normalised_reference_skips_empty_text(spark):
    people = spark.createDataFrame([(1, " UK "), (2, "uk"), (3, ""), (4, None), (5, "Mars")], "id int, country string")
    lands = spark.createDataFrame([("Uk",), ("France ",)], "name string")
    assert as_tuples(integrity.fk_orphans(people, "country", lands, "name", normalised_name), "id") == [(5,)]
    report = integrity.unmatched_values_report({"people": (people, "id", "country")}, lands, "name")
    assert [tuple(r) for r in report.collect()] == [("people", "5", "Mars")]


def test_relationship_catalog(spark, child, parent):
    relations = [("parent", "k", "child", "fk"), ("child", "id", "child", "id")]
    checked = integrity.relationship_check(relations, {"child": child, "parent": parent})
    assert as_tuples(checked, "parent_entity", "child_column", "child_rows", "orphan_rows") == [
        ("child", "id", 5, 0),
        ("parent", "fk", 5, 1),
    ]
    assert catalog.relations_frame(spark).count() == 24


def test_near_duplicates_against_brute_force(spark):
    """One name holds thousands of the rows; every member has a row of its own."""
    rng = random.Random(7)
    names = ["Hot"] * 3000 + [rng.choice(["a", "b", "c", "d"]) + str(rng.randrange(40)) for _ in range(190)] + [None] * 10
    rows = [(i, None if n is None else rng.choice([n, n.upper(), f" {n}", f"{n} "])) for i, n in enumerate(names)]
    expected = {}
    for i, spelling in rows:
        expected.setdefault(None if spelling is None else spelling.strip(" ").lower(), []).append((i, spelling))
    df = spark.createDataFrame(rows, "id int, name string").repartition(5)
    assert as_tuples(integrity.near_duplicate_names(df, "name", "id"), "id", "spelling", "name_key", "occurrences") == sorted(
        ((i, s, k, len(members)) for k, members in expected.items() if len(members) > 1 for i, s in members),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def test_non_printable(spark):
    df = spark.createDataFrame(
        [(1, "plain"), (2, "café"), (3, ""), (4, None), (5, "tab\t"), (6, "line\n"), (7, "~ ok")], "id int, t string"
    )
    assert as_tuples(integrity.non_printable_ascii(df, "t"), "id") == [(2,), (3,), (5,), (6,)]


def test_insert_if_absent_and_update(spark):
    table = spark.createDataFrame([("e", "c1", "kept")], "entity string, col string, note string")
    rows = spark.createDataFrame([("new", "c2", "e"), ("other", "c1", "e")], "note string, col string, entity string")
    result = catalog.insert_if_absent(table, rows, ["entity", "col"])
    assert as_tuples(result, "entity", "col", "note") == [("e", "c1", "kept"), ("e", "c2", "new")]
    assert as_tuples(catalog.insert_if_absent(result, rows, ["entity", "col"]), "col") == [("c1",), ("c2",)]
    updated, listed = catalog.update_and_list(result, F.col("col") == "c2", "note", "seen", F.col("note") == "seen")
    assert updated.count() == 2 and as_tuples(listed, "col") == [("c2",)]


def test_all_links_of_a_child_from_one_scan(spark, tmp_path):
    rows = [(1, "a", 1.0), (1, "A ", None), (2, None, 3.0), (None, "", 9.0), (7, "zz", 9.0)]
    spark.createDataFrame(rows, "x int, t string, d double").write.parquet(str(tmp_path / "c"))
    child = spark.read.parquet(str(tmp_path / "c"))
    numbers = spark.createDataFrame([(1,), (2,), (2,)], "k bigint")
    names = spark.createDataFrame([("A",), ("b",)], "name string")
    empty = spark.createDataFrame([], "k int")
    links = [
        integrity.Link(child, "x", numbers, "k"),
        integrity.Link(child, "t", names, "name", integrity.normalised_name),
        integrity.Link(child, "d", numbers, "k"),
        integrity.Link(child, "x", empty, "k"),
        integrity.Link(empty, "k", numbers, "k"),
    ]
    found = integrity.orphan_counts(links)
    assert as_tuples(found, "number", "child_rows", "orphan_rows") == [(0, 5, 1), (1, 5, 1), (2, 5, 3), (3, 5, 4), (4, 0, 0)]
    for link, row in zip(links, sorted(found.collect())):
        one = integrity.fk_orphan_count(link.child, link.column, link.parent, link.key, link.normalise).first()
        assert (one.child_rows, one.orphan_rows) == (row.child_rows, row.orphan_rows)
    plan = integrity.orphan_counts(links)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
