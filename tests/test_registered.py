"""Every registered query against its SQL on the smallest test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import compare, connect  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from siltworks.plans.registry import all_queries, all_sql  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_equals_its_sql(spark, connection, name):
    problems, _, _ = compare(spark, connection, FOLDER, name)
    assert not problems


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 270


def test_other_queries_stay_when_a_library_is_missing(monkeypatch):
    """Without a library that only the subpackage for training data needs, that subpackage alone is left out."""
    for name in [m for m in sys.modules if m.startswith("siltworks.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    assert set(driver.queries()) == set(all_queries()) and set(driver.oracle_sql()) == set(all_sql())
