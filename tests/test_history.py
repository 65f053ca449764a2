"""Versioned history against a plain re-implementation, and its invariants."""

from datetime import datetime, timezone

from sorted_rows import as_tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltworks.operators import history as h

SCHEMA = "k1 int, k2 string, a int, b string, load_date timestamp, active boolean"
OLD = datetime(2020, 1, 1, tzinfo=timezone.utc)
NEW = datetime(2021, 1, 1, tzinfo=timezone.utc)
KEYS, ATTRIBUTES = ["k1", "k2"], ["a", "b"]


def frame(spark, rows):
    return spark.createDataFrame([(k1, k2, a, b, OLD, active) for k1, k2, a, b, active in rows], SCHEMA)


def expected(history, batch):
    named = {(k1, k2): (a, b) for k1, k2, a, b in batch}
    current = {(k1, k2): (a, b) for k1, k2, a, b, active in history if active}
    out = []
    for k1, k2, a, b, active in history:
        keeps = active and ((k1, k2) not in named or named[(k1, k2)] == (a, b))
        out.append((k1, k2, a, b, bool(keeps), False))
    for key, values in named.items():
        if current.get(key) != values or key not in current:
            out.append((*key, *values, True, True))
    return out


def applied(spark, history, batch):
    result = h.apply_changes(
        frame(spark, history), spark.createDataFrame(batch, "k1 int, k2 string, a int, b string"), KEYS, ATTRIBUTES, NEW
    )
    assert result.schema.simpleString() == frame(spark, history).schema.simpleString()
    return result.withColumn("fresh", F.year("load_date") == 2021)


def key(t):
    return tuple((v is None, str(v)) for v in t)


HISTORY = [
    (1, "x", 10, "same", True),
    (2, "x", 20, None, True),
    (2, "x", 19, "older", False),
    (3, "x", None, "c", True),
    (4, "x", 40, "only closed", False),
    (5, "x", 50, "gone null flag", None),
    (6, "y", 60, "untouched", True),
]
BATCH = [(1, "x", 10, "same"), (2, "x", 20, "now set"), (3, "x", None, "c"), (4, "x", 40, "only closed"), (5, "x", 50, "z"), (7, "x", None, None)]


def test_apply_changes(spark):
    got = as_tuples(applied(spark, HISTORY, BATCH), "k1", "k2", "a", "b", "active", "fresh")
    want = [(*r[:4], None if r[:2] == (5, "x") and not r[5] else r[4], r[5]) for r in expected(HISTORY, BATCH)]
    assert got == sorted(want, key=key)


def test_twice_is_once_and_one_active_row_per_key(spark):
    batch = spark.createDataFrame(BATCH, "k1 int, k2 string, a int, b string")
    once = h.apply_changes(frame(spark, HISTORY), batch, KEYS, ATTRIBUTES, NEW)
    twice = h.apply_changes(once, batch, KEYS, ATTRIBUTES, NEW)
    assert as_tuples(once, *once.columns) == as_tuples(twice, *once.columns)
    assert h.current_rows(once).groupBy(*KEYS).count().filter("count <> 1").count() == 0


def test_reports(spark):
    history, batch = frame(spark, HISTORY), spark.createDataFrame(BATCH, "k1 int, k2 string, a int, b string")
    assert as_tuples(h.changed(history, batch, KEYS, ATTRIBUTES), "k1", "b") == [(2, None)]
    assert as_tuples(h.new_rows(history, batch, KEYS), "k1") == [(4,), (5,), (7,)]
    counts = {r.status: r.row_count for r in h.change_counts(history, batch, KEYS, ATTRIBUTES).collect()}
    assert counts == {"inserted": 3, "updated": 1, "unchanged": 2}
    after = h.apply_changes(history, batch, KEYS, ATTRIBUTES, NEW)
    assert h.new_rows(after, batch, KEYS).count() == 0


def test_append_if_absent_closes_nothing(spark):
    history, batch = frame(spark, HISTORY), spark.createDataFrame(BATCH, "k1 int, k2 string, a int, b string")
    after = h.append_if_absent(history, batch, KEYS, ATTRIBUTES, NEW)
    assert after.count() == len(HISTORY) + 4
    assert as_tuples(after.filter("k1 = 2 AND active"), "b") == [("now set",), (None,)]
    assert h.append_if_absent(after, batch, KEYS, ATTRIBUTES, NEW).count() == after.count()


def test_a_batch_without_rows_changes_nothing(spark):
    batch = spark.createDataFrame([], "k1 int, k2 string, a int, b string")
    after = h.apply_changes(frame(spark, HISTORY), batch, KEYS, ATTRIBUTES, NEW)
    assert as_tuples(after, "k1", "a", "active") == as_tuples(frame(spark, HISTORY), "k1", "a", "active")


values = st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.sampled_from(["p", "q"])))
keys = st.tuples(st.integers(0, 4), st.sampled_from(["x", "y"]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    current=st.dictionaries(keys, values, max_size=8),
    closed=st.lists(st.tuples(keys, values), max_size=4),
    batch=st.dictionaries(keys, values, max_size=8),
)
def test_random_batches(spark, current, closed, batch):
    history = [(*k, *v, True) for k, v in current.items()] + [(*k, *v, False) for k, v in closed]
    rows = [(*k, *v) for k, v in batch.items()]
    got = as_tuples(applied(spark, history, rows), "k1", "k2", "a", "b", "active", "fresh")
    assert got == sorted(expected(history, rows), key=key)
