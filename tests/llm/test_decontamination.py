"""Benchmark windows in documents against plain Python."""

import hashlib
import re
from collections import Counter

import pytest

from siltworks.llm import decontamination
from siltworks.llm.queries import op13_decontamination

UPPER = {i: i + 32 for i in range(0x41, 0x5B)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def wanted(texts, items, n=10):
    held = {}
    for item, text in items:
        w = words(text)
        for s in range(max(len(w) - n, 0) + 1 if w else 0):
            held.setdefault(tuple(w[s : s + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in held}:
            for s in range(len(w) - size + 1):
                if tuple(w[s : s + size]) in held:
                    hit |= set(range(s, s + size))
                    found |= held[tuple(w[s : s + size])]
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), hit))
    return out


def tables(spark, folder):
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    return docs, items, [(r["item_id"], r["text"]) for r in items.collect()]


def test_query_equals_plain_search(spark, messy, texts):
    _, _, items = tables(spark, messy)
    want = [r[:6] for r in wanted(texts, items)]
    assert {r[5] for r in want} == {True, False} and max(r[3] for r in want) > 2
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in op13_decontamination(spark, messy).collect())


@pytest.mark.parametrize("most_rows, most_chars", [(3, 10**9), (10**9, 50)])
def test_beyond_the_broadcast_bounds_results_are_the_same(spark, messy, texts, most_rows, most_chars):
    docs, items, listed = tables(spark, messy)
    found = decontamination.contaminated(docs, items, most_rows=most_rows, most_chars=most_chars)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in found.collect()]
    assert Counter(got) == Counter(r[:4] for r in wanted(texts, listed))


@pytest.mark.parametrize("n", [1, 3])
def test_other_window_lengths(spark, messy, texts, n):
    docs, items, listed = tables(spark, messy)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"])) for r in decontamination.contaminated(docs, items, n).collect()]
    assert Counter(got) == Counter(r[:4] for r in wanted(texts, listed, n))


def test_no_items(spark, messy, texts):
    docs, items, _ = tables(spark, messy)
    rows = decontamination.query(docs, items.filter("item_id = 23")).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == len(texts) and {(r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows} == {(0, 0, empty, False)}


def test_spans_are_cut_out_and_documents_dropped(spark, messy, texts):
    docs, items, listed = tables(spark, messy)
    hits = [r[6] for r in wanted(texts, listed)]

    def cut(text, hit):
        if not hit:
            return text
        tokens = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text)
        lead = re.match(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", text).group()
        return lead + "".join(t for k, t in enumerate(tokens) if k not in hit)

    spans = decontamination.clean(docs, items)
    assert spans.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in spans.collect()) == Counter((i, cut(t, h)) for (i, t), h in zip(texts, hits))
    whole = decontamination.clean(docs, items, remove="documents")
    assert Counter((r["doc_id"], r["text"]) for r in whole.collect()) == Counter((i, t) for (i, t), h in zip(texts, hits) if not h)
    with pytest.raises(ValueError):
        decontamination.clean(docs, items, remove="words")


def test_the_scan_is_one_compiled_loop(spark, messy):
    """Explosion, look-up in the broadcast table and verification share a stage, so that places without a hit cost no row."""
    docs, items, _ = tables(spark, messy)
    found, _ = decontamination.windows(items)
    places = decontamination._places(docs.select("doc_id", "text"), [10])
    listed = found.select("window", "digest", "tokens").withColumnRenamed("digest", "window_digest")
    import pyspark.sql.functions as F

    plan = places.join(F.broadcast(listed), F.col("digest") == F.col("window_digest"), "left")._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Python" not in text
