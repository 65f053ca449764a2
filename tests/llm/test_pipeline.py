"""The pipeline stage by stage against brute force over a small table."""

import random
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from siltworks.llm.common import stored

from test_dedup import covered, plain_counts
from test_simhash import groups, near_pairs, plain_fingerprint


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    plain = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, folder), "test-stage")
        after[name] = docs
        if name != names[-1]:
            assert docs.columns == columns

    def kept(name):
        return {r["doc_id"]: r["text"] for r in after[name].collect()}

    counts = {i: plain_counts(t) for i, t in plain.items()}
    plain = {i: t for i, t in plain.items() if not (counts[i][0] < 50 or counts[i][4] * 2 > counts[i][0])}
    found = kept(names[0])
    assert found.items() <= plain.items() and len(found) > 0.95 * len(plain)
    first = {}
    for i, t in sorted(found.items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    plain = {i: found[i] for i in first.values()}
    assert kept(names[1]) == plain
    ids = sorted(plain)
    labels = groups(len(ids), near_pairs([plain_fingerprint(plain[i]) for i in ids]))
    plain = {ids[k]: plain[ids[k]] for k in set(labels)}
    assert kept(names[2]) == plain
    rest = {i: left.decode(errors="ignore") for (i, _), (_, _, left) in zip(plain.items(), covered(list(plain.items())))}
    plain = {i: t for i, t in rest.items() if t == plain[i] or re.search(r"[^\x20\x09-\x0D]", t)}
    assert kept(names[3]) == plain
    assert {r["doc_id"]: r["n_chars"] for r in after[names[3]].collect()} == {i: len(t) for i, t in plain.items()}
    assert {r["doc_id"] for r in after[names[4]].collect()} == set(plain)


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(rows.columns)
    assert rows.count() > 0


def long_text(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(300))


def test_repeated_rows_come_out_once(spark):
    """Rows read in twice, copies without an id, texts that share an id, and near texts under one id."""
    a, b, c, d, e, f = map(long_text, range(6))
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "y"), (2, a, "x"), (None, b, "x"), (None, b, "x"), (None, b.replace(" ", "\n", 2), "x")]
    rows += [(3, c, "x"), (3, c.replace(" ", "  ", 1), "x"), (4, d, "x"), (4, e, "x"), (5, f, "x"), (5, f + " end", "x"), (6, f + " ends", "x")]
    docs = spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), "test-stage")
        found = docs.collect()
        if name == "exact dedup":
            assert Counter(r["doc_id"] for r in found) == {1: 1, None: 1, 3: 1, 4: 2, 5: 2, 6: 1}
            assert {r["source"] for r in found if r["doc_id"] == 1} == {"x"}
    assert Counter(r["doc_id"] for r in found) == {1: 1, None: 1, 3: 1, 4: 2, 5: 1}
    words = {t.split()[0]: t.split() for t in (a, b, c, d, e, f)}
    assert all(r["text"].split()[:300] == words.pop(r["text"].split()[0]) for r in found) and not words


def test_near_stage_alone_keeps_one_row_of_repeats(spark):
    text = long_text(9)
    docs = spark.createDataFrame([(7, text), (7, text), (8, text + " end"), (None, text)], "doc_id bigint, text string")
    assert [tuple(r) for r in corpus_pipeline.near(spark, docs, "").collect()] == [(7, text)]


def test_cuts_inside_characters_leave_genuine_replacement_characters(spark):
    """A passage that begins and ends inside characters: their parts go and make no new one; U+FFFD elsewhere stays."""
    shared = "\u0082" + "passage " * 40 + "\u3042"
    first = "one \ufffd two \u3042" + shared[1:] + " end"
    second = "three \u3142" + shared[1:-1] + "\u3043 more \ufffd"
    docs = spark.createDataFrame([(1, first), (2, second)], "doc_id bigint, text string").withColumn("n_chars", F.length("text").cast("bigint"))
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.passages(spark, docs, "").collect()}
    assert found[1][0] == "one \ufffd two  end" and found[2][0] == "three  more \ufffd"
    assert all(n == len(text) for text, n in found.values())
