"""Exact and suffix-array deduplication, and quality rules, against brute force."""

import hashlib
import os
import random
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest

from siltworks.llm import exact_dedup, quality_rules, suffix_dedup
from siltworks.llm.queries import op4_quality_rules, op8_exact_dedup


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 30_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(2**63), 2**63 - 1, n, dtype=np.int64))
    built = exact_dedup.build_fuse(keys)
    assert exact_dedup.in_fuse(keys, *built).all()
    others = rng.integers(-(2**63), 2**63 - 1, 100_000, dtype=np.int64)
    assert exact_dedup.in_fuse(others, *built).mean() < 0.02


def test_exact_groups(spark, messy, texts):
    norm = {(i, t): re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in texts}
    groups = {}
    for i, t in texts:
        groups.setdefault(norm[i, t], []).append(i)
    wanted = []
    for i, t in texts:
        ids = [x for x in groups[norm[i, t]] if x is not None]
        keep = min(ids) if ids else None
        wanted.append((i, keep, len(groups[norm[i, t]]), i == keep, hashlib.sha256(norm[i, t].encode()).hexdigest()))
    found = op8_exact_dedup(spark, messy).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in found)


@pytest.mark.parametrize("batches", [1, 5])
def test_batches_make_no_difference(spark, messy, batches):
    docs = spark.read.parquet(f"{messy}/documents.parquet")
    found = sorted(map(repr, exact_dedup.dedupe(docs, batches).collect()))
    assert found == sorted(map(repr, exact_dedup.dedupe(docs).collect()))


def covered(texts, span=200):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(d[i : i + span] for d in data for i in range(len(d) - span + 1))
    out = []
    for d in data:
        mark = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - span + 1):
            if seen[d[i : i + span]] > 1:
                mark[i : i + span] = True
        runs = int((mark[1:] & ~mark[:-1]).sum()) + int(mark[0])
        out.append((len(d), runs, bytes(b for b, m in zip(d, mark) if not m)))
    return out


@pytest.mark.parametrize("batches, hot", [(3, 1000), (5, 0), (1, 2)])
def test_repeats(spark, messy, texts, batches, hot):
    wanted = Counter((i, *c) for (i, _), c in zip(texts, covered(texts)))
    rows = suffix_dedup.remove_repeats(spark.read.parquet(f"{messy}/documents.parquet"), batches, hot).collect()
    assert Counter((r["own"]["doc_id"], r["n_bytes"], r["n_spans"], bytes(r["kept"])) for r in rows) == wanted


def test_levels_merge_geometrically(spark):
    index = suffix_dedup.SuffixIndex()
    for i in range(7):
        rows = [(b"%03d" % k, k, 0, i, 0) for k in range(i, i + 3)]
        found = index.add(spark.createDataFrame(rows, suffix_dedup.POSTINGS))
        assert sorted({r["key"] for r in found.collect()}) == ([] if not i else [k for k in range(i, i + 3) if k < i + 2])
    assert [size for size, _ in index.levels] == [4, 2, 1]


def test_levels_are_scanned_side_by_side(spark):
    """A new array meets a level bucket by bucket: their files are merged without an exchange."""
    index = suffix_dedup.SuffixIndex()
    for i in range(2):
        rows = [(b"%05d" % k, k, 0, i, 0) for k in range(i, 300, 2)]
        index.add(spark.createDataFrame(rows, suffix_dedup.POSTINGS))
    (_, old), (_, new) = index.levels
    plan = new.join(old.select("suffix").hint("merge"), "suffix", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_seven_batches_over_a_stored_index(spark, tmp_path):
    """Each batch opens what the one before has left, and loses what it shares with itself or any earlier document."""
    rng = random.Random(21)
    passages = [" ".join(rng.choice(["stone", "river", "walk", "éa", "of", "the"]) + str(rng.randint(0, 99)) for _ in range(60)) for _ in range(6)]
    made, known = 0, []
    for batch in range(7):
        rows = []
        for _ in range(5):
            own = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(5, 80)))
            rows.append((made, own + " " + rng.choice(passages) + " " + own[:40] if rng.random() < 0.7 else own))
            made += 1
        if batch == 3:
            rows += [(made, known[0][1]), (made + 1, None), (made + 2, known[2][1][3:])]
            made += 3
        docs, earlier = (spark.createDataFrame(r, "doc_id bigint, text string") if r else None for r in (rows, known))
        index = suffix_dedup.SuffixIndex(str(tmp_path / "index"), spark)
        assert sum(size for size, _ in index.levels) == batch and len(index.postings) == batch
        found = suffix_dedup.remove_repeats(docs, 1, index=index, earlier=earlier).collect()
        wanted = covered([*rows, *known])[: len(rows)]
        assert Counter((r["own"]["doc_id"], r["n_bytes"], r["n_spans"], bytes(r["kept"])) for r in found) == Counter((i, *c) for (i, _), c in zip(rows, wanted))
        known += rows
    assert [size for size, _ in index.levels] == [4, 2, 1]


def test_anchors_in_pieces_are_those_of_the_whole(texts, monkeypatch):
    whole = [suffix_dedup.anchors((t or "").encode()) for _, t in texts]
    for size in (1, 137, 300):
        monkeypatch.setattr(suffix_dedup, "WINDOWS", size)
        for (_, t), want in zip(texts, whole):
            if t and len(t) < 5000:
                got = suffix_dedup.anchors(t.encode())
                assert (got is None) == (want is None) and (got is None or all((a == b).all() for a, b in zip(got, want)))


_LONG = """
import resource, sys
from siltworks.llm import quality_rules, simhash, suffix_dedup
from siltworks.llm.chunk_encoder import library_encoder
import public_tokenizers, random
rng = random.Random(1)
words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(50_000)]
text = "".join(rng.choice(words) + rng.choice("    \\n") for _ in range(5_000_000))
assert len(text) > 29_000_000
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
{call}
grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
print(round(grown), file=sys.stderr)
assert grown < {limit}, grown
"""


@pytest.mark.parametrize(
    "call, limit",
    [
        ("simhash.fingerprint(text)", 240),
        ("quality_rules.counts(text)", 480),
        ("suffix_dedup.anchors(text.encode())", 240),
        ('library_encoder(public_tokenizers.path("byte_bpe_50k.json"), True).encode(text)', 480),
    ],
)
def test_a_text_of_thirty_megabytes_takes_bounded_memory(call, limit):
    """Peak growth in MB, for a text of 30 MB: some times the text, not tens of times."""
    code = _LONG.format(call=call, limit=limit)
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.dirname(__file__))), capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr


def test_windows_of_equal_remainder_are_compared_together(monkeypatch):
    rng = random.Random(6)
    lists = [[rng.choice([b"a", b"b", b"c", b"dd"]) for _ in range(n)] for n in (0, 1, 2, 3, 4, 7, 30, 200)]
    whole = [quality_rules.repeated_words(words) for words in lists]
    for n, words in zip(whole, lists):
        assert n == plain_counts(b" ".join(words).decode())[4]
    monkeypatch.setattr(quality_rules, "WINDOWS", 3)
    assert [quality_rules.repeated_words(words) for words in lists] == whole


def test_anchors_are_the_same_in_equal_windows():
    rng = random.Random(3)
    shared = bytes(rng.choices(b"abc ", k=500))
    found = []
    for lead in (0, 37, 411):
        data = bytes(rng.choices(b"abc ", k=lead)) + shared + bytes(rng.choices(b"abc ", k=90))
        key, at, first, last = suffix_dedup.anchors(data)
        assert first[0] == 0 and last[-1] == len(data) - 200 and (first[1:] == last[:-1] + 1).all()
        assert ((at >= first) | (at <= last + 200)).all() and (at - first < 200).all()
        anchor = np.repeat(at, last - first + 1)
        found.append((anchor - lead)[lead : lead + 301])
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(i, i + 3)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_quality_counts(spark, messy, texts):
    found = op4_quality_rules(spark, messy).collect()
    wanted = [(i, *plain_counts(t)) for i, t in texts]
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)[:6]) for r in found)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_many_kinds_of_words():
    words = [str(i).encode() for i in range(9)] * 2
    assert quality_rules.repeated_words(words) == 18
    assert quality_rules.repeated_words([b"a", b"b"]) == 0
    assert quality_rules.repeated_words([b"a"] * 4) == 4


def test_bad_host_makes_warnings_count(spark):
    clean = " ".join(f"word{i} stone river" for i in range(60))
    odd = clean + " " + "$ " * 60
    rows = [(i, odd, "bad") for i in range(60)] + [(100 + i, clean, "bad") for i in range(4)]
    rows += [(200 + 50 * h + i, clean, f"good{h}") for h in range(4) for i in range(30)] + [(900, odd, "good0"), (901, odd, "tiny")]
    found = {r["doc_id"]: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert not any(found[i]["kept"] for i in range(60))
    assert all(found[100 + i]["kept"] for i in range(4))  # clean documents of a bad host
    assert found[900]["kept"]
    assert 0 < found[901]["host_rate"] < 1  # one document doesn't make a rate of one
