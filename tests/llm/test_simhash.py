import random

import numpy as np
import xxhash

from siltworks.llm import simhash
from siltworks.llm.common import word_pieces
from siltworks.llm.components import components


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered:
        if c in " \t\n\x0b\x0c\r":
            words, word = words + ([word] if word else []), ""
        else:
            word += c
    words += [word] if word else []
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def near_pairs(values, bits=4):
    return [(i, j) for i in range(len(values)) for j in range(i) if bin(values[i] ^ values[j]).count("1") <= bits]


def test_fingerprints(texts):
    for _, text in texts:
        if not text or len(text) < 4000:
            assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprints_in_pieces_are_those_of_the_whole(texts, monkeypatch):
    whole = [simhash.fingerprint(t) for _, t in texts]
    for size in (1, 7, 50):
        monkeypatch.setattr(simhash, "word_pieces", lambda data, size=size: word_pieces(data, size))
        assert [simhash.fingerprint(t) for _, t in texts] == whole


def test_components_of_documents(spark, messy, texts):
    rows = simhash.near_duplicates(spark.read.parquet(f"{messy}/documents.parquet")).collect()
    prints = sorted({r["fp"] & (2**64 - 1) for r in rows})
    labels = dict(zip(prints, groups(len(prints), near_pairs(prints))))
    for r in rows:
        mine = [x["doc_id"] for x in rows if labels[x["fp"] & (2**64 - 1)] == labels[r["fp"] & (2**64 - 1)] and x["doc_id"] is not None]
        assert r["component_id"] == min(mine, default=None)


def scattered(rng, n, centres=6, most=6):
    base = [rng.getrandbits(64) for _ in range(centres)]
    values = {rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, most))) for _ in range(n)}
    return sorted(values)


def test_links_with_and_without_split_units(spark):
    rng = random.Random(3)
    values = scattered(rng, 400)
    wanted = groups(len(values), near_pairs(values))
    signed = [v - ((v >> 63) << 64) for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for unit_rows in (simhash.UNIT_ROWS, 12):
        found = simhash.links(frame, unit_rows=unit_rows).collect()
        pairs = [(signed.index(r["a"]), signed.index(r["b"])) for r in found]
        assert all(bin(values[a] ^ values[b]).count("1") <= 64 for a, b in pairs)
        assert groups(len(values), pairs) == wanted


def test_dense_group_is_spanned_not_listed():
    rng = random.Random(9)
    base = rng.getrandbits(44)
    paths = np.array(sorted({base ^ sum(1 << b for b in rng.sample(range(44), rng.randint(0, 3))) for _ in range(1500)}), dtype=np.int64)
    zeros = np.zeros(len(paths), np.int64)
    i, j = simhash.forest_links(zeros, zeros, zeros.astype(bool), paths, 4)
    assert len(i) < len(paths)
    assert groups(len(paths), zip(i.tolist(), j.tolist())) == groups(len(paths), near_pairs([int(p) for p in paths]))


def test_component_stars(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + rng.randint(1, 90)) for _ in range(50)] + [(500, 500)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    wanted = groups(501, pairs)
    assert found == {i: wanted[i] for p in pairs for i in p if i != 500}
