"""Clustering and vector codes against plain Python."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from siltworks.llm import centroids, vector_codes
from siltworks.llm.centroids import Bounds, sphere_drift
from siltworks.llm.queries import op11_centroids, op12_vector_codes
from siltworks.llm.vector_codes import Codebooks, PartIndex


def usable(rows, scale):
    single = [(r["vec_id"], r["label"], r["embedding"]) for r in rows]
    kept = [r for r in single if r[2] is not None and len(r[2]) == 64 and all(x is not None and math.isfinite(x) for x in r[2])]
    return [(i, label, [math.floor(scale * x) for x in v], v) for i, label, v in kept]


def lloyd(rows, k, rounds, salt):
    def first(r):
        return hashlib.sha256(f"{salt}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[3]

    centres = [r[2] for r in sorted(rows, key=first)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        members = defaultdict(list)
        for r in rows:
            members[nearest(r[2])[1]].append(r[2])
        centres = [[sum(x) // len(members[j]) for x in zip(*members[j])] if j in members else c for j, c in enumerate(centres)]
    return [(r[0], *nearest(r[2])[::-1]) for r in rows], centres


def digest(values):
    return hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()


def test_clusters_equal_plain_rounds(spark, messy):
    rows = usable(spark.read.parquet(f"{messy}/embeddings.parquet").collect(), 1024)
    found, centres = lloyd(rows, 8, 10, 3)
    inertia = defaultdict(int)
    for _, j, d in found:
        inertia[j] += d
    wanted = [(i, j, d, inertia[j], sum(inertia.values()), digest(centres[j])) for i, j, d in found]
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in op11_centroids(spark, messy).collect())


@pytest.mark.parametrize("k, rounds", [(1, 3), (3, 0), (3, 1), (2000, 2)])
def test_other_numbers_of_clusters_and_rounds(spark, messy, k, rounds):
    df = spark.read.parquet(f"{messy}/embeddings.parquet").filter("vec_id < 150 OR vec_id IS NULL")
    found, centres = lloyd(usable(df.collect(), 1024), k, rounds, 3)
    rows, have, _ = centroids.cluster(df, k=k, rounds=rounds)
    assert have.tolist() == centres
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in rows.collect())


def test_bounds_spare_most_scans(spark, messy):
    df = spark.read.parquet(f"{messy}/embeddings.parquet")
    rows, _, scanned = centroids.cluster(df, rounds=30)
    n = rows.count()
    # Few moves are left after some rounds, and rounds end once nothing moves.
    assert scanned[0] == n and len(scanned) < 31 and max(scanned[1:]) < 0.7 * n and scanned[-1] < 0.05 * n


def test_rounds_shuffle_no_vectors(spark, messy):
    """Blocks and what is known of them meet bucket by bucket."""
    tables = centroids._Tables(spark.range(1))
    blocks = tables.write(spark.range(100).selectExpr("id AS block", "binary('x') AS vectors").repartition(tables.buckets, "block"), "vectors")
    state = tables.write(spark.range(100).selectExpr("id AS block", "binary('y') AS cluster"), "state")
    plan = blocks.join(state.hint("shuffle_hash"), "block")._jdf.queryExecution().executedPlan().toString()
    tables.forget()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan


def test_drift_holds_for_every_point_of_the_sphere():
    rng = np.random.default_rng(2)
    tighter = 0
    for _ in range(3000):
        dims = int(rng.integers(2, 6))
        centre, before = rng.normal(0, 100, dims).round(), rng.normal(0, 100, dims).round()
        after = before + rng.normal(0, 30, dims).round()
        radius = float(rng.uniform(0, 120))
        bound, move = sphere_drift(centre, radius, before, after), float(np.linalg.norm(after - before))
        ways = rng.normal(0, 1, (200, dims))
        points = centre + ways / np.linalg.norm(ways, axis=1, keepdims=True) * radius * rng.uniform(0.8, 1, (200, 1))
        falls = np.linalg.norm(points - before, axis=1) - np.linalg.norm(points - after, axis=1)
        assert falls.max() <= bound + 1e-6 and bound <= move * (1 + 1e-6)
        tighter += bound < 0.9 * move
    assert tighter > 300


def test_bounds_never_miss_a_change():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-300, 300, (2000, 8))
    centres = vectors[:6].copy()
    bounds = Bounds(centres)
    cluster, upper, lower = bounds.first(vectors)
    for _ in range(25):
        radius = np.array([upper[cluster == j].max(initial=0) for j in range(6)])
        moved = np.array([vectors[cluster == j].sum(axis=0) // max(1, (cluster == j).sum()) if (cluster == j).any() else centres[j] for j in range(6)])
        bounds, centres = Bounds(moved, centres, radius), moved
        cluster, upper, lower, _ = bounds.next(vectors, cluster, upper, lower)
        distances = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert (cluster == distances.argmin(axis=1)).all()
        assert (upper >= np.sqrt(distances.min(axis=1))).all()


def test_a_component_out_of_range_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] * 64, 1)], "vec_id bigint, embedding array<float>, label int")
    with pytest.raises(Exception, match="lies beyond"):
        op = centroids.cluster(df)
        op[0].collect()


def codes(rows, entries, rounds, parts=16):
    width = 64 // parts
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
    books = [[r[2][p * width : (p + 1) * width] for r in first] for p in range(parts)]

    def nearest(v):
        cut = [v[p * width : (p + 1) * width] for p in range(parts)]
        return [min((sum((a - b) ** 2 for a, b in zip(part, e)), j) for j, e in enumerate(book)) for part, book in zip(cut, books)]

    for _ in range(rounds):
        members = defaultdict(list)
        for r in rows:
            for p, (_, j) in enumerate(nearest(r[2])):
                members[p, j].append(r[2][p * width : (p + 1) * width])
        books = [[[sum(x) // len(members[p, j]) for x in zip(*members[p, j])] if (p, j) in members else e for j, e in enumerate(book)] for p, book in enumerate(books)]
    out = []
    for r in rows:
        found = nearest(r[2])
        out.append((r[0], r[1], "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    return out, books


def test_codes_equal_plain_search(spark, messy):
    found, books = codes(usable(spark.read.parquet(f"{messy}/embeddings.parquet").collect(), 256), 64, 2)
    errors = defaultdict(int)
    for _, label, _, e in found:
        errors[label] += e
    name = digest(x for book in books for e in book for x in e)
    wanted = [(i, code, e, errors[label], name) for i, label, code, e in found]
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in op12_vector_codes(spark, messy).collect())


def test_few_rows_give_small_codebooks(spark, messy):
    df = spark.read.parquet(f"{messy}/embeddings.parquet").filter("vec_id < 5 OR vec_id IS NULL")
    wanted, books = codes(usable(df.collect(), 256), 64, 3)
    rows, have = vector_codes.compress(df, rounds=3)
    assert have.entries.tolist() == books
    assert sorted(map(repr, wanted)) == sorted(repr(tuple(r)) for r in rows.collect())


def test_masks_hold_the_nearest_and_its_ties():
    rng = np.random.default_rng(5)
    for spread in (1, 3, 40, 100_000):
        for n in (1, 2, 63, 64):
            entries, parts = rng.integers(-spread, spread + 1, (n, 4)), rng.integers(-2 * spread, 2 * spread + 1, (500, 4))
            index = PartIndex(entries)
            distances = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
            got, least = index.nearest(parts)
            assert (got == distances.argmin(axis=1)).all() and (least == distances.min(axis=1)).all()
            masks = index.candidates(parts)
            ties = distances == distances.min(axis=1, keepdims=True)
            for mask, tied in zip(masks.tolist(), ties):
                assert all(mask >> e & 1 for e in np.flatnonzero(tied).tolist())


def test_masks_rule_out_most_entries():
    rng = np.random.default_rng(6)
    index = PartIndex(rng.normal(0, 100, (64, 4)).astype(np.int64))
    left = [bin(m).count("1") for m in index.candidates(rng.normal(0, 100, (2000, 4)).astype(np.int64)).tolist()]
    assert sum(left) / len(left) < 16


def test_codebooks_are_limited_and_codes_decode():
    with pytest.raises(ValueError):
        PartIndex(np.zeros((65, 4), np.int64))
    random.seed(1)
    books = Codebooks(np.arange(2 * 3 * 2).reshape(2, 3, 2))
    assert books.decode("0201") == [4, 5, 8, 9]
