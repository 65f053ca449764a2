"""Centroid clustering: Lloyd's rounds in which bounds spare most distances, with geometric drift tightening.

Every vector keeps its cluster, an upper bound on the distance to its own centroid and a lower
bound on the distance to any other. When the centroids have moved, the upper bound grows by the
own centroid's move. The lower bound shrinks by less than the greatest move of the others: all
members of a cluster lie in a sphere around its old centroid, and in the plane through that
centre and the two places of a moved centroid, points whose distance to the moved centroid fell by
some amount lie within the asymptotes of a hyperbola. So over the whole sphere the distance falls
by at most ``move * cos(angle)``, where the angle, seen from the middle of the move, is the one
between the move and the nearest ray that touches the sphere (``sphere_drift``). Only vectors whose
bounds overlap are looked at again, first their own distance, then, if still ambiguous, all of them
exactly. Distances and sums are integers, so results do not depend on order or rounding: bounds are
widened by a relative 1e-9 and a vector whose bounds meet is always scanned.

Vectors lie in blocks of ``BLOCK`` rows in a table bucketed by block number; what is known of them
lies in a table a round with the same buckets, so a round is one join of files without a shuffle,
whatever values repeat. Sums are corrected by the vectors that moved, a row of sums per task.
Tables are written below the folder of ``spark.checkpoint.dir``: a lost executor costs its tasks.
The centroids, ``k`` vectors, are the only thing that passes through the driver.

Rows whose vector is null, has another number of components, or holds a null or a number that is
not finite are left out; the others each give a row, repeated rows and rows without an id too.
Seeds are the rows of least hash; equal ids are told apart by their vectors, a null id counts as empty
text. Fewer than ``k`` rows give as many clusters, none an empty result. A component beyond
2**27 / ``scale`` is an error, as no long holds its squares. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.common import ship, stored
from siltworks.llm.vectors import floors, kept, last_marked, matrix, summed
from siltworks.session import scratch_path

# Vectors of a block: 128 KB of 64 components.
BLOCK = 512
# Relative widening of bounds, far above the rounding of a few additions and one square root.
SLACK = 1e-9
# The same for a cosine: near their ends, inverse sine and cosine keep half of a double's digits.
ANGLE_SLACK = 1e-6


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    return ((vectors - centroid) ** 2).sum(axis=1)


def sphere_drift(centre: np.ndarray, radius: float, before: np.ndarray, after: np.ndarray) -> float:
    """How much the distance to a centroid that moves can fall, at most, for points of a sphere.

    For x in it, d(x, before)**2 - d(x, after)**2 is 2 (x - m) . move with m the middle of the move,
    and d(x, before) + d(x, after) is at least 2 |x - m|: the fall is at most the length of the move times
    the cosine of the angle between x - m and the move, if that is positive. The sphere spans asin(radius / |centre - m|)
    on either side of its centre's angle; if it holds m, the whole move counts.
    """
    move = (after - before).astype(float)
    length = math.sqrt(float(move @ move))
    if length == 0:
        return 0.0
    away = centre.astype(float) - (before.astype(float) + move / 2)
    distance = math.sqrt(float(away @ away))
    if distance <= radius * (1 + SLACK):
        return length * (1 + SLACK)
    angle = math.acos(max(-1.0, min(1.0, float(away @ move) / (distance * length))))
    nearest = max(0.0, angle - math.asin(min(1.0, radius / distance)))
    return length * min(1.0 + SLACK, max(0.0, math.cos(nearest) + ANGLE_SLACK))


class Bounds:
    """What the tasks of a round need: centroids, their moves, and how far lower bounds are loosened per cluster."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None = None, radius: np.ndarray | None = None):
        self.centroids = centroids
        k = len(centroids)
        apart = [[math.sqrt(float(squared(centroids[i : i + 1], centroids[j])[0])) for j in range(k) if j != i] for i in range(k)]
        #: No vector closer to its centroid than half the way to the next one can be nearer to another.
        self.half = np.array([min(others, default=math.inf) for others in apart]) / 2 * (1 - SLACK)
        if before is not None:
            self.moved = np.sqrt([float(d) for d in ((centroids - before) ** 2).sum(axis=1)]) * (1 + SLACK)
            self.loosened = np.array(
                [max((sphere_drift(before[i], radius[i], before[j], centroids[j]) for j in range(k) if j != i), default=0.0) for i in range(k)]
            )

    def first(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cluster, upper and lower bound of vectors that are scanned in full; ties go to the smaller number."""
        distances = np.stack([squared(vectors, c) for c in self.centroids], axis=1)
        cluster = distances.argmin(axis=1)
        rows = np.arange(len(vectors))
        upper = np.sqrt(distances[rows, cluster].astype(float)) * (1 + SLACK)
        others = distances.astype(float)
        others[rows, cluster] = math.inf
        return cluster, upper, np.sqrt(others.min(axis=1)) * (1 - SLACK)

    def next(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """The same after the centroids have moved, and how many vectors had to be scanned in full."""
        upper = upper * (1 + 1e-15) + self.moved[cluster]
        lower = np.maximum(lower * (1 - 1e-15) - self.loosened[cluster], 0.0)
        limit = np.maximum(lower, self.half[cluster])
        unsure = np.flatnonzero(upper >= limit)
        own = ((vectors[unsure] - self.centroids[cluster[unsure]]) ** 2).sum(axis=1)
        upper[unsure] = np.sqrt(own.astype(float)) * (1 + SLACK)
        unsure = unsure[upper[unsure] >= limit[unsure]]
        cluster = cluster.copy()
        if len(unsure):
            cluster[unsure], upper[unsure], lower[unsure] = self.first(vectors[unsure])
        return cluster, upper, lower, len(unsure)


STATE = "block bigint, cluster binary, upper binary, lower binary, totals array<bigint>, radius array<double>"
STATE_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("cluster", pa.binary()),
        ("upper", pa.binary()),
        ("lower", pa.binary()),
        ("totals", pa.list_(pa.int64())),
        ("radius", pa.list_(pa.float64())),
    ]
)


class _Tables:
    """Tables of one run, all with the same buckets by block; their files lie in the shared folder."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.names: list[str] = []

    def write(self, df: DataFrame, what: str) -> DataFrame:
        name = f"llm_{what}_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "block").option("path", scratch_path(self.spark, f"llm-{what}")).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def forget(self) -> None:
        """Takes the names out of the catalogue; the files stay, as all written tables do."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _sql(k: int = 8, rounds: int = 10, scale: int = 1024, salt: int = 3, dims: int = 64) -> str:
    """The same rounds, every distance computed."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
  SELECT vec_id, j, d FROM (
    SELECT vec_id, j, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, j) AS place FROM (
      SELECT x.vec_id, c.j, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{t} c USING (pos) GROUP BY ALL))
  WHERE place = 1)""")
        if t < rounds:
            steps.append(f"""s{t} AS (
  SELECT a.j, x.pos, CAST(sum(x.v) AS BIGINT) AS s, count(*) AS n FROM a{t} a JOIN x USING (vec_id) GROUP BY ALL
), c{t + 1} AS MATERIALIZED (
  SELECT c.j, c.pos, coalesce((s - ((s % n) + n) % n) // n, c.v) AS v FROM c{t} c LEFT JOIN s{t} USING (j, pos))""")
    return f"""
WITH e AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {dims}
), x AS MATERIALIZED (
  SELECT vec_id, pos, CAST(floor({scale} * CAST(embedding[pos] AS DOUBLE)) AS BIGINT) AS v FROM e, range(1, {dims + 1}) AS r(pos)
), c0 AS MATERIALIZED (
  SELECT j, pos, v FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS j FROM e QUALIFY j < {k}) USING (vec_id)
), {", ".join(steps)}, f AS (
  SELECT j, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{rounds} GROUP BY j
), t AS (
  SELECT j, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY j
)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, cluster_inertia,
  (SELECT CAST(sum(d) AS BIGINT) FROM a{rounds}) AS inertia, centroid_sha256
FROM a{rounds} JOIN t USING (j) JOIN f USING (j)
"""


def _blocks(rows: DataFrame, dims: int, scale: int, buckets: int) -> DataFrame:
    """(block, ids, vectors): runs of a task's rows as integers, dealt out by block number."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                packed = matrix(some.column("vector"), dims, scale).astype("<i4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([some.column("vec_id").to_pylist()], pa.list_(pa.int64())), pa.array([packed], pa.binary())],
                    names=["block", "ids", "vectors"],
                )
                number += 1

    return rows.mapInArrow(pack, "block bigint, ids array<bigint>, vectors binary").repartition(buckets, "block")


def _unpacked(row: dict, dims: int) -> np.ndarray:
    return np.frombuffer(row["vectors"], "<i4").reshape(-1, dims).astype(np.int64)


def _pass(joined: DataFrame, bounds: Bounds, dims: int) -> DataFrame:
    """One assignment of every vector. The last row of a task has the changes of sums and counts and the radii."""
    k = len(bounds.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, scanned, radius = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0, np.zeros(k)

        def blocks() -> Iterator[dict]:
            nonlocal scanned
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    vectors = _unpacked(row, dims)
                    if row.get("cluster") is None:
                        cluster, upper, lower = bounds.first(vectors)
                        came, left = np.arange(len(vectors)), np.zeros(0, int)
                        old, full = cluster, len(vectors)
                    else:
                        old = np.frombuffer(row["cluster"], "<i4").astype(np.int64)
                        cluster, upper, lower, full = bounds.next(vectors, old, np.frombuffer(row["upper"], "<f8"), np.frombuffer(row["lower"], "<f8"))
                        came = left = np.flatnonzero(cluster != old)
                    np.add.at(sums, cluster[came], vectors[came])
                    np.add.at(counts, cluster[came], 1)
                    np.subtract.at(sums, old[left], vectors[left])
                    np.subtract.at(counts, old[left], 1)
                    np.maximum.at(radius, cluster, upper)
                    scanned += full
                    yield {
                        "block": row["block"],
                        "cluster": cluster.astype("<i4").tobytes(),
                        "upper": upper.astype("<f8").tobytes(),
                        "lower": lower.astype("<f8").tobytes(),
                    }

        def marks() -> dict:
            return {"totals": [*sums.ravel().tolist(), *counts.tolist(), scanned], "radius": radius.tolist()}

        yield from last_marked(blocks(), marks, STATE_ARROW)

    return joined.mapInArrow(run, STATE)


def cluster(
    rows: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, salt: int = 3, dims: int = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(vec_id, cluster, distance) of every kept row, the final centroids, and the vectors scanned in full a round.

    Each round assigns and then moves the centroids to the floor of their members' mean; empty ones
    stay. At the end vectors are assigned once more. Rounds after one in which nothing moved change nothing and are left out.
    """
    spark = rows.sparkSession
    ship(spark)
    source = kept(rows, vector, dims, vec_id=vec_id)
    text = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    seeds = source.orderBy(F.sha2(text, 256), "vector").limit(k).collect()  # k rows
    if not seeds:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint"), np.zeros((0, dims), np.int64), []
    centroids = floors(np.array([s["vector"] for s in seeds], float), scale)
    k = len(centroids)
    tables = _Tables(rows)
    blocks = tables.write(_blocks(source, dims, scale, tables.buckets), "vectors")
    bounds = Bounds(centroids)
    state = tables.write(_pass(blocks.select("block", "vectors"), bounds, dims), "state")
    totals, scanned = np.zeros(k * dims + k, np.int64), []
    for done in range(rounds + 1):
        found = summed(state, "totals", k * dims + k + 1)
        totals, scanned = totals + found[:-1], [*scanned, int(found[-1])]
        if done == rounds:
            break
        counts = totals[k * dims :]
        moved = np.where(counts[:, None] > 0, totals[: k * dims].reshape(k, dims) // np.maximum(counts, 1)[:, None], centroids)
        if (moved == centroids).all():
            break
        reach = state.filter("radius IS NOT NULL").select(F.posexplode("radius").alias("place", "value")).groupBy("place").agg(F.max("value"))
        radius = dict(map(tuple, reach.collect()))  # k rows
        bounds = Bounds(moved, centroids, np.array([radius[i] for i in range(k)]))
        centroids = moved
        # Both tables lie in the same buckets: the join reads files side by side, without an exchange.
        joined = blocks.select("block", "vectors").join(state.select("block", "cluster", "upper", "lower").hint("shuffle_hash"), "block")
        state = tables.write(_pass(joined, bounds, dims), "state")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                own = np.frombuffer(row["cluster"], "<i4")
                distance = ((_unpacked(row, dims) - centroids[own]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), pa.array(own, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    joined = blocks.join(state.select("block", "cluster").hint("shuffle_hash"), "block")
    result = stored(joined.mapInArrow(measure, "vec_id bigint, cluster int, distance bigint"), "clustered")
    tables.forget()
    return result, centroids, scanned


def query(rows: DataFrame, **parameters) -> DataFrame:
    """Every kept vector with its cluster, the inertia of that and of all, and the digest of its centroid."""
    found, centroids, _ = cluster(rows, **parameters)
    spark = rows.sparkSession
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)]
    # A row per cluster in the window and on the broadcast side.
    named = spark.createDataFrame(digests, "number int, centroid_sha256 string")
    sums = found.groupBy(F.col("cluster").alias("number")).agg(F.sum("distance").alias("cluster_inertia"))
    facts = named.join(sums, "number").withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()))
    return found.join(F.broadcast(facts), F.col("cluster") == F.col("number")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


SQL = _sql()
