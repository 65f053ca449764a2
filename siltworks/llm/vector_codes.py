"""Codes of vectors: a codebook per part, its nearest entry found by sorted coordinates and bit masks.

A vector is cut into equal parts; each part position has a codebook of at most 64 entries, so that a
set of entries is one unsigned 64-bit mask. Per dimension the entries' coordinates are sorted, and
place i of the order carries the mask of the first i entries. To find the nearest entry of a part:

* the entries that neighbour it in each dimension's order give a first distance, and with it a radius;
* per dimension, two binary searches cut out the coordinates within the radius, and the masks at
  their ends give the entries of that slice;
* the slices of all dimensions are ANDed: what is left is every entry that can be as near as the first
  distance, among them the nearest and all its ties. They are compared exactly, ties going to the lower index.

A round is one pass over the vectors: a task adds up its parts per entry and hands on one row of
sums, and the codebooks, which are as large as ``parts`` x 64 entries whatever the data, go out
with the next job. Nothing is shuffled but those sums, and errors per label.

Rows whose vector is null, has another number of components than ``dims``, or holds a null or a number
that is not finite are left out; the others each give a row, repeated rows and rows without an id
too. Codebooks start from the least ids; equal ids are told apart by their vectors, null ids come
last. Fewer than 64 rows give smaller codebooks, none an empty result. Null labels form one group. A component
beyond 2**27 / ``scale`` is an error, as no long holds its squares. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import ship, stored
from siltworks.llm.vectors import floors, kept, matrix, summed

# Bits of a mask.
MOST_ENTRIES = 64
# Parts that are compared at once: as many masks as 64 bits each are laid open.
AT_ONCE = 8192


class PartIndex:
    """The entries of one part position, sorted by each coordinate, with masks of every beginning of the order."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= MOST_ENTRIES:
            raise ValueError(f"a codebook has 1 to {MOST_ENTRIES} entries")
        self.entries = entries
        self.orders = [np.argsort(c, kind="stable") for c in entries.T]
        self.sorted = [c[o] for c, o in zip(entries.T, self.orders)]
        bits = [np.uint64(1) << o.astype(np.uint64) for o in self.orders]
        self.masks = [np.concatenate([np.zeros(1, np.uint64), np.bitwise_or.accumulate(b)]) for b in bits]

    def _distances(self, parts: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((parts - self.entries[entry]) ** 2).sum(axis=1)

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """Per part the mask of entries within its first distance in every dimension."""
        first = None
        for order, coordinates, values in zip(self.orders, self.sorted, parts.T):
            place = np.searchsorted(coordinates, values)
            for near in (np.maximum(place - 1, 0), np.minimum(place, len(order) - 1)):
                distance = self._distances(parts, order[near])
                first = distance if first is None else np.minimum(first, distance)
        radius = np.sqrt(first.astype(float)).astype(np.int64) + 1
        found = np.full(len(parts), np.uint64(0xFFFFFFFFFFFFFFFF))
        for masks, coordinates, values in zip(self.masks, self.sorted, parts.T):
            low = np.searchsorted(coordinates, values - radius, "left")
            high = np.searchsorted(coordinates, values + radius, "right")
            found &= masks[high] & ~masks[low]
        return found

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to the nearest entry of every part."""
        index, least = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        for at in range(0, len(parts), AT_ONCE):
            some = parts[at : at + AT_ONCE]
            masks = self.candidates(some)
            shown = np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, entry = np.nonzero(shown)  # by row, entries ascending
            distance = self._distances(some[row], entry)
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            best = np.minimum.reduceat(distance, starts)
            ties = np.flatnonzero(distance == best[row])
            _, lowest = np.unique(row[ties], return_index=True)
            index[at : at + AT_ONCE], least[at : at + AT_ONCE] = entry[ties[lowest]], best
        return index, least


class Codebooks:
    """The codebooks of all part positions: an array of parts x entries x components of a part."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self._indexes: list[PartIndex] | None = None

    def __getstate__(self) -> dict:
        return {"entries": self.entries, "_indexes": None}

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per vector the index in every part, and the squared distance summed over the parts."""
        self._indexes = self._indexes or [PartIndex(e) for e in self.entries]
        parts, _, width = self.entries.shape
        codes, error = np.zeros((len(vectors), parts), np.int64), np.zeros(len(vectors), np.int64)
        for p, index in enumerate(self._indexes):
            codes[:, p], distance = index.nearest(vectors[:, p * width : (p + 1) * width])
            error += distance
        return codes, error

    def decode(self, code: str) -> list[int]:
        """The components that a code stands for."""
        return [int(x) for p, e in enumerate(bytes.fromhex(code)) for x in self.entries[p, e]]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _sums(source: DataFrame, books: Codebooks, dims: int, scale: int) -> DataFrame:
    """A row per task: the sums and the number of parts that fall to each entry."""
    parts, entries, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            vectors = matrix(batch.column("vector"), dims, scale)
            codes, _ = books.encode(vectors)
            for p in range(parts):
                np.add.at(sums[p], codes[:, p], vectors[:, p * width : (p + 1) * width])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array([[*sums.ravel().tolist(), *counts.ravel().tolist()]], pa.list_(pa.int64()))], names=["totals"])

    return source.select("vector").mapInArrow(run, "totals array<bigint>")


def train(source: DataFrame, parts: int, entries: int, rounds: int, scale: int, dims: int) -> Codebooks | None:
    """Codebooks for rows (vec_id, vector), or None if there is no row."""
    width = dims // parts
    if width * parts != dims or not 0 < entries <= MOST_ENTRIES:
        raise ValueError("parts must divide the components, and a codebook has 1 to 64 entries")
    first = source.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()  # 64 rows at most
    if not first:
        return None
    start = floors(np.array([r["vector"] for r in first], float), scale)
    books = Codebooks(start.reshape(len(start), parts, width).swapaxes(0, 1).copy())
    for _ in range(rounds):
        cells = books.entries.size
        totals = summed(_sums(source, books, dims, scale), "totals", cells + parts * len(start))
        sums, counts = totals[:cells].reshape(books.entries.shape), totals[cells:].reshape(parts, len(start), 1)
        books = Codebooks(np.where(counts > 0, sums // np.maximum(counts, 1), books.entries))
    return books


def compress(
    rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, dims: int = 64,
    vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, code, error) of every kept row, and the codebooks."""
    ship(rows.sparkSession)
    source = kept(rows, vector, dims, vec_id=vec_id, label=label)
    books = train(source, parts, entries, rounds, scale, dims)
    kinds = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    if books is None:
        return rows.sparkSession.createDataFrame([], schema), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, error = books.encode(matrix(batch.column("vector"), dims, scale))
            text = pa.array([c.tobytes().hex() for c in codes.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), text, pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"]
            )

    return source.mapInArrow(run, schema), books


def query(rows: DataFrame, **parameters) -> DataFrame:
    """Every kept vector's code and error, the error summed over its label, and the digest of all codebooks.

    Labels are summed before they are joined; a label of many rows is split by adaptive execution.
    """
    found, books = compress(rows, **parameters)
    found = stored(found, "codes")
    sums = stored(found.groupBy(F.col("label").alias("group")).agg(F.sum("error").alias("label_error")), "label-errors")
    digest = F.lit(books.sha256() if books else "")
    return found.join(sums, F.col("label").eqNullSafe(F.col("group"))).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql(parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, dims: int = 64) -> str:
    """The same rounds, every distance computed."""
    width, steps = dims // parts, []
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (
  SELECT vec_id, part, j, d FROM (
    SELECT vec_id, part, j, d, row_number() OVER (PARTITION BY vec_id, part ORDER BY d, j) AS place FROM (
      SELECT x.vec_id, x.part, c.j, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{t} c USING (part, pos) GROUP BY ALL))
  WHERE place = 1)""")
        if t < rounds:
            steps.append(f"""s{t} AS (
  SELECT a.part, a.j, x.pos, CAST(sum(x.v) AS BIGINT) AS s, count(*) AS n FROM a{t} a JOIN x USING (vec_id, part) GROUP BY ALL
), c{t + 1} AS MATERIALIZED (
  SELECT c.part, c.j, c.pos, coalesce((s - ((s % n) + n) % n) // n, c.v) AS v FROM c{t} c LEFT JOIN s{t} USING (part, j, pos))""")
    return f"""
WITH e AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {dims}
), x AS MATERIALIZED (
  SELECT vec_id, i // {width} AS part, i % {width} AS pos, CAST(floor({scale} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS v
  FROM e, range(0, {dims}) AS r(i)
), c0 AS MATERIALIZED (
  SELECT part, j, pos, v FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM e QUALIFY j < {entries}) USING (vec_id)
), {", ".join(steps)}, o AS (
  SELECT vec_id, string_agg(printf('%02x', j), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id
), l AS (
  SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM o JOIN e USING (vec_id) GROUP BY label
)
SELECT o.vec_id, code, error, label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, j, pos)) FROM c{rounds}) AS codebooks_sha256
FROM o JOIN e USING (vec_id) JOIN l ON e.label IS NOT DISTINCT FROM l.label
"""


SQL = _sql()
