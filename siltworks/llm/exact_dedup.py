"""Exact deduplication: binary-fuse filters of immutable snapshots screen each new batch.

Texts are equal when they are identical after every run of ASCII white space becomes one space.
Documents arrive in batches. The distinct 64-bit digests of a batch are screened against the
filter of every earlier snapshot; digests that occur more than once within the batch are found
by grouping, apart from that. Then the batch becomes a snapshot with a filter of its own, which
never changes. A filter is built in shards, so no task and no driver holds it whole.

Digests that any screen lets through are suspects. The texts of suspect rows meet in exact
buckets and are grouped by their bytes, after grouping within each task, so that a group of
copies of any size sends one row per task. Digests decide nothing by themselves: a false
positive or a collision leaves groups of one. To keep other texts where they are, rows are first
tested against a bitmap of the suspects, of bounded size; a full bitmap lets all through and
changes no result.

Null text counts as empty, and empty texts are equal. Of equal texts the rows with the smallest
doc_id stay (a null doc_id only if there is no other); repeated rows of that doc_id are one
document and stay together. group_size counts rows. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import Bitmap, maybe_in, row_key, ship, stored

BATCHES = 3
#: Digests in a shard of a filter, about.
SHARD_KEYS = 40_000

_MASK64 = (1 << 64) - 1


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of the keys with a seed."""
    h = keys.view(np.uint64) + np.uint64(seed)
    for multiplier in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(multiplier)
    return h ^ (h >> np.uint64(33))


def _cells(h: np.ndarray, segment: int, count: int) -> np.ndarray:
    """The three cells of each hash, one in each of three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(segment * count)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack([first, second, third], axis=1).astype(np.int64)


def _prints(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))).astype(np.uint8)


def build_fuse(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, cells) over distinct keys: a 3-wise binary-fuse filter of 8 bits."""
    n = max(2, len(keys))
    segment = 1 << min(18, int(np.log(n) / np.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))
    count = max(1, -(-int(n * factor) // segment) - 2)
    size = (count + 2) * segment
    for attempt in range(1000):
        if attempt % 20 == 19:  # unlucky small sets: more room
            count += 1
            size += segment
        seed = (0x9E3779B97F4A7C15 * (attempt + 1)) & _MASK64
        h = _mixed(keys, seed)
        cells = _cells(h, segment, count)
        layers = _peel(cells, size)
        if layers is None:
            continue
        table, prints = np.zeros(size, np.uint8), _prints(h)
        for peeled, own in reversed(layers):
            three = cells[peeled]
            table[own] = 0
            table[own] = prints[peeled] ^ table[three[:, 0]] ^ table[three[:, 1]] ^ table[three[:, 2]]
        return seed, segment, count, table.tobytes()
    raise ValueError("no filter found: keys are not distinct")


def _peel(cells: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the cell that only this key still uses); None if some keys are left."""
    degree = np.bincount(cells.ravel(), minlength=size)
    held = np.zeros(size, np.int64)
    rows = np.arange(len(cells))
    for c in range(3):
        np.bitwise_xor.at(held, cells[:, c], rows)
    layers, left = [], len(cells)
    while left:
        single = np.flatnonzero(degree == 1)
        if not len(single):
            return None
        keys, at = np.unique(held[single], return_index=True)
        layers.append((keys, single[at]))
        for c in range(3):
            np.subtract.at(degree, cells[keys, c], 1)
            np.bitwise_xor.at(held, cells[keys, c], keys)
        left -= len(keys)
    return layers


def in_fuse(keys: np.ndarray, seed: int, segment: int, count: int, table: bytes) -> np.ndarray:
    """Whether the filter has each key: always for its own, in 1 of 256 cases for others."""
    h = _mixed(keys, seed)
    three, held = _cells(h, segment, count), np.frombuffer(table, np.uint8)
    return _prints(h) == held[three[:, 0]] ^ held[three[:, 1]] ^ held[three[:, 2]]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _sharded(keys: DataFrame, shards: int) -> DataFrame:
    return keys.select("digest", F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"))


def build_filter(keys: DataFrame, shards: int) -> DataFrame:
    """The filter of a snapshot with these distinct digests: one row per shard."""
    ship(keys.sparkSession)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        seed, segment, count, table = build_fuse(frame["digest"].to_numpy(np.int64))
        seed -= (seed >> 63) << 64
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "seed": seed, "segment": segment, "count": count, "cells": [table]})

    return _sharded(keys, shards).groupBy("shard").applyInPandas(build, "shard bigint, seed bigint, segment bigint, count bigint, cells binary")


def screen(keys: DataFrame, snapshot: DataFrame, shards: int) -> DataFrame:
    """Digests that a snapshot's filter lets through."""
    ship(keys.sparkSession)

    def test(_, filters: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        if filters.empty or frame.empty:
            return frame[["digest"]].iloc[:0]
        f = filters.iloc[0]
        digests = frame["digest"].to_numpy(np.int64)
        return frame[["digest"]][in_fuse(digests, int(f["seed"]) & _MASK64, int(f["segment"]), int(f["count"]), f["cells"])]

    return snapshot.groupBy("shard").cogroup(_sharded(keys, shards).groupBy("shard")).applyInPandas(test, "digest bigint")


def suspects(rows: DataFrame, batches: int) -> DataFrame:
    """Distinct digests that may stand for more than one row, batch after batch."""
    found: list[DataFrame] = []
    snapshots: list[tuple[DataFrame, int]] = []
    for batch in range(batches):
        own = stored(rows.filter(F.col("batch") == batch).groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "dedup-batch")
        found.append(own.filter("n > 1").select("digest"))
        found += [screen(own, snapshot, shards) for snapshot, shards in snapshots]
        if batch + 1 < batches:
            shards = 1 + own.count() // SHARD_KEYS
            snapshots.append((stored(build_filter(own, shards), "dedup-filter"), shards))
    union = found[0]
    for other in found[1:]:
        union = union.unionByName(other)
    return union.distinct()


def dedupe(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, row), one row per document; row is row_key("text")."""
    text = docs.select("doc_id", row_key("text").alias("row"), normalised(F.col("text")).alias("norm"))
    digest = F.xxhash64("norm")
    rows = stored(
        text.select(
            "doc_id",
            "row",
            digest.alias("digest"),
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch"),
        ),
        "dedup-digests",
    )
    found = stored(suspects(rows, batches), "dedup-suspects")
    near = maybe_in(text.withColumn("digest", digest), Bitmap(found))
    equal = (
        near.groupBy("digest", "norm")
        .agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
        .select("digest", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"), "keep", "size")
    )
    joined = rows.join(equal, ["digest", "text_sha256"], "left")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        "row",
    )


def query(docs: DataFrame) -> DataFrame:
    return dedupe(docs).drop("row")


SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm
)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""
