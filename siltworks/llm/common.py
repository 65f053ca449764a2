"""Helpers shared by the operators: written tables, batch maps and row keys."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import chunk_encoder
from siltworks.session import scratch_path

# Bytes of results that a task gathers before it hands them on.
BATCH_BYTES = 8_000_000
# Bytes of a batch that are Python values at once.
SLICE_BYTES = 4_000_000
# Least and most bits of a bitmap that keeps rows out of a shuffle: 2 and 32 MB.
BITMAP_BITS, MOST_BITS = 1 << 24, 1 << 28


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back: its lineage ends here."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers of every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted(package.rglob("*.py")):
            file.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


# Bytes of a text that are words at once.
PIECE_BYTES = 1_000_000
_BETWEEN_WORDS = re.compile(rb"[ \t-\r]")


def word_pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A text in pieces of about ``size`` bytes that end before white space, so that no word is cut."""
    at = 0
    while at < len(data):
        found = _BETWEEN_WORDS.search(data, at + size) if len(data) - at > size else None
        end = found.start() if found else len(data)
        yield data[at:end]
        at = end


def row_key(*columns: str) -> Column:
    """64-bit hash of the named columns. With doc_id it tells rows apart whose decisions may differ."""
    return F.xxhash64(*[F.col(c) for c in columns])


def release(run: str | None = None) -> None:
    """Gives back what earlier tasks of this worker have left, but for the encoders of the named run."""
    chunk_encoder.forget(run)
    gc.collect()
    pa.default_memory_pool().release_unused()


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, few enough at once that their Python values take little memory."""
    rows = max(1, batch.num_rows * SLICE_BYTES // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_rows(
    df: DataFrame, make: Callable[[Iterator[dict[str, list]]], Iterator[tuple]], schema: str, run_id: str | None = None
) -> DataFrame:
    """Runs ``make`` once per partition: batches come as columns of Python values, results go as tuples.

    ``run_id`` names the run whose encoders earlier tasks may have left in the worker; all others are dropped.
    """
    ship(df.sparkSession)
    fields = df.sparkSession.createDataFrame([], schema).schema.fields
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    target = pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release(run_id)
        columns = ({n: c.to_pylist() for n, c in zip(b.schema.names, b.columns)} for whole in batches for b in slices(whole))
        held, size = [], 0
        for row in make(columns):
            held.append(row)
            size += 40 + sum(len(v) for v in row if isinstance(v, (bytes, str)))
            if size >= BATCH_BYTES:
                yield _batch(held, target)
                held, size = [], 0
        if held:
            yield _batch(held, target)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), target.types)], schema=target)


class Bitmap:
    """The bits of a table's 64-bit values in column ``digest``, which keep other rows out of a shuffle.

    It has 16 bits for each value, but no fewer than ``BITMAP_BITS`` and no more than ``MOST_BITS``, 32 MB: rows of 4 KB that
    can be broadcast whatever the table. Up to 16 million values it lets one row in sixteen through by chance; beyond that more, half of
    all rows at 180 million values, with the same result.
    """

    def __init__(self, digests: DataFrame):
        wanted = 16 * digests.count()
        self.bits = min(MOST_BITS, max(BITMAP_BITS, 1 << (wanted - 1).bit_length() if wanted else 0))
        bit = F.pmod("digest", F.lit(self.bits))
        self.rows = digests.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap"))


def maybe_in(rows: DataFrame, bitmap: Bitmap, wanted: bool = True) -> DataFrame:
    """Rows whose ``digest`` has its bit set, with some others by chance; or the rows whose bit is not set.

    Nulls count as not set.
    """
    bit = F.pmod("digest", F.lit(bitmap.bits))
    byte = F.conv(F.hex(F.expr("substring(bitmap, cast(bit_place div 8 + 1 as int), 1)")), 16, 10).cast("int")
    joined = rows.withColumn("bucket", F.bitmap_bucket_number(bit)).withColumn("bit_place", F.bitmap_bit_position(bit))
    joined = joined.join(F.broadcast(bitmap.rows), "bucket", "left")
    is_set = F.coalesce(F.call_function("shiftright", byte, F.expr("cast(bit_place % 8 as int)")).bitwiseAND(F.lit(1)), F.lit(0))
    return joined.filter(is_set == F.lit(int(wanted))).drop("bucket", "bit_place", "bitmap")


def without(docs: DataFrame, rejected: DataFrame, *columns: str) -> DataFrame:
    """The rows of ``docs``, all columns, that are not among the rejected (doc_id, row); row is row_key(*columns).

    Only rows that a bitmap can't rule out are shuffled for the exact comparison.
    """
    rejected = stored(rejected.select(F.col("doc_id").alias("out_id"), F.col("row").alias("out_row")).distinct(), "rejected")
    bitmap = Bitmap(rejected.select(F.xxhash64("out_id", "out_row").alias("digest")))
    row = row_key(*columns)
    tagged = docs.select(F.struct("*").alias("own"), row.alias("row"), F.xxhash64(F.col("doc_id"), row).alias("digest"))
    near = maybe_in(tagged, bitmap).join(rejected, F.col("own.doc_id").eqNullSafe(F.col("out_id")) & (F.col("row") == F.col("out_row")), "left_anti")
    return maybe_in(tagged, bitmap, wanted=False).select("own.*").union(near.select("own.*"))


def one_per_group(docs: DataFrame, found: DataFrame, group: str) -> DataFrame:
    """One row of ``docs`` for each ``group`` of found (doc_id, row, kept, group), a row per document; row is row_key("text").

    Of a group's kept rows, which have one doc_id, the one with the least row key stays; of its
    repeats, the least by all columns. Repeats are put together within each task first.
    """
    staying = found.filter("kept").groupBy("doc_id", "row", group).agg(F.count(F.lit(1)).alias("n"))
    staying = stored(staying, "staying")
    several = staying.groupBy(group).agg(F.min("row").alias("first"), F.sum("n").alias("total")).filter("total > 1").drop("total")
    several = stored(staying.join(stored(several, "several-groups"), group), "several")
    again = several.filter("row = first AND n > 1").select(F.col("doc_id").alias("again_id"), F.col("row").alias("again_row"))
    out = found.filter("NOT kept").select("doc_id", "row").unionByName(several.filter("row <> first OR n > 1").select("doc_id", "row"))
    bitmap = Bitmap(again.select(F.xxhash64("again_id", "again_row").alias("digest")))
    row = row_key("text")
    tagged = docs.select(F.struct("*").alias("own"), row.alias("row"), F.xxhash64(F.col("doc_id"), row).alias("digest"))
    least = maybe_in(tagged, bitmap).groupBy(F.col("own.doc_id").alias("doc_id"), "row").agg(F.min("own").alias("own"))
    least = least.join(again, F.col("doc_id").eqNullSafe(F.col("again_id")) & (F.col("row") == F.col("again_row")), "left_semi")
    return without(docs, out, "text").union(least.select("own.*"))
