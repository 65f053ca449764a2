"""Vectors as integers: which rows are usable, and how they reach the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest integer component: a squared distance of 64 components then fits a long.
LARGEST = 1 << 27


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector is there, has ``dims`` components, and all are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == dims) & finite, F.lit(False))


def kept(rows: DataFrame, vector: str, dims: int, **columns: str) -> DataFrame:
    """The named columns (new name = old name) of usable rows, and ``vector`` as array<double>."""
    named = [F.col(old).alias(new) for new, old in columns.items()]
    return rows.filter(usable(F.col(vector), dims)).select(*named, F.col(vector).cast("array<double>").alias("vector"))


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component; a component beyond ``LARGEST`` has no squared distance that fits a long."""
    scaled = np.floor(float(scale) * values)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError(f"a component times {scale} lies beyond {LARGEST}")
    return scaled.astype(np.int64)


def matrix(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """The integers of an Arrow column of vectors, a row each."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return floors(values.reshape(-1, dims), scale)


def summed(rows: DataFrame, totals: str, size: int) -> np.ndarray:
    """Sums over the rows of an array column of ``size`` longs, place by place; null arrays count as zeros."""
    places = rows.filter(F.col(totals).isNotNull()).select(F.posexplode(totals).alias("place", "value"))
    found = np.zeros(size, np.int64)
    for place, value in places.groupBy("place").agg(F.sum("value")).collect():  # one row per place
        found[place] = value
    return found


def last_marked(results: Iterator[dict], marks: Callable[[], dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of a task as batches; the last one also carries what the task has summed up."""
    before = None
    for row in results:
        if before is not None:
            yield pa.RecordBatch.from_pylist([before], schema=schema)
        before = row
    if before is not None:
        yield pa.RecordBatch.from_pylist([before | marks()], schema=schema)
