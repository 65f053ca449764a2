"""Parquet tables: batch folders, full refresh, append, and published versions."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER_SCHEMA = "table string, folders array<string>, schema string, number long"


def stamp(df: DataFrame, load_ts: datetime | None = None) -> DataFrame:
    moment = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    return df.withColumn("load_date", moment)


def load_overwrite(df: DataFrame, path: str, load_ts: datetime | None = None, partition_by: tuple[str, ...] = ()) -> None:
    """Full refresh of a table folder, each row stamped with its arrival.

    The data must not be read from ``path`` itself; use a VersionedStore for that.
    """
    writer = stamp(df, load_ts).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def load_append(df: DataFrame, path: str, load_ts: datetime | None = None) -> None:
    stamp(df, load_ts).write.mode("append").parquet(path)


def batch_path(root: str, entity: str, batch_id: str) -> str:
    return f"{root}/{entity}/batch_id={batch_id}"


def reset_staging(df: DataFrame, root: str, entity: str, batch_id: str) -> DataFrame:
    """Write a batch to its own folder, replacing an earlier try of the same batch only.

    Other batches stay as they are, so there is nothing to empty before a new one.
    """
    path = batch_path(root, entity, batch_id)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_by_verdict(df: DataFrame, path: str) -> DataFrame:
    """Rows with a text column ``verdict``, written once, a folder per verdict; read back, a filter on it opens its folder only."""
    df.write.mode("overwrite").partitionBy("verdict").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class ConflictError(RuntimeError):
    """Another writer has published in the meantime."""


@dataclass(frozen=True)
class Version:
    """The folders that make up a table, oldest first, and the columns of its rows.

    The first folder is the base; later ones hold rows that batches have added (``operators.appended``).
    """

    folders: tuple[str, ...]
    schema: str

    def followed_by(self, added: Version) -> Version:
        return Version(self.folders + added.folders, self.schema)


class VersionedStore:
    """Tables whose readers see only published versions: write, point, read.

    Each write goes to a new folder. Publishing writes one small pointer file that lists the folders of
    all tables, under the next number; Spark's commit makes it appear whole or not at all, and
    the highest number is in force. A batch that fails or is rejected leaves all tables as they were,
    and tables published together change together.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._pointers = f"{root}/pointer"

    def write(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = (), rebalance: bool = False) -> Version:
        """Store a candidate version; it is not visible to readers yet.

        ``rebalance`` first gathers the rows of a partition into evenly sized tasks, large
        partitions into several, instead of a small file per task and partition.
        """
        folder = f"{table}/{uuid.uuid4().hex}"
        rows = df.hint("rebalance", *partition_by) if rebalance else df
        writer = rows.write.mode("errorifexists").option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.root}/{folder}")
        return Version((folder,), df.schema.json())

    def read(self, version: Version) -> DataFrame:
        """A version under its recorded schema, so that an empty one can be read as well."""
        schema = T.StructType.fromJson(json.loads(version.schema))
        if not version.folders:
            return self.spark.createDataFrame([], schema)
        # Folders are read one by one in the plan, as only the base may be partitioned.
        frames = [self.spark.read.schema(schema).parquet(f"{self.root}/{f}").select(*schema.names) for f in version.folders[:1]]
        if added := version.folders[1:]:
            frames.append(self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in added]).select(*schema.names))
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def published(self) -> dict[str, Version]:
        """Version in force per table."""
        return self._last()[1]

    def _last(self) -> tuple[int, dict[str, Version]]:
        try:
            pointers = self.spark.read.schema(POINTER_SCHEMA).parquet(self._pointers)
            number = pointers.agg(F.max("number")).first()[0] or 0
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        rows = pointers.filter(F.col("number") == number).collect()  # a row per table
        return number, {r.table: Version(tuple(r.folders), r.schema) for r in rows}

    def publish(self, versions: dict[str, Version], expected: dict[str, Version] | None = None) -> None:
        """Put the versions in force, all in one step; other tables keep theirs.

        ``expected`` gives the versions in force that they were made from. If any of these tables
        has changed since, or another writer takes the same number, nothing is
        published and ConflictError raised: the batch has to be applied again. This is a check before
        the write: of two writers that pass it at the same moment, one may be lost.
        """
        number, now = self._last()
        moved = [t for t in versions if expected is not None and now.get(t) != expected.get(t)]
        if moved:
            raise ConflictError(f"changed by another writer: {', '.join(sorted(moved))}")
        rows = [(table, list(v.folders), v.schema) for table, v in {**now, **versions}.items()]
        pointer = self.spark.createDataFrame(rows, POINTER_SCHEMA.removesuffix(", number long"))
        try:
            pointer.coalesce(1).write.mode("errorifexists").parquet(f"{self._pointers}/number={number + 1}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise ConflictError(f"another writer published as number {number + 1}") from error

    def current(self, table: str) -> DataFrame | None:
        """The published version, or None before the first publication."""
        version = self.published().get(table)
        return self.read(version) if version else None
