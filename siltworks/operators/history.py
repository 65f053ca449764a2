"""Versioned history: closing changed versions and adding new ones from partial batches.

``active`` marks the current version of a key. A batch is partial: a key it does not name is
unchanged. Keys of a batch must be unique (see ``integrity.require_unique``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import all_of, any_of, differs
from siltworks.operators.integrity import Names, _names
from siltworks.sources.tables import stamp


def current_rows(history: DataFrame) -> DataFrame:
    """Versions in force; a null flag is not in force."""
    return history.filter("active")


def _incoming(batch: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    return batch.select(*[F.col(c).alias(f"_in_{c}") for c in [*keys, *attributes]])


def _same_key(keys: list[str]) -> Column:
    return all_of([F.col(k) == F.col(f"_in_{k}") for k in keys])


def _attributes_differ(attributes: list[str]) -> Column:
    return any_of([differs(F.col(a), F.col(f"_in_{a}")) for a in attributes])


def _met(history: DataFrame, batch: DataFrame, keys: list[str], attributes: list[str]) -> DataFrame:
    """Current versions of the keys a batch names.

    A semi join, so that Spark can broadcast a small batch and leave the history unshuffled.
    Whatever follows works on no more rows than the batch has.
    """
    return current_rows(history).select(*keys, *attributes).join(batch.select(*keys), keys, "left_semi")


def changed(history: DataFrame, batch: DataFrame, key: Names, attributes: list[str]) -> DataFrame:
    """Current versions that the batch contradicts, null-safe, as they stand in the history."""
    keys = _names(key)
    joined = current_rows(history).join(_incoming(batch, keys, attributes), _same_key(keys))
    return joined.filter(_attributes_differ(attributes)).select(*history.columns)


def classify(history: DataFrame, batch: DataFrame, key: Names, attributes: list[str]) -> DataFrame:
    """The batch with ``status`` inserted, updated or unchanged."""
    keys = _names(key)
    known = _incoming(_met(history, batch, keys, attributes), keys, attributes).withColumn("_known", F.lit(True))
    status = (
        F.when(F.col("_known").isNull(), "inserted")
        .when(_attributes_differ(attributes), "updated")
        .otherwise("unchanged")
    )
    return batch.join(known, _same_key(keys), "left").select(*batch.columns, status.alias("status"))


def next_versions(
    history: DataFrame, batch: DataFrame, key: Names, attributes: list[str], load_ts: datetime | None = None
) -> DataFrame:
    """Everything a batch makes of the versions in force: those it closes, and all that are in
    force afterwards. Versions closed earlier are not part of it and are not read.

    One join by key: a current version is kept, or closed and followed by its successor; a key
    without a current version gets its first. Keys are unique on both sides, so none is hot.
    """
    keys = _names(key)
    moment = F.lit(load_ts).cast("timestamp") if load_ts else F.current_timestamp()
    types = {f.name: f.dataType for f in history.schema.fields}

    incoming = _incoming(batch, keys, attributes).withColumn("_named", F.lit(True))
    known, named = F.col("_known").isNotNull(), F.col("_named").isNotNull()
    contradicted = known & named & _attributes_differ(attributes)
    given = {c: F.col(f"_in_{c}") for c in [*keys, *attributes]}
    given |= {"load_date": moment, "active": F.lit(True)}

    def version(values: dict[str, Column]) -> Column:
        return F.struct(
            *[values.get(c, F.lit(None)).cast(data_type).alias(c) for c, data_type in types.items()]
        )

    kept = version({c: F.col(c) for c in types} | {"active": ~contradicted})
    versions = (
        F.when(~known, F.array(version(given))).when(contradicted, F.array(kept, version(given))).otherwise(F.array(kept))
    )
    current = current_rows(history).withColumn("_known", F.lit(True))
    return current.join(incoming, _same_key(keys), "full").select(F.inline(versions))


def apply_changes(
    history: DataFrame, batch: DataFrame, key: Names, attributes: list[str], load_ts: datetime | None = None
) -> DataFrame:
    """The history after a batch: changed versions closed, new versions in force.

    Versions closed earlier pass through without a join, however many one key has. Unchanged
    rows are not repeated, so the same batch applied twice changes nothing.
    """
    closed = history.filter(~F.coalesce(F.col("active"), F.lit(False)))
    return closed.unionByName(next_versions(history, batch, key, attributes, load_ts))


def new_rows(history: DataFrame, batch: DataFrame, key: Names) -> DataFrame:
    """Rows of the batch whose key has no current version; only keys of the history are read."""
    keys = _names(key)
    return batch.join(_met(history, batch, keys, []), keys, "left_anti")


def append_if_absent(
    history: DataFrame, batch: DataFrame, key: Names, attributes: list[str], load_ts: datetime | None = None
) -> DataFrame:
    """Add each row of the batch unless an identical version is in force; nothing is closed."""
    keys = _names(key)
    identical = _same_key(keys) & all_of([F.col(a).eqNullSafe(F.col(f"_in_{a}")) for a in attributes])
    current = _incoming(_met(history, batch, keys, attributes), keys, attributes)
    absent = batch.join(current, identical, "left_anti").select(*keys, *attributes).withColumn("active", F.lit(True))
    return history.unionByName(stamp(absent, load_ts), allowMissingColumns=True)


def change_counts(history: DataFrame, batch: DataFrame, key: Names, attributes: list[str]) -> DataFrame:
    """Rows of the batch per status."""
    statuses = classify(history, batch, key, attributes)
    return statuses.groupBy("status").agg(F.count(F.lit(1)).alias("row_count"))
