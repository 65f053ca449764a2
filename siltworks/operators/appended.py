"""Tables that batches only add to: the row in force is the latest of its key.

A table is a base, in which each key has at most one row in force, and rows that batches have
appended, numbered by batch. A batch adds one row for each key that it creates or changes (or
takes away: ``gone``), in one file per task, and rewrites nothing. Readers put base and additions
together: the additions are small between two compactions, so Spark broadcasts their keys and the
base is read without a shuffle; if they are not, the same join shuffles by key. ``compacted`` rows become the next base.

Keys are unique within a batch and have no null part (``integrity.require_unique``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltworks.functions import any_of, differs
from siltworks.operators.integrity import Names, _names
from siltworks.sources.tables import stamp

# Number of the batch that added a row; 0 in a base.
BATCH = "_batch"
# Whether the row says that its key is no longer there.
GONE = "_gone"
STATUSES = ("inserted", "updated", "unchanged")


def as_base(df: DataFrame, removable: bool = False) -> DataFrame:
    """Rows as a base; ``removable`` if later batches may take keys away."""
    base = df.withColumn(BATCH, F.lit(0).cast("bigint"))
    return base.withColumn(GONE, F.lit(False)) if removable else base


def _latest(added: DataFrame, keys: list[str]) -> DataFrame:
    """The last addition of each key. A batch names a key once, so there are no ties."""
    row = F.struct(*added.columns)
    return added.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.max_by(row, BATCH).alias("row")).select("row.*")


def _keys_of(added: DataFrame, keys: list[str]) -> DataFrame:
    return added.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()


def _same(keys: list[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"_key_{k}"))
    return condition


def in_force(table: DataFrame, key: Names, plain: bool = False) -> DataFrame:
    """The row in force of every key, without the columns that only serve the merge.

    Closed versions in the base (``active`` false) are left out. ``plain`` says that the table has no additions.
    """
    keys = _names(key)
    base = table.filter(F.col(BATCH) == 0)
    if "active" in table.columns:
        base = base.filter("active")
    rows = base
    if not plain:
        added = table.filter(F.col(BATCH) > 0)
        rows = base.join(_keys_of(added, keys), _same(keys), "left_anti").unionByName(_latest(added, keys))
    if GONE in table.columns:
        rows = rows.filter(~F.col(GONE)).drop(GONE)
    return rows.drop(BATCH)


def history(table: DataFrame, key: Names, plain: bool = False) -> DataFrame:
    """Every version of every key, ``active`` only where nothing later has been added."""
    keys, columns = _names(key), [c for c in table.columns if c != BATCH]
    if plain:
        return table.select(*columns)
    added = table.filter(F.col(BATCH) > 0)
    last = added.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(F.max(BATCH).alias("_last"))
    # Versions closed in the base pass by without the join.
    base = table.filter(F.col(BATCH) == 0)
    closed = base.filter(~F.coalesce(F.col("active"), F.lit(False)))
    rest = base.filter("active").unionByName(added).join(last, _same(keys), "left")
    active = F.col("_last").isNull() | (F.col("_last") == F.col(BATCH))
    rest = rest.withColumn("active", F.coalesce("active", F.lit(False)) & active)
    return closed.select(*columns).unionByName(rest.select(*columns))


def additions(
    current: DataFrame,
    batch: DataFrame,
    key: Names,
    attributes: list[str],
    number: int,
    load_ts: datetime | None = None,
    counts: Observation | None = None,
) -> DataFrame:
    """What a batch adds to a history: its rows that are new or differ from the version in force.

    The versions in force are met by a semi join on the batch's keys, so a small batch is broadcast and the history
    read once, unshuffled. ``counts`` gathers the rows per status while the additions are written.
    """
    keys = _names(key)
    types = {f.name: f.dataType for f in current.schema.fields}
    met = current.select(*keys, *attributes).join(batch.select(*keys), keys, "left_semi")
    known = met.select(*[F.col(c).alias(f"_key_{c}") for c in [*keys, *attributes]]).withColumn("_known", F.lit(True))
    changed = any_of([differs(F.col(a), F.col(f"_key_{a}")) for a in attributes]) if attributes else F.lit(False)
    status = F.when(F.col("_known").isNull(), STATUSES[0]).when(changed, STATUSES[1]).otherwise(STATUSES[2])
    told = batch.join(known, _same(keys), "left").withColumn("_status", status)
    if counts is not None:
        told = told.observe(counts, *[F.count_if(F.col("_status") == s).alias(s) for s in STATUSES])
    rows = stamp(told.filter(F.col("_status") != STATUSES[2]).select(*batch.columns).withColumn("active", F.lit(True)), load_ts)
    given = [(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
    return rows.select(*given, F.lit(number).cast("bigint").alias(BATCH))
