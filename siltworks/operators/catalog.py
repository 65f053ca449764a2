"""Catalog tables: relations, insert-if-absent, corrections by condition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import all_of
from siltworks.operators.cleaning import update_where
from siltworks.schemas import RELATIONS
from siltworks.sources.staging import rows


def relations_frame(spark: SparkSession, relations: list[tuple[str, str, str, str]] = RELATIONS) -> DataFrame:
    """The relation catalog as a table; the same list drives ``relationship_check``."""
    return rows(
        spark,
        [(*relation, "FK") for relation in relations],
        "parent_entity string, parent_column string, child_entity string, child_column string, relation_type string",
    )


def insert_if_absent(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The table with those new rows added whose key it lacks; columns are matched by name.

    Only the keys of the table are read for the lookup, and only those the new rows name go on.
    """
    met = table.select(*keys).join(new.select(*keys), keys, "left_semi")
    lookup = met.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    absent = new.join(lookup, all_of([F.col(k) == F.col(f"_known_{k}") for k in keys]), "left_anti")
    return table.unionByName(absent, allowMissingColumns=True)


def update_and_list(df: DataFrame, condition: Column, column: str, value, listed: Column) -> tuple[DataFrame, DataFrame]:
    """Rewrite a column where the condition holds; also the rows to look at afterwards."""
    updated = update_where(df, condition, column, value)
    return updated, updated.filter(listed)
