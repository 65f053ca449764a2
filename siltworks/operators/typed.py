"""Text staging to typed staging, strict or with quarantine."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import any_of, flag_to_int, hex_to_binary, null_token
from siltworks.schemas import ENTITIES, NUMBER_TYPE, Entity
from siltworks.sources.staging import ACCEPTED, REJECTED
from siltworks.sources.tables import split_by_verdict

_SIZED = re.compile(r"(text|clip)\((\d+)\)")


class TypedColumn:
    """Typed form of one staging column and the test of whether its text can take it."""

    def __init__(self, entity: Entity, column: str):
        self.source = column
        self.name = entity.typed_name(column)
        kind = entity.columns[column]
        text = F.col(column)
        if column in entity.null_tokens:
            text = null_token(text)
        if column in entity.trimmed:
            text = F.trim(text)
        if entity.name == "countries":
            text = F.nullif(text, F.lit(""))
        sized = _SIZED.fullmatch(kind)
        self.too_long: Column | None = None
        if kind == "text":
            self.strict = self.lenient = text
        elif sized and sized.group(1) == "clip":
            self.strict = self.lenient = F.substring(text, 1, int(sized.group(2)))
        elif sized:
            limit = int(sized.group(2))
            self.too_long = F.length(text) > limit
            message = F.concat(F.lit(f"{self.name} longer than {limit}: "), text)
            self.strict = F.when(self.too_long, F.raise_error(message).cast("string")).otherwise(text)
            self.lenient = F.when(~self.too_long, text)
        elif kind == "hex":
            self.strict, self.lenient = hex_to_binary(text, strict=True), hex_to_binary(text)
        elif kind == "flag":
            self.strict = flag_to_int(text)
            self.lenient = flag_to_int(text, cast=lambda c: c.try_cast("int"))
        else:
            target = NUMBER_TYPE if kind == "number" else kind
            self.strict, self.lenient = text.cast(target), text.try_cast(target)
        self.failed = text.isNotNull() & self.lenient.isNull()


def typed_columns(entity: str) -> list[TypedColumn]:
    spec = ENTITIES[entity]
    return [TypedColumn(spec, c) for c in spec.columns]


def to_typed(df: DataFrame, entity: str) -> DataFrame:
    """Cast a staging table to its typed shape; the first text that cannot be cast fails the job, as an ANSI cast does."""
    return df.select(*[c.strict.alias(c.name) for c in typed_columns(entity)])


def judged(df: DataFrame, entity: str) -> DataFrame:
    """Every row with its typed columns, its ``verdict``, and, if it is rejected, its text and the failing columns.

    Each field is cast once, to a struct of its value and whether the text could not take the type.
    """
    columns = typed_columns(entity)
    cast = [F.struct(c.lenient.alias("value"), F.col(c.source).alias("text"), c.failed.alias("failed")).alias(f"_{i}") for i, c in enumerate(columns)]
    failed = [F.col(f"_{i}.failed") for i in range(len(columns))]
    rejected = any_of(failed)
    names = F.array_compact(F.array(*[F.when(f, F.lit(c.name)) for f, c in zip(failed, columns)]))
    text = F.struct(*[F.col(f"_{i}.text").alias(c.source) for i, c in enumerate(columns)])
    return df.select(*cast).select(
        *[F.when(~rejected, F.col(f"_{i}.value")).alias(c.name) for i, c in enumerate(columns)],
        F.when(rejected, text).alias("_text"),
        F.when(rejected, names).alias("_failed_columns"),
        F.when(rejected, REJECTED).otherwise(ACCEPTED).alias("verdict"),
    )


def quarantine(df: DataFrame, entity: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected rows), written to ``path`` in one pass over the staging table, a folder each.

    A row with any uncastable text is kept as text, with the names of the failing columns, and is not loaded.
    """
    stored = split_by_verdict(judged(df, entity), path)
    good = stored.filter(F.col("verdict") == ACCEPTED).select(*[c.name for c in typed_columns(entity)])
    return good, stored.filter(F.col("verdict") == REJECTED).select("_text.*", F.col("_failed_columns").alias("failed_columns"))
