"""Corrections of staged text and of named attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import (
    UNSIGNED_NUMBER,
    all_of,
    any_of,
    empty_to_null,
    guarded_number,
    null_token,
    strip_characters,
)
from siltworks.schemas import COUNTRY_SYMBOLS, NUMBER_TYPE


def null_tokens(df: DataFrame, columns: list[str], token: str = "NULL") -> DataFrame:
    """Turn the token into a real null in the listed columns."""
    return df.withColumns({c: null_token(c, token) for c in columns})


def null_token_counts(df: DataFrame, columns: list[str], token: str = "NULL") -> DataFrame:
    """Values that ``null_tokens`` would change, per column, and rows touched; one scan."""
    hits = {c: F.col(c) == token for c in columns}
    return df.agg(
        F.count_if(any_of(list(hits.values()))).alias("rows_touched"),
        *[F.count_if(hit).alias(f"{c}_changed") for c, hit in hits.items()],
    )


def blanks_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: empty_to_null(c) for c in columns})


def strip_symbols(df: DataFrame, symbols: dict[str, str]) -> DataFrame:
    """Remove the given characters from the given columns."""
    return df.withColumns({c: strip_characters(c, characters) for c, characters in symbols.items()})


def clean_countries(df: DataFrame) -> DataFrame:
    """Country file ready for its cast: symbols removed, NULL text and empty text made null."""
    columns = [c for c in df.columns if c != "country_name"]
    symbols = {c: s for c, s in COUNTRY_SYMBOLS.items() if c in df.columns}
    return blanks_to_null(null_tokens(strip_symbols(df, symbols), columns), columns)


def recode(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    """Replace the listed values; every other value, null included, stays."""
    return df.replace(mapping, subset=[column])


def recode_with(df: DataFrame, column: str, mapping: DataFrame, source: str, target: str) -> DataFrame:
    """``recode`` for a mapping held in a table. Source values must be unique in it."""
    pairs = mapping.select(F.col(source).alias("_from"), F.col(target).alias("_to"))
    return (
        df.join(pairs, F.col(column) == F.col("_from"), "left")
        .withColumn(column, F.coalesce("_to", column))
        .select(*df.columns)
    )


def patch_by_key(df: DataFrame, patches: DataFrame, keys: str | list[str]) -> DataFrame:
    """Overwrite attributes of the rows a patch names; a null in a patch leaves the value alone."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    attributes = [c for c in patches.columns if c not in keys]
    renamed = patches.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(a).alias(f"_new_{a}") for a in attributes]
    )
    joined = df.join(renamed, all_of([F.col(k) == F.col(f"_key_{k}") for k in keys]), "left")
    return joined.withColumns({a: F.coalesce(f"_new_{a}", a) for a in attributes}).select(*df.columns)


def update_where(df: DataFrame, condition: Column, column: str, value) -> DataFrame:
    """Rewrite one column of the rows for which the condition is true."""
    return df.withColumn(column, F.when(condition, F.lit(value)).otherwise(F.col(column)))


def castable_numbers(df: DataFrame, column: str, pattern: str = UNSIGNED_NUMBER, target: str = NUMBER_TYPE) -> DataFrame:
    """Only the rows whose text has the pattern, with the column as a number."""
    return df.filter(F.col(column).rlike(pattern)).withColumn(column, guarded_number(column, pattern, target))
