"""Text files and inline rows as staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.schemas import ENTITIES
from siltworks.sources.tables import split_by_verdict


# Column that holds the text of a line with too many or too few fields.
LINE = "_line"
ACCEPTED, REJECTED = "accepted", "rejected"


def read_lines(spark: SparkSession, path: str | list[str], entity: str, multi_line: bool = True, header: bool = True) -> DataFrame:
    """Header CSV as all-text columns, and ``_line``: the text of a line whose fields don't fit, else null.

    The schema is declared, so nothing is inferred and leading zeros survive. Columns are
    taken by position; ``enforceSchema`` keeps the file's header spelling out of it.

    A quote within quotes is written twice. ``multi_line`` reads line breaks within quotes as part of the field; a file is then read by one
    task, so a large extract should come as several files. Files that are known to hold a record a line are split without it.
    ``header`` says whether the first line of a file names the columns. All columns are read, whatever is used later, as fields are only counted then.
    """
    schema = T.StructType([*ENTITIES[entity].text_schema.fields, T.StructField(LINE, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("columnPruning", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_staging_csv(spark: SparkSession, path: str | list[str], entity: str, multi_line: bool = True) -> DataFrame:
    """The well-formed lines of a header CSV as a staging table; ``stage_csv`` keeps the others as well."""
    lines = read_lines(spark, path, entity, multi_line)
    return lines.filter(F.col(LINE).isNull()).drop(LINE)


def stage_csv(
    spark: SparkSession,
    path: str | list[str],
    entity: str,
    target: str,
    multi_line: bool = True,
    counts: Observation | None = None,
    *measures: Column,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Copy a file into a folder of its own, read once: (staging table, text of the rejected lines).

    ``measures`` over the accepted rows are gathered in ``counts`` while they are written, next to their number (``rows``) and
    that of rejected lines (``rejected``). A write that fails leaves neither rows nor counts.
    """
    lines = read_lines(spark, path, entity, multi_line, header)
    fits = F.col(LINE).isNull()
    told = lines.withColumn("verdict", F.when(fits, ACCEPTED).otherwise(REJECTED))
    if counts is not None:
        told = told.observe(counts, F.count_if(fits).alias("rows"), F.count_if(~fits).alias("rejected"), *measures)
    stored = split_by_verdict(told, target)
    accepted = stored.filter(F.col("verdict") == ACCEPTED).select(*ENTITIES[entity].columns)
    return accepted, stored.filter(F.col("verdict") == REJECTED).select(F.col(LINE).alias("line"))


def rows(spark: SparkSession, values: list[tuple], schema: str) -> DataFrame:
    """Inline constant rows, e.g. a rule catalog. For literals only, never for data."""
    return spark.createDataFrame(values, schema)


def generate_days(spark: SparkSession, start: str, days: int) -> DataFrame:
    """``days`` consecutive dates from ``start`` on, produced by the executors."""
    first = F.to_date(F.lit(start))
    return spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("full_date"))


def evolve(df: DataFrame, column: str, type_name: str, default=None) -> DataFrame:
    """Add a column with a default unless the table has it already."""
    if column in df.columns:
        return df
    return df.withColumn(column, F.lit(default).cast(type_name))
