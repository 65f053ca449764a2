"""Key, referential and consistency checks.

A hot key may hold a large share of a table, so every check that only needs counts aggregates
by key before any join; Spark combines those counts on the map side.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import NOT_PRINTABLE_ASCII, all_of, any_of, is_blank, normalised_name

Names = str | list[str]


def _names(value: Names) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def union_all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def pk_blank_count(df: DataFrame, keys: Names, table: str) -> DataFrame:
    """Rows in which any part of the key is null or blank."""
    blank = any_of([is_blank(k) for k in _names(keys)])
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(blank).alias("blank_rows")).select(
        F.lit(table).alias("table_name"), "total_rows", "blank_rows"
    )


def pk_malformed(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with a malformed key part: the parts as text and the length of each.

    ``rules`` gives, per key column, the condition that makes it malformed.
    """
    lengths = [F.length(F.col(k).cast("string")).alias(f"{k}_length") for k in rules]
    return df.filter(any_of(list(rules.values()))).select(*rules, *lengths)


def pk_duplicates(df: DataFrame, keys: Names) -> DataFrame:
    """Keys that occur more than once, null keys being one group, with their count."""
    return df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def require_unique(df: DataFrame, keys: Names, what: str) -> None:
    """Fail when a key is repeated or has a null part. Brings back at most one offending key."""
    missing = any_of([F.col(k).isNull() for k in _names(keys)])
    groups = df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("occurrences"))
    wrong = groups.filter((F.col("occurrences") > 1) | missing).take(1)
    if wrong:
        found = wrong[0].asDict()
        raise ValueError(f"{what}: {'repeated' if found['occurrences'] > 1 else 'null in'} key {found}")


def parent_keys(parent: DataFrame, keys: Names, normalise: Callable | None = None) -> DataFrame:
    """Key values of a parent under neutral names."""
    convert = normalise or F.col
    return parent.select(*[convert(k).alias(f"_parent_{i}") for i, k in enumerate(_names(keys))])


def fk_orphans(
    child: DataFrame,
    columns: Names,
    parent: DataFrame,
    keys: Names,
    normalise: Callable | None = None,
    repeated_parent: bool = False,
) -> DataFrame:
    """Child rows whose complete foreign key has no parent.

    With ``normalise`` (for instance ``normalised_name``) both sides are compared in that form
    and empty text is not checked. A self reference is the same call with one table twice.

    The child meets the parent in a plain anti join, the form in which Spark splits a hot child
    key over several tasks. A parent that may repeat its keys often is reduced to distinct
    values first (``repeated_parent``), on the map side as far as possible.
    """
    columns = _names(columns)
    convert = normalise or F.col
    present = [F.col(c).isNotNull() for c in columns]
    if normalise:
        present += [F.col(c) != "" for c in columns]
    wanted = parent_keys(parent, keys, normalise)
    if repeated_parent:
        wanted = wanted.distinct()
    match = all_of([convert(c) == F.col(f"_parent_{i}") for i, c in enumerate(columns)])
    return child.filter(all_of(present)).join(wanted, match, "left_anti")


def fk_orphan_count(
    child: DataFrame, columns: Names, parent: DataFrame, keys: Names, normalise: Callable | None = None
) -> DataFrame:
    """One row: child rows, and those without a parent; ``normalise`` as in ``fk_orphans``.

    The child is reduced to one row per key value first, so the join carries distinct values.
    """
    columns = _names(columns)

    def compared(column: str) -> Column:
        return F.when(F.col(column) != "", normalise(column)) if normalise else F.col(column)

    values = child.groupBy(*[compared(c).alias(f"_child_{i}") for i, c in enumerate(columns)]).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    wanted = parent_keys(parent, keys, normalise).distinct().withColumn("_found", F.lit(True))
    match = all_of([F.col(f"_child_{i}") == F.col(f"_parent_{i}") for i in range(len(columns))])
    complete = all_of([F.col(f"_child_{i}").isNotNull() for i in range(len(columns))])
    orphan = complete & F.col("_found").isNull()
    return values.join(wanted, match, "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("child_rows"),
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).alias("orphan_rows"),
    )


@dataclass(frozen=True, eq=False)
class Link:
    """A column of a child that must find its value in a column of a parent."""

    child: DataFrame
    column: str
    parent: DataFrame
    key: str
    normalise: Callable | None = None

    @property
    def kind(self) -> T.DataType:
        """The type in which both sides are compared, as Spark would choose it."""
        types = [self.child.schema[self.column].dataType, self.parent.schema[self.key].dataType]
        if types[0] == types[1]:
            return types[0]
        both = F.coalesce(*[F.lit(None).cast(t) for t in types]).alias("both")
        return self.child.sparkSession.range(0).select(both).schema["both"].dataType

    def child_value(self) -> Column:
        compared = F.when(F.col(self.column) != "", self.normalise(self.column)) if self.normalise else F.col(self.column)
        return compared.cast(self.kind)

    def parent_value(self) -> Column:
        compared = self.normalise(self.key) if self.normalise else F.col(self.key)
        return compared.cast(self.kind).cast("string")


def orphan_counts(links: list[Link]) -> DataFrame:
    """A row per link, numbered as listed: child rows, and those whose value no parent has.

    A child is read once, however many links it has: its rows are counted by the values of each column alone, a grouping
    set per link, on the map side first, so a hot value costs no more than any other. The counts of all children, as (link, value),
    meet the values of all parents, stacked alike, in one join. A parent column that serves several links is read once.
    """
    children: dict[int, list[int]] = {}
    parents: dict[tuple, int] = {}
    wanted, of = [], []
    for number, link in enumerate(links):
        children.setdefault(id(link.child), []).append(number)
        same = (id(link.parent), link.key, link.normalise, link.kind.simpleString())
        if same not in parents:
            parents[same] = len(parents)
            wanted.append(link.parent.select(F.lit(parents[same]).alias("parent"), link.parent_value().alias("wanted")).distinct())
        of.append(parents[same])
    counted = []
    for numbers in children.values():
        names = [f"_v{n}" for n in numbers]
        values = links[numbers[0]].child.select(*[links[n].child_value().alias(name) for n, name in zip(numbers, names)])
        rows, one = F.count(F.lit(1)).alias("_rows"), len(names) == 1
        values = values.groupBy(*names).agg(rows) if one else values.groupingSets([[name] for name in names], *names).agg(rows, F.grouping_id().alias("_set"))
        which, of_which, value = F.lit(numbers[0]), F.lit(of[numbers[0]]), F.col(names[0]).cast("string")
        for k in range(1, len(names)):
            mine = F.col("_set") == ((1 << len(names)) - 1) ^ (1 << (len(names) - 1 - k))
            which, of_which = F.when(mine, numbers[k]).otherwise(which), F.when(mine, of[numbers[k]]).otherwise(of_which)
            value = F.when(mine, F.col(names[k]).cast("string")).otherwise(value)
        counted.append(values.select(which.alias("link"), of_which.alias("of"), value.alias("value"), "_rows"))
    counts = union_all(counted)
    found = union_all(wanted).withColumn("_found", F.lit(True))
    met = counts.join(found, (F.col("of") == F.col("parent")) & (F.col("value") == F.col("wanted")), "left")
    orphan = F.col("value").isNotNull() & F.col("_found").isNull()
    sums = met.groupBy("link").agg(F.sum("_rows").alias("child_rows"), F.sum(F.when(orphan, F.col("_rows")).otherwise(0)).alias("orphan_rows"))
    spark = links[0].child.sparkSession
    # As many rows as links; one whose child is empty has no counts.
    return spark.range(len(links)).select(F.col("id").cast("int").alias("number")).join(sums, F.col("number") == F.col("link"), "left").select(
        "number", F.coalesce("child_rows", F.lit(0)).alias("child_rows"), F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows")
    )


def relationship_check(
    relations: list[tuple[str, str, str, str]],
    tables: dict[str, DataFrame],
    parents: dict[str | tuple[str, str, str, str], DataFrame] | None = None,
) -> DataFrame:
    """Check every catalogued relation: one row each with child rows and orphan rows.

    A relation is (parent, parent column, child, child column). ``parents`` may give other
    frames for the parent side, such as a batch together with what is already in memory, by
    table or for one relation. Every child is read once. Country names are compared whatever
    their case and surrounding spaces.
    """
    given = parents or tables
    links = [
        Link(tables[r[2]], r[3], given[r] if r in given else given[r[0]], r[1], normalised_name if r[1] == "country_name" else None)
        for r in relations
    ]
    spark = links[0].child.sparkSession
    named = spark.createDataFrame(
        [(n, *relation) for n, relation in enumerate(relations)],
        "number int, parent_entity string, parent_column string, child_entity string, child_column string",
    )
    return named.join(orphan_counts(links), "number").drop("number")


def unmatched_values_report(
    sources: dict[str, tuple[DataFrame, str, str]], parent: DataFrame, parent_column: str
) -> DataFrame:
    """Values of several tables that no parent name matches, ordered by table and value.

    ``sources`` gives per table its frame, its id column and its value column. The id closes
    the sort order, so that one frequent value can still be split over sort ranges.
    """
    found = []
    for table, (df, id_column, value_column) in sources.items():
        usable = df.filter(F.trim(F.col(value_column)) != "")
        orphans = fk_orphans(usable, value_column, parent, parent_column, normalised_name)
        found.append(
            orphans.select(
                F.lit(table).alias("source_table"),
                F.col(id_column).cast("string").alias("record_id"),
                F.col(value_column).alias("bad_value"),
            )
        )
    return union_all(found).orderBy("source_table", "bad_value", "record_id")


def near_duplicate_names(df: DataFrame, name: str, row_id: str) -> DataFrame:
    """Names equal but for case and surrounding spaces: one row per member of each group.

    Groups are counted on the map side; members meet the counts in a plain join, which Spark
    splits for a hot name. No task gathers a group.
    """
    members = df.select(normalised_name(name).alias("_name"), F.col(row_id).alias("id"), F.col(name).alias("spelling"))
    groups = (
        members.groupBy(F.col("_name").alias("name_key"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter("occurrences > 1")
    )
    return members.join(groups, F.col("_name").eqNullSafe(F.col("name_key"))).select("name_key", "occurrences", "id", "spelling")


def non_printable_ascii(df: DataFrame, columns: Names) -> DataFrame:
    """Rows in which a listed text is empty or holds anything but printable ASCII."""
    bad = [F.col(c).rlike(NOT_PRINTABLE_ASCII) | (F.col(c) == "") for c in _names(columns)]
    return df.filter(any_of(bad))
