"""Quality rules with error thresholds, their results, and the load gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.operators.integrity import Link, orphan_counts, union_all
from siltworks.sources.staging import rows
from siltworks.sources.tables import VersionedStore

# Fixed values stored in the results and the rule catalog.
REJECTED = "Rechazado"
APPROVED = "Aprobado"
COMPLETENESS = "Completitud"
VALIDITY = "Validez"
CONSISTENCY = "Consistencia"
UNIQUENESS = "Unicidad"

RULE_SCHEMA = (
    "rule_name string, description string, target_table string, target_column string, "
    "rule_type string, threshold_pct decimal(5,2), check_sql string"
)

RESULT_SCHEMA = (
    "rule_name string, target_table string, rule_type string, threshold_pct decimal(5,2), run_id long, "
    "executed_at timestamp, rows_evaluated long, rows_failed long, failed_pct decimal(5,2), verdict string"
)


@dataclass(frozen=True)
class QualityRule:
    """A counted condition with the share of failing rows it tolerates.

    Exactly one of these says what fails: ``condition``, a SQL condition on the target table;
    ``parent`` with ``parent_key``, a table that must hold every value of the column;
    ``unique``, rows beyond the first of a value fail; or ``statement``, a SQL query over
    registered views that returns the number of failing rows.
    """

    name: str
    description: str
    table: str
    column: str
    rule_type: str
    threshold: Decimal | None = Decimal("0.00")
    condition: str | None = None
    parent: str | None = None
    parent_key: str | None = None
    unique: bool = False
    statement: str | None = None

    @property
    def check_sql(self) -> str:
        if self.statement:
            return self.statement
        if self.condition:
            return f"{_counting(self.table)}{self.condition}"
        if self.unique:
            return f"SELECT COUNT(*) - COUNT(DISTINCT {self.column}) FROM {self.table} WHERE {self.column} IS NOT NULL"
        return (
            f"SELECT COUNT(*) FROM {self.table} c LEFT ANTI JOIN {self.parent} p "
            f"ON c.{self.column} = p.{self.parent_key} WHERE c.{self.column} IS NOT NULL"
        )


def _counting(table: str) -> str:
    """What the SQL of a condition begins with."""
    return f"SELECT COUNT(*) FROM {table} WHERE "


def completeness_rule(name: str, table: str, column: str, or_empty: bool = False, threshold="1.00") -> QualityRule:
    condition = f"{column} IS NULL" + (f" OR {column} = ''" if or_empty else "")
    described = f"{table}.{column} must be present"
    return QualityRule(name, described, table, column, COMPLETENESS, Decimal(threshold), condition=condition)


def validity_rule(name: str, table: str, column: str, condition: str, threshold="0.00") -> QualityRule:
    described = f"{table}.{column} must not satisfy: {condition}"
    return QualityRule(name, described, table, column, VALIDITY, Decimal(threshold), condition=condition)


def consistency_rule(name: str, table: str, column: str, parent: str, key: str, threshold="0.00") -> QualityRule:
    described = f"every {table}.{column} must exist in {parent}.{key}"
    return QualityRule(name, described, table, column, CONSISTENCY, Decimal(threshold), parent=parent, parent_key=key)


def uniqueness_rule(name: str, table: str, column: str) -> QualityRule:
    described = f"{table}.{column} must not repeat"
    return QualityRule(name, described, table, column, UNIQUENESS, unique=True)


# Rule names and thresholds of the standard catalog.
STAGING_RULES = [
    completeness_rule("CATEGORIA_ID_COMPLETITUD", "tmp_categories", "category_id"),
    completeness_rule("PROVEEDOR_ID_COMPLETITUD", "tmp_suppliers", "supplier_id"),
    completeness_rule("PRODUCTO_NOMBRE_COMPLETITUD", "tmp_products", "product_name", or_empty=True),
    completeness_rule("CLIENTE_ID_COMPLETITUD", "tmp_customers", "customer_id"),
    completeness_rule("EMPLEADO_ID_COMPLETITUD", "tmp_employees", "employee_id"),
    completeness_rule("ORDEN_FECHA_COMPLETITUD", "tmp_orders", "order_date"),
    validity_rule("DETALLE_PRECIO_VALIDEZ", "tmp_order_details", "unit_price", "unit_price < 0"),
    completeness_rule("TRANSPORTISTA_ID_COMPLETITUD", "tmp_shippers", "shipper_id"),
    completeness_rule("REGION_ID_COMPLETITUD", "tmp_region", "region_id"),
    completeness_rule("TERRITORIO_DESC_COMPLETITUD", "tmp_territories", "territory_description", or_empty=True),
    completeness_rule("EMP_TERR_RELACION_COMPLETITUD", "tmp_employee_territories", "employee_id"),
    completeness_rule("DEMOGRAFIA_TIPO_COMPLETITUD", "tmp_customer_demographics", "customer_type_id"),
    completeness_rule("CLIENTE_DEMO_RELACION_COMPLETITUD", "tmp_customer_customer_demo", "customer_id"),
]
MODEL_RULES = [
    consistency_rule("CONSISTENCIA_FK_PRODUCTO", "fact_table", "product_key", "dim_product", "product_key"),
    consistency_rule("CONSISTENCIA_FK_CLIENTE", "fact_table", "customer_key", "dim_customer", "customer_key"),
    consistency_rule("CONSISTENCIA_FK_EMPLEADO", "fact_table", "employee_key", "dim_employee", "employee_key"),
    consistency_rule("CONSISTENCIA_FK_PROD_CAT", "dim_product", "category_key", "dim_category", "category_key"),
]

# A repeated key would multiply the rows of every table that looks it up.
KEY_RULES = [
    uniqueness_rule(f"UNICIDAD_{table.upper()}", table, column)
    for table, column in [
        ("dim_category", "category_id"),
        ("dim_supplier", "supplier_id"),
        ("dim_product", "product_id"),
        ("dim_customer", "customer_id"),
        ("dim_employee", "employee_id"),
        ("fact_table", "fact_key"),
    ]
]
DECLARED = {r.name: r for r in [*STAGING_RULES, *MODEL_RULES, *KEY_RULES]}


def rules_frame(spark: SparkSession, rules: list[QualityRule]) -> DataFrame:
    return rows(
        spark,
        [(r.name, r.description, r.table, r.column, r.rule_type, r.threshold, r.check_sql) for r in rules],
        RULE_SCHEMA,
    )


def load_rules(catalog: DataFrame, table: str) -> list[QualityRule]:
    """The catalogued rules of one table, from their stored SQL. A catalog is a small table."""
    return [_stored_rule(r, DECLARED) for r in catalog.filter(F.col("target_table") == table).orderBy("rule_name").collect()]


def load_catalog(catalog: DataFrame, declared: dict[str, QualityRule] | None = None) -> list[QualityRule]:
    """All catalogued rules; ``declared`` are those known in code, the standard ones if not given."""
    found = catalog.orderBy("target_table", "rule_name").collect()
    return [_stored_rule(r, DECLARED if declared is None else declared) for r in found]


def _stored_rule(row, declared: dict[str, QualityRule]) -> QualityRule:
    """A declared rule whose SQL is as declared takes the stored threshold. Any other condition stays a
    condition, so that the rules of a table share one scan; other SQL is run as it stands."""
    known = declared.get(row.rule_name)
    if known and known.check_sql == row.check_sql:
        return replace(known, description=row.description, threshold=row.threshold_pct)
    sql, counting = row.check_sql, _counting(row.target_table)
    what = {"condition": sql.removeprefix(counting)} if sql.startswith(counting) else {"statement": sql}
    return QualityRule(row.rule_name, row.description, row.target_table, row.target_column, row.rule_type, row.threshold_pct, **what)


def upsert(catalog: DataFrame, new: DataFrame, key: str, overwrite: list[str]) -> DataFrame:
    """Insert new keys; for a known key overwrite only the listed columns.

    Keys must be unique on both sides. One full join; the new catalog is written as a new
    version by the caller.
    """
    incoming = new.select(*[F.col(c).alias(f"_new_{c}") for c in catalog.columns], F.lit(True).alias("_incoming"))
    joined = catalog.withColumn("_known", F.lit(True)).join(incoming, F.col(key) == F.col(f"_new_{key}"), "full")
    known, given = F.col("_known").isNotNull(), F.col("_incoming").isNotNull()
    columns = []
    for c in catalog.columns:
        takes_new = given if c in overwrite else given & ~known
        columns.append(F.when(takes_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
    return joined.select(*columns)


def upsert_rules(catalog: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(catalog, new, "rule_name", ["description", "check_sql", "threshold_pct"])


def list_rules(catalog: DataFrame, types: tuple[str, ...] = (VALIDITY, COMPLETENESS)) -> DataFrame:
    """Rules of the given types, ordered by type and name."""
    return catalog.filter(F.col("rule_type").isin(*types)).orderBy("rule_type", "rule_name")


def _verdict(failed: Column, total: Column, threshold: Column) -> Column:
    """Rejected when the failing share exceeds the threshold; multiplied out, so nothing is rounded."""
    share = failed.cast("decimal(20,0)") * 100
    allowed = threshold * total.cast("decimal(20,0)")
    return F.when(share > allowed, REJECTED).otherwise(APPROVED)


def _failed_pct(failed: Column, total: Column) -> Column:
    share = failed.cast("decimal(20,0)") * 100 / F.nullif(total.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.coalesce(share, F.lit(0)).cast("decimal(5,2)")


def run_quality_checks(
    tables: dict[str, DataFrame],
    table: str,
    rules: list[QualityRule],
    run_id: int,
    executed_at: datetime,
) -> DataFrame:
    """Evaluate the rules of one table: rows evaluated, rows failed, percentage, verdict.

    All conditions share a single aggregate over the table, and so do the columns of all parent
    rules, which are counted by value before parents are looked for. An empty table fails nothing.
    """
    df = tables[table]
    chosen = [r for r in rules if r.table == table]
    conditions = [r for r in chosen if r.condition]
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.expr(r.condition)).alias(f"_failed_{i}") for i, r in enumerate(conditions)],
    )

    def entry(rule: QualityRule | None, failed: Column) -> Column:
        """A rule with its failures; without a rule, the bearer of the table's row count."""
        values = [rule.name, rule.rule_type, rule.threshold] if rule else [None] * 3
        types = ["string", "string", "decimal(5,2)"]
        names = ["rule_name", "rule_type", "threshold_pct"]
        labels = [F.lit(v).cast(t).alias(n) for v, t, n in zip(values, types, names)]
        return F.struct(*labels, failed.cast("long").alias("rows_failed"))

    entries = [entry(None, F.lit(None))] + [entry(r, F.col(f"_failed_{i}")) for i, r in enumerate(conditions)]
    measured = [counts.select(F.col("_total"), F.inline(F.array(*entries)))]
    linked = [r for r in chosen if r.parent]
    if linked:
        orphans = orphan_counts([Link(df, r.column, tables[r.parent], r.parent_key) for r in linked])
        listed = F.array(*[entry(r, F.col("orphan_rows")) for r in linked])
        measured.append(orphans.select(F.col("child_rows").alias("_total"), F.inline(F.array(F.get(listed, F.col("number"))))))
    for r in chosen:
        if r.unique:
            values = df.filter(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("_rows"))
            repeats = values.agg(F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("_repeats"))
            measured.append(
                repeats.select(F.lit(None).cast("long").alias("_total"), F.inline(F.array(entry(r, F.col("_repeats")))))
            )
        elif r.statement:
            answer = df.sparkSession.sql(r.statement)
            failed = F.col(answer.columns[0])
            measured.append(
                answer.select(F.lit(None).cast("long").alias("_total"), F.inline(F.array(entry(r, failed))))
            )
    # A handful of rows, one per rule, gathered with the table's row count and spread again, so
    # that statement rules get the count without a join.
    gathered = union_all(measured).agg(
        F.max("_total").alias("rows_evaluated"),
        F.collect_list(
            F.when(F.col("rule_name").isNotNull(), F.struct("rule_name", "rule_type", "threshold_pct", "rows_failed"))
        ).alias("_rules"),
    )
    failed, total = F.col("rows_failed"), F.col("rows_evaluated")
    return gathered.select("rows_evaluated", F.inline("_rules")).select(
        "rule_name",
        F.lit(table).alias("target_table"),
        "rule_type",
        "threshold_pct",
        F.lit(run_id).cast("long").alias("run_id"),
        F.lit(executed_at).alias("executed_at"),
        "rows_evaluated",
        "rows_failed",
        _failed_pct(failed, total).alias("failed_pct"),
        _verdict(failed, total, F.col("threshold_pct")).alias("verdict"),
    )


def run_all_checks(
    tables: dict[str, DataFrame], rules: list[QualityRule], run_id: int, executed_at: datetime
) -> DataFrame:
    """A result for every rule. A table that is not given is an empty one: its rules find nothing."""
    targets = list(dict.fromkeys(r.table for r in rules if r.table in tables))
    results = [run_quality_checks(tables, t, rules, run_id, executed_at) for t in targets]
    absent = [
        (r.name, r.table, r.rule_type, r.threshold, run_id, executed_at, 0, 0, Decimal("0.00"), APPROVED)
        for r in rules
        if r.table not in tables
    ]
    if absent:
        spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
        results.append(spark.createDataFrame(absent, RESULT_SCHEMA))
    return union_all(results)


def rejections(results: DataFrame, units: dict[str, tuple[str, ...]], as_of: datetime, within: str = "1 hour") -> DataFrame:
    """Recent rejections per load unit, and whether the unit may load.

    A unit is one table or several that load together, such as order headers with their lines.
    A unit without results passes.
    """
    spark = results.sparkSession
    members = spark.createDataFrame(
        [(unit, table) for unit, tables in units.items() for table in tables], "unit string, target_table string"
    )
    earliest = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {within}")
    recent = (
        results.filter((F.col("verdict") == REJECTED) & (F.col("executed_at") >= earliest))
        .groupBy("target_table")
        .agg(F.count(F.lit(1)).alias("_rejected"))
    )
    counted = members.join(recent, "target_table", "left")
    total = F.coalesce(F.sum("_rejected"), F.lit(0))
    return counted.groupBy("unit").agg(
        total.alias("rejections"), F.when(total > 0, "blocked").otherwise("passed").alias("decision")
    )


def rejection_count(results: DataFrame, tables: tuple[str, ...], as_of: datetime, within: str = "1 hour") -> int:
    return rejections(results, {"unit": tables}, as_of, within).first().rejections


def gated_load(
    sources: dict[str, DataFrame],
    results: DataFrame,
    as_of: datetime,
    load: Callable[[str, DataFrame], None],
    checked_tables: tuple[str, ...] | None = None,
) -> bool:
    """Load the given tables together unless any of them was rejected recently.

    ``load`` stores one table, for instance as a new published version. Returns whether the
    load took place; a blocked unit keeps what it had.
    """
    if rejection_count(results, checked_tables or tuple(sources), as_of):
        return False
    for table, df in sources.items():
        load(table, df)
    return True


def critical_rejections(results: DataFrame, run_id: int) -> DataFrame:
    """Rejected rules of this run that tolerate no failure at all."""
    return results.filter(
        (F.col("run_id") == run_id) & (F.col("verdict") == REJECTED) & (F.col("threshold_pct") == 0)
    )


def publish_or_discard(
    store: VersionedStore,
    candidates: dict[str, DataFrame],
    check: Callable[[dict[str, DataFrame]], DataFrame],
    run_id: int,
    partition_by: dict[str, tuple[str, ...]] | None = None,
) -> bool:
    """Write candidate versions, check what was written, and publish all of them or none.

    ``check`` gets the written candidates and returns quality results. One critical rejection
    discards the batch: its folders stay unreferenced and readers keep the old versions.
    """
    layout = partition_by or {}
    versions = {name: store.write(name, df, layout.get(name, ())) for name, df in candidates.items()}
    written = {name: store.read(version) for name, version in versions.items()}
    if critical_rejections(check(written), run_id).take(1):
        return False
    store.publish(versions)
    return True
