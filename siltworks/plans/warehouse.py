"""The warehouse run end to end: stage, validate, type, check, gate, apply changes, rebuild."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.operators import appended, integrity, quality, rules
from siltworks.operators.appended import BATCH, as_base
from siltworks.operators.cleaning import clean_countries, patch_by_key, recode
from siltworks.operators.model import TIME_DAYS, TIME_START, dropped_lines, sales_from_sums, seller_sums
from siltworks.operators.typed import to_typed
from siltworks.plans.maintenance import MODEL_KEYS, maintain
from siltworks.plans.rebuild import rebuild_model
from siltworks.plans.views import empty_memory, enrichment_views, in_force, with_empty_tables
from siltworks.schemas import (
    CAPITALS_BY_ABBREVIATION,
    COUNTRY_NAME_BY_ABBREVIATION,
    COUNTRY_PATCH_BY_NAME,
    COUNTRY_RECODE,
    ENTITIES,
    RELATIONS,
)
from siltworks.sources.staging import LINE, REJECTED, stage_csv
from siltworks.sources.tables import Version, VersionedStore, batch_path, stamp

# Tables that the gate loads together or not at all.
SALES_UNIT = ("orders", "order_details")

# The quality catalog speaks of tmp_ tables; the region table is singular there.
GATE_TABLES = {entity: "tmp_region" if entity == "regions" else f"tmp_{entity}" for entity in ENTITIES}

# Keys of the tables that batches append to.
KEYS = {f"dwm_{entity}": list(spec.keys) for entity, spec in ENTITIES.items()} | MODEL_KEYS

# Tables of the model as readers see them; the sums behind the data product stand apart.
MODEL = (*MODEL_KEYS, "dim_time", "dim_country")

# Folders of a table from which on ``Warehouse.compact`` writes it anew.
COMPACT_FROM = 8


@dataclass(frozen=True)
class BatchResult:
    """What a batch did; true if it was published. The frames are computed when they are used."""

    published: bool
    results: DataFrame
    changes: DataFrame
    dropped: DataFrame

    def __bool__(self) -> bool:
        return self.published


class Warehouse:
    """A warehouse under one shared folder. Methods return DataFrames unless they write."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.store = VersionedStore(spark, f"{root}/store")
        self._counts: dict[str, tuple[DataFrame, dict[str, int]]] = {}

    # Staging

    def stage(self, batch_id: str, files: dict[str, str], multi_line: bool = True) -> dict[str, DataFrame]:
        """Copy the batch's files into its own staging folders, as text, each read once.

        Lines whose fields don't fit are kept apart (``rejected_lines``). Rows and broken rules are counted by
        the same write (``validation_status``, ``staged_counts``).
        """
        text = {}
        for entity, path in files.items():
            told, listed = Observation(), rules.rules_for(entity)
            measures = rules.failure_measures(listed, F.col(LINE).isNull())
            target = batch_path(f"{self.root}/txt", entity, batch_id)
            text[entity], _ = stage_csv(self.spark, path, entity, target, multi_line, told, *measures)
            self._counts[entity] = (text[entity], told.get)
        return text

    def rejected_lines(self, batch_id: str, entities: tuple[str, ...] = tuple(ENTITIES)) -> DataFrame:
        """Lines of a staged batch with too many or too few fields: table, text."""
        found = []
        for entity in entities:
            schema = T.StructType([T.StructField(LINE, T.StringType()), T.StructField("verdict", T.StringType())])
            try:
                stored = self.spark.read.schema(schema).parquet(batch_path(f"{self.root}/txt", entity, batch_id))
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue  # not in the batch
            found.append(stored.filter(F.col("verdict") == REJECTED).select(F.lit(ENTITIES[entity].text_table).alias("table_name"), F.col(LINE).alias("line")))
        return integrity.union_all(found) if found else self.spark.createDataFrame([], "table_name string, line string")

    def staged_counts(self) -> DataFrame:
        """Rows and rejected lines of every table that this run has staged, as its write has counted them."""
        counts = [(ENTITIES[e].text_table, told["rows"], told["rejected"]) for e, (_, told) in self._counts.items()]
        return self.spark.createDataFrame(counts, "table_name string, row_count long, rejected_lines long")

    def validate(self, text: dict[str, DataFrame], run_id: int) -> DataFrame:
        """Every issue of every staged table, one scan per table, kept in the issue log."""
        found = []
        for entity, df in text.items():
            spec = ENTITIES[entity]
            found.append(rules.validate(df, spec.text_table, rules.rules_for(entity), rules.row_key(spec.keys), run_id))
        return self._logged("dqm_validation_issues", integrity.union_all(found), run_id, "format")

    def _logged(self, log: str, rows: DataFrame, run_id: int, step: str) -> DataFrame:
        """Add the rows of a run's step to a log, in a folder of their own, and return them as
        stored. A step that is run again replaces what it logged before."""
        path = f"{self.root}/{log}/run={run_id}/step={step}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def validation_status(self, text: dict[str, DataFrame]) -> DataFrame:
        """Errors and status per table; a table that this run has staged is not scanned again."""
        failures = []
        for entity, df in text.items():
            table, listed = ENTITIES[entity].text_table, rules.rules_for(entity)
            staged, counts = self._counts.get(entity, (None, None))
            if staged is df:
                failures.append(rules.counted_failures(self.spark, table, listed, counts))
            else:
                failures.append(rules.rule_failures(df, table, listed))
        return rules.validation_status(integrity.union_all(failures))

    def typed(self, text: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Typed staging, stored, so that later steps don't cast the text again; text that cannot be cast fails the job."""
        cleaned = {e: clean_countries(df) if e == "countries" else df for e, df in text.items()}
        stored = {entity: self.store.write(f"tmp_{entity}", to_typed(df, entity)) for entity, df in cleaned.items()}
        return {entity: self.store.read(version) for entity, version in stored.items()}

    # Checks

    def check_keys(self, text: dict[str, DataFrame]) -> DataFrame:
        """Blank and repeated keys per staged table."""
        blanks, repeats = [], []
        for entity, df in text.items():
            spec = ENTITIES[entity]
            blanks.append(integrity.pk_blank_count(df, list(spec.keys), spec.text_table))
            duplicates = integrity.pk_duplicates(df, list(spec.keys))
            repeats.append(
                duplicates.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(
                    F.lit(spec.text_table).alias("table_name"), "duplicate_keys"
                )
            )
        return integrity.union_all(blanks).join(integrity.union_all(repeats), "table_name")

    def malformed_keys(self, text: dict[str, DataFrame]) -> DataFrame:
        """Key parts that cannot take their typed form: table, column, value, length."""
        found = []
        for entity, df in text.items():
            spec = ENTITIES[entity]
            for rule in rules.rules_for(entity):
                if rule.column in spec.keys:
                    bad = integrity.pk_malformed(df, {rule.column: rule.broken})
                    found.append(
                        bad.select(
                            F.lit(spec.text_table).alias("table_name"),
                            F.lit(rule.column).alias("column_name"),
                            F.col(rule.column).alias("key_value"),
                            F.col(f"{rule.column}_length").alias("key_length"),
                        )
                    )
        return integrity.union_all(found)

    def check_relations(self, typed: dict[str, DataFrame]) -> DataFrame:
        """Catalogued relations of a batch; parents are the batch together with memory, and the country dimension."""
        parents, memory = {}, self.memory_tables()
        for entity, spec in ENTITIES.items():
            keys = [spec.typed_name(k) for k in spec.keys]
            known = [source[entity].select(*keys) for source in (typed, memory) if entity in source]
            if known:
                parents[entity] = integrity.union_all(known)
        if (countries := self.model("dim_country")) is not None:
            parents["dim_country"] = countries
        relations = [r for r in RELATIONS if r[0] in parents and r[2] in typed]
        return integrity.relationship_check(relations, typed, parents)

    def check_model(self) -> DataFrame:
        """Catalogued relations within the published model."""
        published = self.store.published()
        relations = [r for r in RELATIONS if r[0] in published and r[2] in published]
        tables = {t: self._read(t, published[t]) for t in {name for r in relations for name in (r[0], r[2])}}
        return integrity.relationship_check(relations, tables)

    # Quality rules

    def rules(self) -> DataFrame:
        """The rule catalogue: what was stored, or the declared rules."""
        stored = self.store.current("dqm_quality_rules")
        return stored if stored is not None else quality.rules_frame(self.spark, list(quality.DECLARED.values()))

    def upsert_rules(self, new: DataFrame) -> None:
        """New rules, or another description, SQL or threshold for known ones; later checks use them."""
        before = self.store.published()
        merged = quality.upsert_rules(self.rules(), new)
        self.store.publish({"dqm_quality_rules": self.store.write("dqm_quality_rules", merged)}, before)

    def _check(self, tables: dict[str, DataFrame], of: Callable[[str], bool], extra, run_id, executed_at, step) -> DataFrame:
        """Results of the catalogued rules on tables of a kind; rules given by SQL see the tables as views."""
        chosen = [r for r in quality.load_catalog(self.rules()) if of(r.table)] + [*(extra or [])]
        if any(r.statement for r in chosen):
            for name, df in tables.items():
                df.createOrReplaceTempView(name)
        return self._logged("dqm_quality_results", quality.run_all_checks(tables, chosen, run_id, executed_at), run_id, step)

    def check_quality(self, typed: dict[str, DataFrame], run_id: int, executed_at: datetime) -> DataFrame:
        """A result for every catalogued rule of the staging tables; one that the batch lacks is empty."""
        tables = {GATE_TABLES[entity]: df for entity, df in typed.items()}
        return self._check(tables, lambda t: t.startswith("tmp_"), None, run_id, executed_at, "staging")

    # Memory

    def _read(self, table: str, version: Version) -> DataFrame:
        """The rows in force of a table, whatever batches have appended to it."""
        df = self.store.read(version)
        return appended.in_force(df, KEYS[table], plain=len(version.folders) == 1) if BATCH in df.columns else df

    def _history(self, table: str, version: Version) -> DataFrame:
        return appended.history(self.store.read(version), KEYS[table], plain=len(version.folders) == 1)

    def memory(self, entity: str) -> DataFrame | None:
        """Every version of every row, closed ones too."""
        version = self.store.published().get(f"dwm_{entity}")
        return self._history(f"dwm_{entity}", version) if version else None

    def memory_tables(self, published: dict[str, Version] | None = None) -> dict[str, DataFrame]:
        """The rows in force of every memory table, from one look at what is published."""
        published = self.store.published() if published is None else published
        return {e: self._read(f"dwm_{e}", published[f"dwm_{e}"]) for e in ENTITIES if f"dwm_{e}" in published}

    def load_memory(
        self, typed: dict[str, DataFrame], results: DataFrame, as_of: datetime, load_ts: datetime | None = None
    ) -> dict[str, bool]:
        """Full refresh of each table that passes the gate; order headers and lines as one."""
        units = {e: (e,) for e in typed if e not in SALES_UNIT}
        sales = tuple(e for e in SALES_UNIT if e in typed)
        if sales:
            units["sales"] = sales
        checked = {unit: tuple(GATE_TABLES[e] for e in entities) for unit, entities in units.items()}
        decisions = {r.unit: r.decision == "passed" for r in quality.rejections(results, checked, as_of).collect()}
        versions, loaded = {}, {}
        for unit, entities in units.items():
            for entity in entities:
                loaded[entity] = decisions[unit]
                if decisions[unit]:
                    rows = stamp(typed[entity].withColumn("active", F.lit(True)), load_ts)
                    versions[f"dwm_{entity}"] = self.store.write(f"dwm_{entity}", as_base(rows))
        if versions:
            self.store.publish(versions)
        return loaded

    def apply_batch(
        self,
        typed: dict[str, DataFrame],
        run_id: int,
        executed_at: datetime,
        load_ts: datetime | None = None,
        extra_rules: list[quality.QualityRule] | None = None,
    ) -> BatchResult:
        """Append an incremental batch to the histories and bring the model up to date.

        Every entity of the batch is taken. What is written follows the batch: a row per new or
        changed key, and the rows of the model that these affect. The model is built anew only if there is
        none yet or countries changed. It keeps the calendar it has. History and model are
        published together, or not at all when a rule that tolerates no failure rejects the new model.
        """
        published = self.store.published()
        versions, added, counts = {}, {}, []
        for entity, df in typed.items():
            table, keys = f"dwm_{entity}", list(ENTITIES[entity].keys)
            integrity.require_unique(df, keys, entity)
            previous, told = published.get(table), Observation()
            known = self._read(table, previous) if previous else empty_memory(self.spark, entity)
            attributes = [c for c in df.columns if c not in keys]
            rows = appended.additions(known, df, keys, attributes, len(previous.folders) if previous else 0, load_ts, told)
            version = self.store.write(table, rows)
            found = {status: n for status, n in told.get.items() if n}  # counted while the rows were written
            counts += [(entity, status, n) for status, n in found.items()]
            if previous is None or set(found) - {"unchanged"}:
                versions[table] = previous.followed_by(version) if previous else version
                added[entity] = self.store.read(version).drop(BATCH)

        memory = self.memory_tables({**published, **versions})
        if "fact_table" in published and "countries" not in added:
            model = self._maintain_model(memory, added, published, load_ts)
        else:
            model = self._write_model(memory, load_ts)

        tables = {**published, **model}
        written = {t: self._history(t, v) for t, v in versions.items()} | {t: self._read(t, tables[t]) for t in MODEL if t in tables}
        results = self._check(written, written.__contains__, extra_rules, run_id, executed_at, "model")
        accepted = not quality.critical_rejections(results, run_id).take(1)
        if accepted:
            self.store.publish({**versions, **model}, published)
            enrichment_views(with_empty_tables(self.spark, memory))
        memory = with_empty_tables(self.spark, memory)
        lost = dropped_lines(
            in_force(memory["order_details"]),
            in_force(memory["orders"]),
            *[self._read(f"dim_{d}", tables[f"dim_{d}"]) for d in ("product", "customer", "employee", "time")],
        )
        changes = self.spark.createDataFrame(counts, "entity string, status string, row_count long")
        return BatchResult(accepted, results, changes, lost)

    def standardise_countries(self, load_ts: datetime | None = None) -> None:
        """Recode country names of customers and employees, correct country attributes."""
        published = self.store.published()
        versions = {}
        for entity in ("customers", "employees"):
            if (table := f"dwm_{entity}") in published:
                recoded = recode(self._history(table, published[table]), "country", COUNTRY_RECODE)
                versions[table] = self.store.write(table, as_base(recoded))
        if "dwm_countries" in published:
            patched = patch_countries(self.spark, self._history("dwm_countries", published["dwm_countries"]))
            versions["dwm_countries"] = self.store.write("dwm_countries", as_base(patched))
        if versions:
            self.store.publish(versions, published)

    def compact(self, folders: int = COMPACT_FROM) -> list[str]:
        """Write each table of at least so many folders anew as one base, and publish them together.

        Readers see the same rows before and after. To be run between batches, as often as reading the additions costs
        more than it should.
        """
        published, versions = self.store.published(), {}
        for table, version in published.items():
            if len(version.folders) < folders:
                continue
            if table.startswith("dwm_"):
                versions[table] = self.store.write(table, as_base(self._history(table, version)), rebalance=True)
            elif table == "fact_table":
                versions[table] = self._write_fact(self._read(table, version))
            elif table in MODEL_KEYS:
                versions[table] = self.store.write(table, as_base(self._read(table, version)), rebalance=True)
            elif table == "sales_sums":
                sums = self.store.read(version).groupBy("employee_key", "year", "quarter")
                totals = sums.agg(F.sum("revenue").cast("decimal(28,2)").alias("revenue"), F.sum("lines").alias("lines"), F.sum("units").alias("units"))
                versions[table] = self.store.write(table, totals)
        if versions:
            self.store.publish(versions, published)
        return sorted(versions)

    def country_leftovers(self) -> dict[str, DataFrame]:
        """What standardisation left: unknown country names, near-duplicate and non-ASCII countries."""
        memory = self.memory_tables()
        countries = memory["countries"]
        sources = {
            f"dwm_{entity}": (memory[entity], ENTITIES[entity].keys[0], "country")
            for entity in ("customers", "suppliers", "employees")
            if entity in memory
        }
        return {
            "unmatched": integrity.unmatched_values_report(sources, countries, "country_name"),
            "near_duplicates": integrity.near_duplicate_names(countries, "country_name", "country_name"),
            "non_printable": integrity.non_printable_ascii(countries, ["country_name", "capital_city"]).select(
                "country_name", "capital_city", "abbreviation"
            ),
        }

    # Model

    def _calendar(self) -> tuple[str, int]:
        """First day and number of days of the published calendar, or the standard one."""
        days = self.model("dim_time")
        if days is None:
            return TIME_START, TIME_DAYS
        first, n = days.agg(F.min("full_date").cast("string"), F.count(F.lit(1))).first()
        return (first, n) if n else (TIME_START, TIME_DAYS)

    def _write_fact(self, fact: DataFrame) -> Version:
        """The fact as a base, a folder per year."""
        return self.store.write("fact_table", as_base(_by_year(fact), removable=True), ("year",), rebalance=True)

    def _write_model(self, memory, load_ts, calendar: tuple[str, int] | None = None) -> dict[str, Version]:
        """Write every table of the model once, parents before children, and the sums of the fact."""
        versions: dict[str, Version] = {}

        def keep(name: str, df: DataFrame) -> DataFrame:
            versions[name] = self._write_fact(df) if name == "fact_table" else self.store.write(name, as_base(df) if name in KEYS else df)
            return self._read(name, versions[name])

        tables = rebuild_model(self.spark, with_empty_tables(self.spark, memory), load_ts, *(calendar or self._calendar()), keep)
        versions["sales_sums"] = self.store.write("sales_sums", seller_sums(tables["fact_table"], tables["dim_time"]))
        return versions

    def _maintain_model(self, memory, added, published, load_ts) -> dict[str, Version]:
        """Append what the batch changes in the model; tables that it leaves alone keep their version."""
        versions: dict[str, Version] = {}

        def keep(name: str, df: DataFrame) -> DataFrame:
            previous = published.get(name)
            rows = df
            if name in KEYS:
                rows = (_by_year(df) if name == "fact_table" else df).withColumn(BATCH, F.lit(len(previous.folders)).cast("bigint"))
            version = self.store.write(name, rows)
            if previous is not None and not self.store.read(version).isEmpty():
                versions[name] = previous.followed_by(version)
            return self.store.read(version).drop(BATCH)

        model = {t: self._read(t, published[t]) for t in MODEL if t in published}
        maintain(memory, added, model, keep, load_ts)
        return versions

    def rebuild(self, load_ts: datetime | None = None, time_start: str | None = None, time_days: int = TIME_DAYS) -> None:
        """Build the model anew; a calendar that is given replaces the one it has."""
        before = self.store.published()
        memory = self.memory_tables(before)
        self.store.publish(self._write_model(memory, load_ts, (time_start, time_days) if time_start else None), before)
        enrichment_views(with_empty_tables(self.spark, memory))

    def model(self, table: str) -> DataFrame | None:
        """A published table of the model, or None before the first publication."""
        version = self.store.published().get(table)
        return self._read(table, version) if version else None

    def sales_by_employee(self) -> DataFrame:
        """The data product, from the stored sums of the fact and what batches have added to them."""
        view = sales_from_sums(self.model("sales_sums"), self.model("dim_employee"))
        view.createOrReplaceTempView("vw_sales_by_employee")
        return view


def _by_year(fact: DataFrame) -> DataFrame:
    return fact.withColumn("year", (F.col("date_key") / 10000).cast("int"))


def patch_countries(spark: SparkSession, countries: DataFrame) -> DataFrame:
    """The keyed corrections of capital, code and name, by abbreviation and by name."""
    by_code = spark.createDataFrame(
        [(code, capital, COUNTRY_NAME_BY_ABBREVIATION.get(code)) for code, capital in CAPITALS_BY_ABBREVIATION.items()],
        "abbreviation string, capital_city string, country_name string",
    )
    by_name = spark.createDataFrame(
        [(name, fix["abbreviation"], fix["capital_city"]) for name, fix in COUNTRY_PATCH_BY_NAME.items()],
        "country_name string, abbreviation string, capital_city string",
    )
    return patch_by_key(patch_by_key(countries, by_code, "abbreviation"), by_name, "country_name")
