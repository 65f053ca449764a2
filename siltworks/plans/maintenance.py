"""The model kept up to date by affected keys, in place of a rebuild for every batch.

A batch is known by the rows it added to memory (``operators.appended``). From these follow the
members, products and order lines whose model rows can change; everything else stays as it is:

* members of a changed entity keep the surrogate key they have; new ones are numbered after the highest;
* a product is also affected if its category or supplier has just become known;
* a line is affected if the line or its header changed, or if a product, customer or seller
  that it names has just become known. Its fact row is made anew; it replaces the old one, or takes
  it away if a header now names something unknown;
* the sums behind the data product get the new rows' sums added and the old rows' taken off.

Every step gives rows to append, no more than really differ. Small sets of keys meet large
tables by semi joins and flag joins without hints: Spark broadcasts them while they are small.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import any_of, differs
from siltworks.operators.appended import GONE
from siltworks.operators.integrity import union_all
from siltworks.operators.keys import assign_keys
from siltworks.operators.model import FACT_COLUMNS, SUMMED, build_fact, link_products, resolve_country, seller_sums
from siltworks.plans.views import categories_view, customers_view, employees_view, in_force, products_view, suppliers_view, with_empty_tables
from siltworks.sources.tables import stamp

# Dimensions of members, with their entity, view, business key, columns, and whether a country key belongs to them.
MEMBERS = {
    "dim_category": ("categories", categories_view, "category_id", ["category_name"], False),
    "dim_supplier": ("suppliers", suppliers_view, "supplier_id", ["company_name", "country"], True),
    "dim_customer": ("customers", customers_view, "customer_id", ["company_name", "city", "country", "region"], True),
    "dim_employee": ("employees", employees_view, "employee_id", ["full_name", "title", "city", "country", "region", "hire_date"], True),
}
# Business key of each table that is maintained; the sums are only ever added to.
MODEL_KEYS = {name: member[2] for name, member in MEMBERS.items()} | {"dim_product": "product_id", "fact_table": "fact_key"}

Keep = Callable[[str, DataFrame], DataFrame]


def _numbered(rows: DataFrame, dim: DataFrame, key_id: str, key: str) -> tuple[DataFrame, int]:
    """Rows under the surrogate key they have, or one after the highest; and the highest before."""
    highest = dim.agg(F.max(key)).first()[0] or 0  # one value
    known = dim.select(key_id, key).join(rows.select(key_id), key_id, "left_semi")
    old = rows.join(known, key_id)
    new = assign_keys(rows.join(known, key_id, "left_anti"), key_id, key).withColumn(key, F.col(key) + F.lit(highest))
    return old.unionByName(new), highest


def _replaced(dim: DataFrame, rows: DataFrame, key_id: str) -> DataFrame:
    """A dimension as it is after the rows."""
    return dim.join(rows.select(key_id), key_id, "left_anti").unionByName(rows.select(*dim.columns))


def _changed(rows: DataFrame, dim: DataFrame, key_id: str) -> DataFrame:
    """Those of the rows that the dimension does not hold already, whatever their load date."""
    told = [c for c in rows.columns if c not in (key_id, "load_date")]
    before = dim.join(rows.select(key_id), key_id, "left_semi").select(F.col(key_id).alias("_id"), F.struct(*told).alias("_before"))
    joined = rows.join(before, F.col(key_id) == F.col("_id"), "left")
    return joined.filter(F.col("_before").isNull() | differs(F.struct(*told), F.col("_before"))).select(*rows.columns)


def maintain(
    memory: dict[str, DataFrame],
    added: dict[str, DataFrame],
    model: dict[str, DataFrame],
    keep: Keep,
    load_ts: datetime | None = None,
) -> dict[str, DataFrame]:
    """Rows to append to each table of the model that a batch changes.

    ``memory`` has the rows in force after the batch, ``added`` those of them that the batch has
    brought, ``model`` the model as it was. ``keep`` stores rows under a name and returns what it stored; rows
    of tables that don't change are not stored. A batch that brings countries asks for a rebuild instead, as any name may
    then resolve to another country.
    """
    if "countries" in added and not added["countries"].isEmpty():
        raise ValueError("changed countries ask for a rebuild of the model")
    spark = next(iter(model.values())).sparkSession
    memory = with_empty_tables(spark, memory)
    touched = {e for e, rows in added.items() if not rows.isEmpty()}
    model, out, newcomers = dict(model), {}, {}

    def append(name: str, rows: DataFrame, key_id: str, key: str, highest: int) -> None:
        out[name] = rows = keep(name, rows)
        model[name] = _replaced(model[name], rows, key_id)
        fresh = rows.filter(F.col(key) > highest).select(key_id)
        if not fresh.isEmpty():
            newcomers[key_id] = fresh

    for name, (entity, view, key_id, columns, has_country) in MEMBERS.items():
        if entity not in touched:
            continue
        key = f"{name.removeprefix('dim_')}_key"
        rows, highest = _numbered(view(added[entity]).select(key_id, *columns), model[name], key_id, key)
        if has_country and "dim_country" in model:
            rows = resolve_country(rows, model["dim_country"])
        wanted = stamp(rows, load_ts).select(*model[name].columns)
        append(name, _changed(wanted, model[name], key_id), key_id, key, highest)

    affected = [products_view(added["products"])] if "products" in touched else []
    for key_id in ("category_id", "supplier_id"):
        if key_id in newcomers:
            products = products_view(memory["products"])
            affected.append(products.join(newcomers[key_id], key_id, "left_semi").select(*products.columns))
    if affected:
        products = union_all(affected).dropDuplicates(["product_id"])
        rows, highest = _numbered(products, model["dim_product"], "product_id", "product_key")
        linked = stamp(link_products(rows, model["dim_category"], model["dim_supplier"]), load_ts).select(*model["dim_product"].columns)
        append("dim_product", _changed(linked, model["dim_product"], "product_id"), "product_id", "product_key", highest)

    lines = _affected_lines(memory, {e: added[e] for e in touched}, newcomers)
    if lines is not None:
        out |= _fact_changes(keep("affected_lines", lines), memory, model, keep, load_ts)
    return out


def _affected_lines(memory: dict[str, DataFrame], added: dict[str, DataFrame], newcomers: dict[str, DataFrame]) -> DataFrame | None:
    """Lines in force whose fact row can have changed, found in one pass over the lines; None if nothing can."""
    lines, orders = in_force(memory["order_details"]), in_force(memory["orders"])
    own_seller = "employee_id" in lines.columns
    headers = [added["orders"].select("order_id")] if "orders" in added else []
    for key_id in ("customer_id", *([] if own_seller else ["employee_id"])):
        if key_id in newcomers:
            headers.append(orders.join(newcomers[key_id], key_id, "left_semi").select("order_id"))
    marks: list[tuple[list[str], DataFrame]] = []
    if headers:
        marks.append((["order_id"], union_all(headers).distinct()))
    if "order_details" in added:
        marks.append((["order_id", "product_id"], added["order_details"].select("order_id", "product_id")))
    for key_id in ("product_id", *(["employee_id"] if own_seller else [])):
        if key_id in newcomers:
            marks.append(([key_id], newcomers[key_id]))
    if not marks:
        return None
    if len(marks) == 1:
        return lines.join(marks[0][1], marks[0][0], "left_semi")
    flagged = lines
    for n, (keys, found) in enumerate(marks):
        flagged = flagged.join(found.withColumn(f"_mark{n}", F.lit(True)), keys, "left")
    return flagged.filter(any_of([F.col(f"_mark{n}").isNotNull() for n in range(len(marks))])).select(*lines.columns)


def _fact_changes(
    lines: DataFrame, memory: dict[str, DataFrame], model: dict[str, DataFrame], keep: Keep, load_ts: datetime | None
) -> dict[str, DataFrame]:
    """Fact rows that are new, differ, or go, and the change of the sums that follows from them."""
    orders = in_force(memory["orders"]).join(lines.select("order_id").distinct(), "order_id", "left_semi")
    dims = [model[f"dim_{d}"] for d in ("product", "customer", "employee", "time")]
    new = build_fact(lines, orders, *dims, load_ts)
    old = model["fact_table"].join(lines.select(F.concat_ws("-", "order_id", "product_id").alias("fact_key")), "fact_key", "left_semi")

    def packed(fact: DataFrame, name: str) -> DataFrame:
        row = F.struct(*[c for c in [*FACT_COLUMNS, "load_date"]])
        return fact.select(F.col("fact_key").alias(f"_{name}_key"), row.alias(name))

    def told(name: str) -> Column:
        return F.struct(*[F.col(f"{name}.{c}") for c in FACT_COLUMNS])

    both = packed(new, "new").join(packed(old, "old"), F.col("_new_key") == F.col("_old_key"), "full")
    differing = F.col("new").isNull() | F.col("old").isNull() | differs(told("new"), told("old"))
    gone = F.col("new").isNull()
    # Of the row that is replaced, only what the sums lose is stored.
    was = F.when(F.col("old").isNotNull(), F.struct(*[F.col(f"old.{c}") for c in SUMMED])).alias("was")
    told_rows = both.filter(differing).select(F.when(gone, F.col("old")).otherwise(F.col("new")).alias("row"), gone.alias(GONE), was)
    changes = keep("fact_changes", told_rows)

    rows = changes.select("row.*", GONE)
    time = model["dim_time"]
    sums = seller_sums(changes.filter(~F.col(GONE)).select("row.*"), time)
    sums = sums.unionByName(seller_sums(changes.filter("was IS NOT NULL").select("was.*"), time, -1))
    totals = sums.groupBy("employee_key", "year", "quarter").agg(*[F.sum(c).cast(t).alias(c) for c, t in (("revenue", "decimal(28,2)"), ("lines", "bigint"), ("units", "bigint"))])
    moved = totals.filter("revenue <> 0 OR lines <> 0 OR units <> 0")
    return {"fact_table": keep("fact_table", rows), "sales_sums": keep("sales_sums", moved)}
