"""Registered queries: versioned history."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.operators import appended
from siltworks.operators import history as h
from siltworks.plans.testbed import CHANGED, Catalogue, table
from siltworks.session import scratch_path
from siltworks.sources.tables import VersionedStore

catalogue = Catalogue()

ATTRIBUTES = ["name", "segment", "balance"]

# Customers as history: each has its current version; those with a large balance also have a
# closed one. Segment is null for one of the five segments, so that nulls are compared.
_CURRENT = """SELECT c_custkey AS id, c_name AS name, nullif(c_mktsegment, 'MACHINERY') AS segment,
    CAST(c_acctbal AS DECIMAL(12,2)) AS balance, DATE '2020-01-01' AS load_date, TRUE AS active FROM customer"""
_CLOSED = """SELECT c_custkey AS id, c_name AS name, 'former' AS segment, CAST(0 AS DECIMAL(12,2)) AS balance,
    DATE '2019-01-01' AS load_date, FALSE AS active FROM customer WHERE c_acctbal > 5000"""
# The batch: customers in debt are reset, two segments arrive unchanged, suppliers arrive as new customers.
_BATCH = """SELECT c_custkey AS id, c_name AS name, nullif(c_mktsegment, 'MACHINERY') AS segment,
    CAST(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS DECIMAL(12,2)) AS balance
    FROM customer WHERE c_acctbal < 0 OR c_mktsegment IN ('MACHINERY', 'BUILDING')
    UNION ALL
    SELECT 1000000000 + s_suppkey, s_name, NULL, CAST(s_acctbal AS DECIMAL(12,2)) FROM supplier"""
_HISTORY = f"{_CURRENT} UNION ALL {_CLOSED}"
_SAME = "h.id = b.id AND h.name IS NOT DISTINCT FROM b.name AND h.segment IS NOT DISTINCT FROM b.segment AND h.balance IS NOT DISTINCT FROM b.balance"
_WITH = f"WITH h AS ({_HISTORY}), b AS ({_BATCH})"


def _customer_history(spark, folder) -> DataFrame:
    customers = table(spark, folder, "customer")
    current = customers.selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "nullif(c_mktsegment, 'MACHINERY') AS segment",
        "CAST(c_acctbal AS DECIMAL(12,2)) AS balance",
        "TIMESTAMP '2020-01-01' AS load_date",
        "TRUE AS active",
    )
    closed = customers.filter("c_acctbal > 5000").selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "'former' AS segment",
        "CAST(0 AS DECIMAL(12,2)) AS balance",
        "TIMESTAMP '2019-01-01' AS load_date",
        "FALSE AS active",
    )
    return current.unionByName(closed)


def _customer_batch(spark, folder) -> DataFrame:
    known = (
        table(spark, folder, "customer")
        .filter("c_acctbal < 0 OR c_mktsegment IN ('MACHINERY', 'BUILDING')")
        .selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "nullif(c_mktsegment, 'MACHINERY') AS segment",
            "CAST(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS DECIMAL(12,2)) AS balance",
        )
    )
    new = table(spark, folder, "supplier").selectExpr(
        "1000000000 + s_suppkey AS id",
        "s_name AS name",
        "CAST(NULL AS STRING) AS segment",
        "CAST(s_acctbal AS DECIMAL(12,2)) AS balance",
    )
    return known.unionByName(new)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("load_date", F.to_date("load_date"))


@catalogue.register(
    f"""{_WITH} SELECT h.* FROM h JOIN b ON h.id = b.id WHERE h.active AND NOT ({_SAME})"""
)
def customer_changes(spark, folder) -> DataFrame:
    changed = h.changed(_customer_history(spark, folder), _customer_batch(spark, folder), "id", ATTRIBUTES)
    return _dated(changed)


@catalogue.register(
    f"""{_WITH}
        SELECT id, name, segment, balance, load_date,
               active AND NOT EXISTS (SELECT 1 FROM b WHERE b.id = h.id AND NOT ({_SAME})) AS active FROM h
        UNION ALL
        SELECT id, name, segment, balance, DATE '2020-02-01', TRUE FROM b
        WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.active AND {_SAME})"""
)
def customer_history(spark, folder) -> DataFrame:
    """Changed versions closed, new ones in force, the rest as it was."""
    return _dated(
        h.apply_changes(_customer_history(spark, folder), _customer_batch(spark, folder), "id", ATTRIBUTES, CHANGED)
    )


@catalogue.register(
    f"""{_WITH} SELECT id, name, segment, balance FROM b WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.active AND h.id = b.id)"""
)
def customer_new(spark, folder) -> DataFrame:
    return h.new_rows(_customer_history(spark, folder), _customer_batch(spark, folder), "id")


@catalogue.register(
    f"""{_WITH} SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM h WHERE h.active AND h.id = b.id) THEN 'inserted'
            WHEN EXISTS (SELECT 1 FROM h WHERE h.active AND {_SAME}) THEN 'unchanged' ELSE 'updated' END AS status,
            CAST(count(*) AS BIGINT) AS row_count FROM b GROUP BY 1"""
)
def change_counts(spark, folder) -> DataFrame:
    return h.change_counts(_customer_history(spark, folder), _customer_batch(spark, folder), "id", ATTRIBUTES)


@catalogue.register(f"{_WITH} SELECT id, name, segment, balance, load_date, active FROM h WHERE active")
def current_versions(spark, folder) -> DataFrame:
    return _dated(h.current_rows(_customer_history(spark, folder)))


@catalogue.register(
    f"""{_WITH} SELECT id, name, segment, balance, load_date, active FROM h
        UNION ALL
        SELECT id, name, segment, balance, DATE '2020-02-01', TRUE FROM b
        WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.active AND {_SAME})"""
)
def append_if_absent(spark, folder) -> DataFrame:
    """New versions are added, but the old one stays in force."""
    return _dated(
        h.append_if_absent(_customer_history(spark, folder), _customer_batch(spark, folder), "id", ATTRIBUTES, CHANGED)
    )


# Order lines under the composite key (order, part): the dearest line of each pair is the current
# version and, where a pair has several lines, the cheapest is a closed one. Returned lines arrive
# with quantity zero; orders without any line get a first one.
_LINES = """WITH g AS (SELECT l_orderkey AS order_id, l_partkey AS product_id, max(CAST(l_extendedprice AS DECIMAL(10,2))) AS price,
        min(CAST(l_extendedprice AS DECIMAL(10,2))) AS least, max(CAST(l_quantity AS INTEGER)) AS quantity,
        max(CASE l_returnflag WHEN 'R' THEN 2 WHEN 'N' THEN 1 ELSE 0 END) AS flag, count(*) AS n FROM lineitem GROUP BY 1, 2),
    h AS (SELECT order_id, product_id, price, quantity, DATE '2020-01-01' AS load_date, TRUE AS active FROM g
        UNION ALL SELECT order_id, product_id, least, quantity, DATE '2019-01-01', FALSE FROM g WHERE n > 1),
    b AS (SELECT order_id, product_id, price, CASE WHEN flag = 2 THEN 0 ELSE quantity END AS quantity FROM g WHERE flag > 0
        UNION ALL SELECT o_orderkey, -1, CAST(o_totalprice AS DECIMAL(10,2)), 1 FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))"""
_LINE_SAME = "h.order_id = b.order_id AND h.product_id = b.product_id AND h.price IS NOT DISTINCT FROM b.price AND h.quantity IS NOT DISTINCT FROM b.quantity"


@catalogue.register(
    f"""{_LINES}
        SELECT order_id, product_id, price, quantity, load_date, active AND NOT EXISTS (
            SELECT 1 FROM b WHERE b.order_id = h.order_id AND b.product_id = h.product_id AND NOT ({_LINE_SAME})) AS active FROM h
        UNION ALL
        SELECT order_id, product_id, price, quantity, DATE '2020-02-01', TRUE FROM b
        WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.active AND {_LINE_SAME})"""
)
def lineitem_history(spark, folder) -> DataFrame:
    """The pairs are stored first, as a history is; the batch then meets them in one pass."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    pairs = lines.groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")).agg(
        F.max(price).alias("price"),
        F.min(price).alias("least"),
        F.max(F.col("l_quantity").cast("int")).alias("quantity"),
        F.max(F.expr("CASE l_returnflag WHEN 'R' THEN 2 WHEN 'N' THEN 1 ELSE 0 END")).alias("flag"),
        F.count(F.lit(1)).alias("n"),
    )
    path = scratch_path(spark, "pairs")
    pairs.write.parquet(path)
    pairs = spark.read.schema(pairs.schema).parquet(path)
    current = pairs.selectExpr(
        "order_id", "product_id", "price", "quantity", "TIMESTAMP '2020-01-01' AS load_date", "TRUE AS active"
    )
    closed = pairs.filter("n > 1").selectExpr(
        "order_id", "product_id", "least AS price", "quantity", "TIMESTAMP '2019-01-01' AS load_date", "FALSE AS active"
    )
    returned = pairs.filter("flag > 0").selectExpr(
        "order_id", "product_id", "price", "CASE WHEN flag = 2 THEN 0 ELSE quantity END AS quantity"
    )
    known_orders = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    first = orders.join(known_orders, "o_orderkey", "left_anti").selectExpr(
        "o_orderkey AS order_id",
        "CAST(-1 AS BIGINT) AS product_id",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS price",
        "1 AS quantity",
    )
    return _dated(
        h.apply_changes(
            current.unionByName(closed),
            returned.unionByName(first),
            ["order_id", "product_id"],
            ["price", "quantity"],
            CHANGED,
        )
    )


# Three batches in a row: the one above, another that changes large balances and those in debt, and
# the first again, which turns debtors back and leaves the rest as it is.
_SECOND = """SELECT c_custkey AS id, c_name AS name, nullif(c_mktsegment, 'MACHINERY') AS segment,
    CAST(CAST(c_acctbal AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) AS balance FROM customer WHERE c_acctbal < 0 OR c_acctbal > 5000"""
_DATES = ["2020-02-01", "2020-03-01", "2020-04-01"]


def _stamp(day: str) -> datetime:
    return datetime.fromisoformat(day).replace(tzinfo=timezone.utc)


def _after(n: int) -> str:
    """Common table expressions: the history h0 and what each of the first n batches makes of it."""
    steps = [f"h0 AS ({_HISTORY})", f"b1 AS ({_BATCH})", f"b2 AS ({_SECOND})", "b3 AS (SELECT * FROM b1)"]
    for k in range(1, n + 1):
        same = _SAME.replace("h.", f"h{k - 1}.").replace("b.", f"b{k}.")
        steps.append(
            f"""h{k} AS (SELECT id, name, segment, balance, load_date, active AND NOT EXISTS (
                SELECT 1 FROM b{k} WHERE b{k}.id = h{k - 1}.id AND NOT ({same})) AS active FROM h{k - 1}
            UNION ALL SELECT id, name, segment, balance, DATE '{_DATES[k - 1]}', TRUE FROM b{k}
            WHERE NOT EXISTS (SELECT 1 FROM h{k - 1} WHERE h{k - 1}.active AND {same}))"""
        )
    return "WITH " + ", ".join(steps)


class _Appended:
    """The customers' history as a stored table that batches append to."""

    def __init__(self, spark, folder):
        self.store = VersionedStore(spark, scratch_path(spark, "appended"))
        first = _customer_batch(spark, folder)
        second = table(spark, folder, "customer").filter("c_acctbal < 0 OR c_acctbal > 5000").selectExpr(
            "c_custkey AS id",
            "c_name AS name",
            "nullif(c_mktsegment, 'MACHINERY') AS segment",
            "CAST(CAST(c_acctbal AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) AS balance",
        )
        self.batches = [first, second, first]
        self.version = self.store.write("customers", appended.as_base(_customer_history(spark, folder)))

    def rows(self) -> DataFrame:
        return self.store.read(self.version)

    def apply(self, n: int) -> DataFrame:
        """Append batch n (from 1); the rows it has written."""
        number = len(self.version.folders)
        current = appended.in_force(self.rows(), "id", plain=number == 1)
        rows = appended.additions(current, self.batches[n - 1], "id", ATTRIBUTES, number, _stamp(_DATES[n - 1]))
        written = self.store.write("customers", rows)
        self.version = self.version.followed_by(written)
        return self.store.read(written)

    def compact(self) -> None:
        self.version = self.store.write("customers", appended.as_base(appended.history(self.rows(), "id")))


@catalogue.register(f"{_after(3)} SELECT id, name, segment, balance, load_date, active FROM h3")
def history_by_additions(spark, folder) -> DataFrame:
    """Three batches that only append, with a compaction after the second: every version, as a reader sees it."""
    kept = _Appended(spark, folder)
    kept.apply(1)
    kept.apply(2)
    kept.compact()
    kept.apply(3)
    return _dated(appended.history(kept.rows(), "id"))


@catalogue.register(f"{_after(2)} SELECT id, name, segment, balance, load_date, active FROM h2 WHERE active")
def in_force_by_additions(spark, folder) -> DataFrame:
    """The versions in force after two batches, merged while they are read."""
    kept = _Appended(spark, folder)
    kept.apply(1)
    kept.apply(2)
    return _dated(appended.in_force(kept.rows(), "id"))


@catalogue.register(
    f"""{_after(2)}
        SELECT CAST(1 AS BIGINT) AS batch, id, balance FROM h1 WHERE load_date = DATE '{_DATES[0]}'
        UNION ALL SELECT 2, id, balance FROM h2 WHERE load_date = DATE '{_DATES[1]}'"""
)
def rows_that_batches_write(spark, folder) -> DataFrame:
    """A batch writes the rows that are new or differ, and no others."""
    kept = _Appended(spark, folder)
    return kept.apply(1).unionByName(kept.apply(2)).selectExpr("_batch AS batch", "id", "balance")
