"""A key with a third of the rows: joins keep the form that adaptive execution splits."""

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from siltworks.operators import history, integrity, model

ROWS = 60_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    # Tables this small would otherwise shrink to one task, which cannot be split.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Every third row under key 7."""
    path = str(tmp_path_factory.mktemp("hot") / "rows")
    key = F.when(F.col("id") < ROWS // 3, F.lit(7)).otherwise(F.col("id"))
    spark.range(ROWS, numPartitions=8).select("id", key.alias("fk"), F.lit(date(1998, 1, 1)).alias("d")).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df, value):
    """Plan after a run that needs the value column, so that a hot partition keeps its size."""
    total = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(value).bitwiseAND(1)))
    rows = total.first()[0]
    total.collect()
    return rows, total._jdf.queryExecution().executedPlan().toString()


def test_orphans_are_split(spark, hot):
    with settings(spark, SMALL):
        rows, plan = final_plan(integrity.fk_orphans(hot, "fk", spark.range(100).filter("id <> 7"), "id"), "id")
    assert rows == ROWS
    assert "skew=true" in plan


def test_product_arm_is_split(spark, hot):
    products = hot.selectExpr("id AS product_id", "'p' AS product_name", "fk AS category_id", "id % 5000 AS supplier_id", "TRUE AS is_discontinued")
    arm = spark.range(ROWS)
    categories = arm.selectExpr("id AS category_id", "id + 1 AS category_key")
    suppliers = arm.selectExpr("id AS supplier_id", "id + 1 AS supplier_key")
    with settings(spark, SMALL):
        dim = model.build_dim_product(products, categories, suppliers)
        assert dim.filter("category_key = 8").count() == ROWS // 3
        rows, plan = final_plan(dim, "product_key")
    assert rows == ROWS
    assert "skew=true" in plan


def test_closed_versions_of_a_hot_key_meet_no_join(spark, hot):
    versions = hot.selectExpr("fk AS k", "id AS v", "CAST(d AS TIMESTAMP) AS load_date", f"id >= {ROWS // 3 - 1} AS active")
    batch = spark.createDataFrame([(7, -1)], "k long, v long")
    with settings(spark, SMALL):
        after = history.apply_changes(versions, batch, "k", ["v"])
        assert after.filter("active").count() == ROWS - ROWS // 3 + 1
        assert after.filter("k = 7").count() == ROWS // 3 + 1
        # The closed branch of the union reads its rows and passes them on.
        branches = after._jdf.queryExecution().optimizedPlan().children()
        assert "Join" not in branches.apply(0).toString()
