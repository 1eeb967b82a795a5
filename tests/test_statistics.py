"""Order statistics, splits of trees, and what stored tables are derived from, against plain versions."""

from __future__ import annotations

import math
import random

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from cartloom.operators.quantiles import exact_quantile, exact_quantiles, quantile_table
from cartloom.plans import explain, reorder
from cartloom.plans.products import product_thresholds
from cartloom.sources import staging
from cartloom.sources.schema import Tables

CATALOGUE = 49_688


def plain_quantile(values, share):
    held = sorted(v for v in values if v is not None)
    return held[max(math.ceil(share * len(held)), 1) - 1] if held else None


def test_medians_of_a_whole_catalogue(spark):
    """More distinct values than a sketch of default size tells apart."""
    draw = random.Random(3)
    rows = [(n, 100 + n % 7, draw.randrange(10**9), draw.random()) for n in range(CATALOGUE)]
    columns = "product_id int, total_purchases int, total_unique_buyers long, reorder_rate double"
    metrics = spark.createDataFrame(rows, columns).repartition(6)
    cut = metrics.limit(1).select(product_thresholds(metrics, 100).alias("cut")).first().cut
    assert cut.reach_median == plain_quantile([row[2] for row in rows], 0.5)
    assert cut.loyalty_median == plain_quantile([row[3] for row in rows], 0.5)


@pytest.mark.parametrize("share", [0.0, 0.001, 0.3333, 0.5, 0.9, 1.0])
def test_quantiles_with_ties_and_nulls(spark, share):
    """A third of all rows share one value; a coarse sketch must not change the result."""
    draw = random.Random(4)
    values = [None if n % 10 == 0 else 50 if n % 3 == 0 else draw.randrange(2000) - 500 for n in range(6000)]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(5)
    for error in (0.05, 1e-4):
        found = spark.range(1).select(exact_quantile(df, "v", share, error).alias("v")).first().v
        assert found == plain_quantile(values, share)


def test_quantiles_of_nothing_and_of_little(spark):
    empty = spark.createDataFrame([], "v double")
    assert as_dicts(quantile_table(empty, ["v"], [0.5])) == [{"column_name": "v", "share": 0.5, "value": None}]
    nulls = spark.createDataFrame([(None,), (None,)], "v double")
    assert spark.range(1).select(exact_quantile(nulls, "v", 0.5)).first()[0] is None
    one = spark.createDataFrame([(3.5, 1), (3.5, 2)], "v double, w int")
    found = spark.range(1).select(exact_quantiles(one, {"a": ("v", 0.1), "b": ("w", 0.5)}).alias("q")).first().q
    assert (found.a, found.b) == (3.5, 1)


# --- models


def fitted(spark, model, **settings):
    rows = [(float(n % 2 or n % 5 == 0), float(n % 4), float(n % 3), n % 3 + 10, 1.0 + n % 2) for n in range(300)]
    df = spark.createDataFrame(rows, "label double, a double, b double, p_department_id int, class_weight double")
    pipeline = reorder.build_reorder_pipeline(model, features=("a", "b"), subsamplingRate=1.0, **settings)
    return rows, pipeline.fit(df)


def test_splits_of_a_stump(spark):
    rows, model = fitted(spark, "rf", numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    [split] = as_dicts(explain.tree_splits(model, ("a", "b")))
    place = {"a": 1, "b": 2}[split["feature"]]
    for side, keep in (("left", lambda x: x <= split["threshold"]), ("right", lambda x: x > split["threshold"])):
        own = [row for row in rows if keep(row[place])]
        assert split[side] == pytest.approx(sum(row[0] * row[4] for row in own) / sum(row[4] for row in own))


def test_split_by_department(spark):
    """Departments are categories to the trees; the rows outside are left, whichever side is richer."""
    for rich in (10, 11):
        rows = [(float(n % 3 + 10 == rich), 1.0, 1.0, n % 3 + 10, 1.0) for n in range(90)]
        df = spark.createDataFrame(rows, "label double, a double, b double, p_department_id int, class_weight double")
        settings = dict(numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all", subsamplingRate=1.0)
        model = reorder.build_reorder_pipeline("rf", features=("a", "b"), **settings).fit(df)
        [split] = as_dicts(explain.tree_splits(model, ("a", "b")))
        assert split["feature"] == f"p_department_id={rich}" and split["threshold"] == 0.5
        assert (split["left"], split["right"]) == (0.0, 1.0)


def test_splits_of_deeper_trees_are_numbered(spark):
    _, model = fitted(spark, "rf", numTrees=3, maxDepth=3, featureSubsetStrategy="all")
    splits = as_dicts(explain.tree_splits(model, ("a", "b")))
    assert {row["tree"] for row in splits} == {1, 2, 3}
    for row in splits:
        assert row["node"] == 1 or any(
            other["tree"] == row["tree"] and other["node"] == row["node"] // 2 for other in splits
        )
    names = set(explain.input_names(model, ("a", "b")))
    assert names == {"a", "b", "p_department_id=10", "p_department_id=11", "p_department_id=12"}


# --- stored tables


def test_buckets_within_what_spark_allows(spark):
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "4")
    try:
        assert staging.bucket_count(spark, 100 << 40) == 4
        store = staging.Store.open(spark, staging.required_folder(spark), 100 << 40)
        rows = spark.range(100).selectExpr("id % 10 AS order_id", "id AS v")
        assert store.by_order("many", rows).count() == 100
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert staging.bucket_count(spark, 10 << 40) == 20_480
    assert staging.bucket_count(spark, 1) == spark.sparkContext.defaultParallelism


def test_bytes_of_a_bucket_stay_as_the_input_grows(spark):
    sizes = [n << 30 for n in (1, 6, 36)]
    assert {size / staging.bucket_count(spark, size) for size in sizes} == {staging.BYTES_PER_BUCKET}
    assert staging.BYTES_PER_BUCKET <= 4 << 20


def test_failed_derivation_can_be_repeated(spark, shop):
    store = staging.Store.open(spark, staging.required_folder(spark), 1)
    known: list[dict] = [{"database": store.database}, {}]
    for held in known:
        tables = Tables(**{**shop.__dict__, "known": held})
        broken = spark.range(10).select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
        with pytest.raises(Exception, match="lost"):
            staging.remembered(tables, "derived", lambda: broken)
        assert "derived" not in held
        assert staging.remembered(tables, "derived", lambda: spark.range(3)).count() == 3
        assert staging.remembered(tables, "derived", lambda: broken).count() == 3


def test_few_files_are_listed_without_a_job(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"{n}.txt").write_text("x" * n)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "deep.txt").write_text("four")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    total, _ = staging.input_state(spark, [str(tmp_path)])
    assert total == 14 and spark.sparkContext.statusTracker().getJobIdsForGroup(None) == jobs
    assert staging.input_state(spark, [str(tmp_path)], few=2)[0] == 14
