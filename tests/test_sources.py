from __future__ import annotations

import csv
import json
import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from conftest import AISLES, DEPARTMENTS, ORDERS, PRIOR, PRODUCTS, TRAIN, as_dicts, make_tables

import __spark_entry__ as contract
from cartloom.jobs import feature_tables
from cartloom.jobs.session import open_tables
from cartloom.plans.products import (
    department_matrix, product_pair_base, register_result_views,
)
from cartloom.sources import shop as shop_module
from cartloom.sources import sinks
from cartloom.sources.config import FeatureConfig, REORDER_FEATURES
from cartloom.sources import staging
from cartloom.sources.readers import load_tables, register_views, sample_users
from cartloom.sources.schema import CSV_FILES, SCHEMAS
from cartloom.sources.staging import input_state


@pytest.fixture(scope="module")
def csv_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    rows = {
        "orders": ORDERS, "op_prior": PRIOR, "op_train": TRAIN, "products": PRODUCTS,
        "aisles": AISLES, "departments": DEPARTMENTS,
    }
    for name, file in CSV_FILES.items():
        with open(folder / file, "w", newline="") as out:
            writer = csv.writer(out)
            writer.writerow(SCHEMAS[name].fieldNames())
            writer.writerows(rows[name])
    return str(folder)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_round_trip(spark, csv_folder):
    loaded, expected = load_tables(spark, csv_folder), make_tables(spark)
    for (name, mine), (_, theirs) in zip(loaded.items(), expected.items()):
        assert mine.schema == theirs.schema, name
        assert rows_of(mine) == rows_of(theirs), name


def test_stored_csv_tables_are_the_same(spark, csv_folder):
    stored, expected = open_tables(spark, csv_folder), make_tables(spark)
    for (name, mine), (_, theirs) in zip(stored.items(), expected.items()):
        assert rows_of(mine) == rows_of(theirs), name


def test_feature_command(spark, csv_folder, tmp_path):
    feature_tables.main(["--data", csv_folder, "--out", str(tmp_path)])
    assert spark.read.parquet(f"{tmp_path}/features/train_dataset").count() == 5


def test_missing_files_are_named_together(spark, csv_folder, tmp_path):
    (tmp_path / "orders.csv").write_text("order_id\n1\n")
    with pytest.raises(FileNotFoundError) as error:
        load_tables(spark, str(tmp_path))
    assert "products.csv" in str(error.value) and "orders.csv" not in str(error.value)


def test_views(spark, shop):
    register_views(shop)
    assert spark.sql("SELECT count(*) FROM order_products_all").first()[0] == len(PRIOR) + len(TRAIN)
    assert spark.sql("SELECT max(days_since_prior) FROM orders").first()[0] == 30.0
    register_result_views(product_pair_base(shop), department_matrix(shop))
    assert spark.sql("SELECT * FROM product_pair_base").count() == 5
    assert spark.sql("SELECT * FROM department_matrix").count() == 4


def test_sample_keeps_whole_users(spark):
    orders = [(n, n // 2, "prior", n % 2 + 1, 0, 0, None) for n in range(400)]
    t = make_tables(spark, orders=orders, prior=[(n, 10, 1, 0) for n in range(400)], train=[])
    sampled = sample_users(t, 0.5)
    per_user = sampled.orders.groupBy("user_id").count()
    assert {r["count"] for r in as_dicts(per_user)} == {2}
    assert 60 < per_user.count() < 140
    assert sampled.op_all.count() == sampled.orders.count()
    again = sample_users(t, 0.5)
    assert rows_of(again.orders) == rows_of(sampled.orders)
    assert sample_users(t, 1.0) is t
    assert sampled.known is not t.known
    for wrong in (0, -0.5, 1.5):
        with pytest.raises(ValueError):
            sample_users(t, wrong)


def test_sinks(spark, shop, tmp_path):
    table, export, report = (str(tmp_path / name) for name in ("t", "csv", "json"))
    sinks.write_table(shop.aisles, table)
    sinks.write_table(shop.aisles, table)
    assert spark.read.parquet(table).count() == len(AISLES)
    sinks.export_csv(shop.products, export)
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(export)
    assert {r["product_name"] for r in back.collect()} == {p[1] for p in PRODUCTS}
    sinks.write_report(shop.aisles, report)
    assert spark.read.json(report).count() == len(AISLES)
    found = {r["table_name"]: r for r in as_dicts(
        sinks.validate_outputs(spark, {"a": table, "b": str(tmp_path / "none")}))}
    assert found["a"]["row_count"] == len(AISLES) and found["a"]["column_count"] == 2
    assert found["b"]["row_count"] is None and found["b"]["error"] == "PATH_NOT_FOUND"


def test_config(spark, tmp_path):
    assert FeatureConfig.from_json(spark, None) == FeatureConfig()
    path = tmp_path / "features.json"
    path.write_text(json.dumps({"segmentation_features": ["recency"], "basket": {"x": 1}}, indent=1))
    config = FeatureConfig.from_json(spark, str(path))
    assert config.segmentation_features == ("recency",)
    assert config.reorder_numeric_features == REORDER_FEATURES


# --- the tables derived from a wholesale schema ----------------------------------------------


def wholesale(spark, folder, seed=5):
    """One user holds a third of the orders and one order a large part of the lines."""
    draw = random.Random(seed)
    start = datetime(2024, 1, 1)
    orders = [
        (n, 1 if n % 3 == 0 else draw.randint(2, 30), start + timedelta(days=draw.randrange(12)))
        for n in range(300)
    ]
    parts = [(n, f"{c} {k}", t) for n, (c, k, t) in enumerate(
        (c, k, t) for c in ("red", "blue") for k in ("bolt", "ring", "gear") for t in ("A", "B")
        for _ in range(3))]
    lines = [(draw.choice([7, draw.randrange(300)]), draw.randrange(len(parts)), draw.randint(1, 7))
             for _ in range(2000)]
    frames = {
        "orders": spark.createDataFrame(
            orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "part": spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_type string"),
        "lineitem": spark.createDataFrame(
            lines, "l_orderkey bigint, l_partkey bigint, l_linenumber int"),
    }
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return frames


@pytest.fixture(scope="module")
def wholesale_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("wholesale"))
    return folder, wholesale(spark, folder)


def test_staged_lazy_and_block_numbering_agree(spark, wholesale_folder, monkeypatch):
    folder, frames = wholesale_folder
    staged = shop_module.shop_tables(spark, folder)
    lazy = shop_module.derive_tables(frames["orders"], frames["lineitem"], frames["part"])
    monkeypatch.setattr(shop_module, "WINDOW_ORDERS", 0)
    monkeypatch.setattr(shop_module, "_BLOCK_BITS", 4)
    blocks = shop_module.derive_tables(frames["orders"], frames["lineitem"], frames["part"])
    for (name, a), (_, b), (_, c) in zip(staged.items(), lazy.items(), blocks.items()):
        assert rows_of(a.select(sorted(a.columns))) == rows_of(b.select(sorted(a.columns))), name
        assert rows_of(b.select(sorted(a.columns))) == rows_of(c.select(sorted(a.columns))), name


def test_order_numbers_follow_date_and_id(spark, wholesale_folder):
    folder, frames = wholesale_folder
    by_user: dict = {}
    for r in frames["orders"].collect():
        by_user.setdefault(r.o_custkey, []).append((r.o_orderdate, r.o_orderkey))
    expected = {
        key: number
        for orders in by_user.values()
        for number, (_, key) in enumerate(sorted(orders), 1)
    }
    staged = shop_module.shop_tables(spark, folder)
    assert {r.order_id: r.order_number for r in staged.orders.collect()} == expected


def test_second_read_reuses_the_stored_tables(spark, wholesale_folder):
    folder, _ = wholesale_folder
    first, second = (shop_module.shop_tables(spark, folder) for _ in range(2))
    assert first is second


def test_staged_join_needs_no_shuffle(spark, wholesale_folder):
    folder, _ = wholesale_folder
    t = shop_module.shop_tables(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = t.op_all.join(t.orders.select("order_id", "user_id"), "order_id")
        plan = joined.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_replaced_file_of_equal_length_is_read_anew(spark, tmp_path):
    path = tmp_path / "files"
    path.mkdir()
    (path / "a.txt").write_text("one")
    total, before = input_state(spark, [str(path)])
    assert total == 3
    os.utime(path / "a.txt", (1, 1))
    (path / "b.txt").write_text("")
    (path / "b.txt").unlink()
    assert input_state(spark, [str(path)])[1] != before
    assert input_state(spark, [str(path)]) == input_state(spark, [str(path)])


def test_dropped_stores_leave_no_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "_made", {})
    store = staging.Store.open(spark, str(tmp_path), 1)
    store.by_order("lines", spark.range(9).selectExpr("id AS order_id", "id % 2 AS part"), "part")
    assert store.plain("few", spark.range(3)).count() == 3 and list(tmp_path.iterdir())
    staging.drop_stores(spark)
    assert not list(tmp_path.iterdir())


def test_cluster_without_shared_folder_is_told(spark, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shop_module.shop_tables(spark, "/nowhere")


def test_csv_products_writes_products_alone(spark, shop):
    folder = Path(staging.required_folder(spark))
    before = set(folder.glob("csv-*/*"))
    rows = contract.QUERIES["csv_products"](shop).collect()
    assert {row["product_name"] for row in rows} == {f'a "quoted", {p["product_name"]},\n"' for p in shop.products.collect()}
    assert [path.name for path in set(folder.glob("csv-*/*")) - before] == ["products.csv"]
