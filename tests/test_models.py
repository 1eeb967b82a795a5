from __future__ import annotations

import itertools
import math
from collections import Counter

import pytest
from conftest import as_dicts, make_tables
from pyspark.ml.fpm import FPGrowthModel

from cartloom.jobs.feature_tables import FEATURE_TABLES, export_job
import argparse

from cartloom.jobs.train_models import TASKS, Settings, one_of, read_reports, run
from cartloom.operators.lookup import names_for
from cartloom.plans import association, reorder, segmentation
from cartloom.sources.sinks import validate_outputs


def labelled(spark, labels):
    return spark.createDataFrame([(n, float(v)) for n, v in enumerate(labels)], "user_id int, label double")


def test_class_weights_balance(spark):
    df = labelled(spark, [1, 0, 0, 0])
    weights = as_dicts(reorder.class_weights(df))[0]
    assert (weights["pos_weight"], weights["neg_weight"]) == (2.0, 4 / 6)
    total = {}
    for row in reorder.add_class_weights(df).collect():
        total[row.label] = total.get(row.label, 0) + row.class_weight
    assert math.isclose(total[0.0], total[1.0])


def test_single_class_has_weight_one(spark):
    rows = reorder.add_class_weights(labelled(spark, [0, 0])).collect()
    assert [row.class_weight for row in rows] == [1.0, 1.0]


def test_split_keeps_users_together(spark):
    df = spark.range(2000).selectExpr("id % 500 AS user_id", "id AS x")
    train, test = reorder.split_by_user(df)
    a = {r.user_id for r in train.select("user_id").distinct().collect()}
    b = {r.user_id for r in test.select("user_id").distinct().collect()}
    assert not a & b and len(a | b) == 500 and 60 < len(b) < 140


def test_split_always_has_a_test_user(spark):
    df = spark.range(3).selectExpr("id AS user_id")
    for seed in range(4):
        train, test = reorder.split_by_user(df, seed, share=1.0)
        assert (train.count(), test.count()) == (2, 1)


def test_confusion_without_predicted_positives(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    row = as_dicts(reorder.confusion_metrics(df))[0]
    assert (row["precision_pos"], row["recall_pos"], row["f1_pos"]) == (0.0, 0.0, 0.0)
    assert row["accuracy"] == 0.5 and (row["fn"], row["tn"]) == (1.0, 1.0)


def test_unknown_model_and_task():
    with pytest.raises(argparse.ArgumentTypeError, match="stars"):
        one_of(list(TASKS))("basket,stars")
    assert one_of(list(TASKS))("all") == ["reorder", "segmentation", "basket"]
    assert one_of(list(TASKS))(" Basket,reorder") == ["basket", "reorder"]


def test_unknown_model(spark):
    with pytest.raises(ValueError):
        reorder.build_reorder_pipeline("tree")


def test_default_estimators_keep_their_settings(spark):
    stages = {m: reorder.build_reorder_pipeline(m).getStages()[-1] for m in reorder.MODELS}
    assert stages["lr"].getMaxIter() == 60 and stages["lr"].getRegParam() == 0.01
    assert stages["rf"].getNumTrees() == 80 and stages["rf"].getMaxDepth() == 8
    assert stages["gbt"].getMaxIter() == 50 and stages["gbt"].getStepSize() == 0.1


def test_itemsets_agree_with_counting(spark):
    baskets = spark.createDataFrame(
        [(["1", "2"],), (["1", "2", "3"],), (["1", "3"],), (["2"],)], "items array<string>"
    )
    model = association.fit_itemsets(baskets, 0.5, 0.1)
    found = {tuple(sorted(r["items"])): r["freq"] for r in as_dicts(association.frequent_itemsets(model))}
    # The single-item basket does not count, so two of three baskets are needed.
    assert found == {("1",): 3, ("2",): 2, ("3",): 2, ("1", "2"): 2, ("1", "3"): 2}
    rules = as_dicts(association.association_rules(model))
    assert [r["lift"] for r in rules] == sorted((r["lift"] for r in rules), reverse=True)


def test_itemsets_of_every_size_and_their_stored_model(spark, tmp_path):
    baskets = [sorted({str(n % 3), str(n % 5), str(n % 7), str(10 + n % 4), str(100 + n)}) for n in range(400)]
    df = spark.createDataFrame([(basket,) for basket in baskets], "items array<string>")
    seen = Counter(s for b in baskets for size in range(1, len(b) + 1) for s in itertools.combinations(b, size))
    want = {members: n for members, n in seen.items() if n >= 8}
    path = str(tmp_path / "model")
    model = association.fit_itemsets(df, 8 / 400, 0.1, path)
    assert {tuple(sorted(r["items"])): r["freq"] for r in as_dicts(model.freqItemsets)} == want
    assert max(map(len, want)) == 3
    rules = as_dicts(association.rules_of(FPGrowthModel.load(path)))
    assert len(rules) == sum(n >= 0.1 * want[tuple(x for x in s if x != y)] for s, n in want.items() if s[1:] for y in s)
    for rule in rules:
        one, other = tuple(rule["antecedent"]), tuple(rule["consequent"])
        both = want[tuple(sorted(one + other))]
        assert rule["support"] == both / 400
        assert rule["lift"] == pytest.approx(both / want[one] / (want[other] / 400))


def test_trees_hold_frequent_pairs_only(spark, monkeypatch):
    # Fifty items in 600 baskets that are all different; two of them are bought together often.
    baskets = [(["x", "y", f"{n % 50}", f"{50 + n // 50}"] if n < 20 else [f"{n % 50}", f"{50 + n // 50}"],) for n in range(600)]
    fitted = []

    class Noted(association.FPGrowth):
        def fit(self, rows):
            fitted.append(sorted(sorted(r["items"]) for r in rows.collect() if r["items"]))
            return super().fit(rows)

    monkeypatch.setattr(association, "FPGrowth", Noted)
    model = association.fit_itemsets(spark.createDataFrame(baskets, "items array<string>"), 10 / 600, 0.1)
    assert {tuple(sorted(r["items"])) for r in as_dicts(model.freqItemsets) if len(r["items"]) > 1} >= {("x", "y")}
    assert fitted and all(set(kept) >= {"x", "y"} for kept in fitted[0]) and len(fitted[0]) == 20


def test_no_basket_of_two(spark, tmp_path):
    baskets = spark.createDataFrame([(["1"],)], "items array<string>")
    report = association.train_basket_rules(baskets, baskets, str(tmp_path))
    assert report.skipped and report.choice is None


def test_names_keep_order_and_unknown_ids(spark, shop):
    df = spark.createDataFrame(
        [(["13", "10"], ["99"]), (["10"], [])], "a array<string>, b array<string>"
    )
    rows = {tuple(r["a"]): r for r in as_dicts(names_for(df, {"a": "an", "b": "bn"}, shop.products))}
    assert rows[("13", "10")]["an"] == ["Soap", "Organic Milk"]
    assert rows[("13", "10")]["bn"] == ["99"]
    assert rows[("10",)]["bn"] == []


def test_too_few_users_are_skipped(spark, tmp_path):
    rfv = spark.createDataFrame([(1, 1.0)], "user_id int, recency double")
    report = segmentation.train_segmentation(rfv, str(tmp_path), features=["recency"])
    assert report.skipped


def test_all_jobs_end_to_end(spark, tmp_path):
    orders, prior, train = [], [], []
    for user in range(40):
        for number in range(1, 4):
            order = user * 10 + number
            last = number == 3
            orders.append((order, user, "train" if last else "prior", number, number, user % 24,
                           None if number == 1 else float(user % 7)))
            for position, product in enumerate({10, 11 + user % 3, 11 + number % 2}, 1):
                again = int(number > 1 and product == 10)
                (train if last else prior).append((order, product, position, again))
    t = make_tables(spark, orders=orders, prior=prior, train=train)
    out = str(tmp_path / "out")
    settings = Settings(
        k_max=3, min_support=0.1,
        overrides={"lr": {"maxIter": 2}, "rf": {"numTrees": 2}, "gbt": {"maxIter": 1}},
    )
    reports = run(t, out, settings=settings)
    fits = reports["reorder"].runs
    assert {r["model"] for r in fits} == {"lr", "rf", "gbt"}
    assert reports["reorder"].choice["auc_pr"] == max(r["auc_pr"] for r in fits)
    tested = sum(r["count"] for r in reports["reorder"].inputs["rows"] if r["part"] == "test")
    assert all(sum(r[c] for c in ("tp", "fp", "fn", "tn")) == tested for r in fits)
    assert reports["segmentation"].choice["k"] in (2, 3)
    assert reports["basket"].runs[0]["basket_association_rules"] > 0
    assert reports["basket"].choice["antecedent_names"]
    found = as_dicts(validate_outputs(spark, {n: f"{out}/features/{n}" for n in FEATURE_TABLES}))
    assert all(r["row_count"] for r in found)
    assert spark.read.parquet(f"{out}/features/user_segments").count() == 40
    assert all(spark.read.json(f"{out}/reports/{task}").count() == 1 for task in TASKS)
    told = {row["task"]: row for row in as_dicts(read_reports(spark, out))}
    assert [run["k"] for run in told["segmentation"]["runs"]] == [2, 3] and told["segmentation"]["inputs"]["users"] == 40
    assert [run["model"] for run in told["reorder"]["runs"]] == ["lr", "rf", "gbt"]
    assert told["basket"]["inputs"]["min_support"] == 0.1 and not any(row["skipped"] for row in told.values())
    paths = export_job(t, f"{out}/exports")
    assert spark.read.option("header", True).csv(paths["top_products"]).count() == 4
