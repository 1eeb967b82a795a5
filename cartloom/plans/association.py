"""Frequent itemsets and association rules over baskets."""

from __future__ import annotations

import math
import uuid

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame, functions as F

from cartloom.operators.lookup import names_for
from cartloom.operators.relational import min_items, top_k
from cartloom.sources.sinks import Report, save_model, write_report, write_table
from cartloom.sources.staging import required_folder

_RULE = ["antecedent", "consequent"]


def rule_baskets(baskets: DataFrame) -> DataFrame:
    """Baskets that can hold a rule."""
    return min_items(baskets, "items", 2)


def _pairs(baskets: DataFrame) -> DataFrame:
    """(basket, a, b): every two items of a basket whose items are sorted."""
    each = baskets.select("basket", "items", F.posexplode("items").alias("at", "a"))
    return each.select("basket", "a", F.explode(F.expr("slice(items, at + 2, size(items))")).alias("b"))


def _often(rows: DataFrame, least: int, *keys: str) -> DataFrame:
    """Keys with at least so many rows, kept, so that joins to them know their size."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least)
    counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    counts.count()
    return counts


def fit_itemsets(
    baskets: DataFrame, min_support: float = 0.003, min_confidence: float = 0.2, path: str | None = None
) -> FPGrowthModel:
    """FP-growth over baskets that can hold a rule, mined once into the model stored at ``path``.

    A set of two and more items is frequent only if each two of them are. Items and pairs are counted
    first, with partial sums; the trees then hold, of every basket, the items of its frequent pairs
    alone, so they grow with what is frequent and not with the number of different baskets. Baskets
    without such a pair stay as empty ones for the supports. Single items get their counts over all.
    Without ``path`` the model goes to a place of its own in the shared folder.
    """
    spark = baskets.sparkSession
    path = path or f"{required_folder(spark)}/itemsets-{uuid.uuid4().hex[:12]}"
    usable = rule_baskets(baskets.select(F.array_sort(F.array_distinct("items")).alias("items")))
    total = usable.count()
    least = max(math.ceil(min_support * total), 1)
    numbered = usable.withColumn("basket", F.monotonically_increasing_id())
    singles = _often(usable.select(F.explode("items").alias("item")), least, "item")
    both = _pairs(numbered)
    for side in ("a", "b"):
        both = both.join(singles.select(F.col("item").alias(side)), side, "left_semi")
    pairs = _often(both, least, "a", "b")
    held = _pairs(numbered).join(pairs, ["a", "b"], "left_semi")
    members = held.select("basket", F.explode(F.array("a", "b")).alias("item"))
    cores = members.groupBy("basket").agg(F.collect_set("item").alias("items")).select("items")
    cores = cores.persist(StorageLevel.MEMORY_AND_DISK)
    empty = spark.range(total - cores.count()).select(F.array().cast(usable.schema["items"].dataType).alias("items"))
    settings = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    model = settings.fit(cores.unionByName(empty))
    mined = model.freqItemsets.persist(StorageLevel.MEMORY_AND_DISK)
    save_model(model, path)
    sets = singles.select(F.array("item").alias("items"), "freq")
    write_table(sets.unionByName(mined.where(F.size("items") > 1)), f"{path}/data")
    for kept in (mined, cores, pairs, singles):
        kept.unpersist()
    return FPGrowthModel.load(path)


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    return model.freqItemsets.orderBy(F.desc("freq"))


def _strongest():
    return [F.desc(c) for c in ("lift", "confidence", "support")] + [F.asc(c) for c in _RULE]


def rules_of(model: FPGrowthModel) -> DataFrame:
    """Rules in no order; the items of an antecedent are sorted."""
    return model.associationRules.withColumn("antecedent", F.array_sort("antecedent"))


def association_rules(model: FPGrowthModel) -> DataFrame:
    """Rules, strongest first, in a total order."""
    return rules_of(model).orderBy(*_strongest())


def named_rules(rules: DataFrame, products: DataFrame) -> DataFrame:
    """Rules with the product names of both sides."""
    names = {side: f"{side}_names" for side in _RULE}
    return names_for(rules, names, products).orderBy(*_strongest())


def top_rules(rules: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    """The k strongest rules; names are looked up for these only."""
    best = top_k(rules, _strongest(), k)
    return named_rules(best, products).select(
        *_RULE, "antecedent_names", "consequent_names", "confidence", "lift", "support"
    )


def train_basket_rules(
    baskets: DataFrame,
    products: DataFrame,
    output: str,
    min_support: float = 0.003,
    min_confidence: float = 0.2,
) -> Report:
    """Mine once into the saved model; itemsets, named rules and the strongest ones follow from it."""
    usable = rule_baskets(baskets).persist(StorageLevel.MEMORY_AND_DISK)
    inputs = {"baskets": usable.count(), "min_support": min_support, "min_confidence": min_confidence}
    report = Report("basket", inputs)
    if not inputs["baskets"]:
        usable.unpersist()
        return report.skip("no basket has two items")
    model = fit_itemsets(usable, min_support, min_confidence, f"{output}/models/basket_fpgrowth")
    usable.unpersist()
    tables = {
        "basket_freq_itemsets": frequent_itemsets(model),
        "basket_association_rules": named_rules(rules_of(model), products),
    }
    sizes = {}
    for name, table in tables.items():
        write_table(table, f"{output}/features/{name}")
        sizes[name] = baskets.sparkSession.read.parquet(f"{output}/features/{name}").count()
    best = top_rules(rules_of(model), products)
    write_report(best, f"{output}/reports/top_rules")
    report.runs = [sizes]
    first = best.first()
    return report.choose("lift", first.asDict()) if first else report
