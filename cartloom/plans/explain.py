"""What fitted models say: terms of a linear model, splits of trees, how settled a clustering is."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StandardScalerModel, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def input_names(fitted: PipelineModel, features: Sequence[str]) -> list[str]:
    """Names of the slots of the assembled vector: the numeric features, then one per department."""
    indexers = [stage for stage in fitted.stages if isinstance(stage, StringIndexerModel)]
    labels = [f"{stage.getInputCol()}={label}" for stage in indexers for label in stage.labels]
    return [*features, *labels]


def linear_terms(fitted: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(term, coefficient): change of the log-odds per unit of each feature as it was given, and the intercept."""
    model = fitted.stages[-1]
    scales = [stage.std.toArray() for stage in fitted.stages if isinstance(stage, StandardScalerModel)]
    names, rows = input_names(fitted, features), [("intercept", float(model.intercept))]
    for at, (name, coefficient) in enumerate(zip(names, model.coefficients.toArray())):
        scale = scales[0][at] if scales else 1.0
        rows.append((name, float(coefficient / scale) if scale else 0.0))
    return SparkSession.active().createDataFrame(rows, "term string, coefficient double")


def _walk(node, tree: int, place: int, names: list[str], rates: bool) -> Iterator[tuple]:
    if node.subtreeDepth() == 0:
        return
    split, children = node.split(), [node.leftChild(), node.rightChild()]
    if split.getClass().getSimpleName() == "CategoricalSplit":
        # A department's slot holds 0 or 1; the side of the zeros is called left.
        threshold = 0.5
        if 0.0 not in list(split.leftCategories()):
            children.reverse()
    else:
        threshold = float(split.threshold())
    sides = []
    for child in children:
        counts = list(child.impurityStats().stats())
        sides.append(float(counts[1] / sum(counts[:2])) if rates else float(child.prediction()))
    yield tree, place, names[split.featureIndex()], threshold, *sides
    for side, child in enumerate(children):
        yield from _walk(child, tree, 2 * place + side, names, rates)


def tree_splits(fitted: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(tree, node, feature, threshold, left, right) of all splits of a forest or of boosted trees.

    Trees count from 1, a node's children are twice its number and one more. Left and right are the
    weighted share of positive rows below the split for a classifying tree, the fitted value for a
    boosted one.
    """
    model = fitted.stages[-1]
    rates = "Classification" in type(model.trees[0]).__name__
    names = input_names(fitted, features)
    rows = [
        row for n, tree in enumerate(model.trees, 1) for row in _walk(tree._java_obj.rootNode(), n, 1, names, rates)
    ]
    schema = "tree int, node long, feature string, threshold double, `left` double, `right` double"
    return SparkSession.active().createDataFrame(rows, schema)


def _squared(values: Column, centre: Sequence[float]) -> Column:
    """Squared distance of an array to a centre."""
    parts = F.zip_with(values, F.array(*map(F.lit, centre)), lambda x, c: (x - c) * (x - c))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part)


def settled(model: KMeansModel, scaled: DataFrame) -> DataFrame:
    """One row: k, the rows that are not with their nearest centre, and the farthest that a centre is, in
    any coordinate, from the mean of its rows."""
    centres = [[float(x) for x in centre] for centre in model.clusterCenters()]
    held = model.transform(scaled).select("cluster", vector_to_array("features").alias("values"))
    apart = F.array(*[_squared(F.col("values"), centre) for centre in centres])
    nearest = F.array_position(apart, F.array_min(apart)) - 1
    moved = held.agg(F.count_if(F.col("cluster") != nearest).alias("moved"))
    means = held.select("cluster", F.posexplode("values").alias("at", "value")).groupBy("cluster", "at")
    means = means.agg(F.avg("value").alias("mean"))
    own = F.get(F.get(F.array(*[F.array(*map(F.lit, centre)) for centre in centres]), F.col("cluster")), F.col("at"))
    drift = means.agg(F.max(F.abs(F.col("mean") - own)).alias("drift"))
    return moved.select(F.lit(len(centres)).alias("k"), "moved", drift.scalar().alias("drift"))
