"""Fitted trees as a table of nodes, and their scores as Spark expressions.

A row of the node table is one node: tree, node (0 is the root), feature (-1 for a leaf),
threshold, left, right, value (of a leaf) and weight (of the tree). The table's size is
fixed by the model's parameters, whatever the data, so it travels to the rows as a
scalar subquery; a row walks down all trees level by level in the JVM, without Python.
"""

from __future__ import annotations

from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillview.functions.measures import one_row

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, weight double"
_WALKED = ("feature", "threshold", "left", "right", "value")


def _nodes_of(root: Any, tree: int, weight: float) -> list[tuple]:
    """The nodes below a fitted tree's root, numbered from it level by level."""
    rows, level, next_number = [], [root], 1
    while level:
        below: list[Any] = []
        for node in level:
            number = len(rows)
            if node.getClass().getSimpleName() == "LeafNode":
                rows.append((tree, number, -1, 0.0, -1, -1, node.prediction(), weight))
            else:
                split = node.split()
                rows.append((tree, number, split.featureIndex(), split.threshold(), next_number, next_number + 1, 0.0, weight))
                below += [node.leftChild(), node.rightChild()]
                next_number += 2
        level = below
    return rows


def tree_nodes(model: PipelineModel) -> DataFrame:
    """The node table of a pipeline that ends in boosted trees over continuous features."""
    fitted = model.stages[-1]
    rows = [row for k, (tree, weight) in enumerate(zip(fitted.trees, fitted.treeWeights, strict=True)) for row in _nodes_of(tree._call_java("rootNode"), k, float(weight))]
    return SparkSession.active().createDataFrame(rows, NODES)


def walked(nodes: DataFrame) -> Column:
    """All trees as one scalar: an array of structs of arrays, each in the order of the nodes,
    with the number of steps that the deepest needs at most."""
    ordered = F.array_sort(F.collect_list(F.struct("node", *_WALKED)))
    trees = nodes.groupBy("tree", "weight").agg(ordered.alias("n"))
    arrays = [F.col("n")[c].alias(c) for c in _WALKED]  # a field of all structs
    trees = trees.select("tree", F.struct("weight", *arrays).alias("t"))
    return one_row(trees.agg(F.transform(F.array_sort(F.collect_list(F.struct("tree", "t"))), lambda p: p["t"]).alias("trees")))["trees"]


def margin(x: Column, trees: Column, depth: int) -> Column:
    """The weighted sum of the leaves that ``x``, an array of features, ends in after at most
    ``depth`` steps down each of ``trees`` (from ``walked``)."""

    def leaf(tree: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            goes_left = F.get(x, F.get(tree["feature"], at)) <= F.get(tree["threshold"], at)
            below = F.when(goes_left, F.get(tree["left"], at)).otherwise(F.get(tree["right"], at))
            return F.when(F.get(tree["feature"], at) < 0, at).otherwise(below)

        return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)

    return F.aggregate(trees, F.lit(0.0), lambda total, tree: total + tree["weight"] * F.get(tree["value"], leaf(tree)))
