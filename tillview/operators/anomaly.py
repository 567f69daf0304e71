"""Isolation forest: trees grown and rows scored on the executors."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillview.functions.measures import one_row
from tillview.operators.ranks import value_at
from tillview.sources.staging import stage

# Functions of this module run on executors, which need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The features of the model, by name.
ANOMALY_FEATURES = [
    "total_transactions",
    "total_revenue",
    "avg_transaction_value",
    "return_rate",
    "days_since_last_purchase",
    "web_conversion_rate",
    "purchase_frequency",
]
# Forest size, rows per tree, share of anomalies.
TREES = 100
TREE_ROWS = 256
CONTAMINATION = 0.05
SEED = 42

NODES = "tree int, node int, feature int, threshold double, left int, right int, size int"
EULER = 0.5772156649015329
HASH_RANGE = 2**31
# Rows drawn per row wanted: the chance of drawing too few is nil.
DRAWS_PER_ROW = 8


def anomaly_features(features: DataFrame, columns: Sequence[str] = tuple(ANOMALY_FEATURES)) -> DataFrame:
    """``customer_id`` and the columns that exist, as doubles, NULL as 0."""
    if "customer_id" not in features.columns:
        raise ValueError("customer_id is required")
    have = [c for c in columns if c in features.columns]
    return features.select(
        "customer_id", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in have]
    )


def unsuccessful_path(n: np.ndarray) -> np.ndarray:
    """Mean depth at which a search in a random binary tree of n rows ends."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def tree_samples(
    numbers: DataFrame, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED
) -> DataFrame:
    """``rows`` customers per tree, drawn without replacement from all of them.

    Each tree draws by a hash of its own, a few times what it needs: a row is
    repeated only for the trees that draw it, so what is shuffled is bounded by
    trees x rows however large the table is. Of its draws each tree keeps the
    smallest hashes. The result depends on ids and seed only, not on the
    partitioning."""
    total = one_row(numbers.agg(F.count("*").alias("n")))["n"]

    def draw(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), tree, F.col("customer_id")), F.lit(HASH_RANGE))

    reach = F.lit(float(HASH_RANGE) * DRAWS_PER_ROW * rows)
    drawn = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: draw(tree).cast("double") * F.col("total") <= reach,
    )
    order = Window.partitionBy("tree").orderBy("draw", "customer_id")
    return (
        numbers.withColumn("total", total)
        .withColumn("tree", F.explode(drawn))
        .withColumn("draw", draw(F.col("tree")))
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= rows)
    )


def _grow(values: np.ndarray, tree: int, seed: int) -> list[tuple]:
    """Random splits down to single rows or the usual depth limit."""
    rng = np.random.default_rng([seed, tree])
    limit = math.ceil(math.log2(max(len(values), 2)))
    nodes: list[list] = []
    todo = [(np.arange(len(values)), 0, -1, "")]
    while todo:
        members, depth, parent, side = todo.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][4 if side == "left" else 5] = here
        nodes.append([tree, here, -1, 0.0, -1, -1, len(members)])
        low, high = values[members].min(axis=0), values[members].max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(members) < 2 or len(splittable) == 0:
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = values[members, feature] <= threshold
        nodes[here][2:4] = [feature, threshold]
        todo.append((members[~goes_left], depth + 1, here, "right"))
        todo.append((members[goes_left], depth + 1, here, "left"))
    return [tuple(n) for n in nodes]


def fit_forest(
    numbers: DataFrame,
    trees: int = TREES,
    rows: int = TREE_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """The forest as a node table, at most trees x 2 x rows nodes. Each group
    handed to Python is one tree's sample, ``rows`` rows."""
    columns = [c for c in numbers.columns if c != "customer_id"]
    kinds = dict(p.split() for p in NODES.split(", "))
    types = {"int": "int32", "double": "float64"}

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("place")
        tree = int(sample["tree"].iloc[0])
        nodes = _grow(sample[columns].to_numpy(dtype=float), tree, seed)
        return pd.DataFrame(nodes, columns=list(kinds)).astype({c: types[k] for c, k in kinds.items()})

    return tree_samples(numbers, trees, rows, seed).groupBy("tree").applyInPandas(grow, NODES)


def score_forest(numbers: DataFrame, forest: DataFrame) -> DataFrame:
    """``anomaly_score`` of every row: -2^(-mean depth / expected depth), lower
    is more anomalous. Collects the node table, whose size is fixed by the
    forest's parameters, and sends it to the tasks."""
    columns = [c for c in numbers.columns if c != "customer_id"]
    nodes = forest.toPandas().sort_values(["tree", "node"])
    sample_rows = int(nodes.loc[nodes["node"] == 0, "size"].max())
    expected = float(unsuccessful_path(np.array([sample_rows]))[0]) or 1.0
    packed = [
        tuple(part[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size"))
        for _, part in nodes.groupby("tree")
    ]
    model = numbers.sparkSession.sparkContext.broadcast(packed)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch[columns].to_numpy(dtype=float)
            row = np.arange(len(values))
            depth = np.zeros(len(values))
            for feature, threshold, left, right, size in model.value:
                at = np.zeros(len(values), dtype=np.int64)
                inner = feature[at] >= 0
                while inner.any():
                    f = np.where(inner, feature[at], 0)
                    to = np.where(values[row, f] <= threshold[at], left[at], right[at])
                    at = np.where(inner, to, at)
                    depth += inner
                    inner = feature[at] >= 0
                depth += unsuccessful_path(size[at])
            yield pd.DataFrame(
                {
                    "customer_id": batch["customer_id"],
                    "anomaly_score": -np.exp2(-depth / len(model.value) / expected),
                }
            )

    return numbers.mapInPandas(score, "customer_id string, anomaly_score double")


def flag_anomalies(scores: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """``is_anomaly`` beside the score: 1 for the ``ceil((n - 1) * contamination)``
    lowest of n scores, and for scores equal to the highest of these. Runs a job."""
    share = F.lit(str(contamination)).cast("decimal(9,8)")
    cut = value_at(scores, "anomaly_score", lambda n: F.ceil((n - 1) * share), "double")
    flag = F.coalesce(F.col("anomaly_score") <= cut, F.lit(False)).cast("int")
    return scores.select("customer_id", flag.alias("is_anomaly"), "anomaly_score")


def isolation_forest(
    features: DataFrame,
    columns: Sequence[str] = tuple(ANOMALY_FEATURES),
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    seed: int = SEED,
) -> DataFrame:
    """(customer_id, is_anomaly, anomaly_score) for every customer.

    Runs jobs: the scores are staged, since the cut needs them before the flag
    can be set."""
    numbers = anomaly_features(features, columns)
    scores = stage(score_forest(numbers, fit_forest(numbers, trees, seed=seed)), "anomaly-scores")
    return flag_anomalies(scores, contamination)


def top_anomalies(anomalies: DataFrame, features: DataFrame, n: int = 10) -> DataFrame:
    """The most anomalous customers with the features they were judged by. The
    top rows are chosen before the join, so only ``n`` rows enter it."""
    worst = (
        anomalies.filter("is_anomaly = 1").orderBy("anomaly_score", "customer_id").limit(n)
    )
    numbers = anomaly_features(features)
    return (
        worst.join(numbers, "customer_id", "left")
        .select("customer_id", "anomaly_score", *numbers.columns[1:])
        .orderBy("anomaly_score", "customer_id")
    )
