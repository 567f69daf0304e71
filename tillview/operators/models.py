"""Churn and lifetime-value models with Spark ML.

Training is iterative: pass stored feature tables. Functions that fit or
evaluate run jobs.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillview.functions.measures import hash_bucket, select_available
from tillview.functions.policies import CLV_LABEL_RANGE
from tillview.operators.lifetime import clv_features
from tillview.operators.running import totals_before
from tillview.operators.trees import margin, tree_nodes, walked

# The model inputs.
CHURN_FEATURES = [
    "days_since_last_purchase",
    "total_transactions",
    "total_revenue",
    "avg_transaction_value",
    "transactions_last_30d",
    "transactions_last_60d",
    "transactions_last_90d",
    "revenue_last_30d",
    "distinct_categories_purchased",
    "return_count",
    "return_rate",
    "current_loyalty_points",
    "loyalty_tier_numeric",
    "total_crm_interactions",
    "complaint_count",
    "avg_crm_satisfaction",
    "unresolved_issues",
    "total_web_sessions",
    "web_conversions",
    "web_conversion_rate",
    "abandoned_cart_count",
    "total_support_tickets",
    "high_priority_tickets",
    "dissatisfied_ticket_count",
    "purchase_frequency",
    "customer_tenure_days",
    "recency_score",
    "frequency_score",
    "monetary_score",
]
# The churn label is a threshold on the first of these; the others restate it.
CHURN_LEAKS = [
    "days_since_last_purchase",
    "transactions_last_30d",
    "transactions_last_60d",
    "transactions_last_90d",
    "revenue_last_30d",
    "recency_score",
]
CLV_FEATURES = [
    "historical_revenue",
    "avg_transaction_revenue",
    "purchase_count",
    "purchase_frequency_monthly",
    "avg_days_between_purchases",
    "categories_purchased",
    "avg_items_per_transaction",
    "recency_days",
    "customer_age_days",
]
CLV_ENRICHMENT = [
    "customer_tenure_days",
    "return_rate",
    "current_loyalty_points",
    "web_conversion_rate",
]
# Hyperparameters.
SEED = 42
TRAIN_PERCENT = 80
LINEAR = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}
BOOSTED = {"maxIter": 50, "maxDepth": 5}

NOT_FEATURES = ("customer_id", "label")


def split_by_hash(
    df: DataFrame, key: str = "customer_id", train_percent: int = TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: the same under any partitioning, and
    narrow, so neither side is recomputed to be counted or shuffled."""
    bucket = hash_bucket(key)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def churn_training_set(features: DataFrame, leak_free: bool = True) -> DataFrame:
    """``customer_id``, the features that exist and the label, NULL as 0.

    By default without the columns the label is made from; with
    ``leak_free=False`` all of them."""
    wanted = [c for c in CHURN_FEATURES if not (leak_free and c in CHURN_LEAKS)]
    chosen = select_available(
        features, ["customer_id", *wanted, "is_churned"], ("customer_id", "is_churned")
    )
    return chosen.withColumnRenamed("is_churned", "label").na.fill(0)


def clv_training_set(clv: DataFrame, features: DataFrame) -> DataFrame:
    """CLV features joined with ``cf_``-prefixed customer features, NULL as 0.

    The label is the 3-year value where the table has it, else the historical
    revenue; labels outside the plausible range are left out."""
    label = next((c for c in ("predicted_clv_3yr", "historical_revenue") if c in clv.columns), None)
    if label is None:
        raise ValueError("the CLV table has no column to learn")
    own = [c for c in CLV_FEATURES if c in clv.columns]
    extra = [c for c in CLV_ENRICHMENT if c in features.columns]
    enrichment = features.select(
        "customer_id", *[F.col(c).cast("double").alias(f"cf_{c}") for c in extra]
    )
    low, high = CLV_LABEL_RANGE
    return (
        clv.select(
            "customer_id",
            *[F.col(c).cast("double").alias(c) for c in own],
            F.col(label).cast("double").alias("label"),
        )
        .join(enrichment, "customer_id", "left")
        .na.fill(0.0)
        .filter((F.col("label") > low) & (F.col("label") < high))
        .select("customer_id", *own, *[f"cf_{c}" for c in extra], "label")
    )


def clv_future_set(lines: DataFrame, customers: DataFrame, cutoff: date) -> DataFrame:
    """CLV features up to ``cutoff`` against the revenue after it: a label that
    is not a product of the features. NULL as 0."""
    past = lines.filter(F.to_date("transaction_date") <= F.lit(cutoff))
    later = (
        lines.filter(F.to_date("transaction_date") > F.lit(cutoff))
        .groupBy("customer_id")
        .agg(F.sum("revenue").cast("double").alias("label"))
    )
    known = clv_features(past, customers, cutoff).select(
        "customer_id", *[F.col(c).cast("double").alias(c) for c in CLV_FEATURES]
    )
    return known.join(later, "customer_id", "left").na.fill(0.0)


def _inputs(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_FEATURES]


def _scaled(columns: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(columns), outputCol="features_raw"),
        StandardScaler(inputCol="features_raw", outputCol="features", withStd=True, withMean=True),
    ]


def fit_churn_lr(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=[*_scaled(_inputs(train)), LogisticRegression(**LINEAR)]).fit(train)


def fit_churn_gbt(train: DataFrame, seed: int = SEED) -> PipelineModel:
    assembler = VectorAssembler(inputCols=_inputs(train), outputCol="features")
    return Pipeline(stages=[assembler, GBTClassifier(seed=seed, **BOOSTED)]).fit(train)


def fit_clv_lr(train: DataFrame) -> PipelineModel:
    return Pipeline(stages=[*_scaled(_inputs(train)), LinearRegression(**LINEAR)]).fit(train)


def churn_predictions(model: PipelineModel, test: DataFrame) -> DataFrame:
    """(customer_id, label, prediction, churn_probability)."""
    return model.transform(test).select(
        "customer_id",
        "label",
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("churn_probability"),
    )


def clv_predictions(model: PipelineModel, test: DataFrame) -> DataFrame:
    return model.transform(test).select("customer_id", "label", "prediction")


def areas_under(predictions: DataFrame, score: str = "churn_probability") -> DataFrame:
    """One row (auc_roc, auc_pr): areas under the curves through every distinct score of rows
    (label, ``score``), trapezia between them; NULL without both classes. Equal scores are one
    point. Rows are counted by score, and those counts summed up by ranges of scores. A job."""
    label = F.col("label").cast("int")
    counted = predictions.groupBy(F.col(score).alias("score")).agg(
        F.count_if(label == 1).alias("pos"), F.count_if(label == 0).alias("neg")
    )
    points = totals_before(counted, F.desc("score"), ["pos", "neg"])
    pos, neg, hits, misses = (F.col(c) for c in ("pos", "neg", "pos_before", "neg_before"))
    after = (hits + pos) / (hits + pos + misses + neg)
    before = F.coalesce(F.try_divide(hits, hits + misses), after)  # the curve begins level
    return points.agg(
        F.try_divide(F.sum(neg * (hits + pos / 2)), F.sum(pos) * F.sum(neg)).alias("auc_roc"),
        F.try_divide(F.sum(pos * (after + before) / 2), F.sum(pos)).alias("auc_pr"),
    )


def binary_metrics(
    predictions: DataFrame, name: str, score: str = "churn_probability"
) -> DataFrame:
    """(model, metric, value) of scored rows (label, prediction, ``score``): areas
    under ROC and PR over every distinct score, accuracy, and F1 weighted by the
    classes' sizes. Runs jobs; the rows should be a stored table."""
    areas = areas_under(predictions, score).first()
    cells = {(r["label"], r["prediction"]): r["count"] for r in confusion_matrix(predictions).collect()}
    rows = sum(cells.values())
    f1 = 0.0
    for side in {label for label, _ in cells}:
        actual = sum(n for (label, _), n in cells.items() if label == side)
        guessed = sum(n for (_, guess), n in cells.items() if guess == side)
        f1 += actual / rows * 2 * cells.get((side, side), 0) / (actual + guessed)
    accuracy = sum(n for (label, guess), n in cells.items() if label == guess) / rows if rows else 0.0
    values = [("auc_roc", areas["auc_roc"]), ("auc_pr", areas["auc_pr"]), ("accuracy", accuracy), ("f1", f1)]
    return predictions.sparkSession.createDataFrame(
        [(name, metric, value) for metric, value in values],
        "model string, metric string, value double",
    )


def _slopes(model: PipelineModel, rows: DataFrame, residual: Column) -> tuple[list[float], float, int]:
    """Mean of residual times each scaled input, mean residual, and rows, as one aggregate."""
    scored = model.transform(rows).select(residual.alias("residual"), vector_to_array("features").alias("x"))
    width = model.stages[-1].numFeatures
    row = scored.agg(F.count("*").alias("rows"), F.avg("residual").alias("mean"), *(F.avg(F.col("residual") * F.col("x")[i]).alias(f"x{i}") for i in range(width))).first()
    return [row[f"x{i}"] for i in range(width)], row["mean"], row["rows"]


def _excess(slopes: Sequence[float], weights: Sequence[float], l1: float, l2: float) -> float:
    """How far weights are from the least of a loss whose slope (without penalties) is given:
    at a weight other than 0 the whole slope must vanish, at 0 it may be up to ``l1``."""
    out = 0.0
    for slope, weight in zip(slopes, weights, strict=True):
        whole = slope + l2 * weight
        out = max(out, abs(whole + (l1 if weight > 0 else -l1)) if weight else max(0.0, abs(whole) - l1))
    return out


def churn_lr_gap(model: PipelineModel, train: DataFrame) -> tuple[int, float]:
    """(training rows, greatest slope of the penalised loss at the fitted weights), 0 at the least
    of the loss, which is convex. One pass over ``train``."""
    fitted = model.stages[-1]
    residual = vector_to_array("probability")[1] - F.col("label")
    slopes, mean, rows = _slopes(model, train, residual)
    share, strength = LINEAR["elasticNetParam"], LINEAR["regParam"]
    gap = _excess(slopes, fitted.coefficients.toArray().tolist(), strength * share, strength * (1 - share))
    return rows, max(gap, abs(mean))


def clv_lr_gap(model: PipelineModel, train: DataFrame) -> tuple[int, float]:
    """The same for the lifetime-value regression, as a share of the label's deviation, which
    also divides the quadratic penalty there."""
    fitted = model.stages[-1]
    spread = train.agg(F.stddev_samp("label")).first()[0]
    slopes, mean, rows = _slopes(model, train, F.col("prediction") - F.col("label"))
    share, strength = LINEAR["elasticNetParam"], LINEAR["regParam"]
    gap = _excess(slopes, fitted.coefficients.toArray().tolist(), strength * share, strength * (1 - share) / spread)
    return rows, max(gap, abs(mean)) / spread


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("label", "prediction").count()


def feature_importance(model: PipelineModel, n: int = 10) -> list[tuple[str, float]]:
    """The ``n`` most important inputs of a fitted tree model, descending."""
    columns = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(columns, map(float, weights), strict=True), key=lambda p: (-p[1], p[0]))
    return ranked[:n]


def regression_metrics(predictions: DataFrame) -> DataFrame:
    """One row: RMSE, MAE and R2, in one pass of built-in aggregates."""
    label, error = F.col("label"), F.col("label") - F.col("prediction")
    return predictions.agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.avg(error * error), F.var_pop(label))).alias("r2"),
    )


def gbt_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(customer_id, label, margin, churn_probability) by the trees' own nodes: the same scores as
    the model's, from its node table and built-in expressions."""
    inputs = F.array(*(F.col(c).cast("double") for c in model.stages[0].getInputCols()))
    scored = rows.withColumn("_trees", walked(tree_nodes(model))).withColumn("margin", margin(inputs, F.col("_trees"), BOOSTED["maxDepth"]))
    chance = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * F.col("margin")))
    return scored.select("customer_id", "label", "margin", chance.alias("churn_probability"))


def model_metrics(spark: SparkSession, churn: dict[str, DataFrame], clv: DataFrame) -> DataFrame:
    """(model, metric, value) of churn predictions by model name and of lifetime-value predictions. Runs jobs."""
    parts = [binary_metrics(scored, name) for name, scored in churn.items()]
    errors = regression_metrics(clv).first().asDict()
    parts.append(spark.createDataFrame([("clv_lr", name, value) for name, value in errors.items()], parts[0].schema if parts else "model string, metric string, value double"))
    return reduce(DataFrame.unionByName, parts)


def load_model(path: str) -> PipelineModel:
    """A model that ``save_model`` has written."""
    return PipelineModel.load(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path
