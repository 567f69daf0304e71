"""Seasonal forecasts of many series at once, by ridge regression.

Every series has its own bending trend and its own yearly and weekly terms. The columns of
the regression are computed by Spark; a series' rows, as many as its calendar has
days, are then summed up and its small system solved where they lie, all series in
parallel. Predictions are dot products with the coefficients, again in Spark.

The loss of a series is the mean squared error / 2 plus ``RIDGE`` / 2 times the squares of the
coefficients of standardised columns; columns that do not vary have coefficient 0.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillview.operators.forecast import HORIZON, MIN_DAYS, RIDGE, Z80, _output, _season_columns, _trend_columns, fill_gaps

# executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COEFFICIENTS = "days long, intercept double, coefficients array<double>, sd double"


def design(series: DataFrame, horizon: int = HORIZON, min_days: int = MIN_DAYS) -> DataFrame:
    """History and ``horizon`` further days of every series that is long enough: series_id,
    date, y (NULL in the future), is_future and ``x``, the columns of the regression.

    The last day of a series brings its future along, so nothing is joined."""
    whole = Window.partitionBy("series_id")
    filled = fill_gaps(series, min_days).withColumn("last_t", F.max("t").over(whole))
    ahead = F.when(F.col("t") == F.col("last_t"), F.sequence(F.lit(0), F.lit(horizon))).otherwise(F.array(F.lit(0)))
    rows = filled.withColumn("step", F.explode(ahead)).select(
        "series_id",
        F.date_add("date", F.col("step")).alias("date"),
        F.when(F.col("step") == 0, F.col("y")).alias("y"),
        (F.col("step") > 0).alias("is_future"),
        ((F.col("t") + F.col("step")) / F.greatest(F.col("last_t"), F.lit(1))).alias("scaled_t"),
    )
    columns = [*_trend_columns(F.col("scaled_t")).values(), *_season_columns().values()]
    return rows.select("series_id", "date", "y", "is_future", F.array(*columns).alias("x"))


def _solved(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, np.ndarray, float]:
    """Intercept, coefficients and the deviation of the residuals."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    varies = spread > 1e-12
    z = (x[:, varies] - mean[varies]) / spread[varies]
    gram, cross = z.T @ z / len(y), z.T @ (y - y.mean()) / len(y)
    coefficients = np.zeros(x.shape[1])
    coefficients[varies] = np.linalg.solve(gram + ridge * np.eye(len(gram)), cross) / spread[varies]
    intercept = float(y.mean() - mean @ coefficients)
    return intercept, coefficients, float(np.std(y - x @ coefficients - intercept, ddof=1))


def fit_seasonal(rows: DataFrame, ridge: float = RIDGE) -> DataFrame:
    """From ``design``: one row per series with its days, intercept, coefficients and ``sd``."""

    def fit(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        days = group.num_rows
        x = group["x"].combine_chunks().flatten().to_numpy().reshape(days, -1)
        intercept, coefficients, sd = _solved(x, group["y"].to_numpy(), ridge)
        one = [group["series_id"].slice(0, 1), pa.array([days], pa.int64()), pa.array([intercept]), pa.array([coefficients.tolist()]), pa.array([sd])]
        return pa.table(one, ["series_id", "days", "intercept", "coefficients", "sd"])

    kind = dict(rows.dtypes)["series_id"]
    history = rows.filter("not is_future").select("series_id", "y", "x")
    return history.groupBy("series_id").applyInArrow(fit, f"series_id {kind}, {COEFFICIENTS}")


def predicted(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """``rows`` with the coefficients of their series and ``prediction``."""
    terms = F.zip_with("x", "coefficients", lambda a, b: a * b)
    level: Column = F.aggregate(terms, F.col("intercept"), lambda total, term: total + term)
    return rows.join(fitted, "series_id").withColumn("prediction", level)


def forecast_seasonal_many(series: DataFrame, horizon: int = HORIZON, min_days: int = MIN_DAYS) -> DataFrame:
    """Fitted history and ``horizon`` future days of every series, with 80 % bounds."""
    rows = design(series, horizon, min_days)
    level, margin = F.col("prediction"), F.lit(Z80) * F.col("sd")
    every_day = predicted(rows, fit_seasonal(rows))
    return _output(every_day, F.col("date"), level, level - margin, level + margin, "seasonal_regression", F.col("is_future"))


def optimality(rows: DataFrame, fitted: DataFrame, ridge: float = RIDGE) -> DataFrame:
    """How far each series' fit is from the least of its loss, which has one: series_id, days and
    ``gap``, the greatest slope of the loss along a standardised column or the intercept,
    as a share of the deviation of y."""
    history = predicted(rows.filter("not is_future"), fitted).withColumn("residual", F.col("y") - F.col("prediction"))
    each = history.select("series_id", "y", "residual", F.posexplode(F.arrays_zip("x", "coefficients")).alias("column", "c"))
    slopes = each.groupBy("series_id", "column").agg(
        F.count("*").alias("days"),
        F.covar_pop(F.col("c.x"), F.col("residual")).alias("covariance"),
        F.stddev_pop("c.x").alias("spread"),
        F.first("c.coefficients").alias("coefficient"),
        F.avg("residual").alias("mean_residual"),
        F.stddev_pop("y").alias("scale"),
    )
    slope = F.when(F.col("spread") > 1e-12, F.col("covariance") / F.col("spread") - F.lit(ridge) * F.col("spread") * F.col("coefficient")).otherwise(F.col("coefficient"))
    worst = F.greatest(F.abs(slope), F.abs("mean_residual"))
    return slopes.groupBy("series_id").agg(F.max("days").alias("days"), (F.max(worst) / F.greatest(F.max("scale"), F.lit(1e-300))).alias("gap"))
