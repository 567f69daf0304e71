"""Forecasts by exponential smoothing: a level, a trend and a weekly season that follow the data.

The state of a series is folded over its days in order, in one expression over the sorted
array of its values; several settings of the smoothing constants are tried side by side
and the one with the least squared error is kept. A series is as long as its calendar, so
its array is small however many sales it sums up. No Python, and one shuffle, by series.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillview.operators.forecast import HORIZON, MIN_DAYS, WEEK, Z95, _output, fill_gaps

# How much of an error goes into the level, the trend and the season.
LEVELS, TRENDS, SEASONS = (0.05, 0.2, 0.5), (0.0, 0.02), (0.05, 0.2)


def _steps(y: Column, level: Column, trend: Column, season: Column) -> Column:
    """The state after all days: from the means of the first week and of the second, each
    later day corrects what was expected of it."""
    def mean_of(first: int) -> Column:
        return F.aggregate(F.slice(y, first + 1, WEEK), F.lit(0.0), lambda total, v: total + v) / F.lit(float(WEEK))

    def corrected(state: Column, value: Column) -> Column:
        day = F.pmod(state["day"], F.lit(WEEK))
        usual = F.get(state["season"], day)
        error = value - (state["level"] + state["trend"] + usual)
        return F.struct(
            (state["level"] + state["trend"] + level * error).alias("level"),
            (state["trend"] + trend * error).alias("trend"),
            F.transform(state["season"], lambda s, i: F.when(i == day, s + season * error).otherwise(s)).alias("season"),
            (state["squares"] + error * error).alias("squares"),
            (state["day"] + 1).alias("day"),
        )

    start = F.struct(
        mean_of(0).alias("level"),
        ((mean_of(WEEK) - mean_of(0)) / F.lit(float(WEEK))).alias("trend"),
        F.transform(F.slice(y, 1, WEEK), lambda v: v - mean_of(0)).alias("season"),
        F.lit(0.0).alias("squares"),
        F.lit(WEEK).alias("day"),
    )
    return F.aggregate(F.slice(y, F.lit(WEEK + 1), F.size(y)), start, corrected)


def fit_smoothing(series: DataFrame, min_days: int = MIN_DAYS) -> DataFrame:
    """The best setting of every series that is long enough: series_id, last (date), days,
    alpha, beta, gamma and the final level, trend, season and squares (sum of squared
    errors after the first week). Ties go to the smaller constants."""
    if min_days < 2 * WEEK:
        raise ValueError(f"two weeks are needed to begin with, not {min_days} days")
    filled = fill_gaps(series, min_days)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("date", "y"))), lambda d: d["y"])
    arrays = filled.groupBy("series_id").agg(F.max("date").alias("last"), ordered.alias("y")).filter(F.size("y") >= 2 * WEEK)
    grid = F.array(*(F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(g).alias("gamma")) for a, b, g in itertools.product(LEVELS, TRENDS, SEASONS)))
    tried = arrays.withColumn("c", F.explode(grid)).select("series_id", "last", F.size("y").alias("days"), "c.*", _steps(F.col("y"), F.col("c.alpha"), F.col("c.beta"), F.col("c.gamma")).alias("s"))
    best = Window.partitionBy("series_id").orderBy("s.squares", "alpha", "beta", "gamma")
    kept = tried.withColumn("place", F.row_number().over(best)).filter("place = 1")
    return kept.select("series_id", "last", "days", "alpha", "beta", "gamma", "s.level", "s.trend", "s.season", "s.squares")


def forecast_smoothing(series: DataFrame, horizon: int = HORIZON, min_days: int = MIN_DAYS) -> DataFrame:
    """``horizon`` days after each series' last, with 95 % bounds that widen as the errors of the
    days between add up."""
    ahead = fit_smoothing(series, min_days).withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    level = F.col("level") + F.col("h") * F.col("trend") + F.get("season", F.pmod(F.col("days") + F.col("h") - 1, F.lit(WEEK)))

    def weight(j: Column) -> Column:
        """How much of an error is still there ``j`` days later."""
        return F.col("alpha") + F.col("beta") * j + F.when(j % WEEK == 0, F.col("gamma")).otherwise(F.lit(0.0))

    days = F.when(F.col("h") > 1, F.sequence(F.lit(1), F.col("h") - 1)).otherwise(F.array().cast("array<int>"))
    growth = F.aggregate(days, F.lit(1.0), lambda total, j: total + weight(j) * weight(j))
    margin = F.lit(Z95) * F.sqrt(F.col("squares") / (F.col("days") - WEEK) * growth)
    return _output(ahead, F.date_add("last", F.col("h")), level, level - margin, level + margin, "exponential_smoothing", F.lit(True))
