"""Daily demand forecasts, for one series or for many at once.

A series table has the columns ``series_id``, ``date`` and ``y``, one row per
series and date. Everything about a series, filling its gaps, fitting and
forecasting it, happens in windows over ``series_id``: the table is shuffled
once, and no step joins. A series is as long as its calendar, so its window is
small however many sales it sums up.
"""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillview.functions.measures import one_row

HORIZON = 30
MIN_DAYS = 14
WEEK = 7
Z95 = 1.96
ALL = "all"
OUTPUT = [
    "series_id",
    "forecast_date",
    "predicted_revenue",
    "lower_bound",
    "upper_bound",
    "model_type",
    "is_future",
]


def _series() -> WindowSpec:
    return Window.partitionBy("series_id")


def revenue_series(daily: DataFrame, by: str | None = None, value: str = "total_revenue") -> DataFrame:
    """A series table from a daily sales table, one series per value of ``by``."""
    series = F.col(by) if by else F.lit(ALL)
    return daily.select(
        series.alias("series_id"), F.col("date"), F.col(value).cast("double").alias("y")
    ).filter(F.col("y").isNotNull())


def skipped_series(series: DataFrame, min_days: int = MIN_DAYS) -> DataFrame:
    """Series with too little history to forecast."""
    days = series.groupBy("series_id").agg(F.count("*").alias("days"))
    return days.filter(F.col("days") < min_days)


def fill_gaps(
    series: DataFrame, min_days: int = MIN_DAYS, held_out_days: int = 0
) -> DataFrame:
    """Every date from a series' first to its last, with 0 where none was
    recorded, and ``t``, the days since the first.

    Each recorded date brings along the empty ones up to the next record, so no
    calendar has to be joined. ``train`` is true up to the last record that is
    not among the last ``held_out_days`` days, ``held_out`` in those days.
    Series with fewer than ``min_days`` records to train on are left out."""
    cut = F.date_sub("end", held_out_days)
    trained = F.when(F.col("date") <= cut, F.col("date"))
    recorded = (
        series.withColumns(
            {
                "start": F.min("date").over(_series()),
                "end": F.max("date").over(_series()),
                "next": F.lead("date").over(_series().orderBy("date")),
            }
        )
        .withColumns(
            {"trained_to": F.max(trained).over(_series()), "days": F.count(trained).over(_series())}
        )
        .filter(F.col("days") >= min_days)
    )
    until = F.coalesce(F.date_sub("next", 1), F.col("date"))
    return recorded.withColumn("day", F.explode(F.sequence("date", until))).select(
        "series_id",
        F.col("day").alias("date"),
        F.datediff("day", "start").alias("t"),
        F.dayofweek("day").alias("weekday"),
        F.when(F.col("day") == F.col("date"), F.col("y")).otherwise(F.lit(0.0)).alias("y"),
        (F.col("day") <= F.col("trained_to")).alias("train"),
        (F.col("day") > cut).alias("held_out"),
    )


def fit_trend_weekday(
    series: DataFrame, min_days: int = MIN_DAYS, held_out_days: int = 0
) -> DataFrame:
    """A linear trend plus one offset per weekday, for each series: the filled
    history with ``prediction`` and ``sd``, the deviation of the residuals."""

    def trained(value: Column) -> Column:
        return F.when(F.col("train"), value)

    y, t = F.col("y"), F.col("t")
    same_weekday = Window.partitionBy("series_id", "weekday")
    return (
        fill_gaps(series, min_days, held_out_days)
        .withColumns(
            {
                "slope": F.regr_slope(trained(y), trained(t)).over(_series()),
                "base": F.regr_intercept(trained(y), trained(t)).over(_series()),
            }
        )
        .withColumn("line", F.col("base") + F.col("slope") * t)
        .withColumn("effect", F.avg(trained(y - F.col("line"))).over(same_weekday))
        .withColumn("prediction", F.col("line") + F.col("effect"))
        .withColumn("sd", F.stddev_samp(trained(y - F.col("prediction"))).over(_series()))
        .drop("base", "line", "effect")
    )


def _output(
    df: DataFrame,
    when: Column,
    prediction: Column,
    lower: Column,
    upper: Column,
    model: str,
    future: Column,
) -> DataFrame:
    return df.select(
        "series_id",
        when.alias("forecast_date"),
        prediction.alias("predicted_revenue"),
        lower.alias("lower_bound"),
        upper.alias("upper_bound"),
        F.lit(model).alias("model_type"),
        future.alias("is_future"),
    )


def forecast_trend_weekday(fitted: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Fitted values without bounds, then ``horizon`` future days with 95 %
    bounds, per series.

    A future day lies whole weeks after one of the last seven and differs from
    it by the trend alone, so those seven rows carry the forecast: no join with
    the weekday offsets, and one pass for past and future."""
    left = F.datediff(F.max("date").over(_series()), F.col("date"))
    weeks = F.floor((F.lit(horizon) + F.col("left")) / F.lit(WEEK)).cast("int")
    ahead = F.when(F.col("left") < WEEK, F.sequence(F.lit(0), weeks)).otherwise(F.array(F.lit(0)))
    rows = (
        fitted.withColumn("left", left)
        .withColumn("week", F.explode(ahead))
        .withColumn("shift", F.col("week") * WEEK)
    )
    level = F.col("prediction") + F.col("slope") * F.col("shift")
    margin = F.when(F.col("week") > 0, F.lit(Z95) * F.col("sd"))
    when = F.date_add("date", F.col("shift"))
    return _output(rows, when, level, level - margin, level + margin, "trend_weekday", F.col("week") > 0)


def next_days(forecast: DataFrame, n: int = 7) -> DataFrame:
    """The first ``n`` days after each series' history."""
    first = F.min(F.when(F.col("is_future"), F.col("forecast_date"))).over(_series())
    near = F.col("is_future") & (F.col("forecast_date") < F.date_add(first, n))
    return forecast.withColumn("near", near).filter("near").select(*OUTPUT)


def forecast_metrics(fitted: DataFrame) -> DataFrame:
    """In-sample MAE, RMSE and MAPE per series; MAPE over days with a non-zero
    actual only, NULL when there is none."""
    error = F.col("y") - F.col("prediction")
    relative = F.when(F.col("y") != 0, F.abs(error / F.col("y")))
    return fitted.groupBy("series_id").agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(relative) * F.lit(100.0)).alias("mape"),
    )


def holdout_metrics(series: DataFrame, days: int = HORIZON) -> DataFrame:
    """The same errors on each series' last ``days`` days, forecast from the
    days before them. Days without a record count as 0."""
    return forecast_metrics(fit_trend_weekday(series, held_out_days=days).filter("held_out"))


# -- one series with yearly and weekly seasons and a bending trend ---------
# Season lengths, Fourier orders, changepoints, interval width.
YEAR_DAYS, YEAR_ORDER = 365.25, 10
WEEK_DAYS, WEEK_ORDER = 7.0, 3
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
Z80 = 1.2816
RIDGE = 0.01


def _season_columns() -> dict[str, Column]:
    day = F.datediff(F.col("date"), F.lit("1970-01-01").cast("date"))
    columns: dict[str, Column] = {}
    for name, length, order in (("year", YEAR_DAYS, YEAR_ORDER), ("week", WEEK_DAYS, WEEK_ORDER)):
        for k in range(1, order + 1):
            angle = day * F.lit(2 * math.pi * k / length)
            columns[f"{name}_sin_{k}"] = F.sin(angle)
            columns[f"{name}_cos_{k}"] = F.cos(angle)
    return columns


def _trend_columns(scaled_t: Column) -> dict[str, Column]:
    """The time itself and a hinge at each changepoint, where the slope may
    bend; the changepoints lie evenly in the first part of the history."""
    columns = {"trend": scaled_t}
    for i in range(1, CHANGEPOINTS + 1):
        bend = CHANGEPOINT_RANGE * i / (CHANGEPOINTS + 1)
        columns[f"bend_{i}"] = F.greatest(scaled_t - F.lit(bend), F.lit(0.0))
    return columns


def forecast_seasonal(
    series: DataFrame, horizon: int = HORIZON, min_days: int = MIN_DAYS
) -> tuple[DataFrame, DataFrame]:
    """(forecast, fitted) of one series by ridge regression on a piecewise
    linear trend and Fourier terms of the year and the week, 80 % bounds.

    The fit is one pass of the normal equations, summed on the executors; the
    model has about 50 coefficients. Runs jobs."""
    if series.select("series_id").distinct().count() != 1:
        raise ValueError("forecast_seasonal takes a single series")
    if skipped_series(series, min_days).count():
        raise ValueError(f"fewer than {min_days} days of history")
    history = fill_gaps(series, min_days).drop("weekday", "train", "held_out")
    last = one_row(history.agg(F.max("t").alias("t"), F.max("date").alias("date")))
    future = history.filter(F.col("date") == last["date"]).select(
        "series_id",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"),
        "date",
        "t",
    ).select(
        "series_id",
        F.date_add("date", F.col("step")).alias("date"),
        (F.col("t") + F.col("step")).alias("t"),
    )
    seasons = _season_columns()
    trend = _trend_columns(F.col("t") / last["t"])
    columns = [*trend, *seasons]
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=columns, outputCol="features"),
            LinearRegression(
                featuresCol="features", labelCol="y", regParam=RIDGE, solver="normal"
            ),
        ]
    ).fit(history.withColumns({**trend, **seasons}))

    def predicted(df: DataFrame) -> DataFrame:
        return model.transform(df.withColumns({**trend, **seasons})).drop("features", *columns)

    fitted = predicted(history).select("series_id", "date", "t", "y", "prediction")
    spread = one_row(fitted.agg(F.stddev_samp(F.col("y") - F.col("prediction")).alias("sd")))["sd"]
    name = "seasonal_regression"
    level, margin = F.col("prediction"), F.lit(Z80) * spread
    day = ["series_id", "date", "prediction"]
    every_day = fitted.select(*day, F.lit(False).alias("future")).unionByName(
        predicted(future).select(*day, F.lit(True).alias("future"))
    )
    out = _output(
        every_day, F.col("date"), level, level - margin, level + margin, name, F.col("future")
    )
    return out, fitted
