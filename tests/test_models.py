"""Forecast, anomaly and model operators on planted signals."""

import os
import subprocess
import sys
from datetime import date, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tillview.operators import anomaly, forecast, models, seasonal, smoothing
from tillview.operators.quality import by_group

START = date(2024, 1, 1)


def series(spark, days, value, name="all", skip=()):
    rows = [(name, START + timedelta(d), float(value(d))) for d in range(days) if d not in skip]
    return spark.createDataFrame(rows, "series_id string, date date, y double")


# -- forecast ---------------------------------------------------------------
def test_trend_and_weekday_are_recovered(spark):
    pattern = [0, 5, -5, 10, -10, 3, -3]
    truth = lambda d: 100 + 2 * d + pattern[d % 7]
    model = forecast.fit_trend_weekday(series(spark, 70, truth))
    out = {r.forecast_date: r for r in forecast.forecast_trend_weekday(model).collect()}
    assert len(out) == 100
    for d in (70, 83, 99):
        row = out[START + timedelta(d)]
        assert abs(row.predicted_revenue - truth(d)) < 1.5
        assert row.lower_bound <= row.predicted_revenue <= row.upper_bound
    assert out[START].lower_bound is None


def test_gaps_are_zero_and_short_series_are_skipped(spark):
    both = series(spark, 20, lambda d: 1, skip=(3, 4)).unionByName(series(spark, 13, lambda d: 1, "short"))
    filled = forecast.fill_gaps(both)
    assert [tuple(r) for r in filled.groupBy("series_id").agg(F.count("*"), F.sum("y")).collect()] == [("all", 20, 18.0)]
    assert sorted(r.t for r in filled.collect()) == list(range(20))
    assert [r.series_id for r in forecast.skipped_series(both).collect()] == ["short"]
    assert forecast.fill_gaps(series(spark, 14, lambda d: 1)).count() == 14


def test_next_days(spark):
    s = series(spark, 30, lambda d: d)
    out = forecast.next_days(forecast.forecast_trend_weekday(forecast.fit_trend_weekday(s)))
    assert sorted(r.forecast_date for r in out.collect()) == [START + timedelta(30 + i) for i in range(7)]


def test_many_series_are_shuffled_once(spark):
    out = forecast.forecast_trend_weekday(forecast.fit_trend_weekday(series(spark, 30, lambda d: d)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_metrics_skip_zero_actuals(spark):
    fitted = spark.createDataFrame(
        [("a", 0.0, 1.0), ("a", 10.0, 5.0), ("z", 0.0, 2.0)], "series_id string, y double, prediction double")
    rows = {r.series_id: r for r in forecast.forecast_metrics(fitted).collect()}
    assert (rows["a"].mae, rows["a"].mape) == (3.0, 50.0)
    assert abs(rows["a"].rmse - 13 ** 0.5) < 1e-12
    assert rows["z"].mape is None


def test_holdout_errors_are_small_on_a_clean_line(spark):
    row = forecast.holdout_metrics(series(spark, 100, lambda d: 50 + 3 * d)).first()
    assert row.mae < 1e-6


def test_seasonal_regression_follows_year_and_week(spark):
    truth = lambda d: 200 + 0.1 * d + 30 * np.sin(2 * np.pi * d / 365.25) + (20 if d % 7 == 0 else 0)
    out, fitted = forecast.forecast_seasonal(series(spark, 800, truth))
    error = fitted.agg(F.max(F.abs(F.col("y") - F.col("prediction")))).first()[0]
    assert error < 5
    ahead = {r.forecast_date: r.predicted_revenue for r in out.collect()}
    assert len(ahead) == 830
    assert max(abs(ahead[START + timedelta(d)] - truth(d)) for d in range(800, 830)) < 12
    with pytest.raises(ValueError):
        forecast.forecast_seasonal(series(spark, 13, truth))


def test_many_seasonal_series_are_each_fitted(spark):
    """A long one, a short one, a constant one; one that is too short is left out."""
    truth = {"a": lambda d: 200 + 0.1 * d + 30 * np.sin(2 * np.pi * d / 365.25) + (20 if d % 7 == 0 else 0), "b": lambda d: 40 - d + 9 * (d % 7 == 3), "c": lambda d: 5}
    parts = [series(spark, 800, truth["a"], "a"), series(spark, 60, truth["b"], "b"), series(spark, 20, truth["c"], "c"), series(spark, 13, truth["c"], "d")]
    every = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    rows = seasonal.design(every).persist()
    fitted = seasonal.fit_seasonal(rows).persist()
    assert {r.series_id: r.days for r in fitted.collect()} == {"a": 800, "b": 60, "c": 20}
    assert all(r.gap < 1e-9 for r in seasonal.optimality(rows, fitted).collect())
    worse = fitted.withColumn("coefficients", F.transform("coefficients", lambda c: c * 1.01))
    assert {r.series_id for r in seasonal.optimality(rows, worse).filter("gap > 1e-4").collect()} == {"a", "b"}
    out = {(r.series_id, r.forecast_date): r for r in seasonal.forecast_seasonal_many(every).collect()}
    assert len(out) == 830 + 90 + 50
    ahead = [abs(out["a", START + timedelta(d)].predicted_revenue - truth["a"](d)) for d in range(800, 830)]
    assert max(ahead) < 12
    assert out["c", START + timedelta(25)].predicted_revenue == pytest.approx(5) and out["c", START + timedelta(25)].is_future
    x = np.random.default_rng(3).normal(size=(40, 5))
    y = x @ [1, 2, 0, -1, 3] + 7
    assert seasonal._solved(x, y, 0.0)[1] == pytest.approx([1, 2, 0, -1, 3])


def slow_smoothing(y, a, b, g):
    """Level, trend, season and squared errors after all days of a list."""
    level, trend = sum(y[:7]) / 7, (sum(y[7:14]) / 7 - sum(y[:7]) / 7) / 7
    season, squares = [v - level for v in y[:7]], 0.0
    for day, v in enumerate(y[7:], 7):
        e = v - (level + trend + season[day % 7])
        level, trend = level + trend + a * e, trend + b * e
        season[day % 7] += g * e
        squares += e * e
    return squares, level, trend, season


def test_smoothing_is_the_recursion_at_its_best_constants(spark):
    draw = np.random.default_rng(8)
    noise = draw.normal(size=200)
    values = {"up": lambda d: 10 + d + 5 * (d % 7) + noise[d], "jump": lambda d: (100 if d > 60 else 10) + noise[d], "short": lambda d: d}
    every = series(spark, 90, values["up"], "up").union(series(spark, 120, values["jump"], "jump", skip={70})).union(series(spark, 13, values["short"], "short"))
    got = {r.series_id: r for r in smoothing.fit_smoothing(every).collect()}
    assert set(got) == {"up", "jump"}
    for name, days in (("up", 90), ("jump", 120)):
        y = [0.0 if (name, d) == ("jump", 70) else float(values[name](d)) for d in range(days)]
        tried = {(a, b, g): slow_smoothing(y, a, b, g) for a in smoothing.LEVELS for b in smoothing.TRENDS for g in smoothing.SEASONS}
        best = min(tried, key=lambda k: (tried[k][0], k))
        r = got[name]
        assert (r.alpha, r.beta, r.gamma, r.days) == (*best, days)
        assert (r.squares, r.level, r.trend) == pytest.approx(tried[best][:3]) and r.season == pytest.approx(tried[best][3])
    ahead = {(r.series_id, (r.forecast_date - START).days): r for r in smoothing.forecast_smoothing(every).collect()}
    assert len(ahead) == 60
    assert all(abs(ahead["up", d].predicted_revenue - (10 + d + 5 * (d % 7))) < 12 for d in range(90, 120))
    widths = [ahead["up", d].upper_bound - ahead["up", d].lower_bound for d in range(90, 120)]
    assert widths == sorted(widths) and widths[0] > 0


def test_areas_under_curves_keep_ties_whole(spark):
    """Against the points of the curves, one per distinct score."""
    draw = np.random.default_rng(5)
    rows = [(int(draw.random() < 0.3 + 0.4 * (s / 9)), float(s)) for s in draw.integers(0, 10, 500)]
    df = spark.createDataFrame(rows, "label int, churn_probability double").repartition(7)
    got = models.areas_under(df).first()
    p = sum(label for label, _ in rows)
    n = len(rows) - p
    points, hits, misses = [], 0, 0
    for cut in sorted({s for _, s in rows}, reverse=True):
        hits += sum(1 for label, s in rows if s == cut and label)
        misses += sum(1 for label, s in rows if s == cut and not label)
        points.append((hits / p, misses / n, hits / (hits + misses)))
    roc = sum((b[1] - a[1]) * (a[0] + b[0]) / 2 for a, b in zip([(0.0, 0.0), *points], points, strict=False))
    pr = sum((b[0] - a[0]) * (a[2] + b[2]) / 2 for a, b in zip([(0.0, 0.0, points[0][2]), *points], points, strict=False))
    assert (got.auc_roc, got.auc_pr) == pytest.approx((roc, pr))
    assert tuple(models.areas_under(df.filter("label = 0")).first()) == (None, None)


# -- isolation forest -------------------------------------------------------
@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(1)
    rows = [(f"c{i}", *map(float, rng.normal(size=3))) for i in range(600)]
    rows += [(f"odd{i}", 9.0 + i, -9.0 - i, 9.0) for i in range(6)]
    return spark.createDataFrame(rows, "customer_id string, total_transactions double, total_revenue double, return_rate double")


def test_planted_outliers_come_first(spark, planted):
    out = anomaly.isolation_forest(planted)
    assert out.count() == 606
    worst = [r.customer_id for r in out.orderBy("anomaly_score").limit(6).collect()]
    assert all(w.startswith("odd") for w in worst)
    flagged = out.filter("is_anomaly = 1").count()
    assert flagged == 31  # ceil(605 * 0.05)
    assert out.agg(F.min("anomaly_score")).first()[0] >= -1 and out.agg(F.max("anomaly_score")).first()[0] <= 0
    top = anomaly.top_anomalies(out, planted, 3).collect()
    assert [r.customer_id for r in top] == worst[:3] and top[0].total_transactions > 8


def test_scores_do_not_depend_on_partitioning(spark, planted):
    def scores(df):
        numbers = anomaly.anomaly_features(df)
        forest = anomaly.fit_forest(numbers, trees=10)
        return sorted(map(tuple, anomaly.score_forest(numbers, forest).collect()))

    assert scores(planted.repartition(2)) == scores(planted.repartition(7, "total_revenue"))


def test_tree_samples_are_bounded(spark, planted):
    samples = anomaly.tree_samples(anomaly.anomaly_features(planted), trees=4, rows=32)
    assert [r["count"] for r in samples.groupBy("tree").count().collect()] == [32] * 4
    assert samples.select("customer_id").distinct().count() < 300


def test_path_length_constants():
    assert anomaly.unsuccessful_path(np.array([0, 1, 2])).tolist() == [0.0, 0.0, 1.0]
    assert abs(anomaly.unsuccessful_path(np.array([256]))[0] - 10.244770920116851) < 1e-9


# -- models -----------------------------------------------------------------
@pytest.fixture(scope="module")
def churn(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        x, noise = rng.normal(), rng.normal()
        rows.append((f"c{i}", float(x), float(noise), 200 if x + 0.2 * noise > 0 else 10, None, int(x + 0.2 * noise > 0)))
    return spark.createDataFrame(
        rows, "customer_id string, total_revenue double, return_rate double, days_since_last_purchase int, "
        "recency_score int, is_churned int")


def test_training_set_leaves_leaks_out(churn):
    assert models.churn_training_set(churn).columns == ["customer_id", "total_revenue", "return_rate", "label"]
    full = models.churn_training_set(churn, leak_free=False)
    assert "days_since_last_purchase" in full.columns and full.filter("recency_score = 0").count() == 400


def test_split_is_stable_and_complete(churn):
    train, test = models.split_by_hash(churn)
    again, _ = models.split_by_hash(churn.repartition(5, "total_revenue"))
    assert train.count() + test.count() == 400 and 280 < train.count() < 360
    assert train.select("customer_id").exceptAll(again.select("customer_id")).isEmpty()


def test_churn_models_learn(churn, monkeypatch):
    monkeypatch.setitem(models.BOOSTED, "maxIter", 8)
    train, test = models.split_by_hash(models.churn_training_set(churn))
    boosted = models.fit_churn_gbt(train)
    for name, model in (("lr", models.fit_churn_lr(train)), ("gbt", boosted)):
        values = {r.metric: r.value for r in models.binary_metrics(models.churn_predictions(model, test), name).collect()}
        assert values["auc_roc"] > 0.85 and values["accuracy"] > 0.75, (name, values)
        assert set(values) == {"auc_roc", "auc_pr", "accuracy", "f1"}
        matrix = models.confusion_matrix(models.churn_predictions(model, test))
        assert matrix.agg(F.sum("count")).first()[0] == test.count()
    ranked = models.feature_importance(boosted)
    assert ranked[0][0] == "total_revenue" and len(ranked) == 2


def test_clv_label_range(spark):
    clv = spark.createDataFrame(
        [("a", 0.0, None), ("b", 99999.99, 2.0), ("c", 100000.0, 1.0), ("d", 0.01, None)],
        "customer_id string, predicted_clv_3yr double, avg_days_between_purchases double")
    feats = spark.createDataFrame([("b", 0.5)], "customer_id string, return_rate double")
    out = models.clv_training_set(clv, feats)
    assert out.columns == ["customer_id", "avg_days_between_purchases", "cf_return_rate", "label"]
    assert sorted(map(tuple, out.collect())) == [("b", 2.0, 0.5, 99999.99), ("d", 0.0, 0.0, 0.01)]
    with pytest.raises(ValueError):
        models.clv_training_set(clv.drop("predicted_clv_3yr"), feats)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0)], "label double, prediction double")
    row = models.regression_metrics(df).first()
    assert abs(row.rmse - (4 / 3) ** 0.5) < 1e-12 and abs(row.mae - 2 / 3) < 1e-12 and abs(row.r2 + 1.0) < 1e-12


def test_group_report_without_the_group_column(spark):
    assert by_group(spark.range(4), "missing", {"n": F.count("*")}).first().n == 4


def test_forest_runs_where_executors_lack_the_package(tmp_path):
    """The driver alone has the package on its path; workers start in another folder."""
    root = Path(__file__).resolve().parent.parent
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
from tillview.operators import anomaly
rows = [(f"c{{i}}", float(i % 17), float(i)) for i in range(400)]
df = spark.createDataFrame(rows, "customer_id string, total_transactions double, total_revenue double")
assert anomaly.isolation_forest(df, trees=5).filter("is_anomaly = 1").count() >= 20
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=240)


def test_trees_draw_from_all_rows(spark):
    """Rows beyond any fixed pool reach a tree as often as others."""
    numbers = spark.range(60_000).selectExpr("cast(id as string) as customer_id", "cast(id as double) as total_revenue")
    drawn = anomaly.tree_samples(numbers, trees=100, rows=256).select("customer_id").distinct().count()
    assert drawn > 0.3 * 60_000


def test_next_days_of_the_seasonal_forecast(spark):
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-02-29')) AS date").withColumn("total_revenue", F.dayofweek("date") * 10.0)
    out = forecast.forecast_seasonal(forecast.revenue_series(days))[0]
    assert [str(r.forecast_date) for r in forecast.next_days(out, 2).orderBy("forecast_date").collect()] == ["2024-03-01", "2024-03-02"]
    assert out.filter("is_future").count() == 30
