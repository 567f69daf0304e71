"""The registered queries: every operator over the order-book tables.

Silver and gold inputs are written once per session and folder by the
pipeline, as a user's job would, and then read; the operator a query is named
after always runs in the query itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tillview.functions.measures import hash_bucket, select_available
from tillview.operators import (
    anomaly,
    conform,
    customer_view,
    features,
    forecast,
    lifetime,
    models,
    quality,
    rfm,
    sales,
    seasonal,
    segments,
    smoothing,
)
from tillview.operators.dedup import dedup_latest, latest_value_per_key
from tillview.operators.profile import customer_profile, renamed
from tillview.plans.medallion import Medallion, ingest_csv
from tillview.sources.csv import stamp_load
from tillview.sources.orderbook import AS_OF, LOADED_AT, OrderBook
from tillview.sources.schemas import SOURCES
from tillview.sources.staging import stage, staging_path
from tillview.sources.tables import TableStore, count_tables
from tillview.sources.tables import layer_summary as layer_summary_of

# A fixed model to assign customers to: one centre per row, one coordinate per
# segmentation feature.
CENTERS = [
    [40.0, 14000.0, 60.0, 6.0, 350.0, 0.33, 1800.0, 0.2],
    [30.0, 9000.0, 150.0, 6.0, 300.0, 0.30, 0.0, 0.0],
    [20.0, 6000.0, 400.0, 5.0, 250.0, 0.35, 0.0, 0.0],
    [45.0, 17000.0, 30.0, 6.0, 400.0, 0.30, 900.0, 0.3],
    [35.0, 11000.0, 250.0, 6.0, 320.0, 0.40, 0.0, 0.0],
    [38.0, 12500.0, 20.0, 6.0, 330.0, 0.25, 0.0, 0.0],
]

_runs: dict[tuple[str, str], Medallion] = {}


def medallion(spark: SparkSession, folder: str) -> Medallion:
    """The session's pipeline over a folder of order-book tables."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _runs:
        book = OrderBook(spark, folder)
        store = TableStore(spark, staging_path(spark, "layers"))
        _runs[key] = Medallion(store, AS_OF, book.bronze().__getitem__, key_tables=book.key_tables(), lie_by_transaction=True)
    return _runs[key]


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles: both engines then return the same type."""
    return df.selectExpr(
        *[
            f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`"
            if isinstance(f.dataType, DecimalType)
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Rounds sums of doubles, whose last digits depend on the summing order."""
    return df.withColumns({c: F.round(c, places) for c in columns})


Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain_numbers(build(spark, folder))

    REGISTRY[build.__name__.rstrip("_")] = run
    return build


def silver(spark, folder, name) -> DataFrame:
    return medallion(spark, folder).table(f"{name}_silver")


def gold(spark, folder, name) -> DataFrame:
    return medallion(spark, folder).table(f"{name}_gold")


def lines(spark, folder) -> DataFrame:
    return silver(spark, folder, "transactions")


# -- ingest and conform -----------------------------------------------------
@query
def ingest_stamp(spark, folder):
    orders = OrderBook(spark, folder).table("orders")
    stamped = stamp_load(orders, datetime.fromisoformat(LOADED_AT), "orders.parquet")
    # without a zone, so that the check does not depend on the session's
    return stamped.withColumn("ingestion_timestamp", F.lit(LOADED_AT).cast("timestamp_ntz"))


def _ingested(source: str) -> Query:
    """Writes a derived source as CSV and ingests the file."""

    def ingest(spark, folder):
        raw = staging_path(spark, f"csv-{source}")
        OrderBook(spark, folder).bronze()[source].drop("ingestion_timestamp").write.option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").csv(raw)
        store = TableStore(spark, staging_path(spark, "ingested"))
        out = ingest_csv(store, source, raw, datetime.fromisoformat(LOADED_AT))
        # instants without a zone, as DuckDB has them
        times = {n: F.col(n).cast("timestamp_ntz") for n, kind in out.dtypes if kind == "timestamp"}
        return out.withColumns(
            {
                **times,
                "rejected_fields": F.array_join("rejected_fields", ","),
                # part files are named at random
                "source_file": F.regexp_replace("source_file", "^part-.*[.]csv$", "part.csv"),
            }
        )

    ingest.__name__ = f"ingest_{source}"
    return ingest


for _source in SOURCES:
    query(_ingested(_source))


@query
def conform_customers(spark, folder):
    return conform.conform_customers(OrderBook(spark, folder).customers(), AS_OF)


@query
def conform_products(spark, folder):
    return conform.conform_products(OrderBook(spark, folder).products(), AS_OF)


@query
def conform_transactions(spark, folder):
    book = OrderBook(spark, folder)
    return conform.conform_transactions(
        book.transactions(),
        silver(spark, folder, "customers"),
        silver(spark, folder, "products"),
        book.key_tables(),
        lie_by_transaction=True,
    )


@query
def conform_crm(spark, folder):
    return conform.conform_crm(OrderBook(spark, folder).crm())


@query
def conform_loyalty(spark, folder):
    return conform.conform_loyalty(OrderBook(spark, folder).loyalty())


@query
def conform_web(spark, folder):
    return conform.conform_web(OrderBook(spark, folder).web())


@query
def conform_tickets(spark, folder):
    return conform.conform_tickets(OrderBook(spark, folder).tickets())


@query
def dedup_latest_(spark, folder):
    """One line per order and line number, the latest shipped."""
    kept = dedup_latest(
        OrderBook(spark, folder).table("lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate"
    )
    return kept.select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


# -- quality ----------------------------------------------------------------
@query
def dq_customers(spark, folder):
    out = conform.conform_customers(OrderBook(spark, folder).customers(), AS_OF)
    return out.select("customer_id", "data_quality_flag")


@query
def dq_products(spark, folder):
    out = conform.conform_products(OrderBook(spark, folder).products(), AS_OF)
    return out.select("product_id", "data_quality_flag")


@query
def dq_transactions(spark, folder):
    out = conform.flag_transactions(OrderBook(spark, folder).transactions())
    return out.select("transaction_id", "product_id", "data_quality_flag")


@query
def dq_flag_distribution(spark, folder):
    parts = [
        quality.distribution(silver(spark, folder, name), "data_quality_flag", "data_quality_flag")
        .withColumn("source", F.lit(name))
        for name in ("customers", "products")
    ]
    return parts[0].unionByName(parts[1])


@query
def dq_duplicate_keys(spark, folder):
    return quality.duplicate_keys(
        OrderBook(spark, folder).transactions(), ["transaction_id", "product_id"]
    )


@query
def dq_report(spark, folder):
    book = OrderBook(spark, folder)
    return quality.dq_report(book.customers(), book.transactions(), book.products())


@query
def transaction_summary(spark, folder):
    return quality.transaction_summary(lines(spark, folder))


# -- tables -----------------------------------------------------------------
@query
def partitioned_write(spark, folder):
    """Writes the valid lines by year and month and counts what is read back."""
    store = TableStore(spark, staging_path(spark, "partitioned"))
    wanted = ["transaction_id", "revenue", "transaction_year", "transaction_month"]
    back = store.write(
        lines(spark, folder).select(*wanted),
        "lines_silver",
        partition_by=["transaction_year", "transaction_month"],
    )
    return back.groupBy("transaction_year", "transaction_month").agg(
        F.count("*").alias("records"), F.sum("revenue").alias("revenue")
    )


@query
def overwrite_replace(spark, folder):
    """A table rewritten from itself twice: its last version beside the one before."""
    store = TableStore(spark, staging_path(spark, "replaced"))
    now = store.write(lines(spark, folder).select("product_category", "revenue"), "lines_silver")
    for kept in ("revenue > 50", "product_category is not null"):
        now = store.write(now.filter(kept).withColumn("revenue", (F.col("revenue") * 2).cast("decimal(18,4)")), "lines_silver")
    versions = [store.read("lines_silver", version=n).withColumn("version", F.lit(n)) for n in (2, 3)]
    return (
        versions[0]
        .unionByName(versions[1])
        .groupBy("version", "product_category")
        .agg(F.count("*").alias("records"), F.sum("revenue").alias("revenue"))
    )


@query
def catalog_schema(spark, folder):
    """A catalog table through a changed schema and new partitions: its columns in the
    catalog, and its rows by partition as the catalog finds them."""
    store = TableStore(spark, staging_path(spark, "registered"), database=f"tillview_{uuid.uuid4().hex[:12]}")
    sold = lines(spark, folder).select("transaction_year", "transaction_month", F.col("revenue").cast("double").alias("amount"))
    store.write(sold.filter("transaction_year < 1995").drop("transaction_month"), "sold_silver", partition_by="transaction_year")
    store.write(sold.withColumn("amount", F.col("amount").cast("decimal(18,4)")), "sold_silver", partition_by="transaction_year")
    columns = [f"{c.name} {c.dataType}{' partition' if c.isPartition else ''}" for c in spark.catalog.listColumns(store.qualified("sold_silver"))]
    found = store.read("sold_silver", prefer="catalog")
    rows = found.groupBy("transaction_year").agg(F.count("*").alias("records"), F.sum("amount").alias("amount"))
    return rows.withColumn("columns", F.lit(", ".join(columns)))


@query
def layer_summary(spark, folder):
    names = ["customers", "products", "transactions", "crm_interactions"]
    names += ["loyalty_events", "web_analytics", "support_tickets"]
    return count_tables({f"{n}_silver": silver(spark, folder, n) for n in names})


@query
def layer_status(spark, folder):
    """All layers with their status: two ingested tables, all others as they are
    built, one that is not there."""
    run = medallion(spark, folder)
    bronze = [run.store.write(run.bronze(name), f"{name}_bronze") and f"{name}_bronze" for name in ("customers", "products")]
    built = [f"{n}_silver" for n in ("customers", "products", "transactions")] + [f"{n}_gold" for n in ("customer_rfm", "sales_aggregated")]
    for name in built:
        run.table(name)
    return layer_summary_of(run.store, [*bronze, *built, "nothing_gold"], prefer="path").drop("path")


@query
def quarantine_transactions(spark, folder):
    out = medallion(spark, folder).table("transactions_quarantine_silver")
    return out.select("transaction_id", "product_id", "data_quality_flag")


@query
def latest_loyalty(spark, folder):
    """Current tier and balance per customer: those of the last event."""
    events = silver(spark, folder, "loyalty_events")
    return latest_value_per_key(events, ["customer_id"], ["tier", "points_balance"], ["event_date", "event_id"])


# -- customer view ----------------------------------------------------------
@query
def transaction_metrics(spark, folder):
    return customer_view.transaction_metrics(lines(spark, folder), AS_OF)


@query
def loyalty_metrics(spark, folder):
    return customer_view.loyalty_metrics(silver(spark, folder, "loyalty_events"))


@query
def crm_metrics(spark, folder):
    return customer_view.crm_metrics(silver(spark, folder, "crm_interactions"))


@query
def web_metrics(spark, folder):
    return customer_view.web_metrics(silver(spark, folder, "web_analytics"))


@query
def ticket_metrics(spark, folder):
    return customer_view.ticket_metrics(silver(spark, folder, "support_tickets"))


@query
def customer_360(spark, folder):
    return customer_view.customer_360(
        silver(spark, folder, "customers"),
        lines(spark, folder),
        silver(spark, folder, "loyalty_events"),
        silver(spark, folder, "crm_interactions"),
        silver(spark, folder, "web_analytics"),
        silver(spark, folder, "support_tickets"),
        AS_OF,
    )


@query
def top_customers_sql(spark, folder):
    silver(spark, folder, "customer360").createOrReplaceTempView("customer360_silver_view")
    return customer_view.top_customers_sql(spark, "customer360_silver_view")


@query
def never_purchased(spark, folder):
    flagged = customer_view.with_never_purchased(silver(spark, folder, "customer360"))
    return flagged.select("customer_id", "churn_risk_flag", "never_purchased")


@query
def health_distribution(spark, folder):
    return quality.health_distribution(silver(spark, folder, "customer360"))


@query
def churn_risk_distribution(spark, folder):
    return quality.distribution(
        silver(spark, folder, "customer360"), "churn_risk_flag", "churn_risk_flag"
    )


# -- scores and features ----------------------------------------------------
@query
def rfm_(spark, folder):
    return rfm.rfm(lines(spark, folder), AS_OF)


@query
def rfm_cutpoints(spark, folder):
    cuts = rfm.rfm_cutpoints(stage(rfm.rfm_base(lines(spark, folder), AS_OF), "rfm-base"))
    return cuts.select(
        *[
            F.col(m)[i].cast("double").alias(f"{m}_q{(i + 1) * 20}")
            for m in rfm.RFM_MEASURES
            for i in range(4)
        ]
    )


@query
def rfm_distribution(spark, folder):
    return quality.rfm_distribution(gold(spark, folder, "customer_rfm"))


@query
def transaction_features(spark, folder):
    out = features.transaction_features(lines(spark, folder), AS_OF)
    return rounded(out, 6, "stddev_transaction_value")


@query
def loyalty_features(spark, folder):
    return features.loyalty_features(silver(spark, folder, "loyalty_events"))


@query
def crm_features(spark, folder):
    return features.crm_features(silver(spark, folder, "crm_interactions"), AS_OF)


@query
def web_features(spark, folder):
    return features.web_features(silver(spark, folder, "web_analytics"))


@query
def ticket_features(spark, folder):
    return features.ticket_features(silver(spark, folder, "support_tickets"))


@query
def customer_features(spark, folder):
    wanted = dict.fromkeys(
        [*features.TRANSACTION_FEATURES.values(), *rfm.RFM_MEASURES.values()]
    )
    profile = stage(customer_profile(lines(spark, folder), AS_OF, list(wanted)), "profile")
    out = features.assemble_features(
        silver(spark, folder, "customers"),
        renamed(profile, features.TRANSACTION_FEATURES),
        features.loyalty_features(silver(spark, folder, "loyalty_events")),
        features.crm_features(silver(spark, folder, "crm_interactions"), AS_OF),
        features.web_features(silver(spark, folder, "web_analytics")),
        features.ticket_features(silver(spark, folder, "support_tickets")),
        rfm.score_rfm(renamed(profile, rfm.RFM_MEASURES)),
    )
    return rounded(out, 6, "stddev_transaction_value")


@query
def feature_coverage(spark, folder):
    return quality.feature_coverage(gold(spark, folder, "customer_features"))


@query
def churn_label_distribution(spark, folder):
    return quality.distribution(gold(spark, folder, "customer_features"), "is_churned", "is_churned")


@query
def clv_features(spark, folder):
    return lifetime.clv_features(lines(spark, folder), silver(spark, folder, "customers"), AS_OF)


@query
def clv_distribution(spark, folder):
    return quality.clv_distribution(gold(spark, folder, "customer_clv_features"))


@query
def clv_training_set(spark, folder):
    return models.clv_training_set(
        gold(spark, folder, "customer_clv_features"), gold(spark, folder, "customer_features")
    )


@query
def select_available_(spark, folder):
    """Of a wished-for list, the columns the feature table has."""
    wanted = ["customer_id", "total_revenue", "not_there", "return_rate", "is_churned"]
    return select_available(gold(spark, folder, "customer_features"), wanted, ("customer_id",))


@query
def split_by_hash(spark, folder):
    train, test = models.split_by_hash(gold(spark, folder, "customer_features"))
    parts = [
        df.select("customer_id", hash_bucket("customer_id").alias("bucket"), F.lit(part).alias("part"))
        for df, part in ((train, "train"), (test, "test"))
    ]
    return parts[0].unionByName(parts[1])


@query
def zscore_features(spark, folder):
    numbers = segments.segmentation_features(gold(spark, folder, "customer_features"))
    columns = numbers.columns[1:]
    return rounded(segments.zscores(numbers, columns), 6, *columns)


# -- sales ------------------------------------------------------------------
@query
def sales_daily(spark, folder):
    return sales.sales_daily(lines(spark, folder))


@query
def sales_monthly(spark, folder):
    return sales.sales_monthly(lines(spark, folder))


@query
def sales_by_category(spark, folder):
    return sales.sales_by_category(lines(spark, folder))


@query
def sales_union(spark, folder):
    return sales.sales_union(lines(spark, folder))


@query
def unique_customers(spark, folder):
    """Customers by day, month and year, all from one table of bitmaps."""
    bitmaps = stage(sales.customer_bitmaps(lines(spark, folder)), "bitmaps")
    levels = {"day": F.col("date"), "month": F.trunc("date", "month"), "year": F.trunc("date", "year")}
    parts = [sales.unique_customers(bitmaps, day).withColumn("level", F.lit(name)) for name, day in levels.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def recent_sales(spark, folder):
    return quality.recent_sales(gold(spark, folder, "sales_aggregated"))


@query
def product_performance(spark, folder):
    return sales.product_performance(
        lines(spark, folder), silver(spark, folder, "products"), AS_OF
    )


@query
def top_products(spark, folder):
    return sales.top_products(gold(spark, folder, "product_performance"))


@query
def product_status_overview(spark, folder):
    return quality.product_status_overview(gold(spark, folder, "product_performance"))


# -- segments ---------------------------------------------------------------
def _assigned(spark, folder) -> DataFrame:
    numbers = segments.segmentation_features(gold(spark, folder, "customer_features"))
    return segments.nearest_center_assign(numbers, numbers.columns[1:], CENTERS)


@query
def nearest_center_assign(spark, folder):
    return _assigned(spark, folder)


@query
def cluster_profiles(spark, folder):
    return segments.cluster_profiles(_assigned(spark, folder))


@query
def segment_names(spark, folder):
    return _assigned(spark, folder).select(
        "customer_id", "cluster", segments.segment_name().alias("segment_name")
    )


@query
def segment_profile(spark, folder):
    named = _assigned(spark, folder).withColumn("segment_name", segments.segment_name())
    return segments.segment_profile(named)


@query
def segment_profile_joined(spark, folder):
    """Measures that the segment table lacks come from the feature table."""
    named = _assigned(spark, folder).select("customer_id", segments.segment_name().alias("segment_name"))
    return segments.segment_profile(named, gold(spark, folder, "customer_features"))


@query
def segments_shape(spark, folder):
    """Every customer has one cluster, and every cluster one name."""
    found = segments.segment_customers(gold(spark, folder, "customer_features"))
    return found.agg(
        F.count("*").alias("customers"),
        F.count_distinct("customer_id").alias("distinct_customers"),
        (F.count_distinct("cluster") == F.count_distinct("cluster", "segment_name")).alias("one_name_each"),
        (F.count_distinct("cluster") <= segments.CLUSTERS).alias("within_k"),
    )


@query
def lloyd_step(spark, folder):
    """Where fixed centres go in one step of k-means."""
    numbers = segments.segmentation_features(gold(spark, folder, "customer_features"))
    columns = numbers.columns[1:]
    moved = segments.lloyd_step(numbers, columns, CENTERS).withColumn("squares", F.col("squares") / F.col("customers"))
    # means of amounts can end in the middle of two roundings
    shown = ("squares", *columns)
    return rounded(moved.withColumns({c: F.col(c) + 1e-9 for c in shown}), 6, *shown)


@query
def segments_fixed_point(spark, folder):
    """Centres fitted on all customers: one more step leaves them where they are."""
    numbers = segments.segmentation_features(gold(spark, folder, "customer_features"))
    columns = numbers.columns[1:]
    scaled = stage(segments.zscores(numbers, columns), "scaled")
    centers = segments.fit_centers(scaled, columns)
    at = F.array(*(F.array(*map(F.lit, center)) for center in centers))
    change = F.greatest(*(F.abs(F.col(c) - at[F.col("cluster")][i]) for i, c in enumerate(columns)))
    return segments.lloyd_step(scaled, columns, centers).agg(
        F.sum("customers").alias("customers"),
        (F.count("*") == segments.CLUSTERS).alias("all_centers_used"),
        (F.max(change) < 1e-6).alias("fixed"),
    )


@query
def segments_kmeans(spark, folder):
    return segments.segment_customers(gold(spark, folder, "customer_features"))


# -- forecast ---------------------------------------------------------------
def _series(spark, folder) -> DataFrame:
    return forecast.revenue_series(gold(spark, folder, "sales_aggregated"))


NUMBERS = ("predicted_revenue", "lower_bound", "upper_bound")


@query
def forecast_trend_dow(spark, folder):
    fitted = forecast.fit_trend_weekday(_series(spark, folder))
    return rounded(forecast.forecast_trend_weekday(fitted), 4, *NUMBERS)


@query
def forecast_next_days(spark, folder):
    fitted = forecast.fit_trend_weekday(_series(spark, folder))
    return rounded(forecast.next_days(forecast.forecast_trend_weekday(fitted)), 4, *NUMBERS)


@query
def forecast_metrics(spark, folder):
    fitted = forecast.fit_trend_weekday(_series(spark, folder))
    return rounded(forecast.forecast_metrics(fitted), 4, "mae", "rmse", "mape")


@query
def forecast_holdout(spark, folder):
    return rounded(forecast.holdout_metrics(_series(spark, folder)), 4, "mae", "rmse", "mape")


@query
def forecast_by_category(spark, folder):
    """One series per product category."""
    daily = sales.sales_by_category(lines(spark, folder))
    series = forecast.revenue_series(daily, "product_category", "category_revenue")
    return rounded(
        forecast.forecast_trend_weekday(forecast.fit_trend_weekday(series)), 4, *NUMBERS
    )


@query
def forecast_seasonal(spark, folder):
    return forecast.forecast_seasonal(_series(spark, folder))[0]


@query
def forecast_seasonal_days(spark, folder):
    """Which days the seasonal forecast has, before and after the end of history."""
    return (
        forecast.forecast_seasonal(_series(spark, folder))[0]
        .groupBy("series_id", "is_future")
        .agg(F.count("*").alias("days"), F.min("forecast_date").alias("first"), F.max("forecast_date").alias("last"))
    )


def _category_series(spark, folder) -> DataFrame:
    daily = sales.sales_by_category(lines(spark, folder))
    return forecast.revenue_series(daily, "product_category", "category_revenue")


@query
def forecast_seasonal_by_category(spark, folder):
    """The seasonal model of every category at once: its days, and whether the coefficients are
    where the loss is least (its slope is 0 along every column)."""
    rows = stage(seasonal.design(_category_series(spark, folder)), "design")
    best = seasonal.optimality(rows, stage(seasonal.fit_seasonal(rows), "fitted"))
    future = rows.groupBy("series_id").agg(F.count_if("is_future").alias("future_days"))
    return best.join(future, "series_id").select("series_id", "days", "future_days", (F.col("gap") < 1e-8).alias("optimal"))


@query
def forecast_seasonal_many(spark, folder):
    return seasonal.forecast_seasonal_many(_category_series(spark, folder))


@query
def forecast_smoothing(spark, folder):
    return rounded(smoothing.forecast_smoothing(_category_series(spark, folder)), 4, *NUMBERS)


@query
def forecast_next_days_seasonal(spark, folder):
    near = forecast.next_days(forecast.forecast_seasonal(_series(spark, folder))[0])
    return near.select("series_id", "forecast_date", "model_type", "is_future")


@query
def forecast_skipped(spark, folder):
    """One series per product: those with too few days."""
    daily = lines(spark, folder).groupBy("product_id", F.to_date("transaction_date").alias("date")).agg(F.sum("revenue").alias("revenue"))
    return forecast.skipped_series(forecast.revenue_series(daily, "product_id", "revenue"), min_days=28)


# -- anomalies and models ---------------------------------------------------
@query
def isolation_forest(spark, folder):
    return anomaly.isolation_forest(gold(spark, folder, "customer_features"))


@query
def isolation_flags(spark, folder):
    flagged = anomaly.isolation_forest(gold(spark, folder, "customer_features"))
    return flagged.agg(F.count("*").alias("customers"), F.sum("is_anomaly").alias("flagged"))


# A small forest: tree, node, feature, threshold, left, right, size.
FOREST = [
    (0, 0, 0, 38.0, 1, 2, 100),
    (0, 1, -1, 0.0, -1, -1, 40),
    (0, 2, 1, 14000.0, 3, 4, 60),
    (0, 3, -1, 0.0, -1, -1, 59),
    (0, 4, -1, 0.0, -1, -1, 1),
    (1, 0, 4, 30.0, 1, 2, 100),
    (1, 1, -1, 0.0, -1, -1, 98),
    (1, 2, -1, 0.0, -1, -1, 2),
]


@query
def forest_scores(spark, folder):
    """Scores by a fixed forest in place of a fitted one."""
    numbers = anomaly.anomaly_features(gold(spark, folder, "customer_features"))
    forest = spark.createDataFrame(FOREST, anomaly.NODES)
    return rounded(anomaly.score_forest(numbers, forest), 9, "anomaly_score")


@query
def anomaly_flags(spark, folder):
    """The lowest scores of a fixed measure, by exact rank."""
    scores = gold(spark, folder, "customer_features").select(
        "customer_id", (-F.col("total_revenue").cast("double")).alias("anomaly_score")
    )
    return anomaly.flag_anomalies(scores)


@query
def top_anomalies(spark, folder):
    return anomaly.top_anomalies(
        gold(spark, folder, "customer_anomalies"), gold(spark, folder, "customer_features")
    )


_models: dict[tuple[str, str, str], object] = {}


def _once(spark, folder, what: str, make):
    """A session's model or training set, made once per folder."""
    key = (spark.sparkContext.applicationId, folder, what)
    if key not in _models:
        _models[key] = make()
    return _models[key]


def _churn_split(spark, folder):
    data = models.churn_training_set(gold(spark, folder, "customer_features"))
    return models.split_by_hash(_once(spark, folder, "churn-set", lambda: stage(data, "churn-set")))


def _churn_model(spark, folder, kind: str):
    fit = {"lr": models.fit_churn_lr, "gbt": models.fit_churn_gbt}[kind]
    train, _ = _churn_split(spark, folder)
    return _once(spark, folder, kind, lambda: fit(train))


@query
def churn_training_set(spark, folder):
    return models.churn_training_set(gold(spark, folder, "customer_features"), leak_free=False)


@query
def churn_lr(spark, folder):
    _, test = _churn_split(spark, folder)
    return models.churn_predictions(_churn_model(spark, folder, "lr"), test)


@query
def churn_lr_optimal(spark, folder):
    """Whether the penalised loss is least at the fitted weights: its slope there, over all training rows."""
    rows, gap = models.churn_lr_gap(_churn_model(spark, folder, "lr"), _churn_split(spark, folder)[0])
    return _churn_split(spark, folder)[0].agg(F.count("*").alias("rows")).withColumns({"all_rows": F.col("rows") == rows, "optimal": F.lit(gap < 1e-3)})


@query
def churn_gbt(spark, folder):
    _, test = _churn_split(spark, folder)
    return models.churn_predictions(_churn_model(spark, folder, "gbt"), test)


@query
def gbt_node_scores(spark, folder):
    """The boosted trees scored from their node table, against the model's own scores."""
    _, test = _churn_split(spark, folder)
    model = _churn_model(spark, folder, "gbt")
    own = models.gbt_scores(model, test).withColumnRenamed("churn_probability", "by_nodes")
    both = models.churn_predictions(model, test).join(own.select("customer_id", "by_nodes"), "customer_id")
    return both.agg(F.count("*").alias("customers"), F.count_if(F.abs(F.col("churn_probability") - F.col("by_nodes")) > 1e-12).alias("differing"))


@query
def saved_model(spark, folder):
    """A model written and read back gives the same scores."""
    model, _, test = _clv_model(spark, folder)
    path = models.save_model(model, staging_path(spark, "model"))
    again = models.clv_predictions(models.load_model(path), test).withColumnRenamed("prediction", "again")
    both = models.clv_predictions(model, test).join(again.select("customer_id", "again"), "customer_id")
    return both.agg(F.count("*").alias("customers"), F.count_if(F.col("prediction") != F.col("again")).alias("differing"))


@query
def churn_importance(spark, folder):
    ranked = models.feature_importance(_churn_model(spark, folder, "gbt"))
    return spark.createDataFrame(ranked, "feature string, importance double")


@query
def churn_metrics(spark, folder):
    _, test = _churn_split(spark, folder)
    parts = []
    for kind in ("lr", "gbt"):
        scored = stage(models.churn_predictions(_churn_model(spark, folder, kind), test), "scored")
        parts.append(models.binary_metrics(scored, kind))
    return parts[0].unionByName(parts[1])


@query
def churn_confusion(spark, folder):
    _, test = _churn_split(spark, folder)
    return models.confusion_matrix(models.churn_predictions(_churn_model(spark, folder, "lr"), test))


def _linear_churn(spark, folder) -> DataFrame:
    """A fixed linear score in place of a fitted one."""
    score = F.col("days_since_last_purchase") - F.col("total_transactions")
    return gold(spark, folder, "customer_features").select(
        F.col("is_churned").alias("label"),
        (score > 60).cast("int").alias("prediction"),
        score.cast("double").alias("churn_probability"),
    )


@query
def linear_metrics(spark, folder):
    """The metrics of a fixed score."""
    return rounded(models.binary_metrics(_linear_churn(spark, folder), "linear"), 9, "value")


@query
def linear_confusion(spark, folder):
    return models.confusion_matrix(_linear_churn(spark, folder))


@query
def linear_regression_metrics(spark, folder):
    """Errors of a fixed guess of the lifetime value."""
    guess = gold(spark, folder, "customer_clv_features").select(
        F.col("predicted_clv_3yr").cast("double").alias("label"),
        (F.col("historical_revenue").cast("double") * 0.5).alias("prediction"),
    )
    return rounded(models.regression_metrics(guess), 6, "rmse", "mae", "r2")


def _clv_model(spark, folder):
    """(model, train, test)"""
    data = models.clv_training_set(
        gold(spark, folder, "customer_clv_features"), gold(spark, folder, "customer_features")
    )
    train, test = models.split_by_hash(_once(spark, folder, "clv-set", lambda: stage(data, "clv-set")))
    return _once(spark, folder, "clv", lambda: models.fit_clv_lr(train)), train, test


def _clv_predictions(spark, folder):
    model, _, test = _clv_model(spark, folder)
    return models.clv_predictions(model, test)


@query
def clv_lr_optimal(spark, folder):
    """The same of the lifetime-value regression, which stops at its number of iterations: the
    slope is within 1 % of the label's deviation."""
    model, train, _ = _clv_model(spark, folder)
    rows, gap = models.clv_lr_gap(model, train)
    return train.agg(F.count("*").alias("rows")).withColumns({"all_rows": F.col("rows") == rows, "optimal": F.lit(gap < 1e-2)})


@query
def clv_lr(spark, folder):
    return _clv_predictions(spark, folder)


@query
def clv_metrics(spark, folder):
    return models.regression_metrics(_clv_predictions(spark, folder))


@query
def clv_future_set(spark, folder):
    return models.clv_future_set(
        lines(spark, folder), silver(spark, folder, "customers"), date(2000, 8, 1)
    )
