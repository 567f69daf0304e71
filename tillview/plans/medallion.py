"""The batch pipeline: bronze, silver, gold and model tables.

Every table is written once and read back, so a later step scans a stored
table instead of recomputing its plan from the sources.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillview.operators import (
    anomaly,
    catalog,
    conform,
    customer_view,
    features,
    forecast,
    lifetime,
    models,
    rfm,
    sales,
    segments,
)
from tillview.operators.profile import customer_profile, renamed
from tillview.sources.csv import rejected_rows, scan_csv, stamp_load
from tillview.sources.schemas import SOURCES
from tillview.sources.staging import stage
from tillview.sources.tables import TableStore

PARTITIONS = {"transactions_silver": ("transaction_year", "transaction_month")}


def ingest_csv(store: TableStore, source: str, path: str, load_ts: datetime) -> DataFrame:
    """One CSV source into its bronze table; returns the written table."""
    found = SOURCES[source]
    return store.write(stamp_load(scan_csv(store.spark, path, found), load_ts), found.bronze)


def ingest_folder(store: TableStore, folder: str, load_ts: datetime) -> dict[str, DataFrame]:
    """All seven CSV files of a folder."""
    return {
        name: ingest_csv(store, name, f"{folder.rstrip('/')}/{source.file}", load_ts)
        for name, source in SOURCES.items()
    }


def write_rejected_fields(store: TableStore, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One quarantine table over all sources: rows with fields that did not parse,
    by source and key; the rows themselves stay in bronze with NULL there."""
    parts = [
        rejected_rows(df).select(
            F.lit(name).alias("source"),
            F.concat_ws("|", *SOURCES[name].key).alias("key"),
            "rejected_fields",
            "source_file",
            "ingestion_timestamp",
        )
        for name, df in bronze.items()
    ]
    return store.write(reduce(DataFrame.unionByName, parts), "rejected_fields_bronze")


@dataclass
class Medallion:
    """Silver and gold tables over a store, built on first use.

    ``bronze`` gives the ingested table of a source. ``key_tables`` optionally
    names cheaper places to look for the hot join keys of the transactions, and
    ``lie_by_transaction`` says that these come hash-partitioned by transaction id.
    """

    store: TableStore
    as_of: date
    bronze: Callable[[str], DataFrame]
    load_ts: datetime | None = None
    key_tables: Mapping[str, DataFrame] | None = None
    lie_by_transaction: bool = False
    _built: dict[str, DataFrame] = field(default_factory=dict)
    _lock: threading.RLock = field(default_factory=threading.RLock)

    def table(self, name: str) -> DataFrame:
        """The named table, written before if it was not yet in this run."""
        with self._lock:
            if name not in self._built:
                df = self._builders()[name]()
                self._built[name] = self.store.write(df, name, self.load_ts, PARTITIONS.get(name), rebalance=False)
            return self._built[name]

    def run(self) -> dict[str, DataFrame]:
        """All tables. Valid and rejected lines both come from the flagged ones, so these are
        written down first; a single table does without."""
        with self._lock:
            if "_flagged" not in self._built and "transactions_silver" not in self._built:
                self._built["_flagged"] = stage(self._flagged(), "flagged-transactions")
            return {name: self.table(name) for name in self._builders()}

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "customers_silver": lambda: conform.conform_customers(
                self.bronze("customers"), self.as_of
            ),
            "products_silver": lambda: conform.conform_products(
                self.bronze("products"), self.as_of
            ),
            "transactions_silver": lambda: conform.conform_flagged(
                self._flagged(),
                self.table("customers_silver"),
                self.table("products_silver"),
                self.key_tables
                or dict.fromkeys(("customer_id", "product_id"), self.bronze("transactions")),
                # a stored table no longer lies as the plan that wrote it
                lie_by_transaction=self.lie_by_transaction and "_flagged" not in self._built,
            ),
            "transactions_quarantine_silver": lambda: conform.rejected(self._flagged()),
            "crm_interactions_silver": lambda: conform.conform_crm(self.bronze("crm_interactions")),
            "loyalty_events_silver": lambda: conform.conform_loyalty(self.bronze("loyalty_events")),
            "web_analytics_silver": lambda: conform.conform_web(self.bronze("web_analytics")),
            "support_tickets_silver": lambda: conform.conform_tickets(
                self.bronze("support_tickets")
            ),
            "customer360_silver": lambda: customer_view.customer_360(
                *self._facts(), as_of=self.as_of
            ),
            "customer_rfm_gold": lambda: rfm.score_rfm(
                renamed(self._profile(), rfm.RFM_MEASURES)
            ),
            "customer_features_gold": self._features,
            "sales_base_gold": lambda: sales.sales_base(self.table("transactions_silver")),
            "sales_levels_gold": lambda: sales.all_levels(self.table("sales_base_gold")),
            "sales_aggregated_gold": lambda: self.table("sales_levels_gold")
            .filter("aggregation_level = 'daily'")
            .select(*sales.SALES_COLUMNS),
            "product_performance_gold": lambda: sales.product_performance(
                self.table("transactions_silver"), self.table("products_silver"), self.as_of
            ),
            "customer_clv_features_gold": lambda: lifetime.score_clv(
                renamed(self._profile(), lifetime.CLV_MEASURES), self.table("customers_silver")
            ),
            "customer_segments_gold": lambda: segments.segment_customers(
                self.table("customer_features_gold")
            ),
            "revenue_forecast_gold": lambda: self._stamped(
                forecast.forecast_trend_weekday(forecast.fit_trend_weekday(self._series())),
                "forecast_timestamp",
            ),
            "revenue_forecast_skipped_gold": lambda: forecast.skipped_series(self._series()),
            "customer_anomalies_gold": lambda: self._stamped(
                anomaly.isolation_forest(self.table("customer_features_gold")),
                "detection_timestamp",
            ),
        }

    def _series(self) -> DataFrame:
        return forecast.revenue_series(self.table("sales_aggregated_gold"))

    def _stamped(self, df: DataFrame, column: str) -> DataFrame:
        """When a model's output was made: the run's load time, where it has one."""
        return df if self.load_ts is None else df.withColumn(column, F.lit(self.load_ts))

    def _flagged(self) -> DataFrame:
        """Deduplicated, flagged lines: of a whole run the table written, else their plan."""
        return self._built["_flagged"] if "_flagged" in self._built else conform.flag_transactions(self.bronze("transactions"))

    def _facts(self) -> list[DataFrame]:
        names = ("customers", "transactions", "loyalty_events", "crm_interactions")
        names += ("web_analytics", "support_tickets")
        return [self.table(f"{name}_silver") for name in names]

    def _profile(self) -> DataFrame:
        """The union of what RFM, churn features and CLV need per customer, in
        one pass over the transactions instead of one each."""
        if "_profile" not in self._built:
            wanted = dict.fromkeys(
                [
                    *features.TRANSACTION_FEATURES.values(),
                    *rfm.RFM_MEASURES.values(),
                    *lifetime.CLV_MEASURES.values(),
                ]
            )
            profile = customer_profile(self.table("transactions_silver"), self.as_of, list(wanted))
            self._built["_profile"] = stage(profile, "customer-profile")
        return self._built["_profile"]

    def _features(self) -> DataFrame:
        customers, _, loyalty, crm, web, tickets = self._facts()
        return features.assemble_features(
            customers,
            renamed(self._profile(), features.TRANSACTION_FEATURES),
            features.loyalty_features(loyalty),
            features.crm_features(crm, self.as_of),
            features.web_features(web),
            features.ticket_features(tickets),
            self.table("customer_rfm_gold"),
        )


def train_models(medallion: Medallion, artifacts: str, leak_free: bool = True) -> dict[str, str]:
    """Fits and saves the churn and lifetime-value models; returns their paths. What they
    reach on the rows left out, and the ten most important inputs of the trees, are
    written as ``model_metrics_gold`` and ``feature_importance_gold``."""
    table = medallion.table
    churn = stage(
        models.churn_training_set(table("customer_features_gold"), leak_free), "churn-set"
    )
    clv = stage(
        models.clv_training_set(
            table("customer_clv_features_gold"), table("customer_features_gold")
        ),
        "clv-set",
    )
    train_churn, test_churn = models.split_by_hash(churn)
    train_clv, test_clv = models.split_by_hash(clv)
    fitted = {
        "churn_lr": models.fit_churn_lr(train_churn),
        "churn_gbt": models.fit_churn_gbt(train_churn),
        "clv_lr": models.fit_clv_lr(train_clv),
    }
    scored = {name: stage(models.churn_predictions(fitted[name], test_churn), "scored") for name in ("churn_lr", "churn_gbt")}
    spark, store = medallion.store.spark, medallion.store
    metrics = models.model_metrics(spark, scored, models.clv_predictions(fitted["clv_lr"], test_clv))
    store.write(metrics, "model_metrics_gold", medallion.load_ts)
    ranked = spark.createDataFrame(models.feature_importance(fitted["churn_gbt"]), "feature string, importance double")
    store.write(ranked, "feature_importance_gold", medallion.load_ts)
    root = artifacts.rstrip("/")
    return {name: models.save_model(model, f"{root}/{name}") for name, model in fitted.items()}


def write_feature_catalog(store: TableStore, load_ts: datetime) -> DataFrame:
    """The feature catalog as a managed table."""
    rows = catalog.feature_catalog(store.spark).withColumn("gold_load_timestamp", F.lit(load_ts))
    return store.write_managed(rows, "ml_feature_catalog")


def run_csv_pipeline(
    spark: SparkSession,
    raw: str,
    root: str,
    as_of: date,
    load_ts: datetime,
    database: str | None = None,
    artifacts: str | None = None,
) -> dict[str, DataFrame]:
    """CSV folder to every silver and gold table, segments, forecast and anomalies
    included. With ``artifacts`` the churn and lifetime-value models are fitted and
    saved there, and with ``database`` the feature catalog is written."""
    store = TableStore(spark, root, database=database)
    bronze = ingest_folder(store, raw, load_ts)
    write_rejected_fields(store, bronze)
    medallion = Medallion(store, as_of, bronze.__getitem__, load_ts)
    tables = medallion.run()
    if artifacts is not None:
        train_models(medallion, artifacts)
    if database is not None:
        write_feature_catalog(store, load_ts)
    return tables
