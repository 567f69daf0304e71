"""Checks and distributions over the layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillview.functions import policies
from tillview.functions.measures import exact_mean, mean, one_row, rows_where


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).count().filter("count > 1")


def dq_report(customers: DataFrame, transactions: DataFrame, products: DataFrame) -> DataFrame:
    """One row: duplicate customer ids, transactions without a customer, the
    transaction date range, products without a usable price."""
    repeated = one_row(
        duplicate_keys(customers, ["customer_id"]).agg(F.count("*").alias("duplicate_customer_ids"))
    )
    prices = one_row(products.agg(rows_where("price <= 0 OR price IS NULL").alias("n")))
    dates = transactions.agg(
        rows_where("customer_id IS NULL").alias("null_customer_ids"),
        F.min("transaction_date").alias("earliest_transaction"),
        F.max("transaction_date").alias("latest_transaction"),
    )
    return dates.select(
        repeated["duplicate_customer_ids"].alias("duplicate_customer_ids"),
        "null_customer_ids",
        "earliest_transaction",
        "latest_transaction",
        prices["n"].alias("invalid_product_prices"),
    )


def distribution(df: DataFrame, column: Column | str, name: str, total: str = "count") -> DataFrame:
    """Rows per value."""
    value = F.col(column) if isinstance(column, str) else column
    return df.groupBy(value.alias(name)).agg(F.count("*").alias(total))


def health_distribution(view: DataFrame) -> DataFrame:
    return distribution(
        view, policies.HEALTH_CATEGORY.column(), "health_category"
    ).orderBy("health_category")


def transaction_summary(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.count("*").alias("total_transactions"),
        F.sum("revenue").alias("total_revenue"),
        mean("revenue").alias("avg_transaction_value"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def by_group(
    df: DataFrame, group: str, measures: dict[str, Column], order_by: str | None = None
) -> DataFrame:
    """Measures per value of ``group``; over everything where the column is
    absent. Ordered by one measure, descending, with the group as tie-break."""
    aggregates = [column.alias(name) for name, column in measures.items()]
    if group not in df.columns:
        return df.agg(*aggregates)
    out = df.groupBy(group).agg(*aggregates)
    return out.orderBy(F.col(order_by).desc(), group) if order_by else out


def rfm_distribution(rfm: DataFrame) -> DataFrame:
    return by_group(
        rfm,
        "rfm_segment",
        {"customer_count": F.count("*"), "avg_revenue": mean("monetary_value")},
        "customer_count",
    )


def clv_distribution(clv: DataFrame) -> DataFrame:
    return by_group(
        clv,
        "clv_tier",
        {
            "customer_count": F.count("*"),
            "avg_clv": exact_mean("predicted_clv_3yr"),
            "total_revenue": F.sum("historical_revenue"),
        },
        "avg_clv",
    )


def product_status_overview(products: DataFrame) -> DataFrame:
    return by_group(
        products,
        "product_status",
        {"product_count": F.count("*"), "total_revenue": F.sum("total_revenue")},
        "total_revenue",
    )


def feature_coverage(features: DataFrame) -> DataFrame:
    return features.agg(
        F.count("*").alias("total_customers"),
        rows_where("total_transactions > 0").alias("customers_with_purchases"),
        rows_where("is_churned = 1").alias("churned_customers"),
        mean("total_revenue").alias("avg_customer_revenue"),
        mean("customer_tenure_days").alias("avg_tenure_days"),
    )


def recent_sales(daily: DataFrame, days: int = 30) -> DataFrame:
    """Totals over the newest ``days`` rows of a daily table. Dates without a
    sale have no row, so this can reach further back than ``days`` days."""
    newest = daily.orderBy(F.col("date").desc()).limit(days)
    return newest.agg(
        F.sum("total_revenue").alias("revenue_last_30d"),
        mean("total_revenue").alias("avg_daily_revenue"),
        F.sum("transaction_count").alias("total_transactions"),
    )
