"""The catalog of model features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values: (source table, use case, feature, type, description).
FEATURES = [
    ("customer_features_gold", "Churn Prediction", "days_since_last_purchase", "Numeric", "Recency metric"),
    ("customer_features_gold", "Churn Prediction", "transactions_last_90d", "Numeric", "Recent activity"),
    ("customer_features_gold", "Churn Prediction", "avg_crm_satisfaction", "Numeric", "Customer sentiment"),
    ("customer_features_gold", "Churn Prediction", "unresolved_issues", "Numeric", "Support quality"),
    ("customer_features_gold", "Churn Prediction", "web_conversion_rate", "Numeric", "Digital engagement"),
    ("customer_rfm_gold", "Segmentation", "recency_score", "Numeric", "RFM - Recency"),
    ("customer_rfm_gold", "Segmentation", "frequency_score", "Numeric", "RFM - Frequency"),
    ("customer_rfm_gold", "Segmentation", "monetary_score", "Numeric", "RFM - Monetary"),
    ("customer_clv_features_gold", "CLV Prediction", "historical_revenue", "Numeric", "Past spending"),
    ("customer_clv_features_gold", "CLV Prediction", "purchase_frequency_monthly", "Numeric", "Purchase rate"),
    ("customer_clv_features_gold", "CLV Prediction", "avg_transaction_revenue", "Numeric", "Transaction value"),
    ("customer_clv_features_gold", "CLV Prediction", "categories_purchased", "Numeric", "Product diversity"),
    ("sales_aggregated_gold", "Demand Forecasting", "total_revenue", "Numeric", "Target variable"),
    ("sales_aggregated_gold", "Demand Forecasting", "day_of_week", "Categorical", "Temporal pattern"),
    ("sales_aggregated_gold", "Demand Forecasting", "is_weekend", "Binary", "Weekend effect"),
    ("sales_aggregated_gold", "Demand Forecasting", "month", "Categorical", "Seasonality"),
    ("product_performance_gold", "Inventory Optimization", "avg_daily_sales", "Numeric", "Velocity"),
    ("product_performance_gold", "Inventory Optimization", "return_rate", "Numeric", "Quality indicator"),
    ("product_performance_gold", "Inventory Optimization", "days_since_last_sale", "Numeric", "Obsolescence risk"),
]


def feature_catalog(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        FEATURES,
        "source_table string, ml_use_case string, feature_name string, "
        "feature_type string, description string",
    )
