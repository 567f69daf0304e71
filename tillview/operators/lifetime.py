"""Customer lifetime value features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillview.functions import policies
from tillview.functions.measures import ratio
from tillview.operators.profile import customer_profile, renamed

# output column -> profile measure
CLV_MEASURES = {
    "historical_revenue": "revenue_sum",
    "avg_transaction_revenue": "revenue_mean",
    "purchase_count": "line_count",
    "purchase_days": "day_count",
    "customer_age_days": "days_first_to_last",
    "recency_days": "days_since_last",
    "categories_purchased": "category_count",
    "avg_items_per_transaction": "quantity_mean",
}
CLV_COLUMNS = [
    "customer_id",
    *CLV_MEASURES,
    "purchase_frequency_monthly",
    "avg_days_between_purchases",
    "age",
    "customer_segment",
    "customer_tenure_days",
    "predicted_clv_3yr",
    "clv_tier",
]


def score_clv(base: DataFrame, customers: DataFrame) -> DataFrame:
    """Frequency, purchase gap, 3-year value and tier on a CLV aggregate.

    Only customers with purchases have a row. The gap is NULL for one
    purchase; the frequency is 0 when all purchases fall on one day."""
    per_month = F.col("customer_age_days") / F.lit(float(policies.DAYS_PER_MONTH))
    gaps = F.col("purchase_count") - F.lit(1)
    known = customers.select("customer_id", "age", "customer_segment", "customer_tenure_days")
    return (
        base.withColumns(
            {
                "avg_transaction_revenue": F.coalesce("avg_transaction_revenue", F.lit(0.0)),
                "purchase_frequency_monthly": ratio("purchase_count", per_month),
                "avg_days_between_purchases": F.when(
                    F.col("purchase_count") > 1, F.col("customer_age_days") / gaps
                ),
            }
        )
        .withColumn(
            "predicted_clv_3yr",
            F.round(
                F.col("avg_transaction_revenue")
                * F.col("purchase_frequency_monthly")
                * F.lit(float(policies.CLV_MONTHS)),
                2,
            ),
        )
        .withColumn("clv_tier", policies.CLV_TIER.column())
        .join(known, "customer_id", "left")
        .select(*CLV_COLUMNS)
    )


def clv_features(lines: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    profile = customer_profile(lines, as_of, list(CLV_MEASURES.values()))
    return score_clv(renamed(profile, CLV_MEASURES), customers)
