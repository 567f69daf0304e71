"""The churn feature table: one row per customer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillview.functions import policies
from tillview.functions.measures import days_until, mean, ratio, rows_where, sum_where, zero_filled
from tillview.operators.profile import customer_profile, renamed

# output column -> profile measure
# The names of the feature table's columns.
TRANSACTION_FEATURES = {
    "total_transactions": "line_count",
    "total_revenue": "revenue_sum",
    "avg_transaction_value": "revenue_mean",
    "stddev_transaction_value": "revenue_stddev",
    "transactions_last_30d": "lines_30d",
    "transactions_last_60d": "lines_60d",
    "transactions_last_90d": "lines_90d",
    "revenue_last_30d": "revenue_30d",
    "revenue_last_60d": "revenue_60d",
    "revenue_last_90d": "revenue_90d",
    "distinct_months_active": "months_seen",
    "avg_purchase_hour": "hour_mean",
    "distinct_products_purchased": "product_count",
    "distinct_categories_purchased": "category_count",
    "online_purchases": "online_lines",
    "store_purchases": "store_lines",
    "mobile_purchases": "mobile_lines",
    "return_count": "returned_lines",
    "cancellation_count": "cancelled_lines",
    "days_since_last_purchase": "days_since_last",
    "customer_lifespan_days": "days_first_to_last",
    "avg_discount_used": "discount_mean",
    "discounted_purchases": "discounted_lines",
    "credit_card_payments": "credit_card_lines",
    "paypal_payments": "paypal_lines",
}

CUSTOMER_COLUMNS = [
    "customer_id",
    "age",
    "gender",
    "state",
    "customer_segment",
    "acquisition_channel",
    "customer_tenure_days",
]
RFM_COLUMNS = ["recency_score", "frequency_score", "monetary_score", "rfm_segment"]


def transaction_features(lines: DataFrame, as_of: date) -> DataFrame:
    profile = customer_profile(lines, as_of, list(TRANSACTION_FEATURES.values()))
    return renamed(profile, TRANSACTION_FEATURES)


def loyalty_features(events: DataFrame) -> DataFrame:
    """``loyalty_tier_numeric``: Gold 3, Silver 2, any other or no tier 1."""
    return events.groupBy("customer_id").agg(
        F.max("points_balance").alias("current_loyalty_points"),
        sum_where("points_transaction_type = 'Earn'", "points_change").alias("total_points_earned"),
        sum_where("points_transaction_type = 'Redeem'", F.abs("points_change")).alias(
            "total_points_redeemed"
        ),
        F.count_distinct("event_type").alias("distinct_loyalty_event_types"),
        F.max(policies.TIER_RANK.column()).alias("loyalty_tier_numeric"),
    )


def crm_features(interactions: DataFrame, as_of: date) -> DataFrame:
    return interactions.groupBy("customer_id").agg(
        F.count("interaction_id").alias("total_crm_interactions"),
        rows_where("interaction_type = 'Complaint'").alias("complaint_count"),
        mean("satisfaction_score").alias("avg_crm_satisfaction"),
        rows_where("is_unresolved").alias("unresolved_issues"),
        days_until(as_of, F.max("interaction_date")).alias("days_since_last_contact"),
    )


def web_features(sessions: DataFrame) -> DataFrame:
    """Sessions of known customers only."""
    known = sessions.filter(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(
        F.count("session_id").alias("total_web_sessions"),
        F.sum("page_views").alias("total_page_views"),
        mean("page_views").alias("avg_pages_per_session"),
        rows_where("is_bounce").alias("bounce_sessions"),
        rows_where("is_conversion").alias("web_conversions"),
        rows_where("is_abandoned_cart").alias("abandoned_cart_count"),
        F.count_distinct("device_type").alias("distinct_devices"),
        rows_where("device_type = 'Mobile'").alias("mobile_sessions"),
    )


def ticket_features(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("customer_id").agg(
        F.count("ticket_id").alias("total_support_tickets"),
        rows_where("priority = 'High'").alias("high_priority_tickets"),
        rows_where("sla_breached").alias("sla_breach_count"),
        mean("customer_satisfaction").alias("avg_ticket_satisfaction"),
        rows_where("is_dissatisfied").alias("dissatisfied_ticket_count"),
    )


def assemble_features(
    customers: DataFrame,
    transactions: DataFrame,
    loyalty: DataFrame,
    crm: DataFrame,
    web: DataFrame,
    tickets: DataFrame,
    rfm: DataFrame,
) -> DataFrame:
    """Every customer with the five aggregates, its RFM scores, four ratios and
    the churn label.

    The counts, sums and averages are zero-filled before the ratios and the
    label are taken, so a customer who never bought has 0 days since the last
    purchase and is labelled as not churned; the RFM columns stay NULL."""
    parts = [transactions, loyalty, crm, web, tickets]
    joined = customers.select(*CUSTOMER_COLUMNS)
    for part in parts:
        joined = joined.join(part, "customer_id", "left")
    joined = joined.join(rfm.select("customer_id", *RFM_COLUMNS), "customer_id", "left")
    numeric = [c for part in parts for c in part.columns if c != "customer_id"]
    months = F.col("customer_lifespan_days") / F.lit(policies.DAYS_PER_MONTH)
    return (
        zero_filled(joined, numeric)
        .withColumns(
            {
                "purchase_frequency": ratio("total_transactions", months),
                "return_rate": ratio("return_count", "total_transactions"),
                "web_conversion_rate": ratio("web_conversions", "total_web_sessions"),
                "loyalty_redemption_rate": ratio("total_points_redeemed", "total_points_earned"),
                "is_churned": policies.CHURN_LABEL.column(),
            }
        )
    )


def customer_features(
    customers: DataFrame,
    lines: DataFrame,
    loyalty: DataFrame,
    crm: DataFrame,
    web: DataFrame,
    tickets: DataFrame,
    rfm: DataFrame,
    as_of: date,
) -> DataFrame:
    return assemble_features(
        customers,
        transaction_features(lines, as_of),
        loyalty_features(loyalty),
        crm_features(crm, as_of),
        web_features(web),
        ticket_features(tickets),
        rfm,
    )
