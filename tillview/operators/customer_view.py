"""The one-row-per-customer view and the five aggregates it joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillview.functions import policies
from tillview.functions.measures import mean, rows_where, sum_where, zero_filled
from tillview.operators.profile import customer_profile, renamed

# output column -> profile measure
TRANSACTION_METRICS = {
    "total_transactions": "line_count",
    "total_revenue": "revenue_sum",
    "avg_transaction_value": "revenue_mean",
    "last_purchase_date": "last_purchase",
    "first_purchase_date": "first_purchase",
    "distinct_categories_purchased": "category_count",
    "return_count": "returned_lines",
    "recency_days": "days_since_last",
}

ZERO_FILLED = [
    "total_transactions",
    "total_revenue",
    "avg_transaction_value",
    "return_count",
    "current_loyalty_points",
    "total_points_earned",
    "total_points_redeemed",
    "total_crm_interactions",
    "avg_satisfaction_score",
    "unresolved_interactions_count",
    "total_web_sessions",
    "total_page_views",
    "avg_session_duration",
    "web_conversions",
    "distinct_devices_used",
    "total_support_tickets",
    "sla_breaches_count",
    "avg_ticket_satisfaction",
]


def transaction_metrics(lines: DataFrame, as_of: date) -> DataFrame:
    """``total_transactions`` counts order lines, the grain of ``lines``."""
    profile = customer_profile(lines, as_of, list(TRANSACTION_METRICS.values()))
    return renamed(profile, TRANSACTION_METRICS)


def loyalty_metrics(events: DataFrame) -> DataFrame:
    """``current_loyalty_points`` is the highest balance on record and
    ``current_loyalty_tier`` the last tier name in text order."""
    return events.groupBy("customer_id").agg(
        F.max("points_balance").alias("current_loyalty_points"),
        F.max("tier").alias("current_loyalty_tier"),
        sum_where("points_transaction_type = 'Earn'", "points_change").alias("total_points_earned"),
        sum_where("points_transaction_type = 'Redeem'", F.negate("points_change")).alias(
            "total_points_redeemed"
        ),
    )


def crm_metrics(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("customer_id").agg(
        F.count("interaction_id").alias("total_crm_interactions"),
        mean("satisfaction_score").alias("avg_satisfaction_score"),
        rows_where("is_unresolved").alias("unresolved_interactions_count"),
    )


def web_metrics(sessions: DataFrame) -> DataFrame:
    """Sessions of known customers only."""
    known = sessions.filter(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(
        F.count("session_id").alias("total_web_sessions"),
        F.sum("page_views").alias("total_page_views"),
        mean("session_duration_seconds").alias("avg_session_duration"),
        rows_where("is_conversion").alias("web_conversions"),
        F.count_distinct("device_type").alias("distinct_devices_used"),
    )


def ticket_metrics(tickets: DataFrame) -> DataFrame:
    return tickets.groupBy("customer_id").agg(
        F.count("ticket_id").alias("total_support_tickets"),
        rows_where("sla_breached").alias("sla_breaches_count"),
        mean("customer_satisfaction").alias("avg_ticket_satisfaction"),
    )


def health_score() -> Column:
    """Sum of four parts, one decimal; without any data 60.

    Reads its inputs before they are zero-filled: an unknown satisfaction
    counts as the default, not as 0. Summed as decimals, so rounding is exact.
    """
    part = "decimal(18,6)"
    satisfaction = F.coalesce(
        F.col("avg_satisfaction_score"), F.lit(float(policies.HEALTH_DEFAULT_SATISFACTION))
    ) * F.lit(float(policies.HEALTH_POINTS_PER_SATISFACTION))
    orders = F.least(
        F.coalesce("total_transactions", F.lit(0)),
        F.lit(policies.HEALTH_MAX_COUNTED_TRANSACTIONS),
    ) * F.lit(policies.HEALTH_POINTS_PER_TRANSACTION)
    active = F.when(F.col("is_active_customer"), F.lit(policies.HEALTH_POINTS_IF_ACTIVE)).otherwise(0)
    loyalty = F.least(
        F.coalesce("current_loyalty_points", F.lit(0)) / F.lit(policies.HEALTH_LOYALTY_POINTS_PER_POINT),
        F.lit(float(policies.HEALTH_MAX_LOYALTY)),
    )
    total = satisfaction.cast(part) + orders.cast(part) + active.cast(part) + loyalty.cast(part)
    return F.round(total, 1).cast("double")


def customer_360(
    customers: DataFrame,
    lines: DataFrame,
    loyalty: DataFrame,
    crm: DataFrame,
    web: DataFrame,
    tickets: DataFrame,
    as_of: date,
) -> DataFrame:
    """Every silver customer with its metrics, health score and churn risk.

    Five left joins on one key: each aggregate is already partitioned by it,
    so the joins add no shuffle. A customer without purchases has NULL recency
    and counts as low risk."""
    joined = (
        customers.join(transaction_metrics(lines, as_of), "customer_id", "left")
        .join(loyalty_metrics(loyalty), "customer_id", "left")
        .join(crm_metrics(crm), "customer_id", "left")
        .join(web_metrics(web), "customer_id", "left")
        .join(ticket_metrics(tickets), "customer_id", "left")
    )
    scored = (
        joined.withColumns(
            {
                "customer_lifetime_value": F.coalesce("total_revenue", F.lit(0)),
                "is_active_customer": policies.ACTIVE_CUSTOMER.column(),
            }
        )
        .withColumn("customer_health_score", health_score())
        .withColumn("churn_risk_flag", policies.CHURN_RISK.column())
    )
    return zero_filled(scored, ZERO_FILLED)


def top_customers_sql(spark: SparkSession, view: str, n: int = 10) -> DataFrame:
    """The biggest spenders, as SQL over a view of the customer table."""
    return spark.sql(
        f"""
        SELECT customer_id, total_transactions, total_revenue AS total_spent,
               avg_transaction_value, current_loyalty_points AS loyalty_points,
               last_purchase_date AS last_interaction_date
        FROM {view}
        ORDER BY total_spent DESC, customer_id
        LIMIT {int(n)}
        """
    )


def with_never_purchased(customers: DataFrame) -> DataFrame:
    """A flag beside the churn label and risk, which both count a customer without
    purchases as safe. For tables with ``total_transactions``."""
    bought = F.coalesce(F.col("total_transactions"), F.lit(0)) > 0
    return customers.withColumn("never_purchased", ~bought)
