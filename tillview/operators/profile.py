"""Per-customer aggregates of the transaction lines.

Several outputs (customer view, RFM, churn features, lifetime value) need
overlapping aggregates of the same fact table. They are declared once, and
``customer_profile`` computes whichever are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillview.functions.policies import LOOKBACK_DAYS
from tillview.operators.enrich import hot_keys
from tillview.sources.staging import stage

# What is counted distinctly per customer.
DISTINCT = {
    "order_count": "transaction_id",
    "product_count": "product_id",
    "category_count": "product_category",
    "day_count": "to_date(transaction_date)",
}


def _mean(column: str) -> str:
    return f"try_divide(CAST(sum({column}) AS DOUBLE), count({column}))"


def plain_measures(as_of: date) -> dict[str, str]:
    """Aggregates that keep a buffer of fixed size per customer, as SQL."""
    out = {
        "line_count": "count(transaction_id)",
        "revenue_sum": "sum(revenue)",
        "revenue_mean": _mean("revenue"),
        "revenue_stddev": "stddev_samp(CAST(revenue AS DOUBLE))",
        "last_purchase": "max(transaction_date)",
        "first_purchase": "min(transaction_date)",
        "days_since_last": f"datediff(DATE'{as_of}', max(transaction_date))",
        "days_first_to_last": "datediff(max(transaction_date), min(transaction_date))",
        # twelve possible months fit a bit mask: distinct without a distinct
        "months_seen": "CAST(bit_count(bit_or(1 << transaction_month)) AS BIGINT)",
        "hour_mean": _mean("transaction_hour"),
        "quantity_mean": _mean("quantity"),
        "online_lines": "count_if(channel = 'Online')",
        "store_lines": "count_if(channel = 'Store')",
        "mobile_lines": "count_if(channel = 'Mobile App')",
        "returned_lines": "count_if(order_status = 'Returned')",
        "cancelled_lines": "count_if(order_status = 'Cancelled')",
        "discount_mean": _mean("discount_percent"),
        "discounted_lines": "count_if(discount_percent > 0)",
        "credit_card_lines": "count_if(payment_method = 'Credit Card')",
        "paypal_lines": "count_if(payment_method = 'PayPal')",
    }
    for days in LOOKBACK_DAYS:
        recent = f"transaction_date >= DATE'{as_of - timedelta(days=days)}'"
        out[f"lines_{days}d"] = f"count_if({recent})"
        out[f"revenue_{days}d"] = f"sum(CASE WHEN {recent} THEN revenue ELSE 0 END)"
    return out


def customer_profile(lines: DataFrame, as_of: date, wanted: Sequence[str]) -> DataFrame:
    """One row per customer with the wanted measures, named as declared above.

    With two or more distinct counts Spark copies every row once per distinct
    column and shuffles the copies and the buffers of all plain measures, though
    one task's lines seldom hold a customer twice. So the lines themselves are
    shuffled once, and a customer's measures and sets of distinct values are
    made where its lines meet. Customers that may hold more than a thousandth of
    the lines (:func:`hot_keys`, a list of bounded length) are aggregated apart, see
    :func:`_spread_profile`. That list is staged (a job), so that both parts read the
    same one.

    Lines without a customer belong to no profile and are left out.
    """
    plain = plain_measures(as_of)
    unknown = [w for w in wanted if w not in plain and w not in DISTINCT]
    if unknown:
        raise ValueError(f"unknown profile measures: {unknown}")
    known = lines.filter(F.col("customer_id").isNotNull())
    simple = [F.expr(f"{plain[w]} AS {w}") for w in wanted if w in plain]
    counted = [F.expr(f"count(DISTINCT {DISTINCT[w]}) AS {w}") for w in wanted if w in DISTINCT]
    if len(counted) < 2 or not simple:
        out = known.groupBy("customer_id").agg(*simple, *counted)
    else:
        hot = F.broadcast(stage(hot_keys(known, "customer_id"), "hot-customers"))
        sets = [F.expr(f"CAST(size(collect_set({DISTINCT[w]})) AS BIGINT) AS {w}") for w in wanted if w in DISTINCT]
        met = known.join(hot, "customer_id", "left_anti").repartition("customer_id").groupBy("customer_id").agg(*simple, *sets)
        spread = _spread_profile(known.join(hot, "customer_id", "left_semi"), simple, counted)
        out = met.unionByName(spread.select(*met.columns))
    return out.select("customer_id", *wanted)


def _spread_profile(known: DataFrame, simple: Sequence[Column], counted: Sequence[Column]) -> DataFrame:
    """The profile of customers with very many lines. Distinct counts are aggregated
    apart from the plain measures, on rows that hold nothing but the counted columns,
    and joined back on the customer. Either part pre-aggregates before its shuffle, and
    the distinct part shuffles by (customer, value), so a customer with a third of all
    lines is spread over many tasks."""
    totals = known.groupBy("customer_id").agg(*simple)
    return totals.join(known.groupBy("customer_id").agg(*counted), "customer_id")


def renamed(profile: DataFrame, names: dict[str, str]) -> DataFrame:
    """The profile under output names: {output column: profile measure}."""
    return profile.selectExpr(
        "customer_id", *[f"{measure} AS {out}" for out, measure in names.items()]
    )
