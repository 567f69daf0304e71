"""Bronze to silver: one function per source.

Each takes the ingested table and returns the conformed one: tidied text, date
parts, categories, one row per key, and a quality flag where the source has
one. Money columns are decimals throughout.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillview.functions import policies
from tillview.functions.measures import days_until, named, tidy
from tillview.operators.dedup import dedup_latest
from tillview.operators import enrich
from tillview.operators.enrich import hot_keys, left_join_in_place, left_join_salted
from tillview.sources.schemas import SOURCES

LOADED = "bronze_ingestion_timestamp"
FLAG = "data_quality_flag"


def _same(*names: str) -> dict[str, Column]:
    return {name: F.col(name) for name in names}


def _loaded() -> dict[str, Column]:
    return {LOADED: F.col("ingestion_timestamp")}


def _calendar(column: str, prefix: str, *parts: str) -> dict[str, Column]:
    take = {
        "year": F.year,
        "month": F.month,
        "day_of_week": F.dayofweek,
        "hour": F.hour,
        "quarter": F.quarter,
    }
    return {f"{prefix}_{part}": take[part](column) for part in parts}


def _latest(df: DataFrame, source: str) -> DataFrame:
    return dedup_latest(df, SOURCES[source].key, LOADED)


def _latest_shaped(bronze: DataFrame, source: str, columns: Mapping[str, Column], renamed: Mapping[str, str] | None = None) -> DataFrame:
    """The latest row of each key in its silver ``columns``. Only ingested columns are shuffled; they
    break ties in the silver order, in which columns made from them follow and so decide none."""
    declared = SOURCES[source].schema.names
    raw = [c for c in ((renamed or {}).get(name, name) for name in columns) if c in declared]
    one_each = dedup_latest(bronze.select(*raw, "ingestion_timestamp"), SOURCES[source].key, "ingestion_timestamp")
    return one_each.select(*named(columns))


def keep_valid(df: DataFrame) -> DataFrame:
    """Rows whose quality flag says valid. Applied after deduplication: the
    kept copy of a key may be the invalid one, and then the key is dropped."""
    return df.filter(F.col(FLAG) == policies.VALID)


def rejected(df: DataFrame) -> DataFrame:
    """The complement of :func:`keep_valid`, for a quarantine table."""
    return df.filter(F.col(FLAG) != policies.VALID)


def conform_customers(bronze: DataFrame, as_of: date) -> DataFrame:
    years = F.floor(days_until(as_of, "date_of_birth") / F.lit(policies.DAYS_PER_YEAR))
    columns = {
        **_same("customer_id"),
        "first_name": tidy("first_name"),
        "last_name": tidy("last_name"),
        "email": F.lower(F.trim("email")),
        "phone_cleaned": F.regexp_replace("phone", "[^0-9]", ""),
        "phone_original": F.col("phone"),
        **_same("date_of_birth", "registration_date"),
        "age": years,
        "customer_tenure_days": days_until(as_of, "registration_date"),
        "gender": F.upper("gender"),
        "city": tidy("city"),
        "state": F.upper(F.trim("state")),
        **_same("zip_code", "customer_segment", "acquisition_channel"),
        **_loaded(),
    }
    one_each = _latest(bronze.select(*named(columns)), "customers")
    return one_each.withColumn(FLAG, policies.CUSTOMER_QUALITY.column())


def conform_products(bronze: DataFrame, as_of: date) -> DataFrame:
    gain = (F.col("price") - F.col("cost")).cast("double")
    columns = {
        **_same("product_id"),
        "product_name": F.trim("product_name"),
        "category": tidy("category"),
        "subcategory": tidy("subcategory"),
        "brand": tidy("brand"),
        **_same("price", "cost"),
        # NULL, not an error, where the price is zero
        "profit_margin_pct": F.round(
            F.try_divide(gain, F.col("price").cast("double")) * F.lit(100), 2
        ),
        **_same("stock_quantity"),
        "stock_status": policies.STOCK_STATUS.column(),
        **_same("supplier_id", "launch_date"),
        "product_age_days": days_until(as_of, "launch_date"),
        **_loaded(),
    }
    one_each = _latest(bronze.select(*named(columns)), "products")
    return one_each.withColumn(FLAG, policies.PRODUCT_QUALITY.column())


def flag_transactions(bronze: DataFrame) -> DataFrame:
    """Bronze transactions, one row per (transaction, product), with the flag.

    Only bronze columns take part, so the flag can be applied, and invalid
    rows dropped, before the dimension joins rather than after them."""
    one_each = dedup_latest(bronze, SOURCES["transactions"].key, "ingestion_timestamp")
    return one_each.withColumn(FLAG, policies.TRANSACTION_QUALITY.column())


def enrich_transactions(
    flagged: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    keys_from: Mapping[str, DataFrame],
    salts: int = 64,
    lie_by_transaction: bool = False,
) -> DataFrame:
    """Adds the dimension columns of silver customers and products.

    ``keys_from`` names, per join key, a stored table in which hot keys are
    looked for on a scan of the key column alone. Where ``lie_by_transaction`` says that the
    lines come hash-partitioned by ``transaction_id``, dimensions of more than ``enrich.LARGE``
    rows are joined without moving the lines, whose plan then runs once more for each
    from the shuffle it ends with. The dimensions are counted for it (jobs) and
    should be stored tables."""
    joins = (
        (products, "product_id", {"category": "product_category", "brand": "product_brand", "cost": "cost"}),
        (customers, "customer_id", {"customer_segment": "customer_segment", "state": "customer_state"}),
    )
    line, by = SOURCES["transactions"].key, "transaction_id"
    lines, moved = flagged, []
    for dim, key, columns in joins:
        wanted = dim.select(key, *[F.col(old).alias(new) for old, new in columns.items()])
        hot = hot_keys(keys_from[key], key)
        if not lie_by_transaction or dim.count() <= enrich.LARGE:
            moved.append((wanted, key, hot))
            continue
        # a line's own key comes once; lines of a transaction share others
        pairs = flagged.select(by, key) if {by, key} == set(line) else flagged.select(by, key).distinct()
        lines = left_join_in_place(lines, wanted, key, hot, pairs, by, salts)
    for wanted, key, hot in reversed(moved):
        lines = left_join_salted(lines, wanted, key, hot, line, salts)
    return lines


def conform_flagged(
    flagged: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    keys_from: Mapping[str, DataFrame],
    salts: int = 64,
    lie_by_transaction: bool = False,
) -> DataFrame:
    """The silver lines from deduplicated, flagged ones; what they leave out is
    :func:`rejected`."""
    lines = keep_valid(flagged)
    return shape_transactions(enrich_transactions(lines, customers, products, keys_from, salts, lie_by_transaction))


def conform_transactions(
    bronze: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    keys_from: Mapping[str, DataFrame] | None = None,
    salts: int = 64,
    lie_by_transaction: bool = False,
) -> DataFrame:
    """The valid transaction lines with their dimensions.

    One row is one (transaction, product); counts of ``transaction_id`` on
    this table therefore count order lines. ``lie_by_transaction`` says that ``bronze`` comes
    hash-partitioned by ``transaction_id``, see :func:`enrich_transactions`."""
    keys_from = keys_from or {"customer_id": bronze, "product_id": bronze}
    return conform_flagged(flag_transactions(bronze), customers, products, keys_from, salts, lie_by_transaction)


def shape_transactions(lines: DataFrame) -> DataFrame:
    """The silver columns of enriched, flagged transaction lines."""
    percent = Decimal("0.01")
    quantity = F.col("quantity").cast("decimal(9,0)")
    gross = F.col("unit_price") * quantity
    columns = {
        **_same("transaction_id", "customer_id", "product_id", "transaction_date"),
        **_calendar(
            "transaction_date", "transaction", "year", "month", "day_of_week", "hour", "quarter"
        ),
        **_same("quantity", "unit_price", "discount_percent", "total_amount"),
        "discount_amount": F.round(gross * F.col("discount_percent") * F.lit(percent), 2),
        "revenue": F.col("total_amount"),
        "gross_profit": F.round(F.col("total_amount") - F.col("cost") * quantity, 2),
        **_same("payment_method", "channel", "store_id", "shipping_cost", "order_status"),
        **_same("customer_segment", "customer_state", "product_category", "product_brand"),
        **_loaded(),
        **_same(FLAG),
    }
    return lines.select(*named(columns))


def conform_crm(bronze: DataFrame) -> DataFrame:
    columns = {
        **_same("interaction_id", "customer_id", "interaction_date"),
        **_calendar("interaction_date", "interaction", "year", "month"),
        **_same("interaction_type", "reason", "resolution_status", "agent_id", "duration_minutes"),
        "duration_category": policies.CALL_LENGTH.column(),
        **_same("satisfaction_score"),
        "is_unresolved": policies.UNRESOLVED.column(),
        **_same("notes"),
        **_loaded(),
    }
    return _latest_shaped(bronze, "crm_interactions", columns)


def conform_loyalty(bronze: DataFrame) -> DataFrame:
    columns = {
        **_same("event_id", "customer_id", "event_date"),
        **_calendar("event_date", "event", "year", "month"),
        **_same("event_type", "points_change"),
        "points_transaction_type": policies.POINTS_KIND.column(),
        **_same("points_balance", "tier", "description"),
        **_loaded(),
    }
    return _latest_shaped(bronze, "loyalty_events", columns)


def conform_web(bronze: DataFrame) -> DataFrame:
    per_page = F.try_divide(
        F.col("session_duration_seconds").cast("double"), F.col("page_views").cast("double")
    )
    columns = {
        **_same("session_id", "customer_id", "session_date"),
        **_calendar("session_date", "session", "year", "month", "day_of_week", "hour"),
        **_same("device_type", "browser", "page_views", "session_duration_seconds"),
        # NULL, not an error, for a session without page views
        "avg_time_per_page_seconds": F.round(per_page, 2),
        "session_duration_category": policies.VISIT_LENGTH.column(),
        "is_bounce": F.col("bounce"),
        "is_conversion": F.col("conversion"),
        **_same("utm_source", "utm_campaign", "landing_page", "exit_page"),
        "is_abandoned_cart": policies.ABANDONED_CART.column(),
        **_loaded(),
    }
    return _latest_shaped(bronze, "web_analytics", columns, {"is_bounce": "bounce", "is_conversion": "conversion"})


def conform_tickets(bronze: DataFrame) -> DataFrame:
    columns = {
        **_same("ticket_id", "customer_id", "created_date"),
        **_calendar("created_date", "created", "year", "month"),
        **_same("category", "priority", "status", "assigned_agent", "resolved_date"),
        **_same("resolution_time_hours"),
        "resolution_speed": policies.RESOLUTION_SPEED.column(),
        "sla_breached": policies.SLA_BREACHED.column(),
        **_same("customer_satisfaction"),
        "is_dissatisfied": policies.DISSATISFIED.column(),
        **_loaded(),
    }
    return _latest_shaped(bronze, "support_tickets", columns)
