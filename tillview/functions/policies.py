"""The business rules of the retail layers, as data.

Fixed values: labels, thresholds and domain words in this module are part of
the results and must not change.
"""

from tillview.functions.rules import Rules, above, at_least, below, flag

VALID = "Valid"

# -- row quality ----------------------------------------------------------
CUSTOMER_QUALITY = Rules(
    (
        ("email IS NULL OR phone_cleaned IS NULL", "Missing Contact Info"),
        ("age < 18", "Underage"),
        ("age > 100", "Invalid Age"),
    ),
    VALID,
)
PRODUCT_QUALITY = Rules(
    (
        ("price IS NULL OR price <= 0", "Invalid Price"),
        ("cost IS NULL OR cost <= 0", "Invalid Cost"),
        ("price < cost", "Price Below Cost"),
    ),
    VALID,
)
# A NULL amount or quantity matches no case, so such a row counts as valid.
TRANSACTION_QUALITY = Rules(
    (
        ("total_amount < 0", "Negative Amount"),
        ("quantity <= 0", "Invalid Quantity"),
        ("customer_id IS NULL", "Missing Customer"),
        ("product_id IS NULL", "Missing Product"),
    ),
    VALID,
)

# -- categories of one row ------------------------------------------------
STOCK_STATUS = Rules(
    (
        ("stock_quantity = 0", "Out of Stock"),
        ("stock_quantity < 10", "Low Stock"),
        ("stock_quantity < 50", "Medium Stock"),
    ),
    "In Stock",
)
CALL_LENGTH = below(
    "duration_minutes", [(5, "Quick"), (15, "Standard"), (30, "Extended")], "Long"
)
UNRESOLVED = flag("resolution_status IN ('Pending', 'Escalated')")
POINTS_KIND = Rules((("points_change > 0", "Earn"), ("points_change < 0", "Redeem")), "Neutral")
VISIT_LENGTH = below(
    "session_duration_seconds", [(60, "Very Short"), (300, "Short"), (900, "Medium")], "Long"
)
ABANDONED_CART = flag("NOT conversion AND page_views > 3")
RESOLUTION_SPEED = Rules(
    (
        ("resolution_time_hours IS NULL", "Unresolved"),
        ("resolution_time_hours < 4", "Fast"),
        ("resolution_time_hours < 24", "Standard"),
        ("resolution_time_hours < 72", "Slow"),
    ),
    "Very Slow",
)
SLA_BREACHED = Rules(
    (
        ("priority = 'High' AND resolution_time_hours > 48", True),
        ("priority <> 'High' AND resolution_time_hours > 72", True),
    ),
    False,
)
DISSATISFIED = flag("customer_satisfaction <= 2")

# -- categories of one customer or product --------------------------------
ACTIVE_CUSTOMER = flag("recency_days <= 90")
CHURN_RISK = above("recency_days", [(180, "High"), (90, "Medium")], "Low")
CHURN_LABEL = Rules((("days_since_last_purchase > 90", 1),), 0)
HEALTH_CATEGORY = at_least(
    "customer_health_score", [(80, "Excellent"), (60, "Good"), (40, "Fair")], "Poor"
)
RFM_SEGMENT = at_least(
    "rfm_score",
    [
        (13, "Champions"),
        (11, "Loyal Customers"),
        (9, "Potential Loyalists"),
        (7, "At Risk"),
        (5, "Needs Attention"),
    ],
    "Lost",
)
TIER_RANK = Rules((("tier = 'Gold'", 3), ("tier = 'Silver'", 2)), 1)
CLV_TIER = at_least(
    "predicted_clv_3yr", [(10000, "Platinum"), (5000, "Gold"), (2000, "Silver")], "Bronze"
)
PRODUCT_STATUS = Rules(
    (
        ("days_since_last_sale > 180", "Dormant"),
        ("days_since_last_sale > 90", "Slow Moving"),
        ("avg_daily_sales > 1", "Fast Moving"),
    ),
    "Active",
)
WEEKEND = Rules((("day_of_week IN (1, 7)", 1),), 0)

# -- numbers --------------------------------------------------------------
DAYS_PER_YEAR = 365.25
DAYS_PER_MONTH = 30
LOOKBACK_DAYS = (30, 60, 90)
RFM_QUANTILES = (0.2, 0.4, 0.6, 0.8)
CLV_MONTHS = 36
HEALTH_DEFAULT_SATISFACTION = 3
HEALTH_POINTS_PER_SATISFACTION = 20
HEALTH_MAX_COUNTED_TRANSACTIONS = 20
HEALTH_POINTS_PER_TRANSACTION = 2
HEALTH_POINTS_IF_ACTIVE = 30
HEALTH_LOYALTY_POINTS_PER_POINT = 100
HEALTH_MAX_LOYALTY = 10
CLV_LABEL_RANGE = (0, 100000)
