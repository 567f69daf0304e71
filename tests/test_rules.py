"""Every rule list: each branch, each boundary, and NULL."""

import pytest
from pyspark.sql import functions as F
from tillview.functions import policies

N = None
# rules, column type(s), [(inputs, expected)]
CASES = [
    ("CUSTOMER_QUALITY", "email string, phone_cleaned string, age int", [
        ((N, "1", 30), "Missing Contact Info"), (("a", N, 30), "Missing Contact Info"),
        (("a", "1", 17), "Underage"), (("a", "1", 18), "Valid"), (("a", "1", 100), "Valid"),
        (("a", "1", 101), "Invalid Age"), (("a", "1", N), "Valid"), ((N, "1", 5), "Missing Contact Info")]),
    ("PRODUCT_QUALITY", "price double, cost double", [
        ((N, 1.0), "Invalid Price"), ((0.0, 1.0), "Invalid Price"), ((-1.0, N), "Invalid Price"),
        ((2.0, N), "Invalid Cost"), ((2.0, 0.0), "Invalid Cost"), ((2.0, 3.0), "Price Below Cost"),
        ((2.0, 2.0), "Valid"), ((2.0, 1.0), "Valid")]),
    ("TRANSACTION_QUALITY", "total_amount double, quantity int, customer_id string, product_id string", [
        ((-0.1, 1, "c", "p"), "Negative Amount"), ((0.0, 1, "c", "p"), "Valid"),
        ((1.0, 0, "c", "p"), "Invalid Quantity"), ((1.0, 1, N, "p"), "Missing Customer"),
        ((1.0, 1, "c", N), "Missing Product"), ((N, 1, "c", "p"), "Valid"), ((1.0, N, "c", "p"), "Valid")]),
    ("STOCK_STATUS", "stock_quantity int", [
        ((0,), "Out of Stock"), ((1,), "Low Stock"), ((9,), "Low Stock"), ((10,), "Medium Stock"),
        ((49,), "Medium Stock"), ((50,), "In Stock"), ((N,), "In Stock")]),
    ("CALL_LENGTH", "duration_minutes int", [
        ((4,), "Quick"), ((5,), "Standard"), ((14,), "Standard"), ((15,), "Extended"),
        ((29,), "Extended"), ((30,), "Long"), ((N,), "Long")]),
    ("UNRESOLVED", "resolution_status string", [
        (("Pending",), True), (("Escalated",), True), (("Resolved",), False), ((N,), False)]),
    ("POINTS_KIND", "points_change int", [((1,), "Earn"), ((-1,), "Redeem"), ((0,), "Neutral"), ((N,), "Neutral")]),
    ("VISIT_LENGTH", "session_duration_seconds int", [
        ((59,), "Very Short"), ((60,), "Short"), ((299,), "Short"), ((300,), "Medium"),
        ((899,), "Medium"), ((900,), "Long"), ((N,), "Long")]),
    ("ABANDONED_CART", "conversion boolean, page_views int", [
        ((False, 4), True), ((False, 3), False), ((True, 4), False), ((N, 4), False), ((False, N), False)]),
    ("RESOLUTION_SPEED", "resolution_time_hours int", [
        ((N,), "Unresolved"), ((3,), "Fast"), ((4,), "Standard"), ((23,), "Standard"),
        ((24,), "Slow"), ((71,), "Slow"), ((72,), "Very Slow")]),
    ("SLA_BREACHED", "priority string, resolution_time_hours int", [
        (("High", 48), False), (("High", 49), True), (("Low", 72), False), (("Low", 73), True),
        ((N, 100), False), (("High", N), False)]),
    ("DISSATISFIED", "customer_satisfaction int", [((2,), True), ((3,), False), ((N,), False)]),
    ("ACTIVE_CUSTOMER", "recency_days int", [((90,), True), ((91,), False), ((N,), False)]),
    ("CHURN_RISK", "recency_days int", [
        ((181,), "High"), ((180,), "Medium"), ((91,), "Medium"), ((90,), "Low"), ((N,), "Low")]),
    ("CHURN_LABEL", "days_since_last_purchase int", [((91,), 1), ((90,), 0), ((N,), 0)]),
    ("HEALTH_CATEGORY", "customer_health_score double", [
        ((80.0,), "Excellent"), ((79.9,), "Good"), ((60.0,), "Good"), ((59.9,), "Fair"),
        ((40.0,), "Fair"), ((39.9,), "Poor"), ((N,), "Poor")]),
    ("RFM_SEGMENT", "rfm_score int", [
        ((15,), "Champions"), ((13,), "Champions"), ((12,), "Loyal Customers"), ((10,), "Potential Loyalists"),
        ((8,), "At Risk"), ((6,), "Needs Attention"), ((5,), "Needs Attention"), ((4,), "Lost"), ((N,), "Lost")]),
    ("TIER_RANK", "tier string", [(("Gold",), 3), (("Silver",), 2), (("Platinum",), 1), ((N,), 1)]),
    ("CLV_TIER", "predicted_clv_3yr double", [
        ((10000.0,), "Platinum"), ((9999.99,), "Gold"), ((5000.0,), "Gold"), ((2000.0,), "Silver"),
        ((1999.99,), "Bronze"), ((N,), "Bronze")]),
    ("PRODUCT_STATUS", "days_since_last_sale int, avg_daily_sales double", [
        ((181, 5.0), "Dormant"), ((180, 5.0), "Slow Moving"), ((91, 5.0), "Slow Moving"),
        ((90, 1.1), "Fast Moving"), ((90, 1.0), "Active"), ((N, N), "Active")]),
    ("WEEKEND", "day_of_week int", [((1,), 1), ((7,), 1), ((2,), 0), ((6,), 0), ((N,), 0)]),
]


@pytest.mark.parametrize("name,schema,cases", CASES, ids=[c[0] for c in CASES])
def test_rules(spark, name, schema, cases):
    rows = [(i, *inputs) for i, (inputs, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, {schema}")
    out = df.select("i", getattr(policies, name).column().alias("got")).orderBy("i").collect()
    assert [r.got for r in out] == [expected for _, expected in cases]


def test_every_rule_list_is_tested():
    from tillview.functions.rules import Rules

    assert {n for n, v in vars(policies).items() if isinstance(v, Rules)} == {c[0] for c in CASES}


def test_first_match_wins(spark):
    from tillview.functions.rules import Rules

    rules = Rules((("x > 0", "a"), ("x > 1", "b")), "c")
    df = spark.createDataFrame([(2,), (None,)], "x int").select(rules.column().alias("y"))
    assert [r.y for r in df.collect()] == ["a", "c"]
    assert F.expr("1") is not None
