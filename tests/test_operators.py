"""Operators on inline rows: edges the generated tables do not reach."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from tillview.operators import conform, customer_view, enrich, features, lifetime, profile, ranks, rfm, sales, segments
from tillview.operators.dedup import dedup_latest, latest_value_per_key
from tillview.operators.enrich import hot_keys, left_join_in_place, left_join_salted
from tillview.operators.profile import customer_profile
from tillview.operators.ranks import share_rank, values_at
from tillview.sources.schemas import SOURCES

AS_OF = date(2024, 6, 30)
LOADED = datetime(2024, 6, 30, 1)
LINES = (
    "transaction_id string, customer_id string, product_id string, transaction_date timestamp, "
    "quantity int, revenue decimal(18,4), discount_percent decimal(9,4), channel string, "
    "order_status string, payment_method string, product_category string"
)


def lines(spark, rows):
    """(transaction, customer, product, date, quantity, revenue[, category])"""
    full = [
        (t, c, p, datetime.fromisoformat(d), q, Decimal(str(r)), Decimal(0), "Online", "Returned", "PayPal", (more or ["A"])[0])
        for t, c, p, d, q, r, *more in rows
    ]
    return spark.createDataFrame(full, LINES).withColumns(
        {"transaction_month": F.month("transaction_date"), "transaction_hour": F.hour("transaction_date")}
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def bronze(spark, source, **values):
    """One ingested row of a source, NULL where nothing is given."""
    schema = SOURCES[source].schema
    row = tuple(values.get(f.name) for f in schema)
    return spark.createDataFrame([row], schema).withColumn("ingestion_timestamp", F.lit(LOADED))


# -- dedup ------------------------------------------------------------------
def test_dedup_is_stable_under_partitioning(spark):
    rows = [(k, LOADED, v) for k in range(20) for v in range(15)]
    df = spark.createDataFrame(rows, "k int, at timestamp, v int")
    results = {
        tuple(sorted(map(tuple, dedup_latest(df.repartition(n, col), ["k"], "at").collect())))
        for n in (1, 3, 7)
        for col in ("k", "v")
    }
    assert results == {tuple((k, LOADED, 0) for k in range(20))}


def test_dedup_prefers_the_latest_and_keeps_null_keys_once(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [("a", early, 1), ("a", late, 2), (None, late, 3), (None, early, 4), ("b", None, 5), ("b", early, 6)],
        "k string, at timestamp, v int",
    )
    got = {r.k: r.v for r in dedup_latest(df, ["k"], "at").collect()}
    assert got == {"a": 2, None: 3, "b": 6}


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, LOADED, 2)], "k int, at timestamp, v int")
    plan = dedup_latest(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize(("source", "made"), [("crm_interactions", "is_unresolved"), ("loyalty_events", "points_transaction_type"), ("web_analytics", "is_abandoned_cart"), ("support_tickets", "sla_breached")])
def test_only_ingested_columns_are_shuffled_to_tell_copies(spark, source, made):
    """And ties of loading time go to the copy that is first by the silver columns, NULL first."""
    by = {"crm_interactions": conform.conform_crm, "loyalty_events": conform.conform_loyalty, "web_analytics": conform.conform_web, "support_tickets": conform.conform_tickets}
    schema = SOURCES[source].schema.add("ingestion_timestamp", "timestamp")
    text = {f.name for f in schema if f.dataType.simpleString() == "string"}
    rows = [tuple("k" if f.name in SOURCES[source].key else (v if f.name in text else LOADED if f.name == "ingestion_timestamp" else None) for f in schema) for v in ("b", None, "a")]
    out = by[source](spark.createDataFrame(rows, schema))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert made in plan[: plan.index("Exchange")] and made not in plan[plan.index("Exchange") :]
    assert one(out)["customer_id"] is None


# -- enrichment -------------------------------------------------------------
def test_salted_join_equals_plain_join_with_a_hot_key_and_nulls(spark):
    facts = spark.range(6000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
        .alias("k"),
    )
    dim = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 400)]], "k string, x int")
    hot = hot_keys(facts, "k", share=0.01)
    assert [r.k for r in hot.collect()] == ["hot"]
    salted = left_join_salted(facts, dim, "k", hot, ["id"], salts=8)
    plain = facts.join(dim, "k", "left")
    assert salted.count() == 6000
    columns = ["id", "k", "x"]
    assert salted.select(*columns).exceptAll(plain.select(*columns)).isEmpty()
    assert plain.select(*columns).exceptAll(salted.select(*columns)).isEmpty()


def _placed(spark):
    """Facts as a join on ``t`` leaves them: NULLs, a hot key, keys without a dimension row, copies."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 50 != 0, F.concat(F.lit("t"), F.col("id") % 700)).alias("t"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
        (F.col("id") % 2900).alias("paid"),
    )
    right = spark.range(600).select(F.concat(F.lit("t"), "id").alias("o"), F.col("id").alias("ordered"))
    return left.join(right, F.col("t") == F.col("o"), "left").drop("o")


def test_join_in_place_equals_plain_join(spark):
    facts = _placed(spark)
    dim = spark.createDataFrame([("hot", 1, None), *[(f"k{i}", i, "x") for i in range(0, 400)]], "k string, x int, y string")
    pairs = facts.select("t", "k").unionByName(spark.createDataFrame([("t1", "k5"), (None, "hot"), ("none", "k6")], "t string, k string"))
    columns = ["t", "k", "paid", "ordered", "x", "y"]
    plain = sorted(map(str, facts.join(dim, "k", "left").select(*columns).collect()))
    for some in (pairs, pairs.distinct()):
        got = left_join_in_place(facts, dim, "k", hot_keys(facts, "k", share=0.01), some, "t", salts=8)
        assert sorted(map(str, got.select(*columns).collect())) == plain


def test_join_in_place_does_not_move_the_facts(spark, monkeypatch):
    """No shuffle above the facts' own join, for either dimension of the lines."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(enrich, "LARGE", 0)
        ordered = spark.range(9).select(F.col("id").cast("string").alias("transaction_id"), F.lit("c").alias("customer_id"))
        sold = bronze(spark, "transactions", transaction_id="1", product_id="p", quantity=1, total_amount=Decimal(1)).drop("customer_id")
        customers = spark.createDataFrame([("c", "Gold", "TX")], "customer_id string, customer_segment string, state string")
        products = spark.createDataFrame([("p", "A", "B", Decimal(1))], "product_id string, category string, brand string, cost decimal(18,4)")
        out = conform.conform_transactions(sold.join(ordered, "transaction_id", "left"), customers, products, lie_by_transaction=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Union\n") == 2 and plan.index("Union\n") < plan.index("SortMergeJoin") < plan.index("Exchange")
        row = one(out)
        assert (row["customer_state"], row["product_brand"], row["gross_profit"]) == ("TX", "B", 0)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_spread(spark):
    facts = spark.range(4000).select("id", F.lit("hot").alias("k"))
    salt = F.pmod(F.xxhash64("id"), F.lit(8))
    sizes = [r["count"] for r in facts.groupBy(salt).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 700


# -- conform ----------------------------------------------------------------
def test_zero_price_gives_no_margin_and_no_error(spark):
    row = one(conform.conform_products(bronze(spark, "products", product_id="p", price=Decimal(0), cost=Decimal(1)), AS_OF))
    assert row["profit_margin_pct"] is None and row["data_quality_flag"] == "Invalid Price"


def test_in_stock(spark):
    row = one(conform.conform_products(
        bronze(spark, "products", product_id="p", price=Decimal(4), cost=Decimal(3), stock_quantity=50,
               launch_date=date(2024, 6, 20), category=" home & garden "), AS_OF))
    assert (row["stock_status"], row["profit_margin_pct"], row["product_age_days"]) == ("In Stock", 25.0, 10)
    assert row["category"] == "Home & Garden"


def test_no_page_views_gives_no_time_per_page(spark):
    row = one(conform.conform_web(bronze(spark, "web_analytics", session_id="s", page_views=0, session_duration_seconds=5)))
    assert row["avg_time_per_page_seconds"] is None and row["is_abandoned_cart"] is False


def test_customer_cleaning(spark):
    row = one(conform.conform_customers(
        bronze(spark, "customers", customer_id="c", first_name="  aNNa ", email=" A@B.Example ",
               phone="+1 (555) 01", date_of_birth=date(2000, 7, 1), registration_date=date(2024, 6, 1),
               gender="f", state=" ca "), AS_OF))
    assert (row["first_name"], row["email"], row["phone_cleaned"]) == ("Anna", "a@b.example", "155501")
    assert (row["age"], row["customer_tenure_days"], row["gender"], row["state"]) == (23, 29, "F", "CA")


def test_invalid_latest_copy_removes_the_key(spark):
    base = bronze(spark, "transactions", transaction_id="t", product_id="p", customer_id="c",
                  quantity=1, total_amount=Decimal(1))
    newer = bronze(spark, "transactions", transaction_id="t", product_id="p", customer_id="c",
                   quantity=0, total_amount=Decimal(1)).withColumn("ingestion_timestamp", F.lit(datetime(2024, 7, 1)))
    flagged = conform.flag_transactions(base.unionByName(newer))
    assert one(flagged)["data_quality_flag"] == "Invalid Quantity"
    assert conform.keep_valid(flagged).isEmpty() and conform.rejected(flagged).count() == 1


def test_transactions_keep_unknown_dimensions_as_null(spark):
    raw = bronze(spark, "transactions", transaction_id="t", product_id="p", customer_id="c", quantity=2,
                 unit_price=Decimal("10"), discount_percent=Decimal("12.5"), total_amount=Decimal("17.5"),
                 transaction_date=datetime(2024, 2, 29, 13))
    customers = conform.conform_customers(bronze(spark, "customers", customer_id="other"), AS_OF)
    products = conform.conform_products(bronze(spark, "products", product_id="p", cost=Decimal(3), category="toys"), AS_OF)
    row = one(conform.conform_transactions(raw, customers, products))
    assert (row["customer_segment"], row["product_category"]) == (None, "Toys")
    assert (row["discount_amount"], row["gross_profit"]) == (Decimal("2.50"), Decimal("11.50"))
    assert (row["transaction_year"], row["transaction_month"], row["transaction_hour"], row["transaction_quarter"]) == (2024, 2, 13, 1)


# -- customer view ----------------------------------------------------------
@pytest.fixture(scope="module")
def silent_view(spark):
    """A customer without a single fact, and one with a purchase."""
    customers = conform.conform_customers(
        bronze(spark, "customers", customer_id="quiet").unionByName(bronze(spark, "customers", customer_id="buyer")), AS_OF)
    bought = lines(spark, [("t", "buyer", "p", "2024-06-29", 1, 10)])
    none = lambda source, fn: fn(bronze(spark, source)).limit(0)
    others = (
        none("loyalty_events", conform.conform_loyalty),
        none("crm_interactions", conform.conform_crm),
        none("web_analytics", conform.conform_web),
        none("support_tickets", conform.conform_tickets),
    )
    return customers, bought, others


def test_customer_without_facts(spark, silent_view):
    customers, bought, others = silent_view
    view = {r.customer_id: r.asDict() for r in customer_view.customer_360(customers, bought, *others, AS_OF).collect()}
    quiet = view["quiet"]
    assert (quiet["recency_days"], quiet["churn_risk_flag"], quiet["customer_health_score"]) == (None, "Low", 60.0)
    assert (quiet["total_transactions"], quiet["avg_satisfaction_score"], quiet["is_active_customer"]) == (0, 0.0, False)
    assert view["buyer"]["customer_health_score"] == 92.0
    assert view["buyer"]["customer_lifetime_value"] == Decimal(10)


def test_never_buyer_is_labelled_not_churned(spark, silent_view):
    customers, bought, (loyalty, crm, web, tickets) = silent_view
    out = features.customer_features(customers, bought, loyalty, crm, web, tickets, rfm.rfm(bought, AS_OF), AS_OF)
    assert len(out.columns) == 64
    rows = {r.customer_id: r.asDict() for r in out.collect()}
    assert (rows["quiet"]["is_churned"], rows["quiet"]["days_since_last_purchase"], rows["quiet"]["rfm_segment"]) == (0, 0, None)
    assert rows["buyer"]["stddev_transaction_value"] == 0 and rows["buyer"]["purchase_frequency"] == 0


def test_highest_tier_name_and_balance(spark):
    events = spark.createDataFrame(
        [("c", 5, "Platinum", "Earn", 5), ("c", 9, "Silver", "Redeem", -4), ("c", 1, None, "Neutral", 0)],
        "customer_id string, points_balance int, tier string, points_transaction_type string, points_change int",
    ).withColumn("event_type", F.lit("x"))
    row = one(customer_view.loyalty_metrics(events))
    assert (row["current_loyalty_points"], row["current_loyalty_tier"]) == (9, "Silver")
    assert (row["total_points_earned"], row["total_points_redeemed"]) == (5, 4)
    assert one(features.loyalty_features(events))["loyalty_tier_numeric"] == 2


# -- profile ----------------------------------------------------------------
def test_profile_distinct_counts_and_windows(spark):
    df = lines(spark, [
        ("t1", "c", "p1", "2024-06-29", 1, 1, "A"), ("t1", "c", "p2", "2024-06-29", 2, 2, "B"),
        ("t2", "c", "p1", "2024-05-31 08:00", 3, 4, "A"), ("t3", "c", "p1", "2023-05-31", 1, 8, None),
        ("t4", None, "p1", "2024-06-01", 1, 16, "A")])
    wanted = ["order_count", "product_count", "category_count", "day_count", "months_seen", "line_count",
              "lines_30d", "lines_60d", "revenue_30d", "days_since_last", "days_first_to_last"]
    row = one(customer_profile(df, AS_OF, wanted))
    assert [row[w] for w in wanted] == [3, 2, 2, 3, 2, 4, 3, 3, Decimal(7), 1, 395]
    with pytest.raises(ValueError):
        customer_profile(df, AS_OF, ["nonsense"])


def test_one_customer_holding_most_lines(spark):
    """Skew changes nothing: counts against the same aggregate in one group."""
    df = spark.range(30000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 1000).cast("string")).alias("customer_id"),
        (F.col("id") % 77).cast("string").alias("product_id"),
        (F.col("id") % 5).cast("string").alias("product_category"),
        F.lit(datetime(2024, 6, 1)).alias("transaction_date"),
        F.lit(6).alias("transaction_month"),
        F.lit(1).cast("decimal(18,4)").alias("revenue"),
    )
    out = customer_profile(df, AS_OF, ["line_count", "order_count", "product_count", "category_count"])
    hot = one(out.filter("customer_id = 'hot'"))
    assert (hot["line_count"], hot["order_count"], hot["product_count"], hot["category_count"]) == (10000, 10000, 77, 5)
    assert out.agg(F.sum("line_count")).first()[0] == 30000


def test_only_customers_with_very_many_lines_are_aggregated_apart(spark, monkeypatch):
    """The others, a few lines each, are shuffled as lines; both against the plain aggregate."""
    df = spark.range(40000).select(
        F.when(F.col("id") % 11 != 0, (F.col("id") % 9973).cast("string")).alias("transaction_id"),
        F.when(F.col("id") % 4 == 0, "hot").when(F.col("id") % 97 != 0, (F.col("id") % 3001).cast("string")).alias("customer_id"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 77).cast("string")).alias("product_id"),
        F.when(F.col("id") % 3001 != 5, (F.col("id") % 5).cast("string")).alias("product_category"),
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 90).cast("int")).cast("timestamp").alias("transaction_date"),
        (F.col("id") % 3 + 1).cast("int").alias("transaction_month"),
        (F.col("id") % 100).cast("decimal(18,4)").alias("revenue"),
    )
    seen, whole = [], profile._spread_profile
    monkeypatch.setattr(profile, "_spread_profile", lambda known, *rest: seen.append(known) or whole(known, *rest))
    wanted = ["line_count", "order_count", "product_count", "category_count", "day_count", "revenue_sum", "months_seen"]
    got = customer_profile(df, AS_OF, wanted)
    assert [r[0] for r in seen[0].select("customer_id").distinct().collect()] == ["hot"]
    plain = df.filter("customer_id is not null").groupBy("customer_id").agg(
        F.count("transaction_id"), F.count_distinct("transaction_id"), F.count_distinct("product_id"), F.count_distinct("product_category"),
        F.count_distinct(F.to_date("transaction_date")), F.sum("revenue"), F.count_distinct("transaction_month"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    assert [t for _, t in got.dtypes[1:6]] == ["bigint"] * 5


# -- RFM, CLV ---------------------------------------------------------------
def test_rfm_of_one_customer_and_of_equal_frequencies(spark):
    row = one(rfm.rfm(lines(spark, [("t", "c", "p", "2024-06-01", 1, 5)]), AS_OF))
    assert (row["recency_score"], row["frequency_score"], row["monetary_score"]) == (5, 5, 5)
    many = lines(spark, [(f"t{i}", f"c{i}", "p", f"2024-06-{i:02d}", 1, i) for i in range(1, 11)])
    rows = sorted((int(r.customer_id[1:]), r.recency_score, r.frequency_score, r.monetary_score)
                  for r in rfm.rfm(many, AS_OF).collect())
    assert {r[2] for r in rows} == {5}
    assert rows[0][1] == 1 and rows[-1][1] == 5 and rows[0][3] == 1 and rows[-1][3] == 5
    assert all(3 <= sum(r[1:]) <= 15 for r in rows)


def test_clv_single_purchase_and_same_day(spark):
    customers = conform.conform_customers(bronze(spark, "customers", customer_id="x"), AS_OF)
    df = lines(spark, [("t1", "once", "p", "2024-06-01", 1, 5), ("t2", "day", "p", "2024-06-01 09:00", 1, 5),
                       ("t3", "day", "p", "2024-06-01 10:00", 1, 7), ("t4", "far", "p", "2024-05-01", 1, 100),
                       ("t5", "far", "p", "2024-05-31", 1, 200)])
    rows = {r.customer_id: r.asDict() for r in lifetime.clv_features(df, customers, AS_OF).collect()}
    assert (rows["once"]["avg_days_between_purchases"], rows["once"]["purchase_frequency_monthly"]) == (None, 0.0)
    assert (rows["day"]["avg_days_between_purchases"], rows["day"]["purchase_days"], rows["day"]["predicted_clv_3yr"]) == (0.0, 1, 0.0)
    assert (rows["far"]["predicted_clv_3yr"], rows["far"]["clv_tier"]) == (10800.0, "Platinum")


# -- sales ------------------------------------------------------------------
def test_product_status_and_unsold_products(spark):
    df = lines(spark, [("t1", "c", "fast", "2024-06-01", 50, 5), ("t2", "c", "fast", "2024-06-11", 1, 5),
                       ("t3", "c", "idle", "2023-01-01", 1, 5)])
    products = conform.conform_products(
        bronze(spark, "products", product_id="fast").unionByName(bronze(spark, "products", product_id="unsold")), AS_OF)
    sold = {r.product_id: r.asDict() for r in sales.product_performance(df, products, AS_OF).collect()}
    assert {k: v["product_status"] for k, v in sold.items()} == {"fast": "Fast Moving", "idle": "Dormant"}
    assert (sold["fast"]["avg_daily_sales"], sold["fast"]["return_rate"]) == (5.1, 1.0)
    every = {r.product_id: r.asDict() for r in sales.product_performance(df, products, AS_OF, include_unsold=True).collect()}
    assert set(every) == {"fast", "unsold"} and every["unsold"]["total_orders"] is None
    assert every["unsold"]["product_status"] == "Active" and every["unsold"]["return_rate"] == 0.0


def test_sales_levels_agree(spark):
    df = lines(spark, [("t1", "c", "p", "2024-06-01", 1, 5, "A"), ("t2", "d", "p", "2024-06-01", 2, 7, "B"),
                       ("t3", "c", "p", "2024-07-03", 1, 1, None)])
    got = {r.aggregation_level: (r.rows, r.revenue) for r in sales.sales_union(df).groupBy("aggregation_level").agg(
        F.count("*").alias("rows"), F.sum("total_revenue").alias("revenue")).collect()}
    assert got == {"daily": (2, Decimal(13)), "monthly": (2, Decimal(13)), "category": (3, Decimal(13))}
    assert [r.month_year for r in sales.sales_monthly(df).collect()] == ["2024-06", "2024-07"]


# -- segments ---------------------------------------------------------------
def test_nearest_center_ties_go_to_the_lower_index_and_do_not_shuffle(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 0.9), ("c", 5.0)], "customer_id string, x double")
    out = segments.nearest_center_assign(df, ["x"], [[1.0], [-1.0], [4.0]])
    assert {r.customer_id: r.cluster for r in out.collect()} == {"a": 0, "b": 0, "c": 2}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_nearest_center_agrees_with_the_model(spark):
    rows = [(str(i), float(i % 4) * 10 + (i % 3), float(i % 4) * 7) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id string, total_transactions double, total_revenue double")
    model = segments.fit_segments(df, k=4)
    by_model = model.transform(df).select("customer_id", "cluster")
    centers = segments.centers_of(model)
    # the model measures in standardised units: scale rows and centres alike
    scaler = model.stages[1]
    mean, std = scaler.mean.toArray(), scaler.std.toArray()
    columns = ["total_transactions", "total_revenue"]
    scaled = df.select("customer_id", *[((F.col(c) - float(m)) / float(s)).alias(c) for c, m, s in zip(columns, mean, std)])
    ours = segments.nearest_center_assign(scaled, columns, [((c - mean) / std).tolist() for c in centers])
    assert ours.select("customer_id", "cluster").exceptAll(by_model).isEmpty()


def test_segment_names(spark):
    df = spark.createDataFrame([(0,), (4,), (7,)], "cluster int")
    got = [r.n for r in df.select("cluster", segments.segment_name().alias("n")).orderBy("cluster").collect()]
    assert got == ["High Value Frequent Buyers", "Discount Seekers", "Segment_7"]
    profiles = spark.createDataFrame(
        [(0, 10.0, 100.0, 5.0, 0.1), (1, 1.0, 10.0, 10.0, 0.0), (2, 5.0, 50.0, 300.0, 0.2),
         (3, 6.0, 60.0, 20.0, 0.9), (4, 7.0, 70.0, 30.0, 0.1)],
        "cluster int, avg_transactions double, avg_revenue double, avg_recency double, avg_return_rate double")
    assert segments.names_by_rank(profiles) == {
        0: "High Value Frequent Buyers", 2: "At Risk Customers", 3: "Discount Seekers",
        1: "New Customers", 4: "Occasional Shoppers"}


def test_missing_customer_id_is_an_error(spark):
    with pytest.raises(ValueError):
        segments.segmentation_features(spark.range(1))


def test_segment_profile_joins_what_is_missing(spark):
    seg = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "customer_id string, cluster int")
    feats = spark.createDataFrame([("a", 1.0, 1, 3), ("b", 2.0, 3, 5), ("c", 9.0, 9, 9)],
                                  "customer_id string, total_revenue double, total_transactions int, days_since_last_purchase int")
    got = [tuple(r) for r in segments.segment_profile(seg, feats).collect()]
    assert got == [(1, 1, 9.0, 9.0, 9.0), (0, 2, 1.5, 2.0, 4.0)]


@pytest.mark.parametrize("few", [1_000_000, 300])
def test_ranks_are_exact_for_any_number_of_rows(spark, monkeypatch, few):
    """Read off at once, and through sketches: distinct values, repeats, NULLs, one value in most rows."""
    monkeypatch.setattr(ranks, "FEW_ROWS", few)
    n = 250_000
    df = spark.range(n).repartition(90).selectExpr("cast(id * 7919 % 250000 as int) as a", "cast(id % 10 as decimal(18,4)) as b", "if(id % 2 = 0, cast(id as bigint), null) as c", "cast(null as int) as d", "if(id < 1000, cast(id as int), 5) as e")
    got = one(values_at(df, ["a", "b", "c", "d", "e"], [share_rank("0.2"), share_rank("0.600001"), lambda rows: rows, lambda rows: F.lit(4)]))
    assert got["a"] == [49_999, 150_000, n - 1, 3]
    assert [int(x) for x in got["b"]] == [1, 6, 9, 0]
    assert got["c"] == [2 * 24_999, 2 * 75_000, n - 2, 6]
    assert got["d"] == []
    assert got["e"] == [5, 5, 999, 3]


@pytest.mark.parametrize(("n", "margin"), [(0, 0.02), (150, 0.02), (40, -0.2)])
def test_ranks_by_poor_sketches(spark, monkeypatch, n, margin):
    """Enclosing values that miss the rank only cost more passes."""
    monkeypatch.setattr(ranks, "FEW_ROWS", 10)
    monkeypatch.setattr(ranks, "MARGIN", margin)
    draw = random.Random(n)
    values = [draw.choice([None, draw.randint(-3, 3), draw.randint(-(10**9), 10**9)]) for _ in range(n)]
    places = [1, n // 2, n, 0]
    got = one(values_at(spark.createDataFrame([(v,) for v in values], "v long"), ["v"], [lambda _, p=p: F.lit(p) for p in places]))["v"]
    known = sorted(v for v in values if v is not None)
    assert got == [known[p - 1] for p in places if 1 <= p <= len(known)]


def test_hot_keys_of_many_partitions(spark):
    facts = spark.range(40_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as k").repartition(90)
    assert [r.k for r in hot_keys(facts, "k", share=0.01).collect()] == ["hot"]


def test_latest_value_per_key(spark):
    rows = [("a", 1, "x", 5), ("a", 3, "y", 1), ("a", None, "z", 9), ("b", 2, None, 4), ("b", 2, None, 7)]
    df = spark.createDataFrame(rows, "k string, at int, v string, w int")
    assert sorted(map(tuple, latest_value_per_key(df, ["k"], ["v", "w"], ["at"]).collect())) == [("a", "y", 1), ("b", None, 7)]
