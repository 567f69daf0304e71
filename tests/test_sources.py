"""CSV binding, layered tables, staging, and the whole pipeline on CSV files."""

import subprocess
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tillview.operators import conform
from tillview.operators.catalog import feature_catalog
from tillview.plans.medallion import (
    Medallion,
    ingest_csv,
    run_csv_pipeline,
    train_models,
    write_feature_catalog,
)
from tillview.sources.commits import TableFolder, VersionMissing
from tillview.sources.csv import REJECTED, rejected_rows, scan_csv, scan_csv_inferred
from tillview.sources.orderbook import OrderBook
from tillview.sources.schemas import SOURCES
from tillview.sources.staging import DROP_SHUFFLES, shuffles_dropped, stage, staging_root
from tillview.sources.tables import NotOurTable, TableMissing, TableStore, layer_summary

LOADED = datetime(2024, 7, 1, 2, 3, 4)
AS_OF = date(2024, 6, 30)
# a header that differs from the declared columns in names, order and number
PRODUCTS = (
    "product_id,product_name,category,sub_category,brand,price,cost,stock_quantity,"
    "reorder_level,supplier,is_active,margin\r\n"
    "P1,Lamp,Home,Home_1,BrandA,10.50,4.20,7,54,Supplier2,True,60.0\r\n"
    "P2,Desk,Home,Home_2,BrandB,not a price,4.20,7,54,Supplier3,True,60.0\r\n"
    "P3,Sofa,Home,Home_2,BrandB,10,4\r\n"
)


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "products.csv").write_text(PRODUCTS, newline="")
    return folder


def test_csv_is_bound_by_name(spark, raw):
    rows = {r.product_id: r for r in scan_csv(spark, str(raw / "products.csv"), SOURCES["products"]).collect()}
    p1 = rows["P1"]
    assert (p1.subcategory, p1.price, p1.stock_quantity, p1.supplier_id) == ("Home_1", Decimal("10.5"), 7, "Supplier2")
    assert p1.launch_date is None and p1[REJECTED] == []
    assert rows["P2"].price is None and rows["P2"][REJECTED] == ["price"]
    assert rows["P3"].price == 10 and rows["P3"][REJECTED] == ["_corrupt_line"]


def test_inferred_scan(spark, raw):
    (raw / "x.csv").write_text("a,b\n1,2.5\n")
    assert dict(scan_csv_inferred(spark, str(raw / "x.csv")).dtypes) == {"a": "int", "b": "double"}


def test_files_with_other_headers_are_refused(spark, raw):
    folder = raw / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("product_id,price\nA,1\n")
    (folder / "b.csv").write_text("price,product_id\n1,B\n")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        scan_csv(spark, str(folder), SOURCES["products"]).collect()


def test_ingest_stamps_and_quarantine(spark, raw, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    bronze = ingest_csv(store, "products", str(raw / "products.csv"), LOADED)
    row = bronze.first()
    assert (row.ingestion_timestamp, row.source_file, row.bronze_load_date) == (LOADED, "products.csv", LOADED.date())
    assert bronze.count() == 3
    assert sorted(r.product_id for r in rejected_rows(bronze).collect()) == ["P2", "P3"]
    assert store.path("products_bronze").endswith("/bronze/products_bronze")


def test_store_paths_reads_and_overwrites(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    assert store.path("main.shop.x_silver") == store.path("x_silver")
    assert store.read("x_silver", optional=True) is None
    with pytest.raises(TableMissing):
        store.read("x_silver")
    with pytest.raises(ValueError):
        store.read("x_silver", prefer="luck")
    first = store.write(spark.range(3), "x_silver", LOADED)
    assert first.columns == ["id", "silver_load_timestamp"] and first.count() == 3
    again = store.write(spark.range(5).withColumn("extra", F.lit(1)), "x_silver", LOADED)
    assert again.count() == 5 and "extra" in again.columns
    assert store.status("x_silver") == "at path"


def test_partitioned_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    df = spark.range(1000).select("id", (F.col("id") % 4).cast("int").alias("m"))
    back = store.write(df, "x_gold", partition_by="m")
    assert back.count() == 1000
    (folder,) = (tmp_path / "lake" / "gold" / "x_gold").glob("data-*")
    assert sorted(p.name for p in folder.iterdir() if p.is_dir()) == [f"m={i}" for i in range(4)]
    assert all(len(list(p.glob("*.parquet"))) == 1 for p in folder.glob("m=*"))


def test_partitioned_write_without_a_shuffle(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    df = spark.range(1000, numPartitions=3).select("id", (F.col("id") % 4).cast("int").alias("m"))
    back = store.write(df, "x_gold", partition_by="m", rebalance=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    (folder,) = (tmp_path / "lake" / "gold" / "x_gold").glob("data-*")
    assert {len(list(p.glob("*.parquet"))) for p in folder.glob("m=*")} == {3}


def test_lines_are_shuffled_once_before_the_dimensions(spark, tmp_path):
    """Lines and orders meet, and copies of a line are told, in one shuffle of each; only a
    whole run writes the flagged lines down."""
    at, day = datetime(1996, 1, 1), datetime(1996, 2, 1)
    orders = [(k, 5, "F", at, "1-URGENT") for k in (1, 2)]
    lines = [(1, 7, 3, 1, 2.0, 10.0, 0.1, 0.0, "N", day), (1, 7, 3, 2, 2.0, 10.0, 0.1, 0.0, "R", at), (9, 7, 3, 1, 2.0, 10.0, 0.1, 0.0, "N", day), (None, 7, 3, 1, 2.0, 10.0, 0.1, 0.0, "N", day)]
    book = OrderBook(spark, str(tmp_path))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        flagged = conform.flag_transactions(book.transactions())
        plan = flagged._jdf.queryExecution().executedPlan().toString()
        found = {(r.transaction_id, r.product_id, r.customer_id, r.order_status) for r in flagged.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2
    assert found == {("1", "7", "5", "Completed"), ("9", "7", None, "Completed"), (None, "7", None, "Completed")}
    run = Medallion(TableStore(spark, f"{tmp_path}/lake"), AS_OF, {"transactions": book.transactions()}.__getitem__)
    assert run.table("transactions_quarantine_silver").count() == 2 and "_flagged" not in run._built


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    def kept():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().endswith(".data")}

    before, moved = kept(), spark.range(1000).repartition(5, "id")
    assert len(stage(moved, "moved").collect()) == 1000
    assert len(TableStore(spark, str(tmp_path)).write(moved, "moved_silver").collect()) == 1000
    for _ in range(100):  # files are deleted in the background
        if kept() <= before:
            break
        time.sleep(0.1)
    assert kept() <= before


def test_a_session_gets_its_shuffle_setting_back(spark):
    assert spark.conf.get(DROP_SHUFFLES, None) is None
    for own in ("false", None):
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark), shuffles_dropped(spark):
            if own:
                raise ZeroDivisionError
            assert spark.conf.get(DROP_SHUFFLES) == "true"
            1 / 0
        assert spark.conf.get(DROP_SHUFFLES, None) is None
    spark.conf.set(DROP_SHUFFLES, "false")
    with shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
    assert spark.conf.get(DROP_SHUFFLES) == "false"
    spark.conf.unset(DROP_SHUFFLES)


def test_lines_are_shortened_before_their_shuffle(spark, tmp_path):
    """The order's key travels once, as the text that is joined on; amounts as decimals."""
    day = datetime(1996, 2, 1)
    book = OrderBook(spark, str(tmp_path))
    spark.createDataFrame([(89, 5, "F", day, "1-URGENT"), (97, 5, "O", day, "2-HIGH")], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(89, 10, 3, 1, 2.0, 1000.0, 0.1, 0.05, "R", day), (97, 11, 3, 2, 1.0, 250.0, 0.0, 0.0, "A", day), (101, 12, 3, 2, 1.0, 250.0, 0.0, 0.0, "N", None), (None, 12, None, None, None, None, None, None, None, None)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    out = book.transactions()
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "l_orderkey" not in above and "l_extendedprice" not in above and "l_partkey" not in above
    got = {r.transaction_id: (r.customer_id, r.product_id, str(r.transaction_date), r.quantity, r.unit_price, r.total_amount, r.shipping_cost, r.order_status, r.store_id) for r in out.collect()}
    D = Decimal
    assert got == {
        "89": ("5", "10", "1994-12-28 17:00:00", 1, D("10.0000"), D("-9.0000"), D("0.0500"), "Returned", "3"),
        "97": (None, "11", "1995-09-04 01:00:00", 0, D("2.5000"), D("2.5000"), D("0.0000"), "Cancelled", "3"),
        "101": (None, None, "None", 0, D("2.5000"), D("2.5000"), D("0.0000"), "Completed", "3"),
        None: (None, None, "None", None, None, None, None, "Completed", None),
    }


def test_tables_are_written_with_zstd(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    assert store.write(spark.range(10), "x_gold").count() == 10
    assert {p.name.split(".", 1)[1] for p in (tmp_path / "lake").rglob("part-*")} == {"zstd.parquet"}


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    store.write(spark.range(100), "x_gold")
    broken = store.read("x_gold").repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("half-way"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        store.write(broken, "x_gold")
    assert store.read("x_gold").count() == 100
    assert store.folder("x_gold").numbers() == [1]
    # what the failed write left goes when it is old enough
    folder = tmp_path / "lake" / "gold" / "x_gold"
    left = [p.name for p in folder.glob("data-*") if p.name != store.folder("x_gold").version().folder]
    assert store.folder("x_gold").sweep(2) == []
    assert sorted(store.folder("x_gold").sweep(2, orphan_hours=-1)) == sorted(left)
    assert store.read("x_gold").count() == 100 and len(list(folder.glob("data-*"))) == 1


def test_versions_are_pinned_and_swept(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"), keep=2)
    first = store.write(spark.range(1), "x_gold")
    second = store.write(store.read("x_gold").union(spark.range(9)), "x_gold")  # from itself
    assert (first.count(), second.count()) == (1, 10)
    store.write(second.withColumn("extra", F.lit("e")), "x_gold")
    assert store.folder("x_gold").numbers() == [2, 3]
    assert second.count() == 10 and store.read("x_gold", version=2).columns == ["id"]
    assert store.read("x_gold").columns == ["id", "extra"]
    with pytest.raises(VersionMissing):
        store.read("x_gold", version=1)
    assert len(list((tmp_path / "lake" / "gold" / "x_gold").glob("data-*"))) == 2


def test_two_writers_take_two_numbers(spark, tmp_path):
    """The second finds the number taken after it has looked."""
    path = str(tmp_path / "x")
    one, other = TableFolder(spark, path), TableFolder(spark, path)
    schema = spark.range(1).schema
    one.commit("data-a", schema)
    other.numbers = lambda: []
    assert other.commit("data-b", schema).number == 2
    del other.numbers
    assert [other.version(n).folder for n in other.numbers()] == ["data-a", "data-b"]
    assert not [p for p in (tmp_path / "x" / "_commits").iterdir() if not p.name.strip(".").startswith("0")]


def test_empty_tables_and_plain_folders_are_read(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    none = spark.range(3).withColumn("m", F.lit(1)).limit(0)
    assert store.write(none, "none_gold", partition_by="m").columns == ["id", "m"]
    assert store.read("none_gold").count() == 0
    spark.range(4).write.parquet(store.path("plain_gold"))
    assert store.read("plain_gold").count() == 4


def test_the_catalog_follows_the_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"), database="follow_test")
    columns = lambda: [(c.name, c.dataType) for c in spark.catalog.listColumns("follow_test.a_gold")]
    store.write(spark.range(3).select(F.col("id").alias("a")), "a_gold")
    assert columns() == [("a", "bigint")]
    store.write(spark.range(3).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b")), "a_gold")
    assert columns() == [("a", "int"), ("b", "string")]
    assert store.read("a_gold", prefer="catalog").columns == ["a", "b"]
    for months in (1, 3):
        store.write(spark.range(6).select("id", (F.col("id") % months).cast("int").alias("m")), "a_gold", partition_by="m")
        found = store.read("a_gold", prefer="catalog")
        assert found.count() == 6 and found.select("m").distinct().count() == months
    store.write(spark.range(2), "a_gold")
    assert columns() == [("id", "bigint")] and store.read("a_gold", prefer="catalog").count() == 2
    spark.range(9).write.saveAsTable("follow_test.mine_gold")
    with pytest.raises(NotOurTable):
        store.write(spark.range(2), "mine_gold")
    assert spark.table("follow_test.mine_gold").count() == 9
    spark.sql("DROP DATABASE follow_test CASCADE")


def test_registration_and_summary(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"), database="shop_test")
    store.write(spark.range(7).withColumn("m", F.lit(1)), "a_gold", LOADED, partition_by=["m"])
    store.write(spark.range(2), "b_gold", LOADED)
    assert store.status("a_gold") == "registered"
    assert store.read("a_gold", prefer="catalog").count() == 7
    store.write(spark.range(4), "b_gold", LOADED)
    assert store.read("b_gold", prefer="catalog").count() == 4
    rows = {r.table_name: r for r in layer_summary(store, ["a_gold", "b_gold", "c_gold"]).collect()}
    assert (rows["a_gold"].records, rows["a_gold"].columns, rows["a_gold"].status) == (7, 3, "registered")
    assert rows["b_gold"].records == 4
    assert (rows["c_gold"].records, rows["c_gold"].status) == (None, "missing")
    assert layer_summary(store, ["c_gold"]).first().records is None
    spark.sql("DROP DATABASE shop_test CASCADE")


def test_managed_catalog_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "lake"))
    table = write_feature_catalog(store, LOADED)
    assert table.count() == 19 and "gold_load_timestamp" in table.columns
    assert feature_catalog(spark).select("source_table").distinct().count() == 5
    assert write_feature_catalog(store, LOADED).count() == 19
    spark.sql("DROP TABLE ml_feature_catalog")


def test_staging_uses_the_sessions_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert staging_root(spark) in staged.inputFiles()[0]


def test_undeclared_columns_are_kept(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,margin,price\nP1,12.5,3\nP2,,x\n")
    rows = scan_csv(spark, str(tmp_path / "products.csv"), SOURCES["products"]).orderBy("product_id").collect()
    assert [r.undeclared_fields for r in rows] == ['{"margin":"12.5"}', "{}"]
    assert rows[1].rejected_fields == ["price"]


def test_staged_tables_can_be_dropped(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pathlib import Path
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
from tillview.sources.staging import drop_staged, stage
assert stage(spark.range(5), "five").count() == 5
assert list(Path({str(tmp_path)!r}).rglob("*.parquet"))
drop_staged(spark)
assert not list(Path({str(tmp_path)!r}).rglob("*.parquet"))
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


# -- the whole pipeline -----------------------------------------------------
@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Seven CSV files for 120 customers, run through every layer."""
    raw = tmp_path_factory.mktemp("raw")

    def write(name, header, rows):
        text = "\n".join([header, *(",".join("" if v is None else str(v) for v in r) for r in rows)])
        (raw / f"{name}.csv").write_text(text + "\n")

    n = 120
    write("customers", "customer_id,first_name,last_name,email,phone,date_of_birth,gender,city,state,zip_code,registration_date,customer_segment,acquisition_channel",
          [(f"C{i}", f"ann{i}", "lee", None if i % 9 == 0 else f"a{i}@x.example", "555-01", "1980-02-03", "f", "rome", "ca", "1", "2023-01-01", "Premium" if i % 2 else "Basic", "Web") for i in range(n)])
    (raw / "products.csv").write_text(PRODUCTS, newline="")
    write("transactions", "transaction_id,customer_id,product_id,transaction_date,quantity,unit_price,discount_percent,total_amount,payment_method,channel,store_id,shipping_cost,order_status",
          [(f"T{i}-{j}", f"C{i}", f"P{1 + j % 3}", f"2024-0{1 + (i + j) % 6}-{1 + (i * 7 + j) % 28:02d} 10:00:00", 1 + j % 3, 10, 5, 10.5 + i, "PayPal", "Online", "S1", 0, "Returned" if (i + j) % 5 == 0 else "Completed")
           for i in range(5, n) for j in range(1 + i % 7)])
    write("crm_interactions", "interaction_id,customer_id,interaction_date,interaction_type,reason,resolution_status,agent_id,duration_minutes,satisfaction_score,notes",
          [(f"I{i}", f"C{i}", "2024-05-01 09:00:00", "Complaint", "r", "Pending", "A1", i % 40, 1 + i % 5, "n") for i in range(0, n, 2)])
    write("loyalty_events", "event_id,customer_id,event_date,event_type,points_change,points_balance,tier,description",
          [(f"E{i}", f"C{i}", "2024-05-01 09:00:00", "purchase", i - 60, i, "Gold" if i % 2 else "Platinum", "d") for i in range(0, n, 3)])
    write("web_analytics", "session_id,customer_id,session_date,device_type,browser,page_views,session_duration_seconds,bounce,conversion,utm_source,utm_campaign,landing_page,exit_page",
          [(f"W{i}", f"C{i}" if i % 4 else None, "2024-05-01 09:00:00", "Mobile", "b", i % 6, i * 10, i % 2 == 0, i % 3 == 0, "u", "c", "l", "e") for i in range(n)])
    write("support_tickets", "ticket_id,customer_id,created_date,category,priority,status,assigned_agent,resolved_date,resolution_time_hours,customer_satisfaction",
          [(f"K{i}", f"C{i}", "2024-05-01 09:00:00", "c", "High" if i % 2 else "Low", "Open", "A", None, i if i % 5 else None, 1 + i % 5) for i in range(n)])
    root = tmp_path_factory.mktemp("lake")
    tables = run_csv_pipeline(spark, str(raw), str(root), AS_OF, LOADED)
    return tables, TableStore(spark, str(root)), n


EXPECTED = [
    "customers_silver", "products_silver", "transactions_silver", "transactions_quarantine_silver", "crm_interactions_silver", "loyalty_events_silver",
    "web_analytics_silver", "support_tickets_silver", "customer360_silver", "customer_rfm_gold", "customer_features_gold",
    "sales_base_gold", "sales_levels_gold", "sales_aggregated_gold", "product_performance_gold", "customer_clv_features_gold", "customer_segments_gold",
    "revenue_forecast_gold", "revenue_forecast_skipped_gold", "customer_anomalies_gold",
]


def test_every_table_is_written(lake):
    tables, store, _ = lake
    assert list(tables) == EXPECTED
    assert all(store.status(name) == "at path" for name in EXPECTED)


def test_customer_tables_keep_every_customer(lake):
    tables, _, n = lake
    for name in ("customer360_silver", "customer_features_gold", "customer_segments_gold", "customer_anomalies_gold"):
        df = tables[name]
        assert (df.count(), df.select("customer_id").distinct().count()) == (n, n), name
    assert tables["customer_rfm_gold"].count() == n - 5
    assert tables["customer_features_gold"].count() == n


def test_output_columns(lake):
    tables, _, _ = lake
    widths = {name: len(df.columns) for name, df in tables.items()}
    assert widths["customer_features_gold"] == 65
    assert widths["sales_aggregated_gold"] == 16
    assert widths["product_performance_gold"] == 23
    assert widths["customer_clv_features_gold"] == 17
    assert tables["customer_segments_gold"].columns == [
        "customer_id", "cluster", "total_transactions", "total_revenue", "days_since_last_purchase",
        "distinct_categories_purchased", "avg_transaction_value", "return_rate", "current_loyalty_points",
        "web_conversion_rate", "segment_name", "gold_load_timestamp"]
    assert tables["customer_anomalies_gold"].columns == ["customer_id", "is_anomaly", "anomaly_score", "detection_timestamp", "gold_load_timestamp"]


def test_totals_survive_the_layers(lake):
    tables, _, _ = lake
    total = lambda name, column: tables[name].agg(F.sum(column)).first()[0]
    revenue = total("transactions_silver", "revenue")
    assert revenue == total("customer360_silver", "total_revenue") == total("sales_aggregated_gold", "total_revenue")
    assert revenue == total("customer_rfm_gold", "monetary_value") == total("product_performance_gold", "total_revenue")
    assert tables["customer_segments_gold"].groupBy("segment_name").count().agg(F.sum("count")).first()[0] == 120


def test_models_are_saved_and_load(spark, lake, tmp_path, monkeypatch):
    from pyspark.ml import PipelineModel
    from tillview.operators import models

    monkeypatch.setitem(models.BOOSTED, "maxIter", 2)

    tables, store, _ = lake
    medallion = Medallion(store, AS_OF, lambda name: store.read(f"{name}_bronze"), LOADED, _built=dict(tables))
    paths = train_models(medallion, str(tmp_path / "artifacts"))
    written = {(r.model, r.metric) for r in store.read("model_metrics_gold").collect()}
    assert written == {(m, x) for m in ("churn_lr", "churn_gbt") for x in ("auc_roc", "auc_pr", "accuracy", "f1")} | {("clv_lr", x) for x in ("rmse", "mae", "r2")}
    assert 0 < store.read("feature_importance_gold").count() <= 10
    model = PipelineModel.load(paths["clv_lr"])
    data = models.clv_training_set(tables["customer_clv_features_gold"], tables["customer_features_gold"])
    metrics = models.regression_metrics(models.clv_predictions(model, data)).first()
    assert metrics.r2 > 0.5 and metrics.rmse >= metrics.mae > 0
