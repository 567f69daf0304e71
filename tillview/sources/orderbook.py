"""The seven retail sources derived from an order-book schema.

Maps the tables ``customer nation part lineitem orders events`` (one Parquet
table each under a folder) to ingested bronze tables, so that the operators can
be run and checked on them. Every column is a function of one row, or of one
row and its order or nation; no rows are dropped. ``README.md`` lists the
mapping.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillview.functions.measures import MONEY
from tillview.sources.schemas import SOURCES

AS_OF = date(2001, 8, 1)
LOADED_AT = "2001-08-01 06:00:00"
# Events are recorded in January 2024; moved so that they end with the orders.
EVENT_SHIFT_DAYS = 8218


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _loaded() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def _pick(key: str, *values: str) -> Column:
    """values[key mod n]"""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int")
    )


@dataclass(frozen=True)
class OrderBook:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")

    # -- bronze -----------------------------------------------------------
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                _text("c_custkey").alias("customer_id"),
                F.concat(F.lit(" "), F.lower(F.split_part("c_name", F.lit("#"), F.lit(1)))).alias(
                    "first_name"
                ),
                F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
                F.when(
                    F.col("c_acctbal") >= 0,
                    F.concat(F.lit(" "), F.upper(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@Shop.example ")),
                ).alias("email"),
                F.when(
                    F.col("c_acctbal") < 9000,
                    F.concat(F.lit("+"), _text("c_nationkey"), F.lit(" (555) "), _text("c_custkey")),
                ).alias("phone"),
                F.date_add(F.lit(date(1895, 1, 1)), (key * 97 % 36000).cast("int")).alias(
                    "date_of_birth"
                ),
                _pick("c_custkey", "f", "m").alias("gender"),
                F.lower("n_name").alias("city"),
                F.concat(F.lower("n_name"), F.lit(" ")).alias("state"),
                F.lpad((key % 100000).cast("string"), 5, "0").alias("zip_code"),
                F.date_add(F.lit(date(1993, 1, 1)), (key * 13 % 2500).cast("int")).alias(
                    "registration_date"
                ),
                F.col("c_mktsegment").alias("customer_segment"),
                _pick("c_nationkey", "Organic", "Paid", "Referral").alias("acquisition_channel"),
                _loaded().alias("ingestion_timestamp"),
            )
        )

    def products(self) -> DataFrame:
        size = F.col("p_size")
        price = F.when(size == 49, F.lit(0)).otherwise(F.col("p_retailprice").cast(MONEY)).cast(MONEY)
        factor = F.when(size == 50, F.lit(1.2)).otherwise(F.lit(0.65)).cast("decimal(3,2)")
        listed = F.col("p_retailprice").cast("decimal(12,2)")
        return self.table("part").select(
            _text("p_partkey").alias("product_id"),
            F.concat(F.lit(" "), F.col("p_name")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat(F.col("p_type"), F.lit("_sub")).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            price.alias("price"),
            F.when(size == 48, F.lit(0)).otherwise(listed * factor).cast(MONEY).alias("cost"),
            ((size - 1) * 2).alias("stock_quantity"),
            F.concat(F.lit("S"), (F.col("p_partkey") % 10).cast("string")).alias("supplier_id"),
            F.date_add(F.lit(date(1990, 1, 1)), (F.col("p_partkey") % 3000).cast("int")).alias(
                "launch_date"
            ),
            _loaded().alias("ingestion_timestamp"),
        )

    def transactions(self) -> DataFrame:
        """One row per order line; the order's hour comes from its key. Some lines have
        no customer or product or a negative amount, and two tenths of the products
        were last sold earlier."""
        tenth = F.col("l_partkey") % 10
        # what a line needs, as short as it gets, before the shuffle
        sold = self.table("lineitem").select(
            _text("l_orderkey").alias("transaction_id"),
            (F.col("l_orderkey") % 97 != 0).alias("has_customer"),
            F.when((F.col("l_orderkey") % 101 != 0) | (F.col("l_linenumber") != 2), F.col("l_partkey")).alias("part"),
            F.when(tenth == 0, F.lit(400)).when(tenth == 1, F.lit(150)).otherwise(F.lit(0)).alias("days_early"),
            F.col("l_quantity").cast("int").alias("pieces"),
            (F.col("l_extendedprice").cast("decimal(14,2)") * F.lit(0.01).cast("decimal(3,2)")).cast(MONEY).alias("unit"),
            F.col("l_discount").cast("decimal(4,2)").alias("share"),
            ((F.col("l_orderkey") % 89 == 0) & (F.col("l_linenumber") == 1)).alias("refunded"),
            "l_suppkey",
            F.col("l_tax").cast("decimal(4,2)").alias("tax"),
            "l_returnflag",
            "l_shipdate",
        )
        unit, share = F.col("unit"), F.col("share")
        hours = F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
        status = F.when(F.col("l_returnflag") == "R", "Returned").when(
            F.col("l_returnflag") == "A", "Cancelled"
        )
        channel = F.when(F.col("o_orderstatus") == "F", "Online").when(
            F.col("o_orderstatus") == "O", "Store"
        )
        payment = F.when(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"), "Credit Card").when(
            F.col("o_orderpriority") == "2-HIGH", "PayPal"
        )
        one = F.lit(1).cast("decimal(4,2)")
        sign = F.when(F.col("refunded"), F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")
        early = F.make_dt_interval("days_early")
        # joined on the text that the lines are deduplicated by: one shuffle serves both
        ordered = self.table("orders").withColumn("order_id", _text("o_orderkey"))
        return (
            sold.join(ordered, F.col("transaction_id") == F.col("order_id"), "left")
            .select(
                "transaction_id",
                F.when(F.col("has_customer"), _text("o_custkey")).alias("customer_id"),
                _text("part").alias("product_id"),
                (F.col("o_orderdate") + hours - early).alias("transaction_date"),
                (F.col("pieces") - 1).alias("quantity"),
                unit.alias("unit_price"),
                (share * F.lit(100)).cast("decimal(9,4)").alias("discount_percent"),
                (unit * (one - share) * sign).cast(MONEY).alias("total_amount"),
                payment.otherwise("Debit Card").alias("payment_method"),
                channel.otherwise("Mobile App").alias("channel"),
                _text("l_suppkey").alias("store_id"),
                F.col("tax").cast(MONEY).alias("shipping_cost"),
                status.otherwise("Completed").alias("order_status"),
                F.col("l_shipdate").alias("ingestion_timestamp"),
            )
        )

    def tickets(self) -> DataFrame:
        """One support ticket per order; open orders have no resolution."""
        key = F.col("o_orderkey")
        hours = F.when(F.col("o_orderstatus") != "O", (key * 7 % 120).cast("int"))
        return self.table("orders").select(
            _text("o_orderkey").alias("ticket_id"),
            _text("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("created_date"),
            F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("category"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "High")
            .otherwise("Normal")
            .alias("priority"),
            F.when(F.col("o_orderstatus") == "O", "Open").otherwise("Closed").alias("status"),
            _pick("o_orderkey", "ana", "ben", "cho").alias("assigned_agent"),
            (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)).alias("resolved_date"),
            hours.alias("resolution_time_hours"),
            (key % 5 + 1).cast("int").alias("customer_satisfaction"),
            _loaded().alias("ingestion_timestamp"),
        )

    def _events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            _text("user_id").alias("customer_id"),
            "user_id",
            (F.col("ts") - F.make_dt_interval(F.lit(EVENT_SHIFT_DAYS))).alias("at"),
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
            F.floor("value").cast("int").alias("whole"),
            _loaded().alias("ingestion_timestamp"),
        )

    def crm(self) -> DataFrame:
        return self._events().select(
            _text("event_id").alias("interaction_id"),
            "customer_id",
            F.col("at").alias("interaction_date"),
            F.when(F.col("event_type") == "error", "Complaint").otherwise("Inquiry").alias(
                "interaction_type"
            ),
            F.col("event_type").alias("reason"),
            _pick("event_id", "Resolved", "Pending", "Closed", "Escalated").alias("resolution_status"),
            _pick("k", "ana", "ben", "cho").alias("agent_id"),
            (F.col("whole") % 45).alias("duration_minutes"),
            (F.col("event_id") % 5 + 1).cast("int").alias("satisfaction_score"),
            F.concat(F.lit("k="), _text("k")).alias("notes"),
            "ingestion_timestamp",
        )

    def loyalty(self) -> DataFrame:
        change = F.when(F.col("event_type") == "purchase", F.col("whole")).when(
            F.col("event_type") == "error", -F.col("whole")
        )
        return self._events().select(
            _text("event_id").alias("event_id"),
            "customer_id",
            F.col("at").alias("event_date"),
            "event_type",
            change.otherwise(0).alias("points_change"),
            (F.col("k") * 20).alias("points_balance"),
            _pick("user_id", "Gold", "Silver", "Bronze", "Platinum").alias("tier"),
            F.concat(F.lit("k="), _text("k")).alias("description"),
            "ingestion_timestamp",
        )

    def web(self) -> DataFrame:
        """Sessions; before sign-up the customer is unknown."""
        return self._events().select(
            _text("event_id").alias("session_id"),
            F.when(F.col("event_type") != "signup", F.col("customer_id")).alias("customer_id"),
            F.col("at").alias("session_date"),
            _pick("event_id", "Mobile", "Desktop", "Tablet").alias("device_type"),
            _pick("k", "Firefox", "Chrome").alias("browser"),
            (F.col("k") % 12).alias("page_views"),
            F.floor(F.col("value") * 3).cast("int").alias("session_duration_seconds"),
            (F.col("event_type") == "error").alias("bounce"),
            (F.col("event_type") == "purchase").alias("conversion"),
            _pick("k", "mail", "search", "direct").alias("utm_source"),
            _pick("user_id", "spring", "fall").alias("utm_campaign"),
            F.lit("/home").alias("landing_page"),
            F.concat(F.lit("/"), F.col("event_type")).alias("exit_page"),
            "ingestion_timestamp",
        )

    def key_tables(self) -> dict[str, DataFrame]:
        """Stored tables that hold the join keys of the lines."""
        return {
            "customer_id": self.table("orders").select(_text("o_custkey").alias("customer_id")),
            "product_id": self.table("lineitem").select(_text("l_partkey").alias("product_id")),
        }

    def bronze(self) -> dict[str, DataFrame]:
        """All seven ingested tables by source name."""
        made = (
            self.customers(),
            self.products(),
            self.transactions(),
            self.crm(),
            self.loyalty(),
            self.web(),
            self.tickets(),
        )
        return dict(zip(SOURCES, made, strict=True))
