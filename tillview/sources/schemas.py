"""Declared columns of the seven sources.

Fixed values: names and order are the file contract. Money is decimal so that
sums are exact and independent of partition order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from tillview.functions.measures import MONEY


@dataclass(frozen=True)
class Source:
    name: str
    file: str
    key: tuple[str, ...]
    ddl: str
    # header spellings accepted for a declared column, besides its own name
    also_known_as: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def bronze(self) -> str:
        return f"{self.name}_bronze"

    @property
    def silver(self) -> str:
        return f"{self.name}_silver"


SOURCES = {
    s.name: s
    for s in (
        Source(
            "customers",
            "customers.csv",
            ("customer_id",),
            "customer_id string, first_name string, last_name string, email string, "
            "phone string, date_of_birth date, gender string, city string, state string, "
            "zip_code string, registration_date date, customer_segment string, "
            "acquisition_channel string",
        ),
        Source(
            "products",
            "products.csv",
            ("product_id",),
            "product_id string, product_name string, category string, subcategory string, "
            f"brand string, price {MONEY}, cost {MONEY}, stock_quantity int, "
            "supplier_id string, launch_date date",
            (("sub_category", "subcategory"), ("supplier", "supplier_id")),
        ),
        Source(
            "transactions",
            "transactions.csv",
            ("transaction_id", "product_id"),
            "transaction_id string, customer_id string, product_id string, "
            f"transaction_date timestamp, quantity int, unit_price {MONEY}, "
            f"discount_percent decimal(9,4), total_amount {MONEY}, payment_method string, "
            f"channel string, store_id string, shipping_cost {MONEY}, order_status string",
        ),
        Source(
            "crm_interactions",
            "crm_interactions.csv",
            ("interaction_id",),
            "interaction_id string, customer_id string, interaction_date timestamp, "
            "interaction_type string, reason string, resolution_status string, "
            "agent_id string, duration_minutes int, satisfaction_score int, notes string",
        ),
        Source(
            "loyalty_events",
            "loyalty_events.csv",
            ("event_id",),
            "event_id string, customer_id string, event_date timestamp, event_type string, "
            "points_change int, points_balance int, tier string, description string",
        ),
        Source(
            "web_analytics",
            "web_analytics.csv",
            ("session_id",),
            "session_id string, customer_id string, session_date timestamp, "
            "device_type string, browser string, page_views int, "
            "session_duration_seconds int, bounce boolean, conversion boolean, "
            "utm_source string, utm_campaign string, landing_page string, exit_page string",
        ),
        Source(
            "support_tickets",
            "support_tickets.csv",
            ("ticket_id",),
            "ticket_id string, customer_id string, created_date timestamp, category string, "
            "priority string, status string, assigned_agent string, resolved_date timestamp, "
            "resolution_time_hours int, customer_satisfaction int",
        ),
    )
}
