"""The ledger: the set of source tables every product reads.

A `Ledger` is just named DataFrames.  Production code builds it from catalog
tables (`from_catalog`) or parquet folders (`from_parquet`); the test suite
and the benchmark build it from the driver's synthetic tables
(`revbridge.sources.tpch_binding`).
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "recognitions",
    "schedules",
    "items",
    "attachments",
    "return_items",
    "return_attachments",
    "rtp_items",
    "rtp_attachments",
    "rtp_orders",
    "swap_items",
    "swap_attachments",
    "penalty",
    "vas",
    "discounts",
    "acquisitions",
)


TS = "timestamp_ntz"
# Display columns of an entity's user, which the churn table carries
DISPLAY = (
    "bundle_id long, contact string, user_name string, email_id string, display_id string, is_migrated boolean, is_autopay_enabled boolean"
)
# Columns of a swap beside its id and entity (fixed names: the register passes them through)
SWAP_COLUMNS = {
    "rented_product_id": "long", "state": "string", "action": "string", "swap_id": "long", "swap_pair_id": "long",
    "swap_composite_item_id": "long", "pricing_details": "string", "payment_details": "string", "offers_snapshot": "string",
    "fulfillment_id": "long", "stock_commitment_id": "long", "fulfillment_date": TS, "selected_fulfillment_date": TS,
    "promise_date_details": "string", "created_at": TS, "updated_at": TS, "cancelled_at": TS, "cancelled_by": "string",
    "original_tenure_start_date": TS, "original_tenure_end_date": TS,
}
# Column layout of every ledger table (what production catalog tables carry)
SCHEMAS = {
    "recognitions": f"id long, accountable_entity_id long, accountable_entity_type string, recognition_type string, "
    f"state string, vertical string, start_date {TS}, end_date {TS}, recognised_at {TS}, created_at {TS}, "
    f"deleted_at {TS}, external_reference_type string, external_reference_id long, "
    f"revenue_recognition_schedule_id long, taxable_amount decimal(18,2), discounts string",
    "schedules": f"id long, start_date {TS}, end_date {TS}, taxable_amount decimal(18,2), post_tax_amount decimal(18,2)",
    "items": f"id long, user_id long, order_id long, state string, vertical string, activation_date {TS}, "
    f"pickup_date {TS}, composite_item_id long, name string, pricing_details string, {DISPLAY}",
    "attachments": f"id long, user_id long, order_id long, state string, vertical string, activation_date {TS}, "
    f"pickup_date {TS}, composite_item_id long, name string, pricing_details string, {DISPLAY}",
    "return_items": f"id long, item_id long, return_id long, state string, created_at {TS}, updated_at {TS}",
    "return_attachments": f"id long, attachment_id long, return_id long, state string, created_at {TS}, updated_at {TS}",
    "rtp_items": "id long, item_id long, rent_to_purchase_order_id long, payment_details string, payableafterpaymentoffers string",
    "rtp_attachments": "id long, attachment_id long, rent_to_purchase_order_id long, payment_details string, "
    "payableafterpaymentoffers string",
    "rtp_orders": f"id long, state string, created_at {TS}",
    "swap_items": "id long, item_id long, " + ", ".join(f"{c} {t}" for c, t in SWAP_COLUMNS.items()),
    "swap_attachments": "id long, attachment_id long, " + ", ".join(f"{c} {t}" for c, t in SWAP_COLUMNS.items()),
    "penalty": "id long, product_entity_id long, user_id long",
    "vas": "id long, entity_id long, entity_type string, type string, state string",
    "discounts": "id long, type string",
    "acquisitions": "accountable_entity_id long, accountable_entity_type string, fur_id string, "
    "taxable_amount decimal(18,2), activation_date date, flag string",
}


@dataclass
class Ledger:
    recognitions: DataFrame
    schedules: DataFrame
    items: DataFrame
    attachments: DataFrame
    return_items: DataFrame
    return_attachments: DataFrame
    rtp_items: DataFrame
    rtp_attachments: DataFrame
    rtp_orders: DataFrame
    swap_items: DataFrame
    swap_attachments: DataFrame
    penalty: DataFrame
    vas: DataFrame
    discounts: DataFrame
    acquisitions: DataFrame

    def close(self) -> None:
        """Nothing to release, unless the ledger was read from a copy of its own."""

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "") -> "Ledger":
        """Read every table as `{prefix}{name}` from the catalog."""
        return cls(**{f.name: spark.table(f"{prefix}{f.name}") for f in fields(cls)})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> "Ledger":
        """Read every table from `{root}/{name}` parquet folders."""
        return cls(**{f.name: spark.read.parquet(f"{root}/{f.name}") for f in fields(cls)})

    @classmethod
    def from_rows(cls, spark: SparkSession, **rows) -> "Ledger":
        """Small in-memory ledger (tests, examples): lists of tuples per table,
        missing tables are empty."""
        def frame(name: str) -> DataFrame:
            width = len(SCHEMAS[name].replace("decimal(18,2)", "decimal").split(","))
            padded = [tuple(r) + (None,) * (width - len(r)) for r in rows.get(name, [])]  # last columns may be left out
            return spark.createDataFrame(padded, SCHEMAS[name])

        return cls(**{name: frame(name) for name in TABLES})

    def write_parquet(self, root: str, mode: str = "overwrite") -> None:
        for f in fields(self):
            getattr(self, f.name).write.mode(mode).parquet(f"{root}/{f.name}")
