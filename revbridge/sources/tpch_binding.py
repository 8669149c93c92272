"""Bind the ledger onto the driver's TPC-H-style tables.

The rules (which order becomes which item, when a return happens, ...) are the
fixture contract written down in FIXTURES.md section 3; the DuckDB oracle in
`revbridge.checks.oracle_sql` derives the same ledger independently in SQL.

Everything here is per-row arithmetic plus one group-by (orders -> entities)
and one join (lineitem -> orders), so the binding scales with the inputs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revbridge.functions import ist_date, money
from revbridge.policy import Policy
from revbridge.session import RunFolder
from revbridge.sources.ledger import SWAP_COLUMNS, Ledger

# Fixed values of the binding (FIXTURES.md section 3)
SCHEDULE_DAYS = [30, 61, 91, 183, 274, 365]  # by o_orderkey % 6
VAS_TYPES = [  # by l_orderkey % 5
    "BRAND_CARE_PROGRAM",
    "FLEXI_CANCELLATION",
    "DELIVERY_CHARGE",
    "AC_INSTALLATION_CHARGE",
    "OTHER",
]
CATALOG_TYPES = ["UPFRONT", "LOYALTY", "COUPON"]  # by p_size % 3


def _days(ts, n) -> F.Column:
    return ts + F.make_dt_interval(days=n.cast("int"))


def _minutes(ts, n) -> F.Column:
    return ts + F.make_dt_interval(mins=n.cast("int"))


def _entity_type(k) -> F.Column:
    return F.when(k == 2, F.lit("ATTACHMENT")).otherwise(F.lit("ITEM"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture_policy(**knobs) -> Policy:
    """The run parameters of the fixture (FIXTURES.md section 3), with other knobs."""
    fixed = {"months": (dt.date(1997, 1, 1), dt.date(1997, 2, 1)), "as_of": dt.date(2002, 1, 1)}
    return Policy(**(fixed | knobs))


def table_times(spark: SparkSession, sf_dir: str) -> tuple[int, ...]:
    """Modification times of the tables that the binding reads."""
    out = []
    for name in ("orders", "lineitem", "part"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        out.append(path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime())
    return tuple(out)


def bind(spark: SparkSession, sf_dir: str, policy: Policy, cache: bool = True) -> Ledger:
    """Derive the ledger tables.  With `cache` every table is written once, so
    downstream plans see them as leaves (as they would see catalog tables)
    instead of re-deriving the binding in every branch."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"
    )
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")

    # ---- entities: one per (customer, order key mod 3) ----------------------
    k = F.col("o_orderkey") % 3
    ent = (
        orders.withColumn("k", k)
        .groupBy("o_custkey", "k")
        .agg(F.min("o_orderdate").alias("first_at"), F.min("o_orderkey").alias("order_id"))
    )
    h = F.col("o_custkey") + F.col("k")
    ent = ent.select(
        (F.col("o_custkey") * 10 + F.col("k") % 2).alias("id"),  # an attachment shares the id of an item
        _entity_type(F.col("k")).alias("entity_type"),
        F.col("o_custkey").alias("user_id"),
        "order_id",
        _minutes(F.col("first_at"), ((F.col("o_custkey") * 7 + F.col("k")) * 101) % 1440).alias(
            "activation_date"
        ),
        (F.col("o_custkey") * 10 + F.col("k") % 2).alias("composite_item_id"),
        F.when(h % 41 == 0, "CANCELLED").otherwise("ACTIVE").alias("state"),
        h.alias("h"),
        F.when(F.col("k") == 2, 1).otherwise(0).alias("att"),
    )

    folder = RunFolder(spark) if cache else None
    if cache:  # ten tables derive from the entities: grouped once
        ent.write.parquet(folder.next_path("entities"))
        ent = spark.read.parquet(f"{folder.path}/001-entities")

    # ---- returns: some entities have a second live one (n = 1) ----------------
    h, n = F.col("h"), F.col("n")
    twice = ent.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    row_id = F.col("id") * 4 + F.col("att") * 2 + n
    returns = twice.filter((h % 5 == 1) & ((n == 0) | (h % 15 == 1))).select(
        "id", "entity_type", row_id.alias("row_id"),
        (F.col("user_id") * 2 + n).alias("return_id"),
        F.when((h % 35 == 1) & (n == 0), "CANCELLED").otherwise("COMPLETED").alias("state"),
        _minutes(_days(F.col("activation_date"), (h * 37) % 1500 + 30 + n * 45), (h * 53) % 1440).alias(
            "created_at"
        ),
    ).withColumn("updated_at", _days(F.col("created_at"), F.lit(1)))
    pickups = returns.filter(F.col("state") == "COMPLETED").groupBy("id", "entity_type").agg(
        _days(F.max("created_at"), F.lit(3)).alias("pickup_date")
    )

    # ---- buy-outs (rent to purchase): second lines, some on cancelled orders ---
    buyouts = twice.filter(((h % 5 == 2) | (h % 55 == 1)) & ((n == 0) | (h % 10 == 2))).select(
        "id", "entity_type", row_id.alias("row_id"),
        F.when((h % 4 == 0) & (n == 0), F.lit('{"status":"PENDING"}'))
        .otherwise(F.lit('{"status":"PAID"}'))
        .alias("payment_details"),
        F.concat(F.lit('{"byCashPreTax":"'), ((h * 97) % 50000 + 100).cast("string"), F.lit('"}')).alias(
            "payableafterpaymentoffers"
        ),
        F.when((n == 1) & (h % 20 == 2), "CANCELLED").otherwise("CONFIRMED").alias("order_state"),
        _days(F.col("activation_date"), (h * 31) % 1500 + 30 + n * 60).alias("created_at"),
    )

    # ---- swaps --------------------------------------------------------------
    day = _days(F.col("activation_date"), (h * 29) % 1500 + 15)
    swaps = ent.filter(h % 5 >= 3).select(
        "id", "entity_type", F.col("id").alias("row_id"),
        (F.col("id") + 7).alias("rented_product_id"),
        F.when(h % 21 == 3, "PENDING").otherwise("FULFILLED").alias("state"),
        F.when(h % 2 == 0, "SWAP_OUT").otherwise("SWAP_IN").alias("action"),
        (F.col("id") * 3).alias("swap_id"), (F.col("id") * 3 + 1).alias("swap_pair_id"),
        F.col("composite_item_id").alias("swap_composite_item_id"),
        F.concat(F.lit('{"basePrice":'), (F.col("id") % 997 + 100).cast("string"), F.lit("}")).alias("pricing_details"),
        F.lit(None).cast("string").alias("payment_details"), F.lit("[]").alias("offers_snapshot"),
        (F.col("id") + 11).alias("fulfillment_id"), (F.col("id") + 13).alias("stock_commitment_id"),
        day.alias("fulfillment_date"), _days(day, F.lit(-1)).alias("selected_fulfillment_date"),
        F.lit(None).cast("string").alias("promise_date_details"),
        F.col("activation_date").alias("created_at"), day.alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("cancelled_at"), F.lit(None).cast("string").alias("cancelled_by"),
        F.col("activation_date").alias("original_tenure_start_date"),
        _days(F.col("activation_date"), F.lit(365)).alias("original_tenure_end_date"),
    )

    # ---- items / attachments --------------------------------------------------
    ent_full = ent.join(pickups, ["id", "entity_type"], "left")

    def entity_table(kind: str) -> DataFrame:
        return ent_full.filter(F.col("entity_type") == kind).select(
            "id", "user_id", "order_id", "state",
            F.lit(policy.vertical).alias("vertical"),
            "activation_date", "pickup_date", "composite_item_id",
            F.concat(F.lit(kind.lower() + "-"), F.col("id").cast("string")).alias("name"),
            F.concat(F.lit('{"basePrice":'), (F.col("id") % 997 + 100).cast("string"), F.lit("}")).alias(
                "pricing_details"
            ),
            F.col("order_id").alias("bundle_id"),
            F.concat(F.lit("tel-"), F.col("user_id").cast("string")).alias("contact"),
            F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("user_name"),
            F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.org")).alias("email_id"),
            F.concat(F.lit("CX-"), F.col("user_id").cast("string")).alias("display_id"),
            (F.col("id") % 2 == 0).alias("is_migrated"),
            (F.col("id") % 3 == 0).alias("is_autopay_enabled"),
        )

    def by_type(df: DataFrame, kind: str, id_col: str, cols: list) -> DataFrame:
        return df.filter(F.col("entity_type") == kind).select(
            F.col("row_id").alias("id"), F.col("id").alias(id_col), *cols
        )

    ret_cols = ["return_id", "state", "created_at", "updated_at"]
    rtp_cols = [F.col("row_id").alias("rent_to_purchase_order_id"), "payment_details", "payableafterpaymentoffers"]
    swap_cols = list(SWAP_COLUMNS)

    # ---- recognition cycles -------------------------------------------------
    lo = lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
    ln = F.col("l_linenumber")
    lk = F.col("l_orderkey") % 3
    e = F.col("o_custkey") * 10 + lk % 2
    start = F.date_trunc("DAY", F.col("l_shipdate"))
    lines = F.filter(
        F.array(
            F.struct(
                F.round(F.col("l_discount") * 1000, 2).alias("amount"),
                F.col("l_partkey").cast("string").alias("catalogReferenceId"),
            ),
            F.struct(
                F.round(F.col("l_tax") * 1000, 2).alias("amount"),
                (F.col("l_partkey") + 1).cast("string").alias("catalogReferenceId"),
            ),
        ),
        lambda d: d["amount"] != 0,
    )
    one_object = (F.col("l_partkey") % 89 == 0) & (F.col("l_discount") != 0)
    discounts_text = (
        F.when(F.col("l_partkey") % 97 == 0, F.lit("no discounts"))  # not JSON
        .when(one_object, F.to_json(F.element_at(lines, 1)))
        .when(F.size(lines) > 0, F.to_json(lines))
    )
    recognitions = lo.select(
        (F.col("l_orderkey") * 10 + ln).alias("id"),
        F.when(ln.isin(6, 7), F.col("l_orderkey") * 10 + ln).otherwise(e).alias("accountable_entity_id"),
        F.when(ln == 6, "VALUE_ADDED_SERVICE")
        .when(ln == 7, "PENALTY")
        .otherwise(_entity_type(lk))
        .alias("accountable_entity_type"),
        F.when(F.col("l_linestatus") == "F", "ACCRUAL").otherwise("DEFERRAL").alias("recognition_type"),
        F.when((F.col("l_returnflag") == "A") & (ln == 5), "CANCELLED")
        .when((F.col("l_returnflag") == "A") & (ln == 4) & (F.col("l_suppkey") % 7 == 0), "INVALIDATED")
        .otherwise("RECOGNISED").alias("state"),
        F.when(F.col("l_suppkey") % 29 == 0, "OTHER").otherwise(policy.vertical).alias("vertical"),
        start.alias("start_date"),
        _days(start, F.col("l_suppkey") % 61 + 10).alias("end_date"),
        F.when(F.col("l_partkey") % 17 == 0, F.lit(None))
        .otherwise(
            _minutes(
                _days(F.col("l_shipdate"), F.col("l_partkey") % 61 - 30), (F.col("l_partkey") * 37) % 1440
            )
        )
        .alias("recognised_at"),
        _days(F.col("l_shipdate"), F.lit(-1)).alias("created_at"),
        F.when(F.col("l_partkey") % 53 == 0, F.col("l_shipdate")).alias("deleted_at"),
        F.when(F.col("l_suppkey") % 13 == 0, "SETTLEMENT").otherwise("ORDER").alias("external_reference_type"),
        F.col("l_orderkey").alias("external_reference_id"),
        F.col("l_orderkey").alias("revenue_recognition_schedule_id"),
        money("l_extendedprice").alias("taxable_amount"),
        discounts_text.alias("discounts"),
    )

    schedule_days = F.element_at(F.array(*[F.lit(d) for d in SCHEDULE_DAYS]), (F.col("o_orderkey") % 6 + 1).cast("int"))
    schedules = orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("start_date"),
        _days(F.col("o_orderdate"), schedule_days).alias("end_date"),
        money("o_totalprice").alias("taxable_amount"),
        F.round(money("o_totalprice") * F.lit(1.18).cast("decimal(3,2)"), 2).cast("decimal(18,2)").alias(
            "post_tax_amount"
        ),
    )

    penalty = (
        lo.filter(ln == 7)
        .select(
            (F.col("l_orderkey") * 10 + 7).alias("id"),
            e.alias("product_entity_id"),
            F.col("o_custkey").alias("user_id"),
        )
        .distinct()
    )
    vas_type = F.element_at(F.array(*[F.lit(t) for t in VAS_TYPES]), (F.col("l_orderkey") % 5 + 1).cast("int"))
    vas = (
        lo.filter(ln == 6)
        .select(
            (F.col("l_orderkey") * 10 + 6).alias("id"),
            e.alias("entity_id"),
            _entity_type(lk).alias("entity_type"),
            vas_type.alias("type"),
            F.when(F.col("l_orderkey") % 23 == 0, "CANCELLED").otherwise("ACTIVE").alias("state"),
        )
        .distinct()
    )
    catalog_type = F.element_at(F.array(*[F.lit(t) for t in CATALOG_TYPES]), (F.col("p_size") % 3 + 1).cast("int"))
    discounts = part.select(F.col("p_partkey").alias("id"), catalog_type.alias("type"))

    # ---- acquisitions: first (activation, id) of a user is 'New' -------------
    first = ent.groupBy("user_id").agg(F.min(F.struct("activation_date", "id", "entity_type")).alias("first"))
    acquisitions = (
        ent.join(first, "user_id")
        .join(orders.select(F.col("o_orderkey").alias("order_id"), "o_totalprice"), "order_id")
        .select(
            F.col("id").alias("accountable_entity_id"),
            F.col("entity_type").alias("accountable_entity_type"),
            F.concat(F.lit("CX-"), F.col("user_id").cast("string")).alias("fur_id"),
            money("o_totalprice").alias("taxable_amount"),
            ist_date("activation_date").alias("activation_date"),
            F.when((F.col("first.id") == F.col("id")) & (F.col("first.entity_type") == F.col("entity_type")), "New")
            .otherwise("UPSELL").alias("flag"),
        )
    )

    ledger = Ledger(
        recognitions=recognitions,
        schedules=schedules,
        items=entity_table("ITEM"),
        attachments=entity_table("ATTACHMENT"),
        return_items=by_type(returns, "ITEM", "item_id", ret_cols),
        return_attachments=by_type(returns, "ATTACHMENT", "attachment_id", ret_cols),
        rtp_items=by_type(buyouts, "ITEM", "item_id", rtp_cols),
        rtp_attachments=by_type(buyouts, "ATTACHMENT", "attachment_id", rtp_cols),
        rtp_orders=buyouts.select(F.col("row_id").alias("id"), F.col("order_state").alias("state"), "created_at"),
        swap_items=by_type(swaps, "ITEM", "item_id", swap_cols),
        swap_attachments=by_type(swaps, "ATTACHMENT", "attachment_id", swap_cols),
        penalty=penalty,
        vas=vas,
        discounts=discounts,
        acquisitions=acquisitions,
    )
    if cache:
        # write each table once into the session's shared folder and read it
        # back: downstream plans see parquet leaves, exactly like the catalog
        # tables of a production ledger
        ledger.write_parquet(folder.path)
        ledger = Ledger.from_parquet(spark, folder.path)
        ledger.close = folder.close
    return ledger


_LEDGERS: dict = {}


def ledger_for(spark: SparkSession, sf_dir: str, policy: Policy | None = None) -> Ledger:
    """One cached binding per (session, folder and state of its tables, vertical):
    every registered query of a run shares the same loaded ledger."""
    policy = policy or fixture_policy()
    key = (spark.sparkContext.applicationId, sf_dir, table_times(spark, sf_dir), policy.vertical)
    if key not in _LEDGERS:
        _LEDGERS[key] = bind(spark, sf_dir, policy)
    return _LEDGERS[key]


def close_ledgers() -> None:
    """Delete the copies that the bound ledgers were read from."""
    while _LEDGERS:
        _LEDGERS.popitem()[1].close()
