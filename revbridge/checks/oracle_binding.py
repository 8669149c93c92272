"""DuckDB derivation of the test ledger (FIXTURES.md section 3), written
independently of the Spark binding.  Views `orders`, `lineitem`, `part` are
pre-registered by the checker.  Discount lines are produced directly as values
(1 = l_discount, 2 = l_tax), not through JSON.
"""

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"

BINDING_CTES = r"""
ent_raw AS (
    SELECT o_custkey, o_orderkey % 3 AS k, MIN(o_orderdate) AS first_at, MIN(o_orderkey) AS order_id
    FROM orders GROUP BY o_custkey, o_orderkey % 3
),
ent AS (
    SELECT o_custkey * 10 + k % 2 AS id,  -- an attachment shares the id of an item
           CASE WHEN k = 2 THEN 'ATTACHMENT' ELSE 'ITEM' END AS entity_type,
           o_custkey AS user_id, order_id,
           first_at + to_minutes(CAST(((o_custkey * 7 + k) * 101) % 1440 AS BIGINT)) AS activation_date,
           o_custkey * 10 + k % 2 AS composite_item_id,
           CASE WHEN (o_custkey + k) % 41 = 0 THEN 'CANCELLED' ELSE 'ACTIVE' END AS state,
           o_custkey + k AS h, CASE WHEN k = 2 THEN 1 ELSE 0 END AS att
    FROM ent_raw
),
ret AS (  -- n = 1: a second live return
    SELECT id, entity_type, id * 4 + att * 2 + n AS return_row_id, user_id * 2 + n AS return_id,
           CASE WHEN h % 35 = 1 AND n = 0 THEN 'CANCELLED' ELSE 'COMPLETED' END AS state,
           activation_date + to_days(CAST((h * 37) % 1500 + 30 + 45 * n AS INTEGER))
                           + to_minutes(CAST((h * 53) % 1440 AS BIGINT)) AS created_at
    FROM ent CROSS JOIN (VALUES (0), (1)) t(n) WHERE h % 5 = 1 AND (n = 0 OR h % 15 = 1)
),
ret2 AS (SELECT *, created_at + INTERVAL 1 DAY AS updated_at FROM ret),
return_items AS (SELECT return_row_id AS id, id AS item_id, return_id, state, created_at, updated_at FROM ret2 WHERE entity_type = 'ITEM'),
return_attachments AS (SELECT return_row_id AS id, id AS attachment_id, return_id, state, created_at, updated_at FROM ret2 WHERE entity_type = 'ATTACHMENT'),
pickups AS (SELECT id, entity_type, max(created_at) + INTERVAL 3 DAY AS pickup_date FROM ret WHERE state = 'COMPLETED' GROUP BY ALL),
bo AS (  -- n = 1: a second buy-out line, some on a cancelled order
    SELECT id, entity_type, id * 4 + att * 2 + n AS line_id,
           CASE WHEN h % 4 = 0 AND n = 0 THEN '{"status":"PENDING"}' ELSE '{"status":"PAID"}' END AS payment_details,
           '{"byCashPreTax":"' || CAST((h * 97) % 50000 + 100 AS VARCHAR) || '"}' AS payableafterpaymentoffers,
           CASE WHEN n = 1 AND h % 20 = 2 THEN 'CANCELLED' ELSE 'CONFIRMED' END AS order_state,
           activation_date + to_days(CAST((h * 31) % 1500 + 30 + 60 * n AS INTEGER)) AS created_at
    FROM ent CROSS JOIN (VALUES (0), (1)) t(n) WHERE (h % 5 = 2 OR h % 55 = 1) AND (n = 0 OR h % 10 = 2)
),
rtp_items AS (SELECT line_id AS id, id AS item_id, line_id AS rent_to_purchase_order_id, payment_details, payableafterpaymentoffers FROM bo WHERE entity_type = 'ITEM'),
rtp_attachments AS (SELECT line_id AS id, id AS attachment_id, line_id AS rent_to_purchase_order_id, payment_details, payableafterpaymentoffers FROM bo WHERE entity_type = 'ATTACHMENT'),
rtp_orders AS (SELECT line_id AS id, order_state AS state, created_at FROM bo),
sw AS (
    SELECT id, entity_type, id + 7 AS rented_product_id, id * 3 AS swap_id, id * 3 + 1 AS swap_pair_id, composite_item_id AS swap_composite_item_id,
           '{"basePrice":' || CAST(id % 997 + 100 AS VARCHAR) || '}' AS pricing_details, CAST(NULL AS VARCHAR) AS payment_details,
           '[]' AS offers_snapshot, id + 11 AS fulfillment_id, id + 13 AS stock_commitment_id, CAST(NULL AS VARCHAR) AS promise_date_details,
           CASE WHEN h % 2 = 0 THEN 'SWAP_OUT' ELSE 'SWAP_IN' END AS action,
           CASE WHEN h % 21 = 3 THEN 'PENDING' ELSE 'FULFILLED' END AS state,
           activation_date + to_days(CAST((h * 29) % 1500 + 15 AS INTEGER)) AS fulfillment_date,
           fulfillment_date - INTERVAL 1 DAY AS selected_fulfillment_date, activation_date AS created_at, fulfillment_date AS updated_at,
           CAST(NULL AS TIMESTAMP) AS cancelled_at, CAST(NULL AS VARCHAR) AS cancelled_by,
           activation_date AS original_tenure_start_date, activation_date + INTERVAL 365 DAY AS original_tenure_end_date
    FROM ent WHERE h % 5 >= 3
),
swap_items AS (SELECT id AS item_id, * EXCLUDE (entity_type) FROM sw WHERE entity_type = 'ITEM'),
swap_attachments AS (SELECT id AS attachment_id, * EXCLUDE (entity_type) FROM sw WHERE entity_type = 'ATTACHMENT'),
swap_items_shown AS (SELECT * REPLACE (CAST(fulfillment_date AS VARCHAR) AS fulfillment_date, CAST(selected_fulfillment_date AS VARCHAR) AS selected_fulfillment_date,
    CAST(created_at AS VARCHAR) AS created_at, CAST(updated_at AS VARCHAR) AS updated_at, CAST(cancelled_at AS VARCHAR) AS cancelled_at,
    CAST(original_tenure_start_date AS VARCHAR) AS original_tenure_start_date, CAST(original_tenure_end_date AS VARCHAR) AS original_tenure_end_date) FROM swap_items),
swap_attachments_shown AS (SELECT * REPLACE (CAST(fulfillment_date AS VARCHAR) AS fulfillment_date, CAST(selected_fulfillment_date AS VARCHAR) AS selected_fulfillment_date,
    CAST(created_at AS VARCHAR) AS created_at, CAST(updated_at AS VARCHAR) AS updated_at, CAST(cancelled_at AS VARCHAR) AS cancelled_at,
    CAST(original_tenure_start_date AS VARCHAR) AS original_tenure_start_date, CAST(original_tenure_end_date AS VARCHAR) AS original_tenure_end_date) FROM swap_attachments),
ent_p AS (SELECT e.*, p.pickup_date FROM ent e LEFT JOIN pickups p ON p.id = e.id AND p.entity_type = e.entity_type),
items AS (
    SELECT id, user_id, order_id, state, 'RENTAL' AS vertical, activation_date, pickup_date, composite_item_id,
           'item-' || CAST(id AS VARCHAR) AS name,
           '{"basePrice":' || CAST(id % 997 + 100 AS VARCHAR) || '}' AS pricing_details,
           order_id AS bundle_id, 'tel-' || CAST(user_id AS VARCHAR) AS contact, 'user-' || CAST(user_id AS VARCHAR) AS user_name,
           'u' || CAST(user_id AS VARCHAR) || '@example.org' AS email_id, 'CX-' || CAST(user_id AS VARCHAR) AS display_id,
           id % 2 = 0 AS is_migrated, id % 3 = 0 AS is_autopay
    FROM ent_p WHERE entity_type = 'ITEM'
),
attachments AS (
    SELECT id, user_id, order_id, state, 'RENTAL' AS vertical, activation_date, pickup_date, composite_item_id,
           'attachment-' || CAST(id AS VARCHAR) AS name
    FROM ent_p WHERE entity_type = 'ATTACHMENT'
),
lo AS (SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
rr AS (
    SELECT l_orderkey * 10 + l_linenumber AS id,
           CASE WHEN l_linenumber IN (6, 7) THEN l_orderkey * 10 + l_linenumber
                ELSE o_custkey * 10 + l_orderkey % 3 % 2 END AS accountable_entity_id,
           CASE WHEN l_linenumber = 6 THEN 'VALUE_ADDED_SERVICE'
                WHEN l_linenumber = 7 THEN 'PENALTY'
                WHEN l_orderkey % 3 = 2 THEN 'ATTACHMENT' ELSE 'ITEM' END AS accountable_entity_type,
           CASE WHEN l_linestatus = 'F' THEN 'ACCRUAL' ELSE 'DEFERRAL' END AS recognition_type,
           CASE WHEN l_returnflag = 'A' AND l_linenumber = 5 THEN 'CANCELLED'
                WHEN l_returnflag = 'A' AND l_linenumber = 4 AND l_suppkey % 7 = 0 THEN 'INVALIDATED' ELSE 'RECOGNISED' END AS state,
           CASE WHEN l_suppkey % 29 = 0 THEN 'OTHER' ELSE 'RENTAL' END AS vertical,
           CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS start_date,
           CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_days(CAST(10 + l_suppkey % 61 AS INTEGER)) AS end_date,
           CASE WHEN l_partkey % 17 = 0 THEN NULL
                ELSE l_shipdate + to_days(CAST(l_partkey % 61 - 30 AS INTEGER))
                                + to_minutes(CAST((l_partkey * 37) % 1440 AS BIGINT)) END AS recognised_at,
           l_shipdate - INTERVAL 1 DAY AS created_at,
           CASE WHEN l_partkey % 53 = 0 THEN l_shipdate END AS deleted_at,
           CASE WHEN l_suppkey % 13 = 0 THEN 'SETTLEMENT' ELSE 'ORDER' END AS external_reference_type,
           l_orderkey AS external_reference_id,
           l_orderkey AS revenue_recognition_schedule_id,
           CAST(l_extendedprice AS DECIMAL(18, 2)) AS taxable_amount,
           -- text that is no JSON has no discounts; a single object has the first only
           CASE WHEN l_partkey % 97 = 0 THEN 'none' WHEN l_partkey % 89 = 0 AND l_discount <> 0 THEN 'one' ELSE 'list' END AS disc_form,
           CASE WHEN disc_form = 'none' THEN 0 ELSE ROUND(l_discount * 1000, 2) END AS disc1, CAST(l_partkey AS VARCHAR) AS cat1,
           CASE WHEN disc_form = 'list' THEN ROUND(l_tax * 1000, 2) ELSE 0 END AS disc2, CAST(l_partkey + 1 AS VARCHAR) AS cat2
    FROM lo
),
schedules AS (
    SELECT o_orderkey AS id, o_orderdate AS start_date,
           o_orderdate + to_days(CAST([30, 61, 91, 183, 274, 365][o_orderkey % 6 + 1] AS INTEGER)) AS end_date,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS taxable_amount,
           CAST(ROUND(CAST(o_totalprice AS DECIMAL(18, 2)) * CAST(1.18 AS DECIMAL(3, 2)), 2) AS DECIMAL(18, 2)) AS post_tax_amount
    FROM orders
),
penalty AS (
    SELECT DISTINCT l_orderkey * 10 + 7 AS id, o_custkey * 10 + l_orderkey % 3 % 2 AS product_entity_id, o_custkey AS user_id
    FROM lo WHERE l_linenumber = 7
),
vas AS (
    SELECT DISTINCT l_orderkey * 10 + 6 AS id, o_custkey * 10 + l_orderkey % 3 % 2 AS entity_id,
           CASE WHEN l_orderkey % 3 = 2 THEN 'ATTACHMENT' ELSE 'ITEM' END AS entity_type,
           ['BRAND_CARE_PROGRAM', 'FLEXI_CANCELLATION', 'DELIVERY_CHARGE', 'AC_INSTALLATION_CHARGE', 'OTHER'][l_orderkey % 5 + 1] AS type,
           CASE WHEN l_orderkey % 23 = 0 THEN 'CANCELLED' ELSE 'ACTIVE' END AS state
    FROM lo WHERE l_linenumber = 6
),
disc_catalog AS (SELECT p_partkey AS id, ['UPFRONT', 'LOYALTY', 'COUPON'][p_size % 3 + 1] AS type FROM part),
acquisitions AS (
    SELECT e.id AS accountable_entity_id, e.entity_type AS accountable_entity_type,
           'CX-' || CAST(e.user_id AS VARCHAR) AS fur_id,
           CAST(o.o_totalprice AS DECIMAL(18, 2)) AS taxable_amount,
           CAST(e.activation_date + INTERVAL 330 MINUTE AS DATE) AS activation_date,
           CASE WHEN ROW_NUMBER() OVER (PARTITION BY e.user_id ORDER BY e.activation_date, e.id, e.entity_type) = 1
                THEN 'New' ELSE 'UPSELL' END AS flag
    FROM ent e JOIN orders o ON o.o_orderkey = e.order_id
)
"""
