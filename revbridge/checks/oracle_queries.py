"""The oracle's SELECT of every registered query (keys match `plans.registry`)."""

from __future__ import annotations

from revbridge.checks.oracle_sql import FROM_CHURN_TABLE, base, cents, churn, ist_day, labels, report, shown

ENTITY = "accountable_entity_id:i=eid accountable_entity_type=kind"
CYC = f"{ENTITY} cycle_start_date:s=s cycle_end_date:s=e"
LOSS = (
    "entity_id:i=eid entity_type=kind churn_flag transaction_type=ttype payment_date:s=paid_at start_date:s end_date:s "
    "taxable_amount:d=monthly revenue_loss_day:s=lost_day rnk:i"
)
DISCOUNT = f"{ENTITY} revenue_recognition_schedule_id:i=sid"
EVENT = "month_num:i entity_id:i=eid entity_type=kind user_ids:i taxable_amount:d=monthly churn_flag transaction_type=ttype"
COUNTS = "items_count:i=items cx_count:i=cx taxable_revenue:d=rev"


def components() -> dict[str, str]:
    names = (
        "R01_opening_revenue R02_mtp_adjustment R04_new_deliveries R05_upsells R06_total_pickups R07_partial_pickups R08_full_pickups "
        "R09_buyout_total R10_buyout_partial R11_buyout_full R12_swapped_out R13_swapped_in R14_current_month_mtp R15_penalty_revenue "
        "R16_plan_transition R16P_plan_transition_positive R17_plan_transition_negative R18_renewal_overdue_positive "
        "R19_renewal_overdue_negative R20_discount_given R21_discount_change R22_discount_change_positive R23_discount_change_negative "
        "R24_vas_care_flexi R25_vas_delivery R26_vas_installation R27_vas_other"
    ).split()
    return {n: report(f"SELECT {shown('month_num:i ' + COUNTS)} FROM line WHERE component = '{n.split('_')[0]}'") for n in names}


def month_rows(months: str) -> str:
    spec = "month_num:i m_start:s m_next:s m_end:s prev_start:s m_label"
    return base(f"""SELECT {shown(spec)}, (SELECT count(*) FROM rr WHERE CAST(start_date AS DATE) >= m_start AND CAST(start_date AS DATE) < m_next) AS cycles_starting
FROM (SELECT *, m_next - 1 AS m_end FROM ({months}))""")


ROLLING = """SELECT k AS month_num, CAST(d AS DATE) AS m_start, CAST(d + INTERVAL 1 MONTH AS DATE) AS m_next, CAST(d - INTERVAL 1 MONTH AS DATE) AS prev_start,
       strftime(d, '%b %Y') AS m_label FROM (SELECT k, DATE '2001-01-01' + to_months(CAST(k AS INTEGER)) AS d FROM range(1, 13) t(k))"""


def wide(rows: str) -> str:
    """Report rows with the months side by side."""
    cells = ", ".join(
        f"CAST(max({c}) FILTER (month_num = {m}) AS {t}) AS m{m}_{c}" for m in (1, 2) for c, t in (("items", "BIGINT"), ("cx", "BIGINT"), ("rev", "DOUBLE"))
    )
    return report(f"SELECT label AS component, CAST(pos AS BIGINT) AS sort_order, {cells} FROM ({rows}) GROUP BY label, pos")


LINES = "SELECT month_num, label, pos, items, cx, rev FROM line WHERE label IS NOT NULL"
CYCLE_COLUMNS = (
    f"{ENTITY} start_date:s=start_day end_date:s=end_day recognised_at:s=rec_day taxable_amount:d=amount recognition_type=rtype user_id:i"
)

# Both sides of the gap, one row per entity (or customer) and component, then its residual spent cause by cause.
GAP_ROWS = """WITH stand AS (
  SELECT f.*, f.month_num AS g, 'C' AS side, sign, in_items, in_cx, in_rev FROM fact f JOIN member USING (component) JOIN meta USING (component)
  UNION ALL SELECT f.*, f.month_num - 1, 'O', 1, 1, 1, 1 FROM fact f WHERE component = 'R01'
  UNION ALL SELECT f.*, f.month_num - 1, 'E', 1, 0, 0, 0 FROM fact f WHERE component = 'R02'
  UNION ALL SELECT f.*, f.month_num, 'X', 1, 0, 0, 0 FROM fact f WHERE component IN ('R18', 'R19', 'R20')
), per_part AS (
  SELECT g, entity_type, entity_id, side, component, any_value(sign * in_items) AS n, sum(amount * sign) AS amt FROM stand WHERE g = 1 GROUP BY ALL
), both_sides AS (
  SELECT g, entity_type, entity_id, coalesce(max(1) FILTER (side = 'O'), 0) AS opened, coalesce(sum(n) FILTER (side = 'C'), 0) AS closed,
         coalesce(bool_or(n <> 0) FILTER (side = 'C'), FALSE) AS moved,
         coalesce(sum(amt) FILTER (side = 'O'), 0) - coalesce(sum(amt) FILTER (side = 'C'), 0) AS r0, coalesce(sum(amt) FILTER (side = 'E'), 0) AS a1,
         coalesce(sum(amt) FILTER (side = 'X' AND component <> 'R20'), 0) AS a2, -coalesce(sum(amt) FILTER (side = 'X' AND component = 'R20'), 0) AS a3
  FROM per_part GROUP BY ALL
), spent AS (
  SELECT *, CASE WHEN sign(r0) = sign(a1) THEN sign(r0) * least(abs(r0), abs(a1)) ELSE 0 END AS e1, r0 - e1 AS r1,
         CASE WHEN sign(r1) = sign(a2) THEN sign(r1) * least(abs(r1), abs(a2)) ELSE 0 END AS e2, r1 - e2 AS r2,
         CASE WHEN sign(r2) = sign(a3) THEN sign(r2) * least(abs(r2), abs(a3)) ELSE 0 END AS e3, r2 - e3 AS r3,
         CASE WHEN opened = 1 AND closed = 1 THEN 'amount differs' WHEN opened = 1 AND closed > 1 THEN 'counted in more than once'
              WHEN opened = 1 AND moved THEN 'opened although moved out' WHEN opened = 1 THEN 'opened without movement'
              WHEN closed > 0 THEN 'not opened without movement' WHEN closed < 0 THEN 'moved out without opening' ELSE 'amount without item' END AS state
  FROM both_sides
), buyer AS (
  SELECT g, customer, coalesce(max(1) FILTER (side = 'O'), 0) - coalesce(sum(n) FILTER (side = 'C'), 0) AS cx
  FROM (SELECT g, customer, side, component, any_value(sign * in_cx) AS n FROM stand WHERE g = 1 AND side IN ('C', 'O') AND customer IS NOT NULL GROUP BY ALL) GROUP BY ALL
), gap_row AS (
  SELECT g AS month_num, 'ENTITY' AS grain, entity_type, entity_id, NULL AS customer, t.cause, t.component, t.items, 0 AS cx, t.rev
  FROM spent, LATERAL (SELECT 'early cycles of the next opening' AS cause, 'R02' AS component, 0 AS items, e1 AS rev UNION ALL SELECT 'renewal overdue', 'R18/R19', 0, e2
    UNION ALL SELECT 'discount given', 'R20', 0, e3 UNION ALL SELECT state, NULL, opened - closed, r3) t WHERE t.items <> 0 OR t.rev <> 0
  UNION ALL
  SELECT g, 'CUSTOMER', NULL, NULL, customer, CASE WHEN cx > 0 THEN 'customer opened, not in closing' ELSE 'customer in closing, not opened' END, NULL, 0, cx, 0
  FROM buyer WHERE cx <> 0
)"""
GAP_COLUMNS = "month_num:i grain entity_type entity_id:i customer cause component items_count:i=items cx_count:i=cx taxable_revenue:d=rev"

HISTORY = "SELECT " + shown(
    "entity_id:i=eid entity_type=kind user_id:i order_id:i item_activation_date:s=act_day item_name=name cycle_start_date:s=s cycle_end_date:s=e "
    "recognised_at:s=rec_at recognised_at_ist:s=rec synthetic_recognised_at_ist:s=syn used_tto_date_for_pattern=moved recognition_type=rtype "
    "cycle_taxable_amount:d=amount has_return_in_window=returned_in return_item_id:i=ret_id return_item_state=ret_state return_created_at_ist:s=ret_day "
    "has_rtp_in_window=bought_in rent_to_purchase_item_id:i=buy_id rtp_created_at_ist:s=buy_day churn_classification=churn_flag "
    "churn_transaction_type=ttype mtp_classification=class mtp_classification_synthetic=class matched_month_window=m_label primary_cycle_type=label "
    "last_cycle_end_date:s=last_e item_recognition_pattern=pattern churn_pattern_type=churn_pattern is_item_last_cycle=from_end=1 "
    "cycle_position_from_end:i=from_end"
) + ", '2002-01-01' AS extracted_at FROM history"

ORACLE = components() | {
    "B01_entity_directory": base(f"SELECT {shown('id:i entity_type=kind user_id:i')} FROM owner"),
    "B02_ledger_base": base("SELECT " + shown(
        f"recognition_type=rtype {ENTITY} rr_start_date:s=started rr_end_date:s=ended recognised_at_ist:s=rec_day created_at_ist:s=made_day "
        "external_reference_type=ext revenue_recognition_schedule_id:i=sid taxable_amount:d=amount sched_taxable_amount:d=s_amount sched_tenure:i=s_months"
    ) + " FROM cycle"),
    "B03_ledger_split": base("""SELECT slice, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS taxable_amount
FROM cycle JOIN (VALUES ('ITEM', 'entity'), ('ATTACHMENT', 'entity'), ('PENALTY', 'penalty'), ('VALUE_ADDED_SERVICE', 'vas')) t(kind, slice) USING (kind) GROUP BY slice"""),
    "B04_revenue_cycles": base(f"SELECT {shown(CYCLE_COLUMNS)} FROM owned"),
    "B05_buyout_dates": base(f"SELECT {shown(f'{ENTITY} tto_date:s')} FROM buyout_day WHERE tto_date IS NOT NULL"),
    "B06_effective_recognition_date": base(f"SELECT {shown(CYCLE_COLUMNS + ' tto_date:s synthetic_recognised_at:s=adjusted_day')} FROM owned"),
    "B07_month_driver": month_rows("SELECT * FROM month"),
    "B08_rolling_month_driver": month_rows(ROLLING),
    "B09_schedule_grain": report("SELECT " + shown(
        f"revenue_recognition_type=rtype {DISCOUNT} start_date:s=s_start end_date:s=s_end taxable_amount:d=rate tenure:i=s_months "
        "external_reference_type=ext created_at:s=made_day"
    ) + " FROM term"),
    "B10_first_completed_return": base(
        f"SELECT {shown(ENTITY)}, CAST(min(created_at) AS VARCHAR) AS return_created_at FROM sent_back WHERE state = 'COMPLETED' GROUP BY eid, kind"
    ),
    "B11_normalised_cycles": base(f"""SELECT {shown(
        f'{ENTITY} recognition_type=rtype start_date:s=start_day end_date:s=end_day tenure:i=s_months recognised_at:s=rec_day created_at:s=made_day '
        'external_reference_type=ext external_reference_id:i=ext_id revenue_recognition_schedule_id:i=sid taxable_amount:d=amount user_id:i'
    )}, CAST({cents('s_amount', 's_months')} AS DOUBLE) AS monthly_taxable_amount, CAST({cents('s_post', 's_months')} AS DOUBLE) AS monthly_post_tax_amount,
  CAST(min(start_day) OVER (PARTITION BY eid, kind) AS VARCHAR) AS min_start_date,
  CAST((SELECT {ist_day('min(b.created_at)')} FROM sent_back b WHERE (b.eid, b.kind) = (o.eid, o.kind) AND b.state = 'COMPLETED') AS VARCHAR) AS return_created_at
FROM owned o"""),
    "C01_item_transactions": churn("SELECT " + shown(
        "item_id:i activation_date:s=act return_item_state=return_state user_id:i transaction_id:i=tid item_transaction_date:s=moment tto_pay=pay "
        "transaction_type=ttype return_item_updated_at:s=return_updated"
    ) + " FROM tx"),
    "C02_user_item_cross": churn("SELECT " + shown(
        "user_id:i=t.user_id transaction_date:s=t.moment base_item_id:i=t.item_id transaction_id:i=t.tid transaction_type=t.ttype"
    ) + """, count(k.item_id) AS earlier_items, count(k.item_id) FILTER (k.last_at >= t.moment) AS still_held
FROM (SELECT DISTINCT user_id, moment, item_id, tid, ttype FROM tx WHERE tid IS NOT NULL) t LEFT JOIN kept_item k ON k.user_id = t.user_id AND k.act < t.moment
GROUP BY t.user_id, t.moment, t.item_id, t.tid, t.ttype"""),
    "C03_transaction_scope": churn(f"SELECT {shown('transaction_id:i=tid user_id:i transaction_type=ttype full_or_partial_flag=flag')} FROM scope"),
    "C04_transaction_detail": churn("SELECT " + shown(
        "item_id:i bundle_id:i item_name=name return_item_state=return_state composite_item_id:i=composite base_price=price user_id:i contact user_name email_id "
        "fur_id=display_id activation_date:s=act pickup_date:s=pickup is_migrated is_autopay_enabled=is_autopay ufdiscount_config='NA' payment_date:s=paid_at "
        "charge_till_date:s=DATE'2002-01-01' applicable_on:s=paid_at tto_amount:d=paid transaction_type=ttype transaction_id:i=tid "
        "transaction_type_detail=flag updated_at:s=DATE'2002-01-01' return_item_updated_at:s=return_updated"
    ) + " FROM detail"),
    "C05_remaining_item_count": churn(f"SELECT {shown('item_ids:i later_items_count:i=n')} FROM remaining"),
    "C06_churn_flag": churn(f"SELECT {shown('item_ids:i user_ids:i pickup_date:s=pickup later_items_count:i=n churn_flag')} FROM tagged"),
    "C07_item_churn_amount": churn(f"SELECT {shown(LOSS)}, CAST(CAST(date_trunc('month', lost_day) AS DATE) AS VARCHAR) AS revenue_loss_month FROM loss WHERE kind = 'ITEM'"),
    "C08_attachment_churn_amount": churn(
        f"SELECT {shown(LOSS)}, CAST(CAST(date_trunc('month', lost_day) AS DATE) AS VARCHAR) AS revenue_loss_month FROM loss WHERE kind = 'ATTACHMENT'"
    ),
    "C09_churn_table": churn("SELECT " + shown(
        "entity_id:i=eid entity_type=kind user_ids:i activation_date:s=act return_item_state=return_state base_price=price fur_id=display_id pickup_date:s=pickup "
        "payment_date:s=paid_at tto_amount:d=paid transaction_type=ttype transaction_id:i=tid transaction_type_detail=flag churn_flag start_date:s end_date:s "
        "taxable_amount:d=monthly rnk:i"
    ) + ", '2002-01-01 00:00:00' AS refreshed_at FROM loss WHERE churn_flag <> 'ACTIVE'"),
    "C10_published_churn_events": churn(f"SELECT {shown(EVENT)} FROM event"),
    "R00_classify_cycles": base("SELECT " + shown(
        f"month_num:i tag {ENTITY} start_date:s=start_day recognised_at:s=rec_day synthetic_recognised_at:s=adjusted_day user_id:i taxable_amount:d=amount"
    ) + " FROM mark"),
    "R03_adjusted_opening": report(f"SELECT {shown('month_num:i ' + COUNTS)} FROM total WHERE pos = 3"),
    "R0X_mtp_entities": base(f"SELECT DISTINCT {shown(ENTITY)} FROM mark WHERE tag = 'CMTP'"),
    "R0C_churn_events": churn(f"SELECT {shown(EVENT)} FROM event"),
    "R0N_churn_events_null_aware": churn(f"""SELECT {shown(EVENT)} FROM loss l JOIN month ON CAST(paid_at AS DATE) >= m_start AND CAST(paid_at AS DATE) < m_next
WHERE rnk = 1 AND churn_flag <> 'ACTIVE' AND NOT EXISTS (
  FROM mark x WHERE x.tag = 'CMTP' AND coalesce(x.eid = l.eid, TRUE) AND coalesce(x.kind = l.kind, TRUE))"""),
    "R28_vas_timing_detail": report("SELECT " + shown(
        "month_num:i accountable_entity_id:i=eid external_reference_id:i=ext_id start_date:s=start_day end_date:s=end_day taxable_amount:d=amount "
        "vas_type=vtype user_id:i vas_component=comp"
    ) + ", ['Current month VAS', 'Previous month VAS'][age + 1] AS vas_timing FROM addon"),
    "R29_vas_bridge": report(f"SELECT {shown('month_num:i vas_items:i=items vas_cx:i=cx vas_rev:d=rev')} FROM vas_move"),
    "R30_vas_adjusted_opening": report("SELECT " + shown(
        "month_num:i items_count:i=t.items+coalesce(v.items,0) cx_count:i=t.cx+coalesce(v.cx,0) taxable_revenue:d=t.rev+coalesce(v.rev,0)"
    ) + " FROM total t LEFT JOIN vas_move v USING (month_num) WHERE pos = 3"),
    "A01_all_components": report(f"SELECT {shown('month_num:i component=label sort_order:i=pos ' + COUNTS)} FROM line WHERE label IS NOT NULL"),
    "A02_bridge_wide": wide(LINES),
    "A03_closing_revenue": report(f"SELECT {shown('month_num:i ' + COUNTS)} FROM total WHERE pos = 31"),
    "A04_bridge_gap": report(f"SELECT {shown('month_num:i ' + COUNTS)} FROM gap"),
    "A05_revenue_bridge": wide(f"{LINES} UNION ALL SELECT * FROM total UNION ALL SELECT * FROM gap"),
    "A06_distinct_closing": report("""FROM (WITH key AS (
  SELECT month_num, component, 'ITEM' AS kind, entity_type || ':' || entity_id AS k FROM fact UNION SELECT month_num, component, 'CUSTOMER', customer FROM fact
), held AS (SELECT DISTINCT month_num, kind, k FROM key WHERE k IS NOT NULL AND (component IN ('R01', 'R04', 'R05') OR kind = 'ITEM' AND component = 'R13')
), gone AS (SELECT DISTINCT month_num, kind, k FROM key WHERE k IS NOT NULL AND (component IN ('R08', 'R11') OR kind = 'ITEM' AND component IN ('R07', 'R10', 'R12'))
), both_sets AS (SELECT *, TRUE AS h FROM held UNION ALL SELECT *, FALSE FROM gone)
SELECT CAST(b.month_num AS BIGINT) AS month_num, kind, count(DISTINCT k) FILTER (h) AS held, count(DISTINCT k) FILTER (NOT h) AS left_month,
  count(DISTINCT k) - count(DISTINCT k) FILTER (NOT h) AS closing_distinct, CAST(any_value(CASE kind WHEN 'ITEM' THEN t.items ELSE t.cx END) AS BIGINT) AS closing_added
FROM both_sets b LEFT JOIN total t ON t.month_num = b.month_num AND t.pos = 31 GROUP BY b.month_num, kind)"""),
    "Q01_component_drilldown": report(
        f"SELECT {shown('month_num:i component entity_type entity_id:i customer amount:d')} FROM fact WHERE component IN (SELECT component FROM meta WHERE label IS NOT NULL)"
    ),
    "Q02_gap_drilldown": report(f"FROM ({GAP_ROWS} SELECT {shown(GAP_COLUMNS)} FROM gap_row)"),
    "Q03_gap_causes": report(f"""FROM ({GAP_ROWS} SELECT CAST(month_num AS BIGINT) AS month_num, grain, cause, component, count(*) AS n_rows,
  CAST(sum(items) AS BIGINT) AS items_count, CAST(sum(cx) AS BIGINT) AS cx_count, CAST(sum(rev) AS DOUBLE) AS taxable_revenue FROM gap_row GROUP BY ALL)"""),
    "D01_discount_lines": report("SELECT " + shown(
        f"{DISCOUNT} external_reference_type=ext rr_start_date:s=start_day rr_end_date:s=end_day sched_tenure:i=s_months catalogReferenceId=ref discount_amount:d=amt"
    ) + " FROM discount"),
    "D02_discount_types": report("SELECT " + shown(
        f"{DISCOUNT} external_reference_type=ext rr_start_date:s=start_day rr_end_date:s=end_day sched_tenure:i=s_months catalogReferenceId=ref discount_amount:d=amt "
        "discount_type=dtype"
    ) + " FROM typed"),
    "D03_upfront_per_schedule": report(
        f"SELECT {shown(DISCOUNT)}, CAST(sum(coalesce(amt, 0)) AS DOUBLE) AS upfront_discount_amount FROM upfront WHERE ext <> 'SETTLEMENT' GROUP BY eid, kind, sid"
    ),
    "D04_discount_per_schedule": report(
        f"SELECT {shown(DISCOUNT)}, CAST(sum(amt) AS DOUBLE) AS discount_amount FROM typed WHERE ext <> 'SETTLEMENT' AND dtype IS NOT NULL GROUP BY eid, kind, sid"
    ),
    "D05_plan_transition_detail": report("SELECT " + shown(
        f"month_num:i {DISCOUNT} start_date:s=start_day end_date:s=end_day tenure:i=s_months upfront_discount_amount:d=up previous_tenure:i=was_months "
        "previous_upfront_discount_amount:d=was_up previous_start_date:s=was_start previous_end_date:s=was_end discount_change:d=up-was_up"
    ) + " FROM plan_detail JOIN month ON start_day >= prev_start AND start_day < m_start WHERE was_months <> s_months"),
    "D06_discount_grain_check": base(f"""SELECT {shown(DISCOUNT + ' start_date:s=start_day')}, count(*) AS n_cycles,
  CAST(sum(CAST(disc1 AS DECIMAL(18, 2)) + CAST(disc2 AS DECIMAL(18, 2))) AS DOUBLE) AS json_total, json_total AS exploded_total, TRUE AS matches
FROM owned GROUP BY eid, kind, sid, start_day, ended, disc_form, disc1, cat1, disc2, cat2"""),
    "D07_discount_faults": base(f"""SELECT {shown(DISCOUNT + ' start_date:s=start_day')}, CAST(NULL AS BIGINT) AS line,
  CASE disc_form WHEN 'none' THEN 'not JSON' ELSE 'object instead of a list' END AS reason FROM owned WHERE disc_form <> 'list'"""),
    "S01_swap_register": base(" UNION ALL ".join(
        f"SELECT * EXCLUDE ({own}), {own} AS entity_id, '{kind}' AS entity_type FROM swap_{kind.lower()}s_shown{where}"
        for own, kind, where in (("attachment_id", "ATTACHMENT", ""), ("item_id", "ITEM", " WHERE action = 'SWAP_OUT' AND state = 'FULFILLED'"))
    )),
    "S02_swap_peers": report("""FROM (WITH target AS (
  SELECT s.*, CASE WHEN s.action = 'SWAP_OUT' THEN (SELECT max(c.start_day) FROM cycle c WHERE (c.eid, c.kind) = (s.eid, s.kind) AND c.start_day <= s.day)
              ELSE (SELECT min(c.start_day) FROM cycle c WHERE (c.eid, c.kind) = (s.eid, s.kind) AND c.start_day >= s.day) END AS st FROM swap s)
SELECT CAST(t.eid AS BIGINT) AS entity_id, t.kind AS entity_type, t.action, CAST(t.day AS VARCHAR) AS fulfillment_date, CAST(t.st AS VARCHAR) AS cycle_start,
  CAST(c.amount AS DOUBLE) AS taxable_amount, count(c.eid) OVER w AS peers, row_number() OVER (PARTITION BY t.eid, t.kind, t.action, t.day ORDER BY c.amount DESC) AS place
FROM target t LEFT JOIN cycle c ON (c.eid, c.kind, c.start_day) = (t.eid, t.kind, t.st) WINDOW w AS (PARTITION BY t.eid, t.kind, t.action, t.day))"""),
    "L01_return_in_cycle": labels(
        f"SELECT {shown(CYC + ' return_item_id:i=ret_id return_item_state=ret_state return_created_at_ist:s=ret_day has_return_in_window=returned_in')} FROM with_return"
    ),
    "L02_buyout_in_cycle": labels(
        f"SELECT {shown(CYC + ' rent_to_purchase_item_id:i=buy_id rtp_created_at_ist:s=buy_day has_rtp_in_window=bought_in')} FROM with_buyout"
    ),
    "L03_churn_enrichment": labels("SELECT " + shown(
        f"{CYC} has_return_in_window=returned_in has_rtp_in_window=bought_in churn_classification=churn_flag churn_transaction_type=ttype churn_user_id:i=user_ids"
    ) + " FROM with_churn"),
    "L04_lifecycle_context": labels(
        f"SELECT {shown(CYC + ' global_tto_date:s=g future_cycles_count:i=later synthetic_recognised_at_ist:s=syn used_tto_date_for_pattern=moved')} FROM in_life"
    ),
    "L05_cycle_month_class": labels(f"SELECT DISTINCT {shown(CYC + ' month_num:i mtp_classification=class matched_month_window=m_label')} FROM classed"),
    "L06_earliest_match": labels(f"SELECT {shown(CYC + ' month_num:i mtp_classification=class matched_month_window=m_label')} FROM first_match"),
    "L07_cycle_label": labels(f"SELECT {shown(CYC + ' primary_cycle_type=label')} FROM history"),
    "L07T_cycle_label_terminal": labels(f"SELECT {shown(CYC + ' primary_cycle_type=label_terminal')} FROM history"),
    "L08_entity_context": labels(f"SELECT {shown(ENTITY + ' user_id:i order_id:i item_activation_date:s=act_day item_name=name')} FROM person"),
    "L09_lifecycle_pattern": labels("SELECT " + shown(
        f"{CYC} last_cycle_end_date:s=last_e item_recognition_pattern=pattern churn_pattern_type=churn_pattern cycle_position_from_end:i=from_end "
        "is_item_last_cycle=from_end=1"
    ) + " FROM history"),
    "L11_return_through_parent": labels(f"""FROM (WITH route AS (
  SELECT id, eid, kind, state, created_at, 'DIRECT' AS via FROM sent_back WHERE state <> 'CANCELLED'
  UNION ALL
  SELECT b.id, a.id, 'ATTACHMENT', b.state, b.created_at, 'PARENT' FROM sent_back b, items i, attachments a
  WHERE b.kind = 'ITEM' AND b.state <> 'CANCELLED' AND i.id = b.eid AND i.state <> 'CANCELLED' AND a.composite_item_id = i.composite_item_id
), best AS (
  SELECT c.eid, c.kind, c.s, c.e, arg_min(r, (CASE via WHEN 'PARENT' THEN 0 ELSE 1 END, r.created_at, r.id)) AS r
  FROM (SELECT DISTINCT eid, kind, s, e FROM plain_cycle) c JOIN route r ON (r.eid, r.kind) = (c.eid, c.kind) AND {ist_day('r.created_at')} BETWEEN c.s AND c.e
  GROUP BY ALL
) SELECT {shown('accountable_entity_id:i=c.eid accountable_entity_type=c.kind cycle_start_date:s=c.s cycle_end_date:s=c.e')},
  b.r.id AS return_item_id, b.r.state AS return_item_state, CAST({ist_day('b.r.created_at')} AS VARCHAR) AS return_created_at_ist, b.r.via AS return_route,
  EXISTS (FROM route r WHERE (r.eid, r.kind, r.via) = (c.eid, c.kind, 'DIRECT') AND {ist_day('r.created_at')} BETWEEN c.s AND c.e) AS returned_directly,
  EXISTS (FROM route r WHERE (r.eid, r.kind, r.via) = (c.eid, c.kind, 'PARENT') AND {ist_day('r.created_at')} BETWEEN c.s AND c.e) AS returned_with_parent,
  EXISTS (FROM route r WHERE (r.eid, r.kind) = (c.eid, c.kind) AND {ist_day('r.created_at')} BETWEEN c.s AND c.e) AS has_return_in_window
FROM plain_cycle c LEFT JOIN best b ON (b.eid, b.kind, b.s, b.e) = (c.eid, c.kind, c.s, c.e))"""),
    "L10_cycle_history": labels(HISTORY),
}


ORACLE["P01_fiscal_periods"] = base("""FROM (WITH week AS (  -- 4, 4 and 5 weeks, four times
  SELECT n, DATE '1996-12-30' + CAST(7 * (13 * ((n + 2) // 3 - 1) + 4 * ((n + 2) % 3)) AS INTEGER) AS lo FROM range(0, 14) t(n)
), fiscal AS (SELECT n AS num, lo, lead(lo) OVER (ORDER BY n) AS hi, lag(lo) OVER (ORDER BY n) AS prev FROM week QUALIFY n BETWEEN 1 AND 12
), placed AS (
  SELECT num, 'S1.1' AS tag, o.* FROM owned o JOIN fiscal ON start_day >= prev AND start_day < lo WHERE rec_day IS NULL OR rec_day >= start_day
  UNION ALL SELECT num, 'S1.2', o.* FROM owned o JOIN fiscal ON rec_day >= prev AND rec_day < lo WHERE start_day >= lo
  UNION ALL SELECT num, 'CMTP', o.* FROM owned o JOIN fiscal ON adjusted_day >= lo AND adjusted_day < hi WHERE start_day >= hi
) SELECT CAST(num AS BIGINT) AS period, tag, count(DISTINCT (eid, kind)) AS items_count, count(DISTINCT user_id) AS cx_count, CAST(sum(amount) AS DOUBLE) AS taxable_revenue
FROM placed GROUP BY ALL)""")
ORACLE["S03_swap_one_per_action"] = report("""FROM (WITH one AS (
  SELECT eid, kind, action, CASE action WHEN 'SWAP_OUT' THEN max(day) ELSE min(day) END AS day FROM swap GROUP BY eid, kind, action
), pair AS (  -- every cycle on the right side of any of the entity's swaps, ranked by start
  SELECT s.eid, s.kind, s.action, c.amount, row_number() OVER (PARTITION BY s.eid, s.kind, s.action
    ORDER BY CASE s.action WHEN 'SWAP_OUT' THEN c.start_day END DESC, CASE s.action WHEN 'SWAP_IN' THEN c.start_day END, c.amount DESC) AS k
  FROM swap s JOIN cycle c ON (c.eid, c.kind) = (s.eid, s.kind) AND CASE s.action WHEN 'SWAP_OUT' THEN c.start_day <= s.day ELSE c.start_day >= s.day END
) SELECT CAST(o.eid AS BIGINT) AS entity_id, o.kind AS entity_type, o.action, CAST(o.day AS VARCHAR) AS fulfillment_date, CAST(p.amount AS DOUBLE) AS taxable_amount
FROM one o LEFT JOIN pair p ON (p.eid, p.kind, p.action, p.k) = (o.eid, o.kind, o.action, 1))""")
ORACLE["L12_trailing_year_history"] = labels(HISTORY, month="month AS (" + ROLLING.replace("2001-01-01", "1996-12-01") + ")")
ORACLE["L13_history_from_churn_table"] = labels(HISTORY.replace("label AS primary_cycle_type", "label_terminal AS primary_cycle_type"), rules=FROM_CHURN_TABLE)
ORACLE["V01_sql_report"] = ORACLE["A05_revenue_bridge"]
ORACLE["V02_sql_component"] = report(f"SELECT {shown('month_num:i component entity_type entity_id:i customer amount:d')} FROM fact WHERE component = 'R14'")
ORACLE["V03_sql_transitions"] = f"SELECT * FROM ({ORACLE['D05_plan_transition_detail']}) WHERE accountable_entity_type = 'ITEM'"


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
