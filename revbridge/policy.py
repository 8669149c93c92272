"""Run parameters and fixed values.

`Policy` holds every knob where the source reports disagree with each other
(S1.1 recognised rule, buy-out adjusted dates, discount population, settlement
handling, ...).  Defaults follow the current main bridge.  The fixed values below must
equal the report's labels and sort orders so downstream dashboards keep working.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Policy:
    # analysis months (first day of each month); any number of months works
    months: tuple[dt.date, ...]
    # stands in for CURRENT_DATE in the churn product; never read the clock
    as_of: dt.date
    # business vertical kept by every ledger scan: set it to the ledger's own name
    vertical: str = "RENTAL"
    # days per month used for schedule tenure and for churn amounts
    tenure_days_per_month: Decimal = Decimal("30.45")
    churn_days_per_month: Decimal = Decimal("30.40")
    # S1.1 recognised condition: "cycle_start" (recognised NULL or >= cycle
    # start), "prev_start" (>= previous month start), "month_start", or
    # "other_month" (not in the month in which the cycle starts)
    s11_recognised_rule: str = "cycle_start"
    # current-month MTP tests the buy-out adjusted date ("adjusted") or "raw"
    current_mtp_date: str = "adjusted"
    # optional ledger filters: drop soft-deleted cycles, look-back lower bound
    exclude_deleted: bool = False
    created_from: dt.date | None = None
    # discounts counted by R20-R23: "non_upfront" or "all"
    discount_population: str = "non_upfront"
    # settlement cycles feed the upfront-discount sum of plan transition
    include_settlement: bool = True
    # months before the first one beyond which no earlier cycle is compared with
    # (R16, R20-R23, D05); None looks back over all history
    discount_lookback_months: int | None = None
    # plan transition R16 compares against the previous *upfront* cycle
    # (reference rule) or, when dense, against the previous cycle of any kind
    plan_transition_dense: bool = False
    # add the VAS bridge into adjusted opening (off in the main bridge)
    vas_in_opening: bool = False
    # revenue of every swap ("event"), or of one an entity and action ("entity"):
    # its last swap out, its first swap in
    swap_rank: str = "event"
    # bucket churn events by "payment" (transaction) date or "pickup" date
    churn_bucket: str = "payment"
    # churn events of entities with a current-month MTP are left out by
    # "not_exists" or by "not_in", whose NULL keys exclude whatever they might equal
    mtp_exclusion: str = "not_exists"
    # months after a cycle's start in which R21-R23 report its discount change:
    # 1 (the main bridge) or 0 (the current month)
    discount_change_months: int = 1
    # add-on service type -> bridge component; a type matches a name that it
    # equals or ends with after an underscore (ledgers prefix a brand), the
    # first match wins and anything else is R27, "Other"
    vas_types: tuple[tuple[str, str], ...] = (
        ("CARE_PROGRAM", "R24"),
        ("FLEXI_CANCELLATION", "R24"),
        ("DELIVERY_CHARGE", "R25"),
        ("AC_INSTALLATION_CHARGE", "R26"),
    )
    # (component, label): report labels to use in place of the fixed ones
    labels: tuple[tuple[str, str], ...] = ()

    @property
    def first_prev_start(self) -> dt.date:
        """Start of the month before the earliest analysis month."""
        m = min(self.months).replace(day=1)
        return (m - dt.timedelta(days=1)).replace(day=1)

    @property
    def discount_window(self) -> tuple[dt.date, dt.date]:
        """Starts of the cycles whose discounts the months count: from one month before
        the first (or as many as R21-R23 report later) to the end of the last."""
        m = self.first_start.year * 12 + self.first_start.month - 1 - max(1, self.discount_change_months)
        return dt.date(m // 12, m % 12 + 1, 1), self.last_next

    @property
    def discount_lookback(self) -> dt.date | None:
        """Start of the first month that the look-back still reaches."""
        if self.discount_lookback_months is None:
            return None
        m = self.first_start.year * 12 + self.first_start.month - 1 - self.discount_lookback_months
        return dt.date(m // 12, m % 12 + 1, 1)

    @property
    def first_start(self) -> dt.date:
        return min(self.months).replace(day=1)

    @property
    def last_next(self) -> dt.date:
        """Start of the month after the latest analysis month."""
        return (max(self.months).replace(day=1) + dt.timedelta(days=32)).replace(day=1)


# ---------------------------------------------------------------------------
# Report labels, sort orders, signs and customer counting.
# (component id, label, sort order, sign, counts customers)
# ---------------------------------------------------------------------------
COMPONENTS = [
    ("R01", "Opening_revenue", 1, 1, True),
    ("R02", "Minimum tenure charges", 2, -1, True),
    ("R04", "New deliveries (Addition of Cx)", 4, 1, True),
    ("R05", "Upsell (Addition in item count)", 5, 1, True),
    ("R06", "Total pickup (Return Request Date)", 6, -1, True),
    ("R07", "Partial pickup (Reduction in item count)", 7, -1, False),
    ("R08", "Full pickup (Reduction of Cx)", 8, -1, True),
    ("R09", "TTO (Total - TTO Transaction Date)", 9, -1, True),
    ("R10", "TTO - Partial (Reduction in item count)", 10, -1, False),
    ("R11", "TTO - Full (Reduction of Cx)", 11, -1, True),
    ("R12", "Swapped out", 12, -1, False),
    ("R13", "Swapped in", 13, 1, False),
    ("R14", "Current month MTP", 14, -1, True),
    ("R15", "Penalty", 15, 1, True),
    ("R16", "Plan transition", 16, 1, True),
    ("R18", "RO (Renewal Overdue) - Positive", 18, 1, True),
    ("R19", "RO (Renewal Overdue) - Negative", 19, 1, True),
    ("R20", "Discount given", 20, 1, True),
    ("R21", "Discount change", 21, 1, True),
    ("R24", "VAS Revenue - Care & Flexi", 24, 1, True),
    ("R25", "VAS Revenue - Delivery charges", 25, 1, True),
    ("R26", "VAS Revenue - Installation Charges", 26, 1, True),
    ("R27", "VAS Revenue - Other", 27, 1, True),
]
# split components reported outside the main bridge
EXTRA_COMPONENTS = [
    ("R16P", "Plan transition - Positive", 16, 1, True),
    ("R17", "Plan transition - Negative", 17, 1, True),
    ("R22", "Discount change - Positive", 22, 1, True),
    ("R23", "Discount change - Negative", 23, 1, True),
]
# components computed from one shared frame: if the frame has any row in a
# month, every member gets a (possibly zero) row for that month
FAMILIES = {
    "opening": ["R01", "R02", "R14"],
    "acquisition": ["R04", "R05"],
    "churn": ["R06", "R07", "R08", "R09", "R10", "R11"],
    "accrual": ["R18", "R19"],
}
# closing members (items / customers / revenue lists differ on purpose)
CLOSING_ITEMS = ["R04", "R05", "R07", "R08", "R10", "R11", "R12", "R13"]
CLOSING_CUSTOMERS = ["R04", "R05", "R08", "R11"]
CLOSING_REVENUE = CLOSING_ITEMS + ["R14", "R15", "R16", "R21"]
# computed report rows
ADJUSTED_OPENING = ("Adjusted opening", 3)
TOTAL_CLOSING = ("Total closing Revenue", 31)
GAP = ("Gap (Month1 Closing vs Month2 Opening)", 32)
# churn transaction types, churn flags and cycle labels
TXN_RETURN = "return_item"
TXN_BUYOUT = "rent_to_purchase_item"
EXCLUDED_RR_STATES = ("CANCELLED", "INVALIDATED")
