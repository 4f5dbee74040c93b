"""Parameters and fixed values.

Everything a plan needs besides its input DataFrames lives here: the run
parameters (``Params``), and the fixed texts, thresholds and column mappings
that results must reproduce.  Plans take a ``Params`` explicitly, so a run is
repeatable for any ``as_of`` date.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Params:
    """Run parameters.  ``as_of`` replaces the wall-clock "today"."""

    as_of: _dt.date = _dt.date(2001, 8, 2)
    # 03/04/2024 is the third of April: the exports come from shops that write
    # the day first.  A text that has no such reading is tried month first.
    day_first: bool = True
    dead_stock_days: int = 90
    low_margin_threshold: Decimal = Decimal("0.10")
    credit_risk_days: int = 15
    low_margin_lookback_days: int = 90
    velocity_days: int = 30
    alerts_per_mart: int = 10
    alerts_per_type: int = 5
    digest_lines_per_type: int = 3
    business_name: str = "Your Business"
    # low-margin alerts: the reference ranks the higher margin first inside one
    # severity; ``worst_first`` flips that to lowest margin first.
    worst_first: bool = False
    digest_time: _dt.datetime | None = None

    def digest_ts(self) -> _dt.datetime:
        return self.digest_time or _dt.datetime.combine(self.as_of, _dt.time(9, 0))


DEFAULT = Params()

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's texts and thresholds)
# ---------------------------------------------------------------------------

SEVERITY_ORDER = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}
ALERT_SEVERITIES = ("CRITICAL", "HIGH")

# dead stock: day thresholds and actions
DEAD_CRITICAL_DAYS = 180
DEAD_HIGH_DAYS = 120
DEAD_ACTION_DAYS = 90
DEAD_ACTION_CRITICAL = "Liquidate immediately at 20-30% discount"
DEAD_ACTION_HIGH = "Run promotional offer within 2 weeks"
DEAD_ACTION_MEDIUM = "Monitor closely, prepare promotion"
DEAD_ACTION_NORMAL = "Normal - continue monitoring"
DEAD_VALUE_FACTOR = Decimal("0.1")
DEAD_VALUE_UNIT_PRICE = 4000

# low margin: thresholds, causes and actions
LOW_MARGIN_HIGH = Decimal("0.05")
CAUSE_BELOW_COST = "Selling below cost price"
CAUSE_MISSING_COST = "Missing cost data - cannot calculate margin"
CAUSE_BELOW_AVG = "Below product average - excessive discount"
CAUSE_GENERAL = "General low margin issue"
MARGIN_ACTION_CRITICAL = "URGENT: Review pricing. Currently making loss!"
MARGIN_ACTION_HIGH = "Renegotiate with customer or stop sales"
MARGIN_ACTION_OTHER = "Reduce discounts, increase price"

# credit risk: day / amount thresholds, scores and actions
CREDIT_CRITICAL_AMOUNT = 100000
CREDIT_CRITICAL_DAYS = 90
CREDIT_HIGH_DAYS = 60
CREDIT_MEDIUM_DAYS = 30
PAYMENT_SCORE_STEPS = ((90, 0), (60, 25), (30, 50), (15, 75))
PAYMENT_SCORE_DEFAULT = 100
CREDIT_ACTION_CRITICAL = "STOP ALL CREDIT. Initiate legal recovery process."
CREDIT_ACTION_HIGH = "Final notice. Stop further sales immediately."
CREDIT_ACTION_MEDIUM = "Send stern payment reminder. Personal follow-up required."
CREDIT_ACTION_LOW = "Send polite payment reminder via WhatsApp"

# alert types, in the order the digest lists them
CREDIT_RISK = "CREDIT_RISK"
DEAD_STOCK = "DEAD_STOCK"
LOW_MARGIN = "LOW_MARGIN"
ALERT_TYPE_ORDER = (CREDIT_RISK, DEAD_STOCK, LOW_MARGIN)

# digest texts
SEVERITY_EMOJI = {"CRITICAL": "🔴", "HIGH": "🟠", "MEDIUM": "🟡", "LOW": "🟢"}
DEFAULT_EMOJI = "⚪"
SECTION_TITLES = {
    CREDIT_RISK: "💳 *OVERDUE PAYMENTS*",
    DEAD_STOCK: "📦 *DEAD STOCK*",
    LOW_MARGIN: "💰 *LOW MARGIN SALES*",
}
DIGEST_HEADER = "🚨 *{business} - Daily Alert*"
DIGEST_DATE_LINE = "📅 {when}"
DIGEST_ACTION_LINE = "⚠️ *ACTION REQUIRED*"
DIGEST_FOOTER = ("---", "💬 Reply HELP for support")
NO_ALERTS_TEXT = "✅ *{business} - Daily Report*\n\nNo critical issues today!\nAll systems running smoothly 🎉"
RUPEE = "₹"

# Unicode White_Space characters (the set an all-Unicode TRIM removes)
UNICODE_WHITESPACE = "".join(chr(c) for c in (
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D, 0x0020, 0x0085, 0x00A0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
))

# ---------------------------------------------------------------------------
# Source-system column mappings (universal field -> export header), in the
# order the systems are tried.  Fixed values.
# ---------------------------------------------------------------------------

# Source-system headers by universal field, in conf/erp_mappings.json.
# Systems and entities keep the file's order (ties in detection go to the first).
MAPPINGS_FILE = os.environ.get("LEDGERLENS_MAPPINGS") or os.path.join(os.path.dirname(__file__), "conf", "erp_mappings.json")


def load_mappings(path: str = MAPPINGS_FILE) -> dict[str, dict[str, dict[str, str]]]:
    """{system: {entity: {universal field: source header}}} from a file."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


ERP_MAPPINGS = load_mappings()


def use_mappings(path: str) -> None:
    """Take the mappings of another file from now on (more systems, other headers)."""
    new = load_mappings(path)
    ERP_MAPPINGS.clear()
    ERP_MAPPINGS.update(new)

# required fields checked by the cleaner (its own list of seven)
CLEANER_REQUIRED = (
    "transaction_id", "transaction_date", "customer_name",
    "product_name", "quantity", "unit_price", "total_amount",
)
NUMERIC_COLUMNS = ("quantity", "unit_price", "cost_price", "total_amount", "tax_amount")
FUZZY_CUTOFF = 70
LOW_CONFIDENCE = 0.5

# declared entities: (name, required) per field, and primary keys
ENTITY_FIELDS: dict[str, tuple[tuple[str, bool], ...]] = {
    "sales_transactions": (
        ("transaction_id", True), ("invoice_number", False), ("transaction_date", True),
        ("transaction_time", False), ("customer_id", True), ("customer_name", True),
        ("customer_type", False), ("product_id", True), ("product_name", True),
        ("product_category", False), ("product_brand", False), ("quantity", True),
        ("unit_of_measure", False), ("unit_price", True), ("cost_price", False),
        ("total_amount", True), ("discount_amount", False), ("tax_amount", False),
        ("final_amount", False), ("payment_status", False), ("payment_mode", False),
        ("payment_due_date", False), ("payment_received_date", False), ("amount_paid", False),
        ("salesperson_id", False), ("territory", False), ("notes", False),
    ),
    "inventory": (
        ("product_id", True), ("product_name", True), ("snapshot_date", True),
        ("quantity_on_hand", True), ("warehouse_location", False), ("last_sale_date", False),
        ("last_purchase_date", False), ("reorder_level", False),
    ),
    "customers": (
        ("customer_id", True), ("customer_name", True), ("customer_type", False),
        ("credit_limit", False), ("credit_period_days", False), ("territory", False),
        ("phone", False), ("email", False), ("registration_date", False),
    ),
    "products": (
        ("product_id", True), ("product_name", True), ("product_category", False),
        ("brand", False), ("unit_of_measure", False), ("standard_cost", False),
        ("standard_price", False), ("is_active", False),
    ),
}
PRIMARY_KEYS = {
    "sales_transactions": ("transaction_id",),
    "inventory": ("product_id", "snapshot_date"),
    "customers": ("customer_id",),
    "products": ("product_id",),
}
ALLOWED_VALUES = {
    ("sales_transactions", "customer_type"): ("Dealer", "Retailer", "Distributor", "Direct", "Wholesaler"),
    ("sales_transactions", "payment_status"): ("Paid", "Unpaid", "Partial", "Credit"),
    ("sales_transactions", "payment_mode"): ("Cash", "Card", "UPI", "Cheque", "Bank Transfer", "Credit"),
    ("customers", "customer_type"): ("Dealer", "Retailer", "Distributor", "Direct"),
}

# declared data-quality rules: (entity, rule name, severity)
DQ_RULES = {
    "sales_transactions": (
        ("quantity must be greater than 0", "error"),
        ("unit_price must be greater than 0", "error"),
        ("total_amount should equal quantity × unit_price", "warning"),
        ("cost_price should be less than unit_price", "warning"),
        ("transaction_date should not be in future", "error"),
    ),
    "inventory": (
        ("quantity_on_hand must be >= 0", "error"),
        ("last_sale_date should not be after snapshot_date", "error"),
    ),
}
TOTAL_TOLERANCE = Decimal("0.01")  # ours: equality tolerance for the total check


@dataclass(frozen=True)
class Condition:
    field: str
    operator: str
    value: object = None
    value_ref: str | None = None


@dataclass(frozen=True)
class Level:
    name: str
    threshold: object
    message: str
    action: str
    amount: object = None  # second condition of a two-condition level


@dataclass(frozen=True)
class Rule:
    name: str
    enabled: bool
    metric: str
    conditions: tuple[Condition, ...]
    levels: tuple[Level, ...] = field(default_factory=tuple)
    direction: str = "ge"  # "ge": metric >= level; "lt": metric < level
    frame: str = ""  # the rows the ladder judges
    filter_frame: str = ""  # the rows the conditions filter (the frame's own, or those it is made of)
    key: tuple[str, ...] = ()
    values: dict[str, tuple[str, ...]] = field(default_factory=dict)  # template field -> column[, format]
    amount_field: str | None = None


def load_rules(path: str = os.path.join(os.path.dirname(os.path.abspath(__file__)), "conf", "alert_rules.json")) -> tuple[Rule, ...]:
    """Alert rules of a rule file; decimal thresholds stay exact."""
    with open(path, encoding="utf-8") as f:
        declared = json.load(f, parse_float=Decimal)["rules"]
    out = []
    for r in declared:
        r = dict(r)
        r["conditions"] = tuple(Condition(**c) for c in r["conditions"])
        r["levels"] = tuple(Level(**lv) for lv in r.get("levels", ()))
        r["key"] = tuple(r.get("key", ()))
        r["values"] = {k: tuple(v) for k, v in r.get("values", {}).items()}
        r["filter_frame"] = r.get("filter_frame") or r.get("frame", "")
        out.append(Rule(**r))
    return tuple(out)


ALERT_RULES = load_rules()


@dataclass(frozen=True)
class Benchmarks:
    """Benchmarks of one industry."""
    margins: dict[str, Decimal]  # healthy, acceptable, critical
    turnover_days: int
    slow_moving_days: int
    credit_terms: dict[str, int]
    seasons: tuple[tuple[str, tuple[int, ...], Decimal], ...] = ()
    category_margins: dict[str, tuple[Decimal, Decimal]] = field(default_factory=dict)  # category -> (target, minimum)
    category_turnover_days: dict[str, int] = field(default_factory=dict)
    credit_score_weights: dict[str, Decimal] = field(default_factory=dict)

    def __post_init__(self):
        m = self.margins
        if set(m) != {"healthy", "acceptable", "critical"} or not m["healthy"] >= m["acceptable"] >= m["critical"]:
            raise ValueError(f"margins must fall from healthy over acceptable to critical: {m}")
        months = [x for _, ms, _ in self.seasons for x in ms]
        if len(months) != len(set(months)) or not set(months) <= set(range(1, 13)):
            raise ValueError(f"a month stands in one season only: {months}")
        for c, (target, least) in self.category_margins.items():
            if least > target:
                raise ValueError(f"minimum margin of {c} is above its target")
        if self.credit_score_weights and sum(self.credit_score_weights.values()) != 1:
            raise ValueError("credit score weights must add up to 1")


def load_benchmarks(path: str = os.path.join(os.path.dirname(os.path.abspath(__file__)), "conf", "benchmarks.json")) -> dict[str, Benchmarks]:
    """Benchmarks by industry of a benchmark file, checked; an industry without
    category values, seasons or weights takes those of its ``categories_of``."""
    with open(path, encoding="utf-8") as f:
        declared = json.load(f, parse_float=Decimal)["industries"]
    out = {}
    for name, own in declared.items():
        b = declared[own["categories_of"]] | own if "categories_of" in own else own
        out[name] = Benchmarks(
            margins=b["margins"], turnover_days=b["turnover_days"], slow_moving_days=b["slow_moving_days"], credit_terms=b["credit_terms"],
            seasons=tuple((k, tuple(v["months"]), Decimal(v["multiplier"])) for k, v in b.get("seasons", {}).items()),
            category_margins={k: (Decimal(v[0]), Decimal(v[1])) for k, v in b.get("category_margins", {}).items()},
            category_turnover_days=b.get("category_turnover_days", {}), credit_score_weights=b.get("credit_score_weights", {}))
    return out


BENCHMARKS = load_benchmarks()
PUMPS, GENERAL = BENCHMARKS["pump_distributor"], BENCHMARKS["general_distributor"]
SEASONS, CATEGORY_MARGINS, MARGIN_BANDS = PUMPS.seasons, PUMPS.category_margins, PUMPS.margins
TURNOVER_TARGET_DAYS = {k: b.turnover_days for k, b in BENCHMARKS.items()}
CATEGORY_TURNOVER_DAYS, SLOW_MOVING_DAYS = PUMPS.category_turnover_days, PUMPS.slow_moving_days
CREDIT_TERMS, CREDIT_SCORE_WEIGHTS = PUMPS.credit_terms, PUMPS.credit_score_weights
THRESHOLD_VARIANTS = {
    "dead_stock": {"critical": 180, "high": 120, "medium": 90, "low": 60},
    "credit_risk": {"critical_days": 90, "critical_amount": 100000, "high_days": 60,
                    "high_amount": 50000, "medium_days": 30},
}
DIGEST_MAX_PER_GROUP = 3
DIGEST_MAX_PER_MESSAGE = 5
COST_IMPUTE_FACTOR = Decimal("0.8")
