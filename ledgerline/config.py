"""Report parameters: the period, the rule-version presets and the partner lists.

Everything a report needs besides the tables lives here, so that one implementation
serves every rule version (`Variant`) and every reporting window (`Period`).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Period:
    """Half-open reporting window ``[min_date, max_date)``."""

    min_date: dt.date
    max_date: dt.date

    @staticmethod
    def of(min_date: str, max_date: str) -> "Period":
        return Period(dt.date.fromisoformat(min_date), dt.date.fromisoformat(max_date))

    @staticmethod
    def year(y: int) -> "Period":
        return Period(dt.date(y, 1, 1), dt.date(y + 1, 1, 1))

    @staticmethod
    def quarter(y: int, q: int) -> "Period":
        start = dt.date(y, 3 * (q - 1) + 1, 1)
        end = dt.date(y + 1, 1, 1) if q == 4 else dt.date(y, 3 * q + 1, 1)
        return Period(start, end)


@dataclass(frozen=True)
class Variant:
    """One rule version of the lead-level / summary reports.

    Each flag is one line of the variant matrix: the presets below differ only here.
    """

    name: str
    # special deals: only rows with IsActive = 1 count
    deals_active_only: bool = True
    # partner universe: "current" (IP prefix, market exclusions, inclusion list)
    # or "legacy" (SellNow + market lists + SalesCat exclusions)
    legacy_universe: bool = False
    # motor: drop bookings whose Leadsource is the excluded direct channel
    motor_exclude_lead_source: bool = True
    # motor: taxi remap needs SubProduct NULL for the VehicleSubClass test
    taxi_strict: bool = False
    # motor rule 18 (two-wheeler, TP only, offline): factor
    tw_tp_offline_factor: str = "0"
    # health fresh: PSU insurer zeroes the credit except for product 3
    hf_psu_keeps_product3: bool = True
    # health fresh: the 'Renewal' arm of the business-type classes is active
    health_bt_renewal_arm: bool = False
    # compliance flag also needs ComplianceCertified = Yes
    compliance_needs_certificate: bool = False
    # renewal: drop bookings made more than three months before the prior end date
    renewal_early_guard: bool = True
    # Markettype is part of the lead-level output
    markettype_in_output: bool = True
    # life: booking details restricted to life products before the join
    life_details_product_filter: bool = True


CURRENT = Variant("current")
NO_SELL_NOW = replace(CURRENT, name="no_sell_now", deals_active_only=False, renewal_early_guard=False)
LEGACY = Variant(
    "legacy",
    deals_active_only=False,
    legacy_universe=True,
    motor_exclude_lead_source=True,
    taxi_strict=True,
    tw_tp_offline_factor="0",
    hf_psu_keeps_product3=True,
    compliance_needs_certificate=True,
    renewal_early_guard=False,
    markettype_in_output=False,
)
SUMMARY = Variant(
    "summary",
    deals_active_only=False,
    legacy_universe=True,
    motor_exclude_lead_source=False,
    taxi_strict=True,
    tw_tp_offline_factor="1",
    hf_psu_keeps_product3=False,
    health_bt_renewal_arm=True,
    compliance_needs_certificate=True,
    renewal_early_guard=False,
    markettype_in_output=False,
    life_details_product_filter=False,
)
VARIANTS = {v.name: v for v in (CURRENT, NO_SELL_NOW, LEGACY, SUMMARY)}


# ---------------------------------------------------------------------------
# These must equal the reference's for right results.
# Product ids, status ids and status names, in the order the reports list them.
# ---------------------------------------------------------------------------
MOTOR_PRODUCTS = (186, 187, 188)
HEALTH_FRESH_PRODUCTS = (3, 106, 118, 130, 138, 144, 189, 190, 147, 224)
HEALTH_RENEWAL_PRODUCTS = (130, 190, 224)
LIFE_PRODUCTS = (7, 115, 200)
SME_PRODUCTS = (193, 194, 221)
HEALTH_FRESH_STATUS_IDS = (13, 39, 41, 42, 43, 44, 77)
HEALTH_ISSUED_STATUS_IDS = (41, 42, 44)
RENEWAL_STATUS_IDS = (41, 42, 43, 44)
PERSISTENCY_STATUS_IDS = (13, 41, 42, 43, 44)
LIFE_STATUSES = ("Booked", "Policy Issued", "Sale Complete", "Soft Copy Received")
LIFE_ISSUED_STATUSES = ("Policy Issued", "Sale Complete", "Soft Copy Received")
SME_STATUSES = ("Booked", "Sale Complete")
MOTOR_EXCLUDED_LEAD_SOURCE = "B2CMRP"
HEALTH_NEW_TYPES = ("Fresh Booking", "New", "NEW BUSINESS", "Fresh")
HEALTH_PORT_TYPES = ("Fresh Port", "New Port", "Rollover Port", "Rollover")
MOTOR_NEW_TYPES = ("New", "Rollover")
CURRENT_EXCLUDED_MARKETS = ("Fleets", "Institutional", "PRIME", "Strategic Motor")
LEGACY_SALESCAT_EXCLUDED = ("prime", "Strategic Motor", "Fleets")
LEGACY_OTHER_SALESCAT_EXCLUDED = ("prime", "Strategic Motor", "Fleets", "Others")
PARTNER_CODE_PREFIX = "IP%"
# Quarter labels used by persistency and the annual calculation.
QUARTER_LABELS = ("Q1-JFM", "Q2-AMJ", "Q3-JAS", "Q4-OND")


@dataclass(frozen=True)
class PartnerLists:
    """Market / team lists. Real lists name people, so they are configuration.

    ``legacy_allowed_markets``: markets whose partners pass the legacy "motor" arm.
    ``legacy_other_excluded``: markets excluded from the legacy "other" arm.
    ``vertical_motor_markets``, ``vertical_health_teams``, ``vertical_life_teams``:
    the partner-vertical classification lists.
    """

    legacy_allowed_markets: tuple[str, ...] = ()
    legacy_other_excluded: tuple[str, ...] = ()
    vertical_motor_markets: tuple[str, ...] = ()
    vertical_health_teams: tuple[str, ...] = ()
    vertical_life_teams: tuple[str, ...] = ()


@dataclass(frozen=True)
class ReportConfig:
    """Everything a report run needs besides the catalog."""

    period: Period
    variant: Variant = CURRENT
    lists: PartnerLists = field(default_factory=PartnerLists)
    # renewal / persistency "today" (the reference reads the clock)
    as_of: dt.date | None = None
    # tasks over which one partner, status or plan is spread (None: see joins.salt_width)
    salts: int | None = None
    # tasks over which the copies of one booking are spread (None: no exchange is spent on them)
    copy_tasks: int | None = None

    def with_variant(self, variant: Variant) -> "ReportConfig":
        return replace(self, variant=variant)

    def with_period(self, period: Period) -> "ReportConfig":
        return replace(self, period=period)
