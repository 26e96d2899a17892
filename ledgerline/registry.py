"""Registered reports over the test catalog (used by ``__spark_entry__`` and bench).

Every query derives the report tables from the given star-schema parquet files with
Spark (``sources.fixtures``), then runs one report over the whole derived tables.
The fixture configuration (period 1997, invented market/team lists) is the one
FIXTURES.md prescribes. ``run(name, catalog)`` runs the same report on any catalog,
e.g. the derived tables stored as parquet.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config as C
from .sources.catalog import Catalog
from .sources.fixtures import fixture_catalog

FIXTURE_YEAR = 1997
FIXTURE_LISTS = C.PartnerLists(
    legacy_allowed_markets=("Region A", "Region B", "Others"),
    legacy_other_excluded=("Region A", "Region B", "Others", "Fleets", "Strategic Motor"),
    vertical_motor_markets=("Region A", "Region B", "Others", "Fleets", "Institutional", "PRIME", "Strategic Motor"),
    vertical_health_teams=("Health Team 1", "Health Team 2"),
    vertical_life_teams=("Life Team",),
)
AS_OF = dt.date(1997, 11, 15)


def fixture_config(variant: C.Variant = C.CURRENT, period: C.Period | None = None) -> C.ReportConfig:
    if period is None:
        period = C.Period.quarter(FIXTURE_YEAR, 1) if variant.name in ("summary", "legacy") else C.Period.year(FIXTURE_YEAR)
    return C.ReportConfig(period=period, variant=variant, lists=FIXTURE_LISTS, as_of=AS_OF)


@dataclass(frozen=True)
class Spec:
    fn: Callable
    variant: C.Variant = C.CURRENT
    period: C.Period | None = None
    kwargs: dict = field(default_factory=dict)

    def run(self, cat: Catalog) -> DataFrame:
        return self.fn(cat, fixture_config(self.variant, self.period), **self.kwargs)


def specs() -> dict[str, Spec]:
    from .functions.text import eq
    from .operators import deals, partners
    from .plans import annual, combine, health, life, motor, parts, persistency, sme

    out: dict[str, Spec] = {}
    lines = {
        "sme": (sme.sme_leads, sme.sme_summary),
        "motor": (motor.motor_leads, motor.motor_summary),
        "health_fresh": (health.health_fresh_leads, health.health_fresh_summary),
        "health_renewal": (health.health_renewal_leads, health.health_renewal_summary),
        "life": (life.life_leads, life.life_summary),
    }
    for name, (leads, summary) in lines.items():
        out[f"{name}_leads"] = Spec(leads)
        # the legacy health-renewal report keeps the full-year window
        legacy_period = C.Period.year(FIXTURE_YEAR) if name == "health_renewal" else None
        out[f"{name}_leads_legacy"] = Spec(leads, C.LEGACY, legacy_period)
        out[f"{name}_leads_no_sell_now"] = Spec(leads, C.NO_SELL_NOW)
        out[f"{name}_summary"] = Spec(summary, C.SUMMARY)
    for i, tag in enumerate(("jfm", "amj", "jas", "ond"), start=1):
        out[f"motor_leads_{tag}"] = Spec(motor.motor_leads, C.CURRENT, C.Period.quarter(FIXTURE_YEAR, i))
    out.update({
        "partner_universe": Spec(partners.partner_universe),
        "partner_universe_legacy": Spec(partners.partner_universe_legacy, C.LEGACY),
        "partner_vertical": Spec(partners.partner_vertical),
        "special_deals": Spec(deals.special_deals),
        "qtr_locking_date": Spec(lambda cat, cfg: parts.booking_calendar(cat)),
        "renewal_locking_date": Spec(lambda cat, cfg: parts.renewal_calendar(cat)),
        "motor_status_flags": Spec(parts.motor_status_flags),
        "life_plan_enrichment": Spec(parts.life_plan_enrichment),
        "health_persistency": Spec(persistency.health_persistency),
        "annual_clubs": Spec(lambda cat, cfg: annual.annual_clubs(cat, FIXTURE_YEAR)),
        # the annual report has no placeholder: the condition wraps its output columns
        "annual_clubs_condition": Spec(
            lambda cat, cfg: annual.annual_clubs(cat, FIXTURE_YEAR, condition=F.expr("Crown_Count >= 1"))),
        "combined_leads": Spec(combine.combined_leads),
        "combined_leads_shared_scan": Spec(combine.combined_leads, kwargs={"shared_scan": True}),
        # one caller condition applied to every line before consolidation
        "combined_leads_condition": Spec(
            lambda cat, cfg: combine.combined_leads(cat, cfg, condition=eq("BookingMode", "Online"))),
        # persistency's condition sees its output columns, the quarter rank included
        "health_persistency_condition": Spec(
            lambda cat, cfg: persistency.health_persistency(cat, cfg, condition=F.expr("rnk = 1"))),
        # caller condition on a pre-projection column (BookingMode is not an output column)
        "condition_pushdown": Spec(
            lambda cat, cfg: health.health_fresh_leads(cat, cfg, condition=eq("BookingMode", "Online"))),
    })
    out["run_reports"] = Spec(combine.report_totals)
    out.update({
        # conditions on columns that only the marker sees, and on summaries and the vertical
        "health_fresh_leads_verified": Spec(
            lambda cat, cfg: health.health_fresh_leads(cat, cfg, condition=eq("VerificationStatus", "Verified"))),
        "motor_leads_od": Spec(
            lambda cat, cfg: motor.motor_leads(cat, cfg, condition=F.expr("od_netpr > tp_netpr AND MatrixLeadId IS NULL"))),
        "motor_summary_condition": Spec(
            lambda cat, cfg: motor.motor_summary(cat, cfg, condition=F.expr("motor_cancelled >= 1")), C.SUMMARY),
        "partner_vertical_condition": Spec(
            lambda cat, cfg: partners.partner_vertical(cat, cfg, condition=F.expr("Vertical = 'Motor'"))),
    })
    return out


Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    def wrap(spec: Spec) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return spec.run(fixture_catalog(spark, sf_dir))

        return run

    return {name: wrap(spec) for name, spec in specs().items()}


def run(name: str, cat: Catalog) -> DataFrame:
    return specs()[name].run(cat)
