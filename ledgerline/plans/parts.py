"""Building blocks of the reports exposed as reports of their own (for audits and
for checking each step against the oracle on whole tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import month_start, qtr_locking_date, renewal_locking_date
from ..operators.joins import expand
from ..sources.catalog import Catalog
from .health import counted_policies, edge_slices, met_edges
from .life import join_pay_term, join_plan_details
from .motor import join_status_classes


def booking_calendar(cat: Catalog) -> DataFrame:
    """Every booking with its accrual month and quarter locking date."""
    return cat.table("bookings").select(
        "leadid", "BookingDate",
        month_start("BookingDate").alias("MON"),
        qtr_locking_date("BookingDate").alias("Qtr_Locking_Date"),
    )


def renewal_calendar(cat: Catalog, slices: int | None = None, copy_tasks: int | None = None) -> DataFrame:
    """Every renewal edge (booking -> referred prior booking) with the prior end date
    and the renewal locking date (NULL when booked after the lock).

    Edges meet the prior bookings by (referral, slice of the lead), so one referral that
    very many leads share is split; equal results of one edge are a count until the end."""
    fact = cat.table("bookings")
    met = met_edges(cat, counted_policies(fact), edge_slices(cat, slices))
    j = expand(fact.select("leadid", "BookingDate").join(met, F.expr("leadid = _ref_lead"), "inner"), "_n", tasks=copy_tasks)
    return j.select(
        "leadid", F.col("_ref_id").alias("ReferralID"), "BookingDate",
        F.col("_prev_end").cast("date").alias("Prev_end_date"),
        month_start("_prev_end").alias("MON"),
        renewal_locking_date("_prev_end", "BookingDate").alias("Qtr_Locking_Date"),
    )


def motor_status_flags(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Every motor booking with the status-master classes (existence tests of the
    status id among cancellation / non-cancellation names)."""
    b = cat.table("bookings").where(F.col("ProductId").isin(list(C.MOTOR_PRODUCTS))).select("leadid", "StatusId", "Status")
    j = join_status_classes(b, cat, cfg.salts)
    return j.select(
        "leadid", "StatusId", "Status",
        F.when(F.col("_cancel") == 1, F.lit(1)).otherwise(F.lit(0)).alias("motor_cancelled_flag"),
        F.when(F.col("_booked") == 1, F.lit(1)).otherwise(F.lit(0)).alias("policy_booked_flag"),
    )


def life_plan_enrichment(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Life bookings with booking details, de-duplicated plan category and pay term."""
    b = cat.table("bookings").where(F.col("ProductId").isin(list(C.LIFE_PRODUCTS))).select("leadid", "ProductId")
    j = expand(join_plan_details(join_pay_term(b, cat), cat, cfg), "_n_bp", "_n_pt", tasks=cfg.copy_tasks)
    return j.select(
        "leadid", "ProductId", F.col("BasicPremium").cast("double").alias("BasicPremium"), "PaymentPeriodicity",
        "issuanceDate", "PayoutProdCat", "PayTerm",
    )
