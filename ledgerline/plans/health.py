"""Health accrual: fresh business and renewals, lead-level and partner-month summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import add_months, month_start_sql, renewal_lock_sql, window_sql
from ..functions.text import isin_sql
from ..operators.joins import counted_lookup, one_key
from ..operators.ladders import HEALTH_INSURER_CLASSES, OTHERS, classify_sql, health_fresh_rules, ladder_sql
from ..operators.partners import attach_partner
from ..sources.catalog import Catalog
from .common import (BOOKING_CALENDAR, Rules, apply_rules, compliance_sql, credited_sql, deal_flag_sql, exact_credited,
                     fact_in_sql, fact_rows, finish, flag_sql, head_columns, in_period_sql, ints, join_deal_count,
                     join_verification_count, summarize, weighted, with_copies)

PRODUCT = "Health"
HEALTH_WEIGHT = 4.0
# Products whose fresh bookings need a verification record
VERIFIED_PRODUCTS = (190, 130, 224)


def health_bt_sql(variant: C.Variant) -> str:
    """Business-type class: New / Port (/ Renewal in the summary rules); else NULL."""
    arms = [f"WHEN {isin_sql('BusinessType', C.HEALTH_NEW_TYPES)} THEN 'New'",
            f"WHEN {isin_sql('BusinessType', C.HEALTH_PORT_TYPES)} THEN 'Port'"]
    if variant.health_bt_renewal_arm:
        arms.append(f"WHEN {isin_sql('BusinessType', ('Renewal',))} THEN 'Renewal'")
    return f"CASE {' '.join(arms)} END"


def join_sum_insured(df: DataFrame, cat: Catalog) -> DataFrame:
    """Left join of the health booking details on (lead, product) for SumInsured."""
    d = cat.table("booking_details").where(F.col("ProductID").isin(list(C.HEALTH_FRESH_PRODUCTS))).select(
        F.col("LEADID").alias("_si_lead"), F.col("ProductID").alias("_si_prod"), "SumInsured")
    return counted_lookup(df, d, ["leadid", "ProductId"], ["_si_lead", "_si_prod"], "_n_si")


def _credits(*issued: str) -> Rules:
    return [
        {"Accrual_Net_Booked": credited_sql("Accrual_Net_Ins", "special_deal_flag"),
         "Accrual_Net": credited_sql("Accrual_Net_Ins", *issued, "special_deal_flag"),
         "Accrual_Net_C": credited_sql("Accrual_Net_Ins", *issued, "special_deal_flag", "compliance_flag")},
        {"W_Net_Booked": f"Accrual_Net_Booked * {HEALTH_WEIGHT}D", "W_Net": f"Accrual_Net * {HEALTH_WEIGHT}D",
         "W_Net_C": f"Accrual_Net_C * {HEALTH_WEIGHT}D"},
    ]


# -- fresh -------------------------------------------------------------------------

def fresh_predicate(fact: DataFrame, cfg: C.ReportConfig) -> str:
    return in_period_sql(
        fact, C.HEALTH_FRESH_PRODUCTS, cfg.period.min_date, cfg.period.max_date,
        f"NOT ({fact_in_sql(fact, 'BusinessType', ('Renewal',))}) AND StatusId IN ({ints(C.HEALTH_FRESH_STATUS_IDS)})")


def fresh_line_rules(v: C.Variant) -> Rules:
    psu = "health_insurers = 'PSU'" + (" AND Product_updated <> 3" if v.hf_psu_keeps_product3 else "")
    return [
        BOOKING_CALENDAR | {
            "product_name": f"'{PRODUCT}'",
            "bt": "'Health_Fresh'",
            "pd": "'Health_Fresh'",
            "Product_updated": "ProductId",
            "special_deal_flag": deal_flag_sql(),
            "Health_bt": health_bt_sql(v),
            "netpr": "APE",
            "policy_booked_flag": "1",
            "policy_issued_flag": flag_sql(f"StatusId IN ({ints(C.HEALTH_ISSUED_STATUS_IDS)})"),
            "health_insurers": classify_sql(HEALTH_INSURER_CLASSES, OTHERS),
            "compliance_flag": compliance_sql(v),
        },
        {
            # verified row -> 1; none, for the verified products and New/Port business -> 0
            "policy_verified_flag": "CASE WHEN _n_ver IS NOT NULL THEN 1 "
                                    f"WHEN Product_updated IN ({ints(VERIFIED_PRODUCTS)}) AND {isin_sql('Health_bt', ('New', 'Port'))} "
                                    "THEN 0 ELSE 1 END",
            "Accrual_Net_Pr": ladder_sql(health_fresh_rules(), "netpr"),
        },
        {"Accrual_Net_Ins": f"CASE WHEN {psu} THEN Accrual_Net_Pr * 0 ELSE Accrual_Net_Pr END"},
        *_credits("policy_issued_flag", "policy_verified_flag"),
    ]


def health_fresh_detail(cat: Catalog, cfg: C.ReportConfig, by_status: bool = False) -> DataFrame:
    fact = cat.table("bookings")
    b = attach_partner(fact_rows(fact, fresh_predicate(fact, cfg)), cat, cfg)
    b = join_deal_count(join_verification_count(b, cat, by_status), cat, cfg, PRODUCT)
    t = apply_rules(join_sum_insured(b, cat), fresh_line_rules(cfg.variant))
    return with_copies(t, "_n_ver", "_n_deal", "_n_si")


# The report's columns in its order.
def health_fresh_columns(v: C.Variant) -> list[str]:
    return head_columns(v) + [
        "IsComplianceN", "compliance_flag", "leadid", "TotalPremium", "APE", "netpr", "SumInsured", "Insurer Name",
        "BookingDate", "MON", "Status", "StatusId", "Product_updated", "product_name", "bt", "Qtr_Locking_Date",
        "Health_bt", "policy_booked_flag", "policy_issued_flag", "policy_verified_flag", "special_deal_flag",
        "Accrual_Net_Pr", "Accrual_Net_Ins", "Accrual_Net_Booked", "Accrual_Net", "Accrual_Net_C",
        "W_Net_Booked", "W_Net", "W_Net_C",
    ]


def health_fresh_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return finish(health_fresh_detail(cat, cfg, condition is not None), health_fresh_columns(cfg.variant), condition, cfg.copy_tasks)


def _summary(t: DataFrame, label: str, *issued: str, condition: Column | None = None) -> DataFrame:
    t = t.withColumns({
        "_booked": exact_credited("Accrual_Net_Ins", "special_deal_flag"),
        "_net": exact_credited("Accrual_Net_Ins", *issued, "special_deal_flag"),
    })
    return summarize(t, label, {
        "TotalPremium": weighted("TotalPremium"),
        "APE": weighted("APE"),
        "Net_Pr": weighted("netpr"),
        "Accrual_Net_Booked": F.col("_booked"),
        "Accrual_Net": F.col("_net"),
        "Accrual_Net_C": F.when(F.col("compliance_flag") == 1, F.col("_net")).otherwise(F.lit(0)),
    }, condition)


def health_fresh_summary(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return _summary(health_fresh_detail(cat, cfg), "Health_Fresh", "policy_issued_flag", "policy_verified_flag",
                    condition=condition)


# -- renewal -----------------------------------------------------------------------

def renewal_window(period: C.Period) -> tuple[dt.date, dt.date]:
    """Renewal bookings count from two months before the period to 1 month + 15 days
    after its end (renewals are booked around the prior policy's end)."""
    lo = add_months(period.min_date, -2)
    hi = add_months(period.max_date, 1) + dt.timedelta(days=15)
    return lo, hi


def edge_slices(cat: Catalog, asked: int | None = None) -> int:
    """Slices of the edges of one referral: as many as the session has shuffle partitions, unless asked."""
    return asked or int(cat.spark.conf.get("spark.sql.shuffle.partitions"))


def met_edges(cat: Catalog, prior: DataFrame, slices: int) -> DataFrame:
    """Referral edges (counted) with the ``prior`` policies they refer to: ``_ref_lead, _ref_id``,
    the columns of ``prior`` and ``_n``, the number of (edge, policy) pairs.

    An edge belongs to a slice of its referral, by the referring lead. The slices that a
    referral has are collected per referral (combined map-side, one row each, at most ``slices`` values), and a
    prior policy is repeated for those only: most referrals have one edge and one slice, one that holds a third
    of all edges has them all, and its edges meet its policies in as many tasks. Prior policies
    that nobody refers to drop out on the way."""
    edges = cat.table("lead_referral").where("LeadID IS NOT NULL AND ReferralID IS NOT NULL") \
        .groupBy(F.col("LeadID").alias("_ref_lead"), F.col("ReferralID").alias("_ref_id")).agg(F.count(F.lit(1)).alias("_n_ref")) \
        .withColumn("_slice", F.expr(f"pmod(xxhash64(_ref_lead), {int(slices)})"))
    some = edges.groupBy(F.col("_ref_id").alias("_some")).agg(F.collect_set("_slice").alias("_slices"))
    sliced = some.join(prior, F.expr("_some = _prev_lead"), "inner").withColumn("_prev_slice", F.explode("_slices")).drop("_some", "_slices")
    met = edges.join(sliced, F.expr(f"{one_key('_ref_id', '_slice')} = {one_key('_prev_lead', '_prev_slice')}"), "inner")
    return met.withColumn("_n", F.expr("_n_ref * _n_pol")).drop("_slice", "_prev_slice", "_n_ref", "_n_pol")


def counted_policies(fact: DataFrame, condition: str = "true") -> DataFrame:
    """``_prev_lead, _prev_end, _n_pol`` of the bookings that fit."""
    return fact.where(f"{condition} AND leadid IS NOT NULL").groupBy(
        F.col("leadid").alias("_prev_lead"), F.col("PolicyEndDate").alias("_prev_end")).agg(F.count(F.lit(1)).alias("_n_pol"))


def prior_policies(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Per renewing lead, the prior policies that ended inside the period:
    ``_ref_lead, _prev_end`` and the number of (edge, policy) pairs, ``_n_prev``.

    booking -(leadid = LeadID)-> referral edge -(ReferralID = leadid)-> prior booking. The
    booking stream is shuffled by lead id alone, for this and for all its lookups."""
    p = cfg.period
    prior = counted_policies(cat.table("bookings"), window_sql("PolicyEndDate", p.min_date, p.max_date))
    met = met_edges(cat, prior, edge_slices(cat, cfg.salts))
    return met.groupBy("_ref_lead", "_prev_end").agg(F.sum("_n").alias("_n_prev"))


def renewal_predicate(fact: DataFrame, cfg: C.ReportConfig) -> str:
    lo, hi = renewal_window(cfg.period)
    return in_period_sql(
        fact, C.HEALTH_RENEWAL_PRODUCTS, lo, hi,
        f"{fact_in_sql(fact, 'BusinessType', ('Renewal',))} AND StatusId IN ({ints(C.RENEWAL_STATUS_IDS)})")


#: Renewals booked more than three months before the prior end are early; the booking keeps
#: its time of day: month arithmetic on the timestamp, not on a date.
NOT_EARLY = "BookingDate >= _prev_end - INTERVAL 3 MONTHS"


def renewal_line_rules(v: C.Variant) -> Rules:
    return [
        {
            "MON": month_start_sql("_prev_end"),
            "Qtr_Locking_Date": renewal_lock_sql("_prev_end", "BookingDate"),
            "Prev_end_date": "CAST(_prev_end AS DATE)",
            "product_name": f"'{PRODUCT}'",
            "bt": "'Health_Renewal'",
            "Product_updated": "ProductId",
            "special_deal_flag": deal_flag_sql(),
            "Health_bt": "'Renewal'",
            "netpr": "APE",
            "policy_issued_flag": flag_sql(f"StatusId IN ({ints(C.HEALTH_ISSUED_STATUS_IDS)})"),
            "health_insurers": classify_sql(HEALTH_INSURER_CLASSES, OTHERS),
            "compliance_flag": compliance_sql(v),
        },
        {"Accrual_Net_Ins": "CASE WHEN health_insurers = 'PSU' THEN 0 ELSE netpr END"},
        *_credits("policy_issued_flag"),
    ]


def health_renewal_detail(cat: Catalog, cfg: C.ReportConfig, by_status: bool = False) -> DataFrame:
    """Renewal bookings of the partner universe joined to their prior policies, the most
    selective join, before any enrichment."""
    fact = cat.table("bookings")
    j = attach_partner(fact_rows(fact, renewal_predicate(fact, cfg)), cat, cfg)
    j = j.join(prior_policies(cat, cfg), F.expr("leadid = _ref_lead"), "inner")
    if cfg.variant.renewal_early_guard:
        j = j.where(NOT_EARLY)
    j = join_deal_count(join_verification_count(j, cat, by_status), cat, cfg, PRODUCT)
    t = apply_rules(join_sum_insured(j, cat), renewal_line_rules(cfg.variant))
    return with_copies(t, "_n_ver", "_n_deal", "_n_si", "_n_prev")


# The report's columns in its order.
def health_renewal_columns(v: C.Variant) -> list[str]:
    return head_columns(v) + [
        "IsComplianceN", "compliance_flag", "leadid", "TotalPremium", "APE", "netpr", "SumInsured", "Insurer Name",
        "BookingDate", "MON", "Status", "StatusId", "Product_updated", "product_name", "bt", "Qtr_Locking_Date",
        "Prev_end_date", "Health_bt", "policy_issued_flag", "special_deal_flag", "Accrual_Net_Ins",
        "Accrual_Net_Booked", "Accrual_Net", "Accrual_Net_C", "W_Net_Booked", "W_Net", "W_Net_C",
    ]


def health_renewal_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return finish(health_renewal_detail(cat, cfg, condition is not None), health_renewal_columns(cfg.variant), condition, cfg.copy_tasks)


def health_renewal_summary(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return _summary(health_renewal_detail(cat, cfg), "Health_Renewal", "policy_issued_flag", condition=condition)
