"""Life accrual: lead-level report and partner-month summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import isin_sql, key
from ..operators.joins import counted_lookup, join_dimension
from ..operators.ladders import LIFE_INSURER_CLASSES, OTHERS, classify_sql, ladder_sql, life_rules
from ..operators.partners import attach_partner
from ..sources.catalog import Catalog
from .common import (BOOKING_CALENDAR, Rules, apply_rules, compliance_sql, credited_sql, deal_flag_sql, exact_credited,
                     fact_in_sql, fact_rows, finish, flag_sql, head_columns, in_period_sql, ints, join_deal_count,
                     summarize, weighted, with_copies)

PRODUCT = "Life"
LIFE_WEIGHT = 1.5
#: What a life lead takes from its booking details, besides the keys of its plan.
DETAIL_VALUES = ("BasicPremium", "PaymentPeriodicity", "CAST(issuanceDate AS DATE) AS issuanceDate")


def life_details_filter(v: C.Variant) -> str:
    """Booking details rows that life leads look up."""
    return f"ProductID IN ({ints(C.LIFE_PRODUCTS)})" if v.life_details_product_filter else "true"


def join_plan_details(df: DataFrame, cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Left join of the leads' booking details (counted, ``_n_bp``), then of their plans."""
    d = cat.table("booking_details").where(life_details_filter(cfg.variant)).selectExpr(
        "LEADID AS _bp_lead", "PlanId", "SupplierId", "ProductID AS _bp_prod", *DETAIL_VALUES)
    return join_plans(counted_lookup(df, d, ["leadid"], ["_bp_lead"], "_n_bp"), cat, cfg)


def join_plans(df: DataFrame, cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Left join of the payout category by (``PlanId``, ``_bp_prod``, ``SupplierId``).

    The catalogue is de-duplicated under the collation (of spellings that differ in case or
    trailing blanks the smallest remains). It is joined after the details have met their leads, so only
    the period's details take part."""
    plans = cat.table("life_plans").groupBy(
        F.col("PlanID").alias("_plan"), F.col("ProductID").alias("_product"), F.col("SupplierID").alias("_supplier"),
        key("PayoutProdCat").alias("_category")).agg(F.min("PayoutProdCat").alias("PayoutProdCat"))
    key_of = {"PlanId": "_plan", "_bp_prod": "_product", "SupplierId": "_supplier"}
    out = join_dimension(df, plans, key_of, "left", "leadid", cfg.salts)
    return out.drop("_plan", "_product", "_supplier", "_category", "PlanId", "_bp_prod", "SupplierId")


def life_predicate(fact: DataFrame, cfg: C.ReportConfig) -> str:
    return in_period_sql(fact, C.LIFE_PRODUCTS, cfg.period.min_date, cfg.period.max_date, fact_in_sql(fact, "Status", C.LIFE_STATUSES))


def life_line_rules(v: C.Variant) -> Rules:
    issued = ("policy_issued_flag", "policy_verified_flag")
    return [
        BOOKING_CALENDAR | {
            "product_name": f"'{PRODUCT}'",
            "Product_updated": "ProductId",
            "special_deal_flag": deal_flag_sql(),
            "netpr": "BasicPremium",
            "policy_issued_flag": flag_sql(isin_sql("Status", C.LIFE_ISSUED_STATUSES)),
            "policy_verified_flag": "1",
            "life_insurers": classify_sql(LIFE_INSURER_CLASSES, OTHERS),
            "compliance_flag": compliance_sql(v),
        },
        {"Accrual_Net_Pr": ladder_sql(life_rules(), "netpr")},
        {"Accrual_Net_Ins": "CASE WHEN life_insurers = 'PSU' THEN 0 WHEN life_insurers = 'Pvt' THEN Accrual_Net_Pr "
                            f"WHEN life_insurers = '{OTHERS}' THEN Accrual_Net_Pr * 0.75 ELSE Accrual_Net_Pr END"},
        {"Accrual_Net_Booked": credited_sql("Accrual_Net_Ins", "special_deal_flag"),
         "Accrual_Net": credited_sql("Accrual_Net_Ins", *issued, "special_deal_flag"),
         "Accrual_Net_C": credited_sql("Accrual_Net_Ins", *issued, "special_deal_flag", "compliance_flag")},
        {"W_Net_Booked": f"Accrual_Net_Booked * {LIFE_WEIGHT}D", "W_Net": f"Accrual_Net * {LIFE_WEIGHT}D",
         "W_Net_C": f"Accrual_Net_C * {LIFE_WEIGHT}D"},
    ]


def join_pay_term(df: DataFrame, cat: Catalog, only: str = "") -> DataFrame:
    pt = cat.table("pay_term").selectExpr("LeadId AS _pt_lead", "PayTerm")
    return counted_lookup(df, pt, ["leadid"], ["_pt_lead"], "_n_pt", only)


def life_detail(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    fact = cat.table("bookings")
    b = attach_partner(fact_rows(fact, life_predicate(fact, cfg)), cat, cfg)
    b = join_deal_count(join_pay_term(b, cat), cat, cfg, PRODUCT)
    t = apply_rules(join_plan_details(b, cat, cfg), life_line_rules(cfg.variant))
    return with_copies(t, "_n_deal", "_n_bp", "_n_pt")


# The report's columns in its order.
def life_columns(v: C.Variant) -> list[str]:
    return head_columns(v) + [
        "IsComplianceN", "compliance_flag", "leadid", "TotalPremium", "APE", "netpr", "PaymentPeriodicity",
        "PayoutProdCat", "PayTerm", "Insurer Name", "BookingDate", "MON", "Status", "StatusId", "Product_updated",
        "product_name", "Qtr_Locking_Date", "policy_issued_flag", "policy_verified_flag", "special_deal_flag",
        "Accrual_Net_Pr", "Accrual_Net_Ins", "Accrual_Net_Booked", "Accrual_Net", "Accrual_Net_C",
        "W_Net_Booked", "W_Net", "W_Net_C",
    ]


def life_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return finish(life_detail(cat, cfg), life_columns(cfg.variant), condition, cfg.copy_tasks)


def life_summary(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    t = life_detail(cat, cfg).withColumns({
        "_booked": exact_credited("Accrual_Net_Ins", "special_deal_flag"),
        "_net": exact_credited("Accrual_Net_Ins", "policy_issued_flag", "special_deal_flag"),
    })
    return summarize(t, PRODUCT, {
        "TotalPremium": weighted("TotalPremium"),
        "APE": weighted("APE"),
        "Net_Pr": weighted("netpr"),
        "Accrual_Net_Booked": F.col("_booked"),
        "Accrual_Net": F.col("_net"),
        "Accrual_Net_C": F.when(F.col("compliance_flag") == 1, F.col("_net")).otherwise(F.lit(0)),
    }, condition)
