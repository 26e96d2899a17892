"""SME (small business) accrual: lead-level report and partner-month summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..operators.ladders import ladder_sql, sme_rules
from ..operators.partners import attach_partner
from ..sources.catalog import Catalog
from .common import (BOOKING_CALENDAR, Rules, apply_rules, compliance_sql, credited_sql, deal_flag_sql, exact_credited,
                     fact_in_sql, fact_rows, finish, head_columns, in_period_sql, join_deal_count, summarize, weighted,
                     with_copies)

PRODUCT = "SME"
SME_WEIGHT = 1.25


def sme_predicate(fact: DataFrame, cfg: C.ReportConfig) -> str:
    return in_period_sql(fact, C.SME_PRODUCTS, cfg.period.min_date, cfg.period.max_date, fact_in_sql(fact, "Status", C.SME_STATUSES))


def sme_line_rules(v: C.Variant) -> Rules:
    return [
        BOOKING_CALENDAR | {
            "product_name": f"'{PRODUCT}'",
            "Product_updated": "ProductId",
            "special_deal_flag": deal_flag_sql(),
            "netpr": "`Net Premium`",
            "compliance_flag": compliance_sql(v),
        },
        {"Accrual_Net_Pr": ladder_sql(sme_rules(), "netpr")},
        {"Accrual_Net": credited_sql("Accrual_Net_Pr", "special_deal_flag"),
         "Accrual_Net_C": credited_sql("Accrual_Net_Pr", "special_deal_flag", "compliance_flag")},
        {"W_Net": f"Accrual_Net * {SME_WEIGHT}D", "W_Net_C": f"Accrual_Net_C * {SME_WEIGHT}D"},
    ]


def sme_detail(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """All pre-projection columns of the SME report (one row per credited lead)."""
    fact = cat.table("bookings")
    b = attach_partner(fact_rows(fact, sme_predicate(fact, cfg)), cat, cfg)
    t = apply_rules(join_deal_count(b, cat, cfg, PRODUCT), sme_line_rules(cfg.variant))
    return with_copies(t, "_n_deal")


# The report's columns in its order.
def sme_columns(v: C.Variant) -> list[str]:
    return head_columns(v) + [
        "IsComplianceN", "compliance_flag", "leadid", "TotalPremium", "APE", "netpr", "BookingDate", "MON", "Status",
        "StatusId", "Product_updated", "product_name", "PlanName", "Qtr_Locking_Date", "special_deal_flag",
        "Accrual_Net_Pr", "Accrual_Net", "Accrual_Net_C", "W_Net", "W_Net_C",
    ]


def sme_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return finish(sme_detail(cat, cfg), sme_columns(cfg.variant), condition, cfg.copy_tasks)


def sme_summary(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    """Partner x month totals; the summary multiplies the deal flag into the insurer
    amount and sums it, with the compliant share separately."""
    t = sme_detail(cat, cfg).withColumn("Accrual_Net_Ins", exact_credited("Accrual_Net_Pr", "special_deal_flag"))
    return summarize(t, PRODUCT, {
        "TotalPremium": weighted("TotalPremium"),
        "APE": weighted("APE"),
        "Net_Pr": weighted("netpr"),
        "Accrual_Net": F.col("Accrual_Net_Ins"),
        "Accrual_Net_C": F.when(F.col("compliance_flag") == 1, F.col("Accrual_Net_Ins")).otherwise(F.lit(0)),
    }, condition)
