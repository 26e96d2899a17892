"""Motor accrual: lead-level report and partner-month summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import isin_sql, key_sql, like
from ..operators.joins import counted_classes, join_dimension
from ..operators.ladders import MOTOR_INSURER_CLASSES, OTHERS, classify_sql, ladder_sql, motor_rules
from ..operators.partners import attach_partner
from ..sources.catalog import Catalog
from .common import (BOOKING_CALENDAR, Rules, apply_rules, compliance_sql, credited_sql, deal_flag_sql, exact_credited,
                     fact_in_sql, fact_rows, finish, flag_sql, head_columns, in_period_sql, join_deal_count, same,
                     summarize, weighted, with_copies)

PRODUCT = "Motor"


def motor_product_sql(strict: bool = False) -> str:
    """Taxi private cars (186) are credited as commercial vehicles (188)."""
    sub, veh = f"{key_sql('SubProduct')} = 'TAXI'", f"{key_sql('VehicleSubClass')} = 'TAXI'"
    if strict:
        return (f"CASE WHEN ProductId = 186 AND {sub} THEN 188 "
                f"WHEN ProductId = 186 AND SubProduct IS NULL AND {veh} THEN 188 ELSE ProductId END")
    return f"CASE WHEN ProductId = 186 AND ({sub} OR {veh}) THEN 188 ELSE ProductId END"


def join_business_type(df: DataFrame, cat: Catalog, only: str = "") -> DataFrame:
    """Left join of the leads' business types: one row per class that a lead has
    (``Motor_bt``; a NULL business type counts as Renewal) with its number of rows (``_n_bt``)."""
    new = isin_sql("MotorBusinessType", C.MOTOR_NEW_TYPES)
    one = counted_classes(cat.table("business_type"), "Leadid", {"_new": new, "_ren": f"({new}) IS NOT TRUE"})
    both = "array(named_struct('bt', 'New', 'n', _new), named_struct('bt', 'Renewal', 'n', _ren))"
    out = df.join(one, F.expr(f"leadid = _k{only}"), "left")
    out = out.withColumn("_bt", F.expr(f"explode_outer(filter({both}, x -> x.n > 0))"))
    return out.withColumns({"Motor_bt": F.expr("_bt.bt"), "_n_bt": F.expr("_bt.n")}).drop("_k", "_new", "_ren", "_bt")


def status_classes(cat: Catalog) -> DataFrame:
    """Per status id: is any of its names a cancellation ('re%'), is any not."""
    name = F.col("StatusName")
    return cat.table("status").where(F.col("StatusId").isNotNull()).groupBy(F.col("StatusId").alias("_sid")).agg(
        F.max(F.when(like(name, "re%"), F.lit(1)).otherwise(F.lit(0))).alias("_cancel"),
        F.max(F.when(~like(name, "re%"), F.lit(1)).otherwise(F.lit(0))).alias("_booked"),
    )


def join_status_classes(df: DataFrame, cat: Catalog, salts: int | None = None, only: str = "") -> DataFrame:
    """Left join to ``status_classes``; bookings share few status ids."""
    return join_dimension(df, status_classes(cat), {"StatusId": "_sid"}, "left", "leadid", salts, only).drop("_sid")


def motor_predicate(fact: DataFrame, cfg: C.ReportConfig) -> str:
    extra = None
    if cfg.variant.motor_exclude_lead_source:  # NULL is dropped, as in SQL
        extra = f"NOT ({fact_in_sql(fact, 'Leadsource', (C.MOTOR_EXCLUDED_LEAD_SOURCE,))})"
    return in_period_sql(fact, C.MOTOR_PRODUCTS, cfg.period.min_date, cfg.period.max_date, extra)


def motor_line_rules(v: C.Variant, amount: Callable[[str], str] = same) -> Rules:
    """``amount`` names the DOUBLE amounts (the other lines' are DECIMAL)."""
    net, pr, ins = amount("netpr"), amount("Accrual_Net_Pr"), amount("Accrual_Net_Ins")
    return [
        BOOKING_CALENDAR | {
            "product_name": f"'{PRODUCT}'",
            "Product_updated": motor_product_sql(v.taxi_strict),
            "special_deal_flag": deal_flag_sql(),
            # premium per term year, in DOUBLE (premium cast before dividing); no term -> 0
            "od_netpr": "CASE WHEN ODTerm > 0 THEN CAST(ODPremium AS DOUBLE) / ODTerm ELSE 0.0D END",
            "tp_netpr": "CASE WHEN TPTerm > 0 THEN CAST(TPPremium AS DOUBLE) / TPTerm ELSE 0.0D END",
            "motor_booked_flag": "1",
            "motor_cancelled_flag": flag_sql("_cancel = 1"),
            "policy_booked_flag": flag_sql("_booked = 1"),
            "motor_insurers": classify_sql(MOTOR_INSURER_CLASSES, OTHERS),
            "compliance_flag": compliance_sql(v),
        },
        {net: "od_netpr + tp_netpr"},
        {pr: ladder_sql(motor_rules(v.tw_tp_offline_factor), net)},
        {ins: f"CASE WHEN motor_insurers = 'PSU' THEN {pr} * 0.9D WHEN motor_insurers = 'Pvt' THEN {pr} * 0.75D ELSE {pr} END"},
        {"Accrual_Net": credited_sql(ins, "policy_booked_flag", "special_deal_flag"),
         "Accrual_Net_C": credited_sql(ins, "policy_booked_flag", "special_deal_flag", "compliance_flag")},
    ]


def motor_detail(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    fact = cat.table("bookings")
    b = attach_partner(fact_rows(fact, motor_predicate(fact, cfg)), cat, cfg)
    t = join_deal_count(join_business_type(b, cat), cat, cfg, PRODUCT)
    t = apply_rules(join_status_classes(t, cat, cfg.salts), motor_line_rules(cfg.variant))
    return with_copies(t, "_n_deal", "_n_bt")


# The report's columns in its order.
def motor_columns(v: C.Variant) -> list[str]:
    return head_columns(v) + [
        "IsComplianceN", "compliance_flag", "leadid", "TotalPremium", "netpr", "APE", "Insurer Name", "BookingMode",
        "BookingDate", "MON", "SubProduct", "VehicleSubClass", "ODPremium", "TPPremium", "ODTerm", "TPTerm", "Status",
        "Product_updated", "product_name", "StatusId", "Qtr_Locking_Date", "Motor_bt", "motor_booked_flag",
        "motor_cancelled_flag", "policy_booked_flag", "special_deal_flag", "Accrual_Net_Pr", "Accrual_Net_Ins",
        "Accrual_Net", "Accrual_Net_C",
    ]


def motor_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    return finish(motor_detail(cat, cfg), motor_columns(cfg.variant), condition, cfg.copy_tasks)


def motor_summary(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    t = motor_detail(cat, cfg).withColumn(
        "_net", exact_credited("Accrual_Net_Ins", "policy_booked_flag", "special_deal_flag"))
    return summarize(t, PRODUCT, {
        "TotalPremium": weighted("TotalPremium"),
        "APE": weighted("APE"),
        "Net_Pr": weighted("netpr"),
        "Accrual_Net": F.col("_net"),
        "Accrual_Net_C": F.when(F.col("compliance_flag") == 1, F.col("_net")).otherwise(F.lit(0.0)),
        "motor_booked": weighted("motor_booked_flag"),
        "motor_cancelled": weighted("motor_cancelled_flag"),
    }, condition)
