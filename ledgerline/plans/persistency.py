"""Health renewal persistency: quarterly and annual renewal ratios per partner, their
payout multipliers, and the quarter rank within the partner's year."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import in_window, quarter_label, ts_literal
from ..functions.text import key
from ..operators.joins import multiplicity
from ..sources.catalog import Catalog

# Multiplier ladder on the rounded ratio, first match wins.
PERSISTENCY_LADDER = ((0.9, 0.75), (0.8, 0.65), (0.7, 0.60), (0.6, 0.55))
PERSISTENCY_FLOOR = 0.0
MIN_YEARLY_DUE = 5


def half_up_ratio(num: Column, den: Column) -> Column:
    """``ROUND(num / den, 2)`` on exact decimals (half-up), as DOUBLE; NULL when
    ``den`` is NULL."""
    return F.round(num.cast("decimal(20,0)") / den.cast("decimal(20,0)"), 2).cast("double")


def multiplier(ratio: Column) -> Column:
    out = None
    for bound, m in PERSISTENCY_LADDER:
        cond = ratio >= F.lit(bound)
        out = F.when(cond, F.lit(m)) if out is None else out.when(cond, F.lit(m))
    return out.when(ratio < F.lit(PERSISTENCY_LADDER[-1][0]), F.lit(PERSISTENCY_FLOOR))


def health_persistency(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    """Policies due for renewal (health renewal products ending inside the period, up
    to ``as_of``) against the renewals booked for them (leads referring back to them).

    The referral edge is reduced to a count per referred lead before the join (partial
    aggregation, so a lead renewed many times is not a hot join key), and the quarter
    rows are rolled up to the year with a window over (partner, year) instead of a
    self-join; the same window partitioning serves the quarter rank.
    """
    p = cfg.period
    as_of = cfg.as_of or dt.date.today()
    end = F.col("PolicyEndDate")
    due = cat.table("bookings").where(
        in_window("PolicyEndDate", p.min_date, p.max_date)
        & F.expr(f"PolicyEndDate <= {ts_literal(as_of)}")
        & F.col("ProductId").isin(list(C.HEALTH_RENEWAL_PRODUCTS))
        & F.col("StatusId").isin(list(C.PERSISTENCY_STATUS_IDS))
    ).select("leadid", "Utm_term", "PolicyEndDate")
    refs = multiplicity(cat.table("lead_referral"), "ReferralID", "_n_ref")
    j = due.join(refs, due["leadid"] == refs["_k"], "left")
    # COUNT(leadid) and COUNT(ReferralID) over the left-joined rows
    due_rows = F.when(F.col("leadid").isNotNull(), F.coalesce(F.col("_n_ref"), F.lit(1))).otherwise(F.lit(0))
    done_rows = F.coalesce(F.col("_n_ref"), F.lit(0))
    q = j.groupBy(
        key("Utm_term").alias("PartnerCode"),
        quarter_label("PolicyEndDate").alias("Quarter"),
        F.year(end).alias("Year"),
    ).agg(F.sum(due_rows).alias("_due"), F.sum(done_rows).alias("_done"))
    # the reference joins quarters to years on (PartnerCode, Year): NULL partners drop out
    q = q.where(F.col("PartnerCode").isNotNull() & F.col("Year").isNotNull())
    w = Window.partitionBy("Year", "PartnerCode")
    due_q = F.nullif(F.col("_due"), F.lit(0))
    out = q.select(
        "PartnerCode", "Quarter", "Year",
        due_q.cast("double").alias("Qtr_Renewal_Due"),
        F.col("_done").cast("double").alias("Qtr_Renewal_Done"),
        F.sum(due_q).over(w).alias("_ydue"),
        F.sum(F.col("_done")).over(w).alias("_ydone"),
        half_up_ratio(F.col("_done"), due_q).alias("Qtr_Health_Persistency"),
        F.row_number().over(w.orderBy("Quarter")).alias("rnk"),
    )
    out = out.select(
        "PartnerCode", "Quarter", "Year", "Qtr_Renewal_Due", "Qtr_Renewal_Done",
        F.col("_ydue").cast("double").alias("Yearly_Renewal_Due"),
        F.col("_ydone").cast("double").alias("Yearly_Renewal_Done"),
        "Qtr_Health_Persistency",
        half_up_ratio(F.col("_ydone"), F.col("_ydue")).alias("Annual_Health_Persistency"),
        "rnk",
    )
    out = out.select(
        "PartnerCode", "Quarter", "Year", "Qtr_Renewal_Due", "Qtr_Renewal_Done", "Yearly_Renewal_Due",
        "Yearly_Renewal_Done", "Qtr_Health_Persistency", "Annual_Health_Persistency",
        multiplier(F.col("Qtr_Health_Persistency")).alias("Qtr_Health_Persistency_Multiplier"),
        F.when(F.col("Yearly_Renewal_Due") < MIN_YEARLY_DUE, F.lit(1.0))
        .otherwise(multiplier(F.col("Annual_Health_Persistency"))).alias("Annual_Health_Persistency_Multiplier"),
        F.lit("Health").alias("product_name"), F.lit("Renewal").alias("Health_bt"), "rnk",
    )
    return out.where(condition) if condition is not None else out
