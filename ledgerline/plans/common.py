"""Steps shared by the lead-level reports of every product line.

A line's row rules are SQL strings in stages (``{column: expression}`` dicts; a later stage
reads the columns of earlier ones). The line's own report applies them one after another,
the combined report under a line tag, so both run the same rules."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import month_start_sql, quarter_lock_sql, window_sql
from ..functions.text import key, key_sql, like, norm, s
from ..operators.deals import special_deals
from ..operators.joins import copies_sql, counted_lookup, expand, multiplicity
from ..sources.catalog import PARTITION_MONTH, Catalog, key_column

# Money columns leave a report as DOUBLE: amounts are computed exactly in DECIMAL up to
# the insurer step and converted once, so both engines of a comparison agree bit for bit.
MONEY = frozenset({
    "TotalPremium", "APE", "netpr", "ODPremium", "TPPremium", "Accrual_Net_Pr", "Accrual_Net_Ins",
    "Accrual_Net_Booked", "Accrual_Net", "Accrual_Net_C", "W_Net_Booked", "W_Net", "W_Net_C",
})


# Summary measures that are counts of rows.
COUNTS = frozenset({"motor_booked", "motor_cancelled"})

# Columns of the fact that some line reads.
FACT_COLUMNS = (
    "Utm_term", "leadid", "TotalPremium", "APE", "Net Premium", "ProductId", "IsComplianceN", "Insurer Name",
    "PlanName", "BookingMode", "BookingDate", "BusinessType", "SubProduct", "VehicleSubClass", "ODPremium",
    "TPPremium", "ODTerm", "TPTerm", "Status", "StatusId", "PolicyStartDate",
)

Rules = list[dict[str, str]]


def same(name: str) -> str:
    return name


def ints(values) -> str:
    """SQL list of integer literals."""
    return ", ".join(str(int(v)) for v in values)


def flag_sql(condition: str) -> str:
    """0/1 flag from a SQL condition (NULL counts as 0, as in ``CASE WHEN``)."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def fact_in_sql(fact: DataFrame, column: str, values) -> str:
    """``column IN (values)`` under the collation. Where the stored fact keeps the column's
    comparison key, the test is on that key and reaches the scan as a pushed filter."""
    name = key_column(column)
    left = f"`{name}`" if name in fact.columns else key_sql(column)
    return f"{left} IN ({', '.join(s(norm(v)) for v in values)})"


def in_period_sql(fact: DataFrame, products, lo, hi, extra: str | None = None) -> str:
    """Bookings of the given products in ``lo <= BookingDate < hi``. The bounds are literals
    and the products an integer set, so both reach the scan; on a fact stored by month the months too."""
    parts = [f"ProductId IN ({ints(products)})", window_sql("BookingDate", lo, hi)]
    if PARTITION_MONTH in fact.columns:
        parts.append(month_partitions_sql(lo, hi))
    if extra:
        parts.append(f"({extra})")
    return " AND ".join(parts)


def month_partitions_sql(lo, hi) -> str:
    """Predicate on the month partition column implied by ``lo <= BookingDate < hi``
    (months from the month of ``lo`` up to the month of the last instant before ``hi``)."""
    first = dt.date(lo.year, lo.month, 1)
    return f"{PARTITION_MONTH} >= DATE '{first.isoformat()}' AND {PARTITION_MONTH} < DATE '{hi.isoformat()}'"


def fact_rows(fact: DataFrame, condition: str, *more: str) -> DataFrame:
    """The fact's rows that fit, without the columns that only storage knows; ``more`` are added expressions."""
    own = [c for c in FACT_COLUMNS if c in fact.columns]
    cast = {"PolicyStartDate": "CAST(PolicyStartDate AS DATE) AS PolicyStartDate"}
    return fact.where(condition).selectExpr(*[cast.get(c, _q(c)) for c in own], *more)


BOOKING_CALENDAR = {"MON": month_start_sql("BookingDate"), "Qtr_Locking_Date": quarter_lock_sql("BookingDate")}


def deal_flag_sql() -> str:
    return "CASE WHEN _n_deal IS NULL THEN 1 ELSE 0 END"


def join_deal_count(df: DataFrame, cat: Catalog, cfg: C.ReportConfig, product: str) -> DataFrame:
    """Left join to the special deals of ``product`` reduced to a per-lead count
    (``_n_deal``); ``MatrixLeadId`` (for conditions) is the deal's lead."""
    m = multiplicity(special_deals(cat, cfg, product), "MatrixLeadId", "_n_deal")
    return df.join(m, F.expr("leadid = _k"), "left").withColumnRenamed("_k", "MatrixLeadId")


def join_verification_count(df: DataFrame, cat: Catalog, by_status: bool, only: str = "") -> DataFrame:
    """Left join to verified health leads: number of rows (``_n_ver``), with ``by_status`` per
    ``VerificationStatus`` (which only a caller's condition can read)."""
    v = cat.table("verification").where(like("VerificationStatus", "%Verif%"))
    if by_status:
        return counted_lookup(df, v.selectExpr("LeadId AS _ver_lead", "VerificationStatus"), ["leadid"], ["_ver_lead"], "_n_ver", only)
    return df.join(multiplicity(v, "LeadId", "_n_ver"), F.expr(f"leadid = _k{only}"), "left").drop("_k")


def compliance_sql(variant: C.Variant) -> str:
    cond = f"{key_sql('IsComplianceN')} = 'YES'"
    if variant.compliance_needs_certificate:
        cond = f"{key_sql('ComplianceCertified')} = 'YES' AND {cond}"
    return flag_sql(cond)


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    for stage in rules:
        df = df.withColumns({c: F.expr(e) for c, e in stage.items()})
    return df


def head_columns(v: C.Variant) -> list[str]:
    return ["PartnerCode", "SellNowEnabled", "ComplianceCertified"] + (["Markettype"] if v.markettype_in_output else [])


def with_copies(df: DataFrame, *counts: str) -> DataFrame:
    """Replace match counts by ``_copies``: how many rows this row stands for when
    lookups hold duplicates. Lead reports expand it, summaries weight by it."""
    return df.withColumn("_copies", F.expr(copies_sql(*counts))).drop(*counts)


def finish(df: DataFrame, columns, condition: Column | None, copy_tasks: int | None = None) -> DataFrame:
    """Apply the caller's condition to the pre-projection rows (it may use any input
    column, as the reference's placeholder sits before the final projection), restore
    the row copies, then project the output columns, money as DOUBLE."""
    if condition is not None:
        df = df.where(condition)
    df = expand(df.withColumnRenamed("_copies", "_n"), "_n", tasks=copy_tasks)
    # one projection expression list: a single call to build, however many columns
    return df.selectExpr(*[f"CAST({_q(c)} AS DOUBLE) AS {_q(c)}" if c in MONEY else _q(c) for c in columns])


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def credited_sql(ins: str, *flags: str) -> str:
    """``Ins * flag1 * flag2 ...`` in DOUBLE (flags are 0/1 so every step is exact)."""
    return " * ".join([f"CAST({_q(ins)} AS DOUBLE)"] + [_q(f) for f in flags])


def exact_credited(ins: str, *flags: str) -> Column:
    """``Ins * (flag1 * flag2 ... * copies)`` kept in DECIMAL (DOUBLE for motor), for exact sums."""
    weight = " * ".join([*map(_q, flags), "_copies"])
    return F.expr(f"{_q(ins)} * CAST({weight} AS DECIMAL(10, 0))")


def weighted(column: str) -> Column:
    """A measure times the copies its row stands for."""
    return F.expr(f"{_q(column)} * CAST(_copies AS DECIMAL(10, 0))")


def summarize(df: DataFrame, product_name: str, measures: dict[str, Column], condition: Column | None = None) -> DataFrame:
    """Partner x product x month totals (partners under the collation); the condition
    sees the output columns. Measures are weighted already; decimal sums are exact and
    converted to DOUBLE once; DOUBLE sums are rounded to cents (their order is not fixed)."""
    aggs = []
    grouped = df.groupBy(key("PartnerCode").alias("PartnerCode"), F.lit(product_name).alias("product_name"), F.col("MON"))
    for name, expr in measures.items():
        aggs.append(F.sum(expr).alias(name))
    out = grouped.agg(*aggs)
    cols = []
    for f in out.schema.fields:
        if f.name in ("PartnerCode", "product_name", "MON"):
            cols.append(F.col(f.name))
        elif f.name in COUNTS:
            cols.append(F.col(f.name).cast("long").alias(f.name))
        elif f.dataType.typeName() == "decimal":
            cols.append(F.col(f.name).cast("double").alias(f.name))
        elif f.dataType.typeName() == "double":
            cols.append(F.round(F.col(f.name), 2).alias(f.name))
        else:
            cols.append(F.col(f.name))
    out = out.select(*cols)
    return out.where(condition) if condition is not None else out
