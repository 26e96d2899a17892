"""The combined lead-level dataset and the run-all entry point."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.dates import in_window
from ..functions.text import key_sql, norm, s
from ..operators.deals import special_deals
from ..operators.joins import copies_sql, counted_classes, counted_lookup
from ..operators.partners import attach_partner
from ..session import ensure_checkpoint_dir
from ..sources.catalog import Catalog
from . import health, life, motor, persistency, sme
from .common import MONEY, Rules, fact_rows, finish, ints, join_verification_count

# Constant fills, then ordered fallbacks (target <- source). Later
# fallbacks see the results of earlier ones.
CONSTANT_FILLS = {
    "policy_booked_flag": 1,
    "policy_issued_flag": 1,
    "policy_verified_flag": 1,
    "motor_booked_flag": 0,
    "motor_cancelled_flag": 0,
}
FALLBACKS = (
    ("Accrual_Net_Pr", "netpr"),
    ("Accrual_Net_Ins", "Accrual_Net_Pr"),
    ("Accrual_Net_Booked", "Accrual_Net"),
    ("W_Net", "Accrual_Net"),
    ("W_Net_C", "Accrual_Net_C"),
    ("W_Net_Booked", "W_Net"),
    ("bt", "product_name"),
)
DATE_TO_TIMESTAMP = ("MON", "Prev_end_date")

LINES = ("Motor", "Health_Fresh", "Health_Renewal", "Life", "SME")


def line_reports(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> dict[str, DataFrame]:
    return {
        "Motor": motor.motor_leads(cat, cfg, condition),
        "Health_Fresh": health.health_fresh_leads(cat, cfg, condition),
        "Health_Renewal": health.health_renewal_leads(cat, cfg, condition),
        "Life": life.life_leads(cat, cfg, condition),
        "SME": sme.sme_leads(cat, cfg, condition),
    }


def consolidate(frames: list[DataFrame]) -> DataFrame:
    """Stack line reports with different columns (missing -> NULL, column order of
    first appearance), then apply the fills, the fallback chain and the date parse."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return filled(out)


def filled(out: DataFrame) -> DataFrame:
    """The fills, the fallback chain and the date parse over the stacked columns."""
    cols = {c: F.col(f"`{c}`") for c in out.columns}
    for c, v in CONSTANT_FILLS.items():
        if c in cols:
            cols[c] = F.coalesce(cols[c], F.lit(v))
    for target, source in FALLBACKS:
        if target in cols and source in cols:
            cols[target] = F.coalesce(cols[target], cols[source])
    for c in DATE_TO_TIMESTAMP:
        if c in cols:
            cols[c] = cols[c].try_cast("timestamp_ntz")
    return out.select(*[e.alias(c) for c, e in cols.items()])


# -- all lines in one pass ------------------------------------------------------------

#: The one amount column that is DOUBLE in the motor line and DECIMAL in the others has its own name there.
MOTOR_AMOUNTS = {c: f"_motor_{c}" for c in ("netpr", "Accrual_Net_Pr", "Accrual_Net_Ins")}


@dataclass(frozen=True)
class Line:
    predicate: Callable[[DataFrame, C.ReportConfig], str]
    rules: Callable[[C.Variant], Rules]
    columns: Callable[[C.Variant], list[str]]
    deal: str  # the special deals' name of the line's product


ONE_PASS = {
    "Motor": Line(motor.motor_predicate, lambda v: motor.motor_line_rules(v, lambda c: MOTOR_AMOUNTS[c]), motor.motor_columns, motor.PRODUCT),
    "Health_Fresh": Line(health.fresh_predicate, health.fresh_line_rules, health.health_fresh_columns, health.PRODUCT),
    "Health_Renewal": Line(health.renewal_predicate, health.renewal_line_rules, health.health_renewal_columns, health.PRODUCT),
    "Life": Line(life.life_predicate, life.life_line_rules, life.life_columns, life.PRODUCT),
    "SME": Line(sme.sme_predicate, sme.sme_line_rules, sme.sme_columns, sme.PRODUCT),
}
_HEALTH = "_line IN ('Health_Fresh', 'Health_Renewal')"
#: Key of booking details that belong to a lead whatever their product.
_ANY = -1


def tagged_bookings(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """The fact read once: every booking of any line with its ``_line``. Lines are disjoint: by
    product, and fresh from renewed health by business type. One line's predicate that
    is NULL is not met."""
    fact = cat.table("bookings")
    arms = {name: line.predicate(fact, cfg) for name, line in ONE_PASS.items()}
    tag = " ".join(f"WHEN {p} THEN '{name}'" for name, p in arms.items())
    return fact_rows(fact, " OR ".join(f"({p})" for p in arms.values()), f"CASE {tag} END AS _line")


def join_deals_by_line(df: DataFrame, cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """One lookup for the special deals of all lines: per lead a count for each product."""
    products = dict.fromkeys(line.deal for line in ONE_PASS.values())
    counts = {f"_deals_{p}": f"{key_sql('product')} = {s(norm(p))}" for p in products}
    one = counted_classes(special_deals(cat, cfg), "MatrixLeadId", counts)
    mine = " ".join(f"WHEN '{name}' THEN _deals_{line.deal}" for name, line in ONE_PASS.items())
    out = df.join(one, F.expr("leadid = _k"), "left").withColumn("_n_deal", F.expr(f"nullif(CASE _line {mine} END, 0L)"))
    return out.withColumn("MatrixLeadId", F.expr("CASE WHEN _n_deal IS NOT NULL THEN _k END")).drop("_k", *counts)


def join_details_by_line(df: DataFrame, cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """One lookup for the booking details of health (sum insured, by lead and product) and life (plan and
    premium, by lead); a details row that both lines look up counts for each."""
    names = ("PlanId", "SupplierId", "_bp_prod", "BasicPremium", "PaymentPeriodicity", "issuanceDate")
    values = ("PlanId", "SupplierId", "ProductID", "BasicPremium", "PaymentPeriodicity", "CAST(issuanceDate AS DATE)")

    def kind(condition: str, product: str, insured: str, keep: bool) -> str:
        rest = ", ".join(f"'{n}', {'' if keep else 'nullif('}{x}{'' if keep else f', {x})'}" for n, x in zip(names, values))
        return f"CASE WHEN {condition} THEN named_struct('_d_prod', {product}, 'SumInsured', {insured}, {rest}) END"

    kinds = [kind(f"ProductID IN ({ints(C.HEALTH_FRESH_PRODUCTS)})", "ProductID", "SumInsured", False),
             kind(life.life_details_filter(cfg.variant), str(_ANY), "nullif(SumInsured, SumInsured)", True)]
    d = cat.table("booking_details").selectExpr("LEADID AS _d_lead", f"inline(filter(array({', '.join(kinds)}), x -> x IS NOT NULL))")
    df = df.withColumn("_d_key", F.expr(f"CASE WHEN {_HEALTH} THEN ProductId WHEN _line = 'Life' THEN {_ANY} END"))
    out = counted_lookup(df, d, ["leadid", "_d_key"], ["_d_lead", "_d_prod"], "_n_details")
    return life.join_plans(out, cat, cfg).drop("_d_key")


def joined_lines(cat: Catalog, cfg: C.ReportConfig, by_status: bool) -> DataFrame:
    """Bookings of all lines with everything that any line looks up: one join per table, on one
    partitioning by lead. A line that doesn't look a table up matches nothing in it."""
    t = attach_partner(tagged_bookings(cat, cfg), cat, cfg)
    t = t.join(health.prior_policies(cat, cfg), F.expr("leadid = _ref_lead AND _line = 'Health_Renewal'"), "left")
    kept = "_ref_lead IS NOT NULL" + (f" AND {health.NOT_EARLY}" if cfg.variant.renewal_early_guard else "")
    t = t.where(f"_line <> 'Health_Renewal' OR ({kept})").drop("_ref_lead")
    t = join_deals_by_line(t, cat, cfg)
    t = join_verification_count(t, cat, by_status, f" AND {_HEALTH}")
    t = motor.join_business_type(t, cat, " AND _line = 'Motor'")
    t = life.join_pay_term(t, cat, " AND _line = 'Life'")
    t = join_details_by_line(t, cat, cfg)
    return motor.join_status_classes(t, cat, cfg.salts, " AND _line = 'Motor'")


def by_line(arms: dict[str, str], otherwise: str = "NULL") -> str:
    """``CASE _line`` with lines of one expression together."""
    same: dict[str, list[str]] = {}
    for name, e in arms.items():
        same.setdefault(e, []).append(name)
    parts = " ".join(f"WHEN _line IN ({', '.join(map(s, names))}) THEN {e}" for e, names in same.items())
    return f"CASE {parts} ELSE {otherwise} END"


def one_pass_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    """The five lead-level reports as one: the bookings read once, every table looked up once, each row's
    rules chosen by its line. Columns that a line doesn't report are NULL in its rows.

    The condition is applied once, to rows that hold the input columns of all lines (those that a line
    doesn't look up are NULL; ``netpr`` and the amounts are DOUBLE)."""
    v = cfg.variant
    t = joined_lines(cat, cfg, condition is not None)
    staged = {name: line.rules(v) for name, line in ONE_PASS.items()}
    for k in range(max(map(len, staged.values()))):
        now: dict[str, dict[str, str]] = {}
        for name, rules in staged.items():
            for c, e in (rules[k] if k < len(rules) else {}).items():
                now.setdefault(c, {})[name] = e
        known = set(t.columns)
        t = t.withColumns({c: F.expr(by_line(arms, f"`{c}`" if c in known else "NULL")) for c, arms in now.items()})
    t = t.withColumns({c: F.expr(f"CASE WHEN _line = 'Motor' THEN `{m}` ELSE CAST(`{c}` AS DOUBLE) END") for c, m in MOTOR_AMOUNTS.items()})
    reported = {name: line.columns(v) for name, line in ONE_PASS.items()}
    columns = list(dict.fromkeys(c for cols in reported.values() for c in cols))
    counts = [c for c in ("_n_deal", "_n_ver", "_n_bt", "_n_pt", "_n_details", "_n_prev")]
    t = t.withColumn("_copies", F.expr(copies_sql(*counts))).drop(*counts)
    out = finish(t, [*columns, "_line"], condition, cfg.copy_tasks)
    mine = {c: [n for n, cols in reported.items() if c in cols] for c in columns}
    return out.selectExpr(*[
        f"`{c}`" if len(mine[c]) == len(reported) else f"CASE WHEN _line IN ({', '.join(map(s, mine[c]))}) THEN `{c}` END AS `{c}`"
        for c in columns])


def combined_leads(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None,
                   shared_scan: bool = False) -> DataFrame:
    """The five lead-level reports under one condition, consolidated, in one pass over the
    bookings (``one_pass_leads``).

    With ``shared_scan`` the in-scope slice of the fact is written once under the session's
    checkpoint folder and the five reports read that slice one by one (kept for callers
    who want a stored slice)."""
    if shared_scan:
        cat = cat.with_table("bookings", stage_bookings_in_scope(cat, cfg))
        reports = line_reports(cat, cfg, condition)
        return consolidate([reports[n] for n in LINES])
    return filled(one_pass_leads(cat, cfg, condition))


def bookings_in_scope(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Every booking any line report of ``cfg`` can read: the lines' products booked in
    the period widened to the renewal window, and prior policies ending in the period
    (the renewal report's second reference to the fact)."""
    p = cfg.period
    lo, hi = health.renewal_window(p)
    products = sorted(set(C.MOTOR_PRODUCTS + C.HEALTH_FRESH_PRODUCTS + C.HEALTH_RENEWAL_PRODUCTS
                          + C.LIFE_PRODUCTS + C.SME_PRODUCTS))
    ids = ", ".join(str(i) for i in products)
    return cat.table("bookings").where(
        F.expr(f"ProductId IN ({ids})") & in_window("BookingDate", min(lo, p.min_date), max(hi, p.max_date))
        | in_window("PolicyEndDate", p.min_date, p.max_date))


def stage_bookings_in_scope(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Write the in-scope slice once to the shared checkpoint folder and read it back
    (a written table cuts the lineage, so lost executors never re-read the fact)."""
    spark = cat.spark
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ledgerline-scope-{uuid.uuid4().hex}"
    bookings_in_scope(cat, cfg).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_reports(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> dict[str, DataFrame]:
    """All six reports as lazy DataFrames (the five lines and persistency). The
    persistency report is produced but not part of the combined dataset."""
    out = line_reports(cat, cfg, condition)
    out["Health_Persistency"] = persistency.health_persistency(cat, cfg, condition)
    return out


def report_totals(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    """One row per report of ``run_reports``: its name, number of rows, and the sum of each amount it
    has (summed as exact decimals, so in any order; null where the report lacks the column)."""
    parts = [df.groupBy(F.lit(name).alias("report")).agg(F.count(F.lit(1)).alias("n_rows"), *[
        F.expr(f"CAST(round(sum(CAST(`{c}` AS DECIMAL(28, 6))), 2) AS DOUBLE) AS total_{c}" if c in df.columns else f"CAST(NULL AS DOUBLE) AS total_{c}")
        for c in sorted(MONEY)]) for name, df in run_reports(cat, cfg, condition).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
