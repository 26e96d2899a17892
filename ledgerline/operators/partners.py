"""Partner universes (which selling partners a report credits) and the vertical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import eq, isin, key, like
from ..sources.catalog import Catalog
from .joins import join_dimension

UNIVERSE_COLUMNS = ("PartnerCode", "SellNowEnabled", "ComplianceCertified", "Markettype")
LEGACY_UNIVERSE_COLUMNS = ("PartnerCode", "SellNowEnabled", "ComplianceCertified")


def partner_universe(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Current universe: IP-prefixed partners outside the excluded markets, plus the
    inclusion-list partners that are not already in that base (UNION ALL)."""
    p = cat.table("partners")
    base = p.where(like("PartnerCode", C.PARTNER_CODE_PREFIX) & ~isin("Markettype", C.CURRENT_EXCLUDED_MARKETS)) \
        .select(*UNIVERSE_COLUMNS)
    # codes of the list that no base partner has, grouped as one table of codes (combined map-side, so a
    # repeated code is one row): one exchange for both sides of the NOT EXISTS
    codes = cat.table("inclusion").select(key("PartnerCode").alias("_listed"), F.lit(False).alias("_base")).unionByName(
        base.select(key("PartnerCode").alias("_listed"), F.lit(True).alias("_base")))
    listed = codes.groupBy("_listed").agg(F.max("_base").alias("_base")).where("NOT _base")
    extra = p.join(listed, key(p["PartnerCode"]) == listed["_listed"], "left_semi").select(*UNIVERSE_COLUMNS)
    return base.unionByName(extra)


def partner_universe_legacy(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Legacy universe: SellNow partners, either certified in an allowed market
    ("motor" arm) or in any other non-excluded market ("other" arm)."""
    p = cat.table("partners")
    lists = cfg.lists
    sell = like("PartnerCode", C.PARTNER_CODE_PREFIX) & eq("SellNowEnabled", "Yes")
    motor_arm = p.where(
        sell & eq("ComplianceCertified", "Yes") & isin("Markettype", lists.legacy_allowed_markets)
        & ~isin("SalesCat", C.LEGACY_SALESCAT_EXCLUDED)
    )
    other_arm = p.where(
        sell & ~isin("Markettype", lists.legacy_other_excluded)
        & ~isin("SalesCat", C.LEGACY_OTHER_SALESCAT_EXCLUDED)
    )
    return motor_arm.select(*LEGACY_UNIVERSE_COLUMNS).unionByName(other_arm.select(*LEGACY_UNIVERSE_COLUMNS))


def universe_for(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    if cfg.variant.legacy_universe:
        return partner_universe_legacy(cat, cfg)
    return partner_universe(cat, cfg)


def partner_dimension(cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """The universe keyed for the booking join: ``_pk`` (collation key),
    ``upper(PartnerCode)`` and the partner columns."""
    u = universe_for(cat, cfg)
    cols = [c for c in u.columns if c != "PartnerCode"]
    return u.select(key("PartnerCode").alias("_pk"), F.upper("PartnerCode").alias("PartnerCode"), *cols)


def attach_partner(bookings: DataFrame, cat: Catalog, cfg: C.ReportConfig) -> DataFrame:
    """Inner join of bookings to the partner universe on ``Utm_term = PartnerCode``
    under the collation. Output starts with ``upper(PartnerCode)`` and the partner
    columns, followed by every booking column.

    A partner owning a large share of bookings is split by Spark's skew join or, with
    ``cfg.salts``, spread by lead id; whether the universe is broadcast is Spark's decision, by bytes.
    """
    u = partner_dimension(cat, cfg)
    cols = [c for c in u.columns if c not in ("_pk", "PartnerCode")]
    joined = join_dimension(bookings, u, {"upper(rtrim(Utm_term))": "_pk"}, "inner", "leadid", cfg.salts)
    return joined.selectExpr(*[f"`{c}`" for c in ("PartnerCode", *cols, *bookings.columns)])


def partner_vertical(cat: Catalog, cfg: C.ReportConfig, condition: Column | None = None) -> DataFrame:
    """Vertical (Motor / Health / Life / sales category) of every IP partner; the
    condition sees the output columns."""
    d = cat.table("partner_directory")
    lists = cfg.lists
    vertical = (
        F.when(isin("MarketType", lists.vertical_motor_markets), F.lit("Motor"))
        .when(eq("SalesCat", "PRIME") & isin("NH_NAME", lists.vertical_health_teams), F.lit("Health"))
        .when(eq("SalesCat", "VRM") & isin("NH_NAME", lists.vertical_health_teams), F.lit("Health"))
        .when(eq("SalesCat", "VRM") & isin("NH_NAME", lists.vertical_life_teams), F.lit("Life"))
        .otherwise(F.col("SalesCat"))
    )
    out = d.where(like("PartnerCode", C.PARTNER_CODE_PREFIX)).select(
        "PartnerCode", "PartnerName", "RMCode", "RMName", "MarketType", "PartnerPhoneNumber",
        "PartnerEmailId", "ComplianceCertified", "SellNowEnabled", vertical.alias("Vertical"),
    )
    return out.where(condition) if condition is not None else out
