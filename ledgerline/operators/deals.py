"""Special deals (contest leads): a booking with a deal earns no standard credit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.text import eq
from ..sources.catalog import Catalog


def special_deals(cat: Catalog, cfg: C.ReportConfig, product: str | None = None) -> DataFrame:
    """Contest rows from the period start on (no upper bound), optionally only active
    ones; with ``product`` only that product's rows (compared under the collation)."""
    t = cat.table("contest")
    cond = F.expr(f"ContestMonth >= DATE '{cfg.period.min_date.isoformat()}'")
    if cfg.variant.deals_active_only:
        cond = cond & (F.col("IsActive") == 1)
    if product is not None:
        cond = cond & eq("product", product)
    return t.where(cond).select("MatrixLeadId", "product")
