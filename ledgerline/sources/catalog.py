"""Catalog: logical table name -> DataFrame.

Reports only ever ask the catalog for a table by its logical name, so the same report
runs on parquet/Delta-style directories, on a JDBC source, or on test fixtures.
Loaders are lazy and memoised per catalog, so a table used by several branches of
one plan is the same DataFrame (identical sub-plans let Spark reuse exchanges).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# Logical names of the relations the reports read.
TABLES = (
    "bookings",          # policy bookings (fact), one row per lead
    "booking_details",   # sum insured / plan / periodicity per lead
    "verification",      # health verification status per lead
    "contest",           # special deals (contest) per lead
    "partners",          # partner dimension
    "partner_directory", # partner dimension with contact / manager columns
    "inclusion",         # extra partner codes admitted to the universe
    "lead_referral",     # lead -> referral (prior policy lead) edge
    "business_type",     # motor business type per lead
    "status",            # status master
    "life_plans",        # life plan catalogue
    "pay_term",          # life pay term per lead
    "partner_quarter",   # quarterly partner tier / weighted net premium
)

Loader = Callable[[], DataFrame]


class Catalog:
    def __init__(self, spark: SparkSession, loaders: Mapping[str, Loader | DataFrame]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            src = self._loaders.get(name)
            if src is None:
                raise KeyError(f"catalog has no table {name!r}")
            self._cache[name] = src if isinstance(src, DataFrame) else src()
        return self._cache[name]

    def with_table(self, name: str, df: DataFrame) -> "Catalog":
        """A catalog identical to this one except for table ``name``."""
        return Catalog(self.spark, self._loaders | {name: df})

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)

    def names(self) -> list[str]:
        return sorted(self._loaders)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names=TABLES) -> "Catalog":
        """Tables stored as ``{root}/{name}`` parquet directories."""
        return cls(spark, {n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in names})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        table_map: Mapping[str, str],
        properties: Mapping[str, str] | None = None,
        partitioning: Mapping[str, Mapping[str, object]] | None = None,
    ) -> "Catalog":
        """Tables read through Spark's JDBC source.

        ``table_map`` maps a logical name to the remote table. ``partitioning`` may
        give, per logical name, ``partitionColumn/lowerBound/upperBound/numPartitions``, or a list of
        ``predicates`` (see ``month_product_predicates``), so that large remote tables are read
        by many tasks instead of over one connection; the bookings fact must have it. Credentials come from ``properties``; nothing is
        stored here.
        """
        props = dict(properties or {})
        parts = dict(partitioning or {})
        if "bookings" in table_map and "bookings" not in parts:
            raise ValueError("partitioning for the bookings fact is required: it is not read over one connection")

        def load(name: str) -> DataFrame:
            mine = dict(parts.get(name, {}))
            predicates = mine.pop("predicates", None)
            if predicates is not None:  # one read task per predicate
                more = {k: str(v) for k, v in mine.items()}
                return spark.read.jdbc(url, table_map[name], predicates=list(predicates), properties=props | more)
            reader = spark.read.format("jdbc").option("url", url).option("dbtable", table_map[name])
            for k, v in (props | mine).items():
                reader = reader.option(k, str(v))
            return reader.load()

        return cls(spark, {n: (lambda n=n: load(n)) for n in table_map})

    def write_parquet(self, root: str, names=None, mode: str = "overwrite", partition_fact: bool = False) -> None:
        """Materialise tables as parquet directories (one Spark job per table). With
        ``partition_fact`` the bookings fact is laid out by booking month and product
        (``write_bookings``), so report periods and product lines prune directories."""
        for n in names or self.names():
            if n == "bookings" and partition_fact:
                write_bookings(self.table(n), f"{root}/{n}", mode)
            else:
                self.table(n).write.mode(mode).parquet(f"{root}/{n}")


def month_product_predicates(date_column: str, lo: dt.date, hi: dt.date, product_column: str | None = None,
                             products: Sequence[Sequence[int]] = ()) -> list[str]:
    """Remote predicates, one read task each: a month of ``lo <= date < hi``, times a group of
    products. Together they hold every row of the window (and of the products) once."""
    months = []
    at = lo
    while at < hi:
        following = min(hi, dt.date(at.year + at.month // 12, at.month % 12 + 1, 1))
        months.append(f"{date_column} >= '{at.isoformat()}' AND {date_column} < '{following.isoformat()}'")
        at = following
    if not products:
        return months
    groups = [f"{product_column} IN ({', '.join(str(int(p)) for p in g)})" for g in products]
    return [f"{m} AND {g}" for m in months for g in groups]


PARTITION_MONTH = "BookingMonth"

#: Text columns of the fact that reports filter on. A stored fact keeps their comparison
#: keys (upper case, without trailing blanks), so that the filters reach its scan.
KEY_COLUMNS = ("Status", "BusinessType", "Leadsource")


def key_column(column: str) -> str:
    return f"_key_{column}"


def with_key_columns(bookings: DataFrame) -> DataFrame:
    from ..functions.text import key

    return bookings.withColumns({key_column(c): key(c) for c in KEY_COLUMNS if c in bookings.columns})


def write_bookings(bookings: DataFrame, path: str, mode: str = "overwrite", writers: int | None = None) -> None:
    """Store the bookings fact partitioned by booking month and product id.

    Each (month, product) directory is written by the tasks holding its rows after a
    shuffle on the partition columns plus the lead id (so one large month/product is
    spread over ``writers`` tasks, by default the session's parallelism). Reports recognise the ``BookingMonth``
    column and add it to their period filter, which turns the period into partition
    pruning; the product filter prunes on ``ProductId`` directly. Comparison keys of the text columns that
    reports filter on are stored beside them (``KEY_COLUMNS``)."""
    from pyspark.sql import functions as F

    writers = writers or bookings.sparkSession.sparkContext.defaultParallelism
    out = with_key_columns(bookings).withColumn(PARTITION_MONTH, F.trunc(F.col("BookingDate").cast("date"), "month"))
    out = out.repartition(PARTITION_MONTH, "ProductId", F.pmod(F.xxhash64("leadid"), F.lit(writers)))
    out.write.mode(mode).partitionBy(PARTITION_MONTH, "ProductId").parquet(path)
