"""Lead layout: the fact and every lead-keyed table stored in buckets of the lead id.

Every lookup of a report joins the booking stream by lead. In this layout the bookings and the lookups
are written with the same hash of the lead id into the same number of buckets, so Spark reads
both sides co-partitioned: lookups are counted and joined bucket by bucket without any
exchange. The fact may besides be partitioned by booking month, so periods still prune.

Buckets are a property of a table, not of files: ``open_lead_layout`` declares each stored
folder as a table of the session (``CREATE TABLE ... CLUSTERED BY``) from the small table
``{root}/layout`` that ``write_lead_layout`` leaves beside the data. Nothing is copied or
read for that but file footers and, with months, the folder list.

One bucket is read by one task, so a lead id that holds a large share of a table makes one
long task. ``bucket_rows`` shows that; such a table can be read plain (``plain=``), and then is
combined before it is shuffled, as ever.
"""

from __future__ import annotations

import hashlib
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import PARTITION_MONTH, Catalog, with_key_columns

#: The lead id column of each lead-keyed table.
LEAD_KEYS = {
    "bookings": "leadid", "booking_details": "LEADID", "verification": "LeadId", "contest": "MatrixLeadId",
    "lead_referral": "LeadID", "business_type": "Leadid", "pay_term": "LeadId",
}


def _table(root: str, name: str) -> str:
    return f"ledgerline_{hashlib.md5(root.encode()).hexdigest()[:12]}_{name}"


def write_lead_layout(cat: Catalog, root: str, buckets: int, months: bool = False) -> None:
    """Store every table of ``cat`` under ``root``: lead-keyed ones in ``buckets`` buckets sorted by lead
    (all keys as BIGINT, so that one hash serves all), the others as they are. With ``months`` the
    fact is partitioned by booking month as well. One shuffle per table writes one file per
    bucket (and month)."""
    spark, root = cat.spark, root.rstrip("/")
    for name in cat.names():
        df, path = cat.table(name), f"{root}/{name}"
        if name not in LEAD_KEYS:
            df.write.mode("overwrite").parquet(path)
            continue
        lead = LEAD_KEYS[name]
        df = df.withColumn(lead, F.col(lead).cast("long"))
        split = []
        if name == "bookings":
            df = with_key_columns(df)
            if months:
                df = df.withColumn(PARTITION_MONTH, F.trunc(F.col("BookingDate").cast("date"), "month"))
                split = [PARTITION_MONTH]
        spark.sql(f"DROP TABLE IF EXISTS {_table(root, name)}")
        out = df.repartition(buckets, lead).write.mode("overwrite").format("parquet").bucketBy(buckets, lead).sortBy(lead)
        (out.partitionBy(*split) if split else out).option("path", path).saveAsTable(_table(root, name))
    rows = [(n, LEAD_KEYS.get(n), buckets if n in LEAD_KEYS else None, months and n == "bookings") for n in cat.names()]
    spark.createDataFrame(rows, "name string, lead string, buckets int, months boolean").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root}/layout")


def _declare(spark: SparkSession, root: str, name: str, lead: str, buckets: int, months: bool) -> DataFrame:
    path, table = f"{root}/{name}", _table(root, name)
    fields = [f for f in spark.read.parquet(path).schema.fields if f.name != PARTITION_MONTH or not months]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    split = ""
    if months:
        columns.append(f"{PARTITION_MONTH} date")
        split = f"PARTITIONED BY ({PARTITION_MONTH})"
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # an external table: its files stay
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet {split} "
              f"CLUSTERED BY ({lead}) SORTED BY ({lead}) INTO {buckets} BUCKETS LOCATION '{path}'")
    if months:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def open_lead_layout(spark: SparkSession, root: str, plain: Collection[str] = ()) -> Catalog:
    """The catalog of a stored lead layout; tables named in ``plain`` are read without their buckets."""
    root = root.rstrip("/")
    stored = {r["name"]: r for r in spark.read.parquet(f"{root}/layout").collect()}

    def load(name: str) -> DataFrame:
        r = stored[name]
        if r["lead"] is None or name in plain:
            return spark.read.parquet(f"{root}/{name}")
        return _declare(spark, root, name, r["lead"], r["buckets"], r["months"])

    return Catalog(spark, {n: (lambda n=n: load(n)) for n in stored})


def bucket_rows(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``bucket, n`` of a stored table: is any lead id hot?"""
    root = root.rstrip("/")
    r = spark.read.parquet(f"{root}/layout").where(F.col("name") == name).first()
    bucket = F.expr(f"pmod(hash(`{r['lead']}`), {r['buckets']})").alias("bucket")
    return spark.read.parquet(f"{root}/{name}").groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
