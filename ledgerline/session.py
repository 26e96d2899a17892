"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the reports are tuned for. AQE re-plans joins from runtime sizes, coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # lead-keyed lookups join on (lead) or (lead, product): let a partitioning on the
    # lead id alone serve both, instead of re-shuffling the booking stream (lead ids are
    # unique per booking, so this cannot create skew)
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = DEFAULT_CONF | runtime_filter_conf()
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a local session without one
    gets a temporary folder (tests): on a cluster, executors would each write to their own disks."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back (a written table cuts the
    lineage, so lost executors never read its inputs again). Tables of one application share the folder
    ``<checkpoint dir>/ledgerline/<application id>``, which a scheduler may delete when it has ended."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ledgerline/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a runtime filter, at most: each task's share of a filter this large is sent to one
#: reducer, and the filter to every task.
MOST_FILTER_BITS = 1 << 26


def runtime_filter_conf(period_leads: int = 4_000_000, lookup_mb: int = 256) -> dict[str, str]:
    """Runtime semi-join reduction of the lookups.

    Spark's runtime filters build a Bloom filter over the lead ids of the fact's filtered scan
    (product, period and status) and apply it at the scan of a lookup, below the aggregate that
    counts it, so leads outside the period never enter the count or its shuffle. False positives only
    cost work; no lead is lost. Lookups under ``lookup_mb`` aren't worth it.
    ``period_leads`` is the number of leads a report reads: the filter has 8 bits for each, up to
    ``MOST_FILTER_BITS``. Beyond that a filter would let most leads pass and the second
    scan of the fact is wasted, so filters are off; the lead layout (``sources.layout``) is the way then."""
    pre = "spark.sql.optimizer.runtime.bloomFilter"
    if 8 * period_leads > MOST_FILTER_BITS:
        return {f"{pre}.enabled": "false"}
    return {
        f"{pre}.enabled": "true",
        # by estimated bytes: the fact's side is a selection of unknown size, bounded by ``period_leads``
        f"{pre}.creationSideThreshold": "1024t",
        f"{pre}.applicationSideScanSizeThreshold": f"{lookup_mb}m",
        f"{pre}.expectedNumItems": str(period_leads),
        f"{pre}.maxNumItems": str(period_leads),
        f"{pre}.numBits": str(8 * period_leads),
        f"{pre}.maxNumBits": str(MOST_FILTER_BITS),
    }


def cluster_conf(total_cores: int, advisory_mb: int = 256, period_leads: int = 4_000_000) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1000 executors over ~100 TB).

    Shuffles start with many partitions (a few per core, so no reducer holds more than
    a few hundred MB even for the whole fact) and AQE coalesces them to
    ``advisory_mb``-sized partitions from the real map output sizes; file splits match
    that size; skewed join partitions (5x the median and above the advisory size) are
    split. Automatic broadcast stays at Spark's default threshold, and the report code holds no
    broadcast hints. Runtime filters reduce the lookups to the period's leads."""
    initial = max(200, 4 * total_cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{advisory_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{advisory_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{advisory_mb}m",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.parquet.filterPushdown": "true",
        **runtime_filter_conf(period_leads),
    }
