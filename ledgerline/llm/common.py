"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

#: The separators between words, as a Java / RE2 character class body.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that a task of a staged table holds at least, where the number of rows is known.
TASK_ROWS = 100_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks (and files) that so many rows are worth, one for each core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def stage_table(df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back, in ``tasks`` files at most
    (a file costs several calls, on a local file system a process each).

    The written table survives lost executors, cuts the lineage and has known size
    statistics. Tables of one application share the folder
    ``<checkpoint dir>/ledgerline-llm/<application id>``, which a scheduler may delete
    when the application has ended."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ledgerline-llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    (df if tasks is None else df.coalesce(tasks)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch sent to a Python worker: texts may be long, so batches are short.
BATCH_ROWS = 1000


def map_arrow(rows: DataFrame, fn, schema) -> DataFrame:
    """``rows.mapInArrow`` with short batches (the session setting is lowered, never raised). At a task's end
    the worker gives back what Arrow has freed, as workers stay on for later tasks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(rows.sparkSession.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        rows.sparkSession.conf.set(name, BATCH_ROWS)

    def run(batches):
        import pyarrow as pa

        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, schema)


def words_sql(col: str = "text") -> str:
    """SQL expression: the array of words of a text (null text: empty array)."""
    pattern = f"[{SPACE}]+".replace("\\", "\\\\")
    return f"filter(split(coalesce({col}, ''), '{pattern}'), x -> x <> '')"


def salted_join(left: DataFrame, right: DataFrame, key: str, salt: Column, salts: int, how: str = "left") -> DataFrame:
    """Join a large ``left`` to a small-per-key ``right`` on ``key``, null keys included.

    Rows of one key are spread over ``salts`` reducers by ``salt`` (any deterministic
    column of ``left``), and ``right`` is repeated once per salt value, so a key that
    holds a third of ``left`` is still handled by many tasks."""
    a = left.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(salts)).cast("int"))
    b = right.withColumnRenamed(key, "_key").withColumn("_rsalt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, a["_salt"].eqNullSafe(b["_rsalt"]) & a[key].eqNullSafe(b["_key"]), how).drop("_salt", "_rsalt", "_key")


def wider(rows: DataFrame, ddl: str) -> StructType:
    """The schema of ``rows`` with the columns of ``ddl`` after its own."""
    return StructType([*rows.schema.fields, *StructType.fromDDL(ddl).fields])
