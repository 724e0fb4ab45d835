"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Bytes of an Arrow batch: a row may hold 20,000 words, so a bound in rows does not bound memory.
BATCH_BYTES = "8m"
#: Fixed value: the session's bound unless set.
_DEFAULT_BATCH = "67108864b"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "ledgerlens", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """Session with a UTC clock; sizes, credentials and storage options come from the caller."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Day boundaries, hours and text timestamps all mean UTC here."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Sets the session's bound on Arrow batches, unless it has one of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == _DEFAULT_BATCH:
        spark.conf.set(name, BATCH_BYTES)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting may fall back to a temporary folder: executors
    on other machines could not see it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
