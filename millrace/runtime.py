"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(
    app: str, master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Session with UTC timestamps, AQE and a state store that spills to disk.

    ``spark.sql.shuffle.partitions`` is left to the cluster configuration: batch
    plans are re-sized by AQE, and a stateful stream keeps the number it was
    first started with, so only the operator of the cluster can choose it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        # Sessions of one key merge before the shuffle, so a hot key sends few rows.
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df, name: str):
    """``df`` written to the shared folder and read again, where a later step reads it
    more than once or stands on a long lineage."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run, below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
