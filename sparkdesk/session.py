"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that results or skew handling rely on. Memory, executor and shuffle
# partition counts are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Stream state beside the heap, for a fold over very many keys.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A generated method above 8000 bytes is never compiled by the JVM; fall back to smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app_name: str = "sparkdesk", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A folder on this machine is used only when the setting is absent and Spark
    itself runs in this one process, as it does in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    shared = tempfile.mkdtemp(prefix="sparkdesk-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df, name: str):
    """Write a frame to the shared folder and read it back.

    Cuts the lineage and fixes the rows, and unlike a cached block it is still
    there after an executor is lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df, name: str, column: str, buckets: int):
    """As ``materialise``, in buckets by a column, read back twice: with its buckets, so that what groups or joins by the column finds the rows where
    they are and does not shuffle them, and plainly, for what does not.

    Buckets are a matter of tables, so there is one for a moment; its files are below the shared folder and stay when it is dropped.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"drop table {table}")
    return rows, spark.read.schema(df.schema).parquet(path)
