"""Streaming jobs run over the whole of a table, checked with the SQL of their batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.plans.inputs import job_log, requests, table
from sparkdesk.plans.jobs import FOLD_SQL, shown
from sparkdesk.plans.orders import REQUESTS_SQL
from sparkdesk.session import scratch_path
from sparkdesk.streaming.export import stream_export as start_export
from sparkdesk.streaming.jobs import current_records, stream_job_fold
from sparkdesk.streaming.orders import outcomes
from sparkdesk.streaming.orders import stream_orders as start_orders


def follow(spark: SparkSession, df: DataFrame, name: str, files_per_batch: int = 2) -> DataFrame:
    """A stream over a landed copy of a frame, some files per batch."""
    landed = scratch_path(spark, name)
    df.write.parquet(landed)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_per_batch).parquet(landed)


def stream_orders(spark: SparkSession, d: str) -> DataFrame:
    """Every request arrives twice, and what became of it: the second time adds nothing."""
    path = scratch_path(spark, "stream-orders")
    asked = requests(spark, d)
    start_orders(follow(spark, asked.unionByName(asked), "requests"), path, scratch_path(spark, "ckpt")).awaitTermination()
    found = outcomes(spark, f"{path}-aside")
    # Stored rows are those of the order table itself.
    stored = spark.read.parquet(path).select("order_no", "request_id", F.lit("stored").alias("outcome"))
    found = found.where("outcome <> 'stored'").select("order_no", F.col("request.request_id").alias("request_id"), "outcome", "message")
    return found.unionByName(stored, allowMissingColumns=True)


def stream_fold(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "stream-jobs")
    stream_job_fold(
        follow(spark, job_log(spark, d), "job-log"), F.col("event_id"), path, scratch_path(spark, "ckpt")
    ).awaitTermination()
    return shown(current_records(spark, path))


def stream_export(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "stream-csv")
    start_export(follow(spark, table(spark, d, "documents"), "docs"), path, scratch_path(spark, "ckpt")).awaitTermination()
    schema = "doc_id string, text string, lang string, source string, n_chars string"
    return spark.read.schema(schema).options(header="true", multiLine="true", escape='"', lineSep="\n").csv(path)


QUERIES = {"stream_orders": stream_orders, "stream_job_fold": stream_fold, "stream_export": stream_export}

ORACLE = {
    "stream_orders": f"""
        with {REQUESTS_SQL},
        good as (select order_no, request_id, unnest(['stored', 'conflict']) as outcome from priced)
        select order_no, request_id, outcome, null as message from good
        union all
        select null, request_id, 'rejected', array_to_string(violations, '; ') from checked, range(2) where len(violations) > 0""",
    "stream_job_fold": f"with {FOLD_SQL} select * from record",
    "stream_export": "select doc_id::varchar as doc_id, text, lang, source, n_chars::varchar as n_chars from documents",
}
