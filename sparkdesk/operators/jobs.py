"""Job tracking: a log of partial updates folded into one record per submission, and its status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdesk.functions.strings import is_blank

# Fixed values.
NEW_LAUNCHER_STATE, NEW_YARN_STATE = "SUBMITTED", "APP_ID_PENDING"
FIELD_GROUPS = {
    "application_id": ("application_id",),
    "launcher_state": ("launcher_state",),
    "yarn_status": ("yarn_state", "final_status", "tracking_url"),
    "last_error": ("last_error",),
}
INSERT = "insert"
DEFAULTS = {"launcher_state": NEW_LAUNCHER_STATE, "yarn_state": NEW_YARN_STATE}
RECORD_COLUMNS = (
    "submission_id", "job_name", "queue", "application_id", "launcher_state", "yarn_state", "final_status",
    "tracking_url", "last_error", "created_at", "updated_at",
)


def _partial(seq: Column) -> list[Column]:
    """Aggregates over the changes of a key: the last insert, the last write of each group of fields, the last change of all."""
    partial = [F.max(F.when(F.col("kind") == INSERT, F.struct(seq.alias("s"), "ts", "job_name", "queue"))).alias("_new")]
    for kind, fields in FIELD_GROUPS.items():
        partial.append(F.max(F.when(F.col("kind") == kind, F.struct(seq.alias("s"), *fields))).alias(f"_{kind}"))
    partial.append(F.max(F.struct(seq.alias("s"), "ts")).alias("_last"))
    return partial


def fold(log: DataFrame, seq: Column, key: str = "submission_id") -> DataFrame:
    """One record per key from a log of ``key, ts, kind`` and the value columns.

    An ``insert`` starts the record anew; later rows set one group of fields each, and a
    written null counts. Rows before the insert change nothing, and a key without one has
    no record. ``seq`` orders the rows of a key and may be a struct.

    Each part of the record is a maximum over (seq, values): one aggregation that
    shrinks every key in the input tasks. The same code runs on a stream.
    """
    folded = log.groupBy(key).agg(*_partial(seq)).where(F.col("_new").isNotNull())

    def current(kind: str, field: str) -> Column:
        written = F.col(f"_{kind}.s") > F.col("_new.s")
        return F.when(written, F.col(f"_{kind}.{field}")).otherwise(F.lit(DEFAULTS.get(field))).cast("string").alias(field)

    values = [current(kind, field) for kind, fields in FIELD_GROUPS.items() for field in fields]
    record = folded.select(
        key,
        F.col("_new.job_name"),
        F.col("_new.queue"),
        *values,
        F.col("_new.ts").alias("created_at"),
        F.col("_last.ts").alias("updated_at"),
    )
    return record.select(key, *RECORD_COLUMNS[1:])


def merge(records: DataFrame, changes: DataFrame, seq: Column, key: str = "submission_id") -> DataFrame:
    """``records`` after ``changes`` (as the log of ``fold``), all of which are later than what the records hold.

    ``merge(fold(a), b)`` is ``fold(a and b)``: changes of a key without a record do nothing unless an insert comes before them.
    """
    folded = changes.groupBy(key).agg(*_partial(seq))
    base = records.select(key, F.struct(*RECORD_COLUMNS[1:]).alias("_r"))
    joined = base.join(folded, key, "full").where(F.col("_r").isNotNull() | F.col("_new").isNotNull())
    fresh = F.col("_new").isNotNull()

    def current(kind: str, field: str) -> Column:
        written = F.when(fresh, F.coalesce(F.col(f"_{kind}.s") > F.col("_new.s"), F.lit(False))).otherwise(F.col(f"_{kind}").isNotNull())
        kept = F.when(fresh, F.lit(DEFAULTS.get(field))).otherwise(F.col(f"_r.{field}"))
        return F.when(written, F.col(f"_{kind}.{field}")).otherwise(kept).cast("string").alias(field)

    def own(field: str, source: str) -> Column:
        return F.when(fresh, F.col(source)).otherwise(F.col(f"_r.{field}")).alias(field)

    values = [current(kind, field) for kind, fields in FIELD_GROUPS.items() for field in fields]
    updated = F.when(F.col("_last").isNotNull(), F.col("_last.ts")).otherwise(F.col("_r.updated_at")).alias("updated_at")
    record = joined.select(key, own("job_name", "_new.job_name"), own("queue", "_new.queue"), *values, own("created_at", "_new.ts"), updated)
    return record.select(key, *RECORD_COLUMNS[1:])


def report_changes(records: DataFrame, reports: DataFrame) -> DataFrame:
    """Reports of the cluster as log rows of the submissions whose application they are on.

    ``reports`` holds ``application_id, yarn_state, final_status, tracking_url, reported_at``, any number per
    application; a submission without an application id, or with a blank one, gets none.
    """
    known = records.where(~is_blank(F.col("application_id"))).select("submission_id", "application_id")
    fields = FIELD_GROUPS["yarn_status"]
    seen = reports.select("application_id", F.col("reported_at").alias("ts"), *fields)
    empty = [F.lit(None).cast("string").alias(f) for f in ("job_name", "queue", "launcher_state", "last_error")]
    rows = seen.join(known, "application_id").select("submission_id", "ts", F.lit("yarn_status").alias("kind"), *fields, *empty)
    return rows.withColumn("application_id", F.lit(None).cast("string"))


def job_status(records: DataFrame, reports: DataFrame, base_url: str) -> DataFrame:
    """Records after the reports of ``report_changes``, whose time moves ``updated_at``, with their link.

    Of several reports on one application the newest holds. A record without an application id keeps what the launcher saw, and has no link.
    """
    seen = merge(records, report_changes(records, reports), F.struct("ts", *FIELD_GROUPS["yarn_status"]))
    link = F.when(~is_blank(F.col("application_id")), F.concat(F.lit(base_url + "/cluster/app/"), F.col("application_id")))
    return seen.select(
        "submission_id", "job_name", "application_id", "queue", "launcher_state", *FIELD_GROUPS["yarn_status"],
        link.alias("router_tracking_url"), "last_error", "created_at", "updated_at",
    )
