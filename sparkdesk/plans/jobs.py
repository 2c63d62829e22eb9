"""Job tracking: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.functions.cells import local_timestamp_text
from sparkdesk.operators import jobs as J
from sparkdesk.plans.inputs import job_log
from sparkdesk.plans.sqltext import iso_local


def shown(df: DataFrame) -> DataFrame:
    return df.withColumns({name: local_timestamp_text(F.col(name)) for name in ("created_at", "updated_at")})


def records(spark: SparkSession, d: str) -> DataFrame:
    return J.fold(job_log(spark, d), F.col("event_id"))


def job_fold(spark: SparkSession, d: str) -> DataFrame:
    return shown(records(spark, d))


def reports(spark: SparkSession, d: str) -> DataFrame:
    """Two reports, an hour apart, per application id that the log names; ids of every third user have none."""
    log = job_log(spark, d).where("application_id is not null")
    user = F.regexp_extract("application_id", "_([0-9]+)$", 1).cast("bigint")
    ids = log.where(user % 3 != 0).groupBy("application_id").agg(F.max("ts").alias("at"))
    first = F.struct(F.lit(1).alias("hours"), F.lit("RUNNING").alias("yarn_state"), F.lit("UNDEFINED").alias("final_status"))
    last = F.struct(F.lit(2).alias("hours"), F.lit("FINISHED").alias("yarn_state"), F.lit("KILLED").alias("final_status"))
    seen = ids.select("application_id", "at", F.explode(F.array(last, first)).alias("r"))
    return seen.select(
        "application_id", "r.yarn_state", "r.final_status", F.concat(F.lit("http://history/"), "application_id").alias("tracking_url"),
        F.expr("at + make_dt_interval(0, r.hours)").alias("reported_at"),
    )


def job_status(spark: SparkSession, d: str) -> DataFrame:
    return shown(J.job_status(records(spark, d), reports(spark, d), "http://router:8089"))


def job_merge(spark: SparkSession, d: str) -> DataFrame:
    """The log in two halves, the second merged into the records of the first, then the reports: one fold over all."""
    log, half = job_log(spark, d), F.col("event_id") % 2 == 0
    # Every second event comes late, but with numbers of its own order, so the later half starts records anew where it inserts.
    kept = J.merge(J.fold(log.where(half), F.col("event_id")), log.where(~half), F.col("event_id"))
    changes = J.report_changes(kept, reports(spark, d))
    return shown(J.merge(kept, changes, F.struct("ts", "yarn_state")))


QUERIES = {"job_fold": job_fold, "job_merge": job_merge, "job_status": job_status}

LOG_SQL = "log as (select 'sub-' || user_id as submission_id, user_id, event_id, ts, event_type, (props->>'$.k')::int as k from events),"

FOLD_SQL = f"""
    {LOG_SQL}
    born as (select submission_id, max(event_id) as born_at from log where event_type = 'signup' group by 1),
    live as (select l.*, born_at from log l join born using (submission_id) where event_id >= born_at),
    last as (
        select submission_id,
               max(event_id) filter (event_type = 'signup') as i, max(event_id) filter (event_type = 'click') as a,
               max(event_id) filter (event_type = 'view') as v, max(event_id) filter (event_type = 'purchase') as y,
               max(event_id) filter (event_type = 'error') as x, max(event_id) as z
        from live group by 1),
    record as (
        select last.submission_id, 'job-' || i as job_name,
               case when li.k % 2 = 0 then 'root.batch' else 'root.adhoc' end as queue,
               case when la.k % 10 <> 0 then 'application_' || la.k || '_' || la.user_id end as application_id,
               case when v is null then 'SUBMITTED' when lv.k % 3 = 0 then 'RUNNING' when lv.k % 3 = 1 then 'CONNECTED' end
                   as launcher_state,
               case when y is null then 'APP_ID_PENDING' when ly.k < 50 then 'RUNNING' else 'FINISHED' end as yarn_state,
               case when ly.k >= 50 then 'SUCCEEDED' end as final_status, 'http://rm/' || ly.k as tracking_url,
               'code ' || lx.k as last_error, {iso_local('li.ts')} as created_at, {iso_local('lz.ts')} as updated_at
        from last left join log li on li.event_id = i left join log la on la.event_id = a left join log lv on lv.event_id = v
             left join log ly on ly.event_id = y left join log lx on lx.event_id = x left join log lz on lz.event_id = z)"""

REPORTED_SQL = """
    said as (select 'application_' || k || '_' || user_id as application_id, max(ts) + interval 2 hour as seen_at from events_log
        where event_type = 'click' and k % 10 <> 0 and user_id % 3 <> 0 group by 1),"""

#: The merge of the odd events into the records of the even ones: odd ones count as later.
MERGE_SQL = FOLD_SQL.replace("user_id, event_id, ts,", "user_id, event_id + case when event_id % 2 = 0 then 0 else 1000000000000 end as event_id, event_id as raw, ts,").replace(
    "'job-' || i as job_name", "'job-' || li.raw as job_name"
)


def _status(columns: str) -> str:
    """The record after its application's last report."""
    return f"""
        {REPORTED_SQL.replace("events_log", "log")}
        r as (select record.*, said.seen_at from record left join said using (application_id))
        select submission_id, job_name, application_id, queue, launcher_state,
               case when seen_at is not null then 'FINISHED' else yarn_state end as yarn_state,
               case when seen_at is not null then 'KILLED' else final_status end as final_status,
               case when seen_at is not null then 'http://history/' || application_id else tracking_url end as tracking_url,
               {columns} last_error, created_at, case when seen_at is not null then {iso_local("seen_at")} else updated_at end as updated_at
        from r"""


ORACLE = {
    "job_fold": f"with {FOLD_SQL} select * from record",
    "job_merge": f"with {MERGE_SQL}, {_status('')}",
    "job_status": f"with {FOLD_SQL}, {_status("'http://router:8089/cluster/app/' || application_id as router_tracking_url,")}",
}
