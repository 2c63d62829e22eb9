"""The job log as a stream: the current record of every submission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sparkdesk.operators.jobs import fold
from sparkdesk.streaming import records


def stream_job_fold(
    log: DataFrame, seq: Column, path: str, checkpoint: str, key: str = "submission_id", every: int = records.EVERY, **trigger
) -> StreamingQuery:
    """Writes the records that each batch changed to the store of ``records`` at ``path``.

    A repeated batch changes nothing. The state keeps one record per submission
    and is not dropped: a late change may come for any of them.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        records.commit(batch, batch_id, path, key, owner=checkpoint, every=every)

    return (
        fold(log, seq, key)
        .writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_records(spark: SparkSession, path: str, key: str = "submission_id") -> DataFrame:
    """The newest stored record of each submission."""
    return records.current(spark, path, key)
