"""The current record of every key, kept as one snapshot and the few changes since.

Below ``path`` there are two places for a snapshot, two for the pointer, and a ring of places for changes, each
replaced when its turn comes, so the number of folders is fixed however long a stream runs::

    snapshot-0|1/bucket=..    every record up to some batch, in folders by a hash of the key
    changes-0 .. 2*every-1    the records that one batch changed
    pointer-0|1               one row: which snapshot holds, and up to which batch there are changes

A batch counts once its pointer is written, as one file in one task. What the valid pointer names is not touched by the
batch after it, so a batch that broke off anywhere is run again from the same state, and one that was committed is left alone.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVERY, BUCKETS = 8, 16
POINTER = "snapshot int, upto bigint, last bigint, every int, buckets int, owner string, kind string"


@dataclass(frozen=True)
class Pointer:
    """``snapshot`` (0 or 1, -1 for none yet) holds all batches to ``upto``; changes follow to the batch ``last``."""

    snapshot: int
    upto: int
    last: int
    every: int
    buckets: int
    owner: str
    kind: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.kind))

    def changes(self) -> list[int]:
        return [batch % (2 * self.every) for batch in range(self.upto + 1, self.last + 1)]


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def committed(spark: SparkSession, path: str) -> Pointer | None:
    """The pointer of the last committed batch: two rows at most are read."""
    found = []
    for place in (0, 1):
        rows = _read(spark, f"{path}/pointer-{place}", POINTER)
        found += [Pointer(*r) for r in rows.collect()] if rows is not None else []
    return max(found, key=lambda p: p.last, default=None)


def bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _newest(frames: list[DataFrame], key: str) -> DataFrame:
    """The record of the latest batch for each key: one aggregation that shrinks keys in the input tasks."""
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), "batch").alias("_r"))
    return last.select("_r.*")


def _parts(spark: SparkSession, path: str, pointer: Pointer) -> list[DataFrame]:
    stored = pointer.schema.add("batch", T.LongType())
    parts = []
    if pointer.snapshot >= 0:
        parts.append(_read(spark, f"{path}/snapshot-{pointer.snapshot}", T.StructType([*stored.fields, T.StructField("bucket", T.IntegerType())])).drop("bucket"))
    return parts + [_read(spark, f"{path}/changes-{place}", stored) for place in pointer.changes()]


def commit(batch: DataFrame, batch_id: int, path: str, key: str, owner: str = "", every: int = EVERY, buckets: int = BUCKETS) -> None:
    """Stores the records that one batch changed, ids rising by one from batch to batch.

    Every ``every`` batches the snapshot and the changes since become the other snapshot. ``owner`` names the stream, such as its checkpoint: the
    batches of another one, which would count from 0 again, are refused.
    """
    spark = batch.sparkSession
    pointer = committed(spark, path) or Pointer(-1, batch_id - 1, batch_id - 1, every, buckets, owner, json.dumps(batch.schema.jsonValue()))
    if pointer.owner != owner:
        raise ValueError(f"{path} holds the records of {pointer.owner!r}, not of {owner!r}")
    if batch_id <= pointer.last:
        return
    if batch_id != pointer.last + 1:
        raise ValueError(f"{path} ends with batch {pointer.last}, so batch {batch_id} cannot follow")
    place = f"{path}/changes-{batch_id % (2 * pointer.every)}"
    batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(place)
    new = Pointer(pointer.snapshot, pointer.upto, batch_id, pointer.every, pointer.buckets, owner, pointer.kind)
    if batch_id - pointer.upto >= pointer.every:
        records = _newest(_parts(spark, path, new), key).withColumn("bucket", bucket(key, pointer.buckets))
        # One bucket's rows in few files, and several tasks for a large one.
        records = records.hint("rebalance", F.col("bucket"))
        other = 1 - max(pointer.snapshot, 0)
        records.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/snapshot-{other}")
        new = Pointer(other, batch_id, batch_id, pointer.every, pointer.buckets, owner, pointer.kind)
    write_pointer(spark, path, new)


def write_pointer(spark: SparkSession, path: str, pointer: Pointer) -> None:
    row = spark.createDataFrame([tuple(vars(pointer).values())], POINTER).coalesce(1)
    row.write.mode("overwrite").parquet(f"{path}/pointer-{pointer.last % 2}")


def current(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The newest record of each key: one snapshot and at most ``every`` folders of changes are opened."""
    pointer = committed(spark, path)
    if pointer is None:
        raise ValueError(f"{path} holds no records yet")
    return _newest(_parts(spark, path, pointer), key).drop("batch")


def find(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """The record of one key: of the snapshot only its bucket is read."""
    pointer = committed(spark, path)
    if pointer is None:
        raise ValueError(f"{path} holds no records yet")
    stored = pointer.schema.add("batch", T.LongType())
    wanted = F.col(key) == F.lit(value).cast(pointer.schema[key].dataType)
    parts = [_read(spark, f"{path}/changes-{place}", stored).where(wanted) for place in pointer.changes()]
    if pointer.snapshot >= 0:
        number = spark.range(1).select(F.lit(value).cast(pointer.schema[key].dataType).alias(key)).select(bucket(key, pointer.buckets)).first()[0]
        whole = _read(spark, f"{path}/snapshot-{pointer.snapshot}", T.StructType([*stored.fields, T.StructField("bucket", T.IntegerType())]))
        parts.append(whole.where((F.col("bucket") == number) & wanted).drop("bucket"))
    return _newest(parts, key).drop("batch")
