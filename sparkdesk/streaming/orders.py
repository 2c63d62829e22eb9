"""Order requests as a stream: validated, priced, and added where absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkdesk.operators.keyed import insert_if_absent
from sparkdesk.operators.orders import append_orders, checked, order_number, price, price_normalised, split_valid, stored_orders, table_checks

# The number ties an order to its day, so keys can only meet within one day's folder.
ORDER_KEYS = ["order_no", "request_id"]
STORED, REJECTED, CONFLICT = "stored", "rejected", "conflict"
DECIDED = "batch_id bigint"
# Begins what stands for the number of a request that gets none; numbers begin otherwise.
NO_NUMBER = "none "


def _of_days(orders: DataFrame, days: tuple) -> DataFrame:
    """Rows of a stored table from the first to the last of these days; no others are read."""
    return orders.where(F.col("order_day").between(F.lit(days[0]), F.lit(days[1])))


def classified(requests: DataFrame) -> DataFrame:
    """Every request as its order, with ``request``, what was asked, ``message``, null for a good one, and ``rank`` among the good ones of its key.

    One pass over the requests, which are dealt out by ``_number``, their order number, and request id as they came: a batch of few large files
    would else be classified in as many tasks. A rejected one has a null order but for its request id; where it has no number, a hash
    of it takes its place, so that such requests never meet.
    """
    none = F.concat(F.lit(NO_NUMBER), F.xxhash64(F.struct(*requests.columns)))
    dealt = requests.withColumn("_number", F.coalesce(order_number(F.col("requested_at"), F.col("request_id")), none)).repartition("_number", "request_id")
    number = F.when(~F.startswith(F.col("_number"), F.lit(NO_NUMBER)), F.col("_number"))
    told = checked(dealt, numbered=True, number=number, beside=["_number"])
    message = F.when(F.size("violations") > 0, F.array_join("violations", "; "))
    orders = price_normalised(told.select("*", F.col("asked").alias("request"), message.alias("message")), "request", "message", "_number", number=number)
    good = F.col("message").isNull()
    names = [c for c in orders.columns if c not in ("request_id", "request", "message", "_number")]
    orders = orders.select("request_id", *[F.when(good, F.col(c)).alias(c) for c in names], "request", "message", "_number")
    # Rows of one key and time in a fixed order, so that a batch that is run again chooses the same.
    own = F.xxhash64(*names)
    rank = F.row_number().over(W.partitionBy("_number", "request_id", good).orderBy("created_at", own))
    return orders.withColumn("rank", rank)


def decide(requests: DataFrame, path: str) -> DataFrame:
    """``classified`` requests with their ``outcome`` against the order table at ``path``: stored, rejected or conflict.

    Requests are ranked and meet the stored keys where they were dealt out. Of the batch itself only the times are read before.
    """
    staged = classified(requests)
    days = requests.agg(F.to_date(F.min("requested_at")), F.to_date(F.max("requested_at"))).first()
    table = T.StructType([*[f for f in staged.schema if f.name in ORDER_KEYS], T.StructField("order_day", T.DateType())])
    present = _of_days(stored_orders(requests.sparkSession, path, table), days)
    present = present.select(F.col("order_no").alias("_number"), "request_id", F.lit(True).alias("_there")).distinct()
    outcome = F.when(F.col("message").isNotNull(), REJECTED).when((F.col("rank") == 1) & F.col("_there").isNull(), STORED).otherwise(CONFLICT)
    return staged.join(present, ["_number", "request_id"], "left").select(*staged.columns, outcome.alias("outcome")).drop("_number", "rank")


def add_orders(requests: DataFrame, path: str, aside: str | None = None, batch_id: int = 0) -> None:
    """One batch of requests into the order table. Running it twice adds nothing the second time.

    Below ``aside`` the batch's folder of ``outcomes`` gets every request with what became of it: stored, rejected with its message, or in
    conflict with an order whose key is stored already or came earlier in the batch. Two places beside it take turns in naming the last batch
    whose outcomes are complete, which is before its first order is stored. A batch that is run again decides anew
    until it is named there, and then only stores what is missing.
    """
    spark = requests.sparkSession
    if aside is None:
        accepted, _ = split_valid(requests)
        orders = price(accepted).where(table_checks())
        days = orders.agg(F.to_date(F.min("created_at")), F.to_date(F.max("created_at"))).first()
        schema = orders.withColumn("order_day", F.lit(None).cast("date")).schema
        existing = _of_days(stored_orders(spark, path, schema), days)
        append_orders(insert_if_absent(orders, existing, ORDER_KEYS, [F.col("created_at"), F.xxhash64(*orders.columns)]), path)
        return
    named = [stored_orders(spark, f"{aside}/decided-{k}", T.StructType([T.StructField("batch_id", T.LongType())])) for k in (0, 1)]
    again = bool(named[0].unionByName(named[1]).where(F.col("batch_id") >= batch_id).take(1))
    folder = f"{aside}/outcomes/batch_id={batch_id}"
    if not again:
        decide(requests, path).write.mode("overwrite").partitionBy("outcome").parquet(folder)
        last = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id")).coalesce(1)
        last.write.mode("overwrite").parquet(f"{aside}/decided-{batch_id % 2}")
    fresh = spark.read.parquet(folder).where(F.col("outcome") == STORED).drop("request", "message", "outcome")
    if again:
        days = fresh.agg(F.to_date(F.min("created_at")), F.to_date(F.max("created_at"))).first()
        schema = T.StructType([*fresh.schema.fields, T.StructField("order_day", T.DateType())])
        fresh = fresh.join(_of_days(stored_orders(spark, path, schema), days).select(*ORDER_KEYS), ORDER_KEYS, "left_anti")
        if fresh.isEmpty():
            return
    append_orders(fresh, path)


def outcomes(spark: SparkSession, aside: str) -> DataFrame:
    """Every request of the stream: its order, ``request``, ``message``, ``outcome`` and ``batch_id``."""
    return spark.read.parquet(f"{aside}/outcomes")


def stream_orders(requests: DataFrame, path: str, checkpoint: str, aside: str | None = None, **trigger) -> StreamingQuery:
    """``trigger`` is what ``DataStreamWriter.trigger`` takes; all available input by default.

    What became of each request goes below ``aside``, which is ``<path>-aside`` by default; see ``outcomes``.
    """
    aside = aside or f"{path.rstrip('/')}-aside"

    def add(batch: DataFrame, batch_id: int) -> None:
        add_orders(batch, path, aside, batch_id)

    return (
        requests.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
