"""The provided tables, and the request, landed-JSON and log tables that stand in for real input.

The stand-ins are row-wise projections or joins of whole tables, so they grow with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.sources.tables import scan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan(spark, f"{folder}/{name}.parquet")


def utc(c):
    """The instant of a zone-free column that is meant as UTC, the zone of the session."""
    return c.cast("timestamp")


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Order requests: all events with their customer and part; some break a rule of requests or of the order table on purpose."""
    events = table(spark, folder, "events")
    parts = table(spark, folder, "part")
    part_count = parts.agg(F.count("*")).scalar()
    bought = events.select(
        F.col("event_id").alias("request_id"),
        F.col("user_id").alias("c_custkey"),
        F.pmod("event_id", part_count).alias("p_partkey"),
        F.get_json_object("props", "$.k").cast("int").alias("quantity"),
        F.when(F.col("event_id") % 89 == 3, F.lit(0))
        .when(F.col("event_id") % 101 == 9, F.lit(99999999999))
        .when(F.col("event_id") % 97 != 5, F.col("value").cast("decimal(12,2)") * F.lit(1.005).cast("decimal(4,3)"))
        .cast("decimal(16,5)")
        .alias("unit_price"),
        utc(F.col("ts")).alias("requested_at"),
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    skus = parts.select("p_partkey", F.lower(F.concat_ws("-", "p_brand", F.col("p_partkey").cast("string"))).alias("sku"))
    named = bought.join(customers, "c_custkey", "left")
    whole = named.join(skus, "p_partkey", "left")
    tier = F.when(F.col("c_mktsegment") == "MACHINERY", " platinum").when(F.col("c_mktsegment") == "FURNITURE", "Gold\t")
    return whole.select(
        "request_id",
        F.when(F.col("c_custkey") % 50 == 7, " \t ")
        .when(F.col("request_id") % 103 == 11, F.repeat("c_name", F.lit(4)))
        .otherwise(F.concat(F.lit(" "), "c_name", F.lit("\n")))
        .alias("customer_name"),
        tier.otherwise("silver").alias("customer_tier"),
        F.col("sku").alias("sku_code"),
        "quantity",
        "unit_price",
        F.lit(None).cast("string").alias("remark"),
        "requested_at",
    )


def video_id(number):
    return F.concat(F.lit("BV"), F.lpad(number.cast("string"), 10, "0"))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """``(conv_id, turn, v, text)``: every turn of every conversation is a video, number ``v``."""
    return table(spark, folder, "conversations").select("conv_id", "turn", (F.col("conv_id") * 8 + F.col("turn")).alias("v"), "text")


def urls(spark: SparkSession, folder: str) -> DataFrame:
    """Links to videos: two pages link to all turns of a conversation, some without an id, some to no conversation that is there."""
    pages = table(spark, folder, "pages").withColumn("conv", F.floor(F.col("page_id") / 2))
    linked = pages.join(turns(spark, folder).select("conv_id", "turn"), F.col("conv") == F.col("conv_id"), "left")
    turn = F.coalesce("turn", F.lit(0))
    tail = F.regexp_extract("url", r"[?#].*$", 0)
    path = F.when(F.col("page_id") % 20 == 7, "watch").otherwise(F.concat(F.lit("video/"), video_id(F.col("conv") * 8 + turn)))
    return linked.select(
        F.concat(F.lit("https://v.example.com/"), path, tail).alias("url"), F.lit(0).alias("src"), (F.col("page_id") * 8 + turn).alias("pos")
    )


def views(spark: SparkSession, folder: str) -> DataFrame:
    """``(bvid, payload)`` per turn, whole texts as titles and parts: failures, absent ids, absent titles and blank parts among them."""
    v = F.col("v")
    second = F.when(v % 4 == 1, F.lit(" ")).otherwise(F.concat(F.lit("2. "), "text"))
    pages = F.transform(
        F.sequence(F.lit(1).cast("bigint"), 1 + v % 3),
        lambda i: F.struct(
            F.when((i == 2) & (v % 5 == 1), 0).otherwise(v * 100 + i).alias("cid"),
            F.when(i == 1, F.lit("Part: one")).when(i == 2, second).otherwise(F.col("text")).alias("part"),
        ),
    )
    data = F.struct(
        F.when(v % 19 == 5, 0).otherwise(v + 1).alias("aid"),
        (v * 100 + 50).alias("cid"),
        F.when(v % 7 != 2, F.col("text")).alias("title"),
        pages.alias("pages"),
    )
    failed = v % 17 == 3
    payload = F.struct(
        F.when(failed, -404).otherwise(0).alias("code"), F.when(failed, "not found").otherwise("OK").alias("message"),
        F.when(~failed, data).alias("data"),
    )
    return turns(spark, folder).select(video_id(v).alias("bvid"), F.to_json(payload).alias("payload"))


# Track lists by ``(video + cid) % 5``: (lan, lan_doc) in order.
TRACKS = (
    (),
    (("en", "English"), ("zh-CN", "中文（中国）")),
    (("ja", "日本語"), ("xx", "中文（自动）")),
    (("en", "English"), ("ja", "日本語")),
    (("en", "English"), ("zh", "")),
)


def _parts(spark: SparkSession, folder: str) -> DataFrame:
    """``(v, text, cid)``: one to three parts of every turn."""
    number = F.explode(F.sequence(F.lit(1).cast("bigint"), 1 + F.col("v") % 3))
    return turns(spark, folder).select("v", "text", number.alias("i")).withColumn("cid", F.col("v") * 100 + F.col("i"))


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    """``(cid, aid, payload)`` for the parts of every turn, but for one turn in eleven, and for every turn itself."""
    parts = _parts(spark, folder).where("v % 11 != 4").select("v", "cid")
    whole = turns(spark, folder).select("v", (F.col("v") * 100 + 50).alias("cid"))

    def entry(lan: str, words: str):
        link = F.concat(F.lit("//s.example.com/" if lan != "en" else "http://s.example.com/"), F.col("cid"), F.lit(f"/{lan}.json"))
        return F.struct(
            F.lit(lan).alias("lan"), F.lit(words).alias("lan_doc"), (F.lit(" ") if lan == "zh" else link).alias("subtitle_url")
        )

    choice = F.when(F.lit(False), F.array(entry("", "")))
    for key, entries in enumerate(TRACKS):
        made = F.array(*[entry(*e) for e in entries]) if entries else F.slice(F.array(entry("", "")), 1, 0)
        choice = choice.when((F.col("v") + F.col("cid")) % 5 == key, made)
    payload = F.struct(F.lit(0).alias("code"), F.struct(F.struct(choice.alias("subtitles")).alias("subtitle")).alias("data"))
    return parts.unionByName(whole).select("cid", (F.col("v") + 1).alias("aid"), F.to_json(payload).alias("payload"))


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """``(url, payload)``: the lines of each turn as one caption file per part and language; every seventh is empty."""
    lines = F.transform(F.split("text", "\n"), lambda t: F.named_struct(F.lit("content"), F.concat(F.lit(" \t"), t, F.lit(" "))))
    noise = F.array(F.struct(F.lit("  ").alias("content")), F.struct(F.lit(None).cast("string").alias("content")))
    kept = F.when(F.col("v") % 7 == 6, noise).otherwise(F.concat(noise, lines))
    langs = F.explode(F.array(*[F.lit(x) for x in ("en", "zh-CN", "ja", "xx")])).alias("lan")
    made = _parts(spark, folder).select("cid", kept.alias("body")).select("cid", F.to_json(F.struct("body")).alias("payload"), langs)
    return made.select(F.concat(F.lit("https://s.example.com/"), "cid", F.lit("/"), "lan", F.lit(".json")).alias("url"), "payload")


def job_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as updates of one submission per user: a signup inserts, the others set one group of fields."""
    kind = (
        F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "click", "application_id")
        .when(F.col("event_type") == "view", "launcher_state").when(F.col("event_type") == "purchase", "yarn_status")
        .otherwise("last_error")
    )
    return table(spark, folder, "events").select(*job_log_columns(kind))


def job_log_columns(kind) -> list:
    k = F.get_json_object("props", "$.k").cast("int")

    def only(which: str, value):
        return F.when(kind == which, value)

    return [
        F.concat(F.lit("sub-"), "user_id").alias("submission_id"),
        "event_id",
        "ts",
        kind.alias("kind"),
        only("insert", F.concat(F.lit("job-"), "event_id")).alias("job_name"),
        only("insert", F.when(k % 2 == 0, "root.batch").otherwise("root.adhoc")).alias("queue"),
        only("application_id", F.when(k % 10 != 0, F.concat(F.lit("application_"), k, F.lit("_"), "user_id"))).alias("application_id"),
        only("launcher_state", F.when(k % 3 == 0, "RUNNING").when(k % 3 == 1, "CONNECTED")).alias("launcher_state"),
        only("yarn_status", F.when(k < 50, "RUNNING").otherwise("FINISHED")).alias("yarn_state"),
        only("yarn_status", F.when(k >= 50, "SUCCEEDED")).alias("final_status"),
        only("yarn_status", F.concat(F.lit("http://rm/"), k)).alias("tracking_url"),
        only("last_error", F.concat(F.lit("code "), k)).alias("last_error"),
    ]
