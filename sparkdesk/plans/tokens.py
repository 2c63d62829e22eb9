"""Signed tokens: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.functions.cells import instant_text
from sparkdesk.operators import tokens as T
from sparkdesk.plans.inputs import table, utc
from sparkdesk.plans.sqltext import iso_instant

# A key for these queries only; it signs nothing else.
KEY = bytes(range(1, 33))
NOW_SECONDS = 1_704_067_200


def tokens(spark: SparkSession, d: str) -> DataFrame:
    """A token per customer; by number some are expired, altered, cut, of another algorithm, or without a user."""
    key = F.col("c_custkey")
    user = F.to_json(
        F.struct(
            key.cast("string").alias("id"),
            F.col("c_name").alias("username"),
            F.array(F.lower("c_mktsegment"), F.lit("reader")).alias("roles"),
            F.array(F.concat(F.lit("nation:"), "c_nationkey")).alias("permissions"),
            ((NOW_SECONDS + key) * 1000).alias("expiry"),
        )
    )
    expiry = F.when(key % 10 == 1, NOW_SECONDS - 1 - key).otherwise(NOW_SECONDS + 60 + key)
    payload = F.to_json(F.struct(F.lit("s").alias("sub"), expiry.alias("exp"), F.when(key % 10 != 5, user).alias("userInfo")))
    head = F.when(key % 10 == 2, '{"alg":"HS512"}').otherwise('{"alg":"HS256"}')
    made = table(spark, d, "customer").withColumn(
        "_m", F.concat(T.base64url(head.cast("binary")), F.lit("."), T.base64url(payload.cast("binary")))
    )
    sign = T.base64url(T.hmac(F.col("_m"), KEY, "HS256"))
    token = (
        F.when(key % 10 == 3, F.concat("_m", F.lit("."), F.translate(sign, "AB", "BA"), F.lit("AAAA")))
        .when(key % 10 == 4, F.col("_m")).otherwise(F.concat("_m", F.lit("."), sign))
    )
    return made.select("c_custkey", token.alias("token"))


def verify_tokens(spark: SparkSession, d: str) -> DataFrame:
    now = F.timestamp_seconds(F.lit(NOW_SECONDS))
    user = F.col("user")
    return T.verify(tokens(spark, d), "token", KEY, now).select(
        "c_custkey", "token_status", user["id"].alias("id"), user["username"].alias("username"),
        F.array_join(user["roles"], ",").alias("roles"), F.array_join(user["permissions"], ",").alias("permissions"),
        instant_text(user["expiry"]).alias("expiry"),
    )


def token_expiry(spark: SparkSession, d: str) -> DataFrame:
    """Events as tokens that live as many minutes as their value; every fifth has no expiry."""
    created = utc(F.col("ts"))
    expiry = F.when(F.col("event_id") % 5 != 0, created + F.make_interval(mins=F.floor("value").cast("int")))
    return table(spark, d, "events").select("event_id", instant_text(T.effective_expiry(expiry, created)).alias("expiry"))


QUERIES = {"verify_tokens": verify_tokens, "token_expiry": token_expiry}

_OK = "token_status = 'ok' and c_custkey % 10 <> 5"

ORACLE = {
    "verify_tokens": f"""
        with t as (select *, case c_custkey % 10 when 1 then 'expired' when 2 then 'wrong_algorithm' when 3 then 'bad_signature'
                             when 4 then 'malformed' else 'ok' end as token_status from customer)
        select c_custkey, token_status, case when {_OK} then c_custkey::varchar end as id, case when {_OK} then c_name end as username,
               case when {_OK} then lower(c_mktsegment) || ',reader' end as roles,
               case when {_OK} then 'nation:' || c_nationkey end as permissions,
               case when {_OK} then strftime(make_timestamp((1704067200 + c_custkey) * 1000000), '%Y-%m-%dT%H:%M:%SZ') end as expiry
        from t""",
    "token_expiry": f"""
        with t as (select event_id, ts + to_minutes(case when event_id % 5 = 0 then 120
                                                    else greatest(floor(value), 120) end::int) as t from events)
        select event_id, {iso_instant('t')} as expiry from t""",
}
