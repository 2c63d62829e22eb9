"""Typed cell rendering: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkdesk.functions import cells as C
from sparkdesk.plans.inputs import table, utc
from sparkdesk.plans.sqltext import iso_clock, iso_instant, iso_local


def cell_null(spark: SparkSession, d: str) -> DataFrame:
    """Source names of German documents are absent, of French ones empty."""
    source = F.when(F.col("lang") == "fr", "").when(F.col("lang") != "de", F.col("source"))
    return table(spark, d, "documents").select("doc_id", C.text_cell(source).alias("cell"))


def cell_int(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        C.plain_text(F.col("l_orderkey")).alias("wide"),
        C.plain_text(-F.col("l_linenumber")).alias("plain"),
        C.signed_text(F.col("l_partkey").cast("int"), 8).alias("narrow8"),
        C.signed_text(F.col("l_orderkey").cast("int") * 11, 16).alias("narrow16"),
    )


def cell_uint(spark: SparkSession, d: str) -> DataFrame:
    raw = -F.col("l_partkey").cast("int") * F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", C.uint_text(raw, 8).alias("u8"), C.uint_text(raw, 16).alias("u16")
    )


def cell_float(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        C.plain_text(F.col("l_extendedprice")).alias("as_double"),
        C.plain_text((F.col("l_quantity") / 8).cast("float")).alias("as_float"),
    )


def cell_bool(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.plain_text(F.col("l_returnflag") == "R").alias("cell"))


def cell_decimal(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        C.plain_text(F.col("l_extendedprice").cast("decimal(12,2)")).alias("scaled"),
        C.unscaled_decimal_text(F.col("l_orderkey") - 500, 4).alias("unscaled"),
    )


def cell_date(spark: SparkSession, d: str) -> DataFrame:
    days = F.unix_date(F.col("l_shipdate").cast("date")) - 20000
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", C.date_text(F.col("l_shipdate")).alias("cell"), C.epoch_day_text(days).alias("raw")
    )


def _micros_of_day():
    """Times of day of which some are whole minutes, seconds or milliseconds."""
    size = F.element_at(F.array(*[F.lit(x) for x in (60_000_000, 1_000_000, 1_000, 1)]), (F.col("event_id") % 4 + 1).cast("int"))
    raw = F.unix_micros(utc(F.col("ts"))) % 86_400_000_000
    return raw - raw % size


def cell_time(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("m", _micros_of_day())
    return events.select(
        "event_id",
        C.time_text((F.col("m") / 1000).cast("int"), "millis").alias("millis"),
        C.time_text(F.col("m"), "micros").alias("micros"),
        C.time_text(F.col("m") * 1000, "nanos").alias("nanos"),
    )


def _stamped(spark: SparkSession, d: str) -> DataFrame:
    """Events moved to 1960, before the epoch, for every odd id, and cut to the same sizes."""
    raw = F.unix_micros(utc(F.col("ts"))) - F.when(F.col("event_id") % 2 == 1, 2_019_686_400_000_000).otherwise(0)
    size = F.element_at(F.array(*[F.lit(x) for x in (60_000_000, 1_000_000, 1_000, 1)]), (F.col("event_id") % 4 + 1).cast("int"))
    return table(spark, d, "events").withColumn("m", raw - F.pmod(raw, size))


def cell_instant(spark: SparkSession, d: str) -> DataFrame:
    return _stamped(spark, d).select(
        "event_id",
        C.instant_text(F.timestamp_micros("m")).alias("stored"),
        C.epoch_text(F.col("m"), "micros").alias("micros"),
        C.epoch_text(F.floor(F.col("m") / 1000), "millis").alias("millis"),
    )


def cell_local_ts(spark: SparkSession, d: str) -> DataFrame:
    moved = F.expr("timestampadd(MICROSECOND, m, timestamp_ntz'1970-01-01 00:00:00')")
    return _stamped(spark, d).select(
        "event_id",
        C.local_timestamp_text(moved).alias("stored"),
        C.epoch_text(F.col("m") * 1000, "nanos", utc=False).alias("nanos"),
    )


def _bytes_of(number, size: int):
    """Little-endian bytes of a number."""
    text = F.lpad(F.hex(number), 2 * size, "0")
    return F.unhex(F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(size))]))


def cell_int96(spark: SparkSession, d: str) -> DataFrame:
    of_day = F.pmod(F.col("m"), F.lit(86_400_000_000))
    day = ((F.col("m") - of_day) / 86_400_000_000).cast("bigint") + C.JULIAN_DAY_OF_EPOCH
    raw = F.concat(_bytes_of(of_day * 1000, 8), _bytes_of(day, 4))
    return _stamped(spark, d).select("event_id", C.int96_text(raw).alias("cell"))


def cell_uuid(spark: SparkSession, d: str) -> DataFrame:
    raw = F.unhex(F.md5(F.col("l_orderkey").cast("string").cast("binary")))
    size = F.when(F.col("l_orderkey") % 10 == 0, 12).otherwise(16)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.uuid_text(F.substring(raw, F.lit(1), size)).alias("cell"))


def cell_binary(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", C.base64_text(F.col("text").cast("binary")).alias("cell"))


def cell_nested(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    row = F.struct("event_id", "event_type", F.array(F.col("user_id"), F.col("event_id")).alias("ids"))
    return events.select(
        "event_id", C.nested_text(row).alias("grouped"), C.plain_text(C.first_element(F.array("user_id", "event_id"))).alias("first")
    )


QUERIES = {
    "cell_null": cell_null,
    "cell_int": cell_int,
    "cell_uint": cell_uint,
    "cell_float": cell_float,
    "cell_bool": cell_bool,
    "cell_decimal": cell_decimal,
    "cell_date": cell_date,
    "cell_time": cell_time,
    "cell_instant": cell_instant,
    "cell_local_ts": cell_local_ts,
    "cell_int96": cell_int96,
    "cell_uuid": cell_uuid,
    "cell_binary": cell_binary,
    "cell_nested": cell_nested,
}

_KEY = "l_orderkey, l_linenumber"
_SIZE = "[60000000, 1000000, 1000, 1][event_id % 4 + 1]"
_DAY = f"""
    with e as (select event_id, epoch_us(ts) % 86400000000 as r, {_SIZE} as s from events),
    t as (select event_id, make_timestamp((r - r % s)::bigint) as t from e)"""
_MOVED = f"""
    with e as (select event_id, epoch_us(ts) - case when event_id % 2 = 1 then 2019686400000000 else 0 end as r,
                      {_SIZE}::bigint as s from events),
    t as (select event_id, make_timestamp(r - ((r % s) + s) % s) as t from e)"""
_MILLIS = "date_trunc('millisecond', t)"

ORACLE = {
    "cell_null": """
        select doc_id, case when lang in ('fr', 'de') then '' else source end as cell from documents""",
    "cell_int": """
        select l_orderkey::varchar as wide, (-l_linenumber)::varchar as plain,
               ((l_partkey % 256) - case when l_partkey % 256 >= 128 then 256 else 0 end)::varchar as narrow8,
               ((l_orderkey * 11 % 65536) - case when l_orderkey * 11 % 65536 >= 32768 then 65536 else 0 end)::varchar as narrow16
        from lineitem""",
    "cell_uint": f"""
        select {_KEY}, ((256 - l_partkey * l_linenumber % 256) % 256)::varchar as u8,
               ((65536 - l_partkey * l_linenumber % 65536) % 65536)::varchar as u16
        from lineitem""",
    "cell_float": f"""
        select {_KEY}, l_extendedprice::varchar as as_double, (l_quantity / 8)::float::varchar as as_float from lineitem""",
    "cell_bool": f"select {_KEY}, case when l_returnflag = 'R' then 'true' else 'false' end as cell from lineitem",
    "cell_decimal": f"""
        select {_KEY}, l_extendedprice::decimal(12,2)::varchar as scaled,
               ((l_orderkey - 500)::decimal(20,0) * 0.0001::decimal(4,4))::decimal(25,4)::varchar as unscaled
        from lineitem""",
    "cell_date": f"""
        select {_KEY}, strftime(l_shipdate, '%Y-%m-%d') as cell, strftime(l_shipdate - interval 20000 day, '%Y-%m-%d') as raw
        from lineitem""",
    "cell_time": f"""
        {_DAY} select event_id, {iso_clock(_MILLIS)} as millis, {iso_clock('t')} as micros, {iso_clock('t')} as nanos from t""",
    "cell_instant": f"""
        {_MOVED} select event_id, {iso_instant('t')} as stored, {iso_instant('t')} as micros,
                        {iso_instant("make_timestamp(epoch_us(t) - ((epoch_us(t) % 1000) + 1000) % 1000)")} as millis from t""",
    "cell_local_ts": f"{_MOVED} select event_id, {iso_local('t')} as stored, {iso_local('t')} as nanos from t",
    "cell_int96": f"{_MOVED} select event_id, {iso_instant('t')} as cell from t",
    "cell_uuid": f"""
        with m as (select {_KEY}, md5(l_orderkey::varchar) as h from lineitem)
        select {_KEY}, case when l_orderkey % 10 = 0 then to_base64(from_hex(substr(h, 1, 24)))
                       else substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
                            || '-' || substr(h, 21, 12) end as cell
        from m""",
    "cell_binary": "select doc_id, to_base64(encode(text)) as cell from documents",
    "cell_nested": """
        select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","ids":[' || user_id || ','
                         || event_id || ']}' as grouped, user_id::varchar as first
        from events""",
}
