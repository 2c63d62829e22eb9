"""Scans, sinks and export: queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions.cells import base64_text, instant_text, local_timestamp_text
from sparkdesk.functions.links import export_base_name, safe_entry_name
from sparkdesk.functions.strings import csv_escape
from sparkdesk.operators import export as E
from sparkdesk.operators.orders import append_orders
from sparkdesk.plans.inputs import table
from sparkdesk.plans.orders import REQUESTS_SQL, priced
from sparkdesk.plans.sqltext import escaped, iso_instant, iso_local
from sparkdesk.session import scratch_path
from sparkdesk.sources.demo import FACTOR, FOLD, MASK, STREAMS, demo_columns, stream_start
from sparkdesk.sources.seeds import load_seeds
from sparkdesk.sources.tables import scan


def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", local_timestamp_text(F.col("l_shipdate")).alias("l_shipdate"),
    )


def csv_lines(spark: SparkSession, d: str) -> DataFrame:
    return E.csv_lines(table(spark, d, "events"))


def _read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(header="true", multiLine="true", escape='"', lineSep="\n").csv(path)


DOC_SCHEMA = "doc_id string, text string, lang string, source string, n_chars string"


def write_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    E.write_csv(table(spark, d, "documents"), path)
    return _read_csv(spark, path, DOC_SCHEMA)


def write_csv_compressed(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "csv-gz")
    E.write_csv_compressed(table(spark, d, "documents"), path, level=6)
    return _read_csv(spark, path, DOC_SCHEMA)


def write_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    E.write_parquet(table(spark, d, "documents"), path)
    return scan(spark, path)


def export(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "export")
    chosen = E.export(table(spark, d, "pages"), path, " Csv ")
    pages = _read_csv(spark, path, "page_id string, url string, html string")
    return pages.withColumn("format", F.lit(chosen))


def generate_demo(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row"))
    made = demo_columns(keys, F.col("row"))
    return made.select(
        "i32", "i64", instant_text(F.col("t96")).alias("t96"), "f32", "b", "d64", base64_text(F.col("bin")).alias("bin")
    )


def write_int96(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "int96")
    events = table(spark, d, "events")
    stamped = events.select("event_id", F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp").alias("ts"))
    E.write_int96(stamped, path)
    return spark.read.parquet(path).select("event_id", instant_text(F.col("ts")).alias("ts"))


def seeds(spark: SparkSession, d: str) -> DataFrame:
    """The stored orders after the seeds were loaded twice."""
    path, now = scratch_path(spark, "orders"), F.lit("2024-06-01 12:00:00Z").cast("timestamp")
    append_orders(priced(spark, d), path)
    load_seeds(spark, path, now)
    load_seeds(spark, path, now)
    return spark.read.parquet(path).select(
        "order_no", "customer_name", "quantity", "unit_price", "shipping_fee",
        instant_text(F.col("created_at")).alias("created_at"),
    )


def export_stats(spark: SparkSession, d: str) -> DataFrame:
    """What a write in each format came to. A CSV document has one header, its parts one each; compressed sizes are only compared."""
    docs = table(spark, d, "documents")
    told = [E.export_counted(docs, scratch_path(spark, f"export-{fmt}"), fmt) for fmt in E.FORMATS]
    rows = told[0].unionByName(told[1]).unionByName(told[2])
    one_header = F.col("bytes") - (F.col("files") - 1) * E.header_bytes(docs)
    csv = F.max(F.when(F.col("format") == "csv", F.col("bytes"))).over(W.partitionBy())
    rows = rows.withColumn("smaller", (F.col("bytes") > 0) & (F.col("bytes") < csv))
    return rows.select("format", "rows", F.when(F.col("format") == "csv", one_header).alias("bytes"), "smaller")


def export_text_stats(spark: SparkSession, d: str) -> DataFrame:
    return E.export_stats(table(spark, d, "documents"))


def csv_escaped(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", csv_escape(F.col("text")).alias("cell"))


def entry_names(spark: SparkSession, d: str) -> DataFrame:
    """Links as names; every twentieth one stands for a name that needs the default."""
    key = F.col("page_id") % 20
    name = F.when(key == 1, "..").when(key == 2, ".").when(key == 3, "  ").otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", safe_entry_name(name).alias("entry"))


def base_names(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("page_id") % 20
    name = F.when(key == 1, ".parquet").when(key == 2, "").otherwise(F.concat("url", F.lit(".parquet")))
    return table(spark, d, "pages").select("page_id", export_base_name(name).alias("base"))


QUERIES = {
    "scan_parquet": scan_parquet,
    "csv_lines": csv_lines,
    "write_csv": write_csv,
    "write_csv_compressed": write_csv_compressed,
    "write_parquet": write_parquet,
    "export": export,
    "generate_demo": generate_demo,
    "write_int96": write_int96,
    "seed_orders": seeds,
    "export_stats": export_stats,
    "export_text_stats": export_text_stats,
    "csv_escape": csv_escaped,
    "safe_entry_name": entry_names,
    "export_base_name": base_names,
}


_DOCS = "select doc_id::varchar as doc_id, text, lang, source, n_chars::varchar as n_chars from documents"


def _mixed_sql() -> str:
    """The hash streams of the generated table, stage by stage."""
    start = ", ".join(f"((r & {MASK}) + {stream_start(1234567, n)}) & {MASK} as {n}" for n in STREAMS)
    stages = [f"s0 as (select (r >> 31) & {MASK} as high, {start} from (select l_orderkey * 8 + l_linenumber as r from lineitem))"]
    for turn in range(3):
        mixed = {n: f"(xor({n}, {n} >> {FOLD}) * {FACTOR}) & {MASK}" for n in STREAMS}
        columns = ", ".join(f"xor({c}, high) as {n}" if turn == 0 else f"{c} as {n}" for n, c in mixed.items())
        stages.append(f"s{turn + 1} as (select high, {columns} from s{turn})")
    stages.append("m as (select " + ", ".join(f"xor({n}, {n} >> {FOLD}) as {n}" for n in STREAMS) + " from s3)")
    return ", ".join(stages)


def _made(name: str, value: str) -> str:
    return f"case when {name}_null % 10 <> 0 then {value} end as {name}"


_BIN = " || ".join(f"chr((bin_{part} // {94**i} % 94 + 33)::int)" for part in "abcd" for i in range(4))

ORACLE = {
    "scan_parquet": f"select * exclude (l_shipdate), {iso_local('l_shipdate')} as l_shipdate from lineitem",
    "csv_lines": f"""
        select 'event_id,ts,user_id,event_type,value,props' as line
        union all
        select event_id || ',' || {iso_local('ts')} || ',' || user_id || ',' || {escaped('event_type')} || ',' || value
               || ',' || {escaped('props')}
        from events""",
    "write_csv": _DOCS,
    "write_csv_compressed": _DOCS,
    "write_parquet": "select * from documents",
    "export": "select page_id::varchar as page_id, url, html, 'csv' as format from pages",
    "generate_demo": f"""
        with {_mixed_sql()}
        select {_made('i32', "(i32_a * 2 + i32_b % 2 - 2147483648)::int")},
               {_made('i64', "(i64_a * 2147483648 + i64_b - 2305843009213693952) * 4 + i64_c % 4")},
               {_made('t96', iso_instant("make_timestamp((1704067200000 + t96_a % 1000000) * 1000)"))},
               {_made('f32', "((f32_a >> 7) / 16777216.0::double)::float")},
               {_made('b', "b_a % 2 = 0")},
               {_made('d64', "((d64_a * 2147483648 + d64_b) >> 9)::double / 9007199254740992::double")},
               {_made('bin', f"to_base64(encode({_BIN}))")}
        from m""",
    "write_int96": f"select event_id, {iso_instant('ts')} as ts from events",
    "seed_orders": f"""
        with {REQUESTS_SQL}
        select order_no, customer_name, quantity, unit_price, shipping_fee, {iso_instant('created_at')} as created_at from priced
        union all
        select 'PO-DEMO-0001', 'Alice Chen', 2, 129.00::decimal(12,2), 18.00::decimal(12,2), '2024-06-01T11:45:00Z'
        union all
        select 'PO-DEMO-0002', 'Bob Li', 1, 299.00::decimal(12,2), 26.00::decimal(12,2), '2024-06-01T11:52:00Z'""",
    "export_stats": f"""
        with s as (
            select count(*) as rows,
                (sum(strlen(doc_id || ',' || {escaped('text')} || ',' || lang || ',' || source || ',' || n_chars) + 1)
                 + strlen('doc_id,text,lang,source,n_chars') + 1)::bigint as bytes
            from documents)
        select format, rows, case when format = 'csv' then bytes end as bytes, format <> 'csv' as smaller
        from s, (select unnest(['parquet', 'csv', 'zip']) as format)""",
    "export_text_stats": f"""
        select 'csv' as format, count(*) as rows,
               (sum(strlen(doc_id || ',' || {escaped('text')} || ',' || lang || ',' || source || ',' || n_chars) + 1)
                + strlen('doc_id,text,lang,source,n_chars') + 1)::bigint as bytes
        from documents""",
    "csv_escape": f"select doc_id, {escaped('text')} as cell from documents",
    "safe_entry_name": """
        select page_id, case when page_id % 20 in (1, 2, 3) then 'data.csv' else replace(url, '/', '_') end as entry
        from pages""",
    "export_base_name": "select page_id, case when page_id % 20 in (1, 2) then 'data' else url end as base from pages",
}
