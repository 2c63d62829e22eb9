"""Cell texts: literal values, files with types Spark cannot infer, and CSV bytes."""

import base64
import datetime as dt
import decimal
import glob
import gzip
import random
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkdesk.functions import cells as C
from sparkdesk.operators import export as E
from sparkdesk.sources.demo import generate
from sparkdesk.sources.tables import mark, scan


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "column, text",
    [
        (lambda: C.base64_text(F.lit(bytes([0xFF, 0, 0x41]))), "/wBB"),
        (lambda: C.base64_text(F.lit(bytes(200))), base64.b64encode(bytes(200)).decode()),
        (lambda: C.unscaled_decimal_text(F.lit(12345), 2), "123.45"),
        (lambda: C.unscaled_decimal_text(F.lit(1), 10), "0.0000000001"),
        (lambda: C.unscaled_decimal_text(F.lit(7), 0), "7"),
        (lambda: C.epoch_day_text(F.lit(0)), "1970-01-01"),
        (lambda: C.epoch_day_text(F.lit(-1)), "1969-12-31"),
        (lambda: C.uint_text(F.lit(-1), 16), "65535"),
        (lambda: C.uint_text(F.lit(-1), 8), "255"),
        (lambda: C.signed_text(F.lit(255), 8), "-1"),
        (lambda: C.time_text(F.lit(1), "millis"), "00:00:00.001"),
        (lambda: C.time_text(F.lit(1), "micros"), "00:00:00.000001"),
        (lambda: C.time_text(F.lit(1), "nanos"), "00:00:00.000000001"),
        (lambda: C.time_text(F.lit(0), "millis"), "00:00"),
        (lambda: C.time_text(F.lit(61_000), "millis"), "00:01:01"),
        (lambda: C.time_text(F.lit(86_399_999_999_999), "nanos"), "23:59:59.999999999"),
        (lambda: C.epoch_text(F.lit(1000), "millis"), "1970-01-01T00:00:01Z"),
        (lambda: C.epoch_text(F.lit(-1), "micros"), "1969-12-31T23:59:59.999999Z"),
        (lambda: C.epoch_text(F.lit(-1), "nanos"), "1969-12-31T23:59:59.999999999Z"),
        (lambda: C.epoch_text(F.lit(0), "micros", utc=False), "1970-01-01T00:00"),
        (lambda: C.epoch_text(F.lit(1_000_000), "micros", utc=False), "1970-01-01T00:00:01"),
        (lambda: C.int96_text(F.lit((3_000_000_000).to_bytes(8, "little") + (2440588).to_bytes(4, "little"))), "1970-01-01T00:00:03Z"),
        (lambda: C.uuid_text(F.lit(uuid.UUID("123e4567-e89b-12d3-a456-426614174000").bytes)), "123e4567-e89b-12d3-a456-426614174000"),
        (lambda: C.uuid_text(F.lit(b"abc")), "YWJj"),
        (lambda: C.plain_text(F.lit(1e10)), "1.0E10"),
    ],
)
def test_literals(spark, column, text):
    assert one(spark, column()) == text


def test_instant_text_does_not_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, C.instant_text(F.timestamp_micros(F.lit(1_000_000)))) == "1970-01-01T00:00:01Z"
        gap = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
        assert one(spark, C.local_timestamp_text(gap)) == "2024-03-10T02:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_scan_with_overrides(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    id_ = uuid.UUID("123e4567-e89b-12d3-a456-426614174000")
    table = pa.table(
        {
            "u": pa.ExtensionArray.from_storage(pa.uuid(), pa.array([id_.bytes, None], pa.binary(16))),
            "tms": pa.array([1, None], pa.time32("ms")),
            "tus": pa.array([1, None], pa.time64("us")),
            "tns": pa.array([1, None], pa.time64("ns")),
            "ns": pa.array([1_000_000_001, None], pa.timestamp("ns", tz="UTC")),
            "lns": pa.array([1_000_000_000, None], pa.timestamp("ns")),
            "u8": pa.array([255, None], pa.uint8()),
            "u16": pa.array([65535, None], pa.uint16()),
            "dec": pa.array([decimal.Decimal("123.45"), None], pa.decimal128(9, 2)),
            "us": pa.array([dt.datetime(1970, 1, 1, 0, 0, 1), None], pa.timestamp("us", tz="UTC")),
            "raw": pa.array([b"\xff\x00A", None], pa.binary()),
        }
    )
    pq.write_table(table, path, version="2.6")
    df = scan(
        spark, path,
        {"u": "uuid", "tms": "time_millis", "tus": "time_micros", "tns": "time_nanos", "ns": "instant_nanos", "lns": "local_nanos"},
        "u binary, tms int, tus bigint, tns bigint, ns bigint, lns bigint, u8 smallint, u16 int, dec decimal(9,2), us timestamp, raw binary",
    )
    lines = [r["line"] for r in E.csv_lines(df).collect()]
    assert lines == [
        "u,tms,tus,tns,ns,lns,u8,u16,dec,us,raw",
        "123e4567-e89b-12d3-a456-426614174000,00:00:00.001,00:00:00.000001,00:00:00.000000001,"
        "1970-01-01T00:00:01.000000001Z,1970-01-01T00:00:01,255,65535,123.45,1970-01-01T00:00:01Z,/wBB",
        ",,,,,,,,,,",
    ]
    with pytest.raises(ValueError):
        mark(df, {"u": "nothing"})
    with pytest.raises(ValueError):
        mark(df, {"absent": "uuid"})


def text_of(path, pattern="part-*"):
    return "".join(open(f, newline="", encoding="utf8").read() for f in sorted(glob.glob(f"{path}/{pattern}")))


CSV = 'a,b\n"你好, ""x""","line1\nline2"\n'


def test_csv_bytes(spark, tmp_path):
    df = spark.createDataFrame([('你好, "x"', "line1\nline2")], "a string, b string").coalesce(1)
    assert "".join(r["line"] + "\n" for r in E.csv_lines(df).collect()) == CSV
    E.write_csv(df, str(tmp_path / "parts"))
    assert text_of(tmp_path / "parts") == CSV
    E.write_csv(df, str(tmp_path / "concat"), layout="concat")
    assert text_of(tmp_path / "concat") == CSV
    with pytest.raises(ValueError):
        E.write_csv(df, str(tmp_path / "x"), layout="other")


def test_csv_lines_with_another_rule(spark):
    df = spark.createDataFrame([("a,b", 1)], "s string, n int").coalesce(1)
    lines = E.csv_lines(df, lambda c, field: F.concat(F.lit(field.name + "="), c.cast("string")))
    assert [r["line"] for r in lines.collect()] == ["s,n", '"s=a,b",n=1']


def test_csv_sink_equals_lines(spark, tmp_path):
    rows = [(" a ", None, 1.5), ("", "\r", None), (None, '\\"', float("nan")), ("#", "x,y", 0.1)]
    df = spark.createDataFrame(rows, "a string, `b,c` string, d double").coalesce(1)
    want = "".join(r["line"] + "\n" for r in E.csv_lines(df).collect())
    E.write_csv(df, str(tmp_path / "out"))
    assert text_of(tmp_path / "out") == want


def test_csv_sink_equals_lines_on_random_text(spark, tmp_path):
    pick = random.Random(7)
    alphabet = ["a", "é", "#", '"', ",", "\n", "\r", " ", "\t", "\\", "\x00", "\x01", "'", ";", "\ufeff", "\u00a0"]

    def text():
        return None if pick.random() < 0.1 else "".join(pick.choices(alphabet, k=pick.randrange(5)))

    df = spark.createDataFrame([(text(), text()) for _ in range(4000)], "a string, b string").coalesce(1)
    want = "".join(r["line"] + "\n" for r in E.csv_lines(df).collect())
    E.write_csv(df, str(tmp_path / "out"))
    assert text_of(tmp_path / "out") == want


def test_one_column_keeps_empty_rows(spark, tmp_path):
    df = spark.createDataFrame([("x",), (None,), ("",), ("y",)], "a string").coalesce(1)
    E.write_csv(df, str(tmp_path / "one"))
    assert text_of(tmp_path / "one") == "a\nx\n\n\ny\n"


@pytest.mark.parametrize("level", [-3, 0, 1, 9, 99])
def test_compressed(spark, tmp_path, level):
    df = spark.range(2000).select(F.col("id"), F.md5(F.col("id").cast("string").cast("binary")).alias("h")).coalesce(1)
    E.write_csv_compressed(df, str(tmp_path / "z"), level)
    (file,) = glob.glob(f"{tmp_path}/z/part-*.gz")
    data = open(file, "rb").read()
    text = gzip.decompress(data).decode()
    assert text == "".join(r["line"] + "\n" for r in E.csv_lines(df).collect())
    assert (len(data) > len(text)) == (level == 0)


@pytest.mark.parametrize("raw, chosen", [(None, "zip"), (" ", "zip"), (" csv ", "csv"), ("PARQUET", "parquet"), ("Zip", "zip")])
def test_export_dispatch(spark, tmp_path, raw, chosen):
    assert E.export(spark.range(3), str(tmp_path / "o"), raw) == chosen
    suffix = {"zip": "csv.gz", "csv": "csv", "parquet": "snappy.parquet"}
    # one-column tables go through the line writer, hence txt
    found = glob.glob(f"{tmp_path}/o/part-*")
    assert found and all(f.endswith((suffix[chosen], "txt", "txt.gz")) for f in found)


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError):
        E.export(spark.range(3), str(tmp_path / "o"), "xml")


def test_counted_write_equals_stats(spark, tmp_path):
    df = spark.createDataFrame([("é,", 1), (None, 2)], "a string, b int")
    counted = E.write_csv_counted(df, str(tmp_path / "c"))
    stats = E.export_stats(df).first()
    size = len(text_of(tmp_path / "c").encode())
    assert (counted["rows"], counted["bytes"]) == (stats["rows"], stats["bytes"]) == (2, size)


def test_generated_table(spark):
    df = generate(spark, 20_000)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in df.schema] == [
        "i32 int", "i64 bigint", "t96 timestamp", "f32 float", "b boolean", "d64 double", "bin binary",
    ]
    shares = df.select([F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).first()
    assert all(0.085 < s < 0.115 for s in shares)
    r = df.select(
        F.min("d64"), F.max("d64"), F.min("f32"), F.max("f32"), F.min("i64"), F.max("i64"), F.min("i32"), F.max("i32"),
        F.min(F.length("bin")), F.max(F.length("bin")), F.bool_and(F.col("bin").cast("string").rlike("^[!-~]{16}$")),
        (F.unix_millis(F.max("t96")) - F.unix_millis(F.min("t96"))),
    ).first()
    assert 0 <= r[0] < 0.01 and 0.99 < r[1] < 1 and 0 <= r[2] < 0.01 and 0.99 < r[3] < 1
    assert r[4] < -(2**62) and r[5] > 2**62 and r[6] < -(2**30) and r[7] > 2**30
    assert (r[8], r[9], r[10]) == (16, 16, True) and 900_000 < r[11] < 1_000_000
    again = generate(spark, 20_000).repartition(3)
    assert df.exceptAll(again).isEmpty()
    assert not df.exceptAll(generate(spark, 20_000, seed=5)).isEmpty()


def test_one_column_tables_keep_their_header(spark, tmp_path):
    """Without rows, with empty cells, and in files cut by a number of rows."""
    import glob

    read = lambda path: ["".join(open(f)) for f in sorted(glob.glob(f"{path}/part-*"))]
    E.write_csv(spark.createDataFrame([], "a string"), str(tmp_path / "none"))
    assert "".join(read(tmp_path / "none")) == "a\n"
    rows = spark.createDataFrame([("x",), (None,), ("",), ("y,z",), ("w",)], "a string").coalesce(1)
    E.write_csv(rows, str(tmp_path / "cut"), maxRecordsPerFile="2")
    assert read(tmp_path / "cut") == ["a\nx\n\n", 'a\n\n"y,z"\n', "a\nw\n"]
    E.write_csv_compressed(rows.where("false"), str(tmp_path / "gz"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "gz")).columns == ["a"]


def test_one_column_stream_keeps_its_header(spark, tmp_path):
    import glob

    from sparkdesk.streaming.export import stream_export

    for part in (["x", ""], ["y"]):
        spark.createDataFrame([(v,) for v in part], "a string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("a string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream_export(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    texts = sorted("".join(open(f)) for f in glob.glob(f"{tmp_path}/out/batch=*/part-*"))
    assert texts == ["a\nx\n\n", "a\ny\n"]


def test_counts_of_each_format_come_from_its_write(spark, tmp_path):
    import glob
    import os

    rows = spark.range(100).select("id", F.concat(F.lit("text "), "id").alias("t")).repartition(3)
    for fmt in E.FORMATS:
        told = E.export_counted(rows, str(tmp_path / fmt), fmt).first()
        files = glob.glob(f"{tmp_path}/{fmt}/part-*")
        assert tuple(told) == (fmt, 100, len(files), sum(map(os.path.getsize, files)))
