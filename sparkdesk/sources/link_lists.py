"""Lists of links in text files: one per line, or one JSON array per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.strings import is_blank, is_not_blank, trim_ctl

POSITION = "struct<file:string,block:bigint,line:bigint,part:int>"


def parse_link_line(value):
    """array of texts of one line: trimmed, without blank and ``#`` ones."""
    parts = F.transform(F.split(value, r"\R"), trim_ctl)
    return F.filter(parts, lambda x: is_not_blank(x) & ~F.startswith(x, F.lit("#")))


def parse_link_array(value):
    """array of texts of a JSON array; elements that are not texts are left out."""
    items = F.zip_with(
        F.from_json(value, "array<string>"),
        F.from_json(value, "array<variant>"),
        lambda text, v: F.when(F.schema_of_variant(v) == "STRING", trim_ctl(text)),
    )
    return F.filter(items, is_not_blank)


def _exploded(df: DataFrame, links) -> DataFrame:
    position = F.struct("file", "block", "line", F.col("part")).cast(POSITION)
    return df.select("file", "block", "line", F.posexplode(links).alias("part", "url")).select("url", position.alias("pos"))


def url_source(spark: SparkSession, path: str | list[str], kind: str = "auto") -> DataFrame:
    """``(url, pos)`` of link files; ``pos`` sorts by file, then by place in the file.

    ``kind`` is ``lines``, ``json`` or ``auto``, which looks at the first character of each
    file that is not blank, in a join with the lines. Line files are split among tasks; only a JSON array,
    one value, comes together in one row.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    if kind == "lines":
        return _exploded(lines, parse_link_line(F.col("value")))
    if kind == "json":
        return _json_arrays(spark, path)
    if kind != "auto":
        raise ValueError(f"unknown kind of link file: {kind}")
    heads = lines.where(~is_blank(F.col("value"))).groupBy("file").agg(
        F.min_by(F.substring(trim_ctl(F.col("value")), 1, 1), F.struct("block", "line")).alias("head")
    )
    # One row per file on the right: a plain join, broadcast only at a known small size.
    told = lines.join(heads, "file")
    plain = _exploded(told.where("head <> '['"), parse_link_line(F.col("value")))
    placed = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    whole = told.where("head = '['").groupBy("file").agg(F.array_join(F.transform(placed, lambda x: x["value"]), "\n").alias("value"))
    return plain.unionByName(_arrays(whole))


def _json_arrays(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return _arrays(spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file")))


def _arrays(whole: DataFrame) -> DataFrame:
    """Links of files (file, value) that are one JSON array each."""
    start = F.lit(0).cast(T.LongType())
    links = parse_link_array(F.col("value"))
    wrong = F.raise_error(F.concat(F.lit("not a JSON array of links: "), F.col("file"))).cast("array<string>")
    rows = whole.where(~is_blank(F.col("value"))).withColumns({"block": start, "line": start})
    return _exploded(rows, F.coalesce(links, wrong))
