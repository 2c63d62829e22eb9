"""Pieces that several operators of this folder share."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than the blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Every whitespace run except a single blank, which needs no change.
ODD_SPACE = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"

#: Bits of the map of ``marked``, 2 MB.
BITS = 1 << 24


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def spaced(text: Column) -> Column:
    """Each whitespace run as one blank."""
    return F.regexp_replace(text, ODD_SPACE, " ")


def free(docs: DataFrame, *stems: str) -> list[str]:
    """Names for helper columns, each its stem with as many underscores as it takes to be none of the columns of ``docs``."""
    taken, out = {c.lower() for c in docs.columns}, []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        out.append(stem)
        taken.add(stem.lower())
    return out


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def marked(rows: DataFrame, key: Column, known: DataFrame, known_key: Column, mark: str) -> DataFrame:
    """``rows`` with the boolean column ``mark``: true where the key is among those of ``known``, and by chance for few others.

    The known keys set bits in a map of BITS, which goes to every task; its size is fixed, and the more keys there are the more rows it lets pass.
    So it spares a join that follows the rows that cannot match. A null key hashes as any other. Columns may have any names.
    """
    bucket, bits = free(rows, "_bucket", "_bits")
    place = lambda k: F.pmod(F.xxhash64(k), F.lit(BITS))
    keys = known.select(place(known_key).alias("_place"))
    table = keys.groupBy(F.bitmap_bucket_number("_place").alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias(bits))
    at = F.bitmap_bit_position(place(key))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    there = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)).cast("bigint") % 2 == 1, F.lit(False))
    joined = rows.join(F.broadcast(table), F.bitmap_bucket_number(place(key)) == F.col(bucket), "left")
    return joined.withColumn(mark, there).drop(bucket, bits)


def ship(spark: SparkSession) -> None:
    """Lets Python workers of this session import this package, as they do where it is installed or given by --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    there = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in there.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, there]))
