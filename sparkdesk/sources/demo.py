"""A generated table whose rows depend only on the seed and the row number."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "i32 int, i64 bigint, t96 timestamp, f32 float, b boolean, d64 double, bin binary"

# One value in ten is null; times lie within 1,000,000 ms after the base;
# ``bin`` holds 16 printable characters.
NULL_ONE_IN = 10
TIME_RANGE_MILLIS = 1_000_000
FIRST_CHAR, CHAR_RANGE, BIN_SIZE = 33, 94, 16
BASE_MILLIS = 1_704_067_200_000


NAMES = ("i32", "i64", "t96", "f32", "b", "d64", "bin")

# One stream of 31-bit numbers per entry: a null test for each column and its values' parts.
STREAMS = tuple(f"{n}_null" for n in NAMES) + (
    "i32_a", "i32_b", "i64_a", "i64_b", "i64_c", "t96_a", "f32_a", "b_a", "d64_a", "d64_b",
    "bin_a", "bin_b", "bin_c", "bin_d",
)
MASK, FACTOR, FOLD = (1 << 31) - 1, 73_244_475, 15


def stream_start(seed: int, stream: str) -> int:
    return int(hashlib.sha256(f"{seed}:{stream}".encode()).hexdigest()[:7], 16)


def _folded(c: Column) -> Column:
    return c.bitwiseXOR(F.shiftright(c, FOLD))


def _mixed(df: DataFrame, row: Column, seed: int) -> DataFrame:
    """A hash of the row number per stream: three rounds of fold and multiply within 62 bits.

    Each round is a projection of its own, so that no round is computed twice.
    """
    low, high = row.bitwiseAND(F.lit(MASK)), F.shiftright(row, 31).bitwiseAND(F.lit(MASK))
    state = df.select(high.alias("_high"), low.alias("_low"))
    state = state.select("_high", *[(F.col("_low") + stream_start(seed, n)).bitwiseAND(F.lit(MASK)).alias(n) for n in STREAMS])
    for turn in range(3):
        multiplied = {n: (_folded(F.col(n)) * FACTOR).bitwiseAND(F.lit(MASK)) for n in STREAMS}
        state = state.select("_high", *[(c.bitwiseXOR(F.col("_high")) if turn == 0 else c).alias(n) for n, c in multiplied.items()])
    return state.select(*[_folded(F.col(n)).alias(n) for n in STREAMS])


def _printable(number: Column, size: int) -> list[Column]:
    """Characters from the base-94 digits of a number, the lowest first."""
    digits = [F.call_function("div", number, F.lit(CHAR_RANGE**i).cast("bigint")) % CHAR_RANGE for i in range(size)]
    return [F.char(digit + FIRST_CHAR) for digit in digits]


def demo_columns(df: DataFrame, row: Column, seed: int = 1234567, base_millis: int = BASE_MILLIS) -> DataFrame:
    """The seven columns for each row number of ``df``.

    The values are a hash of seed and row number, not taken from a generator per task: a
    retried task, or another split of the input, gives the same table.
    """

    def joined(first: str, second: str) -> Column:
        return F.col(first) * (1 << 31) + F.col(second)

    chars = [c for part in "abcd" for c in _printable(F.col(f"bin_{part}"), BIN_SIZE // 4)]
    made = {
        "i32": (F.col("i32_a") * 2 + F.col("i32_b") % 2 - (1 << 31)).cast("int"),
        "i64": (joined("i64_a", "i64_b") - (1 << 61)) * 4 + F.col("i64_c") % 4,
        "t96": F.timestamp_millis(F.lit(base_millis) + F.col("t96_a") % TIME_RANGE_MILLIS),
        "f32": (F.shiftright("f32_a", 7) / F.lit(float(1 << 24))).cast("float"),
        "b": F.col("b_a") % 2 == 0,
        "d64": F.shiftright(joined("d64_a", "d64_b"), 9) / F.lit(float(1 << 53)),
        "bin": F.concat(*chars).cast("binary"),
    }
    mixed = _mixed(df, row.cast("bigint"), seed)
    return mixed.select(*[F.when(F.col(f"{n}_null") % NULL_ONE_IN != 0, made[n]).alias(n) for n in NAMES])


def generate(spark: SparkSession, rows: int, seed: int = 1234567, base_millis: int = BASE_MILLIS) -> DataFrame:
    return demo_columns(spark.range(rows), F.col("id"), seed, base_millis)
