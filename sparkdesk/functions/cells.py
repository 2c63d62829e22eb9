"""Text of one typed cell, as it appears in an exported table.

``cell`` picks the rule once per column from the schema, so a scan runs a fixed
projection instead of a switch per value. A column whose stored meaning Spark
does not know (a UUID, a raw time of day, nanoseconds) carries it as the field
metadata key ``cell``; ``sources.tables.scan`` puts it there.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.functions.strings import csv_escape

# Fixed values.
JULIAN_DAY_OF_EPOCH = 2440588
SECONDS_PER_DAY = 86_400
PER_SECOND = {"millis": 1_000, "micros": 1_000_000, "nanos": 1_000_000_000}


def text_cell(c: Column) -> Column:
    """An absent value and an empty text are both an empty cell."""
    return F.coalesce(c.cast("string"), F.lit(""))


def plain_text(c: Column) -> Column:
    """Integers, floats, booleans, decimals and dates in their Java text form."""
    return c.cast("string")


def uint_text(c: Column, bits: int) -> Column:
    return c.cast("bigint").bitwiseAND(F.lit((1 << bits) - 1)).cast("string")


def signed_text(c: Column, bits: int) -> Column:
    """Keep the low bits only and read them as a signed number."""
    half = 1 << (bits - 1)
    low = (c.cast("bigint") + half).bitwiseAND(F.lit((1 << bits) - 1))
    return (low - half).cast("string")


def unscaled_decimal_text(c: Column, scale: int) -> Column:
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(T.DecimalType(max(scale, 1), scale))
    return (c.cast("decimal(20,0)") * unit).cast("string")


def date_text(c: Column) -> Column:
    return c.cast("date").cast("string")


def epoch_day_text(c: Column) -> Column:
    return F.date_from_unix_date(c.cast("int")).cast("string")


def _whole(a: Column, b: int) -> Column:
    """Whole part of a non-negative bigint divided by a constant, without a double between."""
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def _fraction(part: Column, unit: str) -> Column:
    """'' for zero, else a dot and the shortest of 3, 6 or 9 digits that is exact."""
    digits = F.lpad(part.cast("string"), len(str(PER_SECOND[unit])) - 1, "0")
    rule = F.when(part == 0, "")
    for keep in (3, 6):
        if 10**keep < PER_SECOND[unit]:
            rule = rule.when(part % (PER_SECOND[unit] // 10**keep) == 0, F.concat(F.lit("."), F.substring(digits, 1, keep)))
    return rule.otherwise(F.concat(F.lit("."), digits))


def _clock(of_day: Column, unit: str, seconds: str) -> Column:
    """Clock text of a count of ``unit`` since midnight.

    ``seconds='always'`` gives HH:mm:ss; ``'needed'`` leaves the seconds out
    when they and the fraction are zero.
    """
    per = PER_SECOND[unit]
    whole, part = _whole(of_day, per), of_day % F.lit(per)
    minutes = F.concat(_two(_whole(whole, 3600)), F.lit(":"), _two(_whole(whole % 3600, 60)))
    full = F.concat(minutes, F.lit(":"), _two(whole % 60), _fraction(part, unit))
    if seconds == "always":
        return full
    return F.when(of_day % F.lit(per * 60) == 0, minutes).otherwise(full)


def time_text(c: Column, unit: str) -> Column:
    """Time of day from a raw count of millis, micros or nanos."""
    return _clock(c.cast("bigint"), unit, "needed")


def epoch_text(c: Column, unit: str, utc: bool = True) -> Column:
    """A timestamp from a raw count since 1970, as an instant (Z) or a local time."""
    per_day = PER_SECOND[unit] * SECONDS_PER_DAY
    of_day = F.pmod(c.cast("bigint"), F.lit(per_day))
    day = F.call_function("div", c.cast("bigint") - of_day, F.lit(per_day))
    clock = _clock(of_day, unit, "always" if utc else "needed")
    text = F.concat(epoch_day_text(day), F.lit("T"), clock)
    return F.concat(text, F.lit("Z")) if utc else text


def instant_text(c: Column) -> Column:
    """A timestamp as UTC text, whatever the session zone is."""
    return epoch_text(F.unix_micros(c), "micros")


def _short_clock(c: Column) -> Column:
    """Spark's own HH:mm:ss[.ffffff] text in the form that drops zero parts."""
    whole, part = F.substring(c, 1, 8), F.substring(c, 10, 6)
    return (
        F.when(part != "", F.concat(whole, F.lit("."), F.rpad(part, F.when(F.length(part) <= 3, 3).otherwise(6), "0")))
        .when(F.endswith(whole, F.lit(":00")), F.substring(c, 1, 5))
        .otherwise(whole)
    )


def local_timestamp_text(c: Column) -> Column:
    text = c.cast("string")
    return F.concat(
        F.substring_index(text, " ", 1), F.lit("T"), _short_clock(F.substring_index(text, " ", -1))
    )


def time_type_text(c: Column) -> Column:
    return _short_clock(c.cast("string"))


def _little_endian(hex_text: Column, first: int, size: int) -> Column:
    pairs = [F.substring(hex_text, 2 * i + 1, 2) for i in reversed(range(first, first + size))]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def int96_text(c: Column) -> Column:
    """The 12 raw bytes of an INT96 timestamp: nanos of the day, then the Julian day."""
    text = F.hex(c)
    day = _little_endian(text, 8, 4) - JULIAN_DAY_OF_EPOCH
    return F.concat(epoch_day_text(day), F.lit("T"), _clock(_little_endian(text, 0, 8), "nanos", "always"), F.lit("Z"))


def base64_text(c: Column) -> Column:
    """Base64 on one line; Spark wraps it after 76 characters."""
    return F.translate(F.base64(c), "\r\n", "")


def uuid_text(c: Column) -> Column:
    """16 bytes as a UUID; any other length as Base64."""
    text = F.lower(F.hex(c))
    parts = [F.substring(text, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.octet_length(c) == 16, F.concat_ws("-", *parts)).otherwise(base64_text(c))


def nested_text(c: Column) -> Column:
    return F.to_json(c)


def first_element(c: Column) -> Column:
    return F.try_element_at(c, F.lit(1))


# Kinds that a schema cannot say on its own: metadata value -> rule.
KINDS = {
    "int8": lambda c: signed_text(c, 8),
    "int16": lambda c: signed_text(c, 16),
    "uint8": lambda c: uint_text(c, 8),
    "uint16": lambda c: uint_text(c, 16),
    "date": epoch_day_text,
    "time_millis": lambda c: time_text(c, "millis"),
    "time_micros": lambda c: time_text(c, "micros"),
    "time_nanos": lambda c: time_text(c, "nanos"),
    "instant_millis": lambda c: epoch_text(c, "millis"),
    "instant_micros": lambda c: epoch_text(c, "micros"),
    "instant_nanos": lambda c: epoch_text(c, "nanos"),
    "local_millis": lambda c: epoch_text(c, "millis", utc=False),
    "local_micros": lambda c: epoch_text(c, "micros", utc=False),
    "local_nanos": lambda c: epoch_text(c, "nanos", utc=False),
    "uuid": uuid_text,
    "int96": int96_text,
    "first": lambda c: plain_text(first_element(c)),
}


def _needs_escape(field: T.StructField) -> bool:
    kind = field.metadata.get("cell")
    if kind:
        return kind == "first" and isinstance(field.dataType.elementType, T.StringType)
    safe = (
        T.NumericType, T.BooleanType, T.DateType, T.TimeType, T.TimestampType, T.TimestampNTZType, T.BinaryType
    )
    return not isinstance(field.dataType, safe)


def cell(c: Column, field: T.StructField) -> Column:
    """Text of one column by its type; null stays null."""
    kind = field.metadata.get("cell")
    if kind:
        if kind.startswith("decimal:"):
            return unscaled_decimal_text(c, int(kind.split(":")[1]))
        return KINDS[kind](c)
    data_type = field.dataType
    if isinstance(data_type, T.TimestampType):
        return instant_text(c)
    if isinstance(data_type, T.TimestampNTZType):
        return local_timestamp_text(c)
    if isinstance(data_type, T.TimeType):
        return time_type_text(c)
    if isinstance(data_type, T.BinaryType):
        return base64_text(c)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return nested_text(c)
    return plain_text(c)


def column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def render(df: DataFrame, rule=cell) -> DataFrame:
    """Every column as text, under its own name."""
    return df.select(*[rule(column(f.name), f).alias(f.name) for f in df.schema.fields])


def csv_cell(field: T.StructField, rule=cell) -> Column:
    """One escaped CSV cell. Types whose text cannot hold a special character skip the escape."""
    text = rule(column(field.name), field)
    if rule is not cell or _needs_escape(field):
        text = csv_escape(text)
    return F.coalesce(text, F.lit(""))
