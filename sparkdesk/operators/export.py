"""Table export: CSV lines and files, compressed CSV, Parquet, and what they amount to."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sparkdesk.functions.cells import cell, csv_cell, render

FORMATS = ("parquet", "csv", "zip")

# Deflate levels by their names in the Hadoop codec, fixed values.
LEVELS = (
    "NO_COMPRESSION", "BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION"
)

# Writer options under which Spark's CSV text equals ``csv_lines``. A cell at the start of a row
# that begins with the comment sign is quoted; one that begins with a quote is so anyway.
CSV_OPTIONS = {
    "comment": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


def header_text(df: DataFrame) -> str:
    def escaped(name: str) -> str:
        return '"' + name.replace('"', '""') + '"' if set(name) & set(',"\r\n') else name

    return ",".join(escaped(name) for name in df.columns)


def csv_header(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1).select(F.lit(header_text(df)).alias("line"))


def csv_rows(df: DataFrame, rule=cell) -> DataFrame:
    cells = []
    for field in df.schema.fields:
        cells += [F.lit(","), csv_cell(field, rule)]
    return df.select(F.concat(*cells[1:]).alias("line"))


def csv_lines(df: DataFrame, render=cell) -> DataFrame:
    """The header and one escaped line per row, as ``(line)``.

    ``render(column, field)`` gives the text of a cell.
    """
    return csv_header(df).unionByName(csv_rows(df, render))


def write_csv(df: DataFrame, path: str, layout: str = "parts", mode: str = "errorifexists", **options: str) -> None:
    """CSV files, one per task.

    ``parts``: every file has a header, as Spark readers expect. ``concat``: only
    the first file has it, so the files in name order are the one CSV document,
    without any task having held it whole.
    """
    if layout not in ("parts", "concat"):
        raise ValueError(f"unknown layout: {layout}")
    if layout == "concat":
        csv_lines(df).write.mode(mode).options(lineSep="\n", **options).text(path)
    elif len(df.columns) == 1:
        # Spark's CSV writer leaves out empty rows of a one-column table.
        _write_with_headers(csv_rows(df), header_text(df), path, mode, options)
    else:
        render(df).write.mode(mode).options(header="true", **CSV_OPTIONS, **options).csv(path)


def _write_with_headers(lines: DataFrame, header: str, path: str, mode: str, options: dict[str, str]) -> None:
    """Lines with the header before the first of every file, also of files that are cut by a number of rows, and of a table without rows."""
    conf = lines.sparkSession.conf.get("spark.sql.files.maxRecordsPerFile", "0")
    most = int(options.get("maxRecordsPerFile", conf))
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33))
    first = place % most == 0 if most > 0 else place == 0
    text = F.when(first, F.concat(F.lit(header + "\n"), F.col("line"))).otherwise(F.col("line"))
    counted = Observation("lines")
    rows = lines.observe(counted, F.count("*").alias("n")).select(text.alias("line"))
    rows.write.mode(mode).options(lineSep="\n", **options).text(path)
    if not counted.get["n"]:
        alone = lines.sparkSession.range(1).select(F.lit(header).alias("line")).coalesce(1)
        alone.write.mode("append").options(lineSep="\n", **options).text(path)


def write_csv_compressed(
    df: DataFrame, path: str, level: int = 1, codec: str = "gzip", layout: str = "parts", mode: str = "errorifexists"
) -> None:
    """Compressed CSV files; a level outside 0..9 means the fastest."""
    name = LEVELS[level] if 0 <= level <= 9 else LEVELS[1]
    write_csv(df, path, layout, mode, **{"compression": codec, "zlib.compress.level": name})


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_int96(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet with timestamps in the legacy 12-byte form."""
    conf, key = df.sparkSession.conf, "spark.sql.parquet.outputTimestampType"
    before = conf.get(key)
    conf.set(key, "INT96")
    try:
        write_parquet(df, path, mode)
    finally:
        conf.set(key, before)


def parse_format(raw: str | None) -> str:
    """parquet, csv or zip; nothing at all means zip, which is compressed CSV here."""
    if raw is None or not raw.strip():
        return "zip"
    name = raw.strip().lower()
    if name not in FORMATS:
        raise ValueError(f"unknown export format: {raw}")
    return name


def export(df: DataFrame, path: str, fmt: str | None = None, level: int = 1, mode: str = "errorifexists") -> str:
    """Write a table in the named format and return that format."""
    chosen = parse_format(fmt)
    if chosen == "parquet":
        write_parquet(df, path, mode)
    elif chosen == "csv":
        write_csv(df, path, mode=mode)
    else:
        write_csv_compressed(df, path, level, mode=mode)
    return chosen


def export_counted(df: DataFrame, path: str, fmt: str | None = None, level: int = 1) -> DataFrame:
    """``export`` to a new folder, and what it came to: one row of ``format, rows, files, bytes``.

    Rows are counted by the write itself, bytes are those of the committed files; nothing is rendered for counting.
    """
    counted = Observation("export")
    chosen = export(df.observe(counted, F.count("*").alias("rows")), path, fmt, level)
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("length")
    return files.agg(
        F.lit(chosen).alias("format"), F.lit(counted.get["rows"]).cast("bigint").alias("rows"),
        F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )


def export_stats(df: DataFrame) -> DataFrame:
    """Rows and bytes of the CSV form, header included, in one pass, without writing it."""
    header = F.lit(header_bytes(df)).cast("bigint")
    return csv_rows(df).agg(
        F.lit("csv").alias("format"),
        F.count("*").alias("rows"),
        (F.coalesce(F.sum(F.octet_length("line").cast("bigint") + 1), F.lit(0)) + header).alias("bytes"),
    )


def header_bytes(df: DataFrame) -> int:
    return len(header_text(df).encode()) + 1


def write_csv_counted(df: DataFrame, path: str, **options) -> dict[str, int]:
    """Write the ``concat`` layout and return the rows and bytes counted during that write."""
    counted = Observation("export")
    lines = csv_lines(df).observe(
        counted, (F.count("*") - 1).alias("rows"), F.sum(F.octet_length("line").cast("bigint") + 1).alias("bytes")
    )
    lines.write.options(lineSep="\n", **options).text(path)
    return counted.get
