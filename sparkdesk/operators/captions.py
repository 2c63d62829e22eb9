"""From a list of links and landed JSON payloads to named caption documents.

Landed tables, each with one row per key: ``views(bvid, payload)``, ``tracks(cid, aid, payload)``,
``bodies(url, payload)``. An item that cannot be completed keeps its row, with the reason in
``error``; no item stops another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions.jsons import json_text_or
from sparkdesk.functions.links import VIDEO_ID, doc_base_name, extract_video_id, https_url, url_page_index
from sparkdesk.functions.strings import is_blank, trim_ctl
from sparkdesk.operators.keyed import first_per_key
from sparkdesk.session import materialise

# Fixed values.
MISSING_CODE = -(1 << 31)
CHINESE_CODE, CHINESE_WORD = "zh", "中文"
DEFAULT_LANGUAGE = "zh"
# List entries are read as variants: one of an unexpected type must not spoil its list.
VIEW_SCHEMA = "data struct<aid:string,cid:string,title:string,pages:array<variant>>"
TRACK_SCHEMA = "data struct<subtitle:struct<subtitles:array<variant>>>"
BODY_SCHEMA = "body array<variant>"

PIECE_BITS = 12
DOC_BUCKETS = 64


def api_code(payload: Column) -> Column:
    return F.coalesce(F.get_json_object(payload, "$.code").try_cast("int"), F.lit(MISSING_CODE))


def api_code_ok(payload: Column) -> Column:
    return api_code(payload) == 0


def api_error(payload: Column) -> Column:
    """Text of a failed payload, null for a good one."""
    text = F.concat(
        F.lit("code="), api_code(payload).cast("string"), F.lit(", message="), json_text_or(payload, "$.message", "")
    )
    return F.when(~api_code_ok(payload), text)


def select_part(pages: Column, index: Column, video_cid: Column) -> Column:
    """struct<cid, part> of a page: its own id, else the video's, else null; a blank part name is null."""
    page = F.try_element_at(pages, index)
    own = F.try_variant_get(page, "$.cid", "bigint")
    part = F.try_variant_get(page, "$.part", "string")
    fallback = video_cid.try_cast("bigint")
    cid = F.when(own > 0, own).when(fallback > 0, fallback)
    return F.struct(cid.alias("cid"), F.when(~is_blank(part), part).alias("part"))


def caption_context(
    urls: DataFrame, views: DataFrame, id_pattern: str = VIDEO_ID, page_name: str = "p"
) -> DataFrame:
    """``urls(url, src, pos)`` with ids, title and the chosen part of their video."""
    named = urls.withColumn("bvid", extract_video_id(F.col("url"), id_pattern))
    # A link without an id gets a key of its own, which no id equals, so that such links do not meet in one task.
    own = F.concat_ws(" ", F.lit("none"), F.col("src").cast("string"), F.col("pos").cast("string"))
    landed = views.select(F.col("bvid").alias("_key"), F.col("payload").alias("_view"))
    seen = named.withColumn("_key", F.coalesce("bvid", own)).join(landed, "_key", "left").drop("_key")
    opened = seen.withColumn("_data", F.from_json("_view", VIEW_SCHEMA)["data"])
    data = F.col("_data")
    count = F.greatest(F.coalesce(F.size(data["pages"]), F.lit(0)), F.lit(1))
    paged = opened.withColumns({"page_count": count, "aid": data["aid"].try_cast("bigint")}).withColumn(
        "page_index", url_page_index(F.col("url"), F.col("page_count"), page_name)
    )
    part = select_part(data["pages"], F.col("page_index"), data["cid"])
    chosen = paged.withColumn("_part", part)
    error = (
        F.when(F.col("bvid").isNull(), "no video id")
        .when(F.col("_view").isNull(), "no view")
        .when(~api_code_ok(F.col("_view")), F.concat(F.lit("view failed: "), api_error(F.col("_view"))))
        .when(data.isNull(), "unexpected view")
        .when(F.coalesce(F.col("aid"), F.lit(0)) <= 0, "missing aid")
        .when(F.col("_part.cid").isNull(), "missing cid")
    )
    failed = error.isNotNull()

    def known(c: Column) -> Column:
        return F.when(~failed, c)

    return chosen.select(
        "src", "pos", "url", "bvid",
        known(F.col("aid")).alias("aid"),
        known(F.col("_part.cid")).alias("cid"),
        known(F.coalesce(data["title"], F.col("bvid"))).alias("title"),
        known(F.col("page_index")).alias("page_index"),
        known(F.col("page_count")).alias("page_count"),
        known(F.col("_part.part")).alias("part_title"),
        error.alias("error"),
    )


def track_tier(lan: Column, lan_doc: Column, language: str) -> Column:
    """1 for the wanted language, 2 for Chinese, 3 for any other track."""
    wanted = language.strip().lower()
    code, words = F.lower(F.coalesce(lan, F.lit(""))), F.coalesce(lan_doc, F.lit(""))
    chinese = F.when(code.contains(CHINESE_CODE) | words.contains(CHINESE_WORD), 2).otherwise(3)
    if not wanted:
        return chinese
    return F.when(code.contains(wanted) | F.lower(words).contains(wanted), 1).otherwise(chinese)


def pick_track(
    tracks: DataFrame, item: list[str], pos: str, language: str = DEFAULT_LANGUAGE, lan: str = "lan", lan_doc: str = "lan_doc"
) -> DataFrame:
    """One track per item: the best tier, then the first in order."""
    tier = track_tier(F.col(lan), F.col(lan_doc), language)
    return first_per_key(tracks.withColumn("tier", tier), item, [F.col("tier"), F.col(pos)])


def pick_track_in(tracks: Column, language: str = DEFAULT_LANGUAGE) -> Column:
    """The same choice inside an array of tracks, without a shuffle."""

    def first_of(tier: int) -> Column:
        fits = F.filter(tracks, lambda t: track_tier(t["lan"], t["lan_doc"], language) == tier)
        return F.try_element_at(fits, F.lit(1))

    return F.coalesce(*[first_of(tier) for tier in (1, 2, 3)])


def track_entries(tracks: Column) -> Column:
    """array<struct<lan, lan_doc, subtitle_url>> of the objects in a landed list."""
    objects = F.filter(tracks, lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT")))
    names = ("lan", "lan_doc", "subtitle_url")
    return F.transform(
        objects,
        lambda v: F.named_struct(*[x for n in names for x in (F.lit(n), F.try_variant_get(v, f"$.{n}", "string"))]),
    )


def track_lines(parts: DataFrame, tracks: DataFrame, bodies: DataFrame, language: str = DEFAULT_LANGUAGE) -> DataFrame:
    """Distinct parts ``(cid, aid, ...)`` with ``subtitle_url``, ``lines`` and ``error`` of their chosen track."""
    seen = parts.join(tracks.select("cid", "aid", F.col("payload").alias("_tracks")), ["cid", "aid"], "left")
    landed = F.from_json("_tracks", TRACK_SCHEMA)["data"]["subtitle"]["subtitles"]
    listed = seen.withColumn("_landed", landed).withColumn("_entries", track_entries(F.col("_landed")))
    picked = listed.withColumn("_track", pick_track_in(F.col("_entries"), language))
    link = F.col("_track")["subtitle_url"]
    no_track = (
        F.when(F.col("_tracks").isNull(), "no track list")
        .when(~api_code_ok(F.col("_tracks")), F.concat(F.lit("track list failed: "), api_error(F.col("_tracks"))))
        .when(F.coalesce(F.size("_landed"), F.lit(0)) <= 0, "no tracks")
        .when(F.col("_track").isNull(), "no usable track")
        .when(is_blank(link), "empty track url")
    )
    named = picked.withColumn("_early", no_track).withColumn(
        "subtitle_url", F.when(F.col("_early").isNull(), https_url(link))
    )
    # A part without a URL gets a key of its own, so that such parts do not meet in one task.
    own = F.concat_ws(" ", F.lit("none"), F.col("cid").cast("string"), F.col("aid").cast("string"))
    keyed = named.drop("_tracks", "_landed", "_entries", "_track").withColumn("_key", F.coalesce("subtitle_url", own))
    texts = bodies.select(F.col("url").alias("_key"), F.col("payload").alias("_body"))
    opened = keyed.join(texts, "_key", "left").withColumn("_items", F.from_json("_body", BODY_SCHEMA)["body"])
    cleaned = opened.withColumn("_lines", clean_lines(F.col("_items")))
    error = (
        F.when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("_body").isNull(), "no body")
        .when(F.col("_items").isNull(), "missing body")
        .when(F.size("_lines") == 0, "no content lines")
    )
    checked = cleaned.withColumn("error", error)
    lines = F.when(F.col("error").isNull(), F.col("_lines"))
    return checked.select(*parts.columns, "subtitle_url", lines.alias("lines"), "error")


def caption_tracks(
    context: DataFrame, tracks: DataFrame, bodies: DataFrame, language: str = DEFAULT_LANGUAGE
) -> DataFrame:
    """Context rows with ``subtitle_url`` and ``lines``, the cleaned texts of the chosen track.

    Tracks and bodies are looked up once per part, however many links name it.
    """
    wanted = context.where("error is null").select("cid", "aid").distinct()
    found = track_lines(wanted, tracks, bodies, language).withColumnRenamed("error", "_late")
    # Failed links have no key: they keep out of the join, where they would all meet in one task.
    joined = context.where("error is null").join(found, ["cid", "aid"], "left")
    joined = joined.unionByName(context.where("error is not null"), allowMissingColumns=True)
    return joined.withColumn("error", F.coalesce("error", "_late")).drop("_late")


def clean_lines(items: Column) -> Column:
    """Trimmed, non-blank contents of a landed list of entries, in order."""
    texts = F.transform(items, lambda v: trim_ctl(F.try_variant_get(v, "$.content", "string")))
    return F.filter(texts, lambda t: ~is_blank(t))


def caption_lines(df: DataFrame, content: str) -> DataFrame:
    """The same rule on a table with one entry per row."""
    return df.withColumn(content, trim_ctl(F.col(content))).where(~is_blank(F.col(content)))


def caption_names(items: DataFrame) -> DataFrame:
    """Items with ``base_name``; null where the item failed."""
    base = doc_base_name(F.col("title"), F.col("page_index"), F.col("page_count"), F.col("part_title"))
    return items.withColumn("base_name", F.when(F.col("error").isNull(), base))


def _joined(order: str, value: str) -> Column:
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v"))))
    return F.array_join(F.transform(entries, lambda e: e["v"]), "\n", "")


def caption_pieces(lines: DataFrame, item: str, pos: str, text: str, bits: int | None = None) -> DataFrame:
    """``(item, piece, line_count, text)``: the lines of each 4,096 (2 ** ``bits``) positions, in order, joined with newlines.

    However long a document is, a piece is short; use this where a whole one may not fit in a row.
    ``pos`` is a whole number and unique in its item.
    """
    piece = F.shiftright(F.col(pos).cast("bigint"), PIECE_BITS if bits is None else bits).alias("piece")
    return lines.groupBy(item, piece).agg(F.count("*").alias("line_count"), _joined(pos, text).alias("text"))


def caption_doc(lines: DataFrame, item: str, pos: str, text: str) -> DataFrame:
    """``(item, line_count, doc)``: lines in order, joined with newlines.

    Sorting and joining is done piece by piece in many tasks; only finished pieces meet.
    """
    pieces = caption_pieces(lines, item, pos, text)
    return pieces.groupBy(item).agg(F.sum("line_count").alias("line_count"), _joined("piece", "text").alias("doc"))


def item_outcomes(items: DataFrame, error: str = "error") -> DataFrame:
    """How many items were completed and how many failed."""
    status = F.when(F.col(error).isNull(), "ok").otherwise("failed").alias("status")
    return items.groupBy(status).agg(F.count("*").alias("items"))


def write_text_docs(docs: DataFrame, path: str, name: str = "name", text: str = "doc", mode: str = "errorifexists") -> None:
    """One folder per document name with the text inside, closed by a newline; ``write_doc_pieces`` is for many documents.

    Give one row per document; the rows stay in the tasks they are in.
    """
    docs.select(F.col(name), F.col(text)).write.mode(mode).partitionBy(name).option("lineSep", "\n").text(path)


def write_text_lines(
    lines: DataFrame, path: str, name: str, pos: str, text: str, mode: str = "errorifexists"
) -> None:
    """The same files from one row per line, for documents too long for one row.

    Lines are sorted by document and place across all tasks; a document that spans tasks
    has several files, whose name order is the line order.
    """
    placed = lines.repartitionByRange(F.col(name), F.col(pos)).sortWithinPartitions(name, pos)
    placed.select(name, text).write.mode(mode).partitionBy(name).option("lineSep", "\n").text(path)


def doc_bucket(name: Column, buckets: int = DOC_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def write_doc_pieces(
    lines: DataFrame, path: str, name: str, pos: str, text: str, bits: int | None = None, buckets: int = DOC_BUCKETS, mode: str = "errorifexists"
) -> None:
    """All documents in a fixed number of folders: ``name, piece, line_count, byte_start, byte_count, text`` by ``bucket``.

    One row per line goes in; every line is closed by a newline, a null one is empty, and lines without a name are of no document.
    The pieces of a document one after another are its text, and ``byte_start`` is where a piece stands in it in UTF-8, so any
    byte range of a document of any length is read without the rest. No row or task holds a whole document: only the sizes of
    its pieces meet, for the prefix sum.
    """
    pieces = caption_pieces(lines.where(F.col(name).isNotNull()), name, pos, text, bits)
    closed = F.concat("text", F.lit("\n"))
    pieces = pieces.select(
        F.col(name).alias("name"), "piece", "line_count", F.octet_length(closed).cast("bigint").alias("byte_count"), closed.alias("text")
    )
    pieces = materialise(pieces, "doc-pieces")
    before = W.partitionBy("name").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    starts = pieces.select("name", "piece", F.coalesce(F.sum("byte_count").over(before), F.lit(0)).alias("byte_start"))
    placed = pieces.join(starts, ["name", "piece"]).withColumn("bucket", doc_bucket(F.col("name"), buckets))
    placed = placed.repartitionByRange("bucket", "name", "piece").sortWithinPartitions("bucket", "name", "piece")
    placed.select("name", "piece", "line_count", "byte_start", "byte_count", "text", "bucket").write.mode(mode).partitionBy("bucket").parquet(path)


def read_doc_pieces(spark: SparkSession, path: str, name: str | None = None, buckets: int = DOC_BUCKETS) -> DataFrame:
    """The pieces written by ``write_doc_pieces``, of all documents or of one, for which only its folder is opened."""
    pieces = spark.read.parquet(path)
    if name is not None:
        pieces = pieces.where((F.col("bucket") == doc_bucket(F.lit(name), buckets)) & (F.col("name") == name))
    return pieces.drop("bucket")
