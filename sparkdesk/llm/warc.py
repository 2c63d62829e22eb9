"""WARC archives: written from a table of pages, read back by verified chains of record boundaries.

Reading: the archive is split by Spark at every place that looks like the start of a record, in parallel
and without regard to records. Each such candidate says where its successor must begin. Candidates
inside payloads say so too; only those that a chain of successors reaches from the start of the
file are records. Stretches in which each candidate points at the next one are one link of that
chain, and links are followed by pointer jumping, so the rounds grow with the logarithm of the links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.session import materialise, scratch_path

MAGIC, END = "WARC/1.", "\r\n\r\n"
#: What stands between two records: the end of one and the start of the next. It cannot overlap itself,
#: so a false boundary never hides a true one.
BETWEEN = END + MAGIC
#: Payloads below this many bytes are stored each time.
LEAST_REVISIT = 100


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, payload_digest, refers_to`` of pages whose payload a smaller page_id has, written once."""
    light = pages.select("page_id", *_payload_facts(F.col("html"))).where(F.col("payload_bytes") >= LEAST_REVISIT)
    groups = light.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    groups = materialise(groups.where("n > 1").drop("n"), "payloads")
    later = light.join(groups, ["payload_digest", "payload_bytes"]).where("page_id != refers_to")
    return materialise(later.select("page_id", "payload_digest", "refers_to").distinct(), "revisits")


def _payload_facts(html: Column) -> tuple[Column, Column]:
    payload = F.coalesce(html.cast("string"), F.lit(""))
    return F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest")


def write_archives(pages: DataFrame, path: str) -> None:
    """One record per row of ``pages`` (page_id, url, html), an archive per task that reads them.

    The payload is the html in UTF-8, a null an empty one. Only ids of revisits are joined, so pages are moved
    only when there are too many revisits to send to every task. Rows without a page_id are always responses,
    and so are rows that repeat the smallest page_id of their payload. A null url gives an empty target.
    """
    one = F.col("html").cast("string")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(one, F.lit("")).alias("html"))
    rows = rows.select("*", *_payload_facts(F.col("html")))
    rows = rows.join(revisits(pages), ["page_id", "payload_digest"], "left")
    again, line = F.col("refers_to").isNotNull(), F.lit("\r\n")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(f"{MAGIC}1\r\nWARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x1f\x7f]", " "),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(again, F.concat(F.lit("\r\nWARC-Refers-To: "), urn(F.col("refers_to")))).otherwise(F.lit("")),
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.lit("\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.when(again, F.lit("0")).otherwise(F.col("payload_bytes").cast("string")), line, line,
    )
    record = F.concat(header, F.when(again, F.lit("")).otherwise(F.col("html")))
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The archives' bytes between two boundary candidates, in the order ``file, block, nth``.

    Spark's line reader keeps a separator inside a line when the separator lies across the ends of two blocks; such a
    line is cut here, as Latin-1 so that its bytes stay what they are.
    """
    found = spark.read.schema("value string").option("lineSep", BETWEEN).text(path)
    value, latin = F.col("value"), "ISO-8859-1"
    cut = F.split(F.decode(value.cast("binary"), latin), BETWEEN.replace(".", r"\."), -1)
    parts = F.when(F.contains(value, F.lit(BETWEEN)), F.transform(cut, lambda c: F.encode(c, latin).cast("string")))
    rows = found.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("line"),
        parts.otherwise(F.array(value)).alias("parts"),
    )
    rows = rows.select("file", "block", "size", "line", F.posexplode_outer("parts").alias("part", "value"))
    return rows.select("file", "block", "size", F.struct("line", "part").alias("nth"), "value")


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate with the offset of its first byte, its successor's offset and its header; no payloads.

    Only a line feed begins a header line: U+0085, U+2028 and U+2029 may stand in a url.
    """
    head = F.substring_index("value", END, 1)
    field = lambda name: F.regexp_extract("_head", rf"(?dim)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)
    rows = _pieces(spark, path).select(
        "file", "block", "size", "nth", F.octet_length("value").alias("_octets"),
        F.contains("value", F.lit(END)).alias("_closed"), head.alias("_head"), F.octet_length(head).alias("_head_octets"), "value",
    )
    rows = rows.withColumn("content_length", field("Content-Length").try_cast("bigint"))
    # A header that does not end in this piece ends with the boundary, whose magic then opens the payload.
    body_at = F.col("_head_octets") + len(END)
    body = F.expr(f"substring(cast(value as binary), _head_octets + {len(END)} + 1)")
    whole = F.col("_closed") & (F.octet_length(body) == F.col("content_length"))
    return rows.select(
        "file", "block", "size", "nth", "_octets", "content_length",
        F.when(F.col("content_length") >= 0, body_at).alias("_body_at"),
        F.when(whole, F.sha2(body, 256)).alias("body_sha256"),
        field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"),
        field("WARC-Target-URI").alias("url"), field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Payload-Digest").alias("payload_digest"), field("X-Payload-Length").alias("payload_length"),
    )


def placed(found: DataFrame) -> DataFrame:
    """Adds ``offset`` and ``next_offset``: sums inside a block, on top of the sums of the blocks before it."""
    width = F.col("_octets") + len(BETWEEN)
    blocks = found.groupBy("file", "block").agg(F.sum(width).alias("_width"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_width").over(earlier), F.lit(0)).alias("_base"))
    inside = W.partitionBy("file", "block").orderBy("nth").rowsBetween(W.unboundedPreceding, -1)
    rows = found.withColumn("_at", F.coalesce(F.sum(width).over(inside), F.lit(0))).join(blocks, ["file", "block"])
    start = F.col("_base") + F.col("_at")
    # The first piece of a file begins with the file, every other one after the magic of its record.
    offset = F.when(start == 0, F.lit(0)).otherwise(start - len(MAGIC))
    after = start + F.col("_body_at") + F.col("content_length") + len(END)
    return rows.withColumn("offset", offset).withColumn("next_offset", after).drop("_base", "_at")


def reachable(rows: DataFrame) -> DataFrame:
    """``rows`` (file, block, offset, next_offset) that a chain of successors reaches from offset 0 of their file."""
    spark = rows.sparkSession
    order = W.partitionBy("file", "block").orderBy("offset")
    linked = F.coalesce(F.lag("next_offset").over(order) == F.col("offset"), F.lit(False))
    rows = rows.withColumn("_new", (~linked).cast("int"))
    rows = rows.withColumn("_run", F.max(F.when(F.col("_new") == 1, F.col("offset"))).over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = materialise(rows.drop("_new"), "warc-rows")
    tails = rows.groupBy("file", "block", "_run").agg(F.max(F.struct("offset", "next_offset")).alias("t"))
    targets = rows.select("file", F.col("offset").alias("entry"), F.col("_run").alias("to"))
    jumps = tails.select("file", F.col("_run").alias("run"), F.col("t.next_offset").alias("entry")).join(targets, ["file", "entry"])
    jumps = materialise(jumps.select("file", "run", "to", "entry"), "warc-links")
    reached = rows.where("offset = 0").select("file", F.col("_run").alias("run"), F.lit(0).cast("bigint").alias("entry")).distinct()
    reached, known = materialise(reached, "warc-reached"), -1
    while (count := reached.count()) != known:
        known = count
        more = reached.select("file", "run").join(jumps, ["file", "run"]).select("file", F.col("to").alias("run"), "entry")
        reached = materialise(reached.unionByName(more).groupBy("file", "run").agg(F.min("entry").alias("entry")), "warc-reached")
        far = jumps.select("file", F.col("to").alias("_mid"), "run").join(
            jumps.select("file", F.col("run").alias("_mid"), "to", "entry"), ["file", "_mid"]
        )
        jumps = materialise(far.select("file", "run", "to", "entry"), "warc-links")
    hit = reached.select("file", F.col("run").alias("_run"), "entry")
    return rows.join(hit, ["file", "_run"]).where("offset >= entry").drop("_run", "entry")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: header fields, ``body_bytes`` and ``body_sha256``.

    A payload that holds the magic line is put together from its pieces; only such records' bytes are moved.
    A file whose chain breaks ends the job with an error, as records would be lost. No file gives no row.
    """
    every = materialise(placed(materialise(candidates(spark, path), "warc-found")), "warc-placed")
    records = materialise(reachable(every), "warc-records")
    last = records.groupBy("file").agg(F.max("next_offset").alias("_end"), F.max("size").alias("_size"))
    broken = last.where("_end is null or _end != _size").agg(F.count("*").alias("n"))
    checked = F.when(broken.scalar() > 0, F.raise_error(F.lit("an archive's chain of records breaks off")).cast("string"))
    return _with_split_bodies(spark, path, every, records).withColumn("record_type", checked.otherwise(F.col("record_type")))


def _with_split_bodies(spark: SparkSession, path: str, every: DataFrame, records: DataFrame) -> DataFrame:
    parts = records.where("body_sha256 is null").select("file", "block", "nth", "offset", F.lit(True).alias("_own"), "_body_at", "content_length")
    loose = every.join(records.select("file", "offset"), ["file", "offset"], "left_anti").select(
        "file", "block", "nth", "offset", F.lit(False).alias("_own"), F.lit(None).cast("bigint").alias("_body_at"),
        F.lit(None).cast("bigint").alias("content_length"),
    )
    before = W.partitionBy("file").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    owned = parts.unionByName(loose).withColumn("_owner", F.max(F.when(F.col("_own"), F.col("offset"))).over(before))
    owned = materialise(owned, "warc-parts")
    values = _pieces(spark, path).join(owned, ["file", "block", "nth"]).select("file", "offset", "_owner", "_own", "_body_at", "content_length", F.col("value").cast("binary").alias("value"))
    values = values.withColumn("_piece", F.when(F.col("_own"), F.col("value")).otherwise(F.concat(F.lit(BETWEEN).cast("binary"), F.col("value"))))
    bodies = values.groupBy("file", F.col("_owner").alias("offset")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("offset"), F.hex("_piece").alias("h")))).alias("_pieces"),
        F.max("_body_at").alias("_cut"), F.max("content_length").alias("_length"),
    )
    joined = F.unhex(F.array_join(F.transform("_pieces", lambda p: p["h"]), ""))
    bodies = bodies.withColumn("_whole", joined).select(
        "file", "offset", F.sha2(F.expr("substring(_whole, cast(_cut as int) + 1, cast(_length as int))"), 256).alias("_sha")
    )
    out = records.join(materialise(bodies, "warc-bodies"), ["file", "offset"], "left")
    return out.select(
        "file", "offset", "record_type", "record_id", "url", "refers_to", "payload_digest", "payload_length",
        F.col("content_length").alias("body_bytes"), F.coalesce("body_sha256", "_sha").alias("body_sha256"),
    )


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes ``pages`` as archives and reads the records back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    One row per row of ``pages``. Length and digest of a response are those of the payload as read; a revisit carries them in its
    header. A null html is an empty payload; ``refers_to`` is null for responses. A row without a page_id is a response with a
    null page_id. Of pages that repeat the smallest page_id of a payload all are responses. Columns beside page_id, url and html
    are not read. No rows give no rows.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    records = read_archives(spark, path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
    again = F.col("record_type") == "revisit"
    return records.select(
        page(F.col("record_id")).alias("page_id"),
        F.when(again, F.col("payload_length").try_cast("bigint")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(again, F.replace("payload_digest", F.lit("sha256:"), F.lit(""))).otherwise(F.col("body_sha256")).alias("payload_digest"),
        "record_type",
        page(F.col("refers_to")).alias("refers_to"),
    )
