"""Removal of repeated runs of lines.

Every two neighbouring lines are a window, identified by its lines alone, so that a passage that documents share has the same
windows in each of them whatever stands around it. A window that stands earlier in the corpus goes, both lines of it; a
repeated run of any length is the union of its windows and goes from its first line to its last. Lines are compared by
their bytes before anything is removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm.common import WORD, digest, text_of
from sparkdesk.session import materialise


def _versions(docs: DataFrame) -> DataFrame:
    text = docs.select("doc_id", text_of().alias("_text"))
    return text.withColumn("version", F.xxhash64("_text"))


def with_chunks(docs: DataFrame) -> DataFrame:
    """``doc_id, version, lines, gone, starts`` and ``chunks``, texts that joined by a line break give the whole text."""
    lines, starts = F.col("lines"), F.col("starts")
    piece = lambda s, k: F.array_join(F.slice(lines, s + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s), "\n")
    return _chunked(docs).withColumn("chunks", F.transform(starts, piece)).drop("_text")


def _chunked(docs: DataFrame) -> DataFrame:
    """A text's lines with its ``gone`` windows and ``starts``, the first lines of its chunks.

    A chunk is a stretch of lines that stay, or one of lines that go and follow each other in one source, too.
    """
    repeated = repeated_windows(docs).select(F.col("doc_id").alias("_id"), F.col("version").alias("_version"), "gone")
    # Texts are moved before they are cut, once; the hint keeps the join the same at every size.
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("version") == F.col("_version"))
    out = _versions(docs).join(repeated.hint("merge"), same, "left").drop("_id", "_version")
    out = out.withColumn("lines", F.split("_text", "\n", -1))
    gone, nowhere = F.col("gone"), F.array().cast("array<int>")

    def cuts(window, k):
        before, place = F.get(gone, k - 1), window["place"]
        apart = F.when(before["place"] < place - 2, F.array(before["place"] + 2, place))
        return F.when(k == 0, F.array(place)).otherwise(F.coalesce(apart, F.when(before["source"] != window["source"], F.array(place)), nowhere))

    end = F.array(F.get(gone, F.size(gone) - 1)["place"] + 2)
    inner = F.when(gone.isNotNull(), F.concat(F.flatten(F.transform(gone, cuts)), end)).otherwise(nowhere)
    inner = F.filter(inner, lambda s: (s > 0) & (s < F.size("lines")))
    return out.withColumn("starts", F.concat(F.array(F.lit(0)), F.array_sort(F.array_distinct(inner))))


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, version, lines`` and ``ids``, 128 bits of each line, of the texts of two lines or more."""
    rows = _versions(docs).where(F.contains("_text", F.lit("\n"))).withColumn("lines", F.split("_text", "\n", -1)).drop("_text")
    return rows.withColumn("ids", F.transform("lines", lambda s: F.substring(digest(s), 1, 16)))


def _windows(docs: DataFrame) -> DataFrame:
    """``doc_id, version, place, id`` per two neighbouring lines that have a word between them."""
    lines, ids = F.col("lines"), F.col("ids")
    rows = _lines(docs).withColumn("_words", F.transform(lines, lambda s: s.rlike(WORD)))
    pair = lambda k: F.when(F.get("_words", k) | F.get("_words", k + 1), F.concat(F.get(ids, k), F.get(ids, k + 1)))
    pairs = F.transform(F.sequence(F.lit(0), F.size(lines) - 2), pair)
    return rows.select("doc_id", "version", F.posexplode(pairs).alias("place", "id")).where("id is not null")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc_id, version, gone``: ``(place, source)`` of the windows that stand earlier, in order, per document that has any.

    ``source`` is equal for neighbouring windows whose earlier places are neighbours in one document.
    """
    windows = _windows(docs)
    where = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version", "place")
    counted = windows.groupBy("id").agg(F.count("*").alias("n"), F.min(where).alias("first")).where("n > 1")
    counted = materialise(counted.select("id", "first"), "repeated-windows")
    # The bytes of every line: two texts under one identifier stop the job.
    texts = _lines(docs).select(F.explode(F.arrays_zip("ids", "lines")).alias("_line")).select("_line.ids", "_line.lines")
    texts = texts.groupBy("ids", "lines").agg(F.lit(1).alias("_one"))
    unsure = texts.groupBy("ids").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n"))
    # Of three equal lines the second window shares a line with the first and is no repeat of it.
    first, place = F.col("first"), F.col("place")
    own = (first["version"] == F.col("version")) & first["doc_id"].eqNullSafe(F.col("doc_id"))
    later = windows.withColumn("_where", where).join(counted, "id").where((F.col("_where") != first) & ~(own & (place - first["place"] < 2)))
    source = F.xxhash64(first["none"], first["doc_id"], first["version"], first["place"] - place)
    sure = F.when(unsure.scalar() > 0, F.raise_error(F.lit("two lines share an identifier")).cast("int")).otherwise(place)
    gone = later.groupBy("doc_id", "version").agg(F.collect_set(F.struct(sure.alias("place"), source.alias("source"))).alias("gone"))
    return materialise(gone.withColumn("gone", F.array_sort("gone")), "removed-windows")


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, n_chunks, text``, one row per row of ``docs`` (doc_id, text): what is left of each text.

    Of equal runs of two lines or more the one of the smallest doc_id stays, then that of the earlier place; rows without an
    id come last. A null text is empty, which is one empty line. Rows that repeat id and text are one document, and none
    of them loses a line to another. Single lines always stay, and so does a line without a word whose neighbours have
    none either. No rows give no rows.
    """
    gone, lines = F.col("gone"), F.col("lines")
    left = F.sequence(F.lit(0), F.size(lines) - 1)
    places = F.transform(gone, lambda g: g["place"])
    rows = _chunked(docs).withColumn("_gone", F.array_union(places, F.transform(gone, lambda g: g["place"] + 1)))
    text = F.array_join(F.transform(F.array_except(left, F.col("_gone")), lambda i: F.get(lines, i)), "\n")
    return rows.select(
        "doc_id", F.size(lines).cast("bigint").alias("n_lines"),
        F.when(gone.isNull(), 0).otherwise(F.size("_gone")).cast("bigint").alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_chunks"),
        F.when(gone.isNull(), F.col("_text")).otherwise(text).alias("text"),
    )
