"""Exact duplicates by content-defined chunk recipes.

A normalised text is cut where a hash of two neighbouring words says so. Every distinct
chunk gets an identifier whose bytes are compared over the whole corpus; a document is the
ordered list of its identifiers, and equal lists mean equal texts. The text of a chunk is
moved once, whatever number of documents holds it: copies fall together in the task that
reads them. Only lists are compared after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm.common import digest, free, spaced, text_of
from sparkdesk.session import materialise

#: One word pair in so many ends a chunk; a chunk has at most LONGEST words.
PAIRS_PER_CUT, LONGEST = 128, 4096


def with_chunks(texts: DataFrame, column: str) -> DataFrame:
    """Adds ``chunks``: the text's pieces, which joined by one blank give the text again.

    A run of one repeated word has no cut inside but those every LONGEST words, counted
    from the last cut, so that copies of a run are cut alike wherever they stand.
    """
    i, words = F.col, F.col("_words")
    cut = lambda k: (F.pmod(F.xxhash64(F.get(words, k - 1), F.get(words, k)), F.lit(PAIRS_PER_CUT)) == 0) & (
        F.get(words, k - 1) != F.get(words, k)
    )
    inner = F.when(F.size(words) > 1, F.filter(F.sequence(F.lit(1), F.size(words) - 1), cut)).otherwise(
        F.array().cast("array<int>")
    )
    out = texts.withColumn("_words", F.split(i(column), " ", -1))
    out = out.withColumn("_bounds", F.concat(F.array(F.lit(0)), inner, F.array(F.size(words))))
    bounds = i("_bounds")
    stretch = lambda k: F.sequence(F.get(bounds, k - 1), F.get(bounds, k) - 1, F.lit(LONGEST))
    out = out.withColumn("_starts", F.flatten(F.transform(F.sequence(F.lit(1), F.size(bounds) - 1), stretch)))
    starts = i("_starts")
    piece = lambda s, k: F.array_join(
        F.slice(words, s + 1, F.coalesce(F.get(starts, k + 1), F.size(words)) - s), " "
    )
    return out.withColumn("chunks", F.transform(starts, piece)).drop("_words", "_bounds", "_starts")


def recipes(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, row, recipe, text_sha256``, written to the shared folder.

    ``recipe`` is the list of 32-byte chunk identifiers in order. The job stops when one identifier
    turns out to stand for two different chunks, so that no two texts are ever taken for one.
    """
    texts = docs.select(F.col("doc_id"), spaced(text_of()).alias("_text"))
    # A plain explode would add a filter on the size of the list, which makes the list twice over.
    chunks = with_chunks(texts.select("_text"), "_text").select(F.explode_outer("chunks").alias("chunk"))
    dictionary = chunks.groupBy(digest(F.col("chunk")).alias("id"), "chunk").agg(F.lit(1).alias("_one"))
    unsure = dictionary.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("n"))
    verified = F.when(unsure.scalar() > 0, F.raise_error(F.lit("two chunks share an identifier")).cast("binary"))
    ids = F.unhex(F.array_join(F.transform("chunks", lambda c: F.sha2(c, 256)), ""))
    listed = with_chunks(texts, "_text").select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        verified.otherwise(ids).alias("recipe"),
        F.sha2(F.col("_text"), 256).alias("text_sha256"),
    )
    return materialise(listed, "recipes")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs`` (doc_id, text).

    Texts are equal when they are after each whitespace run becomes one blank. Of equal texts the row
    with the smallest doc_id stays, rows without an id last; of rows that repeat an id one stays.
    A null text counts as empty, and the empty text is a text like any other. Columns beside
    doc_id and text are not read. No rows give no rows.
    """
    rows = recipes(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))).alias("_first")
    groups = rows.groupBy("recipe").agg(first, F.count("*").alias("_n")).where("_n > 1")
    groups = materialise(
        groups.select("recipe", F.col("_first.doc_id").alias("_keep"), F.col("_first.row").alias("_row"), "_n"), "groups"
    )
    return rows.join(groups, "recipe", "left").select(
        "doc_id",
        F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast(T.LongType()).alias("group_size"),
        F.coalesce(F.col("row") == F.col("_row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, all columns as they are, whatever their names.

    Of rows that repeat both the id and the normalised text one stays, whichever it is. A null text is an empty one. Rows without
    an id give way to rows with one. No rows give no rows.
    """
    sha, doc, key, n = free(docs, "_sha", "_id", "_key", "_n")
    kept = exact_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    kept = kept.groupBy(F.col("doc_id").alias(doc), F.col("text_sha256").alias(key)).agg(F.count("*").alias(n))
    kept = materialise(kept, "kept-ids")
    keyed = docs.withColumn(sha, F.sha2(spaced(text_of()), 256))
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(sha) == F.col(key))
    left, again = keyed.join(kept, same, "left_semi"), kept.where(F.col(n) > 1)
    if not again.isEmpty():
        # Only the rows of repeated ids are moved once more.
        one = keyed.join(again, same, "left_semi").dropDuplicates(["doc_id", sha])
        left = left.join(again, same, "left_anti").unionByName(one)
    return left.drop(sha)
