"""Removal of repeated passages by a compacted De Bruijn graph of word windows.

A window of WINDOW words is represented by the smallest hash among its k-mers of K words, its anchor; one anchor
stands for a stretch of neighbouring windows, which is its context. Anchors are the nodes of the graph, and only those
that occur twice in the corpus go on. Occurrences with one context are one nonbranching path: its first place is the source, and every
later one is a repeat of it, whole stretches at a time. Where an anchor has several contexts the graph branches, and the
windows of one occurrence of each context are compared one by one. Anchors and contexts, or two hashes of a
window, are 128 bits that agree. Repeats that follow each other and have the same source are joined to one
span, (document, start, source, source start).
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm import wordhash
from sparkdesk.llm.common import ship, text_of
from sparkdesk.session import materialise

WINDOW, K = 20, 8
#: Bases of the two hashes of a window, and of the hash of a context with its inverse.
BASE_A, BASE_B, BASE_C = (int(x) for x in wordhash._numbers("window", 3))
INVERSE = np.uint64(pow(BASE_C, -1, 1 << 64))


def anchors(words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a text's word hashes: anchor hash, context hash, anchor place, first window and number of windows, by place.

    Windows whose leftmost smallest k-mer is at one place follow each other.
    """
    if len(words) < WINDOW:
        return tuple(np.zeros(0, dtype=d) for d in (np.int64, np.int64, np.int32, np.int32, np.int32))
    kmers = wordhash.run_hashes(words, K)
    span, at, width = WINDOW - K + 1, np.arange(len(kmers)), 1
    while width < span:
        step = min(width, span - width)
        a, b = at[: len(at) - step], at[step:]
        at, width = np.where(kmers[b] < kmers[a], b, a), width + step
    first = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(first, append=len(at))
    place = at[first]
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * wordhash.powers(len(words), np.uint64(BASE_C)), out=sums[1:])
    context = (sums[first + count - 1 + WINDOW] - sums[first]) * wordhash.powers(len(words), INVERSE)[first]
    shape = count.astype(np.uint64) * wordhash.RUN + (place - first).astype(np.uint64) * wordhash.STEP
    context = wordhash.mixed(context + shape)
    return kmers[place].view(np.int64), context.view(np.int64), place.astype(np.int32), first.astype(np.int32), count.astype(np.int32)


def all_anchors(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in wordhash.slices(batches, "_text"):
            found = [anchors(wordhash.word_hashes(t)) for t in texts]
            owner = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            columns = [pa.array(np.concatenate([f[k] for f in found])) for k in range(5)]
            yield pa.RecordBatch.from_arrays([columns[0], columns[1], rows.column(0).take(pa.array(owner)), *columns[2:]], names=names)

    names = ["h", "context", "doc_id", "place", "start", "n"]
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text"))
    return rows.mapInArrow(run, "h bigint, context bigint, doc_id bigint, place int, start int, n int")


def windows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``a, b, doc_id, start``: both hashes of each window that ``marks`` (doc_id, ranges) names."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in wordhash.slices(batches, "_text"):
            out: list[list[np.ndarray]] = [[], [], [], []]
            for doc, ranges, text in zip(rows.column("doc_id").to_pylist(), rows.column("ranges").to_pylist(), texts):
                words = wordhash.word_hashes(text)
                at = np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in ranges])
                at = at[at <= len(words) - WINDOW]
                for k, base in enumerate((BASE_A, BASE_B)):
                    out[k].append(wordhash.run_hashes(words, WINDOW, np.uint64(base))[at].view(np.int64))
                out[2].append(np.full(len(at), doc, dtype=np.int64))
                out[3].append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["a", "b", "doc_id", "start"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text")).join(marks, "doc_id")
    return texts.select("doc_id", "ranges", "_text").mapInArrow(run, "a bigint, b bigint, doc_id bigint, start int")


def _release(spark) -> None:
    """Lets Spark delete the shuffle files of steps whose results are written."""
    gc.collect()
    spark._jvm.System.gc()


def _per_document(rows: DataFrame) -> DataFrame:
    return rows.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, start, n, source_id, source_start``: windows start to start + n - 1 also start earlier, at the source.

    Earlier is a smaller doc_id, or the same one and an earlier start.
    """
    spark = docs.sparkSession
    every = all_anchors(docs)
    twice = materialise(every.groupBy("h").agg(F.count("*").alias("_n")).where("_n > 1").select("h"), "anchors-twice")
    _release(spark)
    hits = materialise(every.join(twice, "h"), "anchor-hits")
    _release(spark)
    where = F.struct("doc_id", "start", "n")
    paths = hits.groupBy("h", "context").agg(F.min(where).alias("first"), F.count("*").alias("_n"))
    paths = materialise(paths, "paths")
    later = hits.join(paths.where("_n > 1"), ["h", "context"]).where("doc_id != first.doc_id or start != first.start")
    spans = later.select("doc_id", "start", "n", F.col("first.doc_id").alias("source_id"), F.col("first.start").alias("source_start"))
    branching = materialise(paths.groupBy("h").agg(F.count("*").alias("_contexts")).where("_contexts > 1").select("h"), "branching")
    marks = materialise(_per_document(paths.join(branching, "h").select("first.*")), "branch-marks")
    single = materialise(windows(docs, marks), "windows")
    _release(spark)
    first = single.groupBy("a", "b").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count("*").alias("_n"))
    first = materialise(first.where("_n > 1").select("a", "b", "first"), "first-windows")
    apart = single.join(first, ["a", "b"]).where("doc_id != first.doc_id or start != first.start")
    spans = spans.unionByName(apart.select("doc_id", "start", F.lit(1).alias("n"), F.col("first.doc_id").alias("source_id"), F.col("first.start").alias("source_start")))
    spans = materialise(compacted(spans), "spans")
    _release(spark)
    return spans


def compacted(spans: DataFrame) -> DataFrame:
    """Spans that touch and have the same source, as far from it, become one."""
    gap = F.col("start") - F.col("source_start")
    order = W.partitionBy("doc_id", "source_id", "_gap").orderBy("start")
    rows = spans.withColumn("_gap", gap)
    upto = F.max(F.col("start") + F.col("n")).over(order.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.coalesce(F.col("start") > upto, F.lit(True)).cast("int"))
    rows = rows.withColumn("_path", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = rows.groupBy("doc_id", "source_id", "_gap", "_path").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("n")).alias("_end"))
    return whole.select("doc_id", "start", (F.col("_end") - F.col("start")).alias("n"), "source_id", (F.col("start") - F.col("_gap")).alias("source_start"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, text``, one row per row of ``docs`` (doc_id, text): the words that stay, joined by one blank.

    A word goes when a window over it also starts earlier; windows are those of the input. A null text has no words, and
    one of fewer than WINDOW words loses none. A row without a doc_id is nobody's source and loses nothing. Rows that
    repeat an id are one document: they are not each other's source, and what one loses at a place, all lose.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in wordhash.slices(batches, "_text"):
            sizes, gone, kept = [], [], []
            for ranges, text in zip(rows.column("ranges").to_pylist(), texts):
                words = text.split()
                sizes.append(len(words))
                if ranges:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    start = np.minimum([r["start"] for r in ranges], len(words))
                    np.add.at(edge, start, 1)
                    np.add.at(edge, np.minimum([r["start"] + r["n"] - 1 + WINDOW for r in ranges], len(words)), -1)
                    stay = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
                    words = [words[i] for i in stay.tolist()]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"],
            )

    marks = materialise(_per_document(repeats(docs)).withColumnRenamed("doc_id", "_marked"), "span-marks")
    rows = docs.select("doc_id", text_of().alias("_text"))
    kind = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string("n_words bigint, n_removed bigint, text string").fields])
    joined = rows.join(marks, F.col("doc_id") == F.col("_marked"), "left")
    return joined.select("doc_id", "ranges", "_text").mapInArrow(run, kind)
