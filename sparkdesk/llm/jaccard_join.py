"""Near duplicates: word-shingle Jaccard join with Bayesian pruning of candidates.

Texts with equal shingle sets are one class member from the start; a member has a number of its own, so rows that share
a doc_id but not a text are told apart. Members that agree in a whole band of
MinHash values are candidates. Candidates are compared a few MinHash values at a time: a pair is dropped as soon as
the posterior probability that its similarity reaches the threshold, given the agreements so far and a uniform
prior, is below the tolerance. Pairs that remain are verified on their whole shingle sets.

Pairs never become rows. A bucket of candidates is split into parts, two parts are compared in one task, and
what leaves it is a count per member and a forest of links, so a group of near copies costs rows in proportion to
its members. A bucket with the same members as another is compared once, and a pair only in the
first of the buckets that it shares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm import wordhash
from sparkdesk.llm.common import digest, free, marked, ship, text_of
from sparkdesk.session import materialise

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8**5)**30 = 7e-6, one above it more rarely still.
BANDS, ROWS = 30, 5
#: MinHash values compared between two looks at the posterior, and the probability below which a pair is dropped.
BATCH, TOLERANCE = 10, 1e-6
#: Members of a bucket in one part of it, and parts of a class when its members learn their first document.
PART, CLASS_PARTS = 512, 64

MULTIPLIERS = wordhash._numbers("minhash", BANDS * ROWS)


def shingle_set(text: bytes, size: int = WORDS) -> np.ndarray:
    """The sorted hashes of the word shingles; a text of fewer words has one shingle of all its words, one without words none."""
    words = wordhash.word_hashes(text)
    return np.unique(wordhash.run_hashes(words, min(size, len(words)))) if len(words) else words


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    out = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048]
        np.minimum(out, np.multiply.outer(part, MULTIPLIERS).min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def band_keys(values: np.ndarray) -> np.ndarray:
    total = np.arange(BANDS, dtype=np.uint64) * wordhash.STEP
    for row in values.reshape(BANDS, ROWS).T.astype(np.uint64):
        total = wordhash.mixed(total * wordhash.RUN + row)
    return total.view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


@lru_cache(maxsize=4)
def least_agreements(total: int, threshold: float, tolerance: float) -> tuple[int, ...]:
    """For each number of values compared: the agreements below which the posterior is under the tolerance.

    With a uniform prior the similarity given m agreements of n is Beta(m + 1, n - m + 1); its upper tail at t is
    the probability of at most m successes in n + 1 trials of chance t.
    """
    out = [0]
    for n in range(1, total + 1):
        chance = (1 - threshold) ** (n + 1)
        tail, m = chance, 0
        while tail < tolerance and m < n:
            chance *= (n + 1 - m) / (m + 1) * threshold / (1 - threshold)
            m += 1
            tail += chance
        out.append(m)
    return tuple(out)


def survivors(left: np.ndarray, right: np.ndarray, alive: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """The pairs (row of ``left``, row of ``right``) among ``alive`` that no look at the posterior drops."""
    a, b = np.nonzero(alive)
    agree = np.zeros(len(a), dtype=np.int32)
    least = least_agreements(left.shape[1], threshold, TOLERANCE)
    for start in range(0, left.shape[1], BATCH):
        agree += (left[a, start : start + BATCH] == right[b, start : start + BATCH]).sum(axis=1, dtype=np.int32)
        stay = agree >= least[min(start + BATCH, left.shape[1])]
        a, b, agree = a[stay], b[stay], agree[stay]
    return np.stack([a, b], axis=1)


def verified(pairs: np.ndarray, left: list[np.ndarray], right: list[np.ndarray], threshold: float = THRESHOLD) -> np.ndarray:
    """The pairs whose exact similarity reaches the threshold."""
    if not len(pairs):
        return pairs
    shared = np.zeros(len(pairs), dtype=np.int64)
    if len(pairs) <= 32:
        for k, (a, b) in enumerate(pairs):
            shared[k] = len(np.intersect1d(left[a], right[b], assume_unique=True))
    else:
        # Shingles by columns of a 0/1 matrix, so many columns at a time, multiplied for all pairs at once.
        used_a, used_b = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
        at_a, at_b = np.searchsorted(used_a, pairs[:, 0]), np.searchsorted(used_b, pairs[:, 1])
        every = [left[a] for a in used_a] + [right[b] for b in used_b]
        owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
        _, column = np.unique(np.concatenate(every), return_inverse=True)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        width = 4096
        for start in range(0, int(column[-1]) + 1, width):
            lo, hi = np.searchsorted(column, [start, start + width])
            grid = np.zeros((len(every), width), dtype=np.float32)
            grid[owner[lo:hi], column[lo:hi] - start] = 1
            product = grid[: len(used_a)] @ grid[len(used_a) :].T
            shared += np.rint(product[at_a, at_b]).astype(np.int64)
    sizes = np.array([len(left[a]) + len(right[b]) for a, b in pairs]) - shared
    return pairs[shared >= threshold * sizes - 1e-9]


def sets(docs: DataFrame) -> DataFrame:
    """``doc_id, text_id, key, bands`` of every row that has an id: its text's digest, its shingle set's digest and band keys, null without a word."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in wordhash.slices(batches, "_text"):
            keys, bands = [], []
            for text in texts:
                shingles = shingle_set(text)
                keys.append(set_key(shingles) if len(shingles) else None)
                bands.append(band_keys(min_hashes(shingles)) if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("text_id"), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_id", "key", "bands"],
            )

    return _texts(docs).mapInArrow(run, "doc_id bigint, text_id binary, key binary, bands array<bigint>")


def _texts(docs: DataFrame) -> DataFrame:
    rows = docs.where("doc_id is not null")
    return rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), digest(text_of()).alias("text_id"), text_of().alias("_text"))


def candidates(members: DataFrame) -> DataFrame:
    """Per member (id, bands) that shares a bucket: ``id, slots``, its buckets as ``(band, bucket, parts)``."""
    banded = members.select("id", F.posexplode_outer("bands").alias("band", "bucket"))
    buckets = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.expr("cast(xxhash64(id) as decimal(20))")).alias("content"))
    buckets = materialise(buckets.where("n > 1"), "buckets")
    # Buckets of the same members, by count and sum of hashes, go by the smallest of their keys.
    same = buckets.groupBy("n", "content").agg(F.min("bucket").alias("name"))
    named = materialise(buckets.join(same, ["n", "content"]).select("bucket", "name", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "bucket-names")
    slots = banded.join(named, "bucket").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("band", F.col("name").alias("bucket"), "parts"))).alias("slots"))
    return materialise(slots, "slots")


BLOCK_ROW = "bucket bigint, low int, high int, part int, id bigint, copies bigint, names array<bigint>, hashes binary, shingles binary"


def blocks(docs: DataFrame, members: DataFrame) -> DataFrame:
    """A row for each member, bucket and pair of parts in which it is compared, with what the comparison needs."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in wordhash.slices(batches, "_text"):
            out: list[tuple] = []
            for i, copies, slots, text in zip(*(rows.column(c).to_pylist() for c in ("id", "copies", "slots")), texts):
                shingles = shingle_set(text)
                names = [0] * BANDS
                for s in slots:
                    names[s["band"]] = s["bucket"]
                hashes = min_hashes(shingles).tobytes()
                for bucket, parts in {s["bucket"]: s["parts"] for s in slots}.items():
                    part = int(wordhash.mixed(np.array([i ^ bucket], dtype=np.int64).view(np.uint64))[0]) % parts
                    for other in range(parts):
                        out.append((bucket, min(part, other), max(part, other), part, i, copies, names, hashes, shingles.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 9, kinds)], names=columns)

    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    columns = [c.split()[0] for c in BLOCK_ROW.split(", ")]
    named = members.select("rep.doc_id", "rep.text_id", "id", "copies", "slots")
    # Most texts are no candidates and stay where they are.
    key = F.struct("doc_id", "text_id")
    texts = marked(_texts(docs), key, named, key, "_may").where("_may").drop("_may")
    return texts.join(named, ["doc_id", "text_id"]).select("id", "copies", "slots", "_text").mapInArrow(run, BLOCK_ROW)


def compare(rows: list[dict], threshold: float = THRESHOLD) -> Iterator[tuple]:
    """Of the members of one block: ``(id, root, links, texts)``, the smallest id it is linked with here and its links."""
    rows = list({r["id"]: r for r in rows}.values())
    low, high, bucket = rows[0]["low"], rows[0]["high"], rows[0]["bucket"]
    first = [r for r in rows if r["part"] == low]
    second = first if low == high else [r for r in rows if r["part"] == high]
    if not first or not second:
        return
    names = [np.array([r["names"] for r in side], dtype=np.int64) for side in (first, second)]
    hashes = [np.array([np.frombuffer(r["hashes"], np.uint32) for r in side]) for side in (first, second)]
    alive = np.ones((len(first), len(second)), dtype=bool) if low != high else np.triu(np.ones((len(first), len(first)), dtype=bool), 1)
    met = np.zeros(alive.shape, dtype=bool)
    for band in range(BANDS):
        a, b = names[0][:, band], names[1][:, band]
        here = (a[:, None] == b[None, :]) & (a != 0)[:, None]
        alive &= ~(here & ~met & (a != bucket)[:, None])
        met |= here
    sides = [[np.frombuffer(r["shingles"], np.uint64) for r in side] for side in (first, second)]
    pairs = verified(survivors(*hashes, alive, threshold), *sides, threshold)
    nodes = first if low == high else first + second
    shift = 0 if low == high else len(first)
    links, texts, root = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    ids = np.array([r["id"] for r in nodes])
    copies = np.array([r["copies"] for r in nodes])
    a, b = pairs[:, 0], pairs[:, 1] + shift
    for x, y in ((a, b), (b, a)):
        np.add.at(links, x, copies[y])
        np.add.at(texts, x, 1)
    root = ids.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, a, root[b])
        np.minimum.at(root, b, root[a])
        if (before == root).all():
            break
    for k in np.flatnonzero(texts):
        yield int(ids[k]), int(root[k]), int(links[k]), int(texts[k])


def compared(rows: DataFrame) -> DataFrame:
    """``id, root, links, texts`` of every member in every block, block after block from sorted rows."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 4)], names=["id", "root", "links", "texts"])
            out.clear()
            return made

        block = None
        for batch in batches:
            for start in range(0, len(batch), 512):
                for row in batch.slice(start, 512).to_pylist():
                    key = row["bucket"], row["low"], row["high"]
                    if key != block:
                        if len(held) > 1:
                            out.extend(compare(held))
                        held, block = [], key
                    held.append(row)
            yield flush()
        if len(held) > 1:
            out.extend(compare(held))
        yield flush()

    keys = ["bucket", "low", "high"]
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "id bigint, root bigint, links bigint, texts bigint")


def components(edges: DataFrame) -> DataFrame:
    """``id, class_id``: the smallest id of each component of ``edges`` (a, b), by large-star and small-star rounds."""
    edges = materialise(edges.where("a > b").distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        large = materialise(large, "large-star")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        small = materialise(small.where("a > b").distinct(), "small-star")
        if small.join(edges, ["a", "b"], "left_anti").isEmpty() and edges.join(small, ["a", "b"], "left_anti").isEmpty():
            return small.select(F.col("a").alias("id"), F.col("b").alias("class_id"))
        edges = small


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every row with an id as in ``sets``, and of each shingle set that has a link ``key, first, n_links, n_linked_texts``.

    ``first`` is the smallest (doc_id, text_id) of the set's class.
    """
    light = materialise(sets(docs), "shingle-sets")
    rep = F.min(F.struct("doc_id", "text_id")).alias("rep")
    reps = light.where("key is not null").groupBy("key", "bands").agg(rep, F.count("*").alias("copies"))
    # Numbers are fixed by being written; everything after this reads the written ones.
    reps = materialise(reps.withColumn("id", F.monotonically_increasing_id()), "shingle-reps")
    members = reps.select("id", "rep", "copies").join(candidates(reps), "id")
    found = materialise(compared(blocks(docs, members)), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    facts = reps.select("id", "key", "rep", "copies").join(counts, "id", "left").where("copies > 1 or links is not null")
    facts = facts.join(roots, "id", "left").select(
        "key", "rep", F.coalesce("class_id", "id").alias("root"), F.pmod("id", F.lit(CLASS_PARTS)).alias("part"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("texts", F.lit(0)).alias("n_linked_texts"),
    )
    facts = materialise(facts, "facts")
    # By parts, so that a large class does not meet in one task.
    parts = materialise(facts.groupBy("root", "part").agg(F.min("rep").alias("rep")), "class-parts")
    firsts = parts.select("root", "part").join(parts.groupBy("root").agg(F.min("rep").alias("first")), "root")
    return light, materialise(facts.join(firsts, ["root", "part"]).select("key", "first", "n_links", "n_linked_texts"), "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, class_id, n_links, n_linked_texts``, one row per row of ``docs`` (doc_id, text).

    Two documents are linked when the Jaccard similarity of their sets of five-word shingles is 0.8 or more; ``class_id`` is
    the smallest doc_id of a document's connected group and its own where it has no link. ``n_links`` counts linked
    documents, those with the same set among them, ``n_linked_texts`` the different sets among them. A null text is empty;
    a text without words is linked with none, one of fewer than five words has one shingle of all its words. A row without a
    doc_id takes no part: no class, no link. Every row is a document, also one that repeats an id: rows that share an id
    and not a text have the links and the class of their own texts. Other columns are not read. No rows give no rows.
    """
    light, facts = _classes(docs)
    zero = F.lit(0).cast("bigint")
    out = light.join(facts, "key", "left").select(
        "doc_id", F.coalesce("first.doc_id", "doc_id").alias("class_id"), F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("n_linked_texts", zero).alias("n_linked_texts"),
    )
    none = docs.where("doc_id is null").select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("class_id"), zero.alias("n_links"), zero.alias("n_linked_texts"))
    return out.unionByName(none)


def drop_near(docs: DataFrame) -> DataFrame:
    """Of each class of ``near_duplicates`` the document with the smallest doc_id, and all rows that are in no class; all columns as they are.

    Of different texts with that doc_id the one with the smallest SHA-256 stays; rows that repeat both id and text stay together, as
    do rows without a doc_id. Columns may have any names.
    """
    light, facts = _classes(docs)
    doc, text, may = free(docs, "_gone", "_gone_text", "_may")
    gone = light.join(facts, "key").where("struct(doc_id, text_id) != first").select(F.col("doc_id").alias(doc), F.col("text_id").alias(text))
    same = (F.col("doc_id") == F.col(doc)) & (digest(text_of()) == F.col(text))
    gone = materialise(gone.distinct(), "near-copies")
    # Rows whose id is not among those that go do not move.
    rows = marked(docs, F.col("doc_id").cast("bigint"), gone, F.col(doc), may)
    return rows.where(F.col(may)).join(gone, same, "left_anti").unionByName(rows.where(~F.col(may))).drop(may)
