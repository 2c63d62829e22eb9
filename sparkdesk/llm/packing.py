"""Packing of tokenised documents into sequences by patterns.

Pieces that follow each other, BLOCK tokens of them, are packed in the task that made them: patterns of one to three lengths that
fill a sequence exactly are given repeat counts by non-negative least squares against the block's histogram of lengths, and
counts are rounded so that no length is used more often than it occurs. What no full sequence took, a few pieces of a hundred, meets
once more over all blocks: patterns again, by the histogram of at most CAPACITY lengths, which alone comes to the driver, and
best-fit, longest first, for the rest. Only these pieces are moved, and there every one gets its rank among the pieces of its
length from its rank in its block and the counts of the blocks before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkdesk.llm import bpe
from sparkdesk.llm.common import ship, text_of
from sparkdesk.session import materialise

CAPACITY, END_ID = 1024, 2
#: Tokens of pieces that are packed together in a task.
BLOCK = 4_000_000
STEPS = 300


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every row of ``docs`` (doc_id, text).

    ``ids`` are little-endian unsigned 32-bit ids by the vocabulary file at ``path``, the end id after the last. They
    come from a library, five times as fast as the pair index of ``bpe``, which gives the same ones.
    A document longer than the capacity is cut into pieces of the capacity, of which the first may be shorter. A null
    text is empty: one piece with the end id alone. Repeated rows are packed each; other columns are not read.
    """

    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(encoder(path, capacity, end_id), _piece_schema(docs))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_of().alias("_text"))


def _piece_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("piece int, start bigint, length bigint, ids binary").fields])


def encoder(path: str, capacity: int = CAPACITY, end_id: int = END_ID):
    """What ``pieces`` does with the batches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = bpe.library(path), int(end_id).to_bytes(4, "little")
        for rows, texts in bpe.blocks(batches, "_text"):
            take, numbers, starts, ids = [], [], [], []
            for row, text in enumerate(texts):
                encoded = np.array(words.encode(text, allowed_special="all"), dtype="<u4").tobytes() + end
                first = (len(encoded) // 4 - 1) % capacity + 1
                cuts = [0, *range(first * 4, len(encoded), capacity * 4), len(encoded)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    take.append(row), numbers.append(number), starts.append(a // 4), ids.append(encoded[a:b])
            lengths = pa.array([len(i) // 4 for i in ids], pa.int64())
            columns = [rows.column(0).take(pa.array(take)), pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()), lengths, pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

    return run


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All rows (a, b, c), a >= b >= c, of lengths that occur and fill the capacity; 0 where there is no third or second."""
    there = np.zeros(capacity + 1, dtype=bool)
    there[lengths] = True
    there[0] = True
    found = []
    for a in sorted(lengths.tolist(), reverse=True):
        rest = capacity - a
        b = np.arange((rest + 1) // 2, min(a, rest) + 1)
        c = rest - b
        ok = there[b] & there[c]
        found.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), dtype=int)


def fit_counts(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts >= 0 that bring the patterns' lengths closest to the histogram: accelerated projected gradient."""
    width = len(histogram)
    make = lambda x: sum(np.bincount(patterns[:, k], x, width) for k in range(3))
    pull = lambda r: sum(r[patterns[:, k]] for k in range(3))
    # Index 0 stands for no document and does not count.
    used = np.ones(width)
    used[0] = 0
    v = np.ones(len(patterns))
    for _ in range(20):
        v = pull(used * make(v))
        top = np.linalg.norm(v)
        v = v / max(top, 1e-9)
    step = 1 / max(top, 1e-9)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y + step * pull(used * (histogram - make(y))))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def full_plan(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns that fill a sequence exactly, with counts; ``left``, how often each length occurs, is lowered by what they use."""
    out: list[tuple[tuple[int, ...], int]] = []
    patterns = exact_patterns(np.flatnonzero(left), capacity)
    if len(patterns):
        counts = np.rint(fit_counts(patterns, left.astype(float))).astype(np.int64)
        for k in np.argsort(-counts, kind="stable"):
            if counts[k] <= 0:
                break
            row = [int(v) for v in patterns[k] if v]
            n = int(min(counts[k], *(left[v] // row.count(v) for v in row)))
            if n > 0:
                out.append((tuple(row), n))
                for v in row:
                    left[v] -= n
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with counts that use every length exactly as often as it occurs."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    out = full_plan(left, capacity)
    return out + best_fit({int(v): int(left[v]) for v in np.flatnonzero(left)}, capacity)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first into the fullest sequences that still have room; equal sequences are handled by their count."""
    room: dict[int, dict[tuple[int, ...], int]] = {}
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            space = min((r for r in room if r >= length and room[r]), default=None)
            if space is None:
                each = capacity // length
                full, rest = divmod(n, each)
                for size, count in ((each, full), (rest, 1 if rest else 0)):
                    if count:
                        at = room.setdefault(capacity - size * length, {})
                        at[(length,) * size] = at.get((length,) * size, 0) + count
                break
            held, count = room[space].popitem()
            # As many of this length as fit, in as many of these sequences as there are documents for.
            each = min(space // length, n)
            used = min(count, n // each)
            at = room.setdefault(space - each * length, {})
            key = held + (length,) * each
            at[key] = at.get(key, 0) + used
            if count > used:
                room[space][held] = count - used
            n -= used * each
    return [(held, count) for at in room.values() for held, count in at.items()]


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the pieces of a block: the number of its full sequence from 0, or -1, the place there, and the rank among the block's
    other pieces of its length."""
    left = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    order = np.argsort(lengths, kind="stable")
    start = np.cumsum(left) - left
    used, total = np.zeros(capacity + 1, dtype=np.int64), left.copy()
    sequence, offset = np.full(len(lengths), -1, dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    number = 0
    for pattern, count in full_plan(left, capacity):
        at = 0
        for length in pattern:
            rows = order[start[length] + used[length] : start[length] + used[length] + count]
            sequence[rows], offset[rows] = np.arange(number, number + count), at
            used[length] += count
            at += length
        number += count
    rank = np.empty(len(lengths), dtype=np.int64)
    rank[order] = np.arange(len(lengths)) - np.repeat(start + used, total)
    return sequence, offset, rank


def packed_in_blocks(rows: DataFrame, capacity: int, make=None, schema: T.StructType | None = None) -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset`` of full sequences, -1 for pieces of none; and ``_block, _rank`` of these.

    Where ``make`` is given, the pieces are what it makes of the rows' batches, of that ``schema``, in the same Python worker.
    """

    def flush(held: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
        lengths = np.concatenate([b.column("length").to_numpy(zero_copy_only=False) for b in held])
        sequence, offset, rank = place(lengths, capacity)
        # No block has as many sequences as tokens.
        sequence = np.where(sequence >= 0, sequence + (block << 24), -1)
        at = 0
        for batch in held:
            part = slice(at, at + len(batch))
            at += len(batch)
            columns = [pa.array(c[part]) for c in (sequence, offset, np.full(len(lengths), block), rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*names, "sequence_id", "offset", "_block", "_rank"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, tokens, block = [], 0, TaskContext.get().partitionId() << 16
        for batch in make(batches) if make else batches:
            for start in range(0, len(batch), 2_000):
                held.append(batch.slice(start, 2_000))
                tokens += pc.sum(held[-1].column("length")).as_py()
                if tokens >= BLOCK:
                    yield from flush(held, block)
                    held, tokens, block = [], 0, block + 1
        if held:
            yield from flush(held, block)

    schema = schema or rows.schema
    names = schema.names
    added = [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset", "_block", "_rank")]
    ship(rows.sparkSession)
    return rows.mapInArrow(run, T.StructType([*schema.fields, *added]))


def pack(rows: DataFrame, capacity: int = CAPACITY, make=None, schema: T.StructType | None = None) -> DataFrame:
    """``rows`` (length and others) with ``sequence_id`` and ``offset``.

    Every sequence is filled from 0 without a gap, to the capacity at most. Rows need no id, and equal ones are packed each. No rows give
    no sequences. The rows are written once; those of full sequences stay where they are.
    """
    rows = materialise(packed_in_blocks(rows, capacity, make, schema), "pieces")
    full = rows.where("sequence_id >= 0").drop("_block", "_rank")
    rest = rows.where("sequence_id < 0").drop("sequence_id", "offset")
    sizes = rest.groupBy("length", "_block").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy("length").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    sizes = materialise(sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "piece-counts")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rest = rest.join(sizes.drop("_n"), ["length", "_block"]).withColumn("_rank", F.col("_rank") + F.col("_before")).drop("_block", "_before")
    slots, used, sequences = [], dict.fromkeys(histogram, 0), 0
    for pattern, count in plan(histogram, capacity):
        offset = 0
        for length in pattern:
            slots.append(((length << 52) + used[length], sequences - used[length], offset))
            used[length] += count
            offset += length
        sequences += count
    slots.sort()
    keys, bases, offsets = (np.array([s[k] for s in slots], dtype=np.int64) for k in range(3))

    names = [c for c in full.columns if c not in ("sequence_id", "offset")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = np.searchsorted(keys, (length << 52) + rank, side="right") - 1
            columns = [batch.column(c) for c in names]
            # Numbers below 0, so that they are none of a block's.
            yield pa.RecordBatch.from_arrays([*columns, pa.array(-1 - bases[at] - rank), pa.array(offsets[at])], names=[*names, "sequence_id", "offset"])

    return full.unionByName(rest.select(*names, "_rank").mapInArrow(run, full.schema))


def packed_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids`` of every piece of every document."""
    packed = pack(_texts(docs), make=encoder(path), schema=_piece_schema(docs))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset", "ids")
