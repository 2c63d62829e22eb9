"""Removal of byte strings of LENGTH bytes that also start in an earlier document, by external induced sorting of suffixes.

Suffixes are sorted where they are sampled, and all others are induced from these.

1. Sample. Every string of LENGTH bytes holds a sampled place: that of the smallest hash among its K-byte pieces, leftmost of equal ones.
   The piece is the suffix's name. A stretch is a run of strings (places of the text) that share their sampled place. Tasks
   hand on their suffix tuples as sorted runs, one for each shard.
2. Recursion. A shard merges its runs in Spark's sort, which spills to disk. Names that occur once end here, as no
   string over them repeats. Stretches with equal bytes (name and context, 128 bits of hash) are repeats of the first document's.
3. Induction. Where a name stands in different contexts, the suffixes from the sampled places on are sorted by their bytes, again in Spark's sort,
   and get the length of the common prefix with their predecessor. One place further to the left, a suffix's rank is that of its
   byte, then that of the suffix right of it, and the common prefix is one more than the smallest one between the two in the round before, or none.
   Strings are equal where the common prefix reaches LENGTH.

Tuples are read as a sorted stream, CHUNK of them at a time. A name with more contexts than that goes on as single
strings, which Spark groups by their bytes; the result is the same.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkdesk.llm import wordhash
from sparkdesk.llm.common import ship, text_of
from sparkdesk.session import materialise

LENGTH, K = 50, 16
SPAN = LENGTH - K + 1
#: Bytes of a text that are sampled at once, tuples of a run, and contexts that are induced at once.
SEGMENT, RUN, CHUNK = 1 << 20, 1 << 18, 200_000
BASE = int(wordhash._numbers("suffix", 1)[0])
INVERSE = pow(BASE, -1, 1 << 64)
COLUMNS = ("name", "context", "doc", "sub", "pos")
#: A place packed with the distance from the first string of its stretch to the sampled place, and the number of strings.
SHIFT = 12


@functools.lru_cache
def _powers(base: int) -> np.ndarray:
    return wordhash.powers(SEGMENT + LENGTH, np.uint64(base))


def _segment(raw: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a text's bytes, by stretch: name, context, first place, distance to the sampled place, number of strings."""
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(wordhash.BYTES[raw] * _powers(BASE)[: len(raw)], out=sums[1:])
    back = _powers(INVERSE)
    names = wordhash.mixed((sums[K:] - sums[:-K]) * back[: len(raw) - K + 1])
    low = np.uint64((1 << 21) - 1)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    least, width = (names & ~low) | np.arange(len(names), dtype=np.uint64), 1
    while width < SPAN:
        step = min(width, SPAN - width)
        least, width = np.minimum(least[: len(least) - step], least[step:]), width + step
    place = (least & low).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    n, place = np.diff(first, append=len(place)), place[first]
    shape = n.astype(np.uint64) * wordhash.RUN + (place - first).astype(np.uint64) * wordhash.STEP
    contexts = wordhash.mixed((sums[first + n - 1 + LENGTH] - sums[first]) * back[first] + shape)
    return names[place], contexts, first, place - first, n


def stretches(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Name, context and packed place of a text's stretches, from overlapping segments of it."""
    raw = np.frombuffer(text, dtype=np.uint8)
    for start in range(0, max(0, len(raw) - LENGTH + 1), SEGMENT):
        names, contexts, first, apart, n = _segment(raw[start : start + SEGMENT + LENGTH - 1])
        yield names, contexts, (start + first) << SHIFT | apart << 6 | n


def keyed(docs: DataFrame) -> DataFrame:
    """``doc, sub, text`` of the rows with an id; ``sub`` tells rows of one id by their text, and is 0 where the id is there once."""
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1")
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc"), text_of().alias("text"))
    # Left out of the plan's cost where no id is repeated; else a plain join, broadcast only at a known small size.
    rows = rows.join(materialise(ids.select(F.col("doc_id").cast("bigint").alias("doc"), F.lit(True).alias("_many")), "repeated-ids"), "doc", "left")
    return rows.select("doc", F.when(F.col("_many"), F.xxhash64("text")).otherwise(F.lit(0).cast("bigint")).alias("sub"), "text")


def sorted_tuples(rows: DataFrame) -> DataFrame:
    """``name, context, doc, sub, pos`` of all stretches of ``rows`` (doc, sub, text), each name in one partition, sorted."""
    spark = rows.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def flush(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held)]
        shard = (columns[0] % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((columns[0], shard))
        edges = np.flatnonzero(np.diff(shard[order], prepend=-1))
        ends = pa.array([*edges.tolist(), len(order)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(c[order].view(np.int64))) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(shard[order][edges], pa.int32()), *lists], names=["shard", *COLUMNS])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch, texts in wordhash.slices(batches, "text"):
            for doc, sub, text in zip(batch.column("doc").to_pylist(), batch.column("sub").to_pylist(), texts):
                for names, contexts, pos in stretches(text):
                    held.append([names, contexts, np.full(len(pos), doc), np.full(len(pos), sub), pos])
                    size += len(pos)
                    if size >= RUN:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    ship(spark)
    shipped = rows.select("doc", "sub", "text").mapInArrow(runs, "shard int, " + ", ".join(f"{c} array<bigint>" for c in COLUMNS))
    tuples = shipped.repartition(shards, "shard").select(F.inline(F.arrays_zip(*COLUMNS)))
    return tuples.sortWithinPartitions("name", "context", "doc")


def repeated(tuples: DataFrame) -> DataFrame:
    """``doc, sub, pos, name`` of stretches whose name occurs again: without a name where the whole stretch is in an earlier
    document, with it where the first document of a context has to be held against other contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, dtype=np.int64)] * len(COLUMNS)
        last, many = (0, 0, 0), False  # name, context and first document at the end of what was read, if its name has several contexts
        for batch in batches:
            columns = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, COLUMNS)]
            name, context, doc, sub, pos = columns
            if not len(name):
                continue
            new_name = np.append(True, name[1:] != name[:-1])
            new = new_name | np.append(True, context[1:] != context[:-1])
            of_name, of_context = np.cumsum(new_name) - 1, np.cumsum(new) - 1
            first = doc[np.flatnonzero(new)]
            several = np.bincount(of_name[new]) > 1
            if many and name[0] == last[0]:
                several[0] = True
                if context[0] == last[1]:
                    first[0] = last[2]
            gone = doc > first[of_context]
            open_end = (of_name == of_name[-1]) & ~several[-1]
            branch = ~gone & several[of_name] & ~open_end
            keep = np.flatnonzero(gone | branch)
            yield pa.RecordBatch.from_arrays([pa.array(doc[keep]), pa.array(sub[keep]), pa.array(pos[keep]), pa.array(name[keep], mask=gone[keep])], names=out)
            many, last = bool(several[-1]), (name[-1], context[-1], first[-1])
            held = [c[open_end & ~gone] for c in columns]

    out = ["doc", "sub", "pos", "name"]
    return tuples.mapInArrow(run, "doc bigint, sub bigint, pos bigint, name bigint")


def compressed(rows: DataFrame) -> DataFrame:
    """``rows`` (doc, sub, text) with the text as a zstd frame, for moving it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch, texts in wordhash.slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("sub"), pa.array([pack.compress(t) for t in texts], pa.binary())], names=["doc", "sub", "z"])

    return rows.select("doc", "sub", "text").mapInArrow(run, "doc bigint, sub bigint, z binary")


def _unzip(batch: pa.RecordBatch) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return (unpack.decompress(z) for z in batch.column("z").to_pylist())


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def contexts(rows: DataFrame, branches: DataFrame) -> DataFrame:
    """``name, right, left, place, least, doc, sub``: the bytes of ``branches`` (doc, sub, pos, name), each name sorted by ``right``.

    ``right`` are the up to LENGTH bytes from the sampled place on, ``left`` those before it back to the stretch's first string, and
    ``least`` the distance of the last string's start to the place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = [[] for _ in names]
            for doc, sub, found, text in zip(batch.column("doc").to_pylist(), batch.column("sub").to_pylist(), batch.column("found").to_pylist(), _unzip(batch)):
                for f in found:
                    first, apart, n = f["pos"] >> SHIFT, f["pos"] >> 6 & 63, f["pos"] & 63
                    place = first + apart
                    row = (f["name"], text[place : first + n - 1 + LENGTH], text[first:place], place, apart - n + 1, doc, sub)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    names = ["name", "right", "left", "place", "least", "doc", "sub"]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    found = branches.groupBy("doc", "sub").agg(F.collect_list(F.struct("pos", "name")).alias("found"))
    joined = compressed(rows).join(found, ["doc", "sub"]).select("doc", "sub", "found", "z")
    told = joined.mapInArrow(run, "name bigint, right binary, left binary, place bigint, least int, doc bigint, sub bigint")
    return told.repartition("name").sortWithinPartitions("name", "right")


def _padded(values: pa.Array, width: int, reverse: bool = False) -> np.ndarray:
    """Rows of ``width`` bytes, filled up with 0; the last byte first where reversed."""
    values = values.cast(pa.binary())
    raw = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)
    edges = np.frombuffer(values.buffers()[1], dtype=np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    sizes = np.diff(edges)
    out = np.zeros((len(values), width), dtype=np.uint8)
    column = np.arange(width)
    inside = column < sizes[:, None]
    at = edges[1:, None] - 1 - column if reverse else edges[:-1, None] + column
    out[inside] = raw[at[inside]]
    return out


def least_between(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``values[a:b]`` for each pair, a < b."""
    table = [values]
    size = b - a
    while 2 << (len(table) - 1) <= size.max(initial=1):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(a), dtype=values.dtype)
    for k, row in enumerate(table):
        mine = level == k
        out[mine] = np.minimum(row[a[mine]], row[b[mine] - (1 << k)])
    return out


def induced(name: np.ndarray, right: np.ndarray, left: np.ndarray, least: np.ndarray, most: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of row and distance: the string so far before the sampled place of that row is in an earlier document's row.

    Rows are sorted by name, then by ``right`` (LENGTH bytes each); ``left`` are the bytes before it, the nearest first. A row's
    strings start ``least`` to ``most`` bytes before its place.
    """
    if not len(name):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    group = np.cumsum(np.append(False, name[1:] != name[:-1]))
    same = np.argmin(np.append(right[1:] == right[:-1], np.zeros((len(name) - 1, 1), dtype=bool), axis=1), axis=1)
    common = np.append(0, np.where(group[1:] == group[:-1], same, 0)).astype(np.uint8)
    order, rows, far = np.arange(len(name)), [], []
    for distance in range(LENGTH):
        mine = np.flatnonzero(common < LENGTH)
        live = least[order] <= distance
        value = np.where(live, doc[order], np.iinfo(np.int64).max)
        first = np.repeat(np.minimum.reduceat(value, mine), np.diff(mine, append=len(order)))
        late = order[live & (value > first)]
        rows.append(late), far.append(np.full(len(late), distance))
        # One place to the left: by name and the byte there, and within these as before.
        on = np.flatnonzero(most[order] > distance)
        if not len(on):
            break
        key = group[order[on]].astype(np.int64) << 8 | left[order[on], distance]
        sort = np.argsort(key, kind="stable")
        at, key = on[sort], key[sort]
        further = np.zeros(len(at), dtype=np.uint8)
        joint = np.flatnonzero(key[1:] == key[:-1]) + 1
        further[joint] = np.minimum(least_between(common, at[joint - 1] + 1, at[joint] + 1), LENGTH - 1) + 1
        order, common = order[at], further
    return np.concatenate(rows), np.concatenate(far)


def compared(rows: DataFrame) -> DataFrame:
    """``doc, sub, start, n, string`` of ``contexts``: strings found in an earlier document, or, for a name of more than CHUNK contexts, every
    string with its bytes, still to be compared."""

    def answer(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        part = lambda c: table.column(c).chunk(0) if table.column(c).num_chunks else pa.array([], table.schema.field(c).type)
        place, least, doc = (part(c).to_numpy(zero_copy_only=False) for c in ("place", "least", "doc"))
        left = part("left")
        most = np.diff(np.frombuffer(left.cast(pa.binary()).buffers()[1], dtype=np.int32)[left.offset : left.offset + len(left) + 1])
        row, far = induced(part("name").to_numpy(), _padded(part("right"), LENGTH), _padded(left, LENGTH, True), least, most, doc)
        # Distances that follow each other are one run.
        order = np.lexsort((-far, row))
        row, start = row[order], place[row[order]] - far[order]
        edge = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1))) if len(row) else np.zeros(0, dtype=np.int64)
        n = np.diff(edge, append=len(row))
        take = pa.array(row[edge])
        return pa.RecordBatch.from_arrays([part("doc").take(take), part("sub").take(take), pa.array(start[edge]), pa.array(n), pa.nulls(len(n), pa.binary())], names=out)

    def singly(table: pa.Table) -> pa.RecordBatch:
        found = [[] for _ in out]
        for r in table.to_pylist():
            whole = r["left"] + r["right"]
            for far in range(r["least"], len(r["left"]) + 1):
                at = len(r["left"]) - far
                for column, value in zip(found, (r["doc"], r["sub"], r["place"] - far, 1, whole[at : at + LENGTH])):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.int64(),) * 4 + (pa.binary(),))], names=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if hot is not None:
                # The rest of a name that has more contexts than are held.
                count = int((table.column("name").to_numpy() == hot).argmin()) if table.column("name")[-1].as_py() != hot else len(table)
                for start in range(0, count, 2_000):
                    yield singly(table.slice(start, min(2_000, count - start)))
                table = table.slice(count)
                if not len(table):
                    continue
                hot = None
            held = table if held is None else pa.concat_tables([held, table])
            if len(held) <= CHUNK:
                continue
            names = held.column("name").to_numpy()
            end = int(np.flatnonzero(names != names[-1])[-1]) + 1 if names[0] != names[-1] else 0
            for start, stop in _names(names[:end]):
                yield from whole(held.slice(start, stop - start))
            held = held.slice(end)
            if len(held) > CHUNK:
                hot = names[-1]
                yield from whole(held)
                held = None
        if held is not None:
            for start, stop in _names(held.column("name").to_numpy()):
                yield from whole(held.slice(start, stop - start))

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(table) <= CHUNK:
            yield answer(table)
        else:
            for start in range(0, len(table), 2_000):
                yield singly(table.slice(start, 2_000))

    def _names(names: np.ndarray) -> Iterator[tuple[int, int]]:
        """Slices of whole names, of CHUNK rows at most or of one name."""
        edges = [*(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)] if len(names) else []
        start, stop = 0, 0
        for edge in edges:
            if edge - start > CHUNK and stop > start:
                yield start, stop
                start = stop
            stop = edge
        if stop > start:
            yield start, stop

    out = ["doc", "sub", "start", "n", "string"]
    return rows.mapInArrow(run, "doc bigint, sub bigint, start bigint, n bigint, string binary")


def covered(rows: DataFrame) -> DataFrame:
    """``doc, sub, start, n``: strings of ``rows`` (doc, sub, text) from start to start + n - 1 also start in a document of a smaller id."""
    found = materialise(repeated(sorted_tuples(rows)), "stretches")
    spans = found.where("name is null").select("doc", "sub", F.shiftright("pos", SHIFT).alias("start"), F.expr("pos & 63").alias("n"))
    told = materialise(compared(contexts(rows, found.where("name is not null"))), "induced")
    strings = told.where("string is not null")
    first = strings.groupBy("string").agg(F.min("doc").alias("first"))
    later = strings.join(first, "string").where("doc > first")
    return spans.unionByName(told.where("string is null").drop("string")).unionByName(later.select("doc", "sub", "start", "n"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: the bytes of each row of ``docs`` (doc_id, text) that stay, and how many runs went.

    A byte goes when a string of LENGTH bytes over it also starts in a document with a smaller id; strings are those of the input. A null
    text is empty, and one of fewer than LENGTH bytes loses nothing. A row without an id loses nothing and takes nothing from
    others. Rows that repeat an id are judged each by its own text, and take nothing from each other. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sizes, gone, runs, kept = [], [], [], []
            for found, text in zip(batch.column("found"), _unzip(batch)):
                raw = np.frombuffer(text, dtype=np.uint8)
                sizes.append(len(raw))
                if found.is_valid:
                    start, n = (found.values.field(k).to_numpy(zero_copy_only=False) for k in ("start", "n"))
                    edge = np.zeros(len(raw) + 1, dtype=np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + n - 1 + LENGTH, -1)
                    cover = np.cumsum(edge[:-1]) > 0
                    runs.append(int(np.count_nonzero(cover[1:] & ~cover[:-1]) + cover[0]))
                    raw = raw[~cover]
                else:
                    runs.append(0)
                gone.append(sizes[-1] - len(raw))
                kept.append(raw.tobytes())
            columns = [batch.column("doc"), *(pa.array(c, pa.int64()) for c in (sizes, gone, runs)), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    ship(docs.sparkSession)
    rows = keyed(docs)
    marks = covered(rows).groupBy("doc", "sub").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    marks = materialise(marks, "marks")
    joined = compressed(rows).join(marks, ["doc", "sub"], "left").select("doc", "found", "z")
    nobody = docs.where("doc_id is null").select(F.lit(None).cast("bigint").alias("doc"), F.lit(0).cast("bigint").alias("sub"), text_of().alias("text"))
    nobody = compressed(nobody).select("doc", F.lit(None).cast(marks.schema["found"].dataType).alias("found"), "z")
    done = joined.unionByName(nobody).mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return done.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
