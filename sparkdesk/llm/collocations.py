"""Collocations by set-oriented mining (SETM) over persisted occurrence relations.

A relation holds, for phrases of one length, which phrase starts at each place of each piece, sorted by (piece, place). It is
stored in blocks: one row for some megabytes of text of one language, its places as one column of local codes with -1 where
a piece ends or no phrase lives, and beside it the block's own list of phrases with their counts. Blocks lie in buckets, so
that what is sent to a block finds it where it is. A round

- merge-joins the relation with itself on the same piece and the next place, so that two phrases that overlap in all but one word
  become one of a word more; both sides are sorted, so the join is one pass over the column,
- group-counts: the blocks' lists, already added up inside each block, are dealt out by phrase into parts, in packed columns, and meet there,
- semi-joins: phrases frequent in the language go back to their blocks, and places of all others die before the next round.

The places of pairs are not stored, as most of them die: the round after joins them once more, from the places of words. Nor are the
lists of pairs, the longest there are, moved from one worker to another: the pass that joins the pairs of a block deals them out.

Words meet by their texts and longer phrases by the ids of their two halves. An id is the number of a frequent phrase among those of
its language and part, dealt out in turn over the parts, so ids are dense and no two of a language and length are one. The two ids
make one number below the square of their bound, scrambled one to one: parts are ranges of it, and sorted it takes small steps.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.llm import wordhash
from sparkdesk.llm.common import ship, text_of
from sparkdesk.session import bucketed, materialise

LEAST, LONGEST, TOP = 100, 5, 2000
NO_LANG = "und"
#: Characters of text in a block.
BLOCK = 4_000_000
#: Rows of the blocks' lists in a part, about.
PART = 1_000_000
#: No id is as large.
BOUND = 1 << 31
# What parts pieces and words, over lower-cased texts.
PIECE_END, GAP = r"[.,;:!?\x0A-\x0D]+", r"[\x20\x09]+"

_WORDS = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
_GRAMS = pa.list_(pa.struct([("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64())]))
RELATION = "block bigint, lang string, codes binary, size bigint, found array<struct<{}>>"
DEALT = "part int, block bigint, lang string, size bigint, codes binary, keys binary, counts binary"


_ZSTD = pa.Codec("zstd", compression_level=3)


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers of equal width, all first bytes before all second ones, so that small ones take little room."""
    return _ZSTD.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), asbytes=True)


def _unplanes(row: bytes, size: int, kind: str = "<i8") -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(row, decompressed_size=size * width, codec="zstd"), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, size).T).view(kind).ravel()


def _packed(codes: np.ndarray) -> bytes:
    return _planes((codes + 1).astype("<u4"))


def _codes(row: bytes, size: int) -> np.ndarray:
    return _unplanes(row, size, "<u4").astype(np.int64) - 1


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as their steps, so that rising ones take little room."""
    return _planes(np.diff(values.astype("<i8"), prepend=np.int64(0)))


def _unsqueezed(row: bytes, size: int) -> np.ndarray:
    return np.cumsum(_unplanes(row, size))


def _turn(ids: np.ndarray, step: int, bound: int) -> np.ndarray:
    return (wordhash.mixed(ids.astype(np.uint64) * wordhash.STEP + np.uint64(step)) % np.uint64(bound)).astype(np.int64)


def scrambled(left: np.ndarray, right: np.ndarray, bound: int) -> np.ndarray:
    """One number for each pair of ids below ``bound``, evenly spread below its square; no two pairs share one."""
    left = (left + _turn(right, 1, bound)) % bound
    right = (right + _turn(left, 2, bound)) % bound
    left = (left + _turn(right, 3, bound)) % bound
    return left * bound + right


def unscrambled(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    left, right = values // bound, values % bound
    left = (left - _turn(right, 3, bound)) % bound
    right = (right - _turn(left, 2, bound)) % bound
    return (left - _turn(right, 1, bound)) % bound, right


def _given_back() -> None:
    """What Arrow keeps for later goes back to the system: workers live on between tasks, and an executor has several."""
    pa.default_memory_pool().release_unused()


def _listed(values: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """One list row of structs."""
    rows = pa.StructArray.from_arrays(values, fields=list(kind.value_type))
    return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)


def tokenised(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word codes of all texts one after another, -1 between pieces, and the words."""
    low = pc.ascii_lower(texts.cast(pa.large_string()))
    # A full stop is in no word, so as a word of its own it ends a piece.
    low = pc.replace_substring_regex(low, PIECE_END, " . ")
    low = pc.binary_join_element_wise(low, pa.scalar(" .", pa.large_string()), pa.scalar("", pa.large_string()))
    flat = pc.split_pattern_regex(low, GAP).flatten().dictionary_encode()
    words = flat.dictionary
    real = pc.invert(pc.is_in(words, pa.array(["", "."], words.type))).to_numpy(zero_copy_only=False)
    number = np.where(real, np.cumsum(real) - 1, -1)
    return number[flat.indices.to_numpy(zero_copy_only=False)], words.filter(pa.array(real)).cast(pa.string())


def occurrences(docs: DataFrame) -> DataFrame:
    """``block, lang, codes, size, found``: the relation of single words; ``found`` lists word and count by code, frequent words first, equal ones sorted."""

    def flush(lang: str, parts: list[pa.Array], number: int) -> pa.RecordBatch:
        codes, words = tokenised(pa.chunked_array(parts).combine_chunks())
        counts = pa.array(np.bincount(codes[codes >= 0], minlength=len(words)), pa.int64())
        order = pc.sort_indices(pa.table({"n": counts, "word": words}), sort_keys=[("n", "descending"), ("word", "ascending")])
        rank = np.full(len(words) + 1, -1, dtype=np.int64)
        rank[order.to_numpy()] = np.arange(len(words))
        codes = rank[codes]  # code -1 reads the last entry, which stays -1
        columns = [pa.array([number]), pa.array([lang]), pa.array([_packed(codes)], pa.binary()), pa.array([len(codes)])]
        return pa.RecordBatch.from_arrays([*columns, _listed([words.take(order), counts.take(order)], _WORDS)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for start in range(0, len(batch), 500):
                rows = batch.slice(start, 500)
                for lang in rows.column(0).unique().to_pylist():
                    texts = rows.column(1).filter(pc.equal(rows.column(0), lang))
                    held.setdefault(lang, []).append(texts)
                    sizes[lang] = sizes.get(lang, 0) + texts.nbytes
                    if sizes[lang] >= BLOCK:
                        yield flush(lang, held.pop(lang), number)
                        sizes[lang], number = 0, number + 1
                        _given_back()
        for lang in list(held):
            yield flush(lang, held.pop(lang), number)
            number += 1
            _given_back()

    names = ["block", "lang", "codes", "size", "found"]
    ship(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of().alias("_text"))
    return rows.mapInArrow(run, RELATION.format("word string, n bigint"))


def _joined(block: pa.Table, kept: pa.Table, bounds: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Of one block: the code at each place of the phrases that ``kept`` leads to, and their scrambled pairs, sorted, and counts by code; None if there are none."""
    if not len(block):
        return None
    codes, rows = _codes(block.column("codes")[0].as_py(), block.column("size")[0].as_py()), kept.to_pylist()
    for step, bound in enumerate(bounds):
        own = [r for r in rows if r["step"] == step]
        if not own:
            return None
        code = np.concatenate([_unsqueezed(r["codes"], r["size"]) for r in own])
        local = np.full(max(int(codes.max()), int(code.max())) + 2, -1, dtype=np.int64)
        local[code] = np.concatenate([_unsqueezed(r["ids"], r["size"]) for r in own])
        at = local[codes]  # code -1 reads the last entry, which stays -1
        here, after = at[:-1], at[1:]
        live = np.flatnonzero((here >= 0) & (after >= 0))
        if not len(live):
            return None
        values, code, counts = np.unique(scrambled(here[live], after[live], bound), return_inverse=True, return_counts=True)
        codes = np.full(len(here), -1, dtype=np.int64)
        codes[live] = code
    return codes, values, counts


def _met(relation: DataFrame, kept: tuple[DataFrame, ...]):
    """Each block with its own rows of ``kept``, numbered by step."""
    columns = relation.select("block", "lang", "codes", "size")
    steps = [one.select("block", "size", "codes", "ids", F.lit(step).alias("step")) for step, one in enumerate(kept)]
    lists = functools.reduce(DataFrame.unionByName, steps)
    return columns.groupBy("block").cogroup(lists.groupBy("block"))


def extended(relation: DataFrame, *kept: DataFrame, bounds: tuple[int, ...] = (BOUND,)) -> DataFrame:
    """The relation of phrases one word longer; ``kept`` (block, size, codes, ids) has the frequent phrases of ``relation``, packed, in any number of rows a block.

    ``found`` lists the ids of both halves and the count by code. A block where no two frequent phrases follow each other goes. Where more
    ``kept`` are given, each has the frequent phrases of the relation that the one before it led to, and phrases are as many words longer.
    Each has its bound in ``bounds``, above all its ids.
    """

    def run(block: pa.Table, kept: pa.Table) -> pa.Table:
        _given_back()
        joined = _joined(block, kept, bounds)
        if joined is None:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        codes, values, counts = joined
        left, right = unscrambled(values, bounds[-1])
        found = _listed([pa.array(left), pa.array(right), pa.array(counts)], _GRAMS)
        columns = [block.column("block"), block.column("lang"), pa.array([_packed(codes)], pa.binary()), pa.array([len(codes)]), found]
        return pa.table(columns, names=names)

    names, kinds = ["block", "lang", "codes", "size", "found"], [pa.int64(), pa.string(), pa.binary(), pa.int64(), _GRAMS]
    return _met(relation, kept).applyInArrow(run, RELATION.format("left bigint, right bigint, n bigint"))


def _words_packed(words: np.ndarray) -> bytes:
    """No word has a line feed in it."""
    return b"%d " % len(raw := b"\n".join(words)) + _ZSTD.compress(raw, asbytes=True)


def _words_of(row: bytes) -> list[bytes]:
    size, raw = row.split(b" ", 1)
    return pa.decompress(raw, decompressed_size=int(size), codec="zstd", asbytes=True).split(b"\n")


def _edges(parts: int, bound: int) -> np.ndarray:
    """Where the ranges of scrambled pairs of all parts but the first begin."""
    if bound > BOUND:
        raise ValueError(f"{bound} ids of one language and length; products of two must fit 64 bits")
    return np.array([bound * bound * i // parts for i in range(1, parts)], dtype=np.int64)


_DEALT_NAMES = [c.split()[0] for c in DEALT.split(", ")]
_DEALT_KINDS = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _parted(block: int, lang: str, part: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
    """A block's list, whose keys, words or scrambled pairs, and counts are by code, as columns of ``DEALT``: a row for each part."""
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.diff(part[order], prepend=-1))
    packed = _words_packed if keys.dtype == object else _squeezed
    out = [
        (int(part[codes[0]]), block, lang, len(codes), _squeezed(codes), packed(keys[codes]), _planes(counts[codes]))
        for codes in np.split(order, starts[1:])
    ]
    return [pa.array(c, t) for c, t in zip(zip(*out), _DEALT_KINDS)]


def dealt(relation: DataFrame, keys: list[str], parts: int, bound: int = BOUND) -> DataFrame:
    """The blocks' lists, a row for each block and part that has phrases of it: their codes, keys and counts, packed. A phrase has one part.

    Of longer phrases a part has those in its range of scrambled pairs, which is how ``extended`` sorts them: their codes are a range too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                found = batch.column("found")[row].values
                if not len(found):
                    continue
                if keys == ["word"]:
                    values = np.array(found.field("word").cast(pa.binary()).to_pylist(), dtype=object)
                    part = (wordhash.word_hashes(b"\n".join(values)) % np.uint64(parts)).astype(np.int64)
                else:
                    values = scrambled(*(found.field(key).to_numpy() for key in keys), bound)
                    part = np.searchsorted(edges, values, side="right")
                columns = _parted(batch.column("block")[row].as_py(), batch.column("lang")[row].as_py(), part, values, found.field("n").to_numpy())
                yield pa.RecordBatch.from_arrays(columns, names=_DEALT_NAMES)
                _given_back()

    edges = _edges(parts, bound)
    return relation.select("block", "lang", "found").mapInArrow(run, DEALT)


def dealt_longer(relation: DataFrame, *kept: DataFrame, parts: int, bounds: tuple[int, ...] = (BOUND,)) -> DataFrame:
    """What ``dealt`` makes of ``extended``, in one pass over a block, so that its list of pairs, which is long, stays in one worker and is packed there."""

    def run(block: pa.Table, kept: pa.Table) -> pa.Table:
        _given_back()
        joined = _joined(block, kept, bounds)
        if joined is None:
            return pa.table([pa.array([], t) for t in _DEALT_KINDS], names=_DEALT_NAMES)
        _, values, counts = joined
        part = np.searchsorted(edges, values, side="right")
        return pa.table(_parted(block.column("block")[0].as_py(), block.column("lang")[0].as_py(), part, values, counts), names=_DEALT_NAMES)

    edges = _edges(parts, bounds[-1])
    return _met(relation, kept).applyInArrow(run, DEALT)


def counted(lists: DataFrame, keys: list[str], least: int, parts: int, bound: int = BOUND) -> DataFrame:
    """Of every part of ``dealt`` lists: for each block ``block, size, codes, ids``, its phrases found at least so often in their language, packed, and
    for each language a row without a block, whose ``found`` lists these phrases: ``id``, keys and count ``a``."""

    def run(part: pa.Table) -> pa.Table:
        _given_back()
        rows, out, number = part.to_pylist(), [], part.column("part")[0].as_py()
        for lang in sorted({r["lang"] for r in rows}):
            own = [r for r in rows if r["lang"] == lang]
            if keys == ["word"]:
                coded = pa.array([w for r in own for w in _words_of(r["keys"])], pa.binary()).dictionary_encode()
                place, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
                totals = np.zeros(len(words), dtype=np.int64)
            else:
                values, place = np.unique(np.concatenate([_unsqueezed(r["keys"], r["size"]) for r in own]), return_inverse=True)
                totals = np.zeros(len(values), dtype=np.int64)
            np.add.at(totals, place, np.concatenate([_unplanes(r["counts"], r["size"]) for r in own]))
            often = totals >= least
            if not often.any():
                continue
            ids = number + parts * (np.cumsum(often) - 1)
            start = 0
            for r in own:
                here = place[start : start + r["size"]]
                start += r["size"]
                stay = often[here]
                if stay.any():
                    out.append((r["block"], lang, int(stay.sum()), _squeezed(_unsqueezed(r["codes"], r["size"])[stay]), _squeezed(ids[here[stay]]), None))
            phrases = [words.filter(pa.array(often)).to_pylist()] if keys == ["word"] else [half.tolist() for half in unscrambled(values[often], bound)]
            out.append((None, lang, None, None, None, [dict(zip(fields, row)) for row in zip(ids[often].tolist(), *phrases, totals[often].tolist())]))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds)], names=["block", "lang", "size", "codes", "ids", "found"])

    fields = ["id", *keys, "a"]
    phrase = ", ".join(f"{f}: {'binary' if f == 'word' else 'bigint'}" for f in fields)
    struct = pa.struct([(f, pa.binary() if f == "word" else pa.int64()) for f in fields])
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(struct)]
    return lists.groupBy("part").applyInArrow(run, f"block bigint, lang string, size bigint, codes binary, ids binary, found array<struct<{phrase}>>")


def _parts(entries: int) -> int:
    """A phrase is at most one entry of each block, so one that is everywhere is as many entries as there are blocks, and a part grows only by
    such phrases: there are as many parts as the lists need."""
    return max(1, math.ceil(entries / PART))


def frequent(relation: DataFrame, keys: list[str], least: int, bound: int = BOUND) -> tuple[DataFrame, DataFrame]:
    """Phrases found at least so often in their language: ``id, lang, a`` and the keys; and for the blocks ``block, size, codes, ids``, packed.

    Left and right ids are below ``bound``.
    """
    parts = _parts(relation.agg(F.sum(F.size("found"))).first()[0] or 0)
    return frequent_of(dealt(relation, keys, parts, bound), keys, least, parts, bound)


def frequent_of(lists: DataFrame, keys: list[str], least: int, parts: int, bound: int = BOUND) -> tuple[DataFrame, DataFrame]:
    """As ``frequent``, of ``dealt`` lists."""
    often = materialise(counted(lists, keys, least, parts, bound), "phrases-of-blocks")
    phrases = often.where("block is null").select("lang", F.explode("found").alias("_f"))
    named = [F.col(f"_f.{key}").cast("string" if key == "word" else "bigint").alias(key) for key in keys]
    phrases = phrases.select("_f.id", "lang", *named, "_f.a")
    return phrases, often.where("block is not null")


def candidates(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, phrase, k, a, n, pre, suf, inside``: every phrase of 2 to ``longest`` words found at least ``least`` times in its language.

    ``n`` is the number of the language's words, ``pre`` and ``suf`` the counts of the phrase's first and last 1, 2, ... k words, and
    ``inside`` is true where a candidate one word longer, thus any longer one, occurs as often. Rows are (lang, text) of ``docs``; a
    null text is empty, a null language is NO_LANG, repeated rows count each, and other columns are not read.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    relation, rows = bucketed(occurrences(docs), "words", "block", buckets)
    places, blocks = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    sizes = rows.select("lang", F.explode("found").alias("_f")).groupBy("lang").agg(F.sum("_f.n").alias("n"))
    words, kept = frequent(rows, ["word"], least)
    shorter = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", F.array("a").alias("pre"), F.array("a").alias("suf"))
    levels: list[DataFrame] = []
    lists: list[DataFrame] = []
    bounds: list[int] = []
    for k in range(2, longest + 1):
        lists.append(kept)
        bounds.append((shorter.agg(F.max("id")).first()[0] or 0) + 1)
        if k == 2:
            # A fourth of the places, about, are pairs that their block has not had before; parts are four times as large where all are.
            parts = _parts(places // 4)
            longer = dealt_longer(relation, *lists, parts=parts, bounds=tuple(bounds))
            grams, kept = frequent_of(longer, ["left", "right"], least, parts, bounds[-1])
        else:
            longer = extended(relation, *lists, bounds=tuple(bounds))
            relation, rows = bucketed(longer, "places", "block", max(1, min(buckets, blocks)))
            grams, kept = frequent(rows, ["left", "right"], least, bounds[-1])
            lists, bounds = [], []
        left = shorter.select("lang", F.col("id").alias("left"), F.col("phrase").alias("_first"), F.col("pre").alias("_pre"))
        right = shorter.select("lang", F.col("id").alias("right"), F.col("last"), F.col("suf").alias("_suf"))
        phrase = F.concat_ws(" ", "_first", "last").alias("phrase")
        whole = grams.join(left, ["lang", "left"]).join(right, ["lang", "right"]).select(
            "id", "lang", phrase, "last", "a", F.concat("_pre", F.array("a")).alias("pre"), F.concat("_suf", F.array("a")).alias("suf"), "left", "right"
        )
        whole = materialise(whole, "longer-phrases")
        if levels:
            # A phrase one word longer that is as frequent holds every occurrence of its half.
            halves = whole.where(F.element_at("pre", -2) == F.col("a")).select("lang", F.col("left").alias("id"))
            halves = halves.unionByName(whole.where(F.element_at("suf", -2) == F.col("a")).select("lang", F.col("right").alias("id")))
            levels[-1] = levels[-1].join(halves.distinct().withColumn("_in", F.lit(True)), ["lang", "id"], "left")
        levels.append(whole)
        shorter = whole
    told = [
        level.select("lang", "phrase", F.size("pre").alias("k"), "a", "pre", "suf", (F.col("_in").isNotNull() if "_in" in level.columns else F.lit(False)).alias("inside"))
        for level in levels
    ]
    rows = told[0]
    for level in told[1:]:
        rows = rows.unionByName(level)
    return rows.join(sizes, "lang")


def lowest_cut() -> Column:
    """struct<score, k, l, r> of the cut of a candidate with the lowest score floor(1000 a n / (l r)), the earliest of equal ones.

    Products are decimals of up to 38 digits, exact for counts below 10^17.
    """
    left, right = "element_at(pre, i)", "element_at(suf, k - i)"
    wide = lambda x: f"cast({x} as decimal(17, 0))"
    score = f"(cast(1000 as decimal(4, 0)) * {wide('a')} * {wide('n')}) div ({wide(left)} * {wide(right)})"
    return F.expr(f"array_min(transform(sequence(1, k - 1), i -> named_struct('score', {score}, 'k', i, 'l', {left}, 'r', {right})))")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best ``top`` candidates (all where it is None).

    Candidates inside a longer one of the same count are left out. Best is by score, then count, both descending, then by the phrase's
    UTF-8 bytes, so there are no ties. No texts, or none frequent, give no rows.
    """
    rows = candidates(docs, least, longest).where("not inside").withColumn("_cut", lowest_cut())
    rows = rows.select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("bigint"))
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
