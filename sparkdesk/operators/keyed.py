"""Keyed building blocks that hold up when one key owns a large share of the rows.

First-per-key keeps one row per key before the shuffle, and running counts work on (key, bucket)
groups of bounded size. Lookups are plain joins, whose frequent keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.functions.cells import column
from sparkdesk.functions.strings import is_blank, trim_ctl
from sparkdesk.session import materialise

BUCKET_BITS = 16
NUMBERED = r"(?s)^(.+)_([1-9][0-9]{0,17})$"
SUFFIXES = r"(?s)^.+?((?:_[1-9][0-9]{0,17})*)$"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` makes Spark drop all but one row per key in every
    input task, before the exchange, so a frequent key costs no more than others.
    """
    window = W.partitionBy(*[column(k) for k in keys]).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def insert_if_absent(
    new: DataFrame, existing: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """New rows whose key is not present yet; of several with one key the first wins."""
    first = first_per_key(new, keys, order)
    present = existing.select(*[column(k) for k in keys]).distinct()
    return first.join(present, list(keys), "left_anti")


def ordered_union(direct: Sequence[DataFrame], configured: Sequence[DataFrame] = ()) -> DataFrame:
    """Distinct URLs of several lists of ``(url, pos)`` in first-seen order, as ``(url, src, pos)``.

    Direct lists replace the configured ones; lists of one side are appended.
    """
    lists = list(direct) or list(configured)
    parts = [part.select(trim_ctl(F.col("url")).alias("url"), F.lit(i).alias("src"), "pos") for i, part in enumerate(lists)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return first_per_key(whole.where(~is_blank(F.col("url"))), ["url"], [F.col("src"), F.col("pos")])


def running_count(
    df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[Column], flag: Column, out: str
) -> DataFrame:
    """Per key and in order, how many rows up to and with this one have ``flag`` set (0 or 1).

    ``bucket`` must rise with the order and hold few rows of one key, such as
    the high bits of a unique position. A key is counted bucket by bucket; only
    the bucket totals of a key meet in one task.
    """
    names = [column(k) for k in keys]
    marked = df.withColumn("_bucket", bucket).withColumn("_flag", flag.cast("bigint"))
    totals = marked.groupBy(*names, "_bucket").agg(F.sum("_flag").alias("_n"))
    earlier = W.partitionBy(*names).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*names, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*names, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = marked.withColumn("_inside", F.sum("_flag").over(inside))
    return (
        counted.join(offsets, [*keys, "_bucket"])
        .withColumn(out, F.col("_inside") + F.col("_before"))
        .drop("_bucket", "_flag", "_inside", "_before")
    )


def high_bits(c: Column) -> Column:
    return F.shiftright(c.cast("bigint"), BUCKET_BITS)


def rank_in_key(df: DataFrame, keys: Sequence[str], pos: str, out: str = "rank") -> DataFrame:
    """1-based rank of each row in its key by a unique whole-number position."""
    return running_count(df, keys, high_bits(F.col(pos)), [F.col(pos)], F.lit(1), out)


def unique_names(
    df: DataFrame, base: str, pos: str, suffix: str = ".md", taken: DataFrame | None = None, out: str = "name"
) -> DataFrame:
    """File names as if rows were saved one after another: ``x``, then ``x_2``, ``x_3``.

    A name is skipped when it is in ``taken`` (column ``name``, with suffix) or was given
    before, also when it is the plain name of another row (``x_2`` as a title).
    The result equals the one-by-one process; ``pos`` is a unique whole number. A row
    without a base gets no name.

    The rounds are bounded by how many numbers a base ends in (``x_2_3`` has two), not by the rows. Only bases and positions, written once, go through the ranking; the rows
    themselves are joined to their names by position.
    """
    rows = df.where(column(base).isNotNull()).select(column(base).alias("_base"), column(pos).alias("_pos"))
    rows = materialise(rows, "names")
    items = rank_in_key(rows, ["_base"], "_pos", "_rank")
    firsts = rows.groupBy("_base").agg(F.min("_pos").alias("_first"))
    number = F.regexp_extract("_base", NUMBERED, 2)
    numbered = firsts.where(number != "").select(
        F.regexp_extract("_base", NUMBERED, 1).alias("_parent"), "_base", "_first", number.cast("bigint").alias("_k")
    ).where("_k >= 2")
    parents = firsts.select(F.col("_base").alias("_parent"))
    edges = numbered.join(parents, "_parent")
    fixed = None
    if taken is not None:
        fixed, edges = _taken_names(firsts, edges, taken, suffix)
    blocks = _settle(rows, edges, fixed)
    if blocks is None:
        number = F.col("_rank")
    else:
        items, number = _shift(items, blocks), F.col("_rank") + F.col("_shift")
    name = F.when(number == 1, F.col("_base")).otherwise(F.concat("_base", F.lit("_"), number.cast("string")))
    names = items.select(F.col("_pos").alias(pos), F.concat(name, F.lit(suffix)).alias(out))
    return df.join(names, pos, "left")


def _taken_names(firsts: DataFrame, edges: DataFrame, taken: DataFrame, suffix: str):
    """Numbers that existing files block for each base, and the edges they leave open."""
    stem = taken.where(F.endswith("name", F.lit(suffix))).select(
        F.expr(f"substring(name, 1, length(name) - {len(suffix)})").alias("_stem")
    ).distinct()
    bases = firsts.select("_base")
    number = F.regexp_extract("_stem", NUMBERED, 2)
    plain = stem.select(F.col("_stem").alias("_base"), F.lit(1).cast("bigint").alias("_k"))
    counted = stem.where(number != "").select(
        F.regexp_extract("_stem", NUMBERED, 1).alias("_base"), number.cast("bigint").alias("_k")
    ).where("_k >= 2")
    fixed = plain.unionByName(counted).join(bases, "_base", "left_semi")
    open_edges = edges.join(stem, edges["_base"] == stem["_stem"], "left_anti")
    return materialise(fixed, "names-taken"), open_edges


def suffix_depth(base: Column) -> Column:
    """How many numbers a base ends in: none for ``x``, two for ``x_2_3``."""
    return F.length(F.regexp_replace(F.regexp_extract(base, SUFFIXES, 1), "[0-9]", ""))


def _settle(rows: DataFrame, edges: DataFrame, fixed: DataFrame | None) -> DataFrame | None:
    """Which numbers of which base are blocked: ``(_base, _k, _skipped)``, or None for no block at all.

    An edge says that the plain name of base B is number k of base A; whoever comes first gets it. Row r of A takes number k
    when r is k less the smaller blocked numbers of A, and it is there before B when at least r rows of A are. So an edge is
    settled by its k, by how many rows of A lie before B's first, and by the smaller numbers of A, among them number 1, which
    A has lost where the number that is its own name went to its parent. A parent ends in one number less, so bases are settled by that depth.
    """
    edges = materialise(edges, "name-edges")
    if edges.isEmpty() and (fixed is None or fixed.isEmpty()):
        return None
    marks = edges.select(F.col("_parent").alias("_base"), F.col("_first").alias("_pos"), F.col("_base").alias("_child"), "_k")
    within = rows.join(marks.select("_base").distinct(), "_base", "left_semi").unionByName(marks, allowMissingColumns=True)
    counted = running_count(within, ["_base"], high_bits(F.col("_pos")), [F.col("_pos")], F.col("_k").isNull(), "_earlier")
    claims = counted.where("_k is not null").select("_base", "_k", "_child", "_earlier")
    if fixed is not None:
        claims = claims.unionByName(fixed.select("_base", "_k"), allowMissingColumns=True)
    claims = materialise(claims.withColumn("_depth", suffix_depth(F.col("_base"))), "name-claims")
    depths = {r["_depth"] for r in claims.select("_depth").distinct().collect()}
    blocks, lost = None, None
    for depth in sorted(depths | {d + 1 for d in depths}):
        here = claims.where(F.col("_depth") == depth).drop("_depth")
        if lost is not None:
            here = here.unionByName(lost, allowMissingColumns=True)
        settled = materialise(_fold(here), "names-settled")
        lost = settled.where("_child is not null and not _on").select(F.col("_child").alias("_base"), F.lit(1).cast("bigint").alias("_k"))
        on = settled.where("_on").select("_base", "_k", "_skipped")
        blocks = on if blocks is None else blocks.unionByName(on)
    return blocks


def _fold(claims: DataFrame) -> DataFrame:
    """``(_base, _k, _child, _on, _skipped)``: the claims of each base settled by rising number, each with the blocked numbers below it.

    The one rule here that goes step by step: whether a number is blocked depends on how many smaller ones are. Sorted claims stream
    through their task, which holds a base and a count; a base with very many claims is a long stream, never a group in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blocked = None, 0
        for batch in batches:
            on, skipped = [], []
            for base, k, earlier in zip(*(batch.column(c).to_pylist() for c in ("_base", "_k", "_earlier"))):
                if base != current:
                    current, blocked = base, 0
                on.append(earlier is None or earlier < k - blocked)
                skipped.append(blocked)
                blocked += on[-1]
            columns = [batch.column(c) for c in ("_base", "_k", "_child")] + [pa.array(on, pa.bool_()), pa.array(skipped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["_base", "_k", "_child", "_on", "_skipped"])

    rows = claims.select("_base", "_k", "_child", "_earlier").repartition("_base").sortWithinPartitions("_base", "_k")
    return rows.mapInArrow(run, "_base string, _k bigint, _child string, _on boolean, _skipped bigint")


def _shift(items: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows with the number of blocked names that lie before theirs."""
    steps = blocks.select("_base", (F.col("_k") - F.col("_skipped")).alias("_at"), F.lit(1).alias("_step"))
    rows = items.withColumn("_at", F.col("_rank")).withColumn("_step", F.lit(0))
    whole = rows.unionByName(steps, allowMissingColumns=True)
    counted = running_count(
        whole, ["_base"], high_bits(F.col("_at")), [F.col("_at"), F.col("_step").desc()], F.col("_step"), "_shift"
    )
    return counted.where("_step = 0").drop("_at", "_step")
