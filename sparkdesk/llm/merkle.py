"""A Merkle manifest of documents, and octopus multiproofs of all its leaves.

Every language is a tree of fan-out FAN over its documents by id, and the roots of these trees are the leaves of one more
tree. Leaves are numbered by a range sort and the row counts of its parts. BLOCK leaves that follow each other make
a leaf partition, which derives DEPTH levels at once; what is above them goes the same way until one node is left.

For the proofs a leaf partition knows the coordinates (tree, level, place) of the nodes that its leaves lack together: next to
the run of nodes it can derive itself, at most FAN - 1 on either side of each level. That minimal union is joined once with the nodes;
inside the partition the interiors that proofs share are derived once, and each leaf's proof is put together from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkdesk.llm.common import ship
from sparkdesk.session import materialise

FAN, DEPTH = 8, 4
BLOCK = FAN**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the languages' roots; a language's own name is ``=`` and the language, or empty where it is null.
TOP = "top"


def sha(*parts: str) -> bytes:
    return hashlib.sha256("".join(parts).encode()).digest()


def leaf_hash(text: Column | None = None) -> Column:
    """32 bytes: SHA-256 of the fields, each as its UTF-8 length, a colon and its value, a null as ``-``.

    ``text`` stands in for the column of that name.
    """

    def told(name: str) -> Column:
        value = text if name == "text" and text is not None else F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[told(f) for f in FIELDS]), 256))


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


@dataclass
class Forest:
    """``leaves``: tree, at, n (leaves of the tree), hash and what else the rows held; ``nodes``: tree, level, at, n, hash of the interiors."""

    leaves: DataFrame
    nodes: DataFrame

    def roots(self) -> DataFrame:
        """``tree, hash``: the node of each tree that has no sibling, a lone leaf itself."""
        nodes = self.nodes.where("n = 1").select("tree", "hash")
        return nodes.unionByName(self.leaves.where("n = 1").select("tree", "hash"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, hash and others) with ``at``, gapless from 0 in each tree by ``order`` then hash, and ``n``, the tree's rows.

    No tree meets in one task: rows are sorted by ranges, and only the counts by (part, tree) are added up. The place
    in the written table parts rows that are equal, so that these are spread, too.
    """
    keys = ["tree", *order, "hash", "_row"]
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
    rows = materialise(rows.withColumn("_id", F.monotonically_increasing_id()), "merkle-sorted")
    rows = rows.withColumn("_part", F.shiftright("_id", 33))
    runs = rows.groupBy("_part", "tree").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    tree = W.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select("_part", "tree", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(tree).alias("n"))
    return rows.join(runs, ["_part", "tree"]).withColumn("at", F.col("_id") + F.col("_shift")).drop("_part", "_id", "_shift")


def climbed(rows: DataFrame) -> DataFrame:
    """``tree, level, at, n, hash`` of up to DEPTH levels above ``rows`` (the same columns), block by block."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        tree, level, first, n = (block.column(c)[0].as_py() for c in ("tree", "level", "at", "n"))
        hashes, out = [h.hex() for h in block.column("hash").to_pylist()], []
        for up in range(1, DEPTH + 1):
            if n == 1:
                break
            first, n = first // FAN, -(-n // FAN)
            hashes = [sha(*hashes[i : i + FAN]).hex() for i in range(0, len(hashes), FAN)]
            out += [(tree, level + up, first + i, n, bytes.fromhex(h)) for i, h in enumerate(hashes)]
        return pa.table([pa.array([o[k] for o in out], f.type) for k, f in enumerate(kind)], schema=kind)

    kind = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("hash", pa.binary())])
    return rows.groupBy("tree", F.expr(f"at div {BLOCK}")).applyInArrow(run, "tree string, level int, at bigint, n bigint, hash binary")


def forest(rows: DataFrame, order: list[str]) -> Forest:
    """One tree for each value of ``tree`` over ``rows`` (tree, hash and others), its leaves in the order of ``order`` then hash.

    Repeated rows are leaves of their own; no rows are no trees.
    """
    ship(rows.sparkSession)
    leaves = materialise(numbered(rows, order), "merkle-leaves")
    level = leaves.select("tree", F.lit(0).alias("level"), "at", "n", "hash")
    nodes = level.where("false")
    most = leaves.agg(F.max("n")).first()[0] or 0
    for base in range(0, height(most), DEPTH):
        above = materialise(climbed(level.where("n > 1")), "merkle-nodes")
        nodes = nodes.unionByName(above)
        level = above.where(F.col("level") == base + DEPTH)
    return Forest(leaves, nodes)


def missing(runs: DataFrame) -> DataFrame:
    """``runs`` (tree, a, b, n and others) with ``level, at`` of each node that proofs of the leaves a to b - 1 need and that these do not give.

    At every level the run reaches from a to b shifted by the level; its first and last family lack what lies outside.
    """
    width, none = f"cast(power({FAN}, level) as bigint)", "cast(array() as array<bigint>)"
    rows = runs.where("n > 1").withColumn("level", F.explode(F.expr(f"filter(sequence(0, 20), l -> power({FAN}, l) < n)")))
    rows = rows.withColumns({"_a": F.expr(f"a div {width}"), "_b": F.expr(f"(b - 1) div {width} + 1"), "_n": F.expr(f"(n - 1) div {width} + 1")})
    rows = rows.withColumn("_end", F.expr(f"least(_n, ((_b - 1) div {FAN} + 1) * {FAN})"))
    left = F.expr(f"if(_a % {FAN} > 0, sequence(_a - _a % {FAN}, _a - 1), {none})")
    right = F.expr(f"if(_b < _end, sequence(_b, _end - 1), {none})")
    return rows.withColumn("at", F.explode(F.concat(left, right))).drop("_a", "_b", "_n", "_end", "a", "b", "n")


def fetched(trees: Forest, top: Forest) -> DataFrame:
    """``tree, block, up, level, at, hash``: what each leaf partition lacks, joined once with the nodes; ``up`` is true above a tree's root.

    A last row of level -1 holds, as ``at`` and ``size``, the place of the tree's root among all and their number.
    """
    block = F.expr(f"at div {BLOCK}").alias("block")
    runs = trees.leaves.groupBy("tree", block).agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"), F.first("n").alias("n"))
    runs = materialise(runs, "merkle-runs")
    every = lambda t: t.nodes.select("tree", "level", "at", "hash").unionByName(t.leaves.select("tree", F.lit(0).alias("level"), "at", "hash"))
    own = missing(runs).join(every(trees), ["tree", "level", "at"]).withColumn("up", F.lit(False))
    places = top.leaves.select(F.col("name").alias("tree"), F.col("at").alias("a"), (F.col("at") + 1).alias("b"), "n")
    above = missing(places).join(every(top).drop("tree"), ["level", "at"]).withColumn("up", F.lit(True))
    above = above.unionByName(places.select("tree", F.lit(-1).alias("level"), F.col("a").alias("at"), F.lit(None).cast("binary").alias("hash"), F.lit(True).alias("up")))
    above = above.join(runs.select("tree", "block"), "tree")
    return own.select(*above.columns).unionByName(above).join(places.select("tree", F.col("n").alias("size")), "tree")


def expand(leaves: pa.Table, nodes: pa.Table) -> Iterator[tuple[bytes, bytes, bytes, bytes]]:
    """Subroot, root, digest of the proof, and the root folded from ``seen``, for the leaves of one partition in the order of ``at``."""
    known: dict[tuple[bool, int, int], str] = {}
    for r in nodes.to_pylist():
        if r["level"] < 0:
            place, size = r["at"], r["size"]
        else:
            known[r["up"], r["level"], r["at"]] = r["hash"].hex()
    first, n = leaves.column("at")[0].as_py(), leaves.column("n")[0].as_py()
    hashes = [h.hex() for h in leaves.column("hash").to_pylist()]
    for i, h in enumerate(hashes):
        known[False, 0, first + i] = h

    def family(up: bool, level: int, at: int, total: int) -> list[str]:
        return [known[up, level, k] for k in range(at - at % FAN, min(total, at - at % FAN + FAN))]

    # The shared interiors, each once: of the run's own tree, then of the tree over the languages.
    steps: list[tuple[bool, int, int]] = []
    for up, (a, b, total) in ((False, (first, first + len(hashes), n)), (True, (place, place + 1, size))):
        level = 0
        if up:
            known[True, 0, place] = known[steps[-1][0], steps[-1][1] + 1, 0] if steps else hashes[0]
        while total > 1:
            for at in range(a // FAN, (b - 1) // FAN + 1):
                known[up, level + 1, at] = sha(*family(up, level, at * FAN, total)).hex()
            steps.append((up, level, total))
            a, b, total, level = a // FAN, (b - 1) // FAN + 1, -(-total // FAN), level + 1
    root = known[True, height(size), 0]
    subroot = known[True, 0, place]

    def ladder(at: int) -> Iterator[tuple[list[str], int]]:
        for up, level, total in steps:
            if up and level == 0:
                at = place
            yield family(up, level, at, total), at % FAN
            at //= FAN

    # What lies above a family of leaves is the same for all of them.
    rungs, tail = [], ""
    for i, seen in enumerate(leaves.column("seen").to_pylist()):
        if i == 0 or (first + i) % FAN == 0:
            rungs = list(ladder(first + i))
            tail = "".join(h for run, j in rungs[1:] for k, h in enumerate(run) if k != j)
        folded, proof = seen.hex(), ""
        for step, (run, j) in enumerate(rungs):
            if step == 0:
                j = place % FAN if steps[0][0] else (first + i) % FAN
                proof = "".join(run[:j] + run[j + 1 :]) + tail
            folded = sha(*run[:j], folded, *run[j + 1 :]).hex()
        yield bytes.fromhex(subroot), bytes.fromhex(root), sha(proof), bytes.fromhex(folded)


def prove(trees: Forest, top: Forest) -> DataFrame:
    """``trees.leaves`` (with ``seen``, the leaf to be checked) with ``subroot, root, proof, folded``, digests of 32 bytes.

    ``proof`` is the digest of a leaf's siblings from its family up to the root, left to right; ``folded`` is the root that
    ``seen`` and the stored siblings give.
    """

    def run(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        out = list(expand(leaves, nodes)) if len(leaves) else []
        for k, name in enumerate(("subroot", "root", "proof", "folded")):
            leaves = leaves.append_column(name, pa.array([o[k] for o in out], pa.binary()))
        return leaves.select(names)

    ship(trees.leaves.sparkSession)
    leaves = trees.leaves.withColumn("block", F.expr(f"at div {BLOCK}"))
    names = [*leaves.columns, "subroot", "root", "proof", "folded"]
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema) + ", subroot binary, root binary, proof binary, folded binary"
    lacking = materialise(fetched(trees, top), "merkle-fetched")
    pairs = leaves.groupBy("tree", "block").cogroup(lacking.groupBy("tree", "block"))
    return pairs.applyInArrow(run, kind).drop("block")


def manifest(docs: DataFrame, presented: Column | None = None) -> tuple[Forest, Forest]:
    """The trees of all languages over ``docs`` (doc_id, source, lang, n_chars, text), and the tree over their roots.

    The leaves hold ``doc_id`` and ``seen``, the leaf hash of the text that is ``presented`` for checking, by default the text itself.
    Every row is a leaf: nulls in any column, empty texts, and repeated rows, which stand next to each other. Rows without an
    id come first, rows without a language are a tree of their own before all others. Other columns are not read. No rows
    give empty tables and no root.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    seen = leaf_hash(presented) if presented is not None else leaf_hash()
    trees = forest(docs.select(name.alias("tree"), "doc_id", leaf_hash().alias("hash"), seen.alias("seen")), ["doc_id"])
    top = forest(trees.roots().select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "hash"), ["name"])
    return trees, top


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
