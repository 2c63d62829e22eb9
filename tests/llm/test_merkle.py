"""The Merkle manifest against a plain recursive tree."""

import hashlib

import pytest
from pyspark.sql import functions as F

from sparkdesk.llm import merkle

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, level int, block int, tree string, at int, seen string, hash string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*[told(v) for v in (doc_id, source, lang, n_chars, text)])


def plain(leaves):
    """Root of hex leaves, and the siblings of each leaf by level with its place among them."""
    paths = [[] for _ in leaves]
    at = list(range(len(leaves)))
    while len(leaves) > 1:
        runs = [leaves[i : i + 8] for i in range(0, len(leaves), 8)]
        for p, k in zip(paths, at):
            p.append((runs[k // 8], k % 8))
        at = [k // 8 for k in at]
        leaves = [sha(*r) for r in runs]
    return leaves[0], paths


def expected(rows, tamper):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r, leaf(*r)))
    for group in langs.values():
        group.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: plain([h for _, h in langs[name]]) for name in names}
    root, above = plain([trees[name][0] for name in names])
    out = []
    for k, name in enumerate(names):
        sub, paths = trees[name]
        for (r, h), path in zip(langs[name], paths):
            seen = leaf(r[0], tamper(r), *r[2:])
            proof = ""
            for run, j in path + above[k]:
                proof += "".join(run[:j] + run[j + 1 :])
                seen = sha(*run[:j], seen, *run[j + 1 :])
            out.append((str(r[0]), h, sub, root, sha(proof), seen))
    return sorted(out)


def found(spark, rows, presented=None):
    frame = spark.createDataFrame([(*r, 7, 8, "x", 9, "y", "z") for r in rows], COLUMNS)
    proved = merkle.prove(*merkle.manifest(frame, presented))
    return sorted((str(r.doc_id), r.hash.hex(), r.subroot.hex(), r.root.hex(), r.proof.hex(), r.folded.hex()) for r in proved.collect())


def test_small_table(spark):
    rows = [(i, f"Text {i}" if i % 5 else None, lang, "web" if i % 3 else None, i) for i in range(75) for lang in ("en", None, "")]
    rows += [(3, "Text 3", "en", "web", 3), (None, "no id", "en", None, None), (None, None, None, None, None), (1, "", "ß", "é🎉", 0), (2, "A" * 300_000, "de", "", -1)]
    presented = F.when(F.col("doc_id") % 2 == 0, merkle.lower_ascii(F.col("text"))).otherwise(F.col("text"))
    low = lambda r: r[1].lower() if r[1] is not None and r[0] is not None and r[0] % 2 == 0 else r[1]
    got = found(spark, rows, presented)
    assert got == expected(rows, low)
    changed = {r[0] for r in rows if low(r) != r[1]}
    assert changed and all((g[3] == g[5]) == (g[0] == "None" or int(g[0]) not in changed or g[1] != leaf(*[r for r in rows if leaf(*r) == g[1]][0])
                           or low([r for r in rows if leaf(*r) == g[1]][0]) == [r for r in rows if leaf(*r) == g[1]][0][1]) for g in got)


@pytest.mark.parametrize("n", [1, 8, 9, 4097, 8200])
def test_several_blocks(spark, n):
    rows = [(i, f"t{i}", "en", None, None) for i in range(n)]
    assert found(spark, rows) == expected(rows, lambda r: r[1])


def test_no_rows(spark):
    assert found(spark, []) == []


def test_one_proof_needs_few_foreign_nodes(spark):
    """A leaf partition fetches at most FAN - 1 nodes on either side of each level."""
    rows = spark.range(20_000).select(F.lit("=en").alias("tree"), "id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("hash"))
    trees = merkle.forest(rows, ["id"])
    top = merkle.forest(trees.roots().select(F.lit("top").alias("tree"), F.col("tree").alias("name"), "hash"), ["name"])
    per_block = merkle.fetched(trees, top).where("level >= 0").groupBy("block").count().collect()
    assert per_block and all(r["count"] <= 14 * merkle.height(20_000) for r in per_block)
