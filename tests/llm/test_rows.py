"""Repeated ids with different texts, columns named as the helpers are, urls with odd line ends, a ledger with a pair twice."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkdesk.llm import exact_dedup, jaccard_join, line_crf, secret_scan, warc

LONG = [f"w{i}" for i in range(200)]
A, NEAR_A = " ".join(LONG), " ".join(LONG[:-3] + ["end"])
B = " ".join(f"b{i}" for i in range(80))
NEAR_B = B + " tail"
C = " ".join(f"c{i}" for i in range(70))
HELPERS = ["_text", "_TEXT_", "_blob", "_found", "_cuts", "_sha", "_id", "_key", "_n", "_gone", "_gone_text", "text_id", "key", "bands", "rep", "id", "first", "features", "score", "n"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def classes_of(rows):
    """(class, links) of each row; rows without an id take no part."""
    sets, group = [shingles(t) if i is not None else frozenset() for i, t in rows], list(range(len(rows)))
    links = defaultdict(set)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a].add(b), links[b].add(a)
                group = [group[a] if g == group[b] else g for g in group]
    least = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in set(group)}
    return group, [(rows[k][0], least[group[k]] if rows[k][0] is not None else None, len(links[k])) for k in range(len(rows))]


NAMESAKES = [
    [(5, B), (5, NEAR_A), (6, NEAR_B), (7, A)],
    [(1, A), (2, NEAR_A), (2, C)],
    [(4, A), (4, NEAR_A), (4, B), (4, B), (9, NEAR_B), (None, A), (10, None), (10, ""), (3, C), (11, "a b"), (11, "a b")],
]


@pytest.mark.parametrize("rows", NAMESAKES)
def test_links_of_rows_that_share_an_id(spark, rows):
    docs = frame(spark, rows).repartition(3)
    group, want = classes_of(rows)
    got = [(r.doc_id, r.class_id, r.n_links) for r in jaccard_join.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    left = [(r.doc_id, r.text) for r in jaccard_join.drop_near(docs).collect()]
    kept = {g: set() for g in group}
    for k, g in enumerate(group):
        if rows[k] in left:
            kept[g].add(rows[k])
    for k, g in enumerate(group):
        assert len(kept[g]) == 1 and next(iter(kept[g]))[0] == want[k][1]
    assert set(left) <= set(rows)


def test_recall_of_the_join_on_documents(spark):
    """Every row whose id is divisible by 20 against all rows: no link that brute force finds is missing."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = {i: shingles(t) for i, t in rows}
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(docs).collect()}
    for a in (i for i in sets if i % 20 == 0 and sets[i]):
        linked = [b for b in sets if b != a and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
        assert got[a].n_links == len(linked)
        assert all(got[b].class_id == got[a].class_id for b in linked)


def test_columns_may_have_the_names_of_helpers(spark):
    rows = [(1, "password = abcdefghijkl1 here"), (1, "password = abcdefghijkl1 here"), (2, A), (3, NEAR_A), (4, None)]
    docs = frame(spark, rows)
    for k, name in enumerate(HELPERS):
        docs = docs.withColumn(name, F.lit(k))
    same = [tuple(range(len(HELPERS)))]
    for run, count in (
        (secret_scan.redact, 5), (exact_dedup.drop_copies, 4), (jaccard_join.drop_near, 4),
        (lambda d: line_crf.drop_bad(d, frame(spark, []).select("doc_id", F.lit(1).alias("quality"))), 5),
    ):
        out = run(docs)
        assert out.schema == docs.schema
        assert out.count() == count
        assert [tuple(r) for r in out.select(*HELPERS).distinct().collect()] == same


@pytest.mark.parametrize("end", ["\u0085", "\u2028", "\u2029", "\r", "\n", "\r\n"])
def test_headers_survive_any_url(spark, end):
    urls = [f"http://a{end}Content-Length: 3", f"http://a{end}WARC-Refers-To: <urn:page:7>", f"u{end}WARC-Type: revisit{end}"]
    pages = spark.createDataFrame([(i, u, f"<p>{i}</p>") for i, u in enumerate(urls)], "page_id bigint, url string, html string")
    rows = {r.page_id: r for r in warc.archive_pages(pages).collect()}
    assert sorted(rows) == [0, 1, 2]
    assert all((r.record_type, r.refers_to, r.payload_bytes) == ("response", None, 8) for r in rows.values())


def test_a_pair_that_the_ledger_has_twice_counts_once(spark, tmp_path):
    docs = frame(spark, [(1, "token = abcdefghijklm and token = nopqrstuvwxyz done"), (2, "none")])
    ledger = str(tmp_path / "ledger")
    want = {(r.doc_id, str(r.spans)) for r in secret_scan.secrets(docs, ledger).collect()}
    spark.read.parquet(ledger).write.mode("append").parquet(ledger + "-twice")
    spark.read.parquet(ledger).write.mode("append").parquet(ledger + "-twice")
    assert {(r.doc_id, str(r.spans)) for r in secret_scan.secrets(docs, ledger + "-twice").collect()} == want
    assert {r.doc_id: r.text for r in secret_scan.redact(docs, ledger=ledger + "-twice").collect()}[1] == "[SECRET] and [SECRET] done"


def test_the_sample_bounds_what_is_collected(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(line_crf, "fit", lambda documents: seen.extend(documents))
    docs = frame(spark, [(1, f"text {k}") for k in range(500)] + [(3, "other"), (3, None)])
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, None)], "doc_id bigint, quality int")
    line_crf.train(docs, labels, sample=2)
    usable = [i for i in (1, 3) if not frame(spark, [(i, "")]).select(line_crf.held_out(F.col("doc_id"))).first()[0]]
    assert len(seen) == len(usable) > 0


def test_marked_rows_spare_the_join_the_others(spark):
    """Every known key is marked and few others, by whatever columns; near-copy removal moves only texts that are marked."""
    from sparkdesk.llm.common import marked

    rows = spark.range(20000).selectExpr("if(id = 7, null, id) as id", "cast(id as string) as _bits", "'b' as _bucket")
    known = spark.range(0, 20000, 40).selectExpr("id as k")
    got = {r.id: r.m for r in marked(rows, F.col("id"), known, F.col("k"), "m").collect()}
    assert len(got) == 20000 and all(got[i] for i in range(0, 20000, 40)) and sum(got.values()) < 550
    assert not any(r.m for r in marked(rows, F.col("id"), known.where("false"), F.col("k"), "m").collect())
    assert marked(rows, F.col("id"), known, F.col("k"), "m").columns == ["id", "_bits", "_bucket", "m"]
    base = " ".join(f"w{i}" for i in range(60))
    texts = [(i, " ".join(f"x{i}y{j}" for j in range(30))) for i in range(400)] + [(400, base), (401, base + " w60"), (402, base + " w61")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = jaccard_join.drop_near(docs)
        plan = left._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r.doc_id for r in left.collect()) == list(range(401))
    assert "BroadcastHashJoin" in plan and plan.startswith("Union")
