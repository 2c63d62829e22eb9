"""Keyed building blocks against brute force, also with one key that owns a third of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from sparkdesk.operators import keyed as K
from sparkdesk.operators.captions import caption_context
from sparkdesk.operators.jobs import job_status


def one_by_one(titles, taken=()):
    used, names = set(taken), []
    for title in titles:
        name, k = f"{title}.md", 2
        while name in used:
            name, k = f"{title}_{k}.md", k + 1
        used.add(name)
        names.append(name)
    return names


@pytest.mark.parametrize("seed", range(6))
def test_unique_names(spark, monkeypatch, seed):
    monkeypatch.setattr(K, "BUCKET_BITS", 2)
    pick = random.Random(seed)
    pool = ["x", "x_2", "x_3", "x_2_2", "x_2_3", "x_4", "x_02", "x_1", "y", "y_2", "x_3_2", "é_2", "é"]
    titles = pick.choices(pool, k=60 if seed else 5) + ["x"] * 30
    pick.shuffle(titles)
    taken = ["x.md", "x_5.md", "y_2.md", "z.md", "x_2_2.md", "y.txt", "x_1.md"] if seed % 2 else []
    df = spark.createDataFrame([(i * 3 - 20, t) for i, t in enumerate(titles)], "pos bigint, base string")
    present = spark.createDataFrame([(t,) for t in taken], "name string") if taken else None
    got = {r["pos"]: r["name"] for r in K.unique_names(df, "base", "pos", taken=present).collect()}
    assert [got[i * 3 - 20] for i in range(len(titles))] == one_by_one(titles, taken)


@pytest.mark.parametrize("order", ["rising", "falling", "mixed"])
def test_rounds_are_bounded_by_depth(spark, monkeypatch, order):
    """Each of 60 numbered titles hangs on the one before it, yet two depths are settled in three rounds at most."""
    rounds, write = [], K.materialise
    monkeypatch.setattr(K, "materialise", lambda df, name: rounds.append(name) or write(df, name))
    titles = [f"x_{k}" for k in range(2, 62)] + ["x_2_2", "x_9_2", "x_9_3"]
    titles = {"rising": titles, "falling": titles[::-1], "mixed": random.Random(4).sample(titles, len(titles))}[order]
    titles = [t for pair in zip(["x"] * len(titles), titles) for t in pair] + ["x_9", "x_9"]
    df = spark.createDataFrame(list(enumerate(titles)), "pos bigint, base string")
    got = {r["pos"]: r["name"] for r in K.unique_names(df, "base", "pos").collect()}
    assert [got[i] for i in range(len(titles))] == one_by_one(titles)
    assert rounds.count("names-settled") <= 3


def test_suffix_depth(spark):
    want = {"x": 0, "x_2": 1, "x_2_3": 2, "_2": 0, "__2": 1, "x_02": 0, "x_02_2": 1, "x_2\n_3": 1, "a_b_7": 1}
    df = spark.createDataFrame([(b,) for b in want], "b string")
    assert {r["b"]: r["d"] for r in df.select("b", K.suffix_depth(F.col("b")).alias("d")).collect()} == want


def test_unique_names_without_a_base(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "pos bigint, base string")
    assert {r["pos"]: r["name"] for r in K.unique_names(df, "base", "pos").collect()} == {1: None, 2: "a.md"}


def test_running_count(spark, monkeypatch):
    monkeypatch.setattr(K, "BUCKET_BITS", 3)
    pick = random.Random(3)
    rows = [(i, "hot" if i % 3 else pick.choice("abc"), pick.randrange(2)) for i in range(500)]
    df = spark.createDataFrame(rows, "pos int, k string, f int")
    got = K.running_count(df, ["k"], K.high_bits(F.col("pos")), [F.col("pos")], F.col("f"), "n").collect()
    seen, want = {}, {}
    for pos, k, f in rows:
        seen[k] = seen.get(k, 0) + f
        want[pos] = seen[k]
    assert {r["pos"]: r["n"] for r in got} == want


def test_a_number_above_a_thousand_million_is_a_number(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a_3000000000")], "pos bigint, base string")
    taken = spark.createDataFrame([("a_2.md",), ("a_3000000000.md",)], "name string")
    got = {r["pos"]: r["name"] for r in K.unique_names(df, "base", "pos", taken=taken).collect()}
    assert got == {1: "a.md", 2: "a_3.md", 3: "a_3000000000_2.md"}


def test_rows_without_a_key_reach_several_tasks(spark):
    """Links without an id and records without an application, with the help of adaptive execution switched off."""
    links = spark.range(4000).select(F.lit("https://v.example.com/watch").alias("url"), F.lit(0).alias("src"), F.col("id").alias("pos"))
    views = spark.createDataFrame([("BV1", "{}")], "bvid string, payload string")
    texts = ["submission_id", "application_id", "job_name", "queue", "launcher_state", "yarn_state", "final_status", "tracking_url", "last_error"]
    records = spark.range(4000).select(
        *[(F.col("id").cast("string") if c == "submission_id" else F.lit(None).cast("string")).alias(c) for c in texts],
        F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"),
    )
    reports = spark.createDataFrame([("a1", "RUNNING", None, None, None)], "application_id string, yarn_state string, final_status string, tracking_url string, reported_at timestamp")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for joined in (caption_context(links, views), job_status(records, reports, "http://router")):
            assert joined.count() == 4000
            assert joined.select(F.spark_partition_id()).distinct().count() > 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = K.first_per_key(df, ["k"], [F.col("id")])
    assert sorted(map(tuple, first.collect())) == [(0, 0), (1, 1), (2, 2)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("Exchange") < plan.index("Partial")


def test_insert_if_absent(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3), (None, 4)], "k string, pos int")
    old = spark.createDataFrame([("b", 0), ("b", 1)], "k string, other int")
    got = K.insert_if_absent(new, old, ["k"], [F.col("pos")])
    assert {(r["k"], r["pos"]) for r in got.collect()} == {("a", 1), (None, 4)}


def test_ordered_union(spark):
    def urls(*texts):
        return spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "url string, pos int")

    a, b, c = urls(" x ", "y", ""), urls("z", "x", None), urls("w")
    got = K.ordered_union([a, b], [c]).orderBy("src", "pos")
    assert [r["url"] for r in got.collect()] == ["x", "y", "z"]
    assert [r["url"] for r in K.ordered_union([], [c, a]).orderBy("src", "pos").collect()] == ["w", "x", "y"]
