"""Collocations against counting all runs of words of a small corpus."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdesk.llm import collocations
from sparkdesk.session import bucketed, materialise

LOWER = {i: i + 32 for i in range(65, 91)}


def texts():
    rng = random.Random(7)
    names = ["ab", "Cd", "ÄÖ", "e-f", "g", "h i", "ß", "é🎉"]
    out = [("en" if i % 3 else None, " ".join(rng.choices(names, k=rng.randrange(40))) + rng.choice([".", "!x", "\n", "\t ", ""])) for i in range(120)]
    out += [("en", None), (None, ""), ("de", " \t\r\n"), ("und", "ab cd ab cd. ab cd")]
    out += [("fr", "le même passage, le même passage")] * 40 + [("fr", "x " * 3000), ("it", "uno")]
    out += [("es", "uno dos\x0btres\x0cuno dos; UNO DOS? uno  dos: a.b.a")] * 9
    return out


def expected(rows, least, longest=5):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, longest + 1):
                f.update((lang, tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    inside = {
        (lang, ws[i : i + k]) for (lang, ws), a in found.items() for k in range(2, len(ws)) for i in range(len(ws) - k + 1) if a >= f[lang, ws[i : i + k]]
    }
    out = {}
    for (lang, ws), a in found.items():
        if (lang, ws) in inside:
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, ws[:j]] * f[lang, ws[j:]]), j) for j in range(1, len(ws))]
        score, j = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(ws).encode(), f[lang, ws[:j]], f[lang, ws[j:]], total[lang]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n, -score) for lang, rows in out.items() for rank, (score, a, p, left, right, n) in enumerate(sorted(rows), 1)
    )


@pytest.mark.parametrize("block", [300, 16_000_000])
@pytest.mark.parametrize("least", [2, 9])
def test_all_candidates(spark, monkeypatch, block, least):
    monkeypatch.setattr(collocations, "BLOCK", block)
    frame = spark.createDataFrame(texts(), "lang string, text string")
    for name in ("block", "codes", "found", "id", "a", "word", "left", "n"):
        frame = frame.withColumn(name, F.lit("x"))
    got = collocations.collocations(frame, least=least, top=None).collect()
    assert sorted(map(tuple, got)) == expected(texts(), least)


def test_top_and_shorter_phrases(spark):
    frame = spark.createDataFrame(texts(), "lang string, text string")
    got = collocations.collocations(frame, least=3, longest=3, top=2).collect()
    assert sorted(map(tuple, got)) == [r for r in expected(texts(), 3, 3) if r[1] <= 2]


@pytest.mark.parametrize("part", [3, 50])
def test_many_parts(spark, monkeypatch, part):
    monkeypatch.setattr(collocations, "BLOCK", 300)
    monkeypatch.setattr(collocations, "PART", part)
    frame = spark.createDataFrame(texts(), "lang string, text string")
    got = collocations.collocations(frame, least=2, top=None).collect()
    assert sorted(map(tuple, got)) == expected(texts(), 2)


def test_counts_move_in_packed_rows(spark):
    """Words and pairs go to their counts in few rows of some bytes an entry, not as a row each."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    frame = spark.createDataFrame([("en", " ".join(rng.choices(words, k=400))) for _ in range(100)], "lang string, text string").coalesce(2)
    relation = collocations.occurrences(frame)
    for keys in (["word"], ["left", "right"]):
        lists = collocations.dealt(relation, keys, 3).toPandas()
        entries = relation.selectExpr("sum(size(found))").first()[0]
        assert len(lists) <= 3 * relation.count() < entries / 20 and lists["size"].sum() == entries
        assert sum(len(x) for c in ("codes", "keys", "counts") for x in lists[c]) < 8 * entries
        assert lists.groupby("part").ngroups == 3
        phrases, kept = collocations.frequent(relation, keys, 2)
        assert phrases.count() == phrases.select("id").distinct().count() > 0 and kept.where("size is null").isEmpty()
        relation = collocations.extended(relation, kept)


def zipf(lang="en", docs=100, words=300, seed=3):
    """Texts with a few frequent words and many rare ones."""
    rng = random.Random(seed)
    names, weights = [f"w{i}" for i in range(words)], [1 / (i + 1) for i in range(words)]
    return [(lang, " ".join(rng.choices(names, weights, k=400))) for _ in range(docs)]


@pytest.mark.parametrize("bound", [1, 2, 7, 30])
def test_scrambled_pairs_are_one_to_one(bound):
    left, right = (a.ravel() for a in np.meshgrid(np.arange(bound), np.arange(bound)))
    values = collocations.scrambled(left, right, bound)
    assert sorted(values) == list(range(bound * bound))
    assert [x.tolist() for x in collocations.unscrambled(values, bound)] == [left.tolist(), right.tolist()]


def test_scrambled_pairs_fit_64_bits():
    ids = np.array([0, 1, 12345, collocations.BOUND - 2, collocations.BOUND - 1])
    left, right = (a.ravel() for a in np.meshgrid(ids, ids))
    values = collocations.scrambled(left, right, collocations.BOUND)
    assert values.min() >= 0 and values.max() < collocations.BOUND**2 and len(set(values.tolist())) == 25
    assert [x.tolist() for x in collocations.unscrambled(values, collocations.BOUND)] == [left.tolist(), right.tolist()]


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for values in (np.arange(-1, 300), rng.integers(-1, 70_000, 1000), np.array([-1]), np.array([2**31 - 2])):
        assert collocations._codes(collocations._packed(values), len(values)).tolist() == values.tolist()
    for values in (np.array([5]), np.sort(rng.integers(0, 2**62, 1000)), rng.integers(0, 9, 1000)):
        assert collocations._unsqueezed(collocations._squeezed(values), len(values)).tolist() == values.tolist()
        assert collocations._unplanes(collocations._planes(values), len(values)).tolist() == values.tolist()


def test_codes_and_lists_take_little_room(spark):
    """A place is about the entropy of its word, a pair's entry two bytes, however many parts there are."""
    frame = spark.createDataFrame(zipf(words=3000), "lang string, text string").coalesce(1)
    relation = collocations.occurrences(frame)
    words = Counter(w for _, text in zipf(words=3000) for w in text.split())
    total = sum(words.values())
    entropy = -sum(n * np.log2(n / total) for n in words.values()) / 8
    assert relation.selectExpr("sum(octet_length(codes))").first()[0] < 1.25 * entropy
    phrases, kept = collocations.frequent(relation, ["word"], 2)
    bound = phrases.agg(F.max("id")).first()[0] + 1
    assert bound == phrases.count()
    pairs = collocations.extended(relation, kept, bounds=(bound,))
    for parts in (1, 8):
        lists = collocations.dealt(pairs, ["left", "right"], parts, bound).toPandas()
        assert lists["part"].nunique() == parts
        assert sum(len(x) for c in ("codes", "keys", "counts") for x in lists[c]) < 2.5 * lists["size"].sum()


def test_blocks_stay_where_they_are(spark, capsys, monkeypatch):
    """Only the lists of frequent phrases are shuffled to the blocks, and pairs joined anew give what stored ones give."""
    monkeypatch.setattr(collocations, "BLOCK", 20_000)
    frame = spark.createDataFrame(zipf("en") + zipf("de", seed=4), "lang string, text string")
    relation, rows = bucketed(collocations.occurrences(frame), "words", "block", 5)
    _, words = collocations.frequent(rows, ["word"], 2)
    longer = collocations.extended(relation, words)
    longer.explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(block") == 1
    pairs = materialise(longer, "pairs")
    _, kept = collocations.frequent(pairs, ["left", "right"], 2)
    told = [
        sorted(rows.selectExpr("block", "lang", "size", "codes", "cast(found as string)").collect())
        for rows in (collocations.extended(pairs, kept), collocations.extended(relation, words, kept, bounds=(collocations.BOUND,) * 2))
    ]
    assert told[0] == told[1] and len(told[0]) > 4


def test_pairs_are_dealt_where_they_are_joined(spark):
    """Joining and dealing in one pass over a block gives what joining, then dealing does, and one step or two."""
    relation = materialise(collocations.occurrences(spark.createDataFrame(zipf("en") + zipf("de", seed=4), "lang string, text string").coalesce(2)), "words")
    words, kept = collocations.frequent(relation, ["word"], 2)
    bounds, lists = (words.agg(F.max("id")).first()[0] + 1,), (kept,)
    for _ in range(2):
        longer = collocations.extended(relation, *lists, bounds=bounds)
        for parts in (1, 3):
            got = collocations.dealt_longer(relation, *lists, parts=parts, bounds=bounds).collect()
            assert sorted(got) == sorted(collocations.dealt(longer, ["left", "right"], parts, bounds[-1]).collect())
            assert len({r.part for r in got}) == parts
        grams, kept = collocations.frequent(longer, ["left", "right"], 2, bounds[-1])
        bounds, lists = (*bounds, grams.agg(F.max("id")).first()[0] + 1), (*lists, kept)
    none = kept.where("false")
    assert collocations.dealt_longer(relation, none, parts=2).collect() == []


def test_a_task_has_one_python_worker(spark, capsys, monkeypatch):
    """No stage has two steps in Python: what goes from one to the other fills the memory of both, and workers stay with their executor."""
    plans = []
    for name in ("materialise", "bucketed"):

        def written(frame, *more, write=getattr(collocations, name)):
            capsys.readouterr()
            frame.explain()
            plans.append(capsys.readouterr().out)
            return write(frame, *more)

        monkeypatch.setattr(collocations, name, written)
    assert collocations.candidates(spark.createDataFrame(zipf(), "lang string, text string"), least=3).count()
    assert sum("InArrow" in plan for plan in plans) >= 8
    for plan in plans:
        above = False
        for line in plan.splitlines():
            assert not (above and "InArrow" in line), plan
            above = "InArrow" in line or above and not ("Exchange" in line or "Scan" in line)


def test_bucketed(spark):
    frame = spark.range(100).selectExpr("id % 7 as k", "id as v")
    for rows in bucketed(frame, "some", "k", 3):
        assert rows.dtypes == frame.dtypes and sorted(rows.collect()) == sorted(frame.collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("some")]


def test_no_rows(spark):
    frame = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(frame).collect() == []
    assert collocations.collocations(spark.createDataFrame([("en", "a b")], "lang string, text string")).collect() == []


def test_products_above_64_bits(spark):
    row = spark.sql("select 'x' as phrase, 2 as k, 9000000000000L as a, 90000000000000L as n, array(9000000000001L, 9000000000000L) as pre, array(9000000000007L) as suf")
    assert tuple(row.select(collocations.lowest_cut().alias("c")).first().c) == (1000 * 9 * 10**12 * 9 * 10**13 // ((9 * 10**12 + 1) * (9 * 10**12 + 7)), 1, 9 * 10**12 + 1, 9 * 10**12 + 7)
