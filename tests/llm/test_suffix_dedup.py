"""Removal of repeated byte strings against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdesk.llm import suffix_dedup

L = suffix_dedup.LENGTH


def expected(rows):
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        if doc is not None:
            for i in range(len(raw) - L + 1):
                s = raw[i : i + L]
                first[s] = min(first.get(s, doc), doc)
    out = Counter()
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw) + 1)
        for i in range(len(raw) - L + 1):
            if doc is not None and first[raw[i : i + L]] < doc:
                gone[i : i + L] = b"\1" * L
        spans = sum(1 for i in range(len(raw)) if gone[i] and not (i and gone[i - 1]))
        out[doc, len(raw), sum(gone), spans, bytes(b for i, b in enumerate(raw) if not gone[i])] += 1
    return out


def found(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("doc", "sub", "pos", "name", "start", "n", "z", "found", "string"):
        frame = frame.withColumn(name, F.lit("x"))
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.drop_repeats(frame).collect())


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abé ", k=rng.randrange(1, 7)))
    passages = ["".join(word() for _ in range(40)) for _ in range(5)] + ["a" * 70, "\0" * 60, " " * 49, "ab" * 40]
    rows = [(None, None), (None, passages[0]), (1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51), (6, "y" + "x" * 50 + "y" * 200)]
    for i in range(120):
        parts = [rng.choice(passages)[rng.randrange(0, 40) :] if rng.random() < 0.5 else word() for _ in range(rng.randrange(8))]
        rows.append((i + 7, "".join(parts)))
    rows += [(20, passages[0]), (20, passages[0] + "tail" * 20), (20, rows[40][1]), (1000, passages[1] * 3), (1000, passages[1] * 3)]
    # Ids need not be in the order of the table.
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [2, 40, 200_000])
def test_against_brute_force(spark, monkeypatch, chunk):
    """With few contexts at a time every frequent name takes the way by single strings."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rows = corpus()
    assert found(spark, rows) == expected(rows)


def test_ids_with_several_texts(spark):
    a, b, c = ("".join(random.Random(k).choices("abcdefgh", k=200)) for k in range(3))
    rows = [(1, a), (3, a), (3, c), (3, a[:100] + c[:100]), (4, c), (4, b)]
    assert found(spark, rows) == expected(rows)


def test_very_long_texts(spark):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefghij \n", k=1_200_000))
    rows = [(1, long[1_000_000:1_100_000]), (2, "z" + long), (3, "q" * 1_100_000)]
    got = found(spark, rows)
    want = Counter({(1, 100_000, 0, 0, long[1_000_000:1_100_000].encode()): 1, (3, 1_100_000, 0, 0, b"q" * 1_100_000): 1})
    want[2, 1_200_001, 100_000, 1, ("z" + long[:1_000_000] + long[1_100_000:]).encode()] = 1
    assert got == want


def test_no_rows(spark):
    assert not found(spark, [])


def test_common_prefixes_by_induction():
    """The induced order's neighbours have the common prefix that their bytes have."""
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 4000, dtype=np.uint8)
    places = np.sort(rng.choice(np.arange(100, 3900), 300, replace=False))
    right = np.stack([text[p : p + L] for p in places])
    order = np.lexsort(right.T[::-1])
    places, right = places[order], right[order]
    left = np.stack([text[p - 30 : p][::-1] for p in places])
    doc = rng.integers(0, 9, 300)
    row, far = suffix_dedup.induced(np.zeros(300, dtype=np.int64), right, left, np.zeros(300, dtype=np.int64), np.full(300, 30), doc)
    got = set(zip(row.tolist(), far.tolist()))
    want = set()
    for d in range(31):
        first = {}
        for i, p in enumerate(places):
            s = text[p - d : p - d + L].tobytes()
            first[s] = min(first.get(s, 99), doc[i])
        want |= {(i, d) for i, p in enumerate(places) if first[text[p - d : p - d + L].tobytes()] < doc[i]}
    assert got == want


def test_least_between():
    values = np.random.default_rng(2).integers(0, 50, 1000).astype(np.uint8)
    a = np.random.default_rng(3).integers(0, 999, 500)
    b = a + 1 + np.random.default_rng(4).integers(0, 1000, 500) % (1000 - a)
    assert suffix_dedup.least_between(values, a, b).tolist() == [values[x:y].min() for x, y in zip(a, b)]
