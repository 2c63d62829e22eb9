"""Every stage of the pipeline against plain Python on all documents of the smallest tables."""

import re
from collections import defaultdict

import numpy as np
import public_tokenizers
from test_operators import sequences_of, words_of
from tokenizers import Tokenizer

import corpus_pipeline
from sparkdesk.llm import line_crf

FOLDER = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def good(model, text: str) -> float:
    """Score from sums of log weights over all labellings, line by line from both ends."""
    features, sizes = line_crf.document_features(text.encode())
    own = np.stack([np.zeros(len(features)), model.odds(features)], axis=1)
    ahead, behind = [own[0]], [np.zeros(2)]
    for e in own[1:]:
        ahead.append(np.array([np.logaddexp.reduce(ahead[-1] + model.moves[:, j]) + e[j] for j in (0, 1)]))
    for e in own[:0:-1]:
        behind.append(np.array([np.logaddexp.reduce(model.moves[i] + e + behind[-1]) for i in (0, 1)]))
    both = np.array(ahead) + np.array(behind[::-1])
    marginals = 1 / (1 + np.exp(both[:, 0] - both[:, 1]))
    return float((marginals * (sizes + 1)).sum() / (sizes + 1).sum())


def first_of_equal(texts: dict) -> set:
    groups = defaultdict(list)
    for i, t in texts.items():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
    return {min(ids) for ids in groups.values()}


def first_of_linked(texts: dict) -> set:
    sets = {}
    for i, t in texts.items():
        w = words_of(t)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    group = {i: i for i in texts}
    for a in sorted(sets):
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                root, other = sorted((group[a], group[b]))
                group = {k: root if v == other else v for k, v in group.items()}
    return set(group.values())


def base_spans(text: str) -> list:
    spans = [m.span() for m in ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    return spans + [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]


def masked_places(before: str, after: str) -> set:
    """Characters of ``before`` that are masked in ``after``; everything else must be there, in order."""
    parts = after.split("[SECRET]")
    assert before.startswith(parts[0]) and before.endswith(parts[-1])
    at, gone = len(parts[0]), set()
    for k, part in enumerate(parts[1:], 1):
        begin = len(before) - len(part) if k == len(parts) - 1 else before.find(part, at + 1)
        assert begin > at
        gone.update(range(at, begin))
        at = begin + len(part)
    return gone


def test_every_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = line_crf.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    outputs = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
        outputs.append({r.doc_id: r.text or "" for r in docs.collect()})
        assert docs.count() == len(outputs[-1])
    kept, single, apart, masked = outputs
    assert kept == {i: t for i, t in texts.items() if good(model, t) >= line_crf.THRESHOLD}
    assert single == {i: kept[i] for i in first_of_equal(kept)}
    assert apart == {i: single[i] for i in first_of_linked(single)}
    assert len(texts) > len(kept) > len(single) > len(apart)
    assert masked.keys() == apart.keys() and masked != apart
    for i, text in apart.items():
        gone = masked_places(text, masked[i])
        assert all(gone.issuperset(range(*span)) for span in base_spans(text)), i

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.piece):
        found[r.doc_id] += np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert found == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in masked.items()}
    assert len(sequences_of(rows)) >= sum(r.length for r in rows) / 1024
