"""The line model against all labellings, against differences, and on documents whose quality changes."""

import itertools

import numpy as np
import pytest

from sparkdesk.llm import line_crf

WIDTH = 3 * 15 + 1
GOOD = "The river runs past the old mill, and in summer the children of the village swim there until dusk."
BAD = "BUY NOW!!! $$$ CLICK $$$ HERE | WIN | WIN | WIN ### 0000 BUY NOW!!! ***"


def model(rng) -> line_crf.Model:
    return line_crf.Model(rng.normal(size=WIDTH) / 4, rng.normal(size=(2, 2)), rng.normal(size=WIDTH), rng.uniform(0.5, 2, WIDTH))


def weight(m: line_crf.Model, features: np.ndarray, labels) -> float:
    """Log weight of one labelling, term by term."""
    odds = m.odds(features)
    total = sum(o for o, y in zip(odds, labels) if y)
    return total + sum(m.moves[a, b] for a, b in zip(labels, labels[1:]))


def likelihood(m: line_crf.Model, features: np.ndarray, labels) -> float:
    every = [weight(m, features, ys) for ys in itertools.product((0, 1), repeat=len(features))]
    return weight(m, features, labels) - np.logaddexp.reduce(every)


@pytest.mark.parametrize("lines", [1, 2, 3, 7])
def test_marginals_are_those_of_all_labellings(lines):
    rng = np.random.default_rng(lines)
    m, features = model(rng), rng.normal(size=(lines, WIDTH))
    good, whole = np.zeros(lines), 0.0
    for ys in itertools.product((0, 1), repeat=lines):
        w = np.exp(weight(m, features, ys))
        good, whole = good + w * np.array(ys), whole + w
    assert np.allclose(m.marginals(features), good / whole)


def test_slope_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    m = line_crf.Model(rng.normal(size=WIDTH) / 4, rng.normal(size=(2, 2)), np.zeros(WIDTH), np.ones(WIDTH))
    parts = [(rng.normal(size=(n, WIDTH)), rng.integers(0, 2, n)) for n in (1, 3, 5)]
    x, mask, y = np.zeros((3, 5, WIDTH)), np.zeros((3, 5)), np.zeros((3, 5))
    for i, (rows, labels) in enumerate(parts):
        x[i, : len(rows)], mask[i, : len(rows)], y[i, : len(rows)] = rows, 1, labels

    def value(weights, moves):
        at = line_crf.Model(weights, moves, m.mean, m.scale)
        return sum(likelihood(at, rows, labels) / len(rows) for rows, labels in parts)

    weights, moves = line_crf._slope(m, x, mask, y)
    step = 1e-5
    for k in range(0, WIDTH, 5):
        d = np.zeros(WIDTH)
        d[k] = step
        assert (value(m.weights + d, m.moves) - value(m.weights - d, m.moves)) / (2 * step) == pytest.approx(weights[k], abs=1e-6)
    for at in itertools.product((0, 1), repeat=2):
        d = np.zeros((2, 2))
        d[at] = step
        assert (value(m.weights, m.moves + d) - value(m.weights, m.moves - d)) / (2 * step) == pytest.approx(moves[at], abs=1e-6)


def test_a_glued_text_has_the_glued_features():
    first, second = f"{GOOD}\n{BAD}".encode(), f"{BAD}\n\n{GOOD}".encode()
    made = line_crf.glued(line_crf.document_features(first)[0], line_crf.document_features(second)[0])
    assert np.array_equal(made, line_crf.document_features(first + b"\n" + second)[0])


def test_labels_change_where_the_quality_does():
    rng = np.random.default_rng(2)

    def text(line: str, n: int) -> bytes:
        words = line.split()
        return b"\n".join(" ".join(rng.permutation(words)[: rng.integers(6, len(words) + 1)]).encode() for _ in range(n))

    documents = [(line_crf.document_features(text((BAD, GOOD)[i % 2], 2 + i % 9))[0], i % 2) for i in range(200)]
    m = line_crf.fit(documents)
    good, bad = text(GOOD, 12), text(BAD, 12)
    halves = m.marginals(line_crf.document_features(good + b"\n" + bad)[0])
    assert halves[:11].min() > 0.9 and halves[13:].max() < 0.1
    assert m.score(good) > 0.95 and m.score(bad) < 0.05 and 0.3 < m.score(good + b"\n" + bad) < 0.8
