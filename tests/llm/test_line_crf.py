"""Marginals of the line classifier against all labellings, and the bounds of its groups."""

from itertools import product

import numpy as np
import pytest

from wattledger.llm import line_crf
from wattledger.llm.line_crf import Crf


def by_labellings(logits, links):
    """P(good) per line and expected counts of neighbouring labels, by adding up all labellings."""
    n = len(logits)
    total, good, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for labels in product((0, 1), repeat=n):
        value = np.exp(sum(logits[i] for i in range(n) if labels[i]))
        value *= np.exp(sum(links[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        total += value
        good += value * np.array(labels)
        for a, b in zip(labels, labels[1:], strict=False):
            pairs[a, b] += value
    return good / total, pairs / total


@pytest.mark.parametrize("seed", range(5))
def test_marginals_equal_the_sum_over_labellings(seed):
    rng = np.random.default_rng(seed)
    crf = Crf(np.zeros(1), rng.normal(0, 1.5, (2, 2)))
    rows = [rng.normal(0, 2, n) for n in (1, 2, 3, 7, 9, 1, 5)]
    good, pairs, _ = crf.marginals(*line_crf.padded(rows))
    for i, row in enumerate(rows):
        want, want_pairs = by_labellings(row, crf.links)
        np.testing.assert_allclose(good[i, : len(row)], want, rtol=1e-9)
        np.testing.assert_allclose(pairs[i], want_pairs, atol=1e-9)


def random_crf(seed=1):
    rng = np.random.default_rng(seed)
    return Crf(rng.normal(0, 0.5, 3 * line_crf.N_OWN + 3), rng.normal(0, 1, (2, 2)), 1.7, -0.2)


TEXTS = ["", "one line", "a\n\n### $$ %%\nSome words, as they come.\n", "x\n" * 6, "1 2 3\nthe end!\n|||", "é ü\nz"]


def test_score_is_the_length_weighted_mean_of_marginals():
    crf = random_crf()
    for text, score in zip(TEXTS, crf.score(TEXTS), strict=True):
        own, per_text, _ = line_crf.line_features([text])
        good, _ = by_labellings(line_crf.with_neighbours(own, per_text) @ crf.weights, crf.links)
        mean = np.average(good, weights=[len(line.encode()) + 1 for line in text.split("\n")])
        assert score == pytest.approx(1 / (1 + np.exp(-(1.7 * np.log(mean / (1 - mean)) - 0.2))), rel=1e-9)


@pytest.mark.parametrize("cells, documents", [(1, 128), (10, 128), (1 << 20, 2), (1 << 20, 128)])
def test_groups_are_bounded_and_change_no_score(monkeypatch, cells, documents):
    crf = random_crf()
    want = crf.score(TEXTS)
    monkeypatch.setattr(line_crf, "BATCH_CELLS", cells)
    monkeypatch.setattr(line_crf, "BATCH_DOCUMENTS", documents)
    per_text = np.array([t.count("\n") + 1 for t in TEXTS])
    groups = list(line_crf.grouped(per_text))
    assert sorted(i for g in groups for i in g) == list(range(len(TEXTS)))
    for group in groups:
        assert len(group) <= documents
        assert len(group) == 1 or len(group) * per_text[group].max() <= cells
    np.testing.assert_allclose(crf.score(TEXTS), want, rtol=1e-12)


def test_a_long_text_is_not_padded_to_its_neighbours():
    """A text of 200 000 lines among short ones: its cells are its own lines only."""
    texts = ["short\ntext"] * 127 + ["word\n" * 200_000]
    per_text = np.array([t.count("\n") + 1 for t in texts])
    sizes = [len(g) * per_text[g].max() for g in line_crf.grouped(per_text)]
    assert sizes == [254, 200_001]
    crf = random_crf()
    scores = crf.score(texts)
    assert len(set(scores[:127])) == 1 and scores[0] == pytest.approx(crf.score(texts[:1])[0], rel=1e-9)
    assert list(line_crf.grouped(np.zeros(0, int))) == []
