"""The label model against enumeration of all combinations of votes, and on votes drawn from known voters."""

import itertools

import numpy as np
import pytest

from ledgerline.llm import quality
from ledgerline.llm.label_model import LabelModel, decode, encode


def every(voters):
    return np.array(list(itertools.product((-1, 0, 1), repeat=voters)))


def drawn(n, seed, copies=0):
    """Classes and votes of five voters, and of ``copies`` more that mostly repeat the first one's votes."""
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    right, says = (0.75, 0.85, 0.8, 0.9, 0.7), (0.9, 0.8, 0.9, 0.7, 0.9)
    votes = np.stack([np.where(rng.random(n) < r, y, 1 - y) for r in right], axis=1)
    votes[rng.random(votes.shape) >= says] = -1
    more = [np.where(rng.random(n) < 0.9, votes[:, 0], rng.integers(-1, 2, n)) for _ in range(copies)]
    return y, np.stack([*votes.T, *more], axis=1)


def counted(votes):
    codes, counts = np.unique(encode(votes), return_counts=True)
    return decode(codes, votes.shape[1]), counts


def by_hand(model, y, vote):
    """P(class, votes): the prior, each voter's term and each pair's factor, multiplied."""
    p = model.prior if y else 1 - model.prior
    for i, v in enumerate(vote):
        p *= model.theta[y, i, v + 1]
    for i, j in model.pairs:
        p *= model.joint[y, i, vote[i] + 1, j, vote[j] + 1] / (model.theta[y, i, vote[i] + 1] * model.theta[y, j, vote[j] + 1])
    return p


@pytest.mark.parametrize("correlated", [False, True])
def test_posterior_equals_enumeration(correlated):
    votes, counts = counted(drawn(4000, 1, copies=2)[1])
    model = LabelModel(7, correlated).fit(votes, counts)
    assert bool(model.pairs) == correlated
    combos = every(7)
    both = np.array([[by_hand(model, y, v) for y in (0, 1)] for v in combos.tolist()])
    assert both.sum() == pytest.approx(1, abs=1e-9)  # a distribution, with the factors too
    assert np.allclose(model.posterior(combos), both[:, 1] / both.sum(axis=1), atol=1e-9)
    # a pair's joint votes, summed over all other voters, are the estimated ones
    for i, j in model.pairs:
        for a, b in itertools.product((-1, 0, 1), repeat=2):
            mine = both[(combos[:, i] == a) & (combos[:, j] == b)].sum(axis=0)
            share = np.array([1 - model.prior, model.prior])
            assert np.allclose(mine, share * model.joint[:, i, a + 1, j, b + 1], atol=1e-9)


def test_pairs_close_no_circle():
    votes, counts = counted(drawn(4000, 2, copies=3)[1])
    model = LabelModel(8, True).fit(votes, counts)
    groups = [{i} for i in range(8)]
    for i, j in model.pairs:
        a, b = next(g for g in groups if i in g), next(g for g in groups if j in g)
        assert a is not b
        groups.remove(b)
        a |= b


def test_copied_voters_count_once():
    """Three voters that repeat a weak one outvote better ones, unless the model knows that they depend on it."""
    y, votes = drawn(60_000, 3, copies=3)
    combos, counts = counted(votes)
    apart, known = (LabelModel(8, c).fit(combos, counts) for c in (False, True))
    assert {(5, 0), (6, 0), (7, 0)} <= set(known.pairs)
    right = [((m.posterior(votes) >= 0.5) == y).mean() for m in (apart, known)]
    assert right[1] > right[0] + 0.03
    assert known.accuracies()[:5] == pytest.approx([0.75, 0.85, 0.8, 0.9, 0.7], abs=0.04)
    assert known.prior == pytest.approx(0.3, abs=0.04)


def test_independent_voters_get_their_accuracies():
    y, votes = drawn(60_000, 4)
    model = LabelModel(5, True).fit(*counted(votes))
    assert model.accuracies() == pytest.approx([0.75, 0.85, 0.8, 0.9, 0.7], abs=0.04)


def test_few_and_silent_votes():
    """One combination, none at all but abstentions: probabilities, no errors."""
    for votes in (np.full((1, 3), -1), np.array([[1, 1, 1]]), np.array([[0, -1, 1]])):
        p = LabelModel(3, True).fit(votes, np.array([1])).posterior(every(3))
        assert np.isfinite(p).all() and (p >= 0).all() and (p <= 1).all()


def test_quality_posterior_equals_enumeration():
    """The quality classifier's labellers: every combination's posterior by hand."""
    rng = np.random.default_rng(5)
    m = len(quality.LABELLERS)
    votes, counts = counted(rng.integers(-1, 2, (2000, m)))
    model = LabelModel(m, correlated=False).fit(votes, counts)
    for vote, got in zip(votes[:300].tolist(), model.posterior(votes[:300])):
        clean, marked = (by_hand(model, y, vote) for y in (0, 1))
        assert got == pytest.approx(marked / (clean + marked), abs=1e-9)
