"""A generative label model: class, voter accuracies and dependence of voters from the votes alone, by expectation-maximisation.

Votes are -1 (abstains), 0 or 1.  The input is how many documents have each
combination of votes, of which there are at most 3**voters, so that fitting
doesn't depend on the number of documents.

Without dependence the votes are independent given the class.  With it, the
pairs of voters whose votes tell most about each other within the classes
(conditional mutual information) get a factor P(both votes | class) /
(P(one | class) P(other | class)).  The pairs form a forest, so that the product
of all terms is a distribution over the combinations of votes as it stands, and
posteriors are exact.
"""

from __future__ import annotations

import numpy as np

ABSTAIN = -1
#: A pair of voters gets a factor from this conditional mutual information on (nats).
LEAST_INFORMATION = 0.001


def encode(votes: np.ndarray) -> np.ndarray:
    """A number in base 3 for each row of votes."""
    return (votes.astype(np.int64) + 1) @ 3 ** np.arange(votes.shape[1], dtype=np.int64)


def decode(codes: np.ndarray, voters: int) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(voters, dtype=np.int64) % 3 - 1).astype(np.int8)


class LabelModel:
    """P(class 1), P(vote | class) of each voter and P(two votes | class) of the dependent pairs."""

    def __init__(self, voters: int, correlated: bool):
        self.voters, self.correlated = voters, correlated
        self.prior = 0.5
        self.theta = np.full((2, voters, 3), 1 / 3)
        self.joint = np.full((2, voters, 3, voters, 3), 1 / 9)
        self.pairs: list[tuple[int, int]] = []

    def log_likelihood(self, votes: np.ndarray) -> np.ndarray:
        """log P(votes | class): a row for each class."""
        log = np.log(self.theta)
        at = votes.astype(np.int64) + 1
        out = log[:, np.arange(self.voters), at].sum(axis=2)
        for i, j in self.pairs:
            factor = np.log(self.joint[:, i, :, j]) - log[:, i, :, None] - log[:, j, None, :]
            out = out + factor[:, at[:, i], at[:, j]]
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        clean, marked = self.log_likelihood(votes)
        logit = np.log(self.prior / (1 - self.prior)) + marked - clean
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))

    def accuracies(self) -> np.ndarray:
        """P(a voter is right, given that it votes)."""
        share = np.array([1 - self.prior, self.prior])[:, None]
        said = (self.theta[:, :, 1:].sum(axis=2) * share).sum(axis=0)
        return (self.theta[0, :, 1] * share[0] + self.theta[1, :, 2] * share[1]) / said

    def information(self) -> np.ndarray:
        """Conditional mutual information of each two voters' votes given the class, in nats."""
        share = np.array([1 - self.prior, self.prior])
        apart = self.theta[:, :, :, None, None] * self.theta[:, None, None, :, :]
        return np.einsum("y,yiajb->ij", share, self.joint * np.log(self.joint / apart))

    def _estimate(self, marks: np.ndarray, counts: np.ndarray, p: np.ndarray, smooth: float) -> None:
        mass = (counts * (1 - p), counts * p)
        self.prior = float(np.clip(mass[1].sum() / counts.sum(), 1e-4, 1 - 1e-4))
        for y in (0, 1):
            seen = (mass[y] @ marks).reshape(self.voters, 3) + smooth
            self.theta[y] = seen / seen.sum(axis=1, keepdims=True)
            if self.correlated:  # a third of the smoothing for each pair of votes: its sums are the single votes'
                both = (marks * mass[y][:, None]).T @ marks + smooth / 3
                self.joint[y] = both.reshape(self.voters, 3, self.voters, 3) / seen[0].sum()

    def _forest(self) -> list[tuple[int, int]]:
        """The pairs of most information that close no circle."""
        told, tree, pairs = self.information(), list(range(self.voters)), []
        some = [(-told[i, j], i, j) for i in range(self.voters) for j in range(i) if told[i, j] >= LEAST_INFORMATION]
        for _, i, j in sorted(some):
            if tree[i] != tree[j]:
                tree = [tree[i] if t == tree[j] else t for t in tree]
                pairs.append((i, j))
        return sorted(pairs)

    def _rounds(self, votes, marks, counts, p, rounds: int, smooth: float) -> None:
        for _ in range(rounds):
            self._estimate(marks, counts, p, smooth)
            new = self.posterior(votes)
            done, p = np.abs(new - p).max() < 1e-6, new
            if done:
                break

    def fit(self, votes: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 1.0, choices: int = 5) -> LabelModel:
        """Starts from the share of ones among each combination's votes.

        With dependence, pairs are chosen by the model fitted so far and the
        fit starts anew with them (classes that were fitted without a pair may
        have taken the voters' agreement for the class), until the choice is
        the same again or was made ``choices`` times.
        """
        votes, counts = votes.astype(np.int64), counts.astype(float)
        marks = (votes[:, :, None] == np.arange(-1, 2)).reshape(len(votes), -1).astype(float)
        ones, zeros = (votes == 1).sum(axis=1), (votes == 0).sum(axis=1)
        start = (0.5 + ones) / (1.0 + ones + zeros)
        self._rounds(votes, marks, counts, start, rounds, smooth)
        for _ in range(choices if self.correlated else 0):
            pairs = self._forest()
            if pairs == self.pairs:
                break
            self.pairs = pairs
            self._rounds(votes, marks, counts, start, rounds, smooth)
        return self
