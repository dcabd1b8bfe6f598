"""Hashed words of texts as sparse rows, for the classifiers that are trained here."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from harborline.llm import words as W


class Rows:
    """Sparse rows: the columns and values of row ``i`` are at ``at[i]:at[i + 1]``."""

    def __init__(self, columns: np.ndarray, values: np.ndarray, at: np.ndarray):
        self.columns, self.values, self.at = columns, values, at
        self.rows = np.repeat(np.arange(len(at) - 1), np.diff(at))

    def __len__(self) -> int:
        return len(self.at) - 1

    def times(self, weights: np.ndarray) -> np.ndarray:
        """The product with a matrix (or vector) of weights by column."""
        if weights.ndim == 1:
            return np.bincount(self.rows, self.values * weights[self.columns], minlength=len(self))
        return np.stack([self.times(np.ascontiguousarray(w)) for w in weights.T], axis=1)

    def transposed_times(self, errors: np.ndarray, columns: int) -> np.ndarray:
        """The sum over the rows of their values times their errors, by column."""
        if errors.ndim == 1:
            return np.bincount(self.columns, self.values * errors[self.rows], minlength=columns)
        return np.stack([self.transposed_times(e, columns) for e in errors.T], axis=1)

    def squared(self) -> Rows:
        return Rows(self.columns, self.values**2, self.at)


def hashed_words(texts: pa.Array, bits: int) -> tuple[Rows, np.ndarray]:
    """``1 + log(count)`` of each hashed word, every row scaled to length 1; and the rows' numbers of words."""
    hashes, at = W.words(texts)
    n = np.diff(at)
    keys = (np.repeat(np.arange(len(n)), n) << bits) | (hashes >> np.uint64(64 - bits)).astype(np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    values, rows = 1 + np.log(counts), keys >> bits
    length = np.sqrt(np.bincount(rows, values**2, minlength=len(n)))
    return Rows(keys & ((1 << bits) - 1), values / np.maximum(length, 1e-12)[rows], np.searchsorted(rows, np.arange(len(n) + 1))), n


def fit_softmax(rows: Rows, labels: np.ndarray, classes: int, columns: int, rounds: int = 150, rate: float = 8.0, decay: float = 1e-5) -> np.ndarray:
    """Weights of a multinomial logistic regression (last row: bias), by accelerated gradient steps."""
    target = np.eye(classes)[labels]
    weights = np.zeros((columns + 1, classes))
    before = weights
    for k in range(rounds):
        ahead = weights + (k / (k + 3)) * (weights - before)
        error = softmax(rows.times(ahead[:-1]) + ahead[-1]) - target
        step = np.vstack([rows.transposed_times(error, columns), error.sum(axis=0)]) / len(labels)
        before, weights = weights, ahead - rate * (step + decay * ahead)
    return weights


def softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)
