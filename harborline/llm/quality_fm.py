"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its hashed words (``1 + log(count)``, scaled to length 1), statistics of its
structure in bins, and its stated length in bins; every bin is a feature of value 1. The score is the sigmoid of
``bias + sum(w x) + 0.5 * sum over factors of ((sum(v x)) ** 2 - sum((v x) ** 2))``: the sum-of-squares
identity gives all pairwise interactions of a text in time linear in its features.

The weights are fitted by Adam steps on at most ``fit_rows`` labelled rows outside the held-out
third (those of the smallest hashes); labels, language, source and id are no features.

Defined results: null and empty texts get the score of a text without words (their stated lengths may differ); rows that share an id are scored
by their own texts; rows with a null id are scored, never learned from and not held out; an id with two different labels
counts once for each; without labelled rows every score is 0.5 (predicted 1); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import features
from harborline.llm import words as W
from harborline.llm.tables import held_out, sampled, third

BITS, FACTORS, FIT_ROWS, ROUNDS = 16, 8, 4000, 12
BINS = 16


def _classes() -> np.ndarray:
    """The kind of each byte: letter, capital, digit, white space, line end, sentence mark, other mark."""
    kind = np.full(256, 6)
    kind[[*range(97, 123), *range(128, 256)]] = 0
    kind[range(65, 91)] = 1
    kind[range(48, 58)] = 2
    kind[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = 3
    kind[0x0A] = 4
    kind[[0x21, 0x2C, 0x2E, 0x3A, 0x3B, 0x3F]] = 5
    return kind


KINDS, N_KINDS = _classes(), 7


def structure(texts: pa.Array) -> np.ndarray:
    """Statistics of each text, each between 0 and 1: shares of byte kinds, of distinct words and lines, lengths of words, lines and texts."""
    data, at = W.utf8(texts)
    n = np.diff(at)
    kinds = KINDS[data]
    shares = np.stack([np.diff(np.concatenate([[0], np.cumsum(kinds == k)])[at]) / np.maximum(n, 1) for k in range(N_KINDS)], axis=1)
    hashes, w_at = W.words(texts)
    n_words = np.diff(w_at)
    _, d_at = W.distinct(hashes, w_at)
    line_starts, line_ends, rows = W.spans(data, at, data != 0x0A)
    keys = W.span_hashes(data, line_starts, line_ends, W.byte_values(np.arange(256) == 0x0A))
    l_at = np.searchsorted(rows, np.arange(len(n) + 1))
    _, u_at = W.distinct(keys, l_at)
    n_lines = np.diff(l_at)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    repeats = np.diff(np.concatenate([[0], np.cumsum(same)])[w_at])
    more = [
        np.diff(d_at) / np.maximum(n_words, 1),
        np.diff(u_at) / np.maximum(n_lines, 1),
        repeats / np.maximum(n_words, 1),
        np.minimum(n / np.maximum(n_words, 1), 20) / 20,
        np.minimum(n_words / np.maximum(n_lines, 1), 100) / 100,
        np.log1p(n) / 20,
    ]
    return np.clip(np.column_stack([shares, *more]), 0, 1)


def feature_rows(texts: pa.Array, n_chars: pa.Array) -> features.Rows:
    """Hashed words, then one bin for each statistic: columns from ``2 ** BITS`` on."""
    words, _ = features.hashed_words(texts, BITS)
    stats = structure(texts)
    stated = np.array(n_chars.cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False))
    meta = np.where(stated < 0, 0, np.clip(np.log1p(np.maximum(stated, 0)) / 20, 0.05, 1))
    # square roots spread the small shares over more bins
    bins = np.minimum((np.sqrt(np.column_stack([stats, meta])) * BINS).astype(np.int64), BINS - 1)
    columns = (1 << BITS) + np.arange(bins.shape[1]) * BINS + bins
    rows = np.concatenate([words.rows, np.repeat(np.arange(len(words)), bins.shape[1])])
    order = np.argsort(rows, kind="stable")
    values = np.concatenate([words.values, np.full(columns.size, 0.5)])
    return features.Rows(np.concatenate([words.columns, columns.ravel()])[order], values[order], words.at + np.arange(len(words) + 1) * bins.shape[1])


COLUMNS = (1 << BITS) + 14 * BINS


class Machine:
    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def parts(self, rows: features.Rows) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid, and the sums of each factor."""
        sums = rows.times(self.factors)
        squares = rows.squared().times((self.factors**2).sum(axis=1))
        return self.bias + rows.times(self.weights) + 0.5 * ((sums**2).sum(axis=1) - squares), sums

    def scores(self, texts: pa.Array, n_chars: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(feature_rows(texts, n_chars))[0], -30, 30)))


def _pick(rows: features.Rows, some: np.ndarray) -> features.Rows:
    lengths = np.diff(rows.at)[some]
    at = np.concatenate([[0], np.cumsum(lengths)])
    where = np.repeat(rows.at[some] - at[:-1], lengths) + np.arange(at[-1])
    return features.Rows(rows.columns[where], rows.values[where], at)


def fit_machine(rows: features.Rows, labels: np.ndarray, rounds: int = ROUNDS, batch: int = 128, rate: float = 0.02, decay: float = 1e-4) -> Machine:
    """Adam on the logistic loss, in passes of a fixed order."""
    chance = np.random.default_rng(17)
    share = np.clip(labels.mean(), 0.01, 0.99)
    own = Machine(float(np.log(share / (1 - share))), np.zeros(COLUMNS), chance.normal(0, 0.05, (COLUMNS, FACTORS)))
    theta = np.column_stack([own.weights, own.factors])
    first, second, t = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(rounds):
        for some in np.array_split(chance.permutation(len(labels)), max(1, len(labels) // batch)):
            part = _pick(rows, some)
            score, sums = own.parts(part)
            error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - labels[some]) / len(some)
            columns, place = np.unique(part.columns, return_inverse=True)
            local = features.Rows(place, part.values, part.at)
            step = decay * theta[columns]
            step[:, 0] += local.transposed_times(error, len(columns))
            square = local.squared().transposed_times(error, len(columns))
            step[:, 1:] += local.transposed_times(error[:, None] * sums, len(columns)) - own.factors[columns] * square[:, None]
            t += 1
            first[columns] = 0.9 * first[columns] + 0.1 * step
            second[columns] = 0.999 * second[columns] + 0.001 * step**2
            theta[columns] -= rate * (first[columns] / (1 - 0.9**t)) / (np.sqrt(second[columns] / (1 - 0.999**t)) + 1e-8)
            own = Machine(own.bias - rate * float(error.sum()), theta[:, 0], theta[:, 1:])
    return own


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine | None:
    known = labels.where((third(F.col("doc_id")) != 1) & F.col("quality").isin(0, 1)).select(F.col("doc_id").alias("_id"), "quality").distinct()
    some = sampled(known, F.struct("_id", "quality"), fit_rows)
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "n_chars", "quality")
    rows = rows.orderBy("doc_id", "quality", "text").limit(fit_rows).collect()
    if not rows:
        return None
    parts = feature_rows(pa.array([r["text"] or "" for r in rows], pa.large_string()), pa.array([r["n_chars"] for r in rows], pa.int64()))
    return fit_machine(parts, np.array([r["quality"] for r in rows], float))


def score(docs: DataFrame, model: Machine | None) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (higher: quality 1 likelier), ``predicted``."""
    source = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("n_chars").cast("long").alias("n_chars"), F.coalesce("text", F.lit("")).alias("text"))
    if model is None:
        return source.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch):
                s = model.scores(part.column("text"), part.column("n_chars"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
