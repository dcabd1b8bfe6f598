"""Mixing documents to target domain weights with soft membership.

A multinomial classifier, trained on a bounded sample of a labelled table, gives each document a
posterior over domains. Document rates ``r`` (how often a document is to be seen) are fitted by
projected-gradient least squares: the expected tokens of domain ``k``, ``sum(r * tokens *
posterior[k])``, shall equal the target weight times the token budget, with ``r >= 0`` (and ``r <= most`` where a caller sets it). The gradient needs the
domain totals only, so a step is one pass over the documents that returns one small row per
task; the rates themselves follow from a document's posterior and the steps' few numbers and are never moved.
Steps start from rate 1 and are taken in the metric of the tokens, so the rates stay as near to 1 as the targets allow. As long as no posterior at all
could bring a rate to its bound, the totals follow from the moments of the first pass, and steps need no pass. At most ``MOST_PASSES`` steps with
a pass follow; targets not met by then are logged.

A domain for which no target is given keeps the share of the tokens it has, and the targets given share the
rest; it is logged by name. Targets of 0 have to be given as such: documents that belong to such a domain alone get rate 0.

Defined results: null and blank texts have no tokens and the rate their posterior implies; classes
without labelled rows are left out and the targets of the others scaled to a total of 1; without any labelled
row, or in an empty table, every rate is 1; unreachable targets give the nearest totals in
the least-squares sense, and what is left is logged by domain; repeated rows have equal rates; labels with unknown ids are ignored.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import features
from harborline.llm import words as W
from harborline.llm.tables import fresh, sampled
from harborline.session import written_once

BITS, FIT_ROWS = 13, 3000
#: No rate is too high unless the caller says so.
MOST_RATE = float("inf")
#: Steps end where each domain is within ``ENOUGH`` of all tokens, or where the squared residual falls by less than ``STILL`` of itself.
ENOUGH, STILL = 1e-4, 1e-4
MOST_PASSES = 500
#: Target token weights by language; documents labelled as of low quality are a domain of their own.
TARGETS = {"de": 0.20, "en": 0.45, "es": 0.15, "fr": 0.18, "low": 0.02}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` of the labelled rows: their language, or ``low`` where quality is 0."""
    own = labels.select(F.col("doc_id").alias("_id"), "quality").where("quality is not null and _id is not null").distinct()
    langs = docs.select(F.col("doc_id").alias("_id"), "lang").distinct()
    domain = F.when(F.col("quality") == 0, "low").otherwise(F.col("lang"))
    return own.join(langs, "_id").select(F.col("_id").alias("doc_id"), domain.alias("domain")).where("domain is not null")


class Domains:
    def __init__(self, names: list[str], weights: np.ndarray):
        self.names, self.weights = names, weights

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        rows, n = features.hashed_words(texts, BITS)
        return features.softmax(rows.times(self.weights[:-1]) + self.weights[-1]), n


def fit_domains(docs: DataFrame, domains: DataFrame, fit_rows: int = FIT_ROWS) -> Domains | None:
    """A domain classifier from at most ``fit_rows`` labelled rows (of the smallest hashes)."""
    some = sampled(domains, F.struct("doc_id", "domain"), fit_rows).select(F.col("doc_id").alias("_id"), "domain")
    rows = docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("_id")).orderBy("doc_id", "domain", "text").select("domain", "text").limit(fit_rows).collect()
    if not rows:
        return None
    names = sorted({r["domain"] for r in rows})
    sparse, _ = features.hashed_words(pa.array([r["text"] for r in rows], pa.large_string()), BITS)
    return Domains(names, features.fit_softmax(sparse, np.array([names.index(r["domain"]) for r in rows]), len(names), 1 << BITS))


def memberships(docs: DataFrame, model: Domains) -> DataFrame:
    """``(doc_id, text_key, tokens, posterior)`` for each row."""
    source = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch):
                p, n = model.posteriors(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(n), lists], ["doc_id", "text_key", "tokens", "posterior"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, text_key long, tokens long, posterior array<double>")


def rates(posteriors: np.ndarray, steps: list[np.ndarray], most: float) -> np.ndarray:
    """The rates after the given gradient steps from 1, each projected to ``[0, most]``."""
    r = np.ones(len(posteriors))
    for step in steps:
        r = np.clip(r - posteriors @ step, 0, most)
    return r


def _matrix(part: pa.RecordBatch) -> np.ndarray:
    flat = part.column("posterior").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(part.num_rows, -1) if part.num_rows else flat.reshape(0, 1)


def _totals(members: DataFrame, steps: list[np.ndarray], most: float, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Domain token totals at the rates reached, and the tokens' second moments of the posteriors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k + k * k)
        for part in batches:
            p, n = _matrix(part), part.column("tokens").to_numpy().astype(float)
            if len(n):
                sums += np.concatenate([(rates(p, steps, most) * n) @ p, (p.T @ (p * n[:, None])).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], ["i", "sum"])

    rows = members.mapInArrow(run, "i long, sum double").groupBy("i").agg(F.sum("sum")).collect()
    sums = np.zeros(k + k * k)
    for i, value in rows:
        sums[i] = value
    return sums[:k], sums[k:].reshape(k, k)


def shares(given: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Target shares with a total of 1: domains without one (nan) keep their present share, the others divide the rest as given."""
    known = ~np.isnan(given)
    goal = np.where(known, 0.0, present)
    if given[known].sum() > 0:
        goal[known] = given[known] / given[known].sum() * (1 - goal.sum())
    elif not goal.sum():
        goal[:] = 1 / len(goal)
    return goal / goal.sum()


def _far(short: np.ndarray, tokens: float) -> bool:
    return np.abs(short).max() > ENOUGH * tokens


def _free_steps(short: np.ndarray, moments: np.ndarray, scale: np.ndarray, reach: float, most: float, tokens: float) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the first steps, of those that can bring no rate to a bound, and what the totals are above their goal after them."""
    moved, last = np.zeros(len(short)), np.inf
    while _far(short, tokens) and (residual := float(np.square(scale * short).sum())) <= last * (1 - STILL):
        further = moved + scale**2 * short / reach
        if further.max() > 1 or 1 - further.min() > most:
            break
        short, moved, last = short - moments @ (further - moved), further, residual
    return moved, short


def fit_rates(members: DataFrame, goal: np.ndarray, most: float = MOST_RATE) -> tuple[list[np.ndarray], np.ndarray]:
    """The gradient steps whose rates bring the domain totals to ``goal`` (see ``shares``), and what each total is then above it."""
    totals, moments = _totals(members, [], most, len(goal))
    tokens = totals.sum()
    if tokens == 0:
        return [], np.zeros(len(goal))
    goal = shares(goal, totals / tokens)
    # scaled by domain, so that a small one converges as fast as a large one
    scale = 1 / np.sqrt(np.maximum(totals, 1e-9 * tokens))
    reach = np.linalg.eigvalsh(scale[:, None] * moments * scale[None, :])[-1]
    free, short = _free_steps(totals - goal * tokens, moments, scale, reach, most, tokens)
    steps, last = [free] if free.any() else [], np.inf
    for _ in range(MOST_PASSES):
        residual = float(np.square(scale * short).sum())
        if not _far(short, tokens) or residual > last * (1 - STILL):
            break
        last = residual
        steps.append(scale**2 * short / reach)
        short = _totals(members, steps, most, len(goal))[0] - goal * tokens
    return steps, short / tokens


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, most: float = MOST_RATE) -> DataFrame:
    """``(doc_id, text_key, tokens, domain, rate, posterior)`` for each row; ``domain`` is the likeliest."""
    targets = TARGETS if targets is None else targets
    model = fit_domains(docs, labelled_domains(docs, labels))
    if model is None:
        words = F.size(F.expr("filter(split(text, '[ \\t-\\r]+'), x -> x <> '')")).cast("long")
        return docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.greatest(F.coalesce(words, F.lit(0)), F.lit(0)).cast("long").alias("tokens"), F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"), F.array().cast("array<double>").alias("posterior"))
    members = written_once(memberships(docs, model), "memberships")
    names = model.names
    untold = [name for name in names if name not in targets]
    if untold:
        logging.getLogger(__name__).warning("no target for %s: they keep their share", untold)
    steps, over = fit_rates(members, np.array([targets.get(name, np.nan) for name in names]), most)
    level = logging.WARNING if np.abs(over).max() > ENOUGH else logging.INFO
    logging.getLogger(__name__).log(level, "shares above target after %d steps: %s", len(steps), {n: round(float(x), 6) for n, x in zip(names, over, strict=True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            p = _matrix(part)
            domain = np.array(names, object)[p.argmax(axis=1)] if len(p) else []
            own = [part.column(c) for c in ("doc_id", "text_key", "tokens")]
            yield pa.RecordBatch.from_arrays([*own, pa.array(domain, pa.string()), pa.array(rates(p, steps, most)), part.column("posterior")], ["doc_id", "text_key", "tokens", "domain", "rate", "posterior"])

    kind = members.schema["doc_id"].dataType.simpleString()
    return members.mapInArrow(run, f"doc_id {kind}, text_key long, tokens long, domain string, rate double, posterior array<double>")


def with_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, most: float = MOST_RATE) -> DataFrame:
    """The documents with a rate above 0, with ``mix_domain`` and ``mix_rate`` beside their own columns, in place of such columns of their own."""
    added = ("mix_domain", "mix_rate")
    found = mixed(docs, labels, targets, most).groupBy("doc_id", "text_key").agg(F.first("domain").alias("mix_domain"), F.first("rate").alias("mix_rate"))
    key = fresh(docs, "_own_key")
    own = docs.select("*", F.xxhash64("text").alias(key)).alias("own")
    joined = own.join(found.alias("found"), F.expr(f"own.doc_id <=> found.doc_id and own.`{key}` = found.text_key"))
    kept = [F.col(f"own.`{c}`") for c in docs.columns if c not in added]
    return joined.where("found.mix_rate > 0").select(*kept, *[F.col(f"found.{c}") for c in added])
