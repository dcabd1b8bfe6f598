"""N-gram Jaccard join by adaptive multi-match prefixes.

All shingles are put in one global order, rare ones first. Two sets whose Jaccard similarity
is ``percent`` / 100 or more share at least ``l`` of their first ``n - ceil(n * percent / 100)
+ l`` shingles, for every ``l``: so a pair in which one set uses ``la`` and the other ``lb``
shares ``min(la, lb)`` prefix shingles. Each set takes the ``l`` of the lowest estimated cost,
from corpus-wide counts: sets with rare prefixes use ``l = 1``, sets whose prefixes hold common
shingles a longer prefix and more matches.

Equal sets form one class and are joined as one. Candidates are met in two steps so that a
large group of near copies never expands into all its pairs: first each class is verified
against two representatives of its prefix shingles (linear work), which merges such groups;
then every pair of classes that share enough prefix shingles *and are still in different
components* is verified. The second step is complete: no cap and no sample. Verification
recomputes both sets from the whole texts.

Defined results: null or blank texts have the empty set and link with nothing; fewer words
than the shingle size are one shingle; repeated rows give one row each and share a component; rows with a null id
take part, and a component of such rows only has a null id; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W
from harborline.llm.tables import components, fresh, only_ids
from harborline.session import written_once

#: Bits of the table of shingle counts (2 ** 17 counts, 1 MB): fixed, whatever the corpus.
COUNT_BITS = 17
MOST_MATCHES = 4
#: Cost of verifying one candidate, in prefix entries.
VERIFY_COST = 4.0
#: Shared prefix tokens that an entry carries.
CARRIED = 64


def _sets(batch: pa.RecordBatch, size: int, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    return W.distinct(*W.shingles(*W.words(batch.column(column)), size))


def _signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One hash for each set: equal sets have equal hashes."""
    total = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(sets), dtype=np.uint64)])
    return W.mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64))


def _describe(size: int):
    """Rows ``(doc_id, text_key, n, sig)``; after the last one of a task, its shingle counts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for part in W.steps(batch):
                sets, at = _sets(part, size)
                counts += np.bincount((sets >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(counts))
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(np.diff(at)), pa.array(W.signed(_signatures(sets, at))), pa.nulls(n, pa.int32())],
                    ["doc_id", "text_key", "n", "sig", "bucket"],
                )
        some = np.flatnonzero(counts)
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, pa.array(counts[some]), none, pa.array(some.astype(np.int32))], ["doc_id", "text_key", "n", "sig", "bucket"])

    return run


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """The fewest shingles that a set of ``n`` shares with a set it links with."""
    return (n * percent + 99) // 100


def _prefixes(size: int, percent: int, counts: np.ndarray):
    """Rows ``(token, sig, n, matches, len, at)``: the adaptive prefix of each set, once a task for equal sets.

    Tokens are ordered as signed numbers, rare ones first; ``at`` is the place of the token in its
    set and ``len`` the length of the prefix.
    """
    rank = np.empty(len(counts), np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)
    low = np.uint64(64 - COUNT_BITS)
    # what a bucket holds beyond the usual crowd is what its common shingle brings
    beyond = np.maximum(counts - np.median(counts), 0)[np.argsort(counts, kind="stable")].astype(float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for part in W.steps(batch):
                sets, at = _sets(part, size)
                sig = _signatures(sets, at)
                new = np.zeros(len(sig), bool)
                for i, own in enumerate(sig.tolist()):
                    new[i] = own not in met
                    met.add(own)
                # reorder: the rank of the bucket replaces its number, so that sorting is by frequency
                tokens, _ = W.distinct((rank[(sets >> low).astype(np.int64)] << low) | (sets & ((np.uint64(1) << low) - np.uint64(1))), at)
                n = np.diff(at)
                base = n - _least_overlap(n, percent)
                lengths, chosen = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
                for i in np.flatnonzero((n > 0) & new):
                    most = min(MOST_MATCHES, n[i] - base[i])
                    ahead = np.cumsum(beyond[(tokens[at[i] : at[i] + base[i] + most] >> low).astype(np.int64)])
                    matches = np.arange(1, most + 1)
                    # at most sum / l sets share l of these tokens
                    cost = (base[i] + matches) + VERIFY_COST * ahead[base[i] + matches - 1] / matches
                    chosen[i] = matches[np.argmin(cost)]
                    lengths[i] = base[i] + chosen[i]
                rows = np.repeat(np.arange(len(n)), lengths)
                position = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                ordered = W.signed(tokens ^ np.uint64(1 << 63))
                numbers = (pa.array(x.astype(np.int32)) for x in (n[rows], chosen[rows], lengths[rows], position + 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ordered[at[:-1][rows] + position]), pa.array(W.signed(sig[rows])), *numbers],
                    ["token", "sig", "n", "matches", "len", "at"],
                )

    return run


def _linked(size: int, percent: int):
    """Of rows ``(a, b, text_a, text_b)``, the pairs ``(a, b)`` that are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in W.steps(batch, "text_a"):
                for part in W.steps(half, "text_b"):
                    a, a_at = _sets(part, size, "text_a")
                    b, b_at = _sets(part, size, "text_b")
                    both = W.shared(a, a_at, b, b_at)
                    keep = pa.array((both > 0) & (100 * both >= percent * (np.diff(a_at) + np.diff(b_at) - both)))
                    yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], ["a", "b"])

    return run


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The links among candidate pairs ``(a, b)`` of classes, from the texts of their first rows."""
    of = lambda side: classes.select(F.col("sig").alias(side), F.col("id_key").alias(f"id_{side}"), F.col("text_key").alias(f"key_{side}"))
    pairs = written_once(pairs.join(of("a"), "a").join(of("b"), "b"), "candidates")
    some = only_ids(texts, F.col("text_key"), pairs.select("key_a").union(pairs.select("key_b")), "key_a")
    for side in ("a", "b"):
        held = some.select(F.col("id_key").alias(f"id_{side}"), F.col("text_key").alias(f"key_{side}"), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(held.hint("merge"), [f"id_{side}", f"key_{side}"])
    return written_once(pairs.select("a", "b", "text_a", "text_b").mapInArrow(_linked(size, percent), "a long, b long").distinct(), "links")


def _stars(live: DataFrame, percent: int) -> DataFrame:
    """For each class the representative that most of its early prefix tokens point to.

    The representative of a token is the class with the fewest tokens of its own before it: the centre of its copies.
    """
    early = live.where((F.col("n") - F.col("at") + 1) * (100 + percent) >= 2 * percent * F.col("n"))
    central = F.min(F.struct((F.col("at") / F.col("n")).alias("place"), "sig", "n")).alias("central")
    central = written_once(early.groupBy("token").agg(central).select("token", F.col("central.sig").alias("b"), F.col("central.n").alias("m")), "centres")
    stars = early.join(central, "token").where(F.col("sig") != F.col("b")).where((F.least("n", "m") * 100 >= F.greatest("n", "m") * percent))
    counted = stars.groupBy(F.col("sig").alias("a"), "b").agg(F.count("*").alias("c"))
    return counted.groupBy("a").agg(F.max_by("b", F.struct("c", "b")).alias("b"))


def _apart(live: DataFrame, merged: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes in different components that share enough of their prefixes.

    A pair is made once, at its first shared token. There the sets can share no more than what
    follows in each, and in all no more than the shared prefix tokens and what follows the prefix
    of one of them; pairs for which that is too little, or that share fewer tokens than they
    must, are left out. Each entry carries the shared tokens of its prefix for that, up to
    ``CARRIED``: sets with more of them pass these tests on what is carried and go on to verification.
    """
    labelled = live.select("token", "sig", "n", "matches", "len", "at").join(merged.withColumnRenamed("node", "sig"), "sig", "left")
    facts = [F.first(c).alias(c) for c in ("n", "matches", "len", "at")]
    labelled = written_once(labelled.groupBy("token", "sig").agg(F.first(F.coalesce("root", "sig")).alias("root"), *facts), "labelled")
    several = labelled.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    apart = written_once(labelled.join(several, "token"), "apart")
    carried = apart.groupBy("sig").agg(F.slice(F.sort_array(F.collect_list("token")), 1, CARRIED + 1).alias("tokens"))
    some = apart.where(F.col("at") <= F.col("n") - F.floor((F.col("n") * percent + 99) / 100) + 1)
    apart = written_once(some.join(carried, "sig"), "carried")
    x, y = apart.alias("x"), apart.alias("y")
    both = F.array_intersect("x.tokens", "y.tokens")
    whole = (F.size("x.tokens") <= CARRIED) & (F.size("y.tokens") <= CARRIED)
    fits = lambda most: most * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent
    rest = F.greatest(F.col("x.n") - F.col("x.len"), F.col("y.n") - F.col("y.len"))
    return (
        x.join(
            y,
            (F.col("x.token") == F.col("y.token"))
            & (F.col("x.root") < F.col("y.root"))
            & fits(F.least("x.n", "y.n"))
            & fits(F.col("x.n") - F.col("x.at") + 1)
            & fits(F.col("y.n") - F.col("y.at") + 1)
            & ((F.size(both) == 0) | (F.try_element_at(both, F.lit(1)) == F.col("x.token")))
            & (~whole | ((F.size(both) >= F.least("x.matches", "y.matches")) & fits(F.size(both) + rest))),
        )
        .select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b"))
        .distinct()
    )


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles`` (set size), ``component_id`` (smallest id reachable by links)."""
    return _found(docs, id_col, text_col, size, percent).select("doc_id", "n_shingles", "component_id")


def _found(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """The rows of ``ngram_components`` with their ``text_key``, and ``kept``: id and text of the first document of the component."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    source = source.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    described = source.mapInArrow(_describe(size), "doc_id long, text_key long, n long, sig long, bucket int")
    described = written_once(described, "sets")
    rows = described.where("bucket is null").select("doc_id", "text_key", "n", "sig")
    counts = np.zeros(1 << COUNT_BITS, np.int64)
    for bucket, n in described.where("bucket is not null").groupBy("bucket").agg(F.sum("n")).collect():  # at most 2 ** COUNT_BITS rows
        counts[bucket] = n

    first = F.min(F.struct(_id_key(F.col("doc_id")).alias("id_key"), "text_key"))
    classes = rows.where("n > 0").groupBy("sig").agg(first.alias("first"), F.first("n").alias("n"))
    classes = written_once(classes.select("sig", "first.id_key", "first.text_key", "n"), "classes")

    prefixes = source.select("text").mapInArrow(_prefixes(size, percent, counts), "token long, sig long, n int, matches int, len int, at int")
    # equal sets of different tasks count too: that keeps a few entries more and loses none
    met = prefixes.groupBy("token").agg(F.count("*").alias("c")).where("c > 1")
    live = written_once(prefixes.join(met.select("token"), "token"), "prefixes")

    texts = source.select(_id_key(F.col("doc_id")).alias("id_key"), "text_key", "text")
    links = _verified(_stars(live, percent), classes, texts, size, percent)
    more = _verified(_apart(live, components(links), percent), classes, texts, size, percent)
    roots = components(links.union(more))

    ids = classes.select("sig", F.struct("id_key", "text_key").alias("first"))
    grouped = ids.join(roots.withColumnRenamed("node", "sig"), "sig", "left").select("sig", "first", F.coalesce("root", "sig").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("kept"))
    named = written_once(grouped.join(smallest, "root").select("sig", "kept"), "components")
    out = rows.join(named, "sig", "left")
    smallest_id = F.when(F.col("kept.id_key.known"), F.col("kept.id_key.id"))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, smallest_id).otherwise(F.col("doc_id")).alias("component_id"), "kept")


def _id_key(doc_id: Column) -> Column:
    """A never-null key of an id; real ids come before null."""
    return F.struct(doc_id.isNull().alias("unknown"), doc_id.isNotNull().alias("known"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"))


def one_of_each_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Documents without their near copies: of each component the one with the smallest id stays.

    A document is an id with its text: of two texts under one id, only the one that is a copy goes. Of several texts
    under the smallest id, the one with the smallest hash stays. Rows that repeat the kept document stay too; documents without words or
    without an id stay. All columns are returned.
    """
    found = _found(docs, "doc_id", "text", size, percent)
    other = F.struct(_id_key(F.col("doc_id")).alias("id_key"), "text_key") != F.col("kept")
    gone = written_once(found.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull() & other).select("doc_id", "text_key").distinct(), "near-copies")
    gone_id, gone_key = fresh(docs, "_gone_id"), fresh(docs, "_gone_key")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key))
    same = (F.col("doc_id").cast("long") == F.col(gone_id)) & (F.xxhash64(F.col("text").cast("string")) == F.col(gone_key))
    return docs.join(gone, same, "left_anti")
