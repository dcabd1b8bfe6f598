"""Embedding near-dedup by a pivot-permutation index.

Reference points (pivots) are drawn from a bounded sample of the vectors: ``PIVOTS`` of them up to ``USUAL`` vectors of a length, then as the root
of their number, so that lists grow with the root of the table too, up to ``MOST_PIVOTS`` and ``PIVOT_VALUES`` components (beyond, with the
table). Lengths beyond the ``SAMPLED_LENGTHS`` commonest have fixed random directions as pivots. A vector is described by the
ordered list of its ``NEAREST`` nearest pivots; the inverted lists hold, for each pivot, the vectors that name it. Two
vectors with a cosine of 0.98 or more name mostly the same pivots, so candidates are the pairs of one label whose
lists share ``SHARED`` pivots or more. The lists are kept by triples of pivots, which meet exactly the pairs with three
shared ones and are short where single lists are long; a pair is made at its first shared triple only. Every candidate
is verified by its cosine in double precision.

Equal vectors of one label are indexed once and count as many links as they are. Vectors that are null, zero,
or hold null or non-finite components, and those without a label, link with nothing.

The joins whose sides grow with the table are hinted to merge. Spark sizes a table by its compressed file and an exploded one as if each row
stayed one row, so that it would send every vector's 84 triples, or other rows of many times that size, through the driver as a small table.

The index is approximate: a pair whose lists share fewer pivots is missed. ``tests/llm`` measures the recall against
brute force. Verified links are never wrong.

Defined results: an empty table gives no rows; repeated rows (equal id and vector) are one vector each and link
with each other; vectors of different lengths have no cosine and do not link; other columns are ignored; null ids count as
links, but are never a component's id unless it has no other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm.tables import components, sampled
from harborline.session import written_once

PIVOTS, NEAREST, SHARED, LEAST = 192, 9, 3, 0.98
#: Number of vectors of a length from which on the pivots become more, and the bounds on pivots and their components.
USUAL, MOST_PIVOTS, PIVOT_VALUES = 10_000, 4_096, 1 << 22
SAMPLED_LENGTHS = 16


def pivots_for(vectors: int, size: int, least: int = PIVOTS) -> int:
    """How many pivots describe so many vectors of that length."""
    wanted = max(least, math.isqrt(least * least * vectors // USUAL))
    return max(min(wanted, MOST_PIVOTS, PIVOT_VALUES // size), NEAREST)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column."""
    at = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(float)
    return values[at[0] : at[-1]], at - at[0]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two that bring their largest components near 1, so that squares neither overflow nor vanish."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def directions(size: int, least: int = PIVOTS) -> np.ndarray:
    """Fixed random pivots of a length that has no sampled ones."""
    return _units(np.random.default_rng(size).standard_normal((pivots_for(0, size, least), size)))


def _describe(pivots: dict[int, np.ndarray], least: int):
    """The nearest pivots of each vector (pivots by dimension), nearest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = _matrix(batch.column("vector"))
            sizes = np.diff(at)
            lists: list[list[int]] = [[]] * len(sizes)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                points = pivots.get(int(size))
                points = directions(int(size), least) if points is None else points
                for some in np.array_split(own, len(own) // 2048 + 1):
                    units = _units(values[at[some][:, None] + np.arange(size)])
                    near = np.argsort(-(units @ points.T), axis=1, kind="stable")[:, :NEAREST]
                    for row, names in zip(some, near.tolist(), strict=True):
                        lists[row] = names
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("label"), pa.array(lists, pa.list_(pa.int32()))], ["node", "label", "near"])

    return run


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, a_at = _matrix(batch.column("vector_a"))
            b, b_at = _matrix(batch.column("vector_b"))
            n = np.diff(a_at)
            same = n == np.diff(b_at)
            keep = np.zeros(len(n), bool)
            for size in np.unique(n[same]):
                own = np.flatnonzero(same & (n == size))
                for some in np.array_split(own, len(own) // 4096 + 1):
                    x = _scaled(a[a_at[some][:, None] + np.arange(size)])
                    y = _scaled(b[b_at[some][:, None] + np.arange(size)])
                    keep[some] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))) >= least
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return run


def _drawn(classes: DataFrame, rows: int, seed: int) -> np.ndarray:
    """The vectors of so many sampled classes. Only these reach the driver: their nodes are chosen first, and not among the results of a collect, which get
    as many rows from each partition."""
    nodes = sampled(classes.select("node"), F.col("node"), rows, seed)
    some = classes.select("node", "vector").join(F.broadcast(nodes), "node").select(F.xxhash64(F.lit(seed), "node").alias("hash"), "node", "vector").collect()
    return np.array([r["vector"] for r in sorted(some, key=lambda r: (r["hash"], r["node"]))])


def near_vectors(embeddings: DataFrame, least: float = LEAST, pivots: int = PIVOTS, nearest_seed: int = 3) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    sound = F.size("embedding") > 0
    sound &= F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))) & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull()
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    node = F.xxhash64(F.col("label").cast("string"), "embedding")
    rows = rows.select("vec_id", "label", F.when(F.col("sound"), node).alias("node"), F.when(F.col("sound"), F.col("embedding").cast("array<double>")).alias("vector"))
    classes = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    classes = written_once(classes, "vectors")

    lengths = classes.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(SAMPLED_LENGTHS).collect()
    points = {}
    for size, n in lengths:
        if n > 1:
            points[size] = _units(_drawn(classes.where(F.size("vector") == size), pivots_for(n, size, pivots), nearest_seed))
    lists = classes.select("node", "label", "vector").mapInArrow(_describe(points, pivots), f"node long, label {classes.schema['label'].dataType.simpleString()}, near array<int>")
    lists = written_once(lists, "pivot-lists")

    ordered = lists.select("node", "label", F.array_sort("near").alias("near"))
    spots = range(NEAREST)
    triples = [F.array(*[F.get("near", F.lit(i)) for i in (i, j, k)]) for i in spots for j in spots[i + 1 :] for k in spots[j + 1 :]]
    few = F.when(F.size("near") < SHARED, F.array(F.array(F.lit(-1)))).otherwise(F.filter(F.array(*triples), lambda t: F.get(t, F.lit(SHARED - 1)).isNotNull()))
    entries = ordered.where(F.size("near") > 0).select("node", "label", "near", F.explode(few).alias("triple"))
    x, y = entries.alias("x"), entries.alias("y")
    first = F.slice(F.array_intersect("x.near", "y.near"), 1, SHARED)
    meets = (F.col("x.label") == F.col("y.label")) & (F.col("x.triple") == F.col("y.triple")) & (F.col("x.node") < F.col("y.node"))
    pairs = x.join(y.hint("merge"), meets & ((first == F.col("x.triple")) | (F.get("x.triple", F.lit(0)) == -1))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    of = lambda side: classes.select(F.col("node").alias(side), F.col("vector").alias(f"vector_{side}"))
    links = written_once(pairs.join(of("a").hint("merge"), "a").join(of("b").hint("merge"), "b").mapInArrow(_verified(least), "a long, b long"), "links")

    both = links.union(links.select("b", "a")).toDF("node", "other")
    copies = classes.select(F.col("node").alias("other"), "copies")
    others = both.join(copies.hint("merge"), "other").groupBy("node").agg(F.sum("copies").alias("others"))
    roots = components(links)
    named = classes.select("node", "copies", "vec_id").join(roots, "node", "left").select("node", "copies", "vec_id", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    facts = named.join(smallest, "root").join(others, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    facts = written_once(facts, "vector-links")
    out = rows.select("vec_id", "node").join(facts.hint("merge"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
