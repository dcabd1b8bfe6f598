"""Benchmark decontamination by SimHash over item-sized windows.

Each benchmark item has a 256-bit SimHash of its five-word shingles, weighted by their counts.
Every window of a document that is as long as the item gets one too. The fingerprints are cut into
16 blocks of 16 bits: two fingerprints within ``RADIUS`` bits differ by at most ``RADIUS // 16 = 3`` bits in
one block at least (``RADIUS`` is 4 standard deviations above the distance expected at the similarity sought).
The index holds, for each length and block, the values within ``reach`` bits of each item's; a window looks up all values within the
``3 - reach`` bits left, so that together they find every item within the radius. ``reach`` is the largest whose index is
within ``MOST_ENTRIES``: the more items, the more of the work moves from the index to the lookups. What is found does not depend on it.
Pairs within the radius are verified by the exact weighted Jaccard similarity of their shingles,
``sum(min(counts)) / sum(max(counts))``. Windows that hold too few shingles of the benchmark
to reach the similarity with any item of their length are not fingerprinted; that loses none.

The benchmark is taken in blocks of bounded size, each of which is broadcast in turn, so memory does not
grow with it. Documents are read whole, once for each block.

Defined results: null and blank texts or items match nothing; an item of fewer than five words
matches only a document that consists of it; a document shorter than an item is one window;
repeated rows give repeated findings in ``findings`` and are all removed by ``without_items``, which keeps
all columns, rows with null ids included; empty tables find nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W

SIZE, SIMILARITY = 5, 0.8
LANES, RADIUS, BLOCK_BITS = 4, 63, 16
BLOCKS = LANES * 64 // BLOCK_BITS
#: Entries of the index of one broadcast block of items, 8 bytes each.
MOST_ENTRIES = 1 << 22
#: Characters of benchmark text in one broadcast block.
BLOCK_CHARS = 4_000_000
FINDING = "doc_id long, item_id long, start_word long, n_words long, similarity double"


def fingerprint_bits(shingles: np.ndarray) -> np.ndarray:
    """The 256 bits of each shingle, as 0 and 1."""
    lanes = np.stack([W.mix(shingles + s) for s in W.randoms(LANES, 31)], axis=1)
    return np.unpackbits(np.ascontiguousarray(lanes).view(np.uint8), axis=1)


def _packed(ones: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Fingerprints from the number of shingles that set each bit."""
    return np.packbits(2 * ones > m[:, None], axis=1).view(np.uint16)


def masks(most: int) -> np.ndarray:
    """All block values with at most ``most`` bits set."""
    return np.array([sum(1 << b for b in bits) for k in range(most + 1) for bits in combinations(range(BLOCK_BITS), k)], np.uint32)


class Blocks:
    """The multi-index over fingerprints: sorted keys, a block's number above one of its values, and the fingerprint each is of."""

    def __init__(self, marks: np.ndarray, reach: int):
        self.marks, self.probes = marks, masks(RADIUS // BLOCKS - reach)
        keys = self._keys(marks, masks(reach))
        order = np.argsort(keys, axis=None, kind="stable")
        self.keys = keys.ravel()[order]
        self.of = (order // keys.shape[1]).astype(np.int32)

    @staticmethod
    def _keys(marks: np.ndarray, around: np.ndarray) -> np.ndarray:
        """For each fingerprint the keys of all values around those of its blocks."""
        own = marks.astype(np.uint32) | (np.arange(BLOCKS, dtype=np.uint32) << BLOCK_BITS)
        return (own[:, :, None] ^ around).reshape(len(marks), BLOCKS * len(around))

    def near(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (row of ``marks``, own fingerprint) within the radius."""
        keys = self._keys(marks, self.probes)
        low = np.searchsorted(self.keys, keys.ravel(), "left")
        n = np.searchsorted(self.keys, keys.ravel(), "right") - low
        hit = np.flatnonzero(n)
        low, n = low[hit], n[hit]
        found = self.of[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        pairs = np.unique(np.repeat(hit // keys.shape[1], n) * len(self.marks) + found)
        row, own = pairs // max(len(self.marks), 1), pairs % max(len(self.marks), 1)
        close = np.bitwise_count(marks[row] ^ self.marks[own]).sum(axis=1, dtype=np.int64) <= RADIUS
        return row[close], own[close]


class Items:
    """The fingerprints of a block of benchmark items, cut into blocks of bits."""

    def __init__(self, ids: list[int], texts: list[str]):
        hashes, at = W.words(pa.array(texts, pa.string()))
        shingles, s_at = W.shingles(hashes, at, SIZE)
        some = np.flatnonzero(np.diff(at))
        self.ids = np.array(ids, np.int64)[some]
        self.n_words = np.diff(at)[some]
        self.sets = [np.unique(shingles[s_at[i] : s_at[i + 1]], return_counts=True) for i in some]
        ones = [fingerprint_bits(s).T @ c for s, c in self.sets]
        self.m = np.array([int(c.sum()) for _, c in self.sets], np.int64)
        self.marks = _packed(np.array(ones).reshape(len(some), -1), self.m) if len(some) else np.zeros((0, 256 // BLOCK_BITS), np.uint16)
        self.known = np.unique(np.concatenate([s for s, _ in self.sets])) if len(some) else np.zeros(0, np.uint64)
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.known >> np.uint64(44)).astype(np.int64)] = True
        reach = max([r for r in range(RADIUS // BLOCKS + 1) if len(some) * BLOCKS * len(masks(r)) <= MOST_ENTRIES], default=0)
        self.by_length = {}
        for n in np.unique(self.n_words):
            items = np.flatnonzero(self.n_words == n)
            self.by_length[int(n)] = items, Blocks(self.marks[items], reach)

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles occur in the benchmark."""
        found = self.bitmap[(shingles >> np.uint64(44)).astype(np.int64)]
        where = np.flatnonzero(found)
        if len(where):
            k = np.minimum(np.searchsorted(self.known, shingles[where]), len(self.known) - 1)
            found[where] = self.known[k] == shingles[where]
        return found

    def similarity(self, window: np.ndarray, item: int) -> float:
        known, counts = self.sets[item]
        own, own_counts = np.unique(window, return_counts=True)
        _, a, b = np.intersect1d(known, own, assume_unique=True, return_indices=True)
        both = int(np.minimum(counts[a], own_counts[b]).sum())
        return both / (int(counts.sum()) + len(window) - both)

    def search(self, shingles: np.ndarray, n_words: int) -> list[tuple[int, int, int, float]]:
        """``(item_id, start_word, n_words, similarity)``: the best window of each item found in one document."""
        hit = self.hits(shingles)
        if not hit.any():
            return []
        total = np.concatenate([[0], np.cumsum(hit)])
        best: dict[int, tuple[int, int, int, float]] = {}
        for length, (items, blocks) in self.by_length.items():
            width = min(max(length - SIZE + 1, 1), len(shingles))
            if length < SIZE and n_words != length:
                continue
            # J >= s needs s / (1 + s) of all shingles in common
            least = int(np.ceil(SIMILARITY / (1 + SIMILARITY) * (width + self.m[items].min()) - 1e-9))
            starts = np.flatnonzero(total[width:] - total[:-width] >= max(least, 1))
            for some in np.array_split(starts, len(starts) // 512 + 1):
                if not len(some):
                    continue
                low = some[0]
                sums = np.zeros((some[-1] + width - low + 1, LANES * 64), np.int32)
                np.cumsum(fingerprint_bits(shingles[low : some[-1] + width]), axis=0, out=sums[1:])
                marks = _packed(sums[some - low + width] - sums[some - low], np.full(len(some), width))
                for w, own in zip(*blocks.near(marks), strict=True):
                    item = int(items[own])
                    start = int(some[w])
                    score = self.similarity(shingles[start : start + width], item)
                    if score >= SIMILARITY and score > best.get(item, (0, 0, 0, 0.0))[3]:
                        best[item] = (int(self.ids[item]), start, min(length, n_words), score)
        return list(best.values())


def _each(index: Items, part: pa.RecordBatch) -> Iterator[tuple[int, list]]:
    hashes, at = W.words(part.column("text"))
    shingles, s_at = W.shingles(hashes, at, SIZE)
    hit = np.concatenate([[0], np.cumsum(index.hits(shingles))])
    for row in np.flatnonzero(hit[s_at[1:]] > hit[s_at[:-1]]):
        found = index.search(shingles[s_at[row] : s_at[row + 1]], int(at[row + 1] - at[row]))
        if found:
            yield row, found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    items = benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = chars // BLOCK_CHARS + 1
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).orderBy("id", "text").collect()
        yield Items([-1 if r["id"] is None else r["id"] for r in rows], [r["text"] for r in rows])


def findings(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, similarity)``: the best window of each item in each document."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = None
    for index in _blocks(benchmark, item_col, item_text):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in W.steps(batch):
                    rows = [(row, *found) for row, all_found in _each(index, part) for found in all_found]
                    own = part.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    rest = [pa.array([r[k + 1] for r in rows], kind) for k, kind in enumerate(kinds)]
                    yield pa.RecordBatch.from_arrays([own, *rest], ["doc_id", "item_id", "start_word", "n_words", "similarity"])

        found = source.mapInArrow(run, FINDING)
        out = found if out is None else out.union(found)
    return out


def without_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no benchmark item was found, all columns."""
    for index in _blocks(benchmark, item_col, item_text):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in W.steps(batch, text_col):
                    texts = pa.RecordBatch.from_arrays([part.column(text_col)], ["text"])
                    clean = np.ones(len(part), bool)
                    clean[[row for row, _ in _each(index, texts)]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
