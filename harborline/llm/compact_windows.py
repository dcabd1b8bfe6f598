"""Substring dedup by compact windows.

A text is the sequence of its five-word shingles. For a hash function, the node of
the Cartesian tree over the shingles' hashes that has its least value at place ``c`` spans the compact window ``l..r``: every
passage within it that contains ``c`` has that min-hash. There are six functions, in three pairs. The windows of the two functions of
a pair are joined as intervals: where they share ``WIDTH`` shingles (50 words) that hold both minima, every passage between has both
min-hashes, and the key is the two values together. So passages meet only where two functions agree on the same stretch,
and a frequent phrase alone brings nothing together. Two passages meet where both functions of a pair agree: with a chance of 0.953 at a similarity of 0.8, of 0.979
at 0.85, of 0.993 at 0.9, and surely where they are equal.

Stretches of one key are held against two representatives (those of the smallest and the largest document), which is
linear in the group. Aligned stretches of two documents are joined along their offset and verified on the shingles themselves: the longest
stretches with enough shared for each foreign shingle must have ``WIDTH`` shingles and a Jaccard similarity of 0.8 to their counterpart.
Stretches that no verified passage explains after that may be like others of their group but like neither representative. They
are grouped again by their key and one more shingle, at each of the ``ANCHORS`` from their minimum, and held against
representatives once more: near copies share one of the four but for a chance of about 0.002.

Defined results: texts of fewer than 50 words, null and empty texts have no passages; a passage that repeats within its
document is found at each place that has no word in common with the one it is held against; rows with a null id take no part; repeated rows (equal id and
text) are one document, and an id has one text: of several texts under one id, spans of one may be cut from the other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm import words as W
from harborline.llm.tables import only_ids
from harborline.session import written_once

SIZE, WIDTH, SIMILARITY = 5, 46, 0.8
FUNCTIONS, PAIRS = 6, ((0, 1), (2, 3), (4, 5))
#: Places, from the first minimum of a stretch, whose shingles group it again.
ANCHORS = (-14, -7, 7, 14)
ANCHORED = [f"anchor_{k}" for k in range(len(ANCHORS))]
#: Bits of the filter of keys that occur twice (4 MB): fixed, whatever the corpus; it only saves moving rows.
KEY_BITS = 25
#: Shared shingles asked for a foreign one, from what is needed to what is enough.
CHARGES = (4, 6, 8)
#: Bytes of text whose windows are computed at once: the arrays of a step stay in a core's own cache.
STEP_BYTES = 1 << 18
#: How far two places of one text must be from each other for passages of ``WIDTH`` shingles not to share a word.
APART = WIDTH + SIZE - 1


def _widened(x: np.ndarray, by: int, pick, out: np.ndarray, back: bool = False) -> np.ndarray:
    """``pick`` of each place and the one ``by`` places on (with ``back`` before it); the last (first) ones keep their own."""
    rest = max(len(x) - by, 0)
    own, kept = (slice(len(x) - rest, None), slice(0, len(x) - rest)) if back else (slice(0, rest), slice(rest, None))
    pick(x[:rest], x[len(x) - rest :], out=out[own])
    out[kept] = x[kept]
    return out


def _reach(tables: list[np.ndarray], heads: np.ndarray, back: bool, room: np.ndarray) -> np.ndarray:
    """The last place from each head on up to which all values are at least its own. ``tables`` of the least of
    1, 2, 4, ... places are added as they are needed, in rows of ``room``."""
    values, end = tables[0], len(tables[0])
    own, at = values[heads], heads.copy()
    # between separators no way leaves the table: what it has beyond an end is cut off there and holds the separator
    sealed = end > 0 and not values[0] and not values[-1]

    def fits(level: int, some: np.ndarray) -> np.ndarray:
        start = at[some] - (1 << level) if back else at[some] + 1
        if sealed:
            start = np.maximum(start, 0)
        else:
            inside = (start >= 0) & (start + (1 << level) <= end)
            some, start = some[inside], start[inside]
        return some[tables[level][start] >= own[some]]

    # the heads whose way is 2 ** level places at least, level by level, and then their way in powers of two
    everyone, base = np.arange(len(heads)), min(5, len(tables) - 1)
    far, some = [], fits(base, everyone)
    while len(some):
        far.append(some)
        if base + len(far) == len(tables):
            tables.append(_widened(tables[-1], 1 << (len(tables) - 1), np.minimum, room[len(tables)]))
        some = fits(base + len(far), some)
    for level in range(base + len(far) - 1, -1, -1):
        step = -(1 << level) if back else 1 << level
        if sealed and level < base:
            start = np.maximum(at + step, 0) if back else at + 1
            at += (tables[level].take(start) >= own) * step
        else:
            at[fits(level, far[level - base] if level >= base else everyone)] += step
    return at


def room_for(places: int) -> np.ndarray:
    """Working space of ``compact_windows``; touched as far as it is needed, and used again it spares new memory."""
    return np.empty((places.bit_length() + 5, places), np.uint64)


def compact_windows(values: np.ndarray, width: int, every: bool = False, room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(l, c, r)`` of the windows of at least ``width`` places; value 0 separates texts and is in no window.

    Equal values share a window, which is given once, with the first of their places, or with ``every`` one of them.
    """
    if len(values) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    room = room_for(len(values)) if room is None else room
    tables, have = [values], 1
    while 2 * have <= width:
        tables.append(_widened(tables[-1], have, np.minimum, room[len(tables)]))
        have *= 2
    spare = room[-3:]
    least = _widened(tables[-1], width - have, np.minimum, spare[0])
    least[max(len(values) - width + 1, 0) :] = 0
    # a place heads a wide window if it is the least of some ``width`` places around it
    most, have = least, 1
    while have < width:
        step = min(have, width - have)
        most = _widened(most, step, np.maximum, spare[1] if most is not spare[1] else spare[2], back=True)
        have += step
    # the first smaller value beyond a wide window heads a wide one itself or separates texts, so that heads and separators tell all bounds
    places = np.concatenate([[-1], np.flatnonzero(most == values), [len(values)]])
    stops = np.zeros(len(places), np.uint64)
    stops[1:-1] = values[places[1:-1]]
    tables, rows = [stops], np.empty((len(places).bit_length() + 1, len(places)), np.uint64)
    for level in range(min(4, len(places).bit_length())):
        tables.append(_widened(tables[-1], 1 << level, np.minimum, rows[len(tables)]))
    inner = np.flatnonzero(stops)
    heads = places[inner]
    bounds = [places[_reach(tables, inner, True, rows) - 1] + 1, places[_reach(tables, inner, False, rows) + 1] - 1]
    own = values[heads]
    if every:
        return bounds[0], heads, bounds[1]
    _, first = np.unique(np.stack([bounds[0], own.view(np.int64)], axis=1), axis=0, return_index=True) if len(heads) else (None, np.zeros(0, np.int64))
    first = np.sort(first)
    return bounds[0][first], heads[first], bounds[1][first]


def _territories(values: np.ndarray, left: np.ndarray, centre: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(l, c, r, slack)``: the places of equal minima that share a window, with what each has to answer for.

    A place that is within ``APART`` of the last one kept is answered for by that, with ``slack``. A window ends ``WIDTH`` beyond the
    next kept places, so that the windows of a text that repeats itself throughout grow with its length and not with its square.
    """
    order = np.argsort(left, kind="stable")  # places come in ascending order; among windows of one start, the values fall with them
    left, centre, right = left[order], centre[order], right[order]
    head = np.ones(len(left), bool)
    head[1:] = (left[1:] != left[:-1]) | (values[centre[1:]] != values[centre[:-1]])
    keep, slack = head.copy(), np.zeros(len(left), np.int8)
    last = -1
    after = np.flatnonzero(~head)
    for i, place, before, first in zip(after.tolist(), centre[after].tolist(), centre[after - 1].tolist(), head[after - 1].tolist(), strict=True):
        if first:
            last, kept_place = i - 1, before
        if place - kept_place >= APART:
            keep[i], last, kept_place = True, i, place
        else:
            slack[last] = APART
    left, centre, right, head, slack = left[keep], centre[keep], right[keep], head[keep], slack[keep]
    more = np.flatnonzero(~head)
    own = left.copy()
    own[more] = np.maximum(left[more], centre[more - 1] - WIDTH)
    right[more - 1] = np.minimum(right[more - 1], centre[more] + APART + WIDTH)
    return own, centre, right, slack


def joint_windows(one: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...], width: int = WIDTH) -> tuple[np.ndarray, ...]:
    """Rows of two lists of windows ``(l, c, r, ...)`` that share ``width`` places which hold both minima, and those places.

    ``(row of one, row of other, l, r)``
    """
    l1, c1, r1 = one[:3]
    order = np.argsort(other[1], kind="stable")
    l2, c2, r2 = (x[order] for x in other[:3])
    low, high = np.searchsorted(c2, l1, "left"), np.searchsorted(c2, r1, "right")
    i = np.repeat(np.arange(len(c1)), high - low)
    j = np.arange(len(i)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[i]
    fits = (l2[j] <= c1[i]) & (c1[i] <= r2[j])
    i, j = i[fits], j[fits]
    left, right = np.maximum(l1[i], l2[j]), np.minimum(r1[i], r2[j])
    wide = right - left + 1 >= width
    return i[wide], order[j[wide]], left[wide], right[wide]


def _joint(part: pa.RecordBatch, anchored: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each pair of functions: ``(band, keys, rows, l, c, r, slack, anchors)`` of its joint windows, places from the start of their text,
    and the shingles at each of ``ANCHORS``."""
    shingles, at = W.shingles(*W.words(part.column("text")), SIZE)
    long = np.flatnonzero(np.diff(at) >= WIDTH)
    if not len(long):
        return
    sizes = np.diff(at)[long]
    starts = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    inner = np.repeat(starts - at[:-1][long], sizes) + np.repeat(at[:-1][long], sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    tokens = np.zeros(starts[-1] + sizes[-1] + 1, np.uint64)
    tokens[inner] = np.concatenate([shingles[at[i] : at[i + 1]] for i in long])
    between = np.concatenate([starts - 1, [len(tokens) - 1]])
    found, room = [], room_for(len(tokens))
    for seed in W.randoms(FUNCTIONS, 51):
        values = W.mix(tokens ^ seed) | np.uint64(1)
        values[between] = 0
        found.append((values, *_territories(values, *compact_windows(values, WIDTH, every=True, room=room))))
    for band, pair in enumerate(PAIRS):
        (v1, *one), (v2, *other) = (found[k] for k in pair)
        i, j, left, right = joint_windows(one, other)
        centre, second = one[1][i], other[1][j]
        keys = W.mix(v1[centre] + W.mix(v2[second]) + np.uint64(band))
        rows = np.searchsorted(starts, centre, "right") - 1
        anchors = [tokens[np.clip(centre + k, 0, len(tokens) - 1)] for k in ANCHORS if anchored]
        yield band, keys, long[rows], left - starts[rows], centre - starts[rows], right - starts[rows], np.maximum(one[3][i], other[3][j]), anchors


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of each joint window."""
    for batch in batches:
        for part in W.steps(batch, limit=STEP_BYTES):
            for _, keys, *_ in _joint(part, anchored=False):
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(keys))], ["key"])


def _windows(bits: np.ndarray):
    """Rows ``(key, doc_id, l, c, r, slack, anchor_0, ...)`` of the joint windows whose key may occur twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch, limit=STEP_BYTES):
                for _, keys, rows, left, centre, right, slack, anchors in _joint(part):
                    bit = keys >> np.uint64(64 - KEY_BITS)
                    kept = (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
                    places = [pa.array(p[kept].astype(np.int32)) for p in (left, centre, right)]
                    near = [pa.array(_narrow(anchors[k][kept])) for k in range(len(ANCHORS))]
                    ids = part.column("doc_id").take(pa.array(rows[kept]))
                    yield pa.RecordBatch.from_arrays([pa.array(W.signed(keys[kept])), ids, *places, pa.array(slack[kept]), *near], ["key", "doc_id", "l", "c", "r", "slack", *ANCHORED])

    return run


def _key_filter(repeated: DataFrame) -> np.ndarray:
    bit = F.shiftrightunsigned("key", 64 - KEY_BITS)
    words = repeated.select(bit.alias("_bit")).groupBy(F.expr("_bit div 64").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("bits"))
    out = np.zeros(1 << (KEY_BITS - 6), np.int64)
    for batch in words.toArrow().to_batches():  # 2 ** 19 rows at most
        out[batch.column("at").to_numpy()] = batch.column("bits").to_numpy()
    return out.view(np.uint64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of the stretches asked for, with the columns of each request."""
    for batch in batches:
        for part in W.steps(batch):
            shingles, at = W.shingles(*W.words(part.column("text")), SIZE)
            wanted = part.column("wanted")
            w_at, flat = wanted.offsets.to_numpy(), wanted.flatten()
            rows = np.repeat(np.arange(len(part)), np.diff(w_at))
            s, e = (flat.field(k).to_numpy() for k in (0, 1))
            pieces = [_narrow(shingles[at[row] : at[row + 1]][a : b + 1]) for row, a, b in zip(rows, s, e, strict=True)]
            lengths = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(pieces) if pieces else np.zeros(0, np.int32)))
            names = [flat.type.field(k).name for k in range(flat.type.num_fields)]
            yield pa.RecordBatch.from_arrays([*[flat.field(k) for k in range(len(names))], tokens], [*names, "tokens"])


def _narrow(shingles: np.ndarray) -> np.ndarray:
    """The upper 32 bits, enough to compare two passages: of ``n`` and ``m`` shingles, ``n * m / 2 ** 32`` are taken for equal in error."""
    return (shingles >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _runs(marked: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of marked places."""
    framed = np.zeros(len(marked) + 2, bool)
    framed[1:-1] = marked
    edges = (framed[1:] != framed[:-1]).nonzero()[0].tolist()
    return edges[::2], edges[1::2]


def _within(runs: tuple[list[int], list[int]], low: int, high: int) -> tuple[list[int], list[int]]:
    """What of the runs lies in ``low..high``, counted from ``low``."""
    starts, ends = runs
    i, j = bisect_right(ends, low), bisect_left(starts, high)
    return [max(s, low) - low for s in starts[i:j]], [min(e, high) - low for e in ends[i:j]]


def longest_stretch(runs: tuple[list[int], list[int]], charge: int) -> tuple[int, int]:
    """Start and end of the longest stretch, from a shared shingle to a shared one, with at least ``charge`` shared ones for each foreign one.

    ``runs`` are those of shared shingles. The balance rises within a run, so that a stretch starts where a run starts and ends where one ends.
    """
    best, at = (0, 0), 0
    balance, lows, firsts = 0, [], []  # balances fallen to below all before, with their sign turned, and where
    for start, end in zip(*runs, strict=True):
        balance -= charge * (start - at)
        if not lows or -balance > lows[-1]:
            lows.append(-balance)
            firsts.append(start)
        balance += end - start
        first = firsts[bisect_left(lows, -balance)]  # the first start from which the balance up to here is not negative
        if end - first > best[1] - best[0]:
            best = first, end
        at = end
    return best


def _similarity(y: np.ndarray, own: np.ndarray, size: int) -> float:
    """Jaccard similarity of ``own``, a set of ``size`` shingles given by marks, to those of ``y``."""
    other = np.zeros(len(own), bool)
    other[y] = True
    both = int(np.count_nonzero(own & other))
    return both / (size + int(np.count_nonzero(other)) - both)


def verified(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """``(start, end, other_start, other_end, similarity)`` of the similar stretches of two passages.

    A similarity of 0.8 needs four shared shingles for a foreign one on either side, and eight on both sides are enough:
    the longest stretch is tried by each of ``CHARGES``. One that fails is narrowed to what its counterpart shares, or else parted at its widest gap.
    """
    if len(x) == len(y) and (x == y).all():
        if len(x) >= WIDTH:
            yield 0, len(x), 0, len(x), 1.0
        return
    # shingles as numbers below ``kinds``
    both = np.concatenate([x, y])
    order = both.argsort()
    ranked = both[order]
    numbers = np.zeros(len(both), np.int64)
    numbers[order[1:]] = np.cumsum(ranked[1:] != ranked[:-1])
    x, y, kinds = numbers[: len(x)], numbers[len(x) :], int(numbers[order[-1]]) + 1
    there = np.zeros(kinds, bool)
    there[y] = True
    shared, left = _runs(there[x]), [(0, len(x))]
    while left:
        low, high = left.pop()
        if high - low < WIDTH:
            continue
        here = _within(shared, low, high)
        held = mine = None
        for charge in CHARGES:
            a, b = longest_stretch(here, charge)
            if b - a < WIDTH:
                break
            if mine is None or held[:2] != (a, b):
                own = np.zeros(kinds, bool)
                own[x[low + a : low + b]] = True
                mine, size = _runs(own[y]), int(np.count_nonzero(own))
            c, d = longest_stretch(mine, charge)
            if held is None or held[:4] != (a, b, c, d):
                held = a, b, c, d, _similarity(y[c:d], own, size) if d - c >= WIDTH else 0.0
            if held[4] >= SIMILARITY:
                break
        if held is None:
            continue
        a, b, c, d, similarity = held[0] + low, held[1] + low, *held[2:]
        left += [(low, a), (b, high)]
        if similarity >= SIMILARITY:
            yield a, b, c, d, similarity
            continue
        there = np.zeros(kinds, bool)
        there[y[c:d]] = True
        p, q = (a + k for k in longest_stretch(_runs(there[x[a:b]]), CHARGES[-1]))
        if WIDTH <= q - p < b - a:
            left += [(a, p), (p, q), (q, b)]
            continue
        starts, ends = _within(shared, a, b)
        gaps = [start - end for start, end in zip(starts[1:], ends, strict=False)]
        if gaps:
            widest = gaps.index(max(gaps))
            left += [(a, a + ends[widest]), (a + starts[widest + 1], b)]


def _parted(x: np.ndarray, y: np.ndarray, shift: int) -> Iterator[tuple[int, int, int, int, float]]:
    """As ``verified`` of two stretches of one text, ``x`` being ``shift`` places after ``y``, but for passages that have no word in common."""
    beyond = len(y) + SIZE - 1 - shift  # shingles of x that share a word with y
    if beyond <= 0:
        yield from verified(x, y)
        return
    n = min(len(x), len(y))
    same = np.concatenate([[False], x[:n] == y[:n], [False]])
    starts, ends = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(~same[1:] & same[:-1])
    long = ends - starts >= SIZE
    # a text is parted, in places of x, where a run of repeated shingles starts and where the run it repeats has ended
    for at in np.unique(np.concatenate([starts[long], ends[long] - shift + SIZE - 1])).tolist():
        first, stop = max(at, 0), at + shift - SIZE + 1
        if len(x) - first >= WIDTH <= stop:
            for a, b, c, d, similarity in verified(x[first:], y[:stop]):
                yield a + first, b + first, c, d, similarity


#: Results of verified pairs that a task remembers: copies of one passage are held against one representative.
REMEMBERED = 20_000


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The similar passages of stretches that follow, without an ``own_id``, the stretch they are held against."""
    names = ["doc_id", "start_word", "end_word", "source_id", "source_start", "source_end", "similarity"]
    kinds = [pa.int64()] * 6 + [pa.float64()]
    known: dict[bytes, list] = {}
    against, other = None, None
    for batch in batches:
        tokens = batch.column("tokens")
        flat, at = tokens.flatten().to_numpy(zero_copy_only=False), (tokens.offsets.to_numpy() - tokens.offsets[0].as_py()).tolist()
        doc = batch.column("own_id").to_pylist()
        s, rep, t, u = (batch.column(c).to_numpy().tolist() for c in ("s", "rep_id", "rep_s", "rep_e"))
        rows = []
        for i in range(len(doc)):
            own = flat[at[i] : at[i + 1]]
            if doc[i] is None:
                if against != (rep[i], t[i], u[i]):  # else a repeated row
                    against, other, after = (rep[i], t[i], u[i]), own.copy(), own.tobytes()
                continue
            if against != (rep[i], t[i], u[i]):
                continue
            shift = s[i] - t[i] if doc[i] == rep[i] else 0
            pair = b"%d:%d:" % (shift, len(own)) + own.tobytes() + after
            if pair not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[pair] = list(_parted(own, other, shift) if shift else verified(own, other))
            rows += [(doc[i], s[i] + a, s[i] + b + SIZE - 1, rep[i], t[i] + c, t[i] + d + SIZE - 1, similarity) for a, b, c, d, similarity in known[pair]]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _unexplained(live: DataFrame, links: DataFrame) -> DataFrame:
    """The stretches of the groups that still hold unexplained ones, once for each anchor, with the key of both.

    A stretch is explained if a link covers its minimum.
    """
    sides = links.select("doc_id", F.col("start_word").alias("low"), F.col("end_word").alias("high"))
    sides = sides.union(links.select("source_id", "source_start", "source_end")).distinct()
    # spans of a document that touch are one
    along = Window.partitionBy("doc_id").orderBy("low", "high")
    reach = F.max("high").over(along.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("low") <= F.col("reach"), 0).otherwise(1)).over(along.rowsBetween(Window.unboundedPreceding, 0))
    spans = sides.withColumn("reach", reach).withColumn("island", island).groupBy("doc_id", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    spans = spans.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    covers = F.exists("spans", lambda p: (p["low"] <= F.col("c")) & (F.col("c") + SIZE <= p["high"]))
    # the anchors are kept in columns of their own until they are dealt out, as lists are dear to move
    own = [c for c in live.columns if c != "anchors"]
    flat = live.select(*own, *[F.col("anchors")[k].alias(name) for k, name in enumerate(ANCHORED)])
    told = written_once(flat.join(spans, "doc_id", "left").select(*flat.columns, (~F.coalesce(covers, F.lit(False))).alias("open")), "explained")
    some = told.where("open").select("key").distinct()
    near = only_ids(told, F.col("key"), some, "key").join(some, "key", "left_semi")
    near = near.select(*own, "open", F.posexplode(F.array(*ANCHORED)).alias("at", "anchor"))
    return near.withColumn("key", F.xxhash64("key", "at", "anchor")).drop("at", "anchor")


def _stars(live: DataFrame) -> DataFrame:
    """Each stretch beside the two representatives of its key; where ``open`` is given, only of keys that hold an open one."""
    own = F.struct("doc_id", "c", "l", "r", "slack")
    # representatives of the open ones: an explained one is held against them too
    shown = live.where("open") if "open" in live.columns else live
    ends = shown.groupBy("key").agg(F.min(own).alias("low"), F.max(own).alias("high"))
    ends = ends if "open" in live.columns else ends.where("low <> high")
    ends = written_once(ends, "representatives")
    # the representatives are held against each other once
    reps = F.when(F.expr("low = high"), F.array("low")).when(own == F.col("low"), F.array("high")).when(own == F.col("high"), F.expr("slice(array(low), 1, 0)"))
    both = live.join(ends.hint("shuffle_hash"), "key").withColumn("rep", F.explode(reps.otherwise(F.array("low", "high"))))
    slack = F.greatest("slack", "rep.slack").cast("int").alias("slack")
    return both.select("doc_id", *"lcr", slack, F.col("rep.doc_id").alias("rep_id"), *[F.col(f"rep.{p}").alias(f"rep_{p}") for p in "lcr"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ``(doc_id, rep_id, shift, s, e, group)``, sorted by a hash of the first three, those of one offset that touch as one row.

    Only the rows of the last hash wait for what follows: the meetings of two documents at one offset.
    """

    def merged(rows: pa.RecordBatch) -> pa.RecordBatch:
        doc, rep, shift, s, e, group = (c.to_numpy() for c in rows.columns)
        runs = np.concatenate([[0], np.cumsum(group[1:] != group[:-1])])
        order = np.argsort((runs << 32) + s)
        changes = lambda by: (doc[by][1:] != doc[by][:-1]) | (rep[by][1:] != rep[by][:-1]) | (shift[by][1:] != shift[by][:-1])
        new = np.concatenate([[True], changes(order)])
        if np.count_nonzero(new) != runs[-1] + 1:  # two offsets of one hash
            order = np.lexsort((s, shift, rep, doc))
            new[1:] = changes(order)
        offset = np.cumsum(new) << 32  # the furthest end so far, by offset
        reach = np.maximum.accumulate(offset + e[order]) - offset
        new[1:] |= s[order][1:] > reach[:-1]
        first = np.flatnonzero(new)
        ends = reach[np.append(first[1:], len(s)) - 1].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(c[order[first]]) for c in (doc, rep, shift, s)] + [pa.array(ends)], rows.schema.names[:5])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        group = batch.column("group").to_numpy()
        if not len(group):
            continue
        if waiting and group[0] != waiting[-1].column("group")[-1].as_py():
            yield merged(pa.concat_batches(waiting))
            waiting = []
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield merged(pa.concat_batches([*waiting, batch.slice(0, last)]))
            waiting = []
        waiting.append(batch.slice(last))
    if waiting:
        yield merged(pa.concat_batches(waiting))


def _links(source: DataFrame, both: DataFrame) -> DataFrame:
    """The verified passages among pairs of windows."""
    apart = (F.col("doc_id") != F.col("rep_id")) | (F.abs(F.expr("c - rep_c")) >= APART)
    # with slack, the place that is met may be another one than the place aligned to
    before = F.least("c", "rep_c", F.least(F.expr("c - l"), F.expr("rep_c - rep_l")) + F.col("slack"))
    after = F.least(F.expr("r - c"), F.expr("rep_r - rep_c")) + F.col("slack")
    meets = both.where(apart).select("doc_id", "rep_id", F.expr("c - rep_c").alias("shift"), (F.col("c") - before).alias("s"), (F.col("c") + after).alias("e"))
    meets = meets.where((F.col("e") - F.col("s") + 1 >= WIDTH) & ((F.col("doc_id") != F.col("rep_id")) | (F.col("shift") != 0)))
    # each pair of documents once, as (larger id, smaller id)
    turned = (F.col("doc_id") < F.col("rep_id")) | ((F.col("doc_id") == F.col("rep_id")) & (F.col("shift") < 0))
    either = lambda yes, no: F.when(turned, yes).otherwise(no)
    back = [(F.col(p) - F.col("shift"), F.col(p)) for p in ("s", "e")]
    sides = [either(F.col("rep_id"), F.col("doc_id")).alias("doc_id"), either(F.col("doc_id"), F.col("rep_id")).alias("rep_id"), either(-F.col("shift"), F.col("shift")).alias("shift")]
    meets = meets.select(*sides, *[either(*pair).alias(p) for p, pair in zip(("s", "e"), back, strict=True)])
    # one column sorts faster than five, and the meetings of an offset are few
    along = ["doc_id", "rep_id", "shift"]
    sorted_meets = meets.repartition(*along).withColumn("group", F.xxhash64(*along)).sortWithinPartitions("group")
    stretches = sorted_meets.mapInArrow(_merged, "doc_id long, rep_id long, shift int, s int, e int")
    found = written_once(stretches.select("doc_id", "rep_id", "s", "e", (F.col("s") - F.col("shift")).alias("rep_s"), (F.col("e") - F.col("shift")).alias("rep_e")), "stretches")

    # texts are moved and cut once for the requests of both sides: those of the larger id name it, and meet at what they are held against
    ids = found.select("doc_id").union(found.select("rep_id"))
    some = only_ids(source, F.col("doc_id"), ids, "doc_id")
    against = [F.col(c) for c in ("rep_id", "rep_s", "rep_e")]
    asked = found.select("doc_id", F.struct("s", "e", *against, F.col("doc_id").alias("own_id")).alias("request"))
    asked = asked.union(found.select("rep_id", F.struct(F.col("rep_s").alias("s"), F.col("rep_e").alias("e"), *against, F.lit(None).cast("long").alias("own_id"))))
    asked = asked.groupBy("doc_id").agg(F.collect_set("request").alias("wanted"))  # as many as a document has stretches
    kinds = "s int, e int, rep_id long, rep_s int, rep_e int, own_id long"
    cut = some.join(asked.hint("merge"), "doc_id").select("text", "wanted").mapInArrow(_slices, f"{kinds}, tokens array<int>")
    met = cut.drop("e").repartition(*against).sortWithinPartitions(*against, "own_id")  # null, the side held against, comes first
    names = "doc_id long, start_word long, end_word long, source_id long, source_start long, source_end long, similarity double"
    return met.mapInArrow(_verify, names).distinct()


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, start_word, end_word, source_id, source_start, source_end, similarity)``: passages, in words from 0 with
    the end exclusive, that nearly repeat a passage of ``source_id``, a document with a smaller id or the same one."""
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).where("doc_id is not null and text is not null")
    counted = source.select("text").mapInArrow(_keys, "key long").groupBy("key").agg(F.count("*").alias("n"))
    # of a group of up to three, the representatives are held against every other one, so larger ones only are looked at again
    met = written_once(counted.where("n > 1").select("key", (F.col("n") > 3).alias("large")), "repeated-keys")
    windows = source.mapInArrow(_windows(_key_filter(met)), "key long, doc_id long, l int, c int, r int, slack byte, " + ", ".join(f"{c} int" for c in ANCHORED))
    live = written_once(windows.join(met.hint("shuffle_hash"), "key"), "windows")
    links = written_once(_links(source, _stars(live.drop(*ANCHORED, "large"))), "links")
    large = live.where("large").withColumn("anchors", F.array(*ANCHORED)).drop(*ANCHORED, "large")
    return links.union(_links(source, _stars(_unexplained(large, links)))).distinct()
