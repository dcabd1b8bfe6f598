"""Phrase collocation mining by best-first branch and bound.

Phrases of two to four words grow from their prefixes. A prefix ``p`` that begins with the word ``w`` bounds whatever grows from
it: such a phrase occurs ``f(p)`` times at most, and its cut after ``w`` has parts that occur ``f(w)`` times and as often as
the phrase itself at least, so its score is at most ``2000000 * f(p) / (f(w) + f(p))``. Longer prefixes have lower bounds.

All words and all pairs of frequent words are counted. Then the frontier opens from the best bounds down: in
each round all prefixes whose bound reaches a language's threshold are grown, and all one-word extensions, on either
side, of phrases whose score reaches it are counted, as they decide which of these survive. A language is settled when as many survivors
as asked for reach its threshold: whatever has not been opened scores less than that. Else its threshold falls to a
score four times as deep among its pairs, and in the end to nothing, which opens all.

Three passes read the texts: words, pairs, and the stretches in which each pair of neighbours is frequent. All rounds read the
stretches only. Filters of fixed size decide which windows are counted; they depend on the
phrase alone, so each phrase is counted wholly or not at all. Words are known by hashes of 64 bits with their language.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count each; ids are not used; an
empty table gives no rows; other columns are ignored; ties at the end of a list are broken by count and phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harborline.llm import words as W
from harborline.session import written_once

LEAST, TOP, SIZE = 30, 2000, 4
SCALE = 2_000_000
#: Bits of a filter of keys (2 ** 23 bits, 1 MB): fixed, whatever the corpus. Fuller filters only let more pass.
FILTER_BITS = 23
#: Bytes of text of one step: words and pairs are counted within a step before they leave the task.
STEP_BYTES = 4 << 20

U = np.uint64
_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _BLANK | _BREAK
_VALUES = W.byte_values(_OUTSIDE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_TIMES = W.randoms(SIZE, 31)


def joint(keys: np.ndarray, size: int) -> np.ndarray:
    """One key for each run of ``size`` keys, by the place of its first."""
    total = np.zeros(max(len(keys) - size + 1, 0), U)
    for i in range(size):
        total += keys[i : i + len(total)] * _TIMES[i]
    return W.mix(total + U(size))


class Keys:
    """A set of 64-bit keys that may let other keys pass, but always the same ones."""

    def __init__(self, frame: DataFrame, key: str):
        bit = F.shiftrightunsigned(F.col(key), 64 - FILTER_BITS)
        one = F.expr("shiftleft(1L, cast(_bit % 64 as int))")
        rows = frame.select(bit.alias("_bit")).groupBy(F.expr("_bit div 64").alias("at")).agg(F.bit_or(one).alias("bits")).collect()  # 2 ** 17 at most
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        self.bits[[r["at"] for r in rows]] = [r["bits"] for r in rows]
        self.bits = self.bits.view(U)

    def has(self, keys: np.ndarray) -> np.ndarray:
        bit = keys >> U(64 - FILTER_BITS)
        return (self.bits[(bit >> U(6)).astype(np.int64)] >> (bit & U(63)) & U(1)).astype(bool)


def _words(part: pa.RecordBatch):
    """Bytes, starts, ends, rows and keys of all words, and which of them follow another one in the same piece."""
    data, at = W.utf8(part.column("text"))
    starts, ends, rows = W.spans(data, at, ~_OUTSIDE[data])
    language = W.mix(part.column("lang_key").to_numpy().view(U))
    keys = W.mix(W.span_hashes(data, starts, ends, _VALUES) + language[rows])
    piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts)
    follows = np.zeros(len(starts), bool)
    follows[1:] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
    return data, starts, ends, rows, keys, follows


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from W.steps(batch, "text", STEP_BYTES)


def _longs(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(W.signed(np.asarray(c).astype(U))) for c in columns], names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang_key, k, c)`` by step; the row of a language with no ``k`` counts all its words."""
    for part in _steps(batches):
        *_, rows, keys, _ = _words(part)
        language = part.column("lang_key").to_numpy()
        unique, first, counts = np.unique(keys, return_index=True, return_counts=True)
        langs, at = np.unique(language, return_inverse=True)
        totals = np.bincount(at[rows], minlength=len(langs))
        own = pa.array(np.concatenate([W.signed(unique), np.zeros(len(langs), np.int64)]), mask=np.repeat([False, True], [len(unique), len(langs)]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([language[rows[first]], langs])), own, pa.array(np.concatenate([counts, totals]))], ["lang_key", "k", "c"])


def _count_pairs(frequent: Keys):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _steps(batches):
            *_, keys, follows = _words(part)
            known = frequent.has(keys)
            at = np.flatnonzero(follows[1:] & known[1:] & known[:-1])
            _, first, counts = np.unique(joint(keys, 2)[at], return_index=True, return_counts=True)
            yield _longs(["k1", "k2", "c"], [keys[at[first]], keys[at[first] + 1], counts])

    return run


def _stretches(pairs: Keys):
    """Rows ``(run)``: keys of three words or more, each pair frequent; rows ``(k, lang, word)``: the words of frequent pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _steps(batches):
            data, starts, ends, rows, keys, follows = _words(part)
            bound = follows.copy()
            bound[1:] &= pairs.has(joint(keys, 2)) if len(keys) > 1 else False
            heads = np.flatnonzero(~bound)
            lengths = np.diff(np.append(heads, len(keys)))
            kept = np.repeat(lengths >= 3, lengths)
            inside = keys[kept]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths[lengths >= 3])]), pa.int32()), pa.array(W.signed(inside)))
            said = np.flatnonzero(np.repeat(lengths >= 2, lengths))
            unique, first = np.unique(keys[said], return_index=True)
            at = said[first]
            texts = [_LOWER[data[starts[i] : ends[i]]].tobytes().decode() for i in at]
            langs = part.column("lang").take(pa.array(rows[at]))
            n, m = len(lists), len(unique)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([lists, pa.nulls(m, lists.type)]), pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(W.signed(unique))]), pa.concat_arrays([pa.nulls(n, pa.string()), langs.cast(pa.string())]), pa.array([None] * n + texts, pa.string())],
                ["run", "k", "lang", "word"],
            )

    return run


class Rule:
    """Which windows to count: by the key of their prefix, of their suffix, or of themselves."""

    def __init__(self, prefix: Keys | None = None, suffix: Keys | None = None, own: Keys | None = None):
        self.prefix, self.suffix, self.own = prefix, suffix, own

    def wants(self, shorter: np.ndarray, whole: np.ndarray) -> np.ndarray:
        wanted = np.zeros(len(whole), bool)
        for keys, values in ((self.prefix, shorter[: len(whole)]), (self.suffix, shorter[1 : len(whole) + 1]), (self.own, whole)):
            if keys is not None:
                wanted |= keys.has(values)
        return wanted


def _count_windows(size: int, rule: Rule, before: list[Rule]):
    """Counts of the windows of ``size`` words that ``rule`` wants and no earlier rule has counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("run")
            lengths = np.diff(runs.offsets.to_numpy())
            keys = runs.flatten().to_numpy().view(U)
            whole = joint(keys, size)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            fits = (place + size <= np.repeat(lengths, lengths))[: len(whole)]
            shorter = joint(keys, size - 1)
            fits &= rule.wants(shorter, whole)
            for earlier in before:
                fits &= ~earlier.wants(shorter, whole)
            at = np.flatnonzero(fits)
            _, first, counts = np.unique(whole[at], return_index=True, return_counts=True)
            yield _longs([*_names(size), "c"], [*[keys[at[first] + i] for i in range(size)], counts])

    return run


def _names(size: int) -> list[str]:
    return [f"k{i}" for i in range(1, size + 1)]


def _with_key(frame: DataFrame, names: list[str], key: str) -> DataFrame:
    """``frame`` with the joint key of the given key columns."""
    fields = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = sum((batch.column(n).to_numpy().view(U) * t for n, t in zip(names, _TIMES, strict=False)), np.zeros(batch.num_rows, U))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(W.signed(W.mix(total + U(len(names)))))], [*fields, key])

    return frame.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields) + f", `{key}` long")


def _score(a: Column, left: Column, right: Column) -> Column:
    """``floor(SCALE * a / (left + right))`` in exact decimals."""
    a, left, right = (c.cast("decimal(19,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * a, left + right)


class Miner:
    """The counts found so far, and the rounds that add to them."""

    def __init__(self, docs: DataFrame, least: int, top: int):
        self.least, self.top = least, top
        lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
        source = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_key"), F.col("text").cast("string").alias("text"))
        hashed = source.select("lang_key", "text")
        enough = F.col("f") >= least
        counted = hashed.mapInArrow(_count_words, "lang_key long, k long, c long").groupBy("lang_key", "k").agg(F.sum("c").alias("f"))
        counted = written_once(counted.where(enough | F.col("k").isNull()), "words")
        self.totals = counted.where("k is null").select("lang_key", F.col("f").alias("n"))
        self.words = counted.where("k is not null")

        pairs = hashed.mapInArrow(_count_pairs(Keys(self.words, "k")), "k1 long, k2 long, c long")
        pairs = written_once(pairs.groupBy("k1", "k2").agg(F.sum("c").alias("f")).where(enough), "pairs")
        one = lambda i, count: self.words.select(F.col("k").alias(f"k{i}"), F.col("f").alias(count), *(["lang_key"] if i == 1 else []))
        scored = pairs.join(one(1, "head"), "k1").join(one(2, "r"), "k2").select("lang_key", "k1", "k2", F.col("f").alias("a"), "head", F.col("head").alias("l"), "r")
        self.found = {2: self._kept(scored.select("*", _score(F.col("a"), F.col("l"), F.col("r")).alias("score")), 2)}
        self.rules: dict[int, list[Rule]] = {3: [], 4: []}
        self.counted4: DataFrame | None = None

        split = source.mapInArrow(_stretches(Keys(self.found[2], "g")), "run array<long>, k long, lang string, word string")
        split = written_once(split, "stretches")
        self.runs = split.where("run is not null").select("run")
        self.names = written_once(split.where("k is not null").select("k", "lang", "word").distinct(), "phrase-words")

    def _kept(self, scored: DataFrame, size: int) -> DataFrame:
        """Phrases with their key and the bound of all that grows from them."""
        return written_once(_with_key(scored.select("*", _score(F.col("a"), F.col("head"), F.col("a")).alias("bound")), _names(size), "g"), f"phrases-{size}")

    def _counted(self, size: int, rule: Rule) -> DataFrame:
        names = _names(size)
        rows = self.runs.mapInArrow(_count_windows(size, rule, list(self.rules[size])), ", ".join(f"{c} long" for c in (*names, "c")))
        self.rules[size].append(rule)
        return written_once(rows.groupBy(*names).agg(F.sum("c").alias("a")).where(F.col("a") >= self.least), f"counts-{size}")

    def _part(self, size: int, first: int, count: str) -> DataFrame:
        """Counts of phrases of ``size`` words, their words named from ``first`` on."""
        if size == 1:
            return self.words.select(F.col("k").alias(f"k{first}"), F.col("f").alias(count))
        return self.found[size].select(*[F.col(n).alias(f"k{first + i}") for i, n in enumerate(_names(size))], F.col("a").alias(count))

    def _add(self, size: int, counted: DataFrame) -> None:
        """Score counted phrases by their lowest cut, the first of equal ones, and keep them."""
        names, frame = _names(size), counted
        for k in range(1, size):
            frame = frame.join(self._part(k, 1, f"l{k}"), names[:k]).join(self._part(size - k, k + 1, f"r{k}"), names[k:])
        langs = self.words.select(F.col("k").alias("k1"), "lang_key")
        cuts = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in range(1, size)]
        low = F.array_min(F.array(*cuts)).alias("low")
        frame = frame.join(langs, "k1").select("lang_key", *names, "a", F.col("l1").alias("head"), low)
        new = self._kept(frame.select("lang_key", *names, "a", "head", "low.l", "low.r", "low.score"), size)
        self.found[size] = self.found[size].union(new) if size in self.found else new

    def _above(self, size: int, goals: DataFrame, column: str) -> DataFrame:
        return self.found[size].join(goals, "lang_key").where(F.col(column) >= F.col("goal"))

    def grow(self, goals: DataFrame) -> None:
        """Open all prefixes whose bound reaches ``goal``, and count the neighbours of phrases whose score does."""
        opened = lambda size: Rule(Keys(self._above(size, goals, "bound"), "g"), Keys(self._above(size, goals, "score"), "g"))
        self._add(3, self._counted(3, opened(2)))
        longer = self._counted(4, opened(3))
        # a four-word phrase that was met as a neighbour only scores less than the goal; of the others, the last three words must be counted too
        grown = longer.join(self._part(3, 1, "l3"), ["k1", "k2", "k3"])
        missing = grown.select(*[F.col(f"k{i + 1}").alias(f"k{i}") for i in (1, 2, 3)]).join(self._part(3, 1, "known"), ["k1", "k2", "k3"], "left_anti").distinct()
        missing = written_once(_with_key(missing, _names(3), "g"), "missing-parts")
        if not missing.isEmpty():
            self._add(3, self._counted(3, Rule(own=Keys(missing, "g"))))
        self.counted4 = longer if self.counted4 is None else self.counted4.union(longer)
        self._add(4, grown.drop("l3"))

    def survivors(self, goals: DataFrame) -> DataFrame:
        """Phrases whose score reaches the goal and that no phrase one word longer accounts for.

        Whatever is longer by two words holds one that is longer by one and at least as frequent.
        """
        out = []
        for size in (2, 3, 4):
            names = _names(size)
            own = self._above(size, goals, "score").select("lang_key", *names, "a", "l", "r", "score")
            if size < SIZE:
                longer = self.found[3].select(*_names(3), "a") if size == 2 else self.counted4
                ends = [longer.select(*[F.col(f"k{i + d}").alias(f"k{i}") for i in range(1, size + 1)], F.col("a").alias("more")) for d in (0, 1)]
                most = ends[0].union(ends[1]).groupBy(*names).agg(F.max("more").alias("more"))
                lost = F.col("more").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * 80
                own = own.join(most, names, "left").where(~F.coalesce(lost, F.lit(False))).drop("more")
            missing = [F.lit(None).cast("long").alias(n) for n in _names(SIZE)[size:]]
            out.append(own.select("lang_key", *names, *missing, "a", "l", "r", "score"))
        return reduce(DataFrame.union, out)


def _goals(pairs: DataFrame, langs: DataFrame, rank: int) -> DataFrame:
    """``(lang_key, goal)``: the score of the ``rank``-th pair of each language, or -1 where there are fewer."""
    by = Window.partitionBy("lang_key").orderBy(F.desc("score"))
    at = pairs.select("lang_key", "score", F.row_number().over(by).alias("place")).where(F.col("place") <= rank).where(F.col("place") == rank)
    return langs.join(at.select("lang_key", F.col("score").alias("goal")), "lang_key", "left").select("lang_key", F.coalesce("goal", F.lit(-1).cast("long")).alias("goal"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` surviving phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    miner = Miner(docs, least, top)
    langs, settled, rank = miner.totals.select("lang_key"), [], 2 * top
    while True:
        goals = written_once(_goals(miner.found[2], langs, rank), "goals")
        miner.grow(goals)
        alive = written_once(miner.survivors(goals), "survivors")
        reached = goals.join(alive.groupBy("lang_key").agg(F.count("*").alias("c")), "lang_key", "left")
        reached = written_once(reached.select("lang_key", (F.coalesce(F.col("c") >= top, F.lit(False)) | (F.col("goal") < 0)).alias("done")), "settled")
        settled.append(alive.join(reached.where("done"), "lang_key", "left_semi"))
        langs = reached.where("not done").select("lang_key")
        if langs.isEmpty():
            break
        rank *= 4
    found = reduce(DataFrame.union, settled)
    for i, name in enumerate(_names(SIZE), 1):
        words = miner.names.select(F.col("k").alias(name), F.col("word").alias(f"w{i}"), *([F.col("lang")] if i == 1 else []))
        found = found.join(words, name, "left" if i > 2 else "inner")
    found = found.join(miner.totals, "lang_key").select("lang", F.concat_ws(" ", "w1", "w2", "w3", "w4").alias("phrase"), "a", "l", "r", "n", "score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.select("lang", F.row_number().over(best).cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(p, '[\x20\t]+'), lambda x: x <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS p FROM documents)),
counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
    FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(ws) >= size)
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE size > 1 AND f >= 30),
cuts AS (
  SELECT c.*, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, a, array_to_string(ws[i:j], ' ') AS phrase FROM (
    SELECT *, unnest(range(1, size + 1)) AS i FROM candidates WHERE size > 2), (SELECT unnest([2, 3, 4]) AS j) WHERE j > i AND j <= size AND j - i + 1 < size),
longest AS (SELECT lang, phrase, max(a) AS more FROM inside GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, o.phrase) AS rank, o.phrase, a, l, r, score
  FROM lowest o LEFT JOIN longest g ON g.lang = o.lang AND g.phrase = o.phrase WHERE coalesce(100 * more < 80 * a, true))
JOIN totals USING (lang) WHERE rank <= 2000
"""
