"""Conversation prefix trie by composable fingerprints.

Each conversation is rebuilt from the head of a base conversation and its own later turns; the distinct prefixes of
the rebuilt sequences are the nodes of a trie. No rebuilt text is ever made. A sequence of turns has the fingerprint
``(n, sum of x[i] * g ** i)``, four residues of 31 bits, and two of them compose as a monoid:
``(n, s) * (m, t) = (n + m, s + g ** n * t)``. So

* a conversation's running fingerprints come from a range partitioning by conversation and turn: each task
  scans its stretches, and the stretches of one conversation compose by a window over one row for each task it
  lies in, which splits a conversation of any length;
* the fingerprint of a rebuilt prefix is the head's, composed with the difference of two own prefixes, shifted by
  the difference of the head's length and what was cut off.

Groups of equal fingerprints are verified. A turn is known by a hash of 128 bits, and of all hashes that
occur twice the stored texts are compared. A node is grouped by its own fingerprint, its parent's and the turn between
them, so members of a node have equal turns all the way up, if and only if no fingerprint has two such groups. Should
either test fail, other multipliers are taken.

Subtree sums need no walk over levels. The smallest member of a node is the smallest member of one of its nodes at each
greater depth, so each conversation owns its path from some depth on. The leaves below a node are the members
that own a leaf; the saved words below it are, summed over its members, the words from its depth down to where
that member's own path begins.

Defined results: turns are ordered by turn (null first), then role and text hash; null roles and texts are empty; rows without a
conversation id are left out; repeated rows are turns of their own; turnless rebuilt conversations are members of the root; an empty
table gives no rows; other columns are ignored. Remainders of negative ids follow the sign of the id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harborline.llm.tables import only_ids
from harborline.session import written_once

#: Conversations of one block of this many ids share its first one as their base.
BLOCK = 20
#: Heads have 0 to ``HEADS - 1`` turns.
HEADS = 4
# Fixed values: the four largest primes below 2 ** 31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
LANES = tuple(f"s{i}" for i in range(len(PRIMES)))
#: Ids that one piece of an end list holds.
PIECE_IDS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def _generators(seed: int) -> list[int]:
    return [int.from_bytes(hashlib.sha256(f"{seed}:{i}".encode()).digest()[:8], "big") % (p - 3) + 2 for i, p in enumerate(PRIMES)]


def _powers(g: int, p: int, n: np.ndarray) -> np.ndarray:
    """``g ** n mod p`` for each n of 0 or more."""
    out, base, n = np.ones(len(n), np.uint64), np.uint64(g), n.astype(np.uint64)
    while n.any():
        out = np.where(n & np.uint64(1), out * base % np.uint64(p), out)
        base = base * base % np.uint64(p)
        n = n >> np.uint64(1)
    return out


_OWN = ["part", "conv_id", "t1", "t2", "words"]
_PREV = tuple(f"p{i}" for i in range(len(PRIMES)))


def _scan(seed: int):
    """Running counts, words and fingerprints of each conversation in a sorted partition; a row with ``total`` ends each stretch.

    ``s*`` are the residues with the turn of the row, ``p*`` those before it.
    """
    gs = _generators(seed)
    names = [*_OWN, "n", "w", *LANES, *_PREV, "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = None, None, np.zeros(2 + len(PRIMES), np.int64)

        def totals(convs: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            none = pa.nulls(len(convs), pa.int64())
            columns = [pa.array(np.full(len(convs), part), pa.int32()), pa.array(convs), none, none, none, *[pa.array(v) for v in values], *[none] * len(_PREV), pa.array(np.ones(len(convs), bool))]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            part = batch.column("part")[0].as_py()
            conv = batch.column("conv_id").to_numpy()
            if last is not None and last != conv[0]:
                yield totals(np.array([last]), carried[:, None])
            if last != conv[0]:
                carried = np.zeros_like(carried)
            begins = np.concatenate([[0], np.flatnonzero(conv[1:] != conv[:-1]) + 1])
            lengths = np.diff(np.append(begins, len(conv)))
            start = np.repeat(begins, lengths)

            def running(values: np.ndarray, before: int, start=start, own=int(lengths[0])) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(values)])
                out = total[1:] - total[start]
                out[:own] += before
                return out

            n = running(np.ones(len(conv), np.int64), carried[0])
            w = running(batch.column("words").to_numpy(), carried[1])
            lanes, before = [], []
            for i, (g, p) in enumerate(zip(gs, PRIMES, strict=True)):
                half = batch.column(("t1", "t2")[i // 2]).to_numpy().view(np.uint64) >> np.uint64(32 * (i % 2)) & np.uint64(0xFFFFFFFF)
                x = (half % np.uint64(p) * _powers(g, p, n - 1) % np.uint64(p)).astype(np.int64)
                lanes.append(running(x, carried[2 + i]) % p)
                before.append((lanes[-1] - x) % p)
            ends = begins + lengths - 1
            state = np.stack([v[ends] for v in (n, w, *lanes)])
            if len(begins) > 1:
                yield totals(conv[begins[:-1]], state[:, :-1])
            last, carried = conv[-1], state[:, -1].copy()
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _OWN], *[pa.array(v) for v in (n, w, *lanes, *before)], pa.array(np.zeros(len(conv), bool))], names)
        if last is not None:
            yield totals(np.array([last]), carried[:, None])

    return run


def _power(g: int, p: int, n: Column) -> Column:
    """``g ** n mod p``, from the bits of ``n``."""
    squares = F.array(*[F.lit(pow(g, 1 << i, p)).cast("long") for i in range(63)])
    step = lambda acc, i: F.when(F.getbit(n, i) == 1, acc * F.get(squares, i) % p).otherwise(acc)  # noqa: E731
    return F.when(n == 0, F.lit(1).cast("long")).otherwise(F.aggregate(F.sequence(F.lit(0), F.lit(62)), F.lit(1).cast("long"), step))


def _packed(lanes: list[Column]) -> list[Column]:
    """Four residues of 31 bits as two bigints."""
    return [F.shiftleft(lanes[i], 31).bitwiseOR(lanes[i + 1]) for i in range(0, len(lanes), 2)]


def _turns(turns: DataFrame, seed: int) -> DataFrame:
    """``conv_id, turn, role, text`` without nulls but in ``turn``, the hashes ``t1, t2`` of role and text, and the words of the text."""
    own = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).where("conv_id is not null")
    hashes = [F.xxhash64(F.lit(2 * seed + i), "role", "text").alias(f"t{i + 1}") for i in range(2)]
    return own.select("*", *hashes, F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))


def _unlike_texts(own: DataFrame, scanned: DataFrame) -> bool:
    """Whether turns of one hash differ: of hashes that occur twice, all roles and texts are compared."""
    twice = written_once(scanned.groupBy("t1", "t2").agg(F.count("*").alias("c")).where("c > 1").select("t1"), "repeated-turns")
    some = only_ids(own.select("t1", "t2", "role", "text"), F.col("t1"), twice, "t1")
    ends = [f(c).alias(f"{a}_{c}") for c in ("role", "text") for a, f in (("least", F.min), ("most", F.max))]
    return not some.groupBy("t1", "t2").agg(*ends).where("least_role <> most_role or least_text <> most_text").isEmpty()


def _placed(scanned: DataFrame, gs: list[int]) -> DataFrame:
    """One row for each conversation and task: what the conversation's earlier stretches compose to (``off_*``)."""
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))  # noqa: E731
    stretches = scanned.where("total").select("conv_id", "part", "n", "w", *LANES)
    counted = stretches.select("*", zero(F.sum("n").over(earlier)).alias("off_n"), zero(F.sum("w").over(earlier)).alias("off_w"), F.sum("n").over(whole).alias("len"), F.sum("w").over(whole).alias("all_w"))
    times = counted.select("*", *[_power(g, p, F.col("off_n")).alias(f"g{i}") for i, (g, p) in enumerate(zip(gs, PRIMES, strict=True))])
    moved = [(F.col(f"g{i}") * F.col(f"s{i}") % p).alias(f"m{i}") for i, p in enumerate(PRIMES)]
    sums = [(zero(F.sum(f"m{i}").over(earlier)) % p).alias(f"off_s{i}") for i, p in enumerate(PRIMES)]
    return times.select("*", *moved).select("conv_id", "part", "off_n", "off_w", "len", "all_w", *[f"g{i}" for i in range(len(PRIMES))], *sums)


def _whole(kind: str) -> list[Column]:
    """Residues from the start of the conversation, from those of a stretch and what stands before it."""
    return [(F.col(f"off_s{i}") + F.col(f"g{i}") * F.col(f"{kind}{i}")) % p for i, p in enumerate(PRIMES)]


def _rebuilt(scanned: DataFrame, placed: DataFrame, gs: list[int]) -> tuple[DataFrame, DataFrame]:
    """Conversations with their length and words; and a row for each rebuilt prefix: node, parent and turn, nothing of the texts."""
    lanes = range(len(PRIMES))
    own_turns = scanned.where("not total")
    early = own_turns.where(F.col("n") < HEADS).join(placed, ["conv_id", "part"]).where(F.col("off_n") + F.col("n") < HEADS)
    first = F.struct((F.col("off_n") + F.col("n")).alias("pos"), "t1", "t2", "words", (F.col("off_w") + F.col("w")).alias("w"), F.array(*_whole("s")).alias("s"), F.array(*_whole("p")).alias("p"))
    heads = early.groupBy("conv_id").agg(F.array_sort(F.collect_list(first)).alias("heads"))  # HEADS - 1 turns at most

    convs = placed.groupBy("conv_id").agg(F.max("len").alias("len"), F.max("all_w").alias("all_w"))
    convs = convs.select("*", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    own = heads.select("conv_id", F.col("heads").alias("own_heads"))
    lent = heads.select(F.col("conv_id").alias("base"), F.col("heads").alias("base_heads"))
    joined = convs.join(own, "conv_id", "left").join(lent, "base", "left")
    taken = F.slice(F.coalesce("base_heads", F.expr("slice(own_heads, 1, 0)")), 1, F.col("h"))
    at = lambda heads, i, field: F.get(F.col(heads), i)[field]  # noqa: E731
    nothing = F.array(*[F.lit(0).cast("long") for _ in lanes])
    zero = F.lit(0).cast("long")
    info = joined.select("conv_id", "len", "all_w", "h", "own_heads", taken.alias("taken")).select("*", F.size("taken").alias("hb"))
    info = info.select(
        "conv_id",
        "h",
        "hb",
        "taken",
        (F.col("hb") + F.greatest(F.col("len") - F.col("h"), zero)).alias("depth"),
        F.coalesce(at("taken", F.col("hb") - 1, "s"), nothing).alias("base_s"),
        F.coalesce(at("taken", F.col("hb") - 1, "w"), zero).alias("base_w"),
        F.coalesce(at("own_heads", F.col("h") - 1, "s"), nothing).alias("cut_s"),
        F.coalesce(at("own_heads", F.col("h") - 1, "w"), zero).alias("cut_w"),
        F.col("len"),
        F.col("all_w"),
    )
    info = info.select("*", (F.col("base_w") + F.when(F.col("len") > F.col("h"), F.col("all_w") - F.col("cut_w")).otherwise(zero)).alias("rebuilt_w"))
    info = written_once(info, "rebuilt-conversations")

    ended = lambda d: (d == F.col("depth")).alias("ended")  # noqa: E731
    roots = info.select("conv_id", F.lit(-1).alias("part"), zero.alias("d"), *[zero.alias(c) for c in ("k1", "k2", "p1", "p2", "t1", "t2", "words", "w")], ended(zero))
    names = roots.columns
    x = F.col("x")
    packed = lambda own, parent: [c.alias(n) for c, n in zip([*_packed(own), *_packed(parent)], ("k1", "k2", "p1", "p2"), strict=True)]  # noqa: E731
    lent_rows = info.select("conv_id", "depth", F.explode("taken").alias("x")).select(
        "conv_id", F.lit(-1).alias("part"), x["pos"].alias("d"), *packed([x["s"][i] for i in lanes], [x["p"][i] for i in lanes]), *[x[c].alias(c) for c in ("t1", "t2", "words", "w")], ended(x["pos"])
    )
    later = own_turns.join(placed.join(info.drop("len", "all_w", "taken"), "conv_id"), ["conv_id", "part"]).select("*", (F.col("off_n") + F.col("n")).alias("pos")).where("pos > h")
    back = [F.get(F.array(*[F.lit(pow(g, -k, p)).cast("long") for k in range(HEADS)]), F.col("h") - F.col("hb")) for g, p in zip(gs, PRIMES, strict=True)]
    joint = lambda kind: [(F.col("base_s")[i] + back[i] * F.pmod(s - F.col("cut_s")[i], F.lit(p))) % p for i, (s, p) in enumerate(zip(_whole(kind), PRIMES, strict=True))]  # noqa: E731
    depth = F.col("pos") - F.col("h") + F.col("hb")
    own_rows = later.select("conv_id", "part", depth.alias("d"), *packed(joint("s"), joint("p")), "t1", "t2", "words", (F.col("base_w") + F.col("off_w") + F.col("w") - F.col("cut_w")).alias("w"), ended(depth))
    return info, roots.union(lent_rows).union(own_rows).select(names)


def _end_lists(prefixes: DataFrame) -> DataFrame:
    """``(d, k1, k2, ends_sha256)`` of the nodes at which conversations end.

    Ids are joined to pieces where they lie sorted, so the task that digests a node of very many reads its pieces only.
    """
    key = ["d", "k1", "k2"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in (*key, "conv_id")]
            if not len(columns[0]):
                continue
            new = np.ones(len(columns[0]), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0)
            runs = np.append(np.flatnonzero(new), len(new))
            at = np.concatenate([np.arange(a, b, PIECE_IDS) for a, b in zip(runs[:-1], runs[1:], strict=True)])
            stop = np.append(at[1:], len(new))
            texts = [",".join(map(str, columns[3][a:b].tolist())) for a, b in zip(at, stop, strict=True)]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[at]) for c in columns], pa.array(texts, pa.string())], [*key, "least", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for *own, piece in zip(*[batch.column(c).to_pylist() for c in (*key, "piece")], strict=True):
                if own == last:
                    state.update(b"," + piece.encode())
                    continue
                if last is not None:
                    out.append((*last, state.hexdigest()))
                last, state = own, hashlib.sha256(piece.encode())
            yield _digest_rows(out)
        if last is not None:
            yield _digest_rows([(*last, state.hexdigest())])

    def _digest_rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], [*key, "ends_sha256"])

    ends = prefixes.where("ended").select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id")
    cut = ends.mapInArrow(pieces, "d long, k1 long, k2 long, least long, piece string")
    return cut.repartition(*key).sortWithinPartitions(*key, "least").mapInArrow(digests, "d long, k1 long, k2 long, ends_sha256 string")


def trie(turns: DataFrame) -> DataFrame:
    """One row for each distinct prefix: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_ends``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and the node's fingerprint ``k1, k2``."""
    seed = 0
    while True:
        found = _trie(turns, seed)
        if found is not None:
            return found
        seed += 1


def _trie(turns: DataFrame, seed: int) -> DataFrame | None:
    gs, key = _generators(seed), ["d", "k1", "k2"]
    own = _turns(turns, seed)
    order = ["conv_id", "turn", "role", "t1", "t2"]
    ranged = own.select(*order, "words").repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "t1", "t2", "words", F.spark_partition_id().alias("part"))
    kinds = ", ".join(f"{c} long" for c in ("conv_id", "t1", "t2", "words", "n", "w", *LANES, *_PREV))
    scanned = written_once(ranged.mapInArrow(_scan(seed), f"part int, {kinds}, total boolean"), "running-turns")
    if _unlike_texts(own, scanned.where("not total")):
        return None
    placed = written_once(_placed(scanned, gs), "stretches")
    info, prefixes = _rebuilt(scanned, placed, gs)
    prefixes = written_once(prefixes, "prefixes")

    ended = F.col("ended").cast("long")
    nodes = prefixes.groupBy(*key, "p1", "p2", "t1", "t2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(ended).alias("n_ends"), F.max("words").alias("words"), F.max("w").alias("w"))
    nodes = written_once(nodes.drop("t1", "t2"), "nodes")

    # where each conversation's own path starts, and whether it owns the leaf it ends in
    paths = nodes.groupBy("conv_id").agg(F.min("d").alias("from"), F.min(F.col("w") - F.col("words")).alias("words_before"), F.max((F.col("n_ends") == F.col("n_convs")).cast("long")).alias("leaf"))
    facts = info.select("conv_id", "rebuilt_w").join(paths, "conv_id", "left").select("conv_id", "from", F.coalesce("words_before", "rebuilt_w").alias("words_before"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"))
    by_part = facts.join(placed.select("conv_id", "part").union(info.select("conv_id", F.lit(-1).alias("part"))), "conv_id")
    before = F.col("w") - F.col("words")
    shares = prefixes.select("conv_id", "part", *key, before.alias("before")).join(by_part, ["conv_id", "part"]).select(*key, F.greatest(F.col("words_before") - F.col("before"), F.lit(0)).alias("saved"), "leaf", F.coalesce((F.col("from") == F.col("d")).cast("long"), F.lit(0).cast("long")).alias("entry"))
    shares = shares.where("saved > 0 or leaf > 0 or entry > 0")
    children = nodes.where("d > 0").select((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(1).cast("long").alias("child"))
    facts_of = nodes.select(*key, "p1", "p2", "conv_id", "n_convs", "n_ends", F.lit(1).cast("long").alias("group"))
    every = facts_of.unionByName(children, allowMissingColumns=True).unionByName(shares, allowMissingColumns=True)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)  # noqa: E731
    table = every.groupBy(*key).agg(*[F.max(c).alias(c) for c in ("p1", "p2", "conv_id", "n_convs", "n_ends", "entry")], *[total(c) for c in ("child", "leaf", "saved", "group")])
    table = written_once(table, "trie")
    if not table.where("`group` <> 1").isEmpty():
        return None

    parents = table.where("child > 0").select((F.col("d") + 1).alias("d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    met = F.expr("entry > 0 or n_ends > 0")
    named = table.where(met).join(parents, ["d", "p1", "p2"], "left").join(_end_lists(prefixes), key, "left")
    inner = table.where(~met).select("*", F.when(F.col("d") > 0, F.col("conv_id")).alias("parent"), F.lit(None).cast("string").alias("ends_sha256"))
    nobody = hashlib.sha256(b"").hexdigest()
    return named.unionByName(inner).select(
        "conv_id",
        F.col("d").alias("depth"),
        F.when(F.col("d") > 0, F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        "n_ends",
        F.col("child").alias("n_children"),
        F.col("leaf").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"),
        "k1",
        "k2",
    )


ORACLE_SQL = r"""
WITH crc AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT c, list_concat(coalesce(b.t, [])[1:h], o.t[h + 1:]) AS t
  FROM crc JOIN own o USING (c) LEFT JOIN (SELECT c AS base, t FROM own) b ON b.base = crc.c - crc.c % 20),
prefixes AS (
  SELECT c, len(t) AS size, unnest(range(0, len(t) + 1)) AS d, t FROM rebuilt),
keyed AS (
  SELECT c, size, d, md5(CAST(t[1:d] AS JSON)::VARCHAR) AS k, CASE WHEN d > 0 THEN md5(CAST(t[1:d - 1] AS JSON)::VARCHAR) END AS p,
    CASE WHEN d > 0 THEN len(regexp_extract_all(t[d].text, '[^ 	-]+')) ELSE 0 END AS words
  FROM prefixes),
nodes AS (
  SELECT d, k, any_value(p) AS p, min(c) AS c, count(*) AS n, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = size), '')) AS ends
  FROM keyed GROUP BY d, k),
children AS (SELECT d - 1 AS d, p AS k, count(*) AS m FROM nodes WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT a.d, a.k, count(*) FILTER (WHERE m IS NULL) AS leaves, sum((v.n - 1) * v.words) AS saved
  FROM nodes v LEFT JOIN children USING (d, k) JOIN keyed a ON a.c = v.c AND a.d <= v.d GROUP BY a.d, a.k)
SELECT n.c AS conv_id, n.d AS depth, q.c AS parent_conv_id, n.n AS n_convs, coalesce(m, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN below USING (d, k) LEFT JOIN children ch USING (d, k) LEFT JOIN nodes q ON q.d = n.d - 1 AND q.k = n.p
"""
