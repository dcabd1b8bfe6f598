from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from harborline.llm import prefix_trie as T

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * words
            leaves[node[:d]] += node not in children
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows):
    turns = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, words int")
    return sorted((tuple(r) for r in T.trie(turns).select(*COLUMNS).collect()), key=repr)


@pytest.fixture
def scattered(spark):
    """Many small tasks, so that one conversation lies in several."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, scattered, seed):
    draw = random.Random(seed)
    said = ["", "a", "a b", "b\tc\n d", "Ä é"]
    rows = []
    for c in draw.sample(range(0, 90), 70):
        for turn in range(draw.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, None if turn == 0 and c % 7 == 0 else turn, draw.choice(["user", "bot", None]), draw.choice(said[: 2 if c % 2 else 5])))
    rows += [(41, 10 + i, "user", f"long {i % 3}") for i in range(300)] + [(43, 10 + i, "user", f"long {i % 3}") for i in range(280)]
    draw.shuffle(rows)
    assert trie(spark, rows) == brute(rows)


def test_copies_of_one_conversation_and_long_texts(spark):
    big = "word " * 300_000
    rows = [(c, t, "user", f"turn {t}" if t else big) for c in range(200, 230) for t in range(4)]
    assert trie(spark, rows) == brute(rows)


def test_many_ends_make_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE_IDS", 3)
    rows = [(c, t, "user", f"same {t}") for c in range(-5, 60) for t in range(4) if c % 20 or c >= 0]
    rows = [r for r in rows if r[0] >= 0]
    assert trie(spark, rows) == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "user", "x")]) == []
    rows = [(3, 0, "user", "x"), (3, 0, "user", "x"), (3, 1, None, None), (20, 0, None, "y")]
    assert trie(spark, rows) == brute(rows)


def test_unlike_texts_of_one_hash_are_seen(spark):
    own = spark.createDataFrame([(1, 1, "u", "x"), (1, 1, "u", "y"), (2, 2, "u", "z")], "t1 long, t2 long, role string, text string")
    assert T._unlike_texts(own, own)
    assert not T._unlike_texts(own.where("text <> 'y'"), own)
