"""The stages of the pipeline, one by one and in order, on small tables."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from harborline.llm import mixing, segment_lid
from harborline.llm import words as W
from tests.llm.test_llm import DOCS, SPEECH, frame, prose, words

CLASHES = ("_worded", "_covered", "_covered_id", "_covered_key", "_split", "_lines", "_removed", "_gone_id", "_gone_key", "_own_key", "_row", "_at", "_word", "mix_rate", "rate", "tokens", "text_key")


def same(a, b, percent=80):
    def shingles(text):
        w = words(text)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    x, y = shingles(a), shingles(b)
    return bool(x | y) and 100 * len(x & y) >= percent * len(x | y)


def write(tmp_path, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_near_copies_go_by_id_and_text(spark):
    rng = random.Random(1)
    base = prose(rng, 60)
    edited = base.rsplit(" ", 1)[0] + " zz"
    other = prose(rng, 60)
    rows = [(3, base), (5, edited), (5, other), (7, base), (3, base), (None, base), (8, None), (9, " ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = C.one_of_near_copies(spark, docs, "").collect()
    assert sorted((repr(r["doc_id"]), r["text"] or "") for r in got) == sorted((repr(i), t or "") for i, t in [(3, base), (3, base), (5, other), (None, base), (8, None), (9, " ")])


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.randint(6, 80)).split()
        for edits in (0, 0, 1, 4):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(len(own))] = prose(rng, 1)
            texts.append(" ".join(own))
    kept = {r["doc_id"] for r in C.one_of_near_copies(spark, frame(spark, texts), "").collect()}
    reach = {i: {i} for i in range(len(texts))}
    for _ in texts:
        for i in reach:
            reach[i] |= set().union(*(reach[j] for j in reach[i]), {j for j in range(len(texts)) if same(texts[i], texts[j])})
    assert kept == {i for i in reach if min(reach[i]) == i}


def test_line_stage_counts_characters_and_drops_emptied_documents(spark):
    shared = "one line\ntwo line\nthree line"
    texts = [shared, shared, f"own\n{shared}\nend é", None, "", " ", "a\nb"]
    docs = frame(spark, texts).withColumn("n_chars", F.when(F.col("doc_id") == 6, 99).otherwise(F.col("n_chars")).cast("long"))
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in C.without_repeated_lines(spark, docs, "").select(*docs.columns).collect()}
    assert got == {0: (shared, len(shared)), 2: ("own\nend é", 9), 3: (None, None), 4: ("", 0), 5: (" ", 1), 6: ("a\nb", 99)}


def test_domains_without_a_target_keep_their_documents_and_share(spark, caplog):
    rng = random.Random(3)
    langs = [("aa", "bb", "cc")[i % 3] for i in range(150)]
    docs = frame(spark, [prose(rng, 30, SPEECH[k]) for k in langs], langs=langs)
    labels = spark.createDataFrame([(i, 1) for i in range(150)], "doc_id long, quality int")
    out = mixing.mixed(docs, labels, {"aa": 0.75, "bb": 0.25}).collect()
    tokens = sum(r["tokens"] for r in out)
    before = np.sum([np.array(r["posterior"]) * r["tokens"] for r in out], axis=0) / tokens
    after = np.sum([np.array(r["posterior"]) * r["rate"] * r["tokens"] for r in out], axis=0) / tokens
    assert after[2] == pytest.approx(before[2], abs=5e-4)
    assert after[:2] == pytest.approx([0.75 * (1 - before[2]), 0.25 * (1 - before[2])], abs=5e-4)
    assert any("no target for ['cc']" in r.message for r in caplog.records)
    assert mixing.with_rates(docs, labels, {"aa": 0.75, "bb": 0.25}).count() == 150


def test_shares():
    nan = np.nan
    assert mixing.shares(np.array([3.0, 1.0]), np.array([0.5, 0.5])) == pytest.approx([0.75, 0.25])
    assert mixing.shares(np.array([1.0, nan]), np.array([0.5, 0.5])) == pytest.approx([0.5, 0.5])
    assert mixing.shares(np.array([nan, nan]), np.array([0.3, 0.7])) == pytest.approx([0.3, 0.7])
    assert mixing.shares(np.array([0.0, 0.0]), np.array([0.3, 0.7])) == pytest.approx([0.5, 0.5])


@pytest.fixture
def small(spark, tmp_path):
    rng = random.Random(4)
    langs = [list(SPEECH)[i % len(SPEECH)] for i in range(120)]
    texts = [prose(rng, 40, SPEECH[k]) for k in langs]
    item = prose(rng, 30, SPEECH[langs[0]])
    texts[7] = texts[7] + " " + item
    texts[9] = texts[8]
    texts[10] = None
    texts[11] = "1234 5678"
    docs = frame(spark, texts, langs=langs)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    return docs, labels, benchmark, tmp_path


def test_whole_pipeline(spark, small):
    docs, labels, benchmark, path = small
    sf = write(path, documents=docs, labels=labels, benchmark=benchmark)
    got = C.run(spark, sf)
    assert got.columns == [*docs.columns, "mix_domain", "mix_rate"]
    assert {r["doc_id"] for r in got.collect()} == set(range(120)) - {7, 9, 10, 11}
    assert [name for name, _ in C.STAGES] == ["language_id", "line_dedup", "near_copies", "decontamination", "mixing"]


def test_every_stage_takes_clashing_columns_and_empty_tables(spark, small):
    docs, labels, benchmark, path = small
    wide = docs.select("*", *[F.lit("mine").alias(c) for c in CLASHES])
    sf = write(path, documents=wide, labels=labels, benchmark=benchmark)
    for name, stage in C.STAGES:
        out = stage(spark, wide, sf)
        added = ["mix_domain", "mix_rate"] if name == "mixing" else []
        assert sorted(out.columns) == sorted({*wide.columns, *added}), name
        rows = out.collect()
        assert len(rows) > 100 and {r["_covered"] for r in rows} == {"mine"} and {r["_removed"] for r in rows} == {"mine"}, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name


def test_long_words_and_long_pieces_are_scored_whole():
    pieces = segment_lid.Pieces({b" ab", b"abcdefghijklmnopqrstuvwx", b"cd", b"abab"})
    rng = np.random.default_rng(1)
    chances = rng.uniform(0.01, 0.1, (len(pieces.all), 2))
    model = segment_lid.Model(pieces, ["x", "y"], chances)
    ids = {p: i for i, p in enumerate(pieces.all)}

    def brute(word):
        word, total = b" " + word, np.ones((1, 2))
        for end in range(1, len(word) + 1):
            ways = [total[start] * chances[ids[word[start:end]]] for start in range(end) if word[start:end] in ids]
            total = np.vstack([total, np.sum(ways, axis=0)])
        return np.log(total[-1])

    for text in (b"abcd", b"abcdefghijklmnopqrstuvwxyz", b"ab" * 20 + b"abcdefghijklmnopqrstuvwx" * 4, b"abcd" * 40):
        got = model.log_chances(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))[0]
        assert got == pytest.approx(brute(text), rel=1e-9)
    long = b"ab" * 50_000
    assert np.isfinite(model.log_chances(np.frombuffer(long, np.uint8), np.array([0]), np.array([len(long)]))).all()
    assert W.STEP_BYTES > len(long)
