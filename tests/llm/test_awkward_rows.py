"""Repeated rows, null ids, texts over 1 MB, columns with clashing names and empty tables, operator by operator."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from harborline.llm import compact_windows, quality_fm, secrets_crf, simhash_windows
from harborline.llm import words as W

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("key", "text_key", "score", "spans", "_id", "_row", "found", "domain", "doc_id_", "item_id", "label")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(17)
    said = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    passage = " ".join(f"p{k}" for k in range(70))
    texts = {k: said(60) for k in range(40)} | {40: said(50) + " password = hunter22x " + said(5), 41: None, 42: "", 43: said(300_000) + " " + passage, 44: "start " + passage}
    rows = [(i, t, "en", "web", len(t or "")) for i, t in texts.items()]
    rows += [rows[40], rows[40], (None, texts[40], None, None, None), (None, None, None, None, None), (None, "", None, None, 0)]
    assert len(texts[43].encode()) > 1_000_000
    wide = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("mine").alias(c) for c in CLASHES])
    return wide.repartition(3).persist()


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(0, 40)] + [(None, 1, 0, "x"), (1, None, 0, "x")], "doc_id long, quality int, toxic int, text string")
    out = quality_fm.score(docs, quality_fm.fit(docs, labels)).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    assert len({r["score"] for r in out if r["doc_id"] == 40}) == 1
    assert quality_fm.score(docs.limit(0), quality_fm.fit(docs.limit(0), labels.limit(0))).count() == 0


def test_secrets(docs):
    out = secrets_crf.scan(docs, secrets_crf.fit(docs)).collect()
    assert len(out) == docs.count()
    assert {(r["n_assign"], r["base_sha256"]) for r in out if r["doc_id"] == 40} == {(1, next(r["base_sha256"] for r in out if r["doc_id"] == 40))}
    assert [r["n_assign"] for r in out if r["doc_id"] is None].count(1) == 1
    assert sum(r["n_assign"] for r in out) == 4
    assert secrets_crf.scan(docs.limit(0), secrets_crf.fit(docs.limit(0))).count() == 0


def test_passages(docs):
    assert docs.where("doc_id = 43").select(F.octet_length("text")).first()[0] > W.STEP_BYTES or W.STEP_BYTES >= 1 << 20
    found = compact_windows.repeated_passages(docs).collect()
    at = 300_000
    assert [(r["doc_id"], r["start_word"], r["end_word"], r["source_id"], r["source_start"], r["source_end"]) for r in found] == [(44, 1, 71, 43, at, at + 70)]
    assert compact_windows.repeated_passages(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):
    text = docs.where("doc_id = 40").select("text").first()[0]
    passage = docs.where("doc_id = 44").select("text").first()[0].removeprefix("start ")
    bench = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, passage, "x"), (None, None, "x"), (3, "", "x")], "item_id long, text string, doc_id string")
    found = [(r["doc_id"], r["item_id"]) for r in simhash_windows.findings(docs, bench).collect()]
    assert sorted(found, key=repr) == sorted([(40, 1)] * 3 + [(None, 1), (43, 2), (44, 2)], key=repr)
    clean = simhash_windows.without_items(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 6
    assert simhash_windows.without_items(docs, bench.limit(0)).count() == docs.count()
    assert simhash_windows.findings(docs.limit(0), bench).count() == 0
