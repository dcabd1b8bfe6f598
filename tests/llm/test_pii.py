"""Soft spans of personal data: planted ones are found, look-alikes are not; many matches in one text take little time."""

from __future__ import annotations

import random
import time

import pytest

from harborline.llm import pii_weak
from tests.llm.test_llm import DOCS, frame, luhn, prose


def card(rng, first):
    body = first + "".join(rng.choice("0123456789") for _ in range(15 - len(first)))
    number = next(body + d for d in "0123456789" if luhn(body + d))
    return ".".join(number[i : i + 4] for i in (0, 4, 8, 12))


def planted(rng):
    area = rng.choice("2345678") + rng.choice("0123456") + rng.choice("023456789")
    phone = f"({area}) {rng.randint(230, 899)}-{rng.randint(1000, 9999)}"
    name = f"{prose(rng, 1)}.{prose(rng, 1)}"
    return rng.choice(
        [
            ("soft_phone", rng.choice(["call", "phone", "tel", "mobile"]), phone),
            ("soft_email", rng.choice(["mail", "write", "contact"]), f"{name} (at) {prose(rng, 1)} (dot) {rng.choice(['com', 'de', 'org'])}"),
            ("soft_card", rng.choice(["card", "visa", "pay"]), card(rng, rng.choice(["4", "51", "55"]))),
        ]
    )


def lookalike(rng):
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice(
        [
            ("soft_phone", rng.choice(["part", "order", "version"]), f"{rng.choice('01')}{digits(2)}-{digits(3)}-{digits(4)}x"),
            ("soft_email", rng.choice(["build", "tag", "commit"]), f"x{digits(7)}@{digits(4)} .{prose(rng, 1)}zz/"),
            ("soft_card", rng.choice(["serial", "license", "key"]), f"{rng.choice('0189')}{digits(3)}.{digits(4)}.{digits(4)}.{digits(3)}1/"),
        ]
    )


def test_planted_soft_spans(spark):
    rng = random.Random(9)
    texts, truth, false = [], set(), set()
    for i in range(700):
        real = rng.random() < 0.5
        kind, before, span = planted(rng) if real else lookalike(rng)
        start = f"{prose(rng, 12)} {before} "
        texts.append(f"{start}{span} {prose(rng, 8)}")
        (truth if real else false).add((i, kind, len(start)))
    got = set()
    for r in pii_weak.scan(frame(spark, texts)).collect():
        got |= {(r["doc_id"], s.split(":")[0], int(s.split(":")[1])) for s in r["spans"].split(",") if s.startswith("soft_")}
    for kind in pii_weak.SOFT:
        own = {t for t in truth if t[1] == kind}
        assert len(own & got) >= 0.9 * len(own), (kind, len(own & got), len(own))
    wrong = {g for g in got if g not in truth}
    print("recall", len(truth & got) / len(truth), "precision", 1 - len(wrong) / len(got))
    assert len(wrong) <= 0.1 * len(got)


def test_gazetteers():
    import re

    assert re.search(pii_weak.ENDINGS, "a (at) b (dot) de") and re.search(pii_weak.ENDINGS, "a@b.museum") and not re.search(pii_weak.ENDINGS, "a@b.qqq")
    issued = f"^(?:{pii_weak.ISSUED})"
    for good in ("4012888888881881", "371449635398431", "5555555555554444", "2221000000000009", "6011111111111117", "3530111333300000"):
        assert re.search(issued, good)
    for bad in ("1234567890123456", "3714496353984312", "0000000000000000", "40128888888818"):
        assert not re.search(issued, bad)
    for good, bad in (("2125550187", "1125550187"), ("4155550187", "9115550187"), ("6505550187", "2129110187"), ("3035550187", "3715550187")):
        assert re.search(pii_weak.NUMBERED, good) and not re.search(pii_weak.NUMBERED, bad)


@pytest.mark.parametrize("unit", ["12,", "1.2.3.4 ", "(555) 123-4567 1.2.3.4 ", "a@b.com ", "word7 "])
def test_a_text_of_a_megabyte_of_matches(spark, unit):
    docs = spark.createDataFrame([(1, unit * (1_000_000 // len(unit)), "en", "s", 1), (2, "call (212) 555-0187", "en", "s", 1)], DOCS)
    pii_weak.scan(docs.limit(0)).collect()
    start = time.time()
    got = {r["doc_id"]: r for r in pii_weak.scan(docs).collect()}
    assert time.time() - start < 20
    n = 1_000_000 // len(unit)
    assert (got[1]["n_ip"], got[1]["n_email"]) == (n if "1.2.3.4" in unit else 0, n if "@" in unit else 0)


def test_overlaps_with_base_spans_in_any_order(spark):
    texts = ["1.2.3.4 call (212) 555-0187 x@y.com", "+1 (212) 555-0187", "mail a@b.com (dot) de", "4012 8888 8888 1881", "(212) 555-0187 +49 30 1234567"]
    for r in pii_weak.scan(frame(spark, texts * 3)).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        base = [(int(a), int(b)) for k, a, b in spans if not k.startswith("soft")]
        soft = [(int(a), int(b)) for k, a, b in spans if k.startswith("soft")]
        assert not [1 for a, b in soft for c, d in base if a < d and c < b]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(1, "a@b.com", "x", 1), (1, "a@b.com", "x", 1), (None, "1.2.3.4", "y", 2), (2, None, "z", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string, soft int")
    got = sorted(((r["doc_id"], r["spans"]) for r in pii_weak.scan(docs).collect()), key=repr)
    assert got == sorted([(1, "email:0:7"), (1, "email:0:7"), (None, "ip:0:7"), (2, "")], key=repr)
