from __future__ import annotations

import re

from harborline.llm import licenses as L
from harborline.llm.queries import QUERIES
from tests.conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(text):
    words = WORD.findall(ascii_lower(text or ""))
    places = []
    for phrase, label in L.BASE.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


TEXTS = [
    None,
    "",
    " \n\t ",
    "MIT License",
    "mit license mit-license MIT\nLicense",
    "summit license and mit licenses",
    "CC BY CC by-nc 4.0",
    "GNU General Public License, version 3. Apache   License, Version 2.0",
    "Apache",
    "License",
    "É mit License é CC\x00BY 漢字 cc by",
    "# SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-2.0-only WITH Classpath-exception-2.0)\ncode",
    "SPDX-License-Identifier: nonsense",
    'license = "BSD-3-Clause and see the file"',
    "license: see the file",
    "SPDX-License-Identifier: (MIT OR",
    "SPDX-License-Identifier: (MIT OR ISC",
]


def test_digest_equals_brute_force(spark):
    big = "apache license x " * 80_000
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, *TEXTS, big])] + [(None, "mit license", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in L.digest(L.scan(docs)).collect()}
    assert got == {(i, *brute(t)) for i, t, _ in rows}


def test_registered_query_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = QUERIES["op11_license_expressions"](spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == sorted((d.doc_id, *brute(d.text)) for d in docs)
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in rows)


def found(spark, text):
    (row,) = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    return row


def test_expressions(spark):
    row = found(spark, TEXTS[11])
    (e,) = row.expressions
    assert e.valid and e.burden == "permissive" and e.word == 0
    assert e.expression == "mit or ( apache-2.0 and gpl-2.0-only with classpath-exception-2.0 )"
    assert {"mit", "apache-2.0", "gpl", "gpl-2.0", "classpath-exception-2.0"} <= set(row.labels)
    (e,) = found(spark, TEXTS[12]).expressions
    assert not e.valid and e.expression == ""
    (e,) = found(spark, TEXTS[13]).expressions
    assert e.valid and e.expression == "bsd-3-clause"
    assert found(spark, TEXTS[14]).expressions == []
    (e,) = found(spark, TEXTS[16]).expressions
    assert not e.valid and e.expression == "( mit or isc"
    assert found(spark, "no licence here").score == 0.0


def value(text):
    got, closed = L.tokens(text.encode(), 0)
    assert closed
    return L.BURDENS[L.evaluate(got)[1]]


def test_binding_of_operators():
    assert value("GPL-3.0 AND MIT OR ISC") == "permissive"
    assert value("GPL-3.0 AND (MIT OR ISC)") == "strong-copyleft"
    assert value("MIT AND GPL-2.0+ WITH Classpath-exception-2.0") == "weak-copyleft"
    assert value("AGPL-3.0-or-later or LicenseRef-own") == "network-copyleft"
    deep = "(" * 5000 + "MIT" + ")" * 5000
    assert value(deep) == "permissive"


def test_empty_table(spark):
    assert L.digest(L.scan(spark.createDataFrame([], "doc_id long, text string"))).collect() == []
