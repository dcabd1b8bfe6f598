"""Licence scan: an Aho-Corasick automaton finds notices and identifier tags, a shunting-yard parser reads expressions.

The automaton runs once over the words of each text and finds the base phrases, longer notice phrases
and tags such as ``SPDX-License-Identifier:`` or ``license =``. What follows a tag on its line is read as an
expression of licence identifiers joined by ``with``, ``and`` and ``or`` (in that order of binding) and parentheses.
Its value is the licences it names and the burden of its lightest choice: ``or`` takes the lighter side, ``and`` the
heavier one, ``with`` and a known exception make a copyleft licence one step lighter.

An expression ends before the first word that cannot continue it, and before an operator that nothing
readable follows. After a tag of the plain kind (``license:``) prose is usual, so nothing is reported unless an identifier
comes first; after an SPDX tag an unreadable expression is reported with ``valid`` false. Identifiers that start
with ``LicenseRef-`` are valid and have the burden of an unknown licence.

Defined results: null and empty texts have no words and score 0; repeated rows give equal rows each; a null
id is kept; an empty table gives no rows; other columns are ignored. Matches never cross documents, and no text is cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W

# The phrases every place of which counts, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices that name a licence more exactly than the base phrases, or one that these do not know.
NOTICES = {
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu gpl": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "apache license version 2 0": "apache-2.0",
    "apache license version 1 1": "apache-1.1",
    "apache 2 0 license": "apache-2.0",
    "www apache org licenses license 2 0": "apache-2.0",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "opensource org licenses mit": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose with or without fee": "isc",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "boost software license": "bsl-1.0",
    "artistic license": "artistic",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "dedicated to the public domain": "public-domain",
    "released into the public domain": "public-domain",
    "cc0 1 0": "cc0",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "creativecommons org licenses by": "cc-by",
    "cc by sa": "cc-by-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creativecommons org licenses by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creativecommons org licenses by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "creativecommons org licenses by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "creativecommons org licenses by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creativecommons org licenses by nc nd": "cc-by-nc-nd",
    "open database license": "odbl",
    "all rights reserved": "all-rights-reserved",
}
#: Words that an expression may follow: those of an SPDX tag, and plain ones that need a ``:`` or ``=``.
SPDX_TAG, PLAIN_TAGS = "spdx license identifier", ("license", "licence", "licenses", "license expression", "license id")

#: Burdens of a licence, from the lightest.
BURDENS = ("public-domain", "permissive", "weak-copyleft", "strong-copyleft", "network-copyleft", "restricted", "unknown")
UNKNOWN = len(BURDENS) - 1
#: Licence families, the burden each has, and its identifiers without ``-only``, ``-or-later`` and ``+``.
FAMILIES = {
    "mit": (1, "mit mit-0 x11 expat"),
    "bsd": (1, "bsd 0bsd bsd-2-clause bsd-3-clause bsd-4-clause bsd-3-clause-clear"),
    "apache": (1, "apache apache-1.0 apache-1.1 apache-2.0"),
    "isc": (1, "isc"),
    "zlib": (1, "zlib libpng"),
    "bsl-1.0": (1, "bsl-1.0"),
    "python": (1, "psf-2.0 python-2.0"),
    "postgresql": (1, "postgresql"),
    "ncsa": (1, "ncsa"),
    "artistic": (1, "artistic-1.0 artistic-2.0"),
    "wtfpl": (1, "wtfpl"),
    "cc-by": (1, "cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0"),
    "cc0": (0, "cc0 cc0-1.0"),
    "unlicense": (0, "unlicense"),
    "lgpl": (2, "lgpl lgpl-2.0 lgpl-2.1 lgpl-3.0"),
    "mpl": (2, "mpl-1.0 mpl-1.1 mpl-2.0"),
    "epl": (2, "epl-1.0 epl-2.0"),
    "cddl": (2, "cddl-1.0 cddl-1.1"),
    "eupl": (2, "eupl-1.1 eupl-1.2"),
    "gpl": (3, "gpl gpl-1.0 gpl-2.0 gpl-3.0"),
    "gfdl": (3, "gfdl-1.1 gfdl-1.2 gfdl-1.3"),
    "cc-by-sa": (3, "cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0"),
    "odbl": (3, "odbl-1.0"),
    "agpl": (4, "agpl agpl-1.0 agpl-3.0"),
    "cc-by-nc": (5, "cc-by-nc-2.0 cc-by-nc-3.0 cc-by-nc-4.0"),
    "cc-by-nd": (5, "cc-by-nd-3.0 cc-by-nd-4.0"),
    "cc-by-nc-sa": (5, "cc-by-nc-sa-3.0 cc-by-nc-sa-4.0"),
    "cc-by-nc-nd": (5, "cc-by-nc-nd-3.0 cc-by-nc-nd-4.0"),
    "sspl": (5, "sspl-1.0"),
    "busl": (5, "busl-1.1"),
    "proprietary": (5, "proprietary unlicensed"),
}
IDENTIFIERS = {name: (family, burden) for family, (burden, names) in FAMILIES.items() for name in names.split()}
EXCEPTIONS = frozenset(
    "classpath-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 llvm-exception autoconf-exception-3.0 bison-exception-2.2 "
    "font-exception-2.0 linux-syscall-note openssl-exception qt-gpl-exception-1.0 universal-foss-exception-1.0".split()
)
BINDING = {"or": 1, "and": 2, "with": 3}
#: How sure one piece of evidence of each kind makes that a text states a licence.
WEIGHTS = {"phrase": 0.6, "notice": 0.8, "expression": 0.95, "broken": 0.2}

_FOLD = np.full(256, 32, np.uint8)
for _lo, _hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _FOLD[_lo:_hi] = np.arange(_lo, _hi)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)

_OPENING = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"'\[]*[ \t]*")
_SPDX_OPENING = re.compile(rb"[\"']?[ \t]*[:=]?[ \t]*[\"'\[]*[ \t]*")
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.:-]*[A-Za-z0-9])?\+?)")


def _operand(token: str) -> tuple[str, frozenset, int] | None:
    """Canonical identifier, labels and burden; none for a word that is no identifier."""
    if token.startswith("licenseref-"):
        return token, frozenset([token]), UNKNOWN
    plain = token.removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    if plain not in IDENTIFIERS:
        return None
    family, burden = IDENTIFIERS[plain]
    return token, frozenset([family, plain]), burden


def tokens(text: bytes, at: int) -> tuple[list[str], bool]:
    """The tokens from ``at`` on that form the longest readable start of an expression, and whether its parentheses close."""
    out: list[str] = []
    depth, wants_operand, good, good_depth = 0, True, 0, 0
    while found := _TOKEN.match(text, at):
        token = found[1].decode("latin-1").lower()
        if wants_operand:
            if out and out[-1] == "with":
                if token not in EXCEPTIONS:
                    break
                wants_operand = False
            elif token == "(":
                depth += 1
            elif _operand(token):
                wants_operand = False
            else:
                break
        elif token == ")" and depth:
            depth -= 1
        elif token in BINDING and not (token == "with" and out[-1] == ")"):
            wants_operand = True
        else:
            break
        out.append(token)
        at = found.end()
        if not wants_operand:
            good, good_depth = len(out), depth
    return out[:good], good > 0 and good_depth == 0


def evaluate(expression: list[str]) -> tuple[frozenset, int]:
    """Licences and burden of a well-formed expression, by the shunting-yard algorithm."""
    values: list[tuple[frozenset, int]] = []
    operators: list[str] = []

    def reduce() -> None:
        operator = operators.pop()
        (right, heavy), (left, burden) = values.pop(), values.pop()
        if operator == "with":
            values.append((left | right, burden - 1 if 1 < burden < 5 else burden))
        else:
            values.append((left | right, min(burden, heavy) if operator == "or" else max(burden, heavy)))

    for token in expression:
        if token == "(":
            operators.append(token)
        elif token == ")":
            while operators[-1] != "(":
                reduce()
            operators.pop()
        elif token in BINDING:
            while operators and operators[-1] != "(" and BINDING[operators[-1]] >= BINDING[token]:
                reduce()
            operators.append(token)
        elif token in EXCEPTIONS:
            values.append((frozenset([token]), 0))
        else:
            values.append(_operand(token)[1:])
    while operators:
        reduce()
    return values[0]


@cache
def _automaton():
    """All phrases and tags, each between blanks, so that only whole words match."""
    import ahocorasick

    found: dict[str, list[tuple[str, str, int]]] = {}
    for kind, phrases in (("phrase", BASE), ("notice", NOTICES), ("tag", {SPDX_TAG: "spdx"} | dict.fromkeys(PLAIN_TAGS, ""))):
        for phrase, label in phrases.items():
            found.setdefault(phrase, []).append((kind, label, len(phrase) + 1))
    automaton = ahocorasick.Automaton()
    for phrase, values in found.items():
        automaton.add_word(f" {phrase} ", values)
    automaton.make_automaton()
    return automaton


def _read(raw: bytes, at: int, spdx: bool) -> tuple[str, str, list[str], bool] | None:
    opening = (_SPDX_OPENING if spdx else _OPENING).match(raw, at)
    if not opening:
        return None
    expression, closed = tokens(raw, opening.end())
    if not closed:
        return (" ".join(expression), BURDENS[UNKNOWN], [], False) if spdx else None
    labels, burden = evaluate(expression)
    return " ".join(expression), BURDENS[burden], sorted(labels), True


def find(column: pa.Array) -> tuple[np.ndarray, list[list[tuple]], list[list[tuple]]]:
    """Words of each text; its ``(kind, word, label)`` matches; its ``(word, text, burden, labels, valid)`` expressions."""
    data, at = W.utf8(column)
    n = len(at) - 1
    matches: list[list[tuple]] = [[] for _ in range(n)]
    read: list[list[tuple]] = [[] for _ in range(n)]
    if n == 0:
        return np.zeros(0, np.int64), matches, read
    # each text becomes " text \n" in which all but words is blanks, runs of them one blank
    places = np.concatenate([at[:1], np.repeat(at[1:-1], 3), np.repeat(at[-1:], 2)])
    padded = np.insert(data, places, np.frombuffer(b" " + b" \n " * (n - 1) + b" \n", np.uint8))
    ends = at[1:] + 3 * np.arange(n) + 2
    folded = _FOLD[padded]
    folded[ends] = 10
    blank = folded == 32
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    origin = np.flatnonzero(keep)
    normal = folded[keep]
    starts = np.flatnonzero((normal[:-1] == 32) & (normal[1:] != 10)) + 1
    row_of = np.searchsorted(ends, origin[starts])
    counts = np.bincount(row_of, minlength=n)
    before = np.concatenate([[0], np.cumsum(counts)])
    raw = padded.tobytes()
    for end, values in _automaton().iter(normal.tobytes().decode("latin-1")):
        for kind, label, length in values:
            word = int(np.searchsorted(starts, end - length + 1))
            row = int(np.searchsorted(ends, origin[end]))
            own = word - int(before[row])
            if kind != "tag":
                matches[row].append((kind, own, label))
            elif expression := _read(raw, int(origin[end]), label == "spdx"):
                read[row].append((own, *expression))
    return counts, matches, read


_PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])
_EXPRESSION = pa.struct([("word", pa.int64()), ("expression", pa.string()), ("burden", pa.string()), ("labels", pa.list_(pa.string())), ("valid", pa.bool_())])


def _scored(matches: list[tuple], read: list[tuple]) -> float:
    """1 - the product of the doubts that each different piece of evidence leaves."""
    seen = sorted({(kind, label) for kind, _, label in matches} | {("expression" if x[4] else "broken", x[1]) for x in read})
    return float(1 - np.prod([1 - WEIGHTS[kind] for kind, _ in seen]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``places`` and ``notices`` (word and label), ``expressions``, ``labels``, ``score``."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch):
                counts, matches, read = find(part.column("text"))
                of = lambda kind: [[{"word": w, "label": x} for k, w, x in sorted(m) if k == kind] for m in matches]
                said = [[dict(zip(("word", "expression", "burden", "labels", "valid"), x, strict=True)) for x in sorted(r)] for r in read]
                labels = [sorted({x for _, _, x in m} | {x for e in r for x in e[3]}) for m, r in zip(matches, read, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(counts, pa.int64()),
                        pa.array(of("phrase"), pa.list_(_PLACE)),
                        pa.array(of("notice"), pa.list_(_PLACE)),
                        pa.array(said, pa.list_(_EXPRESSION)),
                        pa.array(labels, pa.list_(pa.string())),
                        pa.array([_scored(m, r) for m, r in zip(matches, read, strict=True)], pa.float64()),
                    ],
                    ["doc_id", "n_words", "places", "notices", "expressions", "labels", "score"],
                )

    kind = source.schema["doc_id"].dataType.simpleString()
    place = "array<struct<word: long, label: string>>"
    expression = "array<struct<word: long, expression: string, burden: string, labels: array<string>, valid: boolean>>"
    return source.mapInArrow(run, f"doc_id {kind}, n_words long, places {place}, notices {place}, expressions {expression}, labels array<string>, score double")


def digest(found: DataFrame) -> DataFrame:
    """Counts, ends and label lists of ``scan``'s rows."""
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("places.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join(F.transform("expressions", lambda e: e["expression"]), "; ").alias("expressions"),
    )
