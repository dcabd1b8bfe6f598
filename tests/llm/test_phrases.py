from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from harborline.llm import phrases as P


def brute(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        lost = set()
        for q, more in candidates.items():
            for i in range(len(q)):
                for j in range(i + 2, len(q) + 1):
                    p = q[i:j]
                    if len(p) < len(q) and 100 * more >= 80 * candidates[p]:
                        lost.add(p)
        rows = []
        for p, a in candidates.items():
            if p in lost:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(spark, rows, least, top):
    docs = spark.createDataFrame([(i, t, lang, 1) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, score int")
    return sorted(tuple(r) for r in P.collocations(docs, least, top).collect())


def corpus(seed, n):
    draw = random.Random(seed)
    vocabulary = ["the", "of", "Ä", "new", "york", "city", "hall", "a", "b", "c", "x\x00y", "ê"]
    fixed = ["new york city hall", "of the", "a b c", "york city"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(1, 30)):
            parts.append(draw.choice(fixed) if draw.random() < 0.4 else draw.choice(vocabulary))
            if draw.random() < 0.15:
                parts.append(draw.choice([".", ",", "\n", "?!", "\t"]))
        text = " ".join(parts)
        rows.append((draw.choice(["en", "de", None]), text.title() if draw.random() < 0.1 else text))
    return rows


@pytest.mark.parametrize(("least", "top"), [(3, 4), (2, 1), (5, 2000)])
def test_equals_brute_force(spark, least, top):
    rows = [*corpus(top, 60), ("en", None), ("en", ""), (None, " .,; "), ("fr", "alone"), ("en", "same same same same same")]
    assert mined(spark, rows, least, top) == brute(rows, least, top)


def test_several_rounds_settle_what_one_does_not(spark):
    # all of the best pairs are part of longer phrases, so the threshold has to fall
    rows = [("en", f"p{i} q{i} r{i} s{i}. ") for i in range(40) for _ in range(3)] + [("en", f"u{i} v{i}. u{i}. v{i}.") for i in range(30) for _ in range(3)]
    assert mined(spark, rows, 3, 5) == brute(rows, 3, 5)
    assert mined(spark, rows, 3, 50) == brute(rows, 3, 50)


def test_ties_at_the_end_of_the_list(spark):
    rows = [("en", f"t{i} w{i}.") for i in range(30) for _ in range(4)]
    assert mined(spark, rows, 3, 7) == brute(rows, 3, 7)


def test_long_text_and_empty_table(spark):
    rows = [("en", "left right, " * 100_000), ("en", "left of right")]
    assert mined(spark, rows, 30, 2000) == brute(rows, 30, 2000)
    assert mined(spark, [], 30, 2000) == []
