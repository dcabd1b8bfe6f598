"""Personal data by weak-supervision aggregation, in DataFrame functions only.

Pattern matches (``email``, ``ip``, ``card``, ``phone``) are always reported. Looser candidate spans
are judged by labelers that vote for, against or not at all: the form of the span (regex), a gazetteer of
domain endings, numbering plans and card issuers, the words before it (context), the marks around it and
its digits. Expectation maximisation over the counts of vote patterns estimates each labeler's reliability;
counts come from all documents, and there are at most 3 ** 5 patterns for each kind, so that is a small calculation on the
driver. The posteriors label the spans on which a logistic classifier is trained. It does not see the votes: its features are the span's
characters, its ending or first digits, the words around it (as far as the neighbouring candidates) and how many of these stand near. It is fitted on at most ``FIT_SPANS``
different feature sets (those of the smallest hashes), and spans of 0.5 or more are reported as ``soft_...`` spans.

Spans are in code points, the end exclusive. Matches are leftmost and do not overlap within a
kind. The possessive forms of the patterns find the same matches as the plain ones, without backtracking on long texts; a card
pattern of fewer digits than a card has would only add matches that are dropped. The places of matches are running sums in
blocks, so a text of very many matches takes time in little more than proportion to them.

Defined results: null texts count as empty; repeated rows give repeated rows; a soft span that overlaps a base one is left out;
without candidates nothing is estimated; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.session import written_once

# The kinds of personal data, in the order in which they are listed, and their patterns.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SOFT = {
    "soft_email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}+\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{2,64}+\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z]{2,10}(?![A-Za-z0-9])",
    "soft_phone": r"(?<![0-9+])(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
    "soft_card": r"(?<![0-9])[0-9]{4}[\x20.-][0-9]{4}[\x20.-][0-9]{4}[\x20.-][0-9]{1,4}(?![0-9])",
}
# Generic top-level domains, and country ones in wide use.
GENERIC = "com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post app dev io ai me tv cc co xyz online site shop cloud blog"
COUNTRIES = (
    "ac ad ae af ag al am ao ar at au az ba bd be bg bh bo br by ca ch ci cl cm cn cr cu cy cz de dk do dz ec ee eg es et eu fi fr ge gh gr gt hk hn hr hu id ie il in iq ir "
    "is it jm jo jp ke kg kh kr kw kz la lb li lk lt lu lv ly ma md mk mm mn mt mu mx my ng ni nl no np nz om pa pe pg ph pk pl pr pt py qa ro rs ru sa se sg si sk sn sv sy th "
    "tn tr tw tz ua ug uk us uy uz ve vn ye za zm zw"
)
ENDINGS = f"(?i)[. )\\]](?:{'|'.join((GENERIC + ' ' + COUNTRIES).split())})$"
# Card issuers by their first digits, and the lengths of their numbers.
ISSUERS = (
    ("4", (13, 16, 19)),
    ("5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720", (16,)),
    ("3[47]", (15,)),
    ("6011|64[4-9]|65", (16, 19)),
    ("30[0-5]|36|3[89]", (14, 16, 19)),
    ("35(?:2[89]|[3-8])", (16, 19)),
    ("62", (16, 17, 18, 19)),
    ("5[0678]|6[37]", (13, 14, 15, 16, 17, 18, 19)),
)
ISSUED = "|".join(f"(?=(?:{'|'.join(f'[0-9]{{{n}}}$' for n in lengths)}))(?:{first})" for first, lengths in ISSUERS)
#: The plan of ten-digit numbers: an area and an exchange of 2 to 9 first, neither of the service form n11, no reserved area.
NUMBERED = "^(?!.11)(?!37|96)[2-9][0-8][0-9](?!.11)[2-9][0-9]{6}$"
WORDS = "(?i)(?:mail|contact|write|phone|call|tel|mobile|fax|card|visa|pay|account|konto|karte|correo|tarjeta|carte|courriel|anruf|llame|appel)[^a-z0-9]{0,4}$"
CONTEXT = 48
#: Buckets of the classifier's features, and the most feature sets it is fitted on.
BUCKETS, FIT_SPANS = 4096, 4000


def _let(value: Column, of) -> Column:
    """``of(value)``, the value being computed once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _scanned(items: Column, zero: Column, carry, emit, kind: str) -> Column:
    """``emit(state, item)`` of each item, the state being what ``carry`` made of all items before it.

    States are carried over blocks of about the cube root of the number of items, and within each block, so that appending
    to arrays stays cheap however many items there are. ``carry`` has to be associative over blocks: a sum, a minimum or a maximum.
    """
    none = F.array().cast(f"array<{kind}>")

    def within(block: Column, start: Column) -> Column:
        step = lambda acc, x: F.struct(carry(acc["state"], x).alias("state"), F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out"))
        return F.aggregate(block, F.struct(start.alias("state"), none.alias("out")), step, lambda acc: acc["out"])

    def over(blocks: Column) -> Column:
        step = lambda acc, b: F.concat(acc, F.array(F.aggregate(b, F.element_at(acc, -1), carry)))
        starts = F.aggregate(blocks, F.array(zero), step)
        return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), within))

    def blocked(own: Column) -> Column:
        size = F.greatest(F.lit(8), F.cbrt(F.size(own)).cast("int"))
        return F.transform(F.sequence(F.lit(1), F.size(own), size), lambda i: F.slice(own, i, size))

    return F.when(F.size(items) > 0, _let(_let(items, blocked), over)).otherwise(none)


_MATCH = "struct<start:int,end:int,match:string,before:string,after:string>"


def _matches(text: Column, pattern: str) -> Column:
    """``(start, end, match, before, after)`` of all matches; what lies between them gives their places and contexts."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def pairs(gaps: Column) -> Column:
        own = F.zip_with(F.transform(gaps, lambda g: F.struct(F.length(g).alias("gap"), F.substring(g, -CONTEXT, CONTEXT).alias("before"), F.substring(g, 1, CONTEXT).alias("after"))), found, lambda g, m: F.struct(g.alias("g"), m.alias("match")))
        return _let(own, lambda x: F.transform(F.slice(x, 1, F.size(x) - 1), lambda y, i: F.struct(y["g"]["gap"].alias("gap"), y["match"].alias("match"), y["g"]["before"].alias("before"), F.get(x, i + 1)["g"]["after"].alias("after"))))

    def emit(at: Column, x: Column) -> Column:
        first = at + x["gap"]
        return F.struct(first.alias("start"), (first + F.length(x["match"])).alias("end"), x["match"].alias("match"), x["before"].alias("before"), x["after"].alias("after"))

    carry = lambda at, x: at + x["gap"] + F.length(x["match"])
    return _scanned(_let(F.split(text, pattern, -1), pairs), F.lit(0), carry, emit, _MATCH)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    value = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda total, i: total + F.when(i % 2 == 1, doubled(value(i))).otherwise(value(i))) % 10 == 0


def _holds(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        return F.forall(F.split(match, "\\."), lambda p: F.coalesce(F.try_to_number(F.regexp_replace(p, "^0+(?=.)", ""), F.lit("999")) <= 255, F.lit(False)))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _spans(text: Column, kind: str, pattern: str) -> Column:
    """``(start, end, kind, match, before, after, near)`` of one kind; texts that cannot hold it are not searched."""
    needs = {"email": text.contains("@"), "phone": text.contains("+"), "soft_email": text.contains("@") | F.lower(text).contains("at")}.get(kind, text.rlike("[0-9]"))
    kept = F.filter(_matches(text, pattern), lambda m: _holds(kind, m["match"])) if kind in BASE else _matches(text, pattern)

    def full(found: Column) -> Column:
        far = F.lit(1 << 30)

        def one(m: Column, i: Column) -> Column:
            gaps = m["start"] - F.coalesce(F.when(i > 0, F.get(found, i - 1)["end"]), -far), F.coalesce(F.get(found, i + 1)["start"], far) - m["end"]
            near = sum(((g < 200).cast("int") for g in gaps), F.lit(0))
            return F.struct(*[m[c].alias(c) for c in ("start", "end")], F.lit(kind).alias("kind"), *[m[c].alias(c) for c in ("match", "before", "after")], near.alias("near"))

        return F.transform(found, one)

    none = F.array().cast("array<struct<start:int,end:int,kind:string,match:string,before:string,after:string,near:int>>")
    return F.when(needs, _let(kept, full)).otherwise(none)


def _clear(base: Column, soft: Column) -> Column:
    """The soft spans that overlap no base span, by a scan from either side of all spans in order."""
    spans = lambda own, is_soft: F.transform(own, lambda s, i: F.struct(s["start"].alias("start"), F.lit(is_soft).alias("soft"), s["end"].alias("end"), i.alias("i"), F.lit(False).alias("hit")))
    kind = "struct<start:int,soft:int,end:int,i:int,hit:boolean>"
    seen = lambda x, hit: F.struct(*[x[c].alias(c) for c in ("start", "soft", "end", "i")], (x["hit"] | hit).alias("hit"))
    least = F.lit((1 << 31) - 1)
    left = _scanned(F.array_sort(F.concat(spans(base, 0), spans(soft, 1))), F.lit(0), lambda at, x: F.when(x["soft"] == 0, F.greatest(at, x["end"])).otherwise(at), lambda at, x: seen(x, at > x["start"]), kind)
    both = _scanned(F.reverse(left), least, lambda at, x: F.when(x["soft"] == 0, F.least(at, x["start"])).otherwise(at), lambda at, x: seen(x, at < x["end"]), kind)
    kept = F.filter(both, lambda x: (x["soft"] == 1) & ~x["hit"])
    picked = _let(soft, lambda own: F.transform(F.array_sort(F.transform(kept, lambda x: x["i"])), lambda i: F.get(own, i)))
    return F.when((F.size(base) > 0) & (F.size(soft) > 0), picked).otherwise(soft)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, base, soft)``: base spans, and soft candidates with their votes (1 for, -1 against, 0 neither) and features."""
    text = F.col("text")
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    base = F.concat(*[_spans(text, kind, pattern) for kind, pattern in BASE.items()])
    soft = F.concat(*[_spans(text, kind, pattern) for kind, pattern in SOFT.items()])
    found = source.select("doc_id", base.alias("base"), soft.alias("soft"))
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)

    def voted(s: Column) -> Column:
        match, digits = s["match"], _digits(s["match"])
        before, after = s["before"], s["after"]
        email, card = s["kind"] == "soft_email", s["kind"] == "soft_card"
        form = vote(F.when(email, match.contains("@") | match.rlike("[(\\[]")).when(card, F.length(digits).between(13, 16)).otherwise(match.rlike("^\\(?[2-9]")), F.lit(True))
        gazetteer = vote(F.when(email, match.rlike(ENDINGS)).when(card, digits.rlike(f"^(?:{ISSUED})")).otherwise(digits.rlike(NUMBERED)), F.lit(True))
        context = vote(before.rlike(WORDS), F.lit(False))
        edges = vote(after.rlike("^(?:$|[\\s.,;)])") & before.rlike("(^|[\\s(:])$"), after.rlike("^[A-Za-z0-9=/_-]"))
        number = vote(F.when(card, _luhn(digits)).when(email, ~match.rlike("[0-9]{6}")).otherwise(F.length(digits) == 10), F.lit(True))
        words = lambda pattern, side: F.lower(F.regexp_extract(side, pattern, 1))
        features = {
            "shape": F.regexp_replace(F.regexp_replace(match, "[A-Za-z]+", "a"), "[0-9]", "0"),
            "last": words("(\\S+)\\s*$", before),
            "second": words("(\\S+)\\s+\\S+\\s*$", before),
            "next": words("^\\s*(\\S+)", after),
            "left": F.substring(before, -1, 1),
            "right": F.substring(after, 1, 1),
            "part": F.when(email, words("([A-Za-z]+)$", match)).otherwise(F.substring(digits, 1, 2)),
            "sum": F.when(card, _luhn(digits)).otherwise(F.length(digits) > 5).cast("string"),
            "near": s["near"].cast("string"),
        }
        places = F.array(*[F.pmod(F.xxhash64(s["kind"], F.lit(name), value), F.lit(BUCKETS)).cast("int") for name, value in features.items()])
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), F.array(form, gazetteer, context, edges, number).alias("votes"), places.alias("x"))

    slim = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), b["kind"].alias("kind")))
    return found.select("doc_id", slim.alias("base"), F.transform(_clear(F.col("base"), F.col("soft")), voted).alias("soft"))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 40) -> dict[tuple[int, ...], float]:
    """Posterior of each vote pattern, by expectation maximisation of the labelers' reliabilities.

    A labeler says 1, -1 or 0 with chances that depend on the hidden truth; the counts are smoothed, and the start
    trusts every labeler a little.
    """
    labelers = range(len(patterns[0][0]) if patterns else 0)
    share = 0.5
    chance = {(k, y, v): (0.5 if v == (1 if y else -1) else 0.25) for k in labelers for y in (0, 1) for v in (-1, 0, 1)}
    belief: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(chance[k, 1, votes[k]] / chance[k, 0, votes[k]]) for k in labelers)
            belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(n for _, n in patterns)
        share = min(0.99, max(0.01, sum(n * belief[v] for v, n in patterns) / max(total, 1)))
        for k in labelers:
            for y in (0, 1):
                weight = {v: 1.0 + (1.0 if v == (1 if y else -1) else 0.0) for v in (-1, 0, 1)}
                for votes, n in patterns:
                    weight[votes[k]] += n * (belief[votes] if y else 1 - belief[votes])
                for v in (-1, 0, 1):
                    chance[k, y, v] = weight[v] / sum(weight.values())
    return belief


def span_classifier(spans: list[tuple[tuple[int, ...], float, float]], rounds: int = 80, rate: float = 0.3) -> list[float]:
    """Logistic weights by feature, the bias last, fitted to ``(features, posterior, count)`` by scaled gradient steps."""
    weights, squares = [0.0] * (BUCKETS + 1), [1e-8] * (BUCKETS + 1)
    total = sum(n for _, _, n in spans) or 1
    for _ in range(rounds):
        step: dict[int, float] = {}
        for x, target, n in spans:
            own = weights[BUCKETS] + sum(weights[i] for i in x)
            error = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, own)))) - target)
            for i in (*x, BUCKETS):
                step[i] = step.get(i, 0.0) + error
        for i, g in step.items():
            g += 1e-4 * weights[i]
            squares[i] += g * g
            weights[i] -= rate * g / math.sqrt(squares[i])
    return weights


def fit(found: DataFrame, fit_spans: int = FIT_SPANS) -> list[float]:
    """The weights of the span classifier, from the candidates of all documents (see the module)."""
    spans = found.select(F.explode("soft").alias("s")).select("s.kind", "s.votes", "s.x")
    counted = spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # at most 3 ** 5 for each kind
    belief = {kind: reliabilities(sorted((tuple(r["votes"]), r["n"]) for r in counted if r["kind"] == kind)) for kind in SOFT}
    sets = spans.groupBy("kind", "votes", "x").agg(F.count("*").alias("n"))
    some = sets.orderBy(F.xxhash64("kind", "votes", "x"), "kind", "votes", "x").limit(fit_spans).collect()
    return span_classifier([(tuple(r["x"]), belief[r["kind"]][tuple(r["votes"])], float(r["n"])) for r in some])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, counts and digest of the base spans, and all spans."""
    found = written_once(candidates(docs, id_col, text_col), "pii-candidates")
    weights = fit(found)
    # one text literal instead of thousands of numbers keeps the plan small; it is folded to an array once
    table = F.split(F.lit(",".join(repr(w) for w in weights)), ",").cast("array<double>")

    def chosen(s: Column) -> Column:
        return F.aggregate(s["x"], F.lit(weights[BUCKETS]), lambda total, i: total + F.get(table, i)) >= 0

    order = [*BASE, *SOFT]
    place = lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*[F.lit(k) for k in order]), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    soft = F.transform(F.filter("soft", chosen), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(F.transform(spans, place)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    is_a = lambda kind: lambda b: b["kind"] == kind
    counts = [F.size(F.filter("base", is_a(kind))).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", soft)).alias("spans"))
