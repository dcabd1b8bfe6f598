"""Secret scans by a linear-chain conditional random field.

Tokens (runs of ASCII letters, digits and ``_+/.-``) are tagged B, I or O (secret begin, inside, outside).
The features of a token are its shape (length, shares of digits, capitals and marks, changes between kinds,
hexadecimal or not), the marks before and after it, the hashed words beside it and statistics of the file. The weights are
fitted on lines of a bounded sample of texts, whose tags come from the patterns below; decoding is exact Viterbi.
Where ``O`` leads by more than any pair of transitions can make up, no best path can leave it, so the chain is cut there and
only the short stretches between such tokens are decoded.

Pattern matches are always reported; what the tagger finds in addition gets the kind ``tagged``.
Spans are in code points, the end exclusive.

Defined results: null texts count as empty; an empty text has no span; repeated rows give repeated rows; an empty table
gives no rows; without anything to learn from only the patterns report. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W

# The kinds of secrets, in the order in which they are listed, and their patterns.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20}
TAGGED = "tagged"

FIT_ROWS, ROUNDS, LONGEST = 1200, 60, 40
SIDE = 1 << 10
TOKEN = np.zeros(256, bool)
TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"_+/.-"]] = True
VALUES = W.byte_values(~TOKEN)
_STARTS = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the pattern matches, by start and then kind as listed."""
    found = []
    low = text.lower()
    if any(word in low for word in _STARTS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _groups(*parts: np.ndarray) -> np.ndarray:
    """One number for each combination of small numbers."""
    out = np.zeros(len(parts[0]), np.int64)
    for part in parts:
        out = out * 8 + np.minimum(part, 7)
    return out


class Tokens:
    """The tokens of a column of texts and the columns of their features."""

    WIDTHS = (8**4, 8**3, 256, 256, SIDE, SIDE, 8**3)

    def __init__(self, texts: pa.Array):
        data, at = W.utf8(texts)
        self.data, self.at = data, at
        self.starts, self.ends, self.rows = W.spans(data, at, TOKEN[data])
        n = self.ends - self.starts
        count = lambda mask: (lambda total: total[self.ends] - total[self.starts])(np.concatenate([[0], np.cumsum(mask, dtype=np.int32)]))
        digit = (data >= 48) & (data <= 57)
        capital = (data >= 65) & (data <= 90)
        small = (data >= 97) & (data <= 122)
        hexes = digit | ((data >= 97) & (data <= 102))
        kind = digit * 1 + capital * 2 + small * 3
        turn = np.zeros(len(data), bool)
        turn[1:] = kind[1:] != kind[:-1]
        digits, capitals, letters, marks = count(digit), count(capital), count(small), n - count(kind > 0)
        eighth = lambda c: (c * 6 // np.maximum(n, 1)).astype(np.int64) + (c > 0)
        size = np.searchsorted([3, 5, 7, 11, 15, 19, 27], n, "right")
        turns = np.searchsorted([1, 2, 3, 5, 7, 10, 14], count(turn) - turn[self.starts], "right") if len(n) else n
        before = np.where(self.starts > at[:-1][self.rows], data[np.maximum(self.starts - 1, 0)] if len(data) else 0, 10)
        after = np.where(self.ends < at[1:][self.rows], data[np.minimum(self.ends, max(len(data) - 1, 0))] if len(data) else 0, 10)
        hashes = (W.span_hashes(data, self.starts, self.ends, VALUES) >> np.uint64(54)).astype(np.int64)
        self.hashes = hashes
        edge = np.ones(len(n), bool)
        edge[1:] = self.rows[1:] != self.rows[:-1]
        left, right = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        if len(n):
            left[1:], right[:-1] = hashes[:-1], hashes[1:]
            left[edge] = 0
            right[np.append(edge[1:], True)] = 0
        length = np.maximum(np.diff(at), 1)
        per_file = [np.bincount(self.rows, c, minlength=len(at) - 1) for c in (digits, marks, capitals)]
        files = _groups(*[np.searchsorted([0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.4], c / length, "right") for c in per_file])
        own = (
            _groups(size, eighth(digits), eighth(capitals), eighth(marks)),
            _groups(turns, (count(hexes) == n).astype(np.int64) + 2 * (digits > 0) + 4 * (letters > 0), size),
            before.astype(np.int64),
            after.astype(np.int64),
            left,
            right,
            files[self.rows] if len(n) else n,
        )
        shift = np.concatenate([[0], np.cumsum(self.WIDTHS)[:-1]])
        self.features = np.stack([c + s for c, s in zip(own, shift, strict=True)], axis=1).astype(np.int32) if len(n) else np.zeros((0, len(own)), np.int32)


class Field:
    """Weights of the tags (B, I, O) by feature, and of their transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def unary(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3))
        for column in features.T:
            out += self.weights[column]
        return out

    def tags(self, unary: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The best tags (0 B, 1 I, 2 O) of the chains, one for each row."""
        out = np.full(len(unary), 2)
        # O wins for sure where its lead exceeds what two transitions can differ by
        slack = 2 * (self.moves.max() - self.moves.min())
        open_ = np.flatnonzero(unary[:, 2] - unary[:, :2].max(axis=1) <= slack)
        if not len(open_):
            return out
        new = np.ones(len(open_), bool)
        new[1:] = (np.diff(open_) > 1) | (rows[open_[1:]] != rows[open_[:-1]])
        first = open_[new]
        lengths = np.diff(np.append(np.flatnonzero(new), len(open_)))
        for n in np.unique(lengths):
            own = first[lengths == n]
            starts, ends = np.ones(len(own), bool), np.ones(len(own), bool)
            starts[own > 0] = rows[own[own > 0]] != rows[own[own > 0] - 1]
            last = own + n - 1
            inner = last + 1 < len(rows)
            ends[inner] = rows[last[inner]] != rows[last[inner] + 1]
            score = unary[own] + np.where(starts[:, None], 0, self.moves[2][None, :])
            back = []
            for k in range(1, n):
                paths = score[:, :, None] + self.moves[None]
                back.append(paths.argmax(axis=1))
                score = paths.max(axis=1) + unary[own + k]
            best = (score + np.where(ends[:, None], 0, self.moves[:, 2][None, :])).argmax(axis=1)
            out[last] = best
            for k in range(n - 2, -1, -1):
                best = back[k][np.arange(len(own)), best]
                out[own + k] = best
        return out


def fit_field(features: np.ndarray, tags: np.ndarray, lengths: np.ndarray, rounds: int = ROUNDS, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Adam on the log likelihood of whole chains, by forward and backward passes over padded batches."""
    n, longest, width = len(lengths), int(lengths.max()), sum(Tokens.WIDTHS)
    at = np.concatenate([[0], np.cumsum(lengths)])
    inside = np.arange(longest)[None, :] < lengths[:, None]
    place = np.where(inside, at[:-1, None] + np.arange(longest)[None, :], 0)
    weights, moves = np.zeros((width, 3)), np.zeros((3, 3))
    state = [np.zeros((width + 3, 3)) for _ in range(2)]
    for t in range(1, rounds + 1):
        field = Field(weights, moves)
        u = field.unary(features)[place]
        ahead, behind = np.zeros((longest, n, 3)), np.zeros((longest, n, 3))
        ahead[0] = u[:, 0]
        log_sum = lambda x, axis: (lambda m: m.squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis)))(x.max(axis=axis, keepdims=True))
        for k in range(1, longest):
            ahead[k] = np.where(inside[:, k, None], log_sum(ahead[k - 1][:, :, None] + moves[None], 1) + u[:, k], ahead[k - 1])
        for k in range(longest - 2, -1, -1):
            behind[k] = np.where(inside[:, k + 1, None], log_sum(moves[None] + (u[:, k + 1] + behind[k + 1])[:, None, :], 2), 0)
        total = log_sum(ahead[-1], 1)
        error = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2)[inside] - np.eye(3)[tags]
        step = np.zeros((width + 3, 3))
        for column in features.T:
            for k in range(3):
                step[:width, k] += np.bincount(column, error[:, k], minlength=width)
        for k in range(1, longest):
            own = inside[:, k]
            pair = np.exp(ahead[k - 1][own][:, :, None] + moves[None] + (u[own, k] + behind[k][own])[:, None, :] - total[own][:, None, None])
            step[width:] += pair.sum(axis=0)
            np.subtract.at(step[width:], (tags[place[own, k - 1]], tags[place[own, k]]), 1)
        theta = np.vstack([weights, moves])
        step = step / n + decay * theta
        state[0] = 0.9 * state[0] + 0.1 * step
        state[1] = 0.99 * state[1] + 0.01 * step**2
        theta = theta - rate * (state[0] / (1 - 0.9**t)) / (np.sqrt(state[1] / (1 - 0.99**t)) + 1e-8)
        weights, moves = theta[:width], theta[width:]
    return Field(weights, moves)


def _points(data: np.ndarray, at: np.ndarray, places: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Code points before each byte place, counted from the start of its row."""
    total = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return total[places] - total[at[:-1][rows]]


def _example_tags(tokens: Tokens, texts: list[str]) -> np.ndarray:
    """Tags of the tokens of texts from the values that the patterns match."""
    tags = np.full(len(tokens.starts), 2)
    starts = _points(tokens.data, tokens.at, tokens.starts, tokens.rows)
    ends = _points(tokens.data, tokens.at, tokens.ends, tokens.rows)
    edges = np.searchsorted(tokens.rows, np.arange(len(texts) + 1))
    for row, text in enumerate(texts):
        a, b = edges[row], edges[row + 1]
        low = text.lower()
        values = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]] if any(w in low for w in _STARTS) else []
        values += [(s, e) for s, e, kind in base_spans(text) if kind != "assign"]
        for s, e in sorted(values):
            own = a + np.flatnonzero((starts[a:b] < e) & (ends[a:b] > s))
            fresh = own[tags[own] == 2]
            tags[fresh] = 1
            if len(fresh) == len(own) and len(own):
                tags[own[0]] = 0
    return tags


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    """A field from at most ``fit_rows`` texts that may hold a secret and a quarter as many of the others, those of the smallest hashes."""
    text = F.col(f"`{text_col}`")
    low = F.lower(text)
    hint = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api") | text.contains("AKIA")
    place = F.xxhash64(F.lit(9), F.col(f"`{id_col}`"), text)
    known = docs.where(text.isNotNull()).select(F.pmod(place, F.lit(1 << 30)).alias("place"), place.alias("key"), hint.alias("hint"), text.alias("text"))
    sizes = {r["hint"]: r["n"] for r in known.groupBy("hint").agg(F.count("*").alias("n")).collect()}
    rows = []
    for which, n in sizes.items():
        near = known.where(F.col("hint") == which).where(F.col("place") <= int(min(1.0, 2.0 * fit_rows / n) * (1 << 30)))
        rows += [r["text"] for r in near.orderBy("place", "key").limit(fit_rows if which else fit_rows // 4).collect()]
    if not sizes.get(True):
        return None
    # chains: stretches around the secrets, and every sixteenth stretch of the other tokens
    kept = []
    for i in range(0, len(rows), 100):
        some = rows[i : i + 100]
        tokens = Tokens(pa.array(some, pa.large_string()))
        tags = _example_tags(tokens, some)
        _, chain = np.unique(np.arange(len(tags)) // LONGEST + tokens.rows * (len(tags) + 1), return_inverse=True)
        keep = np.bincount(chain, tags < 2) > 0
        keep |= np.arange(len(keep)) % 16 == 0
        lengths = np.bincount(chain)[keep]
        kept.append((tokens.features[keep[chain]], tags[keep[chain]], lengths))
    features, tags, lengths = (np.concatenate(x) for x in zip(*kept, strict=True))
    return fit_field(features, tags, lengths) if len(lengths) else None


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the spans as an array, and the counts and digests of the base ones."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    order = {kind: k for k, kind in enumerate((*KINDS, TAGGED))}

    def tagged(part: pa.RecordBatch) -> dict[int, list[tuple[int, int, str]]]:
        tokens = Tokens(part.column("text"))
        if field is None or not len(tokens.starts):
            return {}
        tags = field.tags(field.unary(tokens.features), tokens.rows)
        own = np.flatnonzero(tags < 2)
        new = np.ones(len(own), bool)
        new[1:] = (np.diff(own) > 1) | (tags[own[1:]] == 0) | (tokens.rows[own[1:]] != tokens.rows[own[:-1]])
        first, last = own[new], own[np.append(new[1:], True)[: len(own)]] if len(own) else own
        starts = _points(tokens.data, tokens.at, tokens.starts[first], tokens.rows[first])
        ends = _points(tokens.data, tokens.at, tokens.ends[last], tokens.rows[last])
        found: dict[int, list[tuple[int, int, str]]] = {}
        for row, start, end in zip(tokens.rows[first].tolist(), starts.tolist(), ends.tolist(), strict=True):
            found.setdefault(row, []).append((start, end, TAGGED))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch):
                more = tagged(part)
                counts, digests, lists = [], [], []
                for row, text in enumerate(part.column("text").to_pylist()):
                    base = base_spans(text)
                    extra = [s for s in more.get(row, []) if not any(s[0] < e and s[1] > b for b, e, _ in base)]
                    counts.append([sum(s[2] == kind for s in base) for kind in KINDS])
                    digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    lists.append(_joined(sorted(base + extra, key=lambda s: (s[0], order[s[2]]))))
                numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(lists, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
