"""Language identification by segmentation-marginalised unigrams.

A language gives a probability to each piece of a fixed public vocabulary. The probability of a
word is the sum, over all ways of cutting it into pieces, of the product of their
probabilities, computed by a forward pass over its bytes; a text's is the product over its words. Piece
probabilities are fitted by expectation maximisation (forward and backward passes over the
words of a bounded sample of labelled rows for each language). Every byte is a piece of its
own, so each word has a probability.

Words are runs of letters (ASCII letters and all bytes above 127) of the lower-cased text, each
with the vocabulary's word-start mark before it. Pieces of all lengths of the vocabulary count, and words of any length
are scored whole. The best language has the highest total; the score is the posterior at the
mean word, raised to at most ``WORDS_COUNTED`` words, so that it says how clearly the text speaks
for one language and not how long it is.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is everything
if there is nothing to learn from; ties go to the language that sorts first; repeated rows
are scored alike; rows with a null id are scored, never learned from and not held out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.llm import words as W
from harborline.llm.tables import fresh, held_out, third

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Words of up to so many bytes are scored together by length, longer ones each on its own; fitting leaves the longer ones out.
MOST_BYTES = 48
WORDS_COUNTED = 12
#: Places of a long word of which the spans are looked up at once.
LONG_STEP = 1 << 15
FIT_ROWS, ROUNDS, LEAST = 400, 4, 1e-6
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
VALUES = W.byte_values(~LETTER)
_TERM = W.randoms(256, 42)


class Pieces:
    """Vocabulary pieces by the hash of their bytes; ids below 256 are single bytes."""

    def __init__(self, pieces: set[bytes]):
        self.all = [bytes([b]) for b in range(256)] + sorted(p for p in pieces if len(p) > 1)
        self.longest = max(map(len, self.all))
        self.places = W.randoms(self.longest, 41)
        keys = np.array([sum(int(_TERM[b]) * int(self.places[k]) for k, b in enumerate(p)) % (1 << 64) for p in self.all], np.uint64)
        self.levels, left = [], np.arange(256, len(keys))
        while len(left):  # a slot holds one piece; those that find theirs taken go to the next level
            bits = max(10, int(len(left) - 1).bit_length() + 4)
            slots = self._slots(keys[left], bits, len(self.levels))
            _, first = np.unique(slots, return_index=True)
            table, own = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            table[slots[first]], own[slots[first]] = keys[left[first]], left[first]
            self.levels.append((bits, table, own))
            left = np.delete(left, first)

    @staticmethod
    def _slots(keys: np.ndarray, bits: int, level: int) -> np.ndarray:
        return ((keys * W.randoms(level + 1, 43)[level]) >> np.uint64(64 - bits)).astype(np.int64)

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, or -1."""
        out = np.full(keys.shape, -1, np.int32)
        for level, (bits, table, own) in enumerate(self.levels):
            slots = self._slots(keys, bits, level)
            np.copyto(out, own[slots], where=(table[slots] == keys) & (own[slots] >= 0))
        return out

    def arcs(self, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """For words as rows of equally many bytes: ``(start, end, ids)`` of all spans, by their end."""
        n = rows.shape[1]
        ids = {}
        for start in range(n):
            keys = np.zeros(len(rows), np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                keys = keys + _TERM[rows[:, end - 1]] * self.places[end - 1 - start]
                ids[start, end] = rows[:, start].astype(np.int32) if end == start + 1 else self.ids(keys)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                yield start, end, ids[start, end]

    def spans(self, word: np.ndarray) -> Iterator[np.ndarray]:
        """For each end in one word of any length: the pieces of the spans that end there, from the shortest."""
        for begin in range(0, len(word), LONG_STEP):
            first = max(0, begin - self.longest + 1)
            terms = _TERM[word[first : begin + LONG_STEP]]
            ids = np.full((len(terms), self.longest), -1, np.int32)
            ids[:, 0] = word[first : begin + LONG_STEP]
            keys = terms * self.places[0]
            for size in range(2, min(self.longest, len(terms)) + 1):
                keys = keys[:-1] + terms[size - 1 :] * self.places[size - 1]
                ids[size - 1 :, size - 1] = self.ids(keys)
            yield from ids[begin - first :]


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The pieces of a sentencepiece model in lower case, the word-start mark as a space."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    some = (model.id_to_piece(i).lower().replace("▁", " ").encode() for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    return Pieces({p for p in some if b" " not in p[1:] and all(LETTER[b] for b in p.lstrip(b" "))})


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and rows of the words of the lower-cased texts."""
    data, at = W.utf8(pc.utf8_lower(column.fill_null("")))
    return data, *W.spans(data, at, LETTER[data])


def _by_length(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length of up to ``MOST_BYTES`` at a time: their places, and their bytes after the word-start mark."""
    for n in np.unique(lengths[lengths <= MOST_BYTES]):
        own = np.flatnonzero(lengths == n)
        rows = np.full((len(own), n + 1), 32, np.uint8)
        rows[:, 1:] = data[starts[own][:, None] + np.arange(n)]
        yield own, rows


class Model:
    def __init__(self, pieces: Pieces, langs: list[str], chances: np.ndarray):
        self.pieces, self.langs = pieces, langs
        self.chances = np.vstack([chances, np.zeros(len(langs))])  # the last row answers for -1: no piece

    def log_chances(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        out = np.zeros((len(starts), len(self.langs)))
        for own, rows in _by_length(data, starts, lengths):
            ahead = np.zeros((rows.shape[1] + 1, len(rows), len(self.langs)))
            ahead[0] = 1
            for start, end, ids in self.pieces.arcs(rows):
                some = np.flatnonzero(ids >= 0)
                if len(some) == len(ids):
                    ahead[end] += ahead[start] * self.chances[ids]
                elif len(some):
                    ahead[end, some] += ahead[start, some] * self.chances[ids[some]]
            out[own] = np.log(ahead[-1])
        for i in np.flatnonzero(lengths > MOST_BYTES):
            out[i] = self._long_word(np.append(np.uint8(32), data[starts[i] : starts[i] + lengths[i]]))
        return out

    def _long_word(self, word: np.ndarray) -> np.ndarray:
        """The same for one word of any length: sums of the last places only, scaled anew at each."""
        behind = np.zeros((self.pieces.longest, len(self.langs)))  # from the nearest place
        behind[0] = 1
        scale = np.zeros(len(self.langs))
        for ids in self.pieces.spans(word):
            total = (behind * self.chances[ids]).sum(axis=0)
            scale += np.log(total)
            behind[1:] = behind[:-1] / total
            behind[0] = 1
        return scale

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text, as a number, and its score."""
        data, starts, ends, rows = _words(column)
        _, first, word = np.unique(W.span_hashes(data, starts, ends, VALUES), return_index=True, return_inverse=True)
        each = self.log_chances(data, starts[first], (ends - starts)[first])[word]
        total = np.zeros((len(column), len(self.langs)))
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(rows, each[:, k], minlength=len(column))
        n = np.bincount(rows, minlength=len(column))[:, None]
        mean = total / np.maximum(n, 1) * np.minimum(np.maximum(n, 1), WORDS_COUNTED)
        odds = np.exp(mean - mean.max(axis=1, keepdims=True))
        return total.argmax(axis=1), (odds / odds.sum(axis=1, keepdims=True)).max(axis=1)


def fit_chances(pieces: Pieces, texts: list[str], rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation over its distinct words."""
    data, starts, ends, _ = _words(pa.array(texts, pa.large_string()))
    _, first, counts = np.unique(W.span_hashes(data, starts, ends, VALUES), return_index=True, return_counts=True)
    groups = [(counts[own].astype(float), list(pieces.arcs(rows)), rows.shape[1]) for own, rows in _by_length(data, starts[first], (ends - starts)[first])]
    chances = np.full(len(pieces.all) + 1, 1.0 / len(pieces.all))
    chances[-1] = 0
    for _ in range(rounds):
        used = np.zeros(len(chances))
        for weight, arcs, n in groups:
            ahead, behind = np.zeros((n + 1, len(weight))), np.zeros((n + 1, len(weight)))
            ahead[0], behind[n] = 1, 1
            for start, end, ids in arcs:
                ahead[end] += ahead[start] * chances[ids]
            for start, end, ids in reversed(arcs):
                behind[start] += behind[end] * chances[ids]
            for start, end, ids in arcs:
                used += np.bincount(ids % len(chances), ahead[start] * chances[ids] * behind[end] / ahead[n] * weight, minlength=len(chances))
        used[-1] = 0
        chances = np.maximum(used / max(used.sum(), 1e-300), LEAST)
        chances[-1] = 0
        chances /= chances.sum()
    return chances[:-1]


def fit(docs: DataFrame, path: str = VOCABULARY, per_lang: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from at most ``per_lang`` rows for each language, those of the smallest hashes outside the held-out third."""
    text, lang, doc_id = F.col(f"`{text_col}`"), F.col(f"`{lang_col}`"), F.col(f"`{id_col}`")
    known = docs.where((third(doc_id) != 1) & lang.isNotNull() & text.rlike("\\p{L}")).select(doc_id.alias("id"), text.alias("text"), lang.alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # twice the rows wanted, so that the limit below meets a few rows instead of the whole table
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2.0 * per_lang / n))]) if sizes else None
    if share is None:
        return None
    place = F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(1 << 30))
    some = known.where(place < share[F.col("lang")] * F.lit(1 << 30)).withColumn("place", place)
    rows = some.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("place", "id", "text"))), 1, per_lang).alias("rows")).collect()
    found = {r["lang"]: [x["text"] for x in r["rows"]] for r in rows}
    langs, pieces = sorted(found), load_pieces(path)
    return Model(pieces, langs, np.stack([fit_chances(pieces, found[k]) for k in langs], axis=1)) if langs else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred``, ``score``."""
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    source = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.coalesce(text.rlike("\\p{L}"), F.lit(False)).alias("worded"), text.alias("text"))
    if model is None:
        return source.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch):
                lang, score = judged(model, part.column("text"), part.column("worded"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), lang, score], ["doc_id", "held_out", "lang_pred", "score"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def judged(model: Model, texts: pa.Array, worded: pa.Array) -> tuple[pa.Array, pa.Array]:
    best, score = model.texts(texts)
    lang = pa.array(np.array(model.langs, object)[best], pa.string())
    return pc.if_else(worded, lang, "und"), pc.if_else(worded, pa.array(score), 0.0)


def in_known_language(docs: DataFrame, least: float = 0.5, path: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """The documents that clearly are in one of the learned languages (score of ``least`` or more), all columns."""
    model = fit(docs, path)
    if model is None:
        return docs.where(F.lit(False))
    own, flag = docs.columns, fresh(docs, "_worded")
    marked = docs.withColumn(flag, F.coalesce(F.col(f"`{text_col}`").rlike("\\p{L}"), F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.steps(batch, text_col):
                _, score = judged(model, part.column(text_col), part.column(flag))
                yield part.filter(pc.and_(part.column(flag), pc.greater_equal(score, least))).select(own)

    return marked.mapInArrow(run, docs.schema)
