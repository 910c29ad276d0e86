"""Language identification: script ranges narrow the candidates, Viterbi labels spans of words.

Learned per language: counts of hashed byte trigrams and of hashed words (tables of fixed size), and in
which scripts its words are written. A word's score is its log-likelihood under each language that its
script allows; Viterbi over a text's words pays a penalty for every switch. The steps of
all texts of a batch are taken together, so the Python work is per position, not per word.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm.shared import id_remainder
from terraflux.llm.tokens import Tokens, batches, texts_of

HOLD_OUT = 5
#: Slots of the trigram table and of the word table, each.
SLOTS = 1 << 14
#: Languages that are counted in one pass: bounds a task's counts. More languages mean more passes, never fewer languages.
LANGUAGES = 200
SWITCH = 10.0
#: A script is a language's own if this share of its words is written in it.
SCRIPT_SHARE = 0.01
#: Scores (words x languages) that are held at once.
SCORES = 1 << 24
#: A text of more than so many batches is labelled piece by piece.
LONG = 4
_SPACE = re.compile(rb"[\x20\x09-\x0D]")

# First and last code point of scripts, in code point order.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0531, 0x058A), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF), ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("latin", 0x1E00, 0x1EFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
NAMES = ["none", *dict.fromkeys(name for name, _, _ in SCRIPTS), "other"]


#: Code points up to here have a script; letters beyond there are none.
_LAST = 0x40000


def _script_table() -> np.ndarray:
    """Script of every code point: letters only, 0 for anything else."""
    out = np.zeros(_LAST, np.int8)
    letters = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(_LAST)), bool, _LAST)
    out[letters] = NAMES.index("other")
    for name, lo, hi in SCRIPTS:
        own = np.arange(lo, hi + 1)
        out[own[letters[own]]] = NAMES.index(name)
    return out


_TABLE = _script_table()


class Words:
    """Scripts, letters and feature slots of the words of some texts."""

    def __init__(self, texts: list[bytes | None]):
        t = self.tokens = Tokens(texts)
        buf = t.buf.copy()
        lead = np.flatnonzero(buf >= 0xC0)
        after = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int32)
        b0, b1, b2, b3 = after[lead], after[lead + 1] & 63, after[lead + 2] & 63, after[lead + 3] & 63
        code = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1, np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        script = np.where(code < _LAST, _TABLE[np.minimum(code, _LAST - 1)], 0).astype(np.int8)
        of_byte = np.where(buf < 0x80, _TABLE[buf], 0).astype(np.int8)
        of_byte[lead] = script
        capital = lead[(b0 == 0xC3) & (b1 < 0x1F) & (b1 != 0x17)]  # À to Þ
        buf[capital + 1] += 0x20
        space = np.ones(len(buf), bool)
        counts = t.ends - t.starts
        inside = np.repeat(t.starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(counts) else np.zeros(0, np.int64)
        space[inside] = False
        clean = np.where(space, 0x20, buf).astype(np.uint32)
        before, behind = np.concatenate([[0x20], clean[:-1]]).astype(np.uint32), np.concatenate([clean[1:], [0x20]]).astype(np.uint32)
        slot = ((before << np.uint32(16) | clean << np.uint32(8) | behind) * np.uint32(0x9E3779B1) >> np.uint32(18)).astype(np.int32)
        self.slots, self.inside = slot[inside], inside
        self.bounds = np.concatenate([[0], np.cumsum(counts)])
        self.word_slots = (t.hashes() & np.uint64(SLOTS - 1)).astype(np.int64)
        if len(t.starts):
            self.scripts = np.maximum.reduceat(of_byte[inside], self.bounds[:-1])
            self.letters = np.add.reduceat((of_byte[inside] > 0).astype(np.int32), self.bounds[:-1])
        else:
            self.scripts, self.letters = np.zeros(0, np.int8), np.zeros(0, np.int32)


class Model:
    """Log-likelihoods per slot and language, and scripts per language."""

    def __init__(self, languages: list[str], trigrams: np.ndarray, words: np.ndarray, scripts: np.ndarray):
        self.languages = languages
        k = len(languages)
        if not k:
            return
        # counts are (language, slot)
        self.trigrams, self.words = (self._weights(c) for c in (trigrams, words))
        share = scripts / np.maximum(scripts[:, 1:].sum(axis=1, keepdims=True), 1)
        allowed = (share >= SCRIPT_SHARE).T
        allowed[0] = True
        allowed[~allowed.any(axis=1)] = True
        self.barred = np.where(allowed, 0, -50).astype(np.float32)

    @staticmethod
    def _weights(counts: np.ndarray) -> np.ndarray:
        logs = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * SLOTS))
        return np.ascontiguousarray((logs - logs.mean(axis=0)).T.astype(np.float32))

    def word_scores(self, w: Words) -> np.ndarray:
        if not len(w.word_slots):
            return np.zeros((0, len(self.languages)), np.float32)
        scores = self.words[w.word_slots]
        step = max(SCORES // len(self.languages), 1 << 12)
        for at in range(0, len(w.slots), step):  # a slice of the bytes at once: a word may be as long as its text
            low, high = np.searchsorted(w.bounds, at, "right") - 1, np.searchsorted(w.bounds, min(at + step, len(w.slots)), "left")
            scores[low:high] += np.add.reduceat(self.trigrams[w.slots[at : at + step]], np.maximum(w.bounds[low:high] - at, 0), axis=0)
        scores[w.scripts == 0] = 0  # numbers and marks say nothing
        return scores + self.barred[w.scripts]

    def label(self, texts: list[bytes | None]) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """(texts, first word per text, letters per word, language per word) of runs of texts."""
        held, begin, words = [], 0, 0
        size = max(1 << 16, (8 << 20) // max(len(self.languages), 4))

        def held_out() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            counts, letters, scores = (np.concatenate(x) for x in zip(*held, strict=True))
            first = np.concatenate([[0], np.cumsum(counts)])
            return first, letters, viterbi(scores, first)

        for part in batches(texts, size):
            if part.stop - part.start == 1 and len(texts[part.start] or b"") > LONG * size:
                if held:
                    yield slice(begin, part.start), *held_out()
                yield part, *self._long(texts[part.start], size)
                held, begin, words = [], part.stop, 0
                continue
            w = Words(texts[part])
            held.append((w.tokens.counts, w.letters, self.word_scores(w)))
            words += len(w.letters)
            if words * len(self.languages) >= SCORES:
                yield slice(begin, part.stop), *held_out()
                held, begin, words = [], part.stop, 0
        if held:
            yield slice(begin, len(texts)), *held_out()

    def _long(self, text: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, letters per word, language per word) of one long text, in pieces of about ``size`` bytes that are cut between words.

        The values of Viterbi go on from piece to piece; of every word only a bit for each language and the best language before are kept.
        """
        k = len(self.languages)
        value, letters, stays, best = np.zeros(k, np.float32), [], [], []
        for piece in pieces(text, size):
            w = Words([piece])
            scores = self.word_scores(w)
            stay, top_of = np.empty(scores.shape, bool), np.empty(len(scores), np.int32)
            for t in range(len(scores)):
                top = value.argmax()
                least = value[top] - np.float32(SWITCH)
                np.greater_equal(value, least, out=stay[t])
                top_of[t] = top
                np.maximum(value, least, out=value)
                value += scores[t]
            letters.append(w.letters)
            stays.append(np.packbits(stay, axis=1))
            best.append(top_of)
        label, now = [], int(value.argmax())
        for packed, top_of in zip(reversed(stays), reversed(best), strict=True):
            own = np.empty(len(top_of), np.int32)
            for t in range(len(top_of) - 1, -1, -1):
                own[t] = now
                if not packed[t, now >> 3] >> (7 - (now & 7)) & 1:
                    now = int(top_of[t])
            label.append(own)
        letters, label = np.concatenate(letters), np.concatenate(label[::-1])
        return np.array([0, len(label)]), letters, label

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """Language with most letters of each text, and its share of the letters; no letter: ``und`` and 0."""
        labels, scores, k = [], [], len(self.languages)
        if not k:
            return ["und"] * len(texts), np.zeros(len(texts))
        for part, first, letters, label in self.label(texts):
            n = len(first) - 1
            doc = np.repeat(np.arange(n), np.diff(first))
            mass = np.bincount(doc * k + label, letters, n * k).reshape(n, k)
            total, best = mass.sum(axis=1), mass.argmax(axis=1)
            best[total == 0] = -1
            labels += [self.languages[b] if b >= 0 else "und" for b in best.tolist()]
            scores.append(np.where(total > 0, mass.max(axis=1) / np.maximum(total, 1), 0))
        return labels, np.concatenate(scores) if scores else np.zeros(0)

    def spans(self, texts: list[bytes | None]) -> list[list[dict]]:
        """Runs of words of one language: language, first word, number of words, letters."""
        out: list[list[dict]] = []
        if not self.languages:
            return [[] for _ in texts]
        for _, first, letters, label in self.label(texts):
            for a, b in zip(first[:-1], first[1:], strict=True):
                cuts = np.flatnonzero(np.diff(label[a:b])) + 1
                edges = [0, *cuts.tolist(), b - a] if b > a else [0]
                out.append([{"language": self.languages[label[a + i]], "start": i, "words": j - i, "letters": int(letters[a + i : a + j].sum())} for i, j in zip(edges, edges[1:], strict=False)])
        return out


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of ``size`` bytes or a little more, each of which ends before white space."""
    at = 0
    while at < len(text):
        gap = _SPACE.search(text, at + size)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def viterbi(scores: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best language of every word if each switch costs ``SWITCH``; words ``first[d]:first[d + 1]`` are one text."""
    n, k = len(first) - 1, scores.shape[1]
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    begins, longest = first[:-1][order], int(counts.max(initial=0))
    active = np.searchsorted(-counts[order], -np.arange(longest), "left")  # texts with more than t words
    value = np.zeros((n, k), np.float32)
    stays, best = np.ones(scores.shape, bool), np.zeros(len(scores), np.int32)
    row = np.arange(n)
    for t in range(longest):
        a = active[t]
        at, v = begins[:a] + t, value[:a]
        top = v.argmax(axis=1)
        least = (v[row[:a], top] - SWITCH)[:, None]
        stays[at], best[at] = v >= least, top
        value[:a] = np.maximum(v, least) + scores[at]
    out, now = np.zeros(len(scores), np.int32), value.argmax(axis=1).astype(np.int32)
    for t in range(longest - 1, -1, -1):
        a = active[t]
        at, here = begins[:a] + t, now[:a]
        out[at] = here
        now[:a] = np.where(stays[at, here], here, best[at])
    return out


def train(docs: DataFrame) -> Model:
    """Learn from every row with a language whose crc32 remainder is not 0; null text counts as empty.

    Every language is learned, ``LANGUAGES`` of them in a pass. Only counts come to the driver; the
    model has two tables of ``SLOTS`` for each language.
    """
    own = docs.filter("lang is not null").filter(id_remainder(F.col("doc_id"), HOLD_OUT) != 0)
    languages = sorted(r["lang"] for r in own.select("lang").distinct().collect())
    sums = np.zeros((len(languages), 2 * SLOTS + len(NAMES)), np.float32 if len(languages) > LANGUAGES else np.float64)
    for begin in range(0, len(languages), LANGUAGES):
        block = languages[begin : begin + LANGUAGES]
        part = own if len(block) == len(languages) else own.filter(F.col("lang").isin(block))
        sums[begin : begin + len(block)] = _counts(part, block)
    return Model(languages, sums[:, :SLOTS], sums[:, SLOTS : 2 * SLOTS], sums[:, 2 * SLOTS :])


def _counts(docs: DataFrame, languages: list[str]) -> np.ndarray:
    """Counts of trigrams, words and scripts in the rows of some languages: (language, slot)."""
    number = {lang: i for i, lang in enumerate(languages)}
    width = 2 * SLOTS + len(NAMES)

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(languages) * width, np.int64)
        for batch in found:
            texts = texts_of(batch)
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()])
            for part in batches(texts):
                w = Words(texts[part])
                of_word = np.repeat(lang[part], w.tokens.counts)
                of_byte = np.repeat(of_word, np.diff(w.bounds))
                for at, slot in ((of_byte, w.slots), (of_word, SLOTS + w.word_slots), (of_word, 2 * SLOTS + w.scripts.astype(np.int64))):
                    sums += np.bincount(at * width + slot, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["slot", "n"])

    text = docs.select("lang", F.col("text").cast("binary").alias("text"))
    rows = text.mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(len(languages) * width)
    sums[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return sums.reshape(len(languages), width)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its text alone.

    score is the share of the text's letters in spans of lang_pred. Null texts and texts without a letter:
    ``und``, 0; signs, digits and emoji are no letters in any plane. A model of no
    language gives ``und``. Repeated rows and null ids come back; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            labels, scores = sent.value.predict(texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    held = id_remainder(F.col("doc_id"), HOLD_OUT) == 0
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double").select("doc_id", held.alias("held_out"), "lang_pred", "score")


def language_spans(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans) of every row: runs of words labelled with one language, in text order."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("language", pa.string()), ("start", pa.int64()), ("words", pa.int64()), ("letters", pa.int64())]))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sent.value.spans(texts_of(batch)), kind)], ["doc_id", "spans"])

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, "doc_id long, spans array<struct<language:string,start:long,words:long,letters:long>>")
