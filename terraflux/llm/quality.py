"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are complete and of one depth, so a forest is three flat arrays and a batch of rows walks all
trees level by level in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm.shared import id_remainder
from terraflux.llm.tokens import Tokens, batches

#: Labelled rows that are fitted on, about: a hash of doc_id picks them evenly where there are more.
SAMPLE = 20_000
HOLD_OUT = 5
THRESHOLD = 0.3
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.15

FEATURES = [
    "log_words", "log_bytes", "bytes_per_word", "upper", "digits", "marks", "odd_marks", "not_ascii", "lines",
    "same_as_previous", "distinct_words", "short_words", "long_words", "mark_words", "capital_words", "stops", "word_bytes_sd",
]


def _kind(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int32)
    out[list(chars)] = 1
    return out


_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_KINDS = [_kind(bytes(range(65, 91))), _kind(b"0123456789"), _kind(_MARKS), _kind(bytes(c for c in _MARKS if chr(c) not in ".,;:'\"-()?!")), _kind(bytes(range(128, 256))), _kind(b"\n"), _kind(b".?!")]


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of ``FEATURES`` per text; null and empty texts are a row of zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for part in batches(texts):
        t = Tokens(texts[part])
        cased = np.frombuffer(t.cased, np.uint8)
        size, n = np.diff(t.offsets) - 1, t.counts
        per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(n, 1)
        upper, digits, marks, odd, high, lines, stops = (np.add.reduceat(kind[cased], t.offsets[:-1]) for kind in _KINDS)
        lines = lines - 1  # the separator
        doc, hashes, width = t.doc_of_word(), t.hashes(), t.ends - t.starts

        def share(of_words: np.ndarray, doc=doc, k=t.n, per_word=per_word) -> np.ndarray:
            return np.bincount(doc, of_words, k) * per_word

        same = np.zeros(len(doc), bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        order = np.lexsort((hashes, doc))
        new = np.ones(len(doc), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        mean = share(width)
        head, tail = cased[t.starts], cased[t.ends - 1]
        cols = [
            np.log1p(n), np.log1p(size), mean, upper * per_byte, digits * per_byte, marks * per_byte, odd * per_byte, high * per_byte, lines * per_word,
            share(same), np.bincount(doc[order], new, t.n) * per_word, share(width <= 3), share(width > 12), share((_KINDS[2][tail] > 0) & (_KINDS[2][head] > 0)),
            share(_KINDS[0][head]), stops * per_word, np.sqrt(np.maximum(share(width.astype(float) ** 2) - mean**2, 0)),
        ]
        out[part] = np.stack(cols, axis=1)
    return out


class Forest:
    """``feature``, ``cut`` (trees x inner nodes) and ``leaf`` (trees x leaves), nodes in level order."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.cut, self.leaf = base, feature, cut, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boosted trees for logistic loss. No rows: 0.5 for everything; one class only: its smoothed share."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Forest(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    total, found = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), int)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-3)
            at = node - first
            pick = np.full(width, BINS)
            for j in range(x.shape[1]):
                key = at * BINS + bins[:, j]
                left_g = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                left_h = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
                gain = np.where((left_h > 1) & (right_h > 1), gain, 0)[:, : len(cuts[j])]
                if not gain.shape[1]:
                    continue
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                better = value > best
                best[better], pick[better] = value[better], top[better]
                feature[first : first + width][better] = j
                cut[first : first + width][better] = cuts[j][top[better]]
            node = 2 * node + 1 + (bins[np.arange(len(y)), feature[node]] > pick[at])
        sums_g, sums_h = (np.bincount(node - inner, v, leaves) for v in (g, h))
        leaf = -RATE * sums_g / (sums_h + 1)
        total += leaf[node - inner]
        found.append((feature, cut, leaf))
    return Forest(base, *(np.stack(part) for part in zip(*found, strict=True)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit on the labelled rows whose crc32 remainder is not 0, about ``sample`` of them at most.

    Rows without text count as empty; labels other than 0 and 1 and ids that one table lacks are left out.
    """
    named = labels.filter("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality"))
    named = named.filter(id_remainder(F.col("doc_id"), HOLD_OUT) != 0)
    share = min(1.0, sample / max(named.count(), 1))
    picked = named.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))

    def measure(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            x = statistics(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    # picked has about ``sample`` rows whatever the corpus, so it may go to every task
    rows = own.join(F.broadcast(picked), "doc_id").mapInArrow(measure, "doc_id long, quality int, x array<double>").toPandas()
    rows = rows.sort_values(["doc_id", "quality"])
    x = np.stack(rows.x.to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    return fit(x, rows.quality.to_numpy(float))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; other columns are ignored, repeated rows come back."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            own = sent.value.score(statistics(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own)], ["doc_id", "score"])

    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    scored = own.mapInArrow(run, "doc_id long, score double")
    held = id_remainder(F.col("doc_id"), HOLD_OUT) == 0
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, forest: Forest) -> DataFrame:
    """The rows of ``docs``, all columns, that are predicted 1."""
    sent, at = docs.sparkSession.sparkContext.broadcast(forest), docs.columns.index("text")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            yield batch.filter(pa.array(sent.value.score(statistics(batch.column(at).cast(pa.binary()).to_pylist())) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
