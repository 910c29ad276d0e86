"""Log-bilinear language model trained by noise-contrastive estimation.

Vocabulary and counts are exact and of all training rows. The bilinear part predicts one of ``CLASSES``
word classes from the classes of the two words before: the commonest words are classes of
their own, the others share classes by their last three bytes, so an unseen word has one too. A word's
probability is its class's, normalised over all classes, times that of the word within its class after the class before
(``lm_words``). Words that are not common share one outcome of their class by smoothed counts, unseen words
among them, so the probabilities of all words add up to one.

Training needs two counts of the texts, how many positions have each class after each pair of classes, and each common word after each class.
They are exact and of all positions, from one pass, and their table is bounded by the number of classes and common words. It is dealt to
tasks by its key: each runs stochastic steps from common parameters on its part of the positions, in which a
gram of count n weighs n, and the results are averaged, weighted by their steps, after each round. The
class log-probabilities of all pairs of context classes are made once per worker by batched matrix products.

Counts of rare words are never sent around whole: a text's rare words go to the counts by a join.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm import gram_counts, lm_words
from terraflux.llm.shared import discard, id_remainder, materialise
from terraflux.llm.tokens import U64, Tokens, batches, mix, texts_of

HOLD_OUT = 10
CLASSES = 256
#: Class 0 stands before a text (context only), class 1 is the end; then the commonest words.
OWN = 96
TAILS = CLASSES - 2 - OWN
WIDTH = 16
CONTEXT = 2
#: A round trains on every second of the positions, the next round on those between: together they have each position once.
STRIDE = 2
ROUNDS = 2
#: So often do the rounds go over all positions.
EPOCHS = 4
NOISE = 48
STEP = 512
#: Distinct class grams of a training task, and grams that are counted at once.
TASK_ROWS = 1 << 18
GRAMS = 1 << 22
RATE = 0.2
SMOOTH = 0.1
#: Words whose counts go to every task: all those above some count, at most so many.
COMMON = 1 << 17
#: Codes below are (class two before, class before, class), those from here on (outcome, class before).
WORDS_FROM = CLASSES**3

END = np.uint64(0x5851F42D4C957F2D)
#: Parameters: context rows, context matrices, target rows, biases.
_SHAPES = [(CLASSES, WIDTH), (CONTEXT, WIDTH, WIDTH), (CLASSES, WIDTH), (CLASSES,)]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Text:
    """Token hashes and tail classes of some texts, an end after each: ``first[d]:first[d + 1]`` is text ``d``."""

    def __init__(self, texts: list[bytes | None]):
        t = Tokens(texts)
        self.n = t.n
        self.first = t.first + np.arange(t.n + 1)
        words = np.ones(self.first[-1], bool)
        self.ends = self.first[1:] - 1
        words[self.ends] = False
        self.hashes = np.full(len(words), END, U64)
        self.hashes[words] = t.hashes()
        size = t.ends - t.starts
        last = [np.where(size > i, t.buf[np.maximum(t.ends - 1 - i, 0)], 0).astype(np.uint64) for i in range(3)]
        self.tails = np.zeros(len(words), np.int64)
        self.tails[words] = (mix(last[0] | last[1] << U64(8) | last[2] << U64(16)) % U64(TAILS)).astype(np.int64)
        self.doc = np.repeat(np.arange(t.n), np.diff(self.first))


class Vocabulary:
    """What every task knows: common words with their counts, class sizes, and totals."""

    def __init__(self, n: int, v: int, hashes: np.ndarray, counts: np.ndarray, tails: np.ndarray, tail_counts: np.ndarray, tail_types: np.ndarray):
        self.n, self.v = n, v
        order = np.argsort(hashes)
        self.hashes, self.counts, own_tails = hashes[order], counts[order], tails[order]
        by_count = np.lexsort((hashes, -counts))
        own = by_count[hashes[by_count] != END][:OWN]
        self.own_hashes = np.sort(hashes[own])
        np.subtract.at(tail_counts, tails[own], counts[own])
        np.subtract.at(tail_types, tails[own], 1)
        ends = counts[hashes == END].sum()
        at = np.searchsorted(self.hashes, self.own_hashes)
        own_counts = np.zeros(OWN)
        own_counts[: len(own)] = self.counts[at]
        #: Smoothed size of each tail class: its words and one outcome for unseen ones.
        self.tail_mass = tail_counts + SMOOTH * (tail_types + 1)
        inner = (self.hashes != END) & ~np.isin(self.hashes, self.own_hashes)
        rare_counts = tail_counts - np.bincount(own_tails[inner], self.counts[inner], TAILS)
        rare_types = tail_types - np.bincount(own_tails[inner], minlength=TAILS)
        #: The part of it that is not of common words.
        self.rare_mass = rare_counts + SMOOTH * (rare_types + 1)
        #: Outcomes within the classes: the common words by place (those with a class of their own are never met), then one for the rest of each class.
        self.outcome_tail = np.concatenate([own_tails, np.arange(TAILS)])
        share = np.concatenate([np.where(inner, self.counts + SMOOTH, 0), self.rare_mass]) / self.tail_mass[self.outcome_tail]
        self.outcome_share = np.maximum(share, 1e-300)
        mass = np.concatenate([[0, ends], own_counts, tail_counts]) + SMOOTH
        mass[0] = 0
        self.class_share = mass / mass.sum()
        self.base_size = np.log10(n + SMOOTH * (v + 1))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places of common words; -1 for others."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def outcomes(self, places: np.ndarray, tails: np.ndarray) -> np.ndarray:
        """Outcomes within their classes of words of tail classes."""
        return np.where(places >= 0, places, len(self.hashes) + tails)

    def classes(self, text: Text) -> np.ndarray:
        out = 2 + OWN + text.tails
        if len(self.own_hashes):
            at = np.minimum(np.searchsorted(self.own_hashes, text.hashes), len(self.own_hashes) - 1)
            out = np.where(self.own_hashes[at] == text.hashes, 2 + at, out)
        out[text.ends] = 1
        return out


def contexts(classes: np.ndarray, text: Text) -> list[np.ndarray]:
    """Classes of the word 1 before, 2 before, ... within the text; 0 before its beginning."""
    place = np.arange(len(classes)) - text.first[:-1][text.doc]
    return [np.where(place >= i, np.concatenate([np.zeros(i, np.int64), classes[:-i]])[: len(classes)], 0) for i in range(1, CONTEXT + 1)]


def start(vocabulary: Vocabulary) -> list[np.ndarray]:
    draw = np.random.default_rng(3)
    x, c, r = (draw.normal(0, 0.1, s) for s in _SHAPES[:3])
    c = c + np.eye(WIDTH)
    return [x, c, r, np.log(np.maximum(vocabulary.class_share, 1e-12))]


def flat(parameters: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parameters])


def shaped(values: np.ndarray) -> list[np.ndarray]:
    cuts = np.cumsum([int(np.prod(s)) for s in _SHAPES])[:-1]
    return [p.reshape(s) for p, s in zip(np.split(values, cuts), _SHAPES, strict=True)]


def positions(n: int, number: int) -> np.ndarray:
    """Those of ``n`` places that round ``number`` trains on; ``ROUNDS`` rounds together have every place once."""
    return np.arange(number % STRIDE, n, STRIDE)


def entries(n: np.ndarray, cap: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, weight): row i with count n[i] in equal parts of at most ``cap``, so that no step is one heavy row's."""
    parts = np.ceil(n / cap).astype(np.int64)
    return np.repeat(np.arange(len(n)), parts), np.repeat(n / parts, parts).astype(np.float32)


def _summed(rows: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """out[k] += the sum of the rows at k, for few different k: sorted runs are added up at once."""
    order = np.argsort(at.astype(np.int16), kind="stable")
    own = at[order]
    begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    out[own[begin]] += np.add.reduceat(rows[order], begin, axis=0)


class Trainer:
    """Noise-contrastive estimation with AdaGrad steps; noise is drawn from the class shares, anew for each step."""

    def __init__(self, parameters: list[np.ndarray], share: np.ndarray, seed: int):
        self.p = [p.astype(np.float32) for p in parameters]
        self.squares = [np.full_like(p, 1e-2) for p in self.p]
        self.cumulated, self.draw = np.cumsum(share), np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * np.maximum(share, 1e-12)).astype(np.float32)
        self.steps = 0

    def step(self, before: list[np.ndarray], target: np.ndarray, weight: np.ndarray) -> None:
        """One step on some positions; their weights are 1 on the average over all steps."""
        x, c, r, b = self.p
        noise = np.minimum(np.searchsorted(self.cumulated, self.draw.random(NOISE), "right"), CLASSES - 1)
        rows = [x[k] for k in before]
        q = sum(row @ m for row, m in zip(rows, c, strict=True))
        own = r[target]
        true = weight * _logistic(self.log_noise[target] - np.einsum("ij,ij->i", q, own) - b[target])
        false = _logistic(q @ r[noise].T + (b - self.log_noise)[noise])
        false *= -weight[:, None]
        dq = true[:, None] * own + false @ r[noise]
        grads = [np.zeros_like(p) for p in self.p]
        for k, row, m, g in zip(before, rows, c, grads[1], strict=True):
            _summed(dq @ m.T, k, grads[0])
            g += row.T @ dq
        _summed(true[:, None] * q, target, grads[2])
        np.add.at(grads[2], noise, false.T @ q)
        grads[3] += np.bincount(target, true, CLASSES).astype(np.float32)
        np.add.at(grads[3], noise, false.sum(axis=0))
        for p, g, s in zip(self.p, grads, self.squares, strict=True):
            g /= np.float32(len(target))
            s += g * g
            p += np.float32(RATE) * g / np.sqrt(s)
        self.steps += 1


def _logistic(x: np.ndarray) -> np.ndarray:
    out = np.clip(x, -30, 30)
    np.negative(out, out)
    np.exp(out, out)
    out += 1
    return np.reciprocal(out, out)


def class_log10(parameters: list[np.ndarray]) -> np.ndarray:
    """log10 probability of every class after every pair of context classes, normalised: (pairs, classes)."""
    x, c, r, b = (p.astype(np.float32) for p in parameters)
    one, two = x @ c[0], x @ c[1]
    out = np.empty((CLASSES * CLASSES, CLASSES), np.float32)
    for k in range(CLASSES):
        scores = (one + two[k]) @ r.T + b
        scores[:, 0] = -np.inf
        scores -= scores.max(axis=1, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
        out[k * CLASSES : (k + 1) * CLASSES] = scores / np.float32(np.log(10))
    return out


class Model:
    def __init__(self, vocabulary: Vocabulary, parameters: list[np.ndarray], words: lm_words.Words, counts: DataFrame):
        self.vocabulary, self.parameters, self.words, self.counts = vocabulary, parameters, words, counts


def _binary(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))


def count_words(docs: DataFrame) -> DataFrame:
    """(hash, tail, n): count of every distinct token of ``docs``, ends included."""

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = texts_of(batch)
            parts = []
            for part in batches(texts):
                t = Text(texts[part])
                hashes, at, n = np.unique(t.hashes, return_index=True, return_counts=True)
                parts.append((hashes, t.tails[at], n))
            if not parts:
                continue
            hashes, tails, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            hashes, at, back = np.unique(hashes, return_index=True, return_inverse=True)
            sums = np.bincount(back, n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(tails[at].astype(np.int16)), pa.array(sums)], ["hash", "tail", "n"])

    parts = docs.mapInArrow(count, "hash long, tail short, n long")
    return parts.groupBy("hash", "tail").agg(F.sum("n").alias("n"))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    sizes = counts.select(F.floor(8 * F.log2("n")).alias("size"), "n").groupBy("size").agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()
    n, v = sum(r["n"] for r in sizes), sum(r["v"] for r in sizes)
    least, words = 1 << 20, 0
    for r in sorted(sizes, key=lambda r: -r["size"]):
        words += r["v"]
        if words > COMMON:
            break
        least = r["size"]
    is_end = F.col("hash") == int(signed(np.array([END]))[0])
    common = counts.filter((F.floor(8 * F.log2("n")) >= least) | is_end).toArrow()
    tails = counts.filter(~is_end).groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tail_counts, tail_types = np.zeros(TAILS), np.zeros(TAILS)
    for r in tails:
        tail_counts[r["tail"]], tail_types[r["tail"]] = r["n"], r["v"]
    hashes, ns, own = (common.column(k).to_numpy() for k in ("hash", "n", "tail"))
    return Vocabulary(n, v, hashes.view(np.uint64), ns, own.astype(np.int64), tail_counts, tail_types)


def position_grams(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(code, n): how many positions of ``docs`` have each class after each pair of context classes, and each outcome of a tail class after each class.

    The model sees nothing else of a position, so these counts are all that training needs of the texts:
    every position counts, and the table has at most ``CLASSES`` ** 3 + ``CLASSES`` * (``COMMON`` + ``TAILS`` + 1) rows whatever the corpus.
    """

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        for batch in found:
            texts = texts_of(batch)
            for part in batches(texts):
                t = Text(texts[part])
                classes = vocabulary.value.classes(t)
                one, two = contexts(classes, t)
                held.append(((two * CLASSES + one) * CLASSES + classes).astype(np.uint32))
                tail = np.flatnonzero(classes >= 2 + OWN)
                outcomes = vocabulary.value.outcomes(vocabulary.value.places(t.hashes[tail]), t.tails[tail])
                held.append((WORDS_FROM + outcomes * CLASSES + one[tail]).astype(np.uint32))
                size += len(classes) + len(tail)
                if size >= GRAMS:
                    yield from gram_counts.packed(np.concatenate(held), TaskContext.get().partitionId())
                    held, size = [], 0
        if size:
            yield from gram_counts.packed(np.concatenate(held), TaskContext.get().partitionId())

    return gram_counts.counted(docs.mapInArrow(count, gram_counts.SCHEMA))


def class_grams(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """(code, n) of the classes alone."""
    return position_grams(docs, vocabulary).filter(F.col("code") < WORDS_FROM)


def words_of(grams: DataFrame, vocabulary: Vocabulary, parameters: list[np.ndarray]) -> lm_words.Words:
    """The factor within the classes, its contexts as the class model has learnt them."""
    before, target = F.shiftright("code", 8) % CLASSES, F.col("code") % CLASSES
    totals = np.zeros((CLASSES, TAILS))
    of_classes = grams.filter((F.col("code") < WORDS_FROM) & (target >= 2 + OWN)).groupBy(before.alias("k"), target.alias("g")).agg(F.sum("n").alias("n"))
    for r in of_classes.collect():
        totals[r["k"], r["g"] - 2 - OWN] = r["n"]
    # the class before a word of a tail class, as often as it is that
    met = totals.sum(axis=1)
    phi = lm_words.context_vectors(parameters[0] @ parameters[1][0], met / max(met.sum(), 1))
    own = lm_words.by_outcome(grams, WORDS_FROM, CLASSES)
    theta = lm_words.fit(own, own.count(), totals, vocabulary.outcome_share, vocabulary.outcome_tail, phi)
    return lm_words.Words(phi, theta, vocabulary.outcome_share, vocabulary.outcome_tail, TAILS)


def _round(grams: DataFrame, tasks: int, cap: float, share: np.ndarray, parameters: list[np.ndarray], number: int) -> list[np.ndarray]:
    """Local steps per partition on this round's part of the positions, then the average of the results."""
    sent = grams.sparkSession.sparkContext.broadcast((parameters, share))

    def learn(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # at most CLASSES ** 3 rows of all partitions together
        parts = [(b.column("code").to_numpy(), b.column("n").to_numpy()) for b in found if b.num_rows]
        if not parts:
            return
        code, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        begin, shares = sent.value
        trainer = Trainer(begin, shares, 7919 * number + TaskContext.get().partitionId())
        # one shuffle for all rounds of an epoch, so that together they have every entry once
        row, weight = entries(n, cap)
        order = np.random.default_rng(number // STRIDE).permutation(len(row))
        order = order[positions(len(order), number)]
        row, weight = row[order], weight[order] / np.float32(cap)
        target, one, two = code % CLASSES, code // CLASSES % CLASSES, code // CLASSES**2
        for i in range(0, len(row), STEP):
            at = row[i : i + STEP]
            trainer.step([one[at], two[at]], target[at], weight[i : i + STEP])
        if trainer.steps:
            made = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([trainer.steps], pa.int64()), pa.array([flat(trainer.p)], pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(made, ["task", "steps", "p"])

    # dealt and sorted by code: the parameters do not depend on how the files are split
    dealt = grams.repartition(tasks, "code").sortWithinPartitions("code")
    made = dealt.mapInArrow(learn, "task int, steps long, p array<float>").toPandas().sort_values("task")
    return shaped(np.average(np.stack(made.p.to_numpy()).astype(float), axis=0, weights=made.steps)) if len(made) else parameters


def train(docs: DataFrame) -> Model:
    """Learn from all rows whose crc32 remainder is not 0. No rows: uniform classes and nothing known."""
    own = _binary(docs.filter(id_remainder(F.col("doc_id"), HOLD_OUT) != 0))
    counts = materialise(count_words(own), "word-counts")
    vocabulary = vocabulary_of(counts)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    every = materialise(position_grams(own, sent), "class-grams")
    grams = every.filter(F.col("code") < WORDS_FROM)
    rows, total = grams.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parameters = start(vocabulary)
    for number in range(EPOCHS * ROUNDS if rows else 0):
        parameters = _round(grams, -(-rows // TASK_ROWS), total / rows, vocabulary.class_share, parameters, number)
    words = words_of(every, vocabulary, parameters)
    discard(every)
    return Model(vocabulary, parameters, words, counts)


_tables: dict[str, np.ndarray] = {}


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Null text is the empty text: one token, the end. Repeated rows and null ids come back (a null id
    counts as the empty text in the hold-out rule); other columns are ignored.
    """
    spark = docs.sparkSession
    sent, parameters = spark.sparkContext.broadcast(model.vocabulary), spark.sparkContext.broadcast(model.parameters)
    within = spark.sparkContext.broadcast(model.words)
    key = uuid.uuid4().hex  # of the table that a worker keeps between tasks

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = sent.value
        if key not in _tables:
            _tables.clear()
            _tables[key] = class_log10(parameters.value).ravel()
        table, task, row = _tables[key], TaskContext.get().partitionId() << 36, 0
        for batch in found:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for part in batches(texts):
                t = Text(texts[part])
                classes = words.classes(t)
                one, two = contexts(classes, t)
                logs = table[(two * CLASSES + one) * CLASSES + classes].astype(np.float64)
                places = words.places(t.hashes)
                known = places >= 0
                tail = np.flatnonzero(classes >= 2 + OWN)
                logs[tail] += within.value.log10(one[tail], words.outcomes(places[tail], t.tails[tail]))
                base = np.zeros(len(places))
                base[known] = np.log10(words.counts[places[known]] + SMOOTH) - words.base_size
                sums = [np.bincount(t.doc, x, t.n) for x in (base, logs, known)]
                rid = task + row + np.arange(t.n)
                row += t.n
                yield _rows(rid, signed(mix(rid.astype(np.uint64))), np.zeros(t.n, np.int16), np.zeros(t.n, np.int64), *sums[:2], sums[2].astype(np.int64), np.diff(t.first), ids.slice(part.start, t.n))
                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((t.hashes[rare], t.doc[rare]))]
                new = np.ones(len(order), bool)
                new[1:] = (t.hashes[order][1:] != t.hashes[order][:-1]) | (t.doc[order][1:] != t.doc[order][:-1])
                at = order[new]
                n = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
                zero, none = np.zeros(len(at)), pa.nulls(len(at), pa.int64())
                yield _rows(rid[t.doc[at]], signed(t.hashes[at]), t.tails[at].astype(np.int16), n, zero, zero, zero.astype(np.int64), none, none)

    names = "rid long, hash long, tail short, n long, base double, logs double, known long, n_tokens long, doc_id long"
    rows = _binary(docs).mapInArrow(run, names)
    v = model.vocabulary
    counts = model.counts.select("hash", F.col("n").alias("c"))
    # a text's own row has n = 0 and a spread key that is not a word
    joined = rows.join(counts, "hash", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    mass = F.element_at(F.array(*[F.lit(float(x)) for x in v.rare_mass]), F.col("tail") + 1)
    smooth = F.log10(F.col("c") + SMOOTH)
    sums = joined.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.col("n") * (smooth - float(v.base_size))).alias("base_score"),
        F.sum(F.col("logs") + F.col("n") * (smooth - F.log10(mass))).alias("score"),
    )
    held = id_remainder(F.col("doc_id"), HOLD_OUT) == 0
    return sums.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(int(v.n)).alias("train_tokens"), "base_score", "score")


def _rows(rid, hashes, tails, n, base, logs, known, n_tokens, ids) -> pa.RecordBatch:
    values = [rid, hashes, tails, n, base, logs, known, n_tokens, ids]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in values], ["rid", "hash", "tail", "n", "base", "logs", "known", "n_tokens", "doc_id"])


def forget(model: Model) -> None:
    """Delete the count table behind a model."""
    discard(model.counts)
