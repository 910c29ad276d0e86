"""The language model's second factor: the word within its class, given the class before.

An outcome of a tail class is one of its common words, or ``rare``, which stands for all its other words and unseen
ones. Its score after a class k is ``phi[k] . theta[outcome] + log(share)``: the vector of the class before, as the class model has
learnt it, times a vector of the outcome's own, beside the outcome's share of its class. The probabilities of the outcomes
of a class add up to one after every class.

Training is noise-contrastive estimation against the shares, on exact counts of all positions by (class before, outcome), with a standard
normal prior. With the contexts' vectors given, every outcome is a problem of its own: its noise has known expectations, so nothing
is drawn, and damped Newton steps solve it for a block of outcomes at once. Outcomes are dealt to tasks by a hash; the table of
counts is bounded by contexts times outcomes, the vectors that come back by outcomes, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Noise outcomes for each true one.
NOISE = 48
NEWTON = 20
#: No step moves the score of an outcome after any class by more.
FAR = 3.0
#: Steps end when none moves a score by as much.
NEAR = 1e-5
#: Outcomes that are solved at once, and (class before, outcome) counts of a task.
BLOCK = 1024
TASK_ROWS = 1 << 18
#: Positions that are scored at once.
POSITIONS = 1 << 18


def context_vectors(vectors: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The contexts' vectors, of mean 0 and variance 1 in every component under ``share``, and a constant component."""
    centred = vectors - share @ vectors
    spread = np.sqrt(share @ centred**2)
    return np.hstack([centred / np.maximum(spread, 1e-6), np.ones((len(vectors), 1))])


def solve(n: np.ndarray, noise: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Vectors of some outcomes from their counts and expected noise after every context: (contexts, outcomes) each."""
    width = phi.shape[1]
    # curvature in single precision bends the steps a little, never the point where the slope is zero
    pairs = (phi[:, :, None] * phi[:, None, :]).reshape(len(phi), -1).astype(np.float32)
    theta, both = np.zeros((n.shape[1], width)), n + noise
    for _ in range(NEWTON):
        true = 1 / (1 + NOISE * np.exp(-np.clip(phi @ theta.T, -30, 30)))
        slope = (n - both * true).T @ phi - theta
        bend = ((both * true * (1 - true)).astype(np.float32).T @ pairs).reshape(-1, width, width) + np.eye(width)
        step = np.linalg.solve(bend, slope[:, :, None])[:, :, 0]
        moved = np.abs(phi @ step.T).max(axis=0)
        theta += step * (FAR / np.maximum(moved, FAR))[:, None]
        if moved.max() < NEAR:
            break
    return theta


def fit(counts: DataFrame, rows: int, totals: np.ndarray, share: np.ndarray, tail: np.ndarray, phi: np.ndarray) -> np.ndarray:
    """Vectors of all outcomes from ``counts`` (outcome, before, n) of ``rows`` rows.

    totals: positions by (context, tail class); share and tail: of every outcome. What has no row keeps zeros, which is its share.
    """
    sent = counts.sparkSession.sparkContext.broadcast((totals, share, tail, phi))

    def learn(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(k).to_numpy() for k in ("outcome", "before", "n")] for b in found if b.num_rows]
        if not parts:
            return
        outcome, before, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        totals, share, tail, phi = sent.value
        own, at = np.unique(outcome, return_inverse=True)
        for begin in range(0, len(own), BLOCK):
            part = own[begin : begin + BLOCK]
            inside = (at >= begin) & (at < begin + BLOCK)
            table = np.zeros((len(phi), len(part)))
            table[before[inside], at[inside] - begin] = n[inside]
            theta = solve(table, NOISE * totals[:, tail[part]] * share[part], phi)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(list(theta), pa.list_(pa.float64()))], ["outcome", "theta"])

    theta = np.zeros((len(share), phi.shape[1]))
    dealt = counts.repartition(max(1, -(-rows // TASK_ROWS)), "outcome").sortWithinPartitions("outcome", "before")
    made = dealt.mapInArrow(learn, "outcome int, theta array<double>").toArrow()
    if made.num_rows:
        theta[made.column("outcome").to_numpy()] = np.stack(made.column("theta").to_numpy())
    return theta


class Words:
    """log10 probability of an outcome of a tail class after a class."""

    def __init__(self, phi: np.ndarray, theta: np.ndarray, share: np.ndarray, tail: np.ndarray, tails: int):
        self.phi, self.theta, self.tail = phi.astype(np.float32), theta.astype(np.float32), tail
        self.log_share = np.log(share)
        #: log of the sum over the outcomes of a class after a context; every class has an outcome.
        self.size = np.empty((len(phi), tails))
        order = np.argsort(tail, kind="stable")
        cuts = np.searchsorted(tail[order], np.arange(tails + 1))
        for g in range(tails):
            own = order[cuts[g] : cuts[g + 1]]
            total = np.zeros(len(phi))
            top = np.full(len(phi), -np.inf)
            for begin in range(0, len(own), 16 * BLOCK):
                part = own[begin : begin + 16 * BLOCK]
                scores = (self.phi @ self.theta[part].T).astype(float) + self.log_share[part]
                most = np.maximum(top, scores.max(axis=1))
                total = total * np.exp(top - most) + np.exp(scores - most[:, None]).sum(axis=1)
                top = most
            self.size[:, g] = top + np.log(total)

    def log10(self, before: np.ndarray, outcome: np.ndarray) -> np.ndarray:
        out = np.empty(len(outcome))
        for begin in range(0, len(outcome), POSITIONS):
            k, w = before[begin : begin + POSITIONS], outcome[begin : begin + POSITIONS]
            out[begin : begin + POSITIONS] = np.einsum("ij,ij->i", self.phi[k], self.theta[w]) + self.log_share[w] - self.size[k, self.tail[w]]
        return out / np.log(10)


def by_outcome(grams: DataFrame, first: int, contexts: int) -> DataFrame:
    """(outcome, before, n) from the counts by code ``first + outcome * contexts + before``."""
    code = F.col("code") - first
    return grams.filter(F.col("code") >= first).select((code / contexts).cast("int").alias("outcome"), (code % contexts).alias("before"), "n")
