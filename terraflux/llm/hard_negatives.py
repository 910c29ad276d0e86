"""Hard negatives by inner product: length buckets whose sorted coordinate lists prune before scores are computed.

Vectors are stored once in buckets of like length; a bucket holds, for every coordinate, the order of its unit vectors by
that coordinate. A search needs scores of at least some threshold: what a search may still return at its lowest. In a bucket, that is a least cosine to the anchor.
Buckets that are too short for it are skipped whole. Otherwise the anchor's largest coordinates are its focus: a unit vector
within that angle of the anchor has each focus coordinate in a range, so a binary search in each list finds those that are feasible. Vectors in all
ranges are candidates, and only their exact scores are computed. Where ranges hold most of a bucket, its scores are one matrix product.

Anchors go through the groups of buckets in blocks, dealt by a shuffle, so neither anchors nor vectors pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terraflux.llm.shared import discard, materialise

SCALE = 256
#: Vectors of a bucket, and anchors of a block.
BUCKET, BLOCK = 2048, 512
#: Focus coordinates of an anchor.
FOCUS = 4
#: Bytes of exact vectors in the buckets that a task holds at once; all anchors visit each group of buckets.
GROUP_BYTES = 64 << 20
_EXACT = 2**53
_LEAST, _MOST = -(2**63), 2**63 - 1


def integers(column: pa.ListArray) -> np.ndarray:
    """floor(256 x) of each vector, shorter ones end with zeros. Beyond 2**52 all are Python integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.asarray(column.value_lengths()).astype(np.int64)
    if len(flat) and np.abs(flat).max() >= 2.0**52 / SCALE:
        flat = np.array([int(x) * SCALE if abs(x) >= 2**52 else int(np.floor(SCALE * x)) for x in flat.tolist()], object)
    else:
        flat = np.floor(SCALE * flat).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))), flat.dtype)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _packed(x: np.ndarray) -> tuple[bytes, str]:
    if x.dtype == object:
        return ",".join(map(str, x.ravel())).encode(), "text"
    most = int(np.abs(x).max(initial=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)
    return x.astype(kind).tobytes(), kind


def _unpacked(data: bytes, kind: str, rows: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in data.split(b",")], object).reshape(rows, -1)
    flat = np.frombuffer(data, kind).astype(np.int64)
    return flat.reshape(rows, len(flat) // max(rows, 1))


def _widened(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) if x.dtype != object else np.full(len(x), np.inf)


class Bucket:
    """Vectors of like length with sorted lists of their unit vectors' coordinates; without lists if components are beyond 2**52."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, order: np.ndarray | None):
        self.ids, self.labels, self.x, self.order = ids, labels, x, order
        length = _lengths(x)
        self.longest, self.largest = float(length.max(initial=0)), None if x.dtype == object else int(np.abs(x).max(initial=0))
        if order is not None:
            unit = (x / np.where(length > 0, length, 1)[:, None]).T
            self.values = np.take_along_axis(unit, order, axis=1)
            self.floats = x.astype(np.float64)

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> Bucket:
        if x.dtype == object:
            return cls(ids, labels, x, None)
        length = _lengths(x)
        unit = (x / np.where(length > 0, length, 1)[:, None]).T
        return cls(ids, labels, x, np.argsort(unit, axis=1, kind="stable"))

    def row(self) -> tuple:
        data, kind = _packed(self.x)
        order = None if self.order is None else self.order.astype("<i2" if len(self.ids) < 2**15 else "<i4").tobytes()
        return len(self.ids), self.ids.tobytes(), self.labels.tobytes(), data, kind, order, self.longest

    @classmethod
    def from_row(cls, r: dict) -> Bucket:
        n = r["n"]
        x = _unpacked(r["x"], r["kind"], n)
        order = None if r["orders"] is None else np.frombuffer(r["orders"], "<i2" if n < 2**15 else "<i4").reshape(x.shape[1], n).astype(np.int64)
        return cls(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64), x, order)

    def feasible(self, focus: np.ndarray, unit: np.ndarray, cosine: float) -> np.ndarray | None:
        """Vectors whose focus coordinates are in the ranges that a cosine of at least ``cosine`` allows; None if that is most of them."""
        angle, own = np.arccos(min(1.0, cosine)), np.arccos(np.clip(unit[focus], -1, 1))
        low, high = np.cos(np.minimum(np.pi, own + angle)) - 1e-9, np.cos(np.maximum(0, own - angle)) + 1e-9
        ends = [(np.searchsorted(self.values[f], a), np.searchsorted(self.values[f], b, "right")) for f, a, b in zip(focus.tolist(), low, high, strict=True)]
        if min(b - a for a, b in ends) > len(self.ids) // 4:
            return None
        met = np.zeros(len(self.ids), np.int8)
        for f, (a, b) in zip(focus.tolist(), ends, strict=True):
            met[self.order[f, a:b]] += 1
        return np.flatnonzero(met == len(focus))


class Best:
    """The ``k`` best of one search so far: scores of ``least`` to ``most``, higher first, ties to smaller ids."""

    __slots__ = ("k", "least", "most", "found")

    def __init__(self, k: int, least: float, most: float):
        self.k, self.least, self.most, self.found = k, least, most, []

    def threshold(self) -> float:
        return max(self.least, -self.found[-1][0]) if len(self.found) == self.k else self.least

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero((scores >= self.threshold()) & (scores <= self.most))
        if len(at) > 4 * self.k:
            near = scores[at]
            at = at[near >= np.partition(near, len(near) - self.k)[len(near) - self.k]]
        if len(at):
            self.found = sorted([*self.found, *zip((-scores[at]).tolist(), ids[at].tolist(), strict=True)])[: self.k]


class Anchors:
    """A block of anchors, each with its searches."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, searches: list[list[Best]], same: bool):
        self.ids, self.labels, self.x, self.searches, self.same = ids, labels, x, searches, same
        self.length = _lengths(x)

    def visit(self, bucket: Bucket) -> None:
        width = max(self.x.shape[1], bucket.x.shape[1])
        if width > bucket.x.shape[1] and bucket.order is not None:
            bucket = Bucket.of(bucket.ids, bucket.labels, _widened(bucket.x, width))
        q, x = _widened(self.x, width), _widened(bucket.x, width)
        plain = q.dtype == object or bucket.order is None or int(np.abs(q).max(initial=0)) * bucket.largest * max(width, 1) >= _EXACT
        whole = []
        for i, searches in enumerate(self.searches):
            least = min((s.threshold() for s in searches), default=np.inf)
            if not searches or least == np.inf:
                continue
            if plain or least <= 0:
                whole.append(i)
                continue
            reach = self.length[i] * bucket.longest
            if reach * (1 + 1e-9) < least:
                continue  # no vector of this bucket is long enough
            unit = q[i] / self.length[i]
            focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
            near = bucket.feasible(focus, unit, least / reach * (1 - 1e-9))
            if near is None:
                whole.append(i)
            elif len(near):
                self._meet(i, (bucket.floats[near] @ q[i].astype(np.float64)).astype(np.int64), bucket.ids[near], bucket.labels[near])
        if whole:
            scores = x.astype(object) @ q[whole].astype(object).T if plain else (bucket.floats @ q[whole].astype(np.float64).T).astype(np.int64)
            scores = scores if width else np.zeros((len(x), len(whole)), np.int64)
            for j, i in enumerate(whole):
                self._meet(i, scores[:, j], bucket.ids, bucket.labels)

    def _meet(self, i: int, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        own = np.flatnonzero(((labels == self.labels[i]) == self.same) & (ids != self.ids[i]))
        scores, ids = scores[own], ids[own]
        for search in self.searches[i]:
            search.add(scores, ids)

    def rows(self) -> pa.RecordBatch:
        found = [(anchor, at, v, max(_LEAST, min(_MOST, -s))) for anchor, searches in zip(self.ids.tolist(), self.searches, strict=True) for at, search in enumerate(searches) for s, v in search.found]
        columns = list(zip(*found, strict=True)) if found else [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "search", "vec_id", "score"])


_BUCKETS = "n int, ids binary, labels binary, x binary, kind string, orders binary, longest double"
_BUCKET_TYPES = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary()), ("kind", pa.string()), ("orders", pa.binary()), ("longest", pa.float64())])


def _buckets(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of rows that come in the order of their lengths."""
    for batch in found:
        ids, labels, x = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), integers(batch.column("v"))
        for at in range(0, len(ids), BUCKET):
            own = slice(at, at + BUCKET)
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(Bucket.of(ids[own], labels[own], x[own]).row(), _BUCKET_TYPES, strict=True)], schema=_BUCKET_TYPES)


_BLOCKS = "n int, ids binary, labels binary, x binary, kind string, positives array<array<long>>"
_BLOCK_TYPES = pa.schema([("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary()), ("kind", pa.string()), ("positives", pa.list_(pa.list_(pa.int64())))])


def _blocks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        ids, labels, x, scores = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), integers(batch.column("v")), batch.column("scores").to_pylist()
        for at in range(0, len(ids), BLOCK):
            own = slice(at, at + BLOCK)
            row = (len(ids[own]), ids[own].tobytes(), labels[own].tobytes(), *_packed(x[own]), scores[own])
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, _BLOCK_TYPES, strict=True)], schema=_BLOCK_TYPES)


def _search(searches: Callable[[list[int]], list[Best]], same: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition has, group by group, a group's buckets and then the blocks of anchors; a group's buckets are held, blocks pass by."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in found:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["g"] != group:
                    group, held = row["g"], []
                if row["positives"] is None:
                    held.append(Bucket.from_row(row))
                    continue
                labels, n = np.frombuffer(row["labels"], np.int64), row["n"]
                block = Anchors(np.frombuffer(row["ids"], np.int64), labels, _unpacked(row["x"], row["kind"], n), [searches(p) for p in row["positives"]], same)
                for bucket in held:  # longest first: thresholds rise early
                    block.visit(bucket)
                yield block.rows()

    return run


def _met(buckets: DataFrame, blocks: DataFrame, groups: int, searches: Callable[[list[int]], list[Best]], same: bool) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    held = buckets.select("g", F.lit(0).alias("turn"), (-F.col("longest")).alias("by"), "n", "ids", "labels", "x", "kind", "orders", null("array<array<long>>").alias("positives"))
    asked = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("turn"), F.lit(0.0).alias("by"), "n", "ids", "labels", "x", "kind", null("binary").alias("orders"), "positives")
    rows = held.unionByName(asked).repartition(groups, "g").sortWithinPartitions("g", "turn", "by")
    return rows.mapInArrow(_search(searches, same), "anchor_id long, search long, vec_id long, score long")


def _clean(df: DataFrame) -> DataFrame:
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    own = df.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    return own.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", odd))


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low_pct: int = 50, high_pct: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: vec_id, embedding, label; ``is_anchor``: a condition on vec_id and label. A score is the inner product of floor(256 x). An
    anchor's positives are its ``positives`` best other rows of its label. For each, the ``negatives`` best rows of another label whose
    score is ``low_pct`` to ``high_pct`` per cent of the positive's (100 negative >= low_pct positive, 100 negative <= high_pct positive), ranked from 1. Higher scores
    come first, ties go to smaller ids; fewer rows than asked for: all.

    Rows with a null id, label or vector, or any null, NaN or infinite component take no part. Rows of an anchor's own vec_id are not among its others;
    of several anchor rows of one id the smallest (vector, label) counts; other repeated rows count each. Vectors of unlike length compare as if ended with
    zeros. Scores beyond a long are its bounds. Other columns are ignored; empty tables give no rows.
    """
    spark = vectors.sparkSession
    clean = _clean(vectors)
    length = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    placed = clean.withColumn("length", length).repartitionByRange(F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    stored = materialise(placed.select("vec_id", "label", "v").mapInArrow(_buckets, _BUCKETS).withColumn("bucket", F.monotonically_increasing_id()), "length-buckets")
    n, size = stored.agg(F.count("*"), F.coalesce(F.sum(F.length("x") * 4), F.lit(0))).first()
    groups = max(1, -(-size // GROUP_BYTES), min(n, 2 * spark.sparkContext.defaultParallelism))
    buckets = stored.withColumn("g", F.pmod(F.xxhash64("bucket"), F.lit(groups)).cast("int"))
    anchors = clean.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("a")).select("vec_id", "a.v", "a.label")
    # a score of its own for each search of an anchor: the first one has no bounds
    asked = anchors.withColumn("scores", F.array().cast("array<long>"))
    blocks = materialise(asked.mapInArrow(_blocks, _BLOCKS), "anchor-blocks")
    found = _met(buckets, blocks, groups, lambda _: [Best(positives, -np.inf, np.inf)], True)
    best = materialise(_first(found, positives, "anchor_id").select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    own = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "positive_score"))), lambda p: p["positive_score"]).alias("scores"))
    discard(blocks)
    blocks = materialise(anchors.join(own, "vec_id").mapInArrow(_blocks, _BLOCKS), "anchor-blocks")

    def bounds(scores: list[int]) -> list[Best]:
        return [Best(negatives, -(-low_pct * p // 100), high_pct * p // 100) if low_pct * p <= high_pct * p else Best(negatives, np.inf, -np.inf) for p in scores]

    found = _met(buckets, blocks, groups, bounds, False)
    chosen = _first(found, negatives, "anchor_id", "search").withColumn("at", (F.col("search") + 1).cast("int"))
    named = chosen.join(best.withColumnRenamed("rank", "at"), ["anchor_id", "at"])
    return named.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
