"""Exact top-k inner products with vector-approximation files.

Vectors are stored once, in blocks of two columns: the cells of all components, 8 bits each, and the exact integers.
For a block of queries a task scans the cells: a cell's middle gives the inner product up to an
error that the query bounds, so every vector has a lower and an upper bound. Exact vectors are then read in
the order of their upper bounds, until the k-th exact score is above all bounds that are left; that score is carried
on to the next blocks of the task's group. Blocks of queries are dealt to all groups by a shuffle, so the plan is the same for
any number of queries and none passes through the driver; only k rows per query leave a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraflux.llm.shared import materialise

SCALE = 1024
CELL_BITS = 8
#: Bytes of exact vectors in a stored block.
BLOCK_BYTES = 4 << 20
#: Bytes of the exact vectors that a task holds at once; all queries visit each such group of blocks.
GROUP_BYTES = 64 << 20
#: Bytes of a block of queries.
QUERY_BYTES = 4 << 20
LARGEST = 2**63 - 1
#: Whole numbers up to these are exact in floats.
_SINGLE, _DOUBLE = 2**24, 2**52


def integers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of a batch; vectors are floor(1024 x), shorter ones end with zeros. Components beyond 2**52 are Python integers."""
    ids, column = batch.column("vec_id").to_numpy(), batch.column("v")
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    size = np.asarray(column.value_lengths())
    width = int(size.max(initial=0))
    large = len(flat) and np.abs(flat).max() >= _DOUBLE
    flat = np.array([int(x) for x in flat], object) if large else flat.astype(np.int64)
    out = np.zeros((len(ids), width), flat.dtype)
    out[np.arange(width) < size[:, None]] = flat
    return ids, out


class Block:
    """Vectors of one width with their cells: component x is in cell x >> shift. Components beyond 2**52 have no cells."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, cells: np.ndarray | None, shift: int):
        self.ids, self.x, self.cells, self.shift = ids, x, cells, shift

    @classmethod
    def of(cls, ids: np.ndarray, x: np.ndarray) -> Block:
        if x.dtype == object:
            return cls(ids, x, None, 0)
        largest = max(int(x.max(initial=0)), -int(x.min(initial=0)) - 1)
        shift = max(0, largest.bit_length() + 1 - CELL_BITS)
        kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max)
        return cls(ids, x.astype(kind), (x >> shift).astype(np.int8), shift)

    def packed(self) -> dict:
        exact = ",".join(map(str, self.x.ravel())).encode() if self.cells is None else self.x.tobytes()
        return {"ids": self.ids.astype(np.int64).tobytes(), "cells": None if self.cells is None else self.cells.tobytes(), "exact": exact, "shift": self.shift, "width": self.x.shape[1], "bytes": 0 if self.cells is None else self.x.dtype.itemsize}

    @classmethod
    def unpacked(cls, row: dict) -> Block:
        ids = np.frombuffer(row["ids"], np.int64)
        shape = (len(ids), row["width"])
        if row["cells"] is None:
            return cls(ids, np.array([int(x) for x in row["exact"].split(b",")], object).reshape(shape), None, 0)
        return cls(ids, np.frombuffer(row["exact"], f"i{row['bytes']}").reshape(shape), np.frombuffer(row["cells"], np.int8).reshape(shape), row["shift"])

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """(low, high) of every query with every vector; none where sums would not be exact in floats."""
        if self.cells is None or q.dtype == object:
            return None
        largest = float(np.abs(q).max(initial=0)) * max(q.shape[1], 1)
        if largest * 2.0 ** (CELL_BITS + self.shift) >= _DOUBLE:
            return None
        kind = np.float32 if largest * 2.0 ** (CELL_BITS - 1) < _SINGLE else np.float64
        # x = cells * 2**shift + a rest of 0 to 2**shift - 1
        middle = (q.astype(kind) @ self.cells.astype(kind).T).astype(np.float64) * float(1 << self.shift)
        rest = float((1 << self.shift) - 1) / 2
        middle += rest * q.sum(axis=1, keepdims=True)
        error = rest * np.abs(q).sum(axis=1, keepdims=True)
        return middle - error, middle + error


_STORED = "ids binary, cells binary, exact binary, shift int, width int, bytes int"
_STORED_TYPES = pa.schema([("ids", pa.binary()), ("cells", pa.binary()), ("exact", pa.binary()), ("shift", pa.int32()), ("width", pa.int32()), ("bytes", pa.int32())])


def thinned(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows that can be among the ``k`` best of a query: of equal vectors those of the k + 1 smallest ids, k rows of each."""
    if x.dtype == object or not x.size:
        return np.arange(len(ids))
    whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.itemsize * x.shape[1]))).ravel()
    group = np.unique(whole, return_inverse=True)[1]
    order = np.lexsort((ids, group))
    group, own, at = group[order], ids[order], np.arange(len(ids))
    other = np.concatenate([[True], group[1:] != group[:-1]])
    new = other | np.concatenate([[True], own[1:] != own[:-1]])
    nth_id = np.cumsum(new) - np.maximum.accumulate(np.where(other, np.cumsum(new), 0))
    nth_row = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.sort(order[(nth_id <= k) & (nth_row < k)])


def _stored(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The vectors of each batch in blocks, without copies that cannot be among the ``k`` best."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            ids, x = integers(batch)
            keep = thinned(ids, x, k)
            ids, x = ids[keep], x[keep]
            step = max(64, BLOCK_BYTES // (8 * max(x.shape[1], 1)))
            for at in range(0, len(ids), step):
                yield pa.RecordBatch.from_pylist([Block.of(ids[at : at + step], x[at : at + step]).packed()], _STORED_TYPES)

    return run


def _wide(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


class Search:
    """The ``k`` best of the blocks seen so far for each query, ties to smaller ids."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, k: int):
        self.q_ids, self.q, self.k = q_ids, q, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in q_ids]  # (-score, id), sorted

    def add(self, block: Block) -> None:
        k, width = self.k, max(block.x.shape[1], self.q.shape[1])
        q, x = _wide(self.q, width), _wide(block.x, width)
        if block.cells is not None:
            block = Block(block.ids, x, _wide(block.cells, width), block.shift)
        bounds = block.bounds(q)
        if bounds is None:
            q, x = q.astype(object), x.astype(object)  # beyond exact floats: every vector is read
        for i, own in enumerate(self.q_ids.tolist()):
            others = np.flatnonzero(block.ids != own)
            best, scores = self.best[i], np.zeros(0, object if bounds is None else np.int64)
            kth = -best[-1][0] if len(best) >= k else None
            if bounds is not None:
                low, high = bounds[0][i, others], bounds[1][i, others]
                # what the k-th lower bound or the k-th score so far beats can't be among the best
                sure = np.partition(low, -k)[-k] if len(others) > k else -np.inf
                sure = max(sure, -np.inf if kth is None else kth)
                others, high = others[high >= sure], high[high >= sure]
                by = np.argsort(-high, kind="stable")
                others, high = others[by], high[by]
            at, step = 0, 4 * k if bounds is not None else max(len(others), 1)
            row = q[i] if bounds is None else q[i].astype(np.int64)
            while at < len(others):
                part = x[others[at : at + step]]
                scores = np.concatenate([scores, part.astype(row.dtype) @ row if width else np.zeros(len(part), np.int64)])
                at += step
                if at < len(others) and len(scores) >= k and np.partition(scores, -k)[-k] > high[at]:
                    break
                step *= 2
            if not len(scores):
                continue
            seen = block.ids[others[: len(scores)]]
            if bounds is not None and len(scores) > 2 * k:
                near = scores >= np.partition(scores, -k)[-k]
                scores, seen = scores[near], seen[near]
            self.best[i] = sorted([*best, *zip((-scores).tolist(), seen.tolist(), strict=True)])[:k]

    def rows(self) -> pa.RecordBatch:
        found = [(own, v, max(-LARGEST - 1, min(LARGEST, -s))) for own, best in zip(self.q_ids.tolist(), self.best, strict=True) for s, v in best]
        columns = zip(*found, strict=True) if found else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def _asked(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries of each batch in blocks of about ``QUERY_BYTES``."""
    for batch in found:
        ids, x = integers(batch)
        step = max(1, QUERY_BYTES // (8 * max(x.shape[1], 1)))
        for at in range(0, len(ids), step):
            yield pa.RecordBatch.from_pylist([Block.of(ids[at : at + step], x[at : at + step]).packed()], _STORED_TYPES)


def _visits(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A partition has, group by group, a group's blocks of vectors and then the blocks of queries; vectors are held, queries pass by."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in found:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["g"] != group:
                    group, held = row["g"], []
                block = Block.unpacked(row)
                if not row["turn"]:
                    held.append(block)
                    continue
                search = Search(block.ids, block.x if block.x.dtype == object else block.x.astype(np.int64), k)
                for own in held:
                    search.add(own)
                yield search.rows()

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products with other rows' vectors.

    Both tables have vec_id and embedding; components are floor(1024 x). Ties go to the smaller vec_id; fewer
    rows than k: all. Vectors that are null or hold null, NaN or infinite components, and rows without an id,
    take no part. Rows with the query's own vec_id are no candidates; of several queries of one id the smallest
    vector counts; repeated candidate rows count each. Vectors of unlike length compare as if ended with
    zeros. Scores beyond a long are its bounds. Other columns are ignored; empty tables give no rows.

    Of the copies of one vector only those of the k + 1 smallest ids can be among the best, so a batch of vectors is thinned
    out to these, exactly, before its blocks are made. Nothing but the k best of each task is shuffled.
    """
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    def clean(df: DataFrame) -> DataFrame:
        own = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
        return own.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", odd))

    asked = clean(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    stored = materialise(clean(vectors).mapInArrow(_stored(k), _STORED).withColumn("block", F.monotonically_increasing_id()), "vector-cells")
    queries_of = materialise(asked.mapInArrow(_asked, _STORED), "query-blocks")
    n, size = stored.agg(F.count("*"), F.coalesce(F.sum(F.length("exact")), F.lit(0))).first()
    groups = max(1, -(-size // GROUP_BYTES), min(n, 2 * stored.sparkSession.sparkContext.defaultParallelism))
    held = stored.select(F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("turn"), *_STORED_TYPES.names)
    passing = queries_of.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("turn"), *_STORED_TYPES.names)
    rows = held.unionByName(passing).repartition(groups, "g").sortWithinPartitions("g", "turn")
    found = rows.mapInArrow(_visits(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
