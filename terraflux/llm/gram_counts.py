"""Exact counts of small integer codes, shuffled as packets of arrays, not as rows.

Codes have ``BITS`` bits. An odd factor deals them evenly to ``BUCKETS`` ranges, and a packet has the places of a range that a flush
has met, with their counts. A range is added up in an array of its whole length, so memory is ranges of a task times their
length, whatever the corpus. Packets meet in two levels, first those of ``TASKS`` tasks, so no range of a large corpus is one task's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, RANGE_BITS = 26, 17
BUCKETS = 1 << (BITS - RANGE_BITS)
TASKS, SALTS = 64, 256
#: Tasks of a level: each holds a few ranges at a time.
PARTS = 128
SCHEMA = "salt int, bucket int, places binary, counts binary"
_FACTOR = 40503 * 2 + 1
_BACK = pow(_FACTOR, -1, 1 << BITS)
_NONE = np.zeros(0, np.int64)
_MASK = np.uint64((1 << BITS) - 1)


def _times(codes: np.ndarray, factor: int) -> np.ndarray:
    return codes.astype(np.uint64) * np.uint64(factor) & _MASK


def _batch(salt: int, packets: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [
        pa.array([salt] * len(packets), pa.int32()),
        pa.array([b for b, _, _ in packets], pa.int32()),
        pa.array([p.astype(np.uint32).tobytes() for _, p, _ in packets], pa.binary()),
        pa.array([n.astype(np.int64).tobytes() for _, _, n in packets], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["salt", "bucket", "places", "counts"])


def packed(codes: np.ndarray, task: int) -> Iterator[pa.RecordBatch]:
    """Packets of the codes of one flush of a task, some ranges at a time."""
    own, n = np.unique(_times(codes, _FACTOR).astype(np.uint32), return_counts=True)
    cuts = np.searchsorted(own, np.arange(BUCKETS + 1, dtype=np.uint64) << np.uint64(RANGE_BITS))
    met = np.flatnonzero(np.diff(cuts))
    for begin in range(0, len(met), 64):
        part = met[begin : begin + 64]
        yield _batch(task // TASKS % SALTS, [(int(b), own[cuts[b] : cuts[b + 1]] & ((1 << RANGE_BITS) - 1), n[cuts[b] : cuts[b + 1]]) for b in part])


def _added(found: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], np.ndarray]:
    """Whole counts by (salt, bucket); a packet has a place once."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in found:
        for salt, bucket, places, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total = sums.setdefault((salt, bucket), _NONE)
            if total is _NONE:
                total = sums[salt, bucket] = np.zeros(1 << RANGE_BITS, np.int64)
            total[np.frombuffer(places, np.uint32)] += np.frombuffer(n, np.int64)
    return sums


def _merged(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (salt, bucket), total in _added(found).items():
        places = np.flatnonzero(total)
        yield _batch(salt, [(bucket, places, total[places])])


def _unpacked(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, bucket), total in _added(found).items():
        places = np.flatnonzero(total)
        codes = _times(places + (bucket << RANGE_BITS), _BACK)
        yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int32)), pa.array(total[places])], ["code", "n"])


def counted(packets: DataFrame) -> DataFrame:
    """(code, n) of all packets."""
    groups = packets.repartition(PARTS, "salt", "bucket").mapInArrow(_merged, SCHEMA)
    return groups.withColumn("salt", F.lit(0)).repartition(PARTS, "bucket").mapInArrow(_unpacked, "code int, n long")
