"""SimHash near-duplicates: fingerprints, a pigeonring candidate filter and components.

Fingerprints of ``bits`` = 64 lie on a ring of ``SEGMENTS`` segments. If two differ in at most ``tau``
bits, some start on the ring has a chain of consecutive segments whose running difference stays within
the proportional budget ``floor(l * tau / SEGMENTS)`` for every length ``l`` (the pigeonring
principle). With 9 segments and tau = 4 the budgets are 0 0 1 1 2 2 3 3 4: the first two segments
agree, one of the next two agrees, and so on. So a pair shares, for some start, the exact bits of
the segments of one *pattern*; fingerprints meet on (pattern, bits), and the chain and then the full
Hamming distance decide. A longer chain makes patterns more selective and more numerous and loses no
pair: chains of 6 make 45 patterns of about 28 bits, so strangers meet about once in 8 million.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm.graph import components
from terraflux.llm.shared import materialise
from terraflux.llm.tokens import LOWER, texts_of

SHINGLE = 4
TAU = 4
SEGMENTS = 9
#: Segments of a chain that patterns cover: 2, 4, 6 or 8.
CHAIN = 6
#: Fingerprints of one pattern and value that one task compares with each other at once.
BLOCK = 2048


def _bounds() -> list[tuple[int, int]]:
    cuts = [round(i * 64 / SEGMENTS) for i in range(SEGMENTS + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


SEGMENT_MASKS = [((1 << (hi - lo)) - 1) << lo for lo, hi in _bounds()]
BUDGET = [(length * TAU) // SEGMENTS for length in range(SEGMENTS + 1)]


def patterns(chain: int) -> list[int]:
    """Masks of the segments that can be the equal ones of a viable chain of ``chain`` segments, for every start.

    A chain has at most ``BUDGET[l]`` unequal segments among its first ``l``; the masks keep the
    ``chain - BUDGET[chain]`` equal ones of each way that this can happen.
    """
    least = chain - BUDGET[chain]
    masks = set()
    for start in range(SEGMENTS):
        for equal in combinations(range(chain), least):
            differ = [i for i in range(chain) if i not in equal]
            if all(sum(d < length for d in differ) <= BUDGET[length] for length in range(1, chain + 1)):
                masks.add(sum(SEGMENT_MASKS[(start + i) % SEGMENTS] for i in equal))
    return sorted(masks)


def fingerprint(text: bytes | None) -> int:
    """The 64-bit SimHash of one text: bit set if set in over half of the shingle hashes; no words: 0."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate([[0], ends[:-1]])
    spans = zip(begins[: len(words) - SHINGLE + 1].tolist(), (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[a:b], 42) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        own = np.fromiter((fingerprint(t) for t in texts_of(batch)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long. Needs ``doc_id`` and ``text`` only."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_fingerprints, "doc_id long, fp long")


def viable(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether some start has a viable chain around the whole ring, and then the full Hamming distance is small enough."""
    x = a ^ b
    ok = np.zeros(len(x), bool)
    for start in range(SEGMENTS):
        at = np.flatnonzero(~ok)
        total = np.zeros(len(at), np.uint8)
        for length in range(1, SEGMENTS + 1):
            total = total + np.bitwise_count(x[at] & np.uint64(SEGMENT_MASKS[(start + length - 1) % SEGMENTS]))
            stays = total <= BUDGET[length]
            at, total = at[stays], total[stays]
        ok[at] = True
    at = np.flatnonzero(ok)
    ok[at] = np.bitwise_count(x[at]) <= TAU
    return ok


class _Forest:
    """Union-find over the rows of one batch; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.kept: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        new = self.root[a] != self.root[b]
        for i, j in zip(a[new].tolist(), b[new].tolist(), strict=True):
            x, y = self.find(i), self.find(j)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.kept.append((i, j))

    def flatten(self) -> None:
        while (self.root != (up := self.root[self.root])).any():
            self.root = up


def _links_within(group: np.ndarray, fp: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of equal ``group`` (rows are sorted by it).

    Rows i and i + d are compared for d = 1, 2, ... while any group is that long, so memory stays
    linear. Pairs within one half of a two-block cell have been compared in that block's own cell.
    """
    forest, at, d = _Forest(len(fp)), np.arange(len(fp)), 0
    end = np.searchsorted(group, group, "right")
    while len(at):
        d += 1
        at = at[at + d < end[at]]
        near = at[((side[at] == 0) | (side[at] != side[at + d])) & (forest.root[at] != forest.root[at + d])]
        near = near[viable(fp[near], fp[near + d])]
        forest.add(near, near + d)
        if d % 64 == 0:
            forest.flatten()
    return forest.kept


def _links(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning links of each (cell) of a partition that is sorted by cell; a cell is bounded, so what is kept of it is too."""
    rest: list[np.ndarray] | None = None

    def out(cols: list[np.ndarray]) -> pa.RecordBatch:
        changes = np.concatenate([[True], (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
        fp = cols[2].view(np.uint64)
        kept = np.array(_links_within(np.cumsum(changes), fp, cols[3]), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(cols[2][kept[:, 0]]), pa.array(cols[2][kept[:, 1]])], ["u", "v"])

    for batch in found:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "value", "fp", "side")]
        if rest:
            cols = [np.concatenate(p) for p in zip(rest, cols, strict=True)]
        if not len(cols[0]):
            continue
        last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
        cut = last[-1] + 1 if len(last) else 0  # the last cell may go on in the next batch
        rest = [c[cut:] for c in cols]
        if cut:
            yield out([c[:cut] for c in cols])
    if rest and len(rest[0]):
        yield out(rest)


def links(prints: DataFrame, chain: int = CHAIN) -> DataFrame:
    """(u, v): links of at most ``TAU`` bits that connect what such links connect, among distinct fp.

    Each fingerprint goes to one cell per pattern. A cell of more than ``BLOCK`` fingerprints is
    split into blocks, and each pair of blocks is a cell of its own, so that no task ever holds
    more than two blocks of a hot cell and none of its pairs is dropped. Only spanning links leave a
    task: as many as it read rows, at most.
    """
    masks = patterns(chain)
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("pattern"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value")) for i, m in enumerate(masks)]))
    rows = prints.select("fp", at.alias("c")).select("fp", "c.pattern", "c.value")
    hot = rows.groupBy("pattern", "value").count().filter(F.col("count") > BLOCK)
    hot = hot.select("pattern", "value", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(hot, ["pattern", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", "pattern"), F.col("blocks")).cast("int")
    # cell (i, j) of blocks i <= j; side tells the blocks apart, 0 where the cell is one block
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(
            (F.least("own", k) * F.col("blocks") + F.greatest("own", k)).alias("pair"),
            F.when(k == F.col("own"), 0).when(k < F.col("own"), 2).otherwise(1).alias("side"),
        ),
    )
    rows = rows.withColumn("own", own).select("fp", "pattern", "value", F.explode(cells).alias("k"))
    rows = rows.select((F.col("pattern").cast("long") * (1 << 40) + F.col("k.pair")).alias("cell"), "value", "fp", F.col("k.side").alias("side"))
    return rows.repartition("cell", "value").sortWithinPartitions("cell", "value", "fp").mapInArrow(_links, "u long, v long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``.

    Rows whose fingerprints differ in at most 4 bits are linked; component_id is the smallest doc_id
    that links reach, the row's own included. Equal fingerprints are one vertex, so copies cost no
    pairs. Null and word-less texts have fingerprint 0 and are linked like any other. A row with a
    null doc_id takes part; it gets its component's smallest id, null if none has one. Repeated rows
    each come back; other columns are ignored; an empty table gives no rows.
    """
    prints = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes.select("fp")))
    named = found.join(classes, F.col("vertex") == F.col("fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id")
    # written, so that the join below is the only one on fp in its stage and a hot class can be split
    every = classes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    every = materialise(every, "components")
    return prints.join(every, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, the one of the smallest doc_id, with all columns of ``docs``.

    Of several rows of that doc_id one stays. Rows without an id stay.
    """
    named = docs.filter("doc_id is not null")
    gone = simhash_components(named).filter("doc_id <> component_id").select("doc_id").distinct()
    again = named.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    once = docs.join(again, "doc_id", "left_semi").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    rest = docs.join(gone.union(again), "doc_id", "left_anti")
    return rest.select(*docs.columns).unionByName(once.select(*docs.columns))
