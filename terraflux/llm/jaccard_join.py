"""Word n-gram sets of Jaccard similarity of at least 0.9: a size-aware heavy-light join, then components.

Rows of one set are one class. Shingles have a global order, the rare before the frequent, by a count sketch of the whole corpus; any
order is right, this one keeps frequent shingles out of prefixes. A set of n shingles may miss at most m = n - ceil(0.9 n) of them in a
partner, so two linked sets share at least l of their first m + l shingles.

Small sets (light) enumerate all subsets of ``SUBSET`` of their first m + SUBSET shingles and meet on equal subsets. Large sets (heavy) scan the inverted lists of
their first m + 1 shingles, in which all sets that are large enough to be partners stand. The boundary between the two is the size with the
least estimated cost, from the number of sets of each size and the lengths of the lists that they would scan.

What meets passes two filters that lose nothing: sizes, and a parity bitmap, of which a pair's symmetric difference bounds
the unequal bits. Only spanning links leave a task. They make clusters, in which alone sets are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm.graph import components
from terraflux.llm.shared import materialise
from terraflux.llm.simhash import _Forest
from terraflux.llm.tokens import U64, Tokens, batches, mix, texts_of

WIDTH = 3
PERCENT = 90
#: Shingles of an enumerated subset.
SUBSET = 2
#: Counters of the sketch; each task and the driver hold that many.
SKETCH = 1 << 20
_SLICE = 1024
#: Cost of an entry in a scanned list, in rows that are shuffled.
SCAN = 0.05
#: No set that misses more than this enumerates subsets.
MOST_MISSING = 64
#: Sets of one key that are compared with each other at once, and bytes of sets of a cluster.
BLOCK = 16_384
CLUSTER_BYTES = 32 << 20
#: Bits of the table that tells which sets are asked for.
ASKED = 1 << 26
#: Largest set of level 0, and bits of its bitmap. A level more has twice of both.
_SIZE, _BITS = 512, 256


def missing(n: int, percent: int = PERCENT) -> int:
    """How many of ``n`` shingles a linked partner may lack."""
    return n + -percent * n // 100


def shared(a, b, percent: int = PERCENT):
    """How many shingles sets of these sizes share at least if they are linked."""
    return -(-percent * (a + b) // (100 + percent))


def level_of(n: int) -> int:
    return max(0, (max(n, 1) - 1).bit_length() - (_SIZE - 1).bit_length())


def parities(own: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of a set: a bit is set if an odd number of shingles falls on it."""
    return np.packbits((np.bincount((own & U64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool), bitorder="little")


def sets_of(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, bounds = Tokens(texts).shingles(WIDTH)
    steps = bounds.tolist()
    return [np.unique(hashes[p:q]) for p, q in zip(steps, steps[1:], strict=False)]


def _prints(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set."""
    first, second = (int(np.add.reduce(mix(own ^ U64(c)))) for c in (0x51ED270B, 0xA0761D6478BD642F))
    return first - ((first >> 63) << 64), second - ((second >> 63) << 64)


def _sketch(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SKETCH, np.int64)
    shift = U64(64 - SKETCH.bit_length() + 1)
    for batch in found:
        texts = texts_of(batch)
        for part in batches(texts):
            total += np.bincount((Tokens(texts[part]).shingles(WIDTH)[0] >> shift).astype(np.int64), minlength=SKETCH)
    if total.any():
        rows = [x.astype("<u4").tobytes() for x in np.minimum(total, 2**32 - 1).reshape(-1, _SLICE)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows)], ["part", "counts"])


def _added(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for batch in found:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            own = np.frombuffer(counts, "<u4" if len(counts) == 4 * _SLICE else "<i8")
            held[part] = held.get(part, 0) + own.astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([x.astype("<i8").tobytes() for x in held.values()], pa.binary())], ["part", "counts"])


def frequencies(texts: DataFrame) -> np.ndarray:
    """Counters of all shingles of the corpus by the high bits of their hashes: a table of fixed size."""
    kind = "part int, counts binary"
    rows = texts.select("text").mapInArrow(_sketch, kind).repartition("part").mapInArrow(_added, kind).toArrow()
    out = np.zeros((SKETCH // _SLICE, _SLICE), np.int64)
    for part, counts in zip(rows.column("part").to_pylist(), rows.column("counts").to_pylist(), strict=True):
        out[part] += np.frombuffer(counts, "<i8")
    return out.ravel()


_SETS = "doc_id long, n int, f long, g long, prefix binary, bits binary, scans double"


def _describe(sent, percent: int):
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.value
        mean, shift = counts.mean(), U64(64 - SKETCH.bit_length() + 1)
        # frequency in steps of a 256th of a power of two, above the high bits of the hash
        rank = np.floor(np.log2(counts + 1.0) * 256).astype(np.uint64) << U64(48)
        for batch in found:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for part in batches(texts):
                rows, known = [], set()
                for own in sets_of(texts[part]):
                    n = len(own)
                    f, g = _prints(own) if n else (0, 0)
                    if 100 * n < percent * (n + 1) or (f, g) in known:  # linked to nothing else, or described above
                        rows.append((n, f, g, None, None, None))
                        continue
                    known.add((f, g))
                    cell = (own >> shift).astype(np.int64)
                    m = missing(n, percent)
                    first = np.argsort(rank[cell] | (own >> U64(16)), kind="stable")[: m + SUBSET]
                    scans = float(np.maximum(counts[cell[first[: m + 1]]] - mean, 1).sum())
                    rows.append((n, f, g, own[first].tobytes(), parities(own, _BITS << level_of(n)).tobytes(), scans))
                columns = zip(*rows, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float64())
                yield pa.RecordBatch.from_arrays([ids.slice(part.start, len(rows)), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]], ["doc_id", "n", "f", "g", "prefix", "bits", "scans"])

    return run


def boundary(classes: DataFrame, percent: int = PERCENT) -> int:
    """The size up to which sets enumerate subsets: the one of least cost. One row per number of missing shingles comes to the driver."""
    m = F.least(F.col("n") - F.ceil(F.col("n") * percent / 100), F.lit(MOST_MISSING + 1)).cast("int")
    rows = {r["m"]: (r["sets"], r["own"], r["scans"]) for r in classes.filter("prefix is not null").groupBy(m.alias("m")).agg(F.count("*").alias("sets"), F.sum(F.length("prefix") / 8 - (SUBSET - 1)).alias("own"), F.sum("scans").alias("scans")).collect()}
    subsets = lambda m: sum(1 for _ in combinations(range(m + SUBSET), SUBSET))
    cost = {x: sum(sets * subsets(m) if m <= x else own + SCAN * scans for m, (sets, own, scans) in rows.items()) for x in range(-1, MOST_MISSING + 1)}
    best = min(cost, key=lambda x: (cost[x], x))
    n = 0
    while missing(n + 1, percent) <= best:
        n += 1
    return n


def _keys(small: int, percent: int):
    pairs: dict[int, np.ndarray] = {}

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            keys, at, levels = [], [], []
            for i, (n, prefix) in enumerate(zip(batch.column("n").to_pylist(), batch.column("prefix").to_pylist(), strict=True)):
                first, m = np.frombuffer(prefix, np.uint64), missing(n, percent)
                own = []
                if n <= small:
                    if m not in pairs:
                        pairs[m] = np.array(list(combinations(range(m + SUBSET), SUBSET)))
                    own.append(np.add.reduce(mix(first)[pairs[m]] * (2 * np.arange(SUBSET, dtype=np.uint64) + U64(3)), axis=1))
                if 100 * n > percent * small:
                    own.append(first[: m + 1] ^ U64(0x9E3779B97F4A7C15))
                # a set may have partners of the level below
                top = level_of(n)
                for level in range(top, -1, -1):
                    if level < top and percent * n > 100 * (_SIZE << level):
                        break
                    for k in own:
                        keys.append(mix(k + U64(level)).view(np.int64))
                        at.append(np.full(len(k), i))
                        levels.append(np.full(len(k), level, np.int8))
            if keys:
                cid = batch.column("cid").take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), cid, pa.array(np.concatenate(levels))], ["key", "cid", "level"])

    return run


def _cells(rows: DataFrame, blocks: str, own) -> DataFrame:
    """Each row once for every pair of blocks that its own block is in; ``side`` tells the two apart, 0 where the cell is one block."""
    cell = F.transform(
        F.sequence(F.lit(0), F.col(blocks) - 1),
        lambda k: F.struct((F.least(own, k) * F.col(blocks).cast("long") + F.greatest(own, k)).alias("pair"), F.when(k == own, 0).when(k < own, 2).otherwise(1).cast("byte").alias("side")),
    )
    return rows.withColumn("k", F.explode(cell)).select(*[c for c in rows.columns if c != blocks], "k.pair", "k.side")


def _joined(group: np.ndarray, bits: np.ndarray, n: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning links of the pairs of equal ``group`` (sorted by it, then by n) that sizes and bitmaps allow.

    Rows i and i + d are compared for d = 1, 2, ... until a group's rows are one tree or too far apart in size.
    """
    forest, at, d = _Forest(len(n)), np.arange(len(n)), 0
    begin, end = np.searchsorted(group, group), np.searchsorted(group, group, "right")
    while len(at):
        d += 1
        at = at[at + d < end[at]]
        at = at[100 * n[at] >= percent * n[at + d]]
        near = at[((side[at] == 0) | (side[at] != side[at + d])) & (forest.root[at] != forest.root[at + d])]
        if len(near):
            a, b = n[near], n[near + d]
            differ = np.bitwise_count(bits[near] ^ bits[near + d]).sum(axis=1, dtype=np.int64)
            near = near[differ <= a + b - 2 * shared(a, b, percent)]
            forest.add(near, near + d)
        if d & (d - 1) == 0 or d % 256 == 0:
            forest.flatten()
            if len(at):
                starts = np.unique(begin)
                one = np.minimum.reduceat(forest.root, starts) == np.maximum.reduceat(forest.root, starts)
                at = at[~one[np.searchsorted(starts, begin[at])]]
    return forest.kept


def _candidates(percent: int):
    """Spanning links of each cell of a partition that is sorted by cell; a cell is bounded, so what is kept of it is too."""

    def out(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        get = lambda k: rows.column(k).to_numpy()
        key, pair, level, cid, n, side = map(get, ("key", "pair", "level", "cid", "n", "side"))
        group = np.cumsum(np.concatenate([[True], (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])]))
        links = []
        for l in np.unique(level).tolist():  # noqa: E741
            own = np.flatnonzero(level == l)
            size = _BITS << l
            maps = []
            for b in rows.column("bits").take(pa.array(own)).to_pylist():
                x = np.frombuffer(b, np.uint64)
                while len(x) * 64 > size:
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                maps.append(x)
            kept = np.array(_joined(group[own], np.array(maps), n[own].astype(np.int64), side[own], percent), np.int64).reshape(-1, 2)
            links.append(np.stack([cid[own[kept[:, 0]]], cid[own[kept[:, 1]]]]))
        u, v = np.concatenate(links, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in found:
            if not batch.num_rows:
                continue
            key, pair = (batch.column(k).to_numpy() for k in ("key", "pair"))
            other = np.flatnonzero((key != key[-1]) | (pair != pair[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last cell may go on in the next batch
            if rest and (cut or (last := rest[-1]).column("key")[-1].as_py() != key[0] or last.column("pair")[-1].as_py() != pair[0]):
                yield from out(pa.Table.from_batches([*rest, batch.slice(0, cut)]))
                rest = []
            elif cut:
                yield from out(pa.Table.from_batches([batch.slice(0, cut)]))
            rest.append(batch.slice(cut))
        if rest:
            yield from out(pa.Table.from_batches(rest))

    return run


def candidates(classes: DataFrame, small: int, percent: int = PERCENT) -> DataFrame:
    """(u, v): links between classes that connect all whose sets share a subset or list and pass the filters."""
    rows = classes.filter("prefix is not null").select("cid", "n", "prefix").mapInArrow(_keys(small, percent), "key long, cid long, level byte")
    met = rows.groupBy("key").count().filter("count > 1").select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(met, "key").join(classes.select("cid", "n", "bits"), "cid")
    cells = _cells(rows, "blocks", F.pmod(F.xxhash64("cid", "key"), F.col("blocks")).cast("int"))
    return cells.repartition("key", "pair").sortWithinPartitions("key", "pair", "n", "cid").mapInArrow(_candidates(percent), "u long, v long")


def _whole(sent):
    """Sets whose bit is set in the table of those asked for, copies in a batch once."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = texts_of(batch)
            for part in batches(texts):
                known: dict[tuple[int, int], bytes] = {}
                for own in sets_of(texts[part]):
                    f, g = _prints(own) if len(own) else (0, 0)
                    slot = f & (ASKED - 1)
                    if len(own) and int(sent.value[slot >> 6]) >> (slot & 63) & 1:
                        known[f, g] = own.tobytes()
                columns = [pa.array([k[i] for k in known], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(known.values(), pa.binary())], ["f", "g", "whole"])

    return run


def _linked(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between the sets, by exact intersections."""
    by = np.argsort([len(x) for x in sets], kind="stable")
    sets, side = [sets[i] for i in by], side[by]
    n = np.array([len(x) for x in sets], np.int64)
    bits = np.array([parities(x, _BITS << level_of(int(n[-1]))).view(np.uint64) for x in sets])
    tree, kept = np.arange(len(sets)), []
    for i in range(1, len(sets)):
        low = int(np.searchsorted(100 * n[:i], percent * n[i]))
        near = low + np.flatnonzero((tree[low:i] != tree[i]) & ((side[low:i] == 0) | (side[low:i] != side[i])))
        if len(near):
            differ = np.bitwise_count(bits[near] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = near[differ <= n[near] + n[i] - 2 * shared(n[near], n[i], percent)]
        for j in near.tolist():
            if tree[j] == tree[i]:
                continue
            place = np.minimum(np.searchsorted(sets[i], sets[j]), len(sets[i]) - 1)
            both = int((sets[i][place] == sets[j]).sum())
            if 100 * both >= percent * int(n[i] + n[j] - both):
                tree[tree == max(tree[i], tree[j])] = min(tree[i], tree[j])
                kept.append((int(by[i]), int(by[j])))
    return kept


def _verify(percent: int):
    def out(cids: list[int], sides: list[int], sets: list[bytes]) -> pa.RecordBatch:
        kept = _linked([np.frombuffer(x, np.uint64) for x in sets], np.array(sides), percent)
        return pa.RecordBatch.from_arrays([pa.array([cids[k[i]] for k in kept], pa.int64()) for i in (0, 1)], ["u", "v"])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, ([], [], [])
        for batch in found:
            columns = [batch.column(k).to_pylist() for k in ("component", "pair", "cid", "side", "whole")]
            for component, pair, *row in zip(*columns, strict=True):
                if (component, pair) != cell:
                    if len(held[0]) > 1:
                        yield out(*held)
                    cell, held = (component, pair), ([], [], [])
                for column, value in zip(held, row, strict=True):
                    column.append(value)
        if len(held[0]) > 1:
            yield out(*held)

    return run


def verified(texts: DataFrame, classes: DataFrame, found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v): spanning links of the exact ones within the components of the candidate links. Texts are read again for the sets of these only."""
    spark = texts.sparkSession
    members = found.select(F.col("vertex").alias("cid"), "component").join(classes.select("cid", "f", "g", "n"), "cid")
    members = materialise(members, "jaccard-clusters")
    slot = F.col("f").bitwiseAND(ASKED - 1)
    word, bit = F.shiftright(slot, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    table = members.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    asked = np.zeros(ASKED >> 6, np.uint64)
    asked[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    sets = texts.select("text").mapInArrow(_whole(spark.sparkContext.broadcast(asked)), "f long, g long, whole binary")
    sets = sets.groupBy("f", "g").agg(F.first("whole").alias("whole"))
    blocks = members.groupBy("component").agg(F.ceil(F.sum(F.col("n").cast("long") * 8) / CLUSTER_BYTES).cast("int").alias("blocks"))
    rows = members.join(blocks, "component").join(sets, ["f", "g"]).select("component", "cid", "whole", "blocks")
    cells = _cells(rows, "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    return cells.repartition("component", "pair").sortWithinPartitions("component", "pair", "cid").mapInArrow(_verify(percent), "u long, v long")


def similar_sets(docs: DataFrame, percent: int = PERCENT, small: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    A row's set is its distinct ``WIDTH``-word shingles, fewer words: the whole sequence as one. Rows are linked if 100 * intersection >= ``percent`` * union;
    component_id is the smallest doc_id that links reach, the row's own included. Rows without words have 0 shingles and are linked with nothing.
    Equal sets are one class, so copies cost no pairs. A row with a null doc_id takes part; its component_id is null if none in
    its component has an id. Repeated rows each come back; other columns are ignored; an empty table gives no rows.
    ``percent`` is over 50. ``small``: the size up to which sets enumerate subsets, chosen by cost if it is not given; it changes no result.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be over 50 and at most 100")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(frequencies(texts))
    described = materialise(texts.mapInArrow(_describe(sent, percent), _SETS), "jaccard-sets")
    one = [F.first(c, ignorenulls=True).alias(c) for c in ("prefix", "bits", "scans")]
    classes = described.filter("n > 0").groupBy("f", "g", "n").agg(F.min("doc_id").alias("least"), *one)
    classes = materialise(classes.withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")
    found = components(candidates(classes, boundary(classes, percent) if small is None else small, percent))
    linked = components(verified(texts, classes, found, percent))
    named = linked.join(classes.select("cid", "least"), F.col("vertex") == F.col("cid"))
    named = named.join(named.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("cid", "component_id")
    # written, so that the join below is the only one on a class in its stage and a hot class can be split
    every = classes.join(named, "cid", "left").select("f", "g", F.coalesce("component_id", "least").alias("component_id"))
    every = materialise(every, "jaccard-components")
    out = described.filter("n > 0").select("doc_id", "n", "f", "g").join(every, ["f", "g"]).select("doc_id", "n", "component_id")
    return out.unionByName(described.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")
