"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity with it, so MinHash needs sets of
like size. Items are partitioned by size into powers of two; for the class of items of at most ``u``
shingles every document is a row of windows of 2u shingles, one each u, so that any run of u shingles
lies within one window. Containment 0.8 in such a window is a Jaccard similarity of at least 0.19,
so one of 48 min-hashes (bands of one row) agrees but for 4 in 100,000 cases, and of whole copies
(0.25 or more) but for 1 in a million. Every candidate is verified by exact containment of its
shingle strings in the whole document.

A document's words are in its row, so nothing is shuffled: the work is one pass per block of items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.shared import WORD
from terraflux.llm.tokens import U64, Tokens, batches, folded, texts_of

SHINGLE = 5
HASHES = 48
THRESHOLD = 0.8
#: Words of the items that are sent to the tasks at once. More items mean more passes, never fewer items.
BLOCK_WORDS = 1_000_000

_FACTORS = np.random.default_rng(10).integers(1, 2**63, HASHES, dtype=np.uint64) | U64(1)


def _strings(words: list[bytes]) -> set[bytes]:
    if len(words) < SHINGLE:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


class Items:
    """Shingle sets and, by size class, min-hashes of one block of items."""

    def __init__(self, ids: list, texts: list[bytes | None]):
        tokens = Tokens(folded(texts))
        hashes, bounds = tokens.shingles(SHINGLE)
        self.ids = ids
        self.sets = [_strings(tokens.words(i)) for i in range(len(ids))]
        sizes = np.diff(bounds)
        unit = 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for u in sorted(set(unit[sizes > 0].tolist())):
            own = np.flatnonzero((unit == u) & (sizes > 0))
            signs = np.array([[(hashes[bounds[i] : bounds[i + 1]] * f).min() for i in own] for f in (_FACTORS if u > 1 else _FACTORS[:1])])
            orders = signs.argsort(axis=1)
            self.classes[u] = [(s[o], own[o]) for s, o in zip(signs, orders, strict=True)]

    def candidates(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Pairs (document, item) that share a min-hash in some window, as rows of an array."""
        found, sizes = [], np.diff(bounds)
        for u, signs in self.classes.items():
            blocks = -(-sizes // u)
            first = np.concatenate([[0], np.cumsum(blocks)])
            doc = np.repeat(np.arange(len(sizes)), blocks)
            begins = bounds[doc] + u * (np.arange(first[-1]) - first[doc])
            if not len(begins):
                continue
            pair = np.flatnonzero(doc[1:] == doc[:-1]) if u > 1 else np.zeros(0, int)
            for f, (sign, item) in zip(_FACTORS, signs, strict=False):
                least = np.minimum.reduceat(hashes * f, begins)
                least[pair] = np.minimum(least[pair], least[pair + 1])
                at = np.searchsorted(sign, least)
                hit = np.flatnonzero(sign[np.minimum(at, len(sign) - 1)] == least)
                while len(hit):  # items with the same min-hash stand side by side
                    found.append(np.stack([doc[hit], item[at[hit]]], axis=1))
                    at[hit] += 1
                    hit = hit[at[hit] < len(sign)]
                    hit = hit[sign[at[hit]] == least[hit]]
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), int)

    def verified(self, texts: list[bytes | None], threshold: float) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of the candidates whose exact containment is ``threshold`` or more."""
        for part in batches(texts):
            tokens = Tokens(folded(texts[part]))
            last, own = -1, set()
            for d, i in self.candidates(*tokens.shingles(SHINGLE)).tolist():
                if d != last:
                    last, own = d, _strings(tokens.words(d))
                shared = len(self.sets[i] & own)
                if shared >= threshold * len(self.sets[i]):
                    yield part.start + d, i, shared


def _keyed(items: DataFrame) -> DataFrame:
    return items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.sha2("text", 256))


def item_blocks(items: DataFrame) -> Iterator[Items]:
    """The distinct texts of the items in blocks of about ``BLOCK_WORDS`` words, each small enough to go to every task.

    Copies of a text are one item here, so no block grows with them; only a single text longer than a block makes a larger one.
    """
    own = _keyed(items).select("key", "text").distinct()
    words = own.agg(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0] or 0
    blocks = int(words // BLOCK_WORDS) + 1
    for k in range(blocks):
        rows = own.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k).toArrow()
        yield Items(rows.column("key").to_pylist(), [t.encode() for t in rows.column("text").to_pylist()])


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment): items whose shingles a document contains.

    Shingles are 5 words, lower-cased (accented letters, too), distinct; fewer words are one shingle; a text without
    words has none, so it never matches. Rows are per document row and item row: repeated rows and null
    ids come back as they are. Empty tables give no rows; other columns are ignored. Documents are read once
    for each block of items: once per million words of distinct benchmark text.
    """
    spark: SparkSession = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id long, key string, shared long, item_shingles long, containment double"
    names = ["doc_id", "key", "shared", "item_shingles", "containment"]
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items):
        sent = spark.sparkContext.broadcast(block)

        def find(found: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in found:
                hits = list(items.verified(texts_of(batch), threshold))
                sizes = [len(items.sets[i]) for _, i, _ in hits]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([d for d, _, _ in hits], pa.int64())),
                        pa.array([items.ids[i] for _, i, _ in hits], pa.string()),
                        pa.array([n for _, _, n in hits], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([n / s for (_, _, n), s in zip(hits, sizes, strict=True)], pa.float64()),
                    ],
                    names=names,
                )

        out = out.unionByName(own.mapInArrow(find, schema))
    ids = _keyed(items).select("key", F.col("item_id").cast("long"))
    return out.join(ids, "key").select("doc_id", "item_id", "shared", "item_shingles", "containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    spark: SparkSession = docs.sparkSession
    at = docs.columns.index("text")
    for block in item_blocks(items):
        sent = spark.sparkContext.broadcast(block)

        def clean(found: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in found:
                texts = batch.column(at).cast(pa.binary()).to_pylist()
                keep = np.ones(len(texts), bool)
                keep[[d for d, _, _ in sent.value.verified(texts, threshold)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
