"""Exact token-length histogram, and what suffix sums over it answer for every context limit."""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraflux.llm.shared import materialise
from terraflux.llm.tokens import texts_of

#: Byte-pair ranks of a public tokenizer; a parameter of every function here.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that tokenizer cuts text before merging (fixed value of the format).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Lengths whose sums are added up together, so that no window holds the whole histogram.
BUCKET = 1024

_encodings: dict[int, object] = {}


def encoding(ranks: bytes):
    """The tokenizer, made once in each Python worker."""
    import tiktoken

    key = hash(ranks)
    if key not in _encodings:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encodings[key]


def lengths_histogram(docs: DataFrame, ranks_path: str = RANKS) -> DataFrame:
    """(n_tokens, n_docs): how many rows encode to how many tokens. Null and empty texts have 0 tokens."""
    with open(ranks_path, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(sent.value).encode_ordinary
        for batch in found:
            n = Counter(len(encode(t.decode("utf-8", "replace"))) if t else 0 for t in texts_of(batch))
            yield pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.int64()), pa.array(n.values(), pa.int64())], ["n_tokens", "n_docs"])

    part = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "n_tokens long, n_docs long")
    # written: every use of the histogram would encode all texts again
    return materialise(part.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "token-lengths")


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row per occurring length, taken as a context limit.

    docs_at_least and tokens_at_least: suffix sums of documents and tokens of this length or more;
    truncated_tokens: all tokens if each document is cut at the limit; quantile: share of documents
    of at most this length; total_docs, total_tokens: of all. No documents give no rows.
    """
    own = histogram.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"), F.floor(F.col("n_tokens") / BUCKET).alias("bucket"))
    buckets = own.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = [F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}{k}") for c in "dt" for k, w in (("_after", after), ("_all", every))]
    buckets = buckets.select("bucket", *sums)
    here = Window.partitionBy("bucket").orderBy(F.desc("n_tokens"))
    docs_at_least = F.sum("n_docs").over(here) + F.col("d_after")
    tokens_at_least = F.sum("tokens").over(here) + F.col("t_after")
    out = own.join(buckets, "bucket").select("n_tokens", "n_docs", docs_at_least.alias("docs_at_least"), tokens_at_least.alias("tokens_at_least"), F.col("d_all").alias("total_docs"), F.col("t_all").alias("total_tokens"))
    return out.select(
        "*",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("quantile"),
    )


def quantile(limits: DataFrame, q: float) -> DataFrame:
    """(n_tokens): the smallest length that at least a share ``q`` of the documents does not exceed."""
    return limits.filter(F.col("quantile") >= q).agg(F.min("n_tokens").alias("n_tokens"))


def totals_at(limits: DataFrame, limit: int) -> DataFrame:
    """(total_tokens, truncated_tokens, documents_cut) for any context limit, occurring or not."""
    over = limits.filter(F.col("n_tokens") > limit)
    cut = over.agg(F.coalesce(F.max("docs_at_least"), F.lit(0)).alias("documents_cut"), F.coalesce(F.max("tokens_at_least"), F.lit(0)).alias("t"))
    every = limits.agg(F.coalesce(F.max("total_tokens"), F.lit(0)).alias("total_tokens"))
    one = every.withColumn("k", F.lit(1)).join(cut.withColumn("k", F.lit(1)), "k")
    return one.select("total_tokens", (F.col("total_tokens") - F.col("t") + F.lit(limit) * F.col("documents_cut")).alias("truncated_tokens"), "documents_cut")
