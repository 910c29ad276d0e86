"""A training corpus from raw documents: five stages over the columns of ``documents``.

quality -> near-dedup -> substring dedup -> decontamination -> mixing. Every stage works on all that
the one before kept, and its result is written and read again before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terraflux.llm import decontaminate, mixing, quality, simhash, substring_dedup
from terraflux.llm.shared import discard, materialise, read, temporary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the classifier accepts."""
    return quality.accepted(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return simhash.keep_one(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; a document that is nothing else goes."""
    return substring_dedup.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training corpus: one row per taken copy with the document's columns, its text as it is taken, and its position, range-sorted;
    documents that are not taken follow with no text and no position."""
    return mixing.texts_in_order(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup_stage),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote for itself is deleted when its result is written, and the result after the next one's.

    The last result has the texts that are to be trained on, so nothing is lost that the stages have not dropped.
    """
    docs = before = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        with temporary():
            docs = materialise(stage(spark, before, sf_dir), "pipeline-" + name.replace(" ", "-"), keep=True)
        if i:
            discard(before)
        before = docs
    return docs


#: SQL expresses neither the classifier nor min-hash windows; tests hold the stages against brute force.
ORACLE_SQL = None
