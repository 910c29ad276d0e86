"""Counts of codes by packets against a plain count."""

from collections import Counter

import numpy as np
import pyarrow as pa

from terraflux.llm import gram_counts as g


def test_counts_of_codes(spark):
    draw = np.random.default_rng(4)
    codes = np.concatenate([draw.integers(0, 1 << g.BITS, 3000), draw.integers(0, 40, 3000), [0, (1 << g.BITS) - 1, 1 << 24]])
    parts = np.array_split(codes, 5)
    tasks = [0, 1, 63, 64, 7000]  # several of one salt, others of other salts
    batches = [b for part, task in zip(parts, tasks, strict=True) for b in g.packed(part, task)]
    packets = spark.createDataFrame(pa.Table.from_batches(batches).to_pandas(), g.SCHEMA)
    got = {r["code"]: r["n"] for r in g.counted(packets).collect()}
    assert got == Counter(codes.tolist()) and g.counted(packets.limit(0)).count() == 0
