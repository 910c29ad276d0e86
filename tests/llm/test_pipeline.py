"""The corpus pipeline on the smallest tables: every stage against plain Python on its own input."""

import re

import corpus_pipeline
import pytest

from terraflux.llm import decontaminate, simhash
from terraflux.llm.shared import materialise
from terraflux.llm.tokens import LOWER

SF = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().translate(LOWER).split()


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(outputs):
    assert all(sorted(o.columns) == sorted(outputs[0].columns) for o in outputs[:-1]) and len(corpus_pipeline.STAGES) == 5


def test_quality_goes_by_labels(spark, outputs):
    before, after = rows(outputs[0]), rows(outputs[1])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [i for i, quality in labels.items() if (i in after) != (quality == 1)]
    assert len(wrong) <= 0.1 * len(labels) and all(after[i] == before[i] for i in after)


def test_one_of_each_group_stays(outputs):
    before, after = rows(outputs[1]), rows(outputs[2])
    prints = {i: simhash.fingerprint((r["text"] or "").encode()) for i, r in before.items()}
    near = lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4
    assert not any(near(a, b) for a in after for b in after if a < b)
    assert all(any(near(a, b) for b in before if b != a) for a in before if a not in after)


def test_passages_stay_once(outputs):
    seen, repeated = {}, 0
    for i, r in sorted(rows(outputs[3]).items()):
        w = words(r["text"].lower())
        active = {}
        for j in range(len(w) - 4):
            s = tuple(w[j : j + 5])
            active = {(o, p): active.get((o, p - 1), 0) + 1 for o, p in seen.get(s, ()) if o != i}
            repeated += any(n >= 46 for n in active.values())
            seen.setdefault(s, []).append((i, j))
    assert not repeated
    before = rows(outputs[2])
    for i, r in rows(outputs[3]).items():
        if r["text"] == before[i]["text"]:
            assert r == before[i]
        else:
            assert len(r["text"]) == r["n_chars"] < before[i]["n_chars"]


def test_no_item_is_left(spark, outputs):
    items = [decontaminate._strings(words(r["text"].lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = rows(outputs[3]), rows(outputs[4])
    bad = {i for i, r in before.items() if any(len(s & decontaminate._strings(words(r["text"].lower()))) >= 0.8 * len(s) for s in items)}
    assert set(after) == set(before) - bad


def test_mix(outputs):
    before, placed = rows(outputs[4]), outputs[5].collect()
    assert {r["doc_id"] for r in placed} == set(before)
    sums = {}
    for r in placed:
        assert r["size"] == len(re.findall(rb"[^\x20\x09-\x0D]+", before[r["doc_id"]]["text"].encode())) and r["taken"] <= 3 * r["size"]
        sums.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(abs(a - b) < 1 for a, b in sums.values())


def test_the_corpus_has_its_text(outputs):
    """All columns of documents in every row; a taken copy has the stage before's text, up to its last taken word."""
    before, cut = rows(outputs[4]), 0
    assert set(outputs[0].columns) < set(outputs[5].columns)
    for r in outputs[5].collect():
        whole = before[r["doc_id"]]
        assert (r["source"], r["lang"]) == (whole["source"], whole["lang"])
        if r["copy"] is None:
            assert r["text"] == ""
        elif r["taken"] == r["size"]:
            assert (r["text"], r["n_chars"]) == (whole["text"], whole["n_chars"])
        else:
            cut += 1
            assert whole["text"].startswith(r["text"]) and len(words(r["text"])) == r["taken"] and r["n_chars"] == len(r["text"])
    assert 0 < cut <= len({r["source"] for r in before.values()})


def test_run(spark, outputs):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=str) == sorted(map(tuple, outputs[5].collect()), key=str)
