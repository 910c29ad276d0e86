"""Operators against plain Python on the smallest tables, and held-out accuracy."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from terraflux.llm import decontaminate, langid, licenses, lm, mixing, quality, queries, simhash, substring_dedup, token_counts, tokens, vafile

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def words(text):
    return (text or "").encode().translate(tokens.LOWER).split()


class Groups(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def slow_fingerprint(text):
    w = words(text)
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_words_and_shingles(texts):
    some = [t.encode() for t in list(texts.values())[:50]] + [None, b"", b"a", b"A b\tc\x0bd E"]
    t = tokens.Tokens(some)
    assert [t.words(d) for d in range(len(some))] == [words(x.decode() if x else None) for x in some]
    assert t.counts.tolist() == [len(words(x.decode() if x else None)) for x in some]
    seen = {}
    for w, h in zip((w for x in some for w in words(x.decode() if x else None)), t.hashes().tolist(), strict=True):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    hashes, bounds = t.shingles(5)
    seen = {}
    for d, x in enumerate(some):
        w = words(x.decode() if x else None)
        own = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
        assert len(own) == bounds[d + 1] - bounds[d]
        for s, h in zip(own, hashes[bounds[d] : bounds[d + 1]].tolist(), strict=True):
            assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_simhash(spark, texts):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash_near_dedup(spark, SF).collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    groups = Groups()
    for i, a in prints.items():
        for j, b in prints.items():
            if i < j and bin(a ^ b).count("1") <= 4:
                groups.join(i, j)
    assert got == {i: (f"{p:016x}", groups.find(i)) for i, p in prints.items()}


@pytest.mark.parametrize("chain", [2, 4, 6, 8])
def test_patterns_lose_no_pair(chain):
    rng, masks = np.random.default_rng(chain), simhash.patterns(chain)
    for _ in range(3000):
        x = 0
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            x |= 1 << int(b)
        assert any(x & m == 0 for m in masks)


@pytest.mark.parametrize(("block", "chain"), [(2048, 6), (16, 2), (16, 6)])
def test_links_of_a_dense_group(spark, monkeypatch, block, chain):
    """Near copies in one place, in cells split into blocks: what is reachable stays reachable."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(5)
    prints = {0}
    for _ in range(300):
        x = int(rng.choice(list(prints)))
        for b in rng.choice(64, 3, replace=False):
            x ^= 1 << int(b)
        prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = Groups()
    for r in simhash.links(df, chain).collect():
        assert bin((r["u"] ^ r["v"]) & (2**64 - 1)).count("1") <= 4
        found.join(r["u"] % 2**64, r["v"] % 2**64)
    exact = Groups()
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if bin(a ^ b).count("1") <= 4:
                exact.join(a, b)
    assert [found.find(p) for p in prints] == [exact.find(p) for p in prints]


def test_components(spark):
    from terraflux.llm.graph import components

    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(int(a), int(b)) for a, b in rng.integers(200, 260, (40, 2))] + [(5, 5), (None, 3)]
    exact = Groups()
    for a, b in links:
        if a is not None and a != b:
            exact.join(a, b)
    got = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {v: exact.find(v) for v in list(exact)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def slow_windows(h, least):
    """(c, l, r) of all positions by walking outwards."""
    out = []
    for c, x in enumerate(h):
        left, right = c, c
        while left > 0 and h[left - 1] > x:
            left -= 1
        while right + 1 < len(h) and h[right + 1] >= x:
            right += 1
        if right - left + 1 >= least:
            out.append((c, left, right))
    return out


@pytest.mark.parametrize("least", [1, 2, 5, 46])
def test_compact_windows(least):
    rng = np.random.default_rng(least)
    parts = [rng.integers(1, 2**39, n).astype(np.uint64) << np.uint64(24) for n in (0, 1, 60, 200, 45, 46)]
    spaced = np.concatenate([np.zeros(1, np.uint64), *[x for p in parts for x in (p, np.zeros(1, np.uint64))]])
    got = {(int(c), int(left), int(right)) for c, left, right in zip(*substring_dedup.compact_windows(spaced, least), strict=True)}
    expected, at = set(), 1
    for p in parts:
        expected |= {(at + c, at + a, at + b) for c, a, b in slow_windows(p.tolist(), least)}
        at += len(p) + 1
    assert got == expected


def test_repeated_passages(docs, texts):
    """Every text that shares 50 words in a row with an earlier one is found, and what is found is similar."""
    found = substring_dedup.repeated_passages(docs).collect()
    places, exact = defaultdict(list), set()
    for i in sorted(texts):
        w = words(texts[i].lower())
        shingles, active = [tuple(w[j : j + 5]) for j in range(len(w) - 4)], {}
        for s in shingles:
            active = {(o, p): active.get((o, p - 1), 0) + 1 for o, p in places.get(s, ())}
            if any(n >= 46 for n in active.values()):
                exact.add(i)
        for j, s in enumerate(shingles):
            places[s].append((i, j))
    assert exact and exact <= {r["doc_id"] for r in found}
    for r in found:
        assert r["kept_doc_id"] < r["doc_id"] and r["n_words"] >= 50 and r["similarity"] >= 0.8
        w, v = words(texts[r["doc_id"]].lower())[r["start_word"] : r["start_word"] + r["n_words"]], words(texts[r["kept_doc_id"]].lower())
        own = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
        assert len(own & {tuple(v[j : j + 5]) for j in range(len(v) - 4)}) >= 0.85 * len(own)


def test_language_model(spark, texts):
    got = {r["doc_id"]: r for r in queries.op3_lm_scoring(spark, SF).collect()}
    counts, end = Counter(), "end"
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 10:
            counts.update([*words(t), end])
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        w = [*words(t), end]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        r = got[i]
        assert r["base_score"] == pytest.approx(base) and (r["n_tokens"], r["train_tokens"], r["n_known"], r["held_out"]) == (len(w), n, sum(x in counts for x in w), zlib.crc32(str(i).encode()) % 10 == 0)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_language_model_is_normalised(docs):
    model = lm.train(docs)
    assert np.allclose((10.0 ** lm.class_log10(model.parameters)).sum(axis=1), 1, atol=1e-5)
    v = model.vocabulary
    tails = {r["tail"]: (r["n"], r["v"]) for r in model.counts.filter(~F.col("hash").isin([int(x) for x in lm.signed(v.own_hashes)] + [int(lm.signed(np.array([lm.END]))[0])])).groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    for tail, (n, types) in tails.items():  # words of a class and one unseen outcome
        assert (n + 0.1 * types + 0.1) / v.tail_mass[tail] == pytest.approx(1)
    lm.forget(model)


def test_language_id(docs):
    got = langid.identify(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_viterbi_equals_full_search():
    rng = np.random.default_rng(2)
    scores, first = rng.normal(0, 8, (60, 3)).astype(np.float32), np.array([0, 7, 7, 8, 60])
    got = langid.viterbi(scores, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        value = np.zeros(3)
        for t in range(a, b):
            value = np.maximum(value, value.max() - langid.SWITCH) + scores[t]
        path = got[a:b]
        total = scores[np.arange(a, b), path].sum() - langid.SWITCH * np.count_nonzero(np.diff(path))
        assert b == a or total == pytest.approx(value.max(), abs=1e-3)


def test_mixed_languages_and_scripts(spark):
    rows = [(i, "the cat and the dog were in the house that was old", "en", 0) for i in range(1, 40)] + [(i, "кошка и собака были в доме который был старым", "ru", 0) for i in range(40, 80)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, x int"))
    text = "the dog was in the house the dog was in кошка и собака были в доме который"
    spans = model.spans([text.encode()])[0]
    assert [(s["language"], s["start"], s["words"]) for s in spans] == [("en", 0, 10), ("ru", 10, 7)]


def test_top_k(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r["vec_id"]: np.floor(1024 * np.array(r["embedding"], float)).astype(int) for r in df.collect()}
    got = defaultdict(list)
    for r in vafile.top_k(df, df.filter("vec_id % 100 = 0"), 10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q in (i for i in rows if i % 100 == 0):
        best = sorted((-int(rows[q] @ x), i) for i, x in rows.items() if i != q)[:10]
        assert got[q] == [(i, -s) for s, i in best]


def test_quality(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.score(docs, quality.train(docs, labels)).join(labels.withColumnRenamed("quality", "q"), "doc_id").collect()
    assert sum(r["q"] == r["predicted"] for r in rows) >= 0.9 * len(rows)


def test_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((quality.fit(x[:3000], y[:3000]).score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95


def test_water_filling(spark):
    rows = [("a", 10), ("b", 1000), ("c", 10), ("d", 500), (None, 3), ("e", 0)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [1, 2, 3, 1, 2, 3], strict=True))
    sizes, total = dict(rows), sum(n for _, n in rows)
    full: set = set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        want = {s: 3 * sizes[s] if s in full else rest * weight[s] / sum(w for x, w in weight.items() if x not in full) for s in sizes}
        over = {s for s in sizes if want[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    assert got == pytest.approx(want)


def test_positions_invert_the_demand(spark):
    for ramp in (-0.5, 0.0, 0.5):
        for r in spark.range(11).select((F.col("id") / 10).alias("y")).select("y", mixing.position(F.col("y"), F.lit(ramp)).alias("t")).collect():
            assert (1 - ramp) * r["t"] + ramp * r["t"] ** 2 == pytest.approx(r["y"]) and 0 <= r["t"] <= 1


def test_token_counts(docs, texts):
    with open(token_counts.RANKS, "rb") as file:
        encode = token_counts.encoding(file.read()).encode_ordinary
    lengths = [len(encode(t or "")) for t in texts.values()]
    limits = token_counts.context_limits(token_counts.lengths_histogram(docs)).cache()
    for r in limits.collect():
        limit = r["n_tokens"]
        assert r["n_docs"] == lengths.count(limit) and r["docs_at_least"] == sum(n >= limit for n in lengths)
        assert r["truncated_tokens"] == sum(min(n, limit) for n in lengths) and r["total_tokens"] == sum(lengths)
    assert token_counts.totals_at(limits, 100).first()[:] == (sum(lengths), sum(min(n, 100) for n in lengths), sum(n > 100 for n in lengths))
    assert token_counts.quantile(limits, 0.5).first()[0] == sorted(lengths)[math.ceil(len(lengths) / 2) - 1]


def test_decontamination(spark, docs, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    strings = lambda t: decontaminate._strings(words(t.lower()))
    own = {i: strings(t) for i, t in texts.items()}
    expected = {(i, j) for j, t in items.items() for i in own if len(own[i] & strings(t)) >= 0.8 * len(strings(t))}
    got = decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected and expected


def test_licence_rules(spark):
    texts = {
        1: "Some prose.\nThis work is licensed under the GNU General Public License, version 3.",
        2: "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.\nYou may obtain a copy of the License at http://x\nUnless required by applicable law or agreed to in writing, software is distributed",
        3: "Copyright 2020 Someone. All rights reserved.",
        4: "Released under the MIT License. GNU General Public License version 2. Or, at your option, any later version.",
        5: "The license of this is a mystery.",
    }
    got = {r["doc_id"]: (r["licences"], r["unused"]) for r in licenses.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == {1: ("GPL-3.0-only", ""), 2: ("Apache-2.0", ""), 3: ("All-Rights-Reserved", ""), 4: ("MIT;GPL-2.0-or-later", ""), 5: ("", "unknown,")}


def test_passage_in_a_group_that_shares_a_frequent_line(spark):
    """Texts that all have one line, and a few that repeat a passage around it, far apart in the order of ids."""
    rng = np.random.default_rng(7)
    line = "this very common line of words occurs everywhere"
    made = lambda n: " ".join(f"x{i}" for i in rng.integers(0, 10**6, n))
    around = f"{made(22)} {line} {made(22)}"
    rows = [(i, f"{made(80)} {around if i in (3, 40, 77) else line} {made(80)}") for i in range(100)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {r["doc_id"] for r in got} == {40, 77} and {r["kept_doc_id"] for r in got} <= {3, 40}
    assert all(r["start_word"] == 80 and r["n_words"] == 52 for r in got)


def test_half_signs():
    rng = np.random.default_rng(9)
    h = np.concatenate([[0], rng.integers(1, 2**63, 70), [0], rng.integers(1, 2**63, 10), [0]]).astype(np.uint64)
    got = substring_dedup.half_signs(h)
    for i in range(len(h)):
        own = h[i : i + substring_dedup._HALF]
        whole = len(own) == substring_dedup._HALF and (own > 0).all()
        least = (own * substring_dedup._SIDE).min() if whole else None
        assert got[i] == (int(tokens.mix(np.array([least]))[0]) >> 54 if whole else 0)
