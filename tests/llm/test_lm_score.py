"""The language model's score, token by token in plain Python, and what its neural part gains."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from terraflux.llm import lm, lm_words, shared

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def case(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = lm.train(docs)
    return docs, model, lm.score(docs, model).collect()


def train_texts(docs):
    held = {r["doc_id"] for r in docs.filter(shared.id_remainder(docs.doc_id, lm.HOLD_OUT) == 0).collect()}
    return [r["text"] for r in docs.collect() if r["doc_id"] not in held]


def own_tokens(text):
    """(hash, class without own words) of a text's words and end."""
    t = lm.Text([(text or "").encode()])
    return list(zip(t.hashes.tolist(), t.tails.tolist(), strict=True))


def classes(model, tokens):
    """Class of each token: 1 for the end, a common word's own, or the one of its last bytes."""
    own = {h: 2 + i for i, h in enumerate(model.vocabulary.own_hashes.tolist())}
    return [1 if h == int(lm.END) else own.get(h, 2 + lm.OWN + tail) for h, tail in tokens]


def test_score_of_every_text(case):
    docs, model, rows = case
    counts = Counter(h for text in train_texts(docs) for h, _ in own_tokens(text))
    words = {h: tail for text in train_texts(docs) for h, tail in own_tokens(text) if h != int(lm.END)}
    common = sorted((h for h in counts if h != int(lm.END)), key=lambda h: (-counts[h], h))[: lm.OWN]
    assert sorted(common) == model.vocabulary.own_hashes.tolist()
    v = model.vocabulary
    sent = {h: i for i, h in enumerate(v.hashes.tolist())}  # common words: each an outcome of its class
    size, types, rare_size, rare_types = Counter(), Counter(), Counter(), Counter()
    members = defaultdict(list)
    for h, tail in words.items():
        if h not in set(common):
            size[tail] += counts[h]
            types[tail] += 1
            if h in sent:
                members[tail].append(h)
            else:
                rare_size[tail] += counts[h]
                rare_types[tail] += 1
    phi, theta = model.words.phi.astype(float), model.words.theta.astype(float)

    def within(h, tail, before):
        """Probability of a word in its class after a class: exponentials of all its outcomes, one by one."""
        rare = rare_size[tail] + lm.SMOOTH * (rare_types[tail] + 1)
        mass = size[tail] + lm.SMOOTH * (types[tail] + 1)
        weight = {m: (counts[m] + lm.SMOOTH) / mass * math.exp(phi[before] @ theta[sent[m]]) for m in members[tail]}
        weight[None] = rare / mass * math.exp(phi[before] @ theta[len(sent) + tail])
        p = weight[h if h in sent else None] / sum(weight.values())
        return p if h in sent else p * (counts[h] + lm.SMOOTH) / rare

    within_of = {}
    x, c, r, b = (p.astype(float) for p in model.parameters)
    texts = {row["doc_id"]: row["text"] for row in docs.collect()}
    for row in rows[:60]:
        tokens = own_tokens(texts[row["doc_id"]])
        total, before = 0.0, [0, 0]
        for k, (h, tail) in zip(classes(model, tokens), tokens, strict=True):
            logits = (x[before[0]] @ c[0] + x[before[1]] @ c[1]) @ r.T + b
            logits[0] = -np.inf
            total += (logits[k] - logits.max() - math.log(np.exp(logits - logits.max()).sum())) / math.log(10)
            if k >= 2 + lm.OWN:
                key = (h, tail, before[0])
                if key not in within_of:
                    within_of[key] = within(*key)
                total += math.log10(within_of[key])
            before = [k, before[0]]
        assert row["score"] == pytest.approx(total, rel=1e-4)


def test_grams_count_every_position(spark, case):
    docs, model, _ = case
    own = lm._binary(docs.filter(shared.id_remainder(docs.doc_id, lm.HOLD_OUT) != 0))
    got = {r["code"] & 0xFFFFFFFF: r["n"] for r in lm.class_grams(own, spark.sparkContext.broadcast(model.vocabulary)).collect()}
    expected = Counter()
    for text in train_texts(docs):
        before = [0, 0]
        for k in classes(model, own_tokens(text)):
            expected[(before[1] * lm.CLASSES + before[0]) * lm.CLASSES + k] += 1
            before = [k, before[0]]
    assert got == expected


def test_words_after_classes_count_every_position(spark, case):
    docs, model, _ = case
    own = lm._binary(docs.filter(shared.id_remainder(docs.doc_id, lm.HOLD_OUT) != 0))
    grams = lm.position_grams(own, spark.sparkContext.broadcast(model.vocabulary))
    got = {(r["outcome"], r["before"]): r["n"] for r in lm_words.by_outcome(grams, lm.WORDS_FROM, lm.CLASSES).collect()}
    sent = {h: i for i, h in enumerate(model.vocabulary.hashes.tolist())}
    expected = Counter()
    for text in train_texts(docs):
        before, tokens = 0, own_tokens(text)
        for k, (h, tail) in zip(classes(model, tokens), tokens, strict=True):
            if k >= 2 + lm.OWN:
                expected[(sent.get(h, len(sent) + tail), before)] += 1
            before = k
    assert got == expected


def test_entries_keep_the_counts():
    n = np.array([1, 3, 1000, 7, 64])
    row, weight = lm.entries(n, n.sum() / len(n))
    sums = defaultdict(float)
    for i, w in zip(row.tolist(), weight.tolist(), strict=True):
        sums[i] += w
    assert [round(sums[i], 3) for i in range(len(n))] == n.tolist() and weight.max() <= n.sum() / len(n)


def test_neural_part_helps_on_held_out_text(case):
    held = [r for r in case[2] if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_vectors_of_words_help_on_held_out_text(spark, case):
    """Against the same model with vectors of zeros, which is the share of a word in its class whatever is before."""
    docs, model, rows = case
    w, v = model.words, model.vocabulary
    flat = lm_words.Words(w.phi, np.zeros_like(w.theta), v.outcome_share, v.outcome_tail, lm.TAILS)
    assert np.allclose(flat.size, 0, atol=1e-5)  # shares add up to one
    without = {r["doc_id"]: r["score"] for r in lm.score(docs, lm.Model(v, model.parameters, flat, model.counts)).collect()}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(without[r["doc_id"]] for r in held)


def test_outcomes_of_every_class_add_up_to_one(case):
    words = case[1].words
    for k in (0, 1, 2, 97, 98, 255):
        at = np.arange(len(words.tail))
        p = 10.0 ** words.log10(np.full(len(at), k), at)
        assert np.allclose(np.bincount(words.tail, p, lm.TAILS), 1, atol=1e-4)


def test_solved_vectors_are_the_best():
    """The contrastive objective with its prior has no slope left, and every small move lowers it."""
    draw = np.random.default_rng(1)
    phi = lm_words.context_vectors(draw.normal(size=(40, 5)), np.full(40, 1 / 40))
    n = draw.poisson(3 * np.exp(phi[:, :3] @ draw.normal(size=(3, 7)))).astype(float)
    n[:, 3], n[1:, 4] = 0, 0  # an outcome that is never met, one that follows one class only
    n[0, 4] = 5000
    noise = lm_words.NOISE * n.sum(axis=1)[:, None] * np.full(7, 1 / 7)
    theta = lm_words.solve(n, noise, phi)

    def value(t):
        x = phi @ t.T - math.log(lm_words.NOISE)
        return -(n * np.logaddexp(0, -x) + noise * np.logaddexp(0, x)).sum(axis=0) - (t**2).sum(axis=1) / 2

    best = value(theta)
    for j in range(phi.shape[1]):
        for move in (-1e-3, 1e-3):
            near = theta.copy()
            near[:, j] += move
            assert (value(near) <= best + 1e-9 * np.abs(best)).all()


def test_rare_words_and_ends_without_common_words(spark, monkeypatch):
    """No word but the end is common: all share their class's one outcome, and probabilities still add up."""
    monkeypatch.setattr(lm, "COMMON", 2)
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(200)), "x") for i in (1, 2, 4)], "doc_id long, text string, clash string")
    model = lm.train(docs)
    assert model.vocabulary.hashes.tolist() == [int(lm.END)]
    rows = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    assert all(r["n_known"] == 201 and r["score"] < 0 for r in rows.values())
    assert rows[1]["score"] == pytest.approx(rows[2]["score"])
    lm.forget(model)


def test_parameters_do_not_depend_on_partitions(case):
    docs, model, _ = case
    again = lm.train(docs.repartition(7))
    assert np.allclose(model.words.theta, again.words.theta, rtol=1e-4, atol=1e-6)
    assert all((a == b).all() for a, b in zip(model.parameters, again.parameters, strict=True))
