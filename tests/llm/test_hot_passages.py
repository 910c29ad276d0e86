"""Passages around a line that very many texts have."""

import numpy as np

from terraflux.llm import substring_dedup


def test_equal_and_similar_passages_of_a_hot_group(spark):
    """A long common line takes most min-hashes; 30 pairs of texts repeat 60 words around it, 15 of them with one word changed."""
    rng = np.random.default_rng(11)
    made = lambda n: [f"x{i}" for i in rng.integers(0, 10**6, n)]
    line = [f"common{i}" for i in range(40)]
    rows, equal, similar = [], set(), set()
    for i in range(1500):
        rows.append([*made(60), *line, *made(60)])
    for k in range(30):
        a, b = 10 + k, 1400 + k
        around = [*made(10), *line, *made(10)]
        other = list(around)
        if k >= 15:
            other[5] = "changed"
        rows[a], rows[b] = [*made(60), *around, *made(60)], [*made(60), *other, *made(60)]
        (similar if k >= 15 else equal).add((b, a))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(7)
    got = {(r["doc_id"], r["kept_doc_id"]) for r in substring_dedup.repeated_passages(docs).collect() if r["start_word"] <= 66}
    print("equal", len(equal & got) / len(equal), "similar", len(similar & got) / len(similar))
    assert equal <= got
    assert len(similar & got) >= 0.8 * len(similar)


def test_every_place_of_a_passage(spark):
    """A text that has an earlier text's passage twice, and one whose frequent line stands alone before the passage around it."""
    rng = np.random.default_rng(12)
    made = lambda n: " ".join(f"y{i}" for i in rng.integers(0, 10**6, n))
    passage = made(70)
    line = made(30)
    around = f"{made(12)} {line} {made(12)}"
    rows = [(1, f"{made(40)} {passage} {made(40)}"), (2, f"{made(100)} {passage} {made(4830)} {passage} {made(60)}"), (3, f"{made(80)} {around} {made(80)}"), (4, f"{made(60)} {line} {made(200)} {around} {made(60)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["start_word"], r["n_words"]) for r in got} == {(2, 100, 70), (2, 5000, 70), (4, 290, 54)}
    cut = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(docs).collect()}
    assert passage not in cut[2] and len(cut[2].split()) == 4990
