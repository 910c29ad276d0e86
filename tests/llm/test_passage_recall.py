"""How many repeated passages are found: equal ones around a line that thousands of texts have, and similar ones."""

import numpy as np
import pytest

from terraflux.llm import substring_dedup, tokens


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.mark.parametrize("n", [400, 4000, 12000])
def test_repeats_around_a_long_common_line(spark, n):
    """All texts have one line of 40 words; a tenth of 300 of them repeat another's 60 words around it."""
    rng = np.random.default_rng(n)
    made = lambda k: [f"x{i}" for i in rng.integers(0, 10**7, k)]
    line = [f"common{i}" for i in range(40)]
    rows = [[*made(30), *line, *made(30)] for _ in range(n)]
    expected = set()
    for a, b in rng.permutation(n)[:60].reshape(-1, 2).tolist():
        around = [*made(10), *line, *made(10)]
        rows[a], rows[b] = [*made(30), *around, *made(30)], [*made(30), *around, *made(30)]
        expected.add((max(a, b), min(a, b)))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(5)
    got = {(r["doc_id"], r["kept_doc_id"]): r for r in substring_dedup.repeated_passages(docs).collect()}
    found = expected & got.keys()
    print(n, "texts: found", len(found) / len(expected))
    assert len(found) >= 0.9 * len(expected) and got.keys() <= expected
    assert all((got[p]["start_word"], got[p]["n_words"]) == (30, 60) for p in found)


def test_similar_passages(spark):
    """Pairs of texts that share 120 words but for some replaced ones: those that are 0.8 similar or more as they stand."""
    rng = np.random.default_rng(8)
    made = lambda k: [f"z{i}" for i in rng.integers(0, 10**7, k)]
    rows, similarity = [], {}
    for k in range(300):
        own = made(120)
        other = list(own)
        first = int(rng.integers(5, 90))  # one word, two words apart, or two close to each other
        for i in [first, first + int(rng.integers(5, 25))][: k % 3 + 1] if k % 3 < 2 else [first, first + 2]:
            other[i] = made(1)[0]
        a, b = shingles(own), shingles(other)
        similarity[2 * k + 1] = len(a & b) / len(a | b)
        rows += [[*made(50), *own, *made(50)], [*made(70), *other, *made(20)]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(5)
    covered = {}
    for r in substring_dedup.repeated_passages(docs).collect():
        assert r["kept_doc_id"] == r["doc_id"] - 1 and r["similarity"] >= 0.8
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["n_words"]
    for low, high in ((0.8, 0.85), (0.85, 0.9), (0.9, 0.95)):
        own = [i for i, s in similarity.items() if low <= s < high]
        hit = [i for i in own if covered.get(i, 0) >= 50]
        print(f"similarity {low} to {high}: {len(hit)} of {len(own)}")
        assert len(own) >= 20 and len(hit) >= 0.9 * len(own)


def test_windows_of_long_texts(monkeypatch):
    """Cut into stretches, a long text has a window of every passage, around its min-hash."""
    rng = np.random.default_rng(3)
    text = " ".join(f"w{i}" for i in rng.integers(0, 400, 5000)).encode()
    hashes, _ = tokens.Tokens([text]).shingles(substring_dedup.SHINGLE)
    hashes |= np.uint64(1 << 24)
    whole = substring_dedup._windows(np.array([1]), [text])
    monkeypatch.setattr(substring_dedup, "_LONG", 700)
    cut = substring_dedup._windows(np.array([1]), [text])

    def at(rows, f):
        out = {}
        for k, p in zip(rows[0].tolist(), rows[2].tolist(), strict=True):
            if k & (substring_dedup.HASHES - 1) == f:
                out.setdefault(p >> 12, []).append((p >> 6 & 63, p & 63))
        return out

    for f, factor in enumerate(substring_dedup._FACTORS):
        places, parts = at(whole, f), at(cut, f)
        assert places.keys() <= parts.keys()
        low = (hashes * factor | np.uint64(1 << 24)) >> np.uint64(24)
        for i in range(len(low) - substring_dedup.PASSAGE + 1):
            own = low[i : i + substring_dedup.PASSAGE]
            least = [i + int(j) for j in np.flatnonzero(own == own.min())]
            last = i + substring_dedup.PASSAGE - 1
            assert any(c - before <= i and last <= c + behind for c in least for before, behind in parts.get(c, []))


def test_groups_that_go_on_over_batches(monkeypatch):
    """Rows of one passage in many batches: each text but the first is linked to an earlier one, and none is partner of many."""
    import pyarrow as pa

    monkeypatch.setattr(substring_dedup, "HELD", 50)
    rng = np.random.default_rng(6)
    doc = np.sort(rng.integers(0, 700, 1500))
    doc[400:520] = doc[400]  # one text has the passage at many places
    doc = np.sort(doc)
    key = np.full(len(doc), 8)
    key[:10], key[-30:] = 4, 12
    pack = np.arange(len(doc)) << 12 | 45 << 6 | 45
    columns = [key, doc, pack, 0 * doc]
    batches = [pa.RecordBatch.from_arrays([*(pa.array(c[i : i + 37]) for c in columns), pa.nulls(len(doc[i : i + 37]), pa.int64())], substring_dedup._ROWS) for i in range(0, len(doc), 37)]
    links = pa.Table.from_batches(list(substring_dedup._meet(True)(iter(batches)))).to_pydict()
    pairs = set(zip(links["a"], links["b"], strict=True))
    assert all(b < a for a, b in pairs) and set(links["f"]) == {1 | int(substring_dedup._SIMILAR)}
    for k in (4, 8, 12):
        own = sorted(set(doc[key == k].tolist()))
        assert set(own[1:]) <= {a for a, _ in pairs}
    partners = {b: sum(x == b for _, x in pairs) for _, b in pairs}
    assert max(partners.values()) <= 1500 // 50


def test_windows_of_a_short_text_alone():
    """A text of few words has its windows whether or not other texts stand beside it."""
    text = " ".join(f"w{i}" for i in range(substring_dedup.WORDS)).encode()
    for texts in ([text], [text, b"x " * 3_000_000], [b"", text]):
        key, doc, pack, _ = substring_dedup._windows(np.arange(len(texts)), texts)
        own = doc == texts.index(text)
        assert own.sum() == substring_dedup.HASHES and len(set((pack[own] >> 6 & 63) + (pack[own] & 63))) == 1
