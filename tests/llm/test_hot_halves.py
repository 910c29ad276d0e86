"""Windows that are hot under a half's min-hash are compared all with all."""

import numpy as np
import pyarrow as pa

import corpus_pipeline
from terraflux.llm import substring_dedup as sd
from terraflux.llm.tokens import Tokens


def similar(mine, theirs):
    """Which shingles of a window are at about the same place in the other."""
    return np.array([h != 0 and h in theirs[max(0, i - sd.SHIFT) : i + sd.SHIFT + 1] for i, h in enumerate(mine)])


def made_group(rng, n):
    """Windows around one shingle: copies of a few templates with changed, put in and repeated shingles, some near a text's end."""
    templates = rng.integers(1, 2**32, (3, 140), dtype=np.uint32)
    rows = []
    for k in range(n):
        own = templates[k % 3].copy()
        for at in rng.integers(10, 130, int(rng.integers(0, 4))):
            own[at : at + int(rng.integers(1, 5))] = rng.integers(1, 2**32)
        if k % 5 == 0:
            own = np.insert(own, int(rng.integers(60, 75)), rng.integers(1, 2**32, 2, dtype=np.uint32))
        if k % 7 == 0:
            own[: int(rng.integers(5, 40))] = 0
        rows.append(own[: 2 * sd._AROUND + 1])
    around = np.array(rows)
    doc = np.sort(rng.integers(0, 2 * n, n))
    pack = (np.arange(n) ** 2 + 100) << 12 | rng.integers(20, 46, n) << 6 | rng.integers(20, 46, n)  # a difference of two places tells both
    return doc, pack, around


def compared(doc, pack, around, blocks):
    links = set()
    block = np.arange(len(doc)) * 7 % 11 % blocks
    for i in range(blocks):
        for j in range(i, blocks):
            own = (block == i) | (block == j)
            n = int(own.sum())
            columns = {"doc": doc[own], "pack": pack[own], "hashes": [x.tobytes() for x in around[own]], "block": block[own], "i": np.full(n, i), "j": np.full(n, j)}
            out = sd._compared(pa.table(columns))
            links |= set(zip(*(out.column(k).to_pylist() for k in ("a", "b", "lo", "hi", "shift")), strict=True))
    return links


def classes(n, pairs):
    c = np.arange(n)
    for a, b in pairs:
        c[c == c[a]] = c[b]
    return {frozenset(np.flatnonzero(c == x).tolist()) for x in np.unique(c)}


def test_all_pairs_of_a_group():
    """Against a plain loop over all pairs, in one block and in three: the furthest reach of every window, and the classes."""
    doc, pack, around = made_group(np.random.default_rng(2), 150)
    lo, hi, place = pack >> 6 & 63, pack & 63, pack >> 12
    reach, pairs = {}, {}
    for a in range(len(doc)):
        for b in range(a):
            low, high = min(lo[a], lo[b]), min(hi[a], hi[b])
            if doc[a] == doc[b] or low + high + 1 < sd.PASSAGE:
                continue
            hit = similar(around[a], around[b])[sd._AROUND - low : sd._AROUND + high + 1]
            if hit.sum() * 9 < 8 * sd.PASSAGE:
                continue
            score = np.concatenate([[0], np.cumsum(hit * 9 - 8)])
            found = [(x, y) for x in range(len(hit)) for y in range(x + sd.PASSAGE, len(hit) + 1) if score[y] >= score[x]]
            if found:
                pairs[a, b] = min(x for x, _ in found) - low, max(y for _, y in found) - 1 - low
                old = reach.get(a, (99, -99))
                reach[a] = min(old[0], pairs[a, b][0]), max(old[1], pairs[a, b][1])
    assert 50 < len(reach) < len(doc) and len(pairs) > 300
    for blocks in (1, 3):
        found = {(a, b, shift) for a, b, _, _, shift in compared(doc, pack, around, blocks)}
        links = {(a, b) for a in range(len(doc)) for b in range(a) if (doc[a], doc[b], place[a] - place[b]) in found}
        assert len(links) == len(found)
        assert links <= pairs.keys()
        got = {}
        for a, b in links:
            old = got.get(a, (99, -99))
            got[a] = min(old[0], pairs[a, b][0]), max(old[1], pairs[a, b][1])
        assert got == reach
        assert classes(len(doc), links) == classes(len(doc), pairs)
        assert len(links) <= 3 * len(doc) * (1 if blocks == 1 else 2 * blocks)


def test_similar_texts_of_a_template(spark):
    """400 texts with one passage of 60 words, one of which is another word in each: what repeats an earlier text, by comparing all pairs."""
    rng = np.random.default_rng(5)
    made = lambda n: [f"x{i}" for i in rng.integers(0, 10**7, n)]
    template, rows, own = made(60), [], []
    for _ in range(400):
        passage = list(template)
        passage[int(rng.integers(8, 52))] = made(1)[0]
        own.append(passage)
        rows.append([*made(50), *passage, *made(50)])
    shingles = np.array([[hash(tuple(p[i : i + 5])) for i in range(56)] for p in own])
    expected = {}
    for a in range(400):
        spans = [(x, y) for hit in shingles[:a] == shingles[a] for x, y, _ in sd.passages_in(hit)]
        if spans:
            expected[a] = set().union(*(range(x, y + 5) for x, y in spans))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(5)
    got = {}
    for r in sd.repeated_passages(docs).collect():
        got.setdefault(r["doc_id"], set()).update(range(r["start_word"] - 50, r["start_word"] - 50 + r["n_words"]))
    share = np.mean([len(e & got.get(a, set())) / len(e) for a, e in expected.items()])
    print(len(expected), "texts repeat an earlier one; share of their words found", round(float(share), 3), "of the whole", sum(e <= got.get(a, set()) for a, e in expected.items()))
    assert len(expected) > 300 and share >= 0.97


def test_pipeline_cuts_similar_passages_of_a_template(spark):
    """The pipeline's stage cuts such passages out of all texts but few."""
    rng = np.random.default_rng(9)
    made = lambda n: [f"x{i}" for i in rng.integers(0, 10**7, n)]
    template, rows = made(60), []
    for _ in range(120):
        passage = list(template)
        passage[int(rng.integers(25, 35))] = made(1)[0]
        rows.append([*made(50), *passage, *made(50)])
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").repartition(5)
    left = [len(r["text"].split()) for r in corpus_pipeline.substring_dedup_stage(spark, docs, "").collect()]
    print(sum(n < 120 for n in left), "of 120 are cut")
    assert len(left) == 120 and sum(n < 120 for n in left) >= 100


def test_copies_are_settled_by_few_partners(monkeypatch):
    """Windows of 1500 copies of one template with a changed shingle each: 1.1 million pairs are similar, but most need not be looked at."""
    rng = np.random.default_rng(7)
    around = np.tile(rng.integers(1, 2**32, 2 * sd._AROUND + 1, dtype=np.uint32), (1500, 1))
    around[np.arange(1500), rng.integers(20, 100, 1500)] = rng.integers(1, 2**32, 1500)
    looked, reaches = [0], sd.reaches
    monkeypatch.setattr(sd, "reaches", lambda hits, lo, hi: (looked.__setitem__(0, looked[0] + hits.shape[1]), reaches(hits, lo, hi))[1])
    links = compared(np.arange(1500), np.arange(1500) ** 2 << 12 | 45 << 6 | 45, around, 1)
    print(looked[0], "pairs looked at")
    assert {a for a, *_ in links} == set(range(1, 1500)) and looked[0] < 50 * 1500
    assert len(classes(1500, {(a, b) for a, b, *_ in links})) == 1


def test_hot_windows_whose_halves_differ(spark):
    """Passages that begin with one line and differ in a word behind it: of 3000 pairs those that meet in hot windows only, none of which has an equal half."""
    rng = np.random.default_rng(21)
    made = lambda n: [f"x{i}" for i in rng.integers(0, 10**7, n)]
    line = made(24)
    rows, pairs = [" ".join([*made(50), *line, *made(80)]) for _ in range(200)], set()
    for _ in range(3000):
        passage = [*line, *made(32)]
        two = []
        for word in (passage[27], "changed"):
            passage[27] = word
            two.append(" ".join([*made(50), *passage, *made(50)]))
        texts = [t.encode() for t in two]
        key, doc, pack, _ = sd._windows(np.arange(2), texts)
        place = pack >> 12
        around = (place - (pack >> 6 & 63) <= 51) & (place + (pack & 63) >= 98)  # of nearly the whole passage
        own = [dict(zip(key[(doc == i) & (place >= 50) & (place < 102)].tolist(), place[(doc == i) & (place >= 50) & (place < 102)].tolist())) for i in range(2)]
        met = own[0].keys() & own[1].keys()
        hot = {k for k in met if own[0][k] < 70}
        minima = [sd.half_minima(Tokens([t]).shingles(sd.SHINGLE)[0] | np.uint64(1 << 24)) for t in texts]
        apart = all(minima[0][own[0][k]] != minima[1][own[1][k]] for k in hot)
        whole = [set(key[(doc == i) & around].tolist()) for i in range(2)]
        if apart and hot & whole[0] & whole[1] and len({k % sd.HASHES for k in met - hot}) < sd.HITS:
            rows += two
            pairs.add((len(rows) - 1, len(rows) - 2))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(5)
    got = {(r["doc_id"], r["kept_doc_id"]) for r in sd.repeated_passages(docs).collect()}
    cut = {r["doc_id"]: len(r["text"].split()) for r in corpus_pipeline.substring_dedup_stage(spark, docs, "").collect()}
    print("found", len(pairs & got), "cut", sum(cut[a] < 156 for a, _ in pairs), "of", len(pairs))
    assert len(pairs) >= 4 and pairs <= got and all(cut[a] < 156 for a, _ in pairs)
