"""op13 against brute force over all pairs, whatever the boundary, blocks and levels."""

import random
import re

import numpy as np
import pytest

from terraflux.llm import jaccard_join
from terraflux.llm.queries import QUERIES


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i : i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()


def expected(docs, percent=90):
    sets = [shingles(t) for _, t in docs]
    tree = list(range(len(docs)))

    def find(i):
        while tree[i] != i:
            i = tree[i]
        return i

    order = sorted(range(len(docs)), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1 :]:
            if 100 * len(sets[i]) < percent * len(sets[j]):
                break
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                tree[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((-1 if d is None else d), len(sets[i]), -1 if least.get(find(i)) is None else least[find(i)]) for i, (d, _) in enumerate(docs))


def got(df, **kwargs):
    plain = lambda x: -1 if x is None else x
    out = jaccard_join.similar_sets(df, **kwargs)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((plain(r[0]), r[1], plain(r[2])) for r in out.collect())


def corpus(seed, n, sizes, line=""):
    """Base texts with copies in which some words are replaced, added or left out, around the limit."""
    rng = random.Random(seed)
    docs = []
    while len(docs) < n:
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice(sizes))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            own = list(base)
            for _ in range(rng.randrange(max(2, len(base) // 25))):
                at = rng.randrange(len(own) + 1)
                what = rng.randrange(3)
                if what == 0 or not own[at : at + 1]:
                    own.insert(at, f"n{rng.randrange(9999)}")
                elif what == 1:
                    own[at] = f"n{rng.randrange(9999)}"
                else:
                    del own[at]
            docs.append((len(docs), " ".join(([line] if line and rng.random() < 0.8 else []) + own)))
    rng.shuffle(docs)
    return docs


LINE = " ".join(f"common{i}" for i in range(60))


@pytest.mark.parametrize("small", [None, 0, 25, 60])
def test_brute_force(spark, small):
    """Sizes around the first steps of what may be missing; lists only, subsets only, both."""
    docs = corpus(1, 500, [3, 9, 10, 11, 12, 13, 20, 22, 30, 45, 60], LINE)
    assert got(spark.createDataFrame(docs, "doc_id long, text string"), small=small) == expected(docs)


def test_levels(spark):
    """Sets around the sizes at which bitmaps double."""
    docs = corpus(2, 150, [480, 515, 520, 560, 1000, 1030, 1100], LINE)
    assert got(spark.createDataFrame(docs, "doc_id long, text string")) == expected(docs)


def test_blocks(spark, monkeypatch):
    """Hot keys and clusters in many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "CLUSTER_BYTES", 4000)
    docs = corpus(3, 300, [40], LINE)
    base = [f"b{i}" for i in range(80)]
    docs += [(1000 + i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :] + [f"y{i // 9}"])) for i in range(70)]
    assert got(spark.createDataFrame(docs, "doc_id long, text string")) == expected(docs)


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_other_limits(spark, percent):
    docs = corpus(4, 200, [12, 30, 70])
    assert got(spark.createDataFrame(docs, "doc_id long, text string"), percent=percent) == expected(docs, percent)


def test_limits_of_sets():
    """The bounds that the filters rest on, by search over sizes."""
    for a in range(1, 60):
        linked = [(b, o) for b in range(1, 80) for o in range(1, min(a, b) + 1) if 100 * o >= 90 * (a + b - o)]
        assert jaccard_join.missing(a) == max(a - o for _, o in linked)
        assert all(o >= jaccard_join.shared(a, b) for b, o in linked)
        for b in {b for b, _ in linked}:
            assert min(o for c, o in linked if c == b) == jaccard_join.shared(a, b)
    assert [jaccard_join.level_of(n) for n in (1, 512, 513, 1024, 1025)] == [0, 0, 1, 1, 2]
    own = np.random.default_rng(0).integers(0, 2**63, 700, dtype=np.uint64)
    whole = jaccard_join.parities(own, 512).view(np.uint64)
    assert (whole[:4] ^ whole[4:] == jaccard_join.parities(own, 256).view(np.uint64)).all()


def test_edges(spark):
    """Nulls, empty and very long texts, copies, repeated rows, clashing columns, no rows."""
    long = " ".join(f"v{i % 7919} u{i}" for i in range(30_000))
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (6, "one two three"), (None, "one two three"), (None, None), (None, "a b c d e"), (None, "a b c d e"),
        (7, long), (8, long + " tail"), (9, "x"), (10, "ÄÖ ü"), (11, "äö ü"), (12, "z " * 5000), (13, "z z z"), (14, "q" * 300_000),
    ]
    df = spark.createDataFrame([(*r, 1, 2, 3, "k") for r in docs], "doc_id long, text string, n long, f long, cid long, key string")
    assert got(df) == expected(docs)
    assert got(df.limit(0)) == []


def test_query(spark):
    """The whole table at the smallest scale."""
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op13_jaccard_join"](spark, sf).collect()) == expected(docs)
