"""The quality and language queries against plain Python, text by text, and every operator on a text of megabytes."""

import math
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from terraflux.llm import decontaminate, langid, licenses, lm, mixing, quality, queries, simhash, substring_dedup, token_counts, tokens

SF = "/root/testdata/sf0.001"
SPACE = b" \t\n\x0b\x0c\r"
MARKS = set(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
PLAIN_MARKS = set(b".,;:'\"-()?!")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def statistics(text):
    """The document statistics of one text, in the order of ``quality.FEATURES``."""
    raw = (text or "").encode()
    words, n, size = raw.split(), len(raw.split()), len(raw)
    lower = [w.lower() for w in words]
    count = lambda kind: sum(b in kind for b in raw)
    per_byte, per_word = 1 / max(size, 1), 1 / max(n, 1)
    share = lambda test: sum(map(test, words)) * per_word
    mean = sum(map(len, words)) * per_word
    return [
        math.log1p(n), math.log1p(size), mean, count(set(range(65, 91))) * per_byte, count(set(b"0123456789")) * per_byte, count(MARKS) * per_byte, count(MARKS - PLAIN_MARKS) * per_byte,
        count(set(range(128, 256))) * per_byte, raw.count(b"\n") * per_word, sum(a == b for a, b in zip(lower, lower[1:], strict=False)) * per_word, len(set(lower)) * per_word,
        share(lambda w: len(w) <= 3), share(lambda w: len(w) > 12), share(lambda w: w[0] in MARKS and w[-1] in MARKS), share(lambda w: 65 <= w[0] <= 90), count(set(b".?!")) * per_word,
        math.sqrt(max(sum(len(w) ** 2 for w in words) * per_word - mean**2, 0)),
    ]


def test_quality_of_every_text(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    forest = quality.train(docs, labels)
    got = {r["doc_id"]: r for r in queries.op7_quality_classifier(spark, SF).collect()}
    for r in docs.collect():
        x = statistics(r["text"])
        total = forest.base
        for feature, cut, leaf in zip(forest.feature, forest.cut, forest.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if x[feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        own = got[r["doc_id"]]
        assert own["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
        assert own["predicted"] == (own["score"] >= 0.3) and own["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert len(got) == docs.count()


def script_of(char):
    if unicodedata.category(char)[0] != "L":
        return None
    return next((name for name, lo, hi in langid.SCRIPTS if lo <= ord(char) <= hi), "other")


def language_features(text):
    """Per word of a text: slots of its byte trigrams, its own slot, script, number of letters."""
    raw = (text or "").encode()
    raw = bytes(b | 0x20 if 65 <= b <= 90 else b for b in raw)
    folded = bytearray(raw)
    for i, b in enumerate(raw[:-1]):
        if b == 0xC3 and 0x80 <= raw[i + 1] <= 0x9E and raw[i + 1] != 0x97:
            folded[i + 1] += 0x20
    hashes = tokens.Tokens([(text or "").encode()]).hashes().tolist()
    out, at = [], 0
    for w, h in zip(raw.split(), hashes, strict=True):
        at = raw.index(w, at)
        padded = b" " + bytes(folded[at : at + len(w)]) + b" "
        at += len(w)
        slots = [((padded[i] << 16 | padded[i + 1] << 8 | padded[i + 2]) * 0x9E3779B1 % 2**32) >> 18 for i in range(len(w))]
        scripts = [s for s in map(script_of, w.decode("utf-8", "replace")) if s]
        out.append((slots, h % langid.SLOTS, max(scripts, key=langid.NAMES.index) if scripts else "none", len(scripts)))
    return out


def test_language_of_every_text(spark, docs):
    rows = docs.collect()
    train = [r for r in rows if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    languages = sorted({r["lang"] for r in train})
    grams, own_words, scripts = ({lang: Counter() for lang in languages} for _ in range(3))
    features = {r["doc_id"]: language_features(r["text"]) for r in rows}
    for r in train:
        for slots, slot, script, _ in features[r["doc_id"]]:
            grams[r["lang"]].update(slots)
            own_words[r["lang"]][slot] += 1
            scripts[r["lang"]][script] += 1

    def weights(counts):
        total = {lang: sum(c.values()) for lang, c in counts.items()}
        log = lambda lang, slot: math.log((counts[lang][slot] + 0.5) / (total[lang] + 0.5 * langid.SLOTS))
        cache = {}

        def of(slot):
            if slot not in cache:
                logs = np.array([log(lang, slot) for lang in languages])
                cache[slot] = logs - logs.mean()
            return cache[slot]

        return of

    gram, word = weights(grams), weights(own_words)
    share = {lang: sum(n for s, n in scripts[lang].items() if s != "none") for lang in languages}

    def barred(script):
        if script == "none":
            return np.zeros(len(languages))
        ok = np.array([scripts[lang][script] >= 0.01 * max(share[lang], 1) for lang in languages])
        return np.where(ok | ~ok.any(), 0, -50.0)

    got = {r["doc_id"]: r for r in queries.op4_language_id(spark, SF).collect()}
    agree = 0
    for r in rows:
        words = features[r["doc_id"]]
        value, back = np.zeros(len(languages)), []
        for slots, slot, script, _ in words:
            own = np.zeros(len(languages)) if script == "none" else sum(map(gram, slots)) + word(slot)
            top = int(value.argmax())
            stays = value >= value[top] - langid.SWITCH
            back.append((stays, top))
            value = np.maximum(value, value[top] - langid.SWITCH) + own + barred(script)
        mass, now = defaultdict(int), int(value.argmax())
        for (stays, top), (_, _, _, letters) in zip(reversed(back), reversed(words), strict=True):
            mass[now] += letters
            now = now if stays[now] else top
        total = sum(mass.values())
        best = max(mass, key=lambda k: (mass[k], -k)) if total else None
        expected = (languages[best], mass[best] / total) if total else ("und", 0.0)
        own = got[r["doc_id"]]
        agree += own["lang_pred"] == expected[0] and abs(own["score"] - expected[1]) < 0.02
    assert agree >= 0.995 * len(rows) and len(got) == len(rows)


def test_a_text_of_megabytes(spark):
    """A text of 5 MB, and one word of 3 MB, through every operator on documents."""
    rng = np.random.default_rng(1)
    long = " ".join(f"w{i}" for i in rng.integers(0, 5000, 900_000))
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(1, "short text", "en", "a"), (2, f"{long} {passage}", "en", "b"), (3, "y" * 3_000_000, "en", "a"), (4, f"begin {passage} end", "en", "c"), (5, None, "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)
    every = [1, 2, 3, 4, 5]
    ids = lambda df: sorted(r["doc_id"] for r in df.collect())
    assert [(r["doc_id"], r["start_word"], r["n_words"]) for r in substring_dedup.repeated_passages(docs).collect()] == [(4, 1, 70)]
    assert ids(licenses.scan(docs)) == every
    model = lm.train(docs)
    scored = {r["doc_id"]: r for r in lm.score(docs, model).collect()}
    assert sorted(scored) == every and scored[2]["n_tokens"] == 900_071
    assert ids(langid.identify(docs, langid.train(docs))) == every
    assert ids(simhash.simhash_components(docs)) == every
    labels = spark.createDataFrame([(i, i % 2) for i in every], "doc_id long, quality int")
    assert ids(quality.score(docs, quality.train(docs, labels))) == every
    assert {r["doc_id"]: r["size"] for r in mixing.mix(docs).collect()} == {1: 2, 2: 900_070, 3: 1, 4: 72, 5: 0}
    assert token_counts.lengths_histogram(docs.filter("doc_id <> 3")).count() >= 3
    items = spark.createDataFrame([(9, passage)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.contaminated(docs, items).collect()) == [2, 4]
