"""More languages than one pass counts."""

import numpy as np

from terraflux.llm import langid


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    made = lambda: "".join(rng.choice(letters, 6))
    own = {f"l{k:03}": [made() for _ in range(20)] for k in range(langid.LANGUAGES + 30)}
    rows = [(10 * k + i, " ".join(rng.choice(words, 40)), lang) for k, (lang, words) in enumerate(own.items()) for i in range(3 if k >= 30 else 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    held = docs.filter(docs.lang.isin(model.languages))
    assert len(model.languages) > langid.LANGUAGES
    lang = {r[0]: r[2] for r in rows}
    got = [(r["doc_id"], r["lang_pred"]) for r in langid.identify(held, model).collect()]
    assert sum(lang[i] == p for i, p in got) >= 0.99 * len(got)


def test_letters_of_all_planes(spark):
    """Emoji, digits and signs of any plane are no letters; letters beyond the basic plane are."""
    rows = [(i, "the cat and the dog", "en") for i in range(1, 30)] + [(i, "кошка и собака", "ru") for i in range(30, 60)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["😀", "😀 🎉🎉 123 !?", "𝟘𝟙 🜁", "½ ² № 7", "", None]
    odd = ["𐌰𐌱𐌲", "𠀋𠀌", "the cat 😀", "кошка😀"]
    docs = spark.createDataFrame(list(enumerate(texts + odd)), "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    assert [got[i] for i in range(len(texts))] == [("und", 0.0)] * len(texts)
    assert all(got[len(texts) + i][0] in ("en", "ru") and got[len(texts) + i][1] > 0 for i in range(len(odd)))
    assert got[len(texts) + 2][0] == "en" and got[len(texts) + 3][0] == "ru"
    slots = langid.Words(["wort😀 𐌰 7".encode()])
    assert slots.letters.tolist() == [4, 1, 0] and [langid.NAMES[k] for k in slots.scripts] == ["latin", "other", "none"]
