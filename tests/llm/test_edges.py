"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from terraflux.llm import decontaminate, langid, licenses, lm, mixing, quality, simhash, substring_dedup, token_counts, vafile

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, score double, component int, a int, b int, key string, hash long, size int, target int, position double, bucket int, w int, _spans int"


def pad(rows):
    return [(*r, 0, 0, 0.0, 0, 0, 0, "", 0, 0, 0, 0.0, 0, 0, 0) for r in rows]


PASSAGE = " ".join(f"word{i} of{i % 7} passage{i * 31 % 11}" for i in range(30))
LONG = " ".join(f"w{i % 997}" for i in range(60_000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, None, "en", None), (2, "", "en", "s1"), (3, " \n\t ", None, "s1"), (4, "one two", "en", "s2"), (5, "one two", "en", "s2"), (6, "123 --- 4", "de", "s3"),
        (None, "no id here at all", "en", "s1"), (None, None, None, None), (7, LONG, "de", "s1"), (7, LONG, "de", "s1"), (8, f"before {PASSAGE} after", "en", "s2"),
        (9, f"something else {PASSAGE} and the end", "en", "s2"), (10, "ÄÖÜ ß Жж 中文 ünïcödé", "de", "s3"), (11, "a" * 200_000, "en", "s3"), (12, "x " * 50_000, "en", "s3"),
    ]
    return spark.createDataFrame(pad(rows), SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.collect()), key=lambda x: (x is None, x))


ALL = [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10, 11, 12, None, None]


def test_simhash(docs, none):
    got = simhash.simhash_components(docs)
    assert ids(got) == ALL and got.columns == ["doc_id", "fp", "component_id"]
    by = {(r["doc_id"], r["component_id"]) for r in got.collect()}
    assert {(1, 1), (2, 1), (3, 1), (None, 1), (4, 4), (5, 4), (7, 7)} <= by
    assert simhash.simhash_components(none).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and ids(kept)[:3] == [1, 4, 6] and ids(kept).count(7) == 1 and ids(kept).count(None) == 2


def test_substring(docs, none):
    got = substring_dedup.repeated_passages(docs).collect()
    assert [(r["doc_id"], r["kept_doc_id"], r["start_word"], r["n_words"], r["similarity"]) for r in got] == [(9, 8, 2, 90, 1.0)]
    assert substring_dedup.repeated_passages(none).count() == 0
    cut = substring_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == 15
    row = cut.filter("doc_id = 9").first()
    assert row["text"] == "something else and the end" and row["n_chars"] == len(row["text"])
    assert substring_dedup.without_repeats(none).count() == 0


def test_substring_drops_a_text_that_is_nothing_else(spark):
    docs = spark.createDataFrame([(1, PASSAGE), (2, PASSAGE + "\n")], "doc_id long, text string")
    assert ids(substring_dedup.without_repeats(docs)) == [1]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, PASSAGE, 0), (2, None, 0), (3, "", 0), (4, "one two", 0), (None, PASSAGE, 0)], "item_id long, text string, doc_id int")
    got = decontaminate.contaminated(docs, items)
    pairs = sorted((r["doc_id"], r["item_id"] or 0) for r in got.collect())
    assert pairs == [(4, 4), (5, 4), (8, 0), (8, 1), (9, 0), (9, 1)]
    assert decontaminate.contaminated(none, items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == 11


def test_licences(docs, none):
    assert ids(licenses.scan(docs)) == ALL and {r["licences"] for r in licenses.scan(docs).collect()} == {""}
    assert licenses.scan(none).count() == 0


def test_language_model(docs, none):
    model = lm.train(docs)
    got = lm.score(docs, model)
    assert ids(got) == ALL
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["n_tokens"] == 1 and rows[4]["n_tokens"] == 3 and rows[7]["n_tokens"] == 60_001
    assert all(r["score"] <= 0 and r["base_score"] <= 0 for r in rows.values())
    empty = lm.train(none)
    assert lm.score(none, model).count() == 0
    row = lm.score(docs.filter("doc_id = 4"), empty).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["base_score"] == 0
    lm.forget(model)


def test_language_id(docs, none):
    model = langid.train(docs)
    got = langid.identify(docs, model)
    assert ids(got) == ALL
    rows = {r["doc_id"]: r for r in got.collect()}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 6)] == ["und"] * 4 and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[4]["lang_pred"] in ("en", "de") and rows[10]["lang_pred"] in ("en", "de")
    assert langid.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, langid.train(none)).collect()} == {"und"}
    assert ids(langid.language_spans(docs, model)) == ALL


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 13)] + [(4, None, 0), (None, 1, 0)], "doc_id long, quality int, score int")
    forest = quality.train(docs, labels)
    got = quality.score(docs, forest)
    assert ids(got) == ALL and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.collect())
    assert quality.score(none, forest).count() == 0 and quality.accepted(docs, forest).columns == docs.columns
    assert {r["score"] for r in quality.score(docs, quality.train(none, labels)).collect()} == {0.5}
    assert quality.accepted(none, quality.train(docs, labels.limit(0))).count() == 0


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x)) == ALL
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
    sums = {}
    for r in rows:
        sums.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
    assert all(abs(a - b) < 1 for a, b in sums.values())
    assert sum(b for _, b in sums.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert mixing.mix(none).count() == 0
    assert mixing.in_order(mixing.mix(docs)).agg(F.sum("words")).first()[0] == sum(r["taken"] for r in rows)


def test_token_counts(docs, none):
    limits = token_counts.context_limits(token_counts.lengths_histogram(docs))
    assert limits.agg(F.sum("n_docs")).first()[0] == 15 and token_counts.context_limits(token_counts.lengths_histogram(none)).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, None, 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (None, [1.0, 1.0], 1), (6, [], 1), (7, [2.0], 1), (8, [-1.0, 0.25, 7.0], 1), (1, [1.0, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = vafile.top_k(df, df.filter("vec_id % 100 = 0"), 3).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    top = 1024 * 1024 + 512 * 512
    assert sorted(by[0]) == [(1, 7, 2 * 1024 * 1024), (2, 1, top), (3, 1, top)] and sorted(by[100]) == [(1, 7, 2 * 1024 * 1024), (2, 0, top), (3, 1, top)]
    assert vafile.top_k(df.limit(0), df.limit(0)).count() == 0
    huge = spark.createDataFrame([(0, [3e38]), (1, [3e38]), (2, [-3e38]), (3, [1e-3])], "vec_id long, embedding array<float>")
    rows = vafile.top_k(huge, huge.filter("vec_id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in rows] == [(1, 2**63 - 1), (3, 2**63 - 1), (2, -(2**63))]


def test_copies_of_items_make_no_larger_block(spark, monkeypatch):
    """Items that are copies of one text, and more distinct words than a block holds."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    items = [(i, PASSAGE) for i in range(50)] + [(100 + i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(20)]
    table = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(decontaminate.item_blocks(table))
    assert len(blocks) > 2 and sum(len(b.ids) for b in blocks) == 21
    docs = spark.createDataFrame([(1, f"before {PASSAGE} after"), (2, items[-1][1]), (3, "nothing here")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, table).collect())
    assert got == [*((1, i) for i in range(50)), (2, 119)]
    assert ids(decontaminate.drop_contaminated(docs, table)) == [3]
