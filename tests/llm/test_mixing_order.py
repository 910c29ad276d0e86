"""The mixing query and the pipeline's last stage give every copy's position, in order."""

import corpus_pipeline
import pytest

from terraflux.llm import mixing, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def in_order(positions):
    placed = [p for p in positions if p is not None]
    return placed == sorted(placed) and None not in positions[: len(placed)]


def test_query_gives_positions(spark, docs):
    rows = queries.op8_mixing(spark, SF).collect()
    assert len(rows) == docs.count() and in_order([r["position_1"] for r in rows])
    for r in rows:
        places = [r[f"position_{k}"] for k in (1, 2, 3)]
        assert in_order(places) and sum(p is not None for p in places) == (-(-r["taken"] // r["size"]) if r["size"] else 0)
    assert any(r["position_2"] is not None for r in rows)


def test_position_is_the_share_of_training_before_a_copy(spark, docs):
    """Copies in order: the words before one are its position's share of all that the mix takes, but for the documents at work."""
    copies = mixing.in_order(mixing.mix(docs)).collect()
    total, before = sum(r["words"] for r in copies), 0
    longest = 4 * max(r["words"] for r in copies) * len({r["source"] for r in copies})
    for r in copies:
        assert abs(before - r["position"] * total) <= longest
        before += r["words"]


def test_stage_gives_copies(spark, docs):
    rows = corpus_pipeline.source_mixing(spark, docs, SF).collect()
    assert in_order([r["position"] for r in rows])
    copies = sorted((r["position"], r["doc_id"], r["copy"], r["taken"]) for r in rows if r["position"] is not None)
    assert copies == [(r["position"], r["doc_id"], r["copy"], r["words"]) for r in mixing.in_order(mixing.mix(docs)).collect()]
    assert any(r["copy"] == 1 for r in rows)


def test_the_mixed_corpus_has_its_text(spark):
    """Whole copies have the whole text, the partial copy its first words with their white space, the rest none; ids may repeat or be null."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(3 + i % 5)) + ("\n tail " if i % 2 else ""), "de", "s" + str(i % 3), 7) for i in range(40)]
    rows += [(3, "other text of\tthe  same id", "en", "s0", 1), (None, "a b c", "en", "s1", 2), (None, "a b c", "en", "s1", 3), (None, None, None, None, None), (50, "", "en", "s2", 0), (51, None, "en", "s2", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars int, size string")
    out = mixing.texts_in_order(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "source_size", "target", "copy", "taken", "position"] and in_order([r["position"] for r in out.collect()])
    plain = mixing.every_copy(mixing.mix(docs))
    names = ["doc_id", "source", "size", "copy", "taken", "position"]
    assert sorted(map(tuple, out.select(*names).collect()), key=str) == sorted(map(tuple, plain.select(*names).collect()), key=str)
    texts, partial = {}, 0
    for i, text, *_ in rows:
        texts.setdefault(i, []).append(text)
    for r in out.collect():
        whole = [t for t in texts[r["doc_id"]] if len((t or "").split()) == r["size"]]
        if r["copy"] is None:
            assert r["text"] == "" and r["taken"] == 0 and r["n_chars"] == 0
        elif r["taken"] == r["size"]:
            assert r["text"] in whole
        else:
            partial += 1
            assert len(r["text"].split()) == r["taken"] and r["n_chars"] == len(r["text"]) and any(t.startswith(r["text"]) for t in whole)
    assert partial and mixing.texts_in_order(docs.limit(0)).count() == 0
