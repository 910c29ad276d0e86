"""op12 against plain Python with the tokenizers' own libraries, and its edge cases."""

import hashlib
from bisect import bisect_left, bisect_right
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from terraflux.llm import alignment
from terraflux.llm.queries import QUERIES

ALPHABET = alignment._byte_alphabet()


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(alignment.BYTE_LEVEL)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)


def tokens(libraries, text):
    """[(id, bytes)] of both tokenizers; nothing where they do not give the text back."""
    a, b = libraries
    if not text:
        return [], []
    first = [(i, bytes(ALPHABET[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    same = all(b"".join(x for _, x in own) == (" " + text).encode() for own in (first, second))
    return (first, second) if same else ([], [])


def spans(own):
    out, at = [], 0
    for i, x in own:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def expected(libraries, docs):
    """Rows by pairwise comparison and union of overlapping tokens."""
    rows, counts = [], Counter()
    for doc_id, text in docs:
        first, second = map(spans, tokens(libraries, text))
        links, j = [], 0
        for i, begin, end in first:
            while j and second[j - 1][2] > begin:
                j -= 1
            while j < len(second) and second[j][1] < end:
                if second[j][2] > begin:
                    links.append((i, second[j][0]))
                j += 1
        ends = sorted({x[2] for x in first} & {x[2] for x in second})
        parts, low = [], 0
        for high in ends:
            side = [",".join(str(x[0]) for x in own[bisect_left(own, low, key=lambda x: x[1]) : bisect_right(own, high, key=lambda x: x[2])]) for own in (first, second)]
            parts.append("|".join(side))
            low = high
        counts.update(links)
        rows.append((doc_id, first, second, links, parts))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(
        ((d or 0, len(x), len(y), len(parts), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "") for d, x, y, links, parts in rows)
    )


TEXTS = [
    (1, None), (2, ""), (3, " "), (4, "one two three"), (5, "one two three"), (5, "naïve ﬁancée 日本語 😀"), (6, "<|endoftext|> and <s> plain </s>"), (7, "marked ▁ text"), (8, "tabs\tand\nlines \n\n"),
    (None, "no id"), (9, "Aα" * 3000), (10, "x" * 70_000), (11, " " * 5000 + "end"), (12, "word " * 20_000), (13, "\x00\x01   end"),
]


def rows(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((r["doc_id"] or 0, *[r[k] for k in names[1:]]) for r in df.collect())


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5, 0])
def test_edges(spark, libraries, frequent):
    """Null, empty, marked and very long texts, repeated ids; the count table's size changes nothing."""
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in TEXTS], "doc_id long, text string, n long, code long, row string")
    assert rows(alignment.align(df, frequent=frequent)) == expected(libraries, TEXTS)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert rows(alignment.align(df)) == [] and alignment.token_groups(df).count() == 0


def test_query(spark, libraries):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op12_token_alignment"](spark, sf_dir)) == expected(libraries, docs)


def test_groups(spark, libraries):
    """The groups as rows: both sides give the bytes between the group's offsets."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string")
    whole = {}
    for r in sorted(alignment.token_groups(df.filter("doc_id <> 5")).collect(), key=lambda r: (r["doc_id"], r["position"])):
        whole.setdefault(r["doc_id"], []).append((r["begin"], r["end"], r["a_ids"], r["b_ids"]))
    for doc_id, text in TEXTS:
        if doc_id in (None, 5):
            continue
        first, second = map(spans, tokens(libraries, text))
        got = whole.get(doc_id, [])
        assert [i for g in got for i in g[2]] == [i for i, _, _ in first] and [i for g in got for i in g[3]] == [i for i, _, _ in second]
        assert [g[1] for g in got] == sorted({x[2] for x in first} & {x[2] for x in second}) and [g[0] for g in got] == [0, *[g[1] for g in got]][: len(got)]


def test_very_long_space(libraries):
    """The fast library panics on such a run; the file's own one takes over."""
    own = alignment.tokenizer(alignment.ByteLevel, alignment._read(alignment.BYTE_LEVEL))
    text = " " * 1_500_000 + "x"
    assert own.encode(text) == libraries[0].encode(text, add_special_tokens=False).ids
