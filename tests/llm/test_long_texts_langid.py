"""op4 on texts of megabytes with many languages: the same labels as in one piece, in bounded memory."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest

from terraflux.llm import langid


def model(k, seed=0):
    rng = np.random.default_rng(seed)
    counts = lambda: rng.integers(0, 50, (k, langid.SLOTS)) ** 2
    return langid.Model([f"l{i:03}" for i in range(k)], counts(), counts(), np.ones((k, len(langid.NAMES))))


def text(n, seed=1):
    rng = np.random.default_rng(seed)
    words = [b"".join(bytes([97 + c]) for c in rng.integers(0, 26, rng.integers(1, 12))) for _ in range(500)] + ["жук".encode(), b"12", b"--", "日本".encode()]
    gaps = [b" ", b" ", b"\n", b"\t ", b"  "]
    return b"".join(words[i] + gaps[g] for i, g in zip(rng.integers(0, len(words), n), rng.integers(0, 5, n), strict=True))


@pytest.mark.parametrize("k", [1, 3, 9])
def test_pieces_change_nothing(k, monkeypatch):
    own = model(k)
    texts = [text(40, 2), None, text(6000), b"", text(9, 3), text(5000, 4), b"x" * 70_000]
    whole = own.spans(texts), own.predict(texts)
    monkeypatch.setattr(langid, "LONG", 0)  # every text by pieces
    labels = [own._long(t, 500) if t else None for t in texts]
    for t, found, spans in zip(texts, labels, whole[0], strict=True):
        if t:
            assert [(s["language"], s["letters"]) for s in spans] == [(own.languages[x[0]], int(n)) for x, n in runs(found[2], found[1])]
    assert own.spans(texts) == whole[0] and own.predict(texts)[0] == whole[1][0] and (own.predict(texts)[1] == whole[1][1]).all()


def runs(label, letters):
    cuts = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(label)]
    return [(label[a:b], letters[a:b].sum()) for a, b in zip(cuts, cuts[1:], strict=False)]


def test_pieces_end_between_words():
    t = text(3000)
    parts = list(langid.pieces(t, 100))
    assert b"".join(parts) == t and [w for p in parts for w in p.split()] == t.split() and len(parts) > 100
    assert list(langid.pieces(b"y" * 1000, 10)) == [b"y" * 1000] and list(langid.pieces(b"", 10)) == []


def test_a_word_of_any_length(monkeypatch):
    own = model(5)
    texts = [b"ab " + b"qwe" * 20_000 + b" cd"]
    whole = own.word_scores(langid.Words(texts))
    monkeypatch.setattr(langid, "SCORES", 5 << 12)
    assert np.allclose(own.word_scores(langid.Words(texts)), whole, rtol=1e-4)


MEASURE = """
import resource, sys
sys.path[:0] = [{root!r}, {here!r}]
import test_long_texts_langid as t
own, long = t.model(100), t.text(1_400_000)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
labels = own.predict([b"a b", long])
print(len(long), before >> 10, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10, len(labels[0]))
"""


def test_memory_of_a_long_text():
    """10 MB with 100 languages take less than 300 MB beside the model; all scores at once would be 560 MB, and as much again for the steps."""
    here = Path(__file__).resolve().parent
    out = subprocess.run([sys.executable, "-c", MEASURE.format(root=str(here.parents[1]), here=str(here))], capture_output=True, text=True, timeout=600, check=True).stdout.split()
    size, before, most, n = map(int, out)
    assert size > 10_000_000 and n == 2 and most - before < 300, (size, before, most)
