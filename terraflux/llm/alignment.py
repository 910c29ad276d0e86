"""Token groups of two tokenizers over the same bytes, and how often their ids meet.

Both tokenizers cut the same bytes, so their tokens are two tilings. Every token points to its farthest-right
overlapping token, the first tokenizer's where two end alike. Successor doubling (``s = s[s]``) over all tokens of a
batch of texts converges to the terminal token of each component, which labels the groups. Overlapping pairs
are the pieces between neighbouring ends of either tiling, so there are as many as there are different ends.

Texts are encoded once; their pairs are written as sorted codes. Counts of pairs are one aggregate over the corpus. The
``FREQUENT`` most frequent pairs go to the tasks as a table of fixed size, all others are met by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraflux.llm.shared import materialise
from terraflux.llm.token_counts import PATTERN
from terraflux.llm.tokens import batches, texts_of

#: Files of public tokenizers; parameters of every function here.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs whose counts are sent to every task: 16 bytes each. Rarer pairs are joined.
FREQUENT = 1 << 20
#: Different pairs that a task counts before it hands them on.
HELD = 1 << 20

_made: dict[int, object] = {}


def _byte_alphabet() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable ones stand for themselves, others from U+0100 on in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE. The fast library encodes where the file's merges are in the order of their ids, the file's own library all else."""

    def __init__(self, definition: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(definition.decode())
        self.slow.encode_special_tokens = True
        alphabet = _byte_alphabet()
        vocabulary = self.slow.get_vocab(with_added_tokens=False)
        self.pieces = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.pieces[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.fast = self._fast(json.loads(definition)["model"]["merges"])

    def _fast(self, merges: list) -> object | None:
        import tiktoken

        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        ids = [self.slow.token_to_id(m) for m in made]
        if len(self.pieces) != 256 + len(ids) or ids != list(range(256, 256 + len(ids))) or any(len(p) != 1 for p in self.pieces[:256]):
            return None
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks={p: i for i, p in enumerate(self.pieces)}, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as failure:  # a run of white space too long for its pattern ends in a panic
                if type(failure).__name__ != "PanicException":
                    raise
        return self.slow.encode(text, add_special_tokens=False).ids

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [self.encode(" " + t) for t in texts]


class Pieces:
    """A sentence-piece model, which puts the space before a text itself."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1) if texts else []


def tokenizer(kind: type, definition: bytes):
    """The tokenizer, made once in each Python worker."""
    key = hash((kind.__name__, definition))
    if key not in _made:
        _made[key] = kind(definition)
    return _made[key]


def _tiling(ids: list[list[int]], pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter(chain.from_iterable(ids), np.int64)
    size = np.array([len(p) for p in pieces], np.int64)
    return flat, np.cumsum(size[flat])


class Aligned:
    """Groups and links of several texts. Tokens of a text that the tokenizers do not give back byte by byte are left out."""

    def __init__(self, texts: list[bytes | None], first: ByteLevel, second: Pieces):
        self.n = len(texts)
        own = [d for d, t in enumerate(texts) if t]
        read = [texts[d].decode("utf-8", "replace") for d in own]
        a, b = first.encode_all(read), second.encode_all(read)
        whole = lambda ids, t, known: b"".join(map(known.pieces.__getitem__, ids)) == b" " + t
        # with all bytes in its vocabulary, a byte-level BPE gives back what it got; that is the text if it was read without loss
        same = lambda i, d: read[i].encode() == texts[d] if first.fast is not None else whole(a[i], texts[d], first)
        kept = [i for i, d in enumerate(own) if same(i, d) and whole(b[i], texts[d], second)]
        doc = np.array([own[i] for i in kept], np.int64)
        a, b = [a[i] for i in kept], [b[i] for i in kept]
        count = lambda ids: np.bincount(doc, [len(x) for x in ids], self.n).astype(np.int64) if kept else np.zeros(self.n, np.int64)
        self.n_a, self.n_b = count(a), count(b)
        self.a, self.end_a = _tiling(a, first.pieces)
        self.b, self.end_b = _tiling(b, second.pieces)
        #: First token of each text in either tiling.
        self.from_a, self.from_b = (np.concatenate([[0], np.cumsum(n)]) for n in (self.n_a, self.n_b))
        self._group()

    def _group(self) -> None:
        """Pointer jumping. Nodes are the tokens of A, then those of B."""
        n, size = len(self.a), int(self.end_a[-1]) if len(self.a) else 0
        ends_a, ends_b = np.zeros(size + 1, np.int8), np.zeros(size + 1, np.int8)
        ends_a[self.end_a], ends_b[self.end_b] = 1, 1
        self.cut = np.flatnonzero(ends_a | ends_b)
        #: Token of A and of B at each byte.
        self.at_a, self.at_b = np.cumsum(ends_a, dtype=np.int32), np.cumsum(ends_b, dtype=np.int32)
        over_a, over_b = self.at_b[self.end_a - 1], self.at_a[self.end_b - 1]
        after_a = np.where(self.end_b[over_a] > self.end_a, n + over_a, np.arange(n))
        s = np.concatenate([after_a, over_b])
        while (s != (further := s[s])).any():
            s = further
        terminal = s[:n] == np.arange(n)
        ends, number = np.flatnonzero(terminal), np.cumsum(terminal) - 1
        self.group_a, self.group_b = number[s[:n]], number[s[n:]]
        #: Groups of each text are ``from_group[d]:from_group[d + 1]``.
        self.from_group = np.searchsorted(ends, self.from_a)
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=len(ends)), np.bincount(self.group_b, minlength=len(ends))
        self.group_end = self.end_a[ends]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of A, index of B) of all overlapping pairs in order, and where each text's begin."""
        i, j = self.at_a[self.cut - 1], self.at_b[self.cut - 1]
        return i, j, np.searchsorted(i, self.from_a)

    def written(self, texts_of_tokens: list[bytes]) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2`` of each text. ``texts_of_tokens``: id * 4 + separator -> text."""
        before_b, through_a = np.concatenate([[0], np.cumsum(self.size_b)[:-1]]), np.cumsum(self.size_a)
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        last_a = np.concatenate([self.group_a[1:] != self.group_a[:-1], [True]])[: len(self.a)]
        last_b = np.concatenate([self.group_b[1:] != self.group_b[:-1], [True]])[: len(self.b)]
        code[np.arange(len(self.a)) + before_b[self.group_a]] = self.a * 4 + np.where(last_a, 1, 0)
        at_b = np.arange(len(self.b)) + through_a[self.group_b]
        code[at_b] = self.b * 4 + np.where(last_b, 2, 0)
        begins = self.from_a + self.from_b
        final = begins[1:][np.diff(begins) > 0] - 1
        code[final] += 1  # the last token of B in a text: nothing follows
        steps, out = begins.tolist(), []
        for p, q in zip(steps, steps[1:], strict=False):
            out.append(hashlib.sha256(b"".join(map(texts_of_tokens.__getitem__, code[p:q].tolist()))).hexdigest() if q > p else "")
        return out


def _separated(first: ByteLevel, second: Pieces) -> list[bytes]:
    return [b"%d%s" % (i, s) for i in range(max(len(first.pieces), len(second.pieces))) for s in (b",", b"|", b";", b"")]


def _definitions(docs: DataFrame, a_path: str, b_path: str):
    sent = []
    for path in (a_path, b_path):
        with open(path, "rb") as file:
            sent.append(docs.sparkSession.sparkContext.broadcast(file.read()))
    return lambda: (tokenizer(ByteLevel, sent[0].value), tokenizer(Pieces, sent[1].value))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))


def token_groups(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> DataFrame:
    """(doc_id, position, begin, end, a_ids, b_ids): the groups of every text in order, with byte offsets in space + text.

    Texts that are null, empty or not given back by a tokenizer have no rows.
    """
    known = _definitions(docs, a_path, b_path)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for part in batches(texts):
                own = Aligned(texts[part], *known())
                groups = np.diff(own.from_group)
                doc = np.repeat(np.arange(own.n), groups)
                nth = np.arange(len(doc)) - np.repeat(own.from_group[:-1], groups)
                end = own.group_end
                base = np.concatenate([[0], end])[own.from_group[:-1]]
                begin = np.concatenate([[0], end[:-1]])[: len(end)]
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(x, pa.int32())) for n, x in ((own.size_a, own.a), (own.size_b, own.b))]
                columns = [ids.slice(part.start, own.n).take(pa.array(doc)), pa.array(nth, pa.int32()), pa.array(begin - base[doc], pa.int32()), pa.array(end - base[doc], pa.int32()), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "position", "begin", "end", "a_ids", "b_ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, position int, begin int, end int, a_ids array<int>, b_ids array<int>")


_ALIGNED = "doc_id long, n_a int, n_b int, n_groups int, n_links int, groups_sha256 string, links binary"


def _align(known: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = known()
        texts_of_tokens = _separated(a, b)
        for batch in found:
            texts, ids = texts_of(batch), batch.column("doc_id")
            for part in batches(texts):
                own = Aligned(texts[part], a, b)
                i, j, begins = own.links()
                code, steps = own.a[i] * len(b.pieces) + own.b[j], begins.tolist()
                kind = "<u4" if len(a.pieces) * len(b.pieces) < 2**32 else "<u8"
                links = [np.diff(np.sort(code[p:q]), prepend=0).astype(kind).tobytes() for p, q in zip(steps, steps[1:], strict=False)]
                counts = [own.n_a, own.n_b, np.diff(own.from_group), np.diff(begins)]
                columns = [ids.slice(part.start, own.n), *[pa.array(c, pa.int32()) for c in counts], pa.array(own.written(texts_of_tokens)), pa.array(links, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    return run


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Pair codes of the links of a batch, and the row of each."""
    size = batch.column("n_links").to_numpy()
    kinds = {4: "<u4", 8: "<u8"}
    own = [np.cumsum(np.frombuffer(x, kinds[len(x) // n]), dtype=np.int64) for x, n in zip(batch.column("links").to_pylist(), size.tolist(), strict=True) if n]
    return np.concatenate([*own, np.zeros(0, np.int64)]), np.repeat(np.arange(len(size)), size)


def _count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair occurs in a task; what is held is bounded."""

    def out(code: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    code, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in found:
        for at in range(0, batch.num_rows, 1024):
            more, times = np.unique(_codes(batch.slice(at, 1024))[0], return_counts=True)
            every, place = np.unique(np.concatenate([code, more]), return_inverse=True)
            n = np.bincount(place, np.concatenate([n, times]), len(every)).astype(np.int64)
            code = every
            if len(code) > HELD:
                yield out(code, n)
                code, n = code[:0], n[:0]
    if len(code):
        yield out(code, n)


def align(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    Space + text is cut by a byte-level BPE (A) and by a sentence-piece model (B). n_groups: stretches between byte offsets where
    tokens of both end; n_links: overlapping pairs of tokens. The count of a pair of ids is how many links of all ``docs`` have it;
    n_best: links whose pair has the highest count of its B id, ties included; count_sum: sum of the counts over the links.
    Texts that are null, empty, or not given back byte by byte by a tokenizer have zeros and the hash ''. Rows with a null or a repeated
    doc_id each come back and count; other columns are ignored; an empty table gives no rows.

    ``frequent``: pairs whose counts go to the tasks; it moves work, not results.
    """
    known = _definitions(docs, a_path, b_path)
    width = len(tokenizer(Pieces, _read(b_path)).pieces)
    aligned = _texts(docs).mapInArrow(_align(known), _ALIGNED).withColumn("row", F.monotonically_increasing_id())
    aligned = materialise(aligned, "token-pairs", compression="zstd")
    counts = aligned.select("n_links", "links").mapInArrow(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = materialise(counts.withColumn("b", (F.col("code") % width).cast("int")), "pair-counts")
    most = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))  # a row for each id of B
    counts = counts.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    table = counts.orderBy(F.desc("n"), "code").limit(frequent).toArrow().combine_chunks()
    code = table.column("code").to_numpy()
    by = np.argsort(code)
    sent = docs.sparkSession.sparkContext.broadcast((code[by], table.column("n").to_numpy()[by], table.column("best").to_numpy()[by]))

    def meet(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = sent.value
        for whole in found:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                own, row = _codes(batch)
                place = np.minimum(np.searchsorted(code, own), max(len(code) - 1, 0))
                hit = code[place] == own if len(code) else np.zeros(len(own), bool)
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, row[hit], n[place[hit]])
                n_best = np.bincount(row[hit], best[place[hit]], batch.num_rows).astype(np.int64)
                left = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[~hit], np.arange(batch.num_rows + 1)), pa.int32()), pa.array(own[~hit], pa.int64()))
                keep = [batch.column(k) for k in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(n_best), pa.array(total), left], ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "left"])

    met = aligned.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
    met = met.mapInArrow(meet, "row long, doc_id long, n_a int, n_b int, n_groups int, n_links int, groups_sha256 string, n_best long, count_sum long, left array<long>")
    met = materialise(met, "met-pairs")
    rare = met.select("row", F.explode("left").alias("code")).groupBy("row", "code").agg(F.count("*").alias("times")).join(counts, "code")
    rare = rare.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return met.join(rare, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", F.col("more_best")), plus("count_sum", F.col("more")), "groups_sha256")


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
