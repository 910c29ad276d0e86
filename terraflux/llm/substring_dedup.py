"""Near-duplicate passages by compact windows.

The tokens of a text are its 5-word shingles. For each of ``HASHES`` min-hash functions the nodes of
the Cartesian tree over a text's hashes whose subtree spans at least ``PASSAGE`` shingles are its compact
windows: every passage of that length within the window (l, r) around position c has the hash at c
as its min-hash. Windows of different texts with one hash value meet. Windows of one content (all shingles
that a passage around c can have) are linked to that of the smallest doc_id, which stands for them, first
within a batch of texts, before any shuffle, then among all; the others of a group of at most
``SMALL`` are linked pair by pair. The windows of a larger group are compared all with all, block by block, in the shingles
around them as they stand. Of the similar ones each is linked to those that reach furthest to either side of its
position, so that all words come out that repeat an earlier text, and to one of each class of windows that it joins, so
that the links have the classes of all pairs. A pair is passed over only where that cannot change, so in a group of copies of
one passage most windows are settled by one partner. So but for links of one content, which need no look at the texts, no
link grows with the square of a group.
The interval join then keeps stretches of a pair of texts, at one alignment, where
windows of at least ``HITS`` functions overlap. These candidates are verified: shingle by shingle,
a passage stays where at least ``MATCH`` of its shingles occur at the partner's aligned place. Stretches of links of one
content only are equal as they stand, by 64-bit hashes of all their shingles, and need no verification.

Verification moves 64-shingle chunks, not texts: chunks of the partner are requested once however
many texts share them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terraflux.llm.shared import discard, materialise
from terraflux.llm.tokens import U64, Tokens, batches, folded, mix, texts_of

SHINGLE = 5
#: A passage has 50 words or more.
WORDS = 50
PASSAGE = WORDS - SHINGLE + 1
HASHES = 4
HITS = 2
#: Share of shingles in common that makes sets of one size 0.8 similar: 0.8 = m / (2 - m).
MATCH = 8 / 9
CHUNK = 64
#: Alignments of a pair this close are one; words put in or left out move it.
SHIFT = 16

_FACTORS = np.random.default_rng(1).integers(1, 2**63, HASHES, dtype=np.uint64) | U64(1)
_PLACE = U64((1 << 24) - 1)
#: Places whose windows are found at once; they stand in the low bits of a hash.
_LONG = 1 << 23
_REACH = PASSAGE - 1
_HALF = PASSAGE // 2
_SIDE = U64(0x8CB92BA72F3D8DD7)
#: Bits of a half passage's min-hash that make its sign.
_SIGN = 10
#: Windows of a group that are linked pair by pair; those of larger groups are compared in their shingles.
SMALL = 16
#: Windows of a hot group that are compared with as many others in one task.
BLOCK = 8192
#: Rows of an unfinished group that a task holds.
HELD = 1 << 14
#: Low bits of a key: the hash function.
_F = np.int64(HASHES - 1)
_BASE = 0xD6E8FEB86659FD93
#: Bit of a link whose windows are not of one content, beside the bits of the hash functions.
_SIMILAR = np.int64(1 << HASHES)
#: Bits of the table that tells which texts are asked for, by a hash of their doc_id: what a task holds of it is bounded.
_ASKED = 1 << 26
#: Words of 64 bits of that table that are one row where it is sent to the tasks.
_PAGE = 512


def compact_windows(hashes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, l, r) of the windows of ``least`` positions or more; ``hashes`` has 0 between and around texts.

    The minima of all runs of ``least`` positions are the nodes in question, and the nearest smaller
    neighbours of such a node are such nodes, too, so the Cartesian tree is built over them alone.
    Of equal hashes the leftmost counts as the smallest.
    """
    n = len(hashes)
    keyed = hashes & ~_PLACE | np.arange(n, dtype=np.uint64)
    low, width = keyed, 1
    while width < least <= n:
        step = min(width, least - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    low = low[low > _PLACE] if width == least else low[:0]
    if not len(low):
        none = np.zeros(0, np.int64)
        return none, none, none
    keep = np.concatenate([[True], low[1:] != low[:-1]])
    nodes = low[keep]
    gaps = np.flatnonzero(hashes == 0)
    places = (nodes & _PLACE).astype(np.int64)
    after = np.searchsorted(gaps, places)
    left, right = gaps[after - 1] + 1, gaps[after] - 1
    stack: list[tuple[int, int, int]] = []  # (key, place, index), keys rising
    out_left, out_right = left.tolist(), right.tolist()
    begin = left.tolist()
    for i, (key, place, edge) in enumerate(zip(nodes.tolist(), places.tolist(), begin, strict=True)):
        while stack and (stack[-1][1] < edge or stack[-1][0] > key):
            _, old, k = stack.pop()
            if old >= edge:
                out_right[k] = place - 1
        if stack:
            out_left[i] = stack[-1][1] + 1
        stack.append((key, place, i))
    return places, np.array(out_left), np.array(out_right)


def _stretches(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``compact_windows`` of any number of places: long ones in stretches that overlap by a passage and its reach."""
    if len(hashes) <= _LONG:
        return compact_windows(hashes, PASSAGE)
    parts = []
    for begin in range(0, len(hashes), _LONG - 4 * PASSAGE):
        own = np.concatenate([np.zeros(1, U64), hashes[begin : begin + _LONG], np.zeros(1, U64)])
        parts.append([x + begin - 1 for x in compact_windows(own, PASSAGE)])
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def half_minima(hashes: np.ndarray) -> np.ndarray:
    """Min-hash of the ``_HALF`` places from each place on; 0 where they go beyond the text."""
    low, width = hashes * _SIDE, 1
    while width < _HALF <= len(hashes):
        step = min(width, _HALF - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    out = np.zeros(len(hashes), U64)
    if width == _HALF:
        out[: len(low)] = low
    return out


def half_signs(hashes: np.ndarray) -> np.ndarray:
    """A few bits of ``half_minima``."""
    low = half_minima(hashes)
    return (mix(low) >> U64(64 - _SIGN)).astype(np.int64) * (low > 0)


class Runs:
    """Full-width hashes of runs of places, from sums of powers."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes) + 1
        power, self.inverse = (np.cumprod(np.concatenate([np.ones(1, U64), np.full(n - 1, x, U64)])) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(hashes * power[:-1], dtype=U64)])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return mix((self.sums[last + 1] - self.sums[first]) * self.inverse[first] ^ (last - first).astype(U64))


def _pack(place: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Position and reach to either side; what reaches further than a passage does not matter."""
    return place << 12 | np.minimum(place - left, _REACH) << 6 | np.minimum(right - place, _REACH)


def _place(pack: np.ndarray) -> np.ndarray:
    return pack >> 12


def _windows(ids: np.ndarray, texts: list[bytes | None]) -> list[np.ndarray]:
    """(key, doc, packed window, hash of its content) of some texts; the lowest bits of a key tell the hash function."""
    found = []
    for part in batches(texts):
        hashes, bounds = Tokens(folded(texts[part])).shingles(SHINGLE)
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        spaced = np.zeros(len(hashes) + len(bounds), U64)
        where = np.arange(len(hashes)) + doc + 1
        spaced[where] = hashes | U64(1 << 24)
        runs = Runs(spaced)
        for f, factor in enumerate(_FACTORS):
            place, left, right = _stretches(spaced * factor | (spaced > 0) * U64(1 << 24))
            own = np.searchsorted(bounds + np.arange(len(bounds)), place, "right") - 1
            first = bounds[own] + own + 1
            key = spaced[place] & ~U64(2 * HASHES - 1) | U64(f)
            begin = np.maximum(left, place - _REACH)
            content = mix(runs(begin, np.minimum(right, place + _REACH)) ^ (place - begin).astype(U64))
            found.append((key.view(np.int64), ids[part][own], _pack(place - first, left - first, right - first), content.view(np.int64)))
    key, doc, pack, content = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
    return [key, doc, pack, content]


_ROWS = ["key", "doc", "pack", "content", "shift"]
_ROW_TYPES = "key long, doc long, pack long, content long, shift long"


def _folded(key, doc, pack, content) -> pa.RecordBatch:
    """The windows of one content in a batch as rows of its smallest doc_id alone; those of others become links to it.

    A link is a row with a shift, its content is the partner, and its key is spread: copies of one
    passage make no hot key.
    """
    order = np.lexsort((pack, doc, content, key))
    key, doc, pack, content = (x[order] for x in (key, doc, pack, content))
    at, new = np.arange(len(key)), np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    first = np.maximum.accumulate(np.where(new, at, 0))
    link = doc != doc[first]
    spread = mix((pack ^ doc << 20).view(U64)).view(np.int64) & ~_F | key & _F
    columns = [np.where(link, spread, key), doc, pack, np.where(link, doc[first], content)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(_place(pack) - _place(pack[first]), mask=~link)], _ROWS)


def _emit(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        yield _folded(*_windows(batch.column("doc_id").to_numpy(), texts_of(batch)))


_MET = ["a", "b", "shift", "lo", "hi", "f", "key", "content"]
_MET_TYPES = ", ".join(f"{name} long" for name in _MET)


def _met(key, doc, pack, content, i: np.ndarray, j: np.ndarray, exact: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    """Links of rows i with rows j, and the rows ``hot`` (b null, shift the packed window)."""
    i, j = np.where(doc[i] > doc[j], i, j), np.where(doc[i] > doc[j], j, i)
    lo = np.minimum(pack[i] >> 6 & 63, pack[j] >> 6 & 63)
    hi = np.minimum(pack[i] & 63, pack[j] & 63)
    keep = (lo + hi + 1 >= PASSAGE) & (doc[i] != doc[j])
    i, j, lo, hi, exact = i[keep], j[keep], lo[keep], hi[keep], exact[keep]
    place, zero = _place(pack[i]), np.zeros(len(hot), np.int64)
    bits = np.int64(1) << (key[i] & _F) | np.where(exact, 0, _SIMILAR)
    columns = [(doc[i], doc[hot]), (doc[j], zero), (place - _place(pack[j]), pack[hot]), (place - lo, zero), (place + hi, zero), (bits, zero), (0 * i, key[hot]), (0 * i, content[hot])]
    link = np.arange(len(i) + len(hot)) < len(i)
    nulls = {"b": ~link, "key": link, "content": link}
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), mask=nulls.get(k)) for k, c in zip(_MET, columns, strict=True)], _MET)


def _known(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The links that a stream has from the map side."""
    key, a, pack, b, shift = (batch.column(k).to_numpy() for k in _ROWS)
    none, place = pa.nulls(len(a), pa.int64()), _place(pack)
    columns = [a, b, shift, place - (pack >> 6 & 63), place + (pack & 63), np.int64(1) << (key & _F)]
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), none, none], _MET)


def _meet(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links among rows of one key, and the rows of keys that are hot. The stream is sorted by (key, content, doc) or,
    where keys are those of whole passages, by (key, doc)."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, broken = [np.zeros(0, np.int64)] * 4, None
        for batch in chain(found, [None]):
            if batch is not None:
                window = batch.column("shift").is_null()
                yield _known(batch.filter(pc.invert(window)))
                batch = batch.filter(window)
            rows = held if batch is None else [np.concatenate([h, batch.column(k).to_numpy()]) for h, k in zip(held, _ROWS[:4], strict=True)]
            n = len(rows[0])
            if not n:
                continue
            begin = int(np.searchsorted(rows[0], rows[0][-1]))
            ends = batch is None or n - begin <= HELD
            cut = begin if ends and batch is not None else n
            parts = [broken] if broken is not None else []
            broken = broken if ends else int(rows[0][-1])
            key, doc, pack, content = (x[:cut] for x in rows)
            # of an unfinished group of one passage stay its first row and the last
            held = [x[cut:] for x in rows] if ends else [x[[begin, n - 1][: 2 * whole]] for x in rows]
            if cut:
                yield _linked(key, doc, pack, content, whole, [*parts, *([] if ends else [broken])])

    return run


def _linked(key, doc, pack, content, whole: bool, parts: list[int]) -> pa.RecordBatch:
    """Links and hot rows of some keys; of the keys ``parts`` there are more rows elsewhere."""
    at = np.arange(len(key))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    if whole:
        # the row before this text's first one, which is of the text before: no text is the partner of a whole group
        own = new | np.concatenate([[True], doc[1:] != doc[:-1]])
        i, j = at, np.maximum.accumulate(np.where(own, at, 0)) - 1
        linked = (j >= 0) & (key[j] == key)
        return _met(key, doc, pack, content, i[linked], j[linked], np.zeros(np.sum(linked), bool), at[:0])
    new[1:] |= content[1:] != content[:-1]
    first = np.maximum.accumulate(np.where(new, at, 0))
    stands = doc == doc[first]
    i, j, rest = [at[~stands]], [first[~stands]], at[stands]
    own = key[rest]
    begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    size = np.diff(np.concatenate([begin, [len(rest)]]))
    part = np.isin(own[begin], np.array(parts, np.int64))
    alone = (np.minimum.reduceat(doc[rest], begin) == np.maximum.reduceat(doc[rest], begin)) & ~part
    hot = np.repeat(((size > SMALL) | part) & ~alone, size)
    few = rest[~hot & ~np.repeat(alone, size)]
    for step in range(1, SMALL):
        same = key[few[step:]] == key[few[:-step]]
        i.append(few[step:][same])
        j.append(few[:-step][same])
    i, j = np.concatenate(i), np.concatenate(j)
    return _met(key, doc, pack, content, i, j, np.arange(len(i)) < np.sum(~stands), rest[hot])


#: Shingles to either side of a window's position that it is compared in: its reach, and how far words put in or left out move a partner's.
_AROUND = _REACH + SHIFT
_NEAR = "key long, doc long, pack long, hashes binary"


def _surroundings(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle hashes around the windows that a text's ``wanted`` names, 0 beyond the text."""
    for batch in found:
        ids, texts, wanted = batch.column("doc_id").to_numpy(), texts_of(batch), batch.column("wanted")
        first = np.concatenate([[0], np.cumsum(wanted.value_lengths().to_numpy())])
        key, pack = (wanted.flatten().field(i).to_numpy() for i in range(2))
        for part in batches(texts):
            hashes, bounds = Tokens(folded(texts[part])).shingles(SHINGLE)
            hashes = np.maximum(hashes >> U64(32), U64(1)).astype(np.uint32)
            own = slice(first[part.start], first[part.stop])
            d = np.repeat(np.arange(part.stop - part.start), np.diff(first[part.start : part.stop + 1]))
            inside = _place(pack[own]) + (pack[own] & 63) < np.diff(bounds)[d]  # else of another row of this doc_id
            k, p, d = key[own][inside], pack[own][inside], d[inside]
            for begin in range(0, len(k), BLOCK):
                some = slice(begin, begin + BLOCK)
                at = (bounds[d[some]] + _place(p[some]))[:, None] + np.arange(-_AROUND, _AROUND + 1)
                there = (at >= bounds[d[some]][:, None]) & (at < bounds[d[some] + 1][:, None])
                around = np.where(there, hashes[np.where(there, at, 0)], np.uint32(0))
                yield pa.RecordBatch.from_arrays([pa.array(k[some]), pa.array(ids[part][d[some]]), pa.array(p[some]), pa.array([x.tobytes() for x in around], pa.binary())], ["key", "doc", "pack", "hashes"])


_BIG = np.int16(10_000)


def reaches(hits: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is there one, first, last) of the stretches of ``PASSAGE`` places or more, of which at least ``MATCH`` are hits, in each column of ``hits``
    between ``lo`` places before its middle and ``hi`` behind; first and last are the furthest of all such stretches."""
    sums = np.zeros((hits.shape[0] + 1, hits.shape[1]), np.int16)
    np.cumsum(hits * np.int16(9) - np.int16(8), axis=0, out=sums[1:])  # 0 or more between two places: MATCH, which is 8 / 9, or more
    at = np.arange(len(sums))[:, None]
    begin = np.where(at >= _REACH - lo, sums, _BIG)[:-PASSAGE]
    end = np.where(at <= _REACH + hi + 1, sums, -_BIG)[PASSAGE:]
    first = np.maximum.accumulate(end[::-1], axis=0)[::-1] >= begin
    last = np.minimum.accumulate(begin, axis=0) <= end
    return first.any(0), first.argmax(0), len(last) - 1 - last[::-1].argmax(0) + PASSAGE - 1


#: Shingles to either side of a window's position that are looked for in others.
_WIDE = 2 * _REACH + 1
#: Pairs of windows that are guessed in one go, and entries of a table of who has which shingle.
_PAIRS, _TABLE = 128, 1 << 24
#: Windows that one is compared with first.
_FEW = 32
#: Partners that are guessed for a window, all windows at once, before the others are looked for.
_GUESSES = 4


class _Cell:
    """The windows of one pair of blocks of a group, sorted by doc and place: classes, and the partners that reach furthest to either side of each."""

    def __init__(self, doc: np.ndarray, pack: np.ndarray, around: np.ndarray):
        self.doc, self.lo, self.hi = doc, (pack >> 6 & 63).astype(np.int8), (pack & 63).astype(np.int8)
        values, at = np.unique(around, return_inverse=True)
        self.values, self.zero = len(values), 0 if values[0] == 0 else -1
        self.at = at.reshape(around.shape).astype(np.int32)
        self.own = np.ascontiguousarray(self.at[:, SHIFT : SHIFT + _WIDE])
        self.joined = np.arange(len(doc))
        self.first, self.last = np.full(len(doc), _WIDE), np.full(len(doc), -1)
        self.left, self.right = self.last.copy(), self.last.copy()
        self.met: list[tuple[np.ndarray, np.ndarray]] = []

    def looked_at(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """(a, b, first, last) of the pairs that are similar: their shingles as they stand, each at a place at most ``SHIFT`` away."""
        out = []
        for part in range(0, len(a), _PAIRS):
            i, j = a[part : part + _PAIRS], b[part : part + _PAIRS]
            mine, theirs = self.own[i], self.at[j]
            hits = mine == theirs[:, :_WIDE]
            for d in range(1, 2 * SHIFT + 1):
                hits |= mine == theirs[:, d : d + _WIDE]
            hits &= mine != self.zero
            there, x, y = reaches(hits.T, np.minimum(self.lo[i], self.lo[j]), np.minimum(self.hi[i], self.hi[j]))
            out.append((i[there], j[there], x[there], y[there]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (a, b, a, b)

    def guess(self, a: np.ndarray, known: np.ndarray, holder: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Look at windows that hold a shingle of a's at the ends of what it can reach (x to y), then anywhere in it, as long as it is not reached."""
        place, random, root = np.arange(_WIDE), np.random.default_rng(1), self.joined.tolist()

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for turn in range(_GUESSES):
            open_ = (self.first[a] > x) | (self.last[a] < y)
            a, known, x, y = a[open_], known[open_], x[open_], y[open_]
            if not len(a):
                break
            weight = (place, _WIDE - place)[turn % 2] if turn < 2 else random.random((len(a), _WIDE))
            at = np.where(known, weight + 1.0, 0).argmax(1)
            i, j, low, high = self.looked_at(a, holder[self.own[a, at]])
            better = low < self.first[i]
            self.first[i[better]], self.left[i[better]] = low[better], j[better]
            better = high > self.last[i]
            self.last[i[better]], self.right[i[better]] = high[better], j[better]
            kept = []
            for k, (p, q) in enumerate(zip(i.tolist(), j.tolist(), strict=True)):
                p, q = find(p), find(q)
                if p != q:
                    root[max(p, q)] = min(p, q)
                    kept.append(k)
            self.met.append((i[kept], j[kept]))
        self.joined = np.array([find(i) for i in range(len(root))])

    def places(self, theirs: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
        """(shingle, number of the window in ``theirs``, first, last, piece): where the wanted shingles are in windows and ``SHIFT`` places around."""
        row, place = np.nonzero(wanted[self.at[theirs]])
        value = self.at[theirs[row], place]
        order = np.argsort(value, kind="stable")
        value, row, place = value[order], row[order], place[order] - _AROUND
        other, new = np.ones(len(row), bool), np.ones(len(row), bool)
        other[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
        new[1:] = other[1:] | (np.diff(place) > 2 * SHIFT + 1)
        begin, count = np.flatnonzero(new), np.cumsum(new)
        last = place[np.append(begin[1:], len(row)) - 1]
        piece = count[begin] - count[np.maximum.accumulate(np.where(other, np.arange(len(row)), 0))[begin]]
        return value[begin], row[begin], place[begin] - SHIFT, last + SHIFT, piece

    def scan(self, a: np.ndarray, known: np.ndarray, theirs: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
        """Look at all windows of ``theirs`` that are earlier than those of a and have enough of their shingles anywhere, but for those of
        the same class where nothing further can be reached."""
        if not len(a):
            return
        wanted = np.zeros(self.values, bool)
        wanted[self.own[a][known]] = True
        value, row, low, high, piece = self.places(theirs, wanted)
        number, middle = np.full(self.values, -1, np.int32), np.arange(-_REACH, _REACH + 1, dtype=np.int8)[:, None]
        step = len(a) if np.sum(wanted) * len(theirs) <= _TABLE else max(1, _TABLE // (_WIDE * len(theirs)))
        for begin in range(0, len(a), step):
            part = slice(begin, begin + step)
            own = self.own[a[part]]
            values = np.unique(own[known[part]])
            number[values] = np.arange(len(values))
            at = np.flatnonzero(number[value] >= 0)
            shape = len(values) + 1, len(theirs)
            has, tables = np.zeros(shape, np.uint8), []
            has[number[value[at]], row[at]] = 1
            for n in range(int(piece[at].max(initial=-1)) + 1):
                these = at[piece[at] == n]
                tables.append((np.full(shape, 127, np.int8), np.full(shape, -128, np.int8)))
                for table, edge in zip(tables[-1], (low, high), strict=True):
                    table[number[value[these]], row[these]] = edge[these]
            ids = np.where(known[part], number[own], len(values))
            number[values] = -1
            for k, i in enumerate(a[part].tolist()):
                shared = np.add.reduce(has[ids[k], : np.searchsorted(theirs, i)], axis=0, dtype=np.uint8)
                near = np.flatnonzero(shared >= MATCH * PASSAGE)
                j = theirs[near]
                near = near[(self.doc[j] != self.doc[i]) & (np.minimum(self.lo[i], self.lo[j]) + np.minimum(self.hi[i], self.hi[j]) >= _REACH)]
                near, some = near[np.argsort(shared[near], kind="stable")[::-1]], _FEW
                while len(near):  # a few that share most, then more at once
                    if self.first[i] <= x[begin + k] and self.last[i] >= y[begin + k]:
                        near = near[self.joined[theirs[near]] != self.joined[i]]
                    j, hits, pick = theirs[near[:some]], np.zeros((_WIDE, len(near[:some])), bool), np.ix_(ids[k], near[:some])
                    for first, last in tables:
                        hits |= (first[pick] <= middle) & (middle <= last[pick])
                    hits &= (-self.lo[j] <= middle) & (middle <= self.hi[j])
                    enough = np.add.reduce(hits, axis=0, dtype=np.uint8) >= MATCH * PASSAGE
                    if enough.any():
                        self.take(i, j[enough], hits[:, enough])
                    near, some = near[some:], 4 * some

    def take(self, i: int, j: np.ndarray, hits: np.ndarray) -> None:
        """The links of window i to those of j that are similar."""
        there, x, y = reaches(hits, np.minimum(self.lo[i], self.lo[j]), np.minimum(self.hi[i], self.hi[j]))
        j, x, y = j[there], x[there], y[there]
        if not len(j):
            return
        if x.min() < self.first[i]:
            self.first[i], self.left[i] = x.min(), j[x.argmin()]
        if y.max() > self.last[i]:
            self.last[i], self.right[i] = y.max(), j[y.argmax()]
        classes, at = np.unique(self.joined[j], return_index=True)
        other = classes != self.joined[i]
        if other.any():
            self.met.append((np.full(np.sum(other), i), j[at[other]]))
            self.joined[np.isin(self.joined, classes)] = self.joined[i]

    def compare(self, mine: np.ndarray, theirs: np.ndarray) -> None:
        """All of ``mine`` with all earlier ones of ``theirs``."""
        holder = np.full(self.values, len(self.doc))  # the first of theirs that has a shingle
        holder[self.at[theirs[::-1]].ravel()] = np.repeat(theirs[::-1], self.at.shape[1])
        own = self.own[mine]
        known = (np.append(self.doc, np.iinfo(np.int64).max)[holder[own]] < self.doc[mine][:, None]) & (own != self.zero)
        there, x, y = reaches(known.T, self.lo[mine], self.hi[mine])  # as if one window had all that any has: none reaches further
        mine, known, x, y = mine[there], known[there], x[there], y[there]
        place = np.arange(_WIDE)
        known &= (place >= x[:, None]) & (place <= y[:, None])
        self.guess(mine, known, holder, x, y)
        self.scan(mine, known, theirs, x, y)


def _compared(table: pa.Table) -> pa.Table:
    """Links among the windows of one pair of blocks of a group.

    A window is linked to the earlier texts that reach furthest to either side of all that are similar, and to one of each class of windows that
    its links join. A pair is not looked at only where that cannot change: where its windows share too few shingles, or are in one class already and the later reaches
    as far as all shingles of earlier ones together would let it.
    """
    doc, pack, block, i, j = (table.column(k).to_numpy() for k in ("doc", "pack", "block", "i", "j"))
    around = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint32).reshape(len(doc), -1)
    order = np.lexsort((pack, doc))
    doc, pack, block = doc[order], pack[order], block[order]
    cell = _Cell(doc, pack, around[order])
    sides = [np.flatnonzero(block == x) for x in {int(i[0]), int(j[0])}]
    for mine, theirs in zip(sides, sides[::-1], strict=True):
        if len(mine) and len(theirs):
            cell.compare(mine, theirs)
    for partner in (cell.left, cell.right):
        a = np.flatnonzero(partner >= 0)
        cell.met.append((a, partner[a]))
    a, b = np.unique(np.concatenate([np.stack(x) for x in cell.met], axis=1), axis=1)
    low, high = np.minimum(cell.lo[a], cell.lo[b]), np.minimum(cell.hi[a], cell.hi[b])
    bits = np.full(len(a), (1 << HASHES) - 1, np.int64) | _SIMILAR  # looked at as they stand: one function is enough
    columns = [doc[a], doc[b], _place(pack[a]) - _place(pack[b]), _place(pack[a]) - low, _place(pack[a]) + high, bits]
    return pa.Table.from_arrays([pa.array(c.astype(np.int64)) for c in columns], _MET[:6])


def _all_pairs(docs: DataFrame, near: DataFrame) -> DataFrame:
    """Links of the windows ``near`` (key, doc_id, pack): those of one key are compared all with all, in pairs of blocks that are dealt to the tasks."""
    wanted = near.groupBy("doc_id").agg(F.collect_set(F.struct("key", "pack")).alias("wanted"))
    rows = _asked(docs, wanted, near).mapInArrow(_surroundings, _NEAR)
    sizes = near.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    dealt = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("doc", "pack"), "n"))
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j"))))
    dealt = dealt.withColumn("pair", pairs).select("key", "doc", "pack", "hashes", "block", "pair.i", "pair.j")
    return dealt.groupBy("key", "i", "j").applyInArrow(_compared, ", ".join(f"{name} long" for name in _MET[:6]))


def _asked(docs: DataFrame, wanted: DataFrame, by: DataFrame) -> DataFrame:
    """``docs`` with the requests ``wanted`` of their doc_id; ``by`` has these doc_ids, too.

    Most texts that nobody asks for are left out before their text is shuffled, by a bit table of fixed size; the join decides. It is sent as
    pages of the words that are not 0: at most ``_ASKED`` / 64 / ``_PAGE`` rows and 12 bytes a word, for the driver builds a hash table of it.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_ASKED))
    page, bit = F.floor(slot / (64 * _PAGE)).cast("int"), F.pmod(slot, F.lit(64)).cast("int")
    word = F.pmod(F.shiftright(slot, 6), F.lit(_PAGE)).cast("int")
    bits = by.select(page.alias("page"), word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit")).repartition("page")
    words = bits.groupBy("page", "word").agg(F.bit_or("bit").alias("bits"))
    table = words.groupBy("page").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))
    near = docs.join(F.broadcast(table), page == F.col("page")).filter(F.getbit(F.try_element_at("words", word), bit) == 1)
    return near.select(*docs.columns).join(wanted, "doc_id")


def candidates(docs: DataFrame) -> DataFrame:
    """(a, b, shift, lo, hi, exact): shingles lo..hi of text a that may repeat those of text b < a, ``shift`` places earlier; exact: do."""
    rows = docs.mapInArrow(_emit, _ROW_TYPES).repartition("key").sortWithinPartitions("key", "content", "doc", "pack")
    met = materialise(rows.mapInArrow(_meet(False), _MET_TYPES), "passage-links")
    near = met.filter("b is null").select("key", F.col("a").alias("doc_id"), F.col("shift").alias("pack"))
    links = met.filter("b is not null").select("a", "b", "shift", "lo", "hi", "f").unionAll(_all_pairs(docs, near))
    # one exchange by pair and alignment for all that follows
    links = links.withColumn("s", F.floor(F.col("shift") / SHIFT)).repartition("a", "b", "s")
    order = Window.partitionBy("a", "b", "s").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = links.withColumn("new", (F.col("lo") > F.coalesce(reach, F.lit(-1))).cast("int"))
    islands = islands.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    grouped = islands.groupBy("a", "b", "s", "island").agg(F.min("shift").alias("shift"), F.max("shift").alias("most"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.bit_or("f").alias("f"))
    exact = (F.col("f").bitwiseAND(int(_SIMILAR)) == 0) & (F.col("shift") == F.col("most"))
    enough = F.bit_count(F.col("f").bitwiseAND(int(_SIMILAR) - 1)) >= HITS
    pairs = materialise(grouped.withColumn("exact", exact).filter(F.col("exact") | enough).select("a", "b", "shift", "lo", "hi", "exact"), "passage-candidates")
    discard(met)
    return pairs


_CHUNKS = "b long, q long, a long, shift long, lo long, place long, hashes binary"


def _chunks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingle hashes that a text's requests name: stretches of its own, cut at the partner's chunks, and chunks that partners compare with."""
    names = [c.split()[0] for c in _CHUNKS.split(", ")]
    for batch in found:
        ids, texts, wanted = batch.column("doc_id").to_pylist(), texts_of(batch), batch.column("wanted").to_pylist()
        for part in batches(texts):
            hashes, bounds = Tokens(folded(texts[part])).shingles(SHINGLE)
            hashes = (hashes >> U64(32)).astype(np.uint32)
            rows: list[tuple] = []
            for d in range(part.start, part.stop):
                own = hashes[bounds[d - part.start] : bounds[d - part.start + 1]]
                for w in wanted[d]:
                    if w["b"] is None:
                        q = w["lo"]
                        rows.append((ids[d], q, None, None, None, None, own[max(0, CHUNK * q - SHIFT) : CHUNK * (q + 1) + SHIFT].tobytes()))
                        continue
                    lo, hi, shift = max(w["lo"], 0), min(w["hi"], len(own) - 1), w["shift"]
                    for q in range((lo - shift) // CHUNK, (hi - shift) // CHUNK + 1):
                        a, b = max(lo, CHUNK * q + shift), min(hi, CHUNK * (q + 1) + shift - 1)
                        rows.append((w["b"], q, ids[d], shift, w["lo"], a, own[a : b + 1].tobytes()))
            if rows:
                kinds = [pa.int64()] * 6 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _compare(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which shingles of each stretch occur in the partner's chunk, as bits of a long."""
    for batch in found:
        n = batch.num_rows
        sides = []
        for name in ("hashes", "partner"):
            values = batch.column(name).to_pylist()
            size = np.fromiter((len(v) // 4 for v in values), np.int64, n)
            row = np.repeat(np.arange(n), size)
            sides.append((row.astype(U64) << U64(32) | np.frombuffer(b"".join(values), np.uint32), row, size))
        (mine, row, size), (theirs, _, _) = sides
        bit = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size) if n else row
        bits = np.zeros(n, U64)
        hit = np.isin(mine, theirs)
        np.bitwise_or.at(bits, row[hit], U64(1) << bit[hit].astype(np.uint64))
        keep = [batch.column(k) for k in ("a", "b", "shift", "lo", "place")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(size), pa.array(bits.view(np.int64))], ["a", "b", "shift", "lo", "place", "n", "bits"])


def passages_in(hit: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, last, hits) of maximal stretches of ``PASSAGE`` places or more, of which at least ``MATCH`` are hits, hits at both ends."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    out: list[list[int]] = []
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        run = [a, b - 1, b - a]
        while out and out[-1][2] + run[2] >= MATCH * (run[1] - out[-1][0] + 1):
            before = out.pop()
            run = [before[0], run[1], before[2] + run[2]]
        out.append(run)
    return [(a, b, n) for a, b, n in out if b - a + 1 >= PASSAGE]


def _verified(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start_word", "n_words", "kept_doc_id", "kept_start_word", "similarity"]
    for batch in found:
        rows = []
        for a, b, shift, pieces in zip(*(batch.column(k).to_pylist() for k in ("a", "b", "shift", "pieces")), strict=True):
            pieces.sort(key=lambda p: p["place"])
            begin = pieces[0]["place"]
            hit = np.zeros(max(p["place"] + p["n"] for p in pieces) - begin, bool)
            for p in pieces:
                own = np.unpackbits(np.array([p["bits"]], np.int64).view(np.uint8), bitorder="little")[: p["n"]].astype(bool)
                hit[p["place"] - begin : p["place"] - begin + p["n"]] |= own
            for lo, hi, n in passages_in(hit):
                size = hi - lo + 1
                rows.append((a, begin + lo, size + SHINGLE - 1, b, max(0, begin + lo - shift), n / (2 * size - n)))
        if rows:
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, start_word, n_words, kept_doc_id, kept_start_word, similarity): passages that another text has, too.

    A row says that ``n_words`` (50 or more) words of doc_id from word ``start_word`` on, counted from 0, repeat
    those of kept_doc_id around kept_start_word with a similarity of 0.8 or more of their 5-word
    shingles; kept_doc_id < doc_id, so the smallest doc_id of a group is named as kept only. A text
    may have several rows, also one for each place where it has a passage again. Words are lower-cased (accented letters, too). Null, empty and short texts have no passages, and
    passages that repeat within one text only are not reported. Rows with a null doc_id take no part; rows
    of one doc_id are one text (they do not repeat each other). Other columns are ignored; an empty
    table gives no rows.
    """
    own = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    found = candidates(own)
    sure = found.filter("exact").select(F.col("a").alias("doc_id"), F.col("lo").alias("start_word"), (F.col("hi") - F.col("lo") + SHINGLE).alias("n_words"), F.col("b").alias("kept_doc_id"), (F.col("lo") - F.col("shift")).alias("kept_start_word"), F.lit(1.0).alias("similarity"))
    pairs = found.filter("not exact")
    asks = pairs.select(F.col("a").alias("doc_id"), F.struct("b", "shift", "lo", "hi").alias("w"))
    chunk = F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("lo") - F.col("shift")) / CHUNK)), F.greatest(F.lit(0), F.floor((F.col("hi") - F.col("shift")) / CHUNK))))
    named = pairs.select(F.col("b").alias("doc_id"), chunk.alias("lo")).distinct()
    null = F.lit(None).cast("long")
    named = named.select("doc_id", F.struct(null.alias("b"), null.alias("shift"), "lo", null.alias("hi")).alias("w"))
    # bounded by the text's own length: each of its windows has at most ``SMALL`` partners of smaller doc_ids, and its chunks
    wanted = asks.union(named).groupBy("doc_id").agg(F.collect_list("w").alias("wanted"))
    asked = _asked(own, wanted, pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")))
    chunks = materialise(asked.mapInArrow(_chunks, _CHUNKS), "passage-chunks")
    theirs = chunks.filter("a is null").groupBy("b", "q").agg(F.min("hashes").alias("partner"))
    mine = chunks.filter("a is not null").select("b", "q", "a", "shift", "lo", "place", "hashes")
    bits = mine.join(theirs, ["b", "q"]).mapInArrow(_compare, "a long, b long, shift long, lo long, place long, n long, bits long")
    whole = bits.groupBy("a", "b", "shift", "lo").agg(F.collect_list(F.struct("place", "n", "bits")).alias("pieces"))
    return whole.mapInArrow(_verified, "doc_id long, start_word long, n_words long, kept_doc_id long, kept_start_word long, similarity double").union(sure)


def _cut(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without their spans, which are the last column."""
    for batch in found:
        texts, spans = texts_of(batch), batch.column(batch.num_columns - 1).to_pylist()
        out, keep = [], []
        for text, own in zip(texts, spans, strict=True):
            if not own:
                out.append(text)
                keep.append(True)
                continue
            t = Tokens([text])
            gone = np.zeros(len(t.starts), bool)
            for s in own:
                gone[s["start_word"] : s["start_word"] + s["n_words"]] = True
            pieces, at = [], 0
            for i in np.flatnonzero(gone):  # a word goes with the white space behind it
                pieces.append(text[at : t.starts[i]])
                at = int(t.starts[i + 1]) if i + 1 < len(gone) else len(text)
            out.append(b"".join([*pieces, text[at:]]))
            keep.append(not gone.all())
        strings = pa.array([None if x is None else x.decode("utf-8", "replace") for x in out], pa.string())
        names = batch.schema.names[:-1]
        yield pa.RecordBatch.from_arrays([strings if name == "text" else batch.column(name) for name in names], names).filter(pa.array(keep))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with every passage that a smaller doc_id has cut out of the text; a text that is nothing else goes.

    n_chars, where there is such a column, is counted anew for the texts that are cut.
    """
    spare = "_" * (1 + max(map(len, docs.columns)))  # a name that no column has
    found = repeated_passages(docs)
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "n_words")).alias(spare))
    joined = docs.join(spans, "doc_id", "left").select(*docs.columns, spare)
    whole = joined.filter(F.col(spare).isNull()).select(*docs.columns)
    cut = joined.filter(F.col(spare).isNotNull()).mapInArrow(_cut, docs.schema)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return whole.unionByName(cut)
