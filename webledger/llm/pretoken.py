"""Splits texts into the pieces that byte-level BPE merges within.

The split rule is the published one:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
It is local, so the piece starts of many texts are found at once from the
class of each character and of its neighbours.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np

OTHER, LETTER, NUMBER, SPACE, EDGE = range(5)
#: The code points with the property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LIMIT = 250_000


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter(
        (kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
    )
    out[WHITE_SPACE] = SPACE
    return out


def starts(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where pieces start in ``points``; each position of ``edges`` separates
    two texts and is a piece of its own."""
    kind = classes()[points]
    kind[edges] = EDGE
    n = len(points)
    new = np.ones(n, bool)
    if n < 2:
        return np.flatnonzero(new)
    turn = kind[1:] != kind[:-1]
    visible = kind <= NUMBER
    space = (points == 0x20) & (kind == SPACE)
    # A run starts a piece unless the space before it does.
    new[1:] = turn & ~(visible[1:] & space[:-1])
    # The last white space before visible text leaves its run.
    new[:-1] |= (kind[:-1] == SPACE) & visible[1:]
    # Contractions: an apostrophe that starts a piece, with its letters.
    quote = np.flatnonzero(new & (points == 0x27))
    if len(quote):
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        padded[edges] = 0
        a, b = padded[quote + 1], padded[quote + 2]
        # S t m d, and re ve ll.
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for q, size in ((quote[one], 2), (quote[two], 3)):
            new[q + 1] = False
            after = q + size
            after = after[after < n]
            new[after] = True
    new[edges] = True
    return np.flatnonzero(new)


def parts(text: str, limit: int = LIMIT) -> list[str]:
    """``text`` cut where a space follows an ASCII letter, which always starts
    a piece, so that the parts of a very long text can be split one by one."""
    out, at = [], 0
    while len(text) - at > limit:
        cut = at + limit
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isascii() and text[cut - 1].isalpha()):
            cut += 1
        if cut >= len(text):
            break
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


def split_many(texts: list[str]) -> Iterator[list[str]]:
    """The pieces of each of ``texts``."""
    if not texts:
        return
    joined = "\0".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    edges = ends[:-1]
    begin = starts(points, edges) if len(points) else np.zeros(0, np.int64)
    stop = np.append(begin[1:], len(points))
    first = np.searchsorted(begin, np.append(0, edges + 1))
    last = np.searchsorted(begin, ends)
    b, s = begin.tolist(), stop.tolist()
    for i, j in zip(first.tolist(), last.tolist(), strict=True):
        yield [joined[x:y] for x, y in zip(b[i:j], s[i:j], strict=True)]


def split(text: str) -> list[str]:
    """The pieces of one text of any length."""
    return [w for part in parts(text) for w in next(split_many([part]))]


#: Odd multipliers of the two hashes of a piece.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: A longer piece is looked up by itself, not by hash.
HASHED = 64


@functools.cache
def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both bases, their powers and inverse powers up to ``n``, modulo 2^64."""
    out = []
    for base in BASES:
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n + 1, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        out.append(tuple(both))
    return out


def piece_hashes(points: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit polynomial hashes of every piece."""
    x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    out = []
    for up, down in powers(1 << max(16, int(len(points)).bit_length())):
        total = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(x * up[: len(points)], out=total[1:])
        out.append((total[stop] - total[begin]) * down[begin])
    return out


class PieceIds:
    """Ids of the pieces of texts; distinct pieces are remembered, up to ``keep`` of them.

    ``encode(pieces)`` gives the id list of each distinct piece not yet known.
    Pieces are found again by two hashes of 64 bits; a string is made only of
    a new piece.
    """

    def __init__(self, encode, keep: int = 400_000):
        self.encode, self.keep = encode, keep
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.check = np.zeros(1 << 12, np.uint64)
        self.first, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat, self.used = np.zeros(1 << 14, np.uint32), 0

    def add(self, keys: list[int], checks: np.ndarray, pieces: list[str]) -> None:
        lists = self.encode(pieces)
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))
        n, m = len(self.place), len(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + m > len(self.check):
            self.check, self.first, self.size = (np.concatenate([a, np.zeros_like(a)]) for a in (self.check, self.first, self.size))
        self.flat[self.used : self.used + len(ids)] = ids
        self.check[n : n + m], self.size[n : n + m] = checks, size
        self.first[n : n + m] = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.place.update(zip(keys, range(n, n + m), strict=True))

    def group(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each of some texts of moderate length together."""
        joined = "\0".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points):
            return [np.zeros(0, np.uint32)] * len(texts)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        begin = starts(points, ends[:-1])
        stop = np.append(begin[1:], len(points))
        one, two = piece_hashes(points, begin, stop)
        edge = np.zeros(len(begin), bool)
        edge[np.searchsorted(begin, ends[:-1])] = True
        long = np.flatnonzero((stop - begin > HASHED) & ~edge)
        one[long] = np.arange(len(long), dtype=np.uint64)  # each by itself; looked up no further
        special = edge.copy()
        special[long] = True
        keys, first, where = np.unique(one[~special], return_index=True, return_inverse=True)
        usual = np.flatnonzero(~special)
        first = usual[first]
        known = np.fromiter(map(self.place.get, keys.tolist(), repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(known < 0)
        if len(new):
            if len(self.place) and len(self.place) + len(new) > self.keep:
                self.clear()
                new = np.arange(len(keys))
            at = first[new]
            n = len(self.place)
            self.add(keys[new].tolist(), two[at], [joined[a:b] for a, b in zip(begin[at].tolist(), stop[at].tolist(), strict=True)])
            known[new] = np.arange(n, n + len(new))
        at = known[where]
        if not np.array_equal(self.check[at], two[usual]):  # two pieces with one hash
            return [self.plain(t) for t in texts]
        size = np.zeros(len(begin), np.int64)
        size[usual] = self.size[at]
        lists = self.encode([joined[a:b] for a, b in zip(begin[long].tolist(), stop[long].tolist(), strict=True)]) if len(long) else []
        size[long] = [len(x) for x in lists]
        upto = np.cumsum(size)
        source = np.zeros(len(begin), np.int64)
        source[usual] = self.first[at]
        ids = self.flat[np.minimum(np.repeat(source - (upto - size), size) + np.arange(upto[-1]), len(self.flat) - 1)]
        for p, x in zip(long.tolist(), lists, strict=True):
            ids[upto[p] - size[p] : upto[p]] = x
        cuts = upto[np.searchsorted(begin, ends[:-1])]
        return np.split(ids, cuts)

    def plain(self, text: str) -> np.ndarray:
        return np.array([i for x in self.encode(next(split_many([text]))) for i in x], np.uint32)


def ids_of_texts(texts: list[str], known: PieceIds) -> Iterator[np.ndarray]:
    """The ids of each text, whatever its length."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= LIMIT):
            size += len(texts[j])
            j += 1
        if j == i + 1 and size > LIMIT:
            yield np.concatenate([known.group([part])[0] for part in parts(texts[i])])
        else:
            yield from known.group(texts[i:j])
        i = j
