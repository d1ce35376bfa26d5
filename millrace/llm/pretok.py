"""Splitting text into the pieces of a byte-level BPE, for a whole batch of texts at once in numpy.

The rule is that of ``public_tokenizers.PATTERN``: contractions, then letters, digits or other signs with one space before
them, then white space. Classes of code points come from the ``regex`` module. A text with a code point whose class changed
since an early Unicode version (or that has none there) is left to a slower way, as libraries may hold other tables.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER, UNSURE = 0, 1, 2, 3, 4
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    out = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\s+", SPACE), (r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for m in regex.finditer(pattern, text):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    # What another Unicode version may class otherwise: unassigned now, or not of this class in 3.2.
    old = unicodedata.ucd_3_2_0.category
    kinds = {"L": LETTER, "N": NUMBER, "Z": SPACE}
    for c in range(0x80, 0x32000):
        if not 0xD800 <= c < 0xE000:
            x = chr(c)
            was = kinds.get(old(x)[0], OTHER)
            if c == 0x85:
                was = SPACE
            if was != out[c] or unicodedata.category(x) == "Cn":
                out[c] = UNSURE
    out[0x1C:0x20] = UNSURE  # white space to some libraries and not to others
    out[0x180E] = out[0x200B] = UNSURE
    return out


class Pieces:
    """Pieces of a batch: code points, the pieces' starts and ends, the document of each, which documents were left out."""

    def __init__(self, cps, starts, ends, doc, unsure):
        self.cps, self.starts, self.ends, self.doc, self.unsure = cps, starts, ends, doc, unsure


def split(texts: list[str]) -> Pieces:
    """Texts' pieces, in order. Documents in unsure have none."""
    table = classes()
    parts = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    cps = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    n = len(cps)
    if not n:
        e = np.empty(0, np.int64)
        return Pieces(cps, e, e, e, np.zeros(len(texts), bool))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    kind = table[cps]
    unsure = np.zeros(len(texts), bool)
    if (kind == UNSURE).any():
        at = np.flatnonzero(kind == UNSURE)
        unsure[np.searchsorted(bounds, at, "right") - 1] = True
    first = np.zeros(n + 1, bool)  # a document begins here
    first[bounds[:-1][lengths > 0]] = True
    first[n] = True
    run = np.empty(n + 1, bool)  # a run of one class begins here
    run[0] = run[n] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:n])
    run |= first
    space = kind == SPACE
    # The last sign of a run of white space before other text is a piece of its own, or the head of the next one.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & run[1:n] & ~first[1:n]
    start = run.copy()
    start[:n] |= last
    joins = last & (cps == 32)
    after = np.flatnonzero(joins) + 1
    start[after] = False  # the space and the text behind it are one piece
    # Contractions: an apostrophe that begins a piece and is a run of one, before certain small letters.
    quote = np.flatnonzero((cps == 39) & start[:n])
    quote = quote[quote + 1 < n]
    quote = quote[run[quote] & run[quote + 1] & ~first[quote + 1]]
    if len(quote):
        c1 = cps[quote + 1]
        c2 = cps[np.minimum(quote + 2, n - 1)]
        two_ok = (quote + 2 < n) & ~first[np.minimum(quote + 2, n)]
        one = (c1 == 115) | (c1 == 116) | (c1 == 109) | (c1 == 100)
        two = two_ok & (((c1 == 114) & (c2 == 101)) | ((c1 == 118) & (c2 == 101)) | ((c1 == 108) & (c2 == 108)))
        q1, q2 = quote[one], quote[two & ~one]
        start[q1 + 1] = False
        start[q1 + 2] = True
        start[q2 + 1] = False
        start[q2 + 3] = True
    starts = np.flatnonzero(start[:n])
    ends = np.append(starts[1:], n)
    doc = np.searchsorted(bounds, starts, "right") - 1
    if unsure.any():
        keep = ~unsure[doc]
        starts, ends, doc = starts[keep], ends[keep], doc[keep]
    return Pieces(cps, starts, ends, doc, unsure)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base (or of its inverse) modulo 2**64."""
    have = _powers[inverse]
    while len(have) < n:
        factor = np.uint64(pow(int(_INVERSE if inverse else _BASE), len(have), 1 << 64))
        have = np.concatenate([have, have * factor])
    _powers[inverse] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _mixed() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of mixed values (code points or bytes) times powers of the base: spans' hashes are differences of them."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    v = _mixed()[values]
    v *= powers(len(v))
    np.cumsum(v, out=out[1:])
    return out


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each span, wherever it lies."""
    sums = prefix_sums(values)
    raw = (sums[ends] - sums[starts]) * powers(len(values) + 1, True)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


class Known:
    """64-bit hashes by number of arrival, in an open-addressing table; at most half of the slots are used."""

    def __init__(self, bits: int):
        self.bits, self.room, self.n = bits, 1 << (bits - 1), 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.at = np.full(1 << bits, -1, np.int32)

    def clear(self) -> None:
        self.at.fill(-1)
        self.n = 0

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, h: np.ndarray) -> np.ndarray:
        """Numbers, -1 where unknown."""
        at = self._slot(h)
        out = self.at[at]
        todo = np.flatnonzero((out >= 0) & (self.keys[at] != h))
        at = at[todo]
        while len(todo):
            at = (at + 1) & ((1 << self.bits) - 1)
            found = self.at[at]
            out[todo] = found
            go = (found >= 0) & (self.keys[at] != h[todo])
            todo, at = todo[go], at[go]
        return out

    def add(self, h: np.ndarray) -> None:
        """New, distinct hashes; they get the next numbers in their order."""
        numbers = np.arange(self.n, self.n + len(h), dtype=np.int32)
        self.n += len(h)
        at, todo = self._slot(h), np.arange(len(h))
        while len(todo):
            cand = todo[self.at[at[todo]] < 0]
            _, one = np.unique(at[cand], return_index=True)
            won = cand[one]
            self.keys[at[won]] = h[won]
            self.at[at[won]] = numbers[won]
            left = np.ones(len(h), bool)
            left[won] = False
            todo = todo[left[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)


def numbered(known: Known, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """The numbers of hashes, after adding the new ones; where each new one comes first; whether the table began anew."""
    out = known.get(h)
    miss = np.flatnonzero(out < 0)
    if not len(miss):
        return out, miss, False
    own, first = np.unique(h[miss], return_index=True)
    anew = known.n + len(own) > known.room
    if anew:
        known.clear()
        own, first = np.unique(h, return_index=True)
        while len(own) > known.room:
            known.__init__(known.bits + 1)
        miss = np.arange(len(h))
    known.add(own)
    out[miss] = known.get(h[miss])
    return out, miss[first], anew
