"""Byte-level BPE encoding and decoding over length-bucketed padded numpy matrices.

Texts are split into pieces for a batch at once (``pretok``). Distinct pieces are laid out as rows of padded matrices, by
length bucket; in each round every row merges its leftmost pair of least rank, found through a hashed table of pairs, and
rows without a pair are taken out. A piece longer than ``MATRIX_BYTES`` is merged by a heap to the same result in
n log n steps. Ids of pieces are kept per worker, up to half of 2**``CACHE_BITS``, and gathered back to documents. Every document is
decoded from its ids; one that doesn't come back whole is encoded again piece by piece, without hashes of pieces.

Null text counts as empty: no tokens, digests of nothing. Repeated rows are encoded one by one. Extra columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import pretok
from .common import small_batches, whole_text

MATRIX_BYTES = 256
CACHE_BITS = 22
NONE = np.int32(2**31 - 1)
CELLS = 2_000_000


def read_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


def spread(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n of them) for each start, one after the other."""
    ends = np.cumsum(n)
    return np.repeat(starts - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, to = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    to.append(rank)
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        self.bits = max(4, int(2 * len(keys) + 2).bit_length() + 1)
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.to = np.full(1 << self.bits, NONE, np.int32)
        at, todo, to = self._slot(keys), np.arange(len(keys)), np.array(to, np.int32)
        self.longest = 0
        while len(todo):
            free = self.keys[at[todo]] == np.uint64(2**64 - 1)
            cand = todo[free]
            _, one = np.unique(at[cand], return_index=True)
            won = cand[one]
            self.keys[at[won]] = keys[won]
            self.to[at[won]] = to[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            self.longest += 1

    def _slot(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of merged pairs, NONE where there is none or a side is negative."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo].astype(np.uint64) << np.uint64(32)) | right[todo].astype(np.uint64)
        at = self._slot(keys)
        while len(todo):
            found = self.keys[at]
            hit = found == keys
            out[todo[hit]] = self.to[at[hit]]
            go = ~hit & (found != np.uint64(2**64 - 1))
            todo, keys, at = todo[go], keys[go], (at[go] + 1) & ((1 << self.bits) - 1)
        return out.reshape(shape)


class Codec:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.tokens[v] = k
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pairs = PairTable(ranks)
        self.known = pretok.Known(CACHE_BITS)
        self.forget()

    def forget(self) -> None:
        self.offsets = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.int32)

    def merge_rows(self, pieces: list[bytes]) -> np.ndarray:
        """Ids of pieces of much the same length, in one padded matrix (-1 after the last)."""
        width = max(map(len, pieces))
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        size = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < size[:, None], self.byte_ids[raw], -1).astype(np.int32)
        out = np.full((n, width), -1, np.int32)
        rows = np.arange(n)
        rank = self.pairs.get(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((n, 0), NONE, np.int32)
        while len(rows):
            if rank.shape[1]:
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(rows)), at]
                done = best == NONE
            else:
                done = np.ones(len(rows), bool)
            if done.any():
                out[rows[done], : ids.shape[1]] = ids[done]
                go = ~done
                rows, ids, rank = rows[go], ids[go], rank[go]
                if not len(rows):
                    break
                at, best = at[go], best[go]
                used = int((ids >= 0).sum(axis=1).max())
                ids, rank = ids[:, :used], rank[:, : used - 1]
            k = np.arange(len(rows))
            w = ids.shape[1]
            cols = np.arange(w)
            shifted = np.full_like(ids, -1)
            shifted[:, :-1] = ids[:, 1:]
            ids = np.where(cols > at[:, None], shifted, ids)
            ids[k, at] = best
            moved = np.full_like(rank, NONE)
            moved[:, :-1] = rank[:, 1:]
            rank = np.where(cols[:-1] > at[:, None], moved, rank)
            nxt = np.where(at + 1 < w, ids[k, np.minimum(at + 1, w - 1)], -1)
            here = at < w - 1
            rank[k[here], at[here]] = self.pairs.get(best[here], nxt[here])
            before = at > 0
            rank[k[before], at[before] - 1] = self.pairs.get(ids[k[before], at[before] - 1], best[before])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, position) over a linked list."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        first = self.pairs.get(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens, ranks = self.tokens, self.ranks
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (x := ranks.get(tokens[r] + tokens[ids[k]])) is not None:
                    heapq.heappush(heap, (x, i, r, ids[k]))
            h = before[i]
            if h >= 0 and (x := ranks.get(tokens[ids[h]] + tokens[r])) is not None:
                heapq.heappush(heap, (x, h, ids[h], r))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' numbers of ids, and the ids one after the other."""
        n = np.ones(len(pieces), np.int64)
        buckets: dict[int, list[int]] = {}
        found: list[tuple[list[int], np.ndarray]] = []
        whole, whole_ids = [], []
        for i, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                whole.append(i)
                whole_ids.append(rank)
            elif len(p) > MATRIX_BYTES:
                ids = self.merge_long(p)
                n[i] = len(ids)
                found.append(([i], ids))
            else:
                k = len(p)
                buckets.setdefault(k if k <= 16 else 1 << (k - 1).bit_length(), []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS // width)
            for a in range(0, len(rows), step):
                part = rows[a : a + step]
                ids = self.merge_rows([pieces[i] for i in part])
                n[part] = (ids >= 0).sum(axis=1)
                found.append((part, ids[ids >= 0]))
        if whole:
            found.append((whole, np.array(whole_ids, np.int32)))
        starts = np.concatenate([[0], np.cumsum(n)])
        flat = np.empty(starts[-1], np.int32)
        for part, ids in found:
            flat[spread(starts[part], n[part])] = ids
        return n, flat

    def encode_plain(self, text: str) -> np.ndarray:
        """One text by the regex module, without hashes."""
        import public_tokenizers
        import regex

        pieces = [x.encode() for x in regex.findall(public_tokenizers.PATTERN, text)]
        own = {p: i for i, p in enumerate(dict.fromkeys(pieces))}
        n, flat = self.encode_pieces(list(own))
        at = np.array([own[p] for p in pieces], np.int64)
        starts = np.concatenate([[0], np.cumsum(n)])
        return flat[spread(starts[at], n[at])]

    def encode_batch(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """Each text's ids, and the bytes that they decode to."""
        p = pretok.split(texts)
        flat, bounds = np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        if len(p.starts):
            number, first, anew = pretok.numbered(self.known, pretok.span_hashes(p.cps, p.starts, p.ends))
            if anew:
                self.forget()
            if len(first):
                n, ids = self.encode_pieces([p.cps[a:b].tobytes().decode("utf-32-le").encode() for a, b in zip(p.starts[first], p.ends[first], strict=True)])
                self.offsets = np.concatenate([self.offsets, len(self.flat) + np.cumsum(n)])
                self.flat = np.concatenate([self.flat, ids])
            start, n = self.offsets[number], self.offsets[number + 1] - self.offsets[number]
            flat = self.flat[spread(start, n)]
            bounds = np.concatenate([[0], np.cumsum(n)])[np.searchsorted(p.doc, np.arange(len(texts) + 1))]
        out = []
        for i, text in enumerate(texts):
            ids = flat[bounds[i] : bounds[i + 1]]
            back = self.decode(ids)
            if p.unsure[i] or back != text.encode():
                ids = self.encode_plain(text)
                back = self.decode(ids)
            out.append((ids, back))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_codecs: dict[str, Codec] = {}


def codec_for(path: str) -> Codec:
    """The codec of a rank file; the file is part of every worker's installation."""
    if path not in _codecs:
        with open(path, "rb") as f:
            _codecs[path] = Codec(read_ranks(f.read()))
    return _codecs[path]


def slices(texts: list[str], most: int = 1_000_000) -> Iterator[list[str]]:
    """Runs of texts of bounded size (a longer text is a run of its own)."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def encode(docs: DataFrame, path: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, and ids (array<int>) if asked for."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(path)
        for b in batches:
            keys, texts, at = b.column(0), b.column(1).to_pylist(), 0
            for part in slices(texts):
                n, h, d, kept = [], [], [], []
                for ids, back in codec.encode_batch(part):
                    n.append(len(ids))
                    h.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    d.append(hashlib.sha256(back).hexdigest())
                    if keep_ids:
                        kept.append(ids)
                cols = [keys.slice(at, len(part)), pa.array(n, pa.int64()), pa.array(h, pa.string()), pa.array(d, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    cols.append(pa.array(kept, pa.list_(pa.int32())))
                    names.append("ids")
                at += len(part)
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(docs[id_col].alias("doc_id"), whole_text(text_col).alias("t")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of each row's ids."""

    def run(batches):
        codec = codec_for(path)
        for b in batches:
            texts = [codec.decode(np.array(x or [], np.int32)).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
