"""Removal of repeated byte strings by a distributed merge sort of suffixes that knows their common prefixes.

Every byte of a document that lies in a string of ``LENGTH`` bytes that also starts in a document of a smaller id is removed.

1. Of texts that are equal one is kept (with the smallest id); the rest are judged from it. Kept texts are put into packs.
2. Each string of LENGTH bytes has an anchor: of the ``GRAM``-byte strings in it the first of least hash. Equal strings have
   equal anchors at equal offsets, so only suffixes at anchors are sorted. Packs exchange the sorted hashes of their anchors
   by range; one that no second text has can't repeat and is dropped. The answer is a bit for each hash.
3. Each pack sorts the suffixes at its other anchors (the anchor, what follows it, and what precedes it read backwards: all
   that any string with this anchor can hold) into a run, equal ones once with the smallest id. Runs are front-coded
   (length of the prefix shared with the one before, then the rest), cut at sampled splitters and exchanged by range.
4. Each range merges its runs with a loser tree that keeps, for each run's head, the prefix length it shares with the last
   output: of two heads the one that shares more is smaller, and only heads that share the same length are compared, from
   there on. Shared lengths of the output give, for each suffix and each string around its anchor, the smallest id.
5. The answer is a bit for each suffix and string: whether a smaller id than the pack's own has it. Packs mark and cut.

A text or a string can gather no more than one entry a pack in a task. Suffixes of one anchor stay in one range with all their
different contexts, as strings around it are told apart there; the number of ranges and packs grows with the input.

Null counts as empty; texts under LENGTH bytes keep all; very long texts are packs of their own, whole. Null ids count as
greater than all others and not smaller than each other. Rows with one id don't remove each other, whether their texts are
equal or not; equal ones get the same result. An empty table gives an empty result. Extra columns, whatever their names, are
left out. Ids that aren't numbers are refused by Spark's cast.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretok
from .bpe import spread
from .common import small_batches, snapshot, spread_join, under, whole_text

LENGTH, GRAM = 50, 20
SIDE = LENGTH - GRAM
KEY = GRAM + 2 * SIDE + 2
#: A pack's bytes: this share of all bytes between these two sizes, so that packs don't outnumber what one exchange can hold.
PACK_BYTES, MOST_PACK_BYTES, PACKS = 4_000_000, 32_000_000, 1 << 17
#: Bytes that one bucket of the table of packs holds, and the most buckets.
BUCKET_BYTES, MOST_BUCKETS = 12_000_000, 100_000
#: Hashes, and suffixes, that one range of an exchange holds on average.
HASHES_A_RANGE, SUFFIXES_A_RANGE = 500_000, 50_000
#: Bits of an anchor's hash. Two anchors of one hash are taken for repeated, and told apart when their suffixes are merged.
HASH_BITS = 48
#: Splitters are chosen from some hundred suffixes of each of as many runs as give four for each range, between these numbers.
SAMPLED_RUNS, MOST_SAMPLED_RUNS = 500, 16_000
NO_ID = 2**63 - 1
_ZSTD = pa.Codec("zstd", compression_level=6)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def _swell(data: bytes) -> bytes:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=n, codec="zstd", asbytes=True) if n else b""


def _packer(most: int):
    """digest, rep, t -> pack, ids, digests, sizes, data, n."""

    def out(rows):
        ids, sizes = np.array([r[1] for r in rows], np.int64), np.array([len(r[2]) for r in rows], np.int64)
        pack = int.from_bytes(rows[0][0][:8], "little", signed=True)
        cols = [pack, ids.tobytes(), b"".join(r[0] for r in rows), sizes.tobytes(), _squeeze(b"".join(r[2] for r in rows)), int(sizes.sum())]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds, strict=True)], ["pack", "ids", "digests", "sizes", "data", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for digest, rep, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                data = text.encode()
                if rows and size + len(data) > most:
                    yield out(rows)
                    rows, size = [], 0
                rows.append((digest, rep, data))
                size += len(data)
        if rows:
            yield out(rows)

    return run


class Pack:
    """A pack's bytes and the anchors in them."""

    def __init__(self, sizes: bytes, data: bytes):
        self.raw = np.frombuffer(_swell(data), np.uint8)
        self.sizes = np.frombuffer(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, hashes and documents (by number) of the anchors. As anchors are those of least hash, it is mixed again:
        ranges of the result hold equally many."""
        n = len(self.raw) - GRAM + 1
        sums = pretok.prefix_sums(self.raw)
        h = pretok.mix((sums[GRAM:] - sums[:n]) * pretok.powers(len(self.raw) + 1, True)[:n])
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        width = 1
        while 2 * width <= SIDE + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SIDE + 1 - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        starts = spread(self.begins, np.maximum(self.sizes - LENGTH + 1, 0))
        at = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        at = at[np.diff(at, prepend=-1) != 0]
        return at, pretok.mix(h[at] + np.uint64(1)) >> np.uint64(64 - HASH_BITS), np.searchsorted(self.ends, at, "right")

    def suffixes(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """A row of KEY bytes for each place: anchor, what follows, what precedes backwards, and how much there is of these."""
        out = np.zeros((len(at), KEY), np.uint8)
        right = np.minimum(self.ends[doc] - at - GRAM, SIDE)
        left = np.minimum(at - self.begins[doc], SIDE)
        top = len(self.raw) - 1
        for j in range(GRAM):
            out[:, j] = self.raw[at + j]
        for j in range(SIDE):
            out[:, GRAM + j] = np.where(j < right, self.raw[np.minimum(at + GRAM + j, top)], 0)
            out[:, GRAM + SIDE + j] = np.where(j < left, self.raw[np.maximum(at - 1 - j, 0)], 0)
        out[:, -2], out[:, -1] = right + 1, left + 1
        return out


def distinct_hashes(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and which of them lie in two documents or more (doc doesn't fall along h)."""
    order = np.argsort(h, kind="stable")
    s, d = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
    last = np.append(first[1:], len(s)) - 1 if len(s) else first
    return s[first], d[first] != d[last]


def pack_numbers(x: np.ndarray) -> bytes:
    """Rising numbers: the first in eight bytes, then differences in as few bytes as the largest needs (the first byte tells)."""
    d = np.diff(x)
    width = max(1, (int(d.max()).bit_length() + 7) // 8) if len(d) else 1
    return bytes([width]) + x[:1].astype("<u8").tobytes() + d.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    wide = np.zeros((len(raw) + 1, 8), np.uint8)
    wide[0] = np.frombuffer(data, np.uint8, 8, 1)
    wide[1:, :width] = raw
    return np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64)


def front_code(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted distinct rows: lengths shared with the row before, and what isn't shared."""
    shared = np.zeros(len(keys), np.uint8)
    if len(keys) > 1:
        shared[1:] = (keys[1:] != keys[:-1]).argmax(axis=1)
    return shared.tobytes(), keys[np.arange(keys.shape[1]) >= shared[:, None]].tobytes()


def front_decode(shared: bytes, rest: bytes) -> np.ndarray:
    shared = np.frombuffer(shared, np.uint8)
    own = np.arange(KEY) >= shared[:, None]
    out = np.zeros(own.shape, np.uint8)
    out[own] = np.frombuffer(rest, np.uint8)
    row = np.where(own, np.arange(len(shared))[:, None], 0)
    np.maximum.accumulate(row, axis=0, out=row)
    return out[row, np.arange(KEY)]


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Loser-tree merge of sorted runs (keys of one length, prefix lengths shared with the key before).

    Yields run, place in it, and the length of the prefix shared with the last output.
    """
    k = len(runs)
    if not k:
        return
    place, shared = [0] * k, [0] * k
    head = [r[0][0] if r[0] else None for r in runs]
    to_int = int.from_bytes

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared length is then with the winner."""
        x, y = head[a], head[b]
        if x is None:
            return b, a
        if y is None:
            return a, b
        h = shared[a]
        if h != shared[b]:
            return (a, b) if h > shared[b] else (b, a)
        x, y = x[h:], y[h:]
        if x == y:
            shared[b] = h + len(x)
            return a, b
        h += len(x) - (((to_int(x) ^ to_int(y)).bit_length() + 7) >> 3)
        if x < y:
            shared[b] = h
            return a, b
        shared[a] = h
        return b, a

    losers = [0] * k
    winners = [0] * (2 * k)
    winners[k:] = range(k)
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    while head[top] is not None:
        yield top, place[top], shared[top]
        keys, lengths = runs[top]
        place[top] = i = place[top] + 1
        if i < len(keys):
            head[top], shared[top] = keys[i], lengths[i]
        else:
            head[top] = None
        node = (top + k) >> 1
        while node:
            other = losers[node]
            if head[top] is not None and head[other] is not None and shared[top] > shared[other]:
                pass  # top stays ahead, and the loser's shared length holds
            else:
                top, losers[node] = play(top, other)
            node >>= 1


def smaller_ids(keys: np.ndarray, shared: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """keys: merged rows in order; shared: with the row before; ids: a row's smallest id in its pack.

    A bit for each row and string: whether another row with this string has a smaller id. Bit o stands for the string that
    begins o bytes before the anchor.
    """
    n = len(keys)
    out = np.zeros(n, np.uint32)
    first = np.flatnonzero(shared < KEY)
    if not n:
        return out
    row = np.cumsum(shared < KEY) - 1  # the distinct suffix of each row
    least = np.minimum.reduceat(ids, first)
    own = keys[first]
    own_shared = shared[first]
    anchor = np.cumsum(own_shared < GRAM) - 1
    right, left = own[:, -2].astype(np.int64) - 1, own[:, -1].astype(np.int64) - 1
    several = np.bincount(anchor)[anchor] > 1
    many = np.flatnonzero(several)
    best = np.repeat(least[:, None], SIDE + 1, axis=1)
    if len(many):
        sub, ls, rs = own[many], left[many], right[many]
        back = sub[:, GRAM + SIDE : GRAM + 2 * SIDE].astype(np.uint64)
        prefix = np.zeros(len(many), np.uint64)
        for o in range(SIDE + 1):
            if o:
                prefix = pretok.mix(prefix * np.uint64(0x9E3779B97F4A7C15) + back[:, o - 1] + np.uint64(1))
            run = np.cumsum(own_shared < GRAM + SIDE - o)[many].astype(np.uint64)
            ok = np.flatnonzero((ls >= o) & (rs >= SIDE - o))
            if not len(ok):
                continue
            key = pretok.mix(prefix[ok] ^ (run[ok] * np.uint64(0xD6E8FEB86659FD93)))
            order = np.argsort(key, kind="stable")
            k = key[order]
            start = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            low = np.minimum.reduceat(least[many[ok[order]]], start)
            best[many[ok[order]], o] = np.repeat(low, np.diff(np.append(start, len(k))))
    for o in range(SIDE + 1):
        valid = (left >= o) & (right >= SIDE - o)
        out |= np.where((best[:, o][row] < ids) & valid[row], np.uint32(1 << o), np.uint32(0))
    return out


def _offer(bits: int):
    """pack, sizes, data -> range, pack, hashes, twice: a pack's anchors by range of their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, sizes, data in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                _, h, doc = Pack(sizes, data).anchors()
                own, twice = distinct_hashes(h, doc)
                cut = np.searchsorted(own, np.arange(1 << bits, dtype=np.uint64) << np.uint64(HASH_BITS - bits))
                cut = np.append(cut, len(own))
                rows = [(r, pack, pack_numbers(own[a:z]), np.packbits(twice[a:z]).tobytes()) for r, (a, z) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if z > a]
                cols = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], ["range", "pack", "hashes", "twice"])

    return run


def _meet(t: pa.Table) -> pa.Table:
    """One range of hashes: for each pack's, which of them a second text has."""
    r = t.column("range")[0].as_py() if t.num_rows else 0
    packs, hashes = t.column("pack").to_pylist(), [unpack_numbers(x) for x in t.column("hashes").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, np.uint8))[: len(h)].astype(bool) for x, h in zip(t.column("twice").to_pylist(), hashes, strict=True)]
    flat = np.concatenate([*hashes, np.empty(0, np.uint64)])
    order = np.argsort(flat, kind="stable")
    s = flat[order]
    hit = np.concatenate([*twice, np.empty(0, bool)])[order]
    hit[1:] |= s[1:] == s[:-1]
    hit[:-1] |= s[1:] == s[:-1]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.empty(0, np.int64)
    if len(s):
        hit = np.repeat(np.logical_or.reduceat(hit, first), np.diff(np.append(first, len(s))))
    back = np.empty(len(s), bool)
    back[order] = hit
    ends = np.cumsum([len(h) for h in hashes]).astype(np.int64)
    masks = [np.packbits(back[e - len(h) : e]).tobytes() for e, h in zip(ends, hashes, strict=True)]
    return pa.table({"pack": pa.array(packs, pa.int64()), "range": pa.array([r] * len(packs), pa.int64()), "mask": pa.array(masks, pa.binary())})


def _sorted_runs(bits: int):
    """pack, ids, sizes, data, masks -> pack, keys, ids of a sorted run, and where its suffixes occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, ids, sizes, data, masks in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                p = Pack(sizes, data)
                at, h, doc = p.anchors()
                own, _ = distinct_hashes(h, doc)
                shared = np.zeros(len(own), bool)
                cut = np.append(np.searchsorted(own, np.arange(1 << bits, dtype=np.uint64) << np.uint64(HASH_BITS - bits)), len(own))
                for m in masks:
                    a, z = cut[m["range"]], cut[m["range"] + 1]
                    shared[a:z] = np.unpackbits(np.frombuffer(m["mask"], np.uint8))[: z - a].astype(bool)
                keep = shared[np.searchsorted(own, h)]
                at, doc = at[keep], doc[keep]
                if not len(at):
                    continue
                keys = p.suffixes(at, doc)
                run_keys, back = np.unique(keys.view(f"S{KEY}").ravel(), return_inverse=True)
                run_keys = np.ascontiguousarray(run_keys).view(np.uint8).reshape(-1, KEY)
                least = np.full(len(run_keys), NO_ID, np.int64)
                np.minimum.at(least, back, np.frombuffer(ids, np.int64)[doc])
                lengths, rest = front_code(run_keys)
                cols = [pack, _squeeze(lengths), _squeeze(rest), least.tobytes(), _squeeze(at.tobytes()), _squeeze(back.astype(np.int32).tobytes()), run_keys[:: max(1, len(run_keys) // 100), :GRAM].tobytes(), len(run_keys)]
                kinds = [pa.int64(), *[pa.binary()] * 6, pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cols, kinds, strict=True)], ["pack", "shared", "rest", "least", "at", "key_no", "sample", "n"])

    return run


_RUN = "pack bigint, shared binary, rest binary, least binary, at binary, key_no binary, sample binary, n bigint"


def _cut(splitters: list[bytes]):
    """A run -> its parts by range, each front-coded on its own."""
    bounds = np.array(splitters, f"S{GRAM}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pack, shared, rest, least in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                keys = front_decode(_swell(shared), _swell(rest))
                part = np.searchsorted(bounds, np.ascontiguousarray(keys[:, :GRAM]).view(f"S{GRAM}").ravel(), "right")
                ids = np.frombuffer(least, np.int64)
                edges = np.flatnonzero(np.diff(part, prepend=-1, append=len(bounds) + 1))
                rows = []
                for a, z in zip(edges[:-1], edges[1:], strict=True):
                    lengths, own = front_code(keys[a:z])
                    rows.append((int(part[a]), pack, int(a), _squeeze(lengths), _squeeze(own), _squeeze(ids[a:z].tobytes())))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 3 + [pa.binary()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["range", "pack", "from", "shared", "rest", "least"])

    return run


def _merge(t: pa.Table) -> pa.Table:
    """One range of suffixes: merges the packs' runs; a mask for each of their suffixes."""
    packs, start = t.column("pack").to_pylist(), t.column("from").to_pylist()
    mats = [front_decode(_swell(s), _swell(r)) for s, r in zip(t.column("shared").to_pylist(), t.column("rest").to_pylist(), strict=True)]
    ids = [np.frombuffer(_swell(x), np.int64) for x in t.column("least").to_pylist()]
    runs = []
    for s, m in zip(t.column("shared").to_pylist(), mats, strict=True):
        flat = m.tobytes()
        runs.append(([flat[i : i + KEY] for i in range(0, len(flat), KEY)], list(_swell(s))))
    base = np.cumsum([0, *[len(m) for m in mats]])
    order, shared = np.empty(base[-1], np.int64), np.empty(base[-1], np.int64)
    for i, (r, place, length) in enumerate(merge_runs(runs)):
        order[i] = base[r] + place
        shared[i] = length
    if len(shared):
        shared[0] = 0
    bits = smaller_ids(np.concatenate([*mats, np.empty((0, KEY), np.uint8)])[order], shared, np.concatenate([*ids, np.empty(0, np.int64)])[order])
    back = np.empty(len(bits), np.uint32)
    back[order] = bits
    masks = [_squeeze(back[a:z].tobytes()) for a, z in zip(base[:-1], base[1:], strict=True)]
    return pa.table({"pack": pa.array(packs, pa.int64()), "from": pa.array(start, pa.int64()), "mask": pa.array(masks, pa.binary())})


def _remove(batches: Iterator[pa.RecordBatch], with_text: bool = False) -> Iterator[pa.RecordBatch]:
    """pack, ids, digests, sizes, data, least, at, key_no, masks -> a row for each text of the packs."""
    for b in batches:
        for _, ids, digests, sizes, data, least, at, key_no, masks in zip(*(b.column(i).to_pylist() for i in range(9)), strict=True):
            p = Pack(sizes, data)
            cover = np.zeros(len(p.raw) + 1, np.int32)
            ids = np.frombuffer(ids, np.int64)
            if at:
                at, key_no = np.frombuffer(_swell(at), np.int64), np.frombuffer(_swell(key_no), np.int32)
                least = np.frombuffer(least, np.int64)
                bits = np.zeros(len(least), np.uint32)
                for m in masks or []:
                    part = np.frombuffer(_swell(m["mask"]), np.uint32)
                    bits[m["from"] : m["from"] + len(part)] = part
                doc = np.searchsorted(p.ends, at, "right")
                mine = np.where(ids[doc] > least[key_no], np.uint32(2 ** (SIDE + 1) - 1), bits[key_no])
                right, left = p.ends[doc] - at - GRAM, at - p.begins[doc]
                for o in range(SIDE + 1):
                    hit = ((mine >> np.uint32(o)) & np.uint32(1)).astype(bool) & (left >= o) & (right >= SIDE - o)
                    np.add.at(cover, at[hit] - o, 1)
                    np.add.at(cover, at[hit] - o + LENGTH, -1)
            gone = np.cumsum(cover[:-1]) > 0
            rows = []
            for i, (a, z) in enumerate(zip(p.begins, p.ends, strict=True)):
                g = gone[a:z]
                kept = p.raw[a:z][~g].tobytes()
                rows.append((digests[32 * i : 32 * i + 32], int(ids[i]), int(g.sum()), int((np.diff(g.astype(np.int8), prepend=np.int8(0)) == 1).sum()), hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_text]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["digest", "rep", "n_removed", "n_spans", "kept_sha256", "kept"][: len(cols)])


def _power(n: float) -> int:
    return max(3, int(np.ceil(np.log2(max(1.0, n)))))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per input row. Ids are whole numbers."""
    spark = docs.sparkSession
    small_batches(spark)
    t = whole_text(text_col)
    src = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("did"), t.alias("t"), F.unhex(F.sha2(F.encode(t, "UTF-8"), 256)).alias("digest"))
    rows = snapshot(src.select("doc_id", "did", F.octet_length("t").cast("long").alias("n_bytes"), "digest"))
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    texts = src.filter(F.octet_length("t") >= LENGTH).groupBy("digest").agg(F.min("did").alias("rep"), F.first("t").alias("t"))
    # Packs are a bucketed table, so that what comes back for a pack is shuffled to it and never the texts again.
    name = f"millrace_packs_{uuid.uuid4().hex}"
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MOST_BUCKETS, max(12, least, -(-total // BUCKET_BYTES)))
    made = texts.select("digest", "rep", "t").mapInArrow(_packer(min(MOST_PACK_BYTES, max(PACK_BYTES, total // PACKS))), "pack bigint, ids binary, digests binary, sizes binary, data binary, n bigint")
    try:
        made.write.format("parquet").option("compression", "none").bucketBy(buckets, "pack").saveAsTable(name)
        results = _results(spark.table(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    copy = F.col("did") > F.col("rep")
    return spread_join(rows, results, "digest", "left").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
    )


def _results(packs: DataFrame) -> DataFrame:
    """digest, rep, n_removed, n_spans, kept_sha256 of the packs' texts. Exchanges have a partition for each range."""
    spark = packs.sparkSession
    total = packs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = _power(total * 2 / (SIDE + 2) / HASHES_A_RANGE)
    offers = packs.select("pack", "sizes", "data").mapInArrow(_offer(bits), "range bigint, pack bigint, hashes binary, twice binary")
    answers = offers.repartition(1 << bits, "range").groupBy("range").applyInArrow(_meet, "pack bigint, range bigint, mask binary")
    masks = answers.groupBy("pack").agg(F.collect_list(F.struct("range", "mask")).alias("masks"))
    runs = snapshot(packs.join(masks, "pack").select("pack", "ids", "sizes", "data", "masks").mapInArrow(_sorted_runs(bits), _RUN))
    n, n_runs = runs.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    parts = -(-n // SUFFIXES_A_RANGE)
    sampled = min(MOST_SAMPLED_RUNS, max(SAMPLED_RUNS, parts // 25))
    some = runs.filter(under(F.xxhash64("pack"), sampled / max(1, n_runs)))
    sample = sorted(x for r in some.select("sample").toLocalIterator() for x in (r[0][i : i + GRAM] for i in range(0, len(r[0]), GRAM)))
    parts = max(1, min(len(sample), parts))
    splitters = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []
    cut = runs.select("pack", "shared", "rest", "least").mapInArrow(_cut(splitters), "range bigint, pack bigint, from bigint, shared binary, rest binary, least binary")
    merged = cut.repartition(max(spark.sparkContext.defaultParallelism, parts), "range").groupBy("range").applyInArrow(_merge, "pack bigint, from bigint, mask binary")
    marks = merged.groupBy("pack").agg(F.collect_list(F.struct("from", "mask")).alias("marks"))
    known = runs.select("pack", "least", "at", "key_no").join(marks, "pack", "left")
    done = packs.join(known, "pack", "left").select("pack", "ids", "digests", "sizes", "data", "least", "at", "key_no", "marks")
    return snapshot(done.mapInArrow(_remove, "digest binary, rep bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))


def oracle_sql() -> str:
    """DuckDB: every string of LENGTH bytes with the smallest id that it starts in, then runs of covered bytes and what lies
    between them."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(doc_id, 9223372036854775807) AS did, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
spot AS (SELECT rid, did, unnest(range(0, length(h) // 2 - {LENGTH - 1})) AS p, h FROM d WHERE length(h) >= {2 * LENGTH}),
win AS (SELECT rid, did, p, hash(substr(h, 2 * p + 1, {2 * LENGTH})) AS k1, md5_number(substr(h, 2 * p + 1, {2 * LENGTH})) AS k2 FROM spot),
low AS (SELECT k1, k2, min(did) AS least FROM win GROUP BY k1, k2 HAVING min(did) < max(did)),
hit AS (SELECT rid, p FROM win JOIN low USING (k1, k2) WHERE did > least),
mark AS (SELECT rid, p, CASE WHEN p - lag(p, 1, -{2 * LENGTH}) OVER (PARTITION BY rid ORDER BY p) > {LENGTH} THEN 1 ELSE 0 END AS new FROM hit),
runs AS (SELECT rid, g, min(p) AS a, max(p) + {LENGTH} AS z FROM (SELECT rid, p, sum(new) OVER (PARTITION BY rid ORDER BY p) AS g FROM mark) GROUP BY rid, g),
gaps AS (SELECT rid, a, z, lag(z, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS before FROM runs),
cut AS (SELECT rid, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM gaps JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (rid)
"""
