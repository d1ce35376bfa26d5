"""Benchmark decontamination by greedy string tiling.

Tokens are runs of word characters, lower-cased. A document and a benchmark item that share a seed (five tokens in a row)
are tiled: the longest matches of tokens not yet marked are marked one after the other on both sides (ties: the earlier place
in the item, then in the document) until no match of five tokens is left. Their lengths are found by running Karp-Rabin hashes
under a falling search length. An item whose tiles cover ``threshold`` of its tokens has leaked, in whatever order its parts
stand.

A benchmark of at most ``BROADCAST_SEEDS`` tokens is sent to the workers, which look a document's seeds up; documents are then
neither shuffled nor collected. A larger one's seeds are joined with those of the distinct texts by a shuffle, in which seeds
that many texts hold are dealt over several tasks; only pairs that share enough seeds are joined to their texts and tiled.

Null or empty texts and items, and items under five tokens, match nothing. Repeated documents and items are judged one by one,
as are rows of one id with different texts. Very long and very repetitive texts are tiled whole. Empty tables on either side
give no leaks. Extra columns, whatever their names, are left out of the report and kept by the filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import pretok
from .bpe import slices
from .common import small_batches, snapshot, spread_join

WORDS, THRESHOLD = 5, 0.8
#: A benchmark of up to this many tokens is sent to the workers; a larger one's seeds are joined by a shuffle.
BROADCAST_SEEDS = 2_000_000


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are word characters, and the small letter of each."""
    word, small = np.zeros(0x110000, bool), np.arange(0x110000, dtype=np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalnum() or x == "_":
            word[c] = True
            if len(y := x.lower()) == 1:
                small[c] = ord(y)
    return word, small


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and where each text's begin (one more than texts)."""
    word, small = _tables()
    parts = [np.frombuffer((t + "\n").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    cps = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    w = word[cps]
    edge = np.diff(w.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = pretok.span_hashes(small[cps], starts, ends)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return h, np.searchsorted(starts, bounds)


def seeds(h: np.ndarray) -> np.ndarray:
    """Hashes of the windows of five tokens."""
    if len(h) < WORDS:
        return np.empty(0, np.uint64)
    out = np.zeros(len(h) - WORDS + 1, np.uint64)
    for i in range(WORDS):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - WORDS + 1 + i]
    return pretok.mix(out)


class Side:
    """A text's tokens with prefix hashes, so that any window's hash is a difference, and marks of what is in a tile."""

    def __init__(self, h: np.ndarray, at: np.ndarray):
        self.h, self.at = h, at  # at: where tiles may begin
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(pretok.mix(h) * pretok.powers(len(h)), out=self.sums[1:])
        self.marked = np.zeros(len(h), bool)
        self.marks = np.zeros(len(h) + 1, np.int64)

    def mark(self, a: int, n: int) -> None:
        self.marked[a : a + n] = True

    def count(self) -> None:
        """After marking: prefix counts of marks; places that are taken are no longer looked at."""
        np.cumsum(self.marked, out=self.marks[1:])
        self.at = self.at[~self.marked[self.at]]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows of n tokens without a mark."""
        at = self.at[self.at + n <= len(self.h)]
        at = at[self.marks[at + n] == self.marks[at]]
        return at, pretok.mix((self.sums[at + n] - self.sums[at]) * pretok.powers(len(self.h) + 1, True)[at])


def tile(doc: np.ndarray, item: np.ndarray, doc_seeds: np.ndarray, item_seeds: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length) in the order in which they were marked.

    The search length falls from one tile length to the next: whether any window of a length is in both is told by their
    hashes, and as the longer holds the shorter, the greatest such length is found by halving. All tiles of that length are
    marked in one go over the item, each at the first free place in the document, which never moves back. So a text of one
    token over and over costs no more than another: a few sorts for each different tile length.
    """
    p, q = Side(item, np.flatnonzero(np.isin(item_seeds, doc_seeds))), Side(doc, np.flatnonzero(np.isin(doc_seeds, item_seeds)))
    out, most = [], min(len(item), len(doc))

    def shared(n: int) -> bool:
        return bool(np.isin(p.windows(n)[1], q.windows(n)[1]).any())

    while most >= WORDS and shared(WORDS):
        low, step = WORDS, WORDS  # shared at low; doubled first, as most tiles are short beside a document
        while low + step <= most and shared(low + step):
            low, step = low + step, 2 * step
        high = min(most, low + step - 1)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if shared(mid) else (low, mid - 1)
        n = low
        (at, own), (places, theirs) = p.windows(n), q.windows(n)
        order = np.argsort(theirs, kind="stable")
        theirs, places = theirs[order], places[order]
        first, last = np.searchsorted(theirs, own, "left"), np.searchsorted(theirs, own, "right")
        next_free: dict[int, int] = {}
        until = 0
        for a, lo, hi in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
            if a < until:
                continue
            k = next_free.get(lo, lo)
            while k < hi:
                b = int(places[k])
                k += 1
                if not q.marked[b] and not q.marked[b + n - 1] and (item[a : a + n] == doc[b : b + n]).all():
                    out.append((a, b, n))
                    p.mark(a, n)
                    q.mark(b, n)
                    until = a + n
                    break
            next_free[lo] = k
        p.count()
        q.count()
        most = n - 1
    return out


class Benchmark:
    """A part of the benchmark as the workers hold it."""

    def __init__(self, ids: list, texts: list[str]):
        h, bounds = tokens(texts)
        self.ids = ids
        self.items = [h[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
        self.seeds = [seeds(x) for x in self.items]
        flat = np.concatenate([*self.seeds, np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(texts)), [len(x) for x in self.seeds])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]
        self.bits = np.zeros(1 << 20, bool)  # most windows of a corpus fail here
        self.bits[(flat >> np.uint64(44)).astype(np.int64)] = True

    def leaks(self, texts: list[str], threshold: float) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, tokens of the item, covered, tiles) for each leak."""
        h, bounds = tokens(texts)
        s = seeds(h)
        maybe = np.flatnonzero(self.bits[(s >> np.uint64(44)).astype(np.int64)])
        if not len(maybe) or not len(self.flat):
            return
        at = np.searchsorted(self.flat, s[maybe])
        maybe = maybe[self.flat[np.minimum(at, len(self.flat) - 1)] == s[maybe]]
        text = np.searchsorted(bounds, maybe, "right") - 1
        maybe, text = maybe[maybe + WORDS <= bounds[text + 1]], text[maybe + WORDS <= bounds[text + 1]]
        for t in np.unique(text):
            own = np.unique(s[maybe[text == t]])
            lo, hi = np.searchsorted(self.flat, own, "left"), np.searchsorted(self.flat, own, "right")
            items = np.unique(np.concatenate([self.owner[a:b] for a, b in zip(lo, hi, strict=True)]))
            doc = h[bounds[t] : bounds[t + 1]]
            doc_seeds = s[bounds[t] : bounds[t + 1] - WORDS + 1]
            for i in items:
                # Tokens that no shared window holds can be in no tile, so this many is the most that can be covered.
                shared = np.isin(self.seeds[i], own)
                most = int((np.convolve(shared, np.ones(WORDS)) > 0).sum())
                if most < threshold * len(self.items[i]):
                    continue
                tiles = tile(doc, self.items[i], doc_seeds, self.seeds[i])
                covered = sum(x[2] for x in tiles)
                if covered >= threshold * len(self.items[i]):
                    yield int(t), int(i), len(self.items[i]), covered, len(tiles)


def small_benchmark(benchmark: DataFrame, id_col: str, text_col: str, most: int = BROADCAST_SEEDS) -> Benchmark | None:
    """The benchmark, or None where it has more than `most` tokens (reading stops there)."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(id_col, text_col).toLocalIterator():
        size += len(tokens([r[1]])[0]) if r[1] else 0
        if size > most:
            return None
        ids.append(r[0])
        texts.append(r[1] or "")
    return Benchmark(ids, texts)


_FOUND = "n_tokens bigint, n_covered bigint, n_tiles bigint"


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(F.encode(text_col, "UTF-8"), 256))


def _leaked_texts(docs: DataFrame, benchmark: DataFrame, threshold: float, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """digest, item_id, n_tokens, n_covered, n_tiles for a benchmark that is too large to be sent to the workers: distinct texts'
    and items' seeds are joined, pairs that share enough are joined to both texts and tiled."""
    texts = snapshot(docs.filter(F.col(text_col).isNotNull()).select(_digest(text_col).alias("digest"), F.col(text_col).alias("t")).groupBy("digest").agg(F.first("t").alias("t")))
    items = snapshot(benchmark.filter(F.col(item_text).isNotNull()).select(F.monotonically_increasing_id().alias("no"), F.col(item_col).alias("item_id"), F.col(item_text).alias("t")))

    def seeds_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in slices(b.column(1).to_pylist()):
                h, bounds = tokens(part)
                own = [np.unique(seeds(h[bounds[i] : bounds[i + 1]]), return_counts=True) for i in range(len(part))]
                key = b.column(0).slice(at, len(part)).take(pa.array(np.repeat(np.arange(len(part)), [len(x) for x, _ in own])))
                at += len(part)
                flat = [np.concatenate([*(x[k] for x in own), np.empty(0, kind)]) for k, kind in ((0, np.uint64), (1, np.int64))]
                n = np.repeat(np.diff(bounds), [len(x) for x, _ in own])
                yield pa.RecordBatch.from_arrays([key, pa.array(flat[0].view(np.int64)), pa.array(flat[1]), pa.array(n.astype(np.int64))], ["key", "seed", "c", "n"])

    of_items = items.select("no", "t").mapInArrow(seeds_of, "key bigint, seed bigint, c bigint, n bigint").select(F.col("key").alias("no"), "seed", "c", "n")
    of_texts = snapshot(texts.mapInArrow(seeds_of, "key binary, seed bigint, c bigint, n bigint").select(F.col("key").alias("digest"), "seed"))
    shared = spread_join(of_texts, of_items, "seed").groupBy("digest", "no").agg(F.sum("c").alias("c"), F.first("n").alias("n"))
    pairs = snapshot(shared.filter(WORDS * F.col("c") >= threshold * F.col("n")).select("digest", "no"))
    both = spread_join(spread_join(pairs, texts, "digest").withColumnRenamed("t", "doc"), items, "no", row=F.xxhash64("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, (doc, item) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
                rows += [(i, n, c, k) for _, _, n, c, k in Benchmark([0], [item]).leaks([doc], threshold)]
            i, *counts = [list(x) for x in zip(*rows, strict=True)] or [[]] * 4
            keys = [b.column(k).take(pa.array(i, pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(x, pa.int64()) for x in counts)], ["digest", "item_id", "n_tokens", "n_covered", "n_tiles"])

    kind = benchmark.schema[item_col].dataType.simpleString()
    return both.select("digest", "item_id", "doc", "t").mapInArrow(run, f"digest binary, item_id {kind}, {_FOUND}")


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = BROADCAST_SEEDS) -> DataFrame:
    """doc_id, item_id, n_tokens (the item's), n_covered, n_tiles, coverage: one row for each document and item leaked into it."""
    spark = docs.sparkSession
    small_batches(spark)
    out = ["doc_id", "item_id", "n_tokens", "n_covered", "n_tiles", (F.col("n_covered") / F.col("n_tokens")).alias("coverage")]
    own = small_benchmark(benchmark, item_col, item_text, most)
    if own is None:
        rows = snapshot(docs.select(F.col(id_col).alias("doc_id"), _digest(text_col).alias("digest")))
        return spread_join(rows, _leaked_texts(docs, benchmark, threshold, text_col, item_col, item_text), "digest").select(*out)
    sent = spark.sparkContext.broadcast(own)  # at most `most` seeds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            at = 0
            for texts in slices(b.column(1).to_pylist()):
                rows = [(at + t, own.ids[i], n, c, k) for t, i, n, c, k in own.leaks(texts, threshold)]
                at += len(texts)
                if rows:
                    i, *cols = [list(x) for x in zip(*rows, strict=True)]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(i)), *(pa.array(c, f.type) for c, f in zip(cols, list(arrow)[1:], strict=True))], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {benchmark.schema[item_col].dataType.simpleString()}, {_FOUND}"
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).filter(F.col("t").isNotNull())
    return src.mapInArrow(run, schema).select(*out)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = BROADCAST_SEEDS) -> DataFrame:
    """docs without those that an item has leaked into; rows pass whole, without a join where the benchmark can be sent."""
    small_batches(docs.sparkSession)
    own = small_benchmark(benchmark, item_col, item_text, most)
    if own is None:
        bad = _leaked_texts(docs, benchmark, threshold, text_col, item_col, item_text).select(F.col("digest").alias("__digest")).distinct().withColumn("__bad", F.lit(True))
        rows = snapshot(docs.select(_digest(text_col).alias("__digest"), F.struct(*docs.columns).alias("__row")))
        return spread_join(rows, bad, "__digest", "left").filter(F.col("__bad").isNull()).select("__row.*")
    at = docs.columns.index(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, n = np.ones(b.num_rows, bool), 0
            for texts in slices([t or "" for t in b.column(at).to_pylist()]):
                for t, *_ in sent.value.leaks(texts, threshold):
                    keep[n + t] = False
                n += len(texts)
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
