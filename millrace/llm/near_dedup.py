"""Near-duplicate groups through HyperMinHash signatures, confirmed on full shingle sets.

A document's set holds its distinct runs of ``words`` words (A-Z lower-cased; with fewer words all of them as one). Documents
with one and the same set are one node. Each node has ``BANDS * ROWS`` registers: the least value of a hash function over the
set, kept as its number of leading zeros and ten mantissa bits. Nodes that agree in all registers of a band share a bucket.
Two documents of similarity 0.8 share no bucket with a probability of 1.3e-7, less above.

1. In a bucket all members are compared with one hub (the least id): an estimate from the last bit of each register (corrected
   for bits that agree by chance) drops what is clearly too far, then the full sets are compared: a hub's set goes once to each
   task that compares some of its members. Links make components.
2. A bucket all of whose members are in one component is done. Members of the others are gathered by their hub and compared
   across components, exactly: a hub's members are dealt into blocks of bounded size, a task takes two blocks and counts the
   shared shingles of all its pairs by matrix products, and only what joins two components comes out, as stars. Members of
   the hub's largest component aren't compared with each other. So no link within a bucket is left out.

Buckets, hubs and sets that many rows have are counted first and dealt over several tasks; nothing is left out for its size.

Documents without words or text are linked with nothing, and so are rows without an id (their component is null, they are
kept). Repeated rows fall into one component and keep their rows, as do rows of one id with different texts, whose links
all count for that id. Very long texts are compared whole. Of a group the least id stays; of rows with one id that stays, the
filter keeps one, the least by its text. An empty table gives an empty result. Extra columns, whatever their names, are left
out of the report and kept by the filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretok
from .bpe import slices, spread
from .common import hot_keys, small_batches, snapshot, spread_join, whole_text

BANDS, ROWS, MANTISSA = 40, 5, 10
REGISTERS = BANDS * ROWS
#: The last bits of registers of different minima agree as often as this.
COLLIDE = 0.5
#: Estimates this far below the threshold are not compared (six standard deviations for a pair at 0.8); None compares all pairs.
SLACK = 0.25
SKETCH = ["s0", "s1", "s2", "s3"]
#: A hub's members are dealt into blocks of a sixteenth of their shingles, but no fewer and no more shingles than this.
BLOCK = (20_000, 400_000)
SALTS = 16
#: A hub's members are compared in parts of about as many shingles, and members, as this.
PART = (1_000_000, 256)
#: Columns of the dense matrices whose product counts shared shingles.
COLUMNS = 2048
#: Up to this many ids (8 bytes each) are broadcast to pick texts out; more go by a shuffle.
BROADCAST_IDS = 500_000
_SEEDS = np.random.default_rng(20240501).integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    data = [t.encode().lower() for t in texts]
    raw = np.frombuffer(b" ".join([*data, b""]), np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff((~blank).astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = pretok.span_hashes(raw, starts, ends)
    bounds = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])]))
    n = max(0, len(h) - words + 1)
    grams = np.full(n, np.uint64(words))
    for i in range(words):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
    grams = pretok.mix(grams)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            g = np.full(1, np.uint64(b - a))
            for x in h[a:b]:
                g = g * np.uint64(0x9E3779B97F4A7C15) + x
            out.append(pretok.mix(g))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a set: leading zeros and mantissa of each hash function's minimum."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for a in range(0, len(x), 256):
        np.minimum(least, np.multiply.outer(x[a : a + 256], _SEEDS).min(axis=0), out=least)
    f, e = np.frexp(least.astype(np.float64))
    zeros = (32 - e).astype(np.uint16)
    zeros[least == 0] = 33
    mantissa = np.where(least > 0, (2 * f - 1) * 2**MANTISSA, 0).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | mantissa


def sketch(r: np.ndarray) -> list[int]:
    """The registers' last bits in four 64-bit integers."""
    bits = np.zeros(256, np.uint8)
    bits[: len(r)] = r & np.uint16(1)
    return np.packbits(bits).view(np.int64).tolist()


def band_keys(r: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band's number and registers."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in r.reshape(BANDS, ROWS).T:
        key = pretok.mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return key.view(np.int64)


def may_link(percent: int, slack: float | None, of: str = "", other: str = "o"):
    """Whether sizes and sketches of two nodes (columns n, s0.. and on, with suffixes) allow a similarity of percent."""
    n, m = F.col(f"n{of}"), F.col(f"n{other}")
    sizes = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    if slack is None:
        return sizes
    apart = sum((F.bit_count(F.col(f"{c}{of}").bitwiseXOR(F.col(f"{c}{other}"))) for c in SKETCH), F.lit(0))
    return sizes & ((1 - apart / REGISTERS - COLLIDE) / (1 - COLLIDE) >= percent / 100 - slack)


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest (of the whole set), bands (keys), s0 to s3 (the sketch)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digest, bands, bits = [], [], [], []
            for part in slices(b.column(1).to_pylist()):
                for s in shingle_sets(part, words):
                    r = registers(s) if len(s) else None
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    bands.append(band_keys(r) if len(s) else None)
                    bits.append(sketch(r) if len(s) else [None] * 4)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, pa.list_(pa.int64())), *[pa.array([x[k] for x in bits], pa.int64()) for k in range(4)]]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "digest", "bands", *SKETCH])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, n_shingles bigint, digest binary, bands array<bigint>, " + ", ".join(f"{c} bigint" for c in SKETCH))


def _sets(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """node, shingles (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [s.tobytes() for part in slices(b.column(1).to_pylist()) for s in shingle_sets(part, words)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("node"), whole_text(text_col).alias("t")).mapInArrow(run, f"node {kind}, shingles binary")


def _sets_of(nodes: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """node, shingles of the given nodes; texts are read for these only."""
    wanted = snapshot(nodes.toDF(id_col))
    few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return snapshot(_sets(docs.join(F.broadcast(wanted) if few else wanted, id_col, "left_semi"), words, id_col, text_col))


def _keep_near(star: DataFrame, nodes: DataFrame, percent: int, slack: float | None) -> DataFrame:
    """Pairs (a, b) that their sizes and sketches don't rule out, with the size of b's set. A node is b in few pairs; it may be
    a in many."""
    x = nodes.select("node", "n", *SKETCH)
    pairs = spread_join(star, x.toDF("a", *[f"{c}a" for c in ("n", *SKETCH)]), "a")
    pairs = pairs.join(x.toDF("b", *[f"{c}b" for c in ("n", *SKETCH)]), "b")
    return pairs.filter(may_link(percent, slack, "a", "b")).select("a", "b", F.col("nb").alias("n"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of (a, b, n) whose full sets have a similarity of percent or more.

    A hub's members go to as many parts as their shingles ask for. Each part is a sorted run of rows: the hub's set, then its
    members' sets, which a task reads one after the other.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    weight = pairs.groupBy("a").agg(F.sum("n").alias("n"), F.count("*").alias("c"))
    total = weight.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    most = [max(x, t // 20_000) for x, t in zip(PART, total, strict=True)]
    k = F.greatest(*[F.ceil(F.col(c) / m) for c, m in zip("nc", most, strict=True)]).cast("int")
    parts = snapshot(weight.select("a", k.alias("k")).filter("k > 1"))  # under 40,000 hubs
    dealt = pairs.join(F.broadcast(parts), "a", "left").withColumn("part", F.pmod(F.xxhash64("b"), F.coalesce("k", F.lit(1))).cast("int"))
    members = dealt.select("a", "part", "b").join(sets.toDF("b", "x"), "b").select("a", "part", F.lit(1).alias("kind"), "b", "x")
    hubs = pairs.select("a").distinct().join(F.broadcast(parts), "a", "left").join(sets.toDF("a", "x"), "a")
    hubs = hubs.select("a", F.explode(F.sequence(F.lit(0), F.coalesce("k", F.lit(1)) - 1)).alias("part"), F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("b"), "x")

    def near(x: np.ndarray, y: np.ndarray) -> bool:
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        both = int((y[at] == x).sum())
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, begun = [], False  # rows of one id with different texts make several sets
        for t in batches:
            keep = []
            for is_member, x in zip(t.column(2).to_pylist(), t.column(4), strict=True):
                x = np.frombuffer(x.as_py(), np.uint64)
                if not is_member:
                    hub = [x] if begun else [*hub, x]
                    keep.append(False)
                else:
                    keep.append(any(near(h, x) for h in hub))
                begun = bool(is_member)
            yield pa.RecordBatch.from_arrays([t.column(0), t.column(3)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    runs = hubs.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", "kind")
    return runs.mapInArrow(run, f"a {kind}, b {kind}")


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """How many elements each of xs shares with each of ys (sets of 64-bit numbers)."""
    out = np.zeros((len(xs), len(ys)), np.float32)
    own = [(np.repeat(np.arange(len(s)), [len(v) for v in s]), np.concatenate([*s, np.empty(0, np.uint64)])) for s in (xs, ys)]
    common = np.intersect1d(own[0][1], own[1][1])
    if not len(common):
        return out
    sides = []
    for row, v in own:
        col = np.minimum(np.searchsorted(common, v), len(common) - 1)
        hit = common[col] == v
        order = np.argsort(col[hit], kind="stable")
        sides.append((row[hit][order], col[hit][order]))
    (rx, cx), (ry, cy) = sides
    nx, ny = np.bincount(cx, minlength=len(common)), np.bincount(cy, minlength=len(common))
    # Elements that many hold go through dense products, others pair by pair.
    dense = nx * ny * 50 > out.size
    number = np.cumsum(dense) - 1
    for a in range(0, int(dense.sum()), COLUMNS):
        part = []
        for row, col, n in ((rx, cx, len(xs)), (ry, cy, len(ys))):
            some = dense[col] & (number[col] >= a) & (number[col] < a + COLUMNS)
            m = np.zeros((n, COLUMNS), np.float32)
            m[row[some], number[col[some]] - a] = 1
            part.append(m)
        out += part[0] @ part[1].T
    starts = np.cumsum(ny) - ny
    rare = np.flatnonzero(~dense[cx])
    bounds = np.cumsum(ny[cx[rare]])
    for a in range(0, int(bounds[-1]) if len(bounds) else 0, 4_000_000):
        some = rare[np.searchsorted(bounds, a, "right") : np.searchsorted(bounds, a + 4_000_000, "right")]
        n = ny[cx[some]]
        other = ry[spread(starts[cx[some]], n)]
        np.add.at(out.reshape(-1), np.repeat(rx[some], n) * len(ys) + other, 1)
    return out


def joined(xs, ys, labels_x: np.ndarray, labels_y: np.ndarray, percent: int) -> np.ndarray:
    """Of two blocks of sets the links between different labels, as stars: (first, other) places; ys count on after xs."""
    size = [np.array([len(v) for v in s], np.float64) for s in (xs, ys)]
    both = overlaps(xs, ys).astype(np.float64)
    link = (100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)) & (labels_x[:, None] != labels_y[None, :])
    first_x, first_y = np.arange(len(xs)), np.arange(len(xs), len(xs) + len(ys))
    if not link.any():
        return np.empty((0, 2), np.int64)
    while True:
        none = len(xs) + len(ys)
        new_y = np.minimum(first_y, np.where(link, first_x[:, None], none).min(axis=0))
        new_x = np.minimum(first_x, np.where(link, new_y[None, :], none).min(axis=1))
        if (new_x == first_x).all() and (new_y == first_y).all():
            break
        first_x, first_y = new_x, new_y
    first = np.concatenate([first_x, first_y])
    other = np.flatnonzero(first != np.arange(len(first)))
    return np.column_stack([first[other], other])


def _across(members: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, hot: DataFrame) -> DataFrame:
    """Links (a, b) between components of nodes that share a bucket of several components; enough of them to join all that
    are linked. hot: the buckets of many members."""
    kind = nodes.schema["node"].dataType.simpleString()
    left = members.filter("size > 2").select("key", "hub", "node").join(labels, "node", "left")
    left = snapshot(left.select("key", "hub", "node", F.coalesce("label", "node").alias("label")))
    several = left.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key")
    weight = nodes.groupBy("node").agg(F.sum("n").alias("n"))
    group = snapshot(spread_join(left, several, "key", hot=hot).select("hub", "node", "label").distinct().join(weight, "node"))
    sizes = group.groupBy("hub", "label").agg(F.count("*").alias("k"), F.sum("n").alias("t"))
    hubs = sizes.groupBy("hub").agg(F.max(F.struct("k", "label", "t")).alias("m"), F.sum("t").alias("t"))
    block = F.least(F.greatest(F.col("t") / 16, F.lit(BLOCK[0])), F.lit(BLOCK[1]))
    hubs = hubs.select("hub", F.col("m.label").alias("main"), F.ceil((F.col("t") - F.col("m.t")) / block).cast("int").alias("no"), F.ceil(F.col("m.t") / block).cast("int").alias("ni"))
    # A hub may hold a large part of all rows: its rows are dealt over this many join keys.
    hubs = hubs.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = group.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(hubs, ["hub", "salt"]).withColumn("in", F.col("label") == F.col("main"))
    number = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    rows = rows.withColumn("b", F.when(F.col("in"), F.col("no") + number("ni")).otherwise(number("no")))
    rows = rows.withColumn("c", F.explode(F.sequence(F.lit(0), F.when(F.col("in"), F.col("no") - 1).otherwise(F.col("no") + F.col("ni") - 1))))
    cells = rows.select("node", "hub", F.least("b", "c").alias("i"), F.greatest("b", "c").alias("j"), "b", "label").join(sets, "node")

    def run(t: pa.Table) -> pa.Table:
        i, j = (t.column(k)[0].as_py() for k in ("i", "j"))
        ids, b, label = t.column("node").to_numpy(), t.column("b").to_numpy(), t.column("label").to_numpy()
        held = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        x, y = np.flatnonzero(b == i), np.flatnonzero(b == j)
        pairs = joined([held[k] for k in x], [held[k] for k in y], label[x], label[y], percent) if len(x) and len(y) else np.empty((0, 2), np.int64)
        at = np.concatenate([x, y])
        return pa.table({k: pa.array(ids[at[pairs[:, n]]], t.schema.field("node").type) for n, k in enumerate("ab")})

    return cells.groupBy("hub", "i", "j").applyInArrow(run, f"a {kind}, b {kind}")


def components(edges: DataFrame, most_levels: int = 60) -> DataFrame:
    """node, label: the least node reachable, for all nodes of the edges (a, b).

    Each level maps every node to the first of itself and its neighbours, rewrites the edges to what their ends are mapped to
    and goes on with those that aren't loops; stars are done after one level. The first levels take the least node as first;
    later ones the least hash, under which the nodes fall by a constant factor on any graph (chains too). Groupings are
    combined before their shuffle, nothing is collected, and each level is written to the shared folder.
    """
    maps, rest, hashed = [], edges.select("a", "b"), False
    for level in range(most_levels):
        hashed = level >= 3
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if hashed:
            first = F.min(F.struct(F.xxhash64("b", F.lit(level)).alias("h"), F.col("b").alias("x")))
            own = F.struct(F.xxhash64("a", F.lit(level)).alias("h"), F.col("a").alias("x"))
            to = both.groupBy("a").agg(first.alias("f")).select("a", F.least(own, "f")["x"].alias("m"))
        else:
            to = both.groupBy("a").agg(F.min("b").alias("f")).select("a", F.least("a", "f").alias("m"))
        to = snapshot(to)
        maps.append(to)
        rest = rest.join(to, "a").select(F.col("m").alias("x"), "b").join(to.toDF("b", "n"), "b").filter("x <> n")
        rest = snapshot(rest.select(F.least("x", "n").alias("a"), F.greatest("x", "n").alias("b")).distinct())
        if not rest.limit(1).count():
            break
    else:
        raise RuntimeError(f"components are not done after {most_levels} levels")
    labels = maps[-1].toDF("node", "label")
    for to in maps[-2::-1]:
        labels = to.join(labels.toDF("m", "l"), "m", "left").select(F.col("a").alias("node"), F.coalesce("l", "m").alias("label"))
    if len(maps) > 3:  # the last ones' labels are any node of their component
        least = labels.groupBy("label").agg(F.min("node").alias("least"))
        labels = labels.join(least, "label").select("node", F.least("label", "least").alias("label"))
    return snapshot(labels)


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after further links: components of the labels that the links join, not of all nodes again."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = snapshot(labels.join(ends, "node", "full_outer").select("node", F.coalesce("label", "node").alias("label")))
    up = links.join(known.toDF("a", "x"), "a").select("x", "b").join(known.toDF("b", "y"), "b").filter("x <> y")
    joined = components(up.select(F.col("x").alias("a"), F.col("y").alias("b"))).toDF("label", "new")
    return snapshot(known.join(joined, "label", "left").select("node", F.coalesce("new", "label").alias("label")))


def near_groups(docs: DataFrame, words: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", slack: float | None = SLACK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row."""
    rows = snapshot(signatures(docs, words, id_col, text_col))
    some = rows.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    nodes = snapshot(some.groupBy("digest").agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("bands", *SKETCH)], F.first("n_shingles").alias("n")))
    buckets = nodes.select("node", F.explode("bands").alias("key"))
    hubs = snapshot(buckets.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top"), F.count("*").alias("n")).filter("hub < top"))
    hot = hot_keys(hubs, "key", hubs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    members = snapshot(spread_join(buckets, hubs.select("key", "hub", F.col("n").alias("size")), "key", hot=hot, row=F.xxhash64("node")).select("key", "node", "hub", "size"))
    sets = _sets_of(members.select("node").distinct(), docs, words, id_col, text_col)
    star = snapshot(members.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    labels = components(snapshot(_confirm(snapshot(_keep_near(star, nodes, percent, slack)), sets, percent)))
    links = snapshot(_across(members, labels, nodes, sets, percent, hot))
    if links.limit(1).count():
        labels = _relabel(labels, links)
    found = nodes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("component"))
    own = snapshot(rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")))
    out = spread_join(own, found, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_first(docs: DataFrame, words: int = 4, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of the least id of each group, whole; of rows with one id one stays, rows without an id all do."""
    kept = near_groups(docs, words, percent, id_col, text_col).filter(F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(id_col))
    some = docs.filter(F.col(id_col).isNotNull()).join(kept.distinct(), id_col, "left_semi")
    some = some.groupBy(id_col).agg(F.min_by(F.struct(*docs.columns), F.struct(text_col)).alias("__row")).select("__row.*")
    return some.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))


def oracle_sql(words: int = 4, percent: int = 80) -> str:
    """DuckDB: pairs that share one of their rarest shingles, compared on full sets, and what is reachable."""
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, doc_id, unnest(CASE WHEN len(w) >= {words} THEN list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT rid, doc_id, count(*) AS n FROM s GROUP BY rid, doc_id),
rare AS (SELECT rid, doc_id, g, n, row_number() OVER (PARTITION BY rid ORDER BY f, g) AS r FROM s JOIN n USING (rid, doc_id) JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) USING (g) WHERE doc_id IS NOT NULL),
may AS (SELECT DISTINCT x.rid AS a, y.rid AS b, x.n AS na, y.n AS nb FROM rare x JOIN rare y ON x.g = y.g AND x.rid < y.rid AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)
        WHERE x.r <= x.n - ceil({percent} / 100.0 * x.n) + 1 AND y.r <= y.n - ceil({percent} / 100.0 * y.n) + 1),
common AS (SELECT a, b, na, nb, count(*) AS k FROM may JOIN s x ON x.rid = a JOIN s y ON y.rid = b AND y.g = x.g GROUP BY ALL),
e AS (SELECT x.doc_id AS a, y.doc_id AS b FROM common JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * k >= {percent} * (na + nb - k)),
edge AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(node, other) AS (SELECT a, b FROM edge UNION SELECT r.node, edge.b FROM reach r JOIN edge ON edge.a = r.other),
low AS (SELECT node, least(node, min(other)) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, d.doc_id IS NOT DISTINCT FROM coalesce(component_id, d.doc_id) AS kept
FROM d LEFT JOIN n ON n.rid = d.rid LEFT JOIN low ON low.node = d.doc_id
"""
