"""Exact and near duplicates: first wins, append if absent, fingerprint pairs, greedy order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fingerprint import block_keys, first_shared, hamming
from .store import shared_dir

#: Up to so many new fingerprints (20 keys each) are broadcast to an index, which then isn't shuffled.
BROADCAST_PROBES = 50_000


def first_wins(df: DataFrame, keys: list, order: list) -> DataFrame:
    """One row for each key: the first in the given order (a partial group limit runs before the shuffle)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def append_if_absent(new: DataFrame, store: DataFrame, key: str, order: list) -> DataFrame:
    """The rows of new to append: first by key, and not in the store."""
    return first_wins(new, [key], order).join(store.select(key).distinct(), key, "left_anti")


def near_pairs(prints: DataFrame, id_col: str = "id", most_bits: int = 3, parts: int | None = None) -> DataFrame:
    """a < b, distance: firsts of fingerprints within most_bits of each other; copies of a fingerprint are one node.

    Three flipped bits leave three of six blocks whole, so each pair shares a block key; the keys' buckets are thin.
    """
    nodes = prints.groupBy("simhash").agg(F.min(id_col).alias("id"))
    keyed = nodes.select("id", "simhash", F.inline(block_keys(F.col("simhash"), 3 + most_bits, 3))) if parts is None else _keyed(nodes, most_bits, parts)
    left, right = keyed.toDF("a", "ha", "no", "key"), keyed.toDF("b", "hb", "no", "key")
    first = first_shared(F.col("ha"), F.col("hb"), F.col("no"), 3 + most_bits, 3)
    near = left.join(right, ["no", "key"]).filter((F.col("a") < F.col("b")) & (hamming(F.col("ha"), F.col("hb")) <= most_bits) & first)
    return near.select("a", "b", hamming(F.col("ha"), F.col("hb")).alias("distance"))


def near_members(prints: DataFrame, pairs: DataFrame | None = None, id_col: str = "id", most_bits: int = 3, salts: int = 16) -> DataFrame:
    """id, representative, links: for each document the first of its fingerprint and how many pairs that one is in.

    With the pairs of near_pairs no link is lost: documents of one representative are at distance 0, and what holds for
    it holds for them. A fingerprint that many documents have is dealt over salts.
    """
    firsts = prints.groupBy("simhash").agg(F.min(id_col).alias("representative"))
    near = near_pairs(prints, id_col, most_bits) if pairs is None else pairs
    links = near.select(F.explode(F.array("a", "b")).alias("representative")).groupBy("representative").agg(F.count("*").alias("links"))
    known = firsts.join(links, "representative", "left").select("simhash", "representative", F.coalesce("links", F.lit(0)).alias("links"))
    known = known.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
    own = prints.select(id_col, "simhash", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("salt"))
    return own.join(known, ["simhash", "salt"]).select(id_col, "representative", "links")


def probe(new: DataFrame, index: DataFrame, id_col: str = "id", most_bits: int = 3) -> DataFrame:
    """Ids of new fingerprints within most_bits of an indexed one. A small batch goes to where the index is, a large one
    meets it in a shuffle."""
    few = new.limit(BROADCAST_PROBES + 1).count() <= BROADCAST_PROBES
    left = new.select(F.col(id_col), F.col("simhash").alias("h"), F.inline(block_keys(F.col("simhash"), 3 + most_bits, 3)))
    right = index.select(F.col("simhash").alias("o")).distinct().select("o", F.inline(block_keys(F.col("o"), 3 + most_bits, 3)))
    found = (F.broadcast(left) if few else left).join(right, ["no", "key"])
    return found.filter(hamming(F.col("h"), F.col("o")) <= most_bits).select(id_col).distinct()


def prefixes(firsts: DataFrame, first: int = 1000, times: int = 4, sample: int = 20_000) -> list[DataFrame]:
    """firsts in the order of id, cut into parts: each with all before it has some `times` as many rows as these. The cuts come from a sample of ids."""
    n = firsts.count()
    if n <= first * times:
        return [firsts]
    ids = [r["id"] for r in firsts.filter("id IS NOT NULL").sample(min(1.0, sample / n), 1).orderBy("id").select("id").collect()]
    ranks = [first]
    while ranks[-1] * times < n:
        ranks.append(ranks[-1] * times)
    cuts = sorted({ids[len(ids) * r // n] for r in ranks}) if ids else []
    out, at = [], F.lit(True)
    for cut in cuts:
        out.append(firsts.filter(at & (F.col("id") < F.lit(cut))))
        at = F.col("id") >= F.lit(cut)
    return [*out, firsts.filter(at | F.col("id").isNull())]


def _tasks(n: int) -> int:
    """Tasks for comparing so many fingerprints (20 keys each)."""
    return max(1, -(-n // 5_000))


def _keyed(prints: DataFrame, most_bits: int, parts: int) -> DataFrame:
    """id, simhash, no, key over so many tasks: the rows are small, what they are compared with isn't."""
    return prints.select("id", "simhash", F.inline(block_keys(F.col("simhash"), 3 + most_bits, 3))).repartition(parts, "no", "key")


def undropped(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes without those that a kept earlier one (a of a, b) is near.

    Rounds: an a without an earlier neighbour left is kept, so its bs go, with all their edges. Each round is written to the
    checkpoint folder and only edges between undecided nodes go on; the number of rounds is the longest chain of waiting.
    """
    edges, gone = edges.select("a", "b").checkpoint(), None
    while edges.limit(1).count():
        heads = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        now = heads.select("b").distinct().checkpoint()
        gone = now if gone is None else gone.union(now)
        edges = edges.join(now, "b", "left_anti").join(now.toDF("a"), "a", "left_anti").checkpoint()
    return nodes if gone is None else nodes.join(gone.toDF("id"), "id", "left_anti")


def greedy_keep(prints: DataFrame, pairs: DataFrame | None = None, id_col: str = "id", most_bits: int = 3) -> DataFrame:
    """Ids kept if documents arrive by id and one is dropped when a kept one is near: the first maximal independent set.

    Where no pairs are given, documents come in parts (prefixes). A part is compared with what earlier parts have kept, once,
    and pairs are made of what is left of it alone. As each part is a few times what came before, little is near
    each other in what is left: there are about as many pairs as documents, however many there are in all.
    """
    shared_dir(prints.sparkSession)
    firsts = prints.groupBy("simhash").agg(F.min(id_col).alias("id")).checkpoint()
    if pairs is not None:
        return undropped(firsts.select("id"), pairs).select(F.col("id").alias(id_col))
    kept, n_kept = None, 0
    for part in prefixes(firsts):
        if kept is not None:
            tasks = _tasks(part.count() + n_kept)
            had = _keyed(kept, most_bits, tasks).select(F.col("simhash").alias("o"), "no", "key")
            own = _keyed(part, most_bits, tasks).alias("n")
            near = own.join(had.alias("k"), F.expr("n.no = k.no AND n.key = k.key") & (hamming(F.col("simhash"), F.col("o")) <= most_bits), "left_semi")
            part = part.join(near.select("id").distinct(), "id", "left_anti").checkpoint()
        done = undropped(part, near_pairs(part, "id", most_bits, _tasks(part.count()))).select("id", "simhash").checkpoint()
        kept, n_kept = (done, done.count()) if kept is None else (kept.union(done), n_kept + done.count())
    return kept.select(F.col("id").alias(id_col))


def lsh_rows(prints: DataFrame, bands: list[Column], indexed_at: Column) -> DataFrame:
    """The index: band, bucket, simhash, indexed_at; one row for each band."""
    return prints.select(F.posexplode(F.array(*bands)).alias("band", "bucket"), "simhash", indexed_at.alias("indexed_at"))


def unexpired(index: DataFrame, as_of: Column, days: int | None) -> DataFrame:
    return index if days is None else index.filter(F.col("indexed_at") >= as_of - F.make_dt_interval(F.lit(days)))
