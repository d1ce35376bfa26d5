"""Token counts through a cache of content digests.

A text's key is the SHA-256 of its normalised content (null as empty, UTF-8) with the digest of the tokenizer's file. Counts
known under such keys are joined; of the rest each distinct text is encoded once and its count appended to the cache, a
Parquet table in a folder that executors share. The count is the library's: a text is split into its pieces in numpy, and
each distinct piece's count is asked of the library once per worker; a text with a special token's string or with code
points that libraries may class in different ways goes to the library whole.

Null or empty text has 0 tokens. Repeated rows, and rows with one id and different texts, are returned one by one, equal
texts counted once. A digest that the cache holds several times counts once. A very long text is encoded whole, as one slice.
There are no ties to break. An empty table gives an empty result. Extra columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretok
from .bpe import slices
from .common import shared_path, small_batches, snapshot, spread_join, whole_text

OVER = 1024
#: Up to this many missing digests (32 bytes each) are broadcast to pick their texts out; more go by a shuffle.
BROADCAST_MISSES = 200_000
CACHE_BITS = 22
CACHE_SCHEMA = "version string, digest binary, n_tokens bigint"


class Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.no_truncation()
        self.t.no_padding()
        self.special = [x.content for x in self.t.get_added_tokens_decoder().values()]
        self.known, self.counts = pretok.Known(CACHE_BITS), np.empty(0, np.int64)

    def library(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, pieces: list[str]) -> np.ndarray:
        """Counts of pieces, a few thousand to a call of the library."""
        out = np.zeros(len(pieces), np.int64)
        for a in range(0, len(pieces), 4096):
            part = pieces[a : a + 4096]
            ids = self.t.encode(part, is_pretokenized=True, add_special_tokens=False).word_ids
            out[a : a + len(part)] = np.bincount(np.array(ids, np.int64), minlength=len(part))
        return out

    def count(self, texts: list[str]) -> list[int]:
        p = pretok.split(texts)
        total = np.zeros(len(texts), np.int64)
        if len(p.starts):
            number, first, anew = pretok.numbered(self.known, pretok.span_hashes(p.cps, p.starts, p.ends))
            if anew:
                self.counts = np.empty(0, np.int64)
            if len(first):
                words = [p.cps[a:b].tobytes().decode("utf-32-le") for a, b in zip(p.starts[first], p.ends[first], strict=True)]
                self.counts = np.concatenate([self.counts, self.words(words)])
            n = self.counts[number]
            total = np.bincount(p.doc, weights=n, minlength=len(texts)).astype(np.int64)
        out = total.tolist()
        for i, t in enumerate(texts):
            if p.unsure[i] or any(s in t for s in self.special):
                out[i] = self.library([t])[0]
        return out


_counters: dict[str, Counter] = {}


def file_version(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _encode(missing: DataFrame, path: str, version: str) -> DataFrame:
    small_batches(missing.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path)
        for b in batches:
            n = [x for part in slices(b.column(1).to_pylist()) for x in _counters[path].count(part)]
            yield pa.RecordBatch.from_arrays([pa.array([version] * len(n), pa.string()), b.column(0), pa.array(n, pa.int64())], ["version", "digest", "n_tokens"])

    return missing.select("digest", "t").mapInArrow(run, CACHE_SCHEMA)


def token_counts(docs: DataFrame, path: str, cache: str | None = None, limit: int = OVER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit. cache: the folder of the cache table; a new one in the shared folder if None."""
    spark = docs.sparkSession
    version = file_version(path)
    known = None
    if cache is None:
        cache = shared_path(spark, "token-counts")
    else:
        at = spark._jvm.org.apache.hadoop.fs.Path(cache)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version).select("digest")
    t = whole_text(text_col)
    src = docs.select(docs[id_col].alias("doc_id"), t.alias("t"), F.unhex(F.sha2(F.encode(t, "UTF-8"), 256)).alias("digest"))
    texts = src.select("digest", "t")
    if known is None:
        missing = texts.dropDuplicates(["digest"])
    else:
        lacking = texts.select("digest").distinct().join(known, "digest", "left_anti")
        if lacking.limit(BROADCAST_MISSES + 1).count() <= BROADCAST_MISSES:
            missing = texts.join(F.broadcast(lacking), "digest", "left_semi").dropDuplicates(["digest"])
        else:
            missing = texts.dropDuplicates(["digest"]).join(known, "digest", "left_anti")
    _encode(missing, path, version).write.mode("append").parquet(cache)
    # Two runs at once may append one digest each, with one and the same count.
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("version") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    rows = snapshot(src.select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"), "digest"))
    return spread_join(rows, counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
