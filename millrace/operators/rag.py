"""Chunks of articles, their vectors, and search."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.markdown import posexploded, with_chunks
from ..functions.scalars import chunk_id, iso
from .dashboard import as_json
from .store import exists, last_wins, remove, replace, save_watermark, shared_dir, upsert, watermark

ARCHIVE = "chunk_id STRING, embedding ARRAY<FLOAT>, model STRING, dim INT"
CHUNK_LINE = (
    "chunk_id STRING, article_id BIGINT, url STRING, title STRING, heading_path ARRAY<STRING>, chunk_index INT, n_chunks INT, text STRING, "
    "tags ARRAY<STRING>, source_type STRING, language STRING, published_at TIMESTAMP, quality_score DOUBLE"
)


def chunks(articles: DataFrame, after_id: int = 0, target: int = 1200, overlap: int = 150, min_chars: int = 30) -> DataFrame:
    """Chunks of articles with a text and an id above after_id."""
    kept = ["url", "title", "tags", "source_type", "language", "published_at", "quality_score"]
    some = articles.filter((F.col("id") > after_id) & F.col("content_md").isNotNull()).select(F.col("id").alias("article_id"), *kept, "content_md")
    cut = posexploded(with_chunks(some, "content_md", target, overlap, min_chars), ["article_id", *kept])
    return cut.select(chunk_id(F.col("url"), F.col("chunk_index")).alias("chunk_id"), "article_id", "url", "title", "heading_path", "chunk_index", "n_chunks", "text", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "source_type", "language", "published_at", "quality_score")


def last_article(chunk_table: DataFrame) -> DataFrame:
    return chunk_table.agg(F.coalesce(F.max("article_id"), F.lit(0)).cast("long").alias("last_id"))


def to_embed(chunk_table: DataFrame, vectors: DataFrame) -> DataFrame:
    return chunk_table.join(vectors.select("chunk_id"), "chunk_id", "left_anti")


def hashed_words(texts: list[str], dim: int = 64) -> np.ndarray:
    """An embedder without a network: signed sums of hashed words, of length 1."""
    out = np.zeros((len(texts), dim), np.float32)
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
            out[i, h % dim] += 1 if h >> 63 else -1
    n = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(n == 0, 1, n)


def embed(chunk_table: DataFrame, embedder: Callable[[list[str]], np.ndarray] = hashed_words, batch: int = 32) -> DataFrame:
    """chunk_id, embedding; texts go to the embedder in batches. One that fails has a null vector."""

    def run(batches):
        for b in batches:
            ids, texts, out = b.column(0), b.column(1).to_pylist(), []
            for a in range(0, len(texts), batch):
                part = [t or "" for t in texts[a : a + batch]]
                try:
                    out += [list(map(float, v)) for v in embedder(part)]
                except (OSError, ValueError):
                    out += [None] * len(part)
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.list_(pa.float32()))], ["chunk_id", "embedding"])

    return chunk_table.select("chunk_id", "text").mapInArrow(run, "chunk_id string, embedding array<float>")


def in_request_order(answers: DataFrame) -> DataFrame:
    """request, vectors: an embedder's answers (request, index, vector) put in the order of what was asked. A request has
    as many as a batch has texts."""
    own = F.array_sort(F.collect_list(F.struct("index", "vector")))
    return answers.groupBy("request").agg(F.transform(own, lambda x: x["vector"]).alias("vectors"))


def embed_new(chunk_table: DataFrame, at: str, model: str, embedder: Callable[[list[str]], np.ndarray] = hashed_words, batch: int = 32) -> tuple[int, int]:
    """Embeds the chunks that the archive at `at` lacks: vectors are appended to it, ids that failed are listed beside it
    (a later call tries just those again). How many were embedded, and how many failed."""
    spark = chunk_table.sparkSession
    have = spark.read.schema(ARCHIVE).parquet(f"{at}/vectors") if exists(spark, f"{at}/vectors") else spark.createDataFrame([], ARCHIVE)
    run = f"{at}/run-{uuid.uuid4().hex}"
    embed(to_embed(chunk_table, have), embedder, batch).write.parquet(run)
    done = spark.read.parquet(run)
    ok = done.filter("embedding IS NOT NULL")
    ok.select("chunk_id", "embedding", F.lit(model).alias("model"), F.size("embedding").alias("dim")).write.mode("append").parquet(f"{at}/vectors")
    done.filter("embedding IS NULL").select("chunk_id").write.mode("overwrite").parquet(f"{at}/failed")
    n, failed = done.agg(F.count("embedding"), F.count_if(F.col("embedding").isNull())).first()
    remove(spark, run)
    return n, failed


CACHE = "digest STRING, embedding ARRAY<FLOAT>, model STRING, used_at TIMESTAMP"


def query_vectors(texts: DataFrame, at: str, model: str, embedder: Callable[[list[str]], np.ndarray] = hashed_words, most: int = 128) -> DataFrame:
    """text, embedding of each distinct text: taken from the cache at `at` where the model has embedded it before, else embedded
    once. The cache then holds what was used last, `most` at most; more texts than that are answered all the same."""
    spark = texts.sparkSession
    have = (spark.read.schema(CACHE).parquet(at) if exists(spark, at) else spark.createDataFrame([], CACHE)).filter(F.col("model") == model)
    asked = texts.select("text").filter("text IS NOT NULL").distinct().withColumn("digest", F.sha2("text", 256))
    new = embed(asked.join(have.select("digest"), "digest", "left_anti").select(F.col("digest").alias("chunk_id"), "text"), embedder)
    hits = have.select("digest", "embedding").join(asked.select("digest"), "digest", "left_semi")
    shared_dir(spark)
    found = hits.unionByName(new.filter("embedding IS NOT NULL").withColumnRenamed("chunk_id", "digest")).checkpoint()
    used = found.select("digest", "embedding", F.lit(model).alias("model"), F.current_timestamp().alias("used_at"))
    others = have.join(asked.select("digest"), "digest", "left_anti")
    replace(used.unionByName(others).orderBy(F.desc("used_at"), "digest").limit(most), at)
    return asked.join(found, "digest").select("text", "embedding")


def export_chunks(articles: DataFrame, out: str, state: str, full: bool = False, **cut) -> int:
    """Writes chunks as JSON lines: of all articles over what was there, or of those above the watermark in addition. The
    watermark is kept either way. The last article's id."""
    spark = articles.sparkSession
    last = 0 if full else watermark(spark, state)
    c = chunks(articles, last, **cut).withColumn("published_at", iso(F.col("published_at")))
    as_json(c, c.columns).write.mode("overwrite" if full else "append").text(out)
    top = articles.filter("content_md IS NOT NULL").agg(F.greatest(F.lit(last), F.coalesce(F.max("id"), F.lit(0)))).first()[0]
    save_watermark(spark, state, top)
    return top


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Exported chunks; of lines with one id the one of the highest article and then text counts."""
    rows = spark.read.schema(CHUNK_LINE).json(path).filter("chunk_id IS NOT NULL")
    return last_wins(rows, "chunk_id", ["article_id", "text"])


def with_vectors(chunk_table: DataFrame, vectors: DataFrame, order: list | None = None) -> DataFrame:
    """Chunks that have a vector; of chunks written twice the last one counts."""
    own = last_wins(chunk_table, "chunk_id", order) if order else chunk_table
    return own.join(vectors, "chunk_id")


def upsert_chunks(old: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(old, new, "chunk_id", ["text", "heading_path", "embedding"])


def search_filter(source: str | None = None, min_quality: float | None = None, since: Column | None = None) -> Column:
    out = F.lit(True)
    if source:
        out = out & (F.col("source_type") == source)
    if min_quality is not None:
        out = out & (F.col("quality_score") >= min_quality)
    return out if since is None else out & (F.col("published_at") >= since)


def batches_of(df: DataFrame, n: int, order: str) -> DataFrame:
    """The number of each row's batch of n, in an order within each source partition."""
    from pyspark.sql import Window

    return df.withColumn("batch", F.floor((F.row_number().over(Window.partitionBy("source_type").orderBy(order)) - 1) / n))
