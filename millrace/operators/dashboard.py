"""Queries of the dashboard over articles. as_of stands for now."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import rounded


def _within(name: str, value, low, high):
    if not low <= value <= high:
        raise ValueError(f"{name} must be from {low} to {high}")
    return value


def summary(articles: DataFrame, as_of: Column) -> DataFrame:
    recent = F.col("crawled_at") >= as_of - F.expr("INTERVAL 24 HOURS")
    return articles.agg(F.count("*").alias("total"), F.countDistinct("language").alias("languages"), F.count_if(recent).alias("last_24h"))


def distribution(articles: DataFrame, column: str) -> DataFrame:
    """Counts by a column, the largest first; null is a group."""
    return articles.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def daily(articles: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Counts by day of the last days; days without articles are left out."""
    _within("days", days, 1, 365)
    recent = articles.filter(F.col("crawled_at") >= as_of - F.make_dt_interval(F.lit(days)))
    return recent.groupBy(F.to_date("crawled_at").alias("day")).agg(F.count("*").alias("n")).orderBy("day")


def recent(samples: DataFrame, as_of: Column, hours: int, ts: str = "taken_at") -> DataFrame:
    """Samples of the last hours (1 to 168; more or less is taken as the nearest of these), in order of time."""
    hours = max(1, min(168, hours))
    return samples.filter(F.col(ts) >= as_of - F.make_dt_interval(F.lit(0), F.lit(hours))).orderBy(ts)


def matching(articles: DataFrame, lang: str | None = None, q: str | None = None, source: str | None = None) -> DataFrame:
    out = articles
    if lang:
        out = out.filter(F.col("language") == lang)
    if source:
        out = out.filter(F.col("source_type") == source)
    if q:
        out = out.filter(F.col("url").ilike(f"%{q}%") | F.col("content_md").ilike(f"%{q}%"))
    return out


def page(articles: DataFrame, number: int = 1, size: int = 20, **filters) -> DataFrame:
    """A page of matching articles, newest first, with a preview."""
    _within("page", number, 1, 10**9)
    _within("page_size", size, 1, 100)
    cols = ["id", "url", "source_type", "language", F.length("content_md").alias("content_len"), F.left("content_md", F.lit(300)).alias("preview")]
    return matching(articles, **filters).orderBy(F.desc("id")).offset((number - 1) * size).limit(size).select(*cols)


def total(articles: DataFrame, size: int = 20, **filters) -> DataFrame:
    """How many match, and on how many pages."""
    n = F.count("*")
    return matching(articles, **filters).agg(n.alias("total"), F.greatest(F.lit(1), F.ceil(n / size)).cast("long").alias("pages"))


def detail(articles: DataFrame, article_id: int) -> DataFrame:
    return articles.filter(F.col("id") == article_id)


def corpus(articles: DataFrame, min_len: int = 200, min_score: float = 0.0, lang: str | None = None, limit: int = 0) -> DataFrame:
    """Articles to export, by id. A score bound drops articles without a score."""
    out = articles.filter(F.col("content_md").isNotNull() & (F.length("content_md") >= min_len))
    if min_score > 0:
        out = out.filter(F.col("quality_score") >= min_score)
    if lang:
        out = out.filter(F.col("language") == lang)
    out = out.orderBy("id")
    return out.limit(limit) if limit else out


def as_json(df: DataFrame, cols: list[str]) -> DataFrame:
    """One JSON line a row; signs outside ASCII stay as they are, nulls too."""
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def top_k(vectors: DataFrame, query: list[float], k: int = 8, where: Column | None = None, id_col: str = "chunk_id") -> DataFrame:
    """The k rows of greatest cosine similarity, exactly, with score to four places (ties by id)."""
    from ..functions.scalars import cosine

    _within("k", k, 1, 32)
    out = vectors if where is None else vectors.filter(where)
    scored = out.withColumn("raw", cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query])))
    return scored.withColumn("score", rounded(F.col("raw"), 4)).orderBy(F.desc("score"), id_col).limit(k).drop("raw", "embedding")


def top_k_many(vectors: DataFrame, queries: DataFrame, k: int = 8, id_col: str = "chunk_id", query_col: str = "query_id", part: int = 4096) -> DataFrame:
    """query_id, the vectors' columns but the embedding, and score: for each query (query_id, embedding) the k rows of greatest
    cosine similarity, exactly, to four places (ties by id). Vectors of length 0 are never found.

    Queries go to the workers in blocks of `part`, one pass over the vectors each. A task keeps for each query only rows that
    are at least as near as the k-th of a batch it has seen, so little is shuffled.
    """
    from itertools import batched

    import numpy as np
    import pyarrow as pa
    from pyspark.sql import Window

    _within("k", k, 1, 32)
    other = [c for c in vectors.columns if c != "embedding"]
    kind = queries.schema[query_col].dataType.simpleString()
    schema = f"{query_col} {kind}, " + ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in other) + ", score double"

    def unit(x: np.ndarray) -> np.ndarray:
        n = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, n, out=np.full_like(x, np.nan), where=n > 0)

    def near(rows) -> DataFrame:
        sent = vectors.sparkSession.sparkContext.broadcast(([r[0] for r in rows], unit(np.array([r[1] for r in rows], np.float64))))

        def run(batches):
            ids, q = sent.value
            least = np.full(len(ids), -np.inf)
            for b in batches:
                own = [i for i, v in enumerate(b.column(len(other)).to_pylist()) if v is not None]
                if not own:
                    continue
                e = unit(np.array(b.column(len(other)).take(pa.array(own)).to_pylist(), np.float64))
                score = np.nan_to_num(np.floor((q @ e.T) * 1e4 + 0.5) / 1e4, nan=-np.inf)
                if len(own) >= k:
                    least = np.maximum(least, np.partition(score, len(own) - k, axis=1)[:, len(own) - k])
                at, row = np.nonzero((score >= least[:, None]) & (score > -np.inf))
                take = pa.array(np.array(own)[row])
                yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in at]), *(b.column(c).take(take) for c in range(len(other))), pa.array(score[at, row])], [query_col, *other, "score"])

        return vectors.select(*other, "embedding").mapInArrow(run, schema)

    out = None
    for rows in batched(queries.select(query_col, "embedding").filter("embedding IS NOT NULL").toLocalIterator(), part):
        out = near(rows) if out is None else out.unionByName(near(rows))
    if out is None:
        return vectors.sparkSession.createDataFrame([], schema)
    w = Window.partitionBy(query_col).orderBy(F.desc("score"), id_col)
    return out.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= k).drop("__n")
