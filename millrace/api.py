"""The store under one root, and all that the dashboard, the exports and the upkeep ask of it, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions.fingerprint import simhash_blake2b
from .functions.text import assess
from .operators import dashboard, monitor, qa, rag, store


class Corpus:
    """A store. as_of stands for now (a column), so that answers can be repeated."""

    def __init__(self, spark: SparkSession, root: str, as_of: Column | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.as_of = F.current_timestamp() if as_of is None else as_of

    def table(self, name: str) -> DataFrame:
        """A table as it is now; empty if nothing was written."""
        at = f"{self.root}/{name}"
        if not store.exists(self.spark, at):
            return schemas.empty(self.spark, name)
        return self.spark.read.schema(schemas.TABLES[name]).parquet(at)

    @property
    def articles(self) -> DataFrame:
        return self.table("articles")

    # What the dashboard shows

    def summary(self) -> DataFrame:
        return dashboard.summary(self.articles, self.as_of)

    def lang_dist(self) -> DataFrame:
        return dashboard.distribution(self.articles, "language")

    def source_dist(self) -> DataFrame:
        return dashboard.distribution(self.articles, "source_type")

    def daily(self, limit: int = 30) -> DataFrame:
        return dashboard.daily(self.articles, self.as_of, limit)

    def pipeline(self) -> DataFrame:
        return monitor.counters(self.table("outcomes"))

    def health(self, hours: int = 24, limits: dict[str, int] | None = None) -> dict[str, DataFrame]:
        """status of the sources' runs, overall, and the growth between the samples of the last hours."""
        status = monitor.run_status(self.table("runs"), self.as_of, limits or {})
        return {"status": status, "overall": monitor.overall(status), "series": monitor.snapshot_deltas(dashboard.recent(self.table("snapshots"), self.as_of, hours))}

    def search(self, q: str, k: int = 8, source: str | None = None, min_quality: float | None = None, since: Column | None = None, embedder=rag.hashed_words) -> DataFrame:
        """The k chunks nearest to a question of two characters or more."""
        if len(q.strip()) < 2:
            raise ValueError("the question must have two characters or more")
        if min_quality is not None and not 0 <= min_quality <= 1:
            raise ValueError("min_quality must be from 0 to 1")
        vector = [float(x) for x in embedder([q])[0]]
        return dashboard.top_k(self.table("chunks").filter("embedding IS NOT NULL"), vector, k, rag.search_filter(source, min_quality, since))

    def article(self, article_id: int) -> DataFrame:
        return dashboard.detail(self.articles, article_id)

    def list(self, lang: str | None = None, q: str | None = None, source: str | None = None, page: int = 1, page_size: int = 20) -> tuple[DataFrame, DataFrame]:
        """A page of articles, and the total with the number of pages."""
        by = {"lang": lang, "q": q, "source": source}
        return dashboard.page(self.articles, page, page_size, **by), dashboard.total(self.articles, page_size, **by)

    # Exports

    def export(self, out: str, limit: int = 0, min_len: int = 200, min_score: float = 0.0, lang: str | None = None) -> None:
        """The corpus as JSON lines, by id."""
        c = dashboard.corpus(self.articles, min_len, min_score, lang, limit)
        c = c.select("id", "url", "title", "source_type", "language", "quality_score", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"), "tags", "content_md")
        dashboard.as_json(c, c.columns).write.mode("overwrite").text(out)

    def export_sft(self, out: str, format: str = "alpaca", min_quality: float = 0.0, min_answer_chars: int = 100) -> None:
        """Instruction records as JSON lines."""
        shapes = {"alpaca": qa.alpaca, "sharegpt": qa.sharegpt}
        if format not in shapes:
            raise ValueError(f"no such format: {format}")
        p = shapes[format](qa.pairs(self.articles, min_quality, min_answer_chars))
        dashboard.as_json(p, p.columns).write.mode("overwrite").text(out)

    def rag_export(self, out: str, state: str, full: bool = False, target: int = 1200, overlap: int = 150, min_chars: int = 30) -> int:
        return rag.export_chunks(self.articles, out, state, full, target=target, overlap=overlap, min_chars=min_chars)

    def embed(self, chunks: str, out: str, model: str = "hashed-words", embedder=rag.hashed_words) -> tuple[int, int]:
        """Vectors of exported chunks that the archive at out lacks."""
        return rag.embed_new(rag.read_chunks(self.spark, chunks), out, model, embedder)

    def import_vectors(self, chunks: str, archive: str, initial: bool = False) -> int:
        """Exported chunks with their vectors into the store: instead of what is there, or as an upsert. The number of rows after."""
        v = self.spark.read.schema(rag.ARCHIVE).parquet(f"{archive}/vectors").select("chunk_id", "embedding")
        new = rag.with_vectors(rag.read_chunks(self.spark, chunks), v)
        new = schemas.evolve(new, "chunks")
        store.replace(new if initial else rag.upsert_chunks(self.table("chunks"), new), f"{self.root}/chunks")
        return self.table("chunks").count()

    def sync_vectors(self, embedder=rag.hashed_words, initial: bool = False, **cut) -> int:
        """Chunks, embeds and upserts the articles that came after the last one in the vector table. The number of rows after."""
        have = self.table("chunks")
        last = 0 if initial else rag.last_article(have).first()[0]
        c = rag.chunks(self.articles, last, **cut)
        v = rag.embed(c, embedder).filter("embedding IS NOT NULL")
        new = schemas.evolve(rag.with_vectors(c, v), "chunks")
        store.replace(new if initial else rag.upsert_chunks(have, new), f"{self.root}/chunks")
        return self.table("chunks").count()

    # Upkeep

    def dlq_replay(self, landing: str, limit: int | None = None, dry_run: bool = False, delete: bool = False) -> int:
        """Puts the oldest dead letters into the landing folder again; with delete they leave the table. How many."""
        letters = self.table("dead_letters")
        some = store.replay(letters.filter("article <> ''"), limit or None)
        n = some.count()
        if n and not dry_run:
            some.select(F.col("stream_msg_id").alias("msg_id"), "value").write.mode("append").json(landing)
            if delete:
                store.replace(store.after_replay(letters, some), f"{self.root}/dead_letters")
        return n

    def backfill_simhash(self) -> int:
        """Fills missing fingerprints. How many articles have none afterwards."""
        a = self.articles
        prints = simhash_blake2b(a.filter("content_hash IS NULL AND content_md <> ''"), "id", "content_md")
        store.replace(store.backfill(a, prints).select(*a.columns), f"{self.root}/articles")
        return self.articles.filter("content_hash IS NULL").count()

    def quality_probe(self, limit: int = 500) -> DataFrame:
        """The gate's verdicts over the latest articles, by reason."""
        latest = self.articles.orderBy(F.desc("id")).limit(limit)
        return assess(latest).groupBy("reason").agg(F.count("*").alias("n"), F.count_if("keep").alias("kept")).orderBy(F.desc("n"), "reason")

    def sample(self, deltas: DataFrame, pending: int = 0, stream_len: int = 0, keep_days: int = 7) -> None:
        """Adds a sample to the snapshots and drops those older than keep_days."""
        s = monitor.snapshot(self.table("outcomes"), deltas, self.as_of, pending, self.table("dead_letters").count(), stream_len)
        both = self.table("snapshots").unionByName(schemas.evolve(s, "snapshots"))
        store.replace(store.prune(both, "taken_at", self.as_of, keep_days), f"{self.root}/snapshots")
