"""Streaming ingest: messages -> gate, language, duplicates -> articles, outcomes, dead letters.

A failed batch is replayed from the source's checkpoint. What becomes of a message is decided once: outcomes are written under the
batch's number before anything follows from them, and a replay finds and keeps them. Articles and dead letters are appended
if their key is absent, so a replay adds just what the failed attempt did not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import url_hash
from ..functions.text import Gate, assess
from ..operators.dedup import append_if_absent, first_wins, greedy_keep, probe, unexpired
from ..operators.language import with_language_and_print
from ..operators.store import dead_letters, exists, number_after


@dataclass(frozen=True)
class Ingest:
    """Where the store is, and what is kept."""

    root: str
    languages: tuple[str, ...] = ("en",)
    gate: Gate = Gate()
    most_bits: int = 3
    #: Near duplicates are sought among the articles of these last days only; None: among all.
    near_days: int | None = None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """The table as it is now; empty if nothing was written."""
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            return schemas.empty(spark, name)
        return spark.read.schema(schemas.TABLES[name]).parquet(f"{self.root}/{name}")

    def batch(self, df: DataFrame, batch_id: int) -> None:
        """df: msg_id, value (JSON)."""
        spark = df.sparkSession
        parsed = df.select("msg_id", "value", F.from_json("value", schemas.MESSAGE).alias("m"))
        bad = parsed.filter("m IS NULL OR m.url IS NULL")
        m = parsed.filter("m.url IS NOT NULL").select("msg_id", "value", "m.*").withColumn("url_hash", url_hash(F.col("url")))
        m = first_wins(m, ["url_hash"], ["msg_id"])
        judged = assess(m, gate=self.gate)
        known = self.table(spark, "articles").select("url_hash", "content_hash", F.col("crawled_at").alias("indexed_at")).withColumn("known", F.lit(True))
        judged = judged.join(known.select("url_hash", "known"), "url_hash", "left")
        judged = with_language_and_print(judged, "content_md", F.col("keep") & F.col("known").isNull(), self.languages).persist()
        at, now = f"{self.root}/outcomes/batch={batch_id}", F.current_timestamp()
        try:
            if not exists(spark, f"{at}/_SUCCESS"):
                self.decide(judged, known, batch_id, now).write.mode("overwrite").parquet(at)
            decided = spark.read.schema(schemas.TABLES["outcomes"]).parquet(at).filter("outcome = 'stored'").select("msg_id")
            # Keys are sorted out and numbered alone; the texts move once, to their numbers.
            keys = judged.select("msg_id", "url_hash").join(decided, "msg_id", "left_semi")
            stored = append_if_absent(keys, self.table(spark, "articles"), "url_hash", ["msg_id"])
            last = self.table(spark, "articles").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
            rows = judged.join(number_after(stored, last, ["msg_id"]).select("msg_id", "url_hash", "id"), ["msg_id", "url_hash"])
            rows = rows.select("id", "url", "url_hash", "title", "content_md", "author", F.to_timestamp("published_at").alias("published_at"), now.alias("crawled_at"), "tags", "source_type", "language", "quality_score", F.col("simhash").alias("content_hash"))
            letters = bad.select(F.col("msg_id").alias("stream_msg_id"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("title"), F.lit("parse").alias("reason"), F.left("value", F.lit(500)).alias("detail"), F.col("value").alias("article"))
            dead_letters(letters, self.table(spark, "dead_letters"), now).write.mode("append").parquet(f"{self.root}/dead_letters")
            rows.write.mode("append").parquet(f"{self.root}/articles")
        finally:
            judged.unpersist()

    def decide(self, judged: DataFrame, known: DataFrame, batch_id: int, now: Column) -> DataFrame:
        """batch_id, msg_id, source_type, outcome, ts for each message of a batch."""
        fresh = judged.filter("simhash IS NOT NULL").select("msg_id", "simhash")
        index = unexpired(known.select(F.col("content_hash").alias("simhash"), "indexed_at").filter("simhash IS NOT NULL"), now, self.near_days)
        near = probe(fresh, index, "msg_id", self.most_bits)
        # What no stored article is near arrives in the order of msg_id: a message that a kept one of the batch is near is dropped.
        kept = greedy_keep(fresh.join(near, "msg_id", "left_anti"), id_col="msg_id", most_bits=self.most_bits)
        dup = fresh.join(kept, "msg_id", "left_anti").select("msg_id").withColumn("dup", F.lit(True))
        outcome = F.when(F.col("known"), "seen").when(~F.col("keep"), F.col("reason")).when(~F.col("language").isin(*self.languages), "lang").when(F.col("dup"), "dup").otherwise("stored")
        done = judged.join(dup, "msg_id", "left").withColumn("outcome", outcome)
        return done.select(F.lit(batch_id).cast("long").alias("batch_id"), "msg_id", "source_type", "outcome", now.alias("ts"))

    def start(self, messages: DataFrame, checkpoint: str, every: str | None = None):
        """messages: a stream of msg_id, value. Runs over what is there, or every so often."""
        w = messages.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint)
        return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def message_stream(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    """JSON lines {msg_id, value} that land in a folder."""
    return spark.readStream.schema("msg_id STRING, value STRING").option("maxFilesPerTrigger", files_a_batch).json(path)


def distinct_urls(messages: DataFrame) -> DataFrame:
    """The stream's first message of each URL (state: the hashes seen)."""
    m = messages.withColumn("url_hash", url_hash(F.get_json_object("value", "$.url")))
    return m.dropDuplicates(["url_hash"])


def windowed_counts(events: DataFrame, ts: str = "ts", key: str = "source", minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Counts by tumbling window and key of a stream or a table."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, f"{minutes} minutes"), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("bucket"), key, "n")
