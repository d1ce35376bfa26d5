"""Counters, deltas between samples, activity, and the state of the sources' runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import age_status, floor_minutes

#: Outcomes that count as rejections of their source (not the language's and not duplicates').
BY_SOURCE = ("not_found", "extract_fail", "empty", "spam", "link_dump", "low_diversity", "too_short", "thin_prose", "help_request")


def counters(outcomes: DataFrame) -> DataFrame:
    """One row: totals, and maps by source and by reason."""
    stored = F.col("outcome") == "stored"

    def by(df: DataFrame, key: str, name: str) -> DataFrame:
        n = df.groupBy(key).agg(F.count("*").alias("n"))
        return n.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias(name))

    one = outcomes.agg(F.count("*").alias("produced"), F.count_if(stored).alias("stored"), F.count_if(~stored).alias("rejected"))
    rejected = outcomes.filter(~stored)
    # Each side has one row.
    return one.join(by(outcomes, "source_type", "produced_by_source")).join(by(outcomes.filter(stored), "source_type", "stored_by_source")).join(by(rejected, "outcome", "rejected_by_reason")).join(by(rejected.filter(F.col("outcome").isin(*BY_SOURCE)), "source_type", "rejected_by_source"))


def by_reason(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter("outcome <> 'stored'").groupBy("outcome").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "outcome")


def by_source(outcomes: DataFrame) -> DataFrame:
    """Produced, stored and rejected by source."""
    is_in = F.col("outcome").isin(*BY_SOURCE)
    return outcomes.groupBy("source_type").agg(F.count("*").alias("produced"), F.count_if(F.col("outcome") == "stored").alias("stored"), F.count_if(is_in).alias("rejected"))


def stored_and_rejected(stored: DataFrame, rejected: DataFrame) -> DataFrame:
    """Both counts by source, where either is; the most stored first."""
    both = stored.toDF("source", "stored").join(rejected.toDF("source", "rejected"), "source", "full_outer").na.fill(0, ["stored", "rejected"])
    return both.orderBy(F.desc("stored"), "source")


def snapshot_deltas(snapshots: DataFrame) -> DataFrame:
    """Growth since the sample before, at least 0; 0 for the first. Samples are few (one a minute, kept for days)."""
    w = Window.orderBy("taken_at")
    grown = lambda c: F.greatest(F.lit(0), F.col(c) - F.lag(c, 1).over(w))
    return snapshots.select("taken_at", F.coalesce(grown("produced"), F.lit(0)).cast("long").alias("produced_delta"), F.coalesce(grown("stored"), F.lit(0)).cast("long").alias("stored_delta"))


def source_deltas(samples: DataFrame) -> DataFrame:
    """Growth by source between consecutive samples (taken_at, source, produced, stored, rejected).

    A source that a sample lacks counts as 0 there; the first sample has deltas of 0.
    """
    times = samples.select("taken_at").distinct()
    w = Window.orderBy("taken_at")
    before = times.select("taken_at", F.lag("taken_at").over(w).alias("prev"), F.lead("taken_at").over(w).alias("next"))
    # A row is needed for each sample and source that it or the one before has.
    own = samples.select("taken_at", "source")
    carried = samples.join(before, "taken_at").filter("next IS NOT NULL").select(F.col("next").alias("taken_at"), "source")
    keys = own.union(carried).distinct().join(before.select("taken_at", "prev"), "taken_at")
    cur = samples.select("taken_at", "source", "produced", "stored", "rejected")
    prev = cur.toDF("prev", "source", "p0", "s0", "r0")
    out = keys.join(cur, ["taken_at", "source"], "left").join(prev, ["prev", "source"], "left")

    def delta(c: str, c0: str) -> Column:
        d = F.greatest(F.lit(0), F.coalesce(c, F.lit(0)) - F.coalesce(c0, F.lit(0)))
        return F.when(F.col("prev").isNull(), 0).otherwise(d).cast("long")

    return out.select("taken_at", "source", delta("produced", "p0").alias("produced_delta"), delta("stored", "s0").alias("stored_delta"), delta("rejected", "r0").alias("rejected_delta"))


def activity(deltas: DataFrame, sources: list[str], minutes: int = 5) -> DataFrame:
    """Produced by time bucket, a column for each source, 0 where nothing was."""
    per = deltas.groupBy(floor_minutes(F.col("taken_at"), minutes).alias("bucket")).pivot("source", sources).agg(F.sum("produced_delta"))
    return per.na.fill(0).orderBy("bucket")


def activity_rows(deltas: DataFrame, minutes: int = 5) -> DataFrame:
    return deltas.groupBy(floor_minutes(F.col("taken_at"), minutes).alias("bucket"), "source").agg(F.sum("produced_delta").alias("produced_delta"))


def counter_growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """Growth of a counter by source (source, n) from one sample to the next; a source that one lacks has 0 there."""
    both = before.toDF("source", "b").join(after.toDF("source", "a"), "source", "full_outer").na.fill(0, ["a", "b"])
    return both.select("source", F.greatest(F.lit(0), F.col("a") - F.col("b")).cast("long").alias("delta"))


def snapshot(outcomes: DataFrame, deltas: DataFrame, taken_at: Column, pending: int = 0, dlq: int = 0, stream_len: int = 0) -> DataFrame:
    """A row of the snapshots' table: totals, and the deltas of the last sample (source and three deltas) as a map."""
    stored = F.col("outcome") == "stored"
    total = outcomes.agg(F.count("*").alias("produced"), F.count_if(stored).alias("stored"), F.count_if(~stored).alias("rejected"))
    entry = F.struct("source", F.struct("produced_delta", "stored_delta", "rejected_delta"))
    by = deltas.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("by_source"))  # a source each
    counts = [F.lit(v).cast(t).alias(k) for k, v, t in (("pending", pending, "int"), ("dlq", dlq, "int"), ("stream_len", stream_len, "long"))]
    return total.join(by).select(taken_at.alias("taken_at"), "produced", "stored", "rejected", *counts, "by_source")


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last run of each source."""
    cols = [c for c in runs.columns if c != "source"]
    return runs.groupBy("source").agg(F.max_by(F.struct(*cols), "finished_at").alias("r")).select("source", "r.*")


def run_status(runs: DataFrame, as_of: Column, limits: dict[str, int], default: int = 180) -> DataFrame:
    """The last runs with age and status, by source."""
    spark = runs.sparkSession
    table = spark.createDataFrame(sorted(limits.items()) or [("", default)], "source string, lim int")
    out = latest_runs(runs).join(F.broadcast(table), "source", "left").withColumn("stale_after_minutes", F.coalesce("lim", F.lit(default))).drop("lim")
    age, status = age_status(F.col("finished_at"), as_of, F.col("stale_after_minutes"))
    return out.withColumns({"age_minutes": age, "status": status}).orderBy("source")


def overall(status: DataFrame) -> DataFrame:
    """The stale sources, and ok only if there is none."""
    stale = F.array_sort(F.collect_list(F.when(F.col("status") == "stale", F.col("source"))))
    return status.agg(stale.alias("stale")).withColumn("status", F.when(F.size("stale") > 0, "stale").otherwise("ok"))


def cursors(articles: DataFrame) -> DataFrame:
    """The latest publication of each source."""
    return articles.groupBy("source_type").agg(F.max("published_at").alias("cursor"))


def run_summary(pages: DataFrame) -> DataFrame:
    return pages.groupBy("source").agg(F.count("*").alias("pages"), F.sum("published").alias("published"), F.sum("publish_errors").alias("publish_errors"), F.count_if("failed").alias("failed_pages"))
