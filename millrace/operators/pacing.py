"""When calls may start under token buckets, and how fast batches get done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def call_times(calls: DataFrame, key: str, at: str, order: str, gap: Column, burst: Column, pause: Column, slice_ms: int = 3_600_000) -> DataFrame:
    """calls with starts (ms): the first moment at which a bucket of `burst` tokens, one refilled every `gap` ms, lets each start.

    Calls of a key queue by `at` (ms, long) and then order; gap and burst are those of the key. A call with a pause (ms; null: none)
    was answered with a request to wait: its bucket is empty until the pause is over. Rows without key or time start at once.

    What a call leaves behind is max(what it found + w, at + v), so running sums and maxima replace a queue. They are taken within
    slices of time first and then over the slices (one row each), so that a key with many calls is many tasks.
    """
    wait = F.greatest(F.coalesce(pause, F.lit(0)), F.lit(0)).cast("long")
    c = calls.withColumns({"__at": F.col(at).cast("long"), "__gap": gap.cast("long"), "__burst": burst.cast("long"), "__wait": wait})
    c = c.withColumn("__slice", F.floor(F.col("__at") / slice_ms)).withColumn("__w", F.col("__gap") + F.col("__wait"))
    c = c.withColumn("__v", F.when(F.col("__wait") > 0, F.col("__wait") + F.col("__gap") * F.col("__burst")).otherwise(F.col("__gap")))
    queued = F.col(key).isNotNull() & F.col("__at").isNotNull()
    w = Window.partitionBy(key, "__slice").orderBy("__at", order)
    so_far, before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    c1 = c.filter(queued).withColumn("__sum", F.sum("__w").over(so_far))
    c1 = c1.withColumn("__lead", F.col("__at") + F.col("__v") - F.col("__sum")).withColumn("__max", F.max("__lead").over(before))
    slices = c1.groupBy(key, "__slice").agg(F.max("__sum").alias("__sum"), F.max("__lead").alias("__lead"))
    earlier = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__base", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)))
    slices = slices.withColumn("__carry", F.max(F.col("__lead") - F.col("__base")).over(earlier)).select(key, "__slice", "__base", "__carry")
    c1 = c1.join(slices, [key, "__slice"])
    found = F.col("__base") + F.col("__sum") - F.col("__w") + F.greatest(F.col("__carry"), F.col("__max") - F.col("__base"))
    starts = F.greatest(F.col("__at"), found - (F.col("__burst") - 1) * F.col("__gap"))
    out = c1.withColumn("starts", starts).select(*calls.columns, "starts")
    return out.unionByName(c.filter(~queued).withColumn("starts", F.col("__at")).select(*calls.columns, "starts"))


def progress(batches: DataFrame, run: str, at: str, order: str, n: str, started: Column) -> DataFrame:
    """run, at, done, per_minute: rows done after each batch of a run, and a minute since the start. A run's batches are few."""
    w = Window.partitionBy(run).orderBy(at, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    micros = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(started.cast("timestamp"))  # seconds since 1970 in double would lose digits
    minutes = F.greatest(micros / F.lit(1e6) / 60, F.lit(1e-9))
    out = batches.withColumn("done", F.sum(n).over(w).cast("long"))
    return out.select(run, order, at, "done", (F.col("done") / minutes).alias("per_minute"))
