"""Writes of the store: upsert, backfill, prune, dead letters, watermarks, versions of a table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, key: str, changed: list[str]) -> DataFrame:
    """old with the rows of new: changed columns of known keys are taken from new, unknown keys are added whole."""
    n = new.select(*[F.col(c).alias(f"__{c}") for c in old.columns], F.lit(True).alias("__new"))
    both = old.withColumn("__old", F.lit(True)).join(n, F.col(key) == F.col(f"__{key}"), "full_outer")
    pick = lambda c: F.when(F.col("__old") & (F.lit(c not in changed) | F.col("__new").isNull()), F.col(c)).otherwise(F.col(f"__{c}"))
    return both.select(*[pick(c).alias(c) for c in old.columns])


def last_wins(df: DataFrame, key: str, order: list) -> DataFrame:
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r")).select(key, "r.*")


def backfill(df: DataFrame, prints: DataFrame, id_col: str = "id", column: str = "content_hash") -> DataFrame:
    """Fills null fingerprints of rows with text."""
    p = prints.select(F.col(id_col), F.col("simhash").alias("__h"))
    fill = F.when(F.col("content_md") != "", F.col("__h"))
    return df.join(p, id_col, "left").withColumn(column, F.coalesce(column, fill)).drop("__h")


def prune(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """What stays: rows not older than days."""
    return df.filter(F.col(ts) >= as_of - F.make_dt_interval(F.lit(days)))


def keep_newest(df: DataFrame, group: str, order: list, n: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def dead_letters(failed: DataFrame, known: DataFrame, now: Column) -> DataFrame:
    """New dead letters: once for each message, the detail cut at 500 characters, the article whole."""
    new = failed.dropDuplicates(["stream_msg_id"]).join(known.select("stream_msg_id"), "stream_msg_id", "left_anti")
    return new.select("stream_msg_id", "url", "title", "reason", F.left("detail", F.lit(500)).alias("detail"), "article", now.alias("parked_at"))


def replay(letters: DataFrame, limit: int | None = None) -> DataFrame:
    """The oldest letters' articles, to append to the landing zone again."""
    out = letters.orderBy("stream_msg_id")
    return (out.limit(limit) if limit else out).select("stream_msg_id", F.col("article").alias("value"))


def after_replay(letters: DataFrame, replayed: DataFrame) -> DataFrame:
    return letters.join(replayed.select("stream_msg_id"), "stream_msg_id", "left_anti")


def publish(new: DataFrame, log: DataFrame, seen: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """The log after new rows have come: first by key and not seen; of old and new rows the latest `most` stay."""
    from .dedup import append_if_absent

    return log.unionByName(append_if_absent(new, seen, key, [order])).orderBy(F.desc(order)).limit(most)


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _fs(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode where that is unset."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    at = at or "file://" + tempfile.mkdtemp(prefix="millrace-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path for a job's files in the shared folder."""
    return f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"


def replace(df: DataFrame, path: str) -> None:
    """Puts df in the place of the table at path, which df may have been read from: written beside it, then renamed."""
    spark = df.sparkSession
    old, new = f"{path}.old-{uuid.uuid4().hex}", f"{path}.new-{uuid.uuid4().hex}"
    df.write.parquet(new)
    here, fs = _fs(spark, path)
    if fs.exists(here):
        fs.rename(here, _fs(spark, old)[0])
    fs.rename(_fs(spark, new)[0], here)
    remove(spark, old)


def clustered(df: DataFrame, path: str, by: list[str], lookup: list[str] = (), values: int = 1_000_000) -> None:
    """Writes df ranged and sorted by columns, so that a range of them is in few files and row groups, with Bloom filters
    (each for so many values a row group) of columns that single values are looked up in. In place of secondary indexes."""
    w = df.repartitionByRange(*by).sortWithinPartitions(*by).write
    for c in lookup:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(values))
    w.parquet(path)


def watermark(spark: SparkSession, path: str) -> int:
    """The last id kept at path; 0 where there is none or it can't be read."""
    try:
        r = spark.read.schema("last_id BIGINT").json(path).agg(F.max("last_id")).first()
        return r[0] or 0
    except Exception as e:  # a missing path, or one that isn't JSON
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return 0
        raise


def save_watermark(spark: SparkSession, path: str, last_id: int) -> None:
    spark.createDataFrame([(last_id,)], "last_id BIGINT").coalesce(1).write.mode("overwrite").json(path)


def number_after(new: DataFrame, last: int, order: list) -> DataFrame:
    """Ids last + 1, last + 2, ... in the given order: ranged by order, counted per range, and numbered within it.

    The counts (one a partition) are all that reaches the driver; no window runs over all rows in one task.
    """
    ranged = new.orderBy(*order).withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id())
    shared_dir(new.sparkSession)
    ranged = ranged.checkpoint()
    counts = {r["__p"]: r["n"] for r in ranged.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    base, at = {}, last
    for p in sorted(counts):
        base[p] = at
        at += counts[p]
    start = F.create_map(*[x for p, b in base.items() for x in (F.lit(p), F.lit(b))]) if base else None
    n = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1).cast("long")) + 1
    out = ranged.withColumn("id", (n + (start[F.col("__p")] if base else F.lit(last))).cast("long"))
    return out.drop("__p", "__m")
