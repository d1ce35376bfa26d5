"""What the operators of this package share: table access, snapshots, sizes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more rows than this, and more than one row in HOT_KEYS of all, is dealt over several tasks of a join.
HOT_ROWS, HOT_KEYS = 256, 20_000
#: Rows whose key is null match nothing; they are dealt over this many join keys.
NULL_SALTS = 1024
#: Arrow batches to Python are cut at this size; rows are whole, so one very long text makes one larger batch.
ARROW_BYTES = 8 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only in local mode where that is unset."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="millrace-")
        sc.setCheckpointDir(at)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def snapshot(df: DataFrame) -> DataFrame:
    """df computed once into the shared folder (Spark removes the files when the frame is no longer used)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table of the given name."""
    return f"{shared_dir(spark)}/millrace-{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Bounds what one Arrow batch brings into a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def id_hash(id_col: str = "doc_id") -> Column:
    return F.xxhash64(F.col(id_col).cast("string"))


def under(order: Column, share: float) -> Column:
    """Whether a 64-bit hash lies in this share of all hashes, from the least on. A sample of the least hashes is sought among
    twice as many rows as it needs, so that what tasks hand on together doesn't grow with their number."""
    return F.lit(True) if share >= 1 else order < F.lit(int(-(2**63) + share * 2**64)).cast("long")


def shares(most: int, n: int) -> Iterator[float]:
    """Shares in which `most` of n rows are sought: twice what is expected to hold them, then more, at last all."""
    share = 2 * most / max(1, n)
    while share < 1:
        yield share
        share *= 8
    yield 1.0


def whole_text(col: str = "text"):
    """Null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def hot_keys(counts: DataFrame, key: str, total: int) -> DataFrame:
    """key, __k: the keys of counts (key, n) that are hot and over how many tasks each is dealt. Fewer than HOT_KEYS rows, as
    each of them has more than one in HOT_KEYS of all rows; so they may be broadcast."""
    bound = max(HOT_ROWS, total // HOT_KEYS)
    return snapshot(counts.filter((F.col("n") > bound) & F.col(key).isNotNull()).select(key, F.ceil(F.col("n") / bound).cast("int").alias("__k")))


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: DataFrame | None = None, row: Column | None = None) -> DataFrame:
    """left joined to right (inner or left) where one key, or null, may hold a large part of left's rows.

    Rows of a hot key are dealt over as many join keys as their number asks for, and right's rows of these keys alone are
    copied to each. hot is counted here unless it is given. row tells left's rows of one key apart; without it they are
    numbered, and left is to be a snapshot then.
    """
    if hot is None:
        hot = hot_keys(left.groupBy(key).agg(F.count("*").alias("n")), key, left.count())
    row = F.xxhash64(F.monotonically_increasing_id()) if row is None else row
    dealt = left.join(F.broadcast(hot), key, "left")
    dealt = dealt.withColumn("__salt", F.pmod(row, F.when(F.col(key).isNull(), NULL_SALTS).otherwise(F.coalesce("__k", F.lit(1)))).cast("int")).drop("__k")
    copied = right.join(F.broadcast(hot), key, "left")
    copied = copied.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__k", F.lit(1)) - 1))).drop("__k")
    return dealt.join(copied, [key, "__salt"], how).drop("__salt")
