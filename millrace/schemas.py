"""Schemas of the store's tables, and empty frames of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, MapType, StructType

ARTICLES = (
    "id BIGINT, url STRING, url_hash STRING, title STRING, content_md STRING, author STRING, published_at TIMESTAMP, "
    "crawled_at TIMESTAMP, tags ARRAY<STRING>, source_type STRING, language STRING, quality_score DOUBLE, content_hash BIGINT"
)
MESSAGE = "url STRING, title STRING, author STRING, published_at STRING, tags ARRAY<STRING>, source_type STRING, content_md STRING, payload STRING"
FINGERPRINTS = "band INT, bucket BIGINT, simhash BIGINT, indexed_at TIMESTAMP"
DEAD_LETTERS = "stream_msg_id STRING, url STRING, title STRING, reason STRING, detail STRING, article STRING, parked_at TIMESTAMP"
OUTCOMES = "batch_id BIGINT, msg_id STRING, source_type STRING, outcome STRING, ts TIMESTAMP"
RUNS = "source STRING, finished_at TIMESTAMP, pages INT, published INT, failed_pages INT, publish_errors INT, duration_ms BIGINT"
SNAPSHOTS = (
    "taken_at TIMESTAMP, produced BIGINT, stored BIGINT, rejected BIGINT, pending INT, dlq BIGINT, stream_len BIGINT, "
    "by_source MAP<STRING,STRUCT<produced_delta:BIGINT,stored_delta:BIGINT,rejected_delta:BIGINT>>"
)
CHUNKS = (
    "chunk_id STRING, article_id BIGINT, url STRING, title STRING, heading_path ARRAY<STRING>, chunk_index INT, n_chunks INT, text STRING, "
    "tags ARRAY<STRING>, source_type STRING, language STRING, published_at TIMESTAMP, quality_score DOUBLE, embedding ARRAY<FLOAT>"
)
TABLES = {"articles": ARTICLES, "fingerprints": FINGERPRINTS, "dead_letters": DEAD_LETTERS, "outcomes": OUTCOMES, "runs": RUNS, "snapshots": SNAPSHOTS, "chunks": CHUNKS}


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Creates the tables that are missing; run again it changes nothing."""
    for name, ddl in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet")


def evolve(df: DataFrame, name: str) -> DataFrame:
    """df with the table's columns: missing ones null, in the table's order and types."""
    want = empty(df.sparkSession, name)
    return want.unionByName(df.select(*[c for c in df.columns if c in want.columns]), allowMissingColumns=True)


def analyze(spark: SparkSession, database: str = "default") -> None:
    """Statistics of the tables and of their plain columns, for the optimizer; after a load."""
    for name in TABLES:
        plain = [f.name for f in empty(spark, name).schema if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
        spark.sql(f"ANALYZE TABLE {database}.{name} COMPUTE STATISTICS FOR COLUMNS {', '.join(plain)}")
