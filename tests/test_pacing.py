"""Token buckets, the cache of query vectors, literals, statistics and clustered tables."""

import random

import numpy as np
from pyspark.sql import functions as F

from millrace import schemas
from millrace.functions.scalars import general, rounded, text_array_literal, vector_literal
from millrace.operators import pacing, rag, store


def _bucket(calls, gap, burst):
    """Starts of calls (at, pause), one after the other, by a bucket that is refilled all the time."""
    out, tokens, clock = [], float(burst), None
    for at, pause in calls:
        clock = at if clock is None else clock
        now = max(at, clock)
        tokens = min(burst, tokens + (now - clock) / gap)
        if tokens < 1 - 1e-9:
            now += round((1 - tokens) * gap)
            tokens = 1.0
        tokens, clock = tokens - 1, now
        out.append(now)
        if pause:
            tokens, clock = 0.0, now + pause
    return out


def test_calls_start_as_a_bucket_lets_them(spark):
    rng, rows, want = random.Random(7), [], {}
    for host, gap, burst in (("a", 1000, 1), ("b", 500, 6), ("c", 7000, 3)):
        at = sorted(rng.randrange(200_000) for _ in range(150)) + [200_000] * 5
        calls = [(t, 5000 if rng.random() < 0.05 else None) for t in at]
        ids = range(len(rows), len(rows) + len(calls))
        rows += [(i, host, t, p, gap, burst) for i, (t, p) in zip(ids, calls, strict=True)]
        want |= dict(zip(ids, _bucket(calls, gap, burst), strict=True))
    rows += [(9001, None, 5, None, 1, 1), (9002, "a", None, None, 1, 1)]
    want |= {9001: 5, 9002: None}
    df = spark.createDataFrame(rows, "id long, host string, at long, pause int, gap int, burst int")
    for ms in (3000, 60_000, 10**9):
        got = pacing.call_times(df, "host", "at", "id", F.col("gap"), F.col("burst"), F.col("pause"), ms)
        assert got.columns == [*df.columns, "starts"] and {r.id: r.starts for r in got.collect()} == want
    assert pacing.call_times(df.limit(0), "host", "at", "id", F.col("gap"), F.col("burst"), F.col("pause")).count() == 0


def test_general_digits(spark):
    xs = [0.0, 1.0, -0.5, 1e-4, 9.99999e-5, 0.000123456789, 123456.0, 999999.4, 999999.6, 1234567.0, 1e30, -2.5e-12, 100.0, 3.14159265, 42.5, float("inf"), None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = {r.i: r.s for r in df.select("i", general(F.col("x")).alias("s")).collect()}
    assert got == {i: None if x is None else f"{x:.6g}" for i, x in enumerate(xs)}
    assert spark.range(1).select(text_array_literal(F.array(F.lit('q"x'), F.lit("b")))).first()[0] == '{"q\\"x","b"}'


def test_digits_of_exact_ties(spark, duck):
    """Ties of the double itself go to the even digit, as in SQL; what is no tie in binary isn't one."""
    xs = [0.0009765625, 0.0029296875, 100000.5, 100001.5, 1234565.0, 1.2345645, 1.2345655, -0.0, float("nan"), -float("inf")]
    df = spark.createDataFrame([(0, xs), (1, []), (2, None), (3, [None, 0.5])], "i int, v array<double>")
    got = {r.i: r.s for r in df.select("i", vector_literal(F.col("v")).alias("s")).collect()}
    want = duck.sql(f"SELECT array_to_string([format('{{:.6g}}', x) for x in [{', '.join(f"'{x!r}'::DOUBLE" for x in xs)}]], ',')").fetchall()[0][0]
    assert got == {0: f"[{want}]", 1: "[]", 2: None, 3: "[0.5]"}
    one = spark.createDataFrame([(x,) for x in xs], "x double").select(general(F.col("x")).alias("s"))
    assert sorted(r.s for r in one.collect()) == sorted(want.split(","))


def test_progress_to_the_last_digit(spark, duck, same):
    """Rates that lie at a rounding step: times to the microsecond, double arithmetic and ties as in SQL."""
    from datetime import datetime, timedelta

    duck.sql("CREATE OR REPLACE TEMP TABLE late AS SELECT i % 40 AS run, i AS no, TIMESTAMP '2024-01-01 00:00:00' + to_microseconds((i * 7919 * 7919 % 1000003) * 2500003) AS ts FROM range(40000) t(i)")
    want = duck.sql("SELECT run, no, count(*) OVER w * 32 AS done, round(count(*) OVER w * 32 / greatest(epoch(ts - TIMESTAMP '2024-01-01 00:00:00') / 60, 1e-9), 4) AS per_minute FROM late WINDOW w AS (PARTITION BY run ORDER BY ts, no ROWS UNBOUNDED PRECEDING)")
    start = datetime(2024, 1, 1)
    rows = [(i % 40, i, start + timedelta(microseconds=(i * 7919 * 7919 % 1000003) * 2500003)) for i in range(40000)]
    df = spark.createDataFrame(rows, "run long, no long, ts timestamp_ntz").withColumns({"ts": F.col("ts").cast("timestamp"), "n": F.lit(32)})
    p = pacing.progress(df, "run", "ts", "no", "n", F.expr("TIMESTAMP '2024-01-01 00:00:00'"))
    same(p.select("run", "no", "done", rounded(F.col("per_minute"), 4).alias("per_minute")), want)
    xs = [2062.22015, 2921.47855, -0.00005, 0.00015, 1.00005, -1.00005, 3e15, 1e300, 0.0]
    duck.sql("CREATE OR REPLACE TEMP TABLE steps AS SELECT unnest([" + ", ".join(f"{x!r}::DOUBLE" for x in xs) + "]) AS x")
    same(spark.createDataFrame([(x,) for x in xs], "x double").select("x", rounded(F.col("x"), 4).alias("r")), duck.sql("SELECT x, round(x, 4) AS r FROM steps"))


def test_query_vectors_are_embedded_once(spark, tmp_path):
    seen = f"{tmp_path}/seen"

    def embedder(texts):
        with open(seen, "a") as f:
            f.writelines(t + "\n" for t in texts)
        return np.array([[len(t), 1.0] for t in texts], np.float32)

    at = f"{tmp_path}/cache"
    ask = lambda ts, most: {r.text: r.embedding for r in rag.query_vectors(spark.createDataFrame([(t,) for t in ts], "text string"), at, "m", embedder, most).collect()}
    assert ask(["one", "three", "one", None], 2) == {"one": [3.0, 1.0], "three": [5.0, 1.0]}
    assert ask(["one"], 2) == {"one": [3.0, 1.0]}
    assert ask(["fifteen"], 2) == {"fifteen": [7.0, 1.0]}
    assert ask(["one", "three"], 2) == {"one": [3.0, 1.0], "three": [5.0, 1.0]}
    assert sorted(open(seen).read().split()) == ["fifteen", "one", "three", "three"]


def test_statistics_and_clustered_files(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS pace")
    schemas.create_tables(spark, "pace")
    schemas.analyze(spark, "pace")
    assert any(r.col_name == "Statistics" for r in spark.sql("DESCRIBE EXTENDED pace.articles").collect())
    df = spark.range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("url_hash"))
    store.clustered(df, f"{tmp_path}/t", ["id"], ["url_hash"])
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.count() == 1000 and back.filter(F.col("url_hash") == F.sha2(F.lit("77"), 256)).first().id == 77
    spans = back.groupBy(F.input_file_name()).agg(F.min("id").alias("a"), F.max("id").alias("z")).orderBy("a").collect()
    assert all(x.z < y.a for x, y in zip(spans, spans[1:], strict=False))
