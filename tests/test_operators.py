import json
import os
import random

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import dedup, monitor, qa, rag, store
from millrace.sources import adapters
from millrace.streaming.ingest import Ingest, distinct_urls, message_stream


def test_greedy_order_of_arrival(spark):
    random.seed(5)
    base = [random.getrandbits(64) for _ in range(6)]
    prints = []
    for i in range(300):
        h = random.choice(base)
        for b in random.sample(range(64), random.choice([0, 0, 1, 2, 3])):
            h ^= 1 << b
        prints.append((i, h - (1 << 64) if h >> 63 else h))
    kept = []
    for i, h in prints:
        if all(((h ^ k) & (2**64 - 1)).bit_count() > 3 for _, k in kept):
            kept.append((i, h))
    df = spark.createDataFrame(prints, "id long, simhash long")
    for got in (dedup.greedy_keep(df, dedup.near_pairs(df)), dedup.greedy_keep(df)):
        assert sorted(r.id for r in got.collect()) == [i for i, _ in kept]


def test_index_probe_and_expiry(spark):
    index = spark.createDataFrame([(7,), (-1,)], "simhash long")
    new = spark.createDataFrame([(1, 7), (2, 5), (3, 1 << 40), (4, -2)], "id long, simhash long")
    assert sorted(r.id for r in dedup.probe(new, index).collect()) == [1, 2, 4]
    at = F.expr("TIMESTAMP '2024-01-01'")
    rows = dedup.lsh_rows(index, [F.lit(1), F.lit(2)], at)
    assert rows.count() == 4
    assert dedup.unexpired(rows, F.expr("TIMESTAMP '2024-01-09'"), 7).count() == 0
    assert dedup.unexpired(rows, F.expr("TIMESTAMP '2024-01-09'"), None).count() == 4


def test_upsert_keeps_other_columns(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, text string, score int")
    new = spark.createDataFrame([("b", None, 9), ("c", "z", 3)], "k string, text string, score int")
    got = {r.k: (r.text, r.score) for r in store.upsert(old, new, "k", ["text"]).collect()}
    assert got == {"a": ("x", 1), "b": (None, 2), "c": ("z", 3)}


def test_watermark(spark, tmp_path):
    at = f"{tmp_path}/state"
    assert store.watermark(spark, at) == 0
    store.save_watermark(spark, at, 42)
    assert store.watermark(spark, at) == 42
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "f.json").write_text("not json")
    assert store.watermark(spark, f"{tmp_path}/bad") == 0


def test_ids_follow_order(spark):
    df = spark.range(0, 1000, numPartitions=7).select((997 - F.col("id")).alias("m"))
    got = [(r.m, r.id) for r in store.number_after(df, 10, ["m"]).collect()]
    assert sorted(got) == [(m, 11 + i) for i, m in enumerate(range(-2, 998))]


def test_deltas_of_missing_and_reset_sources(spark):
    rows = [("2024-01-01 00:00:00", "a", 5, 5, 1), ("2024-01-01 00:01:00", "a", 3, 6, 1), ("2024-01-01 00:01:00", "b", 4, 0, 2), ("2024-01-01 00:02:00", "b", 9, 1, 2)]
    df = spark.createDataFrame(rows, "t string, source string, produced long, stored long, rejected long").withColumn("taken_at", F.to_timestamp("t")).drop("t")
    got = {(r.taken_at.minute, r.source): (r.produced_delta, r.stored_delta, r.rejected_delta) for r in monitor.source_deltas(df).collect()}
    assert got == {(0, "a"): (0, 0, 0), (1, "a"): (0, 1, 0), (1, "b"): (4, 0, 2), (2, "a"): (0, 0, 0), (2, "b"): (5, 1, 0)}


def test_parse_answers(spark):
    docs = {
        "full": "# Title here\n\nwhat is it\n\n## Top answer\n\nit is this\n",
        "no answer": "# Title\n\nquestion",
        "no heading": "text\n\n## Top answer\n\nanswer",
        "no question": "# Title\n\n## Top answer\n\nanswer",
    }
    df = spark.createDataFrame(list(docs.items()), "k string, t string")
    got = {r.k: r.p for r in df.select("k", qa.parse(F.col("t")).alias("p")).collect()}
    assert tuple(got["full"]) == ("Title here", "what is it", "it is this")
    assert got["no answer"] is got["no heading"] is got["no question"] is None
    short = df.filter("k = 'full'").select(qa.parse(F.col("t"), 100).alias("p")).first()
    assert short.p is None


def test_first_accepted_answer_wins(spark):
    rows = [(1, 0, 9, False), (1, 1, 2, True), (1, 2, 50, True), (2, 0, 3, False), (2, 1, 3, False), (3, 0, 0, False), (3, 1, -2, False)]
    best = qa.best_answers(spark.createDataFrame(rows, "question_id int, pos int, score int, accepted boolean"))
    assert sorted((r.question_id, r.pos) for r in best.collect()) == [(1, 1), (2, 0)]


def test_failed_embedding_is_null(spark):
    def broken(texts):
        raise ValueError("no service")

    df = spark.createDataFrame([("a", "x y"), ("b", None)], "chunk_id string, text string")
    assert [r.embedding for r in rag.embed(df, broken).collect()] == [None, None]
    assert all(len(r.embedding) == 64 for r in rag.embed(df).collect())


def test_sources(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps([{"id": 1, "url": "u1", "title": "t", "published_at": "2024-01-02T00:00:00Z", "tag_list": ["a"], "body_markdown": "inline", "user": {"name": "n"}}, {"id": 2, "url": "u2", "title": "t", "published_at": "2024-01-02T00:00:00Z", "tag_list": [{"name": "b"}], "body_markdown": ""}, {"id": 3, "url": "u3", "title": "old", "published_at": "2023-01-01T00:00:00Z", "tag_list": 42}]))
    bodies = spark.createDataFrame([(1, "other"), (2, "looked up")], "id long, body string")
    got = {r.url: r for r in adapters.read("devto", spark, f"{tmp_path}/d.json", since=F.expr("TIMESTAMP '2024-01-01'"), bodies=bodies).collect()}
    assert {k: (v.content_md, v.tags) for k, v in got.items()} == {"u1": ("inline", ["a"]), "u2": ("looked up", ["b"])}
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>a</title><link>l1</link><author>x</author><updated>2024-01-02T00:00:00Z</updated></item><item><title>no link</title></item><item><title>c</title><link>l2</link><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item></channel></rss>")
    got = adapters.read("rss", spark, f"{tmp_path}/f.xml").collect()
    assert [r.url for r in got] == ["l1", "l2"] and all(r.published_at is not None and r.tags is None for r in got)
    assert len(adapters.read("rss", spark, f"{tmp_path}/f.xml", per_page=1).collect()) == 1
    item = lambda **k: {"question_id": 1, "title": "a &amp; b", "body": "<p>why</p>", "link": "q1", "score": 5, "creation_date": 1700000000, "is_answered": True, "tags": ["t"], "owner": {"display_name": "o"}} | k
    (tmp_path / "q.json").write_text(json.dumps({"items": [item(), item(question_id=2, link="q2", score=0), item(question_id=3, link="q3")]}))
    (tmp_path / "a.json").write_text(json.dumps({"items": [{"answer_id": 9, "question_id": 1, "body": "<p>because</p>", "score": 1, "is_accepted": False}]}))
    (tmp_path / "e.json").write_text(json.dumps({"error_id": 502, "error_message": "throttle"}))
    got = adapters.read("stackexchange", spark, f"{tmp_path}/q.json", answers=f"{tmp_path}/a.json").collect()
    assert [(r.url, r.content_md) for r in got] == [("q1", "# a & b\n\nwhy\n\n## Top answer\n\nbecause\n")]
    assert adapters.envelopes(spark, f"{tmp_path}/e.json").count() == 0
    try:
        adapters.read("nowhere", spark, "")
        raise AssertionError
    except KeyError:
        pass


def _message(i, url=None, text=None):
    body = text if text is not None else " ".join(f"w{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}" + " the" * (k % 6 == 0) + " of" * (k % 7 == 0) for k in range(120))
    return {"msg_id": f"{i:06d}", "value": json.dumps({"url": url or f"https://x.example/{i}", "title": f"t{i}", "source_type": f"s{i % 2}", "content_md": body, "tags": None})}


def test_stream_ingest(spark, tmp_path):
    landing, root = tmp_path / "in", tmp_path / "store"
    landing.mkdir()
    rows = [_message(i) for i in range(12)] + [_message(20, "https://x.example/3"), _message(21, text="short"), {"msg_id": "000022", "value": "not json"}, _message(23, text=json.loads(_message(5)["value"])["content_md"])]
    for k in range(4):
        (landing / f"{k}.json").write_text("\n".join(json.dumps(r) for r in rows[4 * k : 4 * k + 4]))
        os.utime(landing / f"{k}.json", (1700000000 + 60 * k,) * 2)  # the order of arrival
    job = Ingest(f"{root}")

    def run():
        job.start(message_stream(spark, str(landing), 2), f"{tmp_path}/cp").awaitTermination()

    run()
    done = {r.msg_id: r.outcome for r in job.table(spark, "outcomes").collect()}
    assert done["000020"] == "seen"
    assert done["000021"] == "too_short" and done["000023"] == "dup"
    stored = job.table(spark, "articles")
    assert stored.count() == 12 and stored.select("url_hash").distinct().count() == 12
    assert sorted(r.id for r in stored.select("id").collect()) == list(range(1, 13))
    assert [r.stream_msg_id for r in job.table(spark, "dead_letters").collect()] == ["000022"]
    run()  # nothing new
    job.batch(spark.createDataFrame(rows[:4], "msg_id string, value string"), 99)  # a batch replayed
    assert job.table(spark, "articles").count() == 12


def test_stream_dedup_is_stateful(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps(_message(10 * k + i, f"https://x.example/{i}")) for i in range(5)))
    q = distinct_urls(message_stream(spark, f"{tmp_path}/in", 1)).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t")
    schemas.create_tables(spark, "t")
    schemas.create_tables(spark, "t")
    assert spark.table("t.chunks").count() == 0
    assert schemas.evolve(spark.range(1).select(F.lit("u").alias("url"), F.lit(1).alias("other")), "articles").columns == schemas.empty(spark, "articles").columns
    spark.sql("DROP DATABASE t CASCADE")


def test_greedy_makes_few_pairs_where_much_is_near(spark, monkeypatch):
    """Dense fingerprints: each document against those kept before it; pairs only of what is left of a part."""
    r = random.Random(5)
    hashes = [r.getrandbits(13) << 40 for _ in range(6000)]
    df = spark.createDataFrame([(i, None if i == 5999 else h) for i, h in enumerate(hashes)], "id long, simhash long")
    kept = []
    for i, h in enumerate(hashes[:-1]):
        if not any((h ^ hashes[k]).bit_count() <= 3 for k in kept):
            kept.append(i)
    made, pairs = [], dedup.near_pairs

    def counted(*a):
        made.append(pairs(*a).count())
        return pairs(*a)

    monkeypatch.setattr(dedup, "near_pairs", counted)
    assert sorted(x.id for x in dedup.greedy_keep(df).collect()) == [*kept, 5999]  # nothing is near what has no fingerprint
    assert len(made) > 1 and sum(made) < 60_000 < pairs(df).count() / 3
