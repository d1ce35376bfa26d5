import json

import pytest
from pyspark.sql import functions as F

from millrace import schemas
from millrace.__main__ import parser, run
from millrace.api import Corpus
from millrace.operators import rag, store
from millrace.sources import adapters

QA = "# How {}\n\nquestion {}\n\n## Top answer\n\n" + "an answer that is long enough to be kept " * 4


@pytest.fixture
def corpus(spark, tmp_path):
    rows = [(i, f"https://x.example/{i}", f"t{i}", QA.format(i % 6, i), "stackexchange" if i % 2 else "rss", ["en", "de"][i % 2], 0.1 * (i % 10), None) for i in range(1, 13)]
    a = spark.createDataFrame(rows, "id long, url string, title string, content_md string, source_type string, language string, quality_score double, content_hash long")
    a = schemas.evolve(a.withColumns({"url_hash": F.sha2("url", 256), "crawled_at": F.expr("TIMESTAMP '2024-01-01 12:00:00'"), "published_at": F.expr("TIMESTAMP '2024-01-01 00:00:00'")}), "articles")
    a.write.parquet(f"{tmp_path}/store/articles")
    return Corpus(spark, f"{tmp_path}/store", F.expr("TIMESTAMP '2024-01-03 00:00:00'"))


def test_dashboard(corpus):
    assert corpus.summary().first().asDict() == {"total": 12, "languages": 2, "last_24h": 0}
    assert [r.n for r in corpus.lang_dist().collect()] == [6, 6] and corpus.source_dist().count() == 2 and corpus.daily(5).first().n == 12
    page, total = corpus.list(lang="en", page=2, page_size=4)
    assert [r.id for r in page.collect()] == [4, 2] and total.first().asDict() == {"total": 6, "pages": 2}
    assert corpus.article(3).count() == 1 and corpus.article(99).count() == 0
    assert corpus.pipeline().first().produced == 0 and corpus.health()["overall"].first().status == "ok"
    assert {r.reason: r.n for r in corpus.quality_probe(5).collect()} == {"low_diversity": 5} or corpus.quality_probe(5).agg(F.sum("n")).first()[0] == 5
    for bad in (lambda: corpus.daily(0), lambda: corpus.list(page=0), lambda: corpus.list(page_size=101), lambda: corpus.search("a"), lambda: corpus.search("abc", 33), lambda: corpus.search("abc", min_quality=2.0)):
        with pytest.raises(ValueError):
            bad()


def test_exports(corpus, spark, tmp_path):
    corpus.export(f"{tmp_path}/c", limit=3, min_len=10, lang="en")
    assert [json.loads(r.value)["id"] for r in spark.read.text(f"{tmp_path}/c").collect()] == [2, 4, 6]
    corpus.export_sft(f"{tmp_path}/s", "sharegpt")
    assert sorted(json.loads(r.value)["conversations"][0]["from"] for r in spark.read.text(f"{tmp_path}/s").collect()) == ["human"] * 3
    with pytest.raises(ValueError):
        corpus.export_sft(f"{tmp_path}/s", "other")


def test_chunks_vectors_search(corpus, spark, tmp_path):
    out, state, archive = f"{tmp_path}/chunks", f"{tmp_path}/state", f"{tmp_path}/vectors"
    assert corpus.rag_export(out, state) == 12 and store.watermark(spark, state) == 12
    n = spark.read.text(out).count()
    corpus.rag_export(out, state)  # nothing new
    assert spark.read.text(out).count() == n
    corpus.rag_export(out, state, full=True)
    assert rag.read_chunks(spark, out).count() == n
    calls = []

    def failing(texts):
        calls.append(texts)
        raise OSError("no service")

    assert corpus.embed(out, archive, embedder=failing) == (0, n) and spark.read.parquet(f"{archive}/failed").count() == n
    assert corpus.embed(out, archive) == (n, 0) and corpus.embed(out, archive) == (0, 0)
    assert corpus.import_vectors(out, archive, initial=True) == n and corpus.import_vectors(out, archive) == n
    found = corpus.search("question 7", 3, source="stackexchange").collect()
    assert len(found) == 3 and all(r.source_type == "stackexchange" for r in found) and found[0].score >= found[-1].score
    assert corpus.sync_vectors() == n and corpus.sync_vectors(initial=True) == n


def test_upkeep(corpus, spark, tmp_path):
    assert corpus.backfill_simhash() == 0 and corpus.articles.count() == 12
    letters = spark.createDataFrame([(f"{i:03d}", "u", "t", "fetch", "d", f"body {i}") for i in range(5)], "stream_msg_id string, url string, title string, reason string, detail string, article string")
    schemas.evolve(letters, "dead_letters").write.parquet(f"{corpus.root}/dead_letters")
    land = f"{tmp_path}/land"
    assert corpus.dlq_replay(land, 2, dry_run=True) == 2 and corpus.table("dead_letters").count() == 5
    assert corpus.dlq_replay(land, 2, delete=True) == 2
    assert sorted(r.msg_id for r in spark.read.json(land).collect()) == ["000", "001"] and corpus.table("dead_letters").count() == 3
    deltas = spark.createDataFrame([("a", 1, 1, 0)], "source string, produced_delta long, stored_delta long, rejected_delta long")
    corpus.sample(deltas)
    Corpus(spark, corpus.root, F.expr("TIMESTAMP '2024-01-11 00:00:00'")).sample(deltas)
    s = corpus.table("snapshots").collect()
    assert len(s) == 1 and s[0].dlq == 3 and s[0].by_source["a"].produced_delta == 1


def test_shell(corpus, spark, tmp_path):
    ask = lambda *a: run(spark, parser().parse_args([a[0], corpus.root, *a[1:]]))
    assert ask("summary").first().total == 12
    assert [x.count() for x in ask("articles", "--lang", "en", "--page-size", "5")] == [5, 1]
    ask("export", "--out", f"{tmp_path}/o", "--min-len", "10")
    assert spark.read.text(f"{tmp_path}/o").count() == 12
    assert ask("rag-export", "--out", f"{tmp_path}/r", "--state", f"{tmp_path}/w", "--full") == 12
    assert len(ask("health")) == 3 and ask("quality-probe", "--limit", "3").agg(F.sum("n")).first()[0] == 3


def test_pages_end_at_empty_or_broken(spark):
    pages = [("a", 1, False, None), ("a", 2, True, None), ("a", 3, False, None), ("b", 1, False, "x"), ("b", 2, False, "x"), ("b", 3, False, None)]
    d = spark.createDataFrame(pages, "source string, page int, empty boolean, error string")
    taken = adapters.pages_taken(d, breaker=2)
    assert sorted((r.source, r.page) for r in taken.collect()) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert adapters.pages_taken(d, 1).count() == 2
