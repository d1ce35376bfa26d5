"""Further queries: sources, the log, routes and filters, samples, chunk exports, streams. Registered with the catalogue's."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fingerprint as fp
from ..functions import scalars as sc
from ..functions.markdown import unescape
from ..operators import dashboard as db
from ..operators import dedup, monitor, pacing, qa, rag, store
from ..sources import adapters
from .catalogue import ARTICLES_SQL, EVENTS_AS_OF, EXT_SQL, HOURS_SQL, OUTCOMES_SQL, RUNS_SQL, SAMPLES_SQL, SIMHASH_SQL, VECTORS_SQL, chunk_articles, chunk_sql, _naive, articles, articles_ext, outcomes, prints, query, runs, snapshots, source_deltas, table, vectors

# Sources -------------------------------------------------------------------------------------------------------------

LIST_SQL = f"""{ARTICLES_SQL}, items AS (SELECT id, url, crawled_at AS published_at, CASE id % 3 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x' END AS tags,
  CASE WHEN id % 4 > 0 THEN left(content_md, 50) WHEN id % 8 = 0 THEN concat('looked up ', id) ELSE '' END AS content_md FROM articles)"""


@query(f"WITH {LIST_SQL} SELECT url, published_at, tags, content_md FROM items WHERE published_at >= TIMESTAMP '2024-01-01 01:00:00'")
def SRC03_article_list(spark, sf_dir):
    """SRC03, SRC04, FN22, STR06: list items, tags of two shapes, bodies from the list or looked up, the window."""
    tags = F.when(F.col("id") % 3 == 0, '["a","b"]').when(F.col("id") % 3 == 1, '[{"name":"x"},{"name":""}]').otherwise("42")
    body = F.when(F.col("id") % 4 > 0, F.left("content_md", F.lit(50))).otherwise("")
    a = articles(spark, sf_dir)
    items = a.select("id", "url", F.lit("t").alias("title"), F.col("crawled_at").alias("published_at"), tags.alias("tag_list"), body.alias("body_markdown"), F.struct(F.lit("n").alias("name")).alias("user"))
    bodies = a.filter("id % 8 = 0").select("id", F.concat(F.lit("looked up "), F.col("id").cast("string")).alias("body"))
    rows = adapters.devto_rows(items, F.expr("TIMESTAMP '2024-01-01 01:00:00'"), bodies)
    return _naive(rows.select("url", "published_at", F.array_join("tags", ",").alias("tags"), "content_md"), "published_at")


_PAGE_TIME = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id::INT)"


@query(f"""SELECT url, published_at, author FROM (SELECT page_id, CASE WHEN page_id % 6 = 0 THEN '' WHEN page_id % 6 <> 1 THEN url END AS url,
  CASE WHEN page_id % 4 <> 0 THEN {_PAGE_TIME} WHEN page_id % 8 = 4 THEN {_PAGE_TIME} + INTERVAL 1 DAY END AS published_at,
  CASE WHEN page_id % 3 = 0 THEN 'c' ELSE 'a' END AS author FROM pages)
  WHERE url <> '' AND (published_at IS NULL OR published_at >= TIMESTAMP '2024-01-01 00:30:00') ORDER BY page_id % 3, page_id LIMIT 60""")
def SRC05_feed_items(spark, sf_dir):
    """SRC05-07, TOP09: items without a link go, published before updated, author before creator, the first by feed and place."""
    k, t = F.col("page_id"), F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 60)
    items = table(spark, sf_dir, "pages").select(
        F.when(k % 6 == 0, "").when(k % 6 != 1, F.col("url")).alias("link"), F.lit("t").alias("title"), F.lit("g").alias("guid"), F.lit("d").alias("description"),
        F.when(k % 3 == 0, "").otherwise("a").alias("author"), F.lit("c").alias("creator"), F.when(k % 4 != 0, t).alias("published"),
        F.when(k % 8 != 0, t + F.expr("INTERVAL 1 DAY")).alias("updated"), F.lit(None).cast("string").alias("pubDate"), (k % 3).alias("feed"), k.alias("pos"),
    )
    return _naive(adapters.rss_rows(items, F.expr("TIMESTAMP '2024-01-01 00:30:00'"), 60).select("url", "published_at", "author"), "published_at")


QUESTIONS_SQL = "questions AS (SELECT conv_id AS question_id, (conv_id * 13) % 9 - 2 AS score, conv_id % 3 <> 0 AS is_answered FROM (SELECT DISTINCT conv_id FROM conversations))"


def _questions(spark, sf_dir):
    k = F.col("question_id")
    q = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("question_id")).distinct()
    return q.select(k, ((k * 13) % 9 - 2).cast("int").alias("score"), (k % 3 != 0).alias("is_answered"))


@query(f"WITH {QUESTIONS_SQL} SELECT question_id, score FROM questions WHERE score >= 1 AND is_answered")
def FLT11_triage(spark, sf_dir):
    return adapters.triage(_questions(spark, sf_dir)).select("question_id", F.col("score").cast("long").alias("score"))


@query(f"WITH {QUESTIONS_SQL}, b AS (SELECT conv_id AS question_id, arg_min(text, turn) AS body FROM conversations WHERE role = 'user' AND conv_id % 5 <> 0 GROUP BY 1) SELECT question_id, body FROM questions LEFT JOIN b USING (question_id)")
def JON05_question_bodies(spark, sf_dir):
    b = table(spark, sf_dir, "conversations").filter("role = 'user' AND conv_id % 5 <> 0").groupBy(F.col("conv_id").alias("question_id")).agg(F.min_by("text", "turn").alias("body"))
    return _questions(spark, sf_dir).select("question_id").join(b, "question_id", "left")


@query("WITH e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos FROM events) SELECT event_id AS question_id, pos::INT AS pos, (event_id % 7)::INT AS score FROM e WHERE user_id % 4 <> 0")
def SRC09_envelopes(spark, sf_dir):
    """Answers of a service as JSON texts, a user's events in each; every fourth user's is an error."""
    e = table(spark, sf_dir, "events")
    item = F.struct(F.col("event_id").alias("question_id"), (F.col("event_id") % 7).alias("score"))
    raw = e.groupBy("user_id").agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"))).alias("ok"))
    value = F.when(F.col("user_id") % 4 == 0, '{"error_id":502,"error_message":"throttle"}').otherwise(F.col("ok"))
    return adapters.opened(raw.select(F.from_json(value, adapters.ENVELOPE).alias("e")).select("e.*")).select("question_id", "pos", "score")


@query(f"WITH {ARTICLES_SQL} SELECT id, crawled_at AS published_at FROM articles ORDER BY crawled_at DESC LIMIT 40")
def TOP05_newest_first(spark, sf_dir):
    a = articles(spark, sf_dir).select("id", F.col("crawled_at").alias("published_at"), F.col("id").alias("pos"))
    return _naive(adapters.newest_first(a).limit(40).drop("pos"), "published_at")


PAGES_SQL = "results AS (SELECT concat('s', user_id % 3) AS source, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) AS page, event_id % 97 = 50 AS empty, event_id % 13 = 5 AS failed FROM events)"


@query(f"""WITH {PAGES_SQL}, before AS (SELECT *, coalesce(count(*) FILTER (failed) OVER w, 0) AS f, coalesce(count(*) FILTER (empty) OVER w, 0) AS e FROM results WINDOW w AS (PARTITION BY source ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT source, page FROM before WHERE e = 0 AND f < 5 AND page <= 200""")
def STR12_pages_taken(spark, sf_dir):
    from pyspark.sql import Window

    k = F.col("user_id") % 3
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("s"), k.cast("string")).alias("source"), F.row_number().over(Window.partitionBy(k).orderBy("event_id")).cast("long").alias("page"), (F.col("event_id") % 97 == 50).alias("empty"), F.when(F.col("event_id") % 13 == 5, "failed").alias("error"))
    return adapters.pages_taken(e, 200, 5).select("source", "page")


@query("SELECT page_id // 25 AS page, min(page_id) AS oldest FROM pages GROUP BY 1")
def AGG19_oldest_by_page(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(F.floor(F.col("page_id") / 25).alias("page")).agg(F.min("page_id").alias("oldest"))


# The log and the store -----------------------------------------------------------------------------------------------

LOG_SQL = f"""{ARTICLES_SQL}, old AS (SELECT id, url_hash FROM articles WHERE id % 5 = 0), seen AS (SELECT url_hash FROM articles WHERE id % 5 = 0 OR id % 7 = 0),
fresh AS (SELECT min(id) AS id, url_hash FROM (SELECT id + 1000000 AS id, url_hash FROM articles UNION ALL SELECT id + 2000000, url_hash FROM articles) WHERE url_hash NOT IN (SELECT url_hash FROM seen) GROUP BY url_hash)"""


@query(f"WITH {LOG_SQL} SELECT * FROM (SELECT id, url_hash FROM old UNION ALL SELECT id, url_hash FROM fresh) ORDER BY id DESC LIMIT 500")
def SNK01_publish(spark, sf_dir):
    """SNK01, JON01, STR08: unseen URLs join the log, of which the latest 500 stay."""
    a = articles(spark, sf_dir).select("id", "url_hash")
    new = a.select((F.col("id") + 1000000).alias("id"), "url_hash").union(a.select((F.col("id") + 2000000).alias("id"), "url_hash"))
    return store.publish(new, a.filter("id % 5 = 0"), a.filter("id % 5 = 0 OR id % 7 = 0"), "url_hash", "id", 500)


@query(f"WITH {SIMHASH_SQL} SELECT b::INT AS band, ((simhash::HUGEINT & 18446744073709551615::HUGEINT) >> (48 - 16 * b)) & 65535 AS bucket, simhash FROM prints, (VALUES (0), (1), (2), (3)) t(b) WHERE id % 10 >= 3")
def SNK15_index_rows(spark, sf_dir):
    """SNK15, SNK16, FLT15: the index made from stored fingerprints, less what is older than a week."""
    p = prints(spark, sf_dir).withColumn("age", F.when(F.col("id") % 10 < 3, 8).otherwise(2))
    at = F.expr("TIMESTAMP '2024-01-10 00:00:00'") - F.make_dt_interval(F.col("age"))
    rows = dedup.lsh_rows(p.filter("simhash IS NOT NULL"), fp.bands(F.col("simhash")), at)
    return dedup.unexpired(rows, F.expr("TIMESTAMP '2024-01-10 00:00:00'"), 7).select("band", "bucket", "simhash")


@query(f"WITH {SIMHASH_SQL} SELECT x.id AS id, bit_count(xor(x.simhash, y.simhash))::INT AS distance FROM prints x JOIN prints y ON y.id = x.id + 1")
def FN05_hamming(spark, sf_dir):
    p = prints(spark, sf_dir)
    after = p.select((F.col("id") - 1).alias("id"), F.col("simhash").alias("h"))
    return p.join(after, "id").select("id", fp.hamming(F.col("simhash"), F.col("h")).alias("distance"))


@query("SELECT doc_id AS id, len(regexp_extract_all(lower(text), '[a-z0-9_]+')) AS n_tokens FROM documents")
def FN03_tokens(spark, sf_dir):
    from ..functions.text import TOKEN, all_of

    return articles(spark, sf_dir).select("id", F.size(all_of(F.lower("content_md"), TOKEN)).cast("long").alias("n_tokens"))


@query(f"WITH {RUNS_SQL} SELECT source, max(finished_at) AS finished_at, arg_max(pages, finished_at) AS pages FROM runs GROUP BY source")
def WIN06_latest_runs(spark, sf_dir):
    return _naive(monitor.latest_runs(runs(spark, sf_dir)).select("source", "finished_at", "pages"), "finished_at")


@query(f"WITH {ARTICLES_SQL} SELECT count(*) AS n FROM articles")
def AGG17_row_count(spark, sf_dir):
    return articles(spark, sf_dir).agg(F.count("*").alias("n"))


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', {n})" for t, n in (("articles", 13), ("fingerprints", 4), ("dead_letters", 7), ("outcomes", 5), ("runs", 7), ("snapshots", 8), ("chunks", 14))) + ") t(name, columns)")
def DDL01_tables(spark, sf_dir):
    """The store's tables with their numbers of columns."""
    from .. import schemas

    return spark.createDataFrame([(k, len(schemas.empty(spark, k).columns)) for k in schemas.TABLES], "name string, columns int")


# Filters and routes --------------------------------------------------------------------------------------------------


@query(f"WITH {ARTICLES_SQL} SELECT id, CASE WHEN id % 3 > 0 THEN 'inline' ELSE 'fetch' END AS way FROM articles WHERE language IN ('en', 'de')")
def FLT02_way(spark, sf_dir):
    """FLT02, FLT04: a body that came along is taken as it is, others are fetched; languages to keep."""
    a = articles(spark, sf_dir).filter(F.col("language").isin("en", "de"))
    body = F.when(F.col("id") % 3 == 1, F.col("content_md")).when(F.col("id") % 3 == 2, "x").otherwise("")
    return a.select("id", F.when(F.length(body) > 0, "inline").otherwise("fetch").alias("way"))


@query(f"WITH {ARTICLES_SQL} SELECT id, url, CASE WHEN id % 11 = 0 THEN NULL ELSE length(content_md) END AS n FROM articles WHERE id > 200 AND id % 11 <> 0")
def FLT09_after_watermark(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("content_md", F.when(F.col("id") % 11 != 0, F.col("content_md")))
    return a.filter((F.col("id") > 200) & F.col("content_md").isNotNull()).select("id", "url", F.length("content_md").cast("long").alias("n"))


@query(f"WITH {HOURS_SQL} SELECT taken_at, produced, stored FROM snapshots WHERE taken_at >= {EVENTS_AS_OF} - INTERVAL 168 HOURS")
def FLT10_recent_samples(spark, sf_dir):
    """FLT10, FLT16, TOP07: more hours than allowed are taken as the most."""
    s = snapshots(spark, sf_dir).withColumn("taken_at", F.col("taken_at").cast("timestamp"))
    return _naive(db.recent(s, F.expr(EVENTS_AS_OF), 1000), "taken_at")


@query(f"WITH {ARTICLES_SQL} SELECT id FROM articles WHERE (id % 10 = 4 OR quality_score >= 0.6) AND source_type = 'src3'")
def FLT12_score_or_null(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("quality_score", F.when(F.col("id") % 10 != 4, F.col("quality_score")))
    return a.filter((F.col("source_type") == "src3") & (F.col("quality_score").isNull() | (F.col("quality_score") >= 0.6))).select("id")


@query(f"WITH {ARTICLES_SQL} SELECT id, length(content_md) AS content_len, left(content_md, 300) AS preview FROM articles")
def FLT14_preview(spark, sf_dir):
    return articles(spark, sf_dir).select("id", F.length("content_md").cast("long").alias("content_len"), F.left("content_md", F.lit(300)).alias("preview"))


@query(f"WITH {ARTICLES_SQL} SELECT id, url FROM articles WHERE length(content_md) >= 200 ORDER BY id LIMIT 25")
def TOP04_export_limit(spark, sf_dir):
    return db.corpus(articles(spark, sf_dir), limit=25).select("id", "url")


# Scalars -------------------------------------------------------------------------------------------------------------


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'a,b' WHEN 1 THEN 'x' WHEN 4 THEN '' END AS tags FROM events")
def FN22_tags(spark, sf_dir):
    k = F.col("event_id") % 5
    raw = F.when(k == 0, '["a","b"]').when(k == 1, '[{"name":"x"},{"name":""}]').when(k == 2, "42").when(k == 4, "[]")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(sc.tags_of(raw), ",").alias("tags"))


@query("SELECT event_id, CASE event_id % 6 WHEN 0 THEN 30.0 WHEN 1 THEN -5.0 WHEN 2 THEN 30.0 WHEN 3 THEN 0.0 END::DOUBLE AS wait, CASE event_id % 6 WHEN 0 THEN 30.0 WHEN 1 THEN 0.0 END::DOUBLE AS seconds FROM events")
def FN24_retry_after(spark, sf_dir):
    values = ["30", "-5", "Tue, 04 Aug 2026 12:00:00 GMT", "Tue, 04 Aug 2020 12:00:00 GMT", "soon"]
    v = F.try_element_at(F.array(*map(F.lit, values)), (F.col("event_id") % 6 + 1).cast("int"))
    now = F.expr("TIMESTAMP '2026-08-04 11:59:30'")
    return table(spark, sf_dir, "events").select("event_id", sc.retry_after_web(v, now).alias("wait"), sc.retry_after_seconds(v).alias("seconds"))


@query("SELECT conv_id, turn, concat('<b> & ''', turn, ' ü') AS title FROM conversations")
def FN33_unescape(spark, sf_dir):
    raw = F.concat(F.lit("&lt;b&gt; &amp; &#39;"), F.col("turn").cast("string"), F.lit(" &uuml;"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", unescape(raw).alias("title"))


@query(f"WITH {VECTORS_SQL} SELECT x.vec_id, round(list_cosine_similarity(x.e, y.e), 4) AS score FROM vectors x JOIN vectors y ON y.vec_id = x.vec_id + 1")
def FN36_cosine(spark, sf_dir):
    v = vectors(spark, sf_dir).select("vec_id", "embedding")
    after = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return v.join(after, "vec_id").select("vec_id", sc.rounded(sc.cosine(F.col("embedding"), F.col("other")), 4).alias("score"))


@query(f"WITH {ARTICLES_SQL} SELECT id, ((row_number() OVER (PARTITION BY source_type ORDER BY id) - 1) // 32)::BIGINT AS batch FROM articles")
def FN40_batches(spark, sf_dir):
    return rag.batches_of(articles(spark, sf_dir).select("id", "source_type"), 32, "id").select("id", "batch")


@query("SELECT event_id, TIMESTAMP '2023-11-14 22:13:20' + to_seconds(event_id) AS at, strftime(TIMESTAMP '2023-11-14 22:13:20' + to_seconds(event_id), '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def FN41_times(spark, sf_dir):
    at = F.timestamp_seconds(F.lit(1700000000) + F.col("event_id"))
    return _naive(table(spark, sf_dir, "events").select("event_id", at.alias("at"), sc.iso(at).alias("iso")), "at")


@query("SELECT event_id // 32 AS request, string_agg(event_id::VARCHAR, ',' ORDER BY event_id DESC) AS ids FROM events GROUP BY 1")
def TOP11_request_order(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 32).alias("request"), (-F.col("event_id")).alias("index"), F.col("event_id").cast("string").alias("vector"))
    return rag.in_request_order(e).select("request", F.array_join("vectors", ",").alias("ids"))


@query(f"""WITH {VECTORS_SQL} SELECT chunk_id, '[' || array_to_string([format('{{:.6g}}', x * CASE vec_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1e7 ELSE 1e-4 END) for x in e], ',') || ']' AS vector,
  CASE WHEN vec_id % 4 = 0 THEN '{{}}' ELSE '{{"c' || vec_id || '","a\\"b"}}' END AS labels FROM vectors""")
def FN35_literals(spark, sf_dir):
    """FN35: vectors at six significant digits and arrays of text, as a loader takes them."""
    k = F.col("vec_id")
    scale = F.when(k % 3 == 0, 1.0).when(k % 3 == 1, 1e7).otherwise(1e-4)
    names = F.when(k % 4 == 0, F.array().cast("array<string>")).otherwise(F.array("chunk_id", F.lit('a"b')))
    return vectors(spark, sf_dir).select("chunk_id", sc.vector_literal(F.transform("embedding", lambda x: x.cast("double") * scale)).alias("vector"), sc.text_array_literal(names).alias("labels"))


CALLS_SQL = """calls AS (SELECT event_id, concat('h', user_id % 3) AS host, epoch_us(ts) // 1000 AS t, CASE user_id % 3 WHEN 0 THEN 2000000 WHEN 1 THEN 60000 ELSE 600000 END AS gap,
  CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 6 ELSE 2 END AS burst, CASE WHEN event_id % 37 = 0 THEN 900000 ELSE 0 END AS pause FROM events),
summed AS (SELECT *, gap + pause AS w, sum(gap + pause) OVER q AS total FROM calls WINDOW q AS (PARTITION BY host ORDER BY t, event_id)),
led AS (SELECT *, max(t + CASE WHEN pause > 0 THEN pause + gap * burst ELSE gap END - total) OVER (PARTITION BY host ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ahead FROM summed)"""


@query(f"WITH {CALLS_SQL} SELECT event_id, host, greatest(t, coalesce(ahead + total - w - (burst - 1) * gap, t))::BIGINT AS starts FROM led")
def STR13_call_times(spark, sf_dir):
    """STR13, STR14: when each event's call may start, with a rate and a burst for each host and pauses that hosts asked for."""
    k = F.col("user_id") % 3
    calls = table(spark, sf_dir, "events").select("event_id", "user_id", F.concat(F.lit("h"), k.cast("string")).alias("host"), F.expr("unix_millis(CAST(ts AS TIMESTAMP))").alias("at"))
    gap, burst = F.when(k == 0, 2_000_000).when(k == 1, 60_000).otherwise(600_000), F.when(k == 0, 1).when(k == 1, 6).otherwise(2)
    return pacing.call_times(calls, "host", "at", "event_id", gap, burst, F.when(F.col("event_id") % 37 == 0, 900_000)).select("event_id", "host", "starts")


@query("""SELECT user_id, event_id, count(*) OVER w * 32 AS done, round(count(*) OVER w * 32 / greatest(epoch(ts - TIMESTAMP '2024-01-01 00:00:00') / 60, 1e-9), 4) AS per_minute FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def FN43_progress(spark, sf_dir):
    """FN43: a user's events as a run's batches of 32."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.lit(32).alias("n"))
    p = pacing.progress(e, "user_id", "ts", "event_id", "n", F.expr("TIMESTAMP '2024-01-01 00:00:00'"))
    return p.select("user_id", "event_id", "done", sc.rounded(F.col("per_minute"), 4).alias("per_minute"))


# Counters ------------------------------------------------------------------------------------------------------------


@query(f"WITH {OUTCOMES_SQL} SELECT source_type, count(*) AS stored FROM outcomes WHERE outcome = 'stored' GROUP BY 1")
def AGG09_stored_by_source(spark, sf_dir):
    return outcomes(spark, sf_dir).filter("outcome = 'stored'").groupBy("source_type").agg(F.count("*").alias("stored"))


@query(f"WITH {OUTCOMES_SQL} SELECT source_type, count(*) AS produced FROM outcomes GROUP BY 1")
def AGG10_produced_by_source(spark, sf_dir):
    return outcomes(spark, sf_dir).groupBy("source_type").agg(F.count("*").alias("produced"))


@query("""WITH b AS (SELECT concat('u', user_id % 9) AS source, count(*) AS n FROM events WHERE event_id % 3 = 0 AND user_id % 9 <> 2 GROUP BY 1), a AS (SELECT concat('u', user_id % 9) AS source, count(*) AS n FROM events WHERE event_id % 2 = 0 AND user_id % 9 <> 4 GROUP BY 1)
SELECT coalesce(a.source, b.source) AS source, greatest(0, coalesce(a.n, 0) - coalesce(b.n, 0))::BIGINT AS delta FROM a FULL JOIN b ON a.source = b.source""")
def JON08_counter_growth(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("source", F.concat(F.lit("u"), (F.col("user_id") % 9).cast("string")))
    n = lambda cond: e.filter(cond).groupBy("source").agg(F.count("*").alias("n"))
    return monitor.counter_growth(n("event_id % 3 = 0 AND user_id % 9 <> 2"), n("event_id % 2 = 0 AND user_id % 9 <> 4"))


@query(f"""WITH {SAMPLES_SQL}, last AS (SELECT * FROM deltas WHERE taken_at = (SELECT max(taken_at) FROM deltas)),
tot AS (SELECT count(*) AS produced, count(*) FILTER (outcome = 'stored') AS stored, count(*) FILTER (outcome <> 'stored') AS rejected FROM outcomes)
SELECT produced, stored, rejected, 3 AS pending, 2 AS dlq, 7::BIGINT AS stream_len, (SELECT string_agg(source || '=' || produced_delta || '/' || stored_delta || '/' || rejected_delta, ',' ORDER BY source) FROM last) AS by_source FROM tot""")
def SNK07_snapshot(spark, sf_dir):
    d = source_deltas(spark, sf_dir)
    last = d.join(d.agg(F.max("taken_at").alias("taken_at")), "taken_at", "left_semi")
    s = monitor.snapshot(outcomes(spark, sf_dir), last, F.expr(EVENTS_AS_OF), 3, 2, 7)
    flat = F.transform(F.map_entries("by_source"), lambda e: F.concat(e["key"], F.lit("="), *[x for i, k in enumerate(("produced", "stored", "rejected")) for x in ([F.lit("/")] * (i > 0) + [e["value"][f"{k}_delta"].cast("string")])]))
    return s.select("produced", "stored", "rejected", "pending", "dlq", "stream_len", F.array_join(flat, ",").alias("by_source"))


@query("SELECT source, lang FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT source, lang FROM documents WHERE doc_id % 3 <> 0")
def SET03_concatenation(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return d.filter("doc_id % 3 = 0").unionByName(d.filter("doc_id % 3 <> 0")).drop("doc_id")


# Chunks --------------------------------------------------------------------------------------------------------------


@query(f"""WITH {ARTICLES_SQL}, {chunk_sql('articles')} SELECT to_json({{'chunk_id': left(sha256(url), 16) || '_' || chunk_index, 'article_id': id, 'heading_path': path, 'chunk_index': chunk_index, 'n_chunks': n_chunks, 'n': length(text)}}) AS value FROM chunks WHERE id > 0""")
def SNK12_chunk_lines(spark, sf_dir):
    """SNK12, FLT13, AGG16: the JSON lines of all articles' chunks."""
    c = rag.chunks(chunk_articles(spark, sf_dir)).withColumn("n", F.length("text"))
    return db.as_json(c, ["chunk_id", "article_id", "heading_path", "chunk_index", "n_chunks", "n"])


@query(f"WITH {EXT_SQL}, {chunk_sql('ext', 1)} SELECT id AS article_id, array_to_string(path, '/') AS path, chunk_index FROM chunks WHERE len(path) > 0")
def WIN08_heading_paths(spark, sf_dir):
    """FN17, WIN08, WIN05: where all articles' chunks under headings stand."""
    c = rag.chunks(chunk_articles(spark, sf_dir, articles_ext), min_chars=1).filter(F.size("heading_path") > 0)
    return c.select("article_id", F.array_join("heading_path", "/").alias("path"), "chunk_index")


# Streams -------------------------------------------------------------------------------------------------------------


def _messages(spark, sf_dir):
    a = articles(spark, sf_dir)
    value = F.to_json(F.struct("url", F.lit("t").alias("title"), F.col("crawled_at").cast("string").alias("published_at"), "source_type", "content_md"))
    return a.select(F.lpad(F.col("id").cast("string"), 9, "0").alias("msg_id"), F.when(F.col("id") % 50 == 7, "no json").otherwise(value).alias("value"))


@query()
def STR01_stream_ingest(spark, sf_dir):
    """STR01, STR02, STR04, STR07: all documents as messages in a landing folder, ingested by a stream; what became of each."""
    from ..streaming.ingest import Ingest, message_stream

    root = store.work_path(spark, "ingest")
    _messages(spark, sf_dir).write.json(f"{root}/landing", compression="gzip")
    job = Ingest(f"{root}/store")
    job.start(message_stream(spark, f"{root}/landing"), f"{root}/checkpoint").awaitTermination()
    return job.table(spark, "outcomes").select("msg_id", "source_type", "outcome")


@query("SELECT concat('https://', source, '.example.com/doc/', doc_id) AS url FROM documents WHERE doc_id % 50 <> 7")
def STR03_stream_urls(spark, sf_dir):
    """The first message of each URL, by a stateful stream over two copies of every message."""
    from ..streaming.ingest import distinct_urls, message_stream

    root = store.work_path(spark, "urls")
    m = _messages(spark, sf_dir).filter("value <> 'no json'")
    m.union(m).write.json(f"{root}/landing")
    distinct_urls(message_stream(spark, f"{root}/landing")).writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out").awaitTermination()
    return spark.read.schema("value STRING").parquet(f"{root}/out").select(F.get_json_object("value", "$.url").alias("url"))
