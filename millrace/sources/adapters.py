"""Sources: saved responses of the crawled services as rows of the article message, found by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.markdown import extract_content, unescape
from ..functions.scalars import fetch_outcome, tags_of
from ..operators.qa import best_answers, compose

MESSAGE = ["url", "title", "author", "published_at", "tags", "source_type", "content_md"]
SOURCES: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    def add(f):
        SOURCES[name] = f
        return f

    return add


def read(name: str, spark: SparkSession, path: str, **kw) -> DataFrame:
    """Rows of the named source; an unknown name is an error."""
    if name not in SOURCES:
        raise KeyError(f"no such source: {name}; there are {', '.join(sorted(SOURCES))}")
    return SOURCES[name](spark, path, **kw)


def _since(df: DataFrame, since: Column | None) -> DataFrame:
    """Rows in the window; those without a time stay."""
    return df if since is None else df.filter(F.col("published_at").isNull() | (F.col("published_at") >= since))


DEVTO = "id BIGINT, url STRING, title STRING, published_at TIMESTAMP, tag_list STRING, body_markdown STRING, user STRUCT<name: STRING>"
FEED = "link STRING, title STRING, guid STRING, description STRING, author STRING, creator STRING, published TIMESTAMP, updated TIMESTAMP, pubDate STRING"
ITEM = (
    "question_id: BIGINT, answer_id: BIGINT, title: STRING, body: STRING, link: STRING, score: INT, creation_date: BIGINT, "
    "is_answered: BOOLEAN, is_accepted: BOOLEAN, tags: ARRAY<STRING>, owner: STRUCT<display_name: STRING>"
)
ENVELOPE = f"error_id INT, error_message STRING, backoff INT, items ARRAY<STRUCT<{ITEM}>>"


def devto_rows(items: DataFrame, since: Column | None = None, bodies: DataFrame | None = None) -> DataFrame:
    """Messages of list items (DEVTO). A body in the list wins over one looked up by id; no body: empty."""
    rows = items.join(bodies.toDF("id", "looked_up"), "id", "left") if bodies is not None else items.withColumn("looked_up", F.lit(None).cast("string"))
    out = rows.select("url", "title", F.col("user.name").alias("author"), "published_at", tags_of(F.col("tag_list")).alias("tags"), F.lit("devto").alias("source_type"), F.coalesce(F.nullif("body_markdown", F.lit("")), "looked_up", F.lit("")).alias("content_md"))
    return _since(out, since)


@source("devto")
def devto(spark: SparkSession, path: str, since: Column | None = None, bodies: DataFrame | None = None) -> DataFrame:
    """Article lists, saved as JSON arrays."""
    return devto_rows(spark.read.schema(DEVTO).option("multiLine", True).json(path), since, bodies)


def rss_rows(items: DataFrame, since: Column | None = None, per_page: int = 100) -> DataFrame:
    """Messages of feed items (FEED, and feed and pos for the order of arrival): without a link dropped, the first per_page."""
    dated = F.try_to_timestamp(F.regexp_replace("pubDate", r"^[A-Za-z]{3}, | (GMT|\+0000)$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    out = items.filter(F.col("link").isNotNull() & (F.col("link") != "")).withColumn("published_at", F.coalesce("published", dated, "updated"))
    out = _since(out, since).orderBy("feed", "pos").limit(per_page)
    return out.select(F.col("link").alias("url"), "title", F.coalesce(F.nullif("author", F.lit("")), "creator").alias("author"), "published_at", F.lit(None).cast("array<string>").alias("tags"), F.lit("rss").alias("source_type"), F.left(F.coalesce("description", F.lit("")), F.lit(10000)).alias("content_md"))


@source("rss")
def rss(spark: SparkSession, path: str, since: Column | None = None, per_page: int = 100, row_tag: str = "item") -> DataFrame:
    """Feeds, saved as XML; files in order of their names."""
    items = spark.read.format("xml").option("rowTag", row_tag).schema(FEED).load(path)
    return rss_rows(items.withColumns({"feed": F.input_file_name(), "pos": F.monotonically_increasing_id()}), since, per_page)


def opened(envelopes: DataFrame) -> DataFrame:
    """Items of envelopes (ENVELOPE) with their place; one with an error id has none."""
    return envelopes.filter("error_id IS NULL").select(F.posexplode("items").alias("pos", "item")).select("pos", "item.*")


def envelopes(spark: SparkSession, path: str) -> DataFrame:
    return opened(spark.read.schema(ENVELOPE).option("multiLine", True).json(path))


def triage(questions: DataFrame, min_score: int = 1, answered: bool = True) -> DataFrame:
    fit = F.col("score") >= min_score
    return questions.filter(fit & F.col("is_answered") if answered else fit)


@source("stackexchange")
def stackexchange(spark: SparkSession, path: str, answers: str | None = None, bodies: str | None = None, min_score: int = 1, answered: bool = True, since: Column | None = None) -> DataFrame:
    """Questions of a listing with bodies and best answers, as one document each; newest first."""
    q = triage(envelopes(spark, path), min_score, answered)
    if bodies:
        q = q.drop("body").join(envelopes(spark, bodies).select("question_id", "body").dropDuplicates(["question_id"]), "question_id", "left")
    a = envelopes(spark, answers).select("question_id", "pos", "score", F.coalesce("is_accepted", F.lit(False)).alias("accepted"), "body") if answers else None
    if a is None:
        q = q.withColumn("answer", F.lit(None).cast("string"))
    else:
        best = best_answers(a).select("question_id", F.col("body").alias("answer"))
        q = q.join(best, "question_id", "inner" if answered else "left")
    text = compose(unescape(F.col("title")), extract_content(F.concat(F.lit("<body>"), "body", F.lit("</body>"))), extract_content(F.concat(F.lit("<body>"), "answer", F.lit("</body>"))))
    out = q.select(F.col("link").alias("url"), unescape(F.col("title")).alias("title"), unescape(F.col("owner.display_name")).alias("author"), F.timestamp_seconds("creation_date").alias("published_at"), "tags", F.lit("stackexchange").alias("source_type"), text.alias("content_md"), "pos")
    return newest_first(_since(out.filter("content_md IS NOT NULL"), since)).drop("pos")


def newest_first(rows: DataFrame) -> DataFrame:
    """By time of publication, the latest first; equal times in their order of arrival."""
    return rows.orderBy(F.desc("published_at"), "pos")


def pages_taken(pages: DataFrame, max_pages: int = 0, breaker: int = 5) -> DataFrame:
    """Of a source's page results (source, page, empty, error) those up to where its run ends: at the first empty page, at
    the breaker-th page in all that failed, or at max_pages (0: no bound). A source's pages are few; sources run apart."""
    before = Window.partitionBy("source").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    failed = F.coalesce(F.count_if(F.col("error").isNotNull()).over(before), F.lit(0))
    ended = F.coalesce(F.count_if(F.col("empty")).over(before), F.lit(0))
    within = F.col("page") <= max_pages if max_pages else F.lit(True)
    return pages.withColumns({"__f": failed, "__e": ended}).filter((F.col("__e") == 0) & (F.col("__f") < breaker) & within).drop("__f", "__e")


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def route(messages: DataFrame, fetched: DataFrame) -> DataFrame:
    """Messages with text and outcome: the text that came along, else the fetched page's (url, status, html).

    Only pages that are needed are extracted. A page that isn't there, or failed for now, is to be retried.
    """
    inline = F.coalesce(F.length("content_md"), F.lit(0)) > 0
    direct = messages.filter(inline).withColumn("outcome", F.lit("ok"))
    p = messages.filter(~inline).drop("content_md").join(fetched, "url", "left")
    status = fetch_outcome(F.col("status"))
    got = p.withColumn("outcome", status).withColumn("content_md", extract_content(F.when(status == "ok", F.col("html"))))
    got = got.withColumn("outcome", F.when((F.col("outcome") == "ok") & F.col("content_md").isNull(), "extract_fail").when(F.col("outcome") == "gone", "not_found").otherwise(F.col("outcome")))
    return direct.unionByName(got.select(*direct.columns))
