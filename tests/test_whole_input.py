"""Queries over whole inputs: nothing is cut or filtered out before the operator."""

import json
import re

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.functions.fingerprint import simhash_of
from millrace.operators import dedup
from millrace.plans import catalogue
from millrace.streaming.ingest import Ingest

Q = catalogue.queries()


def test_gate_sees_whole_texts(spark, data):
    texts = {r.doc_id: r.text for r in catalogue.table(spark, data, "documents").filter("doc_id % 7 = 6").collect()}
    got = {r.id: r.len for r in Q["FN07_text_features"](spark, data).filter("id % 7 = 6").collect()}
    assert got == {k: len(v) for k, v in texts.items()}
    assert max(got.values()) > 90
    chunked = Q["FN19_chunks"](spark, data).filter("article_id % 7 = 6").groupBy("article_id").agg(F.sum(F.length("text")).alias("n"))
    assert all(r.n > 90 for r in chunked.collect() if len(texts[r.article_id].strip()) > 200)


def test_too_short(spark):
    df = spark.createDataFrame([(1, "a short note of some ten words is all there is"), (2, " ".join(a + b + a for a in "abcdefghijkl" for b in "abcdefghij"))], "id long, content_md string")
    assert {r.id: r.reason for r in tx.assess(df).collect()} == {1: "too_short", 2: "ok"}


def _chunks(text, least, target=1200, overlap=150):
    """(text, path) of each chunk, one paragraph after the other."""
    sections, path, lines = [], [], []
    for line in text.splitlines():
        if m := re.match(r"(#{1,6})\s+(.*\S)\s*$", line):
            sections.append((path, "\n".join(lines).strip()))
            path, lines = path[: len(m[1]) - 1] + [m[2]], []
        lines.append(line)
    sections.append((path, "\n".join(lines).strip()))
    out = []
    for path, body in sections:
        if len(body) <= target:
            out.append((body, path))
            continue
        paras, head = [p.strip() for p in re.split(r"\n\s*\n", body)], []
        while paras and all(re.match(r"#{1,6}\s+\S", x) for x in paras[0].splitlines()):
            head.append(paras.pop(0))
        held = []
        for p in paras:
            if held and len("\n\n".join([*held, p])) > target:
                out.append(("\n\n".join(head + held), path))
                tail = []
                while held and sum(len(x) + 2 for x in [held[-1], *tail]) <= overlap:
                    tail.insert(0, held.pop())
                held = tail
            held.append(p)
        out.append(("\n\n".join(head + held), path))
    return [(x, path) for x, path in out if x and len(x) >= least]


def test_chunk_exports_cover_long_articles(spark, tmp_path):
    para = lambda n, k: f"p{k} " + "word " * n
    texts = {
        1: "tiny", 103: "one paragraph that is a single chunk of its own", 105: "\n\n".join(para(20, k) for k in range(60)),
        110: "\n\n".join(para(5 + k % 90, k) for k in range(80)), 124: "# A\n\n" + "\n\n".join(para(50, k) for k in range(20)) + "\n## B\nshort end of the text, under B",
        131: "x" * 5000, 140: "# One\n\n# Two\n\n" + "\n\n".join(para(9, k) for k in range(90)), 152: "\n\n".join(para(300, k) for k in range(4)),
    }
    spark.createDataFrame([(k, v, "en", "src1", len(v)) for k, v in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want = {k: _chunks(v, 30) for k, v in texts.items()}
    assert sum(len(c) > 1 for c in want.values()) >= 5
    got = {(r.article_id, r.chunk_index): (r.n_chunks, r.text) for r in Q["WIN05_chunks"](spark, str(tmp_path)).collect()}
    assert got == {(k, i): (len(c), x) for k, c in want.items() if k > 100 for i, (x, _) in enumerate(c)}
    lines = [json.loads(r.value) for r in Q["SNK12_chunk_lines"](spark, str(tmp_path)).collect()]
    assert sorted((x["article_id"], x["chunk_index"], x["n_chunks"], x["n"], x["heading_path"]) for x in lines) == sorted((k, i, len(c), len(x), p) for k, c in want.items() for i, (x, p) in enumerate(c))
    ext = {k: _chunks(v + catalogue.EXTRA.get(k % 7, ""), 1) for k, v in texts.items()}
    paths = sorted((r.article_id, r.path, r.chunk_index) for r in Q["WIN08_heading_paths"](spark, str(tmp_path)).collect())
    assert paths == sorted((k, "/".join(p), i) for k, c in ext.items() for i, (_, p) in enumerate(c) if p)


def test_near_members_lose_no_link(spark):
    prints = [(1, 0), (2, 0), (3, 7), (4, 7), (5, 1 << 40 | 0xFF00), (6, -1), (7, 0), (8, -2)]
    df = spark.createDataFrame(prints, "id long, simhash long")
    near = {(a, b) for a, x in prints for b, y in prints if a < b and ((x ^ y) & (2**64 - 1)).bit_count() <= 3}
    pairs = {(r.a, r.b) for r in dedup.near_pairs(df).collect()}
    got = {r.id: (r.representative, r.links) for r in dedup.near_members(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 7: (1, 1), 3: (3, 1), 4: (3, 1), 5: (5, 0), 6: (6, 1), 8: (8, 1)}
    assert near == {(a, b) for a in got for b in got if a < b and (got[a][0] == got[b][0] or tuple(sorted((got[a][0], got[b][0]))) in pairs)}


def test_outcomes_do_not_depend_on_batches(spark, tmp_path):
    words = " ".join(f"{a}{b}{a}" + " the" * (k % 6 == 0) + " of" * (k % 7 == 0) for k, (a, b) in enumerate((a, b) for a in "abcdefghijkl" for b in "mnopqrstuv"))
    others = (f"{words} {a}{b}{c}" for a in "xyz" for b in "abcdefgh" for c in "ijklmnop")
    near = [t for t in others if 0 < (simhash_of(t) ^ simhash_of(words)).bit_count() <= 3][:2]
    assert len(near) == 2
    far = words[::-1].replace("eht", "the").replace("fo", "of")
    rows = [(f"{i:03d}", json.dumps({"url": f"https://x.example/{i}", "title": "t", "source_type": "s", "content_md": t})) for i, t in enumerate([words, near[0], far, near[1], words])]

    def outcomes(name, cuts):
        job = Ingest(f"{tmp_path}/{name}")
        for k, (a, z) in enumerate(cuts):
            job.batch(spark.createDataFrame(rows[a:z], "msg_id string, value string"), k)
        return {r.msg_id: r.outcome for r in job.table(spark, "outcomes").collect()}

    once = outcomes("once", [(0, 5)])
    assert once["000"] == "stored" and once["001"] == once["003"] == once["004"] == "dup"
    assert once == outcomes("each", [(i, i + 1) for i in range(5)]) == outcomes("some", [(0, 2), (2, 5)])


def test_every_event_is_counted(spark, data):
    e = catalogue.table(spark, data, "events")
    first = e.filter("user_id % 4 <> 0").count()
    assert Q["SRC09_envelopes"](spark, data).count() == first
    assert catalogue.runs(spark, data).count() == e.count()
    newest = [r.id for r in Q["TOP05_newest_first"](spark, data).collect()]
    assert newest == sorted((r.doc_id for r in catalogue.table(spark, data, "documents").select("doc_id").collect()), reverse=True)[:40]


def test_a_replay_changes_no_outcome(spark, tmp_path, monkeypatch):
    text = " ".join(a + b + a + " the of" for a in "abcdefghijkl" for b in "abcdefghij")
    rows = [(f"{i}", json.dumps({"url": f"https://x.example/{i % 3}", "title": "t", "source_type": "s", "content_md": f"{text} {'zyxw'[i] * 9}" if i < 3 else "short"})) for i in range(4)] + [("9", "no json")]
    batch = spark.createDataFrame(rows, "msg_id string, value string")
    job = Ingest(f"{tmp_path}/store", most_bits=0)

    def state():
        return sorted((r.msg_id, r.outcome) for r in job.table(spark, "outcomes").collect()), sorted((r.id, r.url) for r in job.table(spark, "articles").collect()), job.table(spark, "dead_letters").count()

    from millrace.streaming import ingest

    real = ingest.number_after

    def breaks(*args):
        if left.pop():
            raise OSError("lost")
        return real(*args)

    left = [0, 1]
    monkeypatch.setattr(ingest, "number_after", breaks)
    try:
        job.batch(batch, 0)  # stops after outcomes are decided
    except OSError:
        pass
    assert state()[1] == []
    job.batch(batch, 0)
    once = state()
    assert len(once[1]) == 3 and once[2] == 1 and {o for _, o in once[0]} == {"stored"}
    monkeypatch.setattr(ingest, "number_after", real)
    job.batch(batch, 0)  # all had been written
    assert state() == once
    job.batch(batch, 1)
    assert sum(o == "seen" for _, o in state()[0]) == 3


def test_near_duplicates_of_long_ago(spark, tmp_path):
    from millrace.operators import dedup as d

    index = spark.createDataFrame([(7, "2024-01-01 00:00:00"), (255 << 40, "2024-01-09 00:00:00")], "simhash long, at string").select("simhash", F.to_timestamp("at").alias("indexed_at"))
    new = spark.createDataFrame([(1, 5), (2, (255 << 40) + 1)], "id long, simhash long")
    as_of = F.expr("TIMESTAMP '2024-01-10 00:00:00'")
    assert {r.id for r in d.probe(new, d.unexpired(index, as_of, None)).collect()} == {1, 2}
    assert {r.id for r in d.probe(new, d.unexpired(index, as_of, 7)).collect()} == {2}


def test_search_in_blocks_equals_all_pairs(spark):
    import numpy as np

    from millrace.operators import dashboard

    g = np.random.default_rng(4)
    v = [(f"c{i}", (g.integers(-2, 3, 6)).astype(float).tolist()) for i in range(300)] + [("none", None), ("zero", [0.0] * 6)]
    df = spark.createDataFrame(v, "chunk_id string, embedding array<float>").repartition(5)
    q = [(i, v[i][1]) for i in range(0, 300, 7) if any(v[i][1])]
    got = dashboard.top_k_many(df, spark.createDataFrame(q, "query_id long, embedding array<float>"), 5, part=10)
    cos = lambda a, b: np.floor(np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) * 1e4 + 0.5) / 1e4
    want = {(i, c, s) for i, a in q for s, c in sorted(((cos(a, b), c) for c, b in v if b and any(b)), key=lambda x: (-x[0], x[1]))[:5]}
    assert {(r.query_id, r.chunk_id, r.score) for r in got.collect()} == want


def test_backfill_of_articles_without_text(spark, data, same, tmp_path):
    import duckdb

    d = catalogue.table(spark, data, "documents").limit(40)
    text = F.when(F.col("doc_id") % 5 == 1, "").when(F.col("doc_id") % 5 == 2, None).when(F.col("doc_id") % 5 == 3, "-- !").otherwise(F.col("text"))
    d.withColumn("text", text).write.parquet(f"{tmp_path}/documents.parquet")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    same(Q["SNK05_backfill"](spark, str(tmp_path)), c.sql(catalogue.oracle_sql()["SNK05_backfill"]))


def test_scores_look_once_at_each_text(spark, data):
    """Each pattern runs over a text as often as the score needs it; those of the gate's other rules aren't tried."""
    q = Q["FN12_quality_score"](spark, data)
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(tx.FENCE) == 1 and plan.count("(?U)" + tx.LINK) == 1 and tx.SPAM not in plan and tx.HELP_ASKED not in plan
    odd = spark.createDataFrame([(1, ""), (2, None), (3, "one word")], "id long, content_md string")
    assert {r.id: (r.reason, r.quality_score is None) for r in tx.assess(odd).collect()} == {1: ("empty", True), 2: ("empty", True), 3: ("too_short", False)}


def test_chunks_are_handed_on_slice_by_slice(spark):
    """A worker never holds the pieces of more texts than a slice has; a long text is a slice of its own, a null one has no pieces."""
    import pyarrow as pa

    from millrace.functions import markdown as md

    texts = ["# A\n\n" + "word " * 20, None, "", "# B\n\n" + "x " * 400_000, "## C\n\nlast of all"] * 50
    assert max(z - a for a, z in md.slices(pa.array(["x" * 1000] * 5000), 1_000_000)) == 1000
    assert [t for a, z in md.slices(pa.array(texts), 1_000_000) for t in texts[a:z]] == texts
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, content_md string").coalesce(1)
    held = md.with_chunks(df, "content_md", min_chars=1)
    assert held.columns == ["id", "pieces"]  # the text isn't sent back beside its pieces
    got = {r.id: [(p.text, tuple(p.heading_path)) for p in r.pieces] for r in held.collect()}
    assert got == {i: md.chunk_markdown(t, min_chars=1) for i, t in enumerate(texts)}


def test_words_looked_for_first_hide_no_match(spark):
    """Texts that the patterns match in letters which Unicode folds to ASCII, or not at all: the same with and without the words."""
    texts = ["PLEA\u017fE help", "CL\u0130CK here", "cl\u0131c\u212a HERE", "Chec\u212a out my blog", "promo \u00e9 CODE", "free code", "we are hiring", "JOB OPENING", "buy\u2003now", "buy now", "a decode", "", None, "how do I f\u0131x", "I'm \u017ftuck", "anyone KNOW how", "I am stuck.", "h\u00e9lp", "see http", "https://a b", "[x](http://y)", "`a` http://z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    t = F.col("t")
    plain = {"spam": F.regexp_like(t, F.lit("(?iU)" + tx.SPAM)), "help": F.regexp_like(t, F.lit("(?iU)" + tx.HELP_ASKED)), "links": F.regexp_count(t, F.lit("(?U)" + tx.LINK)), "code": tx._total_length(tx.all_of(t, tx.FENCE, 1)) + tx._total_length(tx.all_of(t, tx.INLINE))}
    rows = df.select("i", *[v.alias(k) for k, v in plain.items()]).collect()
    assert df.select("i", tx.is_spam(t).alias("spam"), tx.asks_help(t).alias("help"), tx.n_links(t).alias("links"), tx.code_chars(t).alias("code")).collect() == rows
    assert sum(bool(r.spam) for r in rows) > 4 and sum(bool(r.help) for r in rows) > 2


def test_language_and_print_only_where_needed(spark):
    from millrace.operators.language import detect, with_language_and_print

    en, de = "this is what the people of that town have said to all of us when it was late", "das ist nicht der Hund von dem wir als es auch noch hell war mit dir auf dem Weg"
    texts = [en, de, en + " `das ist nicht der` ", None, "", en + "\n```\ndas ist nicht der Hund\n```\n" + en]
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate((k, t) for k in (True, False) for t in texts)], "i int, k boolean, t string")
    got = {r.i: (r.language, r.simhash) for r in with_language_and_print(df, "t", F.col("k"), ("en",)).collect()}
    for i, t in enumerate(texts):
        bare = None if t is None else re.sub(tx.INLINE, " ", re.sub(tx.FENCE, " ", t))
        lang = None if t is None else detect(bare)
        h = simhash_of(t)
        assert got[i] == (lang, (h - (1 << 64) if h >> 63 else h) if lang == "en" else None)
        assert got[i + len(texts)] == (None, None)
    assert got[0][0] == "en" and got[1] == ("de", None)
