import random
import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import fingerprint as fp
from millrace.functions import markdown as md
from millrace.functions import scalars as sc
from millrace.functions import text as tx
from millrace.operators import language

PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} goes along" for i in range(80))
CASES = {
    "code and links": ("```py\n" + "x = 1\n" * 30 + "```\nhttps://a.example https://b.example", "code_rich"),
    "prose": (PROSE, "ok"),
    "links": ("https://a.bc go " * 40, "link_dump"),
    "short": ("a few words only", "too_short"),
    "empty": ("", "empty"),
    "null": (None, "empty"),
    "spam": (PROSE + " Please   subscribe today", "spam"),
    "spam before code": ("click here ```\n" + "y" * 200 + "\n```", "spam"),
    "repeated": ("the same line again\n" * 60, "low_diversity"),
    "help": ("how do I fix this thing " + " ".join(f"term{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)), "help_request"),
    "one long word": ("a" * 5000, "thin_prose"),
}


def test_gate(spark):
    df = tx.assess(spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "k string, content_md string"))
    got = {r.k: r for r in df.collect()}
    assert {k: got[k].reason for k in CASES} == {k: v[1] for k, v in CASES.items()}
    assert all(got[k].keep == (v[1] in ("ok", "code_rich")) for k, v in CASES.items())
    assert all(0 <= r.quality_score <= 1 for r in got.values() if r.quality_score is not None)


def test_code_is_counted_and_stripped(spark):
    t = "a ```\nbody\n```\nand `code`"
    r = spark.createDataFrame([(t,)], "t string").select(tx.code_chars(F.col("t")).alias("n"), tx.strip_code(F.col("t")).alias("s")).first()
    assert r.n == len("body\n") + len("`code`")
    assert "body" not in r.s and "code" not in r.s and "and" in r.s


def test_simhash():
    text = "the quick brown fox jumps over the lazy dog near the river bank " * 8
    near, far = text.replace("lazy", "sleepy", 1), "entirely other matter about shipping containers and customs forms " * 8
    dist = lambda a, b: (a ^ b).bit_count()
    assert fp.simhash_of(text) == fp.simhash_of(text)
    assert dist(fp.simhash_of(text), fp.simhash_of(near)) <= 3 < 10 < dist(fp.simhash_of(text), fp.simhash_of(far))
    assert fp.simhash_of("") == fp.simhash_of(None) == fp.simhash_of("…") == 0


def test_bands_and_blocks(spark):
    with pytest.raises(ValueError):
        fp.bands(F.lit(1), 5)
    random.seed(3)
    rows = []
    for _ in range(200):
        a = random.getrandbits(64)
        b = a
        for i in random.sample(range(64), 3):
            b ^= 1 << i
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(rows, "a long, b long")
    bands = df.select("a", *[x.alias(f"x{i}") for i, x in enumerate(fp.bands(F.col("a")))], fp.hamming(F.col("a"), F.col("b")).alias("d"), F.size(F.array_intersect(fp.block_keys(F.col("a")), fp.block_keys(F.col("b")))).alias("common"))
    for r in bands.collect():
        assert (r.x0 << 48 | r.x1 << 32 | r.x2 << 16 | r.x3) == r.a % (1 << 64)
        assert r.d == 3 and r.common >= 1


def test_chunks_follow_headings():
    got = md.chunk_markdown("before the first heading, long enough to stay\n# Title\nthe question of the document\n## Top answer\nthe answer to the question")
    assert [path for _, path in got] == [(), ("Title",), ("Title", "Top answer")]
    jumped = md.chunk_markdown("# A\n### B\n### C\n# D", min_chars=1)
    assert [path for _, path in jumped] == [("A",), ("A", "B"), ("A", "B", "C"), ("D",)]


def test_long_sections_are_packed():
    paragraphs = [f"paragraph {i} " + "x" * 290 for i in range(12)]
    got = [x for x, _ in md.chunk_markdown("# T\n\n" + "\n\n".join(paragraphs), 1200, 350)]
    assert len(got) > 3 and all(x.startswith("# T") for x in got)
    for a, b in zip(got, got[1:], strict=False):
        assert a.split("\n\n")[-1] == b.split("\n\n")[1]
    fence = "```\n" + "line\n" * 400 + "```"
    assert md.chunk_markdown(fence) == [(fence, ())]
    assert md.chunk_markdown("tiny") == md.chunk_markdown(None) == []


def test_windows_cover_all_paragraphs():
    r = random.Random(3)
    for _ in range(500):
        sizes = [r.randrange(1, 60) for _ in range(r.randrange(12))]
        target, overlap = r.randrange(10, 90), r.randrange(0, 40)
        got = list(md.windows(sizes, target, overlap))
        assert [j for _, j in got] == sorted({j for _, j in got}) and (got[-1][1] if got else 0) == len(sizes)
        for (a, b), (c, d) in zip(got, got[1:], strict=False):
            assert c <= b < d and (c == b or sum(n + 2 for n in sizes[c:b]) <= overlap)
            assert c == a or sum(n + 2 for n in sizes[c - 1 : b]) > overlap
        for k, (a, b) in enumerate(got):
            least = got[k - 1][1] + 1 if k else 1
            assert b == least or sum(n + 2 for n in sizes[a:b]) - 2 <= target
            assert b == len(sizes) or sum(n + 2 for n in sizes[a : b + 1]) - 2 > target


def test_html():
    page = "<html><head><title>no</title></head><body><nav>menu</nav><article><h1>Head</h1><p>One &amp; two<br>three</p><pre><code>a  b\n c</code></pre><table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>2</td></tr></table><!-- gone --><script>x</script></article></body></html>"
    got = md.html_to_markdown(page)
    assert got.startswith("# Head") and "One & two\nthree" in got and "```\na  b\n c\n```" in got
    assert "| k | v |\n| --- | --- |\n| 1 | 2 |" in got and "menu" not in got and "gone" not in got and "x" not in got.split("```")[2].replace("| ", "")
    assert md.html_to_markdown("") is None and md.html_to_markdown(None) is None


def test_tags(spark):
    raw = ['["a","b"]', '[{"name":"a"},{"name":""}]', "42", None, "[]"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i").select(sc.tags_of(F.col("x"))).collect()]
    assert got == [["a", "b"], ["a"], None, None, []]


def test_waiting_times(spark):
    now = datetime(2026, 8, 4, 11, 59, 30, tzinfo=UTC)
    raw = ["30", "-5", "Tue, 04 Aug 2026 12:00:00 GMT", "Tue, 04 Aug 2020 12:00:00 GMT", "soon", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x string").orderBy("i")
    got = df.select(sc.retry_after_web(F.col("x"), F.expr("TIMESTAMP '2026-08-04 11:59:30Z'")).alias("web"), sc.retry_after_seconds(F.col("x")).alias("s")).collect()
    assert [r.web for r in got] == [30.0, -5.0, 30.0, 0.0, None, None]
    assert [r.s for r in got] == [30.0, 0.0, None, None, None, None]
    assert [sc.retry_after_crawler(x, now) for x in raw] == [30.0, 0.0, 30.0, 0.0, 0.0, 0.0]
    assert sc.backoff(10, 32, jitter=False) == 32 and sc.backoff(1, 32, retry_after=7) == 7 and 0 <= sc.backoff(3, 300) <= 8


def test_specs():
    assert sc.parse_map("devto:120, rss:x,bad,:3,se:300") == {"devto": 120, "se": 300}
    assert sc.parse_map("a.example:0.5,b", float) == {"a.example": 0.5}


def test_window_start(spark):
    base, cursor = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-01 01:00:00'"
    q = lambda b, c: spark.range(1).select(sc.window_start(F.expr(b), F.expr(c)).cast("string")).first()[0]
    null = "CAST(NULL AS TIMESTAMP)"
    assert q(base, null) == "2024-01-01 00:00:00" and q(base, cursor) == "2024-01-01 00:55:00"
    assert q(cursor, base) == "2024-01-01 01:00:00" and q(null, cursor) == "2024-01-01 00:55:00"


def test_language():
    assert language.detect("the cat is on the mat and it was not for you") == "en"
    assert language.detect("der Hund ist nicht auf dem Tisch für eine Stunde") == "de"
    assert language.detect("123 !!!") == language.detect(None) == "unknown"


def test_url_hash(spark):
    r = spark.createDataFrame([("https://a.example/1", "https://a.example/2")], "a string, b string").select(sc.url_hash(F.col("a")).alias("a"), sc.url_hash(F.col("b")).alias("b")).first()
    assert r.a != r.b and re.fullmatch("[0-9a-f]{64}", r.a)
