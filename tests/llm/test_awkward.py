"""Tables with nulls in any column, repeated ids with different texts, a megabyte in one text, and extra columns whose names the
operators use themselves: each gives the result it gives without the extra columns, and that of the definition."""


import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import bpe, decision_list, language_id, near_dedup, quality_cotrain, secret_scan, suffix_dedup, tiling, token_counts, url_rules
from tests.llm.test_llm_operators import BASE, PASSAGE, base_spans, prose, rule_counts, sha

NAMES = "y t k h n key hub digest seed c rid row base loose x owner repo doc kind node label part size o w drawn bands shingles component bad cut pack rep did page words lexical layout rule found item_id quality toxic score __salt __k".split()
LONG = " ".join(prose(2500, 100 + i) for i in range(66)) + " end " + PASSAGE + f" token = {'q' * 9}"
ROWS = [
    (1, BASE, "en", "s1", len(BASE)), (1, prose(80, 41), "de", "s2", 9), (1, prose(80, 42), None, None, None), (2, BASE, None, "s1", -5), (3, LONG, "en", "s3", len(LONG)),
    (4, None, None, None, None), (None, prose(90, 43), "en", "s1", 1), (5, "", "en", None, 0), (6, BASE, "en", "s1", len(BASE)), (7, "%%% " * 200, "fr", "s2", 800),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def plain(spark):
    return spark.createDataFrame(ROWS, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def clash(spark, plain):
    out = plain.select(*[F.lit("clash").alias(c) for c in NAMES[:20]], "*", *[F.lit(None).cast("int").alias(c) for c in NAMES[20:]])
    return out.cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i % 8, i % 2, i % 3 == 0 and 1 or 0, "clash") for i in range(16)] + [(None, 0, 1, "z"), (1, None, None, None)], "doc_id long, quality int, toxic int, y string")


def of(df, *cols):
    return Counter(tuple(r[c] for c in cols or df.columns) for r in df.collect())


def test_secrets(clash):
    assert len(LONG) > 1_000_000
    got = of(secret_scan.report(clash), "doc_id", "n_assign", "base_sha256")
    names = ("assign", "access", "hex")
    assert got == Counter((i, sum(k == 0 for _, k, _ in base_spans(t or "")), sha(",".join(f"{names[k]}:{a}:{z}" for a, k, z in base_spans(t or "")).encode())) for i, t, *_ in ROWS)
    kept = secret_scan.redact(clash)
    assert kept.columns == clash.columns and of(kept, "doc_id", "lang", "y") == of(clash, "doc_id", "lang", "y")
    assert [r.text.endswith(PASSAGE + " [SECRET]") for r in kept.filter("doc_id = 3").collect()] == [True]


def test_token_counts(clash, tmp_path):
    from tokenizers import Tokenizer

    path, cache = public_tokenizers.path("byte_bpe_50k.json"), f"{tmp_path}/cache"
    t = Tokenizer.from_file(path)
    want = Counter((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for i, x, *_ in ROWS)
    assert of(token_counts.token_counts(clash, path, cache), "doc_id", "n_bytes", "n_tokens") == want
    known = clash.sparkSession.read.parquet(cache)
    known.write.mode("append").parquet(cache)  # another run appended the same digests
    other = clash.sparkSession.createDataFrame([("old", bytearray(b"x"), 3)], token_counts.CACHE_SCHEMA)
    other.write.mode("append").parquet(cache)
    assert of(token_counts.token_counts(clash, path, cache), "doc_id", "n_bytes", "n_tokens") == want


def test_classifier(plain, clash, labels):
    got = quality_cotrain.classify(clash, labels)
    assert of(got, "doc_id") == of(plain, "doc_id") and of(got, "doc_id", "kept") == of(quality_cotrain.classify(plain, labels), "doc_id", "kept")
    kept = quality_cotrain.keep_good(clash, labels)
    assert kept.columns == clash.columns and of(kept, "doc_id", "n_chars") == of(quality_cotrain.keep_good(plain, labels), "doc_id", "n_chars")


def test_suffixes(plain, clash):
    got = suffix_dedup.dedup(clash)
    assert of(got) == of(suffix_dedup.dedup(plain))
    assert {(r.doc_id, r.n_bytes, r.n_removed) for r in got.filter("doc_id in (2, 6)").collect()} == {(i, len(BASE.encode()), len(BASE.encode())) for i in (2, 6)}
    assert {(r.doc_id, r.n_removed) for r in got.filter("doc_id in (1, 3)").collect()} == {(1, 0), (3, 0)}


def test_rules(clash, labels):
    got = decision_list.judge(clash, labels)
    assert of(got, "doc_id", *decision_list.COUNTS[:5], "base_failed") == Counter((i, *rule_counts(t or "")) for i, t, *_ in ROWS)


def test_bpe(clash):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(f.read()), special_tokens={})
    ids = [(i, np.array(enc.encode_ordinary(t or ""), "<u4"), t or "") for i, t, *_ in ROWS]
    assert of(bpe.encode(clash, path)) == Counter((i, len(x), sha(x.tobytes()), sha(t.encode())) for i, x, t in ids)


def test_near_copies(plain, clash):
    got = near_dedup.near_groups(clash)
    n = lambda t: len({tuple(w) for w in zip(*(re.findall(r"\S+", t or "")[k:] for k in range(4)), strict=False)})
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(1, 1), (2, 1), (6, 1), (3, 3), (4, 4), (None, None), (5, 5), (7, 7)}
    assert {r.n_shingles for r in got.filter("doc_id = 3").collect()} == {n(LONG.lower())}
    kept = near_dedup.keep_first(clash)
    assert kept.columns == clash.columns and of(kept, "doc_id") == Counter({(i,): 1 for i in (1, 3, 4, None, 5, 7)})
    assert [r.text for r in kept.filter("doc_id = 1").collect()] == [min(t for i, t, *_ in ROWS if i == 1)]


def test_exact_comparison_of_all_pairs(plain):
    assert of(near_dedup.near_groups(plain, slack=None)) == of(near_dedup.near_groups(plain))


def test_leaks(spark, clash):
    bench = spark.createDataFrame([(1, PASSAGE, "z"), (None, None, None), (2, prose(60, 44), "z")], "item_id long, text string, doc_id string")
    for most in (10**6, 10):
        assert of(tiling.leaks(clash, bench, most=most), "doc_id", "item_id") == Counter({(3, 1): 1})
        kept = tiling.drop_leaks(clash, bench, most=most)
        assert kept.columns == clash.columns and of(kept, "doc_id") == Counter((i,) for i, *_ in ROWS if i != 3)


def test_language(clash):
    net = language_id.Network(["de", "en"])
    got = {(r.doc_id, r.lang_pred) for r in language_id.language_id(clash, net).collect()}
    assert {i for i, _ in got} == {i for i, *_ in ROWS} and {i for i, p in got if p == "und"} == {4, 5, 7}
    drawn, langs = language_id.training_sample(clash)
    assert set(langs) <= {"en", "de", "fr"} and all(len(x) <= language_id.TRAIN_SEGMENT for d in drawn for x in d)


def test_segments_are_drawn_from_all_over(spark):
    t = "".join(chr(97 + i // 4000) for i in range(100_000))
    d = spark.createDataFrame([(i, t, "en") for i in range(40)], "doc_id long, text string, lang string")
    drawn, _ = language_id.training_sample(d)
    assert len({x[:1] for own in drawn for x in own}) >= 20


def test_urls(spark):
    urls = {
        1: ("http://a.example.org/es/x", "a.example.org", "/es/x", "example.org/es/", "block"), 2: ("https://example.org/en/12?q", "example.org", "/en/12", "example.org/en/1", "block"),
        3: ("https://shop.com/fr/a", "shop.com", "/fr/a", "com/fr/", "allow"), 4: ("https://shop.com/de/" + "a" * 200_000, "shop.com", "/de/" + "a" * 200_000, "com/de/", "block"),
        5: ("https://a.net/?phpsessid=0123456789abcdef0", "a.net", "/", None, "block"), 6: ("https://a.net/x?sid=0123456789abcdef0", "a.net", "/x", None, "block"),
        7: ("https://a.net/x?side=0123456789abcdef0", "a.net", "/x", None, "allow"), 8: (None, "", "", None, "allow"), 9: ("https://other.org/login", "other.org", "/login", "org/", "allow"),
        10: ("https://a.net/login", "a.net", "/login", None, "block"), 11: ("HTTPS://EXAMPLE.ORG/ES/1", "example.org", "/ES/1", "org/", "allow"),
    }
    p = spark.createDataFrame([(k, v[0]) for k, v in urls.items()], "page_id long, url string")
    p = p.select(*[F.lit("clash").alias(c) for c in ("host", "path", "rule", "verdict", "token", "rid", "r", "lowered", "found")], "*")
    want = Counter((k, *v[1:]) for k, v in urls.items())
    for kw in ({"inline": True}, {"inline": False}, {"inline": False, "broadcast_rules": 1}):
        assert of(url_rules.url_filter(p, **kw), "page_id", "host", "path", "rule", "verdict") == want


def test_stages_of_the_pipeline(spark, clash, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (clash, clash.limit(0)):
            got = stage(spark, docs, str(tmp_path))
            assert got.columns == docs.columns, name
            assert of(got, "doc_id").keys() <= of(docs, "doc_id").keys()
    assert corpus_pipeline.tokens(spark, clash, str(tmp_path)).count() == len(ROWS)


def test_hot_keys_are_dealt(spark, monkeypatch):
    from millrace.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 10)
    left = spark.createDataFrame([(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(300)], "i long, key string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3), (None, 4)], "key string, v long")
    for how in ("inner", "left"):
        assert of(common.spread_join(left, right, "key", how), "i", "key", "v") == of(left.join(right, "key", how), "i", "key", "v")
    hot = common.hot_keys(left.groupBy("key").agg(F.count("*").alias("n")), "key", 300).collect()
    assert [(r.key, r["__k"]) for r in hot] == [("hot", 20)]


