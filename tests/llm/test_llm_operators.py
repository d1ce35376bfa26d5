"""Each operator against a brute-force version, over awkward rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, decision_list, language_id, near_dedup, quality_cotrain, secret_scan, suffix_dedup, tiling, token_counts, url_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep string, digest string"
random.seed(9)
WORDS = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "wort", "schön", "été", "niño", "zeta", "eta", "theta", "iota"]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ing", "ed", "."]) for _ in range(n))


SECRET = "AKIA" + "QWERTYUIOP123456"
BASE = prose(400, 1)
PASSAGE = prose(30, 77)
TEXTS = [
    None, "", " \n\t ", "a", "one two three", BASE, BASE, BASE.upper(), BASE + " tail", BASE.replace("alpha", "omega", 3), prose(120, 2) + "\n" + PASSAGE, PASSAGE + "\n" + prose(90, 3),
    f'password = "hunter2hunter2" and {SECRET}', f"token: abc secret={'f' * 40}", "deadbeef" * 5 + " Zx9Kq2Lm8Pn4Rt6Vw1Yb", "token=secret=abcdefgh12", "línea\n" * 40, "x" * 3000, "ab" * 700 + " " + BASE,
    "don't we'll I'VE ünï 中文 русский 😀 ſ K 1² <|endoftext|> end", "!!! ### $$$ %%% " * 20, "dup dup dup dup dup dup", "\x00\x1c\x85  odd", prose(3000, 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], f"src{i % 4}", None if t is None else len(t), "k", "d") for i, t in enumerate(TEXTS)]
    rows += [(5, BASE, "en", "src1", len(BASE), "k", "d"), (None, BASE, None, None, None, None, None), (-3, "one two three", "en", "src0", 13, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def counted(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def sha(b):
    return hashlib.sha256(b).hexdigest()


def base_spans(t):
    kw = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({kw})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets(docs, rows, nothing):
    names = ("assign", "access", "hex")
    want = Counter()
    for i, t in rows:
        s = base_spans(t or "")
        want[(i, *(sum(x[1] == k for x in s) for k in range(3)), sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in s).encode()))] += 1
    got = secret_scan.report(docs)
    assert counted(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == want
    by_id = {r.doc_id: r for r in got.collect()}
    assert "owned:" in by_id[14].spans and by_id[14].n_added == 1
    assert secret_scan.report(nothing).count() == 0


def test_widely_copied_examples_stay(spark):
    rows = [(i, f"key {SECRET} here" if i < 4 else f"password: {'live' * 3}{i}", "en", f"s{i}", 9) for i in range(6)] + [(9, None, None, None, None), (10, "plain", "en", "s", 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in secret_scan.redact(d).collect()}
    assert len(got) == 8 and got[0].text == rows[0][1] and got[4].text == "[SECRET]" and got[4].n_chars == 8
    assert got[9].text is None and got[10].text == "plain"


def test_token_counts(docs, rows, nothing, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    want = Counter((i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False)), len(t.encode(x or "", add_special_tokens=False)) > 1024) for i, x in rows)
    cache = f"{tmp_path}/cache"
    for _ in range(2):  # the second time from the cache
        assert counted(token_counts.token_counts(docs, path, cache), "doc_id", "n_bytes", "n_tokens", "over_limit") == want
    assert docs.sparkSession.read.parquet(cache).count() == len({x or "" for _, x in rows})
    assert token_counts.token_counts(nothing, path).count() == 0


def test_classifier(spark, docs, nothing):
    r = random.Random(4)
    made, labels = [], []
    for i in range(600):
        kind = i % 3
        t = " ".join(prose(8, 1000 + 40 * i + k) for k in range(12))
        if kind == 1:
            t = " ".join(f"{w}###" for w in t.split())
        if kind == 2:
            t = t.replace("gamma", "dreckskerl").replace("zeta", "dreckskerl") + " dreckskerl"
        made.append((i, t, "en", f"s{r.randrange(3)}", len(t), "k", "d"))
        if i % 2:
            labels.append((i, int(kind != 1), int(kind == 2)))
    corpus = spark.createDataFrame(made, DOCS)
    lab = spark.createDataFrame([*labels, (None, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality_cotrain.classify(corpus, lab).collect()}
    wrong = sum(got[i].kept != (i % 3 == 0) for i in range(600))
    assert wrong <= 12
    kept = quality_cotrain.keep_good(corpus, lab)
    assert kept.columns == corpus.columns and sorted(x.doc_id for x in kept.collect()) == sorted(i for i in got if got[i].kept)
    assert quality_cotrain.classify(docs, lab).count() == docs.count()
    assert quality_cotrain.classify(docs, lab.limit(0)).filter("kept").count() == docs.count()
    assert quality_cotrain.classify(nothing, lab).count() == 0


def test_samples_are_those_of_least_hash(spark):
    from millrace.llm.common import id_hash

    d = spark.range(5000).select(F.col("id").alias("doc_id"))
    for rows, most in ((d, 100), (d, 6000), (d.filter("doc_id % 500 = 3"), 8), (d.limit(0), 5)):
        got = quality_cotrain._least(most, d, lambda near, rows=rows: rows.filter(near))
        assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in rows.orderBy(id_hash()).limit(most).collect())


def repeated(rows, length):
    first = {}
    for i, t in sorted(((float("inf") if i is None else i), t or "") for i, t in rows):
        b = t.encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    out = Counter()
    for i, t in rows:
        b, until, kept, runs, before = (t or "").encode(), 0, bytearray(), 0, False
        for p in range(len(b)):
            if p + length <= len(b) and first[b[p : p + length]] < (float("inf") if i is None else i):
                until = p + length
            if p >= until:
                kept.append(b[p])
            runs += p < until and not before
            before = p < until
        out[(i, len(b), len(b) - len(kept), runs, sha(bytes(kept)))] += 1
    return out


def test_suffix_dedup(docs, rows, nothing, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 6000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_A_RANGE", 100)
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert counted(suffix_dedup.dedup(docs), *cols) == repeated(rows, 50)
    assert suffix_dedup.dedup(nothing).count() == 0


def test_loser_tree():
    r = random.Random(2)
    for k in (1, 2, 3, 7, 16):
        runs = []
        for _ in range(k):
            keys = sorted({bytes(r.choice(b"ab") for _ in range(8)) for _ in range(r.randrange(0, 40))})
            shared = [0] + [next(i for i in range(8) if a[i] != b[i]) for a, b in zip(keys, keys[1:], strict=False)]
            runs.append((keys, shared[: len(keys)]))
        got = [(runs[a][0][b], n) for a, b, n in suffix_dedup.merge_runs(runs)]
        assert [x for x, _ in got] == sorted(x for keys, _ in runs for x in keys)
        for (a, _), (b, n) in zip(got, got[1:], strict=False):
            assert n == next((i for i in range(8) if a[i] != b[i]), 8)


def test_packed_numbers_and_front_codes():
    r = np.random.default_rng(3)
    for n, top in ((1, 2**63), (2, 2**48), (500, 2**48), (500, 600)):
        x = np.unique(r.integers(0, top, n, dtype=np.uint64))
        assert (suffix_dedup.unpack_numbers(suffix_dedup.pack_numbers(x)) == x).all()
    keys = np.unique(r.integers(0, 3, (200, suffix_dedup.KEY), dtype=np.uint8), axis=0)
    assert (suffix_dedup.front_decode(*suffix_dedup.front_code(keys)) == keys).all()


def rule_counts(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_rules(spark, docs, rows, nothing):
    labels = spark.createDataFrame([(5, 1), (None, 0)], "doc_id long, quality int")
    got = decision_list.judge(docs, labels)
    assert counted(got, "doc_id", *decision_list.COUNTS[:5], "base_failed") == Counter((i, *rule_counts(t or "")) for i, t in rows)
    assert all(r.kept != r.base_failed for r in got.collect())  # nothing is learned from one kind
    assert decision_list.judge(nothing, labels).count() == 0


def test_rules_are_learned():
    r = np.random.default_rng(1)
    x = r.random((900, len(decision_list.RATIOS)))
    bad = ((x[:, 2] > 0.8) & (x[:, 4] > 0.3)) | (x[:, 9] <= 0.1)
    rules = decision_list.learn(x, bad, list(decision_list.RATIOS))
    names = list(decision_list.RATIOS)
    hit = np.zeros(900, bool)
    for rule in rules:
        ok = np.ones(900, bool)
        for name, sign, t in rule:
            v = x[:, names.index(name)]
            ok &= (v <= t) if sign == "<=" else (v > t)
        hit |= ok
    assert (hit == bad).mean() > 0.95


def test_bpe(docs, rows, nothing):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    enc = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [(i, np.array(enc.encode_ordinary(t or ""), "<u4"), t or "") for i, t in rows]
    want = Counter((i, len(x), sha(x.tobytes()), sha(t.encode())) for i, x, t in ids)
    got = bpe.encode(docs, path, keep_ids=True)
    assert counted(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want
    assert counted(bpe.decode(got, path), "doc_id", "text") == Counter((i, t or "") for i, t in rows)
    assert bpe.encode(nothing, path).count() == 0
    codec = bpe.codec_for(path)
    r = random.Random(6)
    fuzz = ["".join(r.choice("ab' \n1é中　s!T") for _ in range(r.randrange(50))) for _ in range(3000)] + ["z" * 900, "'" * 40 + "s", "ab" * 600]
    assert [x.tolist() for x, _ in codec.encode_batch(fuzz)] == [enc.encode_ordinary(t) for t in fuzz]


def groups(rows, k, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets.append((i, {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} or ({tuple(w)} if w else set())))
    label = {i: i for i, _ in rows if i is not None}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, o in sets[:a]:
            if i is not None and j is not None and s and o and 100 * len(s & o) >= percent * len(s | o):
                x, y = sorted((find(i), find(j)))
                label[y] = x
    return Counter((i, len(s), None if i is None else find(i), True if i is None else find(i) == i) for i, s in sets)


def test_near_groups(docs, rows, nothing):
    cols = ("doc_id", "n_shingles", "component_id", "kept")
    assert counted(near_dedup.near_groups(docs), *cols) == groups(rows, 4, 80)
    assert near_dedup.near_groups(nothing).count() == 0
    kept = near_dedup.keep_first(docs, 4, 80)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({k[0]: 1 for k in groups(rows, 4, 80) if k[3]})


def test_chains_and_stars_of_near_copies(spark):
    """A chain: each links with the next only; and copies that differ from each other more than from their source."""
    w = [f"w{i}" for i in range(3000)]
    made = [(i, " ".join(w[25 * i : 25 * i + 300])) for i in range(30)]
    r = random.Random(8)
    star = [f"s{i}" for i in range(300)]
    for i in range(100, 160):
        own = list(star)
        for k in range(9):
            own[r.randrange(300)] = f"e{i}x{k}"
        made.append((i, " ".join(own)))
    d = spark.createDataFrame(made, "doc_id long, text string")
    assert counted(near_dedup.near_groups(d), "doc_id", "n_shingles", "component_id", "kept") == groups(made, 4, 80)


def test_shared_elements_are_counted():
    r = np.random.default_rng(5)
    for _ in range(60):
        top = int(r.integers(5, 400))
        xs, ys = ([np.unique(r.integers(0, top, r.integers(0, 60)).astype(np.uint64)) for _ in range(int(r.integers(1, 40)))] for _ in range(2))
        assert (near_dedup.overlaps(xs, ys) == np.array([[len(np.intersect1d(x, y)) for y in ys] for x in xs])).all()


def test_blocks_of_a_large_group(spark, monkeypatch):
    """Many copies of one text, half of them too far from it, in blocks of a few texts."""
    monkeypatch.setattr(near_dedup, "BLOCK", (500, 1000))
    r = random.Random(12)
    base = [f"b{i}" for i in range(150)]
    made = [(0, " ".join(base))]
    for i in range(1, 160):
        own = list(base)
        for k in r.sample(range(150), r.choice([2, 3, 8, 9])):
            own[k] = f"x{r.randrange(3)}"
        made.append((i, " ".join(own)))
    d = spark.createDataFrame(made, "doc_id long, text string")
    want = groups(made, 4, 80)
    assert counted(near_dedup.near_groups(d), "doc_id", "n_shingles", "component_id", "kept") == want
    assert 5 < len({k[2] for k in want}) < 150


def test_components_of_a_long_chain(spark):
    n = 500
    e = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(1000, 2000)], "a long, b long"))
    got = {r.node: r.label for r in near_dedup.components(e).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 2000: 1000}


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.ORG/es/1?x", "https://example.org/en/12", "https://example.org/en/2", "https://notexample.org", "http://x.com/fr/", "http://x.com/de/#a", "http://x.com/FR/", "https://spam-farm.example.net/a", "http://h.net/login?u", "http://org/", "http://a.com//de/", "://?q", "http://x.com/de/", "http://x.com/de/"]
    p = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    want = []
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else None
        host = re.match(r"[^/?#]*", rest)[0].lower() if rest is not None else ""
        path = re.match(r"[^?#]*", rest[len(host) :])[0] if rest is not None else ""
        fit = [(-len(r.rule), r.verdict != "block", r.rule, r.verdict) for r in url_rules.PREFIX_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        pat = sorted(r.name for r in url_rules.PATTERN_RULES if re.search(r.regex, (u or "").lower()))
        rule, verdict = min(fit)[2:] if fit else (None, "block" if pat else "allow")
        want.append((i, host, path, rule, verdict))
    for inline in (True, False):
        assert counted(url_rules.url_filter(p, inline=inline), "page_id", "host", "path", "rule", "verdict") == Counter(want)
    assert url_rules.url_filter(p.limit(0)).count() == 0


def test_tiling(spark, nothing):
    item = PASSAGE.split()
    bench = spark.createDataFrame([(1, PASSAGE), (2, None), (3, "too short"), (4, prose(40, 500))], "item_id long, text string")
    turned = " ".join(item[15:] + ["between"] + item[:15])
    made = [(1, prose(50, 900) + " " + PASSAGE.upper() + " end"), (2, turned), (3, " ".join(item[:15])), (4, prose(200, 901)), (5, None), (6, ""), (7, PASSAGE), (7, PASSAGE)]
    d = spark.createDataFrame(made, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    for most in (10**6, 10):  # sent to the workers, and joined
        got = tiling.leaks(d, bench, most=most)
        assert counted(got, "doc_id", "item_id") == Counter({(1, 1): 1, (2, 1): 1, (7, 1): 2})
        kept = tiling.drop_leaks(d, bench, most=most)
        assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]
    assert tiling.leaks(nothing, bench).count() == 0 and tiling.leaks(d, bench.limit(0)).count() == 0


def greedy_tiles(doc, item):
    """Every pair of places, the longest match first."""
    free_doc, free_item, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 4)
        for p in range(len(item)):
            for q in range(len(doc)):
                k = 0
                while p + k < len(item) and q + k < len(doc) and free_item[p + k] and free_doc[q + k] and item[p + k] == doc[q + k]:
                    k += 1
                if k > best[2]:
                    best = (p, q, k)
        p, q, k = best
        if k < 5:
            return out
        out.append(best)
        free_item[p : p + k] = free_doc[q : q + k] = [False] * k


def test_tiles_equal_those_of_all_pairs():
    r = random.Random(3)
    for _ in range(150):
        top = r.choice([1, 2, 3, 8])
        doc, item = ([r.randrange(top) for _ in range(r.randrange(n))] for n in (60, 40))
        if r.random() < 0.5:
            at = r.randrange(len(doc) + 1)
            doc[at:at] = item
        d, i = (np.array([7919 * x + 13 for x in v], np.uint64) for v in (doc, item))
        assert tiling.tile(d, i, tiling.seeds(d), tiling.seeds(i)) == greedy_tiles(doc, item)


def test_one_token_over_and_over(spark):
    d = spark.createDataFrame([(1, "spam " * 10_000), (2, "spam " * 30), (3, ("ham spam eggs " * 4000))], "doc_id long, text string")
    b = spark.createDataFrame([(1, "spam " * 2000), (2, "ham spam eggs " * 700)], "item_id long, text string")
    for most in (10**6, 10):
        got = {(r.doc_id, r.item_id): (r.n_covered, r.n_tiles) for r in tiling.leaks(d, b, most=most).collect()}
        assert got == {(1, 1): (2000, 1), (3, 2): (2100, 1)}


def test_leaks_equal_those_of_all_pairs(spark):
    r = random.Random(31)
    items = {i: [r.choice(WORDS) for _ in range(r.randrange(3, 40))] for i in range(25)}
    made = []
    for i in range(60):
        w = [r.choice(WORDS) for _ in range(r.randrange(80))]
        for k in r.sample(range(25), 2):
            cut = r.randrange(len(items[k]))
            w += [*items[k][cut:], "x", *items[k][: cut - r.randrange(3)]]
        made.append((i % 50, " ".join(w)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()], "item_id long, text string")
    want = Counter()
    for i, t in made:
        for k, v in items.items():
            n = sum(x[2] for x in greedy_tiles(t.lower().split(), [x.lower() for x in v]))
            if n >= 0.8 * len(v):
                want[(i, k, n)] += 1
    assert len(want) > 20
    for most in (10**6, 10):
        assert counted(tiling.leaks(docs, bench, most=most), "doc_id", "item_id", "n_covered") == want
        bad = {i for i, _, _ in want}
        assert not bad & {r.doc_id for r in tiling.drop_leaks(docs, bench, most=most).collect()} - {i for i, n in Counter(i for i, _ in made).items() if n > 1}


def test_tiles_are_greedy():
    h = lambda s: np.array([hash(c) & (2**63 - 1) for c in s], np.uint64)
    doc, item = h("xxabcdefgyyhijklmzzabcdefghijk"), h("abcdefghijklm")
    tiles = tiling.tile(doc, item, tiling.seeds(doc), tiling.seeds(item))
    assert tiles == [(0, 19, 11)]
    assert tiling.tile(h("abcdefgyyhijklm"), item, tiling.seeds(h("abcdefgyyhijklm")), tiling.seeds(item)) == [(0, 0, 7), (7, 9, 6)]


def test_language(spark, data, docs, nothing):
    import zlib

    got = language_id.language_id(spark.read.parquet(f"{data}/documents.parquet"))
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got.collect() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    net = language_id.Network(["de", "en"])
    odd = language_id.language_id(docs, net)
    for r, t in zip(*(sorted(x, key=str) for x in ([(r.doc_id, r.lang_pred, r.score) for r in odd.collect()], [(r.doc_id, r.text) for r in docs.collect()])), strict=True):
        assert r[0] == t[0] and 0 <= r[2] <= 1
    assert {r.doc_id: r.lang_pred for r in odd.collect()}[0] == "und"
    assert language_id.language_id(nothing).count() == 0


def test_gradients():
    net = language_id.Network(["a", "b", "c"])
    x = np.full((3, 6), language_id.PAD, np.int64)
    x[0], x[1, :4], x[2] = [97, 98, 99, 100, 101, 102], [99, 98, 97, 120], [1, 2, 3, 4, 5, 250]
    y = np.array([0, 1, 2])
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    grads, _ = net.gradients(x, y)
    for k, at in (("u", (0, 1, 2)), ("u", (1, 3, 20)), ("x", (97, 5)), ("x", (257 + 98, 17)), ("o", (1, 2, 1))):
        old, e = net.p[k][at], 1e-3
        net.p[k][at] = old + e
        up = net.gradients(x, y)[1]
        net.p[k][at] = old - e
        down = net.gradients(x, y)[1]
        net.p[k][at] = old
        assert abs((up - down) / (2 * e) - grads[k][at]) < 1e-4
