"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Base spans (leftmost, not overlapping within a kind): ``assign`` (keyword, ``:`` or ``=``, a value of 8+), ``access``
(``AKIA`` keys of 16+) and ``hex`` (runs of 32+). Besides, tokens of 20+ characters with a capital, a small letter and a
digit are candidates without a keyword. Every candidate value is digested, and the digests are aggregated over the whole
corpus by distinct owners (``owner_col``) and repositories (``repo_cols``). A value that ``example_owners`` or more owners
hold is a widely copied example; a value of fewer looks live. The method adds a span of kind ``owned`` for each candidate
without a base span over it that looks live. The number of repositories is reported and decides nothing.

Null or empty text: no spans. Null owners count as one owner of their own. Repeated rows are scanned one by one and counted
once where owner and repository agree. Spans that begin at one place are ordered by kind. Very long texts are scanned whole. An
empty table gives an empty result. Extra columns, whatever their names, are left out of the report and kept by ``redact``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import snapshot, spread_join, whole_text


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = "|".join([*map(_any_case, ("password", "passwd", "secret", "token")), _any_case("api") + "_?" + _any_case("key")])
ASSIGN = rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A key's failing (short) match has no longer one inside it, so the least lengths can stand in these two patterns.
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LOOSE = "[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")
EXAMPLE_OWNERS = 3
_SPANS = "array<struct<s:int,e:int>>"


def _spans(text: Column, pattern: str) -> Column:
    """Code-point offsets of all matches: lengths of what lies between them and of themselves, summed up."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, b: F.struct(F.length(a).alias("a"), F.length(b).alias("b")))
    out = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + x["a"] + x["b"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct((acc["at"] + x["a"]).alias("s"), (acc["at"] + x["a"] + x["b"]).alias("e")))).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return F.when(F.regexp_like(text, p), out).otherwise(F.array().cast(_SPANS))


def _with_values(text: Column, pattern: str, group: int, kind: int, keep=lambda v: F.lit(True)) -> Column:
    """array<struct<s, e, k, h>>: spans of one kind with the digest of their value."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.zip_with(_spans(text, pattern), values, lambda a, v: F.struct(a["s"].alias("s"), F.lit(kind).alias("k"), a["e"].alias("e"), v.alias("v")))
    some = F.transform(F.filter(zipped, lambda x: keep(x["v"])), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), F.sha2(F.encode(x["v"], "UTF-8"), 256).alias("h")))
    return F.when(F.regexp_like(text, F.lit(pattern)), some).otherwise(F.array().cast("array<struct<s:int,k:int,e:int,h:string>>"))


def candidates(docs: DataFrame, owner_col: str = "source", repo_cols=("source", "lang"), id_col: str = "doc_id", text_col: str = "text", carry=()) -> DataFrame:
    """doc_id, owner, repo, base and loose: arrays of spans with digests, and what is carried. One row per input row."""
    t = F.col("__t")
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(owner_col).cast("string"), F.lit("\x00")).alias("owner"), F.to_json(F.struct(*[F.col(c) for c in repo_cols])).alias("repo"), whole_text(text_col).alias("__t"), *carry)
    more = [c for c in src.columns if c not in ("doc_id", "owner", "repo", "__t")]
    base = F.concat(
        _with_values(t, ASSIGN, 2, 0, lambda v: F.length(v) >= 8),
        _with_values(t, ACCESS, 0, 1),
        _with_values(t, HEX, 0, 2),
    )
    mixed = lambda v: v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]")
    out = src.select(*more, "doc_id", "owner", "repo", F.array_sort(base).alias("base"), _with_values(t, LOOSE, 0, 3, mixed).alias("loose"))
    over = lambda x: F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    return out.withColumn("loose", F.filter("loose", lambda x: ~over(x)))


def ownership(cands: DataFrame) -> DataFrame:
    """h, n_owners, n_repos over the whole corpus; each step is combined before its shuffle."""
    each = cands.select("owner", "repo", F.explode(F.array_distinct(F.transform(F.concat("base", "loose"), lambda x: x["h"]))).alias("h"))
    pairs = each.groupBy("h", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("h", "owner").agg(F.count("*").alias("r"))
    return owners.groupBy("h").agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repos"))


def _label(x: Column) -> Column:
    return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))


def scan_spans(docs: DataFrame, owner_col: str, repo_cols, id_col: str, text_col: str, example_owners: int, carry=()) -> tuple[DataFrame, DataFrame]:
    """The rows with their candidates (rid tells them apart), and rid, x, n_owners, n_repos for each span that stays.

    Patterns run over each text once. A value that many rows hold is dealt over several tasks of the join.
    """
    rows = snapshot(candidates(docs, owner_col, repo_cols, id_col, text_col, carry).withColumn("rid", F.monotonically_increasing_id()))
    some = rows.select("rid", "owner", "repo", "base", "loose").filter((F.size("base") > 0) | (F.size("loose") > 0))
    spans = snapshot(some.select("rid", F.explode(F.concat("base", "loose")).alias("x")).withColumn("h", F.col("x.h")))
    return rows, spread_join(spans, ownership(some), "h").filter((F.col("x.k") < 3) | (F.col("n_owners") < example_owners))


def scan(docs: DataFrame, owner_col: str = "source", repo_cols=("source", "lang"), id_col: str = "doc_id", text_col: str = "text", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """doc_id, base (array), all (array of base and added spans, each with n_owners and n_repos), one row per input row."""
    rows, kept = scan_spans(docs, owner_col, repo_cols, id_col, text_col, example_owners)
    by_doc = kept.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("x.s", "x.k", "x.e", "n_owners", "n_repos"))).alias("all"))
    none = F.array().cast("array<struct<s:int,k:int,e:int,n_owners:bigint,n_repos:bigint>>")
    out = rows.select("rid", "doc_id", "base").join(by_doc, "rid", "left").withColumn("all", F.coalesce("all", none))
    return out.select("doc_id", "base", "all")


def report(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, **kw) -> DataFrame:
    """The digest columns of a scan."""
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return scan(docs, example_owners=example_owners, **kw).select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(F.encode(F.concat_ws(",", F.transform("base", _label)), "UTF-8"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("all", _label)).alias("spans"),
        F.size(F.filter("all", lambda x: x["n_owners"] == 1)).cast("long").alias("n_live"),
        F.size(F.filter("all", lambda x: x["n_owners"] >= example_owners)).cast("long").alias("n_example"),
        F.size(F.filter("all", lambda x: x["k"] == 3)).cast("long").alias("n_added"),
    )


def oracle_sql(example_owners: int = EXAMPLE_OWNERS) -> str:
    """DuckDB: the same spans by splitting, and the owners by grouping."""
    q = lambda p: p.replace("'", "''")

    def found(kind: int, name: str, pattern: str, group: int, keep: str) -> str:
        p = q(pattern)
        return f"""
  SELECT rid, owner, repo, {kind} AS k, '{name}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(l[1:i])::BIGINT + coalesce(list_sum(g[1:i - 1]), 0)::BIGINT, 'n': g[i], 'v': v[i]}})) AS x
  FROM (SELECT *, list_transform(m, lambda y: length(y)) AS g, list_transform(string_split_regex(t, '{p}'), lambda y: length(y)) AS l
        FROM (SELECT *, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {group}) AS v FROM d WHERE regexp_matches(t, '{p}')))"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS owner, coalesce(source, chr(1)) || '/' || coalesce(lang, chr(1)) AS repo, coalesce(text, '') AS t FROM documents),
spans AS (
  SELECT rid, owner, repo, k, kind, x.s AS s, x.s + x.n AS e, x.v AS v FROM ({found(0, "assign", ASSIGN, 2, "")}) WHERE length(x.v) >= 8
  UNION ALL SELECT rid, owner, repo, k, kind, x.s, x.s + x.n, x.v FROM ({found(1, "access", ACCESS, 0, "")})
  UNION ALL SELECT rid, owner, repo, k, kind, x.s, x.s + x.n, x.v FROM ({found(2, "hex", HEX, 0, "")})),
loose AS (
  SELECT rid, owner, repo, k, kind, x.s AS s, x.s + x.n AS e, x.v AS v FROM ({found(3, "owned", LOOSE, 0, "")})
  WHERE regexp_matches(x.v, '[A-Z]') AND regexp_matches(x.v, '[a-z]') AND regexp_matches(x.v, '[0-9]')),
cand AS (SELECT * FROM spans UNION ALL SELECT * FROM loose l WHERE NOT EXISTS (SELECT 1 FROM spans b WHERE b.rid = l.rid AND b.s < l.e AND l.s < b.e)),
own AS (SELECT v, count(DISTINCT owner) AS n FROM cand GROUP BY v),
fin AS (SELECT c.*, n FROM cand c JOIN own USING (v) WHERE k < 3 OR n < {example_owners}),
agg AS (
  SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3), '') AS b,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans,
         count(*) FILTER (n = 1) AS n_live, count(*) FILTER (n >= {example_owners}) AS n_example, count(*) FILTER (k = 3) AS n_added
  FROM fin GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_added, 0) AS n_added
FROM d LEFT JOIN agg USING (rid)
"""


def redact(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, mark: str = "[SECRET]", owner_col: str = "source", repo_cols=("source", "lang"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with every span that isn't a widely copied example replaced by the mark; the same columns and rows.

    Spans that overlap are replaced as one. Texts are scanned once, into a snapshot; only rows that hold a candidate are shuffled.
    A column n_chars, where there is one, follows the new text.
    """
    carried = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    rows, spans = scan_spans(docs, owner_col, repo_cols, id_col, text_col, example_owners, carry=[carried])
    clean = (F.size("base") == 0) & (F.size("loose") == 0)
    bad = spans.filter(F.col("n_owners") < example_owners).groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("x.s", "x.e"))).alias("cut"))
    text = F.col(f"__row.{text_col}")
    built = F.aggregate(
        "cut",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(x["s"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark))).alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    new = {c: F.col(f"__row.{c}") for c in docs.columns} | {text_col: F.when(F.col("cut").isNull(), text).otherwise(built)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("cut").isNull(), F.col("__row.n_chars")).otherwise(F.length(new[text_col]).cast("long"))
    done = rows.filter(~clean).join(bad, "rid", "left").select(*[new[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    return rows.filter(clean).select(*[F.col(f"__row.{c}").alias(c) for c in docs.columns]).unionByName(done)
