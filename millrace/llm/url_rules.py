"""URL filters: rules found through an index of their rarest literal token.

Two sorts of rules are held in one index:

* prefix rules ``host/path``: fit the host and its subdomains where the URL's path starts with the rule's path; the
  longest fitting rule gives the verdict (ties: block before allow, then the smaller string);
* pattern rules: a regular expression over the URL (A-Z lower-cased), with the literal tokens that any match must hold.

Each rule is filed under the one of its literal tokens that the fewest URLs hold. A URL's own tokens fetch the rules
filed under them, and only those are tried. A URL without a fitting prefix rule is blocked if a pattern rule matches.

A rule without a literal is tried on every URL; none of those kept here is. Beyond ``BROADCAST_RULES`` rules the index is joined
by a shuffle in which a token that many URLs hold is dealt over several tasks.

Null URLs and URLs without ``://`` have an empty host and path and are allowed unless a pattern matches. Very long URLs are
judged whole. Repeated rows are judged one by one; an empty table gives an empty result; extra columns, whatever their names,
are left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Beyond this many rules the index is joined as a table instead of being part of the plan.
INLINE_RULES = 500
#: The largest index (rows) that is broadcast; a larger one is joined by a shuffle.
BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class PrefixRule:
    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]

    def tokens(self) -> list[str]:
        """Tokens that every URL that fits must hold whole: the host's, and the path's up to its last delimiter."""
        closed = re.sub(r"[a-z0-9]+\Z", "", self.path.translate(str.maketrans(UPPER, LOWER)))
        return re.findall("[a-z0-9]+", self.host) + re.findall("[a-z0-9]+", closed)


@dataclass(frozen=True)
class PatternRule:
    name: str
    regex: str
    literals: tuple[str, ...] = field(default_factory=tuple)

    def tokens(self) -> list[str]:
        return list(self.literals)


PREFIX_RULES = [
    PrefixRule("org/", "allow"),
    PrefixRule("example.org/es/", "block"),
    PrefixRule("example.org/en/1", "block"),
    PrefixRule("com/fr/", "allow"),
    PrefixRule("com/de/", "block"),
]
#: Written so that Java and RE2 read them alike.
PATTERN_RULES = [
    PatternRule("spam-farm", r"://[^/?#]*\bspam-farm\.", ("spam", "farm")),
    PatternRule("cheap-pills", r"://[^/?#]*\bcheap-pills\.", ("cheap", "pills")),
    PatternRule("casino", r"://[^/?#]*\bcasino-[a-z]+\.", ("casino",)),
    PatternRule("ad-tracker", r"://[^/?#]*\bads-track\.", ("ads", "track")),
    PatternRule("session-id", r"[?&]phpsessid=[0-9a-f]{16,}", ("phpsessid",)),
    PatternRule("session-id", r"[?&]sid=[0-9a-f]{16,}", ("sid",)),
    PatternRule("login-page", r"/login(\.[a-z]+)?([/?#]|$)", ("login",)),
    PatternRule("calendar-trap", r"/calendar/[0-9]{4}/[0-9]{2}", ("calendar",)),
]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce(url, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0)))


def token_frequencies(pages: DataFrame, wanted: list[str], url_col: str = "url") -> dict[str, int]:
    """In how many URLs of the whole table each wanted token occurs. The result is as large as the rules, not the table."""
    if not wanted:
        return {}
    hit = F.array_intersect(url_tokens(F.col(url_col)), F.array(*[F.lit(x) for x in wanted]))
    rows = pages.select(F.explode(hit).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


def build_index(rules: list, frequency: dict[str, int]) -> dict[str, list]:
    """Token -> rules filed under it; rules without a literal are under '' and tried on every URL."""
    index: dict[str, list] = {}
    for r in rules:
        own = r.tokens()
        index.setdefault(min(own, key=lambda x: (frequency.get(x, 0), x)) if own else "", []).append(r)
    return index


_RULE = "struct<rule:string,verdict:string,rhost:string,rpath:string,regex:string,name:string>"


def _as_struct(r) -> Column:
    if isinstance(r, PrefixRule):
        v = (r.rule, r.verdict, r.host, r.path, None, None)
    else:
        v = (None, "block", None, None, r.regex, r.name)
    names = ("rule", "verdict", "rhost", "rpath", "regex", "name")
    return F.struct(*[F.lit(x).cast("string").alias(n) for n, x in zip(names, v, strict=True)])


def _fits(r: Column, host: Column, path: Column, lowered: Column) -> Column:
    suffix = (host == r["rhost"]) | F.endswith(host, F.concat(F.lit("."), r["rhost"]))
    as_prefix = r["rhost"].isNotNull() & suffix & F.startswith(path, r["rpath"])
    return F.coalesce(F.when(r["regex"].isNull(), as_prefix).otherwise(F.regexp_like(lowered, r["regex"])), F.lit(False))


def _judge(found: Column) -> list[Column]:
    """found: array of the rules that fit."""
    ranked = F.array_sort(
        F.transform(
            F.filter(found, lambda r: r["rule"].isNotNull()),
            lambda r: F.struct((-F.length(r["rule"])).alias("n"), F.when(r["verdict"] == "block", 0).otherwise(1).alias("v"), r["rule"].alias("rule"), r["verdict"].alias("verdict")),
        )
    )
    first = F.try_element_at(ranked, F.lit(1))
    pattern = F.array_min(F.transform(F.filter(found, lambda r: r["name"].isNotNull()), lambda r: r["name"]))
    verdict = F.coalesce(first["verdict"], F.when(pattern.isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return [first["rule"].alias("rule"), verdict.alias("verdict"), pattern.alias("pattern_rule")]


def url_filter(pages: DataFrame, prefix_rules=None, pattern_rules=None, id_col: str = "page_id", url_col: str = "url", inline: bool | None = None, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern_rule (the first by name of the pattern rules that match, or null)."""
    rules = [*(PREFIX_RULES if prefix_rules is None else prefix_rules), *(PATTERN_RULES if pattern_rules is None else pattern_rules)]
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    index = build_index(rules, token_frequencies(src, sorted({x for r in rules for x in r.tokens()})))
    host, path = host_and_path(F.col("url"))
    base = src.select("page_id", "url", host.alias("host"), path.alias("path"), ascii_lower(F.coalesce("url", F.lit(""))).alias("lowered"))
    if inline is None:
        inline = len(rules) <= INLINE_RULES
    if inline:
        none = F.array().cast(f"array<{_RULE}>")
        always = F.array(*[_as_struct(r) for r in index.get("", [])]) if "" in index else none
        filed = {k: v for k, v in index.items() if k}
        if filed:
            by_token = F.create_map(*[x for k, v in sorted(filed.items()) for x in (F.lit(k), F.array(*[_as_struct(r) for r in v]))])
            hits = F.array_intersect(url_tokens(F.col("url")), F.array(*[F.lit(k) for k in sorted(filed)]))
            fetched = F.concat(always, F.flatten(F.transform(hits, lambda t: F.element_at(by_token, t))))
        else:
            fetched = always
        found = base.withColumn("found", F.filter(fetched, lambda r: _fits(r, F.col("host"), F.col("path"), F.col("lowered"))))
        return found.select("page_id", "host", "path", *_judge(F.col("found")))
    # Many rules: the index is a table; a row number of this scan keeps repeated rows apart.
    from .common import snapshot, spread_join

    spark = pages.sparkSession
    flat = [(k, *[getattr(r, a, None) for a in ("rule", "verdict", "host", "path", "regex", "name")]) for k, v in index.items() for r in v]
    flat = [(k, rule, verdict or "block", h, p, rx, n) for k, rule, verdict, h, p, rx, n in flat]
    table = spark.createDataFrame(flat, "token string, rule string, verdict string, rhost string, rpath string, regex string, name string")
    rows = snapshot(base.withColumn("rid", F.monotonically_increasing_id()))
    tokens = rows.select("rid", "host", "path", "lowered", F.explode(F.array_append(url_tokens(F.col("url")), F.lit(""))).alias("token"))
    joined = tokens.join(F.broadcast(table), "token") if len(flat) <= broadcast_rules else spread_join(snapshot(tokens), table, "token")
    r = F.struct("rule", "verdict", "rhost", "rpath", "regex", "name")
    fit = joined.withColumn("r", r).filter(_fits(F.col("r"), F.col("host"), F.col("path"), F.col("lowered")))
    found = fit.groupBy("rid").agg(F.collect_list("r").alias("found"))
    empty = F.array().cast(f"array<{_RULE}>")
    return rows.join(found, "rid", "left").withColumn("found", F.coalesce(F.col("found"), empty)).select("page_id", "host", "path", *_judge(F.col("found")))


def oracle_sql() -> str:
    """DuckDB: every rule against every URL."""
    rules = ",\n".join(f"('{r.rule}', '{r.verdict}', '{r.host}', '{r.path}')" for r in PREFIX_RULES)
    patterns = ",\n".join(f"('{r.name}', '{r.regex}')" for r in PATTERN_RULES)
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://(.*)$', 1) ELSE '' END AS rest FROM pages),
h AS (
  SELECT rid, page_id, translate(url, '{UPPER}', '{LOWER}') AS lowered,
         translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, verdict, rhost, rpath) AS (VALUES {rules}),
patterns(name, regex) AS (VALUES {patterns}),
fit AS (
  SELECT rid, rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, CASE verdict WHEN 'block' THEN 0 ELSE 1 END, rule) AS n
  FROM h JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)),
pat AS (SELECT rid, min(name) AS name FROM h JOIN patterns ON regexp_matches(lowered, regex) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN name IS NULL THEN 'allow' ELSE 'block' END) AS verdict, name AS pattern_rule
FROM h LEFT JOIN (SELECT * FROM fit WHERE n = 1) USING (rid) LEFT JOIN pat USING (rid)
"""
