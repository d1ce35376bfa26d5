"""Text features and the ordered quality gate, as columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import rounded

# The patterns that verdicts depend on, as they stand in the data's contract.
FENCE = "(?s)```[^\\n]*\\n(.*?)```"
INLINE = r"`[^`\n]+`"
LINK = r"https?://\S+|\[[^\]]+\]\(https?://\S+\)"
WORD = r"[A-Za-z][A-Za-z'-]+"
TOKEN = r"[a-z0-9_]+"
SPAM_PATTERNS = [
    r"\bplease\s+(help|subscribe|follow|upvote|donate)\b",
    r"\bcheck\s+out\s+my\s+(channel|blog|repo|github)\b",
    r"\b(free|discount|coupon|promo)\s+code\b",
    r"\bbuy\s+now\b",
    r"\bclick\s+here\b",
    r"\b(job opening|we are hiring|hiring now)\b",
]
HELP_PATTERN = r"\b(can someone help me|how do i fix|i am stuck|i'm stuck|anyone know how|please help me|urgent help)\b"

SPAM = "|".join(SPAM_PATTERNS)
HELP_ASKED = HELP_PATTERN
#: One of these is in whatever the patterns match; they are looked for first.
SPAM_WORDS = ("please", "check", "code", "buy", "click", "job opening", "hiring")
HELP_WORDS = ("help", "how do i fix", "stuck", "know how")


@dataclass(frozen=True)
class Gate:
    """Thresholds of the quality gate."""

    min_chars: int = 100
    min_code_chars: int = 80
    max_link_ratio: float = 0.30
    min_unique_ratio: float = 0.25
    min_words: int = 50


def all_of(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _total_length(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda acc, x: acc + F.length(x))


def code_chars(text: Column) -> Column:
    """Characters in fenced blocks' bodies and in inline code with its ticks (inline code within a fence counts again)."""
    return F.when(~F.contains(text, F.lit("`")), 0).otherwise(_total_length(all_of(text, FENCE, 1)) + _total_length(all_of(text, INLINE)))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD))


def n_links(text: Column) -> Column:
    return F.when(~F.contains(text, F.lit("http")), 0).otherwise(F.regexp_count(text, F.lit("(?U)" + LINK)))


def link_ratio(text: Column) -> Column:
    """Links by words; 0 below 20 words."""
    words = n_words(text)
    return F.when(words < 20, F.lit(0.0)).otherwise(n_links(text) / words)


def unique_ratio(text: Column) -> Column:
    """Distinct words by words, in small letters; 1 below 20 words."""
    words = all_of(F.lower(text), WORD)
    return F.when(F.size(words) < 20, F.lit(1.0)).otherwise(F.size(F.array_distinct(words)) / F.size(words))


def strip_code(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(text, F.lit(FENCE), F.lit(" ")), F.lit(INLINE), F.lit(" "))
    return F.when(F.contains(text, F.lit("`")), bare).otherwise(text)


def _may_have(text: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words is in the text in letters of either case, with those that Unicode folds to ASCII (a dot over I, a long s)."""
    low = F.replace(F.replace(F.replace(F.lower(text), F.lit("ſ"), F.lit("s")), F.lit("ı"), F.lit("i")), F.lit("\u0307"), F.lit(""))
    return reduce(Column.__or__, [F.contains(low, F.lit(w)) for w in words])


def is_spam(text: Column) -> Column:
    return F.when(~_may_have(text, SPAM_WORDS), False).otherwise(F.regexp_like(text, F.lit("(?iU)" + SPAM)))


def asks_help(text: Column) -> Column:
    return F.when(~_may_have(text, HELP_WORDS), False).otherwise(F.regexp_like(text, F.lit("(?iU)" + HELP_ASKED)))


def features(text: Column) -> dict[str, Column]:
    """What the gate looks at, by name; one pass each."""
    return {
        "len": F.length(text),
        "n_words": n_words(text),
        "code_chars": code_chars(text),
        "link_ratio": link_ratio(text),
        "unique_ratio": unique_ratio(text),
        "spam": is_spam(text),
        "help": asks_help(text),
    }


def quality_score() -> Column:
    """0 to 1 over columns of features(): size, code and variety, less a penalty for links."""
    size = F.least(F.col("len") / 3000.0, F.lit(1.0))
    code = F.least(F.col("code_chars") / 800.0, F.lit(1.0))
    variety = F.greatest(F.lit(0.0), F.least("unique_ratio", F.lit(1.0)))
    links = F.least(F.col("link_ratio") / 0.3, F.lit(1.0))
    raw = size * 0.4 + code * 0.3 + variety * 0.3 - links * 0.5
    return F.greatest(F.lit(0.0), F.least(raw, F.lit(1.0)))


def reason(text: Column, g: Gate = Gate()) -> Column:
    """The first rule that applies, over columns of features(); code_rich and ok are kept."""
    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(F.col("spam"), "spam")
        .when(F.col("code_chars") >= g.min_code_chars, "code_rich")
        .when(F.col("link_ratio") > g.max_link_ratio, "link_dump")
        .when(F.col("unique_ratio") < g.min_unique_ratio, "low_diversity")
        .when(F.col("len") < g.min_chars, "too_short")
        .when(F.col("n_words") < g.min_words, "thin_prose")
        .when(F.col("help") & (F.col("n_words") < 2 * g.min_words), "help_request")
        .otherwise("ok")
    )


def assess(df, text_col: str = "content_md", gate: Gate = Gate()):
    """df with the features, reason, keep and quality_score (rounded for reporting; null where empty)."""
    text = F.col(text_col)
    out = df.withColumns(features(text))
    out = out.withColumn("reason", reason(text, gate))
    out = out.withColumn("keep", F.col("reason").isin("code_rich", "ok")).withColumn("quality_score", F.when(text != "", quality_score()))
    return out.withColumn("quality_score", rounded(F.col("quality_score"), 3))
