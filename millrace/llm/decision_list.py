"""Quality rules: features of whole texts, and a decision list learned by sequential covering.

The list is learned from labelled statistics: rules for bad documents are grown one condition (feature, threshold) at a
time by information gain on two thirds of the sample, pruned on the other third, and kept while they are precise there; what
a rule covers is taken out before the next is grown. The learned list is emitted as one ordered Spark conditional.

The fit reads at most ``MAX_LABELLED`` labelled documents (those of the smallest hash of the id); everything else covers all
rows. Null or empty text has no words and fails the base rules. A very long text is counted whole. Labels that are null are
left out; of several labels for one document the smallest counts, and of several texts of one id the one of the smallest counts
is learned from. Repeated rows are judged one by one. Conditions of equal gain: the first by feature, then threshold, then
sign. Without labels, or with labels of one kind, no rule is learned; an empty table gives an empty result. Extra columns,
whatever their names, are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_hash, shares, small_batches, snapshot, under, whole_text

MAX_LABELLED = 20_000
MIN_PRECISION = 0.9
SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\x0b\x0c\r"
PUNCTUATION = b".,;:!?"
DIGITS, CAPITALS = b"0123456789", bytes(range(65, 91))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_punctuation", "n_digits", "n_capitals", "n_distinct_words", "longest_word"]
#: Ratios that rules are made of, as Spark expressions over the counts.
RATIOS = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "punctuation_per_word": "n_punctuation / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "longest_word": "longest_word",
}


def counts(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS. Words are runs without the six ASCII blanks."""
    data = text.encode()
    words = data.split()
    n = len(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    without = lambda signs: len(data) - len(data.translate(None, signs))
    repeated = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(grams)) < len(grams):
            often = Counter(grams)
            until = 0
            for i, g in enumerate(grams):
                if often[g] > 1:
                    repeated += i + 3 - max(i, until)
                    until = i + 3
    distinct = set(words)
    return (n, len(text) - without(BLANK), without(SYMBOLS), len(lines) - len(set(lines)), repeated, len(text), len(lines), without(PUNCTUATION), without(DIGITS), without(CAPITALS), len(distinct), max(map(len, distinct), default=0))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts."""
    small_batches(docs.sparkSession)
    names = ["doc_id", *COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [counts(t) for t in b.column(1).to_pylist()]
            cols = list(zip(*rows, strict=True)) or [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols]], names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray]:
    """Ratios and badness (label 0) of a bounded sample of the labelled documents."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label_col).alias("y"))
    for share in shares(most, labels.count()):
        chosen = snapshot(known.filter(under(id_hash(), share)).orderBy(id_hash(), "doc_id").limit(most))
        if chosen.count() == most:
            break
    known = chosen
    some = docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")  # bounded by most
    f = features(some).groupBy("doc_id").agg(F.min(F.struct(*COUNTS)).alias("c")).select("doc_id", "c.*")
    f = f.join(F.broadcast(known), "doc_id").orderBy(id_hash(), "doc_id")
    pdf = f.select(*[F.expr(e).cast("double").alias(k) for k, e in RATIOS.items()], "y").toPandas()
    return pdf[list(RATIOS)].to_numpy(), (pdf["y"] == 0).to_numpy()


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], max_rules: int = 12, max_conditions: int = 4, min_precision: float = MIN_PRECISION) -> list[list[tuple[str, str, float]]]:
    """Rules for bad rows, in order; each is a list of (feature, '<=' or '>', threshold)."""
    rules: list[list[tuple[str, str, float]]] = []
    if not bad.any() or bad.all():
        return rules
    part = np.arange(len(x)) % 3
    seen = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 101))) for j in range(x.shape[1])]
    cuts = [(v[1:] + v[:-1]) / 2 for v in seen]  # half way between observed values
    left = np.ones(len(x), bool)

    def holds(conds, rows) -> np.ndarray:
        ok = np.ones(len(rows), bool)
        for j, sign, t in conds:
            ok &= (x[rows, j] <= t) if sign == "<=" else (x[rows, j] > t)
        return ok

    for _ in range(max_rules):
        grow, prune = np.flatnonzero(left & (part < 2)), np.flatnonzero(left & (part == 2))
        if bad[grow].sum() < 5:
            break
        conds: list[tuple[int, str, float]] = []
        rows = grow
        while len(conds) < max_conditions:
            p0, n0 = bad[rows].sum(), (~bad[rows]).sum()
            if n0 == 0:
                break
            base, best = np.log2(p0 / (p0 + n0)), (0.0, None)
            for j, own in enumerate(cuts):
                v, b = x[rows, j], bad[rows]
                for t in own:
                    for sign, hit in (("<=", v <= t), (">", v > t)):
                        p = int((hit & b).sum())
                        if p >= 3:
                            gain = p * (np.log2(p / hit.sum()) - base)
                            if gain > best[0] + 1e-12:
                                best = (gain, (j, sign, float(t)))
            if best[1] is None:
                break
            conds.append(best[1])
            rows = grow[holds(conds, grow)]

        def worth(c) -> float:
            hit = holds(c, prune)
            p, n = int((hit & bad[prune]).sum()), int((hit & ~bad[prune]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        best_len = max(range(1, len(conds) + 1), key=lambda k: (round(worth(conds[:k]), 9), -k), default=0)
        conds = conds[:best_len]
        if not conds:
            break
        hit = holds(conds, np.arange(len(x))) & left
        pruned = holds(conds, prune)
        judged = prune[pruned] if pruned.sum() >= 5 else np.flatnonzero(hit)
        if not len(judged) or bad[judged].mean() < min_precision:
            break
        rules.append([(names[j], sign, t) for j, sign, t in conds])
        left &= ~hit
    return rules


def as_condition(rule) -> Column:
    out = F.lit(True)
    for name, sign, t in rule:
        e = F.expr(RATIOS[name]).cast("double")
        out = out & ((e <= F.lit(t)) if sign == "<=" else (e > F.lit(t)))
    return out


def as_column(rules) -> Column:
    """The number (from 1) of the first rule that holds, else null."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(as_condition(r), F.lit(i)) if out is None else out.when(as_condition(r), F.lit(i))
    return (F.lit(None) if out is None else out).cast("int")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five base counts, base_failed, kept, rule (which one of the learned list rejects the document)."""
    rules = learn(*labelled_sample(docs, labels), list(RATIOS))
    out = features(docs).withColumn("base_failed", base_failed()).withColumn("rule", as_column(rules))
    return out.select("doc_id", *COUNTS[:5], "base_failed", (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"), "rule")
