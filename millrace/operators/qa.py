"""Questions and answers: best answer, composed documents, parsed pairs, instruction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import first_wins

MARK = "\n## Top answer\n"
BLANKS = " \t\n\r\x0b\x0c"


def trimmed(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def best_answers(answers: DataFrame) -> DataFrame:
    """The first accepted answer of each question, else that of the highest score above 0 (the first of equal ones)."""
    fit = answers.filter("accepted OR score > 0")
    rank = F.when(F.col("accepted"), F.lit(None)).otherwise(-F.col("score"))
    return first_wins(fit, ["question_id"], [F.desc("accepted"), rank, "pos"])


def answers_by_question(questions: DataFrame, answers: DataFrame) -> DataFrame:
    own = answers.groupBy("question_id").agg(F.array_sort(F.collect_list(F.struct("pos", "answer_id", "score", "accepted"))).alias("answers"))
    return questions.join(own, "question_id", "left")


def compose(title: Column, question: Column, answer: Column) -> Column:
    """The document; null without a question. An answer that is blank is left out."""
    q, a = trimmed(question), trimmed(answer)
    tail = F.when(a != "", F.concat(F.lit(MARK + "\n"), a, F.lit("\n"))).otherwise("")
    return F.when(q != "", F.concat(F.lit("# "), title, F.lit("\n\n"), q, F.lit("\n"), tail))


def parse(content: Column, min_answer: int = 0) -> Column:
    """struct(title, question, answer), or null where the parts aren't all there or the answer is too short."""
    s = trimmed(content)
    title = F.regexp_extract(s, r"\A#\s+(.+)", 1)
    head = F.length(F.regexp_extract(s, r"\A#\s+.+", 0))
    rest = trimmed(F.substring(s, head + 1, F.length(s)))
    at = F.instr(rest, MARK)
    question = trimmed(F.substring(rest, F.lit(1), at - 1))
    answer = trimmed(F.substring(rest, at + len(MARK), F.length(rest)))
    ok = (head > 0) & (at > 0) & (question != "") & (F.length(answer) >= min_answer)
    return F.when(ok, F.struct(F.trim(title, F.lit(BLANKS)).alias("title"), question.alias("question"), answer.alias("answer")))


def pairs(articles: DataFrame, min_quality: float = 0.0, min_answer: int = 100, source: str = "stackexchange") -> DataFrame:
    """Parsed pairs of one source; of equal titles the best by quality, then the first."""
    fit = articles.filter((F.col("source_type") == source) & F.col("content_md").isNotNull() & (F.col("quality_score").isNull() | (F.col("quality_score") >= min_quality)))
    parsed = fit.withColumn("qa", parse(F.col("content_md"), min_answer)).filter("qa IS NOT NULL").select("id", "url", "tags", "quality_score", "qa.*")
    return first_wins(parsed, [F.lower("title")], [F.desc_nulls_last("quality_score"), "id"])


def alpaca(p: DataFrame) -> DataFrame:
    return p.select(F.col("title").alias("instruction"), F.col("question").alias("input"), F.col("answer").alias("output"), "url", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))


def sharegpt(p: DataFrame) -> DataFrame:
    turn = lambda who, what: F.struct(F.lit(who).alias("from"), what.alias("value"))
    human = trimmed(F.concat("title", F.lit("\n\n"), "question"))
    return p.select(F.array(turn("human", human), turn("gpt", F.col("answer"))).alias("conversations"), "url", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))
