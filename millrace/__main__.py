"""python -m millrace COMMAND ROOT ...: the store's exports, upkeep and dashboard queries from a shell."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .api import Corpus
from .streaming.ingest import Ingest, message_stream


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="millrace")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, **options) -> None:
        c = sub.add_parser(name)
        c.add_argument("root")
        for k, v in options.items():
            flag = "--" + k.replace("_", "-")
            if v is False:
                c.add_argument(flag, action="store_true")
            elif isinstance(v, type):
                c.add_argument(flag, type=v, required=True)
            else:
                c.add_argument(flag, type=str if v is None else type(v), default=v)

    for name in ("summary", "lang-dist", "source-dist", "pipeline", "health", "backfill-simhash"):
        command(name)
    command("daily", limit=30)
    command("search", q=str, k=8, source=None)
    command("articles", lang=None, q=None, source=None, page=1, page_size=20)
    command("article", id=int)
    command("quality-probe", limit=500)
    command("export", out=str, limit=0, min_len=200, min_score=0.0, lang=None)
    command("export-sft", out=str, format="alpaca", min_quality=0.0, min_answer_chars=100)
    command("rag-export", out=str, state=str, full=False, target=1200, overlap=150, min_chars=30)
    command("embed", chunks=str, out=str)
    command("import-vectors", chunks=str, archive=str, initial=False)
    command("sync-vectors", initial=False)
    command("dlq-replay", landing=str, limit=0, dry_run=False, delete=False)
    command("ingest", landing=str, checkpoint=str, every=None, languages="en")
    return p


def run(spark: SparkSession, args: argparse.Namespace):
    """A DataFrame (or several) to show, a number to print, or nothing."""
    o = {k: v for k, v in vars(args).items() if k not in ("command", "root")}
    c = Corpus(spark, args.root)
    if args.command == "ingest":
        job = Ingest(args.root, tuple(args.languages.split(",")))
        job.start(message_stream(spark, args.landing), args.checkpoint, args.every).awaitTermination()
        return c.pipeline()
    if args.command == "articles":
        return list(c.list(**o))
    if args.command == "article":
        return c.article(args.id)
    if args.command == "health":
        return list(c.health().values())
    return getattr(c, args.command.replace("-", "_"))(**o)


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName("millrace").getOrCreate()
    out = run(spark, args)
    for x in out if isinstance(out, list) else [out]:
        if hasattr(x, "show"):
            x.show(100, truncate=80)
        elif x is not None:
            print(x)
    spark.stop()


if __name__ == "__main__":
    main()
