"""Markdown chunks with heading paths, and main content of HTML pages as Markdown."""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate, pairwise, takewhile

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Fixed value: a line that is a heading, with its marks and its title.
HEADING = re.compile(r"^(#{1,6})\s+(.*\S)\s*$")


def _under(path: tuple[str, ...], heading: re.Match) -> tuple[str, ...]:
    """The path at a heading of this depth; a depth that was jumped over leaves no gap."""
    return (*path[: len(heading[1]) - 1], heading[2])


def windows(sizes: list[int], target: int, overlap: int) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of paragraphs: each as long as its joined text keeps within target, one paragraph more than
    what is carried at least; what is carried from a run is its longest end of up to overlap characters."""
    edge = [0, *accumulate(n + 2 for n in sizes)]
    first, least = 0, 1
    while least <= len(sizes):
        to = max(least, bisect_right(edge, edge[first] + target + 2) - 1)
        yield first, to
        first, least = max(first, bisect_left(edge, edge[to] - overlap)), to + 1


def chunk_markdown(text: str | None, target: int = 1200, overlap: int = 150, min_chars: int = 30) -> list[tuple[str, tuple[str, ...]]]:
    """(text, heading path) of each chunk, in order.

    Lines are cut before each heading (within fences, too). A part longer than target is cut further between paragraphs, and
    the headings that it begins with stand before each of its pieces.
    """
    lines = (text or "").splitlines()
    heads = [(i, m) for i, line in enumerate(lines) if (m := HEADING.match(line))]
    paths = accumulate((m for _, m in heads), _under, initial=())
    cuts = [0, *(i for i, _ in heads), len(lines)]
    found = []
    for path, (a, z) in zip(paths, pairwise(cuts), strict=True):
        body = "\n".join(lines[a:z]).strip()
        if len(body) <= target:
            found.append((body, path))
            continue
        parts = [x.strip() for x in re.split(r"\n\s*\n", body) if x.strip()]
        titles = list(takewhile(lambda x: all(map(HEADING.match, x.splitlines())), parts))
        rest = parts[len(titles) :]
        found += [("\n\n".join([*titles, *rest[i:j]]), path) for i, j in windows(list(map(len, rest)), target, overlap)]
    return [(x, path) for x, path in found if x and len(x) >= min_chars]


CHUNKS = "array<struct<text:string,heading_path:array<string>>>"


#: A worker cuts texts of so many characters at once, one text at least, and hands their pieces on before it takes more.
SLICE_CHARS = 1_000_000
#: What one Arrow batch brings into a worker at most, a single longer row apart.
BATCH_BYTES = 8 << 20


def with_chunks(df: DataFrame, text_col: str, target: int = 1200, overlap: int = 150, min_chars: int = 30) -> DataFrame:
    """df, with a column pieces (the chunks of each row's text) in place of the text.

    Python holds a batch's texts in Arrow only and makes objects of a slice of them at a time.
    """
    kind = pa.list_(pa.struct([("text", pa.string()), ("heading_path", pa.list_(pa.string()))]))
    at = df.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts, rest = b.column(at), b.remove_column(at)
            for a, z in slices(texts, SLICE_CHARS):
                pieces = [[(x, list(path)) for x, path in chunk_markdown(t.as_py(), target, overlap, min_chars)] for t in texts[a:z]]
                yield pa.RecordBatch.from_arrays([*rest.slice(a, z - a).columns, pa.array(pieces, kind)], [*rest.schema.names, "pieces"])

    from pyspark.sql.types import StructType, _parse_datatype_string

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    schema = StructType([f for f in df.schema.fields if f.name != text_col]).add("pieces", _parse_datatype_string(CHUNKS))
    return df.mapInArrow(run, schema)


def slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts of up to so many characters together, one text at least."""
    a = held = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if i > a and held + n > most:
            yield a, i
            a, held = i, 0
        held += n
    if len(texts) > a:
        yield a, len(texts)


class _Main(HTMLParser):
    """Text of the article (or main, or body) as Markdown; scripts, navigation and the like are left out."""

    LEFT_OUT = {"script", "style", "nav", "footer", "aside", "form", "noscript", "header", "svg", "iframe", "button", "title", "head"}
    BLOCKS = {"p", "div", "section", "article", "main", "ul", "ol", "blockquote", "table", "figure", "body"}
    VOID = {"br", "img", "hr", "meta", "link", "input"}

    def __init__(self, root: str | None):
        super().__init__(convert_charrefs=True)
        self.root, self.inside, self.skip, self.pre = root, 0 if root else 1, 0, 0
        self.out: list[str] = []
        self.row: list[str] | None = None
        self.cell: list[str] | None = None
        self.rows = 0

    def emit(self, s: str) -> None:
        (self.out if self.cell is None else self.cell).append(s)

    def handle_starttag(self, tag, attrs):
        if tag == self.root:
            self.inside += 1
        if tag in self.LEFT_OUT and tag not in self.VOID:
            self.skip += 1
        if not self.inside or self.skip:
            return
        if re.fullmatch("h[1-6]", tag):
            self.emit("\n\n" + "#" * int(tag[1]) + " ")
        elif tag == "pre":
            self.pre += 1
            self.emit("\n\n```\n")
        elif tag == "code" and not self.pre:
            self.emit("`")
        elif tag == "li":
            self.emit("\n- ")
        elif tag == "br":
            self.emit("\n")
        elif tag == "tr":
            self.row = []
        elif tag in ("td", "th"):
            self.cell = []
        elif tag == "table":
            self.rows = 0
            self.emit("\n\n")
        elif tag in self.BLOCKS:
            self.emit("\n\n")

    def handle_endtag(self, tag):
        if tag in self.LEFT_OUT and self.skip:
            self.skip -= 1
        if self.inside and not self.skip:
            if tag == "pre" and self.pre:
                self.pre -= 1
                self.emit("\n```\n\n")
            elif tag == "code" and not self.pre:
                self.emit("`")
            elif tag in ("td", "th") and self.cell is not None:
                text = " ".join("".join(self.cell).split())
                self.cell = None
                if self.row is not None:
                    self.row.append(text)
            elif tag == "tr" and self.row is not None:
                self.out.append("| " + " | ".join(self.row) + " |\n")
                if not self.rows:
                    self.out.append("|" + " --- |" * len(self.row) + "\n")
                self.rows += 1
                self.row = None
            elif tag in self.BLOCKS or re.fullmatch("h[1-6]", tag):
                self.emit("\n\n")
        if tag == self.root and self.inside:
            self.inside -= 1

    def handle_data(self, data):
        if self.inside and not self.skip:
            self.emit(data if self.pre else re.sub(r"\s+", " ", data))


def html_to_markdown(page: str | None) -> str | None:
    """Main content as Markdown; null where there is none."""
    if not page:
        return None
    root = next((t for t in ("article", "main", "body") if re.search(rf"<{t}[\s>]", page, re.I)), None)
    p = _Main(root)
    p.feed(page)
    p.close()
    parts = re.split(r"(```\n.*?\n```)", "".join(p.out), flags=re.S)
    text = "".join(x if i % 2 else re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]*\n[ \t]*", "\n", x)) for i, x in enumerate(parts)).strip()
    return text or None


@pandas_udf(StringType())
def extract_content(pages):
    return pages.map(html_to_markdown)


@pandas_udf(StringType())
def unescape(text):
    return text.map(lambda s: None if s is None else html.unescape(s))


def posexploded(df: DataFrame, keep: list[str | Column]) -> DataFrame:
    """A row for each chunk: kept columns, n_chunks, chunk_index, text, heading_path."""
    return df.select(*keep, F.size("pieces").alias("n_chunks"), F.posexplode("pieces").alias("chunk_index", "piece")).select("*", F.col("piece.text").alias("text"), F.col("piece.heading_path").alias("heading_path")).drop("piece")
