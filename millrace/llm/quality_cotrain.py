"""Quality classifier by co-training of two views.

* The text view: which of a learned vocabulary of telling words a text holds, and its signs and lexical ratios.
* The page view: source, language, length, and how the page is laid out in lines.

Each view has its own logistic model. A bounded labelled sample starts both. In each round each model labels all documents
outside that sample; those it is confident of join the other model's training set. One weighs as much as a labelled document
at most, and all of one sign the ``PSEUDO`` share of the sample's, however many they are. Newton steps need sums over these
documents only, which are added up where the documents are; none is collected. The models are calibrated on a third of the sample that neither is
trained on; calibrated log odds are added (less the prior's) to score every document. A document is bad if its quality label
would be 0 or its toxic label 1; it is kept if the probability of that is below ``REJECT``.

The sample has at most ``MAX_LABELLED`` labelled documents (those of the smallest hash of the id, less texts of over
``MAX_TEXT`` bytes); pseudo-labels and scores cover every row, very long texts whole. Null text counts as empty, null metadata
as values of their own. Labels for one document are merged (least quality, greatest toxicity); null labels are left out.
Without labels of both kinds every document is kept with score 1 (all bad: 0). Repeated rows, and rows of one id with different
texts, are scored one by one; a score of exactly 1 - ``REJECT`` rejects. An empty table gives an empty result. Extra columns,
whatever their names, are left out of the report and kept by the filter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import id_hash, shares, small_batches, snapshot, under

MAX_LABELLED, MAX_TEXT = 6_000, 4_000_000
ROUNDS, STEPS, CONFIDENT, PSEUDO = 3, 3, 0.95, 0.3
REJECT = 0.5
LEAST_DOCS, LEAST_Z, LEAST_ROWS = 5, 6.0, 20
#: Kinds of labelled documents; telling words are sought for each of the bad ones.
GOOD, POOR, TOXIC = 0, 1, 2
_TO_WORDS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
SYMBOLS, PUNCTUATION, CAPITALS = b"#*$%&|<>", b".,;:!?", bytes(range(65, 91))


def look(text: str, n_chars: int | None = None) -> tuple[set[bytes], list[float], list[float]]:
    """A text's words, its signs and ratios (text view; its length in words last) and its layout (page view)."""
    data = text.encode()
    words = data.lower().translate(_TO_WORDS).split()
    n = max(1, len(words))
    own = set(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    without = lambda signs: len(data) - len(data.translate(None, signs))
    blank = max(1, data.count(b" ") + data.count(b"\n"))
    again = sum(map(bytes.__eq__, words, words[1:])) / n
    short = min(1.0, n / 50)  # short texts repeat less
    symbols = without(SYMBOLS)
    lexical = [len(own) / n * short, again, min(1.0, 4 * without(CAPITALS) / max(1, len(data))), min(1.0, symbols / blank), math.log1p(sum(map(len, words)) / n) / 3, short, len(text) / len(data) if data else 1.0, min(1.0, without(PUNCTUATION) / blank), min(1.0, data.count(b"!!") / blank), min(1.0, symbols / max(1, len(data)) * 5), float(n)]
    layout = [math.log1p(len(text) if n_chars is None else max(0, n_chars)) / 10, math.log1p(len(data) / k) / 8, (len(lines) - len(set(lines))) / k, min(1.0, data.count(b" | ") / blank * 3)]
    return own, lexical, layout


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weights (the last is the bias) by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    reg = np.full(len(w), l2 * len(x))
    reg[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + reg * w
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(reg)
        d = np.linalg.solve(hess, g)
        w -= d
        if np.abs(d).max() < 1e-6:
            break
    return w


def logits(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


class TextView:
    """Telling words, each with its share of bad texts and its rate in others, and the logistic model over their evidence."""

    def learn_words(self, rows: list[np.ndarray], sizes: np.ndarray, names: list[bytes], kinds: np.ndarray) -> None:
        """rows: the numbers of each text's distinct words; sizes: their lengths in words; names: all words by number."""
        self.words = {}
        count = lambda which: np.bincount(np.concatenate([rows[i] for i in np.flatnonzero(which)] or [np.empty(0, np.int32)]), minlength=len(names))
        for kind in (POOR, TOXIC):
            bad = kinds == kind
            a, b, nb, ng = count(bad), count(~bad), max(1, int(bad.sum())), max(1, int((~bad).sum()))
            q = (a + b) / (nb + ng)
            z = (a / nb - b / ng) / np.sqrt(q * (1 - q) * (1 / nb + 1 / ng) + 1e-12)
            telling = np.flatnonzero((a >= LEAST_DOCS) & (a / nb > 20 * (b + 0.5) / ng) & (z > LEAST_Z))
            chosen = sorted(telling, key=lambda i: (-z[i], names[i]))
            total = max(1.0, float(sizes[~bad].sum()))
            for i in chosen:
                self.words.setdefault(names[i], (float((a[i] + 0.5) / (nb + 1)), float((b[i] + 0.5) / total)))
        self.share, self.rate = (np.array([v[k] for v in self.words.values()]) for k in (0, 1))
        self.place = {w: k for k, w in enumerate(self.words)}

    def row(self, hit: list[int], lexical: list[float]) -> list[float]:
        """hit: the places of the telling words that the text holds. A long text holds some by accident: a word's evidence
        is less the likelier that is at this length, and what is expected of accident is taken off."""
        *ratios, n = lexical
        if not len(self.share):
            return [0.0, 0.0, 0.0, *ratios]
        chance = -np.expm1(-self.rate * n)
        evidence = np.log1p(self.share * (1 - chance) / chance)
        own = evidence[hit]
        over = [float(own.sum() - chance @ evidence), float(own.max(initial=0.0)), float(len(hit) - chance.sum())]
        return [min(max(over[0], -10.0), 30.0) / 5, over[1] / 5, min(max(over[2], -5.0), 5.0) / 5, *ratios]

    def places(self, names: list[bytes]) -> np.ndarray:
        return np.array([self.place.get(w, -1) for w in names], np.int64)

    def matrix(self, seen: list[tuple[set[bytes], list[float]]]) -> np.ndarray:
        return np.array([self.row([self.place[w] for w in own & self.place.keys()], lexical) for own, lexical in seen])


class PageView:
    """Layout, and for source and language the log odds that the sample's documents of this value are bad."""

    def learn_values(self, rows: list[tuple[str, str, list[float]]], y: np.ndarray) -> None:
        self.odds = []
        share = (y.sum() + 1) / (len(y) + 2)
        for k in (0, 1):
            values, at = np.unique([r[k] for r in rows], return_inverse=True)
            n, bad = np.bincount(at), np.bincount(at, weights=y)
            rate = (bad + 10 * share) / (n + 10)
            own = np.log(rate / (1 - rate)) - math.log(share / (1 - share))
            self.odds.append({str(v): float(x) for v, x, c in zip(values, own, n, strict=True) if c >= LEAST_ROWS})

    def matrix(self, rows: list[tuple[str, str, list[float]]]) -> np.ndarray:
        return np.array([[self.odds[0].get(s, 0.0), self.odds[1].get(g, 0.0), *layout] for s, g, layout in rows])


def sums(x: np.ndarray, z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What a Newton step at w needs of rows x that another view's logits z are confident of: for bad and for good ones the
    number, the gradient and the Hessian, one after the other."""
    bound, out = math.log(CONFIDENT / (1 - CONFIDENT)), []
    for sign, label in ((1, 1.0), (-1, 0.0)):
        some = np.column_stack([x[sign * z >= bound], np.ones(int((sign * z >= bound).sum()))])
        p = 1 / (1 + np.exp(-np.clip(some @ w, -30, 30)))
        out += [[len(some)], some.T @ (p - label), ((some * (p * (1 - p) + 1e-6)[:, None]).T @ some).ravel()]
    return np.concatenate(out)


class CoTrained:
    """What the workers hold: both views, their calibration, the prior."""

    def __init__(self, constant: float | None = None):
        self.constant = constant

    def learn(self, rows, kinds: np.ndarray, names: list[bytes]) -> CoTrained:
        """What telling words and values there are. rows: (numbers of words, lexical, layout, source, lang); kinds: of the rows;
        names: the words by number."""
        self.y = (kinds != GOOD).astype(float)
        self.held = np.arange(len(rows)) % 3 == 2
        train = [r for r, c in zip(rows, self.held, strict=True) if not c]
        self.views = {"text": TextView(), "page": PageView()}
        self.views["text"].learn_words([r[0] for r in train], np.array([r[1][-1] for r in train]), names, kinds[~self.held])
        self.views["page"].learn_values([(r[3], r[4], r[2]) for r in train], self.y[~self.held])
        places = self.views["text"].places(names)
        text = [self.views["text"].row(w[w >= 0].tolist(), r[1]) for r in rows for w in [places[r[0]]]]
        self.x = {"text": np.array(text), "page": self.views["page"].matrix([(r[3], r[4], r[2]) for r in rows])}
        self.w = {k: logistic(x[~self.held], self.y[~self.held]) for k, x in self.x.items()}
        return self

    def train(self, added: Callable[[dict, dict], dict[str, np.ndarray]]) -> CoTrained:
        """Rounds. added(labellers, w): for each view the sums over the documents that the other view's labeller is confident of."""
        y = self.y[~self.held]
        for _ in range(ROUNDS):
            labellers = dict(self.w)
            for _ in range(STEPS):
                got = added(labellers, self.w)
                self.w = {k: self.step(k, y, got[k]) for k in self.w}
        return self.calibrate()

    def step(self, k: str, y: np.ndarray, added: np.ndarray, l2: float = 1e-3) -> np.ndarray:
        """A Newton step of view k over the sample and what is added."""
        x = np.column_stack([self.x[k][~self.held], np.ones(len(y))])
        w, d = self.w[k], x.shape[1]
        reg = np.full(d, l2 * len(x))
        reg[-1] = 1e-9
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g, hess = x.T @ (p - y), (x * (p * (1 - p) + 1e-6)[:, None]).T @ x
        for label, part in zip((1, 0), np.split(added, 2), strict=True):
            if part[0]:
                share = min(1.0, PSEUDO * float((y == label).sum()) / part[0])
                g += share * part[1 : 1 + d]
                hess += share * part[1 + d :].reshape(d, d)
        move = np.linalg.solve(hess + np.diag(reg), g + reg * w)
        return w - move * min(1.0, 5 / (np.abs(move).max() + 1e-12))

    def calibrate(self) -> CoTrained:
        yc = self.y[self.held]
        self.scale = {}
        for k, w in self.w.items():
            z = logits(self.x[k][self.held], w)
            self.scale[k] = logistic(z[:, None], yc, l2=1e-4) if 0 < yc.sum() < len(yc) else np.array([1.0, 0.0])
        rate = (yc.sum() + 1) / (len(yc) + 2)
        self.prior = math.log(rate / (1 - rate))
        self.x = self.y = self.held = None  # the workers need no sample
        return self

    def matrices(self, texts: list[str], sources: list, langs: list, sizes: list) -> dict[str, np.ndarray]:
        seen = [look(t, n) for t, n in zip(texts, sizes, strict=True)]
        page = [(str(s), str(g), y) for s, g, (_, _, y) in zip(sources, langs, seen, strict=True)]
        return {"text": self.views["text"].matrix([(w, x) for w, x, _ in seen]), "page": self.views["page"].matrix(page)}

    def score(self, x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of being good: by text, by page, both."""
        a, b = (logits(logits(x[k], self.w[k])[:, None], self.scale[k]) for k in ("text", "page"))
        good = lambda z: 1 / (1 + np.exp(np.clip(z, -30, 30)))
        return good(a), good(b), good(a + b - self.prior)


_LOOK = "o bigint, words binary, lexical array<double>, layout array<double>, source string, lang string, y int"


def _sample(df: DataFrame, most: int, known: dict[bytes, int]) -> list:
    """((numbers of words, lexical, layout, source, lang), label) of the first rows by hash of the id; known gives words their
    numbers and grows. Texts are looked at where they are; the driver gets the distinct words and ratios of `most` texts."""
    y = F.col("y").cast("int") if "y" in df.columns else F.lit(None).cast("int")
    src = df.select(id_hash().alias("o"), "text", F.col("n_chars").cast("bigint").alias("n"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), y.alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = [look(t or "", n) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            words = pa.array([b" ".join(sorted(w)) for w, _, _ in seen], pa.binary())
            ratios = [pa.array([x[k] for x in seen], pa.list_(pa.float64())) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([b.column(0), words, *ratios, *(b.column(k) for k in (3, 4, 5))], ["o", "words", "lexical", "layout", "source", "lang", "y"])

    rows = src.mapInArrow(run, _LOOK).orderBy("o", "source", "lang", "y", "lexical").limit(most)
    number = lambda words: np.fromiter((known.setdefault(w, len(known)) for w in bytes(words).split()), np.int32)
    return [((number(r.words), list(r.lexical), list(r.layout), str(r.source), str(r.lang)), r.y) for r in rows.toLocalIterator()]


def _least(most: int, of: DataFrame, rows: Callable[[Column], DataFrame]) -> DataFrame:
    """The `most` rows of least hash of the id; rows(near) gives those among which they are sought. Their number is bounded."""
    for share in shares(most, of.count()):
        found = snapshot(rows(under(id_hash(), share)).orderBy(id_hash(), "doc_id").limit(most))
        if found.count() == most:
            break
    return found


VIEWS = ("text", "source", "lang", "n_chars")


def _matrices(model: CoTrained, cols: list[list]) -> Iterator[dict[str, np.ndarray]]:
    """The views' matrices of a batch (columns in the order of VIEWS), in slices of bounded size."""
    texts, n = [t or "" for t in cols[0]], 0
    for part in slices(texts):
        m = n + len(part)
        yield model.matrices(part, *(c[n:m] for c in cols[1:]))
        n = m


def _seen(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, text, page: the views' rows of all documents, computed once (some 200 bytes each)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # telling words and values of the bounded sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = list(_matrices(sent.value, [b.column(k + 1).to_pylist() for k in range(len(VIEWS))]))
            cols = [pa.array([r for x in parts for r in x[k].tolist()], pa.list_(pa.float64())) for k in ("text", "page")]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "text", "page"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return snapshot(docs.select("doc_id", *VIEWS).mapInArrow(run, f"doc_id {kind}, text array<double>, page array<double>"))


def _rows(b: pa.RecordBatch, k: str) -> np.ndarray:
    flat = b.column(b.schema.get_field_index(k)).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(b.num_rows, -1) if b.num_rows else np.empty((0, 0))


def _added(seen: DataFrame, size: dict[str, int]) -> Callable[[dict, dict], dict[str, np.ndarray]]:
    """Sums over all documents of seen, added up in their tasks and then by place; some hundred numbers reach the driver."""

    def of(labellers: dict, w: dict) -> dict[str, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for b in batches:
                if b.num_rows:
                    x = {k: _rows(b, k) for k in w}
                    z = {k: logits(x[k], labellers[k]) for k in w}
                    total = total + np.concatenate([sums(x["text"], z["page"], w["text"]), sums(x["page"], z["text"], w["page"])])
            if isinstance(total, np.ndarray):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "v"])

        got = seen.select("text", "page").mapInArrow(run, "place int, v double").groupBy("place").agg(F.sum("v").alias("v")).collect()
        n = [2 * (1 + (size[k] + 1) + (size[k] + 1) ** 2) for k in ("text", "page")]
        flat = np.zeros(sum(n))
        flat[[r.place for r in got]] = [r.v for r in got]
        return {"text": flat[: n[0]], "page": flat[n[0] :]}

    return of


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[CoTrained, DataFrame | None]:
    """The model, and the views' rows of all documents that it was trained with."""
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    known = known.filter(F.col("q").isNotNull() | F.col("t").isNotNull()).select("doc_id", F.when(F.coalesce("t", F.lit(0)) == 1, TOXIC).when(F.coalesce("q", F.lit(1)) == 0, POOR).otherwise(GOOD).alias("y"))
    src = docs.select("doc_id", *VIEWS)
    small_batches(docs.sparkSession)
    # Ids first, so that texts are read for the bounded sample only.
    chosen = _least(max_labelled, labels, lambda near: known.filter(near).join(src.filter(near).select("doc_id").distinct(), "doc_id", "left_semi"))
    words: dict[bytes, int] = {}
    some = src.join(F.broadcast(chosen), "doc_id").filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= MAX_TEXT)
    rows = _sample(some, max_labelled, words)
    kinds = np.array([b for _, b in rows], int)
    train = kinds[np.arange(len(kinds)) % 3 != 2] != GOOD
    if not len(train) or train.all() or not train.any():
        return CoTrained(0.0 if len(kinds) and (kinds != GOOD).all() else 1.0), None
    model = CoTrained().learn([r for r, _ in rows], kinds, list(words))
    seen = _seen(docs, model)
    pool = seen.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")  # at most max_labelled ids
    return model.train(_added(pool, {k: x.shape[1] for k, x in model.x.items()})), seen


_REPORT = ["text_score", "page_score", "score"]


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, page_score, score (probabilities of a good document), kept."""
    model, seen = fit(docs, labels)
    if seen is None:
        out = docs.select("doc_id", *[F.lit(model.constant).alias(c) for c in _REPORT])
    else:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, model.score({k: _rows(b, k) for k in ("text", "page")}))], ["doc_id", *_REPORT])

        out = seen.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} double" for c in _REPORT))
    return out.withColumn("kept", F.col("score") > 1 - REJECT)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that are kept, whole and without a shuffle: texts are looked at again instead."""
    model, _ = fit(docs, labels)
    if model.constant is not None:
        return docs.filter(F.lit(model.constant > 1 - REJECT))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = [docs.columns.index(k) for k in VIEWS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [sent.value.score(x)[2] for x in _matrices(sent.value, [b.column(k).to_pylist() for k in at])]
            yield b.filter(pa.array(np.concatenate([*scores, np.empty(0)]) > 1 - REJECT))

    return docs.mapInArrow(run, docs.schema)
