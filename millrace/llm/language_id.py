"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

Every position of a text is labelled from a forward and a backward state; the document's probabilities are the mean over its
positions. Texts are run whole, in segments of ``SEGMENT`` bytes; each direction comes to a segment with the state that the
``LEAD`` bytes before it (behind it) leave. The network is trained by backpropagation through time on segments drawn from all
over the whole texts of at most ``MAX_LABELLED`` labelled documents of each language (those of the smallest hash of the id)
outside the held-out quarter (crc32 of the id as text, modulo 4, is 2); language, source and id are never inputs. The driver
gets the drawn segments, whose number and size don't depend on the corpus or on the texts' length. Of languages that are in the
table, the ``MAX_LANGUAGES`` most frequent are learned (a bound on the sample; ties by name).

Null texts and texts without a letter are ``und`` with score 0, and so is everything if no language can be learned. Null ids
aren't held out. Repeated rows, and rows of one id with different texts, are labelled one by one. Of languages of equal
probability the first by name is taken. An empty table gives an empty result. Extra columns, whatever their names, are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import slices
from .common import id_hash, small_batches, under

HIDDEN, SEGMENT, LEAD, PAD = 8, 232, 24, 256
MAX_LABELLED, MAX_LANGUAGES, DRAWS = 1_000, 200, 8
STEPS, BATCH, TRAIN_SEGMENT = 260, 128, 48


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _gate(x: np.ndarray) -> np.ndarray:
    """A piecewise linear sigmoid."""
    x = x * np.float32(0.25)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


class Network:
    """Two GRUs of HIDDEN units, forward and backward. The input tables hold a row per byte, and one for padding."""

    def __init__(self, labels: list[str], seed: int = 7):
        g, h, n = np.random.default_rng(seed), HIDDEN, len(labels)
        self.labels = labels
        self._fast = None
        self.p = {
            "x": (g.normal(size=(2 * 257, 3 * h)) * 0.3).astype(np.float32),
            "u": (g.normal(size=(2, h, 3 * h)) / np.sqrt(h)).astype(np.float32),
            "o": (g.normal(size=(2, h, n)) * 0.3).astype(np.float32),
            "b": np.zeros(n, np.float32),
        }
        self.hold()

    def hold(self) -> None:
        """Padding keeps the state as it is: its update gate is 1."""
        for d in (0, 1):
            self.p["x"][d * 257 + PAD, :HIDDEN] = 1e4

    def states(self, at: np.ndarray, keep: bool = False):
        """at: (steps, 2, rows) of table rows. States (steps, 2, rows, HIDDEN), and what backpropagation needs."""
        x, u, h = self.p["x"], self.p["u"], HIDDEN
        state = np.zeros((2, at.shape[2], h), np.float32)
        out = np.empty((len(at), *state.shape), np.float32)
        kept = []
        for t in range(len(at)):
            a = x[at[t]]
            m = np.matmul(state, u)
            zr = _gate(a[:, :, : 2 * h] + m[:, :, : 2 * h])
            z, r, un = zr[:, :, :h], zr[:, :, h:], m[:, :, 2 * h :]
            new = np.tanh(a[:, :, 2 * h :] + r * un)
            if keep:
                kept.append((state, z, r, un, new))
            state = new + z * (state - new)
            out[t] = state
        return out, kept

    def run_fast(self, at: np.ndarray) -> np.ndarray:
        """The states alone: gates apart from each other, scaled beforehand, in reused arrays."""
        h, x, u = HIDDEN, self.p["x"], self.p["u"]
        quarter, half = np.float32(0.25), np.float32(0.5)
        if self._fast is None:
            self._fast = [np.ascontiguousarray(v) for v in (x[:, :h] * quarter + half, x[:, h : 2 * h] * quarter + half, x[:, 2 * h :], u[:, :, :h] * quarter, u[:, :, h : 2 * h] * quarter, u[:, :, 2 * h :])]
        xz, xr, xn, uz, ur, un = self._fast
        out = np.empty((len(at), 2, at.shape[2], h), np.float32)
        state = np.zeros(out.shape[1:], np.float32)
        z, r, m, n = (np.empty_like(state) for _ in range(4))
        for t in range(len(at)):
            rows = at[t]
            for gate, xs, us in ((z, xz, uz), (r, xr, ur)):
                np.matmul(state, us, out=gate)
                np.take(xs, rows, axis=0, out=m, mode="clip")
                gate += m
                np.maximum(gate, 0, out=gate)
                np.minimum(gate, 1, out=gate)
            np.matmul(state, un, out=m)
            r *= m
            np.take(xn, rows, axis=0, out=n, mode="clip")
            n += r
            np.tanh(n, out=n)
            state -= n
            state *= z
            state += n
            out[t] = state
        return out

    @staticmethod
    def table_rows(bytes_: np.ndarray) -> np.ndarray:
        """(rows, steps) of bytes -> (steps, 2, rows) of table rows, the second direction reversed."""
        forward = bytes_.T
        return np.stack([forward, forward[::-1] + 257], axis=1)

    def positions(self, bytes_: np.ndarray, keep: bool = False):
        """Probabilities (steps, rows, labels)."""
        at = self.table_rows(bytes_)
        s, kept = self.states(at, True) if keep else (self.run_fast(at), [])
        fw, bw = s[:, 0], s[::-1, 1]
        logit = fw @ self.p["o"][0] + bw @ self.p["o"][1] + self.p["b"]
        logit -= logit.max(axis=2, keepdims=True)
        np.exp(logit, out=logit)
        logit /= logit.sum(axis=2, keepdims=True)
        return logit, (at, s, kept)

    def gradients(self, bytes_: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        h = HIDDEN
        prob, (at, s, kept) = self.positions(bytes_, keep=True)
        mask = (bytes_.T != PAD).astype(np.float32)
        d = prob.copy()
        d[:, np.arange(len(y)), y] -= 1
        d *= (mask / mask.sum())[:, :, None]
        loss = -float((np.log(prob[:, np.arange(len(y)), y] + 1e-9) * mask).sum() / mask.sum())
        o = self.p["o"]
        g = {"b": d.sum(axis=(0, 1)), "o": np.stack([np.einsum("tbh,tbl->hl", s[:, 0], d), np.einsum("tbh,tbl->hl", s[::-1, 1], d)])}
        ds = np.stack([d @ o[0].T, (d @ o[1].T)[::-1]], axis=1)
        gu = np.zeros_like(self.p["u"])
        ga = np.empty((*at.shape, 3 * h), np.float32)
        back = np.zeros_like(ds[0])
        for t in range(len(at) - 1, -1, -1):
            before, z, r, un, new = kept[t]
            dh = ds[t] + back
            dn = dh * (1 - z) * (1 - new * new)
            dz = dh * (before - new) * np.where((z > 0) & (z < 1), np.float32(0.25), np.float32(0))
            dr = dn * un * np.where((r > 0) & (r < 1), np.float32(0.25), np.float32(0))
            dm = np.concatenate([dz, dr, dn * r], axis=2)
            ga[t] = np.concatenate([dz, dr, dn], axis=2)
            gu += np.matmul(before.transpose(0, 2, 1), dm)
            back = dh * z + np.matmul(dm, self.p["u"].transpose(0, 2, 1))
        g["u"], g["x"] = gu, np.zeros_like(self.p["x"])
        np.add.at(g["x"], at.ravel(), ga.reshape(-1, 3 * h))
        return g, loss

    def train(self, drawn: list[list[bytes]], y: np.ndarray, steps: int = STEPS, rate: float = 0.03, seed: int = 11) -> None:
        """drawn: each text's segments; y: the texts' labels."""
        g = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        classes = [np.flatnonzero(y == c) for c in range(len(self.labels))]
        for step in range(1, steps + 1):
            pick = np.array([g.choice(classes[i % len(classes)]) for i in range(BATCH)])  # every language alike
            rows = np.full((BATCH, TRAIN_SEGMENT), PAD, np.int64)
            for k, i in enumerate(pick):
                part = np.frombuffer(drawn[i][int(g.integers(len(drawn[i])))], np.uint8)
                rows[k, : len(part)] = part
            grads, _ = self.gradients(rows, y[pick])
            size = np.sqrt(sum(float((x * x).sum()) for x in grads.values()))
            lr = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, x in grads.items():
                x = x * np.float32(min(1.0, 1.0 / (size + 1e-9)))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
            self.hold()
        self._fast = None

    def predict(self, texts: list[str], rows_at_once: int = 1024) -> np.ndarray:
        """(texts, labels): each text's mean of its positions' probabilities; texts are not empty."""
        size = np.array([len(t.encode()) for t in texts])
        n = -(-size // SEGMENT)
        ends = np.cumsum(n)
        width = SEGMENT + 2 * LEAD
        rows = np.empty((int(n.sum()), width), np.int16)
        for t, a, k in zip(texts, ends - n, n, strict=True):
            data = np.full(k * SEGMENT + 2 * LEAD, PAD, np.int16)
            raw = np.frombuffer(t.encode(), np.uint8)
            data[LEAD : LEAD + len(raw)] = raw
            rows[a : a + k] = np.lib.stride_tricks.sliding_window_view(data, width)[::SEGMENT]
        sums = np.empty((len(rows), len(self.labels)), np.float64)
        for a in range(0, len(rows), rows_at_once):
            part = rows[a : a + rows_at_once]
            prob, _ = self.positions(part.astype(np.int64))
            core = prob[LEAD : LEAD + SEGMENT]
            core[part.T[LEAD : LEAD + SEGMENT] == PAD] = 0
            sums[a : a + rows_at_once] = core.sum(axis=0)
        return np.add.reduceat(sums, ends - n, axis=0) / size[:, None]


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """o, lang, t -> o, lang, drawn: segments at places all over the whole text, which follow from o alone."""
    for b in batches:
        drawn = []
        for o, t in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
            data, g = t.encode(), np.random.default_rng(o & (2**63 - 1))
            places = g.integers(0, max(1, len(data) - TRAIN_SEGMENT + 1), DRAWS)
            drawn.append([data[a : a + TRAIN_SEGMENT] for a in places.tolist()])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(drawn, pa.list_(pa.binary()))], ["o", "lang", "drawn"])


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MAX_LABELLED) -> tuple[list[list[bytes]], list[str]]:
    """Drawn segments and language of a bounded sample of each language's labelled texts that aren't held out."""
    t, order, lang = F.col(text_col), id_hash(id_col), F.col(lang_col)
    may = docs.filter(lang.isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    count = {r["lang"]: r["n"] for r in may.groupBy(lang.alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    factor, rows = 2, []
    while count:
        near = [(lang == k) & under(order, factor * most / n) for k, n in count.items()]
        some = may.filter(reduce(Column.__or__, near)).filter(t.rlike(r"\p{L}")).select(order.alias("o"), lang.alias("lang"), t.alias("t"))
        w = Window.partitionBy("lang").orderBy("o", "drawn")
        rows = some.mapInArrow(_draw, "o bigint, lang string, drawn array<binary>").withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most).orderBy("o", "lang", "n").collect()
        found = Counter(r["lang"] for r in rows)
        if all(found[k] == most or factor * most >= n for k, n in count.items()):
            break
        factor *= 8
    return [[bytes(x) for x in r["drawn"]] for r in rows], [r["lang"] for r in rows]


def fit(docs: DataFrame, **kw) -> Network | None:
    drawn, langs = training_sample(docs, **kw)
    labels = sorted(set(langs))
    if not labels:
        return None
    net = Network(labels)
    if len(labels) > 1:
        net.train(drawn, np.array([labels.index(x) for x in langs]))
    return net


def language_id(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    spark = docs.sparkSession
    small_batches(spark)
    net = net or fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    sent = spark.sparkContext.broadcast(net)  # some 50 kB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for b in batches:
            texts = b.column(2).to_pylist()
            lang, score = ["und"] * len(texts), [0.0] * len(texts)
            some = [i for i, t in enumerate(texts) if own and t and any(map(str.isalpha, t))]
            at = 0
            for part in slices([texts[i] for i in some]):
                prob = own.predict(part)
                for i, k, p in zip(some[at : at + len(part)], prob.argmax(axis=1), prob.max(axis=1), strict=True):
                    lang[i], score[i] = own.labels[k], min(1.0, float(p))
                at += len(part)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("t")).mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
