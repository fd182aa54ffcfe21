"""Toxicity by a classifier chain over byte-window features.

A feature is a window of five or six bytes of the normalised text (lower case,
ASCII other than letters made spaces), so a word's start and end count; it is
held exactly as an integer, the length above the bytes.  From a
bounded sample of labelled documents the windows most associated with toxic
ones are selected (chi-squared), and logistic models are fitted one category
after the other:

- ``explicit``: toxic, with a window that a good part of the toxic ones share;
- ``coded``: toxic without any such window;
- ``toxic``: any of them.

Every later model takes the probabilities of the earlier ones as features.  In
training these are out-of-fold predictions, so a later model sees earlier
probabilities as inexact as they will be on new documents.

The sample's bounds are parameters; everything else runs over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queuelake.llm.frames import from_struct, map_batches, row_struct, texts, written

WINDOWS = (5, 6)
CATEGORIES = ("explicit", "coded", "toxic")


class Settings(NamedTuple):
    toxic_rows: int = 2500  # bound of the sample of labelled rows, by class
    clean_rows: int = 5000
    features: int = 2000  # bound of the selected windows
    least_documents: int = 4  # toxic documents that a window must occur in
    common: float = 0.1  # share of the toxic rows that makes a window a common one
    folds: int = 5
    ridge: float = 0.5
    steps: int = 300
    beta: float = 0.5  # of the F-measure that the threshold is set for


class Model(NamedTuple):
    windows: np.ndarray  # sorted uint64
    weights: dict[str, np.ndarray]  # by category: windows, counts, earlier categories, bias
    threshold: float


_NORMAL = np.arange(256, dtype=np.uint8)
_NORMAL[:128] = [c if chr(c).isalpha() else 32 for c in range(128)]


def window_codes(text: str | None) -> np.ndarray:
    """The code of every window of the text, in order."""
    data = (" " + (text or "").lower() + " ").encode("utf-8", "surrogatepass")
    b = _NORMAL[np.frombuffer(data, dtype=np.uint8)].astype(np.uint64)
    n = len(b) - WINDOWS[0] + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    code = b[:n].copy()
    for i in range(1, WINDOWS[0]):
        code <<= np.uint64(8)
        code |= b[i : i + n]
    longer = (code[:-1] << np.uint64(8)) | b[WINDOWS[0] :]
    return np.concatenate([code | np.uint64(WINDOWS[0] << 56), longer | np.uint64(WINDOWS[1] << 56)])


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Finder:
    """Numbers of the selected windows that a text holds, and how often."""

    def __init__(self, windows: np.ndarray):
        self.windows = windows
        self.sieve = np.zeros(1 << 16, dtype=bool)
        self.sieve[(windows * _SPREAD) >> np.uint64(48)] = True

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        code = window_codes(text)
        if not len(code) or not len(self.windows):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        code = code[self.sieve[(code * _SPREAD) >> np.uint64(48)]]
        at = np.minimum(np.searchsorted(self.windows, code), len(self.windows) - 1)
        return np.unique(at[self.windows[at] == code], return_counts=True)


def _dense(found: np.ndarray, times: np.ndarray, size: int) -> tuple[float, float]:
    """Two summary features: distinct windows, and hits per 1000 characters."""
    return float(np.log1p(len(found))), float(np.log1p(1000.0 * times.sum() / max(size, 200)))


class Rows(NamedTuple):
    """Sparse rows of a sample: entry k says that row[k] has window col[k]."""

    row: np.ndarray
    col: np.ndarray
    dense: np.ndarray  # (rows, 2)
    windows: int

    def take(self, keep: np.ndarray) -> "Rows":
        number = np.full(len(keep), -1)
        number[keep] = np.arange(keep.sum())
        inside = keep[self.row]
        return Rows(number[self.row[inside]], self.col[inside], self.dense[keep], self.windows)

    def score(self, w: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        k = self.windows
        z = np.bincount(self.row, weights=w[self.col], minlength=len(self.dense)) if len(self.row) else np.zeros(len(self.dense))
        return z + self.dense @ w[k : k + 2] + earlier @ w[k + 2 : -1] + w[-1]

    def slope(self, g: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        by_window = np.bincount(self.col, weights=g[self.row], minlength=self.windows) if len(self.row) else np.zeros(self.windows)
        return np.concatenate([by_window, self.dense.T @ g, earlier.T @ g, [g.sum()]])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows: Rows, earlier: np.ndarray, y: np.ndarray, s: Settings) -> np.ndarray:
    """Logistic regression with a ridge, by accelerated gradient steps."""
    w = np.zeros(rows.windows + 2 + earlier.shape[1] + 1)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4) if len(y) else 1e-4
    w[-1] = np.log(share / (1 - share))
    if not len(y) or y.min() == y.max():
        return w
    per_row = np.bincount(rows.row, minlength=len(y)) + (rows.dense**2).sum(axis=1) + (earlier**2).sum(axis=1) + 1
    rate = 1.0 / (0.25 * float(np.percentile(per_row, 99)) * len(y) * 0.05 + s.ridge + len(y) * 0.25)
    v, last = w.copy(), w.copy()
    for step in range(s.steps):
        g = rows.slope(sigmoid(rows.score(v, earlier)) - y, earlier)
        g[:-1] += s.ridge * v[:-1]
        w = v - rate * g
        v = w + step / (step + 3.0) * (w - last)
        last = w
    return w


def fit_chain(rows: Rows, targets: dict[str, np.ndarray], fold: np.ndarray, s: Settings) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Weights of every category's model, and the last one's out-of-fold
    probabilities."""
    n = len(fold)
    earlier = np.zeros((n, 0))
    weights, out = {}, np.zeros(n)
    for c in CATEGORIES:
        y = targets[c].astype(float)
        out = np.zeros(n)
        for k in range(s.folds):
            held = fold == k
            if held.any():
                w = fit_linear(rows.take(~held), earlier[~held], y[~held], s)
                out[held] = sigmoid(rows.take(held).score(w, earlier[held]))
        weights[c] = fit_linear(rows, earlier, y, s)
        earlier = np.column_stack([earlier, out])
    return weights, out


def choose_threshold(probability: np.ndarray, y: np.ndarray, beta: float) -> float:
    """Where the F-measure (beta below 1: precision weighs more) is greatest,
    half way in log odds to the next probability below; 0.5 without any toxic
    row."""
    order = np.argsort(-probability, kind="stable")
    p, hits = np.clip(probability[order], 1e-6, 1 - 1e-6), np.cumsum(y[order])
    if not len(p) or not hits[-1]:
        return 0.5
    f = (1 + beta**2) * hits / (np.arange(1, len(p) + 1) + beta**2 * hits[-1])
    last = int(np.argmax(f))
    odds = np.log(p / (1 - p))
    below = odds[last + 1] if last + 1 < len(p) else odds[last] - 1
    return float(sigmoid((odds[last] + below) / 2))


def labelled_sample(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, toxic, text): at most ``toxic_rows`` and ``clean_rows`` of the
    labelled documents, those of the least hash.  A doc_id labelled twice is
    toxic if any label says so; of texts of one doc_id the least counts."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    present = marked.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id", F.lit("sample")))
    some = [present.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(n) for c, n in ((1, s.toxic_rows), (0, s.clean_rows))]
    chosen = written(some[0].union(some[1]).select("doc_id", "toxic"), "chosen")  # rows bounded by the settings
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return written(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).repartition(docs.sparkSession.sparkContext.defaultParallelism), "sample")


def select_windows(sample: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of the selected windows, and which of them are common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_class = []
            for c in (0, 1):
                codes = [np.unique(window_codes(t.as_py())) for t, y in zip(batch.column(2), batch.column(1).to_pylist()) if y == c]
                by_class.append(np.unique(np.concatenate(codes), return_counts=True) if codes else (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)))
            for c, (code, n) in enumerate(by_class):
                for a in range(0, len(code), 50_000):
                    m = n[a : a + 50_000]
                    none = np.zeros_like(m)
                    yield pa.RecordBatch.from_arrays([pa.array(code[a : a + 50_000].astype(np.int64)), pa.array(m if c else none), pa.array(none if c else m)], names=["code", "pos", "neg"])

    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    counts = map_batches(sample, run, "code long, pos long, neg long").groupBy("code").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    a, b = F.col("pos").cast("double"), F.col("neg").cast("double")
    cross = a * (neg - b) - b * (pos - a)
    chi = cross * cross / ((a + b) * (pos + neg - a - b) + 1.0)
    best = counts.where((F.col("pos") >= s.least_documents) & (cross > 0) & (a * max(neg, 1) > 4.0 * (b + 0.5) * max(pos, 1)))
    rows = best.select("code", "pos", "neg", chi.alias("chi")).orderBy(F.desc("chi"), "code").limit(s.features).collect()
    rows.sort(key=lambda r: r.code)
    common = [r.pos >= s.common * pos and r.neg * max(pos, 1) <= 0.02 * r.pos * max(neg, 1) for r in rows]
    return np.array([r.code for r in rows], dtype=np.uint64), np.array(common, dtype=bool)


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """The chain, fitted in one task on the sample's sparse rows, whose number
    the settings bound.  Without both classes every probability stays low."""
    sample = labelled_sample(docs, labels, s)
    windows, common = select_windows(sample, s)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(windows)
        for batch in batches:
            found, dense = [], []
            for t in batch.column(2).to_pylist():
                at, times = finder.counts(t)
                found.append(at)
                dense.append(list(_dense(at, times, len(t))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64())), pa.array(dense, pa.list_(pa.float64()))], names=["doc_id", "toxic", "found", "dense"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        y = pdf["toxic"].to_numpy()
        sizes = [len(x) for x in pdf["found"]]
        col = np.concatenate([*pdf["found"], np.zeros(0)]).astype(np.int64)
        rows = Rows(np.repeat(np.arange(len(pdf)), sizes), col, np.stack([np.asarray(x) for x in pdf["dense"]]), len(windows))
        shared = np.bincount(rows.row, weights=common[rows.col].astype(float), minlength=len(pdf)) > 0 if len(col) else np.zeros(len(pdf), dtype=bool)
        targets = {"explicit": (y == 1) & shared, "coded": (y == 1) & ~shared, "toxic": y == 1}
        weights, held_out = fit_chain(rows, targets, np.arange(len(pdf)) % s.folds, s)
        threshold = choose_threshold(held_out, y.astype(float), s.beta)
        return pd.DataFrame({"category": [*CATEGORIES, "threshold"], "weights": [*(weights[c].tolist() for c in CATEGORIES), [threshold]]})

    sparse = map_batches(sample, features, "doc_id long, toxic int, found array<long>, dense array<double>")
    fitted = {r.category: r.weights for r in sparse.groupBy(F.lit(0).alias("all")).applyInPandas(fit, "category string, weights array<double>").collect()}
    if not fitted:
        return Model(windows, {c: np.array([0.0] * (len(windows) + 2 + i) + [-10.0]) for i, c in enumerate(CATEGORIES)}, 0.5)
    return Model(windows, {c: np.array(fitted[c]) for c in CATEGORIES}, fitted["threshold"][0])


def probabilities(model: Model, finder: Finder, text: str | None) -> list[float]:
    """Of every category, in the order of the chain."""
    at, times = finder.counts(text)
    dense = _dense(at, times, len(text or ""))
    k, out = len(model.windows), []
    for c in CATEGORIES:
        w = model.weights[c]
        z = w[at].sum() + np.dot(w[k : k + 2], dense) + np.dot(w[k + 2 : -1], out) + w[-1]
        out.append(float(sigmoid(np.array(z))))
    return out


def with_toxicity(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` (with a column ``text``, or ``row`` of ``row_struct``) and a
    struct column ``name``: the categories' probabilities and ``is_toxic``."""
    kind = T.StructType([*(T.StructField(c, T.DoubleType()) for c in CATEGORIES), T.StructField("is_toxic", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model.windows)
        for batch in batches:
            p = np.array([probabilities(model, finder, t.as_py()) for t in texts(batch)]).reshape(-1, len(CATEGORIES))
            cols = [*(pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(CATEGORIES))), pa.array(p[:, -1] >= model.threshold)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.StructArray.from_arrays(cols, names=[*CATEGORIES, "is_toxic"])], names=[*batch.schema.names, name])

    return map_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, explicit, coded, score (the chain's last probability) and toxic
    of every document.

    A null text is empty and gets the models' base rates.  Labels without a
    document, null labels and null ids in labels are not used.  Repeated rows
    are scored one by one; other columns are not read; an empty table gives no
    rows, and without labels nothing is toxic.
    """
    scored = with_toxicity(docs.select("doc_id", "text"), train(docs, labels), "t")
    return scored.select("doc_id", F.col("t.explicit").alias("explicit"), F.col("t.coded").alias("coded"), F.col("t.toxic").alias("score"), F.col("t.is_toxic").alias("toxic"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not toxic."""
    scored = with_toxicity(docs.select(row_struct(docs)), train(docs.select("doc_id", "text"), labels), "t")
    return from_struct(scored.where("not t.is_toxic"), docs)
