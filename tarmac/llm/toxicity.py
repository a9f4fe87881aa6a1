"""Toxicity scores by a classifier with a counterfactual penalty.

Features are the words of a text and their beginnings (PREFIXES letters), present or absent, as
64-bit hashes. Learning takes a bounded sample of the labelled rows: logistic regression with an L1
penalty selects features, a second fit on those without it sets their weights. Both fits punish
the change of a text's score when its identity terms are swapped for others of their group, so
that naming a group alone moves no score.

The model is the sorted hashes of the selected features and their weights; scoring looks up every
word of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import PIECE_CHARS, crc_of_id, mix, small_batches, table
from tarmac.llm.common import _inside, _pieces, _points, _powers, _BASE, _INVERSE

#: Labelled rows that learning takes, by the order of a hash of their ids.
TRAIN_ROWS = 10_000
#: Besides the whole words, their first letters in these numbers are features.
PREFIXES = (3, 4, 5, 6, 7)
#: A feature must be in this many sampled texts.
LEAST_TEXTS = 5
#: A feature must lean to a class by this many standard deviations of chance.
LEAST_LEAN = 3.5
#: The features that lean most are kept for the fit.
MOST_FEATURES = 50_000
L1 = 1e-4
COUNTERFACTUAL = 1.0

#: Identity terms by group; a term is swapped for the next of its group.
IDENTITY_TERMS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "transgender"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["gay", "lesbian", "bisexual", "straight", "queer"],
    ["black", "white", "asian", "latino", "arab"],
    ["immigrants", "refugees", "natives", "foreigners"],
    ["deaf", "blind", "disabled", "autistic"],
    ["old", "young", "elderly"],
    ["frauen", "männer"], ["muslime", "christen", "juden"], ["schwule", "lesben"],
    ["femmes", "hommes"], ["musulmans", "chrétiens", "juifs"], ["noirs", "blancs"],
    ["mujeres", "hombres"], ["musulmanes", "cristianos", "judíos"], ["negros", "blancos"],
]


@dataclass
class Model:
    hashes: np.ndarray
    weights: np.ndarray
    bias: float


def _piece_features(points: np.ndarray) -> np.ndarray:
    """Distinct feature hashes of the words among code points."""
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = _inside(points)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    size = max(1 << 21, 1 << int(len(points) + 1).bit_length())
    parts = []
    with np.errstate(over="ignore"):
        total = np.zeros(len(points) + 1, np.uint64)
        np.multiply(points, _powers(_BASE, size)[: len(points)], out=total[1:], dtype=np.uint64)
        np.cumsum(total, out=total)
        back = _powers(_INVERSE, size)[starts]
        own = (total[ends] - total[starts]) * back
        words, first = np.unique(own, return_index=True)
        parts.append(mix(words))
        starts, ends, back = starts[first], ends[first], back[first]
        for n in PREFIXES:
            long = ends - starts >= n
            head = (total[starts[long] + n] - total[starts[long]]) * back[long]
            parts.append(mix(head + np.uint64(n) * np.uint64(0xD6E8FEB86659FD93)))
    return np.unique(np.concatenate(parts))


def features(text: str | None) -> np.ndarray:
    """Distinct features of a whole text, sorted; none for null or without a word."""
    text = (text or "").lower()
    if len(text) <= PIECE_CHARS:
        return _piece_features(_points(text))
    found = np.empty(0, np.uint64)
    for piece in _pieces(text):
        found = np.union1d(found, _piece_features(_points(piece)))
    return found


def _swaps() -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Each identity term's word hash, the features it loses and those it gains when swapped."""
    terms, gone, come = [], [], []
    for group in IDENTITY_TERMS:
        for term, other in zip(group, [*group[1:], group[0]]):
            a, b = features(term), features(other)
            terms.append(_word(term))
            gone.append(np.setdiff1d(a, b))
            come.append(np.setdiff1d(b, a))
    return np.array(terms, np.uint64), gone, come


def _word(word: str) -> np.uint64:
    points = _points(word.lower())
    with np.errstate(over="ignore"):
        total = points * _powers(_BASE, 1 << 21)[: len(points)]
        return mix(total.sum(dtype=np.uint64, keepdims=True))[0]


class _Design:
    """Sparse 0/1 rows in compressed form, for products in both directions."""

    def __init__(self, columns: np.ndarray, rows: np.ndarray, n_rows: int, n_columns: int,
                 values: np.ndarray | None = None):
        self.columns, self.rows, self.n_rows, self.n_columns = columns, rows, n_rows, n_columns
        self.values = values

    def score(self, w: np.ndarray) -> np.ndarray:
        one = w[self.columns] if self.values is None else w[self.columns] * self.values
        return np.bincount(self.rows, one, self.n_rows)

    def pull(self, r: np.ndarray) -> np.ndarray:
        one = r[self.rows] if self.values is None else r[self.rows] * self.values
        return np.bincount(self.columns, one, self.n_columns)


def _fit(x: _Design, y: np.ndarray, swaps: _Design, l1: float, l2: float, steps: int,
         w: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on mean log-loss, penalties and mean squared score change."""
    n, m = len(y), max(swaps.n_rows, 1)
    widest = np.bincount(x.rows, minlength=n).mean() + 1
    rate, best = 4.0 / widest, None
    v, vb, t = w.copy(), bias, 1.0

    def loss(w, b):
        s = x.score(w) + b
        change = swaps.score(w)
        return float(np.mean(np.logaddexp(0, s) - y * s) + l2 * (w @ w) / 2
                     + COUNTERFACTUAL * (change @ change) / (2 * m))

    for _ in range(steps):
        s = x.score(v) + vb
        change = swaps.score(v)
        p = 1 / (1 + np.exp(-s))
        here = float(np.mean(np.logaddexp(0, s) - y * s) + l2 * (v @ v) / 2
                     + COUNTERFACTUAL * (change @ change) / (2 * m))
        g = x.pull(p - y) / n + l2 * v + COUNTERFACTUAL * swaps.pull(change) / m
        gb = float(np.mean(p - y))
        while True:  # shrink the step until the quadratic bound holds
            new = v - rate * g
            new = np.sign(new) * np.maximum(np.abs(new) - rate * l1, 0)
            nb = vb - rate * gb
            d, db = new - v, nb - vb
            if loss(new, nb) <= here + g @ d + gb * db + (d @ d + db * db) / (2 * rate) + 1e-12:
                break
            rate /= 2
        step = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / step * (new - w), nb + (t - 1) / step * (nb - bias)
        moved = np.abs(new - w).max(initial=0)
        w, bias, t = new, nb, step
        if moved < 1e-4:
            break
        rate *= 1.1
    return w, bias


def train(labels: np.ndarray, found: list[np.ndarray]) -> Model:
    """The model of texts' features and their 0/1 labels; constant if a class is missing."""
    y = labels.astype(float)
    empty = np.empty(0, np.uint64)
    if not len(y) or y.min() == y.max():
        return Model(empty, np.empty(0), 4.0 if len(y) and y.min() == 1 else -4.0)
    rows = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])
    flat = np.concatenate(found)
    # Only features that lean to a class by more than chance does enter the fit. The hashes are
    # worked through by their first bits, which bounds the memory of sorting them.
    kept, leans = [empty], [np.empty(0)]
    for part in range(16):
        own = np.flatnonzero(flat >> np.uint64(60) == part)
        every, at, counts = np.unique(flat[own], return_inverse=True, return_counts=True)
        spread = np.sqrt(counts * y.mean() * (1 - y.mean()))
        lean = np.abs(np.bincount(at, (y - y.mean())[rows[own]], len(every))) / spread
        some = (counts >= LEAST_TEXTS) & (lean > LEAST_LEAN)
        kept.append(every[some])
        leans.append(lean[some])
    chosen, lean = np.concatenate(kept), np.concatenate(leans)
    chosen = chosen[np.argsort(-lean, kind="stable")[:MOST_FEATURES]]
    terms, gone, come = _swaps()
    vocabulary = np.unique(np.concatenate([chosen, *gone, *come]))
    columns, lines = [], []
    for part in np.array_split(np.arange(len(flat)), 16):
        at = np.searchsorted(vocabulary, flat[part])
        at[at == len(vocabulary)] = 0
        known = vocabulary[at] == flat[part]
        columns.append(at[known])
        lines.append(rows[part][known])
    at, rows = np.concatenate(columns), np.concatenate(lines)

    # A row for each text and identity term in it: what a swap takes and brings.
    columns, lines, values, n = [], [], [], 0
    for text in found:
        near = np.searchsorted(text, terms)
        for k in np.flatnonzero(np.append(text, np.uint64(0))[near] == terms):
            for part, sign in ((gone[k], -1.0), (come[k], 1.0)):
                columns.append(np.searchsorted(vocabulary, part))
                lines.append(np.full(len(part), n))
                values.append(np.full(len(part), sign))
            n += 1
    swaps = _Design(
        np.concatenate([np.empty(0, int), *columns]), np.concatenate([np.empty(0, int), *lines]),
        n, len(vocabulary), np.concatenate([np.empty(0), *values]),
    )
    x = _Design(at, rows, len(y), len(vocabulary))
    bias = float(np.log(y.mean() / (1 - y.mean())))
    w, bias = _fit(x, y, swaps, L1, 0.0, 300, np.zeros(len(vocabulary)), bias)

    some = np.flatnonzero(w)
    place = np.full(len(vocabulary), -1)
    place[some] = np.arange(len(some))

    def narrowed(d: _Design) -> _Design:
        at = place[d.columns]
        ok = at >= 0
        return _Design(at[ok], d.rows[ok], d.n_rows, len(some), None if d.values is None else d.values[ok])

    w, bias = _fit(narrowed(x), y, narrowed(swaps), 0.0, 1e-4, 300, w[some], bias)
    return Model(vocabulary[some], w, bias)


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from `docs` (doc_id, text) and `labels` (doc_id, toxic).

    At most `rows` labelled ids are taken, by the order of a hash of the id; the bound is what
    one task trains on. An id labelled both ways counts as toxic, null labels and ids not at all;
    ids without a document, or with a null text, teach nothing. No usable label gives a model
    that calls nothing toxic.
    """
    spark = small_batches(docs.sparkSession)
    sample = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = (
        docs.select("doc_id", "text").where("text is not null")
        .join(F.broadcast(sample), "doc_id")  # bounded by `rows`
        .select("toxic", "text")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(x.as_py()).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary())], names=["toxic", "features"]
            )

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        found = [np.frombuffer(f, np.uint64) for f in frame["features"]]
        order = sorted(range(len(found)), key=lambda i: (len(found[i]), frame["features"].iat[i]))
        model = train(frame["toxic"].to_numpy()[order] > 0, [found[i] for i in order])
        return pd.DataFrame({
            "hash": np.append(model.hashes.astype(np.int64), 0),
            "weight": np.append(model.weights, model.bias),
            "bias": np.append(np.zeros(len(model.weights), bool), True),
        })

    found = texts.mapInArrow(extract, "toxic int, features binary")
    rows_out = found.groupBy().applyInPandas(fit, "hash long, weight double, bias boolean").toPandas()
    bias = rows_out.loc[rows_out["bias"], "weight"]
    own = rows_out[~rows_out["bias"]]
    hashes = own["hash"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    del spark
    return Model(hashes[order], own["weight"].to_numpy()[order], float(bias.iloc[0]) if len(bias) else -4.0)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of `docs` as a struct `row`, with score (0 to 1) and predicted (1 from 0.5 on).

    Every word of the text counts, wherever it is. Null and empty texts get the model's constant.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))
    hashes, weights, bias = model.hashes, model.weights, model.bias

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rough = np.zeros(1 << 20, bool)  # which low bits any feature of the model has
        rough[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        for batch in batches:
            out = []
            for words in batch.column("row").field(text):
                own = features(words.as_py())
                own = own[rough[(own & np.uint64((1 << 20) - 1)).astype(np.int64)]]
                at = np.searchsorted(hashes, own)
                at[at == len(hashes)] = 0
                hit = at[hashes[at] == own] if len(hashes) else at[:0]
                out.append(1 / (1 + np.exp(-np.clip(bias + weights[hit].sum(), -50, 50))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(out, pa.float64()),
                 pa.array([int(s >= 0.5) for s in out], pa.int32())],
                names=["row", "score", "predicted"],
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, score double, predicted int"
    return rows.mapInArrow(judge, schema)


def fold(name: str = "doc_id"):
    """Which of five folds a document is in; fold 0 is held out. Null ids are in none."""
    return crc_of_id(name) % 5


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold() != 0)
    return score(docs, learn(docs, labels)).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(fold("row.doc_id") == 0, F.lit(False)).alias("held_out"),
        "score", "predicted",
    )
