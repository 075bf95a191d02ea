"""Toxicity by a classifier chain of linear models.

The categories are predicted one after another.  Each model is a logistic regression on the words
of a text and their beginnings, weighted by log-count ratio, and on the log-odds of all earlier categories.
While training, those come from out-of-fold predictions, so a later model learns how far
earlier predictions can be trusted on unseen text; when scoring, they come from the final models.

The fit uses at most ``most_rows`` labelled documents, chosen by a hash of their id; everything
else (all documents, whole texts) is scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.texts import record_batch, rows, written

MOST_ROWS = 8000
LEAST_DOCS = 4  # documents of the sample a word must be in
FOLDS = 5
BEGINNINGS = (4, 6, 8)  # characters
THRESHOLDS = (0.3, 0.7)  # a cut found on few rows may not lie outside
PENALTY = 1.0
STEPS = 60

_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> set[str]:
    """The words of a text in lower case, and the beginnings of the longer ones.

    Beginnings stand for the inflected and compounded forms that a sample cannot list.
    """
    found = set(_TOKEN.findall(text.lower())) if text else set()
    begun = {f"{word[:size]}*" for word in found for size in BEGINNINGS if len(word) > size}
    return found | begun


@dataclass
class Linear:
    """Word weights (by place in the vocabulary), weights of earlier log-odds, and the constant."""

    words: np.ndarray
    earlier: np.ndarray
    constant: float
    threshold: float = 0.5


def _margin(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``values`` over the rows that begin at ``starts``; an empty row sums to 0."""
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]] if n else np.zeros(0)


class _Rows:
    """Sparse binary rows: the vocabulary places of each document."""

    def __init__(self, places: Sequence[np.ndarray], width: int):
        self.n, self.width = len(places), width
        self.lengths = np.array([len(p) for p in places], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))
        self.places = np.concatenate([np.asarray(p, dtype=np.int64) for p in places]) if self.n else np.zeros(0, np.int64)

    def take(self, chosen: np.ndarray) -> _Rows:
        return _Rows([self.places[self.starts[i] : self.starts[i + 1]] for i in np.flatnonzero(chosen)], self.width)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return _margin(weights[self.places], self.starts, self.n)

    def sums(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.places, weights=np.repeat(per_row, self.lengths), minlength=self.width)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def log_odds(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit_linear(data: _Rows, earlier: np.ndarray, y: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> Linear:
    """Penalised logistic regression by accelerated gradient steps on ratio-scaled words."""
    yes, no = data.sums(y) + 1.0, data.sums(1 - y) + 1.0
    ratio = np.log((yes / (y.sum() + 2)) / (no / ((1 - y).sum() + 2)))

    def forward(v: np.ndarray) -> np.ndarray:
        return data.dot(ratio * v[: data.width]) + earlier @ v[data.width : -1] + v[-1]

    def back(r: np.ndarray) -> np.ndarray:
        return np.concatenate((ratio * data.sums(r), earlier.T @ r, [r.sum()]))

    w = np.zeros(data.width + earlier.shape[1] + 1)
    v, largest = np.ones(len(w)), 1.0
    for _ in range(12):  # power iteration for the curvature
        v = back(forward(v))
        largest = float(np.linalg.norm(v)) or 1.0
        v /= largest
    bound = 0.25 * 1.2 * largest + penalty
    w[-1] = log_odds(np.array([(y.sum() + 1) / (data.n + 2)]))[0]
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        slope = back(_sigmoid(forward(ahead)) - y)
        slope[:-1] += penalty * ahead[:-1]
        following, s = ahead - slope / bound, (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = following + (t - 1) / s * (following - w), following, s
    return Linear(ratio * w[: data.width], w[data.width : -1], float(w[-1]))


def predict(model: Linear, data: _Rows, earlier: np.ndarray) -> np.ndarray:
    return _sigmoid(data.dot(model.words) + earlier @ model.earlier + model.constant)


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the best F1 on out-of-fold predictions, midway to the next lower prediction."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order])
    f1 = 2 * right / (np.arange(1, len(y) + 1) + max(y.sum(), 1))
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal predictions fall on one side
    if not len(y) or not y.sum():
        return 0.5
    at = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return min(max(float((p[order][at] + below) / 2), THRESHOLDS[0]), THRESHOLDS[1])


def fit_chain(places: Sequence[np.ndarray], width: int, labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model a column of ``labels``, in order; ``folds`` numbers the fold of each row."""
    data, earlier, chain = _Rows(places, width), np.zeros((len(places), 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        out = np.full(data.n, (y.sum() + 1) / (data.n + 2))
        for fold in np.unique(folds):
            train, held = folds != fold, folds == fold
            if train.any():
                model = fit_linear(data.take(train), earlier[train], y[train])
                out[held] = predict(model, data.take(held), earlier[held])
        final = fit_linear(data, earlier, y)
        final.threshold = _best_threshold(out, y)
        chain.append(final)
        earlier = np.column_stack((earlier, log_odds(out)))
    return chain


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Mapping[str, Column],
    most_rows: int = MOST_ROWS,
    least_docs: int = LEAST_DOCS,
) -> tuple[dict[str, int], list[Linear]]:
    """(vocabulary, chain) from at most ``most_rows`` labelled documents.

    ``categories`` maps names, in chain order, to conditions on ``labels``.  Labels of a repeated
    doc_id are or-ed; null labels count as false; null ids are left out.
    """
    named = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    said = named.agg(*[F.coalesce(F.max(condition.cast("int")), F.lit(0)).alias(f"y{i}") for i, condition in enumerate(categories.values())])
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    sample = said.orderBy(F.xxhash64(F.lit("chain"), "doc_id"), "doc_id").limit(most_rows)
    # bounded by most_rows
    texts = known.join(F.broadcast(sample), "doc_id").groupBy("doc_id", *[f"y{i}" for i in range(len(categories))])
    texts = texts.agg(F.min("text").alias("text"))  # one and the same text of a repeated id

    @F.udf("array<string>")
    def token_list(text):
        return sorted(tokens(text))

    parsed = texts.select("doc_id", *[f"y{i}" for i in range(len(categories))], token_list("text").alias("tokens"))
    parsed = written(parsed, "toxicity-sample")
    counted = parsed.select(F.explode("tokens").alias("token")).groupBy("token").count().filter(F.col("count") >= least_docs)
    vocabulary = {r[0]: i for i, r in enumerate(counted.select("token").orderBy("token").toLocalIterator())}

    places, ys, folds = [], [], []
    for row in parsed.orderBy("doc_id").toLocalIterator():
        places.append(np.array([vocabulary[t] for t in row["tokens"] if t in vocabulary], dtype=np.int64))
        ys.append([row[f"y{i}"] for i in range(len(categories))])
        folds.append(row["doc_id"] % FOLDS)
    matrix = np.array(ys, dtype=float).reshape(len(ys), len(categories))
    return vocabulary, fit_chain(places, len(vocabulary), matrix, np.array(folds))


def score(docs: DataFrame, vocabulary: dict[str, int], chain: Sequence[Linear], names: Sequence[str]) -> DataFrame:
    """(doc_id, p_<name>, <name>) of every row: probabilities, and whether they reach the cuts.

    A null or empty text gets what the constants say.  Repeated rows stay; other columns are ignored.
    """
    fields = [("doc_id", pa.int64())]
    for name in names:
        fields += [(f"p_{name}", pa.float64()), (name, pa.bool_())]
    schema = pa.schema(fields)
    model = docs.sparkSession.sparkContext.broadcast((vocabulary, [(m.words, m.earlier, m.constant, m.threshold) for m in chain]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, models = model.value
        for batch in batches:
            found = []
            for doc, text in rows(batch, "doc_id", "text"):
                at = [places[t] for t in places.keys() & tokens(text)]
                at.sort()  # the same order of adding whatever the order of the set
                result, odds = [doc], []
                for weights, earlier, constant, threshold in models:
                    z = constant + float(weights[at].sum()) + sum(a * b for a, b in zip(earlier, odds))
                    p = round(1.0 / (1.0 + math.exp(-min(35.0, max(-35.0, z)))), 6)
                    odds.append(float(log_odds(np.float64(p))))
                    result += [p, p >= threshold]
                found.append(tuple(result))
            yield record_batch(schema, found)

    ddl = "doc_id long" + "".join(f", p_{name} double, {name} boolean" for name in names)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scored, ddl)


def toxicity(docs: DataFrame, labels: DataFrame, categories: Mapping[str, Column] | None = None, most_rows: int = MOST_ROWS) -> DataFrame:
    """Every document with the probability and verdict of each category, in chain order.

    By default the chain is ``low_quality`` (quality = 0), then ``toxic`` (toxic = 1).  Without
    any labelled document all probabilities are one half and every verdict follows from that.
    """
    if categories is None:
        categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    vocabulary, chain = train(docs, labels, categories, most_rows)
    return score(docs, vocabulary, chain, list(categories))
