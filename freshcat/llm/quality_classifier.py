"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut
its score: P(grade <= k) = sigmoid(threshold_k - score). The expected grade and the tail
probability P(grade >= k) select documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshcat.llm.common import id_text, ship_package, split_words

FEATURES = 1 << 18
#: Labelled documents the model is fitted on at most (those of least hash of their id).
SAMPLE = 10_000
#: Feature occurrences that the fit adds up at a time.
CHUNK = 1_000_000
GRADES = 3
ROUNDS, RATE, DECAY = 120, 0.05, 2e-4


def grade_of(quality: Column, toxic: Column) -> Column:
    """0 toxic, 1 poor, 2 good; null (not rated) where the labels do not say."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)


def features(text: Column, size: int = FEATURES) -> Column:
    """Distinct hashed features of a text: each word as written, and in lower case without
    what is neither letter nor digit; the share of distinct words, in tenths."""
    words = split_words(text)
    plain = F.split(F.lower(text), "[^\\p{L}\\p{M}\\p{N}]+")
    hashed = lambda kind, w: F.pmod(F.xxhash64(F.lit(kind), w), F.lit(size)).cast("int")
    share = F.floor(F.lit(10) * F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1)))
    return F.concat(
        F.array_distinct(F.transform(words, lambda w: hashed("written", w))),
        F.array_distinct(F.transform(plain, lambda w: hashed("plain", w))),
        F.array(hashed("distinct", share.cast("string"))),
    )


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k), a column for each k from 1."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit(rows: list[np.ndarray], grades: np.ndarray, size: int = FEATURES, levels: int = GRADES,
        rounds: int = ROUNDS, rate: float = RATE, decay: float = DECAY) -> OrdinalModel:
    """Maximum likelihood by Adam over the whole sample; thresholds stay ordered because
    their gaps are exponentials. Without a rated row all weights are 0 and the thresholds
    far below, so every document counts as the top grade. A feature of fewer than three rows
    has no weight. Equal input gives an equal model."""
    if not len(rows):
        return OrdinalModel(np.zeros(size), np.arange(levels - 1) - 50.0)
    # every feature of every row, as (row, column) in eight bytes; sums are taken a chunk at a time
    column = np.concatenate([np.asarray(r, np.int32) for r in rows])
    often = np.bincount(column, minlength=size) >= 3
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    row, column = row[often[column]], column[often[column]]
    known, place = np.flatnonzero(often), np.cumsum(often, dtype=np.int32) - 1
    column = place[column]
    chunks = [slice(a, a + CHUNK) for a in range(0, len(row), CHUNK)]
    share = np.cumsum(np.bincount(grades, minlength=levels) + 1.0)[:-1] / (len(grades) + levels)
    start = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 1e-3))
    params = np.concatenate([np.zeros(len(known)), start[:1], gaps])
    first, second, n = np.zeros_like(params), np.zeros_like(params), len(rows)

    def cut(p: np.ndarray) -> np.ndarray:
        return np.concatenate([[p[len(known)]], p[len(known)] + np.cumsum(np.exp(p[len(known) + 1:]))])

    for step in range(1, rounds + 1):
        theta = cut(params)
        score = np.zeros(n)
        for c in chunks:
            score += np.bincount(row[c], weights=params[column[c]], minlength=n)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        low, high = (1.0 / (1.0 + np.exp(-np.clip(edge[grades + k] - score, -50, 50))) for k in (0, 1))
        # d log(high - low): by the score -(1 - high - low), by each threshold its own density
        by_score = (1 - high - low) / n
        width = np.maximum(high - low, 1e-12)
        by_theta = np.zeros(levels - 1)
        for k in range(levels - 1):
            by_theta[k] = -np.sum((high * (1 - high) / width)[grades == k]) / n + np.sum((low * (1 - low) / width)[grades == k + 1]) / n
        grad = np.empty_like(params)
        grad[:len(known)] = decay * params[:len(known)]
        for c in chunks:
            grad[:len(known)] += np.bincount(column[c], weights=by_score[row[c]], minlength=len(known))
        grad[len(known)] = by_theta.sum()
        for k in range(levels - 2):
            grad[len(known) + 1 + k] = by_theta[k + 1:].sum() * np.exp(params[len(known) + 1 + k])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        params = params - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(size)
    weights[known] = params[:len(known)]
    return OrdinalModel(weights, cut(params))


def fit_on_labels(docs: DataFrame, labels: DataFrame, size: int = FEATURES, sample: int = SAMPLE,
                  id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """The model of a bounded sample: at most ``sample`` labels and, where their ids repeat in
    ``docs``, at most 2 x ``sample`` documents, by id; of each all features count. ``labels``
    has (doc_id, quality, toxic); rows without a grade, a known id or a text are left out,
    repeated ones within the bound count each.

    The sample is taken from the labels before the texts are read (top-k by hash of the id),
    so texts of other documents are neither moved nor hashed; the bound makes it broadcast.
    """
    rated = labels.select(F.col("doc_id").cast("long").alias("l_id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade")).where(F.col("grade").isNotNull() & F.col("l_id").isNotNull())
    chosen = rated.orderBy(F.xxhash64("l_id"), "l_id", "grade").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(F.col("text").isNotNull())
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id"))
    rows = joined.select("doc_id", "grade", features(F.col("text"), size).alias("f")).orderBy("doc_id", "grade").limit(2 * sample)

    def fitted(got: pd.DataFrame) -> pd.DataFrame:
        got = got.sort_values(["doc_id", "grade"], kind="stable")
        model = fit([np.asarray(f, dtype=np.int32) for f in got["f"]], got["grade"].to_numpy(np.int64), size)
        used = np.flatnonzero(model.weights)
        return pd.DataFrame({"feature": np.concatenate([used, -1 - np.arange(len(model.thresholds))]),
                             "value": np.concatenate([model.weights[used], model.thresholds])})

    # the sample's bound makes it one task's work; the driver only gets the model
    ship_package(docs.sparkSession)
    found = rows.groupBy(F.lit(0).alias("one")).applyInPandas(fitted, "feature int, value double").toPandas()
    if not len(found):
        return fit([], np.empty(0, np.int64), size)
    weights, at, value = np.zeros(size), found["feature"].to_numpy(), found["value"].to_numpy()
    weights[at[at >= 0]] = value[at >= 0]
    return OrdinalModel(weights, value[at < 0][np.argsort(-at[at < 0])])


def grade_documents(docs: DataFrame, model: OrdinalModel, tail_grade: int = 2, least_tail: float = 0.5,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, expected_grade, tail_probability, kept) of every row of ``docs``.

    ``expected_grade`` is the sum of P(grade >= k), ``tail_probability`` is
    P(grade >= ``tail_grade``), and ``kept`` whether it reaches ``least_tail``. A null or
    empty text is scored by its features too (no word). Rows are scored each for itself:
    repeated rows and ids, null ids and extra columns do not matter; no shuffle.
    """
    ship_package(docs.sparkSession)
    size = len(model.weights)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))  # bounded by ``size``

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = OrdinalModel(*sent.value)
        for b in batches:
            lengths = b["f"].map(len).to_numpy()
            at = np.concatenate([[0], np.cumsum(lengths)])
            sums = np.concatenate([[0.0], np.cumsum(m.weights[np.concatenate(b["f"].to_list())])]) if len(b) else np.zeros(1)
            score = np.round(sums[at[1:]] - sums[at[:-1]], 6)
            tails = m.tails(score)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": score, "expected_grade": np.round(tails.sum(axis=1), 6),
                                "tail_probability": np.round(tails[:, tail_grade - 1], 6), "kept": tails[:, tail_grade - 1] >= least_tail})

    rows = id_text(docs, id_col, text_col).select("doc_id", features(F.col("text"), size).alias("f"))
    return rows.mapInPandas(scored, "doc_id long, score double, expected_grade double, tail_probability double, kept boolean")
