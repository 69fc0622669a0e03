"""Quality: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - x.w): one vector of weights over hashed text features is
shared by all grades, and ordered thresholds cut its scale. Expected grade and the probability of
the upper tail follow from it. Features are words, pairs of words and letter 4-grams, and the kinds
of characters that stand together (``word_grams``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, schema_with
from .hashed_text import Sample, adam, add_up, labelled_sample, text_sums, word_grams

BUCKETS = 1 << 16
TRAIN_ROWS, EPOCHS, BATCH, RATE = 6000, 20, 256, 0.05
SCALE = 10.0
#: A document is kept if the probability of the best grade is at least this.
KEEP = 0.5


@dataclass
class Model:
    grades: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than grades

    def distribution(self, x: np.ndarray) -> np.ndarray:
        """The grades' probabilities, a row for each score."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - x[:, None], -60, 60)))
        return np.diff(np.concatenate([np.zeros((len(x), 1)), below, np.ones((len(x), 1))], 1), axis=1)


def train(sample: Sample, buckets: int = BUCKETS, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """Maximum likelihood by Adam; thresholds stay ordered as a first one and positive steps. One grade alone: that grade is certain."""
    grades = np.unique(sample.labels) if len(sample) else np.zeros(1)
    k = len(grades)
    y = np.searchsorted(grades, sample.labels)
    w = np.zeros((buckets, 1))
    if k < 2:
        return Model(grades, w[:, 0], np.zeros(0))
    below = np.clip(np.array([(y <= i).mean() for i in range(k - 1)]), 1e-3, 1 - 1e-3)
    start = np.log(below / (1 - below))
    first, steps = start[:1].copy(), np.log(np.maximum(np.diff(start), 0.05))
    rng, step = np.random.default_rng(seed), adam([w, first, steps], RATE)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            which = order[at : at + BATCH]
            ids, shares, row = sample.rows(which)
            x = SCALE * add_up(row, w[ids] * shares[:, None], len(which))[:, 0]
            cuts = np.concatenate([first, first + np.cumsum(np.exp(steps))])
            z = np.concatenate([[-np.inf], cuts, [np.inf]])
            lo, hi = z[y[which]] - x, z[y[which] + 1] - x
            f_lo, f_hi = 1 / (1 + np.exp(-np.clip(lo, -40, 40))) * (lo > -np.inf), np.where(hi == np.inf, 1.0, 1 / (1 + np.exp(-np.clip(hi, -40, 40))))
            p = np.maximum(f_hi - f_lo, 1e-9)
            d_lo, d_hi = f_lo * (1 - f_lo) / p, f_hi * (1 - f_hi) / p
            dx = (d_hi - d_lo) / len(which)
            dz = np.bincount(y[which], d_lo, k + 1) - np.bincount(y[which] + 1, d_hi, k + 1)
            dz = dz[1:k] / len(which)
            d_steps = np.array([dz[i + 1 :].sum() for i in range(k - 2)]) * np.exp(steps)
            step([add_up(ids, SCALE * dx[row, None] * shares[:, None], buckets) + 1e-6 * w, dz.sum(keepdims=True), d_steps])
    return Model(grades, w[:, 0], np.concatenate([first, first + np.cumsum(np.exp(steps))]))


def predict(texts: list[str | None], model: Model) -> np.ndarray:
    total, count = text_sums(texts, SCALE * model.weights, word_grams)
    return model.distribution(total[:, 0] / np.maximum(count, 1))


def fit(docs: DataFrame, labels: DataFrame, grade: str = "quality", rows: int = TRAIN_ROWS) -> Model:
    return train(labelled_sample(docs, labels, grade, ~held_out(), rows, BUCKETS, word_grams))


def grade(docs: DataFrame, model: Model, text_col: str = "text", tail_from: float | None = None, keep: float = KEEP) -> DataFrame:
    """``docs`` with expected_grade, tail_prob (of grades of at least ``tail_from``, by default the best) and keep appended.

    Null and empty texts have only the mark before them as a feature and are graded by it. Very
    long texts are graded whole. Every row stays, repeated ones too, and equal texts have equal
    grades; other columns pass, those of the three names are replaced; an empty table gives an empty
    result.
    """
    docs = docs.drop("expected_grade", "tail_prob", "keep")
    at = docs.columns.index(text_col)
    best = model.grades[-1] if tail_from is None else tail_from
    schema = schema_with(docs, expected_grade="double", tail_prob="double", keep="boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = predict(batch.column(at).to_pylist(), model)
            tail = p[:, model.grades >= best].sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p @ model.grades), pa.array(tail), pa.array(tail >= keep)], names=schema.names)

    return docs.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_prob and keep of every document."""
    out = grade(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "expected_grade", "tail_prob", "keep")
