"""Toxicity: character n-gram vectors averaged over a text's distinct words, then a linear softmax, learned jointly.

Vectors are shared by all words with the same n-grams, so a misspelt word that never occurred in
training still has most of the vectors of the word it varies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, held_out, released, schema_with
from .hashed_text import Sample, adam, add_up_shares, distinct_words, labelled_sample, subword_grams, text_sums

BUCKETS, WIDTH = 1 << 16, 8
#: Labelled texts to learn from, and steps of so many of them each.
TRAIN_ROWS, STEPS, BATCH, RATE = 6000, 300, 128, 0.05
#: Factor of the averages: a text's average moves little for a word in a hundred.
SCALE = 200.0
#: Each text's average has so many zero vectors besides, or a few odd words would decide a short one.
PRIOR = 300
#: Score from which a text is toxic.
THRESHOLD = 0.3


@dataclass
class Model:
    vectors: np.ndarray  # buckets x width
    softmax: np.ndarray  # width x 2
    bias: np.ndarray  # 2

    def weights(self) -> np.ndarray:
        """What one feature adds to the margin of the toxic class: the softmax is linear in the averaged vectors."""
        return SCALE * self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(sample: Sample, buckets: int = BUCKETS, width: int = WIDTH, steps: int = STEPS, seed: int = 7) -> Model:
    """Cross-entropy of the softmax by Adam on small batches; without both classes the model is the share of the class."""
    rng = np.random.default_rng(seed)
    y = (sample.labels > 0).astype(np.int64)
    share = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.01
    model = Model(np.zeros((buckets, width)), rng.normal(0, 0.3, (width, 2)), np.array([0.0, np.log(share / (1 - share))]))
    if not 0 < y.sum() < len(y):
        return model
    model.vectors[:] = rng.normal(0, 0.01, (buckets, width))
    step = adam([model.vectors, model.softmax, model.bias], RATE)
    for _ in range(-(-steps * BATCH // max(len(y), BATCH))):  # a batch at least: few rows do not make more steps
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            which = order[at : at + BATCH]
            ids, shares, row = sample.rows(which)
            mean = SCALE * add_up_shares(row, model.vectors, ids, shares, len(which))
            logit = mean @ model.softmax + model.bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(which)), y[which]] -= 1
            p /= len(which)
            back = SCALE * (p @ model.softmax.T)
            step([add_up_shares(ids, back, row, shares, buckets) + 1e-6 * model.vectors, mean.T @ p + 1e-4 * model.softmax, p.sum(0)])
    return model


def score_texts(texts: list[str | None], weights: np.ndarray, offset: float) -> np.ndarray:
    total, count = text_sums([distinct_words(t) for t in texts], weights, subword_grams)
    return 1 / (1 + np.exp(-np.clip(total[:, 0] / (count + PRIOR) + offset, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from a bounded sample of the labelled documents that are not held out."""
    return train(labelled_sample(docs, labels, "toxic", ~held_out(), rows, BUCKETS, subword_grams, PRIOR, distinct_words))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with two columns appended: the score (double, 0 to 1) and whether it reaches the threshold (int).

    A null or empty text has no features and gets the score of the bias. Very long texts are scored
    whole. Every row stays, repeated ones too, and equal texts have equal scores; all other columns
    pass, whatever their names; columns that have the two names are replaced, so callers that keep
    such columns pass other names. An empty table gives an empty result.
    """
    batch_rows(docs.sparkSession)
    weights, offset = model.weights().astype(np.float32), model.offset()
    docs = docs.drop(*names)
    at = docs.columns.index(text_col)
    schema = schema_with(docs, **dict(zip(names, ("double", "int"), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            s = score_texts(batch.column(at).to_pylist(), weights, offset)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels)
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
