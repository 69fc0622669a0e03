"""Hashed text features shared by the classifiers, and the bounded labelled sample they learn from."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, batch_rows, bounded_sample, mix64, released, window_hashes

_POINTS = 0x110000
#: Stands between texts whose features are taken together; no character.
SEP = 0x10FFFF


def _one(c: int, f: Callable[[str], str]) -> int:
    to = f(chr(c))
    return ord(to) if len(to) == 1 else c


# By code point, all of Unicode.
LOWER = np.fromiter((_one(c, str.lower) for c in range(_POINTS)), np.uint32, _POINTS)
IS_WORD = np.fromiter((chr(c).isalnum() for c in range(_POINTS)), bool, _POINTS)
IS_LETTER = np.fromiter((chr(c).isalpha() for c in range(_POINTS)), bool, _POINTS)
IS_SPACE = np.fromiter((chr(c).isspace() for c in range(_POINTS)), bool, _POINTS)


def code_points(texts: list[str | None], limit: int = CHUNK_BYTES, mark: str = "\n") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts as (first, end, code points, starts): a mark stands before each text and after the last; starts are those of the texts, with the end of the last."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= limit):
            size += len(texts[j] or "")
            j += 1
        run = [t or "" for t in texts[i:j]]
        points = np.frombuffer((mark + mark.join(run) + mark).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum([1, *(len(t) + 1 for t in run)])
        yield i, j, points, starts
        i = j


def subword_grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, hash) of the character 3- to 5-grams of the lower-case words, whose ends are marked, and of the whole words."""
    low = LOWER[points]
    word = IS_WORD[points]
    symbols = np.where(word, low, 1).astype(np.uint64)
    inside = np.cumsum(~word)
    for n in (3, 4, 5):
        if len(symbols) < n:
            continue
        # only the ends of a gram may be marks, and it holds two characters at least
        k = np.flatnonzero(inside[n - 2 : len(symbols) - 1] == inside[: len(symbols) - n + 1])
        yield k, window_hashes(symbols, n)[k] + np.uint64(n)
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    ends = np.flatnonzero(~word[1:] & word[:-1]) + 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(symbols) * (np.arange(len(symbols), dtype=np.uint64) * np.uint64(2) + np.uint64(1)))])
    raw = sums[ends] - sums[starts]  # depends on the place: take that out
    flat = np.concatenate([[np.uint64(0)], np.cumsum(mix64(symbols))])
    yield starts, mix64(raw - (flat[ends] - flat[starts]) * (starts.astype(np.uint64) * np.uint64(2)))


def style_grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, hash) of 1- to 3-grams of the kinds of characters (lower and upper case letters, white space; others stand for themselves), the
    words' lengths, and a mark where a word repeats the one before it."""
    sep = points == SEP
    space = IS_SPACE[points] | sep
    # letters count by their case alone, so that style is learned rather than vocabulary
    letter = IS_LETTER[points]
    upper = letter & (LOWER[points] != points)
    symbols = np.where(space, 1, np.where(upper, 2, np.where(letter, 3, points))).astype(np.uint64)
    for n in (1, 2, 3):
        if len(symbols) >= n:
            # a text's ends count (alone, the mark before it), but nothing beyond them: features do not depend on the texts around
            middle = np.arange(len(sep)) < len(sep) - 1 if n == 1 else ~(sep[:-1] & sep[1:]) if n == 2 else ~sep[1:-1]
            k = np.flatnonzero(middle)
            yield k, window_hashes(symbols, n)[k] + np.uint64(n)
    starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
    ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    flat = np.concatenate([[np.uint64(0)], np.cumsum(mix64(points.astype(np.uint64) + np.uint64(7)))])
    word = flat[ends] - flat[starts]
    text = np.cumsum(sep)[starts]
    same = np.flatnonzero((word[1:] == word[:-1]) & (text[1:] == text[:-1])) + 1
    yield starts[same], np.full(len(same), 11, np.uint64)
    yield starts, mix64((ends - starts).astype(np.uint64) // np.uint64(4))


def word_grams(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``style_grams``, and what the text says: each word in lower case, each two in a row, and the 4-grams of their letters."""
    yield from style_grams(points)
    word = IS_WORD[points]
    low = np.where(word, LOWER[points], 1).astype(np.uint64)
    starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
    ends = np.flatnonzero(~word[1:] & word[:-1]) + 1
    order = (np.arange(len(low), dtype=np.uint64) * np.uint64(2)) + np.uint64(1)
    sums, flat = (np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (mix64(low) * order, mix64(low)))
    words = mix64(sums[ends] - sums[starts] - (flat[ends] - flat[starts]) * (starts.astype(np.uint64) * np.uint64(2)) + np.uint64(17))
    yield starts, words
    text = np.cumsum(points == SEP)[starts]
    joined = text[1:] == text[:-1]
    yield starts[1:][joined], mix64(words[:-1] * np.uint64(3) + words[1:])[joined]
    if len(low) >= 4:
        inside = np.cumsum(~word)
        k = np.flatnonzero(inside[3:] == np.concatenate([[0], inside[:-4]]))
        yield k, window_hashes(low, 4)[k] + np.uint64(19)


Grams = Callable[[np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]


def distinct_words(text: str | None) -> str:
    """The distinct lower-case words of a text, in order: what is said over and over weighs no more than once."""
    return " ".join(dict.fromkeys(re.findall(r"\w+", (text or "").lower())))


def text_sums(texts: list[str | None], weights: np.ndarray, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its features' weights (a row for each bucket) and the number of its features."""
    wide = weights.reshape(len(weights), -1)
    mask = np.uint64(len(weights) - 1)
    total, count = np.zeros((len(texts), wide.shape[1])), np.zeros(len(texts))
    for i, j, points, starts in code_points(texts, mark=chr(SEP)):
        for at, hashes in grams(points):
            # a gram belongs to the text in which it starts; the mark before the first character counts with it
            ids = (mix64(hashes) & mask).astype(np.int64)
            cut = np.searchsorted(at, starts - 1)
            count[i:j] += np.diff(cut)
            for c in range(wide.shape[1]):
                sums = np.concatenate([[0.0], np.cumsum(wide[ids, c])])
                total[i:j, c] += np.diff(sums[cut])
    return total, count


def text_features(text: str | None, buckets: int, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of one text and their counts."""
    _, _, points, _ = next(code_points([text], mark=chr(SEP)))
    ids = [(mix64(h) & np.uint64(buckets - 1)).astype(np.int64) for _, h in grams(points)]
    return np.unique(np.concatenate(ids), return_counts=True) if ids else (np.zeros(0, np.int64),) * 2


@dataclass
class Sample:
    """Texts as rows of (bucket, count of the feature), what a count of one is worth in each, and the labels.

    Kept as narrow as they come: three bytes for a feature of up to 65,536 buckets. A count beyond 255 takes several entries of one bucket, whose shares add up.
    """

    starts: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    unit: np.ndarray
    labels: np.ndarray

    def __len__(self) -> int:
        return len(self.labels)

    def rows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, shares, row of each) of the given rows."""
        sizes = self.starts[which + 1] - self.starts[which]
        row = np.repeat(np.arange(len(which)), sizes)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[which], sizes)
        return self.ids[at].astype(np.int64), self.counts[at] * self.unit[which][row], row


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, use: Column, rows: int, buckets: int, grams: Grams, prior: float = 0.0, prepare: Callable | None = None) -> Sample:
    """At most ``rows`` labelled documents with ``use``, those with the smallest hashed ids, as hashed features.

    ``prior`` is added to a text's number of features when their shares are taken. Only the hashed features come to the driver: 3 bytes for each distinct feature of a text and for each further 255 of its count.
    """
    rated = (
        labels.select(labels["doc_id"].alias("doc_id"), labels[label].cast("double").alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & use)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    batch_rows(docs.sparkSession)
    chosen = bounded_sample(rated, rows, "doc_id")
    texts = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).join(F.broadcast(chosen), "doc_id")

    kind_of_id = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            ids, counts = [], []
            for text in batch.column(1).to_pylist():
                k, n = text_features(prepare(text) if prepare else text, buckets, grams)
                parts = -(-n // 255)
                each = np.full(int(parts.sum()), 255, np.uint8)
                each[np.cumsum(parts) - 1] = n - 255 * (parts - 1)
                ids.append(np.repeat(k, parts).astype(kind_of_id).tobytes())
                counts.append(each.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "label", "ids", "counts"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"doc_id {kind}, label double, ids binary, counts binary").toArrow()
    got = got.take(pa.compute.sort_indices(got, [("doc_id", "ascending"), ("label", "ascending")])).combine_chunks() if len(got) else got
    labels_of = np.array(got.column("label").to_pylist(), float)
    ids, _ = _joined(got.column("ids"), kind_of_id)
    counts, starts = _joined(got.column("counts"), np.uint8)
    totals, some = np.zeros(len(labels_of), np.int64), np.flatnonzero(np.diff(starts))
    if len(some):
        totals[some] = np.add.reduceat(counts, starts[some], dtype=np.int64)  # no running sum over all features
    pa.default_memory_pool().release_unused()
    return Sample(starts, ids, counts, 1 / np.maximum(totals + prior, 1), labels_of)


def _joined(column: pa.ChunkedArray, kind: object) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows as numbers, where they lie, and the bounds of the rows in bytes."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    chunk = column.chunk(0).cast(pa.large_binary())
    bounds = np.frombuffer(chunk.buffers()[1], np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
    data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data.view(kind), bounds - bounds[0]


def adam(params: list[np.ndarray], rate: float) -> Callable[[list[np.ndarray]], None]:
    """An in-place Adam step for ``params``."""
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0

    def step(grads: list[np.ndarray]) -> None:
        nonlocal t
        t += 1
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    return step


def add_up(ids: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows of ``values`` by id."""
    return np.stack([np.bincount(ids, values[:, c], size) for c in range(values.shape[1])], 1)


def add_up_shares(ids: np.ndarray, values: np.ndarray, at: np.ndarray, shares: np.ndarray, size: int) -> np.ndarray:
    """``add_up`` of the rows ``at`` of ``values`` times ``shares``, a column at a time: these rows are never held at once."""
    return np.stack([np.bincount(ids, values[at, c] * shares, size) for c in range(values.shape[1])], 1)
