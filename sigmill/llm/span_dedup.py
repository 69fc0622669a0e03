"""Substring dedup by sliding spans of sentences.

A text is cut into sentences (after ``.``, ``!`` or ``?`` before white space, and at line ends; a
sentence of more than MAX_WORDS words counts as several). A span is a run of at least SENTENCES
sentences with at least WORDS words: for each sentence the shortest one that starts with it and the
shortest one that ends with it. All spans of the corpus are hashed and joined; where a span occurs
more than once, its first place (smallest id, then smallest position) stays, and sentences that any
other place covers are removed.

Passages need not begin or end with a sentence: of every run of PASSAGE words that occurs more than
once, wherever it lies, the first place stays as well, and the words of all others are removed
(within one text those only that do not overlap each other). Runs are looked up only where they can repeat. Each holds the smallest hash of its GRAM-word runs, and
equal runs hold equal ones: those smallest hashes that occur more than once are marked in a table of
bits (a false mark costs time, and loses nothing), and only runs whose smallest hash is marked are
joined. Neighbours with one smallest hash are joined as one block if that hash has the same block at
all its places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _BASE_INVERSE, _power, batch_rows, lower_ascii, materialize, mix64, released, schema_with, span_hashes, text_chunks, unused, words_by_space

SENTENCES, WORDS, MAX_WORDS = 3, 20, 20
#: Words of a passage that is removed wherever it begins, words of the runs that mark it, and how many of those it holds (a power of two).
PASSAGE, GRAM, GRAMS = 51, 20, 32
#: Bits of the table of marks.
MARKS = 1 << 26

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True


class Sentences:
    """The sentences of a run of texts: word bounds, first and end word of each, and the texts' ranges."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = lower_ascii(data)
        self.starts, self.ends, first = words_by_space(low, offsets)
        n = len(self.starts)
        self.low = low
        if not n:
            self.begin = self.end = np.zeros(0, np.int64)
            self.of_text = self.first = np.zeros(len(offsets), np.int64)
            return
        self.first = first
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        stop = _END[low[self.ends - 1]]
        stop[:-1] |= lines[self.starts[1:]] > lines[self.ends[:-1]]
        head = np.ones(n, bool)
        head[1:] = stop[:-1]
        head[first[:-1][first[:-1] < n]] = True
        at = np.arange(n)
        place = at - np.maximum.accumulate(np.where(head, at, 0))
        self.begin = np.flatnonzero(place % MAX_WORDS == 0)
        self.end = np.append(self.begin[1:], n)
        self.of_text = np.searchsorted(self.begin, first)

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, first sentence, end sentence) of every span."""
        n = len(self.begin)
        i = np.arange(n)
        text = np.searchsorted(self.of_text, i, side="right") - 1
        j = np.maximum(i + SENTENCES - 1, np.searchsorted(self.end, self.begin + WORDS))
        ok = j < self.of_text[text + 1]
        a = i[ok] * (n + 1) + j[ok]
        h = np.minimum(i - SENTENCES + 1, np.searchsorted(self.begin, self.end - WORDS, side="right") - 1)
        ok = h >= self.of_text[text]
        both = np.unique(np.concatenate([a, h[ok] * (n + 1) + i[ok]]))
        first, last = both // (n + 1), both % (n + 1)
        return text[first], first, last + 1

    def hashes(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the words of sentences first .. end-1."""
        return self.run_hashes(self.begin[first], self.end[end - 1])

    def run_hashes(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of the words a .. b-1."""
        words = span_hashes(self.low, self.starts, self.ends)
        size = (b - a).astype(np.uint64)
        out = []
        for salt in (np.uint64(1), np.uint64(0x5851F42D4C957F2D)):
            sums = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(mix64(words ^ salt) * _power(_BASE, len(words)), out=sums[1:])
            out.append(mix64((sums[b] - sums[a]) * _power(_BASE_INVERSE, len(words) + 1)[a] + size * (salt | np.uint64(1))))
        return out[0], out[1]

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of each run of GRAM words, smallest of those in the run of PASSAGE words from each word, or 0 if its text ends before, text of each such run)."""
        n = len(self.starts)
        if n < PASSAGE:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.arange(n - GRAM + 1)
        grams, _ = self.run_hashes(at, at + GRAM)
        at = at[: n - PASSAGE + 1]
        text = np.searchsorted(self.first, at, side="right") - 1
        return grams, np.where(at + PASSAGE <= self.first[text + 1], _slide(np.minimum, grams), np.uint64(0)), text


def _slide(f: np.ufunc, x: np.ndarray) -> np.ndarray:
    """``f`` over every run of GRAMS entries."""
    size = 1
    while size < GRAMS:
        x = f(x[:-size], x[size:])
        size *= 2
    return x


def _blocks(least: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last passage of every run of neighbours in one text that have one smallest hash."""
    head = np.ones(len(least), bool)
    head[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(least)) - 1
    ok = least[first] != 0
    return first[ok], last[ok]


def _smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest hash and hash of the whole block, one for each block; another row with 0 where the smallest hash recurs within one."""
    for batch in released(batches):
        for _, _, data, offsets in text_chunks(batch.column(2)):
            s = Sentences(data, offsets)
            grams, least, text = s.passages()
            if not len(least):
                continue
            first, last = _blocks(least, text)
            block, _ = s.run_hashes(first, last + PASSAGE)
            edge = np.zeros(GRAMS - 1, np.uint64)
            places = np.flatnonzero((grams == _slide(np.maximum, np.concatenate([edge, least, edge]))) & (grams != 0))
            close = np.unique(grams[places[1:]][(grams[places[1:]] == grams[places[:-1]]) & (np.diff(places) <= GRAMS)])
            h, block = np.concatenate([least[first], close]), np.concatenate([block, np.zeros(len(close), np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(block.view(np.int64))], names=["h", "block"])


def _marks(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two tables of marks, 64 bits an entry: smallest hashes that repeat, and those of them with different blocks."""
    many = found.mapInArrow(_smallest, "h long, block long").groupBy("h").agg(F.count("*").alias("n"), F.min("block").alias("a"), F.max("block").alias("b")).where("n > 1")
    bits = many.selectExpr(f"(h & {MARKS - 1}) >> 6 AS slot", "shiftleft(1L, int(h & 63)) AS bit", "a <> b AS mixed")
    bits = bits.groupBy("slot").agg(F.bit_or("bit").alias("many"), F.bit_or(F.when(F.col("mixed"), F.col("bit")).otherwise(F.lit(0))).alias("mixed")).toArrow()
    out = np.zeros((2, MARKS // 64), np.int64)
    for k, name in enumerate(("many", "mixed")):
        out[k, bits.column("slot").to_numpy()] = bits.column(name).to_numpy()
    return out[0], out[1]


def _again(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which passages have an earlier equal one in their text. Those that overlap their own next copy are a period, not a passage: spans of sentences thin it out."""
    order = np.lexsort((at, keys))
    same = np.zeros(len(keys), bool)
    same[1:] = keys[order][1:] == keys[order][:-1]
    group = np.cumsum(~same) - 1
    near = same & (np.diff(at[order], prepend=0) < PASSAGE)
    out = np.zeros(len(keys), bool)
    out[order] = same & (np.bincount(group, near) == 0)[group]
    return out


def _passages(found: DataFrame, kind: str) -> DataFrame:
    """The passages and blocks of passages that can repeat: id, th, first and end word, whether this text has the same before, and hashes."""
    tables = found.sparkSession.sparkContext.broadcast(_marks(found))

    def marked(marks: np.ndarray, h: np.ndarray) -> np.ndarray:
        low = (h & np.uint64(MARKS - 1)).astype(np.int64)
        return (marks[low >> 6] >> (low & 63)) & 1 == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many, mixed = tables.value
        for batch in released(batches):
            for i, _, data, offsets in text_chunks(batch.column(2)):
                s = Sentences(data, offsets)
                _, least, text = s.passages()
                first, last = _blocks(least, text)
                ok = marked(many, least[first])
                first, last = first[ok], last[ok]
                single = marked(mixed, least[first])
                size = np.where(single, last - first + 1, 1)
                at = np.repeat(first, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                end = np.where(np.repeat(single, size), at, np.repeat(last, size)) + PASSAGE
                if not len(at):
                    continue
                h1, h2 = s.run_hashes(at, end)
                text = text[at]
                again = _again(h1 ^ mix64(text.astype(np.uint64)), at)
                rows, base = pa.array(i + text), s.first[text]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array((at - base).astype(np.int32)), pa.array((end - base).astype(np.int32)), pa.array(again),
                        pa.array(h1.view(np.int64)), pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    ],
                    names=["id", "th", "s", "e", "again", "h1", "h2"],
                )

    return found.mapInArrow(run, f"id {kind}, th int, s int, e int, again boolean, h1 long, h2 int")


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(batches):
        for i, _, data, offsets in text_chunks(batch.column(2)):
            s = Sentences(data, offsets)
            text, first, end = s.spans()
            if not len(text):
                continue
            h1, h2 = s.hashes(first, end)
            base = s.of_text[text]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(i + text)), batch.column(1).take(pa.array(i + text)), pa.array((first - base).astype(np.int32)), pa.array((end - base).astype(np.int32)),
                    pa.array(h1.view(np.int64)), pa.array((h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                ],
                names=["id", "th", "s", "e", "h1", "h2"],
            )


def covered(n: int, spans: list[dict]) -> np.ndarray:
    """Which of a text's n sentences some non-first span covers; of spans that first occur in this text the first place stays."""
    change = np.zeros(n + 1, np.int64)
    seen = set()
    for x in sorted(spans, key=lambda x: x["s"]):
        key = x["h1"], x["h2"]
        if x["own"] and key not in seen:
            seen.add(key)
            continue
        change[x["s"]] += 1
        change[x["e"]] -= 1
    return np.cumsum(change)[:n] > 0


def covered_words(s: Sentences, k: int, spans: list[dict], passages: pa.StructArray) -> np.ndarray:
    """Which words of text k some non-first span covers, or some non-first passage."""
    a, b = s.of_text[k], s.of_text[k + 1]
    change = np.zeros(int(s.first[k + 1] - s.first[k]) + 1, np.int64)
    np.add.at(change, passages.field("s").to_numpy(), 1)
    np.add.at(change, passages.field("e").to_numpy(), -1)
    return (np.cumsum(change)[:-1] > 0) | np.repeat(covered(int(b - a), spans), s.end[a:b] - s.begin[a:b])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: tuple[str, str] = ("n_sentences", "n_removed")) -> DataFrame:
    """``docs`` with repeated sentences and passages removed from the text, and two columns appended: its sentences, and those removed whole (long).

    A null text stays null and has no sentences; texts with too few sentences or words have no
    spans and stay as they are, byte for byte. Rows with a null id are neither changed nor compared.
    Rows that repeat an id hold the same place in the order: a span that is first in one of them is
    first in all. A passage removed in part of a sentence leaves the sentence's other words; as no
    sentence is longer than MAX_WORDS, some sentence goes whole wherever a word goes. Very long texts
    are handled whole, one at a time. All other columns pass, whatever their names; columns that have
    the names of ``counts`` are replaced, so callers that keep such columns pass other names. An empty
    table gives an empty result. White space after a removed sentence or word goes with it.

    Spans are counted with partial sums; those that occur more than once are found again by a join
    whose large keys the adaptive skew join splits, and only they travel to their texts.
    """
    batch_rows(docs.sparkSession)
    docs = docs.drop(*counts)
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.hash(text_col).alias("th"), F.col(text_col).alias("text"))
    spans = found.mapInArrow(_spans, f"id {kind}, th int, s int, e int, h1 long, h2 int")
    many = spans.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1").drop("n")
    many = materialize(many, "repeats")
    repeated = spans.join(many, ["h1", "h2"]).select("id", "th", "s", "e", "h1", "h2", (F.col("id") == F.col("first")).alias("own"))
    passages = _passages(found, kind)
    ahead = passages.where("NOT again")
    shared = ahead.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1").drop("n")
    shared = materialize(shared, "passages")
    later = ahead.join(shared, ["h1", "h2"]).where("id <> first").select("id", "th", "s", "e").unionByName(passages.where("again").select("id", "th", "s", "e"))
    repeated = repeated.unionByName(later, allowMissingColumns=True)
    # a set, and by text as well: rows that repeat an id repeat its spans, or have others
    by_text = repeated.groupBy("id", "th").agg(
        F.collect_set(F.when(F.col("h1").isNotNull(), F.struct("s", "e", "h1", "h2", "own"))).alias("spans"),
        F.collect_list(F.when(F.col("h1").isNull(), F.struct("s", "e"))).alias("passages"),
    )
    # the names of the join's columns are away from those of the table
    own = dict(zip(by_text.columns, unused(docs, *by_text.columns), strict=True))
    by_text = by_text.withColumnsRenamed(own)
    same = (F.col(id_col) == F.col(own["id"])) & (F.hash(text_col) == F.col(own["th"]))
    joined = docs.join(by_text, same, "left").drop(own["id"], own["th"])
    at, n = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            texts: list[str | None] = []
            sizes, gone = [], []
            for i, j, data, offsets in text_chunks(batch.column(at)):
                s = Sentences(data, offsets)
                ranges = s.of_text.tolist()
                column = batch.column(at).slice(i, j - i)
                spans_of = batch.column(n).slice(i, j - i)
                words_of = batch.column(n + 1).slice(i, j - i)
                valid = spans_of.is_valid().to_pylist()
                for k in range(j - i):
                    a, b = ranges[k], ranges[k + 1]
                    sizes.append(b - a)
                    drop = covered_words(s, k, spans_of[k].as_py(), words_of[k].values) if valid[k] else None
                    if drop is None or not drop.any():
                        texts.append(column[k].as_py())
                        gone.append(0)
                        continue
                    gone.append(int(np.logical_and.reduceat(drop, s.begin[a:b] - s.first[k]).sum()))
                    lo, hi = int(offsets[k]), int(offsets[k + 1])
                    bounds = [*s.starts[s.first[k] : s.first[k + 1]].tolist(), hi]
                    turns = [0, *(np.flatnonzero(drop[1:] != drop[:-1]) + 1).tolist(), len(drop)]
                    parts = [data[lo : bounds[0]].tobytes()]
                    parts += [data[bounds[x] : bounds[y]].tobytes() for x, y in zip(turns[:-1], turns[1:], strict=True) if not drop[x]]
                    text = b"".join(parts)
                    texts.append((text.rstrip() if drop[-1] else text).decode())
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())], names=out.names)

    out = schema_with(docs, **dict.fromkeys(counts, "bigint"))
    return joined.mapInArrow(run, out)


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_removed and the text that stays, of every document."""
    return remove_repeats(docs.select("doc_id", "text")).select("doc_id", "n_sentences", "n_removed", "text")
