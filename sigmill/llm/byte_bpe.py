"""Byte-level BPE encoding and decoding; the merges are a fold in Spark's higher-order functions.

Texts are split by the tokenizer's pattern in array operations. Words that a memo does not hold are
listed once for each document, as strings with one character for each byte, beside the ranks of the
merges that can occur in them (tokens whose bytes stand somewhere in the word). The fold takes these
ranked merges in order and replaces the pair of each by its token, both from a literal rank map. What
is left are the word's tokens.

Merges in order of rank are what repeated merging of the lowest pair does, if each token is made from
two of lower ranks; which two these are, is the same wherever the token is made (no merge crosses the
bounds of a token that is yet to be made). ``Vocabulary`` finds them. Tokens that no merge makes are
found as whole words only.

The memo holds the vocabulary's own words and frequent words of a bounded sample of the documents,
folded by the same fold, so it changes nothing but time. Decoding concatenates the binary piece of
each id.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _BASE, _BASE_INVERSE, _power, batch_rows, materialize, mix64, released, schema_with, span_hashes, text_chunks

#: Documents whose words fill the memo (about), its most words, and the longest of them in bytes.
MEMO_DOCS, MEMO_WORDS, MEMO_BYTES = 20_000, 200_000, 64

#: Bytes of text, or of codes, that a task's array operations handle at once: four Python processes share an executor.
RUN_BYTES = 1 << 18

# What the vocabulary's splitting pattern calls a contraction, after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_OTHER, _LETTER, _NUMBER, _SPACE, _EDGE = range(5)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 bytes and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


# --------------------------------------------------------------------------------------------
# The vocabulary


def halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens whose merge makes ``token``: what merging its bytes by lower ranks leaves; None if that is not two."""
    parts, below = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        low, at = below, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1], below)
            if rank < low:
                low, at = rank, i
        if at < 0:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 and max(ranks[parts[0]], ranks[parts[1]]) < below else None


def char_of(i: int) -> str:
    """The character that stands for an id in the fold; surrogates are left out."""
    return chr(i + 1 if i < 0xD7FF else i + 0x801)


def ids_of(points: np.ndarray) -> np.ndarray:
    return np.where(points < 0xD800, points - 1, points - 0x801)


@dataclass
class Vocabulary:
    ranks: dict[bytes, int]

    def __post_init__(self) -> None:
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"no rank for the bytes {missing}")
        if max(self.ranks.values()) > 1_000_000:
            raise ValueError("ranks must not be above a million")
        self.size = max(self.ranks.values()) + 1
        self.made_of = {r: h for t, r in self.ranks.items() if len(t) > 1 and (h := halves(t, self.ranks))}

    def merges(self) -> tuple[list[str], list[str]]:
        """By rank: the pair that is merged, and what it becomes."""
        pairs = [""] * self.size
        for rank, (a, b) in self.made_of.items():
            pairs[rank] = char_of(self.ranks[a]) + char_of(self.ranks[b])
        return pairs, [char_of(i) for i in range(self.size)]

    def pieces(self) -> list[bytes]:
        out = [b""] * self.size
        for token, rank in self.ranks.items():
            out[rank] = token
        return out

    def pieces_hex(self) -> list[str]:
        return [p.hex() for p in self.pieces()]

    def byte_points(self) -> np.ndarray:
        """Code point of the character of each byte's id."""
        return np.array([ord(char_of(self.ranks[bytes([b])])) for b in range(256)], np.uint32)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


# --------------------------------------------------------------------------------------------
# Splitting


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code point, as the pattern's classes have it."""
    import regex

    out = np.full(0x110000, _OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, name in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(name, every):
            out[ord(m[0][0]) : ord(m[0][-1]) + 1] = kind
    return out


def word_starts(points: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin, for texts that stand one after another and begin at ``texts``.

    Runs of letters, of numbers and of other characters are words, with the space before them; all
    but the last of several blanks before a word are one more, and a last one that is not a space
    another; an apostrophe alone takes the ending that follows.
    """
    n = len(points)
    kind = _kinds()[points]
    first = np.zeros(n + 1, bool)
    first[texts[texts < n]] = True
    start = first[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    ends_text = first[1:]
    ends_text[-1:] = True
    # the last blank of a run that a word follows
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~ends_text[:-1])
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    # an apostrophe alone before a letter
    mark = np.flatnonzero((points[:-1] == 39) & start[:-1] & (kind[1:] == _LETTER) & ~ends_text[:-1])
    if len(mark):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        inside = np.concatenate([ends_text, np.ones(2, bool)])
        for ending in ENDINGS:
            hit = np.ones(len(mark), bool)
            for k, c in enumerate(ending, 1):
                hit &= padded[mark + k] == ord(c)
                if k > 1:
                    hit &= ~inside[mark + k - 1]
            at = mark[hit]
            start[at + 1] = False
            after = at + 1 + len(ending)
            start[after[after < n]] = True  # the rest of the letters, or what comes next anyway
    return np.flatnonzero(start)


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the words begin, with the end, and each word's text."""
    if not len(data):
        return np.zeros(1, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # bytes that begin a character
    texts = np.searchsorted(heads, offsets[:-1][np.diff(offsets) > 0])
    starts = heads[word_starts(points, texts)]
    return np.append(starts, len(data)), np.searchsorted(offsets, starts, side="right") - 1


_SALT = mix64(np.arange(900, 1156, dtype=np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two independent 64-bit hashes of each word."""
    out = np.empty((len(starts), 2), np.uint64)
    out[:, 0] = span_hashes(data, starts, ends)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SALT[data] * (np.arange(len(data), dtype=np.uint64) * np.uint64(2) + np.uint64(1)), out=sums[1:])
    flat = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SALT[data], out=flat[1:])
    # weights count from the word's start
    out[:, 1] = mix64(sums[ends] - sums[starts] - (flat[ends] - flat[starts]) * (starts.astype(np.uint64) * np.uint64(2)))
    return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all ranges, one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


# --------------------------------------------------------------------------------------------
# Tables for the tasks


@dataclass
class Memo:
    """Words by hash, with their ids."""

    keys: np.ndarray  # sorted first hashes
    second: np.ndarray
    starts: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, bounds: np.ndarray, ids: np.ndarray, id_bounds: np.ndarray) -> Memo:
        """Of words and ids that stand one after another."""
        hashes = word_hashes(data, bounds[:-1], bounds[1:])
        order = np.argsort(hashes[:, 0], kind="stable")
        sizes = np.diff(id_bounds)[order]
        return cls(hashes[order, 0], hashes[order, 1], np.concatenate([[0], np.cumsum(sizes)]), ids[ragged(id_bounds[:-1][order], sizes)].astype(np.uint32))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word, or -1."""
        top = np.uint64(64 - 20)
        if not hasattr(self, "first"):
            self.first = np.searchsorted(self.keys >> top, np.arange((1 << 20) + 1, dtype=np.uint64)).astype(np.int32)
        bucket = hashes[:, 0] >> top
        at, end = self.first[bucket], self.first[bucket + np.uint64(1)]
        out = np.full(len(hashes), -1, np.int32)
        left = np.flatnonzero(at < end)
        while len(left):
            hit = (self.keys[at[left]] == hashes[left, 0]) & (self.second[at[left]] == hashes[left, 1])
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


@dataclass
class Tables:
    """What tasks need of a vocabulary."""

    points: np.ndarray  # code point of each byte
    by_size: dict[int, tuple[np.ndarray, np.ndarray]]  # hashes of the merged tokens of a size, sorted, and their ranks
    marks: np.ndarray  # whether a token's hash may have these highest bits
    pieces: np.ndarray  # bytes of all tokens by rank
    piece_starts: np.ndarray

    @classmethod
    def of(cls, v: Vocabulary) -> Tables:
        by_size: dict[int, list[tuple[int, bytes]]] = {}
        for token, rank in v.ranks.items():
            if rank in v.made_of:
                by_size.setdefault(len(token), []).append((rank, token))
        tables = {}
        for size, entries in sorted(by_size.items()):
            data = np.frombuffer(b"".join(t for _, t in entries), np.uint8)
            at = np.arange(len(entries)) * size
            hashes = run_hashes(data)(at, size)
            order = np.argsort(hashes)
            tables[size] = hashes[order], np.array([r for r, _ in entries], np.int64)[order]
        marks = np.zeros(1 << 21, bool)
        for hashes, _ in tables.values():
            marks[hashes >> np.uint64(43)] = True
        pieces = v.pieces()
        return cls(v.byte_points(), tables, marks, np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)]))

    def ranked(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """word * 2**20 + rank, sorted, of the tokens that stand in each of the words, which stand one after another; no place is missed, and a false one changes nothing."""
        at, word = np.arange(len(data)), np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        left = bounds[1:][word] - at  # bytes of the word from here
        hash_of = run_hashes(data)
        found, held = [np.zeros(0, np.int64)], 0
        for size, (hashes, ranks) in self.by_size.items():
            go_on = left >= size
            at, word, left = at[go_on], word[go_on], left[go_on]
            if not len(at):
                break
            h = hash_of(at, size)
            may = np.flatnonzero(self.marks[h >> np.uint64(43)])
            h = h[may]
            slot = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = hashes[slot] == h
            found.append((word[may[hit]] << 20) | ranks[slot[hit]])
            held += len(found[-1])
            if held > 1 << 22:
                found, held = [distinct(np.concatenate(found))], 0
        return distinct(np.concatenate(found))


def run_hashes(data: np.ndarray) -> Callable[[np.ndarray, int], np.ndarray]:
    """Hash of the run of bytes from each place with a size."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SALT[data] * _power(_BASE, len(data)), out=sums[1:])
    back = _power(_BASE_INVERSE, len(data) + 1)
    return lambda at, size: ((sums[at + size] - sums[at]) * back[at] + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


# --------------------------------------------------------------------------------------------
# Stages


def constant(spark: SparkSession, value: object, kind: str) -> Column:
    """A value as a scalar subquery: it is evaluated once and stands in the tasks as a compact literal, but not in the
    text of plans, which the optimizer compares and listeners print over and over."""
    return spark.createDataFrame([(value,)], f"v {kind}").scalar()


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value evaluated once."""
    return F.get(F.transform(F.array(value), f), 0)


def fold_merges(word: Column, tables: Column) -> Column:
    """A word (its bytes as characters, and ranks of merges in order) with every merge made."""
    return F.aggregate(word["ranks"], word["bytes"], lambda state, rank: F.replace(state, F.get(tables["pairs"], rank), F.get(tables["tokens"], rank)))


_REST = "array<struct<bytes:string,ranks:array<int>>>"


def _rest_words(tables: Tables, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StructArray:
    """The words as the fold takes them."""
    sizes = ends - starts
    data, bounds = data[ragged(starts, sizes)], np.concatenate([[0], np.cumsum(sizes)])
    points = tables.points[data]
    text = points.astype("<u4").tobytes().decode("utf-32-le").encode()
    width = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
    cut = np.concatenate([[0], np.cumsum(width)])[bounds]
    strings = pa.StringArray.from_buffers(len(starts), pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(text))
    found = tables.ranked(data, bounds)
    cuts = np.searchsorted(found, np.arange(len(starts) + 1) << 20)
    ranks = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array((found & ((1 << 20) - 1)).astype(np.int32)))
    return pa.StructArray.from_arrays([strings, ranks], names=["bytes", "ranks"])


def _split(tables, memo, at: int, keep: list[int], names: list[str]):
    """Rows to ``keep``, codes (4 bytes a word: its place in the memo, or -1 - its place among the row's other words) and these words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, m = tables.value, memo.value
        for batch in released(batches):
            for i, j, data, offsets in text_chunks(batch.column(at), RUN_BYTES):
                starts, text = split_words(data, offsets)
                hashes = word_hashes(data, starts[:-1], starts[1:])
                codes = m.find(hashes)
                rest = np.flatnonzero(codes < 0)
                # each other word once in a text
                order = rest[np.lexsort((hashes[rest, 1], hashes[rest, 0], text[rest]))]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[order[1:]] != hashes[order[:-1]]).any(1) | (text[order[1:]] != text[order[:-1]])
                which = np.cumsum(new) - 1
                words = order[new]
                of_text = np.searchsorted(text[words], np.arange(j - i + 1))
                codes[order] = -1 - (which - of_text[text[order]])
                listed = _rest_words(t, data, starts[words], starts[words + 1])
                cut = np.searchsorted(text, np.arange(j - i + 1))
                packed = pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((4 * cut).astype(np.int32)), pa.py_buffer(codes.astype("<i4"))])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), packed, pa.ListArray.from_arrays(pa.array(of_text.astype(np.int32)), listed)], names=names)

    return run


def _join_ids(memo: Memo, codes: pa.Array, folded: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows, and where each row's begin, with the end."""
    of_row = _offsets(codes) // 4
    raw = np.frombuffer(codes.buffers()[2] or b"", "<i4")[of_row[0] : of_row[-1]]
    of_row = of_row - of_row[0]
    words = folded.flatten()
    first = _offsets(folded) - _offsets(folded)[0]
    text = np.frombuffer(words.buffers()[2] or b"", np.uint8)[_offsets(words)[0] : _offsets(words)[-1]]
    points = np.frombuffer(text.tobytes().decode().encode("utf-32-le"), np.uint32)
    heads = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
    bounds = np.searchsorted(heads, _offsets(words) - _offsets(words)[0])
    pool = np.concatenate([memo.ids, ids_of(points).astype(np.uint32)])
    row = np.repeat(np.arange(len(codes)), np.diff(of_row))
    other = raw < 0
    starts, sizes = np.empty(len(raw), np.int64), np.empty(len(raw), np.int64)
    known = raw[~other]
    starts[~other], sizes[~other] = memo.starts[known], memo.starts[known + 1] - memo.starts[known]
    word = first[row[other]] - 1 - raw[other]
    starts[other], sizes[other] = len(memo.ids) + bounds[word], bounds[word + 1] - bounds[word]
    return pool[ragged(starts, sizes)], np.concatenate([[0], np.cumsum(sizes)])[of_row]


def _offsets(a: pa.Array) -> np.ndarray:
    return np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64) if len(a) else np.zeros(1, np.int64)


def _parts(batch: pa.RecordBatch, n: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about RUN_BYTES of codes."""
    sizes = np.cumsum(np.diff(_offsets(batch.column(n))))
    i = 0
    while i < batch.num_rows:
        done = sizes[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(sizes, done + RUN_BYTES)))
        yield batch.slice(i, j - i)
        i = j


def _with_ids(memo, n: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for part in _parts(batch, n):
                ids, starts = _join_ids(memo.value, part.column(n), part.column(n + 1))
                listed = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns[:n], listed], names=names)

    return run


def _digests(tables, memo, n: int, names: list[str]):
    """Number of ids, SHA-256 of the ids as little-endian 32-bit integers, and of the concatenated pieces they stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables.value
        for batch in released(batches):
            for part in _parts(batch, n):
                ids, starts = _join_ids(memo.value, part.column(n), part.column(n + 1))
                sizes = t.piece_starts[ids + 1] - t.piece_starts[ids]
                text = memoryview(t.pieces[ragged(t.piece_starts[ids], sizes)])
                cut = np.concatenate([[0], np.cumsum(sizes)])[starts].tolist()
                raw, at = memoryview(ids.astype("<u4").tobytes()), (4 * starts).tolist()
                one = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                two = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(np.diff(starts)), pa.array(one, pa.string()), pa.array(two, pa.string())], names=names)

    return run


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each run of texts with their numbers."""
    for batch in batches:
        for _, _, data, offsets in text_chunks(batch.column(0), RUN_BYTES):
            starts, _ = split_words(data, offsets)
            words = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(data)])
            counted = words.value_counts()
            short = pc.less_equal(pc.binary_length(counted.field("values")), MEMO_BYTES)
            yield pa.RecordBatch.from_arrays([counted.field("values").filter(short), counted.field("counts").filter(short)], names=["w", "n"])


class Codec:
    """One vocabulary's tables, and the DataFrame functions that use them."""

    def __init__(self, spark: SparkSession, path: str):
        v = vocabulary(path)
        batch_rows(spark)
        self.spark, self.vocabulary = spark, v
        self.tables = spark.sparkContext.broadcast(Tables.of(v))
        pairs, tokens = v.merges()
        self._pairs, self._tokens = constant(spark, pairs, "array<string>"), constant(spark, tokens, "array<string>")
        self._set_memo(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64))

    def _set_memo(self, data: np.ndarray, bounds: np.ndarray, ids: np.ndarray, id_bounds: np.ndarray) -> None:
        """The vocabulary's own words, and others that stand one after another."""
        own = self.vocabulary.ranks
        own_bounds, n = np.cumsum([0, *map(len, own)]), len(own)
        words = np.concatenate([np.frombuffer(b"".join(own), np.uint8), data])
        starts = np.concatenate([np.arange(n), id_bounds + n])
        memo = Memo.of(words, np.concatenate([own_bounds[:-1], bounds + own_bounds[-1]]), np.concatenate([np.fromiter(own.values(), np.int64, n), ids]), starts)
        self.memo = self.spark.sparkContext.broadcast(memo)

    def _folded(self, df: DataFrame, text_col: str) -> DataFrame:
        """``df`` without the text, with the codes and the folded other words of each row at the end."""
        rest = [c for c in df.columns if c != text_col]
        keep = [df.columns.index(c) for c in rest]
        schema = schema_with(df.select(*rest), **{"_bpe_codes": "binary", "_bpe_rest": _REST})
        split = df.mapInArrow(_split(self.tables, self.memo, df.columns.index(text_col), keep, schema.names), schema)
        with_tables = split.select("*", self._pairs.alias("_bpe_pairs"), self._tokens.alias("_bpe_tokens"))
        merges = F.struct(F.col("_bpe_pairs").alias("pairs"), F.col("_bpe_tokens").alias("tokens"))
        folded = let(merges, lambda t: F.transform("_bpe_rest", lambda word: fold_merges(word, t)))
        return with_tables.select(*rest, "_bpe_codes", folded.alias("_bpe_folded"))

    def learn(self, docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> None:
        """Fill the memo with the words that occur most in a bounded sample, encoded by the fold."""
        n = docs.count()
        share = min(1.0, MEMO_DOCS / max(n, 1))
        sample = docs.select(F.col(text_col).alias("t"), F.xxhash64(id_col, F.lit(41)).alias("h"))
        sample = sample.where(F.pmod("h", F.lit(1 << 40)) < int(share * (1 << 40))).select("t") if share < 1 else sample.select("t")
        counts = sample.mapInArrow(_count_words, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n")).where("n > 1")
        top = materialize(counts.orderBy(F.desc("n"), "w").limit(MEMO_WORDS).select("w"), "words")
        # words are encoded as texts of one word each, dealt over the tasks; a word of the vocabulary is one token either way
        got = self.encode(top.select("w", F.col("w").cast("string").alias("text")).repartition(32, "w")).toArrow().combine_chunks()
        if len(got):
            words, ids = (got.column(c).chunk(0) for c in ("w", "token_ids"))
            bounds, id_bounds = _offsets(words), _offsets(ids)
            data = np.frombuffer(words.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
            self._set_memo(data, bounds - bounds[0], ids.flatten().to_numpy(), id_bounds - id_bounds[0])

    def encode(self, df: DataFrame, text_col: str = "text", name: str = "token_ids") -> DataFrame:
        """The ids of a text (array of bigint; empty for null) in place of the text, as column ``name`` at the end."""
        df = df if name == text_col else df.drop(name)
        folded = self._folded(df, text_col)
        rest = [c for c in df.columns if c != text_col]
        schema = schema_with(df.select(*rest), **{name: "array<bigint>"})
        return folded.mapInArrow(_with_ids(self.memo, len(rest), schema.names), schema)

    def decode(self, df: DataFrame, ids_col: str = "token_ids", name: str = "decoded") -> DataFrame:
        """Add the bytes that the ids stand for: the binary pieces, one after another."""
        rest = [c for c in df.columns if c != name]
        pieces = df.select("*", constant(self.spark, self.vocabulary.pieces_hex(), "array<string>").alias("_bpe_pieces"))
        joined = let(F.col("_bpe_pieces"), lambda p: F.unhex(F.array_join(F.transform(ids_col, lambda t: F.get(p, t)), "")))
        return pieces.select(*rest, joined.alias(name))

    def digest(self, df: DataFrame, text_col: str = "text") -> DataFrame:
        """n_tokens, ids_sha256 and decoded_sha256 in place of the text."""
        rest = [c for c in df.columns if c != text_col]
        schema = schema_with(df.select(*rest), n_tokens="bigint", ids_sha256="string", decoded_sha256="string")
        return self._folded(df, text_col).mapInArrow(_digests(self.tables, self.memo, len(rest), schema.names), schema)


def codec_for(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> Codec:
    """The vocabulary's codec with a memo for these texts."""
    codec = Codec(docs.sparkSession, path)
    codec.learn(docs, text_col, id_col)
    return codec


def round_trip(docs: DataFrame, path: str, *keep: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document; then the columns ``keep``.

    Null and empty texts have no ids. Every row stays, repeated ones too; other columns are not read;
    an empty table gives an empty result. Equal texts have equal ids. Very long texts are encoded
    whole, one at a time; a word of n bytes, however long, takes one pass for each distinct token
    that stands in it.
    """
    digests = codec_for(docs, path).digest(docs.select("doc_id", "text", *keep))
    return digests.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *keep)
