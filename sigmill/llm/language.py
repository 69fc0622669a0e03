"""Language identification by cross-parsing.

For each language a suffix automaton holds every substring of a labelled sample. A text is cut,
left to right, into the longest phrases that occur in the sample; few phrases mean that the sample
predicts the text well. Phrase counts are normalised by log2 of the sample's size over the text's
length (the cross-parsing estimate of entropy), and the language with the least wins.

The automata are laid out as one table of moves, so that all languages and many texts advance
together, one symbol at a time, in array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _DEFAULT_ROWS, BROADCAST_ROWS, batch_rows, held_out, materialize, schema_with
from .hashed_text import IS_LETTER, LOWER, code_points

#: Labelled documents of a language to learn from (about), and the most symbols of its sample.
TRAIN_DOCS, TRAIN_SYMBOLS = 300, 24_000
#: Most entries of all languages' tables of moves (4 bytes each); with very many languages, or letters, samples are smaller.
TABLE = 24_000_000
#: Texts of more symbols are advanced together with other long ones, so many symbols at once.
LONG, POOL = 4096, 1 << 23
#: Characters of short texts that advance together.
RUN_CHARS = 1 << 20
UNKNOWN = "und"
_BROKEN = 1 << 30


def normal(text: str) -> str:
    """Lower-case letters; each run of other characters is a space, and one follows a last letter."""
    raw = np.frombuffer((text + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = IS_LETTER[raw]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return "".join(map(chr, np.where(letter, LOWER[raw], 32)[keep]))


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """The moves of each state of the smallest automaton of all substrings; state 0 is the start."""
    moves: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        now = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = now
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return moves


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # moves of all automata: the row of the next state, with a mark where a phrase ends before the symbol
    roots: np.ndarray
    norms: np.ndarray  # log2 of the samples' sizes
    codes: dict[int, int]  # code point to symbol; 0 is none, 1 any letter that no sample has
    columns: np.ndarray  # by language and symbol, the column of its automaton's rows; 0 for what its sample does not have

    def symbols(self) -> np.ndarray:
        """The symbol of each code point."""
        out = np.ones(0x110000, np.uint16 if len(self.codes) < 60_000 else np.uint32)
        for point, code in self.codes.items():
            out[point] = code
        return out


def room(letters: int, languages: int) -> int:
    """Symbols that a language's sample may have, so that all tables stay within TABLE: an automaton has up to two states for each."""
    return max(2, min(TRAIN_SYMBOLS, TABLE // max(1, languages) // (2 * (letters + 1)) - 2))


def build(samples: dict[str, str]) -> Model:
    """A model of normalised labelled text per language."""
    languages = sorted(samples)
    samples = {x: samples[x][: room(len(set(samples[x])), len(languages))] for x in languages}
    letters = sorted({c for s in samples.values() for c in s})
    codes = {ord(c): i + 2 for i, c in enumerate(letters)}
    columns = np.zeros((len(languages), 2 + len(letters)), np.int32)
    rows, roots, base = [], [], 0
    for k, language in enumerate(languages):
        own = {c: i + 1 for i, c in enumerate(sorted(set(samples[language])))}
        for c, i in own.items():
            columns[k, codes[ord(c)]] = i
        moves, width = suffix_automaton(samples[language]), 1 + len(own)
        # before the first symbol, and after one that the sample does not have, any symbol begins a phrase
        outside = base + len(moves) * width
        roots.append(outside)
        fresh = np.full(width, outside | _BROKEN, np.int32)
        for c, to in moves[0].items():
            fresh[own[c]] = (base + to * width) | _BROKEN
        block = np.tile(fresh, (len(moves) + 1, 1))
        for state, by in enumerate(moves):
            for c, to in by.items():
                block[state, own[c]] = base + to * width
        rows.append(block.ravel())
        base += block.size
    if base >= _BROKEN:
        raise ValueError("the samples are too large for the table of moves")
    table = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return Model(languages, table, np.array(roots, np.int32), np.log2([max(2, len(samples[x])) for x in languages]), codes, columns)


def _advance(symbols: np.ndarray, begin: np.ndarray, length: np.ndarray, model: Model) -> np.ndarray:
    """Phrases of each text by language: all texts advance together, one symbol at a time; the longest come first, and those that are over drop off the end."""
    k = len(model.languages)
    order = np.argsort(-length, kind="stable")
    at, size = begin[order], length[order]
    broken = np.zeros((k, len(at)), np.int64)
    state = np.repeat(model.roots[:, None], len(at), 1)
    steps = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(steps), side="left")
    for t in range(steps):
        live = alive[t]
        v = model.table.take(state[:, :live] + model.columns.take(symbols[at[:live] + t], axis=1))
        broken[:, :live] += v >> 30
        state[:, :live] = v & (_BROKEN - 1)
    out = np.zeros((len(at), k))
    out[order] = broken.T
    return out


def phrases(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(phrases of each text by language, symbols of each text); a text without a letter has no symbols."""
    n, k = len(texts), len(model.languages)
    out, sizes = np.zeros((n, k)), np.zeros(n, np.int64)
    symbol_of, long, held = model.symbols(), [], 0

    def flush() -> None:
        if long:
            ends = np.cumsum([len(s) for _, s in long])
            lengths = np.array([len(s) for _, s in long])
            out[[row for row, _ in long]] = _advance(np.concatenate([s for _, s in long]), ends - lengths, lengths, model)

    for i, j, points, starts in code_points(texts, RUN_CHARS):
        letter = IS_LETTER[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        if not k or not keep.any():
            continue
        has = np.concatenate([[0], np.cumsum(letter)])
        cut = np.concatenate([[0], np.cumsum(keep)])[starts]
        # the line feed before a text is kept if the text before it ends with a letter: it belongs to that text
        symbols = symbol_of[np.where(letter, LOWER[points], 32)[keep]]
        sizes[i:j] = np.diff(cut) * (np.diff(has[starts]) > 0)
        short = np.flatnonzero((sizes[i:j] > 0) & (sizes[i:j] <= LONG))
        out[i + short] = _advance(symbols, cut[:-1][short], sizes[i + short], model)
        for row in np.flatnonzero(sizes[i:j] > LONG):
            long.append((i + row, symbols[cut[row] : cut[row + 1]].copy()))
            held += len(long[-1][1])
        if held > POOL:
            flush()
            long, held = [], 0
    flush()
    return out, sizes


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """The language of each text and how much fewer phrases it needs than the next best (0 to 1)."""
    count, sizes = phrases(texts, model)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    entropy = count * model.norms / np.maximum(sizes, 1)[:, None]
    best = entropy.argmin(1)
    low = entropy[np.arange(len(texts)), best]
    rest = np.partition(entropy, 1, axis=1)[:, 1] if len(model.languages) > 1 else low
    score = np.where(sizes > 0, 1 - low / np.maximum(rest, 1e-12), 0.0)
    return [model.languages[b] if s else UNKNOWN for b, s in zip(best, sizes, strict=True)], score


def fit(docs: DataFrame) -> Model:
    """Learn from a bounded sample of the documents with a language that are not held out: of each language, however
    many there are, runs of text from hashed places anywhere in about TRAIN_DOCS hashed documents.

    One pass counts the languages, and one takes the sample; equal runs count once.
    """
    use = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = materialize(use.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    counts = F.broadcast(counts) if counts.count() <= BROADCAST_ROWS else counts
    unit = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)
    # so many characters of each document that the sample has enough symbols, and twice that for what is no letter
    size = F.greatest(F.lit(100), F.ceil(F.lit(2 * TRAIN_SYMBOLS) / F.least(F.col("n"), F.lit(TRAIN_DOCS)))).cast("int")
    chosen = use.join(counts, "lang").where(unit(97) < TRAIN_DOCS / F.col("n"))
    begin = (F.floor(unit(41) * F.greatest(F.lit(0), F.length("text") - size)) + 1).cast("int")
    pieces = chosen.select("lang", "doc_id", F.substring("text", begin, size).alias("piece"))
    by: dict[str, dict[str, None]] = {}
    for r in sorted(pieces.collect(), key=lambda r: (r["lang"], str(r["doc_id"]), r["piece"])):
        by.setdefault(r["lang"], {})[normal(r["piece"])] = None
    samples = {language: "".join(by[language])[:TRAIN_SYMBOLS] for language in by}
    return build({k: v for k, v in samples.items() if v.strip()})


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score appended.

    Null texts and texts without a letter get ``und`` and 0; of languages that need equally many
    phrases the first by name wins. Very long texts are parsed whole, from their first symbol on. Every
    row stays, repeated ones too; other columns pass, those of the two names are replaced; an empty
    table gives an empty result.
    """
    docs = docs.drop("lang_pred", "score")
    batch_rows(docs.sparkSession, _DEFAULT_ROWS)  # long texts of a batch advance together
    at = docs.columns.index(text_col)
    schema = schema_with(docs, lang_pred="string", score="double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = predict(batch.column(at).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(score)], names=schema.names)

    return docs.mapInArrow(run, schema)


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    out = identify(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
