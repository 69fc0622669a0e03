"""The corpus operators against brute force, round trips and held-out accuracy, and on odd inputs."""

import hashlib
import random
import re
import struct
import time
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sigmill.llm import byte_bpe, common, decontaminate, embedding_dedup, hashed_text, language, license_scan, near_dedup, quality, span_dedup, toxicity, warc
from sigmill.llm.queries import QUERIES, vocabulary_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, rep long, h1 long, score double, label double"


def docs_of(spark, texts, ids=None, langs=None):
    """A table with names that clash with those the operators use."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, (langs or {}).get(k), "s", None if t is None else len(t), 7, 7, 7, 0.5, 1.0) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD = [None, "", "   \n\t ", "one", "one two three four", "ONE two THREE four", "x" * 5000, "a b c d e f g " * 3000, "é ü ß 日本語 🎉 words here too"]


def components(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# -- shared kernels


def test_shingles_are_those_of_a_plain_loop():
    rng = random.Random(1)
    texts = [*ODD, *(" ".join(words(rng, rng.randrange(40), 30)) for _ in range(200))]
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    got = list(common.shingle_sets(pa.array(texts)))
    assert [len(g) for g in got] == [len(s) for s in sets]
    for i, j in combinations(range(60), 2):
        assert len(np.intersect1d(got[i], got[j])) == len(sets[i] & sets[j])


def test_chunks_of_a_sliced_column():
    column = pa.array(["aa", None, "b" * 50, "", "cc"]).slice(1)
    got = [(i, j, bytes(d), o.tolist()) for i, j, d, o in common.text_chunks(column, limit=10)]
    assert b"".join(g[2] for g in got) == b"b" * 50 + b"cc" and got[0][0] == 0 and got[-1][1] == 4


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    expected = components(500, links)
    got = dict(common.connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(got.get(i, i) == c for i, c in enumerate(expected))
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 1


def test_jaccard_join_is_brute_force(spark):
    rng = random.Random(3)
    base = [words(rng, n) for n in (90, 120, 200, 12, 8)]
    texts = [" ".join(b) for b in base] + ODD + [ODD[4], "a b c d e f g " * 3000]
    common_part = words(rng, 55)
    for b in base:
        for k in range(12):
            w = list(b)
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(len(w))] = f"n{rng.randrange(999)}"
            texts.append(" ".join(w))
    texts += [" ".join(common_part + words(rng, rng.randrange(5, 60))) for _ in range(40)]
    sets = list(common.shingle_sets(pa.array(texts)))
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if near_dedup.linked(sets[i], sets[j])]
    got = near_dedup.jaccard_components(docs_of(spark, texts).repartition(5)).toPandas().set_index("doc_id").sort_index()
    assert got.component_id.tolist() == components(len(texts), links)
    assert got.n_shingles.tolist() == [len(s) for s in sets]
    assert len(links) > 50
    kept = near_dedup.keep_one(docs_of(spark, texts))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(components(len(texts), links)))


def test_jaccard_bound_never_loses_a_pair():
    rng = np.random.default_rng(4)
    hot = np.sort(rng.integers(0, 1 << 60, 200, dtype=np.uint64))
    counts = rng.integers(1, 9, 200)
    for _ in range(400):
        n = int(rng.integers(1, 120))
        a = np.unique(np.concatenate([rng.choice(hot, min(n, 60), replace=False), rng.integers(0, 1 << 60, n, dtype=np.uint64)]))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.uniform(0.85, 1)], rng.integers(0, 1 << 60, int(rng.integers(0, 1 + len(a) // 8)), dtype=np.uint64)]))
        if near_dedup.linked(a, b):
            p, q = (near_dedup.in_order(x, hot, counts)[: near_dedup.prefix_size(len(x))] for x in (a, b))
            least = 1 + near_dedup.needed_overlap(len(a), len(b)) + (-4 * max(len(a), len(b)) // 5)
            assert len(np.intersect1d(p, q)) >= max(1, least)


def test_jaccard_odd_tables(spark):
    assert near_dedup.jaccard_components(docs_of(spark, [])).count() == 0
    got = near_dedup.jaccard_components(docs_of(spark, ["a b c d e f", "a b c d e f", "a b c d e f"], [5, 5, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (5, 5), (5, 5)]


# -- 2


def test_decontamination_finds_new_parameters(spark):
    item = "A train with 3 wagons leaves Paris at noon and travels 120 km in 2 hours before meeting Anna and her 3 friends near Paris again today."
    again = "A train with 5 wagons leaves London at noon and travels 340 km in 7 hours before meeting Berta and her 5 friends near London again today."
    wrong = "A train with 5 wagons leaves London at noon and travels 340 km in 7 hours before meeting Berta and her 9 friends near Madrid again today."
    texts = [f"Some words first. {item} And after.", f"Other words. {again} More.", f"Other words. {wrong} More.", item.upper(), "nothing of the kind here at all, only words and words", *ODD]
    bench = spark.createDataFrame([(1, item, 3), (2, None, 3), (3, "too short", 3)], "item_id long, text string, doc_id long")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs_of(spark, texts), bench).collect()}
    assert set(got) == {(0, 1), (1, 1)}
    assert got[0, 1].n_changed == 0 and got[1, 1].n_changed >= 3
    assert decontaminate.remove_leaks(docs_of(spark, texts), bench).count() == len(texts) - 2
    assert decontaminate.leaks(docs_of(spark, []), bench).count() == 0
    assert decontaminate.leaks(docs_of(spark, texts), bench.limit(0)).count() == 0


def test_decontamination_in_any_case(spark):
    item = "A train with 3 wagons leaves Paris at noon and travels 120 km in 2 hours before meeting Anna and her 3 friends near Paris again today."
    short = "What is the name of the longest river in southern Africa?"
    texts = [item, item.upper(), item.lower(), item.title(), short.upper(), f"Question: {short}", f"A heading\n{short}", item.upper().replace("3 F", "9 F"), item.replace("Paris", "London"), *ODD]
    bench = spark.createDataFrame([(1, item), (2, short)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs_of(spark, texts), bench, any_case=True).collect()}
    assert set(got) == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (8, 1)}
    assert all(got[k, 1].n_changed == 0 for k in range(4)) and got[8, 1].n_changed == 1
    assert all(got[k].share == 1 for k in ((0, 1), (1, 1), (4, 2), (5, 2), (6, 2)))
    assert decontaminate.remove_leaks(docs_of(spark, texts), bench, any_case=True).count() == len(texts) - 8


def test_decontamination_keeps_token_counts(spark):
    rng = random.Random(5)
    alphabet = "ab Z9 .,'-%$é İ5km\n12.5 Tom's"
    texts = ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(300)] + ODD[3:]
    row = docs_of(spark, texts).select(F.size(decontaminate.tokens(F.col("text"))).alias("a"), F.size(F.split(decontaminate.template(F.col("text")), " ")).alias("b"), decontaminate.template(F.col("text")).alias("t"))
    assert all(r.a == (r.b if r.t else 0) for r in row.collect())


def test_decontamination_has_no_python(spark, sf):
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    out = decontaminate.leaks(docs, bench)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())
    q = {r.item_id: r.text for r in bench.collect()}
    exact = {(r.doc_id, i) for r in docs.collect() for i, t in q.items() if r.text and t in r.text}
    assert exact == {(r.doc_id, r.item_id) for r in out.collect()}


# -- 3


def brute_license(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, base = [], set()
    for p, label in license_scan.BASE_PHRASES.items():
        p = p.split()
        hits = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        at += hits
        base |= {label} if hits else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base))


def test_license_scan(spark):
    texts = [
        *ODD, "Licensed under the Apache License, Version 2.0.", "licensed under the apache license, version 3", "MIT license and mit LICENSE; GNU General Public License",
        "Licensed under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3", "é mit license é", "mit license" * 2000,
        "Copyright (c) 2020 Some People. All rights reserved", "Copyright one two three four five six seven eight nine all rights reserved", "licenselicense mit",
    ]
    got = license_scan.license_scan(docs_of(spark, texts)).toPandas().set_index("doc_id").sort_index()
    for k, t in enumerate(texts):
        r = got.loc[k]
        assert (r.n_words, r.n_base, *(None if pd.isna(x) else x for x in (r.first_word, r.last_word)), r.base_labels) == brute_license(t), t
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
    labels = got.labels.tolist()[len(ODD) :]
    assert labels[0] == "apache,apache-2.0" and labels[1] == "apache" and labels[3] == "gpl,gpl-3.0" and labels[6] == "all-rights-reserved" and labels[7] == ""
    assert license_scan.license_scan(docs_of(spark, [])).count() == 0


def test_markup_is_checked():
    with pytest.raises(ValueError):
        license_scan.TokenAutomaton([("x", "a [[ b")])
    a = license_scan.TokenAutomaton([("x", "a [[b {{2}}]] c")])
    assert a.labels("a c".split()) == a.labels("z a b q q c".split()) == {"x"} and not a.labels("a b q q q c".split())


# -- 4


def test_embedding_join_is_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 32))
    v = np.concatenate([base, base[:10], base[:20] + rng.normal(size=(20, 32)) * 0.15, base[:1] + rng.normal(size=(300, 32)) * 0.1, base[:5] * 3]).astype(np.float32)
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [1.0, None] + [0.0] * 30, [float("inf")] * 32, [1.0, 2.0], [1.0, 2.0]]
    rows += [(len(v) + i, x, 0) for i, x in enumerate(odd)]
    got = embedding_dedup.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")).toPandas().set_index("vec_id").sort_index()
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    n = near.sum(1).tolist() + [0] * 6 + [1, 1]
    assert got.n_links.tolist() == n
    pairs = [*zip(*np.nonzero(near)), (len(v) + 6, len(v) + 7)]
    assert got.component_id.tolist() == components(len(rows), pairs)
    assert (got.kept == (got.index == got.component_id)).all()
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 40)
    test_embedding_join_is_brute_force(spark)


# -- 5, 7, 8


def test_ordinal_grades():
    rng = random.Random(7)
    texts, grades = [], []
    for _ in range(900):
        g = rng.randrange(4)
        texts.append(" ".join("!!!" if rng.random() < g / 6 else rng.choice("lorem ipsum dolor sit amet".split()) for _ in range(60)))
        grades.append(float(g))
    ids, counts = zip(*(hashed_text.text_features(t, quality.BUCKETS, hashed_text.style_grams) for t in texts))
    make = lambda k: hashed_text.Sample(np.cumsum([0, *map(len, ids[k])]), np.concatenate([np.zeros(0, int), *ids[k]]), np.concatenate([np.zeros(0), *counts[k]]), np.array([1 / c.sum() for c in counts[k]]), np.array(grades[k]))
    m = quality.train(make(slice(0, 700)))
    assert (np.diff(m.thresholds) > 0).all()
    p = quality.predict(texts[700:], m)
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert np.corrcoef(p @ m.grades, grades[700:])[0, 1] > 0.9
    assert np.isfinite(quality.predict([None, "", "x"], m)).all()
    one = quality.train(make(slice(0, 0)))
    assert (quality.predict(["x"], one) == 1).all()


def test_sample_has_whole_counts(spark):
    texts = ["ab cd " * 20_000, "one two three", "", "x" * 300]
    labels = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, quality int")
    got = hashed_text.labelled_sample(docs_of(spark, texts), labels, "quality", F.lit(True), 10, quality.BUCKETS, hashed_text.style_grams)
    for k, t in enumerate(texts):
        ids, counts = hashed_text.text_features(t, quality.BUCKETS, hashed_text.style_grams)
        at = slice(got.starts[k], got.starts[k + 1])
        assert np.array_equal(np.bincount(got.ids[at], got.counts[at], quality.BUCKETS), np.bincount(ids, counts, quality.BUCKETS)) and np.isclose(got.unit[k], 1 / counts.sum())


def held_out_rows(spark, query, sf):
    out = QUERIES_BY_NAME[query](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas().drop_duplicates("doc_id"), on="doc_id")
    return out[out.held_out]


QUERIES_BY_NAME = {f.__name__: f for f in QUERIES}


def test_quality_held_out(spark):
    z = held_out_rows(spark, "op5_quality", "/root/testdata/sf0.1")
    assert ((z.keep == (z.quality == 1)).mean() > 0.95) and z.tail_prob.between(0, 1).all()


def test_toxicity_held_out(spark):
    z = held_out_rows(spark, "op8_toxicity", "/root/testdata/sf0.1")
    assert (z.predicted == z.toxic).mean() > 0.95 and z.score.between(0, 1).all()


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES_BY_NAME["op7_language"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    z = out[out.held_out & out.lang.notna()]
    assert (z.lang == z.lang_pred).mean() > 0.98 and out.score.between(0, 1).all()


def test_cross_parsing_is_a_plain_greedy_parse():
    rng = random.Random(8)
    samples = {"a": "".join(rng.choice("abc ") for _ in range(300)), "b": "".join(rng.choice("bcd ") for _ in range(300))}
    m = language.build(samples)
    texts = ["".join(rng.choice("abcdé ,1") for _ in range(rng.randrange(1, 200))) for _ in range(50)] + ["abc " * 2000, None, "", "12 ..."]
    count, sizes = language.phrases(texts, m)
    for t, c, n in zip(texts, count, sizes):
        s = language.normal(t or "")
        s = s if re.search(r"[^\W\d_]", t or "") else ""
        assert n == len(s)
        for k, sample in enumerate(samples.values()):
            k_phrases = i = 0
            while i < len(s):
                j = i + 1
                while j <= len(s) and s[i:j] in sample:
                    j += 1
                i = max(j - 1, i + 1)
                k_phrases += 1
            assert c[k] == k_phrases
    best, score = language.predict([None, "", "..12", "🎉🎉", "١٢ 🎉", "\U0001d7ce"], m)
    assert best == ["und"] * 6 and (score == 0).all()
    assert language.predict(["\U00010400"], m)[0] != ["und"]  # a letter beyond 16 bits


def test_more_languages_than_a_few(spark):
    rng = random.Random(6)
    letters = {f"l{k:02}": [chr(0x4E00 + 20 * k + i) for i in range(20)] for k in range(80)}
    say = lambda k: "".join(rng.choice([*letters[k], " "]) for _ in range(120))
    rows = [(i, say(f"l{i % 80:02}"), f"l{i % 80:02}") for i in range(800)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.language_id(d).collect()
    assert all(r.lang_pred == f"l{r.doc_id % 80:02}" for r in got) and len(got) == 800


def test_languages_without_letters(spark):
    texts = ["🎉🎉", "12 34", "...", None, "", "the word", "\U00010400\U00010401"]
    rows = [(i, t, "en" if i == 5 else None) for i, t in enumerate(texts)] + [(10 + i, "the word and more of it", "en") for i in range(8)]
    got = {r.doc_id: r.lang_pred for r in language.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert [got[i] for i in range(7)] == ["und"] * 5 + ["en"] * 2


def test_models_on_odd_tables(spark):
    labels = spark.createDataFrame([(0, 1, 1), (0, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")
    d = docs_of(spark, [*ODD, "same"], [*range(len(ODD)), 0], {3: "en", 4: None})
    for f in (lambda: toxicity.toxicity(d, labels), lambda: quality.quality(d, labels), lambda: language.language_id(d)):
        assert f().count() == len(ODD) + 1
    empty = docs_of(spark, [])
    for f in (lambda: toxicity.toxicity(empty, labels.limit(0)), lambda: quality.quality(empty, labels.limit(0)), lambda: language.language_id(empty)):
        assert f().count() == 0
    out = toxicity.score(d, toxicity.fit(d, labels))
    assert set(d.columns) <= set(out.columns) and out.count() == len(ODD) + 1


# -- 6


def test_bpe_is_tiktoken(spark):
    import public_tokenizers as P
    import tiktoken

    rng = random.Random(9)
    alphabet = "ab theé \n\t'sX90.!　日🎉 "
    texts = [*ODD, *("".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(60)), "I'll say it's 100% 'real'  \n\n x", "ab" * 700]
    v = byte_bpe.vocabulary(vocabulary_path())
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    got = byte_bpe.round_trip(docs_of(spark, texts), vocabulary_path(), "lang").toPandas().set_index("doc_id").sort_index()
    for k, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got.n_tokens[k] == len(ids), t
        assert got.ids_sha256[k] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got.decoded_sha256[k] == hashlib.sha256((t or "").encode()).hexdigest()
    codec = byte_bpe.Codec(spark, vocabulary_path())  # without a memo: the fold alone
    few = codec.decode(codec.encode(docs_of(spark, texts))).collect()
    assert all(r.token_ids == enc.encode_ordinary(texts[r.doc_id] or "") and bytes(r.decoded) == (texts[r.doc_id] or "").encode() for r in few)
    assert byte_bpe.round_trip(docs_of(spark, []), vocabulary_path()).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_words_of_any_length(spark, name):
    import public_tokenizers as P
    import tiktoken

    began = time.time()
    byte_bpe.Vocabulary(byte_bpe.read_ranks(P.path(name)))
    assert time.time() - began < 10
    rng = random.Random(4)
    texts = ["a" * 4097, "".join(rng.choice("abcdefghijklmnop") for _ in range(60_000)), "日本" * 3000, "!?" * 999 + "'s", "\n" * 500 + " x", "12345678901234567890" * 40, " \x1c\x85\u3000x"]
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.vocabulary(P.path(name)).ranks, special_tokens={})
    codec = byte_bpe.Codec(spark, P.path(name))
    got = codec.decode(codec.encode(docs_of(spark, texts))).collect()
    assert all(r.token_ids == enc.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded).decode() == texts[r.doc_id] for r in got) and len(got) == len(texts)


def test_bpe_splits_as_the_pattern():
    import public_tokenizers as P
    import regex

    rng = random.Random(3)
    texts = ["".join(rng.choice("ab 'sretvlmd .!\n\t  é日9½\x1c\x85'") for _ in range(rng.randrange(40))) for _ in range(5000)] + ["", "'", "'s", "'ll x", "it's' 're "]
    data, offsets = np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, text = byte_bpe.split_words(data, offsets)
    got = [[] for _ in texts]
    for a, b, k in zip(starts[:-1], starts[1:], text):
        got[k].append(data[a:b].tobytes().decode())
    assert got == [regex.findall(P.PATTERN, t) for t in texts]


# -- 9


def brute_spans(texts):
    """Sentences by a plain loop, and which of them a non-first span covers."""
    cut = []
    for t in texts:
        sentences, now = [], []
        for m in re.finditer(rb"[^\x20\x09-\x0D]+([\x20\x09-\x0D]*)", (t or "").encode()):
            w = m[0][: len(m[0]) - len(m[1])]
            now.append(re.sub(rb"[A-Z]", lambda x: x[0].lower(), w))
            if w[-1:] in b".!?" or b"\n" in m[1]:
                sentences.append(now)
                now = []
        sentences += [now] if now else []
        cut.append([s[i : i + 20] for s in sentences for i in range(0, len(s), 20)])
    places = {}
    for d, s in enumerate(cut):
        spans = set()
        size = lambda a, b: sum(map(len, s[a:b]))  # noqa: B023, E731
        for i in range(len(s)):
            ends = [j for j in range(i + 3, len(s) + 1) if size(i, j) >= 20]
            starts = [h for h in range(i - 2, -1, -1) if size(h, i + 1) >= 20]
            spans |= {(i, ends[0])} if ends else set()
            spans |= {(starts[0], i + 1)} if starts else set()
        for a, b in spans:
            places.setdefault(tuple(w for x in s[a:b] for w in x), []).append((d, a, b))
    gone = [set() for _ in texts]
    for p in places.values():
        for d, a, b in sorted(p)[1:]:
            gone[d] |= set(range(a, b))
    return [len(s) for s in cut], [len(g) for g in gone]


def test_span_dedup_is_brute_force(spark):
    rng = random.Random(10)
    sentence = lambda: " ".join(words(rng, rng.randrange(2, 30))) + rng.choice([".", "!", "\n", "?\n"])
    passage = " ".join(sentence() for _ in range(6))
    texts = [" ".join(sentence() for _ in range(rng.randrange(8))) + (" " + passage + " " if k % 3 == 0 else "") + " ".join(sentence() for _ in range(rng.randrange(5))) for k in range(40)]
    texts += [*ODD, texts[0], texts[1], "same old words again here. " * 50]
    got = span_dedup.remove_repeats(docs_of(spark, texts).repartition(3)).toPandas().set_index("doc_id").sort_index()
    n, gone = brute_spans(texts)
    assert got.n_sentences.tolist() == n
    assert got.n_removed.tolist() == gone
    assert sum(gone) > 50
    for k, t in enumerate(texts):
        if not gone[k]:
            assert got.text[k] == t or (t is None and got.text[k] is None)
    assert sum(passage[:60] in (t or "") for t in got.text) == 1
    assert span_dedup.remove_repeats(docs_of(spark, [])).count() == 0
    twice = span_dedup.remove_repeats(docs_of(spark, [passage, passage, passage], [1, 1, None]))
    assert sorted(r.n_removed for r in twice.collect()) == [0, 0, 0]


def brute_passages(texts, size=51):
    """Which words of each text lie in a run of ``size`` words that an earlier text has, or an earlier place in it if no two of its places there overlap."""
    seen, gone = set(), []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        places = {}
        for i in range(len(w) - size + 1):
            places.setdefault(tuple(w[i : i + size]), []).append(i)
        mask = [False] * len(w)
        for r, at in places.items():
            apart = all(j - i >= size for i, j in zip(at, at[1:]))
            for i in at if r in seen else at[1:] if apart else ():
                mask[i : i + size] = [True] * size
        seen |= set(places)
        gone.append(mask)
    return gone


def test_passages_within_sentences_are_brute_force(spark):
    rng = random.Random(14)
    long = [words(rng, n, 5000) for n in (51, 60, 75, 130, 300)]
    two = words(rng, 30, 5000)
    two[-1] += "."
    two += words(rng, 31, 5000)
    texts = []
    for k in range(60):  # at other offsets within a sentence each time; 50 words of a passage are too few
        p = (*long, two, long[0][:50])[k % 7]
        texts.append(" ".join([*words(rng, rng.randrange(45), 5000), *p, *words(rng, rng.randrange(45), 5000)]) + ".")
    part = long[4]
    texts += [" ".join(words(rng, 7, 5000) + part[a : a + n]) for a, n in ((3, 51), (100, 50), (140, 80), (249, 51))]
    texts += [" ".join(part + words(rng, 5, 5000) + part), *ODD]
    gone = brute_passages(texts)
    got = span_dedup.remove_repeats(docs_of(spark, texts).repartition(3)).toPandas().set_index("doc_id").sort_index()
    for k, t in enumerate(texts):
        if not any(gone[k]):
            assert k >= 60 or got.text[k] == t
            continue
        left = [w for w, g in zip(t.split(), gone[k]) if not g]
        # spans of sentences may remove more, never less
        assert len(got.text[k].split()) <= len(left) and got.n_removed[k] > 0
        if k < 60:
            assert got.text[k].split() == left
    assert sum(map(any, gone)) > 45
    assert (got.n_removed[[k for k in range(60) if k % 7 == 6]] == 0).all()


# -- 10


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>one</p>", "<p>one</p>", None, "", "é" * 10, "x\r\n\r\ny", "<p>one</p>", "z" * 200_000]
    rows = [(i if i != 4 else None, None if i == 3 else f"http://h/{i}\n", t, "x") for i, t in enumerate(html)]
    pages = spark.createDataFrame([*rows, rows[6]], "page_id long, url string, html string, digest string")
    manifest = warc.write_archive(pages, str(tmp_path / "w"))
    got = warc.read_archive(spark, manifest).collect()
    assert len(got) == 9
    for r in got:
        want = (html[r.page_id] if r.page_id is not None else html[4]) or ""
        assert r.payload_bytes == len(want.encode()) and r.payload_digest == warc.payload_digest(want.encode())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == want.encode()
    kinds = sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to) for r in got)
    assert kinds == [(-1, "response", None), (0, "revisit", 6), (1, "revisit", 6), (2, "revisit", 3), (3, "response", None), (5, "response", None), (6, "response", None), (6, "response", None), (7, "response", None)]
    path = manifest.first().path
    with open(path.removeprefix("file:"), "rb") as f:
        data = f.read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == warc.DICTIONARY_MAGIC and size > 0
    with pytest.raises(ValueError):
        list(warc.frames(memoryview(data[:-3])))
    assert warc.archive_digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    small = warc.read_archive(spark, warc.write_archive(pages, str(tmp_path / "v"), min_payload=11)).where("record_type = 'revisit'")
    assert small.count() == 0


# -- the pipeline


def test_pipeline_stages(spark, sf, tmp_path):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, sf)
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if k < len(P.STAGES) - 1:
            assert after.columns == docs.columns
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        assert ids <= set(before)
        if name == "jaccard_join":
            order = sorted(before)
            sets = dict(zip(order, common.shingle_sets(pa.array([before[i] for i in order]))))
            links = [(i, j) for i, j in combinations(range(len(order)), 2) if near_dedup.linked(sets[order[i]], sets[order[j]])]
            assert ids == {order[c] for c in components(len(order), links)}
        if name == "substring_dedup":
            assert ids == set(before)
            order = sorted(before)
            gone = brute_spans([before[i] for i in order])[1]
            changed = {r.doc_id for r in after.collect() if r.text != before[r.doc_id]}
            assert changed <= {i for i, g in zip(order, gone) if g}
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            assert ids == {i for i, t in before.items() if not any(q in t for q in items)}
        if name == "byte_bpe":
            assert all(r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest() for r in after.collect())
        docs = after


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", f.__name__)[1]) for f in QUERIES) == list(range(1, 11))
