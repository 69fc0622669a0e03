"""Methods against plain restatements, and operators and stages on odd tables."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from sigmill.llm import byte_bpe, common, decontaminate, embedding_dedup, hashed_text, language, license_scan, near_dedup, quality, span_dedup, toxicity, warc
from sigmill.llm.queries import vocabulary_path

# -- 2


def plain_template(text, names):
    """(kind or word, token in lower case) of each token, by a loop."""
    out, number_ends = [], None
    for m in regex.finditer(r"\p{N}+(?:[.,:/]\p{N}+)*|[\p{L}\p{M}]+|[%$€£]", text):
        t = m[0]
        if regex.match(r"\p{N}", t):
            kind = "0"
        elif t in "%$€£":
            kind = "1"
        elif names and regex.match(r"\p{Lu}", t):
            kind = "2"
        elif t.lower() in decontaminate.UNITS and number_ends is not None and text[number_ends : m.start()] in ("", " "):
            kind = "1"
        else:
            kind = t.lower()
        number_ends = m.end() if kind == "0" else None
        out.append((kind, t.lower()))
    return out


def plain_leaks(texts, items):
    """The best copy of each item in each text by loops over all places."""
    found = {}
    for i, item in items.items():
        for d, text in texts.items():
            best = None
            wordy = 0
            for names in (True, False):
                a, b = plain_template(item, names), plain_template(text, names)
                starts = [s for s in range(len(a) - 7) if sum(k not in "012" for k, _ in a[s : s + 8]) >= 5]
                wordy += len(starts)
                by_diagonal = defaultdict(list)
                for s in starts:
                    for t in range(len(b) - 7):
                        if [k for k, _ in a[s : s + 8]] == [k for k, _ in b[t : t + 8]]:
                            by_diagonal[t - s].append(s)
                for diagonal, at in by_diagonal.items():
                    slots = {(k, was, b[s + x + diagonal][1]) for s in at for x, (k, was) in enumerate(a[s : s + 8]) if k in "012"}
                    if len(at) >= min(6, len(starts)) and len(slots) == len({s[:2] for s in slots}):
                        copy = (len(at), len(slots), -sum(w != n for _, w, n in slots), -diagonal, round(len(at) / len(starts), 6))
                        best = max(best, copy) if best else copy
            if best:
                found[d, i] = (best[0], best[4], best[1], -best[2])
            elif not wordy:
                a, b = ([t for _, t in plain_template(x, False)] for x in (item, text))
                if a and (a == b if len(a) < decontaminate.WITHIN else any(b[t : t + len(a)] == a for t in range(len(b)))):
                    found[d, i] = (1, 1.0, 0, 0)
    return found


def test_decontamination_is_brute_force(spark):
    rng = random.Random(12)
    names, things = ["Anna", "Berta", "Carl", "Paris", "Rome"], "red pens from the small shop near old town and then gives half of all to some friend who lives there".split()

    def question():
        out = []
        for _ in range(rng.randrange(9, 26)):
            out.append(rng.choice([*things, *things, rng.choice(names), str(rng.randrange(5)), f"{rng.randrange(9)} km", "%"]))
        return " ".join(out) + rng.choice(["", ".", "?"])

    items = {k: question() for k in range(12)}
    items |= {20: "Compute 12 + 7 - 3 and then 8 + 9 - 4 and 15 + 6 - 2", 21: "Who wrote the old book?", 22: "3 + 4 = 7", 23: "yes", 24: "a b", 25: "", 26: "7 8 9 1 2 3 4 5 6 7 8 9"}
    texts = {}
    for k in range(60):
        t = items[rng.randrange(12)]
        how = rng.randrange(6)
        if how == 1:
            t = t.upper()
        elif how == 2:
            t = regex.sub(r"\d+", lambda m: str(int(m[0]) + 5), t).replace("Anna", "Dora").replace("Rome", "Oslo")
        elif how == 3:
            t = regex.sub(r"\d+", lambda m: str(rng.randrange(100)), t)
        elif how == 4:
            w = t.split()
            w[rng.randrange(len(w))] = "other"
            t = " ".join(w)
        elif how == 5:
            t = t[rng.randrange(30) :]
        texts[k] = f"{question()} {t} {question()}" if rng.random() < 0.7 else t
    texts |= {100: f"Then {items[20]} again", 101: "He asked who wrote THE OLD BOOK, I think", 102: "so 3 + 4 = 7 holds", 103: "Yes!", 104: "yes and no", 105: "", 106: items[26] + " 1", 107: "3+4 = 7!"}
    rows = [(d, t, 1) for d, t in texts.items()] + [(None, items[0], 1), (200, None, 1)]
    bench = spark.createDataFrame([(i, t) for i, t in items.items()] + [(None, items[0]), (99, None)], "item_id long, text string")
    got = decontaminate.leaks(spark.createDataFrame(rows, "doc_id long, text string, item_id int"), bench, any_case=True).collect()
    assert {(r.doc_id, r.item_id): (r.n_windows, r.share, r.n_slots, r.n_changed) for r in got} == plain_leaks(texts, items)
    found = {(r.doc_id, r.item_id) for r in got}
    assert {(100, 20), (101, 21), (107, 22), (103, 23), (106, 26)} <= found and not {(104, 23), (102, 22)} & found


def test_decontamination_by_shuffle_is_the_same(spark, monkeypatch):
    item = "A train with 3 wagons leaves Paris at noon and travels 120 km in 2 hours before meeting Anna and her 3 friends near Paris again today."
    docs = spark.createDataFrame([(0, f"x {item}"), (1, item.lower()), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, "who wrote the book")], "item_id long, text string")
    want = sorted(decontaminate.leaks(docs, bench, any_case=True).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    assert sorted(decontaminate.leaks(docs, bench, any_case=True).collect()) == want and len(want) == 2


# -- 5, 8


def sample_of(rng, n, buckets, labels):
    rows = [rng.integers(0, buckets, rng.integers(1, 12)) for _ in range(n)]
    sizes = [len(r) for r in rows]
    return hashed_text.Sample(np.cumsum([0, *sizes]), np.concatenate(rows), np.ones(sum(sizes), np.uint8), 1 / np.array(sizes, float), np.array(labels, float))


def test_ordinal_training_climbs_the_likelihood():
    rng = np.random.default_rng(3)
    s = sample_of(rng, 200, 64, rng.integers(0, 4, 200))
    m = quality.train(s, buckets=64, epochs=400)

    def likelihood(w, cuts):
        x = np.array([quality.SCALE * w[s.ids[a:b]].mean() for a, b in zip(s.starts[:-1], s.starts[1:])])
        p = quality.Model(m.grades, w, cuts).distribution(x)
        return np.log(p[np.arange(len(x)), np.searchsorted(m.grades, s.labels)]).mean()

    here = likelihood(m.weights, m.thresholds)
    assert (np.diff(m.thresholds) > 0).all() and here > likelihood(np.zeros(64), m.thresholds)
    # at a maximum the numeric gradient vanishes, but for the small pull to zero and the last steps
    for k in range(0, 64, 7):
        e = np.zeros(64)
        e[k] = 1e-4
        assert abs(likelihood(m.weights + e, m.thresholds) - likelihood(m.weights - e, m.thresholds)) / 2e-4 < 0.02
    for k in range(3):
        e = np.zeros(3)
        e[k] = 1e-4
        assert abs(likelihood(m.weights, m.thresholds + e) - likelihood(m.weights, m.thresholds - e)) / 2e-4 < 0.02


def test_grades_are_a_plain_sum():
    rng = np.random.default_rng(4)
    m = quality.Model(np.array([0.0, 1.0, 2.0]), rng.normal(size=quality.BUCKETS), np.array([-0.5, 0.7]))
    texts = ["One two two, three!", "", "ein Wort", None, "x" * 3000]
    for t, p in zip(texts, quality.predict(texts, m)):
        ids, n = hashed_text.text_features(t, quality.BUCKETS, hashed_text.word_grams)
        x = quality.SCALE * (m.weights[ids] * n).sum() / max(n.sum(), 1)
        below = 1 / (1 + np.exp(-(m.thresholds - x)))
        assert np.allclose(p, [below[0], below[1] - below[0], 1 - below[1]], atol=1e-6)


def test_word_features_tell_words():
    f = lambda t: set(hashed_text.text_features(t, 1 << 30, hashed_text.word_grams)[0].tolist())
    assert f("good text") != f("evil text") and f("a b") != f("b a")
    total, count = hashed_text.text_sums(["good text", "a b\nc", "good text"], np.arange(1 << 12, dtype=float), hashed_text.word_grams)
    assert total[0] == total[2] and count[0] == count[2]


def test_toxicity_scores_are_averaged_vectors():
    rng = np.random.default_rng(5)
    m = toxicity.Model(rng.normal(size=(toxicity.BUCKETS, 4)) / 50, rng.normal(size=(4, 2)), np.array([0.1, -0.2]))
    texts = ["You idiot, you IDIOT!", "a fine day", "", None, "Grüße 🎉 x1"]
    got = toxicity.score_texts(texts, m.weights(), m.offset())
    for t, s in zip(texts, got):
        ids, n = hashed_text.text_features(hashed_text.distinct_words(t), toxicity.BUCKETS, hashed_text.subword_grams)
        mean = toxicity.SCALE * (m.vectors[ids] * n[:, None]).sum(0) / (n.sum() + toxicity.PRIOR)
        logit = mean @ m.softmax + m.bias
        assert np.isclose(s, np.exp(logit[1]) / np.exp(logit).sum(), atol=1e-6)


def test_toxicity_training_separates():
    rng = np.random.default_rng(6)
    labels = rng.integers(0, 2, 300)
    s = sample_of(rng, 300, 256, labels)
    s.ids[s.starts[:-1]] = np.where(labels > 0, 7, 9)  # one telling feature each
    m = toxicity.train(s, buckets=256, width=4, steps=200)
    w = m.weights()
    margin = np.array([w[s.ids[a:b]].mean() for a, b in zip(s.starts[:-1], s.starts[1:])]) + m.offset()
    assert ((margin > 0) == (labels > 0)).mean() > 0.97


# -- components


def test_components_of_hubs_and_chains(spark):
    rng = random.Random(2)
    edges = [(0, k) for k in range(1, 1500)] + [(k, k + 1) for k in range(2000, 2300)] + [(9000, 9000)] + [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(90)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1]}
    with pytest.raises(RuntimeError):
        common.connected_components(spark.createDataFrame([(k, k + 1) for k in range(200)], "a long, b long"), rounds=1)


def test_components_at_once_are_those_of_the_rounds(spark):
    rng = random.Random(4)
    edges = [(5, k) for k in range(6, 300)] + [(k, k + 1) for k in range(2000, 2300)] + [(9000, 9000), (-3, 7), (2300, 1)] + [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(90)]
    table = spark.createDataFrame(edges, "a long, b long")
    got = common.connected_components(table, at_once=1000)
    rounds = common.connected_components(table, at_once=10)
    assert got.dtypes == rounds.dtypes == [("id", "bigint"), ("component", "bigint")]
    assert sorted(got.collect()) == sorted(rounds.collect())
    ids, least = common.least_reached(np.arange(1, 5000), np.arange(4999))
    assert ids.tolist() == list(range(5000)) and not least.any()


def test_few_links_take_few_jobs(spark):
    """What the driver keeps of each job adds up over a pipeline."""
    texts = [f"{'a b c d e f g h i j k l m n o p q r s t u v w x y z ' * 2}{k // 2} {k}" for k in range(40)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.sparkContext.setJobGroup("few-links", "")
    try:
        assert {r.component_id for r in near_dedup.jaccard_components(documents).collect()} == {0}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-links")) < 100
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_toxicity_learns_in_little_memory():
    """No array with a row of the vectors for each feature of a batch, nor a running sum over all features of the sample."""
    rng = np.random.default_rng(5)
    n, each = 256, 4000
    labels = (np.arange(n) % 2).astype(float)
    s = hashed_text.Sample(np.arange(n + 1) * each, rng.integers(0, 512, n * each).astype("<u2"), np.ones(n * each, np.uint8), np.full(n, 1 / each), labels)
    tracemalloc.start()
    try:
        toxicity.train(s, buckets=512, steps=2)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 8 * 8 * 128 * each  # a row of eight doubles for each feature of a batch


# -- 1


def test_jaccard_with_hot_shingles_and_parts(spark, monkeypatch):
    """Frequent shingles, and groups in several parts, change the way and not the result."""
    monkeypatch.setattr(near_dedup, "HELD", 3)
    monkeypatch.setattr(near_dedup, "ASKED", 4)
    monkeypatch.setattr(near_dedup, "SEEN", 1)
    monkeypatch.setattr(near_dedup, "HOT", 500)
    rng = random.Random(3)
    common_part = [f"c{k}" for k in range(40)]
    texts = []
    for k in range(120):
        own = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 16))]
        texts.append(" ".join(common_part[: rng.choice([0, 30, 40])] + own))
    texts += texts[:20]
    got = {r.doc_id: r.component_id for r in near_dedup.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    sets = list(common.shingle_sets(pa.array(texts)))
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near_dedup.linked(sets[i], sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert [got[i] for i in range(len(texts))] == root
    with pytest.raises(TypeError):
        near_dedup.jaccard_components(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_most_frequent_is_bounded(spark):
    d = spark.createDataFrame([(k, k % 97 + 1) for k in range(1000)], "token long, n long")
    top = near_dedup.most_frequent(d, 100).toPandas()
    rest = {k for k in range(1000)} - set(top.token)
    assert 0 < len(top) <= 100 and top.n.min() > max(k % 97 + 1 for k in rest)
    assert near_dedup.most_frequent(d.limit(0), 5).count() == 0


# -- odd tables

ODD_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, id long, rep long, h1 long, th int, s int, e int, own boolean, span boolean, spans int, passages int, _id long, _th long, _spans string, _passages string, "
    "score double, predicted long, n_sentences long, n_removed long, at int, w string, h long, token long, n_tokens long, k long, _bpe_codes string, label double, page_id long, a int, b int, task string, held boolean"
)


@pytest.fixture(scope="module")
def odd(spark):
    passage = " ".join(f"word{k}" for k in range(70)) + "."
    texts = [None, "", " \n", "one", passage, f"Before it. {passage} After it.", "y " * 20_000 + passage, "ALL the same words here and there", "ALL the same words here and there", "日本語 🎉"]
    ids = [0, 1, 2, 3, 4, 5, 6, 7, 7, None]
    fields = [f.split() for f in ODD_SCHEMA.split(", ")][2:]
    fill = {"string": "c", "boolean": True, "double": 42.0}
    rows = [(i, t, *(fill.get(kind, 7) if i != 3 else None for _, kind in fields)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def test_operators_on_odd_columns(spark, odd):
    n, bench = odd.count(), spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", 3)], "item_id long, text string, doc_id long")
    labels = spark.createDataFrame([(0, 1, 1), (4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    for d, rows in ((odd, n), (odd.limit(0), 0)):
        assert near_dedup.jaccard_components(d).count() == rows
        assert license_scan.license_scan(d).count() == rows
        assert decontaminate.leaks(d, bench, any_case=True).count() == 0
        assert decontaminate.remove_leaks(d, bench, any_case=True).columns == odd.columns
        assert quality.quality(d, labels).count() == toxicity.toxicity(d, labels).count() == language.language_id(d).count() == rows
        assert byte_bpe.round_trip(d, vocabulary_path(), "lang").count() == rows
        kept = span_dedup.remove_repeats(d, counts=tuple(common.unused(d, "n_sentences", "n_removed")))
        assert kept.count() == rows and kept.columns[: len(odd.columns)] == odd.columns
        pages = d.select(F.col("doc_id").alias("page_id"), F.col("text").alias("html"), F.lit("u").alias("url"), "digest" if "digest" in d.columns else F.lit("z").alias("digest"), "h", "k")
        assert warc.archive_digest(pages).count() == rows
        vectors = d.select(F.col("doc_id").alias("vec_id"), F.when(F.col("doc_id") > 2, F.array(F.lit(1.0), F.col("doc_id").cast("double"))).alias("embedding"), "id", "rep", "at", "a", "b", "task")
        assert embedding_dedup.embedding_dedup(vectors).count() == rows
    gone = {r.doc_id: r.text for r in span_dedup.remove_repeats(odd).collect()}
    assert gone[4].startswith("word0") and gone[5] == "Before it. After it." and gone[6].strip(" y") == "" and gone[0] is None


def test_stages_on_odd_columns(spark, odd, tmp_path):
    pytest.importorskip("corpus_pipeline")
    import corpus_pipeline as P

    spark.createDataFrame([(0, 0, 1), (4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda d: sorted((repr(r.doc_id), r.score, r.predicted, r.n_sentences, r.n_removed, r._spans) for r in d.collect())
    for rows in (odd, odd.limit(0)):
        for k, (name, stage) in enumerate(P.STAGES):
            out = stage(spark, rows, str(tmp_path))
            if k < len(P.STAGES) - 1:
                assert out.schema == odd.schema or out.columns == odd.columns
                assert set(key(out)) <= set(key(rows)), name
            if name == "jaccard_join" and rows is odd:
                assert sorted(str(r.doc_id) for r in out.collect()) == ["0", "1", "2", "3", "4", "7", "7", "None"]  # 5 and 6 are like 4
            if name in ("substring_dedup", "byte_bpe"):
                assert out.count() == rows.count()
