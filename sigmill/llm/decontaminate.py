"""Benchmark decontamination by template canonicalisation, in DataFrame functions throughout.

Numbers, names and units become typed placeholders, so that a question asked again with other
parameters has the same template. Windows of WINDOW tokens of both templates are joined by hash;
matches on one diagonal (document place less item place) are one aligned copy, and its slots must be
consistent: each value of the item stands for one value of the document throughout.

A name is any capitalised word, wherever it stands, so that a text's template does not depend on
what is around it. A copy in another case has other capitals; texts can therefore be read without
names as well, and copies are searched in each reading.

Few documents have any matching window, and these are found first by a sparser join: every run of
WINDOW tokens holds one of the ANCHOR-token runs that begin at each STRIDE-th token, so a document
none of whose sparse runs is anywhere in the benchmark's windows has no matching window either.

Items without a window that has enough words (short ones, and those made of numbers) are searched
as they are, by all their tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize

#: Tokens of a window, and how many of them must be words rather than placeholders.
WINDOW, LITERALS = 8, 5
#: Tokens of a sparse run, and of the step between them: a window holds at least one.
ANCHOR, STRIDE = 5, 4
#: A copy counts from so many matching windows (13 tokens), or all windows of a shorter item.
MATCHES = 6
#: An item that is searched as it is must have so many tokens to be found within a text; a shorter one is a copy only where it is the whole text.
WITHIN = 4
#: Bytes of the benchmark's windows up to which they are broadcast.
BROADCAST_BYTES = 32 << 20

# Units that are replaced where they follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds "
    "oz ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days "
    "week weeks month months year years cent cents dollar dollars euro euros usd eur percent degree degrees mph kmh watt watts volt volts"
).split()

_TOKEN = r"\p{N}+(?:[.,:/]\p{N}+)*|[\p{L}\p{M}]+|[%$€£]"
_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
_NAME = r"(?<![\p{L}\p{M}])\p{Lu}[\p{L}\p{M}]*"
_UNIT = r"(?<= 0 {1,2})(?:" + "|".join(sorted(UNITS, key=lambda u: (-len(u), u))) + r")(?![\p{L}\p{M}])|[%$€£]"


def _marked(text: Column) -> Column:
    """Lower-case text with 0 for each number, and 2 before each name."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, _NUMBER, " 0 "), _NAME, "2$0"))


def _template(marked: Column, names: bool) -> Column:
    out = F.regexp_replace(marked, r"2[\p{L}\p{M}]+", "2") if names else F.translate(marked, "2", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, _UNIT, " 1 "), r"[^\p{L}\p{M}012]+", " "))


def template(text: Column, names: bool = True) -> Column:
    """Canonical tokens separated by single spaces, one for each token of ``tokens``: lower-case words, or 0 for a number, 1 for a unit, 2 for a name (with ``names``)."""
    return _template(_marked(text), names)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def raw_tokens(text: Column) -> Column:
    """The tokens as they are, in lower case, separated by single spaces."""
    return F.lower(F.array_join(tokens(text), " "))


def windows(spaced: Column, size: int = WINDOW) -> Column:
    """Every run of ``size`` tokens, by the place of its first."""
    return F.regexp_extract_all(spaced, F.lit(rf"(?<![^ ])(?=([^ ]+(?: [^ ]+){{{size - 1}}})(?![^ ]))[^ ]+"), F.lit(1))


def anchors(spaced: Column) -> Column:
    """The runs of ANCHOR tokens that begin at each STRIDE-th token."""
    return F.regexp_extract_all(spaced, F.lit(rf"(?=([^ ]++(?: [^ ]++){{{ANCHOR - 1}}}))(?:[^ ]++ ){{{STRIDE}}}"), F.lit(1))


def read_windows(df: DataFrame, text: str, at: str, any_case: bool) -> DataFrame:
    """``df`` without the text, with a row for each window: its place, w, the tokens as they are, and the readings that have it (1 with names, 2 without, 3 both)."""
    rest = [c for c in df.columns if c != text]
    marked = df.withColumn("_marked", _marked(F.col(text)))
    read = [windows(_template(F.col("_marked"), names)).alias(n) for names, n in ((True, "a"), (False, "b"))[: 1 + any_case]]
    rows = marked.select(*rest, F.posexplode(F.arrays_zip(windows(raw_tokens(F.col(text))).alias("raw"), *read)).alias(at, "_w"))
    if not any_case:
        return rows.select(*rest, at, F.col("_w.raw").alias("raw"), F.col("_w.a").alias("w"), F.lit(1).alias("reading"))
    one, two = (F.struct(F.col(f"_w.{k}").alias("w"), F.lit(r).alias("reading")) for k, r in (("a", 1), ("b", 2)))
    both = F.struct(F.col("_w.a").alias("w"), F.lit(3).alias("reading"))
    return rows.select(*rest, at, F.col("_w.raw").alias("raw"), F.inline(F.when(F.col("_w.a") == F.col("_w.b"), F.array(both)).otherwise(F.array(one, two))))


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table of narrow keys, broadcast if it is small."""
    return F.broadcast(df) if df.count() <= rows else df


def _candidates(docs: DataFrame, items: DataFrame, any_case: bool) -> DataFrame:
    """``docs`` (doc_id, text) whose sparse runs meet the items' windows."""
    runs = items.select(F.explode(windows(F.col("w"), ANCHOR)).alias("run")).select(F.xxhash64("run").alias("h")).distinct()
    runs = _small(materialize(runs, "benchmark-runs"))
    marked = docs.withColumn("_marked", _marked(F.col("text")))
    read = marked.select("doc_id", _template(F.col("_marked"), True).alias("a"), *([_template(F.col("_marked"), False).alias("b")] if any_case else []))
    found = anchors(F.col("a"))
    if any_case:
        found = F.when(F.col("a") == F.col("b"), found).otherwise(F.concat(found, anchors(F.col("b"))))
    hit = read.select("doc_id", F.explode(found).alias("run")).select("doc_id", F.xxhash64("run").alias("h")).join(runs, "h", "left_semi").select("doc_id").distinct()
    return docs.join(_small(materialize(hit, "candidates")), "doc_id", "left_semi")


def _whole(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) of the items (item_id, item_raw; at least one) whose tokens stand in a document as they are."""
    size = F.size(F.split("item_raw", " "))
    keyed = items.withColumn("k", F.least(size, F.lit(WINDOW))).withColumn("key", F.when(F.col("k") < WITHIN, F.col("item_raw")).otherwise(F.array_join(F.slice(F.split("item_raw", " "), 1, F.col("k")), " ")))
    keyed = materialize(keyed, "benchmark-whole")
    found = None
    read = docs.withColumn("raw", raw_tokens(F.col("text")))
    for k in sorted(r.k for r in keyed.select("k").distinct().collect()):  # WINDOW sizes at most
        own = keyed.where(F.col("k") == k).select(F.col("key").alias("run"), "item_id", "item_raw")
        if k < WITHIN:
            pairs = read.join(_small(own, 100_000), read["raw"] == own["run"]).select("doc_id", "item_id")
        else:
            hits = read.select("doc_id", F.explode(windows(F.col("raw"), k)).alias("run")).join(_small(own, 100_000), "run").select("doc_id", "item_id", "item_raw").distinct()
            padded = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
            pairs = hits.join(read.select("doc_id", "raw"), "doc_id").where(F.contains(padded(F.col("raw")), padded(F.col("item_raw")))).select("doc_id", "item_id")
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", any_case: bool = False) -> DataFrame:
    """The contaminated pairs (doc_id, item_id) with matching windows, their share of the item's, slots and changed slots of the best copy.

    The best copy has most windows, then most slots, then least changed ones, then stands first; all
    figures are that copy's. Null and empty texts match nothing, on either side, and rows with a null
    id are not compared. Rows that repeat an id are one document, or one item. Very long texts are
    read whole. Empty tables give an empty result; other columns are not read. An item without a
    window of enough words is found where its tokens stand as they are, in any case (one window, no
    slots); with fewer than WITHIN tokens only where it is the whole text. With ``any_case`` copies
    of the other items in another case are found too. The benchmark's windows are broadcast if their
    bytes are few, and shuffled by hash beyond.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    bench = benchmark.select(benchmark["item_id"].alias("item_id"), benchmark["text"].alias("item_text")).where("item_id IS NOT NULL AND item_text IS NOT NULL")
    items = (
        read_windows(bench, "item_text", "item_at", any_case)
        .withColumnsRenamed({"reading": "item_reading", "raw": "item_raw"})
        .where(F.size(F.filter(F.split("w", " "), lambda t: ~t.isin("0", "1", "2"))) >= LITERALS)
        .dropDuplicates(["item_id", "item_at", "w", "item_reading"])
    )
    # Written once: it is read several times, and its filter would be inferred for the documents' windows too.
    items = materialize(items, "benchmark-windows")
    readings = F.explode(F.filter(F.array(F.lit(1), F.lit(2)), lambda r: F.col("readings").bitwiseAND(r) != 0)).alias("reading")
    sizes = items.select("item_id", "item_at", F.col("item_reading").alias("readings")).select("item_id", "item_at", readings).groupBy("item_id", "reading").agg(F.countDistinct("item_at").alias("n_item"))
    held = items.agg(F.coalesce(F.sum(F.octet_length("w") + F.octet_length("item_raw") + 64), F.lit(0))).first()[0]
    keyed = items.withColumn("h", F.xxhash64("w"))
    if few := held <= BROADCAST_BYTES:
        keyed, sizes = F.broadcast(keyed), F.broadcast(sizes)
    found = (
        read_windows(_candidates(docs, items, any_case), "text", "at", any_case)
        .withColumn("h", F.xxhash64("w"))
        .join(keyed, ["h", "w"])
        .select(
            "doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal"), "item_at", F.split("w", " ").alias("kinds"), F.split("item_raw", " ").alias("was"), F.split("raw", " ").alias("now"),
            F.col("reading").bitwiseAND(F.col("item_reading")).alias("readings"),
        )
    )
    slots = F.filter(F.arrays_zip(F.col("kinds").alias("kind"), "was", "now"), lambda s: s["kind"].isin("0", "1", "2"))
    copies = (
        found.select("doc_id", "item_id", "diagonal", "item_at", slots.alias("slots"), readings)
        .groupBy("doc_id", "item_id", "diagonal", "reading")
        .agg(F.countDistinct("item_at").alias("n_windows"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    )
    consistent = F.size("slots") == F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["was"]))))
    good = (
        copies.where(consistent)
        .join(sizes, ["item_id", "reading"])
        .where(F.col("n_windows") >= F.least(F.lit(MATCHES), "n_item"))
        .select(
            "doc_id", "item_id", "diagonal", F.col("n_windows").cast("long").alias("n_windows"), F.round(F.col("n_windows") / F.col("n_item"), 6).alias("share"),
            F.size("slots").cast("long").alias("n_slots"), F.size(F.filter("slots", lambda s: s["was"] != s["now"])).cast("long").alias("n_changed"),
        )
    )
    order = F.struct("n_windows", "n_slots", -F.col("n_changed"), -F.col("diagonal"))
    best = good.groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_windows", "share", "n_slots", "n_changed"), order).alias("best")).select("doc_id", "item_id", "best.*")
    rest = bench.select("item_id", raw_tokens(F.col("item_text")).alias("item_raw")).where("item_raw <> ''").join(items.select("item_id").distinct(), "item_id", "left_anti").distinct()
    rest = materialize(rest, "benchmark-rest")
    if rest.isEmpty():
        return best
    one = _whole(docs, rest).select("doc_id", "item_id", F.lit(1).cast("long").alias("n_windows"), F.lit(1.0).alias("share"), F.lit(0).cast("long").alias("n_slots"), F.lit(0).cast("long").alias("n_changed"))
    return best.union(one)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", any_case: bool = False) -> DataFrame:
    """``docs`` without the contaminated documents; rows with a null id are never equal to one and stay."""
    bad = leaks(docs, benchmark, id_col, text_col, any_case).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(bad, id_col, "left_anti")
