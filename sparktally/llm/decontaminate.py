"""Benchmark decontamination: a broadcast hash set of test n-grams, against which all windows of training words are held."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from sparktally.llm.common import carried, settle

#: Words of a window.
WORDS = 10
#: What stands between words: ASCII that is no letter and no digit.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Hashes that one broadcast set holds at most, about 100 MB; a larger set is
#: cut into slices, and each slice is held against the documents in a pass of its own.
SET_ROWS = 2_000_000


def words_of(text: Column) -> Column:
    """The words of a text as they are written; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")


def _normal(words: Column) -> Column:
    """The words joined by a space, A-Z in lower case; no word holds a space."""
    return F.translate(F.array_join(words, " "), string.ascii_uppercase, string.ascii_lowercase)


def _word_hashes(words: Column) -> Column:
    """One hash per word.  Words that are equal with A-Z lower-cased have equal hashes.

    `lower` folds more letters than A-Z, in much less time; what it folds too
    much is found out when a hit is verified.
    """
    return F.transform(words, lambda w: F.xxhash64(F.lower(w)))


def _window_hashes(hashes: Column, width: Column) -> Column:
    """A hash of every window of `width` words, in their order."""
    last = F.size(hashes) - width + 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(hashes, i, width)))
                  ).otherwise(F.array().cast("array<bigint>"))


def benchmark_grams(benchmark: DataFrame, words: int = WORDS) -> DataFrame:
    """item, gram, width, hash of every distinct window of an item's words.

    An item of fewer words, but not none, is one window of all its words.  `item` is
    the item's id as text; items without an id are one item called 'null'.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    rows = benchmark.select(item.alias("item"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    width = F.least(F.size("words"), F.lit(words))
    rows = rows.select("item", "words", width.alias("width"), _word_hashes(F.col("words")).alias("hashes"))
    rows = rows.select("item", "words", "width", F.posexplode(_window_hashes(F.col("hashes"), F.col("width"))
                                                             ).alias("at", "hash"))
    return rows.select("item", _normal(F.slice("words", F.col("at") + 1, F.col("width"))).alias("gram"),
                       "width", "hash").distinct()


def _scan(docs: DataFrame, hashes: DataFrame, widths: list[int]) -> DataFrame:
    """doc_id, text_hash, n_words, start, width, gram of every window whose hash is in the set.

    Each row of `docs` also gives one row with width 0.  Words are split
    once; windows are listed by hash alone, and the text of a window is built
    only where its hash was met.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))
    rows = rows.select("*", F.size("words").alias("n_words"), _word_hashes(F.col("words")).alias("hashes"))
    listed = F.concat(F.array(F.lit(None).cast("bigint")),
                      *[_window_hashes(F.col("hashes"), F.lit(w)) for w in widths])
    rows = rows.select("doc_id", "text_hash", "words", "n_words", F.posexplode(listed).alias("at", "hash"))
    known = F.broadcast(hashes.select("hash", F.lit(True).alias("known")))
    met = rows.join(known, "hash", "left").where((F.col("at") == 0) | F.col("known"))
    # Place 0 is the document itself; the windows of each width follow one another.
    start, width, before = F.lit(0), F.lit(0), F.lit(1)
    for w in widths:
        start, width = (F.when(F.col("at") >= before, F.col("at") - before).otherwise(start),
                        F.when(F.col("at") >= before, w).otherwise(width))
        before = before + F.greatest(F.col("n_words") - w + 1, F.lit(0))
    met = met.select("doc_id", "text_hash", "n_words", "words", start.alias("start"), width.alias("width"))
    gram = F.when(F.col("width") > 0, _normal(F.slice("words", F.col("start") + 1, F.col("width"))))
    return met.select("doc_id", "text_hash", "n_words", "start", "width", gram.alias("gram"))


def _merged(windows: Column) -> Column:
    """Overlapping or touching [start, end) windows as spans, ascending."""
    span = "array<struct<start:int,end:int>>"

    def add(spans: Column, w: Column) -> Column:
        last = F.element_at(spans, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], w["end"]).alias("end"))
        return (F.when(F.size(spans) == 0, F.array(w))
                .when(w["start"] <= last["end"],
                      F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(longer)))
                .otherwise(F.concat(spans, F.array(w)))).cast(span)

    return F.aggregate(F.sort_array(windows), F.array().cast(span), add)


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, set_rows: int = SET_ROWS) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items, spans of every row of `docs`.

    A word inside any occurrence of a benchmark window is hit; `spans` are the
    hit words as [start, end) word numbers, `items` the ids of the items with a
    window in the document, as text, ascending.  Documents are never
    shuffled: a task holds their windows against a broadcast set of hashes.
    Only windows whose hash was met travel, as text; equality of that text with
    a window of the benchmark decides.  The set is broadcast in slices of about
    `set_rows` hashes, one pass over the documents each, whatever the
    benchmark's size.  Null and empty texts have no words; a benchmark without
    words hits nothing.  Repeated rows each have their row, null ids and equal
    ids with different texts are kept apart by the text.
    """
    grams = settle(benchmark_grams(benchmark, words))
    hashes = settle(grams.select("hash").distinct())
    widths = sorted((r.width for r in grams.select("width").distinct().collect()), reverse=True)  # `words` at most
    slices = max(1, -(-hashes.count() // set_rows))
    met = None
    for k in range(slices):
        part = hashes.where(F.pmod("hash", F.lit(slices)) == k) if slices > 1 else hashes
        one = settle(_scan(docs, part, widths))
        one = one if k == 0 else one.where("width > 0")
        met = one if met is None else met.unionAll(one)
    key = ["doc_id", "text_hash"]
    hits = met.where("width > 0")
    # One row per distinct window, so a window of a third of all documents is
    # a skewed join that Spark splits.
    texts = settle(grams.select("gram").distinct())
    hits = settle(hits.join(texts, "gram").select(*key, "start", "width", "gram"))
    listed = hits.select(*key, "gram").distinct().join(grams.select("gram", "item"), "gram").select(*key, "item").distinct()
    none = F.lit(None)
    window = F.struct("start", (F.col("start") + F.col("width")).alias("end"))
    parts = (met.where("width = 0").select(*key, "n_words", F.lit(1).alias("rows"),
                                           none.cast("struct<start:int,end:int>").alias("window"),
                                           none.cast("string").alias("item"))
             .unionAll(hits.select(*key, none.cast("int"), F.lit(0), window, none.cast("string")))
             .unionAll(listed.select(*key, none.cast("int"), F.lit(0), none.cast("struct<start:int,end:int>"), "item")))
    found = parts.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"), F.sum("rows").alias("rows"),
        _merged(F.collect_set("window")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(*key, "n_words", hit.alias("n_hit"), "items", "spans",
                        F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_copy")).drop("_copy")


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "spans", words: int = WORDS,
           set_rows: int = SET_ROWS) -> DataFrame:
    """`docs` without benchmark passages: what='spans' cuts the hit words, 'documents' whole rows.

    A hit word goes with what stands between it and the next word; the rest
    of the text, and texts without a hit, null included, stay as they are.
    Columns are those of `docs`, whatever their names.
    """
    if what not in ("spans", "documents"):
        raise ValueError(f"unknown what {what!r}")
    found = contamination(docs, benchmark, words, set_rows).where("n_hit > 0")
    # One row per text, so that repeated rows are not multiplied.
    hit = settle(found.groupBy("doc_id", "text_hash").agg(F.min("spans").alias("_spans")))
    hit = hit.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rows = docs.select(carried(docs).alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(hit["_id"]) & (F.xxhash64("_row.text") == hit["_hash"])
    if what == "documents":
        return rows.join(hit, same, "left_anti").select("_row.*")
    joined = rows.join(hit, same, "left")
    text = F.when(F.col("_spans").isNull(), F.col("_row.text")).otherwise(_without(F.col("_row.text"), F.col("_spans")))
    return joined.select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def _without(text: Column, spans: Column) -> Column:
    """`text` without the words of `spans`, each with what follows it up to the next word."""
    gone = F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["end"] - 1)))

    def cut(pieces: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), gone)
        return F.array_join(F.transform(stay, lambda i: F.element_at(pieces, i + 1)), "")

    pieces = F.regexp_extract_all(text, F.lit(f"{_WORD}(?:{GAP})?"), F.lit(0))
    head = F.regexp_extract(text, f"^(?:{GAP})?", 0)
    return F.concat(head, F.element_at(F.transform(F.array(pieces), cut), 1))
