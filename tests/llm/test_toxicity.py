"""The toxicity lexicon: folding, matching, exceptions and held-out accuracy."""

import random
import zlib

import pytest
import tables
from pyspark.sql import functions as F

from sparktally.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def hits(lexicon, text):
    return [(h[2], text[h[0]:h[1]]) for h in lexicon.matcher().hits(toxicity.fold(text))]


def test_folding_finds_disguised_words():
    lexicon = toxicity.Lexicon({"idiot$": 2.0, "vequ": 1.0})
    for text in ("an idiot.", "IDIOT", "1d10t", "idiоt", "ídiöt", "i​diot", "ｉｄｉｏｔ"):
        assert [t for t, _ in hits(lexicon, text)] == ["idiot$"], text
    assert hits(lexicon, "idiotic patriotidiot xvequ") == []
    assert [t for t, _ in hits(lexicon, "vequila, Vequ")] == ["vequ", "vequ"]


def test_exception_phrases_take_matches_out():
    lexicon = toxicity.Lexicon({"trash$": 2.0}, ("trash can",))
    assert hits(lexicon, "a trash can and trash") == [("trash$", "trash")]
    assert hits(lexicon, "trash cannot") == [("trash$", "trash")]


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    return docs, labels, toxicity.learn(docs, labels)


def test_held_out_accuracy(learned):
    docs, labels, lexicon = learned
    scored = toxicity.score(docs, lexicon).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    toxic = [r.score for r in scored if r.toxic]
    clean = [r.score for r in scored if not r.toxic]
    assert len(toxic) > 50
    assert sum(s >= 0.5 for s in toxic) / len(toxic) > 0.9  # some labels are of texts that were lost
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.02


def test_held_out_labels_are_not_learned_from(spark, learned):
    docs, labels, lexicon = learned
    out = toxicity.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.learn(docs, turned) == lexicon
    assert {r.doc_id: r.o for r in spark.range(50).select(F.col("id").alias("doc_id"), toxicity.held_out(
        F.col("id")).alias("o")).collect()} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_awkward_rows(spark):
    docs = tables.clashing(spark)
    lexicon = toxicity.Lexicon({"lorem$": 3.0}, (), -2.0, (0.5, 0.5))
    rows = toxicity.score(docs, lexicon).collect()
    assert len(rows) == len(tables.AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.doc_id for r in rows if r.predicted} == {6}
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1), (2, 1, 1), (2, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    kept = toxicity.reject_toxic(docs, labels)  # nothing to learn, and no base word in it: all stay
    assert kept.columns == docs.columns and tables.table(kept) == tables.table(docs)
    assert toxicity.reject_toxic(tables.empty(spark), labels).count() == 0


def test_base_words_without_labels(spark):
    texts = ["you idiot, you worthless scum", "a kind word about clowns", "take out the trash can", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r.predicted for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    assert scored == {0: 1, 1: 0, 2: 0, 3: 0}


def test_a_base_word_that_clean_texts_use_is_left_out(spark):
    rows = [(i, f"number{i} the clown is a fool and an idiot thing{i}" if i % 4 else f"number{i} clown idiot idiot{i}")
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "int(doc_id % 4 = 0) AS toxic")
    weights = toxicity.learn(docs, labels).weights
    assert "clown$" not in weights and "fool$" not in weights and "scum$" in weights


def name(i):
    return "".join(chr(ord("a") + i // 26 ** k % 26) for k in range(3))


def test_every_telling_term_is_kept(spark):
    toxic = [(i, " ".join(f"{name(j)}vile" for j in range(i % 25, 600, 25))) for i in range(500)]
    clean = [(500 + i, " ".join(f"w{name(i * 37 + j)}ord" for j in range(90))) for i in range(500)]
    docs = spark.createDataFrame([(i, f"{t} only{name(i)}once{name(i)}") for i, t in toxic + clean],
                                 "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "1 AS quality", "int(doc_id < 500) AS toxic")
    weights = toxicity.learn(docs, labels).weights
    assert sum(any(w[:k] in weights for k in range(1, 8)) or f"{w}$" in weights
               for w in (f"{name(j)}vile" for j in range(600))) == 600


def test_every_exception_phrase_is_learned(spark):
    lexicon = toxicity.Lexicon({"scum$": 5.0}, ())
    rows = [(" ".join(f"{name(i)}x scum ." for i in range(1500)), 0)] * 2 + [("you scum", 1)]
    learned = toxicity._learned_exceptions(spark.createDataFrame(rows, "text string, toxic int"), lexicon)
    assert sorted(learned) == sorted(f"{name(i)}x scum" for i in range(1500))


def test_exception_phrases_of_long_words(spark):
    long = "abcdefghij" * 5
    lexicon = toxicity.Lexicon({"scum$": 5.0}, ())
    rows = [(f"{long} scum {long}z and 1{long}", 0)] * 2 + [("you scum", 1)]
    learned = toxicity._learned_exceptions(spark.createDataFrame(rows, "text string, toxic int"), lexicon)
    assert sorted(learned) == sorted([f"{long} scum", f"scum {long}z"])
    for phrase in learned:
        assert hits(toxicity.Lexicon({"scum$": 5.0}, (phrase,)), rows[0][0]) == []


def plain_hits(lexicon, folded):
    """Every place of every term and phrase, by plain search."""
    def places(word):
        return [(i, i + len(word)) for i in range(len(folded) - len(word) + 1) if folded.startswith(word, i)]

    def free(end):
        return end == len(folded) or not folded[end].isalpha()

    spans = [(s, e) for p in lexicon.exceptions for s, e in places(toxicity.fold(p))
             if (s == 0 or not folded[s - 1].isalpha()) and free(e)]
    out = []
    for term, weight in lexicon.weights.items():
        for s, e in places(term.rstrip("$")):
            if (s == 0 or not folded[s - 1].isalpha()) and (term[-1] != "$" or free(e)):
                if not any(a <= s and e <= b for a, b in spans):
                    out.append((s, e, term, weight))
    return sorted(out)


def test_matches_equal_a_plain_search():
    rng = random.Random(2)
    words = ["scum", "scummy", "trash", "can", "ash", "a", "vequ", "vequila", "x1d10t", "1d10t", "idiot", "trash can", "l0ser"]
    lexicon = toxicity.Lexicon({"scum$": 5.0, "vequ": 2.0, "trash$": 1.0, "ash": 3.0, "idiot$": 4.0, "loser$": 2.0, "los": 1.0},
                               ("trash can", "scum a", "a vequila"))
    matcher = lexicon.matcher()
    for _ in range(400):
        folded = toxicity.fold(rng.choice([" ", ". ", "-"]).join(rng.choice(words) for _ in range(rng.randint(0, 12))))
        assert sorted(matcher.hits(folded)) == plain_hits(lexicon, folded)
