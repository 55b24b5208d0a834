"""Small awkward tables for the operators."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns.
CLASHING = ["size", "key", "fp", "block", "position", "text_hash", "n_lines", "n_dropped", "score", "doc", "root",
            "copies", "_row", "toxic", "place", "h1", "tie", "curve", "shard", "spans", "ids", "id", "_gone", "_n"]

LONG = "lorem ipsum dolor sit amet consectetur " * 9_000
AWKWARD = [
    (1, "One line of words\nSecond line of words\n\nthird", "en", "a", 10),
    (2, "  one LINE of words \nsomething of its own here", "en", "a", 11),
    (2, "  one LINE of words \nsomething of its own here", "en", "a", 11),  # a repeated row
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, " \t\n\x0b\x0c\r ", "de", "b", 7),
    (6, LONG, "en", None, len(LONG)),
    (7, "ünïcödé \U0001f600 straße\nSECOND LINE OF WORDS", "de", "b", 3),
    (None, "no id at all\nsecond line of words", "fr", "c", 1),
    (9, "x", "en", "c", 1),
    (-4, "One line of words\nSecond line of words\n\nthird", "en", "b", 10),
    (1 << 60, "mail a.b@c.example.org or +1 (555) 010-9999\n10.0.0.1", "en", "a", 5),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS).repartition(3)


def clashing(spark):
    from pyspark.sql import functions as F

    return awkward(spark).withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def empty(spark):
    return spark.createDataFrame([], DOCS)


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
