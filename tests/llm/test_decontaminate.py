"""Benchmark windows in documents against a plain search."""

import hashlib
import random
import re

import plans
import pytest
import tables

from sparktally.llm import decontaminate

ITEMS = "item_id long, text string"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")


def small(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def by_hand(docs, items, n):
    grams = {}
    for item, text in items:
        w = [small(x) for x in words_of(text)]
        for i in range(max(1, len(w) - n + 1) if w else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add("null" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w = [small(x) for x in words_of(text)]
        hit, found = set(), set()
        for gram, owners in grams.items():
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i:i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    found |= owners
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def found(df):
    return tables.table(df.select("doc_id", "n_words", "n_hit", "items"))


def cases(seed):
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "GAMMA", "élan", "Élan", "ÉLAN", "x1", "Kelvin", "kelvin", "σς", "ΣΣ", "z"]
    text = lambda n: rng.choice([" ", "  ", "\n", "-"]).join(rng.choice(vocabulary[:7]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 4, 6, 9]))) for i in range(8)] + [
        (3, "Beta, gamma! Beta"), (None, "Kelvin one two"), (70, ""), (71, None), (72, " -- "), (9, "ΣΣ σς z z")]
    docs = [(i % 50, text(rng.randint(0, 40))) for i in range(60)] + [
        (100, "KELVIN one two"), (101, "Kelvin one two"), (102, "σσ σς z z"), (103, "ΣΣ σς z z"), (None, None),
        (104, ""), (105, "Beta gamma beta"), (105, "Beta gamma beta"), (None, "alpha beta gamma")]
    return docs, items


@pytest.mark.parametrize("seed,set_rows", [(1, 10**6), (2, 10**6), (3, 7)])
def test_equals_a_plain_search(spark, seed, set_rows):
    docs, items = cases(seed)
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                      spark.createDataFrame(items, ITEMS), words=4, set_rows=set_rows)
    assert found(got) == by_hand(docs, items, 4)


def test_awkward_rows_and_extra_columns(spark):
    items = [(1, "Lorem ipsum dolor sit amet"), (2, "second LINE")]
    docs = tables.clashing(spark).withColumnRenamed("_n", "items")
    got = decontaminate.contamination(docs, spark.createDataFrame(items, ITEMS), words=3)
    assert found(got) == by_hand([r[:2] for r in tables.AWKWARD], items, 3)


def test_spans_and_documents_are_removed(spark):
    docs = spark.createDataFrame(
        [(1, "before it. One two, THREE four; after (it)"), (2, "nothing here"), (3, None), (4, "one two three four"),
         (1, "before it. One two, THREE four; after (it)"), (5, " - one two three four one two three four x")],
        "doc_id long, text string").selectExpr("*", "'own' AS spans", "map(1, doc_id) AS _row")
    items = spark.createDataFrame([(1, "one two three four")], ITEMS)
    cut = decontaminate.remove(docs, items, words=4)
    assert cut.columns == docs.columns
    assert [(r[0], r[1]) for r in tables.table(cut)] == [
        (1, "before it. after (it)"), (1, "before it. after (it)"), (2, "nothing here"), (3, None), (4, ""), (5, " - x")]
    assert {r.spans for r in cut.collect()} == {"own"}
    kept = decontaminate.remove(docs, items, what="documents", words=4)
    assert kept.columns == docs.columns and [r[0] for r in tables.table(kept)] == [2, 3]
    with pytest.raises(ValueError):
        decontaminate.remove(docs, items, what="lines")


def test_touching_spans_are_one(spark):
    docs = spark.createDataFrame([(1, "a b c a b c x a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], ITEMS)
    row = decontaminate.contamination(docs, items).first()
    assert [tuple(s) for s in row.spans] == [(0, 6), (7, 10)] and row.n_hit == 9


def test_no_rows(spark):
    none, some = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "x y")], ITEMS)
    assert decontaminate.contamination(tables.empty(spark), some).count() == 0
    got = decontaminate.contamination(tables.awkward(spark), none)
    assert got.count() == len(tables.AWKWARD) and {r.n_hit for r in got.collect()} == {0}
    assert decontaminate.remove(tables.awkward(spark), none).count() == len(tables.AWKWARD)


def test_a_passage_in_a_third_of_the_documents_is_split(spark, big, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5")
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "if(id % 3 = 0, 'one two three four', concat('word', id, ' is its own')) AS text").repartition(8)
    items = spark.range(500).selectExpr("id AS item_id", "if(id = 0, 'one two three four', concat('word', id, ' is its own')) AS text")
    grams = decontaminate.settle(decontaminate.benchmark_grams(items, 4))
    met = decontaminate.settle(decontaminate._scan(docs, grams.select("hash").distinct(), [4])).where("width > 0")
    joined = met.join(decontaminate.settle(grams.select("gram").distinct()), "gram")
    assert len(joined.collect()) == 2000 + 333 and plans.executed(joined)["skew"] == 1


def test_documents_stay_where_they_are_and_no_python_runs(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    hashes = spark.createDataFrame([(1,)], "hash long")
    plan = decontaminate._scan(docs, hashes, [10])._jdf.queryExecution().toString()
    assert "Exchange hash" not in plan and "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan


def test_digest_of_no_items_is_that_of_nothing(spark, tmp_path):
    from sparktally.llm import queries

    spark.createDataFrame([(1, "x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "y")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    row = queries.QUERIES["op12_decontaminate"](spark, str(tmp_path)).first()
    assert row.items_sha256 == hashlib.sha256(b"").hexdigest() and not row.contaminated
