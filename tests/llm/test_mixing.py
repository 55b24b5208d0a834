"""Mixing by systematic sampling."""

import random

import pytest
import tables
from pyspark.sql import functions as F

from sparktally.llm import mixing
from sparktally.llm.common import positions, tie_hash


def shared_out(sizes, weights, most):
    """Targets by sharing the excess again and again."""
    total, full = sum(sizes.values()), {}
    weight = {k: weights[i % len(weights)] for i, k in enumerate(sorted(sizes))}
    while True:
        left = {k: weight[k] for k in sizes if k not in full}
        rest = total - sum(full.values())
        target = {k: rest * w / sum(left.values()) for k, w in left.items()}
        above = [k for k in left if target[k] >= most * sizes[k]]
        if not above:
            return full | target
        full |= {k: most * sizes[k] for k in above}


@pytest.mark.parametrize("seed", range(4))
def test_targets_are_shared_out(spark, seed):
    rng = random.Random(seed)
    sizes = {f"0s{i:02}": rng.choice([0, 1, 5, 80, 1000, 40_000]) for i in range(9)}
    sizes["0big"] = 300
    got = {r.key: r.target for r in mixing.source_targets(
        spark.createDataFrame(list(sizes.items()), "key string, source_size long")).collect()}
    want = shared_out(sizes, (5, 2, 1), 3)
    assert got == pytest.approx(want, abs=1e-6)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_positions_number_each_group_in_order(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("ab"), rng.choice([1, 1, 1, 7, 9])) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, g string, cell long").withColumn("tie", tie_hash(F.col("doc_id")))
    got = positions(df, ["g"], "cell", "tie", ["doc_id"], salt_bits=3).collect()
    for g in "ab":
        own = sorted((r for r in got if r.g == g), key=lambda r: (r.cell, r.tie, r.doc_id))
        assert [r.position for r in own] == list(range(len(own)))


def test_words_come_near_the_target(spark):
    rng = random.Random(5)
    docs = [(i, "w " * rng.randint(1, 60), "en", f"s{min(i % 9, 3)}", 0) for i in range(2000)]
    rows = mixing.copies_of(spark.createDataFrame(docs, tables.DOCS)).collect()
    for key in {r.key for r in rows}:
        own = [r for r in rows if r.key == key]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(0 <= r.copies <= 3 for r in own)
        assert sum(r.size for r in own) == own[0].source_size


def test_awkward_rows(spark):
    rows = mixing.copies_of(tables.awkward(spark)).collect()
    assert len(rows) == len(tables.AWKWARD)
    assert all(r.size == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert {r.key for r in rows} == {"0", "0a", "0b", "0c", "1"}
    again = mixing.copies_of(tables.awkward(spark).repartition(5))
    assert tables.table(again) == sorted(map(tuple, rows), key=repr)


def test_mix_repeats_whole_rows(spark):
    docs = tables.clashing(spark)
    taken = mixing.copies_of(docs)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = {}
    for r in taken.collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert got == {k: n for k, n in want.items() if n}
    assert mixing.mix(tables.empty(spark)).count() == 0


def test_rows_that_differ_elsewhere_keep_their_own_copies(spark):
    docs = [(1, "some words", lang, "a", n) for lang in ("en", "de", None) for n in (1, 2, None)] + [(1, "x", "en", "a", 1)] * 2
    table = spark.createDataFrame(docs, tables.DOCS).withColumn("extra", F.create_map("doc_id", "lang"))
    for parts in (1, 5):
        mixed = mixing.mix(table.repartition(parts))  # one source: every row once
        assert tables.table(mixed) == tables.table(table)
