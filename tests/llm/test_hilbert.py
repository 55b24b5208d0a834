"""Sharding along a Hilbert curve."""

import itertools
import zlib

import pytest
import tables
from pyspark.sql import functions as F

from sparktally.llm import hilbert


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 3), (2, 1), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    cells = spark.createDataFrame([(list(p),) for p in itertools.product(range(1 << bits), repeat=dims)],
                                  "p array<long>")
    path = [r.p for r in cells.withColumn("i", hilbert.hilbert_index(F.col("p"), dims, bits)).orderBy("i").collect()]
    indexes = [r.i for r in cells.select(hilbert.hilbert_index(F.col("p"), dims, bits).alias("i")).collect()]
    assert sorted(indexes) == list(range(1 << bits * dims))
    assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_runs_are_even_and_gapless(spark, shards):
    rows = hilbert.shard_by_hilbert(tables.clashing(spark), shards).collect()
    assert len(rows) == len(tables.AWKWARD)
    counts = [sum(r.shard == s for r in rows) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in rows)
    for r in rows:
        text = next(t for d, t, *_ in tables.AWKWARD if d == r.doc_id) or ""
        assert r.size == len(text.encode()) + 8 and r.text_crc32 == zlib.crc32(text.encode())


def test_a_shard_covers_few_values(spark):
    docs = spark.createDataFrame(
        [(i, "x" * (i % 7) ** 3, "l%d" % (i % 4), "s%02d" % (i % 16), 0) for i in range(4000)], tables.DOCS)
    placed = hilbert.shard_by_hilbert(docs, 24).select("doc_id", "shard").join(docs, "doc_id")
    seen = placed.groupBy("shard").agg(F.countDistinct("source").alias("s"), F.countDistinct("lang").alias("l"))
    mean = seen.agg(F.avg("s"), F.avg("l")).first()
    assert mean[0] <= 8 and mean[1] <= 2.5


def test_written_shards_hold_every_row(spark, tmp_path):
    docs = tables.awkward(spark)
    hilbert.write_shards(docs, str(tmp_path / "out"), 4)
    assert tables.table(spark.read.parquet(str(tmp_path / "out")).drop("shard")) == tables.table(docs)


def test_no_rows(spark):
    assert hilbert.shard_by_hilbert(tables.empty(spark)).count() == 0


def plain_index(point, bits):
    """Position along the Hilbert curve by walking it: neighbours differ by one step, halves are visited in turn (Skilling)."""
    x, n = list(point), len(point)
    m = 1 << (bits - 1)
    q = m
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, m
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


def test_index_and_cut_by_hand(spark):
    bits = 3
    cells = [(a, b, c) for a in range(8) for b in range(8) for c in range(8)]
    got = {tuple(r.p): r.i for r in spark.createDataFrame([(list(c),) for c in cells], "p array<bigint>").select(
        "p", hilbert.hilbert_index(F.col("p"), 3, bits).alias("i")).collect()}
    assert sorted(got.values()) == list(range(512))
    by_place = {i: c for c, i in got.items()}
    assert all(sum(abs(u - v) for u, v in zip(by_place[i], by_place[i + 1])) == 1 for i in range(511))
    assert {c: plain_index(c, bits) for c in cells} == got
    # the cut: positions along the curve in runs of near equal counts
    docs = spark.createDataFrame([(i, "x" * (i % 50), f"l{i % 3}", f"s{i % 11}", 0) for i in range(301)], tables.DOCS)
    rows = sorted(hilbert.shard_by_hilbert(docs, 7).collect(), key=lambda r: (r.shard, r.slot))
    starts = [-(-s * 301 // 7) for s in range(8)]
    assert [(r.shard, r.slot) for r in rows] == [(s, i - starts[s]) for s in range(7) for i in range(starts[s], starts[s + 1])]
    assert [r.curve for r in rows] == sorted(r.curve for r in rows)


def test_written_shards_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    rows = [(1, "the same", lang, f"s{n}", n) for lang in ("a", "b", None) for n in range(6)] + [(1, "the same", "a", "s0", 0)] * 2
    written = []
    for i, order in enumerate((rows, rows[::-1])):
        hilbert.write_shards(spark.createDataFrame(order, tables.DOCS).coalesce(1), f"{tmp_path}/{i}", 4)
        written.append(tables.table(spark.read.parquet(f"{tmp_path}/{i}")))
    assert written[0] == written[1] and len(written[0]) == len(rows)
