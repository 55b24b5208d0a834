"""SimHash fingerprints, the vantage-point trees and the components."""

import re

import numpy as np
import pytest
import tables
import xxhash
from pyspark.sql import functions as F

from sparktally.llm import simhash_tree as st


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, bits):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def close_points(n, seed, spread=6):
    """Random points in balls that overlap, so that links cross every bound."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    points = []
    for _ in range(n):
        p = int(rng.choice(centres))
        for bit in rng.choice(64, rng.integers(0, spread), replace=False):
            p ^= 1 << int(bit)
        points.append(p)
    return np.unique(np.array(points, np.uint64))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bits", [0, 2, 4])
def test_tree_links_every_close_pair(seed, bits):
    points = close_points(400, seed)
    want = groups([int(p) for p in points], bits)
    got = st.link(points, len(points), bits, leaf=8)
    assert [want.index(w) for w in want] == [got.tolist().index(g) for g in got]


@pytest.mark.parametrize("seed", range(3))
def test_shards_overlap_enough(seed):
    points = close_points(500, seed)
    nodes = st.grow(points[::3], 12, 2)
    row, shard, home = st.route(points, nodes, 2)
    homes = dict(zip(row[home].tolist(), shard[home].tolist()))
    assert len(homes) == len(points) == home.sum()
    reached = {(r, s) for r, s in zip(row.tolist(), shard.tolist())}
    for i in range(len(points)):
        for j in np.flatnonzero(np.bitwise_count(points ^ points[i]) <= 2):
            assert (i, homes[int(j)]) in reached


def test_no_shard_is_left_large():
    rng = np.random.default_rng(7)
    points = np.unique(rng.integers(0, 1 << 63, 300_000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 300_000, dtype=np.uint64))
    nodes = st.grow(points[::3], len(points[::3]) * st.SHARD_ROWS // len(points), 2)
    row, shard, home = st.route(points, nodes, 2)
    at_home, all_rows = np.bincount(shard[home]), np.bincount(shard)
    print(len(nodes) + 1, "shards,", round(len(row) / len(points), 1), "copies, largest at home", at_home.max(), "of", len(points),
          "largest with visitors", all_rows.max())
    assert home.sum() == len(points) and at_home.max() <= 2 * st.SHARD_ROWS and all_rows.max() < len(points) / 7


def test_a_star_of_links_is_split(spark, big, conf, monkeypatch):
    import plans
    conf(**{"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k"})
    seen = []
    settle = st.settle

    def watched(df):
        done = settle(df)
        seen.append(df)
        return done

    edges = spark.range(1, 300_001).selectExpr("id AS a", "0L AS b").repartition(8)
    both = settle(edges.union(edges.selectExpr("b", "a")).toDF("a", "b"))
    least = settle(both.groupBy("a").agg(F.min("b").alias("m")))
    joined = both.join(least, "a")
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert plans.executed(joined)["skew"] == 1
    monkeypatch.setattr(st, "settle", watched)
    roots = st.components(edges)
    assert roots.count() == 300_000 and {r.root for r in roots.select("root").distinct().collect()} == {0}


def test_components_of_a_chain_across_shards(spark):
    # Each number differs from the next by one bit; the ends differ in many.
    fps = [(1 << i) - 1 for i in range(40)] + [0x5A5A << 44]
    distinct = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, least long")
    roots = st.components(st.links(distinct, 2, sample=30, shard_rows=4)).collect()
    assert {r.a for r in roots} == set(fps[1:40]) and {r.root for r in roots} == {0}


def test_fingerprints_and_components_by_hand(spark):
    rows = [r[:2] for r in tables.AWKWARD]
    words = [f"word{i}" for i in range(300)]
    rows += [(100 + k, " ".join(w if i != 7 * k else "other" for i, w in enumerate(words))) for k in range(12)]
    rows += [(50, " ".join(words).upper())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = st.near_duplicates(docs).collect()
    fps = [fingerprint(t) for _, t in rows]
    label = groups(fps, 2)
    want = []
    for (doc_id, _), fp, g in zip(rows, fps, label):
        ids = [d for (d, _), x in zip(rows, label) if x == g and d is not None]
        want.append((doc_id, fp, min(ids) if ids else None))
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == sorted(want, key=repr)
    assert len({c for _, _, c in want}) < len(want) - 8  # near copies do link here


def test_one_row_of_each_group_stays(spark):
    docs = tables.clashing(spark)
    kept = st.keep_one(docs)
    assert kept.columns == docs.columns
    # 3, 4 and 5 have no words; 1 and -4 are equal; 2 is there twice.
    assert sorted(map(str, [r.doc_id for r in kept.collect()])) == sorted(
        map(str, [-4, 2, 3, 6, 7, None, 9, 1 << 60]))


def test_no_rows(spark):
    assert st.near_duplicates(tables.empty(spark)).count() == 0
    assert st.keep_one(tables.empty(spark)).count() == 0


def test_rows_of_equal_id_and_text_that_differ_elsewhere(spark):
    rows = [(1, "the same text", lang, "s", n) for lang in ("a", "b", None) for n in (1, 2)] + [(2, "another text here", "a", "s", 1)]
    kept = {tuple(tables.table(st.keep_one(spark.createDataFrame(order, tables.DOCS).coalesce(1))))
            for order in (rows, rows[::-1], rows[3:] + rows[:3], rows + rows)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2
