"""SimHash near-duplicates found with vantage-point trees over Hamming distance."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from sparktally.llm.common import carried, settle, whole_hash

SHINGLE = 3
MAX_BITS = 2
#: Fingerprints of which the upper tree is grown, at most about so many.
SAMPLE = 131_072
#: Distinct fingerprints that should be at home in a shard, at most about so many.
SHARD_ROWS = 4_096
#: Sample points that a shard is judged by at least; so there are SAMPLE / LEAST_POINTS shards at most, and larger ones beyond.
LEAST_POINTS = 16
#: A node of a shard's own tree with fewer fingerprints is compared in full.
LEAF = 48
_FLUSH = 1 << 19


# ---- fingerprints --------------------------------------------------------

def shingle_hashes(text: str, width: int, most: int = 1 << 16):
    """XXH64 (seed 42) of the word shingles of a text, in lists of at most `most`."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if 0 < len(words) < width:
        yield [xxhash.xxh64_intdigest(b" ".join(words), 42)]
        return
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, len(words) - width + 1, most):
        part = words[start:start + most + width - 1]
        yield [digest(join(x), 42) for x in zip(*[part[i:] for i in range(width)])]


class _BitCounts:
    """Per document, in how many hashes each of the 64 bits is set."""

    def __init__(self, n: int):
        self.set = np.zeros((n, 64), np.int64)
        self.total = np.zeros(n, np.int64)
        self._hashes: list[int] = []
        self._docs: list[int] = []
        self._lengths: list[int] = []

    def add(self, doc: int, hashes: list[int]) -> None:
        if hashes:
            self._hashes += hashes
            self._docs.append(doc)
            self._lengths.append(len(hashes))
            if len(self._hashes) >= _FLUSH:
                self.flush()

    def flush(self) -> None:
        if not self._docs:
            return
        lengths = np.array(self._lengths)
        octets = np.array(self._hashes, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        docs = np.array(self._docs)
        np.add.at(self.set, docs, sums)
        np.add.at(self.total, docs, lengths)
        self._hashes, self._docs, self._lengths = [], [], []

    def fingerprints(self) -> np.ndarray:
        self.flush()
        major = (2 * self.set > self.total[:, None]).astype(np.uint8)
        return np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp (64 bits as a long) of every row; a text without words has 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def each(batches):
        for batch in batches:
            counts = _BitCounts(batch.num_rows)
            for i, text in enumerate(batch.column(2)):
                for hashes in shingle_hashes(text.as_py(), shingle):
                    counts.add(i, hashes)
            fps = pa.array(counts.fingerprints().view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps],
                                             names=["doc_id", "text_hash", "fp"])

    return rows.mapInArrow(each, "doc_id long, text_hash long, fp long")


# ---- the tree ------------------------------------------------------------

def distance(points: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(points ^ point)


def _vantage(points: np.ndarray, radius: int) -> tuple[int, int] | None:
    """A vantage point and a bound; points up to the bound go left.

    Of a few points, taken at even steps, and their complements the one
    whose bound leaves the fewest points within `radius` of it, so that few
    queries have to go both ways.  None if no bound parts the points.
    """
    best = None
    tries = points[:: max(1, len(points) // 8)][:8]
    look = points[:: max(1, len(points) // 4096)]
    for vantage in tries:
        at = np.bincount(distance(look, vantage), minlength=65)
        left = np.cumsum(at)
        for bound in range(64):
            share = left[bound] / len(look)
            if not 0.25 <= share <= 0.75:
                continue
            low, high = max(0, bound - radius), min(64, bound + radius)
            both = left[high] - (left[low] if low <= bound - radius else 0)
            key = (both, abs(share - 0.5))
            if best is None or key < best[0]:
                best = (key, int(vantage), bound)
    if best is None:
        for vantage in tries:  # whatever parts them at all
            d = distance(points, vantage)
            bound = (int(d.min()) + int(d.max())) // 2
            if d.min() <= bound < d.max():
                return int(vantage), bound
        return None
    return best[1], best[2]


def grow(sample: np.ndarray, most: int, radius: int) -> list[tuple[int, int, int, int]]:
    """The upper tree: nodes (vantage, bound, left, right); a child below zero, -1 - s, is shard s.

    The part with most sample points is parted next, until none has more
    than `most` or what has more cannot be parted; so no branch is left large because another one is deep.
    """
    nodes: list[list[int]] = []
    waiting = [(-len(sample), 0, sample, -1, 0)]  # size, order of arrival, points, place in its parent
    done: list[tuple[int, int]] = []
    arrived = 0
    while waiting:
        size, _, points, parent, side = heapq.heappop(waiting)
        node = _vantage(points, radius) if -size > max(1, most) else None
        if node is None:
            done.append((parent, side))
            continue
        if parent >= 0:
            nodes[parent][2 + side] = len(nodes)
        left = distance(points, np.uint64(node[0])) <= node[1]
        for k, part in enumerate((points[left], points[~left])):
            arrived += 1
            heapq.heappush(waiting, (-len(part), arrived, part, len(nodes), k))
        nodes.append([*node, -1, -1])
    for shard, (parent, side) in enumerate(done):
        if parent >= 0:
            nodes[parent][2 + side] = -1 - shard
    return [tuple(n) for n in nodes]


def route(points: np.ndarray, nodes: list, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, home): the shard of each point, and each other one its ball overlaps.

    By the triangle inequality a point within `radius` of this one lies left
    only if this one is at most bound + radius from the vantage point, and right only
    if it is at least bound + 1 - radius.
    """
    rows, shards, homes = [], [], []
    todo = [(0 if nodes else -1, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        i, at, home = todo.pop()
        if not len(at):
            continue
        if i < 0:
            rows.append(at)
            shards.append(np.full(len(at), -1 - i))
            homes.append(home)
            continue
        vantage, bound, to_left, to_right = nodes[i]
        d = distance(points[at], np.uint64(vantage)).astype(np.int64)
        left, right = d <= bound + radius, d > bound - radius
        todo.append((to_left, at[left], (home & (d <= bound))[left]))
        todo.append((to_right, at[right], (home & (d > bound))[right]))
    if not rows:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)


class _Groups:
    """Union-find over positions; pairs come in arrays, the smaller root wins."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while True:
            further = self.parent[up]
            if np.array_equal(further, up):
                return up
            up = further

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))


def link(points: np.ndarray, n_home: int, radius: int, leaf: int = LEAF) -> np.ndarray:
    """Group of each point; the first `n_home` are at home, the others visit.

    Grows a vantage-point tree over the points at home and sends all points
    down it as queries, both ways where their ball crosses a bound.
    Every pair within `radius` with one end at home is found.
    """
    groups = _Groups(len(points))
    todo = [(np.arange(n_home), np.arange(len(points)))]
    while todo:
        own, asking = todo.pop()
        if not len(own) or not len(asking):
            continue
        node = _vantage(points[own], radius) if len(own) > leaf else None
        if node is None:
            # Full comparison, in blocks of bounded size.
            for q in range(0, len(asking), 4096):
                block = asking[q:q + 4096]
                for p in range(0, len(own), 256):
                    mine = own[p:p + 256]
                    near = np.bitwise_count(points[mine][:, None] ^ points[block][None, :]) <= radius
                    i, j = np.nonzero(near)
                    a, b = mine[i], block[j]
                    groups.union(a[a != b], b[a != b])
            continue
        vantage, bound = np.uint64(node[0]), node[1]
        d_own = distance(points[own], vantage)
        d_ask = distance(points[asking], vantage).astype(np.int64)
        todo.append((own[d_own <= bound], asking[d_ask <= bound + radius]))
        todo.append((own[d_own > bound], asking[d_ask > bound - radius]))
    return groups.roots(np.arange(len(points)))


# ---- links and components ------------------------------------------------

def links(distinct: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE,
          shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b), a > b: links that join every set of fingerprints within `max_bits` of each other.

    `distinct` has one row per fingerprint `fp`.  The upper tree is grown on
    at most about `sample` of them, chosen by hash, until no shard has more than its share of them; its
    nodes, fewer than sample / LEAST_POINTS, are broadcast.  Each fingerprint goes to
    its home shard and, as a query, to the shards its ball overlaps.  Inside
    a shard only a spanning set of the pairs found is returned, each to the
    smallest member.
    """
    spark = distinct.sparkSession
    count = distinct.count()
    modulus = max(1, -(-count // sample))
    chosen = distinct.select("fp").where(F.pmod(F.xxhash64("fp"), F.lit(modulus)) == 0).toArrow()
    seed = np.sort(chosen.column(0).to_numpy().astype(np.int64).view(np.uint64))
    seed = seed[np.argsort((seed * np.uint64(0x9E3779B97F4A7C15)), kind="stable")]
    least = min(LEAST_POINTS, shard_rows)
    nodes = grow(seed, max(least, len(seed) * shard_rows // max(1, count)), max_bits)
    shared = spark.sparkContext.broadcast(nodes)

    def dealt(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            row, shard, home = route(fps, shared.value, max_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int64)), pa.array(fps[row].view(np.int64)), pa.array(home)],
                names=["shard", "fp", "home"])

    def within(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy()
        order = np.lexsort((fps, ~home))
        fps = fps[order]
        group = link(fps, int(home.sum()), max_bits)
        # The smallest member stands for a group, as a signed number, as Spark compares.
        signed = fps.view(np.int64)
        least = np.full(len(fps), np.iinfo(np.int64).max)
        np.minimum.at(least, group, signed)
        to = least[group]
        far = to != signed
        return pa.table({"a": signed[far], "b": to[far]})

    return (distinct.select("fp").mapInArrow(dealt, "shard long, fp long, home boolean")
            .groupBy("shard").applyInArrow(within, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(a, root): every end of an edge (a, b), a > b, with the smallest number it reaches.

    Alternates two steps until nothing changes: larger neighbours of a
    number move to its smallest one, then smaller ones do.  Edges only ever
    get fewer distinct ends, and each round is written to the shared folder.  So are the
    smallest neighbours before they are joined: Spark splits the partition of a hot number
    only if neither side of a join has just been grouped by it.
    """
    def seen(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = settle(edges.distinct())
    state = seen(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a"))
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a != b").distinct())
        large = settle(large)
        least = settle(large.groupBy("a").agg(F.min("b").alias("m")))
        joined = large.join(least, "a")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = settle(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, seen(edges)
        if before == state:
            break
    return edges.select("a", F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, text_hash, fp, root, component_id of every row; `root` names the component.

    Rows of equal fingerprint meet in one distinct fingerprint first, so
    copies are never compared.  component_id is the smallest doc_id reachable over links of
    at most `max_bits` differing bits, the row's own included; null ids count
    only where a component has no other.
    """
    rows = settle(fingerprints(docs, shingle))
    distinct = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = settle(components(links(distinct, max_bits)))
    ends = roots.union(roots.select("root", "root")).distinct().toDF("fp", "root")
    known = distinct.join(ends, "fp")
    best = known.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = known.join(best, "root").select("fp", "root", "component_id")
    named = settle(distinct.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id")))
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the smallest doc_id stays.

    Among rows of that id the smallest text hash stays, among rows of equal id and text the
    smallest hash of the whole row, and of rows equal in all columns one.
    """
    found = near_duplicates(docs, shingle, max_bits)
    # The smallest id, null last, then the smallest hash.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("text_hash"))
    kept = (found.groupBy("root").agg(F.min(order).alias("best"))
            .select("best.doc_id", "best.text_hash"))
    rows = docs.select(carried(docs).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                       F.xxhash64("text").alias("_hash"), whole_hash(docs).alias("_whole"))
    same = rows["_id"].eqNullSafe(kept["doc_id"]) & (rows["_hash"] == kept["text_hash"])
    # Spark cuts each task to one row per group before it shuffles them.
    first = F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_whole"))
    return (rows.join(kept, same, "left_semi").withColumn("_n", first).where("_n = 1").select("_row.*"))
