"""Nearest neighbours by cosine through multi-index hashing of learned binary codes."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparktally.llm.common import settle

#: Bits of a code, and of each of its substrings.
BITS, PART = 256, 8
#: Rows the codes and the radius are learned on, at most about so many, chosen by hash.
SAMPLE = 8_192
#: Share of the sample's true neighbours that lie within the radius.
WITHIN = 0.99
#: Vectors of an index block and queries of a chunk, at least about so many, and as many as fit these bytes in double
#: precision: every block meets every chunk, so larger ones mean fewer copies of either.
BLOCK_ROWS, CHUNK_ROWS, BLOCK_BYTES = 4_096, 8_192, 32 << 20


@dataclass
class Codes:
    """Rotations learned on a sample, and the radius in which neighbours are looked for."""

    rotation: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as rows of BITS / 8 octets; one octet is one substring."""
        return np.packbits(vectors @ self.rotation > 0, axis=1)


def _rotation(unit: np.ndarray, seed: int, rounds: int = 20) -> np.ndarray:
    """A rotation that brings the vectors near the corners of a cube.

    Alternates between the nearest corners and the rotation that
    fits the vectors to them best.
    """
    size = unit.shape[1]
    turned = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, size)))[0]
    for _ in range(rounds):
        corners = np.where(unit @ turned > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(corners.T @ unit)
        turned = (u @ v).T
    return turned


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that its largest part is near 1: cosines stay, and no square overflows or vanishes."""
    exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))[1]
    return np.ldexp(vectors, -exponent[:, None])


def learn(sample: np.ndarray, k: int = 5, within: float = WITHIN, probes: int = 512) -> Codes:
    """Codes for vectors like those of the sample; several rotations make up the bits.

    The radius holds the share `within` of the k nearest neighbours that
    probes have among the sample.  In more data neighbours are nearer, so it holds at least as many.
    """
    unit = scaled(sample)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    turns = -(-BITS // unit.shape[1])
    codes = Codes(np.hstack([_rotation(unit, seed) for seed in range(turns)])[:, :BITS], BITS)
    if len(unit) <= k:
        return codes
    of = codes.of(unit)
    asked = np.arange(0, len(unit), max(1, len(unit) // probes))
    apart = []
    for q in asked:
        near = unit @ unit[q]
        near[q] = -2
        best = np.argpartition(-near, k)[:k]
        apart += np.bitwise_count(of[best] ^ of[q]).sum(1).tolist()
    codes.radius = int(np.ceil(np.quantile(apart, within)))
    return codes


_BY_WEIGHT = [np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(PART), w)], np.int64)
              for w in range(PART + 1)]


def _masks(radius: int) -> np.ndarray:
    """All differences of at most `radius` bits of a substring."""
    return np.concatenate(_BY_WEIGHT[:max(0, min(PART, radius) + 1)] or [np.zeros(0, np.int64)])


class Index:
    """The codes of a block, listed by the value of every substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        parts = codes.shape[1]
        self.order = np.argsort(codes, axis=0, kind="stable").T
        counts = np.stack([np.bincount(codes[:, p], minlength=1 << PART) for p in range(parts)])
        self.start = np.concatenate([np.zeros((parts, 1), np.int64), np.cumsum(counts, 1)[:, :-1]], 1)
        self.count = counts

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes within `radius` bits.

        If no more than radius = parts * r + rest bits differ, one of the
        first rest + 1 substrings differs in at most r bits or one of the others in
        at most r - 1; so these lists hold every such code.
        """
        parts = len(code)
        r, rest = divmod(radius, parts)
        part, value = [], []
        for first, last, masks in ((0, rest + 1, _masks(r)), (rest + 1, parts, _masks(r - 1))):
            part.append(np.repeat(np.arange(first, last), len(masks)))
            value.append((code[first:last].astype(np.int64)[:, None] ^ masks[None, :]).ravel())
        part, value = np.concatenate(part), np.concatenate(value)
        count = self.count[part, value]
        part, start, count = part[count > 0], self.start[part, value][count > 0], count[count > 0]
        if not len(count):
            return np.zeros(0, np.int64)
        ends = np.cumsum(count)
        at = np.arange(ends[-1]) + np.repeat(start - ends + count, count)
        seen = np.zeros(len(self.codes), bool)
        seen[self.order[np.repeat(part, count), at]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1) <= radius]


def usable(vector: Column) -> Column:
    """Not null, not empty, all parts finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(index: DataFrame, asked: DataFrame, codes: Codes, radius: int, k: int, blocks: int,
            chunks: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of every block for every query."""
    left = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = (asked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))

    def vectors(table: pa.Table) -> np.ndarray:
        column = table.column("vector").combine_chunks()
        return scaled(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1))

    def each(own: pa.Table, queries: pa.Table) -> pa.Table:
        if not own.num_rows or not queries.num_rows:
            return _FOUND.empty_table()
        x, q = vectors(own), vectors(queries)
        ids = own.column("ids").to_pylist()
        norms = np.sqrt((x * x).sum(1))
        listed = Index(codes.of(x))
        coded = codes.of(q)
        out = []
        for query_id, vector, code in zip(queries.column("query_id").to_pylist(), q, coded):
            rows = listed.within(code, radius)
            scores = (x[rows] * vector).sum(1) / (norms[rows] * np.sqrt((vector * vector).sum()))
            # k + 1 vectors, as one of them may be the query itself; all ties of the last.
            if len(rows) > k + 1:
                near = scores >= np.partition(scores, -k - 1)[-k - 1]
                rows, scores = rows[near], scores[near]
            best = sorted((-s, i) for r, s in zip(rows.tolist(), scores.tolist()) for i in ids[r] if i != query_id)
            out += [(query_id, i, -s) for s, i in best[:k]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 3, _FOUND)],
                                    schema=_FOUND)

    return (left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk"))
            .applyInArrow(each, "query_id long, vec_id long, score double"))


def nearest(table: DataFrame, is_query: Column, k: int = 5, within: float = WITHIN) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its k nearest other rows by cosine.

    `table` has vec_id and embedding; `is_query` is a condition on vec_id.  Vectors
    that are not `usable`, have no id or not the commonest length take no part;
    of several vectors of one id the smallest is meant.  Equal vectors are
    indexed once, with their k + 1 smallest ids, which is all that a result
    can show of them.  Every vector is indexed, in blocks that each answer all queries; a code
    within the learned radius is always found.  Queries that find fewer than k so
    are asked again with a radius that holds every code.  Scores are cosines of
    the given vectors in double precision, ties go to the smaller id.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    rows = settle(rows.groupBy("vec_id").agg(F.min("vector").alias("vector")))
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == lengths["n"])
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    n, n_asked = rows.count(), max(1, asked.count())
    fit = BLOCK_BYTES // (8 * lengths["n"])
    # Small tables are still dealt to as many tasks as a shuffle has.
    width = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(-(-n // max(BLOCK_ROWS, fit)), min(-(-n // BLOCK_ROWS), width))
    chunks = -(-n_asked // max(CHUNK_ROWS, fit))
    # The k + 1 smallest ids of each distinct vector; cut before the shuffle, so a common one is no burden.
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    index = settle(rows.withColumn("_n", place).where(F.col("_n") <= k + 1)
                   .groupBy("vector").agg(F.collect_list("vec_id").alias("ids"))
                   .withColumn("block", F.pmod(F.xxhash64("vector"), F.lit(blocks)).cast("int")))
    keep = max(1, -(-n // SAMPLE))
    sample = index.where(F.pmod(F.xxhash64("vector", F.lit("sample")), F.lit(keep)) == 0).select("vector").toArrow()
    seen = np.array(sample.column(0).to_pylist(), np.float64).reshape(sample.num_rows, lengths["n"])
    codes = learn(seen if len(seen) else np.ones((1, lengths["n"])), k, within)
    found = settle(_search(index, asked, codes, codes.radius, k, blocks, chunks))
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, n - 1))
    lacking = settle(asked.join(enough, "query_id", "left_anti"))
    more = _search(index, lacking, codes, BITS, k, blocks, chunks)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.unionAll(more).distinct().withColumn("rank", best).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
