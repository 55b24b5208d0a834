"""Document fingerprints: a digest of the quartiles of byte-triplet buckets."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, functions as F

#: Buckets of the triplets' hash; two bits each in the digest.
BUCKETS = 128
#: Difference from which two digests are not alike at all.
BOUND = 256
#: Rows that a block of neighbours should have, and blocks at most.
BLOCK_ROWS, MOST_BLOCKS = 1024, 10_000
_CHUNK = 1 << 20


def bucket_counts(data: bytes) -> np.ndarray:
    """How many byte triplets fall into each bucket; a long text is taken in chunks."""
    counts = np.zeros(BUCKETS, np.int64)
    octets = np.frombuffer(data, np.uint8)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for at in range(0, len(octets) - 2, _CHUNK):
        b = octets[at:at + _CHUNK + 2].astype(np.uint32)
        triplet = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        counts += np.bincount((triplet * np.uint32(2654435761)) >> shift, minlength=BUCKETS)
    return counts


def digest(text: str) -> str:
    """Hex text: one byte for the length, one for the quartiles' ratios, two bits per bucket.

    A bucket's bits say in which quarter of all buckets its count lies, so
    the digest depends on how triplets are spread and not on how many there are.
    """
    data = text.encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    levels = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = levels.reshape(-1, 4) @ np.array([64, 16, 4, 1], np.uint8)
    length = min(255, int(np.log1p(len(data)) * 10))
    ratios = (int(q1 * 15 // q3) << 4 | int(q2 * 15 // q3)) if q3 else 0
    return bytes([length, ratios, *body.tolist()]).hex()


def difference(a: str, b: str) -> int:
    """Difference score of two digests, 0 to BOUND.

    Buckets count by their distance in quarters, opposite ends double; lengths and
    ratios add their own steps.
    """
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    crumbs = [np.stack([z[2:] >> s & 3 for s in (6, 4, 2, 0)]).astype(np.int8) for z in (x, y)]
    apart = np.abs(crumbs[0] - crumbs[1])
    body = int(apart.sum()) + 3 * int((apart == 3).sum())
    length = abs(int(x[0]) - int(y[0]))
    ratios = sum(abs((int(x[1]) >> s & 15) - (int(y[1]) >> s & 15)) for s in (4, 0))
    return min(BOUND, body + length // 2 + ratios)


def likeness(a: str, b: str) -> float:
    """1 for equal digests, 0 for a difference of BOUND or more."""
    return 1.0 - difference(a, b) / BOUND


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row; a null text counts as empty."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([digest(t) for t in texts], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return rows.mapInArrow(each, f"doc_id {kind}, n_chars long, fingerprint string")


# ---- neighbours ----------------------------------------------------------

def _blocks(docs: DataFrame, column: str) -> tuple[DataFrame, list]:
    """`docs` with a `block` that rises with doc_id, and the first id of each block.

    Blocks are cut at approximate quantiles of the ids, so their rows are near
    equal however the ids are spread; rows without an id are the last block.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    count = ids.count()
    n = max(1, min(MOST_BLOCKS, -(-count // BLOCK_ROWS)))
    shares = [i / n for i in range(1, n)]
    cuts = ids.agg(F.percentile_approx("id", shares, 10 * MOST_BLOCKS)).first()[0] if shares else []
    # A Bucketizer wants one inner split at least: one that no id lies below.
    inner = sorted({float(c) for c in cuts or []}) or [-float(1 << 63)]
    splits = [-float("inf"), *inner, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_as_double", outputCol="_cut", handleInvalid="keep")

    def dealt(df: DataFrame) -> DataFrame:
        return (cut.transform(df.withColumn("_as_double", F.col("id").cast("double")))
                .withColumn(column, F.coalesce(F.col("_cut").cast("int"), F.lit(len(splits))))
                .drop("_as_double", "_cut"))

    firsts = [(r[column], r["id"]) for r in
              dealt(ids).groupBy(column).agg(F.min("id").alias("id")).orderBy(column).collect()]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return dealt(rows), firsts


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next larger doc_id, after the last the
    first; among equal ids rows follow the hash of the text, and rows without an
    id come last.  The edited text is the text with its last floor(n / 2) code points
    replaced by the first as many, or all, of the next document.  Whole texts
    are shuffled once, into blocks of neighbouring ids; the first document of a block
    also travels to the block before it.  A task walks its blocks in order
    and holds two texts at a time.
    """
    rows, firsts = _blocks(docs, "block")
    spark = docs.sparkSession
    before = spark.createDataFrame(
        [(firsts[i - 1][0], first) for i, (_, first) in enumerate(firsts)], "to_block int, first long")
    # One row per block, at most MOST_BLOCKS.
    again = rows.join(F.broadcast(before), rows["id"].eqNullSafe(before["first"]))
    both = (rows.select("block", F.lit(False).alias("guest"), "id", "text")
            .unionAll(again.select(F.col("to_block").alias("block"), F.lit(True).alias("guest"), "id", "text")))
    walked = (both.repartition("block")
              .sortWithinPartitions("block", "guest", F.col("id").isNull(), "id", F.xxhash64("text")))

    def each(batches):
        held = None  # (block, id, text, digest) of the document before
        closed = None  # block whose guest has come
        for batch in batches:
            out = []
            for block, guest, doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                if guest and closed == block:
                    continue
                own = digest(text)
                if held is not None and held[0] == block:
                    out.append(_compared(*held[1:], text, own))
                held = None if guest else (block, doc_id, text, own)
                closed = block if guest else closed
            columns = list(zip(*out)) or [[]] * len(_NEXT)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NEXT)], schema=_NEXT)

    return walked.mapInArrow(each, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")


_NEXT = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                   ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                   ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compared(doc_id: int | None, text: str, own: str, following: str, next_digest: str) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    changed = digest(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(text), sha, own, changed, likeness(own, changed), likeness(own, next_digest))
