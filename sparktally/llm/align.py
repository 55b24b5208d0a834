"""Cross-tokenizer alignment: token groups between the byte offsets where both encodings end a token."""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections import Counter
from itertools import accumulate, chain, count
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from sparktally.llm.common import settle

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: UTF-8 bytes of text that make up a chunk: documents whose links are looked up together.
CHUNK_BYTES = 8 << 20
#: Links of a group that are listed one by one; a larger group is reduced to its distinct ids first.
LISTED = 4_096
#: Words that a task keeps aligned, and the length up to which it does.
REMEMBERED, LONGEST = 600_000, 256
#: A space between two characters that are none: both sides begin a token there, so words are encoded and aligned alone.
_CUT = re.compile(r"(?<=\S) (?=\S)")


# ---- the two vocabularies ------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes, in
    order, for the letters from U+0100.
    """
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Encoding with a byte-level vocabulary file; `octets[id]` are a token's bytes."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(data)
        self.library.encode_special_tokens = True
        letters = _byte_letters()
        special = {t["content"] for t in json.loads(data)["added_tokens"]}
        vocabulary = self.library.get_vocab()
        self.octets = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            if token not in special:
                self.octets[i] = bytes(letters[c] for c in token)

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words, each with the space before it."""
        return [e.ids for e in self.library.encode_batch_fast([" " + w for w in words], add_special_tokens=False)]


class Pieces:
    """Encoding with a piece model file that puts a space before the text."""

    def __init__(self, data: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=data)
        self.octets, self.cuts = [], True
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.octets.append(bytes([int(piece[3:-1], 16)]))
            else:
                self.octets.append(piece.replace(MARK, " ").encode())
                # Where a piece goes on after a space, a text cannot be cut before one.
                self.cuts &= MARK not in piece.lstrip(MARK)

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words; the library puts a space before each."""
        return self.library.encode(words, num_threads=1)


#: n_a, n_b, n_groups, n_links, the groups as text (None if the bytes do not come back), the linked pairs as bytes
#: of 64-bit numbers, repeats included, and those of large groups as (pair, times).
Word = tuple[int, int, int, int, str | None, bytes, tuple[tuple[int, int], ...]]


_NOT_GIVEN_BACK: Word = (0, 0, 0, 0, None, b"", ())


class Aligner:
    """Both encodings of texts, and their groups and links.

    What a text gives is put together from its words, as no token of either
    side goes on from one word to the next; distinct words are worked out once.
    """

    def __init__(self, byte_level: bytes, pieces: bytes, remembered: int = REMEMBERED):
        self.a, self.b = ByteLevel(byte_level), Pieces(pieces)
        self.sizes = [list(map(len, side.octets)) for side in (self.a, self.b)]
        self.decimal = [list(map(str, range(len(side.octets)))) for side in (self.a, self.b)]
        self.width = len(self.b.octets)
        self.known: dict[str, Word] = {}
        self.remembered = remembered

    def back(self, words: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> bool:
        """Whether both sides give the bytes of all these words back, each with its space."""
        whole = "".join([" " + w for w in words]).encode("utf-8", "surrogatepass")
        return all(b"".join(map(side.octets.__getitem__, chain.from_iterable(ids))) == whole
                   for side, ids in ((self.a, ids_a), (self.b, ids_b)))

    def word(self, ids_a: list[int], ids_b: list[int]) -> Word:
        """The groups of one word and the links of each.

        The ends of a side's tokens are a dictionary from byte offset to
        number of tokens; the offsets that both dictionaries hold, in order, are the ends of the groups.
        """
        (sizes_a, sizes_b), (text_a, text_b), width = self.sizes, self.decimal, self.width
        index_a = dict(zip(accumulate(map(sizes_a.__getitem__, ids_a)), count(1)))
        index_b = dict(zip(accumulate(map(sizes_b.__getitem__, ids_b)), count(1)))
        said, pairs, large, n_links, a, b = [], [], None, 0, 0, 0
        for end in sorted(index_a.keys() & index_b.keys()):
            end_a, end_b = index_a[end], index_b[end]
            if end_a - a == end_b - b == 1:
                x, y = ids_a[a], ids_b[b]
                said.append(f"{x}|{y}")
                pairs.append(x * width + y)
                n_links += 1
            else:
                left, right = ids_a[a:end_a], ids_b[b:end_b]
                said.append(",".join([text_a[i] for i in left]) + "|" + ",".join([text_b[i] for i in right]))
                n = len(left) * len(right)
                n_links += n
                if n <= LISTED:
                    pairs += [x * width + y for x in left for y in right]
                else:
                    large, often = large or Counter(), Counter(right)
                    for x, i in Counter(left).items():
                        for y, j in often.items():
                            large[x * width + y] += i * j
            a, b = end_a, end_b
        return (len(ids_a), len(ids_b), len(said), n_links, ";".join(said), array("q", pairs).tobytes(),
                tuple(large.items()) if large else ())

    def texts(self, texts: list[str | None]) -> list[tuple]:
        """n_a, n_b, n_groups, n_links, digest, distinct pairs ascending and how often each is linked, of every text.

        A text of which either side does not give all bytes back has none of them.
        """
        split = [[] if not t else _CUT.split(t) if self.b.cuts else [t] for t in texts]
        new = list(set(chain.from_iterable(split)).difference(self.known))
        if len(self.known) + len(new) > self.remembered:
            self.known.clear()
            new = list(set(chain.from_iterable(split)))
        ids_a, ids_b = self.a.encode(new), self.b.encode(new)
        sound = self.back(new, ids_a, ids_b)
        for w, a, b in zip(new, ids_a, ids_b):
            self.known[w] = self.word(a, b) if sound or self.back([w], [a], [b]) else _NOT_GIVEN_BACK
        out = [self._text([self.known[w] for w in words]) for words in split]
        for w in new:
            if len(w) > LONGEST:
                del self.known[w]
        return out

    def _text(self, words: list[Word]) -> tuple:
        n_a, n_b, n_groups, n_links, said, pairs, large = zip(*words) if words else [()] * 7
        if not words or None in said:
            return 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        found, times = np.unique(np.frombuffer(b"".join(pairs), np.int64), return_counts=True)
        more = list(chain.from_iterable(large))
        if more:
            found, place = np.unique(np.concatenate([found, [p for p, _ in more]]), return_inverse=True)
            weights, times = np.concatenate([times, [n for _, n in more]]), np.zeros(len(found), np.int64)
            np.add.at(times, place, weights)
        digest = hashlib.sha256(";".join(said).encode()).hexdigest()
        return sum(n_a), sum(n_b), sum(n_groups), sum(n_links), digest, found, times


# ---- the corpus ----------------------------------------------------------

_COLUMNS = "n_a long, n_b long, n_groups long, n_links long"


def _list_array(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))


def _aligned(docs: DataFrame, byte_level: bytes, pieces: bytes, chunk_bytes: int) -> DataFrame:
    """Per row its own figures, digest, distinct pairs with how often each is linked, and its chunk."""
    shared = docs.sparkSession.sparkContext.broadcast((byte_level, pieces))
    rows = docs.select("doc_id", "text")
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_COLUMNS}, groups_sha256 string, chunk long, " \
             "pairs array<long>, times array<long>"

    def each(batches):
        aligner = Aligner(*shared.value)
        chunk, room = TaskContext.get().partitionId() << 32, chunk_bytes
        for batch in batches:
            ids, texts = batch.columns
            at = 0
            while at < batch.num_rows:
                # A few documents at a time, all of one chunk.
                size, start = 0, at
                while at < batch.num_rows and size < min(room, chunk_bytes // 8):
                    size += texts[at].as_buffer().size if texts[at].is_valid else 1
                    at += 1
                out = aligner.texts(texts.slice(start, at - start).to_pylist())
                n_a, n_b, n_groups, n_links, sha, pairs, times = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, at - start), *[pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)],
                     pa.array(sha, pa.string()), pa.array([chunk] * len(out), pa.int64()),
                     _list_array(pairs), _list_array(times)],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "chunk", "pairs", "times"])
                room -= size
                if room <= 0:
                    chunk, room = chunk + 1, chunk_bytes

    return rows.mapInArrow(each, schema)


def _asked(batches):
    """The distinct pairs of each chunk, with the number of its documents that hold them."""
    kept, chunk = [], None
    for batch in batches:
        chunks = batch.column(0).to_numpy()
        lists = batch.column(1)
        for c in np.unique(chunks):
            if kept and c != chunk:
                yield _reduced(chunk, kept)
                kept = []
            chunk = c
            kept.append(pc.list_flatten(lists.filter(pa.array(chunks == c))).to_numpy())
    if kept:
        yield _reduced(chunk, kept)


def _reduced(chunk: int, kept: list[np.ndarray]) -> pa.RecordBatch:
    pairs, n = np.unique(np.concatenate(kept), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), chunk)), pa.array(pairs), pa.array(n)],
                                      names=["chunk", "pair", "n"])


def pair_counts(asked: DataFrame, width: int) -> DataFrame:
    """pair, docs, best: how many documents hold the pair linked, and whether no pair of its A id is in more.

    An A id has `width` pairs at most.
    """
    counts = asked.groupBy("pair").agg(F.sum("n").alias("docs"))
    most = F.max("docs").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return counts.select("pair", "docs", (F.col("docs") == most).alias("best"))


def align(docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every row of `docs`.

    Space + text is encoded by the byte-level file (A) and the piece file (B),
    without special tokens.  Byte offsets where tokens of both end cut them
    into groups; every A token is linked with every B token of its group.  A
    pair of ids counts in as many rows of `docs` as hold it linked; n_best are the
    links whose pair no other pair of the same A id exceeds, count_sum
    the sum of the counts over the links.

    Null and empty texts, and those that either file does not give back byte by
    byte (a literal U+2581, say), have no tokens: zeros and ''.  Repeated rows
    count one by one, also in the counts; ids may be null or repeated.

    Distinct words are aligned once per task, as far as it remembers them.  A task reduces the links of each text to distinct pairs, and the pairs of a
    chunk of documents to distinct ones again.  Only these are counted by a
    shuffle, met with the counts and sent back to their chunk, so a pair
    that every document holds is one row per chunk.
    """
    spark = docs.sparkSession
    files = [_read(spark, path) for path in (byte_level, pieces)]
    width = len(Pieces(files[1]).octets)
    aligned = settle(_aligned(docs, *files, chunk_bytes))
    asked = settle(aligned.select("chunk", "pairs").mapInArrow(_asked, "chunk long, pair long, n long"))
    counts = settle(pair_counts(asked, width))
    answers = asked.join(counts, "pair").select("chunk", "pair", "docs", "best")
    own = [f for f in aligned.schema if f.name not in ("chunk", "pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own) + ", n_best long, count_sum long"

    def summed(rows: pa.Table, found: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        pairs, docs_of, best = (found.column(c).to_numpy() for c in ("pair", "docs", "best"))
        order = np.argsort(pairs)
        lists = rows.column("pairs")
        flat, times = (pc.list_flatten(rows.column(c)).to_numpy() for c in ("pairs", "times"))
        place = order[np.searchsorted(pairs, flat, sorter=order)] if len(flat) else np.zeros(0, np.int64)
        ends = np.cumsum(pc.list_value_length(lists).to_numpy().astype(np.int64))

        def per_row(values: np.ndarray) -> pa.Array:
            total = np.append(0, np.cumsum(values))
            return pa.array(total[ends] - total[np.append(0, ends)[:-1]], pa.int64())

        sums = [per_row(np.where(best[place], times, 0)), per_row(docs_of[place] * times)]
        return pa.table([*[rows.column(f.name) for f in own], *sums], names=[*[f.name for f in own], "n_best", "count_sum"])

    return aligned.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(summed, schema)


def _read(spark, path: str) -> bytes:
    """A file's bytes: of the driver's own disk, or of any folder that Spark can read."""
    if Path(path).is_file():
        return Path(path).read_bytes()
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
