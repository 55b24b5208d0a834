"""SentencePiece encoding: a forward search that words with a common prefix share.

The model is one of merges: SentencePiece joins the neighbours whose joint
piece scores best, again and again.  The sum of scores along a path does not
say which path that is, so a plain Viterbi search would give other ids than
the library.  What a search over prefixes needs is known for merges too: a
row of pieces is what merging leaves if and only if every two neighbours
are left apart when they are merged alone.  So the forward table holds, for
every prefix of a word, the one last piece that can stand there.
"""

from __future__ import annotations

from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words whose ids a task keeps between batches.
REMEMBERED = 400_000
#: Bytes of text that are encoded and handed back at once, about.
_OUT_BYTES = 4_000_000
_PROBES = ("a  b ", " x\n\ty", "ﬁ Å", "the theory of everything, and then some")

Model = tuple[list[str], list[float], list[bool], list[int]]


def read_model(path: str = MODEL) -> Model:
    """Pieces, scores, whether a piece is no text of its own, and the ids of the 256 byte pieces.

    The model must be one of merges with byte fallback that leaves texts as
    they are but for marking spaces and adding one at the front; a few texts are
    tried here.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    octets = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if any(model.is_unknown(i) for i in octets):
        raise ValueError(f"{path} has no byte pieces")
    special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in ids]
    read = [model.id_to_piece(i) for i in ids], [model.get_score(i) for i in ids], special, octets
    own = _Encoder(Vocabulary(read)).encode(list(_PROBES))
    for probe, found in zip(_PROBES, own):
        if np.frombuffer(found, np.int32).tolist() != model.encode(probe) or model.decode(model.encode(probe)) != probe:
            raise ValueError(f"{path} is of another kind, or changes texts before it encodes them")
    return read


class Vocabulary:
    """What `read_model` has read on the driver, made ready for search in a task."""

    def __init__(self, model: Model):
        texts, scores, special, self.bytes = model
        self.ids = {p: i for i, p in enumerate(texts) if not special[i]}
        #: The smaller, the earlier two neighbours are joined to the piece.
        self.ranks = {p: -scores[i] for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        #: UTF-8 of every id, for decoding; control and unknown pieces have none.
        of_byte = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.octets = [of_byte.get(i, b"" if special[i] else p.replace(MARK, " ").encode())
                       for i, p in enumerate(texts)]
        self._history: dict[str, tuple | None] = {}
        #: By left piece, which right ones were found to stay apart from it and which not.
        self._apart: dict[str, dict[str, bool]] = {}
        self._pairs = 0
        #: Every end of a piece: 0 if it is only that, 1 if it is a piece that merging leaves, 2 if that was not yet tried.
        self._ends = {p[k:]: 0 for p in self.ids for k in range(1, len(p))} | dict.fromkeys(self.ids, 2)
        # Words can be cut where a mark follows another character, and at line
        # feeds, only if no piece reaches over.
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError("the model has pieces that reach over words or lines")

    # ---- merges ----------------------------------------------------------

    def history(self, piece: str) -> tuple | None:
        """Ranks of the joins that make up a piece, and its first and last symbol before each and at the end.

        None if merging the piece alone leaves something else.
        """
        if piece not in self._history:
            symbols = list(piece)
            ranks, firsts, lasts = [], [symbols[0]], [symbols[-1]]
            while len(symbols) > 1:
                joint = [(self.ranks[a + b], k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))
                         if a + b in self.ranks]
                if not joint:
                    break
                rank, k = min(joint)
                symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
                ranks.append(rank)
                firsts.append(symbols[0])
                lasts.append(symbols[-1])
            self._history[piece] = (ranks, firsts, lasts) if len(symbols) == 1 else None
        return self._history[piece]

    def apart(self, left: str, right: str) -> bool:
        """Whether two neighbouring pieces stay apart: no join over their border comes first.

        Both sides are built up in the order of their joins; in between, the
        symbols at the border are joined if that ranks before the next join
        of either side, the left one going first among equals.
        """
        ranks_l, _, lasts = self.history(left)
        ranks_r, firsts, _ = self.history(right)
        i = j = 0
        stay = True
        while True:
            next_l = ranks_l[i] if i < len(ranks_l) else float("inf")
            next_r = ranks_r[j] if j < len(ranks_r) else float("inf")
            over = self.ranks.get(lasts[i] + firsts[j])
            if over is not None and over < next_l and over <= next_r:
                stay = False
                break
            if next_l == next_r == float("inf"):
                break
            if next_l <= next_r:
                i += 1
            else:
                j += 1
        return stay

    # ---- words -----------------------------------------------------------

    def encode_words(self, words: list[str]):
        """(word, ids as bytes of 32-bit numbers) of distinct words, in sorted order.

        Sorted words are a walk through their trie, depth first: what two
        neighbours have in common is the path that stays.  The last pieces of
        its prefixes are kept, only the rest of a word is searched.
        """
        ends, pairs = self._ends, self._apart
        if self._pairs > 4 * REMEMBERED:
            pairs.clear()
            self._pairs = 0
        right_of: list[dict[str, bool]] = [{}]  # of the last piece of each prefix, what is known of its neighbours
        last, start, before = [""], [0], ""
        for word in sorted(words):
            n, same = len(word), 0
            limit = min(n, len(before))
            while same < limit and word[same] == before[same]:
                same += 1
            del last[same + 1:], start[same + 1:], right_of[same + 1:]
            for end in range(same + 1, n + 1):
                at = end
                while at:
                    at -= 1
                    piece = word[at:end]
                    whole = ends.get(piece)
                    if whole is None:  # no piece ends so, nor with more in front
                        at = -1
                        break
                    if whole == 2:
                        whole = ends[piece] = int(self.history(piece) is not None)
                    if not whole:
                        continue
                    if not at:
                        break
                    stay = right_of[at].get(piece)
                    if stay is None:
                        stay = right_of[at][piece] = self.apart(last[at], piece)
                        self._pairs += 1
                    if stay:
                        break
                else:
                    at = -1
                if at < 0:  # a character of no piece, which nothing joins
                    at, piece = end - 1, word[end - 1]
                last.append(piece)
                start.append(at)
                right_of.append(pairs.setdefault(piece, {}))
            before = word
            yield word, self._path(word, start)

    def _path(self, word: str, start: list[int]) -> bytes:
        ids, end = [], len(word)
        while end:
            at = start[end]
            piece = self.ids.get(word[at:end])
            if piece is None:
                ids += [self.bytes[b] for b in reversed(word[at:end].encode("utf-8", "surrogatepass"))]
            else:
                ids.append(piece)
            end = at
        ids.reverse()
        return array("i", ids).tobytes()

    def words_of(self, text: str) -> list[str]:
        """Marked words whose encodings, one after the other, are that of the text."""
        words: list[str] = []
        if not text:
            return words
        for k, line in enumerate(text.split("\n")):
            marked = f" {line}" if k == 0 else line
            if k:
                words.append("\n")
            if "  " in marked or marked.endswith(" "):
                words += _runs_of_marks(marked)
            else:
                parts = marked.split(" ")
                if parts[0]:
                    words.append(parts[0])
                words += [MARK + p for p in parts[1:]]
        return words

    def decode(self, ids) -> str:
        octets = b"".join(map(self.octets.__getitem__, ids))
        return octets.decode("utf-8", "replace").removeprefix(" ")


def _runs_of_marks(line: str) -> list[str]:
    """Runs of spaces, each with the characters up to the next run."""
    words, part = [], ""
    for p in line.split(" "):
        # `part` holds the marks since the last word.
        if p:
            words.append(part + p)
            part = ""
        part += MARK
    if len(part) > 1:
        words.append(part[:-1])
    return words


class _Encoder:
    """Ids of texts, with the words of a task remembered up to a bound."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary, self.remembered = vocabulary, remembered
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.vocabulary.words_of(t) for t in texts]
        new = set(chain.from_iterable(split)).difference(self.known)
        if len(self.known) + len(new) > self.remembered:
            self.known.clear()
            new = set(chain.from_iterable(split))
        self.known.update(self.vocabulary.encode_words(new))
        look = self.known.__getitem__
        return [b"".join(map(look, words)) for words in split]


def encode(docs: DataFrame, model: str = MODEL, check: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids of every row; with `check` also whether decoding gives the text back.

    The ids are those of the library; a character of no piece becomes its
    UTF-8 bytes.  Null and empty texts have no ids.  No
    shuffle: distinct words are sorted and searched per Arrow batch, and what a
    task has found it remembers up to a bound.  A literal U+2581 is encoded as a
    space, as the format has no other mark, and is then not `exact`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>"
    schema += ", exact boolean" * check

    def each(batches):
        vocabulary = Vocabulary(shared.value)
        encoder = _Encoder(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            at = 0
            while at < batch.num_rows:
                end, size = at, 0
                while end < batch.num_rows and (end == at or size < _OUT_BYTES):
                    size += texts[end].as_buffer().size
                    end += 1
                part = texts.slice(at, end - at).to_pylist()
                encoded = encoder.encode(part)
                sizes = np.array([len(e) // 4 for e in encoded], np.int64)
                flat = np.frombuffer(b"".join(encoded), np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                out = [batch.column(0).slice(at, end - at), pa.array(sizes), ids]
                if check:
                    out.append(pa.array([vocabulary.decode(np.frombuffer(e, np.int32).tolist()) == t
                                         for e, t in zip(encoded, part)]))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_tokens", "ids", "exact"][:len(out)])
                at = end

    return rows.mapInArrow(each, schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids are no text at all: null."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_model(model))
    rows = encoded.select("doc_id", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return rows.mapInArrow(each, f"doc_id {kind}, text string")
