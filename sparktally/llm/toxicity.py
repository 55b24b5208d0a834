"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton over folded text."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparktally.llm.common import settle

#: Labelled rows a lexicon is learned from, at most about so many, chosen by hash of the id.
TRAINING_ROWS = 8_000
#: Lengths of the word beginnings that can become terms, besides whole words.
STEMS = range(3, 11)
#: How far above the chance of so many candidates a term's log-likelihood ratio must lie.
MARGIN = 8.0
#: Insults to start from, as whole words; labels confirm their weight or take them out.
BASE = ("bastard", "clown", "creep", "cretin", "disgusting", "dumb", "filth", "fool", "garbage", "idiot", "imbecile",
        "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash", "vermin", "worthless")
BASE_WEIGHT = 5.0
#: Phrases in which a term does no harm.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "sore loser", "pathetic fallacy", "scum line")

# Letters of other scripts that look like Latin ones, and digits
# that are written for letters.
_LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "н": "h", "в": "b",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ν": "v", "κ": "k", "ι": "i", "τ": "t", "υ": "u", "χ": "x", "η": "n",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
_INVISIBLE = "​‌‍⁠﻿­"


def _fold_table() -> dict[int, str | None]:
    """Code points of a lower-case text and what they become."""
    table: dict[int, str | None] = {ord(a): b for a, b in (_LOOKALIKES | _DIGITS).items()}
    table |= {ord(c): None for c in _INVISIBLE}
    for i in range(26):  # full-width letters
        table[0xFF41 + i] = chr(ord("a") + i)
    table |= {code: None for code in range(0x300, 0x370)}  # marks that belong to no letter
    return table


def _plain_table() -> dict[int, str]:
    """Letters with marks and the letters below them."""
    bases = {code: unicodedata.normalize("NFD", chr(code))[0]
             for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
    return {code: base for code, base in bases.items() if base != chr(code) and base.isascii()}


_FOLD, _PLAIN = _fold_table(), _plain_table()
_TOKEN = re.compile(r"[^\W\d_]+")
_NEXT = re.compile(r" [^\W\d_]+")


def fold(text: str) -> str:
    """The text in lower case, look-alikes and digits as the letters they stand for.

    Letters with marks stay: in their language they are letters of their own.
    """
    return unicodedata.normalize("NFC", text.lower()).translate(_FOLD)


@dataclass
class Lexicon:
    """Terms with weights, exception phrases, and the line that turns a sum into a score.

    A term ending in "$" is a whole word, any other one the beginning of a word.
    """

    weights: dict[str, float] = field(default_factory=lambda: {f"{w}$": BASE_WEIGHT for w in BASE})
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -4.0
    slopes: tuple[float, float] = (1.0, 1.0)

    def matcher(self) -> "_Matcher":
        return _Matcher(self)


class _Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.terms = self._automaton((t.rstrip("$"), (t, w)) for t, w in lexicon.weights.items())
        self.phrases = self._automaton((fold(p), p) for p in lexicon.exceptions)

    @staticmethod
    def _automaton(words):
        found: dict[str, list] = {}
        for word, value in words:
            found.setdefault(word, []).append(value)
        automaton = ahocorasick.Automaton()
        for word, values in found.items():
            automaton.add_word(word, (len(word), values))
        automaton.make_automaton()
        return automaton if found else None

    def _matches(self, folded: str) -> list[tuple[int, int, str, float]]:
        found = []
        for last, (length, values) in self.terms.iter(folded):
            start, end = last + 1 - length, last + 1
            if start and folded[start - 1].isalpha():
                continue
            inside = end < len(folded) and folded[end].isalpha()
            found += [(start, end, t, w) for t, w in values if not (inside and t[-1] == "$")]
        return found

    def hits(self, folded: str) -> list[tuple[int, int, str, float]]:
        """(start, end, term, weight) of each match that is no part of an exception phrase."""
        if self.terms is None:
            return []
        found = self._matches(folded)
        if not folded.isascii():
            # Marks on the letters of a whole word are a disguise, on its beginning they may be another word.
            seen = {h[:2] for h in found}
            found += [h for h in self._matches(folded.translate(_PLAIN)) if h[2][-1] == "$" and h[:2] not in seen]
        if found and self.phrases is not None:
            spans = []
            for last, (length, _) in self.phrases.iter(folded):
                start, end = last + 1 - length, last + 1
                if (not start or not folded[start - 1].isalpha()) and (
                        end == len(folded) or not folded[end].isalpha()):
                    spans.append((start, end))
            found = [h for h in found if not any(s <= h[0] and h[1] <= e for s, e in spans)]
        return found

    def measures(self, text: str) -> tuple[float, float, int]:
        """Sum of weights, damped; the same per length; number of hits."""
        hits = self.hits(fold(text))
        total = sum(h[3] for h in hits)
        return float(np.log1p(total)), float(np.log1p(1000.0 * total / (len(text) + 200.0))), len(hits)

    def score(self, measures: np.ndarray) -> np.ndarray:
        z = self.lexicon.bias + measures @ np.array(self.lexicon.slopes)
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


# ---- learning ------------------------------------------------------------

def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """text and toxic of labelled rows outside the held-out fold, about `most` at most.

    Ids and labels are joined first, so only chosen texts travel.  Copies and
    near copies, told by the three smallest hashes of their long words, are taken
    once: a text that is repeated a thousand times says no more than one.
    """
    known = (labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(~held_out(F.col("doc_id"))))
    known = settle(known)
    keep = max(1, -(-known.count() // most))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(keep)) == 0)
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(chosen, "doc_id")
    long_words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{9,}"), F.lit(0))
    hashes = F.slice(F.array_sort(F.transform(F.array_distinct(long_words), lambda w: F.xxhash64(w))), 1, 3)
    sign = F.when(F.size(hashes) == 3, F.xxhash64(hashes)).otherwise(F.xxhash64("text"))
    rows = settle(rows.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"), sign.alias("sign")))
    once = rows.groupBy("sign", "toxic").agg(F.min("doc_id").alias("doc_id"))
    return settle(rows.join(once, ["doc_id", "sign", "toxic"], "left_semi").select("text", "toxic"))


def _terms(text: str) -> Counter:
    """In how many distinct words of the text each term is: whole words and beginnings of words."""
    words = set(_TOKEN.findall(fold(text)))
    terms = Counter(w + "$" for w in words if len(w) > 2)
    for n in STEMS:
        terms.update(w[:n] for w in words if len(w) >= n)
    return terms


def _count_terms(batches):
    """(term, documents and distinct words with it in toxic and in clean texts); "" counts all words."""
    for batch in batches:
        documents, words = (Counter(), Counter()), (Counter(), Counter())
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            terms = _terms(text)
            documents[label].update(terms.keys())
            words[label].update(terms)
            words[label][""] += sum(n for t, n in terms.items() if t[-1] == "$")
        names = list(words[0] | words[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64())
                                             for c in (documents[1], words[1], documents[0], words[0])]],
            names=["term", "dt", "wt", "dc", "wc"])


def learn(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS,
          exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from the labelled rows outside the held-out fold.

    Whole words and beginnings of words are counted by the distinct words of
    documents that have them.  One that toxic documents have more often than
    chance allows, among so many candidates, and three of them at least, is a
    term; its weight is the log ratio of its shares.  Of terms that begin
    alike the most telling one is kept.  The base words are terms unless clean
    documents have them too.  A phrase of a term and its neighbour that
    only clean documents have, twice or more, is an exception.  The training rows
    alone bound how many terms and phrases there are.  Without labels of both kinds the lexicon is that of the base words, with usual weights.
    """
    rows = training_rows(docs, labels, most)
    n_toxic, n = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    if not 0 < (n_toxic or 0) < n:
        return Lexicon(exceptions=exceptions)
    counts = rows.mapInArrow(_count_terms, "term string, dt long, wt long, dc long, wc long").groupBy("term").agg(
        *[F.sum(c).alias(c) for c in ("dt", "wt", "dc", "wc")])
    counts = settle(counts.where("dt + dc >= 3 or term = ''"))
    every = counts.where("term = ''").first()
    candidates = counts.count()
    # Log-likelihood ratio of "as often among the words of toxic texts as among all".
    share = every.wt / max(1, every.wt + every.wc)

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    both = F.col("wt") + F.col("wc")
    ratio = 2 * (part(F.col("wt"), both * share) + part(F.col("wc"), both * (1 - share)))
    bound = 2 * float(np.log(max(candidates, 2))) + MARGIN
    often = (F.col("dt") >= 3) & (F.col("wt") * every.wc > 4 * F.col("wc") * every.wt)
    telling = (counts.where("term <> ''").withColumn("g", ratio).where(often & (F.col("g") > bound))
               .orderBy(F.desc("g"), F.desc(F.length("term")), "term"))
    kept: dict[str, float] = {}
    heads: set[str] = set()
    for row in telling.collect():
        word = row.term.rstrip("$")
        if row.term in heads or any(word[:k] in kept for k in range(1, len(word) + 1)) or word + "$" in kept:
            continue
        kept[row.term] = float(np.log((row.wt + 0.5) / (every.wt + 1)) - np.log((row.wc + 0.5) / (every.wc + 1)))
        heads.update(word[:k] for k in range(1, len(word) + 1))
    base = [f"{w}$" for w in BASE]
    common = {r.term for r in counts.where(F.col("term").isin(base)).where(~often & (F.col("dc") > 0)).collect()}
    kept |= {t: BASE_WEIGHT for t in base if t not in common and not any(t[:k] in kept for k in range(1, len(t) + 1))}
    lexicon = Lexicon(kept, exceptions)
    lexicon.exceptions = (*exceptions, *_learned_exceptions(rows, lexicon))
    _fit(rows, lexicon)
    return lexicon


def _with_neighbours(folded: str, start: int) -> list[str]:
    """The word at `start` with the word before it and with the one after it, whole words of any length, a space between."""
    word = _TOKEN.match(folded, start)
    out = []
    if start and folded[start - 1] == " ":
        first = start - 1
        while first and _TOKEN.match(folded[first - 1]):
            first -= 1
        if first < start - 1:
            out.append(folded[first:word.end()])
    if right := _NEXT.match(folded, word.end()):
        out.append(folded[start:right.end()])
    return out


def _learned_exceptions(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    def phrases(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            found, labels = [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded, own = fold(text), set()
                for start, _, _, _ in matcher.hits(folded):
                    own.update(_with_neighbours(folded, start))
                found += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(labels, pa.int32())],
                                             names=["phrase", "toxic"])

    seen = rows.mapInArrow(phrases, "phrase string, toxic int")
    clean = (seen.groupBy("phrase").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
             .where("t = 0 and n >= 2").orderBy(F.desc("n"), "phrase"))
    return [r.phrase for r in clean.collect()]


def _measured(rows: DataFrame, lexicon: Lexicon, extra: str, kind: str) -> DataFrame:
    """(extra, total, per_length, hits) of every row of (extra, text)."""
    def each(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            found = [matcher.measures(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.float64()),
                 pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.int64())],
                names=[extra, "total", "per_length", "hits"])

    return rows.select(extra, "text").mapInArrow(each, f"{extra} {kind}, total double, per_length double, hits long")


def _fit(rows: DataFrame, lexicon: Lexicon, rounds: int = 50, ridge: float = 0.05) -> None:
    """Logistic regression of the label on the two sums, over the bounded training rows."""
    table = _measured(rows, lexicon, "toxic", "int").toArrow()
    y = table.column("toxic").to_numpy().astype(float)
    x = np.column_stack([np.ones(len(y)), table.column("total").to_numpy(), table.column("per_length").to_numpy()])
    beta = np.zeros(3)
    penalty = np.diag([1e-6, ridge, ridge])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    lexicon.bias, lexicon.slopes = float(beta[0]), (float(beta[1]), float(beta[2]))


# ---- scoring -------------------------------------------------------------

def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, text_hash, score, predicted, hits of every row, from its whole text alone.

    The text is lower-cased, look-alike letters and digits are folded to Latin
    letters, terms are found in one pass and whole words also without marks, matches inside exception
    phrases are left out, and the sum of weights goes into the score as it is and per length.
    Null and empty texts have the score of a text without a match.
    """
    rows = docs.select(F.col("doc_id"), F.xxhash64("text").alias("text_hash"),
                       F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            found = np.array([matcher.measures(t.as_py()) for t in batch.column(2)]).reshape(-1, 3)
            scores = matcher.score(found[:, :2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)),
                 pa.array(found[:, 2].astype(np.int64))],
                names=["doc_id", "text_hash", "score", "predicted", "hits"])

    return rows.mapInArrow(each, f"doc_id {kind}, text_hash long, score double, predicted int, hits long")


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` whose score is below one half, by a lexicon learned from `labels`."""
    lexicon = learn(docs, labels)

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = lexicon.matcher()  # once per task
        for texts in batches:
            found = np.array([matcher.measures(t or "")[:2] for t in texts]).reshape(-1, 2)
            yield pd.Series(matcher.score(found) < 0.5)

    return docs.where(clean(F.coalesce(docs["text"], F.lit(""))))
