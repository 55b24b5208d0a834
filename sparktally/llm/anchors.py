"""Personal data: anchors found by Aho-Corasick, boundaries by local parsers."""

from __future__ import annotations

import re
import string

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: In the order in which spans of one start are listed; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
#: Words that announce an identifier of a person or an account, in letters of either case.
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "passport", "ssn", "social security", "tax id",
        "customer id", "user id", "token", "password", "secret", "api_key", "api key")

#: Cues whose value is a secret: after a separator or "is" it is all up to the next white space or quote.
SECRETS = frozenset(("token", "password", "secret", "api_key", "api key"))

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_SCHEME = frozenset(string.ascii_letters + string.digits + "+.-")
_DIGITS = "0123456789"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_FOUR_PARTS = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL_REST = re.compile(r"[^\s<>\"'`{}|\\^]+")
_AFTER_CUE = re.compile(r"(?: ?(?:number|no|nr|id)(?![a-z])\.?)?(?: is(?![a-z]))?[ \t]{0,2}[:=#]?[ \t]{0,2}[\"']?", re.I | re.A)
# Groups of digits may follow; the last one goes on to the end of its word.
_IDENTIFIER = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9_-]*[A-Za-z0-9])?(?: [0-9]{2,4}(?![A-Za-z0-9]))*"
                         r"(?: [0-9]{2,4}[A-Za-z0-9]+)?")
_SEPARATOR = re.compile(r"[ \t]{0,2}(?:[:=]|is(?![a-z]))[ \t]{0,2}[\"']?", re.I | re.A)
_SECRET = re.compile(r"[^\s\"']+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _ascii_lower(text: str) -> str:
    """The text with A to Z in lower case: as many code points, each in its place."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode(
        "utf-8", "surrogatepass")


def _automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", ("at", 1))
    anchors.add_word("+", ("plus", 1))
    anchors.add_word("://", ("scheme", 3))
    for digit in _DIGITS:
        anchors.add_word(digit, ("digit", 1))
    for cue in CUES:
        anchors.add_word(cue, ("secret" if cue in SECRETS else "cue", len(cue)))
    anchors.make_automaton()
    return anchors


class Finder:
    """Spans (kind, start, end) of a text, in code points, by start and kind.

    Every anchor is tried once, from left to right, by the parser of its
    kind.  A parser does not enter what the same kind has already taken, so the base
    kinds give what a scan for their patterns from left to right gives: a
    candidate that fails its check is dropped and not tried again.
    """

    def __init__(self):
        self.anchors = _automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        found: list[tuple[str, int, int]] = []
        done = dict.fromkeys(KINDS, 0)
        for last, (anchor, length) in self.anchors.iter(_ascii_lower(text)):
            at = last + 1 - length
            if anchor == "digit":
                # Only the first digit of a run can begin something.
                if not at or text[at - 1] not in _DIGITS:
                    self._number(text, at, done, found)
            elif anchor == "at":
                self._email(text, at, done, found)
            elif anchor == "plus":
                if match := _PHONE.match(text, at):
                    if 9 <= len(_NOT_DIGIT.sub("", match[0])) <= 15:
                        found.append(("phone", at, match.end()))
            elif anchor == "scheme":
                self._url(text, at, done, found)
            elif anchor != "secret" or not self._secret(text, at, last + 1, done, found):
                self._account(text, at, last + 1, done, found)
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
        return found

    def _number(self, text, at, done, found):
        if at >= done["ip"] and (match := _FOUR_PARTS.match(text, at)):
            done["ip"] = match.end()
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.groups()):
                found.append(("ip", at, match.end()))
        if at >= done["card"] and (match := _DIGIT_CHAIN.match(text, at)):
            done["card"] = match.end()
            digits = _NOT_DIGIT.sub("", match[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", at, match.end()))

    def _email(self, text, at, done, found):
        start = at
        while start > done["email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (match := _DOMAIN.match(text, at + 1)):
            done["email"] = match.end()
            found.append(("email", start, match.end()))

    def _url(self, text, at, done, found):
        start = at
        while start > done["url"] and text[start - 1] in _SCHEME:
            start -= 1
        while start < at and not (text[start].isascii() and text[start].isalpha()):
            start += 1
        match = _URL_REST.match(text, at + 3)
        if start < at and match:
            end = at + 3 + len(match[0].rstrip(".,;:!?)]"))
            if end > at + 3 and text[at + 3].isalnum():
                done["url"] = end
                found.append(("url", start, end))

    def _secret(self, text, start, end, done, found) -> bool:
        if start and text[start - 1].isalnum() or not (separator := _SEPARATOR.match(text, end)):
            return False
        match = _SECRET.match(text, separator.end())
        value = match[0].rstrip(".,;") if match else ""
        # A plain word after "is" is most often none.
        if len(value) < 5 or value.isalpha() or match.start() < done["account"]:
            return False
        done["account"] = match.start() + len(value)
        found.append(("account", match.start(), done["account"]))
        return True

    def _account(self, text, start, end, done, found):
        if start and text[start - 1].isalnum() or end < len(text) and text[end].isalnum():
            return
        match = _IDENTIFIER.match(text, _AFTER_CUE.match(text, end).end())
        if match and match.start() > end and match.start() >= done["account"]:
            # A code of five characters or more, three of them digits.
            if len(match[0]) >= 5 and len(_NOT_DIGIT.sub("", match[0])) >= 3:
                done["account"] = match.end()
                found.append(("account", match.start(), match.end()))


_SPANS = "array<struct<kind:string,start:int,end:int>>"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id and `spans` of every row: kind, start and end (exclusive) in code points.

    Null and empty texts have no spans.  Rows are independent, so there is no shuffle: repeated rows
    and rows without an id each have their row, a table without rows gives none.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    of_span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def each(batches):
        finder = Finder()
        for batch in batches:
            found = [finder.spans(t.as_py()) for t in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found], dtype=np.int64)]).astype(np.int32)
            flat = [s for f in found for s in f]
            values = pa.StructArray.from_arrays(
                [pa.array([s[i] for s in flat], t.type) for i, t in enumerate(of_span)], fields=list(of_span))
            spans = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), spans], names=["doc_id", "spans"])

    return rows.mapInArrow(each, f"doc_id {kind}, spans {_SPANS}")


def spans_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*BASE))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(docs: DataFrame) -> DataFrame:
    """doc_id and text with every span replaced by its kind in brackets; overlapping ones by the first's."""
    rows = docs.select(F.col("doc_id"), F.col("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        finder = Finder()
        for batch in batches:
            texts = []
            for text in batch.column(1).to_pylist():
                parts, at = [], 0
                for name, start, end in finder.spans(text or ""):
                    if start >= at:
                        parts += [text[at:start], f"[{name}]"]
                    at = max(at, end)
                texts.append(text and "".join([*parts, text[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return rows.mapInArrow(each, f"doc_id {kind}, text string")
