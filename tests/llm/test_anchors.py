"""Personal data against plain regular expressions."""

import hashlib
import re

import pytest
import tables
from hypothesis import given, settings, strategies as st

from sparktally.llm import anchors, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


FINDER = anchors.Finder()
TEXTS = ["a@b.c@d.e", "x..%y@-.-", "@b.c a@ b@c d@e.f.", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 001.002.003.004 1.2.3.4.",
         "4111 1111 1111 1111, 4111-1111-1111-1112 and 79927398713 0000000000000", "+1 (555) 010-9999. ++12 345 678 90-",
         "+1+2 345678901 +123456789", "a@b.c+1 555 123 4567 8", "9.9.9.9@9.9.9.9", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
         "", "+", "@", "1", "é@ü.de ä.b@c.de", "1." * 400]


def test_base_spans_equal_the_patterns():
    for text in TEXTS:
        assert [s for s in FINDER.spans(text) if s[0] in anchors.BASE] == plain(text), text


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="a1290.@+- ()\né", max_size=60))
def test_any_text_equals_the_patterns(text):
    assert [s for s in FINDER.spans(text) if s[0] in anchors.BASE] == plain(text)


def test_spans_that_the_method_adds():
    text = 'See https://www.example.org/a?b=1, IBAN: DE89 3704 0044 0532 0130 00 and token = "463a598be7e7".'
    found = {(k, text[a:b]) for k, a, b in FINDER.spans(text) if k not in anchors.BASE}
    assert found == {("url", "https://www.example.org/a?b=1"), ("account", "DE89 3704 0044 0532 0130 00"),
                     ("account", "463a598be7e7")}


def accounts(text):
    return [text[a:b] for k, a, b in FINDER.spans(text) if k == "account"]


def test_cues_in_any_case():
    for cue in anchors.CUES:
        for form in (cue, cue.upper(), cue.title(), cue.capitalize(), cue.swapcase()):
            assert accounts(f"\u0130\u00c4 {form}: 12345678.") == ["12345678"], form
            for word in ("Number", "NUMBER", "No", "No.", "NR", "Id", "ID"):
                assert accounts(f"{form} {word}: 12345678") == accounts(f"{form} {word} 12345678") == ["12345678"]
    assert accounts("API key abc12345, API Key abd12345") == ["abc12345", "abd12345"]
    assert accounts("Passport No: X1234567, passport notice771") == ["X1234567", "notice771"]


def test_identifiers_end_with_their_word():
    assert accounts("ACCOUNT NUMBER 12345678") == ["12345678"]
    assert accounts("account 1234 56789 and iban DE89 3704 0044 05x.") == ["1234 56789", "DE89 3704 0044 05x"]


def test_numbers_after_title_case_cues_are_masked(spark):
    docs = spark.createDataFrame([(1, "Account Number: 12345678; ACCOUNT NUMBER 12345678; Tax ID 12345678")],
                                 "doc_id long, text string")
    masked = "Account Number: [account]; ACCOUNT NUMBER [account]; Tax ID [account]"
    assert tables.table(anchors.masked(docs)) == [(1, masked)]


def test_query_columns(spark, tmp_path):
    tables.clashing(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op9_personal_data(spark, str(tmp_path)).collect():
        text = next(t for d, t, *_ in tables.AWKWARD if d == r.doc_id) or ""
        base = plain(text)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        digest = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()


def test_masked_text(spark):
    docs = spark.createDataFrame([(1, "to a@b.co now"), (2, None), (3, "")], "doc_id long, text string")
    assert tables.table(anchors.masked(docs)) == [(1, "to [email] now"), (2, None), (3, "")]
    assert anchors.find_personal_data(tables.empty(spark)).count() == 0


@pytest.mark.parametrize("text,found", [
    ("account number is 12345678.", "12345678"), ("My password is hunter2, yes", "hunter2"),
    ("password=abcDEF123!@#x more", "abcDEF123!@#x"), ('token: "a1-b2_c3"', "a1-b2_c3"), ("Passport No is X1234567", "X1234567"),
    ("the password is missing", None), ("secret garden", None), ("an account is opened", None)])
def test_boundaries_of_account_values(text, found):
    spans = [text[s:e] for k, s, e in anchors.Finder().spans(text) if k == "account"]
    assert spans == ([found] if found else [])
