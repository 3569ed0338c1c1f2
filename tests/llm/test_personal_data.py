import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from stockmap.llm.personal_data import BASE_KINDS, anchors, find_spans, luhn, personal_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AUTO = anchors()


def by_pattern(text):
    """The base spans by the patterns themselves, left to right."""
    def holds(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in s.split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
    return {k: [m.span() for m in re.finditer(p, text) if holds(k, m.group())] for k, p in PATTERNS.items()}


PIECES = st.sampled_from(["a", "b.c", "@", "@@", ".", "..", "-", "+", "+4", " ", "(", ")", "0", "7", "12", "255", "256", "1.2.3.4",
                          "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 30 1234567", "x@y.de", "x@y", "é", "_", "%", "\n"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=25).map("".join))
def test_base_spans_equal_the_patterns(text):
    found = find_spans(text, AUTO)
    assert {k: found[k] for k in BASE_KINDS} == by_pattern(text)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_anchored_extras():
    def one(text, kind):
        return [text[s:e] for s, e in find_spans(text, AUTO)[kind]]
    assert one("pay to IBAN: DE89 3704 0044 0532 0130 00 TODAY", "account") == ["DE89 3704 0044 0532 0130 00"]
    assert one("IBAN DE88 3704 0044 0532 0130 00", "account") == []
    assert one("her SSN 123-45-6789, his SSN 000-12-3456", "account") == ["123-45-6789"]
    assert one("Account number: 12345678.", "account") == ["12345678"]
    assert one("anerssn: 123-45-6789 accounting 12345678", "account") == []
    assert one("see ftp://ann:pw1@host.example/x y https://host.example/", "login") == ["ftp://ann:pw1@host.example/x"]


def test_cues_in_any_case_and_grouped_numbers():
    def accounts(text):
        return [text[s:e] for s, e in find_spans(text, AUTO)["account"]]
    for cue in ("Social Security number", "sOCIAL security NUMBER", "SOCIAL SECURITY NUMBER is", "Ssn"):
        assert accounts(f"é {cue} 123-45-6789.") == ["123-45-6789"]
    assert accounts("My aCCount number is 12345678, the passport No. is C01234567") == ["12345678", "C01234567"]
    assert accounts("account number: 1234 5678 90, acct # 12-345-678") == ["1234 5678 90", "12-345-678"]
    assert accounts("IBAN is DE89 3704 0044 0532 0130 00.") == ["DE89 3704 0044 0532 0130 00"]
    # No number is announced, too few or too many digits, or the run goes on.
    assert accounts("account 2019 2020; account number is 12 34; account no. 1234-5678-ab; on account of 12 345 678 sales") == ["1234-5678"]
    assert accounts("account number 123456 123456 123456 1234567890") == ["123456"]
    assert accounts("K\u212ASSN \u0130ban account\u017f 12345678") == []  # other cases of non-ASCII letters do not count


def test_long_runs_take_linear_time():
    n = 300_000
    for text in ("a" * n, "1" * n, "a@" * n, "1." * n, "+1" * n, "1 " * n, "a" * n + "@", "account number " + "12 " * n, "ssn " * n):
        found = find_spans(text, AUTO)
        assert sum(map(len, found.values())) < n


def test_rows_nulls_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "x@y.de é +49 30 1234567", 7), (1, "x@y.de", 8), (1, "x@y.de", 8)],
                               "doc_id long, text string, n_email int")
    rows = sorted((tuple(r) for r in personal_data(df).collect()), key=repr)
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 5 and sum(r[5] == empty and r[6] == "" for r in rows) == 2
    r = next(r for r in rows if r[0] is None)
    assert r[1:5] == (1, 0, 0, 1) and r[6] == "email:0:6,phone:9:23"
    assert r[5] == hashlib.sha256(r[6].encode()).hexdigest()
    assert personal_data(df.limit(0)).count() == 0
