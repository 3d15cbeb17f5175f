from __future__ import annotations

import hashlib
import re

import pytest

from skyledger.llm.pii import digest_pii, find_pii, redact_pii, redacted
from tests.llm.corpus import AWKWARD, frame

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
IBAN = "GB82WEST12345698765432"
ROWS = [
    *AWKWARD,
    (100, "😀 mail a.b@c.de or x@y.z_w@q.rs, a@@b.c, a@b.c@d.e.f end@"),
    (101, "1.2.3.4.5.6.7.8 and 256.1.1.1, 0255.000.1.01 1.2.3 9.9.9.9999"),
    (102, "card 4111 1111 1111 1111, 4111-1111-1111-1112 41111111111111111111 12 34"),
    (103, "call +1 (555) 123-4567 or +49.30.1234 567 8901 234567 +1 +12-"),
    (104, f"account {IBAN} and {IBAN[:-1]}3 ssn 123-45-6789, 987-65-4321 " + "z" * 60 + " 111-22-3333"),
    (105, "1" * 20_000 + " " + "1 " * 9_000 + "a." * 9_000 + "@" + "+1" * 5_000),
    (106, "5500005555555559, 4111111111111111@mail.com 10.0.0.1@x.y"),
]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def holds(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text: str) -> list[tuple]:
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if holds(kind, m[0])
    ]


@pytest.fixture(scope="module")
def found(spark):
    return {r["doc_id"]: r for r in digest_pii(frame(spark, ROWS)).collect()}


@pytest.mark.parametrize("row", ROWS, ids=lambda r: str(r[0]))
def test_base_spans(found, row):
    doc_id, text = row
    if doc_id is None or doc_id == 7:
        return
    spans = base(text or "")
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    got = found[doc_id]
    assert [got[f"n_{k}"] for k in PATTERNS] == [sum(x[0] == k for x in spans) for k in PATTERNS]
    assert got["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert got["spans"].startswith(joined)


def test_added_spans(found):
    text = dict(ROWS)[104]
    at = text.index(IBAN)
    first, second = text.index("123-45"), text.index("987-65")
    added = [x for x in found[104]["spans"].split(",") if x.startswith(("iban", "ssn"))]
    assert added == [
        f"iban:{at}:{at + len(IBAN)}", f"ssn:{first}:{first + 11}", f"ssn:{second}:{second + 11}"
    ]


def test_context_and_printed_ibans(spark):
    printed = "GB82 WEST 1234 5698 7654 32"
    rows = [
        (1, "SSN as of 2024-01-02: 123-45-6789."),
        (2, "123-45-6789 is my ssn; " + "z" * 60 + " 111-22-3333"),
        (3, "😀 123-45-6789, 1-2-3, 4-5-6 SSN"),
        (4, f"to {printed} AND {printed[:-1]}3 or ES91 2100 0418 4502 0005 1332 BANK"),
        (5, "123-45-6789 " + "z" * 40 + " ssn"),
    ]
    text = dict(rows)
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x] for r in digest_pii(frame(spark, rows)).collect()}
    span = lambda i, kind, part: f"{kind}:{text[i].index(part)}:{text[i].index(part) + len(part)}"
    assert got[1] == [span(1, "ssn", "123-45-6789")]
    assert got[2] == [span(2, "ssn", "123-45-6789")]
    assert got[3] == [span(3, "ssn", "123-45-6789")]
    assert [x for x in got[4] if x.startswith("iban")] == [
        span(4, "iban", printed), span(4, "iban", "ES91 2100 0418 4502 0005 1332")
    ]
    assert got[5] == []


def test_redacted(spark):
    rows = find_pii(frame(spark, ROWS)).select("doc_id", "text", redacted().alias("clean")).collect()
    clean = {r["doc_id"]: r["clean"] for r in rows}
    assert clean[1] == "" and clean[4] == "one"
    assert clean[100].startswith("😀 mail [email] or [email]")
    assert "555" not in clean[103] and "4111 1111 1111 1111" not in clean[102]
    assert clean[106] == "[card], [email] [email]"
    assert len(rows) == len(ROWS)


def test_many_matches(spark):
    """100,000 addresses in one text, in time that follows its length."""
    text = "".join(f"😀 a{k}@b.cd\n" for k in range(100_000))
    row = digest_pii(frame(spark, [(1, text)])).first()
    joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base(text))
    assert row["n_email"] == 100_000 and row["spans"] == joined
    clean = redact_pii(frame(spark, [(1, text)])).first()["text"]
    assert clean == "😀 [email]\n" * 100_000


def test_empty(spark):
    assert digest_pii(frame(spark, ROWS).limit(0)).count() == 0
