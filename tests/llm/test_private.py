"""Personal data against a plain search in Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tallybrook.llm.private import find_private, redact, span_list

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def plain(text: str | None) -> str:
    text, out = text or "", []
    for m in EMAIL.finditer(text):
        out.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in PHONE.finditer(text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


TEXTS = [
    None,
    "",
    "a@b.c%d@e.f.g x@y",
    "mail é jo.doe+x@ex-ample.co.uk, a@b.c@d.e",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3",
    "call +49 (0) 30.1234-567 or +1 2 +1234567890123456 ++12 34567 8901",
    "4111 1111 1111 1111, 4111-1111-1111-1112 378282246310005 4111111111111111222",
    "0" * 15 + " " + "0" * 20,
    "x" * 5000 + "@" + "y" * 5000,
    "1" * 20000,
    "a." * 3000 + "@b.c",
    "😀 +12 345 678 901 4111 1111 1111 1111 😀 9.9.9.9 a@b.de",
    "a@b.c " * 500,
]


def _random_texts(n: int) -> list[str]:
    rng = random.Random(5)
    parts = ["a@b.c", "@", ".", "1", "25", "255", " ", "-", "+1", "+", "(", "é", "😀", "4111 1111 1111 1111", "%", "x", "12345678", "\n"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_base_spans_are_those_of_a_plain_search(spark):
    texts = TEXTS + _random_texts(1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    found = find_private(docs).select("doc_id", span_list("spans", base_only=True).alias("base")).collect()
    got = {r.doc_id: r.base for r in found}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_account_codes_need_their_checksum_and_ssn_its_context(spark):
    texts = [
        "IBAN: DE89 3704 0044 0532 0130 00.",
        "IBAN: DE88 3704 0044 0532 0130 00.",
        "pay to GB82WEST12345698765432 now",
        "number 123-45-6789",
        "Social security 123-45-6789",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.kind, s.start, s.end, round(s.score, 2)) for s in r.spans if s.number > 3] for r in find_private(docs).collect()}
    assert got == {
        0: [("iban", 6, 33, 1.0)],
        1: [],
        2: [("iban", 7, 29, 0.8)],
        3: [],
        4: [("ssn", 16, 27, 0.6)],
    }


def test_account_codes_end_where_their_checksum_does(spark):
    texts = {
        "FR1420041010050500013M02606 Bank": [(0, 27)],
        "account DE89370400440532013000 12 May": [(8, 30)],
        "GB82WEST12345698765432 I will": [(0, 22)],
        "DE89 3704 0044 0532 0130 00 BIC: COBADEFF": [(0, 27)],
        "DE89370400440532013000 GB82WEST12345698765432 FR1420041010050500013M02606": [(0, 22), (23, 45), (46, 73)],
        "é😀 ref AB12 DE89 3704 0044 0532 0130 00 COBADEFF 1": [(12, 39)],
        "XX57123456789012345 NOW": [(0, 19)],
        "NO9386011117947": [(0, 15)],
        "DE89370400440532013000x DE89370400440532013000EUR DE88370400440532013000 12 May": [],
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "iban"] for r in find_private(docs).collect()}
    assert got == dict(enumerate(texts.values()))
    masked = {r.doc_id: r.text for r in redact(docs).collect()}
    assert masked[0] == "[IBAN] Bank" and masked[3] == "[IBAN] BIC: COBADEFF"
    after = spark.createDataFrame([(1, "DE89370400440532013000 is my bank")], "doc_id long, text string")
    assert [round(s.score, 2) for s in find_private(after).collect()[0].spans if s.kind == "iban"] == [1.1 - 0.1]


def test_redacted_texts(spark):
    rows = [(1, "é a@b.c, +12 345 678 901!", 7), (2, None, 0), (3, "", 0), (3, "", 0), (4, "4111 1111 1111 1111", 1), (None, "1.2.3.4", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = redact(docs)
    assert out.columns == docs.columns
    assert sorted(out.collect(), key=str) == sorted(
        [(1, "é [EMAIL], [PHONE]!", 19), (2, None, None), (3, "", 0), (3, "", 0), (4, "[CARD]", 6), (None, "[IP]", 4)], key=str
    )


def test_columns_of_any_name_come_back_as_they_were(spark):
    names = ["spans", "_merged", "_ip_found", "_iban_codes", "_kept", "_text", "whole", "a.b"]
    docs = spark.createDataFrame([(1, "mail a@b.org now", *names), (2, None, *names)], ["doc_id", "text", *names])
    assert sorted(map(tuple, redact(docs).collect())) == [(1, "mail [EMAIL] now", *names), (2, None, *names)]
    found = find_private(docs)
    assert found.columns == [c for c in docs.columns if c != "spans"] + ["spans"]
    assert {r._ip_found for r in found.collect()} == {"_ip_found"}


def test_no_rows(spark):
    assert find_private(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_on_the_test_tables(spark, folder):
    from tallybrook.llm.queries import op9_private

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    found = 0
    for r in op9_private(spark, folder).collect():
        base = plain(texts[r.doc_id])
        found += bool(base)
        kinds = [s.split(":")[0] for s in base.split(",")]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in ("email", "ip", "card", "phone"))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(base.split(",")) <= set(r.spans.split(","))
    assert found
