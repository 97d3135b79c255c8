"""Pseudonyms against a plain Feistel permutation, and as an exact round trip."""

import hashlib
import re
import time

from pyspark.sql import functions as F

from feedloom.llm import native, pii
from feedloom.llm.queries import op6_pii

from .helpers import FOLDER, ODD_ROWS, documents, frame, rows_of

KEY = "a key of the tests"
MIXED = (
    "a inadanon.24@mail4.example.com, x +1 (171) 555-2028 123.45.6.7. 4111111111111111 4111 1111 1111 1111 4111111111111112 078-05-1120 "
    "666-05-1120 2024-02-29 2023-02-29 29/02/2024 02/29/2024 31.12.1999 +44 20 7946 0958 (555) 123-4567 300.1.1.1 01.2.3.4 "
    "5555-5555-5555-4444 378282246310005 9807915762804490 126.57.31.34 +49301234567 12345678901234567890"
)
FOUND = {"email": 1, "ip": 2, "card": 4, "phone": 4, "ssn": 1, "date": 4}


def keyed(spark):
    spark.conf.set(pii.KEY_SETTING, KEY)
    return spark


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10


def plain_pair(x, y, a, b, kind, key=KEY):
    for turn in range(1, pii.ROUNDS + 1):
        mixed = int(hashlib.sha256(f"{key}:{kind}:{turn}:{y}".encode()).hexdigest()[:15], 16)
        x, y, a, b = y, (x + mixed) % a, b, a
    return x, y


def plain_digits(digits, kind):
    half = len(digits) // 2
    x, y = plain_pair(int(digits[:half]), int(digits[half:]), 10**half, 10 ** (len(digits) - half), kind)
    return f"{x:0{half}d}{y:0{len(digits) - half}d}"


def plain_card(digits):
    body = plain_digits(digits[:-1], "card")
    return next(body + c for c in "0123456789" if luhn(body + c) == 0)


def test_cards_and_addresses_against_plain_permutation(spark):
    docs = documents()
    cards = {x for d in docs for x in re.findall(r"(?<![^\W_])\d{16}(?![^\W_])", d[1])}
    got = {r["doc_id"]: r for r in rows_of(op6_pii(keyed(spark), FOLDER))}
    assert len(got) == len(docs) and any(luhn(c) == 0 for c in cards)
    for doc_id, text, *_ in docs:
        new = got[doc_id]["text"]
        for card in re.findall(r"(?<![^\W_])\d{16}(?![^\W_])", text):
            assert (card in new) == (luhn(card) != 0) and (luhn(card) != 0 or plain_card(card) in new)
        for ip in re.findall(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w])", text):
            o = [int(x) for x in ip.split(".")]
            x, y = plain_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
            assert f"{x // 256}.{x % 256}.{y // 256}.{y % 256}" in new
        for mail in re.findall(r"[\w.]+@[\w.-]+\w", text):
            assert mail not in new
        for phone in re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", text):
            moved = plain_digits(re.sub(r"\D", "", phone)[1:], "phone")
            assert f"+1 ({moved[:3]}) {moved[3:6]}-{moved[6:]}" in new
        n = sum(got[doc_id][f"n_{k}"] for k in pii.KINDS)
        assert (new == text) == (n == 0) and len([s for s in got[doc_id]["spans"].split(",") if s]) == n


def test_formats_links_and_round_trip(spark):
    docs = frame(spark, [(1, MIXED, "en", "a", 1), (2, MIXED[2:], "de", "b", 1)])
    found = pii.with_pseudonyms(docs, KEY, found="found")
    rows = rows_of(found.select("doc_id", "text", *pii.counts_and_spans(F.col("found"))))
    assert {k: rows[0][f"n_{k}"] for k in pii.KINDS} == FOUND
    new = rows[0]["text"]
    assert new.startswith("a ") and rows[1]["text"] == new[2:]  # equal values, equal pseudonyms
    assert "4111111111111112 " in new and "666-05-1120 " in new and "2023-02-29" in new and "300.1.1.1 01.2.3.4" in new
    cards = re.findall(r"(?<!\d)\d{16}(?!\d)|\d{4} \d{4} \d{4} \d{4}", new)
    assert cards[0] == cards[1].replace(" ", "") and luhn(cards[0]) == 0
    iso, dotted = re.search(r"\d{4}-\d\d-\d\d", new)[0], re.search(r"\d\d/\d\d/\d{4}", new)[0]
    assert iso == "-".join(reversed(dotted.split("/")))
    back = pii.with_pseudonyms(found.drop("found"), KEY, undo=True)
    assert [r["text"] for r in rows_of(back)] == [MIXED, MIXED[2:]]
    other = rows_of(pii.with_pseudonyms(docs, key="other"))
    assert other[0]["text"] != new


def test_different_values_stay_different(spark):
    n = 2000
    rows = spark.range(n).selectExpr(
        "id AS doc_id", "concat('10.0.', id div 256, '.', id % 256, ' ', lpad(id % 899 + 1, 3, '0'), '-12-', lpad(id + 1, 4, '0'), ' ', date_add(date'1950-01-01', int(id))) AS text"
    )
    parts = pii.with_pseudonyms(rows, KEY).select(F.split("text", " ").alias("p")).collect()
    for i in (0, 2):
        assert len({r.p[i] for r in parts}) == n
    valid = [f"{i % 899 + 1:03d}" != "666" for i in range(n)]
    assert len({r.p[1] for r in parts}) == n and all(re.fullmatch(r"\d{3}-\d\d-\d{4}", r.p[1]) for r in parts) and sum(valid) < n


def test_odd_rows(spark):
    docs = frame(spark, ODD_ROWS, extra=True)
    out = pii.with_pseudonyms(docs, KEY)
    assert out.columns == docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))  # none of these texts has personal data
    assert pii.with_pseudonyms(frame(spark, []), KEY).collect() == []


def test_forms_that_stand_close_or_plain(spark):
    texts = ["+44 20 7946 0958 2023-01-01", "415-555-2671", "call 415.555.2671.", "иван.Петров@почта.рф", "josé_1@españa.es", "γιώργος@α.gr"]
    docs = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    hidden = pii.with_pseudonyms(docs, KEY, found="found")
    rows = rows_of(hidden.select("doc_id", "text", *pii.counts_and_spans(F.col("found"))))
    assert [r["spans"] for r in rows] == ["phone:0:16,date:17:27", "phone:0:12", "phone:5:17", "email:0:20", "email:0:16", "email:0:12"]
    for r, old in zip(rows, texts):
        assert r["text"] != old and len(r["text"]) == len(old)
    name = rows[3]["text"].partition("@")[0]
    assert all(a != b for a, b in zip(name[:4], "иван")) or name != "иван.Петров"
    back = pii.with_pseudonyms(hidden.drop("found"), KEY, undo=True)
    assert [r["text"] for r in rows_of(back)] == texts


def test_long_texts_take_linear_time(spark):
    texts = ["a@b" + ".b" * 100_000, "2024-02-29 " * 100_000, "x 10.1.2.3," * 20_000]
    docs = frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    start = time.monotonic()
    hidden = pii.with_pseudonyms(docs.filter("doc_id > 0"), KEY, found="found")
    rows = rows_of(hidden.select("doc_id", "text", F.size("found").alias("n"), F.get("found", F.size("found") - 1)["start"].alias("last")))
    assert [(r["n"], r["last"]) for r in rows] == [(100_000, 11 * 99_999), (20_000, 11 * 19_999 + 2)]
    assert len(set(rows[0]["text"].split())) == 1 and rows[0]["text"][:10] != "2024-02-29"
    (found,) = docs.filter("doc_id = 0").select(F.size(native.spans_of(F.col("text"), pii.PATTERN)).alias("n")).collect()
    assert found.n == 1 and time.monotonic() - start < 120
