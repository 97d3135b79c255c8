"""Spans and ownership against a plain scan."""

import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from feedloom.llm import secrets

from .helpers import ODD_ROWS, documents, frame, rows_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}")
FAKE = re.compile(r"example|sample|dummy|changeme|your|placeholder|x{6,}|0{8,}|1234567|abcdef", re.I)


def bits(value):
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def plain(docs):
    """Per row: base spans, live spans, copied values, most owners, most repositories."""
    found, owners, repositories = [], defaultdict(set), defaultdict(set)
    for _, text, lang, source, _ in docs:
        text = text or ""
        base = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        values = {(m.start(2), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8}
        for rank, kind, pattern, least in ((1, "access", r"AKIA[A-Z0-9]+", 16), (2, "hex", r"[0-9a-f]+", 32)):
            hits = [m for m in re.finditer(pattern, text) if len(m[0]) >= least]
            base += [(m.start(), rank, m.end(), kind) for m in hits]
            values |= {(m.start(), m.end(), m[0]) for m in hits}
        values |= {(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)}
        found.append((sorted(base), values))
        for _, _, value in values:
            owners[value].add(source or "")
            repositories[value].add((source or "", lang or ""))
    out = []
    for base, values in found:
        live = [
            (s, 3, e, "live") for s, e, v in values
            if len(owners[v]) <= 1 and len(repositories[v]) <= 2 and bits(v) >= 2.5 and re.search("[0-9]", v) and re.search("[A-Za-z]", v) and not FAKE.search(v)
        ]
        copied = sum(len(owners[v]) >= 2 or len(repositories[v]) >= 3 for _, _, v in values)
        most = [max((len(c[v]) for _, _, v in values), default=0) for c in (owners, repositories)]
        out.append((base, sorted(live), copied, *most))
    return out


def scanned(spark, docs):
    owner = F.coalesce(F.col("source"), F.lit(""))
    repository = F.concat_ws("/", owner, F.coalesce(F.col("lang"), F.lit("")))
    rows = rows_of(secrets.secret_spans(frame(spark, docs, extra=True), owner, repository))
    spans = lambda xs: sorted((x["start"], x["rank"], x["end"], x["kind"]) for x in xs)
    return [(r["doc_id"], spans(r["base"]), spans(r["live"]), r["n_copied"], r["max_owners"], r["max_repositories"]) for r in rows]


def planted():
    rng = random.Random(5)
    value = lambda n: "".join(rng.choices("ABCDEFGHJKMNPQRSTUVWXYZ23456789ghjkmnpq", k=n))
    own, spread, shared, flat = value(28), value(28), value(28), "a" * 64 + "Q7" + value(40)
    rows = [(1, f"token: {own}", "en", "a", 0), (2, f"x {own} y", "de", "a", 0)]  # one owner, two repositories
    rows += [(10 + i, f"see {spread}", lang, "b", 0) for i, lang in enumerate(("en", "de", "fr", "es"))]  # one owner, all its repositories
    rows += [(20 + i, f"api_key={shared}", "en", source, 0) for i, source in enumerate("cd")]  # two owners
    rows += [(30, f"long {flat}", "en", "e", 0), (31, "tail " + "b" * 64 + value(64), "en", "e", 0)]  # uniform head, random tail
    return rows


def test_owners_and_repositories(spark):
    docs = planted()
    got = scanned(spark, docs)
    assert [r[1:] for r in got] == plain(docs)
    by_id = {r[0]: r for r in got}
    assert by_id[1][2] and by_id[2][2] and by_id[1][4:] == (1, 2)
    assert not by_id[10][2] and by_id[10][3:] == (1, 1, 4)
    assert not by_id[20][2] and by_id[20][3] >= 1 and by_id[31][2]


def test_documents_against_a_plain_scan(spark):
    docs = sorted(documents()) + planted()
    docs = [(i, *d[1:]) for i, d in enumerate(docs)]
    assert [r[1:] for r in scanned(spark, docs)] == plain(docs)


def test_odd_rows(spark):
    assert len(scanned(spark, ODD_ROWS)) == len(ODD_ROWS)
    assert scanned(spark, []) == []
