"""Phrases by brute force, and what the index finds."""

import random
import re

from feedloom.llm import licences
from feedloom.llm.queries import op5_licences

from .helpers import FOLDER, ODD_ROWS, documents, frame, rows_of


def plain_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def plain_base(words):
    return sorted((i, label) for phrase, label in licences.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split())


def plain_score(words, index):
    """Best template behind any occurrence of its key phrase, by a whole table of common subsequences."""
    best = 0.0
    for notice in index.notices:
        n = len(notice.words)
        for begin in range(len(words)):
            if words[begin : begin + len(notice.phrase)] != notice.phrase:
                continue
            start = begin - notice.phrase_place
            low, high = max(0, start - notice.drift), min(len(words), start + n + notice.drift)
            table = [[0.0] * (n + 1)]
            for p in range(low, high):
                line = [0.0]
                for q in range(n):
                    hit = words[p] == notice.words[q] and abs(p - q - start) <= notice.drift
                    line.append(max(line[q], table[-1][q + 1], table[-1][q] + notice.weight[q] if hit else 0.0))
                table.append(line)
            score = table[-1][n] / notice.total
            if score >= licences.MIN_SCORE:
                best = max(best, score)
    return best


def index_of(texts):
    sets = [set(plain_words(t)) for t in texts]
    return licences.LicenceIndex(len(texts), {w: sum(w.decode() in s for s in sets) for w in licences.vocabulary()})


def test_query_against_brute_force(spark):
    docs = documents()
    got = {r["doc_id"]: r for r in rows_of(op5_licences(spark, FOLDER))}
    index = index_of([d[1] for d in docs])
    for doc_id, text, *_ in docs:
        own = plain_words(text)
        base, row = plain_base(own), got[doc_id]
        assert row["n_words"] == len(own) and row["n_base"] == len(base)
        assert (row["first_word"], row["last_word"]) == ((base[0][0], base[-1][0]) if base else (None, None))
        assert row["base_labels"] == ",".join(sorted({x for _, x in base}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}
        assert abs(row["score"] - plain_score([w.encode() for w in own], index)) < 1e-9


def test_worn_notices_against_brute_force():
    """Templates with words left out, changed and inserted, between words of other templates."""
    rng = random.Random(7)
    words = sorted(w.decode() for w in licences.vocabulary())
    index = index_of([" ".join(rng.choices(words, k=30)) for _ in range(40)])
    found = missed = 0
    for _ in range(150):
        _, text, _ = rng.choice(licences.TEMPLATES)
        wear, worn = rng.choice((0.0, 0.05, 0.2, 0.5)), []
        for word in plain_words(text):
            if rng.random() >= wear:
                worn.append(word)
            worn += rng.choices(words, k=rng.random() < wear / 2)
        around = rng.choices(words, k=rng.randrange(40))
        whole = " ".join([*around, *worn, *around])
        expected = plain_score([w.encode() for w in plain_words(whole)], index)
        matches = index.scan(whole.encode())[2]
        assert abs(max((m[2] for m in matches), default=0.0) - expected) < 1e-9
        found, missed = found + (expected > 0), missed + (expected == 0)
    assert found > 50 and missed > 10


def test_words_inserted_in_three_places():
    index = index_of(["the software is here"] * 50)
    notice = (
        "Permission is hereby granted free of charge to every any person obtaining a copy of this great software and associated "
        "documentation files the software to deal in our the software without restriction"
    )
    matches = index.scan(notice.encode())[2]
    assert "mit-text" in {label for label, _, _ in matches}
    whole = dict((label, text) for label, text, _ in licences.TEMPLATES)["bsd-3-clause"]
    commented = "\n".join(f"// {line}" if i % 2 else f"12 {line}" for i, line in enumerate(whole.splitlines()))
    best = {label: score for label, _, score in index.scan(f"x {commented} y".encode())[2]}
    assert best["bsd-3-clause"] > 0.999
    renamed = whole.replace("COPYRIGHT HOLDERS", "ACME COMPANY LTD").replace("copyright holder nor", "ACME or company nor")
    assert 0.9 < {label: score for label, _, score in index.scan(renamed.encode())[2]}["bsd-3-clause"] < 1


def test_long_text_of_licence_words():
    index = index_of(["the software is here"] * 50)
    n, base, matches = index.scan(b"mit license " * 20_000)
    assert n == 40_000 and len(base) == 20_000
    assert index.scan(b"permission software copyright " * 100_000)[2] == []


def test_found_and_rejected(spark):
    texts = [
        "x Released under the MIT License. And: Licensed under the Apache License, Version 2.0!",
        "This work is licensed under the GNU General Public License, version 3.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation',
        "released general words the of under, license mit and version",
        "the mit license license MIT license",
        "Licensed under CC BY-NC 4.0.",
    ]
    found = rows_of(licences.scan_documents(spark, frame(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])))
    labels = [{m["label"] for m in r["matches"]} for r in found]
    assert labels[0] == {"mit-notice", "apache-2.0"} and labels[1] == {"gpl-3.0"} and labels[2] == {"mit-text"} and labels[5] == {"cc-by-nc-4.0"}
    assert labels[3] == set() and [(b["start"], b["label"]) for b in found[4]["base"]] == [(1, "mit"), (4, "mit")]


def test_odd_rows(spark):
    found = licences.scan_documents(spark, frame(spark, ODD_ROWS, extra=True)).collect()
    assert len(found) == len(ODD_ROWS)
    assert {r.doc_id: r.n_words for r in found if r.doc_id} == {r[0]: len(plain_words(r[1])) for r in ODD_ROWS if r[0]}
    assert licences.scan_documents(spark, frame(spark, [])).collect() == []
