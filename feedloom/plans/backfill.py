"""The archive fallback of many dates of one run, each seeing the lines that earlier dates of the run wrote.

A date that falls back to the archive writes what it took as lines of its own, so what a later date finds depends on all
dates before it. Dates are therefore taken in order. What enters is small at any size of the archive: per date without
content its newest lines in the archive as it was (``limit`` rows), and per date with content the newest lines of each
publication day (``limit`` rows a day, a few days). The walk over them is one pass over calendar dates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from feedloom.functions.dates import record_date
from feedloom.settings import PRODUCT_SIGNALS, Section
from feedloom.sources.archive import ARCHIVE_SCHEMA, LINES_PER_DATE

STRONG_SECTIONS = ("must_read", "ai_watch")
_LINE = ("title", "url", "source", "category", "score", "published_at", "line_no")
_DAY_MICROS = 86_400_000_000
_EPOCH = date(1970, 1, 1)


def picks_in_order(
    static: DataFrame, own: DataFrame, asked: DataFrame, sources: DataFrame, skipped: DataFrame | None,
    days: int, limit: int, sections: Sequence[Section], first_writes: date | None,
) -> DataFrame:
    """(brief_date, archive columns): the lines that each asked date takes.

    ``static`` holds per asked date the newest lines of the archive before the run, ``own`` the newest lines that the
    dates with content write. A date's lines are written when they fill a strong section, or when the date is
    ``first_writes``, which has no earlier digest to keep.
    """
    total = F.round(F.coalesce("score", F.lit(3.0)), 2)
    when = F.unix_micros(record_date(F.col("published_at"), "archive date"))
    columns = [*_LINE, total.alias("total"), when.alias("published")]
    lines = static.select(F.lit("static").alias("kind"), F.col("brief_date").alias("at"), *columns).unionByName(
        own.select(F.lit("own").alias("kind"), F.col("date").cast("date").alias("at"), *columns)
    )
    marks = asked.select(F.lit("ask").alias("kind"), F.col("brief_date").alias("at"))
    names = sources.select(
        F.lit("name").alias("kind"), F.col("source_name").alias("source"), "category", F.col("source_key").alias("key"), F.col("source_pos").cast("bigint").alias("pos")
    ).join(lines.select("source").distinct(), "source", "left_semi")
    rows = lines.unionByName(marks, allowMissingColumns=True).unionByName(names, allowMissingColumns=True)
    if skipped is not None:
        passed = skipped.join(names.select(F.col("key").alias("source_key")), "source_key", "left_semi")
        rows = rows.unionByName(passed.select(F.lit("skip").alias("kind"), F.col("brief_date").alias("at"), F.col("source_key").alias("key")), allowMissingColumns=True)
    strong = [(s.threshold, s.categories) for s in sections if s.name in STRONG_SECTIONS]

    def walk(table: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(list(_walk(table, days, limit, strong, first_writes)), columns=["brief_date", "date", *_LINE])

    # One group, of a few hundred rows a calendar date.
    return rows.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(walk, f"brief_date date, {ARCHIVE_SCHEMA}")


def _walk(table: pd.DataFrame, days: int, limit: int, strong: list, first_writes: date | None) -> Iterator[tuple]:
    rows = table.astype(object).where(table.notna(), None).to_dict("records")
    kinds: dict[str, list[dict]] = {"static": [], "own": [], "ask": [], "name": [], "skip": []}
    for row in rows:
        kinds[row["kind"]].append(row)
    skipped = {(r["at"], r["key"]) for r in kinds["skip"]}
    named: dict[str, list[dict]] = {}
    for row in sorted(kinds["name"], key=lambda r: -r["pos"]):
        named.setdefault(row["source"], []).append(row)
    static: dict[date, list[dict]] = {}
    for row in kinds["static"]:
        static.setdefault(row["at"], []).append(row)
    own = sorted(kinds["own"], key=lambda r: (r["at"], r["line_no"]))
    written: dict[str, dict] = {}  # newest line of every link that the run has written so far
    done = 0

    def category(row: dict, at: date) -> str:
        read = [n for n in named.get(row["source"], ()) if (at, n["key"]) not in skipped]
        return read[0]["category"] if read else row["category"] or PRODUCT_SIGNALS

    for at in sorted({r["at"] for r in kinds["ask"]}):
        while done < len(own) and own[done]["at"] < at:
            written[own[done]["url"]] = own[done]
            done += 1
        edge = ((at - _EPOCH).days - days) * _DAY_MICROS
        # The edge only moves on, so what is past it stays so.
        written = {u: r for u, r in written.items() if r["published"] is None or r["published"] >= edge}
        found = {r["url"]: r for r in static.get(at, ())}
        for url, row in written.items():
            if url not in found or found[url]["line_no"] < row["line_no"]:
                found[url] = row
        picked = sorted(found.values(), key=lambda r: r["line_no"])[-limit:]
        for row in picked:
            yield (at, str(row["at"]), *(row[c] for c in _LINE))
        kept = [row | {"category": category(row, at), "source": row["source"] or "Archive"} for row in picked]
        fits = any(r["total"] >= least and (allowed is None or r["category"] in allowed) for r in kept for least, allowed in strong)
        if fits or at == first_writes:
            for place, row in enumerate(kept):
                line = (at - _EPOCH).days * LINES_PER_DATE + place
                written[row["url"]] = row | {"at": at, "line_no": line, "score": row["total"]}
