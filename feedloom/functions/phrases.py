"""Texts shown for one scored article, as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from feedloom import wording
from feedloom.settings import PRIORITY_HIGH, PRIORITY_MEDIUM


def text_map(pairs: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for item in pairs.items() for x in item])


def first_rule(rules: Iterable[tuple[tuple[str, ...], str]], keywords: Column, default: str) -> Column:
    """Text of the first rule one of whose labels is among ``keywords``."""
    chosen = F.lit(default)
    for labels, text in reversed(tuple(rules)):
        chosen = F.when(F.arrays_overlap(keywords, F.array(*map(F.lit, labels))), F.lit(text)).otherwise(chosen)
    return chosen


def short_summary(summary: Column, title: Column) -> Column:
    """Summary, or the title when there is none, cut after a fixed number of characters."""
    text = F.when(F.coalesce(summary, F.lit("")) != "", summary).otherwise(title)
    cut = F.concat(F.substring(text, 1, wording.SUMMARY_CHARS), F.lit(wording.SUMMARY_MARK))
    return F.when(F.length(text) > wording.SUMMARY_CHARS, cut).otherwise(text)


def priority(total: Column) -> Column:
    return F.when(total >= PRIORITY_HIGH, "High").when(total >= PRIORITY_MEDIUM, "Medium").otherwise("Low")


def why_important(category: Column) -> Column:
    return F.coalesce(F.try_element_at(text_map(wording.WHY_BY_CATEGORY), category), F.lit(wording.WHY_DEFAULT))


def takeaway(keywords: Column) -> Column:
    return first_rule(wording.TAKEAWAYS, keywords, wording.TAKEAWAY_DEFAULT)


def keyword_notes(keywords: Column) -> Column:
    """``label：explanation`` for the first five labels, joined."""
    shown = F.when(F.size(keywords) > 0, keywords).otherwise(F.array(*map(F.lit, wording.KEYWORDS_DEFAULT)))
    notes = text_map(wording.KEYWORD_NOTES)
    return F.array_join(
        F.transform(
            F.slice(shown, 1, 5),
            lambda k: F.concat(k, F.lit("："), F.coalesce(F.try_element_at(notes, k), F.lit(wording.KEYWORD_NOTE_DEFAULT))),
        ),
        "；",
    )


def date_text(published_at: Column) -> Column:
    return F.coalesce(F.date_format(published_at, "yyyy-MM-dd"), F.lit(wording.DATE_UNKNOWN))


def number_text(value: Column) -> Column:
    """A two-digit number the way a person writes it: 3.0, 2.65."""
    return F.regexp_replace(F.format_number(value, 2), r"(\.\d)0$", "$1")


def reading_row(title: Column, source_name: Column, published_at: Column, total: Column, url: Column) -> Column:
    """One table row of the reading list."""
    cells = [title, source_name, date_text(published_at), F.concat(priority(total), F.lit("，评分 "), number_text(total))]
    joined = F.concat_ws(" | ", *cells, F.concat(F.lit("[阅读]("), url, F.lit(")")))
    return F.concat(F.lit("| "), joined, F.lit(" |"))
