"""Keyword scores and labels as column expressions over one article row."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.operators.terms import list_hits, term_hits
from feedloom.settings import AI_FRONTIER, CHINA_RETAIL, DEFAULT_LEXICON, MARKETPLACE, Lexicon, Weights

#: Distinct terms that are sent to every task; more are joined.
WRITTEN_OUT = 400
COMPONENTS = ("impact", "novelty", "source_quality", "pm_relevance", "actionability")


def article_text(title: Column, summary: Column, source_name: Column, category: Column) -> Column:
    """The searched text of an article, in lower case."""
    parts = [F.coalesce(c, F.lit("")) for c in (title, summary, source_name, category)]
    return F.lower(F.concat_ws(" ", *parts))


def cents(total: Column) -> Column:
    """``total`` rounded to two decimals by its exact binary value: 2.675, which is stored as a little less, gives 2.67.

    A double below 2^62 / 2^k times 2^k is a whole number that a bigint holds, as far as its last bit is 2^-k or more; so
    hundredths and what is left of them are exact decimals. A true tie goes to the even hundredth. Totals of 2^20 and
    more, which no weights give, are rounded as decimals.
    """

    def exact(shift: int) -> Column:
        scaled = (F.abs(total) * F.lit(2.0**shift)).cast("bigint").cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
        unit = F.lit(2**shift).cast("decimal(20,0)")
        left = scaled % unit
        whole = ((scaled - left) / unit).cast("bigint")
        up = (2 * left > unit) | ((2 * left == unit) & (whole % 2 == 1))
        return (whole + up.cast("bigint")) / F.lit(100.0)

    size = F.abs(total)
    rounded = F.when(size < 4, exact(60)).when(size < 1024, exact(50)).when(size < 2**20, exact(40)).otherwise(F.round(size, 2))
    return F.when(total < 0, -rounded).otherwise(rounded)


def any_term(text: Column, terms: Iterable[str]) -> Column:
    return reduce(or_, [text.contains(t.lower()) for t in terms])


def ladder(hits: Column) -> Column:
    """Component score for a number of hits."""
    return F.when(hits >= 8, 5).when(hits >= 5, 4).when(hits >= 3, 3).when(hits >= 1, 2).otherwise(1)


def any_word(text: Column, words: Iterable[str]) -> Column:
    """Whether one of the words stands alone in the text; the plain search spares most regex runs."""
    words = tuple(words)
    alone = text.rlike(r"(?U)\b(" + "|".join(map(re.escape, words)) + r")\b")
    return F.when(any_term(text, words), alone).otherwise(False)


def labels_of(found: dict[str, Column], category: Column, lexicon: Lexicon, limit: int = 5) -> Column:
    """Labels found, in label order, then the category's label, cut to ``limit``."""
    listed = [F.when(hit, F.lit(label)) for label, hit in found.items()]
    listed += [F.when(category == c, F.lit(label)) for c, label in lexicon.category_labels.items()]
    return F.slice(F.array_distinct(F.array_compact(F.array(*listed))), 1, limit)


def label_list(text: Column, category: Column, lexicon: Lexicon, limit: int = 5) -> Column:
    """Labels whose terms occur in ``text``."""
    found = {label: any_term(text, terms) for label, terms in lexicon.label_terms.items()}
    return labels_of(found, category, lexicon, limit)


def with_stages(articles: DataFrame, lexicon: Lexicon = DEFAULT_LEXICON, name: str = "stages") -> DataFrame:
    """Add the growth stages the title or summary speaks of, joined; the standard ones when none does."""
    text = F.lower(F.concat_ws(" ", "title", F.coalesce("summary", F.lit(""))))
    hits = [F.when(any_term(F.col("_text"), terms), F.lit(stage)) for stage, terms in lexicon.stage_terms.items()]
    spoken = articles.withColumn("_text", text).withColumn(name, F.concat_ws("、", *hits)).drop("_text")
    return spoken.withColumn(name, F.when(F.col(name) == "", "、".join(lexicon.default_stages)).otherwise(F.col(name)))


def _with_hits(searched: DataFrame, lists: dict[str, list[str]]) -> DataFrame:
    """``searched`` with ``_hits``, a map from word lists to how many of their terms the text has; without ``_text``."""
    rows = sorted({(group, word) for group, words in lists.items() for word in words})
    keys = [c for c in ("brief_date", "seq") if c in searched.columns]
    hits = term_hits(searched, searched.sparkSession.createDataFrame(rows, "group string, term string"), keys, "_text")
    maps = hits.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("group", "hits"))).alias("_hits"))
    return searched.drop("_text").join(maps, keys, "left")


def score_articles(articles: DataFrame, weights: Weights = Weights(), lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Add the five components, ``total`` and ``keywords`` to every article.

    Row-local: no shuffle. The text is lower-cased once and searched once for all terms (see ``list_hits``), and it is not
    carried on. A lexicon of more than ``WRITTEN_OUT`` terms is joined instead (see ``term_hits``); articles are then told
    apart by date and ``seq``.
    """
    text, category = F.col("_text"), F.col("category")
    lists = {f"score {c}": words for c, words in lexicon.score_terms.items()}
    lists |= {f"label {label}": words for label, words in lexicon.label_terms.items()} | {"frontier": lexicon.frontier_terms}
    lists = {group: [word.lower() for word in words] for group, words in lists.items()}
    joined = len({word for words in lists.values() for word in words}) > WRITTEN_OUT

    def found(group: str) -> Column:
        if joined:
            return F.coalesce(F.try_element_at("_hits", F.lit(group)), F.lit(0))
        return F.get("_hits", F.lit(list(lists).index(group)))

    searched = articles.withColumn("_text", article_text(F.col("title"), F.col("summary"), F.col("source_name"), category))
    finance = any_word(text, lexicon.finance_words) & ~any_word(text, lexicon.product_words)
    if joined:
        searched = _with_hits(searched.withColumn("_finance", finance), lists)
    else:
        searched = searched.withColumns({"_finance": finance, "_hits": list_hits(text, list(lists.values()))}).drop("_text")
    labels = {label: found(f"label {label}") > 0 for label in lexicon.label_terms}
    frontier, finance = category == AI_FRONTIER, F.col("_finance")
    raised = category.isin(MARKETPLACE, CHINA_RETAIL) | (frontier & (found("frontier") > 0))

    def bonus(component: str, when: Column) -> Column:
        return F.least(F.lit(5), ladder(found(f"score {component}")) + when.cast("int"))

    def malus(component: str, by: int) -> Column:
        return F.greatest(F.lit(1), ladder(found(f"score {component}")) - F.when(finance, by).otherwise(0))

    scored = searched.withColumns(
        {
            "impact": malus("impact", 2),
            "novelty": bonus("novelty", frontier),
            "source_quality": F.greatest(F.lit(1), F.least(F.lit(5), F.col("quality"))).cast("int"),
            "pm_relevance": bonus("pm_relevance", raised),
            "actionability": malus("actionability", 1),
            "keywords": labels_of(labels, category, lexicon),
        }
    ).drop("_finance", "_hits")
    total = reduce(add, [F.col(c) * F.lit(getattr(weights, c)) for c in COMPONENTS])
    # Two decimals in every weight give two decimals in every total, and plain rounding is exact for these.
    plain = all(round(getattr(weights, c) * 100, 9).is_integer() and round(getattr(weights, c), 2) == getattr(weights, c) for c in COMPONENTS)
    return scored.withColumn("total", F.round(total, 2) if plain else cents(total))
