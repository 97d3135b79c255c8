"""From scored articles to digest items, cited list, tags, lines and the document text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedloom import wording as w
from feedloom.functions import phrases
from feedloom.functions.scoring import score_articles, with_stages
from feedloom.operators.segments import top_rows
from feedloom.settings import DEFAULT_LEXICON, SECTIONS, Lexicon, Section, Weights


def scored_items(articles: DataFrame, weights: Weights = Weights(), lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Score articles and replace the summary by the two short texts a digest shows.

    Everything that needs the whole text happens here, before any shuffle; later steps move only
    short rows. ``rank_total`` is the total used for ranking.
    """
    return (
        with_stages(score_articles(articles, weights, lexicon), lexicon)
        .withColumns(
            {"summary_short": phrases.short_summary(F.col("summary"), F.col("title")), "rank_total": F.col("total")}
        )
        .drop("summary")
    )


RANKING = (F.desc, "rank_total"), (F.asc, "seq")


def ranking() -> list[Column]:
    """Best total first, earlier article first among equals."""
    return [direction(name) for direction, name in RANKING]


def fits(section: Section) -> Column:
    """Whether an article may stand in a section."""
    enough = F.col("total") >= section.threshold
    return enough if section.categories is None else enough & F.col("category").isin(*section.categories)


def section_items(scored: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """Top articles of every section and date, with ``section_no``, ``section`` and ``pos``.

    All sections in one shuffle, to which each input partition sends at most ``limit`` rows per
    date and section.
    """
    numbers = F.array_compact(F.array(*[F.when(fits(s), F.lit(i)) for i, s in enumerate(sections)]))
    names = F.array(*[F.lit(s.name) for s in sections])
    limits = {s.limit for s in sections}
    placed = scored.withColumn("section_no", F.explode(numbers))
    picked = top_rows(placed, ["brief_date", "section_no"], ranking(), max(limits))
    if len(limits) > 1:
        picked = picked.filter(F.col("pos") <= F.get(F.array(*[F.lit(s.limit) for s in sections]), F.col("section_no")))
    return picked.withColumn("section", F.get(names, F.col("section_no")))


def cited_items(items: DataFrame) -> DataFrame:
    """Articles of all sections in section order, the first of each link; ``cited_pos`` from 1.

    Works on section items: at most nine rows per date.
    """
    order = ["section_no", "pos"]
    first = F.row_number().over(Window.partitionBy("brief_date", "url").orderBy(*order))
    place = F.row_number().over(Window.partitionBy("brief_date").orderBy(*order))
    return items.withColumn("_first", first).filter("_first = 1").drop("_first").withColumn("cited_pos", place)


def _tags(label_lists: Column) -> Column:
    tags = phrases.text_map(w.TAG_BY_LABEL)
    named = F.transform(F.flatten(label_lists), lambda k: F.try_element_at(tags, k))
    always = F.array(*map(F.lit, w.TAGS_ALWAYS))
    return F.slice(F.array_distinct(F.concat(F.array_compact(named), always)), 1, w.TAG_LIMIT)


def digest_lines(cited: DataFrame, dates: DataFrame) -> DataFrame:
    """Per date: ``one_line_signal``, ``thinking_question`` and ``tags``; also for dates without articles."""
    lists = cited.groupBy("brief_date").agg(
        F.array_sort(F.collect_list(F.struct("cited_pos", "keywords"))).getField("keywords").alias("_lists")
    )
    filled = dates.select("brief_date").distinct().join(lists, "brief_date", "left")
    label_lists = F.coalesce(F.col("_lists"), F.array().cast("array<array<string>>"))
    labels = F.flatten(label_lists)
    return filled.select(
        "brief_date",
        phrases.first_rule(w.SIGNALS, labels, w.SIGNAL_DEFAULT).alias("one_line_signal"),
        phrases.first_rule(w.QUESTIONS, labels, w.QUESTION_DEFAULT).alias("thinking_question"),
        _tags(label_lists).alias("tags"),
    )


def learning_cards(dates: DataFrame) -> DataFrame:
    """The learning card of each date: cards take turns day by day."""
    fields = ("concept", "explanation", "scenario", "relation", "english_expression")
    cards = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, card)]) for card in w.LEARNING_CARDS])
    # Days since 0001-01-01, counted from 1: 719163 is the count at 1970-01-01.
    turn = F.pmod(F.unix_date("brief_date") + 719163, F.lit(len(w.LEARNING_CARDS)))
    return dates.withColumn("learning_card", F.get(cards, turn))


def enrich_items(items: DataFrame) -> DataFrame:
    """Texts shown with each article."""
    keywords, total = F.col("keywords"), F.col("total")
    return items.withColumns(
        {
            "priority": phrases.priority(total),
            "why_important": phrases.why_important(F.col("category")),
            "takeaway": phrases.takeaway(keywords),
            "keyword_notes": phrases.keyword_notes(keywords),
            "date_text": phrases.date_text(F.col("published_at")),
            "reading_row": phrases.reading_row(
                F.col("title"), F.col("source_name"), F.col("published_at"), total, F.col("url")
            ),
        }
    )


def _lines(*parts: Column | str) -> Column:
    """Parts under each other with an empty line between."""
    return F.concat_ws("\n\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _say(label: str, *values: Column | str) -> Column:
    return F.concat(F.lit(label), *[F.lit(v) if isinstance(v, str) else v for v in values])


def _block() -> Column:
    """The text block of one enriched section item."""
    title, url, source = F.col("title"), F.col("url"), F.col("source_name")
    link = _say(w.LABEL_LINK, "[", url, "](", url, ")")
    short = F.col("summary_short")
    must = _lines(
        _say("### ", F.col("pos").cast("string"), ". ", title),
        _say(w.LABEL_WHAT, short),
        _say(w.LABEL_WHY, F.col("why_important")),
        _say(w.LABEL_TAKEAWAY, F.col("takeaway")),
        _say(w.LABEL_KEYWORDS, F.col("keyword_notes")),
        link,
        _say(w.LABEL_SOURCE, source, " / ", F.col("date_text")),
        _say(w.LABEL_PRIORITY, F.col("priority")),
    )
    watch = _lines(
        _say("### ", source, " / ", title),
        _say(w.LABEL_NEW, short),
        w.WATCH_PROBLEM,
        w.WATCH_DESIGN,
        w.WATCH_CHANCE,
        link,
    )
    market = _lines(
        _say("### ", title),
        _say(w.LABEL_EVENT, short),
        w.MARKET_AUDIENCE,
        _say(w.LABEL_STAGE, F.col("stages")),
        _say(w.LABEL_LESSON, F.col("takeaway")),
        link,
    )
    return F.when(F.col("section_no") == 0, must).when(F.col("section_no") == 1, watch).otherwise(market)


def digest_documents(items: DataFrame, dates: DataFrame, title: str = w.DEFAULT_TITLE) -> DataFrame:
    """(brief_date, document): the whole digest text of each date, from section items."""
    cited = cited_items(items)
    sections = (
        enrich_items(items)
        .select("brief_date", "section_no", "pos", _block().alias("block"))
        .groupBy("brief_date")
        .agg(F.array_sort(F.collect_list(F.struct("section_no", "pos", "block"))).alias("blocks"))
    )
    reading = (
        enrich_items(cited)
        .groupBy("brief_date")
        .agg(F.array_sort(F.collect_list(F.struct("cited_pos", "reading_row"))).getField("reading_row").alias("rows"))
    )
    joined = (
        learning_cards(digest_lines(cited, dates))
        .join(sections, "brief_date", "left")
        .join(reading, "brief_date", "left")
    )

    def section(number: int, empty: str) -> Column:
        own = F.filter("blocks", lambda b: b["section_no"] == number)
        text = F.array_join(F.transform(own, lambda b: b["block"]), "\n\n")
        return F.when(F.coalesce(text, F.lit("")) == "", F.lit(empty)).otherwise(text)

    card = F.col("learning_card")
    hints = "\n".join([w.HINTS_LEAD, *[f"- {hint}" for hint in w.HINTS]])
    reading_text = F.concat_ws(
        "\n", F.lit(w.READING_HEAD), F.lit(w.READING_RULE), F.coalesce("rows", F.array().cast("array<string>"))
    )
    document = _lines(
        _say(f"# {title} — ", F.date_format("brief_date", "yyyy-MM-dd")),
        w.HEADING_SIGNAL, F.col("one_line_signal"),
        w.HEADING_MUST_READ, section(0, w.EMPTY_MUST_READ),
        w.HEADING_AI_WATCH, section(1, w.EMPTY_AI_WATCH),
        w.HEADING_MARKETPLACE, section(2, w.EMPTY_MARKETPLACE),
        w.HEADING_THINKING, F.col("thinking_question"), hints,
        w.HEADING_CARD,
        _say(w.LABEL_CONCEPT, card["concept"]),
        _say(w.LABEL_EXPLAIN, card["explanation"]),
        _say(w.LABEL_SCENARIO, card["scenario"]),
        _say(w.LABEL_RELATION, card["relation"]),
        _say(w.LABEL_ENGLISH, card["english_expression"]),
        w.HEADING_READING, reading_text,
        w.HEADING_TAGS, F.array_join("tags", " "),
    )
    return joined.select("brief_date", F.concat(document, F.lit("\n")).alias("document"))
