"""The digest job: from articles of any number of dates to digests, status and archive rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from feedloom import wording
from feedloom.functions.dates import day_end, minus_days
from feedloom.functions.phrases import short_summary
from feedloom.functions.scoring import with_stages
from feedloom.operators.asof import prior_report_dates
from feedloom.operators.dedupe import first_unique, with_keys
from feedloom.operators.digest import digest_documents, fits, scored_items, section_items
from feedloom.operators.stage import staged
from feedloom.operators.status import by_date, failed_sources, section_counts, tally
from feedloom.plans.backfill import STRONG_SECTIONS, picks_in_order
from feedloom.settings import WARNING_MARK, RunSettings
from feedloom.sources.archive import archive_rows, articles_of_lines, day_tails, newest_of_tails
from feedloom.sources.cache import cached_articles, rows_in_reach, serve_cache

ARTICLE_COLUMNS = (
    "brief_date", "seq", "title", "url", "summary", "source_key", "source_name", "source_url",
    "category", "quality", "language", "published_at",
)
SHORT_COLUMNS = (
    "brief_date", "seq", "title", "url", "summary_short", "stages", "source_name", "category",
    "published_at", "impact", "novelty", "source_quality", "pm_relevance", "actionability",
    "total", "keywords", "rank_total",
)
KEYED_COLUMNS = (*SHORT_COLUMNS, "link_key", "title_key")


def recent_articles(articles: DataFrame, days: int, reference: Column | None = None) -> DataFrame:
    """Articles without a date, or not older than ``days`` before the end of their digest date.

    What earlier runs stored about a failed feed has a marked title and is no article.
    """
    moment = day_end(F.col("brief_date")) if reference is None else reference
    published = F.col("published_at")
    real = ~F.coalesce(F.col("title").startswith(WARNING_MARK), F.lit(False))
    return articles.filter(real & (published.isNull() | (published >= minus_days(moment, days))))


def on_dates(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows of the given dates. A date list has one row per calendar date, a few million at the very
    most, so it is always small enough to broadcast, and a crowded date stays spread out."""
    return rows.join(F.broadcast(dates.select("brief_date")), "brief_date", "left_semi")


def dates_of(rows: DataFrame) -> DataFrame:
    return rows.select("brief_date").distinct()


def _with_content(asked: DataFrame, articles: DataFrame) -> DataFrame:
    """(brief_date, has_content) of the dates asked."""
    found = dates_of(articles).withColumn("_has", F.lit(True))
    marked = asked.join(found, "brief_date", "left").select("brief_date", F.col("_has").isNotNull().alias("has_content"))
    return staged(marked, "tier")


@dataclass(frozen=True)
class DigestInputs:
    """Tables a run reads. All articles carry the ``brief_date`` of the run they belong to.

    ``cache`` rows carry the ``run_date`` that wrote them, ``reports`` has one ``report_date`` per
    digest that exists already, ``sources`` are those read in this run, ``configured`` all enabled. ``skipped``
    (brief_date, source_key) are read in the run, but not on that date; ``live`` has none of theirs. ``tails`` stands
    for ``archive`` where the tails of it are kept.
    """

    dates: DataFrame
    candidates: DataFrame
    live: DataFrame
    failures: DataFrame
    cache: DataFrame
    archive: DataFrame | None
    sources: DataFrame
    configured: DataFrame
    reports: DataFrame
    skipped: DataFrame | None = None
    tails: DataFrame | None = None


class DigestRun:
    """Results of a run over all its dates; each is computed when first asked for.

    Content of a date: its own recent articles; failing these, cached ones; failing these, archived
    ones; failing these, the digest that exists already. A later tier is worked out only for the
    dates that need it. A date whose fallback content is weak also keeps the earlier digest.
    """

    def __init__(self, inputs: DigestInputs, settings: RunSettings = RunSettings()):
        self.inputs, self.settings = inputs, settings

    @cached_property
    def dates(self) -> DataFrame:
        return staged(dates_of(self.inputs.dates), "dates")

    @cached_property
    def _fresh(self) -> DataFrame:
        own = self.inputs.candidates.select(*ARTICLE_COLUMNS).unionByName(self.inputs.live.select(*ARTICLE_COLUMNS))
        return recent_articles(on_dates(own, self.dates), self.settings.lookback_days)

    def _short(self, articles: DataFrame) -> DataFrame:
        """Scored and cut to short rows with their duplicate keys; every article text is read here, once."""
        return with_keys(scored_items(articles, self.settings.weights, self.settings.lexicon))

    def _cached(self, dates: DataFrame) -> DataFrame:
        """Short rows of candidates and cached articles for the given dates.

        Cached articles are scored and get their keys before they are copied to the dates they serve.
        """
        s, i = self.settings, self.inputs
        cache = rows_in_reach(i.cache, dates, s.cache_retention_days)
        short = self._short(cached_articles(cache, i.sources))
        served = serve_cache(short, cache, dates, s.cache_retention_days, i.skipped)
        candidates = self._short(on_dates(i.candidates, dates))
        pool = candidates.select(*KEYED_COLUMNS).unionByName(served.select(*KEYED_COLUMNS))
        return recent_articles(pool, max(s.lookback_days, s.cache_retention_days))

    @cached_property
    def _own_tiers(self) -> tuple[dict[str, tuple[DataFrame, DataFrame]], DataFrame | None]:
        """Per mode of the first two tiers that is needed: (brief_date, has_content) of the dates asked, and the
        articles; and the dates that are left for the archive, if any."""
        tiers: dict[str, tuple[DataFrame, DataFrame]] = {}

        def add(mode: str, asked: DataFrame, articles: DataFrame) -> DataFrame:
            tiers[mode] = _with_content(asked, articles), articles
            return tiers[mode][0].filter(~F.col("has_content")).select("brief_date")

        left = add("none", self.dates, staged(self._short(self._fresh).select(*KEYED_COLUMNS), "pool"))
        if not left.isEmpty():
            left = add("feed_cache", left, staged(self._cached(left), "pool"))
        return tiers, None if left.isEmpty() else left

    @cached_property
    def _tiers(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """The tiers with the archive, whose articles see what earlier dates of this run write."""
        tiers, left = self._own_tiers
        if left is None:
            return tiers
        articles = staged(articles_of_lines(self._archive_lines(left), self.inputs.sources, self.settings.lexicon, self.inputs.skipped), "archived")
        return tiers | {"archive": (_with_content(left, articles), articles)}

    def _archive_lines(self, left: DataFrame) -> DataFrame:
        """The archive lines that the dates ``left`` take."""
        s, i = self.settings, self.inputs
        days = max(s.lookback_days, s.archive_min_days)
        tails = i.tails if i.tails is not None else staged(day_tails(i.archive, s.archive_limit), "archive-days")
        static = newest_of_tails(tails, left, days, s.archive_limit)
        bounds = self.dates.agg(F.min("brief_date").alias("first"), F.count(F.lit(1)).alias("n")).first()
        if bounds["n"] == 1:
            return static
        first_writes = bounds["first"] if i.reports.isEmpty() else None
        lines = archive_rows(on_dates(self.own_scored, self._own_written(first_writes)))
        own = day_tails(lines, s.archive_limit, ("date",)).select("line.*")
        return picks_in_order(static, own, left, i.sources, i.skipped, days, s.archive_limit, s.sections, first_writes)

    def _own_written(self, first_writes: date | None) -> DataFrame:
        """Dates of the first two tiers that write a digest: fresh ones, and cached ones that aren't weak."""
        tiers, _ = self._own_tiers
        fresh = tiers["none"][0].filter("has_content").select("brief_date")
        if "feed_cache" not in tiers:
            return fresh
        cached = tiers["feed_cache"][0].filter("has_content").select("brief_date")
        strong = [fits(s) for s in self.settings.sections if s.name in STRONG_SECTIONS]
        first = F.lit(False) if first_writes is None else F.col("brief_date") == F.lit(first_writes)
        return fresh.unionByName(dates_of(on_dates(self.own_scored, cached).filter(reduce(or_, strong, first))))

    @cached_property
    def date_modes(self) -> DataFrame:
        """(brief_date, fallback_mode) before preserving; dates without any content have no row."""
        parts = [
            marked.filter("has_content").select("brief_date", F.lit(mode).alias("fallback_mode"))
            for mode, (marked, _) in self._tiers.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    @cached_property
    def pool(self) -> DataFrame:
        """Short rows of the first two tiers with their keys, before duplicates are removed."""
        return reduce(DataFrame.unionByName, [articles for _, articles in self._own_tiers[0].values()])

    @cached_property
    def own_scored(self) -> DataFrame:
        """Scored articles of the first two tiers without duplicates."""
        kept = first_unique(self.pool, ["brief_date"])
        return staged(self.pool.join(kept, ["brief_date", "seq"], "left_semi").select(*SHORT_COLUMNS), "scored-unique")

    @cached_property
    def scored(self) -> DataFrame:
        """Scored articles of all dates without duplicates; archived ones keep their stored total."""
        if "archive" not in self._tiers:
            return self.own_scored
        old = with_stages(self._tiers["archive"][1], self.settings.lexicon).withColumns(
            {"summary_short": short_summary(F.col("summary"), F.col("title")), "rank_total": F.lit(0.0)}
        )
        return self.own_scored.unionByName(old.select(*SHORT_COLUMNS))

    @cached_property
    def items(self) -> DataFrame:
        """Section items of all dates, at most nine per date."""
        return staged(section_items(self.scored, self.settings.sections), "items")

    @cached_property
    def outcome(self) -> DataFrame:
        """Per date: counts, ``fallback_mode``, ``preserved_existing`` and ``carried_date``."""
        counts = tally({"n_pool": self.pool, "scored_count": self.scored})
        table = by_date(self.dates, self.date_modes, counts, section_counts(self.items))
        empty = F.col("fallback_mode").isNull()
        weak = (F.col("must_read_count") == 0) & (F.col("ai_watch_count") == 0)
        needs = empty | ((F.col("fallback_mode") != "none") & weak)
        table = staged(table.withColumns({"_empty": empty, "_needs": needs}), "outcome")
        return self._carry(table)

    def _carry(self, table: DataFrame) -> DataFrame:
        """Runs follow each other by date, so a digest written in this run serves the later dates.

        The very first date can only keep a digest that existed before; once it has written one,
        every later date has something to keep.
        """
        existing = self.inputs.reports.select("report_date").distinct()
        newest = existing.agg(F.max("report_date").alias("d")).first()["d"]
        first = table.agg(F.min("brief_date").alias("d")).first()["d"]
        writes = ~F.col("_needs")
        if newest is None:
            writes = writes | (F.col("brief_date") == F.lit(first))
        written = table.filter(writes).select(F.col("brief_date").alias("report_date"))
        before_own = prior_report_dates(table, written).withColumnRenamed("prior_date", "_written")
        before_any = prior_report_dates(table, written.unionByName(existing)).withColumnRenamed("prior_date", "_any")
        same = existing.select(F.col("report_date").alias("brief_date"), F.lit(True).alias("_same"))
        joined = table.join(before_own, "brief_date", "left").join(before_any, "brief_date", "left").join(same, "brief_date", "left")
        last = F.lit(newest).cast("date")
        when_empty = F.when(F.col("_same"), F.col("brief_date")).otherwise(F.coalesce("_written", last))
        carried = F.when(F.col("_empty"), when_empty).otherwise(F.coalesce("_any", last))
        return (
            joined.withColumn("carried_date", F.when(F.col("_needs"), carried))
            .withColumn("preserved_existing", F.col("carried_date").isNotNull())
            .withColumn(
                "fallback_mode",
                F.when(F.col("preserved_existing"), "preserved").otherwise(F.coalesce("fallback_mode", F.lit("none"))),
            )
            .drop("_empty", "_needs", "_written", "_any", "_same")
        )

    @cached_property
    def status(self) -> DataFrame:
        """One status row per date."""
        i = self.inputs
        read, configured = i.sources.count(), i.configured.count()
        counts = tally(
            {
                "candidate_article_count": on_dates(i.candidates, self.dates),
                "live_article_count": on_dates(i.live, self.dates),
                "n_failures": on_dates(i.failures, self.dates),
            }
        )
        table = by_date(self.outcome, counts, failed_sources(on_dates(i.failures, self.dates)))
        passed_over = F.lit(0)
        if i.skipped is not None:
            table = table.join(i.skipped.groupBy("brief_date").agg(F.count(F.lit(1)).alias("_skipped")), "brief_date", "left")
            passed_over = F.coalesce("_skipped", F.lit(0))
        shown = F.coalesce("carried_date", "brief_date")
        own = F.when(F.col("n_pool") + F.col("scored_count") > 0, shown).otherwise(F.col("brief_date"))
        return table.select(
            "brief_date",
            F.concat(F.lit("brief_date="), F.date_format(own, "yyyy-MM-dd")).alias("output_path"),
            (F.lit(read) - passed_over).cast("int").alias("source_count"),
            F.lit(configured).cast("int").alias("configured_source_count"),
            (F.lit(configured - read) + passed_over).cast("int").alias("skipped_source_count"),
            (F.col("live_article_count") + F.col("n_failures")).alias("fetched_article_count"),
            "candidate_article_count",
            F.when(F.col("n_pool") > 0, F.col("n_pool")).otherwise(F.col("scored_count")).alias("candidate_count"),
            "scored_count", "must_read_count", "ai_watch_count", "marketplace_count", "live_article_count",
            F.coalesce("failed_sources", F.array().cast("array<string>")).alias("failed_sources"),
            "preserved_existing", "fallback_mode",
        )

    def written_dates(self) -> DataFrame:
        return self.outcome.filter(~F.col("preserved_existing")).select("brief_date")

    def documents(self, title: str = wording.DEFAULT_TITLE) -> DataFrame:
        """(brief_date, document) of the dates that get a new digest."""
        written = self.written_dates()
        return digest_documents(on_dates(self.items, written), written, title)

    def archive_rows(self) -> DataFrame:
        """Archive rows of the dates that get a new digest, fallback articles included."""
        return archive_rows(on_dates(self.scored, self.written_dates()))

