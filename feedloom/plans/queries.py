"""Every operator as a query over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.functions import dates as d
from feedloom.functions.phrases import short_summary
from feedloom.functions.scoring import score_articles, with_stages
from feedloom.functions.text import clean_text, title_key
from feedloom.functions.urls import with_url_key
from feedloom.operators import digest, health, status
from feedloom.operators.asof import pending_dates, prior_report_dates, published_dates
from feedloom.operators.dedupe import dedupe_articles, first_unique, with_keys
from feedloom.operators.segments import add_rank
from feedloom.operators.stage import fresh_folder, spread_single, staged
from feedloom.operators.terms import term_hits
from feedloom.plans import adapters as a
from feedloom.plans.daily import DigestInputs, DigestRun, recent_articles
from feedloom.plans.validate import updated_health
from feedloom.plans.workflow import settings_of
from feedloom.session import use_utc
from feedloom.settings import DEPLOYED_WEIGHTS, WARNING_MARK, Quota, RunSettings
from feedloom.sources import cache as c
from feedloom.sources.archive import append_archive, archive_rows, archived_articles, read_archive
from feedloom.sources.candidates import candidate_articles, read_candidates
from feedloom.sources.catalogue import enabled_sources, manual_sources, read_catalogue
from feedloom.sources.feeds import feed_articles, probe_sources, read_feeds
from feedloom.sources.tables import latest_row, write_dates
from feedloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = RunSettings(weights=DEPLOYED_WEIGHTS, lexicon=a.FRAGMENTS)
TITLE = "Daily Digest"
_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def in_utc(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_utc(spark), folder)

    _REGISTRY[function.__name__] = in_utc
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _day(name: str = "brief_date") -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _moment(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _joined(name: str) -> Column:
    return F.array_join(name, ",").alias(name)


# Text and dates.


@query
def url_normalize(spark: SparkSession, folder: str) -> DataFrame:
    pages = a.table(spark, folder, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), "url")
    docs = a.document_articles(spark, folder).select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "url")
    return with_url_key(pages.unionByName(docs)).select("id", "link_key")


@query
def title_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return a.document_articles(spark, folder).select("doc_id", title_key(F.col("title")).alias("title_key"))


@query
def html_clean(spark: SparkSession, folder: str) -> DataFrame:
    pages = spread_single(a.table(spark, folder, "pages"), "page_id")
    return pages.select("page_id", clean_text(F.col("html")).alias("text"))


@query
def feed_date_parse(spark: SparkSession, folder: str) -> DataFrame:
    at = F.date_trunc("second", F.col("ts").cast("timestamp"))
    forms = [
        F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"),
        F.date_format(at, "EEE, d MMM yyyy HH:mm:ss '+0530'"),
        F.date_format(at, "dd MMM yyyy HH:mm 'EST'"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format(at, "yyyy-MM-dd HH:mm:ss'-08:00'"),
        F.date_format(at, "yyyyMMdd'T'HHmmss"),
        F.date_format(at, "EEEE 'the' d'th'"),
        F.date_format(at, "MMMM d, yyyy HH:mm:ss 'PDT'"),
    ]
    text = F.get(F.array(*forms), F.pmod("event_id", F.lit(len(forms))).cast("int"))
    texts = spread_single(a.table(spark, folder, "events"), "event_id").select("event_id", text.alias("text"))
    return d.with_feed_date(texts, "text", "parsed").select("event_id", _moment(F.col("parsed")).alias("parsed"))


# Articles to digests.


def _articles(spark: SparkSession, folder: str) -> DataFrame:
    return a.document_articles(spark, folder)


def _recent(spark: SparkSession, folder: str) -> DataFrame:
    return recent_articles(_articles(spark, folder), SETTINGS.lookback_days)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Recent articles, scored, without duplicates."""
    short = digest.scored_items(_recent(spark, folder), SETTINGS.weights, SETTINGS.lexicon)
    keyed = staged(with_keys(short), "scored")
    return keyed.join(first_unique(keyed, ["brief_date"]), ["brief_date", "seq"], "left_semi")


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return digest.section_items(_scored(spark, folder), SETTINGS.sections)


@query
def recent_articles_only(spark: SparkSession, folder: str) -> DataFrame:
    return _recent(spark, folder).select(_day(), "doc_id")


@query
def marked_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Recent articles, of which some are what an earlier run stored about a feed that failed."""
    marked = F.when(F.col("doc_id") % 13 == 0, F.concat(F.lit(WARNING_MARK + " "), "title")).otherwise(F.col("title"))
    return recent_articles(_articles(spark, folder).withColumn("title", marked), SETTINGS.lookback_days).select(_day(), "doc_id", "title")


def _breakdown(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id", "impact", "novelty", "source_quality", "pm_relevance", "actionability", "total", _joined("keywords")
    )


@query
def score_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return _breakdown(score_articles(_articles(spark, folder), DEPLOYED_WEIGHTS))


@query
def score_breakdown_custom(spark: SparkSession, folder: str) -> DataFrame:
    return _breakdown(score_articles(_articles(spark, folder), SETTINGS.weights, SETTINGS.lexicon))


@query
def catalogue_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Scores by the weights of a catalogue that gives two of five."""
    given = F.create_map(F.lit("impact"), F.lit(0.4), F.lit("actionability"), F.lit(0.3))
    settings = settings_of(_catalogue(spark, folder, weights=given, lookback_days=F.lit(2)), SETTINGS)
    recent = recent_articles(_articles(spark, folder), settings.lookback_days)
    return _breakdown(score_articles(recent, settings.weights, settings.lexicon)).select("doc_id", "total")


@query
def keyword_labels(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_articles(_articles(spark, folder), SETTINGS.weights, SETTINGS.lexicon)
    return scored.select("doc_id", F.posexplode("keywords").alias("place", "label"))


def _part_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Thousands of terms: all runs of three to five signs in the descriptions of parts, grouped by their length."""
    words = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    described = a.table(spark, folder, "part").select(words.alias("t")).distinct()
    runs = described.select(F.explode(F.sequence(F.lit(3), F.lit(5))).alias("n"), "t").select("n", F.explode(F.sequence(F.lit(1), F.length("t") - F.col("n") + 1)).alias("i"), "t")
    return runs.select(F.concat(F.lit("runs of "), F.col("n").cast("string")).alias("group"), F.substring("t", F.col("i"), F.col("n")).alias("term")).distinct()


@query
def lexicon_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of a lexicon of thousands in every document."""
    texts = a.table(spark, folder, "documents").select("doc_id", F.lower("text").alias("text"))
    return term_hits(texts, staged(_part_terms(spark, folder), "terms"), ["doc_id"]).select("doc_id", "group", "hits")


@query
def growth_stage(spark: SparkSession, folder: str) -> DataFrame:
    return with_stages(_articles(spark, folder), SETTINGS.lexicon).select("doc_id", "stages")


@query
def either_key_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return dedupe_articles(a.page_articles(spark, folder).select("seq", "title", "url"), []).select("seq", "url")


@query
def chained_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in chains of hundreds: each shares its link with the one before and its title with the one after.

    Some have no title key; they share the empty one.
    """
    n = F.col("c_custkey")
    rows = a.table(spark, folder, "customer").select(
        n.cast("bigint").alias("seq"),
        F.concat(F.lit("l"), F.floor((n + 1) / 2).cast("string")).alias("link_key"),
        F.when(n % 397 != 0, F.concat(F.lit("t"), F.floor(n / 2).cast("string"))).alias("title_key"),
    )
    return first_unique(rows, [])


@query
def either_key_dedupe_by_date(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedupe_articles(_articles(spark, folder).select("brief_date", "seq", "title", "url", "doc_id"), ["brief_date"])
    return kept.select(_day(), "doc_id")


@query
def ranked_articles(spark: SparkSession, folder: str) -> DataFrame:
    narrow = _scored(spark, folder).select("brief_date", "rank_total", "seq", "doc_id", "total")
    return add_rank(narrow, ["brief_date"], digest.ranking()).select(_day(), "rank", "doc_id", "total")


def _section(name: str) -> Query:
    def top(spark: SparkSession, folder: str) -> DataFrame:
        chosen = [s for s in SETTINGS.sections if s.name == name]
        return digest.section_items(_scored(spark, folder), chosen).select(_day(), "pos", "doc_id", "total")

    top.__name__ = f"{name}_top3"
    return top


for _name in ("must_read", "ai_watch", "marketplace"):
    query(_section(_name))


@query
def cited_items(spark: SparkSession, folder: str) -> DataFrame:
    return digest.cited_items(_items(spark, folder)).select(_day(), "cited_pos", "section", "doc_id")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    dates = a.run_dates(_articles(spark, folder))
    return digest.digest_lines(digest.cited_items(_items(spark, folder)), dates)


@query
def digest_tags(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select(_day(), F.array_join("tags", " ").alias("tags"))


@query
def digest_signal(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder).select(_day(), "one_line_signal", "thinking_question")


@query
def learning_card(spark: SparkSession, folder: str) -> DataFrame:
    dates = a.run_dates(_articles(spark, folder))
    return digest.learning_cards(dates).select(_day(), F.col("learning_card.concept").alias("concept"))


@query
def item_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    rich = digest.enrich_items(_items(spark, folder))
    texts = ("priority", "why_important", "takeaway", "keyword_notes", "date_text", "reading_row", "summary_short", "stages")
    return rich.select(_day(), "section", "pos", "doc_id", *texts)


@query
def short_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return _articles(spark, folder).select("doc_id", short_summary(F.col("summary"), F.col("title")).alias("summary_short"))


@query
def digest_document(spark: SparkSession, folder: str) -> DataFrame:
    dates = a.run_dates(_articles(spark, folder))
    return digest.digest_documents(staged(_items(spark, folder), "items"), dates, TITLE).select(_day(), "document")


# Source health.


def _no_health(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], health.HEALTH_SCHEMA)


def _strict_health(spark: SparkSession, folder: str) -> DataFrame:
    """Health by which a single failure makes a source unstable."""
    return staged(updated_health(a.event_checks(spark, folder), _no_health(spark), 1), "health")


def _health_columns(state: DataFrame) -> DataFrame:
    return state.select(
        "source_key", "status", "consecutive_failures", "total_successes", "total_failures",
        _moment(F.col("last_checked_at")).alias("last_checked_at"),
        _moment(F.col("last_success_at")).alias("last_success_at"), "last_error", "last_article_count",
    )


@query
def source_health_final(spark: SparkSession, folder: str) -> DataFrame:
    """The second half of the checks on top of the state that the first half left."""
    checks = a.event_checks(spark, folder)
    second = F.col("checked_at") >= F.lit("2024-01-15").cast("timestamp")
    before = staged(updated_health(checks.filter(~second), _no_health(spark), SETTINGS.failure_threshold), "health")
    return _health_columns(updated_health(checks.filter(second), before, SETTINGS.failure_threshold))


@query
def source_health_history(spark: SparkSession, folder: str) -> DataFrame:
    checks = health.usable_checks(a.event_checks(spark, folder), discard=False)
    narrow = checks.select("source_key", "seq", "ok", "counts_as_failure")
    history = health.health_history(narrow, _no_health(spark), SETTINGS.failure_threshold)
    return history.select("seq", "source_key", "streak", "status")


@query
def outage_runs(spark: SparkSession, folder: str) -> DataFrame:
    return health.run_flags(a.event_checks(spark, folder)).filter("is_outage or is_discarded")


@query
def healthy_sources(spark: SparkSession, folder: str) -> DataFrame:
    state = _strict_health(spark, folder)
    sources = state.select(
        "source_key",
        F.when(F.col("source_key").rlike(r"[05]$"), "always_try").otherwise("skip_when_unstable").alias("failure_policy"),
    )
    as_of = F.lit("2024-02-01 12:00:00").cast("timestamp")
    return health.sources_to_read(sources, state, as_of, grace_days=SETTINGS.success_grace_days)


@query
def skipped_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that a run of each day at noon would pass over, by the checks up to then."""
    marked = staged(health.usable_checks(a.event_checks(spark, folder)), "checks")
    history = health.health_history(marked.select("source_key", "seq", "ok", "counts_as_failure", "checked_at"), _no_health(spark), 1)
    policy = F.when(F.col("source_key").rlike(r"[05]$"), "always_try").otherwise("skip_when_unstable").alias("failure_policy")
    sources = marked.select("source_key").distinct().select("source_key", policy)
    dates = marked.select(F.to_date("checked_at").alias("brief_date")).distinct()
    noon = F.timestamp_seconds(F.unix_seconds(F.col("brief_date").cast("timestamp")) + 12 * 3600)
    skipped = health.skipped_sources(sources, staged(history, "history"), dates, noon, grace_days=SETTINGS.success_grace_days)
    return skipped.select(_day(), "source_key")


@query
def validation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return health.validation_counts(a.event_checks(spark, folder), _strict_health(spark, folder))


# Cache, archive and fallbacks.


def _live(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return a.split_candidates(spark, folder, _articles(spark, folder))


def _fetched_at() -> Column:
    """Runs fetch at eight in the morning of their date."""
    return F.timestamp_seconds(F.unix_seconds(F.col("brief_date").cast("timestamp")) + 8 * 3600)


def _cache_runs(live: DataFrame) -> DataFrame:
    """Cache rows written by the run of every date."""
    return c.cache_rows(live.withColumn("run_date", F.col("brief_date")), _fetched_at(), SETTINGS.cache_retention_days, ("run_date",))


@query
def feed_cache_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in two upserts; some sources deliver in both halves, and several times in each."""
    live = _articles(spark, folder)
    second = F.col("brief_date") > F.date_add(F.lit(a.FIRST_DAY).cast("date"), 40)
    nothing = spark.createDataFrame([], c.CACHE_SCHEMA)
    old = staged(c.upsert_cache(nothing, live.filter(~second), _fetched_at(), SETTINGS.cache_retention_days), "cache")
    merged = c.upsert_cache(old, live.filter(second), _fetched_at(), SETTINGS.cache_retention_days)
    return merged.select(
        "source_key", _moment(F.col("fetched_at")).alias("fetched_at"), F.col("item_pos").alias("doc_id"), "url",
        _moment(F.col("published_at")).alias("published_at"),
    )


@query
def cached_articles(spark: SparkSession, folder: str) -> DataFrame:
    live = _articles(spark, folder)
    runs = _cache_runs(live)
    articles = c.cached_articles(runs, a.document_sources(spark, folder))
    cached = c.serve_cache(articles, runs, a.run_dates(live), SETTINGS.cache_retention_days)
    return cached.select(_day(), "source_name", "category", "quality", "url", "title", _moment(F.col("published_at")).alias("published_at"))


def _archive(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as an archive in document order; their stored score is the custom one."""
    scored = score_articles(_articles(spark, folder), SETTINGS.weights, SETTINGS.lexicon)
    return scored.select(
        F.date_format("brief_date", "yyyy-MM-dd").alias("date"), "title", "url", F.col("source_name").alias("source"),
        "category", F.col("total").alias("score"), d.iso_text(F.col("published_at")).alias("published_at"),
        F.col("doc_id").alias("line_no"),
    )


def _fallback_columns(found: DataFrame) -> DataFrame:
    return found.select(
        _day(), "seq", "title", "url", "source_name", "category", "quality", "total", _joined("keywords"),
        _moment(F.col("published_at")).alias("published_at"),
    )


def _catalogue_with_twin(spark: SparkSession, folder: str) -> DataFrame:
    """Sources without the first, and with a second entry by the name of another, so that names miss and repeat."""
    sources = a.document_sources(spark, folder)
    twin = sources.filter("source_name = 'src1'").withColumns(
        {"source_pos": F.col("source_pos") + 1000, "quality": F.lit(1), "source_key": F.lit("src1|twin")}
    )
    return sources.filter("source_name <> 'src0'").unionByName(twin)


@query
def archive_fallback(spark: SparkSession, folder: str) -> DataFrame:
    dates = a.run_dates(_articles(spark, folder))
    archive = staged(_archive(spark, folder), "archive")
    found = archived_articles(archive, _catalogue_with_twin(spark, folder), dates, 7, SETTINGS.archive_limit, SETTINGS.lexicon)
    return _fallback_columns(found)


@query
def archive_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Digest lines of all documents, appended twice over a stored archive, read back and fallen back to."""
    scored = staged(digest.scored_items(_articles(spark, folder), SETTINGS.weights, SETTINGS.lexicon), "scored")
    path = fresh_folder(spark, "archive")
    middle = F.col("brief_date") > F.date_add(F.lit(a.FIRST_DAY).cast("date"), 30)
    for part in (scored.filter(~middle), scored.filter(middle), scored.filter(middle)):  # the last one is repeated
        append_archive(archive_rows(part), path)
    dates = a.run_dates(_articles(spark, folder))
    stored = read_archive(spark, path)
    found = archived_articles(stored, a.document_sources(spark, folder), dates, 7, SETTINGS.archive_limit, SETTINGS.lexicon)
    return _fallback_columns(found)


def _run(spark: SparkSession, folder: str) -> DigestRun:
    candidates, live = _live(spark, folder)
    candidates, live = staged(candidates, "candidates"), staged(live, "live")
    dates = a.run_dates(_articles(spark, folder))
    sources = a.document_sources(spark, folder)
    return DigestRun(
        DigestInputs(
            dates=dates,
            candidates=candidates,
            live=live,
            failures=a.document_failures(spark, folder),
            cache=_cache_runs(live),
            archive=staged(_archive(spark, folder), "archive"),
            sources=sources,
            configured=sources,
            reports=spark.createDataFrame([], "report_date date"),
        ),
        SETTINGS,
    )


@query
def fallback_tier(spark: SparkSession, folder: str) -> DataFrame:
    run = _run(spark, folder)
    modes = run.dates.join(run.date_modes, "brief_date", "left")
    return modes.select(_day(), F.coalesce("fallback_mode", F.lit("empty")).alias("tier"))


def _status(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).status


@query
def run_status(spark: SparkSession, folder: str) -> DataFrame:
    return _status(spark, folder).select(
        _day(), "output_path", "source_count", "configured_source_count", "skipped_source_count", "fetched_article_count",
        "candidate_article_count", "candidate_count", "scored_count", "must_read_count", "ai_watch_count",
        "marketplace_count", "live_article_count", _joined("failed_sources"), "preserved_existing", "fallback_mode",
    )


@query
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    return status.quality_gate(_status(spark, folder)).select(_day(), "sufficient", _joined("reasons"))


@query
def candidate_quota(spark: SparkSession, folder: str) -> DataFrame:
    """By targets that some dates meet; one source has a category that is not known."""
    candidates = _live(spark, folder)[0]
    category = F.when(F.col("source_name") == "src13", "Other").otherwise(F.col("category"))
    quota = Quota(min_items=14, max_items=45, min_marketplace=2)
    counted = status.candidate_quota(candidates.withColumn("category", category), quota)
    return counted.withColumn("brief_date", F.date_format("brief_date", "yyyy-MM-dd"))


@query
def digest_archive_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).archive_rows().select("line_no", "date", "title", "url", "source", "category", "score", "published_at")


@query
def prior_digest_asof(spark: SparkSession, folder: str) -> DataFrame:
    articles = _articles(spark, folder)
    reports = articles.select(F.col("brief_date").alias("report_date"))
    found = prior_report_dates(a.run_dates(articles), reports)
    return found.select(_day(), _day("prior_date"))


@query
def pending_digest_dates(spark: SparkSession, folder: str) -> DataFrame:
    articles = _articles(spark, folder)
    heading = F.concat(F.lit(f"intro\n# {TITLE} — "), F.date_format("brief_date", "yyyy-MM-dd"), F.lit("\n\nbody"))
    documents = articles.select("brief_date").distinct().select(heading.alias("text"))
    return pending_dates(a.run_dates(articles), published_dates(documents, TITLE)).select(_day())


@query
def unknown_category_items(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates of one source, whose category is not known, among all others."""
    candidates = _live(spark, folder)[0]
    category = F.when(F.col("source_name") == "src13", "Other").otherwise(F.col("category"))
    return status.unknown_categories(candidates.withColumn("category", category)).select(_day(), "doc_id", "category")


@query
def local_days(spark: SparkSession, folder: str) -> DataFrame:
    """Events by the newsroom's day."""
    events = a.table(spark, folder, "events").select(d.local_day(F.col("ts").cast("timestamp")).alias("day"), "event_type")
    return events.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n")).select(_day("day"), "event_type", "n")


# Scans and sinks, over files written from the tables.


def _text_file(df: DataFrame, value: Column, path: str) -> str:
    df.select(value.alias("value")).coalesce(1).write.text(path)
    return path


def _catalogue(spark: SparkSession, folder: str, **options: Column) -> DataFrame:
    """A catalogue document: the sources of documents, some switched off, some without optional fields, and ``options``."""
    sources = a.document_sources(spark, folder)
    n = F.col("source_pos")
    listed = F.struct(
        F.col("source_name").alias("name"), F.col("source_url").alias("url"), "category",
        F.when(n % 3 != 0, F.col("quality")).alias("quality"), F.when(n % 4 == 1, "zh").alias("language"),
        F.when(n % 5 == 0, 1).alias("tier"), F.when(n % 2 == 0, F.col("failure_policy")).alias("failure_policy"),
        F.when(n % 7 == 3, False).when(n % 7 == 4, True).alias("enabled"),
    )
    by_hand = F.struct(
        F.col("source_name").alias("name"), F.col("source_url").alias("url"), "category", F.lit("en").alias("language"), F.lit("by hand").alias("reason")
    )
    in_order = lambda item: F.transform(F.array_sort(F.collect_list(F.struct(n.alias("n"), item.alias("item")))), lambda x: x["item"])
    # A catalogue is one document that people keep; here one entry per source.
    document = sources.agg(in_order(listed).alias("sources"), in_order(by_hand).alias("manual_sources"))
    return read_catalogue(spark, _text_file(document, F.to_json(F.struct("sources", "manual_sources", *(c.alias(n) for n, c in options.items()))), fresh_folder(spark, "catalogue")))


@query
def catalogue_scan(spark: SparkSession, folder: str) -> DataFrame:
    return enabled_sources(_catalogue(spark, folder))


@query
def manual_list(spark: SparkSession, folder: str) -> DataFrame:
    return manual_sources(_catalogue(spark, folder))


@query
def candidate_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Good documents as candidate files of a few hundred items, optional fields left out in part."""
    candidates = _live(spark, folder)[0]
    n = F.col("doc_id")
    item = F.struct(
        "title", "url", F.col("source_name").alias("source"), F.when(n % 2 == 0, F.col("source_url")).alias("source_url"), "category",
        F.when(n % 3 == 0, F.col("quality")).alias("quality"), F.when(n % 5 == 0, F.col("language")).alias("language"),
        d.iso_text(F.col("published_at")).alias("published_at"), F.when(n % 7 != 0, F.col("summary")).alias("summary"),
    )
    listed = candidates.groupBy("brief_date", F.floor(n / 500).alias("_file")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("item")))), lambda x: x["item"])).alias("value")
    )
    root = fresh_folder(spark, "candidates")
    days = listed.select("value", F.date_format("brief_date", "yyyy-MM-dd").alias("day"), "_file")
    days.write.partitionBy("day", "_file").text(root)
    found = read_candidates(spark, root)
    return candidate_articles(found).select(
        _day(), "title", "url", "summary", "source_key", "quality", "language", _moment(F.col("published_at")).alias("published_at")
    )


@query
def status_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Daily counts written as dated tables, then some dates once more; a rewritten date is replaced, others stay."""
    articles = _articles(spark, folder)
    counts = staged(articles.groupBy("brief_date").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last")), "counts")
    path = fresh_folder(spark, "status")
    write_dates(counts.withColumn("run", F.lit(1)), path)
    write_dates(counts.filter(F.dayofmonth("brief_date") % 2 == 0).withColumn("run", F.lit(2)), path)
    return spark.read.parquet(path).select(_day(), "n", "last", "run")


@query
def digest_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest document of the digests written to their sink."""
    dates = a.run_dates(_articles(spark, folder))
    path = fresh_folder(spark, "documents")
    write_dates(digest.digest_documents(staged(_items(spark, folder), "items"), dates, TITLE), path)
    return latest_row(spark.read.parquet(path)).select(_day(), "document")


# Feeds.


def _payloads(spark: SparkSession, folder: str) -> DataFrame:
    return staged(a.document_payloads(spark, folder), "payloads")


def _feed_columns(articles: DataFrame) -> DataFrame:
    return articles.select("source_key", "title", "url", "summary", _moment(F.col("published_at")).alias("published_at"), "category")


@query
def feed_parse(spark: SparkSession, folder: str) -> DataFrame:
    payloads = _payloads(spark, folder)
    return _feed_columns(feed_articles(read_feeds(payloads, SETTINGS.items_per_source), a.payload_sources(payloads)))


@query
def source_probe(spark: SparkSession, folder: str) -> DataFrame:
    payloads = _payloads(spark, folder)
    # Sources of single documents are in the catalogue too; nothing arrives for them.
    sources = a.payload_sources(payloads)
    sources = sources.unionByName(a.document_sources(spark, folder).select(*sources.columns))
    checks = probe_sources(payloads, sources, F.lit("r1"), F.col("brief_date").cast("timestamp"))
    return checks.select("source_key", "ok", "article_count", "error")


# Streams.


def _stream(spark: SparkSession, folder: str, name: str, df: DataFrame | None = None) -> DataFrame:
    """A table as a stream: the table's own files, or ``df`` written as files first."""
    if df is None:
        schema = a.table(spark, folder, name).schema
        return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@query
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    payloads = _payloads(spark, folder)
    out = fresh_folder(spark, "stream-ingest")
    jobs.ingest_feeds(_stream(spark, folder, "payloads", payloads), a.payload_sources(payloads), f"{out}/data", f"{out}/log", SETTINGS.items_per_source)
    return _feed_columns(spark.read.parquet(f"{out}/data"))


def _parts(spark: SparkSession, df: DataFrame, part: Column, job: Callable[[DataFrame], None], name: str) -> None:
    """Land the rows of part 0, 1 and 2 of a stored table one after the other as files of one folder, and run a stream
    job after each."""
    parted, path = df.withColumn("_part", part), fresh_folder(spark, f"{name}-landed")
    for number in range(3):
        rows = parted.filter(F.col("_part") == number).drop("_part")
        rows.write.mode("append").parquet(path)
        job(spark.readStream.schema(rows.schema).parquet(path))


def _days_since_first(column: str) -> Column:
    return F.greatest(F.lit(0), F.datediff(F.col(column).cast("date"), F.lit(a.FIRST_DAY).cast("date")))


@query
def stream_health(spark: SparkSession, folder: str) -> DataFrame:
    """Checks that come over three batches, so that runs are split; a last sign of life closes all runs."""
    out = fresh_folder(spark, "stream-health")
    checks = staged(a.event_checks(spark, folder), "checks")
    span = F.max("run_at") - F.min("run_at")
    end = checks.agg((F.max("run_at") + span + F.expr("interval 2 days")).alias("run_at"), F.ceil(F.unix_seconds(F.max("run_at")) / 86400 - F.unix_seconds(F.min("run_at")) / 86400 + 1).alias("days")).first()
    if end["days"] is None:
        return _health_columns(_no_health(spark))
    alive = checks.limit(1).withColumns({"run_id": F.lit("alive"), "run_at": F.lit(end["run_at"]), "seq": F.lit(-1).cast("bigint"), "source_key": F.lit("alive")})
    half = F.floor(_days_since_first("checked_at") / 15)
    part = F.when(F.col("run_id") == "alive", 2).otherwise(F.least(F.lit(2), half + F.pmod("seq", F.lit(3))))
    lateness = f"{end['days']} days"
    job = lambda stream: jobs.update_health(stream, f"{out}/data", f"{out}/log", SETTINGS.failure_threshold, lateness)
    _parts(spark, checks.unionByName(alive), part, job, "checks")
    return _health_columns(jobs.read_health(spark, f"{out}/data"))


@query
def stream_cache(spark: SparkSession, folder: str) -> DataFrame:
    out = fresh_folder(spark, "stream-cache")
    # Runs come in several batches and in no order of their dates.
    articles = staged(_articles(spark, folder).withColumn("fetched_at", _fetched_at()), "live")
    job = lambda stream: jobs.update_cache(stream, f"{out}/data", f"{out}/log", SETTINGS.cache_retention_days)
    _parts(spark, articles, F.pmod(F.hash("brief_date"), F.lit(3)), job, "live")
    cached = jobs.read_cache(spark, f"{out}/data").filter("title is not null")
    return cached.select("source_key", F.col("item_pos").alias("doc_id"), _moment(F.col("published_at")).alias("published_at"))


@query
def stream_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    out = fresh_folder(spark, "stream-counts")
    events = _stream(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp"))
    jobs.count_days(events, "at", ["event_type"], f"{out}/data", f"{out}/log")
    return jobs.read_day_counts(spark, f"{out}/data", ["event_type"]).select(_day("day"), "event_type", "n")


@query
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of a link come in different batches; the first batch's stays."""
    out = fresh_folder(spark, "stream-dedupe")
    live = _articles(spark, folder).select("url", "published_at", _fetched_at().alias("fetched_at"), "doc_id")
    job = lambda stream: jobs.drop_seen_links(stream, f"{out}/data", f"{out}/log", "90 days")
    _parts(spark, staged(live, "links"), F.pmod("doc_id", F.lit(3)), job, "links")
    return spark.read.parquet(f"{out}/data").select("link_key", "url", _moment(F.col("event_time")).alias("event_time"))


@query
def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of every event: a tenth comes in the last batch whatever its time, some have none."""
    out = fresh_folder(spark, "stream-late")
    n = F.col("event_id")
    events = a.table(spark, folder, "events").select("event_id", F.when(n % 97 != 0, F.col("ts").cast("timestamp")).alias("at"), _days_since_first("ts").alias("_day"))
    part = F.when(n % 10 == 0, 2).otherwise(F.least(F.lit(2), F.floor(F.col("_day") / 10)))
    _parts(spark, events, part, lambda stream: jobs.split_late(stream, "at", out, f"{out}-log"), "events")
    accepted = spark.read.parquet(f"{out}/accepted").select("event_id", F.lit("accepted").alias("fate"))
    return accepted.unionByName(spark.read.parquet(f"{out}/late").select("event_id", F.col("reason").alias("fate")))
