"""Plain projections from general tables to the relations of the digest jobs.

They let the jobs run on any corpus: documents and web pages become articles, events become source
checks. Nothing is filtered by id; every row of a table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedloom.operators.health import source_key
from feedloom.operators.ordering import CANDIDATE, LIVE, article_seq
from feedloom.operators.stage import spread_single
from feedloom.settings import CATEGORIES, Lexicon

FIRST_DAY = "2024-01-01"

# Word fragments common in the invented prose of the test tables, so that every rung of the score
# ladder and every label occurs.
FRAGMENTS = Lexicon(
    score_terms={
        "impact": ("onth", "erst", "wh", "und", "que", "ment", "sch", "con", "par", "ción"),
        "novelty": ("eau", "ich", "ing", "der", "tion", "thin", "esh", "rea", "oué", "ado"),
        "pm_relevance": ("the", "est", "onth", "lich", "ouan", "dad", "aire", "nder", "iou"),
        "actionability": ("wh", "ent", "ndst", "keit", "eaux", "mente", "tor", "ung", "ous"),
    },
    label_terms={
        "AI Agent": ("sch", "ndst"),
        "AI Copilot": ("con",),
        "AI Workflow": ("par",),
        "AI Analytics": ("ción",),
        "Retail Media": ("eau",),
        "Seller Tools": ("ich", "keit"),
        "Marketplace": ("und",),
        "Conversion Funnel": ("que",),
        "RAG": ("rag",),
        "Multimodal": ("onth",),
    },
    frontier_terms=("wh", "ment"),
    finance_words=("the", "und"),
    product_words=("of", "die"),
    stage_terms={
        "入驻": ("sch",),
        "流量/广告": ("con", "par"),
        "转化": ("ción",),
        "履约": ("rag",),
        "数据分析": ("eau",),
    },
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _category(number: Column) -> Column:
    return F.get(F.array(*map(F.lit, CATEGORIES)), F.pmod(number, F.lit(5)).cast("int"))


def _source_number() -> Column:
    return F.regexp_extract("source", r"(\d+)$", 1).cast("int")


def _doc_day() -> Column:
    """Digest date of a document: blocks of six share a date, with gaps of up to eleven days."""
    block = F.pmod(F.floor(F.col("doc_id") / 6), F.lit(60))
    return F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(block * block, F.lit(60)).cast("int"))


def document_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as live articles; the first line is the title, the rest the summary."""
    docs = spread_single(table(spark, folder, "documents"), "doc_id")
    title = F.substring_index("text", "\n", 1)
    number = _source_number()
    age = F.pmod("doc_id", F.lit(9)).cast("int")
    second = F.pmod(F.col("doc_id") * 7919, F.lit(86400))
    published = F.timestamp_seconds(F.unix_seconds(F.date_sub("brief_date", age).cast("timestamp")) + second)
    name, url = F.col("source"), F.concat(F.lit("https://feeds.example.org/"), "source")
    return docs.withColumn("brief_date", _doc_day()).select(
        "brief_date",
        article_seq(LIVE, number, F.col("doc_id")),
        title.alias("title"),
        F.concat(
            F.lit("https://News.Example.org/"), "lang", F.lit("/"), F.floor(F.col("doc_id") / 3).cast("string"),
            F.lit("/?utm_source="), "source",
        ).alias("url"),
        F.substr("text", F.length(title) + 2).alias("summary"),
        source_key(name, url).alias("source_key"),
        name.alias("source_name"),
        url.alias("source_url"),
        _category(number).alias("category"),
        (F.pmod(number, F.lit(3)) + 3).alias("quality"),
        F.col("lang").alias("language"),
        F.when(F.pmod("doc_id", F.lit(17)) != 0, published).alias("published_at"),
        "doc_id",
    )


def split_candidates(spark: SparkSession, folder: str, articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, live): documents that people labelled good count as hand-supplied."""
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    candidates = articles.join(good, "doc_id", "left_semi").withColumn(
        "seq", article_seq(CANDIDATE, F.lit(0), F.col("doc_id"))
    )
    return candidates, articles.join(good, "doc_id", "left_anti")


def document_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue of sources that documents come from."""
    number = _source_number()
    url = F.concat(F.lit("https://feeds.example.org/"), "source")
    return table(spark, folder, "documents").select("source").distinct().select(
        source_key(F.col("source"), url).alias("source_key"),
        number.alias("source_pos"),
        F.col("source").alias("source_name"),
        url.alias("source_url"),
        _category(number).alias("category"),
        (F.pmod(number, F.lit(3)) + 3).alias("quality"),
        F.lit("en").alias("language"),
        F.lit(2).alias("tier"),
        F.when(F.pmod(number, F.lit(4)) == 0, "always_try").otherwise("skip_when_unstable").alias("failure_policy"),
    )


def document_failures(spark: SparkSession, folder: str) -> DataFrame:
    """A source fails on a date when one of its documents of that date is labelled toxic."""
    toxic = table(spark, folder, "labels").filter("toxic = 1").select("doc_id")
    url = F.concat(F.lit("https://feeds.example.org/"), "source")
    return (
        table(spark, folder, "documents").select("doc_id", "source").join(toxic, "doc_id", "left_semi")
        .select(
            _doc_day().alias("brief_date"), source_key(F.col("source"), url).alias("source_key"),
            _source_number().alias("source_pos"), F.col("source").alias("source_name"),
            F.lit("HTTP Error 503: Service Unavailable").alias("error"),
        )
        .distinct()
    )


def run_dates(articles: DataFrame, days_after: int = 14) -> DataFrame:
    """Digest dates: those of the articles and the two weeks after each."""
    days = F.explode(F.sequence(F.lit(0), F.lit(days_after)))
    return (
        articles.select("brief_date").distinct()
        .select(F.col("brief_date").alias("_day"), days.alias("_n"))
        .select(F.date_add("_day", F.col("_n")).alias("brief_date"))
        .distinct()
    )


def page_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as articles of one run."""
    pages = table(spark, folder, "pages")
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return pages.select(F.col("page_id").alias("seq"), title.alias("title"), "url", "html")


def event_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Events as source checks: an error event is a failed check, and a minute is a run."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    ok = F.col("event_type") != "error"
    name = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    url = F.concat(F.lit("https://example.org/"), F.col("user_id").cast("string"))
    error = (
        F.when(ok, "").when(k < 30, "URLError: Temporary failure in name resolution")
        .when(k < 60, "HTTPError: HTTP Error 404: Not Found").otherwise("no articles returned")
    )
    at = F.col("ts").cast("timestamp")
    return table(spark, folder, "events").select(
        F.date_format(at, "yyyy-MM-dd HH:mm").alias("run_id"),
        source_key(name, url).alias("source_key"), name.alias("name"), url.alias("url"),
        ok.alias("ok"), F.when(ok, k).otherwise(0).alias("article_count"), error.alias("error"),
        at.alias("checked_at"), F.col("event_id").alias("seq"), F.date_trunc("minute", at).alias("run_at"),
    )


def document_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Feed payloads written from documents: twelve consecutive documents make one feed.

    Feeds take turns: RSS, Atom, and one that breaks off. A document without a second line
    gives an item without a link.
    """
    docs = table(spark, folder, "documents")

    def xml(text: Column) -> Column:
        for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            text = F.replace(text, F.lit(raw), F.lit(safe))
        return text

    def tag(name: str, text: Column | str) -> Column:
        return F.concat(F.lit(f"<{name}>"), text if isinstance(text, Column) else F.lit(text), F.lit(f"</{name}>"))

    title = F.substring_index("text", "\n", 1)
    summary = F.substr("text", F.length(title) + 2)
    link = F.when(F.length(summary) > 0, F.concat(F.lit("https://news.example.org/?id="), F.col("doc_id").cast("string"))).otherwise("")
    moment = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 61)
    rss = tag("item", F.concat(
        tag("title", xml(title)), tag("link", link), tag("description", xml(summary)),
        tag("pubDate", F.date_format(moment, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")),
    ))
    atom = tag("entry", F.concat(
        tag("title", xml(title)), F.lit('<link rel="self"/><link href="'), link, F.lit('"/>'), tag("content", xml(summary)),
        tag("updated", F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
    ))
    feed = F.floor(F.col("doc_id") / 12)
    kind = F.pmod(feed, F.lit(3))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "item"))), lambda x: x["item"]), "")
    body = (
        F.when(F.col("kind") == 0, F.concat(F.lit('<?xml version="1.0"?><rss version="2.0"><channel><title>f</title>'), "items", F.lit("</channel></rss>")))
        .when(F.col("kind") == 1, F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), "items", F.lit("</feed>")))
        .otherwise(F.concat(F.lit("<rss><channel>"), "items"))
    )
    return (
        docs.select("doc_id", feed.alias("feed"), kind.alias("kind"), F.when(kind == 1, atom).otherwise(rss).alias("item"))
        .groupBy("feed", "kind").agg(items.alias("items"))
        .select(
            F.lit(FIRST_DAY).cast("date").alias("brief_date"), F.concat(F.lit("feed"), F.col("feed").cast("string")).alias("source_key"),
            body.alias("body"), F.lit(None).cast("string").alias("error"), F.col("feed"),
        )
    )


def payload_sources(payloads: DataFrame) -> DataFrame:
    """The catalogue that goes with ``document_payloads``."""
    name = F.col("source_key")
    return payloads.select(
        "source_key", F.col("feed").cast("int").alias("source_pos"), name.alias("source_name"),
        F.concat(F.lit("https://"), name).alias("source_url"), _category(F.col("feed")).alias("category"),
        F.lit(4).alias("quality"), F.lit("en").alias("language"), F.lit(2).alias("tier"),
        F.lit("skip_when_unstable").alias("failure_policy"),
    )
