"""Feed parsing: landed RSS and Atom payloads to article rows.

A payload row has brief_date, source_key, body and error (null when the download went well).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedloom.functions.dates import with_feed_date
from feedloom.functions.text import clean_text
from feedloom.operators.ordering import LIVE, article_seq

_TEXTS = "array<string>"
_LINKS = "array<struct<_href: string, _VALUE: string>>"
_FIELDS = f"title: {_TEXTS}, link: {_LINKS}, description: {_TEXTS}, pubDate: {_TEXTS}"
_ENTRY = f"title: {_TEXTS}, link: {_LINKS}, summary: {_TEXTS}, content: {_TEXTS}, published: {_TEXTS}, updated: {_TEXTS}"
_FEED = (
    f"struct<channel: array<struct<item: array<struct<{_FIELDS}>>>>,"
    f" entry: array<struct<{_ENTRY}>>, _corrupt_record: string>"
)
# Groups of open length are possessive: Java runs them as a loop, so no payload is too long for them.
_ROOT = r"(?s)^(?:\s|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\])?[^>]*>)*+<([^\s/>]+)"
_TEXT_ELEMENT = "title|description|pubDate|summary|content|published|updated"
_NAME, _ATTRIBUTES = r"(?:[\w.-]++:)?", r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
#: A text element with its text, up to an element within it; then all up to its own end.
_NESTED = (
    rf"(<{_NAME}({_TEXT_ELEMENT})(?=[\s>]){_ATTRIBUTES}(?<!/)>)((?:[^<]++|<!\[CDATA\[(?s:.*?)\]\]>|<!--(?s:.*?)-->|<\?(?s:.*?)\?>)*+)"
    rf"<(?=\w)(?s:.*?)(</{_NAME}\2\s*+>)"
)


def own_text_only(body: Column) -> Column:
    """The payload with elements inside texts cut out: a text ends where its first element begins."""
    return F.regexp_replace(body, _NESTED, "$1$3$4")


def _first(texts: Column) -> Column:
    """Text of the first element of a name, empty when there is none."""
    return F.coalesce(F.get(texts, F.lit(0)), F.lit(""))


def _or_else(text: Column, other: Column) -> Column:
    return F.when(text != "", text).otherwise(other)


def _rss_item(item: Column) -> Column:
    return F.struct(
        _first(item["title"]).alias("title"),
        F.coalesce(F.get(item["link"], F.lit(0))["_VALUE"], F.lit("")).alias("url"),
        _first(item["description"]).alias("summary"),
        _first(item["pubDate"]).alias("date"),
    )


def _atom_entry(entry: Column) -> Column:
    linked = F.filter(entry["link"], lambda link: F.coalesce(link["_href"], F.lit("")) != "")
    return F.struct(
        _first(entry["title"]).alias("title"),
        F.coalesce(F.get(linked, F.lit(0))["_href"], F.lit("")).alias("url"),
        _or_else(_first(entry["summary"]), _first(entry["content"])).alias("summary"),
        _or_else(_first(entry["published"]), _first(entry["updated"])).alias("date"),
    )


def read_feeds(payloads: DataFrame, limit: int = 8) -> DataFrame:
    """Payloads with ``is_rss``, ``items`` (the first ``limit`` raw items) and ``error``.

    A feed that did not arrive or is not XML keeps its row, with no items and an error.
    """
    root = F.regexp_extract("body", _ROOT, 1)
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = payloads.withColumns({"is_rss": root.endswith("rss"), "_feed": F.from_xml(own_text_only(F.col("body")), _FEED, options)})
    none = F.array().cast("array<struct<title: string, url: string, summary: string, date: string>>")
    rss = F.transform(F.slice(F.flatten("_feed.channel.item"), 1, limit), _rss_item)
    atom = F.transform(F.slice("_feed.entry", 1, limit), _atom_entry)
    broken = F.col("body").isNull() | (F.col("body") == "") | F.col("_feed._corrupt_record").isNotNull()
    return parsed.withColumns(
        {
            "items": F.when(broken, none).otherwise(F.coalesce(F.when(F.col("is_rss"), rss).otherwise(atom), none)),
            "error": F.coalesce("error", F.when(broken, F.lit("ParseError: not well-formed"))),
        }
    ).drop("_feed", "body")


def feed_articles(feeds: DataFrame, sources: DataFrame) -> DataFrame:
    """Valid articles of parsed feeds, with the attributes of their source and ``seq``.

    The cap was applied before this test, so invalid items use it up. ``fetched_at`` is kept where
    payloads have it.
    """
    times = [c for c in feeds.columns if c == "fetched_at"]
    # Sources are joined to whole feeds, before their items are unfolded.
    named = feeds.filter(F.size("items") > 0).join(sources, "source_key")
    own = ["brief_date", *times, *sources.columns]
    items = named.select(*own, "is_rss", F.posexplode("items").alias("item_pos", "item"))
    link = F.col("item.url")
    cleaned = with_feed_date(items.withColumn("_date", F.col("item.date")), "_date", "published_at").select(
        *own, "item_pos",
        clean_text(F.col("item.title")).alias("title"),
        F.when(F.col("is_rss"), clean_text(link)).otherwise(link).alias("url"),
        clean_text(F.col("item.summary")).alias("summary"),
        "published_at",
    )
    valid = cleaned.filter((F.col("title") != "") & (F.col("url") != ""))
    return valid.withColumn("seq", article_seq(LIVE, F.col("source_pos"), F.col("item_pos"))).drop("item_pos")


def feed_failures(feeds: DataFrame, sources: DataFrame) -> DataFrame:
    """Feeds that failed: (brief_date, source_key, source_pos, source_name, error)."""
    failed = feeds.filter("error is not null").select("brief_date", "source_key", "error")
    return failed.join(sources.select("source_key", "source_pos", "source_name"), "source_key")


def newest_payloads(payloads: DataFrame) -> DataFrame:
    """Of several payloads of a source and date, the one fetched last; one without a time is older than all others.

    Of payloads fetched at the same time it is one, always the same.
    """
    keys = ["brief_date", "source_key"]
    rest = [c for c in payloads.columns if c not in keys]
    age = F.struct(F.coalesce("fetched_at", F.timestamp_seconds(F.lit(-(2**40)))).alias("at"), F.xxhash64("body", "error").alias("hash"))
    newest = payloads.groupBy(*keys).agg(F.max_by(F.struct(*rest), age).alias("_row"))
    return newest.select(*keys, "_row.*").select(*payloads.columns)


def probe_sources(payloads: DataFrame, sources: DataFrame, run_id: Column, checked_at: Column) -> DataFrame:
    """Check results of every source on every date of ``payloads``: fine when its first item is a valid article.

    A source without a payload fails too. ``seq`` follows the time of the check, so runs of a day don't tie.
    """
    feeds = read_feeds(payloads, limit=1)
    counted = (
        feed_articles(feeds, sources).groupBy("brief_date", "source_key").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    )
    # Calendar dates: one row with a short list, whatever the data.
    dates = payloads.agg(F.collect_set("brief_date").alias("_dates"))
    asked = sources.crossJoin(F.broadcast(dates)).withColumn("brief_date", F.explode("_dates")).drop("_dates")
    arrived = feeds.select("brief_date", "source_key", "error", F.lit(True).alias("_arrived"))
    n = F.coalesce("_n", F.lit(0))
    problem = F.when(F.col("_arrived").isNull(), "nothing arrived").otherwise(F.coalesce("error", F.lit("no articles returned")))
    keys = ["brief_date", "source_key"]
    checks = asked.join(arrived, keys, "left").join(counted, keys, "left").withColumn("_at", checked_at)
    return checks.select(
        run_id.alias("run_id"), "source_key", F.col("source_name").alias("name"), F.col("source_url").alias("url"),
        (n > 0).alias("ok"), n.alias("article_count"), F.when(n > 0, "").otherwise(problem).alias("error"),
        F.col("_at").alias("checked_at"),
        (F.unix_seconds("_at") * F.lit(2**24) + F.col("source_pos")).alias("seq"),
    )
