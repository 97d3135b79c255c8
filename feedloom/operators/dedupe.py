"""Duplicate removal by link *or* title, earliest article first.

In ``seq`` order an article stays unless its link key or its title key belongs to an article that
already stayed; an article that goes does not claim its keys. Neither two passes of
``dropDuplicates`` nor connected components give this result.

Done in rounds over (group, seq, link hash, title hash) only. In a round

1. an article that is first for its link and for its title stays;
2. articles sharing a key with one that stays go, and the rest enter the next round.

That settles most articles in two rounds, but a chain of articles only link by link. All later rounds
also settle chains, however long:

3. every link and every title names its first two articles (cut per input partition before the shuffle);
4. an article with a single earlier neighbour stays exactly when that one goes, so along a chain of
   such articles every second one stays: places in chains come from pointer doubling.

Further rounds are needed only behind articles with several earlier neighbours. There is one plan for
all sizes, and the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from feedloom.functions.text import title_key
from feedloom.functions.urls import with_url_key
from feedloom.operators.segments import top_rows
from feedloom.operators.stage import staged, staged_counted


#: Rounds before chains are looked at.
PLAIN_ROUNDS = 2


def _hash(text: Column) -> Column:
    """128 bits: wide enough that no two different keys of any feasible table meet. Null is an empty key."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _unique_seq(rows: DataFrame, group: list[str]) -> DataFrame:
    """``rows`` if no (group, seq) occurs twice; else the job stops."""
    again = F.raise_error(F.concat(F.lit("seq is not unique: "), F.col("seq").cast("string")))
    counted = rows.groupBy(*group, "seq").agg(F.count(F.lit(1)).alias("_n"), F.first("_link").alias("_link"), F.first("_title").alias("_title"))
    return counted.withColumn("_link", F.when(F.col("_n") > 1, again.cast("binary")).otherwise(F.col("_link"))).drop("_n")


def _first_two(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, seq, pos, first): the first two articles of every key."""
    two = top_rows(rows, keys, ["seq"], 2, f"_pos_{name}")
    first = two.filter(F.col(f"_pos_{name}") == 1).select(*keys, F.col("seq").alias(f"_first_{name}"))
    return two.join(first, keys)


def _first_of_both(rows: DataFrame, group: list[str]) -> DataFrame:
    """(group, seq, _link, _title) of articles that are the first of their link and of their title."""
    first_of_link = rows.groupBy(*group, "_link").agg(F.min("seq").alias("seq"))
    first_of_title = rows.groupBy(*group, "_title").agg(F.min("seq").alias("seq"))
    return staged(first_of_link.join(first_of_title, [*group, "seq"]), "dedupe-kept")


def _staying(rows: DataFrame, group: list[str]) -> DataFrame:
    """(group, seq, _link, _title) of the first of both keys, and of articles in chains that stay."""
    links = _first_two(rows, [*group, "_link"], "link")
    titles = _first_two(rows, [*group, "_title"], "title").drop("_link")
    both = links.join(titles.withColumnRenamed("_title", "_title2"), [*group, "seq"]).filter(F.col("_title") == F.col("_title2"))
    link_first, title_first = F.col("_pos_link") == 1, F.col("_pos_title") == 1
    # The one earlier neighbour of an article; an article without any points to itself.
    at = F.when(link_first & title_first, F.col("seq")).when(title_first, F.col("_first_link")).when(link_first, F.col("_first_title"))
    narrow = [*group, "seq", "_link", "_title"]
    state = both.withColumn("_at", at).filter(F.col("_at").isNotNull())
    first = F.col("_at") == F.col("seq")
    state = staged(state.select(*narrow, "_at", (~first).alias("_odd"), first.alias("_ends")), "dedupe-chains")
    goes = F.coalesce(F.col("_next") != F.col("_at"), F.lit(False))
    moved = True
    while moved:
        ahead = state.select(*group, F.col("seq").alias("_at"), F.col("_at").alias("_next"), F.col("_odd").alias("_step"), "_ends")
        seen = Observation()
        jumped = state.drop("_ends").join(ahead, [*group, "_at"], "left").observe(seen, F.count_if(goes).alias("n"))
        state = staged(
            jumped.select(
                *narrow, F.when(goes, F.col("_next")).otherwise(F.col("_at")).alias("_at"),
                F.when(goes, F.col("_odd") != F.col("_step")).otherwise(F.col("_odd")).alias("_odd"),
                F.coalesce("_ends", F.lit(False)).alias("_ends"),
            ),
            "dedupe-chains",
        )
        moved = seen.get["n"] > 0
    # A chain is settled if it ends at an article without an earlier neighbour.
    return state.filter(F.col("_ends") & ~F.col("_odd")).select(*narrow)


def first_unique(keyed: DataFrame, group: list[str]) -> DataFrame:
    """(group, seq) of the rows that stay; ``keyed`` has group, seq, link_key and title_key.

    Null keys count as empty ones. ``seq`` must be unique within a group, else the job stops.
    """
    narrow = keyed.select(*group, "seq", _hash(F.col("link_key")).alias("_link"), _hash(F.col("title_key")).alias("_title"))
    # Of rows equal in both keys only the first can stay: exact copies fold on the map side.
    start = _unique_seq(narrow, group).groupBy(*group, "_link", "_title").agg(F.min("seq").alias("seq"))
    open_rows, n_open = staged_counted(start, "dedupe-open")
    kept_parts: list[DataFrame] = []
    while n_open > 0:
        kept = (_first_of_both if len(kept_parts) < PLAIN_ROUNDS else _staying)(open_rows, group)
        kept_parts.append(kept.select(*group, "seq"))
        rest = open_rows
        for key in ("_link", "_title"):
            rest = rest.join(kept.select(*group, key), [*group, key], "left_anti")
        open_rows, n_open = staged_counted(rest, "dedupe-open")
    if not kept_parts:
        return keyed.select(*group, "seq").limit(0)
    result = kept_parts[0]
    for part in kept_parts[1:]:
        result = result.unionByName(part)
    return result


def with_keys(articles: DataFrame) -> DataFrame:
    """Add ``link_key`` and ``title_key``."""
    return with_url_key(articles.withColumn("title_key", title_key(F.col("title"))))


def dedupe_articles(articles: DataFrame, group: list[str]) -> DataFrame:
    """Articles that stay, all columns; ``seq`` is unique within a group."""
    kept = first_unique(with_keys(articles), group)
    return articles.join(kept, [*group, "seq"], "left_semi")
