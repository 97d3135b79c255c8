"""The same queries in DuckDB SQL, written apart from the Spark expressions."""

from __future__ import annotations

from feedloom import settings as s, wording as w
from feedloom.plans.adapters import FRAGMENTS

_WORD = r"[^\p{L}\p{N}_]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _map(pairs) -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in pairs.items()) + "}"


def _hits(terms) -> str:
    return " + ".join(f"contains(t, {_q(x)})::INT" for x in terms)


def _any(terms, text: str = "t") -> str:
    return "(" + " OR ".join(f"contains({text}, {_q(x)})" for x in terms) + ")"


def _word(words) -> str:
    return f"regexp_matches(t, '(^|{_WORD})({'|'.join(words)})($|{_WORD})')"


def _ladder(hits: str) -> str:
    return f"(CASE WHEN {hits} >= 8 THEN 5 WHEN {hits} >= 5 THEN 4 WHEN {hits} >= 3 THEN 3 WHEN {hits} >= 1 THEN 2 ELSE 1 END)"


CATEGORY = "{}[1 + ({} % 5)::INT]".format(_list(s.CATEGORIES), "{}")

ART = f"""
art AS MATERIALIZED (
  SELECT doc_id, lang, source AS source_name, split_part(text, chr(10), 1) AS title,
    substr(text, length(split_part(text, chr(10), 1)) + 2) AS summary,
    'https://News.Example.org/' || lang || '/' || (doc_id // 3) || '/?utm_source=' || source AS url,
    'https://news.example.org/' || lang || '/' || (doc_id // 3) AS link_key,
    trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')) AS title_key,
    num, source || '|https://feeds.example.org/' || source AS source_key,
    {CATEGORY.format('num')} AS category, 3 + num % 3 AS quality, d AS brief_date,
    CASE WHEN doc_id % 17 <> 0 THEN (d - (doc_id % 9)::INT)::TIMESTAMP + to_seconds(doc_id * 7919 % 86400) END AS published_at,
    (1::BIGINT << 60) + (num::BIGINT << 40) + doc_id AS seq
  FROM (SELECT *, regexp_extract(source, '(\\d+)$', 1)::INT AS num,
          DATE '2024-01-01' + (((doc_id // 6) % 60) * ((doc_id // 6) % 60) % 60)::INT AS d FROM documents)
)"""

DATES = """
dates AS MATERIALIZED (
  SELECT DISTINCT brief_date + n::INT AS brief_date FROM (SELECT DISTINCT brief_date FROM art), range(15) r(n)
)"""

RECENT = """
recent AS MATERIALIZED (
  SELECT * FROM art
  WHERE published_at IS NULL OR published_at >= brief_date + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 3 DAY
)"""


def _scored(name: str, source: str, lex: s.Lexicon, wt: s.Weights = s.DEPLOYED_WEIGHTS) -> str:
    g = lex.score_terms
    labels = ", ".join(f"CASE WHEN {_any(terms)} THEN {_q(label)} END" for label, terms in lex.label_terms.items())
    extra = ", ".join(f"CASE WHEN category = {_q(c)} THEN {_q(label)} END" for c, label in lex.category_labels.items())
    return f"""
{name}_h AS MATERIALIZED (
  SELECT *, {_hits(g['impact'])} AS hi, {_hits(g['novelty'])} AS hn, {_hits(g['pm_relevance'])} AS hp,
    {_hits(g['actionability'])} AS ha, {_any(lex.frontier_terms)} AS fb,
    ({_word(lex.finance_words)} AND NOT {_word(lex.product_words)}) AS fin,
    list_filter([{labels}, {extra}], lambda x: x IS NOT NULL)[1:5] AS keywords
  FROM (SELECT *, lower(title || ' ' || summary || ' ' || source_name || ' ' || category) AS t FROM {source})
),
{name}_c AS (
  SELECT * EXCLUDE (t, hi, hn, hp, ha, fb, fin),
    CASE WHEN fin THEN greatest(1, {_ladder('hi')} - 2) ELSE {_ladder('hi')} END AS impact,
    CASE WHEN category = 'AI Frontier' THEN least(5, {_ladder('hn')} + 1) ELSE {_ladder('hn')} END AS novelty,
    greatest(1, least(5, quality)) AS source_quality,
    CASE WHEN category IN ('E-commerce & Marketplace', 'China Tech & Retail') OR (category = 'AI Frontier' AND fb)
      THEN least(5, {_ladder('hp')} + 1) ELSE {_ladder('hp')} END AS pm_relevance,
    CASE WHEN fin THEN greatest(1, {_ladder('ha')} - 1) ELSE {_ladder('ha')} END AS actionability
  FROM {name}_h
),
{name} AS MATERIALIZED (
  SELECT *, round(impact * {wt.impact}::DOUBLE + novelty * {wt.novelty}::DOUBLE + source_quality * {wt.source_quality}::DOUBLE
    + pm_relevance * {wt.pm_relevance}::DOUBLE + actionability * {wt.actionability}::DOUBLE, 2) AS total
  FROM {name}_c
)"""


def _dedupe(name: str, source: str, date: str = "brief_date") -> str:
    """Ordered scan with the lists of keys already taken; needs RECURSIVE."""
    return f"""
{name}_k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY {date}, seq) AS rn, dense_rank() OVER (ORDER BY {date}, link_key) AS uk,
    dense_rank() OVER (ORDER BY {date}, title_key) AS tk, {date} AS kd, seq FROM {source}
),
{name}_r(rn, us, ts, keep) AS (
  SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], false
  UNION ALL
  SELECT k.rn,
    CASE WHEN list_contains(us, k.uk) OR list_contains(ts, k.tk) THEN us ELSE list_append(us, k.uk) END,
    CASE WHEN list_contains(us, k.uk) OR list_contains(ts, k.tk) THEN ts ELSE list_append(ts, k.tk) END,
    NOT (list_contains(us, k.uk) OR list_contains(ts, k.tk))
  FROM {name}_r r JOIN {name}_k k ON k.rn = r.rn + 1
),
{name} AS MATERIALIZED (
  SELECT k.kd, k.seq FROM {name}_r r JOIN {name}_k k USING (rn) WHERE keep
)"""


UNIQUE = f"""{_scored('sc', 'recent', FRAGMENTS)},
{_dedupe('kept', 'recent')},
uniq AS MATERIALIZED (
  SELECT sc.* FROM sc JOIN kept ON sc.brief_date = kept.kd AND sc.seq = kept.seq
)"""


def _fits(section: s.Section) -> str:
    where = f"total >= {section.threshold}"
    return where if section.categories is None else f"{where} AND category IN ({_list(section.categories)[1:-1]})"


def _items(source: str, order: str = "total DESC, seq") -> str:
    parts = " UNION ALL ".join(
        f"SELECT *, {i} AS section_no, {_q(x.name)} AS section, row_number() OVER (PARTITION BY brief_date ORDER BY {order}) AS pos"
        f" FROM {source} WHERE {_fits(x)}"
        for i, x in enumerate(s.SECTIONS)
    )
    return f"items AS MATERIALIZED (SELECT * FROM ({parts}) WHERE pos <= 3)"


CITED = """
cited AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY brief_date ORDER BY section_no, pos) AS cited_pos
  FROM (SELECT *, row_number() OVER (PARTITION BY brief_date, url ORDER BY section_no, pos) AS nth FROM items) WHERE nth = 1
)"""

LABELS = """
labels_of AS MATERIALIZED (
  SELECT d.brief_date, coalesce(flatten(l.lists), []::VARCHAR[]) AS labels
  FROM dates d LEFT JOIN (SELECT brief_date, list(keywords ORDER BY cited_pos) AS lists FROM cited GROUP BY 1) l USING (brief_date)
)"""


def _rule(rules, labels: str, default: str) -> str:
    whens = " ".join(f"WHEN list_has_any({labels}, {_list(names)}) THEN {_q(text)}" for names, text in rules)
    return f"CASE {whens} ELSE {_q(default)} END"


LINES = f"""
lines AS MATERIALIZED (
  SELECT brief_date, {_rule(w.SIGNALS, 'labels', w.SIGNAL_DEFAULT)} AS one_line_signal,
    {_rule(w.QUESTIONS, 'labels', w.QUESTION_DEFAULT)} AS thinking_question,
    list_transform(list_filter(
      list_transform(tg, lambda x, i: {{'x': x, 'first': list_position(tg, x) = i}}), lambda z: z.first), lambda z: z.x)[1:6] AS tags
  FROM (SELECT *, list_concat(list_filter(list_transform(labels, lambda k: {_map(w.TAG_BY_LABEL)}[k]), lambda z: z IS NOT NULL),
      {_list(w.TAGS_ALWAYS)}) AS tg FROM labels_of)
)"""

STAGES = "coalesce(nullif(array_to_string(list_filter([{}], lambda x: x IS NOT NULL), '、'), ''), {})".format(
    ", ".join(
        f"CASE WHEN {_any(terms, 'st')} THEN {_q(stage)} END" for stage, terms in FRAGMENTS.stage_terms.items()
    ),
    _q("、".join(FRAGMENTS.default_stages)),
)
_SHORT_TEXT = "CASE WHEN summary <> '' THEN summary ELSE title END"
SHORT = f"(CASE WHEN length({_SHORT_TEXT}) > 220 THEN substr({_SHORT_TEXT}, 1, 220) || '...' ELSE {_SHORT_TEXT} END)"
PRIORITY = "(CASE WHEN total >= 4.2 THEN 'High' WHEN total >= 3.0 THEN 'Medium' ELSE 'Low' END)"
DATE_TEXT = f"coalesce(strftime(published_at, '%Y-%m-%d'), {_q(w.DATE_UNKNOWN)})"
NUMBER = r"regexp_replace(printf('%.2f', total), '(\.\d)0$', '\1')"

RICH = f"""
rich AS MATERIALIZED (
  SELECT *, {PRIORITY} AS priority,
    coalesce({_map(w.WHY_BY_CATEGORY)}[category], {_q(w.WHY_DEFAULT)}) AS why_important,
    {_rule(w.TAKEAWAYS, 'keywords', w.TAKEAWAY_DEFAULT)} AS takeaway,
    array_to_string(list_transform(CASE WHEN len(keywords) > 0 THEN keywords ELSE {_list(w.KEYWORDS_DEFAULT)} END,
      lambda k: k || '：' || coalesce({_map(w.KEYWORD_NOTES)}[k], {_q(w.KEYWORD_NOTE_DEFAULT)})), '；') AS keyword_notes,
    {DATE_TEXT} AS date_text,
    '| ' || title || ' | ' || source_name || ' | ' || {DATE_TEXT} || ' | ' || {PRIORITY} || '，评分 ' || {NUMBER}
      || ' | [阅读](' || url || ') |' AS reading_row,
    {SHORT} AS summary_short, {STAGES} AS stages
  FROM (SELECT *, lower(title || ' ' || summary) AS st FROM items)
)"""

MAIN = f"WITH RECURSIVE {ART}, {DATES}, {RECENT}, {UNIQUE}, {_items('uniq')}, {CITED}"

CHECKS = """
checks AS MATERIALIZED (
  SELECT strftime(ts, '%Y-%m-%d %H:%M') AS run_id, 'user' || user_id || '|https://example.org/' || user_id AS source_key,
    event_type <> 'error' AS ok, CASE WHEN event_type <> 'error' THEN k ELSE 0 END AS article_count,
    CASE WHEN event_type <> 'error' THEN '' WHEN k < 30 THEN 'URLError: Temporary failure in name resolution'
      WHEN k < 60 THEN 'HTTPError: HTTP Error 404: Not Found' ELSE 'no articles returned' END AS error,
    ts AS checked_at, event_id AS seq
  FROM (SELECT *, regexp_extract(props, '(\\d+)', 1)::INT AS k FROM events)
),
flags AS MATERIALIZED (
  SELECT run_id, count(*) AS checked, count(*) FILTER (ok) AS n_ok, count(*) FILTER (NOT ok) AS n_failed,
    NOT bool_or(ok) AND count(*) FILTER (NOT ok) >= greatest(2, count(*) // 2)
      AND coalesce(bool_and(contains(lower(error), 'temporary failure in name resolution')) FILTER (NOT ok), false) AS is_outage,
    NOT bool_or(ok) AND coalesce(bool_and(contains(lower(error), 'temporary failure in name resolution')) FILTER (NOT ok), false) AS is_discarded
  FROM checks GROUP BY run_id
)"""


def _health(discard: bool, threshold: int = 3) -> str:
    where = "WHERE NOT is_discarded" if discard else ""
    return f"""
hist AS MATERIALIZED (
  SELECT *, CASE WHEN ok THEN 'healthy' WHEN streak >= {threshold} THEN 'unstable' ELSE 'degraded' END AS status
  FROM (
    SELECT *, sum(CASE WHEN NOT ok AND NOT is_outage THEN 1 ELSE 0 END) OVER (PARTITION BY source_key, grp ORDER BY seq)::INT AS streak
    FROM (
      SELECT c.*, f.is_outage, sum(ok::INT) OVER (PARTITION BY source_key ORDER BY seq) AS grp
      FROM checks c JOIN flags f USING (run_id) {where}
    )
  )
),
health AS MATERIALIZED (
  SELECT source_key, arg_max(status, seq) AS status, arg_max(CASE WHEN ok THEN 0 ELSE streak END, seq)::INT AS consecutive_failures,
    count(*) FILTER (ok) AS total_successes, count(*) FILTER (NOT ok) AS total_failures,
    strftime(max(checked_at), '%Y-%m-%d %H:%M:%S.%f') AS last_checked_at,
    strftime(max(checked_at) FILTER (ok), '%Y-%m-%d %H:%M:%S.%f') AS last_success_at,
    max(checked_at) FILTER (ok) AS ok_at, arg_max(error, seq) AS last_error, arg_max(article_count, seq)::INT AS last_article_count
  FROM hist GROUP BY source_key
)"""


HEALTH = f"WITH {CHECKS}, {_health(True)}"
STRICT_HEALTH = f"WITH {CHECKS}, {_health(True, 1)}"
_HEALTH_SELECT = "SELECT * EXCLUDE (ok_at) FROM health"
_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
_DAY = "strftime({0}, '%Y-%m-%d') AS {0}"
BD = _DAY.format("brief_date")

# The cache of a date: per source the newest run of the last week.
SOURCES = f"""
srcs AS MATERIALIZED (
  SELECT DISTINCT source AS source_name, num, {CATEGORY.format('num')} AS category, 3 + num % 3 AS quality
  FROM (SELECT source, regexp_extract(source, '(\\d+)$', 1)::INT AS num FROM documents)
)"""


def _cached(live: str) -> str:
    return f"""
runs AS MATERIALIZED (SELECT DISTINCT source_name, brief_date AS run_date FROM {live}),
serving AS MATERIALIZED (
  SELECT d.brief_date, r.source_name, max(r.run_date) AS run_date FROM dates d
  JOIN runs r ON r.run_date BETWEEN d.brief_date - 7 AND d.brief_date GROUP BY 1, 2
),
cached AS MATERIALIZED (
  SELECT v.brief_date, l.* EXCLUDE (brief_date, seq), (2::BIGINT << 60) + (num::BIGINT << 40) + l.doc_id AS seq
  FROM serving v JOIN {live} l ON l.source_name = v.source_name AND l.brief_date = v.run_date
  WHERE (l.published_at IS NULL OR l.published_at >= l.brief_date + INTERVAL 8 HOUR - INTERVAL 7 DAY)
    AND l.brief_date + INTERVAL 8 HOUR >= v.brief_date + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 7 DAY
    AND l.title <> ''
)"""


_ARCHIVE_LABELS = ", ".join(
    [f"CASE WHEN {_any(terms)} THEN {_q(label)} END" for label, terms in FRAGMENTS.label_terms.items()]
    + [f"CASE WHEN category = {_q(c)} THEN {_q(label)} END" for c, label in s.CATEGORY_LABELS.items()]
)


def _archive(dates: str) -> str:
    """Scored documents are the archive; 24 newest links per date."""
    return f"""{_scored('asc_', 'art', FRAGMENTS)},
arch AS MATERIALIZED (
  SELECT * EXCLUDE (keywords, seq, impact, novelty, pm_relevance, actionability),
    (3::BIGINT << 60) + doc_id AS seq, list_filter([{_ARCHIVE_LABELS}], lambda x: x IS NOT NULL)[1:5] AS keywords
  FROM (SELECT *, lower(title || '  ' || source_name || ' ' || category) AS t FROM asc_ WHERE title <> '')
),
arch_hits AS MATERIALIZED (
  SELECT brief_date, doc_id FROM (
    SELECT brief_date, doc_id, row_number() OVER (PARTITION BY brief_date ORDER BY doc_id DESC) AS n FROM (
      SELECT d.brief_date, x.url, max(x.doc_id) AS doc_id FROM {dates} d
      JOIN arch x ON x.published_at IS NULL OR x.published_at >= d.brief_date - INTERVAL 7 DAY GROUP BY 1, 2))
  WHERE n <= 24
),
archived AS MATERIALIZED (
  SELECT h.brief_date, x.* EXCLUDE (brief_date) FROM arch_hits h JOIN arch x USING (doc_id)
)"""


_STRONG = "(total >= 3.0 OR total >= 2.8 AND category IN ('AI Frontier', 'Product & Startup Signals'))"
_OWN_FIRST = "(SELECT min(brief_date) FROM dates)"

# Dates in order: those with content add their lines, those without take the newest 24 links and, if these are worth it,
# add them as lines of their own.
_WALK = f"""
static_hits AS MATERIALIZED (SELECT h.brief_date, x.doc_id FROM arch_hits h JOIN arch x USING (doc_id)),
own_kept AS MATERIALIZED (
  SELECT ps.* FROM ps JOIN pk ON ps.brief_date = pk.kd AND ps.seq = pk.seq
),
own_written AS MATERIALIZED (
  SELECT DISTINCT brief_date FROM own_kept WHERE brief_date IN (SELECT brief_date FROM fresh) OR {_STRONG} OR brief_date = {_OWN_FIRST}
),
own_lines AS MATERIALIZED (
  SELECT brief_date, doc_id, url, title, published_at, datediff('day', DATE '1970-01-01', brief_date)::BIGINT * 68719476736
    + row_number() OVER (PARTITION BY brief_date ORDER BY total DESC, seq) - 1 AS line
  FROM own_kept WHERE brief_date IN (SELECT brief_date FROM own_written)
),
entries AS MATERIALIZED (
  SELECT brief_date, 'own' AS kind, line, url, published_at AS pub, doc_id FROM own_lines WHERE title <> ''
  UNION ALL
  SELECT h.brief_date, 'ask', x.doc_id, x.url, x.published_at, x.doc_id FROM static_hits h JOIN arch x USING (doc_id)
  UNION ALL SELECT brief_date, 'ask', NULL, NULL, NULL, NULL FROM left3
),
steps AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY brief_date) AS i, * FROM (
    SELECT brief_date, min(kind) AS kind, list({{'line': line, 'url': url, 'pub': pub, 'id': doc_id}}) FILTER (line IS NOT NULL) AS given
    FROM entries GROUP BY brief_date)
),
strong_ids AS MATERIALIZED (SELECT list(doc_id) AS ids FROM arch WHERE {_STRONG}),
walk AS (
  SELECT 0::BIGINT AS i, NULL::DATE AS brief_date, 'own' AS kind, []::STRUCT(line BIGINT, url VARCHAR, pub TIMESTAMP, id BIGINT)[] AS state,
    []::STRUCT(line BIGINT, url VARCHAR, pub TIMESTAMP, id BIGINT)[] AS picked
  UNION ALL
  SELECT i, brief_date, kind,
    list_concat(list_filter(state, lambda s: NOT list_contains(list_transform(added, lambda a: a.url), s.url)), added), picked
  FROM (
    SELECT i, brief_date, kind, state, picked, CASE WHEN kind = 'own' THEN given
      WHEN brief_date = {_OWN_FIRST} OR len(list_filter(picked, lambda p: list_contains(ids, p.id))) > 0
        THEN list_transform(list_sort(picked), lambda p, n: {{'line': datediff('day', DATE '1970-01-01', brief_date)::BIGINT * 68719476736 + n - 1, 'url': p.url, 'pub': p.pub, 'id': p.id}})
      ELSE [] END AS added
    FROM (
      SELECT s.i, s.brief_date, s.kind, w.state, coalesce(s.given, []) AS given, strong_ids.ids,
        CASE WHEN s.kind = 'own' THEN [] ELSE list_reverse(list_sort(list_concat(
          list_filter(w.state, lambda x: x.pub IS NULL OR x.pub >= s.brief_date - INTERVAL 7 DAY),
          list_filter(coalesce(s.given, []), lambda g: NOT list_contains(list_transform(w.state, lambda x: x.url), g.url)))))[1:24] END AS picked
      FROM walk w JOIN steps s ON s.i = w.i + 1, strong_ids
    )
  )
),
archived_walk AS MATERIALIZED (
  SELECT p.brief_date, (3::BIGINT << 60) + ((p.pick.line // 68719476736) << 40) + p.pick.line % 68719476736 AS seq, x.* EXCLUDE (brief_date, seq)
  FROM (SELECT brief_date, unnest(picked) AS pick FROM walk WHERE kind = 'ask') p JOIN arch x ON x.doc_id = p.pick.id
)"""

# The whole run: candidates are documents labelled good, all others are live.
RUN = f"""WITH RECURSIVE {ART}, {DATES}, {SOURCES},
cands AS MATERIALIZED (
  SELECT * EXCLUDE (seq), doc_id AS seq FROM art WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
),
live AS MATERIALIZED (SELECT * FROM art WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)),
own AS MATERIALIZED (SELECT * FROM cands UNION ALL BY NAME SELECT * FROM live),
fresh AS MATERIALIZED (
  SELECT * FROM own
  WHERE published_at IS NULL OR published_at >= brief_date + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 3 DAY
),
left2 AS MATERIALIZED (SELECT brief_date FROM dates WHERE brief_date NOT IN (SELECT brief_date FROM fresh)),
{_cached('live')},
second AS MATERIALIZED (
  SELECT * FROM (SELECT * FROM cands UNION ALL BY NAME SELECT * FROM cached)
  WHERE brief_date IN (SELECT brief_date FROM left2)
    AND (published_at IS NULL OR published_at >= brief_date + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 7 DAY)
),
left3 AS MATERIALIZED (SELECT brief_date FROM left2 WHERE brief_date NOT IN (SELECT brief_date FROM second)),
{_archive('left3')},
pool AS MATERIALIZED (SELECT * FROM fresh UNION ALL BY NAME SELECT * FROM second),
{_scored('ps', 'pool', FRAGMENTS)},
{_dedupe('pk', 'pool')},
{_WALK},
tiers AS MATERIALIZED (
  SELECT brief_date, CASE WHEN brief_date IN (SELECT brief_date FROM fresh) THEN 'none'
    WHEN brief_date IN (SELECT brief_date FROM second) THEN 'feed_cache'
    WHEN brief_date IN (SELECT brief_date FROM archived_walk) THEN 'archive' ELSE 'empty' END AS tier FROM dates
),
everything AS MATERIALIZED (
  SELECT ps.brief_date, ps.seq, title, url, source_name, category, published_at, total, total AS rank_total, keywords, doc_id, summary
  FROM ps JOIN pk ON ps.brief_date = pk.kd AND ps.seq = pk.seq
  UNION ALL
  SELECT brief_date, seq, title, url, source_name, category, published_at, total, 0 AS rank_total, keywords, doc_id, '' FROM archived_walk
),
{_items('everything', 'rank_total DESC, seq')},
counts AS MATERIALIZED (
  SELECT d.brief_date, t.tier,
    (SELECT count(*) FROM pool p WHERE p.brief_date = d.brief_date) AS n_pool,
    (SELECT count(*) FROM everything e WHERE e.brief_date = d.brief_date) AS scored_count,
    (SELECT count(*) FROM items i WHERE i.brief_date = d.brief_date AND section = 'must_read') AS must_read_count,
    (SELECT count(*) FROM items i WHERE i.brief_date = d.brief_date AND section = 'ai_watch') AS ai_watch_count,
    (SELECT count(*) FROM items i WHERE i.brief_date = d.brief_date AND section = 'marketplace') AS marketplace_count,
    (SELECT count(*) FROM cands c WHERE c.brief_date = d.brief_date) AS candidate_article_count,
    (SELECT count(*) FROM live l WHERE l.brief_date = d.brief_date) AS live_article_count
  FROM dates d JOIN tiers t USING (brief_date)
),
needs AS MATERIALIZED (
  SELECT *, tier = 'empty' OR (tier <> 'none' AND must_read_count = 0 AND ai_watch_count = 0) AS needy FROM counts
),
written AS MATERIALIZED (
  SELECT brief_date FROM needs WHERE NOT needy OR brief_date = (SELECT min(brief_date) FROM needs)
),
failed AS MATERIALIZED (
  SELECT brief_date, count(*) AS n, string_agg(source_name, ',' ORDER BY num) AS names
  FROM (SELECT DISTINCT brief_date, source_name, num FROM art WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) GROUP BY 1
),
status AS MATERIALIZED (
  SELECT n.brief_date, 'brief_date=' || strftime(CASE WHEN n_pool + scored_count > 0 AND needy
      THEN coalesce((SELECT max(x.brief_date) FROM written x WHERE x.brief_date < n.brief_date), n.brief_date) ELSE n.brief_date END, '%Y-%m-%d') AS output_path,
    (SELECT count(*) FROM srcs)::INT AS source_count, (SELECT count(*) FROM srcs)::INT AS configured_source_count,
    0::INT AS skipped_source_count, live_article_count + coalesce(f.n, 0) AS fetched_article_count, candidate_article_count,
    CASE WHEN n_pool > 0 THEN n_pool ELSE scored_count END AS candidate_count, scored_count, must_read_count, ai_watch_count,
    marketplace_count, live_article_count, coalesce(f.names, '') AS failed_sources,
    needy AND EXISTS (SELECT 1 FROM written x WHERE x.brief_date < n.brief_date) AS preserved_existing,
    CASE WHEN needy AND EXISTS (SELECT 1 FROM written x WHERE x.brief_date < n.brief_date) THEN 'preserved'
      WHEN tier IN ('none', 'empty') THEN 'none' ELSE tier END AS fallback_mode
  FROM needs n LEFT JOIN failed f USING (brief_date)
)"""

FEEDS = """
feed_docs AS MATERIALIZED (
  SELECT *, doc_id // 12 AS feed, (doc_id // 12) % 3 AS kind, doc_id % 12 AS place,
    split_part(text, chr(10), 1) AS raw_title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS raw_summary
  FROM documents
),
feed_items AS MATERIALIZED (
  SELECT 'feed' || feed AS source_key, feed, place, CASE WHEN length(raw_summary) > 0 THEN 'https://news.example.org/?id=' || doc_id ELSE '' END AS url,
    {clean_title} AS title, {clean_summary} AS summary, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 61) AS published_at
  FROM (SELECT * FROM feed_docs WHERE kind < 2)
)"""


def _clean(text: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({text}, '<[^>]+>', ' ', 'g'), '[\s\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+', ' ', 'g'))"


FEEDS = FEEDS.format(clean_title=_clean("raw_title"), clean_summary=_clean("raw_summary"))
_FEED_SELECT = f"""
SELECT source_key, title, url, summary, {_STAMP.format('published_at')} AS published_at, {CATEGORY.format('feed')} AS category
FROM feed_items WHERE place < 8 AND title <> '' AND url <> ''"""

_URL_HEAD = "split_part(split_part(url, '#', 1), '?', 1)"
_URL_QUERY = "substr(split_part(url, '#', 1), length(split_part(split_part(url, '#', 1), '?', 1)) + 2)"
_URL_KEY = rf"""
regexp_extract(lower({_URL_HEAD}), '^[a-z]+://[^/]*') || regexp_replace(regexp_replace({_URL_HEAD}, '^[A-Za-z]+://[^/]*', ''), '/+$', '')
  || coalesce('?' || nullif(array_to_string(list_transform(list_filter(string_split({_URL_QUERY}, '&'),
       lambda p: p <> '' AND split_part(p, '=', 1) NOT IN ({_list(s.TRACKING_KEYS)[1:-1]}) AND NOT starts_with(p, 'utm_')),
     lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END), '&'), ''), '')"""

_ENTITIES = "replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"


def _document() -> str:
    def block(*parts: str) -> str:
        return " || chr(10) || chr(10) || ".join(parts)

    link = f"{_q(w.LABEL_LINK + '[')} || url || '](' || url || ')'"
    must = block(
        "'### ' || pos || '. ' || title", f"{_q(w.LABEL_WHAT)} || summary_short", f"{_q(w.LABEL_WHY)} || why_important",
        f"{_q(w.LABEL_TAKEAWAY)} || takeaway", f"{_q(w.LABEL_KEYWORDS)} || keyword_notes", link,
        f"{_q(w.LABEL_SOURCE)} || source_name || ' / ' || date_text", f"{_q(w.LABEL_PRIORITY)} || priority",
    )
    watch = block(
        "'### ' || source_name || ' / ' || title", f"{_q(w.LABEL_NEW)} || summary_short",
        _q(w.WATCH_PROBLEM), _q(w.WATCH_DESIGN), _q(w.WATCH_CHANCE), link,
    )
    market = block(
        "'### ' || title", f"{_q(w.LABEL_EVENT)} || summary_short", _q(w.MARKET_AUDIENCE),
        f"{_q(w.LABEL_STAGE)} || stages", f"{_q(w.LABEL_LESSON)} || takeaway", link,
    )

    def section(number: int, empty: str) -> str:
        return (
            f"coalesce((SELECT string_agg(block, chr(10) || chr(10) ORDER BY pos) FROM blocks b"
            f" WHERE b.brief_date = l.brief_date AND b.section_no = {number}), {_q(empty)})"
        )

    card = "CASE (datediff('day', DATE '1970-01-01', brief_date) + 719163) % 4 " + " ".join(
        "WHEN {} THEN {}".format(
            i,
            _q("\n\n".join(
                label + text for label, text in zip(
                    (w.LABEL_CONCEPT, w.LABEL_EXPLAIN, w.LABEL_SCENARIO, w.LABEL_RELATION, w.LABEL_ENGLISH), fields
                )
            )),
        )
        for i, fields in enumerate(w.LEARNING_CARDS)
    ) + " END"
    reading = (
        f"{_q(w.READING_HEAD)} || chr(10) || {_q(w.READING_RULE)} || coalesce((SELECT chr(10) || string_agg(reading_row, chr(10) ORDER BY cited_pos)"
        " FROM rows_ r WHERE r.brief_date = l.brief_date), '')"
    )
    hints = _q("\n".join([w.HINTS_LEAD, *[f"- {h}" for h in w.HINTS]]))
    text = block(
        "'# Daily Digest — ' || strftime(brief_date, '%Y-%m-%d')",
        _q(w.HEADING_SIGNAL), "one_line_signal",
        _q(w.HEADING_MUST_READ), section(0, w.EMPTY_MUST_READ),
        _q(w.HEADING_AI_WATCH), section(1, w.EMPTY_AI_WATCH),
        _q(w.HEADING_MARKETPLACE), section(2, w.EMPTY_MARKETPLACE),
        _q(w.HEADING_THINKING), "thinking_question", hints,
        _q(w.HEADING_CARD), card, _q(w.HEADING_READING), reading,
        _q(w.HEADING_TAGS), "array_to_string(tags, ' ')",
    )
    return f"""{MAIN}, {LABELS}, {LINES}, {RICH},
blocks AS MATERIALIZED (
  SELECT brief_date, section_no, pos, CASE section_no WHEN 0 THEN {must} WHEN 1 THEN {watch} ELSE {market} END AS block FROM rich
),
rows_ AS MATERIALIZED (
  SELECT c.brief_date, c.cited_pos, r.reading_row FROM cited c JOIN rich r
    ON r.brief_date = c.brief_date AND r.section_no = c.section_no AND r.pos = c.pos
)
SELECT {BD}, {text} || chr(10) AS document FROM lines l"""


def _breakdown(lexicon: s.Lexicon) -> str:
    return f"""WITH {ART}, {_scored('sc', 'art', lexicon)}
SELECT doc_id, impact, novelty, source_quality, pm_relevance, actionability, total, array_to_string(keywords, ',') AS keywords FROM sc"""


def _top(section: s.Section) -> str:
    return f"{MAIN} SELECT {BD}, pos::INT AS pos, doc_id, total FROM items WHERE section = {_q(section.name)}"


_LISTED = f"""SELECT *, row_number() OVER (ORDER BY num) - 1 AS place, {CATEGORY.format('num')} AS category FROM (
  SELECT DISTINCT source AS source_name, 'https://feeds.example.org/' || source AS source_url, regexp_extract(source, '(\\d+)$', 1)::INT AS num
  FROM documents)"""
_NEWEST = """newest_run AS MATERIALIZED (
  SELECT * FROM art WHERE (source_key, brief_date) IN (SELECT (source_key, max(brief_date)) FROM art GROUP BY source_key)
)"""
_CACHE_LIVE = f"WITH {ART}, {DATES}, {_cached('art')}"


def all_sql() -> dict[str, str]:
    return {
        "url_normalize": f"""WITH {ART} SELECT 'p' || page_id AS id, {_URL_KEY} AS link_key FROM pages
            UNION ALL SELECT 'd' || doc_id, link_key FROM art""",
        "title_normalize": f"WITH {ART} SELECT doc_id, title_key FROM art",
        "html_clean": f"SELECT page_id, {_clean(_ENTITIES)} AS text FROM pages",
        "feed_date_parse": f"""SELECT event_id, {_STAMP.format('''CASE event_id % 8
              WHEN 0 THEN t WHEN 1 THEN t - INTERVAL 330 MINUTE WHEN 2 THEN date_trunc('minute', t) + INTERVAL 5 HOUR
              WHEN 3 THEN t WHEN 4 THEN t + INTERVAL 8 HOUR WHEN 5 THEN t WHEN 6 THEN NULL ELSE t + INTERVAL 7 HOUR END''')} AS parsed
            FROM (SELECT event_id, date_trunc('second', ts) AS t FROM events)""",
        "recent_articles_only": f"WITH {ART}, {RECENT} SELECT {BD}, doc_id FROM recent",
        "score_breakdown": _breakdown(s.DEFAULT_LEXICON),
        "score_breakdown_custom": _breakdown(FRAGMENTS),
        "keyword_labels": f"""WITH {ART}, {_scored('sc', 'art', FRAGMENTS)}
            SELECT doc_id, (i - 1)::INT AS place, keywords[i] AS label FROM sc, range(1, 6) r(i) WHERE i <= len(keywords)""",
        "lexicon_hits": """WITH words AS (SELECT DISTINCT lower(p_name || ' ' || p_type || ' ' || p_brand) AS t FROM part),
            terms AS MATERIALIZED (SELECT DISTINCT n, substr(t, i, n) AS term FROM (SELECT t, n, unnest(range(1, length(t) - n + 2)) AS i FROM words, range(3, 6) r(n)))
            SELECT doc_id, 'runs of ' || n AS "group", count(*) AS hits FROM (SELECT doc_id, lower(text) AS text FROM documents) d
            JOIN terms ON contains(d.text, term) GROUP BY doc_id, n""",
        "marked_titles": f"WITH {ART}, {RECENT} SELECT {BD}, doc_id, title FROM recent WHERE doc_id % 13 <> 0",
        "catalogue_weights": f"""WITH {ART}, {_scored('sc', 'art', FRAGMENTS, s.Weights(0.4, 0.25, 0.2, 0.15, 0.3))} SELECT doc_id, total FROM sc
            WHERE published_at IS NULL OR published_at >= brief_date + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND - INTERVAL 2 DAY""",
        "skipped_by_date": f"""{STRICT_HEALTH}, days AS (SELECT DISTINCT checked_at::DATE AS d FROM hist),
            known AS (SELECT d, source_key, arg_max(status, seq) AS status, max(checked_at) FILTER (ok) AS ok_at FROM days
              JOIN hist ON checked_at <= d + INTERVAL 12 HOUR GROUP BY 1, 2)
            SELECT strftime(d, '%Y-%m-%d') AS brief_date, source_key FROM known WHERE status = 'unstable' AND NOT regexp_matches(source_key, '[05]$')
              AND (ok_at IS NULL OR ok_at < d + INTERVAL 12 HOUR - INTERVAL 3 DAY)""",
        "growth_stage": f"WITH {ART} SELECT doc_id, {STAGES} AS stages FROM (SELECT *, lower(title || ' ' || summary) AS st FROM art)",
        "either_key_dedupe": f"""WITH RECURSIVE pg AS MATERIALIZED (
            SELECT page_id AS seq, url, 0 AS one, {_URL_KEY} AS link_key, trim(regexp_replace(lower(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)),
              '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')) AS title_key FROM pages), {_dedupe('kept', 'pg', 'one')}
            SELECT pg.seq, pg.url FROM pg JOIN kept USING (seq)""",
        "either_key_dedupe_by_date": f"""WITH RECURSIVE {ART}, {_dedupe('kept', 'art')}
            SELECT {BD}, doc_id FROM art JOIN kept ON art.brief_date = kept.kd AND art.seq = kept.seq""",
        "ranked_articles": f"""WITH RECURSIVE {ART}, {RECENT}, {UNIQUE}
            SELECT {BD}, row_number() OVER (PARTITION BY uniq.brief_date ORDER BY total DESC, seq) AS rank, doc_id, total FROM uniq""",
        **{f"{x.name}_top3": _top(x) for x in s.SECTIONS},
        "cited_items": f"{MAIN} SELECT {BD}, cited_pos::INT AS cited_pos, section, doc_id FROM cited",
        "digest_tags": f"{MAIN}, {LABELS}, {LINES} SELECT {BD}, array_to_string(tags, ' ') AS tags FROM lines",
        "digest_signal": f"{MAIN}, {LABELS}, {LINES} SELECT {BD}, one_line_signal, thinking_question FROM lines",
        "learning_card": f"""WITH {ART}, {DATES} SELECT {BD},
            {_list(c[0] for c in w.LEARNING_CARDS)}[1 + (datediff('day', DATE '1970-01-01', brief_date) + 719163) % 4] AS concept FROM dates""",
        "item_enrichment": f"""{MAIN}, {RICH} SELECT {BD}, section, pos::INT AS pos, doc_id, priority, why_important, takeaway,
            keyword_notes, date_text, reading_row, summary_short, stages FROM rich""",
        "short_summaries": f"WITH {ART} SELECT doc_id, {SHORT} AS summary_short FROM art",
        "digest_document": _document(),
        "source_health_final": f"{HEALTH} {_HEALTH_SELECT}",
        "source_health_history": f"WITH {CHECKS}, {_health(False)} SELECT seq, source_key, CASE WHEN ok THEN 0 ELSE streak END::INT AS streak, status FROM hist",
        "outage_runs": f"WITH {CHECKS} SELECT * FROM flags WHERE is_outage OR is_discarded",
        "healthy_sources": f"""{STRICT_HEALTH} SELECT source_key, failure_policy FROM (
              SELECT *, CASE WHEN regexp_matches(source_key, '[05]$') THEN 'always_try' ELSE 'skip_when_unstable' END AS failure_policy FROM health)
            WHERE status <> 'unstable' OR failure_policy = 'always_try' OR ok_at >= TIMESTAMP '2024-02-01 12:00:00' - INTERVAL 3 DAY""",
        "validation_counts": f"""{STRICT_HEALTH} SELECT (SELECT count(*) FROM checks) AS checked, (SELECT count(*) FROM checks WHERE ok) AS healthy_now,
            (SELECT count(*) FROM checks WHERE NOT ok) AS failed_now, (SELECT count(*) FROM health WHERE status = 'unstable') AS unstable_total""",
        # The entry of a source is its newest run: what is young, and one row without an article for all that is not.
        "feed_cache_upsert": f"""WITH {ART}, {_NEWEST}, young AS (
              SELECT *, published_at IS NULL OR published_at >= brief_date + INTERVAL 8 HOUR - INTERVAL 7 DAY AS y FROM newest_run)
            SELECT DISTINCT source_key, {_STAMP.format("brief_date + INTERVAL 8 HOUR")} AS fetched_at, CASE WHEN y THEN doc_id END AS doc_id,
              CASE WHEN y THEN url END AS url, CASE WHEN y THEN {_STAMP.format('published_at')} END AS published_at FROM young""",
        "cached_articles": f"""{_CACHE_LIVE}, {SOURCES} SELECT {BD}, c.source_name, s.category, s.quality, url, title,
            {_STAMP.format('published_at')} AS published_at FROM cached c JOIN srcs s USING (source_name)""",
        # The catalogue lacks src0, whose lines keep what they say and get quality 4, and has src1 twice, the later with quality 1.
        "archive_fallback": f"""WITH {ART}, {DATES}, {_archive('dates')} SELECT {BD}, seq, title, url, source_name, category,
            CASE source_name WHEN 'src0' THEN 4 WHEN 'src1' THEN 1 ELSE quality END AS quality, total,
            array_to_string(keywords, ',') AS keywords, {_STAMP.format('published_at')} AS published_at FROM archived""",
        # Lines are numbered by digest date and rank in it; of the lines of a link the newest counts.
        "archive_roundtrip": f"""WITH {ART}, {DATES}, {_archive('dates')},
            numbered AS MATERIALIZED (
              SELECT x.* EXCLUDE (seq), datediff('day', DATE '1970-01-01', x.brief_date) AS day,
                row_number() OVER (PARTITION BY x.brief_date ORDER BY x.total DESC, o.seq) - 1 AS place, x.title <> '' AS usable
              FROM (SELECT * EXCLUDE (keywords), list_filter([{_ARCHIVE_LABELS}], lambda x: x IS NOT NULL)[1:5] AS keywords
                    FROM (SELECT *, lower(title || '  ' || source_name || ' ' || category) AS t FROM asc_)) x JOIN art o USING (doc_id)
            ),
            tails AS (
              SELECT d.brief_date AS asked, x.url, arg_max(x.doc_id, (x.day, x.place)) AS doc_id, max((x.day, x.place)) AS line
              FROM dates d JOIN numbered x ON usable AND (x.published_at IS NULL OR x.published_at >= d.brief_date - INTERVAL 7 DAY) GROUP BY 1, 2
            ),
            hits AS (SELECT asked, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY line DESC) AS n FROM tails) WHERE n <= 24)
            SELECT strftime(h.asked, '%Y-%m-%d') AS brief_date, (3::BIGINT << 60) + (day::BIGINT << 40) + place AS seq, title, url, source_name,
              category, quality, total, array_to_string(keywords, ',') AS keywords, {_STAMP.format('published_at')} AS published_at
            FROM hits h JOIN numbered x USING (doc_id)""",
        "fallback_tier": f"{RUN} SELECT {BD}, tier FROM tiers",
        "run_status": f"{RUN} SELECT {_DAY.format('brief_date')}, * EXCLUDE (brief_date) FROM status",
        "quality_gate": f"""{RUN} SELECT {BD}, len(r) = 0 AS sufficient, array_to_string(r, ',') AS reasons FROM (
            SELECT brief_date, list_filter([CASE WHEN preserved_existing THEN 'preserved' END,
              CASE WHEN candidate_count < 20 THEN 'candidates' END,
              CASE WHEN candidate_article_count + live_article_count < 20 THEN 'fresh_articles' END,
              CASE WHEN must_read_count < 2 THEN 'must_reads' END, CASE WHEN ai_watch_count < 2 THEN 'ai_watch' END,
              CASE WHEN marketplace_count < 2 THEN 'marketplace' END], lambda x: x IS NOT NULL) AS r FROM status)""",
        "candidate_quota": f"""WITH {ART} SELECT {BD}, n_items, n_ai, n_marketplace, n_china, n_unknown_category,
              n_items BETWEEN 14 AND 45 AND n_ai >= 8 AND n_marketplace >= 2 AND n_china >= 3 AND n_unknown_category = 0 AS meets_quota
            FROM (SELECT brief_date, count(*) AS n_items, count(*) FILTER (category = 'Other') AS n_unknown_category, count(*) FILTER (category IN ('AI Frontier', 'AI Product Video')) AS n_ai,
              count(*) FILTER (category = 'E-commerce & Marketplace') AS n_marketplace,
              count(*) FILTER (category = 'China Tech & Retail') AS n_china
              FROM (SELECT * REPLACE (CASE source_name WHEN 'src13' THEN 'Other' ELSE category END AS category) FROM art)
              WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY 1)""",
        "digest_archive_rows": f"""{RUN} SELECT (datediff('day', DATE '1970-01-01', e.brief_date)::BIGINT << 36)
              + row_number() OVER (PARTITION BY e.brief_date ORDER BY rank_total DESC, seq) - 1 AS line_no,
            strftime(e.brief_date, '%Y-%m-%d') AS date, title, url, source_name AS source, category, total AS score,
            strftime(published_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS published_at
            FROM everything e JOIN status s ON s.brief_date = e.brief_date AND NOT s.preserved_existing""",
        "prior_digest_asof": f"""WITH {ART}, {DATES} SELECT {BD},
            strftime((SELECT max(a.brief_date) FROM art a WHERE a.brief_date < dates.brief_date), '%Y-%m-%d') AS prior_date FROM dates""",
        "pending_digest_dates": f"WITH {ART}, {DATES} SELECT {BD} FROM dates WHERE brief_date NOT IN (SELECT brief_date FROM art)",
        "feed_parse": f"WITH {FEEDS} {_FEED_SELECT}",
        "source_probe": f"""WITH {FEEDS}, firsts AS (SELECT DISTINCT feed, kind FROM feed_docs)
            SELECT 'feed' || feed AS source_key, n > 0 AS ok, n::INT AS article_count,
              CASE WHEN n > 0 THEN '' WHEN kind = 2 THEN 'ParseError: not well-formed' ELSE 'no articles returned' END AS error
            FROM (SELECT f.feed, f.kind, (SELECT count(*) FROM feed_items i WHERE i.feed = f.feed AND place = 0 AND title <> '' AND url <> '') AS n FROM firsts f)
            UNION ALL SELECT DISTINCT source || '|https://feeds.example.org/' || source, false, 0, 'nothing arrived' FROM documents""",
        "stream_ingest": f"WITH {FEEDS} {_FEED_SELECT}",
        "stream_health": f"{HEALTH} {_HEALTH_SELECT}",
        "stream_cache": f"""WITH {ART}, {_NEWEST} SELECT source_key, doc_id, {_STAMP.format('published_at')} AS published_at FROM newest_run
            WHERE published_at IS NULL OR published_at >= brief_date + INTERVAL 8 HOUR - INTERVAL 7 DAY""",
        "stream_daily_counts": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
        "stream_dedupe": f"""WITH {ART} SELECT link_key, arg_min(url, doc_id % 3) AS url, {_STAMP.format('arg_min(moment, doc_id % 3)')} AS event_time
            FROM (SELECT *, coalesce(published_at, brief_date + INTERVAL 8 HOUR) AS moment FROM art) GROUP BY link_key""",
        "stream_late": """WITH ev AS (
              SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN ts END AS t,
                CASE WHEN event_id % 10 = 0 THEN 2 ELSE least(2, greatest(0, datediff('day', DATE '2024-01-01', ts::DATE)) // 10) END AS part
              FROM events),
            edges AS (SELECT p.part, (SELECT max(t) FROM ev WHERE ev.part < p.part) - INTERVAL 3 DAY AS edge FROM (SELECT DISTINCT part FROM ev) p)
            SELECT event_id, CASE WHEN t IS NULL THEN 'no time' WHEN t < edge THEN 'late' ELSE 'accepted' END AS fate FROM ev JOIN edges USING (part)""",
        "chained_dedupe": f"""WITH RECURSIVE rows_ AS MATERIALIZED (
              SELECT c_custkey::BIGINT AS seq, 0 AS one, 'l' || (c_custkey + 1) // 2 AS link_key,
                CASE WHEN c_custkey % 397 <> 0 THEN 't' || c_custkey // 2 ELSE '' END AS title_key FROM customer),
            {_dedupe('kept', 'rows_', 'one')} SELECT seq FROM kept""",
        "unknown_category_items": f"""WITH {ART} SELECT {BD}, doc_id, 'Other' AS category FROM art
            WHERE source_name = 'src13' AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
        "local_days": "SELECT strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
        "catalogue_scan": f"""SELECT source_name || '|' || source_url AS source_key, place::INT AS source_pos, source_name, source_url, category,
              CASE WHEN num % 3 <> 0 THEN 3 + num % 3 ELSE 3 END AS quality, CASE WHEN num % 4 = 1 THEN 'zh' ELSE 'en' END AS language,
              CASE WHEN num % 5 = 0 THEN 1 ELSE 2 END AS tier,
              CASE WHEN num % 4 = 0 THEN 'always_try' ELSE 'skip_when_unstable' END AS failure_policy
            FROM ({_LISTED}) WHERE num % 7 <> 3""",
        "manual_list": f"SELECT source_name AS name, source_url AS url, category, 'en' AS language, 'by hand' AS reason FROM ({_LISTED})",
        "candidate_scan": f"""WITH {ART} SELECT {BD}, title, url, CASE WHEN doc_id % 7 <> 0 THEN summary ELSE '' END AS summary,
              source_name || '|' || CASE WHEN doc_id % 2 = 0 THEN 'https://feeds.example.org/' || source_name ELSE url END AS source_key,
              CASE WHEN doc_id % 3 = 0 THEN quality ELSE 4 END AS quality, CASE WHEN doc_id % 5 = 0 THEN lang ELSE 'en' END AS language,
              {_STAMP.format('published_at')} AS published_at
            FROM art WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
        "status_sink": f"""WITH {ART} SELECT {BD}, count(*) AS n, max(doc_id) AS last, CASE WHEN day(brief_date) % 2 = 0 THEN 2 ELSE 1 END::INT AS run
            FROM art GROUP BY art.brief_date""",
        "digest_latest": f"SELECT * FROM ({_document()}) ORDER BY brief_date DESC LIMIT 1",
    }
