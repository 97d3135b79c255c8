"""DuckDB counterparts of the queries that SQL can express."""

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP4 = rf"""
WITH rows AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size, md5('7:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS weight
  FROM rows GROUP BY source
),
levels AS (
  SELECT *, 2 * source_size / weight::DOUBLE AS full_at,
         (sum(source_size) OVER () * 1.5::DOUBLE
           - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM totals
),
targets AS (
  SELECT source, source_size,
         coalesce(least((2 * source_size)::DOUBLE,
                        (SELECT arg_min(level, full_at) FROM levels WHERE level <= full_at) * weight),
                  (2 * source_size)::DOUBLE) AS target
  FROM levels
),
placed AS (
  SELECT r.doc_id, r.size, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size
                 + greatest(0, least(size, budget - (budget // source_size) * source_size - before)) END::BIGINT AS taken
FROM placed
"""

# Gaps and matches of one pattern give the places of the matches.
def _spans(kind: str, rank: int, pattern: str) -> str:
    return rf"""
  SELECT id, '{kind}' AS kind, {rank} AS rank, m AS match,
         list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT id, unnest(found) AS m, generate_subscripts(found, 1) AS i, found, gaps
        FROM (SELECT id, regexp_extract_all(text, '{pattern}') AS found, regexp_split_to_array(text, '{pattern}') AS gaps FROM texts))"""


_ANY = "".join
_LETTERS = lambda word: _ANY(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
_NAMES = "|".join([*map(_LETTERS, ("password", "passwd", "secret", "token")), "[aA][pP][iI]_?[kK][eE][yY]"])
_ASSIGN = rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

OP2 = rf"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner,
                      coalesce(source, '') || '/' || coalesce(lang, '') AS repository FROM documents),
assigned AS ({_spans('assign', 0, _ASSIGN)}),
base AS (
  SELECT id, kind, rank, start::BIGINT AS start, (start + length(match))::BIGINT AS stop,
         regexp_extract(match, '{_ASSIGN}', 2) AS value
  FROM assigned WHERE length(regexp_extract(match, '{_ASSIGN}', 2)) >= 8
  UNION ALL SELECT id, kind, rank, start::BIGINT, (start + length(match))::BIGINT, match
  FROM ({_spans('access', 1, 'AKIA[A-Z0-9]+')}) WHERE length(match) >= 16
  UNION ALL SELECT id, kind, rank, start::BIGINT, (start + length(match))::BIGINT, match
  FROM ({_spans('hex', 2, '[0-9a-f]+')}) WHERE length(match) >= 32
),
tokens AS (
  SELECT id, start::BIGINT AS start, (start + length(match))::BIGINT AS stop, match AS value
  FROM ({_spans('token', 3, '[A-Za-z0-9+/_=-]+')}) WHERE length(match) >= 20 AND regexp_matches(match, '[0-9]')
),
candidates AS (SELECT DISTINCT id, stop - length(value) AS start, stop, value FROM (SELECT id, stop, value FROM base UNION ALL SELECT id, stop, value FROM tokens)),
frequency AS (
  SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT repository) AS repositories FROM candidates JOIN texts USING (id) GROUP BY value
),
signs AS (
  SELECT value, -sum(n * 1.0 / total * log2(n * 1.0 / total)) AS bits
  FROM (SELECT value, sign, count(*) AS n, length(value) AS total
        FROM (SELECT value, unnest(string_split(value, '')) AS sign FROM frequency) GROUP BY value, sign)
  GROUP BY value
),
judged AS (
  SELECT c.id, c.start, c.stop, f.owners, f.repositories, f.owners >= 2 OR f.repositories >= 3 AS copied,
         f.owners <= 1 AND f.repositories <= 2 AND s.bits >= 2.5 AND regexp_matches(c.value, '[0-9]') AND regexp_matches(c.value, '[A-Za-z]')
         AND NOT regexp_matches(lower(c.value), 'example|sample|dummy|changeme|your|placeholder|x{{6,}}|0{{8,}}|1234567|abcdef') AS live
  FROM candidates c JOIN frequency f USING (value) JOIN signs s USING (value)
),
verdicts AS (
  SELECT id, count(*) FILTER (WHERE live) AS n_live, count(*) FILTER (WHERE copied) AS n_copied, max(owners) AS max_owners,
         max(repositories) AS max_repositories
  FROM judged GROUP BY id
),
listed AS (
  SELECT id, start, rank, kind, stop FROM base UNION ALL SELECT id, start, 3, 'live', stop FROM judged WHERE live
),
spans AS (
  SELECT id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (WHERE rank < 3) AS base
  FROM listed GROUP BY id
)
SELECT t.doc_id, coalesce(s.n_assign, 0)::BIGINT AS n_assign, coalesce(s.n_access, 0)::BIGINT AS n_access, coalesce(s.n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(s.base, '')) AS base_sha256, coalesce(s.spans, '') AS spans, coalesce(v.n_live, 0)::BIGINT AS n_live,
       coalesce(v.n_copied, 0)::BIGINT AS n_copied, coalesce(v.max_owners, 0)::BIGINT AS max_owners,
       coalesce(v.max_repositories, 0)::BIGINT AS max_repositories
FROM texts t LEFT JOIN spans s USING (id) LEFT JOIN verdicts v USING (id)
"""


OP12 = """
WITH kept AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM kept WHERE vec_id % 100 = 0) a, kept b
),
positives AS (
  SELECT *, row_number() OVER (PARTITION BY anchor_id, own ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE label = own AND vec_id <> anchor_id
),
negatives AS (
  SELECT p.anchor_id, p.own, p.place, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.own, p.place ORDER BY n.score DESC, n.vec_id)::INT AS rank
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.own = p.own AND n.label <> p.own
   AND 80 * p.score <= 100 * n.score AND n.score <= p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 5
"""


def llm_sql() -> dict[str, str]:
    return {"op2_secrets": OP2, "op4_mixing": OP4, "op12_hard_negatives": OP12}
