"""SQL of the phrase collocations: every phrase formed and counted for itself."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def collocations_sql(least: int = 100, share: int = 100, first: int = 2_000) -> str:
    return rf"""
WITH plain AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text FROM documents
),
split AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM plain),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM split),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
phrases AS (SELECT lang, w[i : i + m - 1] AS p FROM starts, range(1, 6) AS sizes(m) WHERE i + m - 1 <= len(w)),
counts AS (SELECT lang, p, count(*) AS f FROM phrases GROUP BY lang, p),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE len(p) = 1 GROUP BY lang),
candidates AS (SELECT lang, p, f AS a FROM counts WHERE len(p) >= 2 AND f >= {least}),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM candidates),
scores AS (
  SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.p = c.p[1 : c.k]
    JOIN counts y ON y.lang = c.lang AND y.p = c.p[c.k + 1 : len(c.p)]
    JOIN totals t ON t.lang = c.lang
),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
),
inside AS (SELECT lang, p, a, unnest(range(1, len(p))) AS i FROM candidates),
contained AS (
  SELECT lang, p[i : i + m - 1] AS p, max(a) AS longer FROM inside, range(2, 5) AS sizes(m)
  WHERE m < len(p) AND i + m - 1 <= len(p) GROUP BY ALL
),
kept AS (
  SELECT l.* FROM lowest l LEFT JOIN contained c ON c.lang = l.lang AND c.p = l.p
  WHERE c.longer IS NULL OR 100 * c.longer < {share} * l.a
),
shown AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM kept)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
  phrase, a, l, r, n, score
FROM shown QUALIFY rank <= {first}
"""
