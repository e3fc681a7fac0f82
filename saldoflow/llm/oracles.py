"""The same questions in DuckDB SQL, for the operators that SQL can express."""

MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(trunc(sqrt(size) * size)::BIGINT)::BIGINT AS spread,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sizes GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight FROM per),
remaining AS (
  SELECT *,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))::DOUBLE AS words_left,
    sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
flagged AS (SELECT *, words_left * weight >= 3 * source_size * weight_left AS capped FROM remaining),
goals AS (
  SELECT source, source_size, spread,
    CASE WHEN capped THEN 3.0::DOUBLE * source_size
         ELSE weight * first_value(words_left / weight_left) OVER (
           ORDER BY capped, source_size / weight, source NULLS LAST) END AS target
  FROM flagged),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3)::BIGINT ELSE 3 END AS whole
  FROM goals),
rested AS (SELECT *, target - whole * source_size AS rest FROM split),
drawn AS (
  SELECT s.*, r.source_size, r.target, r.whole, r.rest,
    least(r.rest / nullif(r.spread, 0) * sqrt(s.size), 0.999999) AS p,
    (('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5)
      / 281474976710656.0 AS u
  FROM sizes s JOIN rested r ON s.source IS NOT DISTINCT FROM r.source),
placed AS (
  SELECT *, CASE WHEN size > 0 AND rest > 0
                 THEN (u / (1 - u)) / (p / (1 - p)) / (1 + (u / (1 - u)) / (p / (1 - p))) END AS place
  FROM drawn),
running AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY place) AS after FROM placed WHERE place IS NOT NULL),
cuts AS (
  SELECT source, -1.0::DOUBLE AS place, -max(rest) AS over FROM running GROUP BY source
  UNION ALL SELECT source, place, after - rest FROM running),
ends AS (
  SELECT source, arg_min(place, (abs(over), place)) AS last_place, arg_min(over, (abs(over), place)) AS over
  FROM cuts GROUP BY source),
fits AS (
  SELECT r.source, r.place, r.doc_id, CASE WHEN r.place <= e.last_place THEN -1 ELSE 1 END AS sign,
    abs(e.over + CASE WHEN r.place <= e.last_place THEN -1 ELSE 1 END * r.size) AS miss, abs(e.over) AS now
  FROM running r JOIN ends e ON r.source IS NOT DISTINCT FROM e.source),
extra AS (
  SELECT source, arg_min(place, (miss, place, doc_id)) AS extra_place,
         arg_min(doc_id, (miss, place, doc_id)) AS extra_id, arg_min(sign, (miss, place, doc_id)) AS extra
  FROM fits WHERE miss < now GROUP BY source),
counted AS (
  SELECT p.doc_id, p.source, p.size, p.source_size, p.target,
    p.whole + CASE WHEN p.place <= e.last_place THEN 1 ELSE 0 END
      + CASE WHEN p.place = x.extra_place AND p.doc_id IS NOT DISTINCT FROM x.extra_id THEN x.extra ELSE 0 END
      AS copies
  FROM placed p LEFT JOIN ends e ON p.source IS NOT DISTINCT FROM e.source
  LEFT JOIN extra x ON p.source IS NOT DISTINCT FROM x.source)
SELECT doc_id, source, size, source_size, target, copies::BIGINT AS copies, (copies * size)::BIGINT AS taken
FROM counted
"""

COVER_TREE = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id != b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION
  SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = r.vec_id)::BIGINT AS n_links,
       min(other) AS component_id, min(other) = vec_id AS kept
FROM reach r GROUP BY vec_id
"""

#: Turns digested straight from the table; formatted length from the default template's
#: markers (system 29 characters, assistant 6, user 18 or 8 after a system turn) plus the
#: escaped text: one more character per backslash and per control string.
CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), keyed AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN 'row-' || CAST(row_number() OVER () AS VARCHAR)
                 ELSE CAST(conv_id AS VARCHAR) END AS k FROM given
), t AS (
  SELECT *, lag(role) OVER (PARTITION BY k ORDER BY turn NULLS LAST, role, text) AS before,
         length(text) + (length(text) - length(replace(text, '\', '')))
           + len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|\[/INST\]|\[INST\]|</s>|<s>')) AS escaped
  FROM keyed
)
SELECT any_value(conv_id) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(escaped + CASE WHEN role = 'system' THEN 29 WHEN role = 'assistant' THEN 6
                               WHEN before = 'system' THEN 8 ELSE 18 END) AS BIGINT) AS formatted_chars,
       false AS rewrites_history
FROM t GROUP BY k
"""

#: Counts by phrase text: words hold no space or tab, so space-joined phrases are keys.
COLLOCATIONS = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM d)
), occ AS (
  SELECT lang, ws, len(ws) AS m, unnest(range(1, len(ws) + 1)) AS i FROM p
), grams AS (
  SELECT lang, 1 AS o, ws[i] AS ph FROM occ
  UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1] FROM occ WHERE i + 1 <= m
  UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM occ WHERE i + 2 <= m
), f AS (
  SELECT lang, o, ph, count(*) AS c FROM grams GROUP BY lang, o, ph
), tot AS (
  SELECT lang, sum(c) AS n FROM f WHERE o = 1 GROUP BY lang
), cand AS (
  SELECT lang, o, ph, c AS a, string_split(ph, ' ') AS w FROM f WHERE o >= 2 AND c >= 10
), cuts AS (
  SELECT lang, o, ph, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM cand, range(1, 3) AS ks(k) WHERE k < o
), scored AS (
  SELECT cu.lang, cu.ph, cu.a, cu.k, fl.c AS l, fr.c AS r,
         (1000000::HUGEINT * cu.a * cu.a) // (fl.c::HUGEINT * fr.c) AS score
  FROM cuts cu JOIN f fl ON fl.lang = cu.lang AND fl.ph = cu.lp JOIN f fr ON fr.lang = cu.lang AND fr.ph = cu.rp
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1
), longer AS (
  SELECT lang, w[1] || ' ' || w[2] AS sub, a AS big FROM cand WHERE o = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE o = 3
), kept AS (
  SELECT b.* FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM longer g WHERE g.lang = b.lang AND g.sub = b.ph AND 100 * g.big >= 50 * b.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT k.lang, CAST(row_number() OVER (PARTITION BY k.lang ORDER BY k.score DESC, k.a DESC, k.ph) AS BIGINT) AS rank,
         k.ph AS phrase, CAST(k.a AS BIGINT) AS a, CAST(k.l AS BIGINT) AS l, CAST(k.r AS BIGINT) AS r,
         CAST(t.n AS BIGINT) AS n, CAST(k.score AS BIGINT) AS score
  FROM kept k JOIN tot t USING (lang)
) WHERE rank <= 2000
"""
