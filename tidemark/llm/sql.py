"""DuckDB SQL of the queries that SQL can express, for comparison on small tables."""

#: The words of a text (null: none), unchanged.
_WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: component_id of each id from links (a, b) in both directions, by the smallest id that is reached.
_REACHED = """reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
  least AS (SELECT a, min(b) AS b FROM reached GROUP BY a)"""

OP5 = rf"""WITH w AS (SELECT doc_id, {_WORDS.format(text="text")} AS words FROM documents),
  one AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM w),
  win AS (SELECT doc_id, word, i, n, CASE WHEN i + 49 <= n THEN md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) END AS h FROM one),
  first AS (SELECT h, min(doc_id) AS first_doc FROM win WHERE h IS NOT NULL GROUP BY h),
  late AS (SELECT win.doc_id, word, i, coalesce(first_doc < win.doc_id, false) AS starts FROM win LEFT JOIN first ON win.h = first.h),
  gone AS (SELECT doc_id, word, i, max(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM late),
  kept AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

OP8 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
  links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
  {_REACHED},
  n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id, vec_id <= coalesce(b, vec_id) AS kept FROM embeddings e LEFT JOIN n ON n.a = vec_id LEFT JOIN least l ON l.a = vec_id"""

OP10 = rf"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
  one AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM w),
  runs AS (SELECT doc_id, n, i, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) AS h FROM one),
  s AS (SELECT DISTINCT doc_id, h FROM runs WHERE i + 3 <= n OR (n < 4 AND i = 1)),
  size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
  pairs AS (SELECT a, b FROM met JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
  links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
  {_REACHED}
SELECT w.doc_id, coalesce(size.n, 0) AS n_shingles, least(w.doc_id, coalesce(b, w.doc_id)) AS component_id FROM w LEFT JOIN size USING (doc_id) LEFT JOIN least l ON l.a = w.doc_id"""

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SMALL = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
  l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM s),
  k AS (SELECT *, {_SMALL.format(x=f"trim(line, {_BLANK})")} AS key FROM l),
  held AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key),
  g AS (SELECT k.*, coalesce(first_doc < doc_id, false) AS gone FROM k LEFT JOIN held USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM g GROUP BY doc_id"""

OP12 = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
  p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same),
  n AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score WHERE r <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""

# a checksum's eight steps for a byte, from a list of bytes
_BITS = "list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT)), lambda h, c: list_transform([xor(h, c)], lambda x: {_BITS})[1]), 4294967295)"


def _add(letter: str, cost: str, z: str) -> str:
    """A cost of nine digits and the edits that follow, with an edit before them."""
    return f"(lpad(CAST(CAST(({z})[1:9] AS BIGINT) + {cost} AS VARCHAR), 9, '0') || '{letter}' || ({z})[10:])"


def _row_step(s: int) -> str:
    """The cheapest of delete, keep and rerole of row r from a state (1 to 4: nothing yet, s, u, a)."""
    keep = {1: "CASE r.role WHEN 's' THEN 2 WHEN 'u' THEN 3 END", 2: "CASE r.role WHEN 'u' THEN 3 END", 3: "CASE r.role WHEN 'a' THEN 4 END", 4: "CASE r.role WHEN 'u' THEN 3 END"}[s]
    other, more = f"z[{4 if s == 3 else 3}]", "CASE WHEN r.fault = 't' THEN 3 ELSE 0 END"
    free = "r.fault NOT IN ('b', 'd')"
    return f"least({_add('D', '4', f'z[{s}]')}, CASE WHEN {free} AND ({keep}) IS NOT NULL THEN {_add('K', more, f'z[{keep}]')} END, CASE WHEN {free} THEN {_add('R', f'3 + {more}', other)} END)"


_INSERT = [f"least(w[{s}], {_add('I', '3', f'w[{t}]')}, {_add('I', '6', f'w[{u}]').replace(chr(39) + 'I' + chr(39), chr(39) + 'II' + chr(39))})" for s, t, u in ((1, 3, 4), (2, 3, 4), (3, 4, 3), (4, 3, 4))]
_STATE = "CASE WHEN state = 3 THEN 4 ELSE 3 END"

OP13 = f"""WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
  c AS (SELECT *, {_CRC} % 20 AS kind FROM k),
  d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM c WHERE kind <> 0),
  o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS initial, rtrim(text, {_BLANK}) AS cut FROM d),
  f AS (SELECT *, CASE WHEN cut = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN cut[-1] NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    i > 1 AND (lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial) NOT IN ('su', 'ua', 'au') AS odd FROM o),
  n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (odd) AS illegal,
    list({{'role': initial, 'fault': fault, 'full': role, 'text': text}} ORDER BY i) AS rs FROM f GROUP BY conv_id),
  b AS (SELECT conv_id, rs, len(rs) AS i, ['000000000', '000000006II', '000000003I', '000000000'] AS z FROM n
    UNION ALL SELECT conv_id, rs, i - 1, list_transform([list_transform([rs[i]], lambda r: [{', '.join(_row_step(s) for s in (1, 2, 3, 4))}])[1]], lambda w: [{', '.join(_INSERT)}])[1] FROM b WHERE i > 0),
  e AS (SELECT conv_id, CAST(z[1][1:9] AS BIGINT) AS cost, z[1][10:] AS audit FROM b WHERE i = 0),
  p AS (SELECT conv_id, rs, audit, 0 AS k, 0 AS i, 1 AS state, CAST([] AS VARCHAR[]) AS kept FROM n JOIN e USING (conv_id)
    UNION ALL SELECT conv_id, rs, audit, k + 1, CASE WHEN audit[k + 1] = 'I' THEN i ELSE i + 1 END,
      CASE audit[k + 1] WHEN 'D' THEN state WHEN 'K' THEN CASE rs[i + 1].role WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END ELSE {_STATE} END,
      CASE audit[k + 1] WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, rs[i + 1].full || ':' || rs[i + 1].text) ELSE list_append(kept, CASE WHEN state = 3 THEN 'assistant:' ELSE 'user:' END || CASE WHEN audit[k + 1] = 'R' THEN rs[i + 1].text ELSE '' END) END
    FROM p WHERE k < length(audit)),
  r AS (SELECT conv_id, array_to_string(kept, chr(10)) AS kept FROM p WHERE k = length(audit))
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(kept, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n USING (conv_id) LEFT JOIN e USING (conv_id) LEFT JOIN r USING (conv_id)"""

SQL = {"op5_substring_dedup": OP5, "op8_embedding_dedup": OP8, "op10_ngram_jaccard_join": OP10, "op11_line_dedup": OP11, "op12_hard_negatives": OP12, "op13_turn_repair": OP13}
