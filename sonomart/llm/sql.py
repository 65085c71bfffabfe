"""SQL twins of the training-data queries, for DuckDB over the same tables."""

MIXING = r"""
WITH rows_ AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows_ GROUP BY source),
ranked AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sizes),
placed AS (
  SELECT *, 3 * source_size AS cap,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER f, 0) AS BIGINT) AS rest,
    CAST(sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS BIGINT) AS weights_rest
  FROM ranked
  WINDOW f AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
open_ AS (
  SELECT rest, weights_rest FROM placed WHERE rest * weight < cap * weights_rest
  ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size,
    CASE WHEN rest * weight >= cap * weights_rest THEN CAST(cap AS DOUBLE)
         ELSE CAST((SELECT rest FROM open_) AS DOUBLE) * weight / (SELECT weights_rest FROM open_) END AS target
  FROM placed),
ordered AS (
  SELECT r.doc_id, r.size, t.source_size, t.target,
    coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id, r.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_
  FROM rows_ r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM ordered)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - before_)) AS BIGINT) AS taken
FROM cut"""


def licenses(templates, threshold, block_words) -> str:
    """Every block that begins at a template token against that template, without further filters."""
    values = ", ".join(f"({k}, '{label}', {sorted(set(w.split()))!r})" for k, (label, w) in enumerate(templates))
    return rf"""
WITH templates(k, label, tokens) AS (VALUES {values}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
places AS (
  SELECT r, i,
    CASE WHEN words[i + 1] = 'cc' AND words[i + 2] = 'by' THEN 'cc-by'
         WHEN words[i + 1] = 'general' AND words[i + 2] = 'public' AND words[i + 3] = 'license' THEN 'gpl'
         WHEN words[i + 1] = 'all' AND words[i + 2] = 'rights' AND words[i + 3] = 'reserved' THEN 'reserved' END AS label
  FROM (SELECT r, words, unnest(range(len(words))) AS i FROM docs)),
base AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM places WHERE label IS NOT NULL GROUP BY r),
blocks AS (
  SELECT r, words[b] AS first, words[b : b + {block_words - 1}] AS block FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS b FROM docs)),
opened AS (SELECT k, label, tokens, unnest(tokens) AS first FROM templates),
met AS (
  SELECT r, label, len(list_intersect(tokens, block)) / len(tokens) AS share
  FROM blocks JOIN opened USING (first) WHERE len(list_intersect(tokens, block)) >= ceil({threshold} * len(tokens) - 1e-9)),
found AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS score FROM met GROUP BY r)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
  CASE WHEN b.n_base > 0 THEN 1.0 ELSE coalesce(f.score, 0.0) END::DOUBLE AS score
FROM docs d LEFT JOIN base b USING (r) LEFT JOIN found f USING (r)"""


def decontamination(overlap_words, equal_share) -> str:
    """All diagonals of equal words, without seeds: those with a window of enough equal words count."""
    split = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
    return rf"""
WITH items AS (SELECT row_number() OVER () AS k, * FROM (SELECT DISTINCT item_id, {split} AS words FROM benchmark)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {split} AS words FROM documents),
item_at AS (SELECT k, unnest(words) AS word, unnest(range(len(words))) AS spot FROM items),
doc_at AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS place FROM docs),
equal_ AS (SELECT r, k, place - spot AS diagonal, spot FROM doc_at JOIN item_at USING (word)),
likely AS (
  SELECT r, k, diagonal FROM equal_ JOIN items USING (k)
  GROUP BY r, k, diagonal HAVING count(*) >= ceil(least({overlap_words}, max(len(words))) * {equal_share})),
windows AS (
  SELECT r, k, diagonal, count(*) OVER (PARTITION BY r, k, diagonal ORDER BY spot RANGE BETWEEN {overlap_words - 1} PRECEDING AND CURRENT ROW) AS inside
  FROM equal_ JOIN likely USING (r, k, diagonal)),
verified AS (
  SELECT r, k, diagonal, count(*) AS matched FROM windows JOIN items USING (k) GROUP BY r, k, diagonal
  HAVING max(inside) >= ceil(least({overlap_words}, max(len(words))) * {equal_share}))
SELECT d.doc_id, i.item_id, CAST(max(v.matched) AS BIGINT) AS matched, CAST(max(len(i.words)) AS BIGINT) AS item_words
FROM verified v JOIN docs d USING (r) JOIN items i USING (k) GROUP BY d.doc_id, i.item_id"""


TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f"""


NEARDUP = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT r.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id,
  r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN sizes s USING (doc_id) GROUP BY r.doc_id"""


CHAT = """
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
e AS (SELECT *, sha256(text) AS digest, length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|'))
  + length(replace(replace(role, '\\', '\\\\'), '<|', '<\\|')) AS shown FROM m)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, digest)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, digest), '')) AS loss_sha256,
  CAST(sum(shown + length('<|im_start|>') + 1 + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


FILTERS = r"""
WITH l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
     regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first, false)] AS fails
  FROM d LEFT JOIN l USING (doc_id)),
x AS (SELECT unnest(range(1, 6)) AS i),
orders AS (
  SELECT [a.i, b.i, c.i, e.i, g.i] AS o FROM x a, x b, x c, x e, x g WHERE len(list_distinct([a.i, b.i, c.i, e.i, g.i])) = 5),
steps AS (
  SELECT list_reduce(list_transform(o, lambda k: substr('ABCDE', k, 1)), lambda p, q: p || q) AS filter_order, o, i AS step FROM orders, x),
seen AS (
  SELECT part, filter_order, step, o[step] AS k, good, toxic, fails[o[step]] AS failing,
    len(list_filter(o[1 : step - 1], lambda j: fails[j])) > 0 AS gone,
    len(list_filter(fails, lambda b: b)) AS n
  FROM f, steps),
counted AS (
  SELECT part, filter_order, step, k, count(*) FILTER (NOT failing AND NOT gone) AS kept, count(*) FILTER (failing AND NOT gone) AS removed,
    count(*) FILTER (failing AND gone) AS redundant, count(*) FILTER (failing AND n = 1) AS unique_fails,
    count(*) FILTER (failing AND NOT gone AND good) AS good_lost, count(*) FILTER (failing AND NOT gone AND toxic) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, k)
SELECT part, filter_order, CAST(step AS INT) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM counted"""


SUBSTRINGS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT r, doc_id, i, array_to_string(w[i : i + 49], ' ') AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
least AS (SELECT s, min(doc_id) AS first FROM starts GROUP BY s),
gone AS (SELECT r, i FROM starts JOIN least USING (s) WHERE doc_id > first),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM docs),
marked AS (
  SELECT words.r, p, word, count(g.i) OVER (PARTITION BY words.r ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS cut
  FROM words LEFT JOIN gone g ON g.r = words.r AND g.i = p),
kept AS (
  SELECT r, count(*) FILTER (cut) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (NOT cut) AS text FROM marked GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""
