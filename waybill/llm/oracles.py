"""The rows of some queries in SQL: those that SQL expresses and finishes on whole tables."""

from __future__ import annotations

GAP = r"'[\x20\x09-\x0D]+'"
WORDS = "list_filter(regexp_split_to_array(coalesce({text}, ''), " + GAP + "), lambda x: x <> '')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRINGS = f"""WITH w AS (SELECT doc_id, {WORDS.format(text='text')} AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
low AS (SELECT k, min(doc_id) AS lo FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + o AS p FROM win JOIN low USING (k), (SELECT unnest(range(0, 50)) AS o) WHERE lo < doc_id),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, count(gone.p) AS n_removed, string_agg(x, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS text
  FROM word LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""

JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT reach.x AS doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(y) AS component_id
FROM reach LEFT JOIN n ON reach.x = n.doc_id GROUP BY reach.x"""

QUALITY = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, host, t, {WORDS.format(text='t')} AS ws FROM d),
g AS (SELECT r, i, array_to_string(ws[i : i + 4], ' ') AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM again, (SELECT unnest(range(0, 5)) AS o) GROUP BY r),
l AS (SELECT r, host, t, x, trim(regexp_replace(regexp_replace(lower(x), '[0-9]', '0', 'g'), {GAP}, ' ', 'g'), ' ') AS normal
  FROM (SELECT r, host, t, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')),
same AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM l GROUP BY r),
hosts AS (SELECT host, count(DISTINCT t) AS texts FROM d GROUP BY host),
common AS (SELECT host, normal FROM l JOIN hosts USING (host) GROUP BY host, normal, texts
  HAVING count(DISTINCT t) > 50 AND 100 * count(DISTINCT t) > 10 * texts),
taken AS (SELECT r, sum(len({WORDS.format(text='x')})) AS n FROM l JOIN common USING (host, normal) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(same.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(taken.n, 0) AS BIGINT) AS n_common_words
  FROM w LEFT JOIN same USING (r) LEFT JOIN covered USING (r) LEFT JOIN taken USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_common_words, NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_common_words > 0
    AND (n_words - n_common_words < 10 OR 100 * (n_words - n_common_words) < 30 * n_words)) AS kept FROM m"""

# CRC-32 of the UTF-8 bytes of {0}: a table of 256 entries (`crc`, from the polynomial), then byte by byte
CRC_TABLE = """crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i)))"""
CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(encode({0}))),
  lambda b: ('0x' || substr(hex(encode({0})), 2 * b + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
LEAF = "sha256(" + " || ".join(FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + FIELD + ")"
GROW = """SELECT tree, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM
  (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {0}) WHERE n > 1 GROUP BY tree, level, pos // 3"""
BESIDE = """coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < d.pos // (3 ** s.level)::BIGINT), '') AS lefts,
  coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > d.pos // (3 ** s.level)::BIGINT), '') AS rights"""

MERKLE = f"""WITH RECURSIVE {CRC_TABLE},
l AS (SELECT row_number() OVER () AS id, doc_id, source, {LEAF.format('text')} AS leaf,
    CASE WHEN coalesce({CRC.format('doc_id::VARCHAR')} % 2 = 0, false) THEN {LEAF.format("replace(text, chr(10), '')")} END AS changed FROM documents, crc),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS pos,
    dense_rank() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS tree FROM l),
nodes AS (SELECT tree, 0 AS level, pos, leaf AS digest FROM leaves UNION ALL {GROW.format('nodes')}),
subroots AS (SELECT tree, level AS height, digest FROM nodes QUALIFY level = max(level) OVER (PARTITION BY tree)),
upper_nodes AS (SELECT 0 AS tree, 0 AS level, tree AS pos, digest FROM subroots UNION ALL {GROW.format('upper_nodes')}),
top AS (SELECT level AS height, digest AS root FROM upper_nodes QUALIFY level = max(level) OVER ()),
steps AS (SELECT id, s.level, {BESIDE} FROM leaves AS d JOIN subroots AS r USING (tree)
    JOIN nodes AS s ON s.tree = d.tree AND s.level < r.height AND s.pos // 3 = d.pos // (3 ** (s.level + 1))::BIGINT GROUP BY ALL
  UNION ALL SELECT id, height + s.level, lefts, rights FROM (SELECT d.pos AS tree, s.level, {BESIDE} FROM upper_nodes AS d, top
    JOIN upper_nodes AS s ON s.level < top.height AND s.pos // 3 = d.pos // (3 ** (s.level + 1))::BIGINT WHERE d.level = 0 GROUP BY ALL) AS s
    JOIN leaves USING (tree) JOIN subroots USING (tree)),
fold AS (SELECT id, 0 AS level, coalesce(changed, leaf) AS digest FROM leaves
  UNION ALL SELECT id, level + 1, sha256(lefts || digest || rights) FROM fold JOIN steps USING (id, level)),
folded AS (SELECT id, arg_max(digest, level) AS folded_root FROM fold GROUP BY id),
proof AS (SELECT id, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY id)
SELECT doc_id, leaf, subroots.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN folded USING (id) LEFT JOIN proof USING (id), top"""

WORD_RUNS = f"list_filter(regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
NOISE = "('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT"

RESAMPLED = f"""WITH {CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({WORD_RUNS}, []) AS ws FROM documents),
b AS (SELECT coalesce({WORD_RUNS}, []) AS ws FROM benchmark),
f AS (SELECT r, unnest(ws) AS w FROM d),
words AS (SELECT DISTINCT w FROM f UNION SELECT DISTINCT unnest(ws) FROM b),
dealt AS (SELECT w, {CRC.format('w')} % 10000 AS bucket FROM words, crc),
s AS (SELECT bucket, count(*) AS n FROM f JOIN dealt USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(ws) AS w FROM b) JOIN dealt USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS ss, (SELECT coalesce(sum(n), 0) FROM t) AS tt),
gain AS (SELECT i AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (ss + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * (tt + 10000)::DOUBLE))) AS BIGINT) AS g
  FROM range(10000) AS k(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i, sums),
weight AS (SELECT r, sum(g) AS w FROM f JOIN dealt USING (w) JOIN gain USING (bucket) GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n, CAST(coalesce(w, 0) AS BIGINT) AS weight,
    CAST(coalesce(w, 0) + floor(-1000 * ln(-ln(({NOISE} + 0.5) / 4294967296))) AS BIGINT) AS score FROM d LEFT JOIN weight USING (r)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id) AS k, count(*) FILTER (n >= 20) OVER () AS fits FROM m)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, weight, score, CASE WHEN n >= 20 AND k <= 10 * fits // 100 THEN k END AS rank FROM ranked"""
