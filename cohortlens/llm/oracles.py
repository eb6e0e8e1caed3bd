"""DuckDB SQL of the corpus operators' queries, where SQL can express one, written without their methods."""

from __future__ import annotations


def _nearest(book: str) -> str:
    """Each part's nearest entry of a codebook, ties to the lower index."""
    d = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(4))
    return f"SELECT vec_id, row, p, x0, x1, x2, x3, min(d * 64 + e) % 64 AS e, min(d) AS d FROM (SELECT a.*, b.e, {d} AS d FROM parts a JOIN {book} b USING (p)) GROUP BY ALL"


def _means(book: str, assigned: str) -> str:
    """Entries at the floor of their parts' mean; unused ones stay."""
    mean = ", ".join(f"CAST(floor(sum(x{i}) / count(*)) AS BIGINT) AS x{i}" for i in range(4))
    cells = ", ".join(f"coalesce(m.x{i}, b.x{i}) AS x{i}" for i in range(4))
    return f"SELECT b.p, b.e, {cells} FROM {book} b LEFT JOIN (SELECT p, e, {mean} FROM {assigned} GROUP BY p, e) m USING (p, e)"


#: Vectors of 64 components, so 4 for each of 16 parts.
OP11 = f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, row, CAST(t.p AS BIGINT) AS p, {", ".join(f"v[4 * t.p + {i + 1}] AS x{i}" for i in range(4))} FROM kept, range(16) t(p)),
book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, row) - 1 AS e, x0, x1, x2, x3 FROM parts QUALIFY e < 64),
near0 AS MATERIALIZED ({_nearest("book0")}),
book1 AS MATERIALIZED ({_means("book0", "near0")}),
near1 AS MATERIALIZED ({_nearest("book1")}),
book2 AS MATERIALIZED ({_means("book1", "near1")}),
near2 AS MATERIALIZED ({_nearest("book2")}),
digest AS (SELECT sha256(string_agg(concat_ws(',', x0, x1, x2, x3), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2),
coded AS (
  SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY row)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, g.codebooks_sha256
FROM kept k JOIN coded c USING (row), digest g
"""

#: CRC-32 of strings: the table of the reflected polynomial, and the checksum of a string's UTF-8 bytes.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"


def _crc32(text: str) -> str:
    """Of a SQL expression, where the table ``crc`` is joined."""
    code = f"hex(encode({text}))"
    byte = f"list_transform(range(length({code}) // 2), lambda i: CAST('0x' || substr({code}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {byte}), lambda c, b: xor(c >> 8, crc.tab[(xor(c, b) & 255) + 1])), 4294967295)"


OP13 = f"""
WITH RECURSIVE crc AS MATERIALIZED ({_CRC_TABLE}),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\u00c0-\u00ff]{{7,}}')) AS run FROM documents),
lowered AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c FROM runs GROUP BY ALL),
hashed AS MATERIALIZED (SELECT run, c, {_crc32("id || ':' || run")} AS h FROM lowered, crc),
dropped AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM dropped WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
holes AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
replaced AS (SELECT a.word, b.word AS near FROM holes a JOIN holes b USING (rest, i) WHERE a.word <> b.word AND length(a.word) = length(b.word)),
shorter AS (SELECT DISTINCT h.word, w.word AS near FROM holes h JOIN words w ON w.word = h.rest),
near AS (SELECT word, near FROM replaced UNION SELECT word, near FROM shorter UNION SELECT near, word FROM shorter),
ranked AS (
  SELECT p.word, p.near, b.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY b.n DESC, p.near) AS place
  FROM near p JOIN words b ON b.word = p.near),
formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 10 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 10 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r USING (word)),
chain AS (
  SELECT word, word AS last, 0 AS steps FROM formed
  UNION ALL SELECT c.word, f.form, c.steps + 1 FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM formed f JOIN (SELECT word, arg_max(last, steps) AS root FROM chain GROUP BY word) c USING (word)
"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Every row under a number of its own, its words in order.
_DOCS = f"docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text, {_WORDS} AS words FROM documents)"

#: Windows compared whole (by their digest), each word looked at under the windows that may cover it.
OP7 = f"""
WITH {_DOCS},
spans AS MATERIALIZED (
  SELECT row, doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS run
  FROM (SELECT row, doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs WHERE len(words) >= 50)),
earliest AS (SELECT run, min(doc_id) AS first_doc FROM spans GROUP BY run),
hits AS MATERIALIZED (SELECT s.row, s.i FROM spans s JOIN earliest l USING (run) WHERE l.first_doc < s.doc_id),
places AS (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
marked AS (
  SELECT p.row, p.word, p.i,
         max(CASE WHEN h.i IS NOT NULL THEN 1 END) OVER (PARTITION BY p.row ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM places p LEFT JOIN hits h ON h.row = p.row AND h.i = p.i),
kept AS (
  SELECT row, count(gone) AS n_removed, string_agg(CASE WHEN gone IS NULL THEN word END, ' ' ORDER BY i) AS kept FROM marked GROUP BY row)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (row)
"""

#: All pairs that share a shingle, counted; components by following links as far as they go.
OP9 = f"""
WITH RECURSIVE docs AS MATERIALIZED (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWER.format("coalesce(text, '')"))} AS words FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(shingle) AS shingle FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' '))) AS shingle FROM docs WHERE len(words) >= 5
    UNION ALL SELECT doc_id, array_to_string(words, ' ') AS shingle FROM docs WHERE len(words) BETWEEN 1 AND 4)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id) p
  JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b WHERE 100 * p.shared >= 75 * (m.n + n.n - p.shared)),
reach AS (SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, d.doc_id) AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l USING (doc_id)
"""

#: The columns of op2 that no model decides.
OP2_BASE = f"""
WITH {_DOCS},
lines AS (SELECT row, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM docs),
dups AS (
  SELECT row, sum(n - 1) AS n FROM (SELECT row, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row, line) GROUP BY row),
spans AS MATERIALIZED (
  SELECT row, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT row, words, unnest(range(1, len(words) - 1)) AS i FROM docs WHERE len(words) >= 3)),
twice AS (SELECT row, a, b, c FROM spans GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT DISTINCT row, i + k AS i FROM (SELECT s.row, s.i FROM spans s JOIN twice USING (row, a, b, c)), range(3) t(k)),
repeats AS (SELECT row, count(*) AS n FROM covered GROUP BY row),
counted AS (
  SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(d.words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(coalesce(d.text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(u.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM docs d LEFT JOIN dups u USING (row) LEFT JOIN repeats r USING (row))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
"""

_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_LUHN = (
    f"list_sum(list_transform(range(length({_DIGITS})), lambda k: CASE WHEN k % 2 = 0 THEN CAST(substr({_DIGITS}, length({_DIGITS}) - k, 1) AS INT) "
    f"ELSE (2 * CAST(substr({_DIGITS}, length({_DIGITS}) - k, 1) AS INT)) // 10 + (2 * CAST(substr({_DIGITS}, length({_DIGITS}) - k, 1) AS INT)) % 10 END)) % 10 = 0"
)
_HOLDS = {
    "email": "true",
    "ip": "len(list_filter(string_split(hit, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(try_cast(ltrim(p, '0') AS INT), 0) > 255)) = 0",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
}


def _hits(place: int, kind: str) -> str:
    """A pattern's matches with their places: what stands between them says how far each is."""
    p = _PATTERNS[kind].replace("'", "''")
    return f"""
  SELECT row, {place} AS place, '{kind}' AS kind, hit, gap + taken AS a, gap + taken + length(hit) AS b FROM (
    SELECT row, hit, sum(length(piece)) OVER (PARTITION BY row ORDER BY k) AS gap,
           coalesce(sum(length(hit)) OVER (PARTITION BY row ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken
    FROM (SELECT row, unnest(hits) AS hit, unnest(pieces[1 : len(hits)]) AS piece, unnest(range(len(hits))) AS k
          FROM (SELECT row, regexp_extract_all(text, '{p}') AS hits, string_split_regex(text, '{p}') AS pieces FROM docs WHERE text IS NOT NULL) WHERE len(hits) > 0))
  WHERE {_HOLDS[kind]}"""


#: The columns of op5 that no model decides.
OP5_BASE = f"""
WITH {_DOCS},
found AS MATERIALIZED ({" UNION ALL ".join(_hits(k, kind) for k, kind in enumerate(_PATTERNS))}),
counted AS (
  SELECT row, {", ".join(f"count(CASE WHEN kind = '{kind}' THEN 1 END) AS n_{kind}" for kind in _PATTERNS)},
         string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(b AS BIGINT), ',' ORDER BY place, a) AS listed
  FROM found GROUP BY row)
SELECT d.doc_id, {", ".join(f"coalesce(c.n_{kind}, 0) AS n_{kind}" for kind in _PATTERNS)}, sha256(coalesce(c.listed, '')) AS base_sha256
FROM docs d LEFT JOIN counted c USING (row)
"""

#: The columns of op12 that no model decides; the score to four digits, as sums of doubles differ in their last ones.
OP12_BASE = f"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '')")} % 7 = 2 AS held_out,
         list_append({_WORDS.replace("coalesce(text, '')", _LOWER.format("coalesce(text, '')"))}, chr(0) || ' end') AS tokens
  FROM documents, crc),
tokens AS MATERIALIZED (SELECT row, held_out, unnest(tokens) AS token FROM docs),
seen AS MATERIALIZED (SELECT token, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY token),
total AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM seen),
scored AS (
  SELECT t.row, count(*) AS n_tokens, count(s.c) AS n_known, sum(log10((coalesce(s.c, 0) + 1) / CAST(g.n + g.v + 1 AS DOUBLE))) AS base_score
  FROM tokens t LEFT JOIN seen s USING (token), total g GROUP BY t.row)
SELECT d.doc_id, d.held_out, s.n_tokens, s.n_known, CAST(g.n AS BIGINT) AS train_tokens, round(s.base_score, 4) AS base_score
FROM docs d JOIN scored s USING (row), total g
"""

SQL = {
    "op2_quality_trees_base": OP2_BASE,
    "op5_pii_crf_base": OP5_BASE,
    "op7_block_anchors": OP7,
    "op9_bitmap_join": OP9,
    "op11_vector_codes": OP11,
    "op12_deleted_interpolation_base": OP12_BASE,
    "op13_spelling_variants": OP13,
}
