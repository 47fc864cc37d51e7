"""DuckDB SQL of the queries that SQL can express, written apart from the Spark code.

The others have none: XXH64 and fitted models are not at hand in SQL, look-behind patterns neither.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
runs AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 13) AS n,
         array_to_string(w[i + 1:i + 13], ' ') AS run
  FROM (SELECT *, unnest(range(greatest(len(w) - 13, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, i, n, array_to_string(w[i + 1:i + n], ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM runs) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, grams.n, item FROM grams JOIN runs ON grams.run = runs.run AND grams.n = runs.n),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP4 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|><|im_sep|><|im_end|>') + length(role) + length(text)
                + len(regexp_extract_all(role, '<\\*\|')) + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT)
         AS formatted_chars
FROM t GROUP BY conv_id"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 13) AS UBIGINT) AS DOUBLE)
          + 0.5) / 4503599627370496 AS draw
  FROM documents),
s AS (
  SELECT source, size AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source)),
r AS (
  SELECT *, row_number() OVER (ORDER BY source_size * 3 / weight, source NULLS LAST) AS place,
         source_size * 3 / weight AS stop FROM s),
shares AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS share
  FROM r WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ends AS (SELECT min(place) AS place, min_by(share, place) AS share FROM shares WHERE share <= stop),
targets AS (
  SELECT source, source_size, CASE WHEN ends.place IS NULL OR shares.place < ends.place
         THEN CAST(source_size * 3 AS DOUBLE) ELSE ends.share * weight END AS target
  FROM shares, ends),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
p0 AS (
  SELECT d.*, target - whole * source_size AS need,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY draw) AS upto
  FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source),
k0 AS (SELECT source, need, need - coalesce(max(upto) FILTER (WHERE upto <= need), 0) AS rest FROM p0 GROUP BY source, need),
p1 AS (
  SELECT p0.doc_id, p0.source, p0.size, p0.draw, rest, sum(p0.size) OVER (PARTITION BY p0.source ORDER BY draw) AS upto
  FROM p0 JOIN k0 ON p0.source IS NOT DISTINCT FROM k0.source WHERE NOT upto <= p0.need AND size <= rest),
k1 AS (SELECT source, rest - coalesce(max(upto) FILTER (WHERE upto <= rest), 0) AS rest FROM p1 GROUP BY source, rest),
p2 AS (
  SELECT p1.doc_id, p1.source, p1.draw, k1.rest, sum(p1.size) OVER (PARTITION BY p1.source ORDER BY draw) AS upto
  FROM p1 JOIN k1 ON p1.source IS NOT DISTINCT FROM k1.source WHERE NOT upto <= p1.rest AND size <= k1.rest),
k2 AS (
  SELECT source, draw AS cut FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY abs(upto - rest), draw) AS place FROM (
      SELECT source, draw, upto, rest FROM p2 UNION ALL SELECT DISTINCT source, -1, 0, rest FROM p2)) WHERE place = 1),
more AS (
  SELECT doc_id FROM p0 WHERE upto <= need UNION ALL SELECT doc_id FROM p1 WHERE upto <= rest
  UNION ALL SELECT doc_id FROM p2 JOIN k2 ON p2.source IS NOT DISTINCT FROM k2.source WHERE draw <= cut)
SELECT d.doc_id, d.size, source_size, target,
       CAST((whole + CASE WHEN more.doc_id IS NULL THEN 0 ELSE 1 END) * d.size AS BIGINT) AS taken
FROM d JOIN plan ON d.source IS NOT DISTINCT FROM plan.source LEFT JOIN more USING (doc_id)"""



def _crc32(codes):
    """CRC-32, bit by bit, of a SQL list of bytes."""
    bits = f"flatten([[(b >> i) & 1 for i in range(8)] for b in {codes}])"
    start = f"list_prepend(CAST(4294967295 AS BIGINT), {bits})"
    return f"xor(list_reduce({start}, lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)), 4294967295)"


_VALUES = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")
_LEAF = " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in (*_VALUES, "$text"))
_DIGITS = "[CAST(ord(x) AS BIGINT) for x in string_split(CAST(doc_id AS VARCHAR), '')]"
_CHANGED = f"CASE WHEN {_crc32(_DIGITS)} % 5 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END"

_OP11 = f"""
WITH RECURSIVE
leaves AS (
  SELECT doc_id, source, sha256({_LEAF.replace("$text", "text")}) AS leaf, sha256({_LEAF.replace("$text", "changed")}) AS changed
  FROM (SELECT *, {_CHANGED} AS changed FROM documents)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY source) AS n,
         dense_rank() OVER (ORDER BY source NULLS FIRST) AS tree
  FROM leaves),
inner_nodes AS (
  SELECT tree, 0 AS level, k, n, leaf AS digest FROM ranked
  UNION ALL
  SELECT tree, level + 1, k // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY k))
  FROM inner_nodes WHERE n > 1 GROUP BY tree, level, k // 16, n),
subroots AS (SELECT tree, digest AS subroot FROM inner_nodes WHERE n = 1),
top_nodes AS (
  SELECT 0 AS tree, 0 AS level, tree - 1 AS k, (SELECT count(*) FROM subroots) AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT 0, level + 1, k // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY k))
  FROM top_nodes WHERE n > 1 GROUP BY level, k // 16, n),
runs AS (
  SELECT tree, level, k // 16 AS run, list(digest ORDER BY k) AS digests
  FROM (SELECT * FROM inner_nodes UNION ALL SELECT * FROM top_nodes) WHERE n > 1 GROUP BY ALL),
up AS (
  SELECT row_number() OVER () AS id, doc_id, leaf, tree, tree AS home, 0 AS level, k, n, changed AS folded, '' AS proof FROM ranked
  UNION ALL
  SELECT id, doc_id, leaf, up.tree, home, up.level + 1, k // 16, (n + 15) // 16,
         sha256(array_to_string(digests[1:k % 16], '') || folded || array_to_string(digests[k % 16 + 2:], '')),
         proof || array_to_string(digests[1:k % 16], '') || array_to_string(digests[k % 16 + 2:], '')
  FROM up JOIN runs ON runs.tree = up.tree AND runs.level = up.level AND runs.run = k // 16 WHERE n > 1),
over AS (
  SELECT id, doc_id, leaf, home, 0 AS level, home - 1 AS k, (SELECT count(*) FROM subroots) AS n, folded, proof FROM up WHERE n = 1
  UNION ALL
  SELECT id, doc_id, leaf, home, over.level + 1, k // 16, (n + 15) // 16,
         sha256(array_to_string(digests[1:k % 16], '') || folded || array_to_string(digests[k % 16 + 2:], '')),
         proof || array_to_string(digests[1:k % 16], '') || array_to_string(digests[k % 16 + 2:], '')
  FROM over JOIN runs ON runs.tree = 0 AND runs.level = over.level AND runs.run = k // 16 WHERE n > 1)
SELECT doc_id, leaf, subroot, top.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = top.digest AS verified
FROM over JOIN subroots ON home = subroots.tree, (SELECT digest FROM top_nodes WHERE n = 1) AS top WHERE over.n = 1"""

_CODES = "[CAST(ord(x) AS BIGINT) for x in string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, '')]"
_BYTES = f"flatten([CASE WHEN p < 128 THEN [p] ELSE [192 | (p >> 6), 128 | (p & 63)] END for p in {_CODES}])"

_OP12 = rf"""
WITH RECURSIVE
tokens AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY doc_id, w),
hashed AS (SELECT w, n, {_crc32(_BYTES)} AS h FROM tokens),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word AS a, y.word AS b, y.n FROM cut AS x JOIN cut AS y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON rest = words.word
  UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON rest = words.word),
best AS (
  SELECT a AS word, count(*) OVER (PARTITION BY a) AS n_near, b, n, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS place FROM near),
forms AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * words.n THEN b END AS form,
         CASE WHEN best.n >= 10 * words.n THEN best.n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word AND place = 1),
chains AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT chains.word, forms.form, steps + 1 FROM chains JOIN forms ON chains.root = forms.word WHERE form IS NOT NULL)
SELECT forms.word, form, ends.root, n, n_near, form_n
FROM forms JOIN (SELECT word, max_by(root, steps) AS root FROM chains GROUP BY word) AS ends ON ends.word = forms.word"""

ORACLES = {"op1_decontamination": _OP1, "op4_chat_formatting": _OP4, "op9_source_mixing": _OP9, "op11_merkle_manifest": _OP11,
           "op12_spelling_variants": _OP12}
