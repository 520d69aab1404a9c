"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

# Words of documents and items are lower-cased A to Z only; DuckDB's lower() does more.
SQL["op4_decontaminate"] = r"""
WITH dw AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
runs AS (
  SELECT row_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s
  FROM (SELECT row_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM dw, sizes WHERE len(w) >= k)),
hits AS (SELECT row_id, i, runs.k, item_id FROM runs JOIN windows ON windows.k = runs.k AND windows.s = runs.s),
covered AS (
  SELECT row_id, count(DISTINCT j) AS n_hit
  FROM (SELECT row_id, unnest(generate_series(i, i + k - 1)) AS j FROM hits) GROUP BY row_id),
items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (row_id) LEFT JOIN items USING (row_id)
"""

SQL["op10_exact_dedup"] = r"""
WITH rows AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER same AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER same = 1 AS kept,
       sha256(norm) AS text_sha256
FROM rows
WINDOW same AS (PARTITION BY norm ORDER BY doc_id NULLS LAST)
"""

SQL["op8_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(24 + length(replace(replace(replace(role, '\', '\s'), '<|', '<\p'), chr(10), '\n'))
                + length(replace(replace(text, '\', '\s'), '<|', '<\p'))) AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM joined
"""


def merkle_sql(levels: int = 8, lang_levels: int = 3) -> str:
    """The manifest level by level: enough for 8 ** levels rows a language and 8 ** lang_levels languages."""

    def up(name: str, n: int) -> str:
        steps = []
        for k in range(n):
            steps.append(f"""
{name}_n{k} AS (
  SELECT key, idx, h, count(*) OVER (PARTITION BY key) AS n,
         coalesce(string_agg(h, '') OVER (PARTITION BY key, idx // 8 ORDER BY idx
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY key, idx // 8 ORDER BY idx
                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}_{k}),
{name}_{k + 1} AS (
  SELECT key, idx // 8 AS idx, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h
  FROM {name}_n{k} GROUP BY key, idx // 8)""")
        return ",".join(steps)

    def walk(name: str, source: str, n: int) -> str:
        steps = []
        for k in range(n):
            steps.append(f"""
{name}_w{k + 1} AS (
  SELECT w.* REPLACE (idx // 8 AS idx, proof || l || r AS proof, CASE WHEN n > 1 THEN sha256(l || folded || r) ELSE folded END AS folded)
  FROM {source if k == 0 else f"{name}_w{k}"} w JOIN (SELECT key, idx, n, l, r FROM {name}_n{k}) USING (key, idx))""")
        return ",".join(steps)

    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values) + ")"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # The checksum bit by bit: a byte is xor-ed in, then eight shifts (-1).
    crc = """xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
             lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS key, {leaf("text")} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS tampered
  FROM documents),
placed AS (
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS LAST, leaf) - 1 AS idx, doc_id, leaf, '' AS proof, tampered AS folded
  FROM leaves),
a_0 AS (SELECT key, idx, leaf AS h FROM placed),{up("a", levels)},
b_0 AS (SELECT '' AS key, row_number() OVER (ORDER BY key) - 1 AS idx, h FROM a_{levels}),{up("b", lang_levels)},
{walk("a", "placed", levels).lstrip()},
subroots AS (SELECT key AS of_lang, h AS subroot, row_number() OVER (ORDER BY key) - 1 AS nth FROM a_{levels}),
tops AS (
  SELECT '' AS key, nth AS idx, doc_id, leaf, proof, folded, subroot
  FROM a_w{levels} w JOIN subroots s ON w.key = s.of_lang),{walk("b", "tops", lang_levels)}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM b_w{lang_levels}, b_{lang_levels}
"""


SQL["op13_merkle"] = merkle_sql()

SQL["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
said AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, w AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM said) GROUP BY ALL),
f2 AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f
  FROM (SELECT lang, w, unnest(generate_series(1, len(w) - 1)) AS i FROM said) GROUP BY ALL),
f3 AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f
  FROM (SELECT lang, w, unnest(generate_series(1, len(w) - 2)) AS i FROM said) GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT lang, concat_ws(' ', w1, w2) AS phrase, 2 AS n_words, f2.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM f2 JOIN f1 l USING (lang) JOIN f1 r USING (lang)
  WHERE f2.f >= 10 AND l.phrase = w1 AND r.phrase = w2
    AND NOT EXISTS (FROM f3 WHERE f3.lang = f2.lang AND f3.w1 = f2.w1 AND f3.w2 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
    AND NOT EXISTS (FROM f3 WHERE f3.lang = f2.lang AND f3.w2 = f2.w1 AND f3.w3 = f2.w2 AND 100 * f3.f >= 50 * f2.f)
  UNION ALL
  SELECT f3.lang, concat_ws(' ', f3.w1, f3.w2, f3.w3), 3, f3.f, 1, l.f, r.f
  FROM f3 JOIN f1 l ON l.lang = f3.lang AND l.phrase = f3.w1 JOIN f2 r ON r.lang = f3.lang AND r.w1 = f3.w2 AND r.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, concat_ws(' ', f3.w1, f3.w2, f3.w3), 3, f3.f, 2, l.f, r.f
  FROM f3 JOIN f2 l ON l.lang = f3.lang AND l.w1 = f3.w1 AND l.w2 = f3.w2 JOIN f1 r ON r.lang = f3.lang AND r.phrase = f3.w3),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, n_words
FROM lowest JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

SQL["op11_repeats"] = r"""
WITH dw AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT row_id, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS s
  FROM (SELECT row_id, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM dw)),
firsts AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT row_id, unnest(generate_series(i, i + 49)) AS j
  FROM windows JOIN firsts USING (s) WHERE first < doc_id OR (first IS NOT NULL AND doc_id IS NULL)),
removed AS (SELECT row_id, count(*) AS n FROM gone GROUP BY row_id),
kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY j) AS words
  FROM (SELECT row_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS j FROM dw) ANTI JOIN gone USING (row_id, j)
  GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM dw LEFT JOIN removed USING (row_id) LEFT JOIN kept USING (row_id)
"""
