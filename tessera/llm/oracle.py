"""DuckDB SQL of the training-data queries that SQL can express."""

OP9 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
m AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
             length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS esc_chars FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(esc_chars + CASE WHEN before IS NOT DISTINCT FROM role THEN 10 ELSE 24 + length(role) END)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

OP8 = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
win AS (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8),
win2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM win),
rep AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM win2 WHERE n > 1),
cov AS (SELECT doc_id, sum(CASE WHEN after IS NULL THEN 8 ELSE least(8, after - i) END)::BIGINT AS n FROM rep GROUP BY doc_id),
ln AS (SELECT doc_id, source, hash(text) AS th, unnest(string_split(text, chr(10))) AS line FROM d),
ln2 AS (SELECT *, lower(regexp_replace(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), '\p{Nd}+', '0', 'g')) AS norm
        FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
hosts AS (SELECT source, count(DISTINCT hash(text)) AS n FROM d GROUP BY source),
often AS (SELECT l.source, l.norm FROM ln2 l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
          GROUP BY l.source, l.norm, h.n HAVING count(DISTINCT th) > greatest(10, 0.1 * h.n)),
gone AS (SELECT doc_id, sum(len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')))::BIGINT AS n
         FROM ln2 JOIN often ON ln2.norm = often.norm AND ln2.source IS NOT DISTINCT FROM often.source GROUP BY doc_id),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln2 GROUP BY doc_id),
base AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND n_words - n_removed_words >= 20 AND n_words - n_removed_words >= 0.5 * n_words AS kept
FROM base
"""

OP7 = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
ln AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS idx FROM d),
st AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS worded FROM ln),
st2 AS (SELECT *, greatest(1, sum(CASE WHEN worded THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx)) AS pos FROM st),
w AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t,
             len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS k FROM st2 WHERE worded),
win AS (SELECT doc_id, pos, t AS a, lead(t) OVER o AS b, lead(t, 2) OVER o AS c, k, lead(k) OVER o AS k2 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
rep AS (SELECT doc_id, pos, 3 AS n, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth FROM win WHERE c IS NOT NULL
        UNION ALL SELECT doc_id, pos, 1, row_number() OVER (PARTITION BY a ORDER BY doc_id, pos) FROM win WHERE k >= 50
        UNION ALL SELECT doc_id, pos, 2, row_number() OVER (PARTITION BY a, b ORDER BY doc_id, pos) FROM win WHERE b IS NOT NULL AND k + k2 >= 50),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos::BIGINT, (pos + n)::BIGINT)) AS pos FROM rep WHERE nth > 1),
n_gone AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
n_lines AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
rest AS (SELECT st2.doc_id, string_agg(line, chr(10) ORDER BY idx) AS text FROM st2 ANTI JOIN gone
         ON st2.doc_id = gone.doc_id AND st2.pos = gone.pos GROUP BY st2.doc_id)
SELECT d.doc_id, coalesce(n_lines.n, 0) AS n_lines, coalesce(n_gone.n, 0) AS n_deleted,
       sha256(CASE WHEN n_gone.n IS NULL THEN coalesce(d.text, '') ELSE coalesce(rest.text, '') END) AS text_sha256
FROM d LEFT JOIN n_lines USING (doc_id) LEFT JOIN n_gone USING (doc_id) LEFT JOIN rest USING (doc_id)
"""

# lower() alone would also fold letters beyond A-Z
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
it AS (SELECT item_id, w, least(13, len(w)) AS m FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM it)),
sizes AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS win
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN iw ON dw.m = iw.m AND dw.win = iw.win),
words AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS place FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n > 0 AND 20 * words.n >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL: dict[str, str] = {"op2_decontamination": OP2, "op7_line_dedup": OP7, "op8_quality_rules": OP8, "op9_chat_formatting": OP9}

# CRC-32 bit by bit; the rebuilt conversations; every prefix of each; savings of a node go to all its prefixes
OP11 = r"""
WITH t AS (SELECT conv_id, turn, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
                  len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS words FROM conversations),
own AS (SELECT conv_id, list(code ORDER BY turn NULLS FIRST, code) AS codes, list(words ORDER BY turn NULLS FIRST, code) AS words FROM t GROUP BY conv_id),
h AS (SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
        lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda b, i: xor(b >> 1, 3988292384 * (b & 1)))), 4294967295::BIGINT) % 4, 0) AS h FROM own),
r AS (SELECT h.conv_id, list_concat(coalesce(b.codes, [])[:h.h], h.codes[h.h + 1:]) AS codes, list_concat(coalesce(b.words, [])[:h.h], h.words[h.h + 1:]) AS words
      FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, array_to_string(codes[:d], ',') AS path, array_to_string(codes[:d - 1], ',') AS up, words[d] AS w, d = len(codes) AS last
      FROM (SELECT *, unnest(range(len(codes) + 1)) AS d FROM r)),
n AS (SELECT d, path, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * coalesce(min(w), 0) AS saved,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends FROM p GROUP BY d, path),
k AS (SELECT n.*, u.conv_id AS parent, coalesce(c.k, 0) AS k FROM n LEFT JOIN n u ON u.d = n.d - 1 AND u.path = n.up
      LEFT JOIN (SELECT d - 1 AS d, up, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL) c ON c.d = n.d AND c.up = n.path),
s AS (SELECT a.d, a.path, sum(k.saved) AS saved, count(*) FILTER (k.k = 0) AS leaves
      FROM k JOIN p q ON q.conv_id IS NOT DISTINCT FROM k.conv_id AND q.d = k.d JOIN p a ON a.conv_id IS NOT DISTINCT FROM k.conv_id AND a.d <= k.d GROUP BY a.d, a.path)
SELECT k.conv_id::BIGINT AS conv_id, k.d::INTEGER AS depth, k.parent::BIGINT AS parent_conv_id, k.n::BIGINT AS n_convs, k.k::BIGINT AS n_children,
       s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, k.ends AS ends_sha256 FROM k JOIN s ON s.d = k.d AND s.path = k.path
"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
st AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT item_id, text, t, count(*) AS k FROM (SELECT item_id, text, unnest({_WORDS}) AS t FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
s AS (SELECT item_id, q.text, d.r, d.doc_id, sum(k * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN df USING (t) JOIN tf USING (t) JOIN d USING (r) CROSS JOIN st GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST, r)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10
"""

OP13 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
u AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, min(reach.b))::BIGINT AS component_id FROM s LEFT JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, s.s
"""

SQL.update({"op11_conversation_trie": OP11, "op12_ranked_search": OP12, "op13_jaccard_join": OP13})
