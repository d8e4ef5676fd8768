"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op2_source_mixing"] = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, '')) AS draw
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) AS place FROM sizes),
weighed AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS most,
         (sum(source_size) OVER ())::BIGINT AS total FROM ranked),
rests AS (
  SELECT *, total - (sum(most) OVER (ORDER BY most / weight, place))::BIGINT + most AS rest,
         (sum(weight) OVER (ORDER BY most / weight, place
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weights
  FROM weighed),
fitted AS (SELECT *, rest::HUGEINT * weight <= most::HUGEINT * weights AS fits FROM rests),
first_fit AS (SELECT rest, weights FROM fitted WHERE fits ORDER BY most / weight, place LIMIT 1),
targets AS (
  SELECT place, source, source_size,
         CASE WHEN fits THEN (f.rest * weight)::DOUBLE / f.weights::DOUBLE ELSE most::DOUBLE END AS target
  FROM fitted, first_fit f),
shards AS (SELECT greatest(1, ceil(sum(size) / 1048576.0)::BIGINT) AS n FROM sized),
placed AS (
  SELECT s.*, t.place, t.source_size, t.target, ('0x' || substr(draw, 1, 8))::BIGINT % shards.n AS shard
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, shards),
groups AS (
  SELECT shard, place, sum(size)::BIGINT AS length,
         CASE WHEN first(source_size) > 0
              THEN floor(1000 * (first(target) * sum(size)::BIGINT / first(source_size)))::BIGINT
              ELSE 0 END AS wanted
  FROM placed GROUP BY shard, place),
shared AS (
  SELECT *, (sum(wanted) OVER (PARTITION BY shard))::BIGINT AS all_wanted, count(*) OVER (PARTITION BY shard) AS n_groups
  FROM groups),
counted AS (
  SELECT *, floor(all_wanted / 16000 + 0.5)::BIGINT AS blocks,
         CASE WHEN all_wanted > 0 THEN wanted / all_wanted ELSE 0.0::DOUBLE END AS part FROM shared),
seats AS (
  SELECT *, greatest(0, floor(part * (blocks - n_groups / 2) - 0.5)::BIGINT) AS low,
         ceil(part * (blocks + n_groups / 2) + 0.5)::BIGINT AS high FROM counted),
opened AS (SELECT *, blocks - sum(low) OVER (PARTITION BY shard) AS open FROM seats),
ranked_seats AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY wanted / (2 * seat + 1) DESC, place, seat) AS turn
  FROM (SELECT *, unnest(range(low, greatest(low, high) + 1)) AS seat FROM opened WHERE wanted > 0)),
quotas AS (
  SELECT shard, place,
         least(first(low) + count(*) FILTER (turn <= open), 3 * ceil(first(length) / 16.0)::BIGINT) AS quota
  FROM ranked_seats GROUP BY shard, place),
lined AS (
  SELECT p.*, q.quota,
         (sum(size) OVER (PARTITION BY p.shard, p.place ORDER BY draw, doc_id, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS stop,
         (sum(size) OVER (PARTITION BY p.shard, p.place))::BIGINT AS length
  FROM placed p LEFT JOIN quotas q ON p.shard = q.shard AND p.place = q.place),
edges AS (
  SELECT *, quota // greatest(1, ceil(length / 16.0)::BIGINT) AS rounds,
         (quota % greatest(1, ceil(length / 16.0)::BIGINT)) * 16 AS edge FROM lined),
open AS (
  SELECT *, edge - coalesce(max(CASE WHEN stop <= edge THEN stop END) OVER (PARTITION BY shard, place), 0) AS rest
  FROM edges),
missed AS (
  SELECT *, CASE WHEN stop > edge AND abs(size - rest) < rest THEN abs(size - rest) END AS miss FROM open),
chosen AS (
  SELECT *, miss IS NOT NULL AND row_number() OVER (
           PARTITION BY shard, place ORDER BY miss ASC NULLS LAST, draw, doc_id, size) = 1 AS last FROM missed)
SELECT doc_id, size, source_size, target,
       CASE WHEN length > 0 AND quota IS NOT NULL
            THEN size * (rounds + (stop <= edge)::INTEGER + last::INTEGER) ELSE 0 END::BIGINT AS taken
FROM chosen
"""

ORACLES["op3_exact_dedup"] = """
WITH cleaned AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) = 1 AS kept, text_sha256
FROM cleaned
"""

ORACLES["op8_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10))
           + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars,
       0::BIGINT AS expanded_tokens
FROM turns GROUP BY conv_id
"""

ORACLES["op10_hamming_topk"] = """
WITH codes AS (
  SELECT vec_id AS id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '')::BIT
         AS code FROM embeddings),
ranked AS (
  SELECT q.id AS query_id, c.id, bit_count(xor(q.code, c.code))::INTEGER AS distance,
         row_number() OVER (PARTITION BY q.id ORDER BY bit_count(xor(q.code, c.code)), c.id)::INTEGER AS rank
  FROM codes q CROSS JOIN codes c WHERE q.id % 50 = 0)
SELECT * FROM ranked WHERE rank <= 10
"""


ORACLES["op11_substring_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT row, place, md5(array_to_string(words[place:place + 34], ' ')) AS hash
  FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS place FROM texts)),
repeated AS (SELECT hash FROM windows GROUP BY hash HAVING count(*) > 1),
gone AS (SELECT DISTINCT row, place + step AS place FROM windows JOIN repeated USING (hash), range(35) AS s (step)),
single AS (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
kept AS (
  SELECT row, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS text
  FROM single ANTI JOIN gone USING (row, place) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (row)
"""


_CRC_TABLE = """
crc AS MATERIALIZED (
  WITH RECURSIVE t(byte, round, value) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL
    SELECT byte, round + 1, CASE WHEN value & 1 = 1 THEN xor(3988292384, value >> 1) ELSE value >> 1 END FROM t WHERE round < 8)
  SELECT list(value ORDER BY byte) AS steps FROM t WHERE round = 8)
"""

ORACLES["op12_spelling_variants"] = (
    "WITH RECURSIVE "
    + _CRC_TABLE
    + r""",
runs AS (
  SELECT name || ':' || run AS keyed, run, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS name, unnest(list_transform(
          regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+'),
          lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS run FROM documents)
  GROUP BY ALL),
drawn AS (
  SELECT run, n, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(1, strlen(keyed) + 1),
             lambda i: ('0x' || substr(hex(encode(keyed)), 2 * i - 1, 2))::BIGINT)),
           lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM runs, crc),
slipped AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM drawn),
counted AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
spots AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM counted),
shorter AS (SELECT DISTINCT word, n, left(word, place - 1) || substr(word, place + 1) AS rest FROM spots),
holes AS (SELECT word, n, left(word, place - 1) || '*' || substr(word, place + 1) AS hole FROM spots),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
  UNION ALL SELECT s.word, c.word, c.n FROM shorter s JOIN counted c ON s.rest = c.word
  UNION ALL SELECT c.word, s.word, s.n FROM shorter s JOIN counted c ON s.rest = c.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top,
         first(other ORDER BY other_n DESC, other) AS other FROM pairs GROUP BY word),
known AS (
  SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * c.n THEN other END AS form,
         CASE WHEN top >= 2 * c.n THEN top END AS form_n
  FROM counted c LEFT JOIN best b USING (word)),
chains(word, tip) AS (
  SELECT word, word FROM known
  UNION ALL SELECT c.word, k.form FROM chains c JOIN known k ON k.word = c.tip WHERE k.form IS NOT NULL)
SELECT k.word, k.form, c.tip AS root, k.n, k.n_near::BIGINT AS n_near, k.form_n
FROM known k JOIN chains c USING (word) JOIN known e ON e.word = c.tip WHERE e.form IS NULL
"""
)

ORACLES["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
counted AS (
  SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place
        FROM split, range(1, 6) AS s (size))
  GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE size > 1 AND f >= 100),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(words[1:cut], ' ') AS head, array_to_string(words[cut + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS cut FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.f AS l, t.f AS r, n, 1000::HUGEINT * c.a * n // (h.f::HUGEINT * t.f) AS score, cut
  FROM cuts c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head
  JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail JOIN totals o ON o.lang = c.lang),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(words[place:place + k - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, size - k + 2)) AS place FROM candidates, range(2, 5) AS r (k) WHERE k < size)),
kept AS (SELECT * FROM lowest ANTI JOIN inside USING (lang, phrase, a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""


def _license_sql() -> str:
    from recollect.llm.licenses import KNOWN

    quoted = ", ".join(
        "('" + name + "', '" + text.replace("'", "''") + "')" for name, texts in KNOWN.items() for text in texts
    )
    plain = r"""regexp_replace(regexp_replace(lower(coalesce(text, '')),
      '(?m)^[^\p{L}\p{N}\n]*(copyright|\(c\)|©)([^\p{L}\p{N}\n][^\n]*)?$', '', 'g'), '[^\p{L}\p{M}\p{N}\n]+', ' ', 'g')"""
    plain = f"replace(replace({plain}, 'licence', 'license'), 'licenced', 'licensed')"
    plain = f"replace(replace({plain}, 'non commercial', 'noncommercial'), 'sub license', 'sublicense')"
    lines = f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"
    return f"""
WITH known AS (
  SELECT sha256(array_to_string({lines}, ' ')) AS digest, min(license_id) AS license_id
  FROM (VALUES {quoted}) AS k (license_id, text) GROUP BY 1),
docs AS (SELECT doc_id, {lines} AS lines FROM documents),
units AS (SELECT doc_id, unnest(list_transform(lines, lambda x: sha256(x))) AS digest FROM docs),
named AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS line_licenses, count(*) AS n
  FROM units JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, k.license_id, n.line_licenses, coalesce(n.n, 0) AS n_license_lines,
       sha256(array_to_string(d.lines, ' ')) AS canonical_sha256
FROM docs d LEFT JOIN known k ON k.digest = sha256(array_to_string(d.lines, ' ')) LEFT JOIN named n USING (doc_id)
"""


ORACLES["op7_license_scan"] = _license_sql()
