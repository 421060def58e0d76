"""DuckDB SQL of the queries that SQL can express.

The others need XXH64 (op2, op7), a tokenizer (op4, op5, op13), a fitted model (op1) or every
string of 200 bytes (op6); their tests compare them with brute force. op8 and op9 depend on
hashing only inside the operator: the SQL of op9 compares words themselves (in SQL op8's
sentence rules are not to be had; a test has them by brute force).
"""

from __future__ import annotations

#: CRC-32 of UTF-8 bytes from its defining polynomial, a byte a step (fixed value: the
#: reflected polynomial 0xEDB88320).
CRC32 = """
crc_table AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b::UBIGINT, range(8)::UBIGINT[]),
      lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END) AS v
    FROM range(256) r(b))
),
crc AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, strlen(text)),
      lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::UBIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::INT + 1])), 4294967295::UBIGINT)::BIGINT AS crc
  FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents), crc_table
)"""

SHARDS = """
sized AS (
  SELECT d.doc_id, (strlen(c.text) + 1)::BIGINT AS size, c.crc AS text_crc32
  FROM documents d JOIN crc c ON coalesce(d.text, '') = c.text
),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS upto,
         sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) AS place
  FROM sized
),
placed AS (SELECT *, least(15, ((2 * upto - size) * 16) // (2 * total))::INT AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed"""

CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
sized AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS last,
         length('<|im_start|>') + 1 + length('<|im_end|>') + 1
           + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n'))
           + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
upto AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS prefix FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(prefix) FILTER (role = 'assistant' OR n = last))::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples
FROM upto GROUP BY conv_id"""

#: Every window of the item's size at every place of every document, without an index.
LEAKS = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)
),
b AS (
  SELECT item_id, v, len(v) AS size, least(5, len(v)) AS k FROM (
    SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS v
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) WHERE len(v) > 0
),
ish AS (
  SELECT item_id, v, size, k, s, count(*) AS n FROM (
    SELECT item_id, v, size, k, unnest(list_transform(range(1, size - k + 2), lambda i: array_to_string(v[i:i + k - 1], ' '))) AS s FROM b)
  GROUP BY ALL
),
sizes AS (SELECT DISTINCT k FROM b),
dsh AS (
  SELECT doc_id, w, k, p - 1 AS p, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM d, sizes, unnest(range(1, greatest(len(w) - k + 2, 1))) r(p)
),
-- a window that is similar at all holds a shared shingle: windows around each place of one
places AS (
  SELECT DISTINCT x.doc_id, x.w, i.item_id, i.v, i.size, i.k, x.p FROM dsh x JOIN (SELECT DISTINCT item_id, v, size, k, s FROM ish) i ON x.k = i.k AND x.s = i.s
),
wins AS (
  SELECT DISTINCT doc_id, w, item_id, v, size, k, st
  FROM places, unnest(range(greatest(p - size + 1, 0), greatest(least(p, len(w) - size), 0) + 1)) r(st)
),
wsh AS (
  SELECT doc_id, w, item_id, v, size, k, st, s, count(*) AS n FROM (
    SELECT *, unnest(list_transform(range(1, len(w[st + 1:st + size]) - k + 2), lambda i: array_to_string(w[st + i:least(st + i + k - 1, st + size)], ' '))) AS s FROM wins)
  GROUP BY ALL
),
wn AS (SELECT doc_id, w, item_id, v, st, sum(n) AS n FROM wsh GROUP BY ALL),
inn AS (SELECT item_id, v, sum(n) AS n FROM ish GROUP BY ALL),
both_ AS (
  SELECT x.doc_id, x.w, x.item_id, x.v, x.st, sum(least(x.n, i.n)) AS n
  FROM wsh x JOIN ish i ON x.item_id = i.item_id AND x.v = i.v AND x.s = i.s GROUP BY ALL
),
sim AS (
  SELECT a.doc_id, a.w, a.item_id, a.v, a.st, a.n / (c.n + e.n - a.n) AS similarity
  FROM both_ a JOIN wn c ON a.doc_id IS NOT DISTINCT FROM c.doc_id AND a.w = c.w AND a.item_id = c.item_id AND a.v = c.v AND a.st = c.st
  JOIN inn e ON a.item_id = e.item_id AND a.v = e.v
)
SELECT doc_id, item_id, round(max(similarity), 6) AS similarity, arg_min(st, (1 - similarity, st)) AS start
FROM sim WHERE similarity >= 0.8 GROUP BY doc_id, w, item_id, v"""

#: A-Z to a-z and nothing else.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: All runs of one to three words are counted, then ranked.
PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(LOWERED, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) r(k)) GROUP BY ALL
),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.p, c.k, c.a, j, l.f AS l, r.f AS r, ((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f l ON l.lang = c.lang AND l.p = array_to_string(c.ws[1:c.j], ' ')
  JOIN f r ON r.lang = c.lang AND r.p = array_to_string(c.ws[c.j + 1:], ' ')
),
scored AS (
  SELECT lang, p, a, arg_min(l, (score, j)) AS l, arg_min(r, (score, j)) AS r, min(score) AS score FROM cuts GROUP BY lang, p, a
),
longer AS (
  SELECT lang, p, max(a) AS a FROM (
    SELECT lang, array_to_string(ws[1:2], ' ') AS p, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(ws[2:3], ' ') AS p, a FROM c WHERE k = 3) GROUP BY lang, p
),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.p) AS rank
  FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.p = s.p WHERE g.a IS NULL OR 100 * g.a < 50 * s.a
)
SELECT lang, rank, p AS phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""".replace("LOWERED", LOWER)

TERMS = r"regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".replace("LOWERED", LOWER)

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {TERMS} AS t FROM documents),
size AS (SELECT count(*) AS docs, sum(len(t))::BIGINT AS total FROM d WHERE len(t) > 0),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({TERMS}) AS term FROM benchmark) GROUP BY ALL),
tf AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, size GROUP BY term, docs),
gain AS (
  SELECT row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS gain
  FROM tf JOIN w USING (term), size
),
score AS (SELECT item_id, row, doc_id, sum(gain * times)::BIGINT AS score FROM gain JOIN q USING (term) GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INT AS rank FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

ORACLE_SQL: dict[str, str] = {
    "op3_chat_format": CHAT,
    "op9_decontaminate": LEAKS,
    "op10_sharding": "WITH " + CRC32.strip() + "," + SHARDS,
    "op11_collocations": PHRASES,
    "op12_lexical_search": SEARCH,
}
