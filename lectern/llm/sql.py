"""SQL twins of the queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS l,
         array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 13) + 1)) AS s
        FROM i WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, l, s, array_to_string(w[s:s + l - 1], ' ') AS g
  FROM (SELECT doc_id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS s
        FROM d, (SELECT DISTINCT l FROM iw) WHERE len(w) >= l)
),
h AS (SELECT doc_id, s, l, item_id FROM dw JOIN iw USING (l, g)),
p AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + l - 1)) AS p
        FROM (SELECT DISTINCT doc_id, s, l FROM h))
  GROUP BY doc_id
),
n AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""

_ROUND = "CAST('0x' || substr(md5('42:{k}:' || CAST(r AS VARCHAR)), 1, 12) AS BIGINT)"


def _network(source: str) -> str:
    """The four rounds of the network over column y of a source, as nested selects."""
    kept = "doc_id, size, text_crc32, n, a, b"
    q = f"SELECT {kept}, y // b AS l, y % b AS r FROM {source}"
    for k in range(4):
        shift = f"(l + {_ROUND.format(k=k)}) % {'ab'[k % 2]}"
        q = f"SELECT {kept}, r AS l, {shift} AS r FROM ({q})"
    return f"SELECT {kept}, l * b + r AS y FROM ({q})"


# DuckDB has no crc32: a table of the reflected polynomial, then one step per byte
_CRC_TABLE = """
t AS (
  SELECT list(list_reduce(
           list_prepend(k, CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
           lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
         ) ORDER BY k) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS k)
)
"""


def _crc32(text: str) -> str:
    return f"""
xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(
    regexp_extract_all(hex(encode({text})), '..'),
    lambda h: CAST('0x' || h AS BIGINT))),
  lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])
))
"""


OP4 = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         {_crc32("coalesce(text, '')")} AS text_crc32
  FROM documents, t
),
n AS (SELECT count(*) AS n, CAST(floor(sqrt(count(*) - 1)) AS BIGINT) + 1 AS a FROM d),
s AS (
  SELECT doc_id, size, text_crc32, n, a, (n + a - 1) // a AS b,
         row_number() OVER (ORDER BY doc_id, size, text_crc32) - 1 AS y
  FROM d, n
),
w AS (
  {_network("s")}
  UNION ALL
  {_network("(SELECT * FROM w WHERE y >= n)")}
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law,
       CAST(y % 16 AS INTEGER) AS shard, CAST(y // 16 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM w WHERE y < n
"""

# base32 of a SHA-1: 40 hexadecimal digits are 32 groups of five bits
OP3 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS h
  FROM pages
),
b AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS response,
         list_transform(range(8), lambda k: CAST('0x' || h[5 * k + 1:5 * k + 5] AS BIGINT)) AS five
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((five[k // 4 + 1] >> (5 * (3 - k % 4))) & 31) + 1]
       ), '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM b
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank
  FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

_PIECE = r"[0-9A-Za-z]+|[^\x00-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
_WORD = r"[^\x20\x09-\x0D]+"

# what is left after the batches, counted from the surviving texts
OP8 = f"""
WITH t AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
q AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 0),
d AS (
  SELECT source, lang,
         CASE WHEN q.doc_id IS NULL THEN text ELSE regexp_replace(text, '[0-9]+', '', 'g') END AS text
  FROM documents LEFT JOIN q ON documents.doc_id = q.doc_id
  WHERE documents.doc_id NOT IN (SELECT doc_id FROM t WHERE doc_id IS NOT NULL)
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
FROM (
  SELECT source, lang, 'words-1' AS tokenizer,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n FROM d
  UNION ALL
  SELECT source, lang, 'pieces-1', len(regexp_extract_all(coalesce(text, ''), '{_PIECE}')) FROM d
)
GROUP BY ALL
"""


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    parts = ("doc_id", "source", "lang", n_chars, "text")
    return f"sha256({' || '.join(_field(c) for c in parts)})"


# trees grow level by level: `grp` is a language, or '' for the tree of their roots
OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_crc32("CAST(coalesce(CAST(doc_id AS VARCHAR), '') AS VARCHAR)")} % 7 = 0
              THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS changed
  FROM documents, t
),
p AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY grp) AS n
  FROM d
),
tree AS (
  SELECT grp, 0 AS level, pos, n, leaf AS h FROM p
  UNION ALL
  SELECT grp, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM tree WHERE n > 1 GROUP BY grp, level, pos // 2, n
),
tops AS (
  SELECT grp, h AS subroot, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n
  FROM tree WHERE n = 1
),
crown AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM crown WHERE n > 1 GROUP BY level, pos // 2, n
),
walk AS (
  SELECT doc_id, grp, leaf, pos AS id, 0 AS level, pos, n, changed AS h, '' AS proof FROM p
  UNION ALL
  SELECT doc_id, w.grp, leaf, id, w.level + 1, w.pos // 2, (w.n + 1) // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END),
         proof || coalesce(s.h, '')
  FROM walk w LEFT JOIN tree s ON s.grp = w.grp AND s.level = w.level AND s.pos = xor(w.pos, 1)
  WHERE w.n > 1
),
up AS (
  SELECT doc_id, w.grp, leaf, id, subroot, 0 AS level, t.pos, t.n, h, proof
  FROM walk w JOIN tops t ON t.grp = w.grp WHERE w.n = 1
  UNION ALL
  SELECT doc_id, grp, leaf, id, subroot, w.level + 1, w.pos // 2, (w.n + 1) // 2,
         sha256(CASE WHEN w.pos % 2 = 1 THEN s.h || w.h ELSE w.h || coalesce(s.h, '') END),
         proof || coalesce(s.h, '')
  FROM up w LEFT JOIN crown s ON s.level = w.level AND s.pos = xor(w.pos, 1)
  WHERE w.n > 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, u.h AS folded_root,
       u.h = root AS verified
FROM up u, (SELECT h AS root FROM crown WHERE n = 1) WHERE u.n = 1
"""
