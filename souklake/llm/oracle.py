"""SQL of the text queries that SQL expresses on whole tables."""

from __future__ import annotations

from .shards import SLOTS, lookup_table

#: Windows by their text, the smallest document of each, and the words no repeated window covers.
SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS k FROM d, LATERAL (SELECT unnest(range(1, len(w) - 48)) AS s)),
hit AS (SELECT doc_id, s FROM win JOIN (SELECT k, min(doc_id) AS first FROM win GROUP BY k) USING (k) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM hit, LATERAL (SELECT unnest(range(50)) AS o)),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::bigint AS n_words, coalesce(lost.n, 0)::bigint AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""

#: Conversations as lists of turns, every prefix of every one, and each node handed to all its ancestors.
#: CRC-32 goes bit by bit: a character comes in, eight steps (-1) follow.
PREFIX_TRIE = """
WITH turns AS (SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS bytes,
                      md5(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) AS k
               FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(k ORDER BY turn NULLS FIRST, k) AS k, list(bytes ORDER BY turn NULLS FIRST, k) AS b,
               list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(c::varchar, ''),
                 lambda s: list_concat([ascii(s)::bigint], list_transform(range(8), lambda i: -1::bigint))))),
                 lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END) AS crc
        FROM turns GROUP BY c),
full_conv AS (SELECT o.c, list_concat(coalesce(f.k[1:xor(o.crc, 4294967295) % 9], []), o.k[xor(o.crc, 4294967295) % 9 + 1:]) AS k,
                     list_concat(coalesce(f.b[1:xor(o.crc, 4294967295) % 9], []), o.b[xor(o.crc, 4294967295) % 9 + 1:]) AS b
              FROM own o LEFT JOIN own f ON f.c = o.c - o.c % 5),
members AS (SELECT c, d, k[1:d] AS path, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS bytes, len(k) = d AS ends
            FROM full_conv, LATERAL (SELECT unnest(range(len(k) + 1)) AS d)),
node AS (SELECT array_to_string(path, ',') AS key, any_value(d) AS d, any_value(path) AS path, min(c) AS conv_id, count(*) AS n,
                (count(*) - 1) * any_value(bytes) AS saved,
                sha256(coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
         FROM members GROUP BY 1),
up AS (SELECT key, d, saved, a, array_to_string(path[1:a], ',') AS top FROM node, LATERAL (SELECT unnest(range(d + 1)) AS a)),
kids AS (SELECT top AS key, count(*) AS n FROM up WHERE a = d - 1 GROUP BY top),
sums AS (SELECT top AS key, count(*) FILTER (NOT EXISTS (SELECT 1 FROM kids WHERE kids.key = up.key)) AS leaves, sum(saved) AS saved
         FROM up GROUP BY top)
SELECT node.conv_id, node.d AS depth, parent.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(kids.n, 0) AS n_children,
       sums.leaves AS n_leaves, sums.saved::bigint AS saved_tokens, node.ends_sha256
FROM node JOIN sums USING (key) LEFT JOIN kids USING (key)
LEFT JOIN node parent ON node.d > 0 AND parent.key = array_to_string(node.path[1:node.d - 1], ',')"""

#: Every query against every other row; whole products stay exact in doubles.
TOP_K = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda e: floor(64 * e::double)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::bigint AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::int AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""


def shard_documents(names: list[str]) -> str:
    """Placement by the lookup table, which is written out; tests hold its filling against its rules."""
    table = ", ".join(map(str, lookup_table(names)))
    shards = ", ".join(f"'{name}'" for name in names)
    return f"""
SELECT doc_id, source, slot, ([{shards}])[([{table}])[slot + 1] + 1] AS shard, n_bytes
FROM (SELECT doc_id, source, strlen(text)::bigint AS n_bytes,
             (('0x' || md5(coalesce(doc_id::varchar, ''))[1:15])::bigint % {SLOTS})::int AS slot FROM documents)"""
