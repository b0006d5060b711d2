"""DuckDB SQL for the results of the registered queries that SQL can express."""

from __future__ import annotations

from dockflow.llm import mixing, ngram_join, quality, suffix_dedup
from dockflow.llm.common import LOWER, UPPER

EXACT = f"""SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(n) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS n FROM documents) WINDOW w AS (PARTITION BY n)"""

QUALITY = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
grams AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM d, unnest(range(1, len(ws) - 1)) AS g(i)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM twice, unnest([i, i + 1, i + 2]) AS u(p) GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup FROM d, unnest(string_split(t, chr(10))) AS s(l) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1),
m AS (
  SELECT d.doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, (length(t) - length(replace(t, '!!', ''))) // 2 AS n_shouted
  FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN lines ON d.doc_id = lines.doc_id),
f AS (SELECT *, %s AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & %d <> 0 AS base_failed, failed_bits & %d = 0 AS kept, failed_bits FROM f""" % (
    "CAST(" + " + ".join(f"CASE WHEN {r.failed} THEN {1 << k} ELSE 0 END" for k, r in enumerate(quality.RULES)) + " AS BIGINT)",
    quality.POLICIES[0].mask, quality.CURRENT.mask,
)

MIX = f"""WITH RECURSIVE c AS (SELECT source, CAST(floor(sqrt(count(*))) AS BIGINT) AS root FROM documents GROUP BY 1),
s AS (SELECT source, greatest(1, {mixing.FRAME} * root // (SELECT CAST(sum(root) AS BIGINT) FROM c)) AS share FROM c),
l AS (SELECT list(source ORDER BY source NULLS FIRST) AS src, list(share ORDER BY source NULLS FIRST) AS p, CAST(sum(share) AS BIGINT) AS q FROM s),
edf AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(p, lambda x: CAST(0 AS BIGINT)) AS done, CAST(NULL AS BIGINT) AS pick FROM l
  UNION ALL
  SELECT t + 1, list_transform(range(1, len(p) + 1), lambda j: done[j] + CASE WHEN j = i THEN 1 ELSE 0 END), i FROM (
    SELECT t, done, list_sort(list_filter(list_transform(range(1, len(p) + 1), lambda j:
      CASE WHEN done[j] * q // p[j] <= t THEN {{'due': ((done[j] + 1) * q + p[j] - 1) // p[j], 'i': j}} END), lambda x: x IS NOT NULL))[1].i AS i, p
    FROM edf, l WHERE t < q)),
frame AS (SELECT src[pick] AS source, p[pick] AS share, q, t - 1 AS place_in_frame, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn FROM edf, l WHERE pick IS NOT NULL),
numbered AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) - 1 AS k FROM documents),
blocks AS (SELECT doc_id, source, k // {mixing.BLOCK} AS block, k % {mixing.BLOCK} AS place FROM numbered)
SELECT doc_id, b.source, block, block * q // f.share AS release, ((block + 1) * q + f.share - 1) // f.share AS deadline,
  block // f.share * q + place_in_frame AS slot, place
FROM blocks b JOIN frame f ON b.source IS NOT DISTINCT FROM f.source AND b.block % f.share = f.turn"""

NEAR = rf"""WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + {ngram_join.GRAM - 1}], ' ')) AS gram FROM d, unnest(range(1, greatest(len(ws) - {ngram_join.GRAM - 2}, 2))) AS u(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
linked AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 10 * common >= {round(10 * ngram_join.THRESHOLD)} * (nx.n + ny.n - common)
  UNION ALL SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.doc_id <> b.doc_id AND len(a.ws) = 0 AND len(b.ws) = 0),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, linked.y FROM reach JOIN linked ON reach.y = linked.x)
SELECT d.doc_id, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS class_id, (SELECT count(*) FROM linked WHERE x = d.doc_id) AS n_links FROM d"""

SUFFIXES = f"""WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, {2 * suffix_dedup.WINDOW}) AS s FROM h, unnest(range(0, n - {suffix_dedup.WINDOW - 1})) AS u(i)),
owned AS (SELECT s, min(doc_id) AS owner FROM w GROUP BY 1 HAVING min(doc_id) < max(doc_id)),
late AS (SELECT doc_id, i FROM w JOIN owned USING (s) WHERE owner < doc_id),
marked AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {suffix_dedup.WINDOW} THEN 0 ELSE 1 END AS fresh FROM late),
runs AS (SELECT doc_id, min(i) AS a, max(i) + {suffix_dedup.WINDOW} AS b FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked) GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, a, b, substr(x, 2 * lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1, 2 * (a - lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a))) AS piece
  FROM runs JOIN h USING (doc_id)),
cut AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last, string_agg(piece, '' ORDER BY a) AS head FROM pieces GROUP BY 1)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM h LEFT JOIN cut USING (doc_id)"""


def _crc32(text: str) -> str:
    return (f"xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT)), "
            "lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1]), CAST(4294967295 AS BIGINT)))")


def _reshard(source: str, old: str, new: str, order: str, name: str, shards: int) -> str:
    """CTEs that move the first bytes beyond each shard's share, in an order, to the shards with room, lowest first."""
    return f"""{name}_total AS (SELECT CAST(sum(size) AS BIGINT) AS total FROM {source}),
{name}_shards AS (
  SELECT j, coalesce(size, 0) AS size, CASE WHEN j < {shards} THEN total // {shards} + CASE WHEN j < total % {shards} THEN 1 ELSE 0 END ELSE 0 END AS capacity
  FROM (SELECT unnest(range(greatest({shards}, (SELECT max({old}) + 1 FROM {source})))) AS j) AS all_shards
  LEFT JOIN (SELECT {old} AS j, CAST(sum(size) AS BIGINT) AS size FROM {source} GROUP BY 1) AS sizes USING (j), {name}_total),
{name}_room AS (
  SELECT j, greatest(size - capacity, 0) AS surplus, CAST(sum(greatest(size - capacity, 0)) OVER w - greatest(size - capacity, 0) AS BIGINT) AS base,
    greatest(capacity - size, 0) AS deficit, CAST(sum(greatest(capacity - size, 0)) OVER w AS BIGINT) AS upto
  FROM {name}_shards WINDOW w AS (ORDER BY j)),
{name}_sums AS (SELECT *, CAST(sum(size) OVER (PARTITION BY {old} ORDER BY {order}) AS BIGINT) AS q FROM {source}),
{name} AS (
  SELECT s.*, CASE WHEN q <= surplus THEN (SELECT min(t.j) FROM {name}_room AS t WHERE t.deficit > 0 AND t.upto >= r.base + s.q) ELSE {old} END AS {new}
  FROM {name}_sums AS s JOIN {name}_room AS r ON r.j = {old})"""


RESHARD = f"""WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i)) AS crc_table),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
    {_crc32("coalesce(text, '')")} AS text_crc32, {_crc32("coalesce(source, '')")} % 6 AS old_shard FROM documents, crc),
{_reshard("d", "old_shard", "reached", "place", "flowed", 8)},
f AS (SELECT doc_id, size, place, text_crc32, old_shard, reached FROM flowed),
{_reshard("f", "reached", "shard", "size, place", "evened", 8)}
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard, CAST(old_shard AS INTEGER) AS old_shard FROM evened"""

_FAILS = " + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, c in enumerate([
    "len(ws) < 200", "100 * len(list_distinct(ws)) < 50 * len(ws)", "100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t)",
    "regexp_matches(t, '[#$%&*|]')", "doc_id > min(doc_id) OVER (PARTITION BY t)"]))

AUDIT = rf"""WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
f AS (SELECT doc_id, part, {_FAILS} AS failed FROM d),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1),
c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x AS a, x AS b, x AS c, x AS d, x AS e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, 1 << (ord(substr(filter_order, CAST(k AS INTEGER), 1)) - 65) AS own,
    CAST(coalesce(list_sum(list_transform(range(1, k), lambda i: 1 << (ord(substr(filter_order, CAST(i AS INTEGER), 1)) - 65))), 0) AS INTEGER) AS before
  FROM o, unnest(range(1, 6)) AS u(k)),
r AS (
  SELECT part, filter_order, step, own,
    CAST(coalesce(sum(n) FILTER (WHERE failed & (before | own) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (WHERE failed & own <> 0 AND failed & before = 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (WHERE failed & own <> 0 AND failed & before <> 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (WHERE failed = own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (WHERE failed & own <> 0 AND failed & before = 0), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (WHERE failed & own <> 0 AND failed & before = 0), 0) AS BIGINT) AS toxic_lost
  FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""
