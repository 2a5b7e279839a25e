"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, 'null ' || md5(coalesce(text, '')))) AS draw FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), k AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM s
), w AS (
  SELECT *, kind + 1 AS weight, (3 * source_size)::DOUBLE AS lim FROM k
), l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER o, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY lim / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), x AS (
  SELECT arg_min(level, lim / weight) AS x FROM l WHERE level * weight <= lim
), t AS (
  SELECT source, source_size, kind, least(lim, coalesce(x * weight, lim)) AS target FROM l LEFT JOIN x ON true
), c AS (
  SELECT d.doc_id, d.size, t.source_size, t.kind, t.target,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), n AS (
  SELECT *, whole + CASE WHEN size > 0 AND off + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END AS copies FROM c
), u AS (
  SELECT *, CASE WHEN target > 0 THEN least((off + k * source_size) / target, 1.0::DOUBLE) ELSE 0 END::DOUBLE AS share
  FROM (SELECT *, unnest(range(0, copies)) AS k FROM n)
), v AS (
  SELECT doc_id, size, off, k, round(CASE kind WHEN 0 THEN (share * 2) / (1.5 + sqrt(2.25 - 2 * share)) WHEN 1 THEN share
    ELSE CASE WHEN share * 1.0 <= 0.3125 THEN (share * 2) / (0.5 + sqrt(0.25 + share)) ELSE 0.5 + 2 * (share - 0.3125) / (0.75 + sqrt(0.5625 + 5 * (share - 0.3125))) END
    END::DOUBLE, 6) AS position FROM u
), o AS (
  SELECT doc_id, size, off, min(position) AS first_position, string_agg(printf('%.6f', position), ',' ORDER BY k) AS positions FROM v GROUP BY ALL
)
SELECT n.doc_id, n.size, source_size, target, (copies * n.size)::BIGINT AS taken, copies::BIGINT AS copies, first_position, coalesce(positions, '') AS positions
FROM n LEFT JOIN o ON n.doc_id IS NOT DISTINCT FROM o.doc_id AND n.size = o.size AND n.off = o.off
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT DISTINCT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS u(i) WHERE len(w) > 0
), p AS (
  SELECT d.doc_id, i, n.n, array_to_string(d.w[i : i + n.n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM g) n, unnest(range(1, len(d.w) - n.n + 2)) AS u(i)
), h AS (
  SELECT p.doc_id, p.i, p.n, g.item_id FROM p JOIN g ON p.n = g.n AND p.g = g.g
), k AS (
  SELECT doc_id, count(DISTINCT j)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id
), m AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN m USING (doc_id)
"""

_DIGITS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_CHUNK = "(('0x' || substr(h, {at}, 5))::BIGINT)"
_BASE32 = " || ".join(
    f"substr({_DIGITS}, (({_CHUNK.format(at=5 * i + 1)} >> {shift}) & 31)::INTEGER + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0))

WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages
), f AS (
  SELECT t, min(page_id) AS first_id FROM p GROUP BY t
)
SELECT page_id, strlen(p.t)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN f ON p.t = f.t
"""

_CRC_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
_CRC_STEPS = f"flatten(list_transform({_CRC_BYTES}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
#: crc32 bit by bit: a byte goes in, then eight shifts, marked by -1.
_CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {_CRC_STEPS}), lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


MERKLE = f"""
WITH RECURSIVE base AS (
  SELECT doc_id, source, {_leaf('text')} AS leaf, CASE WHEN {_CRC} % 5 = 0 THEN {_leaf(LOWER.format('text'))} ELSE {_leaf('text')} END AS other,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM documents
), up(l, source, pos, n, node) AS (
  SELECT 0, source, pos, n, leaf FROM base
  UNION ALL
  SELECT any_value(l) + 1, source, pos // 16, any_value((n + 15) // 16), sha256(string_agg(node, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY source, pos // 16
), sub AS (
  SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
), high(l, pos, n, node) AS (
  SELECT 100, pos, n, subroot FROM sub
  UNION ALL
  SELECT any_value(l) + 1, pos // 16, any_value((n + 15) // 16), sha256(string_agg(node, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY pos // 16
), near AS (
  SELECT b.doc_id, u.l, u.pos, u.node, b.pos // (1::BIGINT << (4 * u.l)) AS own FROM base b JOIN up u
    ON b.source IS NOT DISTINCT FROM u.source AND u.n > 1 AND u.pos // 16 = b.pos // (1::BIGINT << (4 * u.l + 4))
  UNION ALL
  SELECT b.doc_id, h.l, h.pos, h.node, s.pos // (1::BIGINT << (4 * (h.l - 100))) FROM base b JOIN sub s ON b.source IS NOT DISTINCT FROM s.source
    JOIN high h ON h.n > 1 AND h.pos // 16 = s.pos // (1::BIGINT << (4 * (h.l - 100) + 4))
), proof AS (
  SELECT doc_id, string_agg(node, '' ORDER BY l, pos) FILTER (WHERE pos <> own) AS p FROM near GROUP BY doc_id
), steps AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY l) AS k, lhs, rhs FROM (
    SELECT doc_id, l, coalesce(string_agg(node, '' ORDER BY pos) FILTER (WHERE pos < own), '') AS lhs, coalesce(string_agg(node, '' ORDER BY pos) FILTER (WHERE pos > own), '') AS rhs
    FROM near GROUP BY doc_id, l)
), folded(doc_id, k, node) AS (
  SELECT doc_id, 0::BIGINT, other FROM base
  UNION ALL
  SELECT f.doc_id, s.k, sha256(s.lhs || f.node || s.rhs) FROM folded f JOIN steps s ON f.doc_id = s.doc_id AND s.k = f.k + 1
), ends AS (
  SELECT doc_id, arg_max(node, k) AS folded_root FROM folded GROUP BY doc_id
), top AS (
  SELECT node AS root FROM high WHERE n = 1
)
SELECT b.doc_id, leaf, subroot, root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM base b JOIN sub s ON b.source IS NOT DISTINCT FROM s.source CROSS JOIN top JOIN ends e ON e.doc_id = b.doc_id LEFT JOIN proof p ON p.doc_id = b.doc_id
"""

_TERMS = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SEARCH = f"""
WITH p AS (
  SELECT doc_id, unnest({_TERMS}) AS t FROM documents
), f AS (
  SELECT doc_id, t, count(*) AS tf FROM p GROUP BY doc_id, t
), n AS (
  SELECT doc_id, count(*) AS n FROM p GROUP BY doc_id
), s AS (
  SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM n
), q AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark
), w AS (
  SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY t, nn
), x AS (
  SELECT item_id, f.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l))))::BIGINT AS score
  FROM q JOIN f ON q.t = f.t JOIN w ON w.t = f.t JOIN n ON n.doc_id = f.doc_id CROSS JOIN s GROUP BY item_id, f.doc_id
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM x WHERE score > 0
)
SELECT * FROM r WHERE rank <= 10
"""

SQL = {"op12_search": SEARCH, "op13_merkle": MERKLE, "op3_mixing": MIXING, "op4_decontamination": DECONTAMINATION, "op7_warc": WARC}
