"""SQL (DuckDB) of the registered queries that SQL can express over whole tables."""

from __future__ import annotations

#: Lower-cased words of a text column.
_WORDS = (r"regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
#: Words between ASCII white space.
_SPACED = r"regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')"


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, four bits at a time."""
    def shifted(bits: int) -> int:
        for _ in range(4):
            bits = (bits >> 1) ^ (0xEDB88320 if bits & 1 else 0)
        return bits
    steps = "[" + ", ".join(f"{shifted(i)}::BIGINT" for i in range(16)) + "]"

    def half(x: str) -> str:
        return f"xor({x} >> 4, {steps}[({x} & 15) + 1])"
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            f"lambda a, b: {half(half('xor(a, b)'))}), 4294967295)")


DECONTAMINATION = f"""
    WITH doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    item AS (SELECT item_id, w, LEAST(13, LEN(w)) AS t
             FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE LEN(w) > 0),
    item_at AS (SELECT item_id, t, w, UNNEST(RANGE(1, LEN(w) - t + 2)) AS i FROM item),
    item_win AS (SELECT DISTINCT item_id, t, ARRAY_TO_STRING(w[i:i + t - 1], ' ') AS g FROM item_at),
    doc_at AS (SELECT doc_id, t, w, UNNEST(RANGE(1, LEN(w) - t + 2)) AS i
               FROM doc, (SELECT DISTINCT t FROM item)),
    doc_win AS (SELECT doc_id, t, i, ARRAY_TO_STRING(w[i:i + t - 1], ' ') AS g FROM doc_at),
    hit AS (SELECT doc_id, item_id, t, i FROM doc_win JOIN item_win USING (t, g)),
    place AS (SELECT DISTINCT doc_id, UNNEST(RANGE(i, i + t)) AS p FROM hit),
    n AS (SELECT doc_id, COUNT(*) AS n_hit FROM place GROUP BY doc_id),
    its AS (SELECT doc_id, COUNT(*) AS n_items, STRING_AGG(item_id, ',' ORDER BY item_id) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
    SELECT doc.doc_id, CAST(LEN(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit,
           COALESCE(n_items, 0) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
           COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= LEN(w) AS contaminated
    FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN its USING (doc_id)
"""

EXACT_DEDUP = """
    WITH hashed AS (
        SELECT doc_id, COALESCE(text, '') AS body FROM documents)
    SELECT doc_id,
           MAX(doc_id) OVER same AS keep_id,
           COUNT(*) OVER same AS group_size,
           doc_id = MAX(doc_id) OVER same AS kept,
           sha256(body) AS text_sha256
    FROM hashed WINDOW same AS (PARTITION BY body)
"""

# every prefix is spelt out as a list, nodes are the distinct lists
PREFIX_TRIE = f"""
    WITH own AS (
      SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos,
             {{'r': COALESCE(role, ''), 't': COALESCE(text, '')}} AS x
      FROM conversations WHERE conv_id IS NOT NULL),
    conv AS (SELECT c, list(x ORDER BY pos) AS xs, ({_crc32('c::VARCHAR')}) % 4 AS h FROM own GROUP BY c),
    whole AS (
      SELECT a.c, list_concat(COALESCE(b.xs[1:a.h], []), a.xs[a.h + 1:]) AS xs
      FROM conv a LEFT JOIN conv b ON b.c = a.c - a.c % 20),
    prefix AS (SELECT c, xs[1:d] AS p, d, len(xs) AS size
               FROM (SELECT c, xs, unnest(range(len(xs) + 1)) AS d FROM whole)),
    node AS (
      SELECT p, d, min(c) AS conv_id, count(*) AS n,
             string_agg(CASE WHEN size = d THEN c::VARCHAR END, ',' ORDER BY c) AS ends
      FROM prefix GROUP BY p, d),
    priced AS (
      SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * len(regexp_extract_all(p[d].t, '[^\\x20\\x09-\\x0D]+')) END AS own_saved,
             NOT EXISTS (SELECT 1 FROM node k WHERE k.d = node.d + 1 AND k.p[1:node.d] = node.p) AS leaf
      FROM node),
    below AS (
      SELECT p[1:u] AS p, u AS d, sum(leaf::BIGINT)::BIGINT AS n_leaves, sum(own_saved)::BIGINT AS saved,
             count(*) FILTER (d = u + 1) AS n_children
      FROM (SELECT *, unnest(range(d + 1)) AS u FROM priced) GROUP BY 1, 2)
    SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, b.n_children, b.n_leaves,
           b.saved AS saved_tokens, sha256(COALESCE(v.ends, '')) AS ends_sha256
    FROM priced v JOIN below b ON b.d = v.d AND b.p = v.p
    LEFT JOIN node up ON up.d = v.d - 1 AND up.p = v.p[1:v.d - 1]
"""

# all pairs of equal words at all lags, as islands
PERIODIC_RUNS = f"""
    WITH split AS (SELECT doc_id, {_SPACED} AS w, COALESCE({_crc32("COALESCE(doc_id::VARCHAR, '')")}, 0) AS h FROM documents),
    sized AS (SELECT *, len(w) AS n, h // 10 AS g FROM split),
    parts AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a,
                     CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sized),
    doc AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
                 THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END)
                 ELSE w END AS w FROM parts),
    word AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(w) AS x FROM doc),
    pair AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM word u JOIN word v
             ON v.doc_id IS NOT DISTINCT FROM u.doc_id AND v.x = u.x AND v.i > u.i AND v.i - u.i <= u.n // 4),
    island AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM pair),
    stretch AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS size FROM island GROUP BY doc_id, q, k
                HAVING count(*) + q >= greatest(6, 4 * q)),
    run AS (SELECT * FROM stretch o WHERE NOT EXISTS (
        SELECT 1 FROM stretch z WHERE z.doc_id IS NOT DISTINCT FROM o.doc_id AND z.q < o.q AND z.s <= o.s
                                      AND z.s + z.size >= o.s + o.size)),
    dropped AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM run),
    listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(format('{{}},{{}},{{}}' || chr(10), s, size, q), '' ORDER BY s, q) AS lines,
                      first({{'s': s, 'size': size, 'q': q}} ORDER BY size DESC, s, q) AS best FROM run GROUP BY doc_id),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS body FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
    SELECT d.doc_id, COALESCE(n_runs, 0) AS n_runs, best.s AS start, best.size AS length, best.q AS period,
           1000 * best.size // best.q AS exponent_milli, sha256(COALESCE(lines, '')) AS runs_sha256,
           sha256(COALESCE(body, '')) AS collapsed_sha256
    FROM doc d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


def _jump(key: str, shards: int) -> str:
    """The generator's draws one after the other, in 128-bit whole numbers."""
    def drawn(k: str) -> str:
        return f"({k} * 2862933555777941757::HUGEINT + 1) % 18446744073709551616::HUGEINT"
    at = "floor((s.b + 1) * (2147483648.0::DOUBLE / ((s.k // 8589934592)::DOUBLE + 1.0::DOUBLE)))::BIGINT"
    first = f"{{'k': ({drawn(key)})::HUGEINT, 'b': 0::BIGINT}}"
    return (f"list_reduce(list_transform(range({shards + 1}), lambda i: {first}), lambda s, x: CASE WHEN {at} < {shards} "
            f"THEN {{'k': ({drawn('s.k')})::HUGEINT, 'b': {at}}} ELSE s END).b::INTEGER")


SHARDING = f"""
    WITH doc AS (
      SELECT doc_id, strlen(COALESCE(text, '')) + 8 AS size,
             CASE WHEN COALESCE(text, '') = '' THEN 0 ELSE {_crc32("text")} END AS text_crc32,
             CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616::HUGEINT
                  ELSE COALESCE(doc_id, 0)::HUGEINT END AS key
      FROM documents),
    placed AS (SELECT *, {_jump('key', 24)} AS shard, {_jump('key', 25)} AS grown_shard FROM doc)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
    FROM placed
"""

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": DECONTAMINATION,
    "op9_exact_dedup": EXACT_DEDUP,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_sharding": SHARDING,
}
