"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tickline.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

ORACLE: dict[str, str] = {}

ORACLE["op7_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, list_slice(ws, i, i + 4) AS gram
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(5)) AS k) GROUP BY r),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(list_filter(ws, lambda x: lower(x) IN ({_STOP}))) AS n_stop,
             len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, length(array_to_string(ls, '')) AS n_line_chars,
             length(array_to_string(ls, '')) - length(array_to_string(list_distinct(ls), '')) AS n_dup_line_chars,
             len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%...' OR rtrim(x, ' ') LIKE '%…')) AS n_open,
             coalesce(n, 0) AS n_repeat_words
      FROM w LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
       AND 100 * word_chars BETWEEN 250 * n_words AND 1500 * n_words
       AND 100 * n_symbols <= 10 * n_words
       AND (n_words < 50 OR 100 * n_stop >= 2 * n_words)
       AND (n_words < 50 OR 100 * n_dup_line_chars <= 30 * n_line_chars)
       AND 100 * n_open <= 30 * n_lines AS kept
FROM b
"""

ORACLE["op10_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
keyed AS (
  SELECT doc_id, r, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM lines),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM keyed),
often AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE keeper IS NOT NULL AND k.doc_id <> keeper)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keeper IS NULL OR k.doc_id IS NULL OR k.doc_id = keeper), '')) AS kept_sha256
FROM k LEFT JOIN often USING (key) GROUP BY r, k.doc_id
"""


def _manifest_sql(levels: int = 7, group_levels: int = 3) -> str:
    """Trees of up to 8^levels rows a language and 8^group_levels languages. A level of one node passes it on."""
    encoded = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # a byte e is xored in (as 256 + e), then eight shifts (0)
    steps = "flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: [256 + ord(substr(doc_id::VARCHAR, i, 1)), 0, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, e: CASE WHEN e >= 256 THEN xor(c, e - 256) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    parts = [
        f"f AS (SELECT doc_id, coalesce('=' || lang, '-') AS g, sha256({encoded.format(text='text')}) AS leaf,"
        f" CASE WHEN {crc} % 3 = 0 THEN sha256({encoded.format(text=lower)}) END AS tampered FROM documents)",
        "l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY g) AS m FROM f)",
        "n0 AS (SELECT g, k, leaf AS d, m FROM l)",
    ]
    up = "k // 8 AS k, CASE WHEN m = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY k)) END AS d, (m + 7) // 8 AS m"
    for j in range(levels):
        parts.append(f"n{j + 1} AS (SELECT g, {up} FROM n{j} GROUP BY g, k // 8, m)")
    parts.append(f"s0 AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS k, d, count(*) OVER () AS m FROM n{levels})")
    for j in range(group_levels):
        parts.append(f"s{j + 1} AS (SELECT {up} FROM s{j} GROUP BY k // 8, m)")
    sides = (
        "coalesce(string_agg(d, '') OVER (PARTITION BY {by} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,"
        " coalesce(string_agg(d, '') OVER (PARTITION BY {by} ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a"
    )
    parts += [f"p{j} AS (SELECT g, k, m, {sides.format(by='g, k // 8')} FROM n{j})" for j in range(levels)]
    parts += [f"q{j} AS (SELECT k, m, {sides.format(by='k // 8')} FROM s{j})" for j in range(group_levels)]
    fold = "{t}.*  EXCLUDE (proof, folded), proof || b || a AS proof, CASE WHEN {p}.m > 1 THEN sha256(b || folded || a) ELSE folded END AS folded"
    parts.append("x0 AS (SELECT doc_id, g, k, leaf, '' AS proof, coalesce(tampered, leaf) AS folded FROM l)")
    for j in range(levels):
        parts.append(f"x{j + 1} AS (SELECT {fold.format(t=f'x{j}', p=f'p{j}')} FROM x{j} JOIN p{j} ON x{j}.g = p{j}.g AND x{j}.k // {8**j} = p{j}.k)")
    parts.append(f"y0 AS (SELECT x.* EXCLUDE (k), s0.d AS subroot, s0.k AS k FROM x{levels} x JOIN s0 USING (g))")
    for j in range(group_levels):
        parts.append(f"y{j + 1} AS (SELECT {fold.format(t=f'y{j}', p=f'q{j}')} FROM y{j} JOIN q{j} ON y{j}.k // {8**j} = q{j}.k)")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, (SELECT d FROM s{group_levels}) AS root, sha256(proof) AS proof_sha256,"
        f" folded AS folded_root, folded = (SELECT d FROM s{group_levels}) AS verified FROM y{group_levels}"
    )


ORACLE["op12_merkle_manifest"] = _manifest_sql()
