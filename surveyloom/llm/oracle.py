"""SQL of the newer queries of this subpackage, for DuckDB."""

from __future__ import annotations

# --- op11: six rounds of assignment and replacement, written out ---------------------------------------------------------------------------------
_NEAREST = """near{n} AS MATERIALIZED (SELECT vec_id, label, part, x, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM
  (SELECT p.vec_id, p.label, p.part, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM parts p JOIN book{n} b USING (part)) GROUP BY ALL)"""
_REPLACED = """book{m} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(s.x, b.x) AS x FROM book{n} b LEFT JOIN
  (SELECT part, entry, list(((total - ((total % k) + k) % k) // k)::BIGINT ORDER BY place) AS x FROM
    (SELECT part, entry, place, sum(v)::BIGINT AS total, count(*) AS k FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS place FROM near{n}) GROUP BY ALL) GROUP BY ALL) s USING (part, entry))"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    steps = ", ".join(_NEAREST.format(n=n) + (", " + _REPLACED.format(n=n, m=n + 1) if n < rounds else "") for n in range(rounds + 1))
    return f"""
        WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda e: floor(e::DOUBLE * 4096)::BIGINT) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        parts AS MATERIALIZED (SELECT vec_id, label, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) r(part)),
        lead AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}),
        book0 AS MATERIALIZED (SELECT part, entry, x FROM parts JOIN lead USING (vec_id)), {steps},
        coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id, label),
        books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books"""


# --- op12: crc32 byte by byte, then the cheapest way row by row -----------------------------------------------------------------------------------
_CRC_TABLE = "list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END))"


def _crc(text: str, table: str) -> str:
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, x: xor({table}[(xor(c, x) % 256) + 1], c // 256)))"


def _least(way: str) -> str:
    """Of the ways to one state of a conversation the cheapest, the least in ASCII order among equals."""
    return f"SELECT conv_id, i, arg_min({{'s': s, 'cost': cost, 'audit': audit, 'said': said}}, (cost, audit)) AS w FROM ({way}) GROUP BY conv_id, i, s"


CONVERSATION_REPAIR = rf"""
        WITH RECURSIVE crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
        base AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        cased AS (SELECT conv_id, turn, role, text, {_crc('name', 't')} % 20 AS c FROM base, crc),
        damaged AS (SELECT conv_id, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role, CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE c WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM cased WHERE c <> 0),
        lined AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
        judged AS MATERIALIZED (SELECT conv_id, turn, role, text, i, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
          CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault FROM lined),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
          count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM judged GROUP BY conv_id),
        steps(s, c, t, said) AS (VALUES ('', 'u', 'u', 'user:'), ('s', 'u', 'u', 'user:'), ('a', 'u', 'u', 'user:'), ('u', 'a', 'a', 'assistant:')),
        takes(s, r) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
        ways AS (
          SELECT conv_id, 0::BIGINT AS i, {{'s': '', 'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]}} AS w, 0 AS k FROM counts
          UNION ALL
          SELECT conv_id, i, w, k FROM (
            WITH open AS (SELECT conv_id, i, w.s AS s, w.cost AS cost, w.audit AS audit, w.said AS said, k FROM ways),
            more AS (SELECT conv_id, i, s, cost, audit, said FROM open WHERE k < 3 UNION ALL SELECT conv_id, i, t, cost + 5, audit || 'I', list_append(o.said, steps.said) FROM open o JOIN steps USING (s) WHERE k < 3),
            edited AS (
              SELECT o.conv_id, o.i + 1 AS i, o.s, o.cost + 2 AS cost, o.audit || 'D' AS audit, o.said FROM open o JOIN judged j ON j.conv_id IS NOT DISTINCT FROM o.conv_id AND j.i = o.i + 1 WHERE k = 3
              UNION ALL
              SELECT o.conv_id, o.i + 1, j.r, o.cost + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, o.audit || 'K', list_append(o.said, j.role || ':' || j.text)
              FROM open o JOIN judged j ON j.conv_id IS NOT DISTINCT FROM o.conv_id AND j.i = o.i + 1 JOIN takes t ON t.s = o.s AND t.r = j.r WHERE k = 3 AND fault NOT IN ('blank', 'duplicate')
              UNION ALL
              SELECT o.conv_id, o.i + 1, t.t, o.cost + CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, o.audit || 'R', list_append(o.said, t.said || j.text)
              FROM open o JOIN judged j ON j.conv_id IS NOT DISTINCT FROM o.conv_id AND j.i = o.i + 1 JOIN steps t ON t.s = o.s WHERE k = 3 AND fault NOT IN ('blank', 'duplicate'))
            SELECT m.conv_id, m.i, m.w, o.k + 1 AS k FROM ({_least('SELECT * FROM more')}) m JOIN (SELECT max(k) AS k FROM open) o ON true
            UNION ALL SELECT conv_id, i, w, 0 AS k FROM ({_least('SELECT * FROM edited')}))),
        ends AS (SELECT c.conv_id, arg_min({{'cost': w.cost, 'audit': w.audit, 'said': w.said}}, (w.cost, w.audit)) AS w FROM counts c JOIN ways ON ways.conv_id IS NOT DISTINCT FROM c.conv_id AND ways.i = c.n AND ways.k = 3 AND ways.w.s IN ('', 'a') GROUP BY c.conv_id)
        SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
          coalesce(e.w.cost, 0)::BIGINT AS cost, coalesce(e.w.audit, '') AS audit, sha256(coalesce(array_to_string(e.w.said, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM a.conv_id"""


# --- op13: matches in order, each found again after the end of the one before ---------------------------------------------------------------------
_EITHER = {"assign": "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")}
_PATTERNS = {
    "assign": rf"""({_EITHER["assign"]})["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "pem": r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*(?:-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----)?",
    "prefixed": r"(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]{16,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}
_LONG = {
    "assign": rf"""length(regexp_extract(m, '^({_EITHER["assign"]})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 2)) >= 6""",
}


def _spans(rank: int, kind: str) -> str:
    pattern = _PATTERNS[kind].replace("'", "''")
    return f"""SELECT doc_id, n, {rank} AS rank, '{kind}' AS kind, m, last - length(m) AS start, last AS "end" FROM (SELECT doc_id, n, unnest(list_zip(found, list_transform(range(1, len(found) + 1), lambda i:
        list_reduce(list_prepend(0::BIGINT, list_transform(found[:i], lambda f: 0::BIGINT)), lambda p, z, k: p + instr(substr(text, p + 1), found[k - 1]) - 1 + length(found[k - 1]))))) AS z, z[1] AS m, z[2] AS last
        FROM (SELECT doc_id, n, text, regexp_extract_all(text, '{pattern}') AS found FROM texts) WHERE len(found) > 0) WHERE {_LONG.get(kind, 'true')}"""


SECRET_SCAN = f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
        found AS ({" UNION ALL ".join(_spans(i, kind) for i, kind in enumerate(_PATTERNS))}),
        told AS (SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
          string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans FROM found GROUP BY n)
        SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts LEFT JOIN told USING (n)"""

ORACLE_SQL = {"op11_vector_codes": vector_codes(), "op12_conversation_repair": CONVERSATION_REPAIR, "op13_secret_scan": SECRET_SCAN}
