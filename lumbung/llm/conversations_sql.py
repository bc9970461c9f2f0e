"""Damage and repair of conversations as DuckDB SQL: one step of the recursion takes the next row of every conversation."""

from __future__ import annotations

from lumbung.llm.sql_crc32 import crc32

BLANK = r"\x20\x09-\x0D"


def add(state: str, cost: str, letter: str) -> str:
    """A state is its cost in nine digits and its audit, so the least text is the cheapest edit, and of these the first."""
    return f"(lpad(({state}[1:9]::BIGINT + {cost})::VARCHAR, 9, '0') || {state}[10:] || '{letter}')"


def inserted(columns: str, source: str) -> str:
    to_user = ", ".join(add(f"x{i}", "2", "I") for i in (0, 1, 3))
    return f"""
        SELECT {columns}, x0 AS z0, x1 AS z1, z2, least(x3, {add("z2", "2", "I")}) AS z3
        FROM (SELECT *, least(x2, {to_user}) AS z2 FROM ({source}))"""


def repair_sql() -> str:
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    step = f"""
        SELECT s.conv_id, r.i,
            {add("z0", "3", "D")} AS x0,
            least({add("z1", "3", "D")}, CASE WHEN NOT gone AND initial = 's' THEN {add("z0", "late", "K")} END) AS x1,
            least({add("z2", "3", "D")},
                {", ".join(f"CASE WHEN NOT gone AND initial = 'u' THEN {add(z, 'late', 'K')} END" for z in ("z0", "z1", "z3"))},
                {", ".join(f"CASE WHEN NOT gone THEN {add(z, '2 + late', 'R')} END" for z in ("z0", "z1", "z3"))}) AS x2,
            least({add("z3", "3", "D")}, CASE WHEN NOT gone AND initial = 'a' THEN {add("z2", "late", "K")} END,
                CASE WHEN NOT gone THEN {add("z2", "2 + late", "R")} END) AS x3
        FROM states s JOIN marked r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1"""
    start = "SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000000' AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM conversations"
    return f"""
    WITH RECURSIVE cases AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32("k")} % 20 AS c
        FROM (SELECT *, {key} AS k FROM conversations)
    ),
    damaged AS (
        SELECT conv_id, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role,
            CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE c WHEN 3 THEN [1, 2] ELSE [1] END) AS times
        FROM cases WHERE c <> 0
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged
    ),
    faults AS (
        SELECT *, role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair,
            CASE WHEN NOT regexp_matches(text, '[^{BLANK}]') THEN 'blank'
                WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][{BLANK}]*$') THEN 'truncated' ELSE '' END AS fault
        FROM placed
    ),
    marked AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS late FROM faults),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM marked GROUP BY conv_id
    ),
    states AS ({inserted("conv_id, i", start)} UNION ALL {inserted("conv_id, i", step)}),
    best AS (
        SELECT conv_id, least(z0, z3)[1:9]::BIGINT AS cost, least(z0, z3)[10:] AS audit
        FROM states QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
    ),
    letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, unnest(range(length(audit))) AS p FROM best WHERE audit <> ''),
    numbered AS (
        SELECT *, sum((edit <> 'I')::BIGINT) OVER w AS i, sum((edit <> 'D')::BIGINT) OVER w AS j
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)
    ),
    met AS (
        SELECT n.conv_id, n.p, n.edit, n.j, r.role, r.text,
            max((n.j = 1 AND n.edit = 'K' AND r.initial = 's')::BIGINT) OVER (PARTITION BY n.conv_id) AS systems
        FROM numbered n LEFT JOIN marked r ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.i AND n.edit <> 'I'
        WHERE n.edit <> 'D'
    ),
    hashes AS (
        SELECT conv_id, sha256(string_agg(
            CASE WHEN edit = 'K' THEN role WHEN (j - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
            chr(10) ORDER BY p
        )) AS h FROM met GROUP BY conv_id
    )
    SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
        coalesce(h, sha256('')) AS repaired_sha256
    FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id
        LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM b.conv_id
    """
