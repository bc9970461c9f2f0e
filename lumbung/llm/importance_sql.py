"""The draw of ``importance.resample`` over single words as DuckDB SQL."""

from __future__ import annotations

from lumbung.llm.sql_crc32 import crc32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def resample_sql(buckets: int = 10_000, seed: int = 2024, least_words: int = 20, percent: int = 10) -> str:
    def words(table: str, key: str) -> str:
        found = f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}')"
        return f"SELECT {key} AS k, w, count(*) AS n FROM (SELECT {key}, unnest({found}) AS w FROM {table}) GROUP BY ALL"

    return f"""
    WITH own AS ({words("documents", "doc_id")}),
    theirs AS ({words("benchmark", "item_id")}),
    vocabulary AS (
        SELECT w, ({crc32("w")} % {buckets})::BIGINT AS bucket
        FROM (SELECT w FROM own UNION SELECT w FROM theirs)
    ),
    s AS (SELECT bucket, sum(n)::DOUBLE AS n FROM own JOIN vocabulary USING (w) GROUP BY bucket),
    t AS (SELECT bucket, sum(n)::DOUBLE AS n FROM theirs JOIN vocabulary USING (w) GROUP BY bucket),
    totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
    gains AS (
        SELECT s.bucket, floor(1000 * ln(
            (coalesce(t.n, 0) + 1) * (s_all + {buckets}) / ((s.n + 1) * (t_all + {buckets}))
        ))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket), totals
    ),
    weights AS (
        SELECT k AS doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
        FROM own JOIN vocabulary USING (w) JOIN gains USING (bucket) GROUP BY k
    ),
    scored AS (
        SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln(
                (('0x' || sha256('{seed}:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE
            )))::BIGINT AS score
        FROM documents d LEFT JOIN weights w ON d.doc_id = w.doc_id
    ),
    ranked AS (
        SELECT *, CASE WHEN n_features >= {least_words} THEN row_number() OVER (
            PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id
        ) END AS place, count(*) FILTER (n_features >= {least_words}) OVER () AS n
        FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= {percent} * n // 100 THEN place END AS rank FROM ranked
    """
