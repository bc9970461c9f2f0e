"""The mixture as SQL: what ``mixing.mix`` reads, walked document by document."""

from __future__ import annotations

from lumbung.llm.mixing import LEVELS, Targets


def _case(column: str, table: dict, default: object) -> str:
    text = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    whens = " ".join(f"WHEN '{k}' THEN {text(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {text(default)} END" if table else text(default)


def _fill(depth: int, targets: Targets) -> str:
    """One level of the tree: children in order of capacity per weight."""
    keys, parents = ", ".join(LEVELS[:depth]), LEVELS[: depth - 1]
    group = f"PARTITION BY {', '.join(parents)} " if parents else ""
    order = f"{group}ORDER BY capacity / weight, {keys}"
    budget = (
        f"least(sum(sum(available)) OVER () * {targets.share} // 1000, sum(sum(capacity)) OVER ())"
        if depth == 1 else f"(SELECT amount FROM level{depth - 1} p WHERE {' AND '.join(f'p.{k} = leaves.{k}' for k in parents)})"
    )
    return f"""nodes{depth} AS (
  SELECT {keys}, sum(capacity) AS capacity, sum(available) AS available, max(weight_{LEVELS[depth - 1]}) AS weight, {budget} AS budget
  FROM leaves GROUP BY {keys}),
ranked{depth} AS (
  SELECT *, budget - coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM nodes{depth}),
level{depth} AS (
  SELECT {keys}, available, CASE WHEN capacity * rest <= weight * remaining THEN capacity ELSE
         weight * max(remaining) FILTER (capacity * rest > weight * remaining) OVER ({group})
         // max(rest) FILTER (capacity * rest > weight * remaining) OVER ({group}) END AS amount
  FROM ranked{depth})"""


def mixture_sql(targets: Targets) -> str:
    leaf = ", ".join(LEVELS)
    weights = ", ".join(f"CAST({_case(n, dict(getattr(targets, n)), targets.default)} AS HUGEINT) AS weight_{n}" for n in LEVELS)
    same = " AND ".join(f"d.{n} = p.{n}" for n in LEVELS)
    return f"""
WITH d AS (
  SELECT doc_id, lang AS own_lang, source AS own_source, {_case("coalesce(source, '')", dict(targets.domains), targets.other)} AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens
  FROM documents),
leaves AS (
  SELECT *, available * {targets.epochs} AS capacity, {weights}
  FROM (SELECT {leaf}, CAST(sum(n_tokens) AS HUGEINT) AS available FROM d GROUP BY ALL) WHERE available > 0),
{", ".join(_fill(depth, targets) for depth in (1, 2, 3))},
passes AS (SELECT {leaf}, amount // available AS epochs, amount % available AS rest FROM level3),
keyed AS (
  SELECT d.*, epochs, rest, md5('{targets.seed}:' || CAST(epochs AS VARCHAR) || ':' || id) AS k FROM d JOIN passes p ON {same}),
walked AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY {leaf} ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed)
SELECT doc_id, domain, own_lang AS lang, own_source AS source, n_tokens,
       CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM walked WHERE epochs > 0 OR rest > 0 AND upto <= rest"""
