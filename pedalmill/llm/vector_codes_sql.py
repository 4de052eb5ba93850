"""Comparison SQL of the vector codes: one assignment and one update per round, written out from a rule."""

from __future__ import annotations

from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def _assign(k: int) -> str:
    return f"""near{k} AS MATERIALIZED (
    SELECT r, p, v, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
        SELECT x.r, x.p, x.v, c.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i]))) AS d
        FROM parts x JOIN book{k} c ON x.p = c.p)
    GROUP BY r, p, v
)"""


def _update(k: int) -> str:
    """Entry means, rounded down; unused entries stay."""
    return f"""means{k} AS (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
        SELECT p, e, i, sum(v[i]) AS s, count(*) AS n FROM near{k}, range(1, 1 + (SELECT max(len(v)) FROM parts)) t(i)
        WHERE i <= len(v) GROUP BY p, e, i)
    GROUP BY p, e
), book{k + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} m USING (p, e)
)"""


def comparison_sql() -> str:
    """The whole contract for vectors of one length, a multiple of the parts."""
    rounds = ",\n".join(f"{_assign(k)},\n{_update(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS ints
    FROM embeddings WHERE len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding) AND len(embedding) > 0
), parts AS MATERIALIZED (
    SELECT r, p, ints[p * w + 1:p * w + w] AS v FROM (SELECT r, ints, len(ints) // {PARTS} AS w FROM kept), range({PARTS}) t(p)
), book0 AS (
    SELECT p, r - 1 AS e, v FROM parts WHERE r <= {ENTRIES}
),
{rounds},
{_assign(ROUNDS)},
coded AS (
    SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{ROUNDS} GROUP BY r
), digest AS (
    SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS}
)
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c USING (r), digest d
"""
