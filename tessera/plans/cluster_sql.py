"""DuckDB SQL text builders for the clustering oracles.

The seeding rounds and Lloyd steps are iterative, so the SQL is *unrolled*:
one CTE per round, generated from the same parameters the Spark query uses.
Every builder works per group ``g`` so the same text serves the whole point set
(one group) and the per-part coreset (one group per part).

Input CTE contract: ``(g, id, x DOUBLE[], w DOUBLE)``.
"""

from __future__ import annotations

from ..functions.random import uniform_sql


def _u(seed: int, r: int, per_part: bool) -> str:
    parts = ["id", str(seed), "g", str(r)] if per_part else ["id", str(seed), str(r)]
    return uniform_sql(*parts)


def seeding_ctes(src: str, k: int, seed: int, per_part: bool, prefix: str, weighted: bool = False) -> tuple[list[str], str]:
    """CTEs drawing k seeds per group (``weighted``: by w·d, the first by w); returns (ctes, name of the seeds CTE (g, c, id, y))."""
    first, mass = (" / w", "(w * d)") if weighted else ("", "d")
    ctes = [
        f"{prefix}s0 AS (SELECT g, 0 AS step, id, x FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY g ORDER BY ln({_u(seed, 0, per_part)}){first} DESC, id) AS rn"
        f" FROM {src}{' WHERE w > 0' if weighted else ''}) WHERE rn = 1)"
    ]
    prev_d = None
    for r in range(1, k):
        if prev_d is None:
            dexpr = "list_distance(p.x, s.x)"
            base = src
        else:
            dexpr = "least(p.d, list_distance(p.x, s.x))"
            base = prev_d
        ctes.append(
            f"{prefix}d{r} AS (SELECT p.g, p.id, p.x, p.w, {dexpr} AS d FROM {base} p"
            f" JOIN {prefix}s{r - 1} s USING (g))"
        )
        ctes.append(
            f"{prefix}s{r} AS (SELECT g, {r} AS step, id, x FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY g ORDER BY ln({_u(seed, r, per_part)}) / {mass} DESC, id)"
            f" AS rn FROM {prefix}d{r} WHERE {mass} > 0) WHERE rn = 1)"
        )
        prev_d = f"{prefix}d{r}"
    union = " UNION ALL ".join(f"SELECT g, step, id, x FROM {prefix}s{r}" for r in range(k))
    ctes.append(f"{prefix}seeds AS (SELECT g, step::INTEGER AS c, id, x AS y FROM ({union}))")
    return ctes, f"{prefix}seeds"


def assign_cte(src: str, cen: str, name: str) -> str:
    """Nearest centre per point (ties → lowest c): ``(g, id, x, w, c, d)``."""
    return (
        f"{name} AS (SELECT g, id, x, w, c, d FROM ("
        f"SELECT p.g, p.id, p.x, p.w, q.c, list_distance(p.x, q.y) AS d,"
        f" row_number() OVER (PARTITION BY p.g, p.id ORDER BY list_distance(p.x, q.y), q.c) AS rn"
        f" FROM {src} p JOIN {cen} q USING (g)) WHERE rn = 1)"
    )


def lloyd_ctes(src: str, cen: str, iterations: int, prefix: str) -> tuple[list[str], str]:
    """``iterations`` damped weighted Lloyd steps; returns (ctes, final centres CTE (g, c, y))."""
    ctes: list[str] = []
    cur = cen
    for i in range(iterations):
        a, m, o, nxt = f"{prefix}a{i}", f"{prefix}m{i}", f"{prefix}o{i}", f"{prefix}c{i + 1}"
        ctes.append(assign_cte(src, cur, a))
        ctes.append(
            f"{m} AS (SELECT g, c, pos, sum(w * v) AS s, sum(w) AS sw FROM ("
            f"SELECT g, c, w, unnest(x) AS v, unnest(range(len(x))) AS pos FROM {a}) GROUP BY g, c, pos)"
        )
        ctes.append(
            f"{o} AS (SELECT g, c, unnest(y) AS v, unnest(range(len(y))) AS pos FROM {cur})"
        )
        ctes.append(
            f"{nxt} AS (SELECT o.g, o.c, list((o.v + coalesce(m.s, 0)) / (1 + coalesce(m.sw, 0))"
            f" ORDER BY o.pos) AS y FROM {o} o LEFT JOIN {m} m USING (g, c, pos) GROUP BY o.g, o.c)"
        )
        cur = nxt
    return ctes, cur


def fit_ctes(src: str, k: int, iterations: int, seed: int, per_part: bool,
             prefix: str, weighted: bool = False) -> tuple[list[str], str]:
    """Seeding + Lloyd; returns (ctes, final centres CTE (g, c, y))."""
    s_ctes, seeds = seeding_ctes(src, k, seed, per_part, prefix, weighted)
    cen0 = f"{prefix}c0"
    s_ctes.append(f"{cen0} AS (SELECT g, c, y FROM {seeds})")
    l_ctes, final = lloyd_ctes(src, cen0, iterations, prefix)
    return s_ctes + l_ctes, final


def merge_reduce_ctes(src: str, k: int, size: int, block: int, iterations: int, seed: int, levels: int) -> tuple[list[str], str]:
    """Merge-and-reduce coresets of the groups of ``src``, of at most ``block * 2 ** levels`` points each; returns (ctes, core (part, c, y, w))."""
    def reduced(pts: str, n: int, prefix: str) -> list[str]:
        ctes, final = fit_ctes(pts, n, iterations, seed, True, prefix, weighted=True)
        return [*ctes, assign_cte(pts, final, f"{prefix}asg"),
                f"{prefix}core AS (SELECT q.g, q.c, q.y, coalesce(sum(a.w), 0) AS w FROM {final} q LEFT JOIN {prefix}asg a"
                f" ON a.g = q.g AND a.c = q.c GROUP BY q.g, q.c, q.y)"]

    ctes = [f"mb AS (SELECT g AS part, (row_number() OVER (PARTITION BY g ORDER BY id, x) - 1) // {block} AS node, id, x, 1.0::DOUBLE AS w FROM {src})",
            "m0p AS (SELECT part || ':0:' || node AS g, part, node, id, x, w FROM mb)"]
    ctes += reduced("m0p", size, "m0")
    ctes.append("m0t AS (SELECT part, node, c, y, w FROM m0core JOIN (SELECT DISTINCT g, part, node FROM m0p) USING (g))")
    for i in range(1, levels + 1):
        ctes.append(f"m{i}i AS (SELECT part, node >> 1 AS node, (node & 1) * {size} + c AS id, c, y, w,"
                    f" min(node) OVER t <> max(node) OVER t AS two FROM m{i - 1}t WINDOW t AS (PARTITION BY part, node >> 1))")
        ctes.append(f"m{i}p AS (SELECT part || ':{i}:' || node AS g, part, node, id, y AS x, w FROM m{i}i WHERE two)")
        ctes += reduced(f"m{i}p", size, f"m{i}")
        ctes.append(f"m{i}t AS (SELECT part, node, c, y, w FROM m{i}core JOIN (SELECT DISTINCT g, part, node FROM m{i}p) USING (g)"
                    f" UNION ALL SELECT part, node, c, y, w FROM m{i}i WHERE NOT two)")
    ctes.append(f"mtp AS (SELECT part || ':-1:0' AS g, part, c AS id, y AS x, w FROM m{levels}t)")
    ctes += reduced("mtp", k, "mt")
    ctes.append("mcore AS (SELECT part, c, y, w FROM mtcore JOIN (SELECT DISTINCT g, part FROM mtp) USING (g))")
    return ctes, "mcore"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
