"""DuckDB SQL text for the oracle check, one string per registered query.

The views ``lineitem documents embeddings ...`` are registered by the checker.
Column names and types match the Spark side: counts are cast to BIGINT, centre
indexes to INTEGER and every float is ``round(..., 6)``.
"""

from __future__ import annotations

from ..functions.random import uniform_sql
from ..operators import kmedian
from . import catalog as Q
from .cluster_sql import assign_cte, fit_ctes, lloyd_ctes, merge_reduce_ctes, with_ctes
from .catalog import SUM_SQ_SCALE, THRESHOLD

_MAX = "(SELECT max(l_extendedprice) FROM lineitem)"
_TOKENS = "(SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)"
_WC = f"SELECT word, count(*)::BIGINT AS n FROM {_TOKENS} GROUP BY word"
_Z = f"(SELECT l_extendedprice / {_MAX} AS z FROM lineitem)"

SQL: dict[str, str] = {
    "num_sum_squares": f"SELECT round(sum(l_extendedprice * l_extendedprice) / {SUM_SQ_SCALE}, 6) AS sum_sq"
                       " FROM lineitem",
    "num_max": "SELECT max(l_extendedprice) AS max_value FROM lineitem",
    "num_normalized": f"SELECT l_orderkey, l_linenumber, round(l_extendedprice / {_MAX}, 6) AS z FROM lineitem",
    "num_stats": (
        "SELECT count(z)::BIGINT AS n, round(avg(z), 6) AS mean, round(var_pop(z) * count(z), 6) AS m2,"
        " round(stddev_pop(z), 6) AS stddev_pop, round(max(z), 6) AS max_value,"
        f" round(min(z), 6) AS min_value FROM {_Z}"
    ),
    "num_over_half": f"SELECT count(*) FILTER (WHERE z > {THRESHOLD})::BIGINT AS n FROM {_Z}",
    "wc_per_doc": f"SELECT doc_id, word, count(*)::BIGINT AS n FROM {_TOKENS} GROUP BY doc_id, word",
    "wc_direct": _WC,
    "wc_salted": _WC,
    "wc_partition": _WC,
    "wc_grouped": _WC,
    "wc_distinct": f"SELECT count(DISTINCT word)::BIGINT AS n FROM {_TOKENS}",
    "wc_tokens": "SELECT sum(len(string_split(text, ' ')))::BIGINT AS n FROM documents",
    "doc_count": "SELECT count(*)::BIGINT AS n FROM documents",
    "wc_avg_len": f"SELECT round(avg(length(word)), 6) AS avg_len FROM (SELECT DISTINCT word FROM {_TOKENS})",
}


# --------------------------------------------------------------------------- vectors

_PTS = "pts AS (SELECT 0 AS g, vec_id AS id, embedding::DOUBLE[] AS x, 1.0::DOUBLE AS w, label FROM embeddings)"
# label centres: mean embedding per label, c = rank of the label
_CEN = [
    _PTS,
    "lab AS (SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS c"
    " FROM (SELECT DISTINCT label FROM pts))",
    "lmean AS (SELECT label, pos, avg(v) AS v FROM ("
    "SELECT label, unnest(x) AS v, unnest(range(len(x))) AS pos FROM pts) GROUP BY label, pos)",
    "cen AS (SELECT 0 AS g, lab.c, list(lmean.v ORDER BY lmean.pos) AS y FROM lab JOIN lmean USING (label)"
    " GROUP BY lab.c)",
    assign_cte("pts", "cen", "asg"),
]


def _long(cen: str) -> str:
    return (f"SELECT c::INTEGER AS c, pos::INTEGER AS pos, round(v, 6) AS v FROM ("
            f"SELECT c, unnest(y) AS v, unnest(range(len(y))) AS pos FROM {cen})")


def _scan_sql() -> str:
    return ("SELECT vec_id, len(embedding)::INTEGER AS dim, round(list_sum(embedding::DOUBLE[]), 6) AS sum_x"
            " FROM embeddings")


def _seed_sql() -> str:
    ctes, _ = fit_ctes("pts", Q.KPP_K, 0, Q.SEED, False, "k")
    return with_ctes([_PTS] + ctes, "SELECT c::INTEGER AS step, id AS vec_id FROM kseeds")


def _fit_sql(objective: bool) -> str:
    ctes, final = fit_ctes("pts", Q.KPP_K, Q.FIT_ITERATIONS, Q.SEED, False, "k")
    ctes = [_PTS] + ctes
    if not objective:
        return with_ctes(ctes, _long(final))
    ctes.append(assign_cte("pts", final, "fa"))
    return with_ctes(ctes, "SELECT round(avg(d), 6) AS objective FROM fa")


_PARTS = (f"nparts AS (SELECT greatest({Q.CORESET_MIN_PARTS}, ceil(count(*) * (max(len(embedding)) + {Q.CORESET_K}"
          f" + 2) * 8 / {kmedian.TARGET_PART_BYTES}))::BIGINT AS L FROM embeddings)")
_CORE_PTS = (f"cpts AS (SELECT least(floor({uniform_sql('vec_id', str(Q.SEED))} * (SELECT L FROM nparts))::BIGINT,"
             " (SELECT L FROM nparts) - 1) AS g, vec_id AS id, embedding::DOUBLE[] AS x, 1.0::DOUBLE AS w FROM embeddings)")


def _coreset_ctes() -> tuple[list[str], str]:
    ctes, final = fit_ctes("cpts", Q.CORESET_K, Q.CORESET_ITERATIONS, Q.SEED, True, "r1")
    ctes = [_PARTS, _CORE_PTS] + ctes + [
        assign_cte("cpts", final, "r1fa"),
        f"core AS (SELECT q.g AS part, q.c, q.y, count(a.id)::DOUBLE AS w FROM {final} q"
        " LEFT JOIN r1fa a ON a.g = q.g AND a.c = q.c GROUP BY q.g, q.c, q.y)",
    ]
    return ctes, "core"


def _coreset_sql() -> str:
    ctes, core = _coreset_ctes()
    return with_ctes(ctes, f"SELECT part::BIGINT AS part, c::INTEGER AS c, round(w, 6) AS w,"
                           f" round(list_sum(y), 6) AS sum_y FROM {core}")


def _block_ctes() -> tuple[list[str], str]:
    """Merge-and-reduce over parts of at most ``CORESET_BLOCK * 2 ** 5`` points."""
    ctes, core = merge_reduce_ctes("cpts", Q.CORESET_K, 2 * Q.CORESET_K, Q.CORESET_BLOCK, Q.CORESET_ITERATIONS, Q.SEED, 5)
    return [_PARTS, _CORE_PTS] + ctes, core


def _coreset_blocks_sql() -> str:
    ctes, core = _block_ctes()
    return with_ctes(ctes, f"SELECT part::BIGINT AS part, c::INTEGER AS c, round(w, 6) AS w,"
                           f" round(list_sum(y), 6) AS sum_y FROM {core}")


def _mr_kmedian_sql(blocks: bool = False) -> str:
    ctes, core = _block_ctes() if blocks else _coreset_ctes()
    ctes.append(f"r2pts AS (SELECT 0 AS g, part * {Q.CORESET_K} + c AS id, y AS x, w FROM {core})")
    c2, final = fit_ctes("r2pts", Q.CORESET_K, Q.CORESET_ITERATIONS, Q.SEED, False, "r2")
    ctes += c2
    ctes.append(_PTS)
    ctes.append(assign_cte("pts", final, "r3"))
    return with_ctes(ctes, "SELECT round(avg(d), 6) AS objective FROM r3")


SQL.update({
    "num_scan": "SELECT l_extendedprice AS x, count(*)::BIGINT AS n FROM lineitem GROUP BY l_extendedprice",
    "page_sums": (f"SELECT (idx // {Q.PAGE_SIZE})::BIGINT AS page, min(vec_id)::BIGINT AS first_id, sum(vec_id)::BIGINT AS sum_id,"
                  " count(*)::BIGINT AS n FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM embeddings)"
                  " GROUP BY 1"),
    "vec_scan": _scan_sql(),
    "vec_scan_ws": _scan_sql(),
    "vec_distance": with_ctes(_CEN[:4], "SELECT p.id AS vec_id, q.c, round(list_distance(p.x, q.y), 6) AS d"
                                        " FROM pts p JOIN lab l ON p.label = l.label JOIN cen q ON q.c = l.c"),
    "vec_assign": with_ctes(_CEN, "SELECT id AS vec_id, c, round(d, 6) AS d FROM asg"),
    "vec_min_distance_update": with_ctes(_CEN, "SELECT id AS vec_id, round(d, 6) AS d FROM asg"),
    "vec_weights": with_ctes(_CEN, (
        f"SELECT pp.part::BIGINT AS part, q.c, count(a.id)::BIGINT AS w"
        f" FROM (SELECT DISTINCT id % {Q.WEIGHT_PARTS} AS part FROM pts) pp CROSS JOIN cen q"
        f" LEFT JOIN asg a ON a.c = q.c AND a.id % {Q.WEIGHT_PARTS} = pp.part GROUP BY pp.part, q.c")),
    "vec_objective": with_ctes(_CEN, "SELECT round(avg(d), 6) AS objective FROM asg"),
    "vec_weighted_mean": with_ctes([_PTS], (
        "SELECT label, pos::INTEGER AS pos, round(sum(w * v) / sum(w), 6) AS v FROM ("
        "SELECT label, (vec_id % 5 + 1)::DOUBLE AS w, unnest(x) AS v, unnest(range(len(x))) AS pos"
        " FROM (SELECT id AS vec_id, label, x FROM pts)) GROUP BY label, pos")),
    "pick_race": with_ctes(_CEN, (
        f"SELECT id AS vec_id FROM asg WHERE d > 0"
        f" ORDER BY ln({uniform_sql('id', str(Q.SEED), str(Q.RACE_ROUND))}) / d DESC, id LIMIT 1")),
    "pick_prefix": with_ctes(_CEN + [
        "run AS (SELECT id, sum(d) OVER (ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r,"
        " sum(d) OVER () AS tot FROM asg WHERE d > 0)"],
        f"SELECT coalesce(min(id) FILTER (WHERE r > {Q.PREFIX_FRAC} * tot), max(id)) AS vec_id FROM run"),
    "seed_kpp": _seed_sql(),
    "lloyd_step": with_ctes(_CEN[:4] + lloyd_ctes("pts", "cen", 1, "l")[0], _long("lc1")),
    "kmeans_fit": _fit_sql(objective=False),
    "kmeans_objective": _fit_sql(objective=True),
    "kmedian_coreset": _coreset_sql(),
    "mr_kmedian": _mr_kmedian_sql(),
    "kmedian_coreset_blocks": _coreset_blocks_sql(),
    "mr_kmedian_blocks": _mr_kmedian_sql(blocks=True),
    "row_index": "SELECT (row_number() OVER (ORDER BY vec_id) - 1)::BIGINT AS idx, vec_id FROM embeddings",
    "page_rows": (f"SELECT idx, vec_id FROM (SELECT (row_number() OVER (ORDER BY vec_id) - 1)::BIGINT AS idx,"
                  f" vec_id FROM embeddings) WHERE idx >= {Q.PAGE_START} AND idx < {Q.PAGE_END}"),
})

_LINES = "(SELECT regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g') AS value FROM documents)"
SQL.update({
    "page_pull": SQL["page_sums"].replace(f"// {Q.PAGE_SIZE})", f"// {Q.PULL_SIZE})"),
    "text_lines": ("SELECT count(*)::BIGINT AS n, 0::BIGINT AS first_no, (count(*) * (count(*) - 1) // 2)::BIGINT AS sum_no, count(*)::BIGINT AS n_no,"
                   f" sum(length(value))::BIGINT AS n_chars, count(DISTINCT value)::BIGINT AS n_texts FROM {_LINES}"),
    "vec_mean_exact": SQL["vec_weighted_mean"],
    "vec_assign_blocks": SQL["vec_assign"],
    "lloyd_step_blocks": SQL["lloyd_step"],
    "kmeans_fit_bounds": SQL["kmeans_fit"],
    "kmeans_fit_cached": SQL["kmeans_fit"],
})
