"""Oracle SQL text (DuckDB dialect, ANSI where possible) for the registered queries.

Conventions shared with the Spark side: doubles rounded to 6 digits, counts
as BIGINT, every computed column aliased to the Spark name, numeric
literals cast to DOUBLE (DuckDB reads ``0.5`` as DECIMAL).
"""

from __future__ import annotations

from riskloom.operators.split import SplitConfig, split_oracle_sql
from riskloom.sources.cases import CASES_SQL, FIXED_SCORE_SQL


def rnd6(expr: str) -> str:
    """floor(x * 1e6 + 0.5) / 1e6: the same IEEE steps in every engine (round() differs at exact ties)."""
    x = f"CAST({expr} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) < 1e12 THEN floor({x} * 1000000.0 + 0.5) / 1000000.0 ELSE {x} END)"


def r6(expr: str, name: str) -> str:
    return f"{rnd6(expr)} AS {name}"


def with_cases(body: str, extra_ctes: str = "") -> str:
    ctes = f"cases AS ({CASES_SQL})"
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def split_cte() -> str:
    return f"split_cases AS ({split_oracle_sql('SELECT * FROM cases', 'case_id', 'target', SplitConfig())})"


def scored_cte() -> str:
    return (split_cte() + ",\nscored AS (SELECT case_id, target, split, "
            + FIXED_SCORE_SQL + " AS score FROM split_cases)")


def quantile_sql(long_rel: str, group: str, value: str, probs: list[float], name: str = "quantile") -> str:
    """Exact linear quantiles with the same arithmetic as the Spark side.
    ``long_rel`` must expose columns (group, value); output (group, q_index, q, quantile)."""
    vals = ", ".join(f"({i}, CAST({float(p)!r} AS DOUBLE))" for i, p in enumerate(probs))
    return f"""(
  WITH _v AS (
    SELECT {group} AS _g, CAST({value} AS DOUBLE) AS _x,
           row_number() OVER (PARTITION BY {group} ORDER BY {value}) - 1 AS _r,
           count(*) OVER (PARTITION BY {group}) AS _n
    FROM {long_rel} WHERE {value} IS NOT NULL
  ), _p AS (
    SELECT g._g, p.q_index, p.q, CAST(g._n - 1 AS DOUBLE) * p.q AS _h
    FROM (SELECT DISTINCT _g, _n FROM _v) g, (VALUES {vals}) p(q_index, q)
  )
  SELECT _p._g AS {group}, _p.q_index, _p.q, lo._x + (hi._x - lo._x) * (_p._h - floor(_p._h)) AS {name}
  FROM _p JOIN _v lo ON lo._g = _p._g AND lo._r = CAST(floor(_p._h) AS BIGINT)
          JOIN _v hi ON hi._g = _p._g AND hi._r = CAST(ceil(_p._h) AS BIGINT)
)"""


def metrics_sql(src: str, group: str | None, threshold: str = "CAST(0.5 AS DOUBLE)",
                y: str = "target", s: str = "score") -> str:
    """K12 from a relation with (group, y, s): same formulas as the Spark side."""
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    grp = f"GROUP BY {group}" if group else ""
    return f"""(
  WITH _sc AS (
    SELECT {g}{s} AS s, CAST(sum(CASE WHEN {y} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
           CAST(sum(CASE WHEN {y} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg
    FROM {src} GROUP BY {g}{s}
  ), _rt AS (
    SELECT *, CAST(sum(pos) OVER ({part}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_pos,
              CAST(sum(neg) OVER ({part}ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cum_neg,
              CAST(sum(pos) OVER ({part.strip()}) AS DOUBLE) AS tot_pos, CAST(sum(neg) OVER ({part.strip()}) AS DOUBLE) AS tot_neg
    FROM _sc
  ), _a AS (
    SELECT {g}max(tot_pos) AS P, max(tot_neg) AS N,
           sum(neg * (cum_pos - pos + pos / 2.0)) AS auc_num,
           sum(pos * (cum_pos / (cum_pos + cum_neg))) AS ap_num,
           max(abs(cum_pos / tot_pos - cum_neg / tot_neg)) AS ks,
           sum(pos * (s - 1.0) * (s - 1.0) + neg * s * s) AS sq,
           CAST(sum(CASE WHEN s >= {threshold} THEN pos ELSE 0 END) AS DOUBLE) AS tp,
           CAST(sum(CASE WHEN s >= {threshold} THEN neg ELSE 0 END) AS DOUBLE) AS fp
    FROM _rt {grp}
  )
  SELECT {g}CAST(P + N AS BIGINT) AS row_count, P / (P + N) AS positive_rate,
         CAST({threshold} AS DOUBLE) AS threshold,
         ap_num / P AS average_precision, auc_num / (P * N) AS roc_auc, ks AS ks_statistic,
         sq / (P + N) AS brier_score, (tp + (N - fp)) / (P + N) AS accuracy,
         coalesce(tp / nullif(tp + fp, 0), 0.0) AS precision,
         coalesce(tp / nullif(P, 0), 0.0) AS recall,
         coalesce(2.0 * tp / nullif(2.0 * tp + fp + (P - tp), 0), 0.0) AS f1,
         CAST(N - fp AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, CAST(P - tp AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp,
         coalesce((N - fp) / nullif(N, 0), 0.0) AS actual_0_pred_0,
         coalesce(fp / nullif(N, 0), 0.0) AS actual_0_pred_1,
         coalesce((P - tp) / nullif(P, 0), 0.0) AS actual_1_pred_0,
         coalesce(tp / nullif(P, 0), 0.0) AS actual_1_pred_1
  FROM _a
)"""


METRIC_DOUBLES = ["positive_rate", "threshold", "average_precision", "roc_auc", "ks_statistic", "brier_score",
                  "accuracy", "precision", "recall", "f1", "actual_0_pred_0", "actual_0_pred_1",
                  "actual_1_pred_0", "actual_1_pred_1"]
METRIC_LONGS = ["row_count", "tn", "fp", "fn", "tp"]


def round_select(rel: str, keep: list[str], doubles: list[str]) -> str:
    cols = keep + [r6(c, c) for c in doubles]
    return f"SELECT {', '.join(cols)} FROM {rel} _x"
