"""DuckDB text of the regression results: dense least squares on explicit regressors, provider means removed.

Systems are solved by Gauss-Jordan elimination in a recursive query.  Both tails come from one power series.
"""

from __future__ import annotations

from checks.oracle_base import SUBQUERIES
from claimloom.plans.policy import OUTCOMES, PolicyDesign

EFFECTS = ("balanced_panel", "winsorized_99_percent", "unweighted_provider_month")


def eliminated(start: str, keys: str) -> str:
    """Reduced rows ``m`` of each system of ``start`` (keys, number of unknowns ``n``, augmented rows ``m``)."""
    return f"""WITH RECURSIVE reduced AS (SELECT {keys}, n, 0 AS k, m FROM ({start}) s
UNION ALL SELECT {keys}, n, k + 1, list_transform(m, lambda r, i: list_transform(r, lambda v, j:
  CASE WHEN i = k + 1 THEN v / m[k + 1][k + 1] ELSE v - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1] END))
FROM reduced WHERE k < n)
SELECT {keys}, n, m FROM reduced WHERE k = n"""


def tail(freedom: str, statistic: str) -> str:
    """Upper tail of the chi-square distribution; with one degree of freedom of a squared normal value."""
    half, z = f"(({freedom}) / 2.0)", f"least(greatest(({statistic}) / 2.0, 1e-300), 700.0)"
    return (
        f"greatest(1 - list_sum(list_transform(range(0, 1500), lambda i: exp(({half} + i) * ln({z}) - {z} - lgamma({half} + i + 1)))), 0)"
    )


def define(design: PolicyDesign, panel: str = "p_panel") -> None:
    """Adds the estimates of ``panel`` to the sub-queries: ``l_terms`` and ``l_wald``."""
    first, last, placebo = -design.pre_months, design.post_months - 1, -design.placebo_months_before
    columns = []
    for name in (*EFFECTS, "event_study", "placebo"):
        end = -1 if name == "placebo" else last
        terms = {"event_study": [(t, t) for t in range(first, last + 1) if t != -1], "placebo": [(placebo, -1)]}.get(name, [(0, last)])
        columns.append((name, 0, "outcome", 0, 0))
        columns += [(name, n, "treated", *term) for n, term in enumerate(terms, 1)]
        columns += [(name, n, "month", t, t) for n, t in enumerate(range(first + 1, end + 1), len(terms) + 1)]
    key = "outcome_name, specification"
    SUBQUERIES["l_columns"] = (
        "SELECT * FROM (VALUES " + ", ".join(map(str, columns)) + ") v(specification, c, kind, first_time, last_time)"
    )
    SUBQUERIES["l_values"] = f"""SELECT provider_key AS g, event_time AS t, CAST(treatment_indicator AS INTEGER) AS d,
  CAST(greatest(eligible_member_months, 1) AS DOUBLE) AS w, outcome_name, CAST(y AS DOUBLE) AS y
FROM (UNPIVOT (SELECT provider_key, event_time, treatment_indicator, eligible_member_months, {', '.join(OUTCOMES)} FROM {panel})
  ON {', '.join(OUTCOMES)} INTO NAME outcome_name VALUE y) u"""
    SUBQUERIES["l_observed"] = f"""SELECT {key}, g, t, d, CASE WHEN specification = '{EFFECTS[2]}' THEN 1.0::DOUBLE ELSE w END AS w,
  CASE WHEN specification = '{EFFECTS[1]}' THEN least(y, quantile_cont(y, {design.winsor_fraction}) OVER (PARTITION BY {key})) ELSE y END AS y
FROM l_values, (SELECT DISTINCT specification FROM l_columns) s WHERE specification <> 'placebo' OR t < 0"""
    SUBQUERIES["l_design"] = f"""SELECT {key}, g, t, w, c, x - sum(w * x) OVER own / sum(w) OVER own AS x
FROM (SELECT *, CASE WHEN kind = 'outcome' THEN y ELSE CAST(t BETWEEN first_time AND last_time AND (d = 1 OR kind = 'month') AS INTEGER)
    END::DOUBLE AS x FROM l_observed JOIN l_columns USING (specification)) filled
WINDOW own AS (PARTITION BY {key}, g, c)"""
    SUBQUERIES["l_gram"] = f"""SELECT {key}, a.c AS i, b.c AS j, sum(a.w * a.x * b.x) AS v
FROM l_design a JOIN l_design b USING ({key}, g, t) WHERE a.c > 0 GROUP BY ALL"""
    SUBQUERIES["l_solved"] = eliminated(f"""SELECT {key}, count(*) AS n, list(r ORDER BY i) AS m FROM (
  SELECT {key}, i, list_concat(list(v ORDER BY j) FILTER (WHERE j > 0),
    list(CAST(i = j AS INTEGER)::DOUBLE ORDER BY j) FILTER (WHERE j > 0), list(v) FILTER (WHERE j = 0)) AS r
  FROM l_gram GROUP BY {key}, i) augmented GROUP BY {key}""", key)
    SUBQUERIES["l_beta"] = f"SELECT {key}, CAST(i AS INTEGER) AS c, m[i][2 * n + 1] AS b FROM l_solved, range(1, 40) r(i) WHERE i <= n"
    SUBQUERIES["l_inverse"] = f"""SELECT {key}, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS c, m[i][n + j] AS v
FROM l_solved, range(1, 40) r(i), range(1, 40) q(j) WHERE i <= n AND j <= n"""
    SUBQUERIES["l_scores"] = f"""SELECT {key}, g, c, sum(w * e * x) AS s FROM l_design JOIN (
  SELECT {key}, g, t, sum(CASE WHEN c = 0 THEN x ELSE -x * b END) AS e
  FROM l_design LEFT JOIN l_beta USING ({key}, c) GROUP BY {key}, g, t) left_over USING ({key}, g, t)
WHERE c > 0 GROUP BY {key}, g, c"""
    SUBQUERIES["l_influence"] = f"""SELECT {key}, g, i, sum(v * s) AS h FROM l_scores JOIN l_inverse USING ({key}, c)
JOIN (SELECT specification, c AS i FROM l_columns WHERE kind = 'treated') k USING (specification, i) GROUP BY {key}, g, i"""
    SUBQUERIES["l_covariance"] = f"""SELECT {key}, i, j, groups, observations,
  v * groups / (groups - 1.0) * (observations - 1.0) / (observations - groups - n) AS v
FROM (SELECT {key}, a.i AS i, b.i AS j, sum(a.h * b.h) AS v FROM l_influence a JOIN l_influence b USING ({key}, g) GROUP BY ALL) c
JOIN (SELECT {key}, count(DISTINCT g) AS groups, count(*) AS observations FROM l_observed GROUP BY {key}) o USING ({key})
JOIN (SELECT {key}, n FROM l_solved) w USING ({key})"""
    SUBQUERIES["l_terms"] = f"""SELECT {key}, first_time AS event_time, b, se, groups, observations,
  {tail('1', 'b * b / (se * se)')} AS p
FROM (SELECT {key}, i AS c, sqrt(v) AS se, groups, observations FROM l_covariance WHERE i = j) e
JOIN l_beta USING ({key}, c) JOIN l_columns USING (specification, c)"""
    leads = -first - 1
    SUBQUERIES["l_wald"] = f"""SELECT outcome_name, statistic, {tail(str(leads), 'statistic')} AS p FROM (
  SELECT outcome_name, sum(b * m[c][n + 1]) AS statistic FROM ({eliminated(f'''
    SELECT outcome_name, count(*) AS n, list(list_append(r, b) ORDER BY c) AS m FROM (
      SELECT outcome_name, i AS c, list(v ORDER BY j) AS r FROM l_covariance
      WHERE specification = 'event_study' AND i <= {leads} AND j <= {leads} GROUP BY outcome_name, i) rows
    JOIN (SELECT outcome_name, c, b FROM l_beta WHERE specification = 'event_study') t USING (outcome_name, c) GROUP BY outcome_name''',
    'outcome_name')}) solved JOIN (SELECT outcome_name, c, b FROM l_beta WHERE specification = 'event_study') t USING (outcome_name)
  WHERE c <= n GROUP BY outcome_name) w"""
