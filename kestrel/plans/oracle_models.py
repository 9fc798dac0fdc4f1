"""DuckDB CTEs for encoded rows, the clustered regression and the probit: sums in long form, matrices solved by elimination."""

from __future__ import annotations

from collections.abc import Sequence

from kestrel.functions import special
from kestrel.operators import propensity as P

COVARIATES = ("device_type", "traveller_type", "acquisition_channel", "is_logged_in")


def inverse(name: str, entries: str) -> str:
    """``name``_inv(i, j, v): an inverse of the positive semidefinite matrix that ``entries`` (i, j, v; i, j from 1) holds.

    Scaled to a unit diagonal, then Gauss-Jordan elimination beside a unit matrix, one pivot a step; a term that depends
    on those before it is left out.
    """
    return f"""{name}_d AS MATERIALIZED (SELECT i, 1 / sqrt(v) AS d FROM {entries} WHERE i = j),
{name}_r AS MATERIALIZED (
  SELECT e.i, list(e.v * a.d * b.d ORDER BY e.j) AS r FROM {entries} e JOIN {name}_d a ON a.i = e.i JOIN {name}_d b ON b.i = e.j GROUP BY e.i),
{name}_gj AS MATERIALIZED (
  WITH RECURSIVE g AS (
    SELECT 1 AS p, count(*) AS k, list(list_concat(r, [CASE WHEN c = i THEN CAST(1 AS DOUBLE) ELSE 0 END
      for c in range(1, (SELECT count(*) FROM {name}_r) + 1)]) ORDER BY i) AS m FROM {name}_r
    UNION ALL
    SELECT p + 1, k, [CASE WHEN m[p][p] < 1e-9 THEN [CASE WHEN i = p THEN 0 ELSE x END for x in m[i]]
                           WHEN i = p THEN [x / m[p][p] for x in m[p]]
                           ELSE [m[i][j] - m[i][p] * m[p][j] / m[p][p] for j in range(1, 2 * k + 1)] END for i in range(1, k + 1)]
    FROM g WHERE p <= k)
  SELECT k, m FROM g WHERE p = k + 1),
{name}_inv AS MATERIALIZED (
  SELECT a.i, b.i AS j, (SELECT m FROM {name}_gj)[a.i][(SELECT k FROM {name}_gj) + b.i] * a.d * b.d AS v FROM {name}_d a CROSS JOIN {name}_d b)"""


def _terms(numeric: Sequence[str], categorical: Sequence[str], naming: str, src: str, key: str, more: str) -> str:
    """SELECT of (more, term, v): the non-zero terms of a treatment-coded design."""
    parts = [f"SELECT {more}, 'Intercept' AS term, CAST(1 AS DOUBLE) AS v FROM {src}"]
    parts += [f"SELECT {more}, '{c}', CAST({c} AS DOUBLE) FROM {src}" for c in numeric]
    for c in categorical:
        before, after = naming.replace("{0}", c).split("{1}")
        parts.append(f"SELECT {more}, '{before}' || CAST({c} AS VARCHAR) || '{after}', 1 FROM {src} "
                     f"WHERE CAST({c} AS VARCHAR) <> (SELECT min(CAST({c} AS VARCHAR)) FROM {src})")
    return "\n  UNION ALL ".join(parts)


def _dense(name: str, rows: str, key: str, weight: str = "1") -> str:
    """``name``_g(i, j, v): X'WX of the rows (key, i, v and what the weight needs), zeros included."""
    return f"""{name}_g AS MATERIALIZED (
  SELECT a.i, b.i AS j, coalesce(s.v, 0) AS v FROM (SELECT DISTINCT i FROM {rows}) a CROSS JOIN (SELECT DISTINCT i FROM {rows}) b
  LEFT JOIN (SELECT x.i, z.i AS j, sum(x.v * z.v * {weight}) AS v FROM {rows} x JOIN {rows} z ON x.{key} = z.{key} GROUP BY x.i, z.i) s
    ON s.i = a.i AND s.j = b.i)"""


CLUSTERED = f"""lm_src AS MATERIALIZED (
  SELECT *, CASE WHEN experiment_variant = 'variant' THEN 1 ELSE 0 END AS treatment FROM x_cd),
lm_long AS MATERIALIZED (SELECT * FROM (
  {_terms(("treatment", "pre_partner_conversion"), COVARIATES, "{0}[T.{1}]", "lm_src", "session_id", "session_id, partner_id, booked_flag AS y")}
  ) AS l WHERE v <> 0),
lm_t AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY CASE term WHEN 'Intercept' THEN 0 WHEN 'treatment' THEN 1
                        WHEN 'pre_partner_conversion' THEN 2 ELSE 3 END, term) AS i FROM (SELECT DISTINCT term FROM lm_long) AS t),
lm_x AS MATERIALIZED (SELECT l.session_id, l.partner_id, CAST(l.y AS DOUBLE) AS y, t.i, l.v FROM lm_long l JOIN lm_t t ON t.term = l.term),
{_dense("lm", "lm_x", "session_id")},
{inverse("lm", "lm_g")},
lm_b AS MATERIALIZED (
  SELECT n.i, sum(n.v * s.v) AS b FROM lm_inv n JOIN (SELECT i, sum(v * y) AS v FROM lm_x GROUP BY i) s ON s.i = n.j GROUP BY n.i),
lm_e AS MATERIALIZED (
  SELECT session_id, any_value(partner_id) AS partner_id, any_value(y) AS y, any_value(y) - sum(v * b) AS e
  FROM lm_x JOIN lm_b USING (i) GROUP BY session_id),
lm_s AS MATERIALIZED (SELECT e.partner_id AS g, x.i, sum(x.v * e.e) AS s FROM lm_x x JOIN lm_e e USING (session_id) GROUP BY 1, 2),
lm_w AS (SELECT n.j AS i, n.v FROM lm_inv n JOIN lm_t t ON t.i = n.i WHERE t.term = 'treatment'),
lm_n AS (SELECT count(*) AS n, count(DISTINCT partner_id) AS g, sum(e * e) AS ssr, sum(y * y) - pow(sum(y), 2) / count(*) AS sst,
                (SELECT count(*) FROM lm_inv WHERE i = j AND v <> 0) AS k FROM lm_e),
lm_fit AS (
  SELECT (SELECT b FROM lm_b JOIN lm_t USING (i) WHERE term = 'treatment') AS effect,
         sqrt((SELECT sum(pow(w, 2)) FROM (SELECT g, sum(s.s * w.v) AS w FROM lm_s s JOIN lm_w w ON w.i = s.i GROUP BY g) AS c)
              * (CAST(g AS DOUBLE) / (g - 1)) * (CAST(n - 1 AS DOUBLE) / (n - k))) AS se, g, n, 1 - ssr / sst AS r2 FROM lm_n)"""


def encoded() -> str:
    """m_enc(session_id, term, value): the validation rows under the dictionary and the scaling of the training rows."""
    dictionary = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS feature, {c} AS level FROM m_train WHERE {c} IS NOT NULL" for c in P.CATEGORICAL)
    scales = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, "
        f"CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) > 0 THEN stddev_pop(CAST({c} AS DOUBLE)) ELSE 1 END AS scale FROM m_train" for c in P.NUMERIC)
    levels = " UNION ALL ".join(f"SELECT session_id, '{c}' AS feature, {c} AS level FROM m_val" for c in P.CATEGORICAL)
    values = " UNION ALL ".join(f"SELECT session_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM m_val" for c in P.NUMERIC)
    return f"""m_train AS MATERIALIZED (SELECT * FROM m_split WHERE split = 'train'),
m_val AS MATERIALIZED (SELECT * FROM m_split WHERE split = 'validation'),
m_enc AS (
  SELECT session_id, feature || '=' || level AS term, CAST(1 AS DOUBLE) AS value FROM ({levels}) AS l JOIN ({dictionary}) AS d USING (feature, level)
  UNION ALL SELECT session_id, feature, (v - mean) / scale FROM ({values}) AS n JOIN ({scales}) AS s USING (feature) WHERE v IS NOT NULL)"""


def _cdf(x: str) -> str:
    """The normal distribution function by the rational approximation whose coefficients `special` lists."""
    def horner(coefficients: Sequence[float]) -> str:
        out = repr(coefficients[0])
        for c in coefficients[1:]:
            out = f"({out} * abs({x}) + CAST({c!r} AS DOUBLE))"
        return out
    far = f"(abs({x}) + 0.65)"
    for c in (4, 3, 2, 1):
        far = f"(abs({x}) + CAST({c} AS DOUBLE) / {far})"
    e = f"exp(-{x} * {x} / 2)"
    tail = (f"CASE WHEN abs({x}) > 37 THEN 0 WHEN abs({x}) < 7.07106781186547 THEN {e} * {horner(special._TAIL_UP)} / {horner(special._TAIL_DOWN)} "
            f"ELSE {e} / {far} / sqrt(2 * pi()) END")
    return f"CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END"


def probit(categorical: Sequence[str], rounds: int = 9) -> str:
    """pb_fit(term, coefficient, standard_error) of the training rows after so many reweighted rounds."""
    start = f"""pb_src AS MATERIALIZED (SELECT * FROM m_split WHERE split = 'train'),
pb_long AS MATERIALIZED (SELECT * FROM (
  {_terms(P.NUMERIC, categorical, P.PROBIT_NAMES, "pb_src", "session_id", "session_id, booked_flag AS y")}
  ) AS l WHERE v <> 0),
pb_t AS MATERIALIZED (SELECT term, row_number() OVER (ORDER BY term) AS i FROM (SELECT DISTINCT term FROM pb_long) AS t),
pb_x AS MATERIALIZED (SELECT l.session_id, CAST(l.y AS DOUBLE) AS y, t.i, l.v FROM pb_long l JOIN pb_t t ON t.term = l.term),
pb0_b AS (SELECT i, CAST(0 AS DOUBLE) AS b FROM pb_t)"""
    parts = [start]
    for r in range(1, rounds + 1):
        n = f"pb{r}"
        parts.append(f"""{n}_eta AS MATERIALIZED (
  SELECT session_id, any_value(y) AS y, sum(v * b) AS eta FROM pb_x JOIN pb{r - 1}_b USING (i) GROUP BY session_id),
{n}_w AS MATERIALIZED (
  SELECT session_id, pdf * pdf / (mu * (1 - mu)) AS w, (y - mu) / pdf AS z FROM (
    SELECT session_id, y, least(greatest({_cdf('eta')}, 1e-10), 1 - 1e-10) AS mu, greatest(exp(-eta * eta / 2) / sqrt(2 * pi()), 1e-12) AS pdf
    FROM {n}_eta) AS m),
{n}_x AS MATERIALIZED (SELECT x.session_id, x.i, x.v, w.w, w.z FROM pb_x x JOIN {n}_w w USING (session_id)),
{_dense(n, f"{n}_x", "session_id", "x.w")},
{inverse(n, f"{n}_g")},
{n}_b AS MATERIALIZED (
  SELECT o.i, o.b + d.b AS b FROM pb{r - 1}_b o JOIN (
    SELECT v.i, sum(v.v * s.v) AS b FROM {n}_inv v JOIN (SELECT i, sum(v * w * z) AS v FROM {n}_x GROUP BY i) s ON s.i = v.j GROUP BY v.i) d
  ON d.i = o.i)""")
    parts.append(f"""pb_fit AS (
  SELECT t.term, b.b AS coefficient, sqrt(v.v) AS standard_error FROM pb{rounds}_b b JOIN pb_t t ON t.i = b.i
  JOIN pb{rounds}_inv v ON v.i = b.i AND v.j = b.i)""")
    return ",\n".join(parts)
