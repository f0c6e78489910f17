"""SQL for the registered queries, written against the tables and not the engine."""

from __future__ import annotations

_EVENT_ROWS = """events_keyed AS (
  SELECT event_type AS store_nbr, user_id % 20 AS item_nbr,
         concat_ws('_', event_type, CAST(user_id % 20 AS VARCHAR)) AS group_id,
         event_id, ts, CAST(ts AS DATE) AS ds, value AS y
  FROM events)"""

_EVENT_SERIES = f"""{_EVENT_ROWS},
series AS (SELECT group_id, ds, sum(y) AS y FROM events_keyed GROUP BY ALL)"""

_EVENT_GAPS = f"""{_EVENT_ROWS},
series AS (
  SELECT group_id, ds,
         CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN NULL ELSE y END AS y
  FROM (SELECT *, store_nbr AS event_type FROM events_keyed))"""

_SHIPPED = """series AS (
  SELECT concat_ws('_', l_returnflag, l_linestatus) AS group_id,
         CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y
  FROM lineitem GROUP BY ALL)"""

_ORDERS = """series AS (
  SELECT concat_ws('_', CAST(c_nationkey AS VARCHAR), o_orderpriority) AS group_id,
         CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_ORDERS_MONTHLY = _ORDERS.replace(
    "CAST(o_orderdate AS DATE) AS ds", "last_day(CAST(o_orderdate AS DATE)) AS ds"
)

_FIRST_DAY = "DATE '1970-01-01'"

_PROFILE = """SELECT group_id, count(*) AS n_rows, count(*) - count(y) AS n_missing,
  min(ds) AS first_ds, max(ds) AS last_ds FROM {table} GROUP BY group_id"""


def _line_fit(table: str = "series") -> str:
    """One least-squares line per series with at least two usable dates."""
    t = f"ds - {_FIRST_DAY}"
    return f"""fit AS (
  SELECT group_id, regr_slope(y, {t}) AS slope, regr_intercept(y, {t}) AS intercept,
         max(ds) AS last_ds
  FROM {table} GROUP BY group_id
  HAVING count(DISTINCT ds) FILTER (WHERE y IS NOT NULL) >= 2)"""


def _line_forecast(series: str, digits: int = 6, step: str = "last_ds + CAST(h AS INTEGER)") -> str:
    return f"""WITH {series}, {_line_fit()},
grid AS (SELECT *, CAST({step} AS DATE) AS ds FROM fit, range(1, 8) AS g(h))
SELECT group_id, 'LinearTrend' AS model_name, ds,
       round(intercept + slope * (ds - {_FIRST_DAY}), {digits}) AS y_pred
FROM grid"""


def _line_forecast_with_history(series: str, digits: int = 6) -> str:
    return f"""WITH {series}, {_line_fit()},
grid AS (
  SELECT DISTINCT group_id, ds FROM series
  UNION ALL
  SELECT group_id, CAST(last_ds + CAST(h AS INTEGER) AS DATE) FROM fit, range(1, 8) AS g(h))
SELECT group_id, 'LinearTrend' AS model_name, ds,
       round(intercept + slope * (ds - {_FIRST_DAY}), {digits}) AS y_pred
FROM grid JOIN fit USING (group_id)"""


def _phase_forecast(model: str, value: str) -> str:
    """Forecast from the history rows a whole number of weeks earlier."""
    return f"""SELECT g.group_id, '{model}' AS model_name, g.ds, round({value}, 6) AS y_pred
FROM grid g LEFT JOIN series s
  ON s.group_id = g.group_id AND s.ds < g.ds AND (g.ds - s.ds) % 7 = 0
GROUP BY g.group_id, g.ds"""


_HORIZON = """grid AS (
  SELECT group_id, CAST(last_ds + CAST(h AS INTEGER) AS DATE) AS ds
  FROM (SELECT group_id, max(ds) AS last_ds FROM series GROUP BY group_id), range(1, 8) AS g(h))"""

_NAIVE = _phase_forecast("SeasonalNaive", "max_by(s.y, s.ds)")
_WEEKDAY = _phase_forecast("WeekdayProfile", "avg(s.y)")


def _shifted_line(model: str, level: str, default: str, history: bool) -> str:
    """Shared slope, one intercept per level: a line with indicator columns.

    Dates of a level the series has never seen fall back to ``default``.
    """
    past = "SELECT group_id, ds FROM series UNION ALL" if history else ""
    return f"""WITH {_SHIPPED},
levelled AS (SELECT *, {level} AS level, ds - {_FIRST_DAY} AS t FROM series),
centres AS (SELECT group_id, level, avg(y) AS mean_y, avg(t) AS mean_t
            FROM levelled GROUP BY ALL),
slopes AS (
  SELECT group_id, sum((t - mean_t) * (y - mean_y)) / sum((t - mean_t) * (t - mean_t)) AS slope,
         max(ds) AS last_ds
  FROM levelled JOIN centres USING (group_id, level) GROUP BY group_id),
dates AS ({past}
  SELECT group_id, CAST(last_ds + CAST(h AS INTEGER) AS DATE) AS ds
  FROM slopes, range(1, 8) AS g(h)),
grid AS (SELECT *, {level} AS level FROM dates)
SELECT g.group_id, '{model}' AS model_name, g.ds,
       round(coalesce(c.mean_y, d.mean_y)
             + slope * (g.ds - {_FIRST_DAY} - coalesce(c.mean_t, d.mean_t)), 6) AS y_pred
FROM grid g JOIN slopes s ON s.group_id = g.group_id
LEFT JOIN centres c ON c.group_id = g.group_id AND c.level = g.level
LEFT JOIN centres d ON d.group_id = g.group_id AND d.level = {default}"""


_HOLIDAY_LEVEL = """CASE WHEN strftime(ds, '%m-%d') = '01-01' THEN 'new_year'
  WHEN strftime(ds, '%m-%d') = '07-01' THEN 'mid_year' ELSE 'none' END"""

def _logistic(growth: str = "0") -> str:
    """A cap above the largest target, plus what it has grown by on the date."""
    return f"""WITH {_SHIPPED},
capped AS (SELECT *, 1.2 * max(y) OVER (PARTITION BY group_id) + {growth} AS cap FROM series),
shares AS (SELECT *, y / cap AS share FROM capped),
logits AS (SELECT group_id, ds, cap, ln(share / (1 - share)) AS y FROM shares),
{_line_fit("logits")},
caps AS (SELECT group_id, max_by(cap, ds) AS cap FROM capped GROUP BY group_id),
grid AS (SELECT *, CAST(last_ds + CAST(h AS INTEGER) AS DATE) AS ds FROM fit, range(1, 8) AS g(h))
SELECT group_id, 'logistic' AS model_name, ds,
       round(cap / (1 + exp(-(intercept + slope * (ds - {_FIRST_DAY})))), 6) AS y_pred
FROM grid JOIN caps USING (group_id)"""


_EARLY = f"""{_SHIPPED},
design AS (SELECT group_id, y, CAST(ds - {_FIRST_DAY} AS DOUBLE) AS t,
  CAST(day(ds) <= 5 AS DOUBLE) AS early FROM series)"""


def _entries(columns: list[str], table: str, digits: int) -> str:
    """Every product of two columns, and of a column with the target, summed."""
    return " UNION ALL ".join(
        f"""SELECT group_id, CAST({i} AS INTEGER) AS i, CAST({j} AS INTEGER) AS j,
  round(sum(({a}) * ({b})), {digits}) AS value FROM {table} GROUP BY group_id"""
        for i, a in enumerate(columns)
        for j, b in enumerate([*columns, "y"])
    )


_HINGES = """days AS (
  SELECT group_id, y, CAST(ds - min(ds) OVER (PARTITION BY group_id) AS DOUBLE) AS t FROM series),
reach AS (SELECT group_id, max(t) * CAST(0.8 AS DOUBLE) AS reach FROM days GROUP BY group_id),
knots AS (SELECT DISTINCT group_id, floor(reach * k / {count}) AS s
          FROM reach, range(1, {count} + 1) AS r(k))"""

_HOURS = f"""{_EVENT_ROWS},
clock AS (SELECT group_id, y, 2 * pi() * hour(ts) / 24 AS a,
  CAST((epoch(date_trunc('hour', ts)) - epoch(TIMESTAMP '2024-01-01')) / 86400 AS DOUBLE) AS d
  FROM events_keyed),
hours AS (SELECT *, d - min(d) OVER (PARTITION BY group_id) AS t FROM clock)"""


# Rolling-origin windows: 7 steps, every 7, over the last 30.

_WINDOWS = """bounds AS (SELECT group_id, max(ds) AS last_ds FROM series GROUP BY group_id),
cutoffs AS (
  SELECT group_id, k, CAST(last_ds - 29 + 7 * k AS DATE) AS cutoff,
         CAST(last_ds - 29 + 7 * k + 7 AS DATE) AS test_end
  FROM bounds, (SELECT CAST(k AS INTEGER) AS k FROM range(0, 4) AS w(k)))"""

_MONTH_WINDOWS = """bounds AS (SELECT group_id, max(ds) AS last_ds FROM series GROUP BY group_id),
cutoffs AS (
  SELECT group_id, last_day(last_ds + to_months(CAST(2 * k - 11 AS INTEGER))) AS cutoff,
         last_day(last_ds + to_months(CAST(2 * k - 8 AS INTEGER))) AS test_end
  FROM bounds, range(0, 5) AS w(k))"""


def _split(length: int) -> str:
    return f"""actual AS (
  SELECT c.group_id, cutoff, ds, y FROM cutoffs c JOIN series s
    ON s.group_id = c.group_id AND ds >= cutoff AND ds < test_end),
full_windows AS (
  SELECT group_id, cutoff FROM actual GROUP BY ALL HAVING count(*) >= {length}),
train AS (
  SELECT c.group_id, cutoff, ds, y FROM full_windows c JOIN series s
    ON s.group_id = c.group_id AND ds < cutoff)"""


_SMAPE = """avg(CASE WHEN y = 0 AND p = 0 THEN 0
  ELSE 2 * abs(y - p) / (abs(y) + abs(p)) END)"""
_MAPE = "avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16))"
_RMSE = "sqrt(avg((y - p) * (y - p)))"


def _scores(model: str, metric: str, value: str, status: str = "ok") -> str:
    return f"""SELECT group_id AS unique_id, '{model}' AS model_name, cutoff,
  '{metric}' AS metric_name, round({value}, 6) AS metric_value, '{status}' AS status
FROM (SELECT a.group_id, a.cutoff, coalesce(a.y, 0) AS y, coalesce(p.p, 0) AS p
      FROM actual a JOIN predictions p USING (group_id, cutoff, ds))
GROUP BY group_id, cutoff"""


def _line_windows(grid: str, length: int) -> str:
    return f"""fits AS (
  SELECT group_id, cutoff, regr_slope(y, ds - cutoff) AS slope,
         regr_intercept(y, ds - cutoff) AS intercept, max(ds) AS last_train,
         count(DISTINCT ds) FILTER (WHERE y IS NOT NULL) AS n_dates
  FROM train GROUP BY ALL),
predictions AS (
  SELECT group_id, cutoff, CAST({grid} AS DATE) AS ds,
         intercept + slope * (CAST({grid} AS DATE) - cutoff) AS p
  FROM fits, (SELECT CAST(h AS INTEGER) AS h FROM range(1, {length + 1}) AS g(h))
  WHERE n_dates >= 2)"""


def _failed(model: str, metric: str) -> str:
    return f"""SELECT group_id AS unique_id, '{model}' AS model_name, cutoff,
  '{metric}' AS metric_name, CAST('inf' AS DOUBLE) AS metric_value, 'error' AS status
FROM fits WHERE n_dates < 2"""


def _line_backtest(series: str, metrics: dict[str, str] | None = None, model="LinearTrend") -> str:
    scores = [
        f"{_scores(model, name, value)} UNION ALL {_failed(model, name)}"
        for name, value in (metrics or {"smape": _SMAPE}).items()
    ]
    return f"""WITH {series}, {_WINDOWS}, {_split(7)},
{_line_windows("last_train + h", 7)}
{" UNION ALL ".join(scores)}"""


def _phase_windows(value: str) -> str:
    """Predictions from training rows a whole number of weeks before the date."""
    return f"""(SELECT l.group_id, l.cutoff, l.last_train + h AS ds, {value} AS p
   FROM (SELECT group_id, cutoff, max(ds) AS last_train FROM train GROUP BY ALL) l
   CROSS JOIN (SELECT CAST(h AS INTEGER) AS h FROM range(1, 8) AS g(h))
   LEFT JOIN train t ON t.group_id = l.group_id AND t.cutoff = l.cutoff
     AND (l.last_train + h - t.ds) % 7 = 0
   GROUP BY ALL)"""


def _phase_scores(model: str, value: str) -> str:
    return _scores(model, "smape", _SMAPE).replace(
        "JOIN predictions p", f"JOIN {_phase_windows(value)} p"
    )


_MONTH_END = "last_day(last_ds + to_months(CAST(h AS INTEGER)))"

ORACLE: dict[str, str] = {
    "table_scan_count": """SELECT source, n_rows FROM (SELECT count(*) AS n_rows FROM events),
  (VALUES ('path'), ('table'), ('sql')) AS s(source)""",
    "scan_three_part": """SELECT event_type, count(*) AS n_rows, max(event_id) AS last_id
FROM events GROUP BY event_type""",
    "preview_rows": """SELECT event_id, user_id, event_type, value FROM events
ORDER BY event_id LIMIT 5""",
    "series_key": """SELECT concat_ws('_', store_nbr, CAST(item_nbr AS VARCHAR)) AS group_id,
  store_nbr, item_nbr, count(*) AS n_rows
FROM (SELECT DISTINCT event_type, user_id % 20 AS item_nbr,
             CASE WHEN user_id % 20 <> 0 THEN event_type END AS store_nbr, CAST(ts AS DATE) AS ds
      FROM events)
GROUP BY ALL""",
    "series_profile": f"""WITH {_EVENT_SERIES}, shipped AS (
  SELECT * FROM (WITH {_SHIPPED} SELECT * FROM series))
SELECT 'events' AS series, * FROM ({_PROFILE.format(table="series")})
UNION ALL
SELECT 'shipped' AS series, * FROM ({_PROFILE.format(table="shipped")})""",
    "quality_missing_ratio": f"""WITH {_EVENT_GAPS}
SELECT group_id, count(*) AS n_rows, count(*) - count(y) AS n_missing,
  round((count(*) - count(y)) / count(*), 6) AS missing_ratio,
  (count(*) - count(y)) / count(*) <= 0.2 AS kept
FROM series GROUP BY group_id""",
    "quality_kept_rows": f"""WITH {_EVENT_GAPS}
SELECT group_id, ds, y FROM series WHERE group_id IN (
  SELECT group_id FROM series GROUP BY group_id
  HAVING (count(*) - count(y)) / count(*) <= 0.2)""",
    "quality_removed_series": f"""WITH {_EVENT_GAPS}
SELECT group_id, count(*) AS n_rows, count(*) - count(y) AS n_missing,
  round((count(*) - count(y)) / count(*), 6) AS missing_ratio
FROM series GROUP BY group_id HAVING (count(*) - count(y)) / count(*) > 0.2""",
    "quality_filtered_forecast": _line_forecast(
        f"""{_EVENT_GAPS.replace("series AS", "all_series AS")},
series AS (SELECT * FROM all_series WHERE group_id IN (
  SELECT group_id FROM all_series GROUP BY group_id
  HAVING (count(*) - count(y)) / count(*) <= 0.2))"""
    ),
    "global_last_date": "SELECT max(CAST(ts AS DATE)) AS last_ds FROM events",
    "step_offsets": """SELECT ds, ds + 1 AS d_1, ds - 29 AS d_back_29, ds + 21 AS w_3,
  CASE WHEN ds = last_day(ds) THEN last_day(ds + INTERVAL 1 MONTH) ELSE last_day(ds) END AS m_1,
  CASE WHEN ds = last_day(ds) THEN last_day(ds + INTERVAL 7 MONTH)
       ELSE last_day(ds + INTERVAL 6 MONTH) END AS m_7,
  last_day(ds - INTERVAL 2 MONTH) AS m_back_2,
  CAST(ds AS TIMESTAMP) + INTERVAL 31 HOUR AS h_31
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS ds FROM orders)""",
    "future_grid": f"""WITH {_EVENT_SERIES}
SELECT group_id, CAST(h AS INTEGER) AS h, CAST(max(ds) + CAST(h AS INTEGER) AS DATE) AS ds
FROM series, range(1, 8) AS g(h) GROUP BY group_id, h""",
    "future_grid_by_frequency": f"""WITH {_EVENT_ROWS},
last AS (SELECT group_id, max(ds) AS ds, date_trunc('hour', max(ts)) AS ts
         FROM events_keyed GROUP BY group_id),
steps AS (SELECT CAST(h AS INTEGER) AS h FROM range(1, 6) AS g(h))
SELECT group_id, h, 'D' AS freq, CAST(ds + h AS TIMESTAMP) AS ds FROM last, steps
UNION ALL SELECT group_id, h, 'W', CAST(ds + 7 * h AS TIMESTAMP) FROM last, steps
UNION ALL SELECT group_id, h, 'M', CAST(last_day(last_day(ds) + to_months(h)) AS TIMESTAMP)
FROM last, steps
UNION ALL SELECT group_id, h, 'H', CAST(ts + to_hours(h) AS TIMESTAMP) FROM last, steps""",
    "resample_spine": f"""WITH {_ORDERS},
spine AS (
  SELECT group_id, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM series GROUP BY group_id)
SELECT group_id, ds, round(sum(y), 2) AS y
FROM spine LEFT JOIN series USING (group_id, ds) GROUP BY ALL""",
    "series_from_join": """SELECT concat_ws('_', CAST(n_regionkey AS VARCHAR), p_brand) AS group_id,
  CAST(l_shipdate AS DATE) AS ds, count(*) AS n_rows, count(l_extendedprice) AS n_obs,
  round(sum(l_extendedprice), 2) AS sum_y
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
GROUP BY ALL""",
    "design_moments": f"""WITH {_EARLY}
{_entries(["1", "t", "early"], "design", 4)}""",
    "solve_moments": f"""WITH {_EARLY},
centres AS (SELECT group_id, early, avg(y) AS y, avg(t) AS t FROM design GROUP BY ALL),
slopes AS (
  SELECT d.group_id, min(d.t) AS origin,
    sum((d.t - c.t) * (d.y - c.y)) / sum((d.t - c.t) * (d.t - c.t)) AS slope
  FROM design d JOIN centres c ON c.group_id = d.group_id AND c.early = d.early
  GROUP BY d.group_id)
SELECT s.group_id, round(o.y + slope * (origin - o.t), 6) AS level, round(slope, 6) AS slope,
  round(e.y - o.y - slope * (e.t - o.t), 6) AS effect, true AS settled
FROM slopes s JOIN centres o ON o.group_id = s.group_id AND o.early = 0
JOIN centres e ON e.group_id = s.group_id AND e.early = 1""",
    "hinge_moments": f"""WITH {_SHIPPED}, {_HINGES.format(count=5)},
basis AS (
  SELECT DISTINCT group_id, 0 AS i, CAST(NULL AS DOUBLE) AS s FROM days
  UNION ALL SELECT DISTINCT group_id, 1, -1 FROM days
  UNION ALL SELECT group_id, 1 + row_number() OVER (PARTITION BY group_id ORDER BY s), s FROM knots),
x AS (
  SELECT group_id, i, t, y, CASE i WHEN 0 THEN 1 WHEN 1 THEN t ELSE greatest(t - s, 0) END AS x
  FROM days JOIN basis USING (group_id))
SELECT a.group_id, CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j,
  round(sum(a.x * b.x), 4) AS value
FROM x a JOIN x b ON a.group_id = b.group_id AND a.t = b.t GROUP BY ALL
UNION ALL
SELECT group_id, CAST(i AS INTEGER), CAST(2 + n AS INTEGER), round(sum(x * y), 4)
FROM x JOIN (SELECT group_id, count(*) AS n FROM knots GROUP BY group_id) USING (group_id)
GROUP BY ALL""",
    "fourier_moments": f"""WITH {_HOURS}
{_entries(
    ["1", "t", *[f"sin({m} * a)" for m in range(1, 5)], *[f"cos({m} * a)" for m in range(1, 5)]],
    "hours", 6,
)}""",
    "forecast_changepoint": f"""WITH {_SHIPPED}, {_HINGES.format(count=1)},
bent AS (
  SELECT group_id, y, t, greatest(t - s, 0) AS h, s FROM days JOIN knots USING (group_id)),
fits AS (
  SELECT group_id, any_value(s) AS s, avg(y) AS my, avg(t) AS mt, avg(h) AS mh,
    var_pop(t) AS tt, covar_pop(t, h) AS th, var_pop(h) AS hh, covar_pop(t, y) AS ty,
    covar_pop(h, y) AS hy, max(t) AS last_t
  FROM bent GROUP BY group_id),
lines AS (
  SELECT *, (ty * hh - hy * th) / (tt * hh - th * th) AS slope,
    (tt * hy - th * ty) / (tt * hh - th * th) AS bend
  FROM fits),
last AS (SELECT group_id, max(ds) AS last_ds FROM series GROUP BY group_id)
SELECT group_id, CAST(last_ds + CAST(k AS INTEGER) AS DATE) AS ds,
  round(my + slope * (last_t + k - mt) + bend * (last_t + k - s - mh), 6) AS y_pred
FROM lines JOIN last USING (group_id), range(1, 8) AS g(k)""",
    "forecast_linear": _line_forecast(_EVENT_SERIES),
    "forecast_linear_with_history": _line_forecast_with_history(_EVENT_SERIES),
    "forecast_linear_interval": f"""WITH {_EVENT_SERIES}, {_line_fit()},
spread AS (
  SELECT s.group_id, count(y) AS n, avg(ds - {_FIRST_DAY}) FILTER (WHERE y IS NOT NULL) AS mean_t,
    sum((y - intercept - slope * (ds - {_FIRST_DAY})) ** 2) AS rest
  FROM series s JOIN fit USING (group_id) GROUP BY ALL),
wide AS (
  SELECT s.group_id, sum((ds - {_FIRST_DAY} - mean_t) ** 2) FILTER (WHERE y IS NOT NULL) AS sxx
  FROM series s JOIN spread USING (group_id) GROUP BY ALL),
grid AS (SELECT *, CAST(last_ds + CAST(h AS INTEGER) AS DATE) AS ds
  FROM fit JOIN spread USING (group_id) JOIN wide USING (group_id), range(1, 8) AS g(h)),
lines AS (
  SELECT *, intercept + slope * (ds - {_FIRST_DAY}) AS p, CASE WHEN n > 2 THEN
    1.2815515655446004 * sqrt(rest / (n - 2) * (1 + 1 / n + (ds - {_FIRST_DAY} - mean_t) ** 2 / sxx))
    END AS half
  FROM grid)
SELECT group_id, 'LinearTrend' AS model_name, ds, round(p, 6) AS y_pred,
  round(p - half, 5) AS y_lower, round(p + half, 5) AS y_upper FROM lines""",
    "forecast_linear_monthly": _line_forecast(_ORDERS_MONTHLY, 2, _MONTH_END),
    "forecast_resampled": f"""WITH {_ORDERS},
daily AS (SELECT group_id, ds, sum(y) AS y FROM series GROUP BY ALL),
{_line_fit("daily")},
grid AS (
  SELECT group_id, CAST(unnest(generate_series(min(ds), max(ds) + 7, INTERVAL 1 DAY)) AS DATE) AS ds
  FROM series GROUP BY group_id)
SELECT group_id, 'LinearTrend' AS model_name, ds,
       round(intercept + slope * (ds - {_FIRST_DAY}), 2) AS y_pred
FROM grid JOIN fit USING (group_id)""",
    "forecast_seasonal_naive": f"WITH {_EVENT_SERIES}, {_HORIZON} {_NAIVE}",
    "forecast_all_models": f"""SELECT * FROM ({_line_forecast(_EVENT_SERIES)})
UNION ALL SELECT * FROM (WITH {_EVENT_SERIES}, {_HORIZON} {_NAIVE})
UNION ALL SELECT * FROM (WITH {_EVENT_SERIES}, {_HORIZON} {_WEEKDAY})""",
    "forecast_logistic": _logistic(),
    "forecast_logistic_growing_cap": _logistic("0.25 * (ds - DATE '1990-01-01')"),
    "forecast_holiday_effect": _shifted_line("holiday", _HOLIDAY_LEVEL, "'none'", True),
    "forecast_regressor": _shifted_line("regressor", "day(ds) <= 5", "false", False),
    "forecast_weekly_seasonality": _shifted_line("weekly", "dayofweek(ds)", "0", True),
    "forecast_logistic_shares": f"""WITH RECURSIVE {_SHIPPED},
caps AS (SELECT group_id, max(y) AS cap, min(ds) AS first_ds, max(ds) AS last_ds
  FROM series GROUP BY group_id),
shares AS (
  SELECT group_id, CASE WHEN day(ds) % 2 = 0 THEN 0 ELSE y / cap END AS z,
    (ds - first_ds) / (last_ds - first_ds) AS u
  FROM series JOIN caps USING (group_id)),
newton AS (
  SELECT group_id, 0 AS i, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM caps
  UNION ALL
  SELECT group_id, i + 1, a + (ga * huu - gu * hu) / (h * huu - hu * hu),
    b + (gu * h - ga * hu) / (h * huu - hu * hu)
  FROM (
    SELECT group_id, i, a, b, sum(z - p) AS ga, sum((z - p) * u) AS gu,
      sum(p * (1 - p)) AS h, sum(p * (1 - p) * u) AS hu, sum(p * (1 - p) * u * u) AS huu
    FROM (SELECT *, 1 / (1 + exp(-a - b * u)) AS p FROM newton JOIN shares USING (group_id))
    WHERE i < 25 GROUP BY group_id, i, a, b))
SELECT group_id, 'LogisticTrend' AS model_name, CAST(last_ds + CAST(k AS INTEGER) AS DATE) AS ds,
  round(cap / (1 + exp(-a - b * (last_ds - first_ds + k) / (last_ds - first_ds))), 6) AS y_pred
FROM newton JOIN caps USING (group_id), range(1, 8) AS g(k) WHERE i = 25""",
    # Trend and week by turns; three harmonics and a level are a free week.
    "forecast_multiplicative": f"""WITH RECURSIVE {_SHIPPED},
days AS (
  SELECT group_id, dayofweek(ds) AS w, y,
    (ds - min(ds) OVER (PARTITION BY group_id)) / 1000 AS u
  FROM series),
turns AS (
  SELECT DISTINCT group_id, w, 0 AS i, CAST(1 AS DOUBLE) AS g, CAST(0 AS DOUBLE) AS a,
    CAST(0 AS DOUBLE) AS b
  FROM days
  UNION ALL
  SELECT group_id, w, i + 1, sum((a2 + b2 * u) * y) / sum((a2 + b2 * u) * (a2 + b2 * u)), a2, b2
  FROM (
    SELECT *, (gy * uu - uy * gu) / (gg * uu - gu * gu) AS a2,
      (gg * uy - gu * gy) / (gg * uu - gu * gu) AS b2
    FROM (
      SELECT group_id, w, i, u, y, sum(g * g) OVER s AS gg, sum(g * g * u) OVER s AS gu,
        sum(g * g * u * u) OVER s AS uu, sum(g * y) OVER s AS gy, sum(g * y * u) OVER s AS uy
      FROM turns JOIN days USING (group_id, w) WHERE i < 60
      WINDOW s AS (PARTITION BY group_id)))
  GROUP BY group_id, w, i, a2, b2),
grid AS (
  SELECT group_id, CAST(max(ds) + CAST(k AS INTEGER) AS DATE) AS ds,
    (max(ds) - min(ds) + k) / 1000 AS u
  FROM series, range(1, 8) AS s(k) GROUP BY group_id, k)
SELECT group_id, 'MultiplicativeSeason' AS model_name, ds, round((a + b * u) * g, 3) AS y_pred
FROM grid JOIN turns USING (group_id) WHERE i = 60 AND w = dayofweek(ds)""",
    "forecast_output_stamped": f"""SELECT *, 'fixed-run' AS run_id
FROM ({_line_forecast(_EVENT_SERIES)})""",
    "forecast_failures": f"""WITH {_EVENT_SERIES},
short AS (SELECT group_id FROM series GROUP BY group_id HAVING count(*) < 2
          UNION ALL SELECT 'single_0')
SELECT group_id, model_name FROM short, (VALUES ('LinearTrend'), ('plain')) AS m(model_name)""",
    "failures_shapeless": f"""WITH {_EVENT_SERIES},
ways AS (SELECT group_id, count(*) % 5 AS way FROM series GROUP BY group_id)
SELECT group_id, 'OftenShapeless' AS model_name,
  CASE way WHEN 1 THEN 'forecast lacks columns [''y_pred'']'
    WHEN 2 THEN 'forecast holds [''str''] in y_pred'
    WHEN 3 THEN 'forecast repeats dates'
    ELSE 'forecast gave Series, not a frame' END AS error
FROM ways WHERE way > 0""",
    "forecast_job_output": f"""SELECT *, 'fixed-run' AS run_id
FROM ({_line_forecast(_EVENT_SERIES)})""",
    "forecast_undated_series": f"""WITH {_EVENT_ROWS}
SELECT group_id, 'LinearTrend' AS model_name,
  CASE WHEN item_nbr = 3 THEN 'missing date' ELSE 'fewer than two usable dates' END AS error
FROM events_keyed GROUP BY group_id, item_nbr
HAVING item_nbr = 3 OR count(DISTINCT ds) < 2""",
    "backtest_resampled": f"""WITH {_ORDERS_MONTHLY.replace("series AS", "monthly AS")},
series AS (SELECT group_id, ds, sum(y) AS y FROM monthly GROUP BY ALL),
{_MONTH_WINDOWS}, {_split(3)},
{_line_windows("last_day(cutoff + to_months(h - 1))", 3)}
{_scores("LinearTrend", "smape", _SMAPE)} UNION ALL {_failed("LinearTrend", "smape")}""",
    "backtest_missing_targets": _line_backtest(
        f"""{_EVENT_ROWS}, series AS (SELECT group_id, ds,
  CASE WHEN event_id % 3 = 0 OR event_id % 7 = 0 THEN NULL ELSE y END AS y FROM events_keyed)"""
    ),
    "backtest_common_start": f"""WITH {_SHIPPED},
bounds AS (SELECT group_id, max(ds) AS last_ds FROM series GROUP BY group_id),
cutoffs AS (
  SELECT group_id, CAST(cutoff AS DATE) AS cutoff, CAST(cutoff AS DATE) + 7 AS test_end
  FROM bounds, unnest(generate_series(
    DATE '1995-05-01', last_ds - 6, INTERVAL 28 DAY)) AS w(cutoff)),
{_split(7)}, {_line_windows("last_train + h", 7)}
{_scores("LinearTrend", "smape", _SMAPE)} UNION ALL {_failed("LinearTrend", "smape")}
UNION ALL {_phase_scores("SeasonalNaive", "max_by(t.y, t.ds)")}""",
    "backtest_failed_windows": f"""SELECT *,
  CASE WHEN status = 'error' THEN 'fewer than two usable dates' END AS error
FROM ({_line_backtest(f"""{_EVENT_SERIES.replace("series AS", "full_series AS")},
series AS (SELECT group_id, ds,
  CASE WHEN ds > max(ds) OVER (PARTITION BY group_id) - 20 THEN y END AS y FROM full_series)""")})""",
    "backtest_job_output": f"""SELECT *, 'fixed-run' AS run_id
FROM ({_line_backtest(_SHIPPED)})""",
    "backtest_cutoffs": f"""WITH {_EVENT_SERIES}, {_WINDOWS}
SELECT group_id, k, cutoff, test_end FROM cutoffs""",
    "backtest_train_stats": f"""WITH {_EVENT_SERIES}, {_WINDOWS}
SELECT c.group_id, cutoff, count(*) AS n_train, round(sum(y), 6) AS sum_y, max(ds) AS last_train
FROM cutoffs c JOIN series s ON s.group_id = c.group_id AND ds < cutoff
GROUP BY c.group_id, cutoff""",
    "backtest_actuals": f"""WITH {_EVENT_SERIES}, {_WINDOWS}
SELECT c.group_id, cutoff, count(*) AS n_actual, round(sum(y), 6) AS sum_y
FROM cutoffs c JOIN series s ON s.group_id = c.group_id AND ds >= cutoff AND ds < test_end
GROUP BY c.group_id, cutoff HAVING count(*) >= 7""",
    "backtest_smape": _line_backtest(_EVENT_SERIES),
    "backtest_smape_cumulative": _line_backtest(_SHIPPED),
    "backtest_all_models": f"""SELECT * FROM ({_line_backtest(_EVENT_SERIES)})
UNION ALL SELECT * FROM (WITH {_EVENT_SERIES}, {_WINDOWS}, {_split(7)}
  {_phase_scores("SeasonalNaive", "max_by(t.y, t.ds)")}
  UNION ALL {_phase_scores("WeekdayProfile", "avg(t.y)")})""",
    "backtest_per_series": _line_backtest(_EVENT_SERIES),
    "backtest_duplicate_dates": _line_backtest(
        f"{_EVENT_ROWS}, series AS (SELECT group_id, ds, y FROM events_keyed)"
    ),
    "backtest_other_metrics": f"""SELECT * FROM ({_line_backtest(
        _SHIPPED, {"mape": _MAPE, "rmse": _RMSE}
    )}) UNION ALL SELECT * FROM (WITH {_SHIPPED}, {_WINDOWS}, {_split(7)},
{_line_windows("last_train + h", 7)}
{_scores("LinearTrend", "unheard_of", "CAST('nan' AS DOUBLE)", "unsupported_metric")})""",
    "backtest_monthly": f"""WITH {_ORDERS_MONTHLY}, {_MONTH_WINDOWS}, {_split(3)},
{_line_windows("last_day(last_train + to_months(h))", 3)}
{_scores("LinearTrend", "smape", _SMAPE)} UNION ALL {_failed("LinearTrend", "smape")}""",
}
