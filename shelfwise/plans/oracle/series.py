from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, REV, X, case, growth, m, n, share, star

_D = "CAST(round({0}, 2) AS DOUBLE)"
_O = "ORDER BY week_end_date"
_ALL = f"({_O} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"


def roll(v: str, k: int, d: int = 2, part: str = "") -> str:
    over = f"({part} {_O} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return H(f"sum({v}) OVER {over}::DOUBLE / count({v}) OVER {over}", d)


star("ts1_weekly_series", f""", w AS (SELECT week_end_date, year, quarter, month, week_of_year, is_holiday_season,
  round(sum(spend), 2) AS r, {m("total_units=weekly_units", "total_visits=weekly_visits", "avg_discount_pct:4")}
  FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), r::DOUBLE AS weekly_revenue, lag(r::DOUBLE) OVER ({_O}) AS prev_week_revenue,
  lead(r::DOUBLE) OVER ({_O}) AS next_week_revenue, (r - lag(r) OVER ({_O}))::DOUBLE AS wow_revenue_delta,
  {growth("r", f"lag(r) OVER ({_O})")} AS wow_revenue_pct, {roll("r", 4)} AS rolling_4w_avg_revenue,
  {roll("r", 12)} AS rolling_12w_avg_revenue, {roll("r", 52)} AS rolling_52w_avg_revenue,
  (sum(r) OVER ({_O}))::DOUBLE AS cumulative_revenue, lag(r::DOUBLE, 52) OVER ({_O}) AS same_week_last_year,
  {growth("r", f"lag(r, 52) OVER ({_O})")} AS yoy_weekly_growth_pct,
  first_value(r::DOUBLE) OVER {_ALL} AS first_week_revenue, last_value(r::DOUBLE) OVER {_ALL} AS last_week_revenue
FROM w""")

CW = """, w AS (SELECT week_end_date, category, sum(spend) AS r, round(sum(spend), 2) AS r2 FROM ef GROUP BY ALL)
"""
_PC = "PARTITION BY category"
star("ts2_category_rolling", CW + f"""SELECT week_end_date, category, r2::DOUBLE AS weekly_revenue,
  {roll("r", 4, 2, _PC)} AS cat_rolling_4w_avg, {roll("r", 12, 2, _PC)} AS cat_rolling_12w_avg,
  {share("r", "week_end_date")} AS pct_of_weekly_portfolio FROM w""")

star("ts3_seasonal_index", f""", w AS (SELECT week_end_date, year, week_num, month_name, round(sum(spend), 2) AS r
  FROM ef GROUP BY ALL), a AS (SELECT sum(r)::DOUBLE / count(*) AS a FROM w)
SELECT week_num, month_name, count(DISTINCT year) AS years_observed,
  {H("sum(r)::DOUBLE / count(*)", 2)} AS avg_revenue_this_week, min(r)::DOUBLE AS min_revenue_this_week,
  max(r)::DOUBLE AS max_revenue_this_week, {H("stddev_samp(r::DOUBLE)", 2)} AS stddev_revenue,
  {H("sum(r)::DOUBLE / count(*) / any_value(a)", 4)} AS seasonal_index FROM w, a GROUP BY 1, 2""")

star("ts4_weekly_anomalies", f""", w AS (SELECT week_end_date, year, month_name, is_holiday_season,
  round(sum(spend), 2) AS r, sum(units)::BIGINT AS weekly_units FROM ef GROUP BY ALL),
s AS (SELECT sum(r)::DOUBLE / count(*) AS mu, stddev_samp(r::DOUBLE) AS sd FROM w)
SELECT w.* EXCLUDE (r), r::DOUBLE AS weekly_revenue, {H("mu", 2)} AS mean_revenue, {H("sd", 2)} AS stddev_revenue,
  {H("(r::DOUBLE - mu) / sd", 4)} AS z_score,
  CASE WHEN abs((r::DOUBLE - mu) / sd) > 2 THEN '{L.ANOMALY}' ELSE '{L.NORMAL}' END AS anomaly_flag FROM w, s""")

_CATS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
_LAGS = ", ".join(f"lag(r::DOUBLE, {k}) OVER ({_O}) AS lag_{k}w_revenue" for k in (1, 4, 13, 52))
_SPLIT = ", ".join(f"coalesce(sum(spend) FILTER (WHERE category = '{c}'), 0)::DOUBLE AS {c.lower()}_revenue" for c in _CATS)
star("ts5_model_features", f""", w AS (SELECT week_end_date, year, quarter, month, week_num, week_of_year,
  is_holiday_season, sum(spend) AS r, {m("total_units", "avg_discount_pct:4", "feature_rows=feature_count",
  "display_rows=display_count", "tpr_rows=tpr_only_count", "promoted_rows=promo_rows")}, {_SPLIT}
  FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), r::DOUBLE AS total_revenue, {_LAGS}, {roll("r", 4, 4)} AS rolling_4w_mean,
  {roll("r", 12, 4)} AS rolling_12w_mean,
  {H(f"stddev_samp(r::DOUBLE) OVER ({_O} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)", 4)} AS rolling_12w_std FROM w""")

star("w1_three_ranks", f"""SELECT category, description, {m("total_revenue")},
  row_number() OVER ({_PC} ORDER BY sum(spend) DESC, description) AS row_num_in_category,
  rank() OVER ({_PC} ORDER BY sum(spend) DESC) AS rank_in_category,
  dense_rank() OVER ({_PC} ORDER BY sum(spend) DESC) AS dense_rank_in_category FROM ef GROUP BY category, description""")

star("w2_store_tiers", f""", r AS (SELECT ef.store_num::BIGINT AS store_num, store_name, seg_value_name,
  sum(spend) AS r FROM ef GROUP BY ef.store_num, store_name, seg_value_name),
t AS (SELECT *, ntile(4) OVER (ORDER BY r DESC, store_num) AS revenue_quartile,
  ntile(10) OVER (ORDER BY r DESC, store_num) AS revenue_decile FROM r)
SELECT * EXCLUDE (r), {X("r", 2)} AS total_revenue, {case("revenue_quartile", L.STORE_TIERS)} AS store_tier FROM t""")

_W = f"OVER ({_PC} {_O})"
star("w3_category_lags", CW + f"""SELECT week_end_date, category, r2::DOUBLE AS weekly_revenue,
  lag(r2::DOUBLE) {_W} AS prev_week_revenue, lag(r2::DOUBLE, 4) {_W} AS revenue_4w_ago,
  lag(r2::DOUBLE, 52) {_W} AS revenue_52w_ago, lead(r2::DOUBLE) {_W} AS next_week_revenue,
  (r2 - lag(r2) {_W})::DOUBLE AS wow_delta, {growth("r2", f"lag(r2) {_W}")} AS wow_pct_change FROM w""")

_TOT = ", w AS (SELECT week_end_date, round(sum(spend), 2) AS r FROM ef GROUP BY 1)\n"
_NO = "datediff('day', DATE '1970-01-03', week_end_date) // 7"


def _week(f: str, x: str, first: str, last: str, part: str = "category") -> str:
    return f"{f}({x}) OVER (PARTITION BY {part} ORDER BY {_NO} RANGE BETWEEN {first} AND {last})"


def _ago(x: str, k: int, part: str = "category") -> str:
    return _week("max", x, f"{k} PRECEDING", f"{k} PRECEDING", part)


def _avg(k: int, part: str = "category") -> str:
    f = lambda name: _week(name, "r", f"{k - 1} PRECEDING", "CURRENT ROW", part)
    return H(f"{f('sum')}::DOUBLE / {f('count')}", 2)


star("w3_calendar_lags", CW + f"""SELECT week_end_date, category, r2::DOUBLE AS weekly_revenue,
  {_ago("r2::DOUBLE", 1)} AS prev_week_revenue, {_ago("r2::DOUBLE", 4)} AS revenue_4w_ago,
  {_ago("r2::DOUBLE", 52)} AS revenue_52w_ago, {_week("max", "r2::DOUBLE", "1 FOLLOWING", "1 FOLLOWING")} AS next_week_revenue,
  {growth("r2", _ago("r2", 1))} AS wow_pct_change FROM w""")
_SC = "store_num, category"
star("ts1_calendar_series", f""", w AS (SELECT week_end_date, ef.store_num::BIGINT AS store_num, category, sum(spend) AS r,
  round(sum(spend), 2) AS r2 FROM ef GROUP BY ALL)
SELECT week_end_date, store_num, category, r2::DOUBLE AS weekly_revenue, {_ago("r2::DOUBLE", 1, _SC)} AS prev_week_revenue,
  {_ago("r2::DOUBLE", 52, _SC)} AS same_week_last_year, {_avg(4, _SC)} AS rolling_4w_avg_revenue,
  {_avg(12, _SC)} AS rolling_12w_avg_revenue, {_avg(52, _SC)} AS rolling_52w_avg_revenue FROM w""")
star("w6_calendar_averages", CW + f"""SELECT week_end_date, category, r2::DOUBLE AS weekly_revenue, {_avg(4)} AS ma_4w,
  {_avg(8)} AS ma_8w, {_avg(12)} AS ma_12w FROM w""")
star("w4_first_last_peak", _TOT + f"""SELECT week_end_date, r::DOUBLE AS weekly_revenue,
  first_value(r::DOUBLE) OVER {_ALL} AS first_week_revenue, last_value(r::DOUBLE) OVER {_ALL} AS last_week_revenue,
  max(r::DOUBLE) OVER () AS all_time_peak_revenue,
  {growth("r", f"first_value(r) OVER {_ALL}")} AS growth_vs_first_week_pct,
  {H("r::DOUBLE * 100 / max(r) OVER ()::DOUBLE", 2)} AS pct_of_peak FROM w""")

star("w5_running_totals", f""", w AS (SELECT week_end_date, year, week_of_year, sum(spend) AS r, sum(units) AS u
  FROM ef GROUP BY ALL)
SELECT week_end_date, year, week_of_year, {X("r", 2)} AS weekly_revenue,
  {X(f"sum(r) OVER ({_O})", 2)} AS cumulative_revenue,
  {X(f"sum(r) OVER (PARTITION BY year {_O})", 2)} AS ytd_revenue, {n(f"sum(u) OVER ({_O})")} AS cumulative_units,
  {H(f"sum(r) OVER ({_O})::DOUBLE * 100 / sum(r) OVER ()::DOUBLE", 2)} AS cumulative_pct_of_total FROM w""")

_F = f"({_PC} {_O} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
star("w6_moving_averages", CW + f"""SELECT week_end_date, category, r2::DOUBLE AS weekly_revenue,
  {roll("r", 4, 2, _PC)} AS ma_4w, {roll("r", 8, 2, _PC)} AS ma_8w, {roll("r", 12, 2, _PC)} AS ma_12w,
  CASE WHEN r::DOUBLE > sum(r) OVER {_F}::DOUBLE / count(r) OVER {_F} THEN '{L.ABOVE_MA}' ELSE '{L.BELOW_MA}' END
  AS vs_ma_12w FROM w""")

star("w7_missing_weeks", f""", k AS (SELECT count(*) AS total_weeks FROM calendar),
g AS (SELECT description, category, ef.store_num::BIGINT AS store_num, {m("week_count=weeks_with_sales",
  "total_revenue")} FROM ef GROUP BY description, category, ef.store_num)
SELECT g.*, total_weeks, total_weeks - weeks_with_sales AS missing_weeks,
  rank() OVER (ORDER BY total_weeks - weeks_with_sales DESC) AS missing_weeks_rank
FROM g, k WHERE weeks_with_sales < total_weeks ORDER BY missing_weeks DESC, description, store_num LIMIT 50""")

star("w8_nested_shares", f"""SELECT category, description, seg_value_name,
  {m("total_revenue=product_segment_revenue")}, {share(REV, "category")} AS pct_of_category_revenue,
  {share(REV, "seg_value_name")} AS pct_of_segment_revenue, {share(REV)} AS pct_of_total_revenue
  FROM ef GROUP BY category, description, seg_value_name""")
