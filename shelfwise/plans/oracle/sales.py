from shelfwise.plans.oracle.base import H, REV, X, growth, m, share, star

_W = "OVER (ORDER BY week_end_date)"
star("s1_weekly_trend", f""", w AS (SELECT week_end_date, year, quarter, month, week_of_year, is_holiday_season,
  sum(spend) AS r, {m("total_revenue=weekly_revenue", "total_units=weekly_units", "total_visits=weekly_visits",
  "total_hhs=weekly_hhs", "avg_basket_value", "avg_price", "avg_discount_pct", "promoted_rows", "promo_rate_pct")}
  FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), lag(weekly_revenue) {_W} AS prev_week_revenue,
  {growth("r", f"lag(r) {_W}")} AS wow_revenue_growth_pct FROM w""")

_W = "OVER (ORDER BY year, month)"
star("s2_monthly_trend", f""", w AS (SELECT year, month, month_name, round(sum(spend), 2) AS r,
  {m("total_units=monthly_units", "total_visits=monthly_visits", "avg_discount_pct")} FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), r::DOUBLE AS monthly_revenue, lag(r::DOUBLE) {_W} AS prev_month_revenue,
  {growth("r", f"lag(r) {_W}")} AS mom_revenue_growth_pct, lag(r::DOUBLE, 12) {_W} AS same_month_last_year,
  {growth("r", f"lag(r, 12) {_W}")} AS yoy_revenue_growth_pct, (sum(r) {_W})::DOUBLE AS cumulative_revenue FROM w""")

_W = "OVER (ORDER BY year, quarter)"
star("s3_quarterly_trend", f""", w AS (SELECT year, quarter, round(sum(spend), 2) AS r,
  {m("total_units=quarterly_units", "total_visits=quarterly_visits", "avg_discount_pct", "promo_rate_pct")}
  FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), year || '-Q' || quarter AS year_quarter, r::DOUBLE AS quarterly_revenue,
  lag(r::DOUBLE) {_W} AS prev_quarter_revenue, {growth("r", f"lag(r) {_W}")} AS qoq_revenue_growth_pct,
  lag(r::DOUBLE, 4) {_W} AS same_q_last_year, {growth("r", f"lag(r, 4) {_W}")} AS yoy_quarterly_growth_pct,
  {share("r", "year")} AS pct_of_annual_revenue FROM w""")

_W = "OVER (ORDER BY year)"
star("s4_annual_summary", f""", w AS (SELECT year, round(sum(spend), 2) AS r, {m("total_units=annual_units",
  "total_visits=annual_visits", "total_hhs=annual_hhs", "week_count=weeks_in_year")} FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), r::DOUBLE AS annual_revenue, {H("r::DOUBLE / weeks_in_year", 2)} AS avg_weekly_revenue,
  lag(r::DOUBLE) {_W} AS prior_year_revenue, {growth("r", f"lag(r) {_W}")} AS yoy_revenue_growth_pct,
  {growth("annual_units", f"lag(annual_units) {_W}")} AS yoy_units_growth_pct FROM w""")

star("s5_category_quarter_mix", f"""SELECT year, quarter, category, {m("total_revenue=revenue")},
  {share(REV, "year, quarter")} AS pct_of_quarter_revenue,
  {X("sum(spend) - lag(sum(spend)) OVER (PARTITION BY category ORDER BY year, quarter)", 2)}
  AS revenue_vs_prev_quarter FROM ef GROUP BY year, quarter, category""")

star("s6_holiday_split", f"""SELECT is_holiday_season, {m("week_count", "total_revenue",
  "revenue_per_week=avg_weekly_revenue", "total_units", "avg_discount_pct", "promo_rate_pct")} FROM ef GROUP BY 1""")

_W = "OVER (PARTITION BY seg_value_name ORDER BY year)"
star("s7_segment_yoy", f"""SELECT year, seg_value_name, {m("total_revenue=revenue")},
  (lag(round(sum(spend), 2)) {_W})::DOUBLE AS prior_year_revenue,
  {growth(REV, f"lag(sum(spend)) {_W}")} AS yoy_growth_pct FROM ef GROUP BY year, seg_value_name""")

_COLS = m("total_units=weekly_units", "avg_discount_pct", "promo_rate_pct")
star("s8_best_and_worst_weeks", f""", w AS (SELECT week_end_date, year, month_name, is_holiday_season,
  round(sum(spend), 2) AS r, {_COLS} FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r, pos), r::DOUBLE AS weekly_revenue FROM (
  SELECT 'TOP 10' AS rank_group, rank() OVER (ORDER BY r DESC) AS week_rank, *,
         row_number() OVER (ORDER BY r DESC, week_end_date) AS pos FROM w
  UNION ALL
  SELECT 'BOTTOM 10', rank() OVER (ORDER BY r), *, row_number() OVER (ORDER BY r, week_end_date) FROM w)
WHERE pos <= 10""")
