from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, X, case, growth, star
from shelfwise.plans.oracle.product import ABC, CUM
from shelfwise.plans.oracle.promotion import LIFT

star("ct1_promo_vs_baseline", LIFT + f"""SELECT upc, description, category, manufacturer, promo_type,
  {H("bu", 2)} AS baseline_units, {H("pu", 2)} AS promo_units, {growth("pu", "bu")} AS units_lift_pct,
  {H("bp", 4)} AS baseline_price, {H("pp", 4)} AS promo_price,
  {H("(bp - pp) * 100 / nullif(bp, 0)", 2)} AS price_cut_pct, bn AS baseline_weeks, pn AS promo_weeks
  FROM p JOIN b USING (upc) JOIN product USING (upc)""")

star("ct2_abc_attribution", CUM + f"""SELECT revenue_rank, {ABC} AS abc_class, upc, description, category,
  manufacturer, {X("r", 2)} AS total_revenue, total_units, {H("sh * 100", 2)} AS revenue_share_pct,
  {H("c * 100", 2)} AS cumulative_pct FROM cum""")

star("ct3_week_spine", """, numbered AS (SELECT week_end_date AS wk_date,
  row_number() OVER (ORDER BY week_end_date) AS week_seq FROM spine)
SELECT week_seq, wk_date, year(wk_date) AS year, quarter(wk_date) AS quarter, month(wk_date) AS month,
  week(wk_date) AS iso_week_num FROM numbered""")

Z = """, z AS (SELECT s.store_num::BIGINT AS store_num, p.upc, description, category, seg_value_name, week_end_date,
  0::DOUBLE AS spend, 0::BIGINT AS units, true AS is_zero_week
  FROM store s CROSS JOIN product p CROSS JOIN calendar c
  WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.date_key = c.date_key AND f.store_num = s.store_num AND f.upc = p.upc))
"""
star("ct4_zero_weeks", Z + """SELECT category, seg_value_name, week_end_date, count(*) AS zero_rows,
  sum(units)::BIGINT AS units, sum(spend) AS spend FROM z GROUP BY 1, 2, 3""")
star("ct4_zero_week_runs", """, z AS (SELECT s.store_num::BIGINT AS store_num, p.upc, c.week_of_year AS no, c.week_end_date
  FROM store s CROSS JOIN product p CROSS JOIN calendar c
  WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.date_key = c.date_key AND f.store_num = s.store_num AND f.upc = p.upc)),
island AS (SELECT *, no - row_number() OVER (PARTITION BY store_num, upc ORDER BY no) AS run FROM z)
SELECT store_num, upc, min(week_end_date) AS first_week, max(week_end_date) AS last_week, count(*) AS zero_weeks
FROM island GROUP BY store_num, upc, run""")
star("ct4_zero_filled_panel", f""", f AS (SELECT s.store_num::BIGINT AS store_num, x.units FROM store s
  CROSS JOIN product p CROSS JOIN calendar c
  LEFT JOIN fact x ON x.date_key = c.date_key AND x.store_num = s.store_num AND x.upc = p.upc)
SELECT store_num, count(*) AS panel_rows, count(*) FILTER (WHERE units IS NULL) AS zero_rows,
  coalesce(sum(units), 0)::BIGINT AS units, {H("coalesce(sum(units), 0)::DOUBLE / count(*)", 4)}
  AS avg_units_per_panel_row FROM f GROUP BY 1""")

star("ct5_yearly_podium", f""", y AS (SELECT year, category, description, manufacturer, sum(spend) AS r
  FROM ef GROUP BY ALL),
q AS (SELECT *, row_number() OVER (PARTITION BY year, category ORDER BY r DESC, description) AS podium_position FROM y)
SELECT * EXCLUDE (r), {X("r", 2)} AS annual_revenue, {case("podium_position", L.MEDALS)} AS medal
FROM q WHERE podium_position <= 3""")
