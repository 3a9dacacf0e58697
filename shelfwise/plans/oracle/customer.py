from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, bands, case, m, mean, per, star

star("cb1_basket_by_category_segment", f"""SELECT category, seg_value_name, {m("avg_basket_size", "avg_basket_value",
  "avg_revenue_per_hh", "avg_units_per_hh", "avg_visits_per_hh", "total_units", "total_hhs", "total_revenue")}
  FROM ef WHERE visits > 0 AND hhs > 0 GROUP BY 1, 2""")

HH = f""", hh AS (SELECT store_num::BIGINT AS store_num, upc, category, description, seg_value_name,
  {m("avg_units_per_hh=units_per_hh", "avg_revenue_per_hh=spend_per_hh", "avg_visits_per_hh=visits_per_hh",
  "total_revenue")} FROM ef WHERE ef.hhs > 0 GROUP BY ef.store_num, upc, category, description, seg_value_name)
"""
star("cb2_intensity_quintiles", HH + f"""SELECT *, {case("intensity_quintile", L.QUINTILES)} AS intensity_label
  FROM (SELECT *, ntile(5) OVER (ORDER BY units_per_hh DESC, store_num, upc) AS intensity_quintile FROM hh)""")

star("cb3_visit_frequency", f"""SELECT category, {m("total_hhs", "avg_visits_per_hh",
  "avg_revenue_per_hh=avg_spend_per_hh", "avg_units_per_hh", "total_revenue")},
  {bands(per("visits", "hhs"), L.FREQUENCY_EDGES, L.FREQUENCY_BANDS)} AS frequency_band
  FROM ef WHERE hhs > 0 AND visits > 0 GROUP BY 1""")

star("cb4_spend_per_hh_premium", f""", v AS (SELECT category, {per("spend", "hhs")} AS v FROM ef
  WHERE seg_value_name = 'VALUE' AND hhs > 0 GROUP BY 1)
SELECT seg_value_name, category, {m("store_count", "avg_revenue_per_hh=avg_spend_per_hh", "avg_units_per_hh",
  "avg_visits_per_hh")}, {H(per("spend", "hhs") + " - any_value(v)", 4)} AS premium_vs_value_stores
  FROM ef LEFT JOIN v USING (category) WHERE hhs > 0 GROUP BY 1, 2""")

star("cb5_category_co_occurrence", f""", c AS (SELECT date_key, store_num, category, sum(spend) AS r FROM ef
  GROUP BY 1, 2, 3 HAVING sum(spend) > 0),
o AS (SELECT category AS category_a, count(*) AS own FROM c GROUP BY 1),
p AS (SELECT a.category AS category_a, b.category AS category_b, count(*) AS co_occurrence_weeks,
  {H("sum(a.r + b.r)::DOUBLE / count(*)", 2)} AS avg_combined_weekly_revenue
  FROM c a JOIN c b ON a.date_key = b.date_key AND a.store_num = b.store_num AND a.category < b.category GROUP BY 1, 2)
SELECT p.*, {H("co_occurrence_weeks * 100.0::DOUBLE / own", 2)} AS pct_of_cat_a_weeks_with_b
FROM p JOIN o USING (category_a)""")

star("cb6_units_per_visit_by_promo", f"""SELECT category, CASE WHEN is_promoted THEN 'PROMOTED' ELSE 'BASELINE' END
  AS promo_status, {m("avg_basket_size=units_per_visit", "avg_basket_value=spend_per_visit", "hhs_per_visit",
  "row_count")} FROM ef WHERE visits > 0 GROUP BY 1, 2""")

_R = L.REACH_MATRIX
star("cb7_reach_frequency_matrix", f""", c AS (SELECT category, sum(hhs) AS h, sum(visits) AS v FROM ef
  GROUP BY category, store_num, date_key HAVING sum(hhs) > 0),
a AS (SELECT avg(h::DOUBLE) AS ah, avg(v::DOUBLE / h) AS af FROM c),
g AS (SELECT category, avg(h::DOUBLE) AS gh, avg(v::DOUBLE / h) AS gf, avg(v::DOUBLE) AS gv FROM c GROUP BY 1)
SELECT category, {H("gh", 1)} AS avg_hhs_per_store_week, {H("gv", 1)} AS avg_visits_per_store_week,
  {H("gf", 4)} AS avg_visit_frequency, CASE WHEN gh >= ah AND gf >= af THEN '{_R[True, True]}'
  WHEN gh >= ah THEN '{_R[True, False]}' WHEN gf >= af THEN '{_R[False, True]}' ELSE '{_R[False, False]}' END
  AS customer_matrix_segment FROM g, a""")

star("cb8_below_category_spend", f""", l AS (SELECT category, {mean("spend_per_hh")} AS l FROM ef GROUP BY 1),
g AS (SELECT category, seg_value_name, state, {per("spend", "hhs")} AS s, {m("store_count", "total_revenue")}
  FROM ef WHERE hhs > 0 GROUP BY 1, 2, 3)
SELECT g.* EXCLUDE (s), {H("s", 4)} AS spend_per_hh FROM g JOIN l USING (category) WHERE s < l""")
