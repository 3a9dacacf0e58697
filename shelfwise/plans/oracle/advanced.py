from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, X, growth, m, mean, mean_if, star

_CH = L.CHAMPIONS
star("aq1_champion_classes", f""", p AS (SELECT upc, description, category, manufacturer,
  {X("coalesce(sum(spend) FILTER (WHERE is_promoted), 0)", 2)} AS promo_revenue,
  {X("coalesce(sum(spend) FILTER (WHERE NOT is_promoted), 0)", 2)} AS baseline_revenue,
  {m("total_revenue", "promo_rate_pct")} FROM ef GROUP BY 1, 2, 3, 4),
d AS (SELECT quantile_cont(total_revenue, 0.5) AS mt, quantile_cont(baseline_revenue, 0.5) AS mb FROM p)
SELECT p.*, {H("promo_revenue * 100 / nullif(total_revenue, 0)", 2)} AS promo_revenue_share_pct,
  CASE WHEN baseline_revenue >= mb AND total_revenue >= mt AND promo_rate_pct < 30 THEN '{_CH[0]}'
       WHEN total_revenue >= mt AND promo_rate_pct >= 30 THEN '{_CH[1]}'
       WHEN baseline_revenue >= mb AND total_revenue < mt THEN '{_CH[2]}' ELSE '{_CH[3]}' END AS champion_class
FROM p, d""")

_P = L.PERFORMANCE_FLAGS
star("aq2_store_vs_category_average", f""", a AS (SELECT ef.store_num::BIGINT AS store_num, store_name,
  seg_value_name, category, {m("total_revenue=actual_revenue")}, round(sum(spend), 2) AS r
  FROM ef GROUP BY ef.store_num, store_name, seg_value_name, category),
b AS (SELECT category, {H("sum(r)::DOUBLE / count(*)", 2)} AS avg_store_category_revenue FROM a GROUP BY 1)
SELECT a.* EXCLUDE (r), avg_store_category_revenue,
  {H("actual_revenue - avg_store_category_revenue", 2)} AS vs_avg_delta,
  {growth("actual_revenue", "avg_store_category_revenue")} AS vs_avg_pct,
  CASE WHEN actual_revenue >= avg_store_category_revenue * 1.2::DOUBLE THEN '{_P[0]}'
       WHEN actual_revenue >= avg_store_category_revenue * 0.8::DOUBLE THEN '{_P[1]}' ELSE '{_P[2]}' END
  AS performance_flag FROM a JOIN b USING (category)""")

star("aq3_price_gap_pairs", f""", c AS (SELECT date_key, store_num, category, description, upc, price, units FROM ef),
p AS (SELECT a.category, a.description AS product_a, b.description AS product_b, a.price - b.price AS g,
  a.units AS ua, b.units AS ub FROM c a JOIN c b ON a.date_key = b.date_key AND a.store_num = b.store_num
  AND a.category = b.category AND a.upc < b.upc)
SELECT category, product_a, product_b, count(*) AS weeks_compared, {H(mean("g"), 4)} AS avg_price_gap,
  {H(mean("ua"), 2)} AS avg_units_a, {H(mean("ub"), 2)} AS avg_units_b, count(*) FILTER (WHERE ua > ub) AS weeks_a_wins,
  count(*) FILTER (WHERE ub > ua) AS weeks_b_wins, {H("corr(g::DOUBLE, (ua - ub)::DOUBLE)", 4)} AS gap_unit_correlation
FROM p GROUP BY 1, 2, 3 HAVING count(*) > 10""")

_W = "OVER (PARTITION BY cohort ORDER BY year, quarter)"
star("aq4_store_cohorts", f""", s AS (SELECT store_num, min(year * 4 + quarter) AS q FROM ef GROUP BY 1),
h AS (SELECT store_num, CASE WHEN q <= (SELECT min(q) FROM s) + 1 THEN '{L.COHORTS[0]}' ELSE '{L.COHORTS[1]}' END
  AS cohort FROM s),
k AS (SELECT cohort, year, quarter, {m("store_count=active_stores", "total_revenue=quarterly_revenue",
  "revenue_per_store")} FROM ef JOIN h USING (store_num) GROUP BY 1, 2, 3)
SELECT *, lag(revenue_per_store) {_W} AS prior_quarter_rps,
  {growth("revenue_per_store", f"lag(revenue_per_store) {_W}")} AS qoq_rps_growth_pct FROM k""")

_B, _C = "promo_type = 'NONE'", "promo_type = 'COMBINED'"
star("aq5_combined_promo_roi", f""", w AS (SELECT category, description, {H(mean_if(_B, "units"), 2)} AS baseline_units,
  {H(mean_if(_C, "units"), 2)} AS combined_units, {H(mean_if(_B, "spend"), 4)} AS baseline_revenue,
  {H(mean_if(_C, "spend"), 4)} AS combined_revenue,
  {H(mean_if(_C, "price_gap * units::DECIMAL(12,0)"), 4)} AS combined_foregone_rev FROM ef GROUP BY 1, 2)
SELECT *, {growth("combined_units", "baseline_units")} AS unit_lift_pct,
  {H("combined_revenue - combined_foregone_rev", 4)} AS net_revenue,
  {H("(combined_revenue - combined_foregone_rev) * 100 / nullif(combined_revenue, 0)", 2)} AS net_margin_pct,
  CASE WHEN combined_revenue - combined_foregone_rev > baseline_revenue THEN '{L.ROI_POSITIVE}'
       ELSE '{L.ROI_NEGATIVE}' END AS roi_verdict
FROM w WHERE baseline_units IS NOT NULL AND combined_units IS NOT NULL""")

star("aq6_dead_zones", f""", q AS (SELECT store_num, store_name, seg_value_name, category, year, quarter,
  round(sum(spend), 2) AS r FROM ef GROUP BY ALL),
f AS (SELECT *, coalesce((r <= lag(r) OVER w)::INT, 0) AS flat FROM q
  WINDOW w AS (PARTITION BY store_num, category ORDER BY year, quarter)),
c AS (SELECT *, sum(flat) OVER (PARTITION BY store_num, category ORDER BY year, quarter
  ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS consec_flat_qtrs FROM f)
SELECT store_num::BIGINT AS store_num, store_name, seg_value_name, category, year, quarter, r::DOUBLE AS qtr_revenue,
  consec_flat_qtrs, '{L.DEAD_ZONE}' AS alert FROM c WHERE consec_flat_qtrs = 3""")
