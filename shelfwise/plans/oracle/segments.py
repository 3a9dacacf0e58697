from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, X, bands, case, growth, m, star
from shelfwise.plans.oracle.customer import HH
from shelfwise.plans.oracle.product import ABC

_C = {f"{a}|{p}": t for (a, p), t in L.STRATEGIC_CELLS.items()}
star("sg1_abc_promo_matrix", f""", p AS (SELECT upc, description, category, manufacturer, sum(spend) AS r,
  {m("avg_discount_pct", "promo_rate_pct")} FROM ef GROUP BY 1, 2, 3, 4),
q AS (SELECT *, sum(r) OVER (ORDER BY r DESC, upc ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(r) OVER ()::DOUBLE AS c FROM p),
k AS (SELECT * EXCLUDE (r, c), {X("r", 2)} AS total_revenue, {ABC} AS abc_class,
  {bands("promo_rate_pct", L.PROMO_LEVEL_EDGES, L.PROMO_LEVELS)} AS promo_dependency FROM q)
SELECT *, {case("abc_class || '|' || promo_dependency", _C)} AS strategic_cell FROM k""")

_Q = L.STORE_QUADRANTS
star("sg2_store_quadrants", f""", s AS (SELECT ef.store_num::BIGINT AS store_num, store_name, state, seg_value_name,
  {m("total_revenue", "avg_basket_value")} FROM ef GROUP BY ef.store_num, store_name, state, seg_value_name),
d AS (SELECT quantile_cont(total_revenue, 0.5) AS mr, quantile_cont(avg_basket_value, 0.5) AS mb FROM s)
SELECT s.*, {H("mr", 2)} AS median_revenue, {H("mb", 4)} AS median_basket_value,
  CASE WHEN total_revenue >= mr AND avg_basket_value >= mb THEN '{_Q[True, True]}'
       WHEN total_revenue >= mr THEN '{_Q[True, False]}' WHEN avg_basket_value >= mb THEN '{_Q[False, True]}'
       ELSE '{_Q[False, False]}' END AS store_quadrant,
  {H("sqrt(pow((total_revenue - mr) / mr, 2) + pow((avg_basket_value - mb) / mb, 2))", 4)} AS distance_from_median
FROM s, d""")

_L = lambda i: f"""CASE WHEN avg_yoy_growth_pct > 5 THEN '{L.LIFECYCLE[0][i]}'
  WHEN avg_yoy_growth_pct >= -2 THEN '{L.LIFECYCLE[1][i]}' ELSE '{L.LIFECYCLE[2][i]}' END"""  # noqa: E731
star("sg3_category_lifecycle", f""", y AS (SELECT category, year, round(sum(spend), 2) AS r FROM ef GROUP BY 1, 2),
g AS (SELECT category, {growth("r", "lag(r) OVER (PARTITION BY category ORDER BY year)")} AS g FROM y),
a AS (SELECT category, {H("avg(g)", 2)} AS avg_yoy_growth_pct, min(g) AS min_yoy, max(g) AS max_yoy FROM g
  WHERE g IS NOT NULL GROUP BY 1)
SELECT *, {_L(0)} AS lifecycle_stage, {_L(1)} AS recommended_strategy FROM a""")

star("sg4_price_consistency", f""", p AS (SELECT upc, description, category,
  {m("avg_price", "min_price", "max_price", "price_stddev", "price_cv_pct")} FROM ef GROUP BY 1, 2, 3)
SELECT *, {bands("price_cv_pct", L.CONSISTENCY_EDGES, L.CONSISTENCY)} AS price_consistency,
  {bands("avg_price", L.PRICE_TIER_EDGES, L.PRICE_TIERS)} AS price_tier FROM p""")

star("sg5_household_value", HH + f"""SELECT * EXCLUDE (total_revenue),
  {case("spend_quartile", L.HH_VALUE)} AS hh_value_segment
  FROM (SELECT *, ntile(4) OVER (ORDER BY spend_per_hh DESC, store_num, upc) AS spend_quartile FROM hh)""")

star("sg6_cluster_features", f"""SELECT ef.store_num::BIGINT AS store_num, upc, description, category, seg_value_name,
  state, {m("total_revenue", "avg_revenue=avg_weekly_revenue", "avg_units:4=avg_weekly_units",
  "avg_row_units_per_hh=avg_units_per_hh", "avg_price", "avg_discount_pct:4", "price_stddev",
  "avg_row_basket_value=avg_basket_value", "avg_row_spend_per_hh=avg_spend_per_hh", "avg_visits_per_hh",
  "feature_share=feature_rate", "display_share=display_rate", "tpr_share=tpr_rate", "promo_share=overall_promo_rate")}
  FROM ef WHERE hhs > 0 GROUP BY ef.store_num, upc, description, category, seg_value_name, state""")
