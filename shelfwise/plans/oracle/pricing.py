from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, REV, X, bands, growth, m, mean, mean_if, rate, share, star

star("pr1_price_range", f"""SELECT description, category, manufacturer, product_size, {m("min_price", "max_price",
  "avg_price", "avg_base_price", "price_range", "avg_discount_pct", "max_discount_pct", "total_units",
  "price_cv_pct")} FROM ef GROUP BY 1, 2, 3, 4""")

star("pr2_price_bands", f"""SELECT category, {bands("price", L.PRICE_BAND_EDGES, L.PRICE_BANDS)} AS price_band,
  {m("row_count", "total_units", "avg_units=avg_units_per_row", "total_revenue", "avg_price=avg_price_in_band",
  "avg_discount_pct")}, {share(REV, "category")} AS pct_of_category_revenue FROM ef GROUP BY 1, 2""")

_B = f"""CASE WHEN discount_pct < 0 THEN '{L.DISCOUNT_ABOVE_BASE}'
  ELSE {bands("discount_pct", L.DISCOUNT_EDGES, L.DISCOUNT_BUCKETS, "<=")} END"""
star("pr3_discount_depth", f"""SELECT category, {_B} AS discount_bucket, {m("row_count", "total_units",
  "avg_units=avg_units_per_row", "avg_discount_pct=avg_discount_in_bucket", "total_revenue")},
  {share("count(*)", "category")} AS pct_of_rows FROM ef GROUP BY 1, 2""")

star("pr4_elasticity_proxy", f""", q AS (SELECT upc, description, category, units, price,
  ntile(4) OVER (PARTITION BY upc ORDER BY price, date_key, store_num) AS q FROM ef WHERE units > 0),
s AS (SELECT upc, description, category, {H(mean_if("q = 1", "price"), 4)} AS avg_low_price,
  {H(mean_if("q = 4", "price"), 4)} AS avg_high_price, {H(mean_if("q = 1", "units"), 4)} AS u1,
  {H(mean_if("q = 4", "units"), 4)} AS u4 FROM q GROUP BY 1, 2, 3 HAVING bool_or(q = 4)),
c AS (SELECT *, (avg_high_price - avg_low_price) * 100 / nullif(avg_low_price, 0) AS dp,
  (u4 - u1) * 100 / nullif(u1, 0) AS du FROM s)
SELECT upc, description, category, avg_low_price, avg_high_price, {H("u1", 2)} AS avg_units_at_low_price,
  {H("u4", 2)} AS avg_units_at_high_price, {H("dp", 2)} AS pct_price_increase, {H("du", 2)} AS pct_units_change,
  {H("du / nullif(dp, 0)", 4)} AS price_elasticity_proxy,
  CASE WHEN abs(du / nullif(dp, 0)) > 1 THEN '{L.ELASTIC}' ELSE '{L.INELASTIC}' END AS elasticity_class FROM c""")

_T = f"""CASE WHEN discount_pct = 0 THEN '{L.TIER_BASELINE}'
  ELSE {bands("discount_pct", L.TIER_EDGES, L.TIERS, "<=")} END"""
star("pr5_lift_by_discount_tier", f""", t AS (SELECT category, description, {_T} AS discount_tier,
  {mean("units")} AS a, count(*) AS row_count FROM ef GROUP BY 1, 2, 3),
b AS (SELECT category, description, a AS b FROM t WHERE discount_tier = '{L.TIER_BASELINE}')
SELECT category, description, discount_tier, {H("a", 2)} AS avg_units, {H("b", 2)} AS baseline_units,
  {growth("a", "b")} AS units_lift_pct, row_count FROM t LEFT JOIN b USING (category, description)""")

star("pr6_price_gap", f"""SELECT description, category, {m("avg_base_price", "avg_price=avg_actual_price",
  "avg_price_gap", "avg_discount_pct")}, count(*) FILTER (WHERE price < base_price) AS weeks_discounted,
  count(*) AS total_weeks, {H(rate("price < base_price"), 2)} AS pct_weeks_discounted,
  {X("coalesce(sum(spend) FILTER (WHERE price < base_price), 0)", 2)} AS revenue_at_discount,
  {X("coalesce(sum(spend) FILTER (WHERE price >= base_price), 0)", 2)} AS revenue_at_full_price FROM ef GROUP BY 1, 2""")

star("pr7_price_by_segment", f""", v AS (SELECT category, {mean("price")} AS v FROM ef
  WHERE seg_value_name = 'VALUE' GROUP BY 1)
SELECT category, seg_value_name, {m("avg_price", "avg_base_price", "avg_discount_pct", "min_price", "max_price")},
  {H(mean("price") + " - any_value(v)", 4)} AS price_premium_vs_value
  FROM ef LEFT JOIN v USING (category) GROUP BY 1, 2""")
