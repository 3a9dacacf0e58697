from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, X, growth, m, mean, mean_if, n, rate, share, star

star("pm1_promo_mix", f"""SELECT category, promo_type, {m("row_count", "total_units", "avg_units=avg_units_per_row",
  "total_revenue", "avg_revenue=avg_revenue_per_row", "avg_price", "avg_discount_pct",
  "avg_row_basket_value=avg_basket_value")}, {share("count(*)", "category")} AS pct_of_category FROM ef GROUP BY 1, 2""")

# Product averages without promotion (b) and per promotion class (p).
LIFT = f""", b AS (SELECT upc, {mean("units")} AS bu, {mean("spend")} AS br, {mean("price")} AS bp, count(*) AS bn
  FROM fact WHERE promo_type = 'NONE' GROUP BY 1),
p AS (SELECT upc, promo_type, {mean("units")} AS pu, {mean("spend")} AS pr, {mean("price")} AS pp, count(*) AS pn
  FROM fact WHERE promo_type <> 'NONE' GROUP BY 1, 2)
"""
star("pm2_promo_lift", LIFT + f"""SELECT category, description, promo_type, {H("bu", 2)} AS baseline_avg_units,
  {H("pu", 2)} AS promo_avg_units, {growth("pu", "bu")} AS units_lift_pct, {H("bp", 4)} AS baseline_avg_price,
  {H("pp", 4)} AS promo_avg_price, {H("(bp - pp) * 100 / nullif(bp, 0)", 2)} AS price_reduction_pct,
  {growth("pr", "br")} AS revenue_lift_pct, pn AS promo_row_count
  FROM p JOIN b USING (upc) JOIN product USING (upc)""")

_K = {"feature": "FEATURE_ONLY", "display": "DISPLAY_ONLY", "tpr": "TPR_ONLY", "combined": "COMBINED"}
_U = lambda code: mean_if(f"promo_type = '{code}'", "units")
star("pm3_lever_comparison", f"""SELECT category, {H(_U("NONE"), 2)} AS baseline_units,
  {", ".join(f"{H(_U(c), 2)} AS {k if k == 'combined' else k + '_only'}_units" for k, c in _K.items())},
  {", ".join(f"{H(_U(c) + ' / ' + _U('NONE'), 2)} AS {k}_lift_multiple" for k, c in _K.items())}
  FROM ef GROUP BY 1""")

_P, _N = mean_if("is_promoted", "units"), mean_if("promo_type = 'NONE'", "units")
star("pm4_segment_lift", f"""SELECT seg_value_name, category, {H(_N, 2)} AS baseline_units, {H(_P, 2)} AS promoted_units,
  {H(H(f"{_P} / {_N} - 1", 4) + " * 100", 2)} AS units_lift_pct,
  {H(mean_if("promo_type = 'NONE'", "price"), 4)} AS baseline_price,
  {H(mean_if("is_promoted", "price"), 4)} AS promo_price FROM ef GROUP BY 1, 2""")

star("pm5_promo_dependency", f"""SELECT description, category, manufacturer, count(*) AS total_rows,
  {m("promoted_rows", "promo_rate_pct", "feature_rows=feature_weeks", "display_rows=display_weeks",
  "tpr_rows=tpr_only_weeks", "combined_rows=combined_weeks")},
  {X("coalesce(sum(spend) FILTER (WHERE is_promoted), 0)", 2)} AS promo_revenue,
  {X("coalesce(sum(spend) FILTER (WHERE NOT is_promoted), 0)", 2)} AS baseline_revenue,
  CASE WHEN {rate("is_promoted")} > 40 THEN '{L.DEPENDENCY_HIGH}' ELSE '{L.DEPENDENCY_OK}' END AS promo_health
  FROM ef GROUP BY 1, 2, 3""")

star("pm6_promo_return", f""", t AS (SELECT category, promo_type, sum(units) AS u, sum(spend) AS r,
  sum(price_gap * units::DECIMAL(12,0)) AS f FROM ef WHERE promo_type <> 'NONE' GROUP BY 1, 2)
SELECT category, promo_type, {n("u")} AS promo_units, {X("r", 4)} AS promo_revenue, {X("f", 4)} AS revenue_foregone,
  {X("r - f", 4)} AS net_revenue, {H("f::DOUBLE * 100 / nullif(r, 0)::DOUBLE", 2)} AS cost_as_pct_of_revenue,
  {H("(r - f)::DOUBLE * 100 / nullif(r, 0)::DOUBLE", 2)} AS net_margin_pct FROM t""")

_CATS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
star("pm7_promo_calendar", f"""SELECT week_end_date, year, quarter, month_name, is_holiday_season,
  {", ".join(f"max((category = '{c}' AND is_promoted)::BIGINT) AS {c.lower()}_promo" for c in _CATS)},
  count(DISTINCT category) FILTER (WHERE is_promoted) AS categories_on_promo,
  count(*) FILTER (WHERE is_promoted) AS promo_rows, {m("total_revenue")} FROM ef GROUP BY 1, 2, 3, 4, 5""")
