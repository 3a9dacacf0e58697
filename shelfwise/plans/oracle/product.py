from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, REV, REV_RANK, X, bands, case, growth, m, per, share, star

star("p1_product_ranking", f"""SELECT upc, description, category, sub_category, manufacturer, product_size,
  {m("total_revenue", "total_units", "total_visits", "total_hhs", "avg_price", "min_price", "max_price",
  "avg_discount_pct", "promo_rate_pct")}, {share(REV)} AS portfolio_revenue_share_pct, {REV_RANK} AS revenue_rank
  FROM ef GROUP BY 1, 2, 3, 4, 5, 6""")

# Per product: revenue, rank, share and running share.
CUM = """, prod AS (SELECT upc, description, category, manufacturer, sum(spend) AS r, sum(units)::BIGINT AS total_units
  FROM ef GROUP BY ALL),
cum AS (SELECT *, rank() OVER (ORDER BY r DESC) AS revenue_rank, r::DOUBLE / sum(r) OVER ()::DOUBLE AS sh,
  sum(r) OVER (ORDER BY r DESC, upc ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(r) OVER ()::DOUBLE AS c FROM prod)
"""
star("p2_pareto", CUM + f"""SELECT revenue_rank, upc, description, category, manufacturer,
  {X("r", 2)} AS product_revenue, {H("sh * 100", 2)} AS revenue_share_pct, {H("c * 100", 2)} AS cumulative_share_pct,
  {bands("c", L.PARETO_CUTS, L.PARETO_CLASSES, "<=")} AS pareto_class,
  {H("revenue_rank * 100.0::DOUBLE / count(*) OVER ()", 1)} AS sku_count_pct FROM cum""")

ABC = bands("c", L.ABC_CUTS, L.ABC_CLASSES, "<=")
star("p3_abc_strategy", CUM + f"""SELECT revenue_rank, upc, description, category, manufacturer,
  {X("r", 2)} AS total_revenue, total_units, {H("sh * 100", 2)} AS revenue_share_pct, {H("c * 100", 2)} AS cumulative_pct,
  {ABC} AS abc_class, {case(f"({ABC})", L.ABC_STRATEGY)} AS abc_strategy FROM cum""")

star("p4_category_market_share", f"""SELECT category, description, manufacturer, {m("total_revenue=product_revenue")},
  {share(REV, "category")} AS category_market_share_pct,
  rank() OVER (PARTITION BY category ORDER BY sum(spend) DESC) AS category_revenue_rank,
  {X("sum(sum(spend)) OVER (PARTITION BY category)", 2)} AS category_total_revenue
  FROM ef GROUP BY category, description, manufacturer""")

star("p5_top_bottom_per_category", f""", r AS (SELECT category, description, manufacturer, product_size,
  {m("total_revenue", "total_units", "avg_price")},
  rank() OVER (PARTITION BY category ORDER BY sum(spend) DESC) AS t,
  rank() OVER (PARTITION BY category ORDER BY sum(spend)) AS b FROM ef GROUP BY 1, 2, 3, 4)
SELECT * EXCLUDE (t, b), if(t <= 5, 'TOP 5', 'BOTTOM 5') AS performance_band, if(t <= 5, t, b) AS band_rank
FROM r WHERE least(t, b) <= 5""")

star("p6_revenue_deciles", f""", r AS (SELECT upc, description, category, round(sum(spend), 2) AS v FROM ef GROUP BY ALL)
SELECT upc, description, category, v::DOUBLE AS total_revenue,
  ntile(10) OVER (ORDER BY v DESC, upc) AS revenue_decile, {share("v")} AS revenue_share_pct FROM r""")

star("p7_product_momentum", f""", mx AS (SELECT max(week_of_year) AS w FROM calendar),
l AS (SELECT upc, description, category, sum(spend) AS now FROM ef, mx WHERE week_of_year > w - 52 GROUP BY ALL),
p AS (SELECT upc, sum(spend) AS before FROM ef, mx WHERE week_of_year > w - 104 AND week_of_year <= w - 52 GROUP BY ALL)
SELECT upc, description, category, {X("now", 2)} AS revenue_last_52w, {X("before", 2)} AS revenue_prior_52w,
  {growth("now", "before")} AS revenue_change_pct,
  CASE WHEN now < before THEN '{L.TREND_DECLINING}' WHEN now > before THEN '{L.TREND_GROWING}'
       ELSE '{L.TREND_STABLE}' END AS trend_label FROM l LEFT JOIN p USING (upc)""")

star("p8_purchase_intensity", f"""SELECT description, category, manufacturer, {m("avg_units_per_hh=units_per_hh",
  "avg_revenue_per_hh=spend_per_hh", "avg_visits_per_hh=visits_per_hh", "total_revenue")},
  rank() OVER (ORDER BY {per("units", "hhs")} DESC) AS intensity_rank FROM ef WHERE hhs > 0 GROUP BY 1, 2, 3""")
