from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, case, m, star

_PM = f""", p AS (SELECT upc, description, category, manufacturer, {m("total_revenue", "total_units", "avg_price",
  "avg_discount_pct", "promo_rate_pct")} FROM ef GROUP BY 1, 2, 3, 4)
"""
_R = lambda c, part="": f"rank() OVER ({part} ORDER BY {c} DESC)"
star("rk1_multi_metric_ranks", _PM + f"""SELECT * EXCLUDE (upc), {_R("total_revenue")} AS revenue_rank,
  {_R("total_units")} AS units_rank, {_R("avg_price")} AS price_rank, {_R("avg_discount_pct")} AS discount_rank,
  {_R("promo_rate_pct")} AS promo_freq_rank, {_R("total_revenue", "PARTITION BY category")} AS category_revenue_rank,
  {_R("total_units", "PARTITION BY category")} AS category_units_rank,
  {H("percent_rank() OVER (ORDER BY total_revenue)", 4)} AS revenue_percentile,
  {H("cume_dist() OVER (ORDER BY total_revenue)", 4)} AS revenue_cume_dist FROM p""")

star("rk2_top_n_per_category", f"""SELECT category, description, manufacturer,
  {m("total_revenue", "total_units", "avg_price")},
  dense_rank() OVER (PARTITION BY category ORDER BY sum(spend) DESC) AS cat_rank
  FROM ef GROUP BY category, description, manufacturer QUALIFY cat_rank <= 3""")

star("rk3_top_stores_per_state", f""", r AS (SELECT ef.store_num::BIGINT AS store_num, store_name, state,
  seg_value_name, {m("total_revenue", "avg_basket_value")},
  rank() OVER (PARTITION BY state ORDER BY sum(spend) DESC) AS state_rank
  FROM ef GROUP BY ef.store_num, store_name, state, seg_value_name)
SELECT *, {case("state_rank", L.STANDINGS)} AS state_standing FROM r WHERE state_rank <= 3""")

star("rk4_decile_summary", f""", p AS (SELECT upc, description, sum(spend) AS r FROM ef GROUP BY 1, 2),
d AS (SELECT *, round(r, 2) AS v, ntile(10) OVER (ORDER BY r DESC, upc) AS decile FROM p)
SELECT decile, count(*) AS products_in_decile, min(v)::DOUBLE AS min_revenue, max(v)::DOUBLE AS max_revenue,
  {H("sum(v)::DOUBLE / count(*)", 2)} AS avg_revenue, sum(v)::DOUBLE AS decile_total_revenue,
  {H("sum(v)::DOUBLE * 100 / sum(sum(v)) OVER ()::DOUBLE", 2)} AS pct_of_portfolio_revenue,
  string_agg(description, ', ' ORDER BY r DESC, description) AS products FROM d GROUP BY 1""")

star("rk5_yearly_rank_shift", f""", y AS (SELECT year, upc, description, category, {m("total_revenue=annual_revenue")},
  rank() OVER (PARTITION BY year ORDER BY sum(spend) DESC) AS current_rank
  FROM ef GROUP BY year, upc, description, category)
SELECT c.*, p.current_rank AS prior_year_rank, coalesce(p.current_rank - c.current_rank, 0) AS rank_change,
  CASE WHEN p.current_rank IS NULL THEN '{L.SHIFT_NEW}' WHEN c.current_rank < p.current_rank THEN '{L.SHIFT_UP}'
       WHEN c.current_rank > p.current_rank THEN '{L.SHIFT_DOWN}' ELSE '{L.SHIFT_SAME}' END AS trend_direction
FROM y c LEFT JOIN y p ON p.upc = c.upc AND p.year = c.year - 1""")

star("rk6_discount_percentiles", f""", d AS (SELECT upc, description, category,
  {m("avg_discount_pct:4", "max_discount_pct:4", "pct_rows_discounted")} FROM ef GROUP BY 1, 2, 3)
SELECT * EXCLUDE (upc), {_R("avg_discount_pct")} AS discount_rank,
  {H("percent_rank() OVER (ORDER BY avg_discount_pct) * 100", 2)} AS discount_percentile,
  {H("cume_dist() OVER (ORDER BY avg_discount_pct) * 100", 2)} AS discount_cume_dist_pct FROM d""")

star("rk7_store_ranks", f""", r AS (SELECT ef.store_num::BIGINT AS store_num, store_name, state, seg_value_name,
  {m("total_revenue", "avg_basket_value")} FROM ef GROUP BY ef.store_num, store_name, state, seg_value_name)
SELECT *, {_R("total_revenue")} AS global_rank, {_R("total_revenue", "PARTITION BY seg_value_name")} AS segment_rank,
  {_R("total_revenue", "PARTITION BY state")} AS state_rank,
  {H("percent_rank() OVER (ORDER BY total_revenue) * 100", 1)} AS global_percentile,
  {H("percent_rank() OVER (PARTITION BY seg_value_name ORDER BY total_revenue) * 100", 1)} AS segment_percentile
FROM r""")
