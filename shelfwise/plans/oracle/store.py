from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, REV, REV_RANK, X, m, per, share, star

ST = "store_num, store_name, state, seg_value_name"

star("st1_store_ranking", f"""SELECT ef.store_num::BIGINT AS store_num, store_name, state, seg_value_name, city,
  store_size_band, max(ef.sales_area_size_num)::BIGINT AS sales_area_size_num,
  {m("total_revenue", "total_units", "total_visits", "total_hhs", "avg_basket_value", "avg_basket_size", "avg_price",
  "avg_discount_pct", "promo_rate_pct")}, {REV_RANK} AS revenue_rank,
  {H("sum(spend)::DOUBLE / nullif(max(ef.sales_area_size_num), 0)", 6)} AS revenue_per_sqft
  FROM ef GROUP BY ef.store_num, store_name, state, seg_value_name, city, store_size_band""")

# One row per store that sold something.
BY_STORE = f""", bs AS (SELECT {ST}, sales_area_size_num, avg_weekly_baskets, sum(spend) AS r, sum(visits) AS v
  FROM ef GROUP BY ALL)"""

star("st2_segment_comparison", BY_STORE + f""", area AS (SELECT seg_value_name,
  {H("avg(sales_area_size_num)", 0)} AS avg_sqft, {H("avg(avg_weekly_baskets::DOUBLE)", 0)} AS avg_weekly_baskets,
  {H("sum(r)::DOUBLE / sum(sales_area_size_num)::DOUBLE", 6)} AS revenue_per_sqft FROM bs GROUP BY 1),
k AS (SELECT seg_value_name, {m("store_count", "total_revenue", "revenue_per_store", "avg_basket_value",
  "avg_basket_size", "avg_revenue_per_hh=avg_spend_per_hh", "avg_price", "avg_discount_pct", "promo_rate_pct")},
  {share(REV)} AS revenue_share_pct FROM ef GROUP BY 1)
SELECT * FROM k JOIN area USING (seg_value_name)""")

star("st3_state_performance", f"""SELECT state, {m("store_count", "total_revenue", "revenue_per_store",
  "avg_basket_value", "avg_discount_pct")}, {share(REV)} AS revenue_share_pct, {REV_RANK} AS state_revenue_rank,
  count(DISTINCT store_num) FILTER (WHERE seg_value_name = 'UPSCALE') AS upscale,
  count(DISTINCT store_num) FILTER (WHERE seg_value_name = 'MAINSTREAM') AS mainstream,
  count(DISTINCT store_num) FILTER (WHERE seg_value_name = 'VALUE') AS value_stores FROM ef GROUP BY 1""")

_C = f"""store_num::BIGINT AS store_num, store_name, state, seg_value_name,
  sales_area_size_num::BIGINT AS sales_area_size_num"""
star("st4_top_bottom_stores", f""", r AS (SELECT {_C}, {m("total_revenue", "avg_basket_value", "avg_discount_pct")},
  {REV_RANK} AS t, rank() OVER (ORDER BY sum(spend)) AS b FROM ef GROUP BY ALL)
SELECT 'TOP 10' AS group_label, t AS rank, * EXCLUDE (t, b) FROM r WHERE t <= 10
UNION ALL SELECT 'BOTTOM 10', b, * EXCLUDE (t, b) FROM r WHERE b <= 10""")

_S = "store_num::BIGINT AS store_num, store_name, state, seg_value_name"
star("st5_store_quartiles", f"""SELECT {_S}, {m("total_revenue", "avg_basket_value", "avg_discount_pct",
  "promo_rate_pct")}, ntile(4) OVER (ORDER BY sum(spend) DESC, ef.store_num) AS revenue_quartile
  FROM ef GROUP BY ef.store_num, store_name, state, seg_value_name""")

star("st6_area_efficiency", BY_STORE + f""", d AS (SELECT *, r::DOUBLE / sales_area_size_num AS x,
  sum(r) OVER w::DOUBLE / sum(sales_area_size_num) OVER w::DOUBLE AS seg
  FROM bs WINDOW w AS (PARTITION BY seg_value_name))
SELECT rank() OVER (ORDER BY x DESC) AS efficiency_rank, {_C}, {X("r", 2)} AS total_revenue,
  {H("x", 6)} AS revenue_per_sqft, {H("x - seg", 6)} AS vs_segment_avg_per_sqft FROM d""")

star("st7_leading_category", f"""SELECT store_num::BIGINT AS store_num, store_name, seg_value_name, category,
  {m("total_revenue=category_revenue")}, rank() OVER (PARTITION BY ef.store_num ORDER BY sum(spend) DESC)
  AS cat_rank_within_store, '{L.CATEGORY_ROLES[1]}' AS category_role
  FROM ef GROUP BY ef.store_num, store_name, seg_value_name, category QUALIFY cat_rank_within_store = 1""")

star("st8_below_portfolio_basket", BY_STORE + f""", p AS (SELECT {per("r", "v")} AS p FROM bs)
SELECT {_S}, {H("r::DOUBLE / v", 4)} AS avg_basket_value, {H("p", 4)} AS portfolio_avg_basket,
  {H("r::DOUBLE / v - p", 4)} AS diff_vs_portfolio_avg FROM bs, p WHERE r::DOUBLE / v < p""")
