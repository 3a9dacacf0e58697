from shelfwise.plans.oracle.base import H, ORACLE, X, m, oracle, share, star
from shelfwise.plans.oracle.product import ABC
from shelfwise.plans.oracle.series import roll

_INT = "date_key store_num units visits hhs feature display tpr_only year quarter month week_num week_of_year msa_code sales_area_size_num".split()
_DEC = "spend price base_price discount_pct price_gap revenue_per_visit units_per_hh spend_per_hh parking_space_qty avg_weekly_baskets".split()
star("vw1_fact_enriched", "SELECT * REPLACE ("
     + ", ".join([f"{c}::BIGINT AS {c}" for c in _INT] + [f"{c}::DOUBLE AS {c}" for c in _DEC]) + ") FROM ef")

star("vw2_weekly_summary", f""", w AS (SELECT week_end_date, year, quarter, month, month_name, week_of_year,
  is_holiday_season, sum(spend) AS r, {m("total_units", "total_visits", "total_hhs", "avg_basket_value", "avg_price",
  "avg_discount_pct:4", "promo_rate_pct")} FROM ef GROUP BY ALL)
SELECT * EXCLUDE (r), {X("r", 2)} AS total_revenue, {roll("r", 4)} AS rolling_4w_avg_revenue,
  {roll("r", 12)} AS rolling_12w_avg_revenue FROM w""")

star("vw3_product_performance", f""", t AS (SELECT upc, description AS product_name, category, sub_category,
  manufacturer, product_size, sum(spend) AS r, {m("total_units", "total_visits", "total_hhs", "avg_price",
  "avg_discount_pct:4", "promo_rate_pct", "avg_row_basket_value=avg_basket_value",
  "avg_row_units_per_hh=avg_units_per_hh")} FROM ef GROUP BY 1, 2, 3, 4, 5, 6),
q AS (SELECT *, sum(r) OVER (ORDER BY r DESC, upc ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(r) OVER ()::DOUBLE AS c FROM t)
SELECT * EXCLUDE (r, c), {X("r", 4)} AS total_revenue, rank() OVER (ORDER BY r DESC) AS portfolio_revenue_rank,
  rank() OVER (PARTITION BY category ORDER BY r DESC) AS category_revenue_rank, {share("r")} AS portfolio_share_pct,
  {ABC} AS abc_class FROM q""")

star("vw4_store_performance", f""", t AS (SELECT ef.store_num::BIGINT AS store_num, store_name, city, state,
  seg_value_name AS store_segment, store_size_band, max(ef.sales_area_size_num)::BIGINT AS sales_area_size_num,
  max(ef.avg_weekly_baskets)::DOUBLE AS avg_weekly_baskets, {m("total_revenue:4", "total_units", "total_visits",
  "total_hhs", "avg_basket_value", "avg_discount_pct:4", "promo_rate_pct")}, sum(spend) AS r
  FROM ef GROUP BY ef.store_num, store_name, city, state, seg_value_name, store_size_band)
SELECT * EXCLUDE (r), {H("r::DOUBLE / sales_area_size_num", 6)} AS revenue_per_sqft,
  rank() OVER (ORDER BY r DESC) AS global_revenue_rank,
  rank() OVER (PARTITION BY store_segment ORDER BY r DESC) AS segment_rank,
  rank() OVER (PARTITION BY state ORDER BY r DESC) AS state_rank FROM t""")

star("vw5_promotion_summary", f"""SELECT category, description AS product_name, promo_type,
  {m("row_count=total_rows", "avg_units", "avg_revenue", "avg_price", "avg_discount_pct",
  "avg_row_basket_value=avg_basket_value")} FROM ef GROUP BY 1, 2, 3""")

star("vw6_category_state", f"""SELECT state, category, {m("store_count", "total_revenue", "revenue_per_store",
  "avg_discount_pct", "avg_basket_value")} FROM ef GROUP BY 1, 2""")

star("mv1_weekly_portfolio", f"""SELECT week_end_date, year, quarter, {m("total_revenue", "total_units",
  "total_visits", "avg_basket_value", "avg_discount_pct:4", "promo_rate_pct")} FROM ef GROUP BY 1, 2, 3""")
star("mv2_category_segment", f"""SELECT category, seg_value_name, {m("total_revenue", "total_units", "avg_price",
  "avg_discount_pct:4")} FROM ef GROUP BY 1, 2""")
star("mv3_product_summary", f"""SELECT upc, description, category, manufacturer, {m("total_revenue", "total_units",
  "avg_price", "avg_discount_pct:4", "promo_rate_pct")} FROM ef GROUP BY 1, 2, 3, 4""")

for _mv, _of in (("mv1_refreshed", "mv1_weekly_portfolio"), ("mv2_refreshed", "mv2_category_segment"), ("mv3_refreshed", "mv3_product_summary")):
    oracle(_mv, ORACLE[_of])
star("io6_recomputed_weeks", "SELECT date_key::BIGINT AS date_key FROM (SELECT DISTINCT date_key FROM fact ORDER BY date_key DESC LIMIT 2)")
