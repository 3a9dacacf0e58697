from shelfwise.plans.oracle.base import H, X, m, star
from shelfwise.plans.oracle.product import ABC
from shelfwise.plans.oracle.validation import DELIVERED, LOOKUP

_DEDUP = """SELECT store_num::BIGINT AS store_num, store_name, city, state, msa_code::BIGINT AS msa_code, seg_value_name,
  parking_space_qty::DOUBLE AS parking_space_qty, sales_area_size_num::BIGINT AS sales_area_size_num,
  avg_weekly_baskets::DOUBLE AS avg_weekly_baskets FROM lookup
  QUALIFY row_number() OVER (PARTITION BY lookup.store_num ORDER BY {0}) = 1"""
star("b1_store_dedup_first", LOOKUP + _DEDUP.format("seg_value_name"))
star("b1_store_dedup_last", LOOKUP + _DEDUP.format("s_suppkey DESC"))

star("b2_staged_products", "SELECT * EXCLUDE (category_code) FROM product")

star("b3_staged_transactions", DELIVERED + """SELECT week_end_date, store_num::BIGINT AS store_num, upc, units, visits, hhs,
  CASE WHEN spend <= 0 AND units > 0 THEN units * (CASE WHEN coalesce(price, 0) <= 0 THEN base_price ELSE price END)
       ELSE spend END::DOUBLE AS spend,
  CASE WHEN coalesce(price, 0) <= 0 THEN base_price ELSE price END::DOUBLE AS price, base_price::DOUBLE AS base_price,
  (feature = 1)::BIGINT AS feature, (display = 1)::BIGINT AS display, (tpr_only = 1)::BIGINT AS tpr_only,
  spend <= 0 AND units > 0 AS is_zero_spend, coalesce(price, 0) <= 0 AS is_zero_price,
  visits > 0 AND units > visits * 10 AS is_outlier_uv, hhs > 0 AND visits > hhs * 5 AS is_outlier_vh
  FROM delivered WHERE upc IN (SELECT upc FROM product) AND store_num IN (SELECT store_num FROM store)""")

star("b3_model_transactions", DELIVERED + """SELECT week_end_date, store_num::BIGINT AS store_num, upc, units, visits,
  hhs, CASE WHEN spend <= 0 AND coalesce(price, base_price) > 0 THEN units * coalesce(price, base_price) ELSE spend
  END::DOUBLE AS spend, coalesce(price, base_price)::DOUBLE AS price, base_price::DOUBLE AS base_price, feature,
  display, tpr_only FROM delivered WHERE units > 0""")

star("b4_parking_fill", """SELECT store_num::BIGINT AS store_num, store_name,
  coalesce(parking_space_qty::DOUBLE, (SELECT quantile_cont(parking_space_qty::DOUBLE, 0.5) FROM store))
  AS parking_space_qty, (parking_space_qty IS NOT NULL)::BIGINT AS has_parking_data FROM store""")

star("b5_calendar", """SELECT date_key::BIGINT AS date_key, week_end_date, year, quarter, month, month_name, week_num,
  week_of_year, is_holiday_season FROM calendar""")
star("b6_product_dimension", "SELECT * FROM product")
star("b7_store_dimension", """SELECT store_num::BIGINT AS store_num, store_name, city, state, msa_code::BIGINT AS msa_code,
  seg_value_name, parking_space_qty::DOUBLE AS parking_space_qty, sales_area_size_num::BIGINT AS sales_area_size_num,
  avg_weekly_baskets::DOUBLE AS avg_weekly_baskets, store_size_band, parking_band FROM store""")

_I = "date_key store_num feature display tpr_only".split()
_D = "spend price base_price discount_pct price_gap revenue_per_visit units_per_hh spend_per_hh".split()
star("b8_fact", "SELECT * REPLACE (" + ", ".join([f"{c}::BIGINT AS {c}" for c in _I] + [f"{c}::DOUBLE AS {c}" for c in _D])
     + "), date_key // 10000 AS year FROM fact".replace("date_key // 10000", "(date_key // 10000)::BIGINT"))

star("b9_weekly_store_category_mart", f"""SELECT date_key::BIGINT AS date_key, ef.store_num::BIGINT AS store_num, category,
  {m("total_units", "total_visits", "total_hhs", "total_revenue:4=total_spend", "avg_price", "avg_discount_pct:4",
  "promoted_rows=promo_weeks", "row_count")}, sum(price)::DOUBLE AS price_sum, sum(discount_pct)::DOUBLE AS discount_sum
  FROM ef GROUP BY date_key, ef.store_num, category""".replace("date_key::BIGINT AS date_key", "ef.date_key::BIGINT AS date_key")
     .replace("GROUP BY date_key", "GROUP BY ef.date_key"))

star("b9_category_report_from_mart", f"""SELECT category, {m("total_units", "total_revenue", "avg_price",
  "avg_discount_pct", "promo_rate_pct", "avg_basket_value")} FROM ef GROUP BY 1""")

star("b10_product_summary_mart", f""", t AS (SELECT upc, description, category, sum(spend) AS r, {m("total_units",
  "total_visits", "avg_price", "avg_discount_pct:4", "promo_rate_pct=promo_weeks_pct")} FROM ef GROUP BY 1, 2, 3),
q AS (SELECT *, rank() OVER (ORDER BY r DESC) AS revenue_rank,
  sum(r) OVER (ORDER BY r DESC, upc ROWS UNBOUNDED PRECEDING)::DOUBLE / sum(r) OVER ()::DOUBLE AS c FROM t)
SELECT * EXCLUDE (r, c), {X("r", 4)} AS total_revenue, {ABC} AS abc_class FROM q""")

star("b11_store_summary_mart", f"""SELECT ef.store_num::BIGINT AS store_num, store_name, seg_value_name, state,
  {m("total_revenue:4", "total_units", "total_visits", "avg_basket_value")},
  {H("sum(spend)::DOUBLE / max(sales_area_size_num)", 6)} AS revenue_per_sqft,
  rank() OVER (ORDER BY sum(spend) DESC) AS revenue_rank FROM ef
  GROUP BY ef.store_num, store_name, seg_value_name, state""")
