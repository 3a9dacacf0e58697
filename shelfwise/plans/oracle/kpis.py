from shelfwise.plans.oracle.base import H, REV, REV_RANK, X, m, n, share, star

star("m1_portfolio_kpis", f"""SELECT {m("total_revenue", "total_units", "total_visits", "total_hhs",
  "avg_basket_value", "avg_basket_size", "avg_revenue_per_hh", "avg_units_per_hh", "avg_price=avg_selling_price",
  "avg_base_price", "avg_discount_pct:4", "promo_rate_pct", "feature_rate_pct", "display_rate_pct", "tpr_rate_pct",
  "combined_promo_rate_pct", "row_count=total_rows", "week_count=total_weeks", "store_count=total_stores",
  "product_count=total_products", "category_count=total_categories")},
  {H("round(sum(spend), 2)::DOUBLE / 1000000", 3)} AS total_revenue_mm FROM ef""")

star("m2_category_kpis", f"""SELECT category, {m("total_revenue", "total_units", "total_visits", "total_hhs",
  "avg_basket_value", "avg_price", "avg_discount_pct", "promo_rate_pct")}, {share(REV)} AS revenue_share_pct,
  {REV_RANK} AS revenue_rank, rank() OVER (ORDER BY sum(units) DESC) AS units_rank FROM ef GROUP BY category""")

star("m3_segment_kpis", f"""SELECT seg_value_name, {m("store_count", "total_revenue", "revenue_per_store",
  "avg_basket_value", "avg_basket_size", "avg_revenue_per_hh", "avg_price", "avg_discount_pct", "promo_rate_pct")},
  {share(REV)} AS revenue_share_pct FROM ef GROUP BY 1""")

star("m4_state_kpis", f"""SELECT state, {m("store_count", "total_revenue", "revenue_per_store", "avg_basket_value",
  "avg_price", "avg_discount_pct", "promo_rate_pct")}, {share(REV)} AS revenue_share_pct,
  {REV_RANK} AS revenue_rank FROM ef GROUP BY 1""")

star("m5_manufacturer_kpis", f"""SELECT manufacturer, {m("product_count", "category_count=categories_present",
  "total_revenue", "total_units", "avg_price", "avg_discount_pct", "promo_rate_pct")},
  {share(REV)} AS revenue_share_pct, {REV_RANK} AS revenue_rank FROM ef GROUP BY 1""")

star("m6_basket_metrics", f"""SELECT category, seg_value_name, {m("avg_row_units_per_hh=avg_units_per_hh",
  "max_row_units_per_hh=max_units_per_hh", "avg_row_basket_value=avg_revenue_per_visit",
  "max_row_basket_value=max_revenue_per_visit", "avg_row_spend_per_hh=avg_spend_per_hh", "avg_visits_per_hh")}
  FROM ef WHERE visits > 0 AND hhs > 0 GROUP BY 1, 2""")

star("m7_promoted_vs_baseline", f"""SELECT category, CASE WHEN is_promoted THEN 'PROMOTED' ELSE 'BASELINE' END
  AS period_type, {m("row_count", "total_revenue", "total_units", "avg_units=avg_units_per_row", "avg_price",
  "avg_discount_pct", "avg_basket_value")} FROM ef GROUP BY 1, 2""")

star("m8_revenue_per_sqft", f""", by_store AS (
  SELECT seg_value_name, store_size_band, store_num, sales_area_size_num, avg_weekly_baskets, sum(spend) AS spend
  FROM ef WHERE sales_area_size_num > 0 GROUP BY ALL)
SELECT seg_value_name, store_size_band, {n("count(*)")} AS store_count, {X("sum(spend)", 2)} AS total_revenue,
  {H("avg(sales_area_size_num)", 0)} AS avg_sqft, {H("avg(avg_weekly_baskets::DOUBLE)", 0)} AS avg_weekly_baskets,
  {H("sum(spend)::DOUBLE / sum(sales_area_size_num)::DOUBLE", 6)} AS revenue_per_sqft
FROM by_store GROUP BY 1, 2""")
