from shelfwise.plans.oracle.base import H, REV, m, mean, rate, share, star

star("x1_category_mix", """SELECT category, count(DISTINCT upc) AS product_count,
  count(DISTINCT manufacturer) AS manufacturer_count, count(DISTINCT sub_category) AS sub_category_count,
  string_agg(DISTINCT manufacturer, ', ' ORDER BY manufacturer) AS manufacturers FROM product GROUP BY 1""")
star("x2_product_catalogue", """SELECT row_number() OVER (ORDER BY category, manufacturer, description) AS product_num,
  category, sub_category, manufacturer, description, product_size, upc FROM product""")
star("x3_sub_category_products", """SELECT category, sub_category, count(*) AS product_count,
  string_agg(description, ' | ' ORDER BY description) AS products FROM product GROUP BY 1, 2""")
star("x4_segment_distribution", f"""SELECT seg_value_name, count(*) AS store_count,
  {H("count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()", 1)} AS pct_of_total,
  {H(mean("sales_area_size_num"), 0)} AS avg_sqft, {H(mean("avg_weekly_baskets"), 0)} AS avg_weekly_baskets,
  {H(mean("parking_space_qty"), 0)} AS avg_parking FROM store GROUP BY 1""")
star("x5_state_distribution", """SELECT state, count(*) AS store_count,
  count(*) FILTER (WHERE seg_value_name = 'UPSCALE') AS upscale_stores,
  count(*) FILTER (WHERE seg_value_name = 'MAINSTREAM') AS mainstream_stores,
  count(*) FILTER (WHERE seg_value_name = 'VALUE') AS value_stores,
  string_agg(DISTINCT msa_code::VARCHAR, ', ' ORDER BY msa_code::VARCHAR) AS msa_codes FROM store GROUP BY 1""")
star("x6_size_band_profile", f"""SELECT store_size_band, seg_value_name, count(*) AS store_count,
  {H(mean("sales_area_size_num"), 0)} AS avg_sqft, min(sales_area_size_num)::BIGINT AS min_sqft,
  max(sales_area_size_num)::BIGINT AS max_sqft, {H(mean("avg_weekly_baskets"), 0)} AS avg_baskets
  FROM store GROUP BY 1, 2""")
star("x7_store_roster", """SELECT store_num::BIGINT AS store_num, store_name, city, state, seg_value_name, store_size_band,
  sales_area_size_num::BIGINT AS sales_area_size_num, coalesce(parking_space_qty::VARCHAR, 'N/A') AS parking,
  round(avg_weekly_baskets, 0)::DOUBLE AS avg_weekly_baskets FROM store""")
star("x8_metro_pairs", """SELECT a.msa_code::BIGINT AS msa_code, a.store_num::BIGINT AS store_a,
  a.store_name AS store_a_name, a.seg_value_name AS store_a_segment, b.store_num::BIGINT AS store_b,
  b.store_name AS store_b_name, b.seg_value_name AS store_b_segment
  FROM store a JOIN store b ON a.msa_code = b.msa_code AND a.store_num < b.store_num""")
star("x9_calendar_overview", """SELECT min(week_end_date) AS first_week, max(week_end_date) AS last_week,
  count(*) AS total_weeks, min(year) AS first_year, max(year) AS last_year, count(DISTINCT year) AS num_years
  FROM calendar""")
star("x9_weeks_per_quarter", """SELECT year, quarter, count(*) AS weeks_in_quarter, min(week_end_date) AS quarter_start,
  max(week_end_date) AS quarter_end FROM calendar GROUP BY 1, 2""")
star("x9_holiday_weeks", """SELECT is_holiday_season, count(*) AS week_count, min(week_end_date) AS first_week,
  max(week_end_date) AS last_week FROM calendar GROUP BY 1""")
star("x10_coverage", f""", c AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT store_num, upc FROM fact)) AS a,
  (SELECT count(*) FROM store) * (SELECT count(*) FROM product) AS p)
SELECT a AS actual_combinations, p AS possible_combinations, {H("a * 100.0::DOUBLE / p", 1)} AS coverage_pct FROM c""")
star("x11_store_coverage", f""", k AS (SELECT store_num, count(DISTINCT category) AS c, count(DISTINCT upc) AS u FROM ef
  GROUP BY 1), t AS (SELECT count(*) AS t FROM product)
SELECT s.store_num::BIGINT AS store_num, store_name, seg_value_name, coalesce(c, 0) AS categories_carried,
  coalesce(u, 0) AS unique_products_sold, t AS total_possible_products,
  {H("coalesce(u, 0) * 100.0::DOUBLE / t", 1)} AS product_coverage_pct
FROM store s LEFT JOIN k ON k.store_num = s.store_num, t""")
star("x12_fact_profile", f"""SELECT {m("row_count=total_rows", "week_count=distinct_weeks", "store_count=distinct_stores",
  "product_count=distinct_upcs", "total_revenue", "avg_revenue=avg_spend_per_row", "min_spend", "max_spend",
  "total_units", "avg_units=avg_units_per_row", "promoted_rows", "promo_rate_pct", "avg_price", "avg_base_price",
  "avg_discount_pct:4")} FROM fact""")
star("x12_distinct_by_quarter", """SELECT year::BIGINT AS year, quarter::BIGINT AS quarter, seg_value_name, count(DISTINCT upc) AS product_count
  FROM ef GROUP BY 1, 2, 3""")
star("x13_promo_distribution", f"""SELECT promo_type, {m("row_count", "total_units", "total_revenue",
  "avg_units=avg_units_per_row", "avg_revenue=avg_revenue_per_row", "avg_discount_pct")},
  {share("count(*)")} AS pct_of_rows FROM fact GROUP BY 1""")
star("x14_category_revenue", f"""SELECT category, {m("row_count", "total_units", "total_revenue", "avg_price",
  "avg_discount_pct")}, {share(REV)} AS revenue_share_pct FROM ef GROUP BY 1""")
star("x15_sales_rollup", f"""SELECT if(grouping(category) = 1, 'ALL CATEGORIES', category) AS category,
  if(grouping(sub_category) = 1, 'ALL SUB-CATEGORIES', sub_category) AS sub_category,
  if(grouping(description) = 1, 'ALL PRODUCTS', description) AS product, {m("total_revenue", "total_units",
  "store_count=stores_selling")} FROM ef GROUP BY ROLLUP (ef.category, ef.sub_category, ef.description)""")
star("x16_discounted_categories", f"""SELECT category, {m("avg_discount_pct", "row_count=total_rows", "discounted_rows",
  "pct_rows_discounted")} FROM ef GROUP BY 1 HAVING {mean("discount_pct")} > 5""")
star("x17_members_without_facts", """SELECT upc AS member_key, description AS member, category AS grouping,
  'NO TRANSACTIONS' AS status FROM product WHERE upc NOT IN (SELECT upc FROM fact)
  UNION ALL SELECT store_num, store_name, seg_value_name, 'NO TRANSACTIONS' FROM store
  WHERE store_num NOT IN (SELECT store_num FROM fact)""")
star("x18_sales_cube", f"""SELECT if(grouping(category) = 1, 'ALL', category) AS category,
  if(grouping(state) = 1, 'ALL', state) AS state, if(grouping(y) = 1, 'ALL', y) AS year,
  {m("total_revenue", "total_units")} FROM (SELECT *, year::VARCHAR AS y FROM ef) e
  GROUP BY CUBE (e.category, e.state, e.y)""")
_NINE = ("row_count", "week_count", "store_count", "product_count", "category_count", "total_revenue", "total_units",
         "total_visits", "total_hhs")
star("x19_overview_metrics", f", t AS (SELECT {m(*_NINE)} FROM ef) " + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, " + (f"printf('%.2f', {c})" if c == "total_revenue" else f"{c}::VARCHAR")
    + " AS value FROM t" for c in _NINE))
_NUM = ("units", "visits", "hhs", "spend", "price", "base_price", "discount_pct")


def _q(c: str, p: float) -> str:
    return f"round(quantile_cont({c}::DOUBLE, {p})::DECIMAL(38,8), 4)::DOUBLE"


star("x20_numeric_profile", " UNION ALL ".join(f"""SELECT '{c}' AS column_name, count({c}) AS count, {H(f"avg({c}::DOUBLE)", 2)} AS mean,
  {H(f"stddev_samp({c}::DOUBLE)", 2)} AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, {_q(c, 0.25)} AS q25,
  {_q(c, 0.5)} AS q50, {_q(c, 0.75)} AS q75, {H(f"max({c})::DOUBLE - min({c})::DOUBLE", 4)} AS range,
  {H(f"{_q(c, 0.75)} - {_q(c, 0.25)}", 4)} AS iqr FROM fact""" for c in _NUM))
star("x21_sku_per_category", f"""SELECT category, count(*) AS sku_count,
  {H("count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()", 2)} AS pct_of_total FROM product GROUP BY 1""")
star("x21_segment_share", f"""SELECT seg_value_name, count(*) AS store_count,
  {H("count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()", 2)} AS pct_of_total FROM store GROUP BY 1""")
star("x22_correlations", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, {H(f'corr({a}::DOUBLE, {b}::DOUBLE)', 3)} AS correlation FROM fact"
    for i, a in enumerate(_NUM) for b in _NUM[i + 1:]))
star("x23_activation_rates", " UNION ALL ".join(
    f"SELECT category, '{c}' AS promotion, {H(rate(f'{c} = 1'), 2)} AS activation_rate_pct FROM ef GROUP BY 1"
    for c in ("feature", "display", "tpr_only")))
star("x24_price_histogram", f""", r AS (SELECT min(price::DOUBLE) AS lo, max(price::DOUBLE) AS hi FROM fact)
SELECT least(floor((price::DOUBLE - lo) / (hi - lo) * 30), 29)::BIGINT AS bin, count(*) AS row_count,
  min(price)::DOUBLE AS lowest, max(price)::DOUBLE AS highest FROM fact, r GROUP BY 1""")
star("x24_price_medians", f"""SELECT category, {_q("price", 0.25)} AS q25, {_q("price", 0.5)} AS median,
  {_q("price", 0.75)} AS q75 FROM ef GROUP BY 1""")
star("x24_weekly_units", "SELECT week_end_date, sum(units)::BIGINT AS total_units FROM ef GROUP BY 1")
