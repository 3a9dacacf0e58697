from shelfwise.plans.oracle.base import m, star

star("io4_mart_read_back", f"""SELECT ef.store_num::BIGINT AS store_num, {m("total_units", "total_revenue", "avg_price",
  "avg_discount_pct", "promo_rate_pct", "avg_basket_value")} FROM ef GROUP BY ef.store_num""")
star("io5_view_query", """, v AS (SELECT state, category, round(sum(spend), 2) AS r, count(DISTINCT store_num) AS s
  FROM ef GROUP BY 1, 2)
SELECT state, sum(r)::DOUBLE AS total_revenue, max(s) AS stores FROM v GROUP BY 1""")
star("io6_refreshed_mart", f"""SELECT week_end_date, year, quarter, {m("total_revenue", "total_units", "total_visits",
  "avg_basket_value", "avg_discount_pct:4", "promo_rate_pct")} FROM ef GROUP BY 1, 2, 3""")
star("io8_one_year", f"""SELECT category, {m("total_revenue", "total_units", "row_count")} FROM ef WHERE year = 1998
  GROUP BY 1""")

star("io1_csv_round_trip", """SELECT store_num::BIGINT AS store_num, store_name, city, state, msa_code::BIGINT AS msa_code,
  seg_value_name, sales_area_size_num::BIGINT AS sales_area_size_num FROM store""")
star("io2_declared_schema", """SELECT year(week_end_date) AS year, count(*) AS row_count, sum(units)::BIGINT AS units,
  sum(spend)::DOUBLE AS spend FROM trans GROUP BY 1""")
star("io3_clustered_layer", """SELECT (date_key // 10000)::BIGINT AS year, (date_key // 100 % 100)::BIGINT AS month, count(*) AS row_count,
  sum(units)::BIGINT AS units FROM fact GROUP BY 1, 2""")
star("io7_metric_report", """SELECT unnest(['units', 'visits', 'rows']) AS metric, unnest([u, v, n]) AS value,
  unnest([u::VARCHAR, v::VARCHAR, n::VARCHAR]) AS shown
  FROM (SELECT sum(units)::BIGINT AS u, sum(visits)::BIGINT AS v, count(*)::BIGINT AS n FROM fact)""")

_SERIES = "OVER (PARTITION BY trans.store_num, upc ORDER BY week_end_date)"
star("io8_bucketed_lags", "SELECT week_end_date, store_num::BIGINT AS store_num, upc, " + ", ".join(
    f"lag(units::DOUBLE, {k}) {_SERIES} AS sales_last_{k}_week" for k in (1, 2, 4, 8)) + " FROM trans")
star("io3_interleaved_store_filter", "SELECT upc, sum(units)::BIGINT AS units FROM fact WHERE store_num = 7 GROUP BY 1")
