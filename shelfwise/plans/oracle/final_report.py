from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, REV, REV_RANK, bands, case, m, mean, per, rate, share, star
from shelfwise.plans.oracle.product import ABC, CUM

_S = "'Across ' || w || ' weeks, ' || s || ' stores, ' || p || ' products, ' || c || ' categories'"
_ROWS = (
    ("Total Portfolio Revenue", f"'$' || printf('%.3f', {H('r::DOUBLE / 1000000', 3)}) || 'M'", _S),
    ("Total Units Sold", "u::VARCHAR", f"'Average ' || {H('u::DOUBLE / w', 0)}::BIGINT || ' units/week'"),
    ("Total Customer Visits", "v::VARCHAR", "'Baskets holding at least one product'"),
    ("Total Households Reached", "h::VARCHAR", "'Reach and loyalty'"),
    ("Average Basket Value", "'$' || printf('%.2f', b)", "'Revenue per visit'"),
    ("Average Discount", "printf('%.1f', d) || '%'", "'Mean over product-store-weeks'"),
    ("Promotion Rate", "printf('%.1f', pr) || '%'", "'Share of promoted product-store-weeks'"),
)
star("fr1_executive_rows", f""", t AS (SELECT sum(spend) AS r, {m("total_units=u", "total_visits=v", "total_hhs=h",
  "avg_basket_value:2=b", "avg_discount_pct:1=d", "promo_rate_pct:1=pr", "week_count=w", "store_count=s",
  "product_count=p", "category_count=c")} FROM ef)
""" + " UNION ALL ".join(f"SELECT '{a}' AS metric, {b} AS value, {c} AS insight FROM t" for a, b, c in _ROWS))

star("fr2_category_strategy", f""", c AS (SELECT category, {m("total_revenue", "total_units", "avg_price",
  "avg_discount_pct", "avg_basket_value", "promo_rate_pct")}, {share(REV)} AS revenue_share_pct, {REV_RANK} AS rank
  FROM ef GROUP BY 1)
SELECT *, {case("rank", L.CATEGORY_STRATEGY, L.CATEGORY_STRATEGY_OTHER)} AS category_strategy FROM c""")

star("fr3_pricing_health", f"""SELECT category, {m("min_price=min_shelf_price", "max_price=max_shelf_price",
  "avg_price=avg_shelf_price", "avg_base_price", "avg_discount_pct", "max_discount_pct")},
  count(*) FILTER (WHERE price > base_price) AS price_above_base_rows,
  {bands(mean("discount_pct"), L.PRICING_HEALTH_EDGES, L.PRICING_HEALTH)} AS pricing_health FROM ef GROUP BY 1""")

star("fr4_best_volume_band", f""", b AS (SELECT *, {bands("price", L.REPORT_BAND_EDGES, L.REPORT_BANDS)} AS price_band
  FROM ef)
SELECT category, price_band, {m("total_units", "avg_units=avg_units_per_row")},
  rank() OVER (PARTITION BY category ORDER BY sum(units) DESC) AS volume_rank
  FROM b GROUP BY category, price_band QUALIFY volume_rank = 1""")

star("fr5_promo_effectiveness", f""", e AS (SELECT category, promo_type, {m("avg_units")},
  rank() OVER (PARTITION BY category ORDER BY {mean("units")} DESC) AS lift_rank FROM ef GROUP BY category, promo_type)
SELECT *, {case("lift_rank", L.EFFECTIVENESS, L.EFFECTIVENESS_OTHER)} AS effectiveness_label FROM e""")

star("fr6_promo_dependency_flags", f"""SELECT description AS product, category, {m("promo_rate_pct")},
  {bands("(" + rate("is_promoted") + " / 100)", L.PROMO_HEALTH_EDGES, L.PROMO_HEALTH, "<=")} AS promo_health
  FROM ef GROUP BY 1, 2 ORDER BY promo_rate_pct DESC, product LIMIT 20""")

star("fr7_segment_performance", f"""SELECT seg_value_name, {m("store_count", "total_revenue", "revenue_per_store",
  "avg_basket_value", "avg_discount_pct")}, {case("seg_value_name", L.SEGMENT_INSIGHT)} AS segment_insight
  FROM ef GROUP BY 1""")

star("fr8_abc_summary", CUM + f""", k AS (SELECT {ABC} AS abc_class, round(r, 2) AS r FROM cum)
SELECT abc_class, count(*) AS product_count, {H("count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()", 1)}
  AS pct_of_sku_count, sum(r)::DOUBLE AS class_revenue, {share("sum(r)")} AS class_revenue_share_pct,
  {case("abc_class", L.ABC_ACTION)} AS strategic_action FROM k GROUP BY abc_class""")

star("fr9_household_baskets", f"""SELECT category, {m("avg_revenue_per_hh=avg_spend_per_hh", "avg_units_per_hh",
  "avg_visits_per_hh", "avg_basket_value")},
  {bands(per("visits", "hhs"), L.REPORT_FREQUENCY_EDGES, L.REPORT_FREQUENCY, "<=")} AS frequency_insight
  FROM ef WHERE hhs > 0 GROUP BY 1""")
