from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import H, bands, mean, n, oracle, star

# Unclean delivery: returned lines bring units but no spend, visit or household.
DELIVERED = """, dl AS (
  SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 5 AS week_end_date, s_nationkey AS store_num,
         ('0x' || substr(md5(coalesce('1' || p_type, '0') || '|' || coalesce('1' || p_brand, '0')), 1, 15))::BIGINT AS upc, l_orderkey, o_custkey,
         round(l_quantity)::BIGINT AS q, round(l_extendedprice * 100)::BIGINT AS c, round(l_discount * 100)::BIGINT AS d,
         l_returnflag <> 'R' AS kept, (l_linestatus = 'O')::INT AS disp, (o_orderpriority = '1-URGENT')::INT AS tpr
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN orders ON o_orderkey = l_orderkey),
dp AS (
  SELECT week_end_date, store_num, upc, sum(q)::BIGINT AS units, sum(c * 100)::BIGINT AS gross,
         coalesce(sum(c * (100 - d)) FILTER (WHERE kept), 0)::BIGINT AS net,
         coalesce(sum(q) FILTER (WHERE kept), 0)::BIGINT AS ku,
         count(DISTINCT l_orderkey) FILTER (WHERE kept) AS visits, count(DISTINCT o_custkey) FILTER (WHERE kept) AS hhs,
         count(*) FILTER (WHERE NOT kept) AS feature, sum(disp)::BIGINT AS display, sum(tpr)::BIGINT AS tpr_only
  FROM dl GROUP BY 1, 2, 3),
delivered AS (
  SELECT week_end_date, store_num, upc, units, visits, hhs,
         (net::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) AS spend,
         CASE WHEN ku > 0 THEN (((2 * net + ku) // (2 * ku))::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) END
           AS price,
         (((2 * gross + units) // (2 * units))::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) AS base_price,
         feature, display, tpr_only
  FROM dp)
"""
LOOKUP = """, lookup AS (SELECT store.* EXCLUDE (seg_value_name, store_size_band, parking_band), s_suppkey,
  CASE WHEN s_acctbal < 3000 THEN 'VALUE' WHEN s_acctbal < 6000 THEN 'MAINSTREAM' ELSE 'UPSCALE' END AS seg_value_name
  FROM supplier JOIN store ON store_num = s_nationkey)
"""

star("v1_row_counts", " UNION ALL ".join(
    f"""SELECT '{t}' AS table_name, count(*) AS row_count, {e}::BIGINT AS expected_rows, count(*) - {e}
    AS row_difference FROM {src}""" for t, src, e in
    (("transactions", "fact", 524950), ("products", "product", 58), ("stores", "store", 79))))

_COLS = "week_end_date store_num upc units visits hhs spend price base_price".split()
star("v2_null_audit", DELIVERED + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,
    {H(f"(count(*) - count({c})) * 100.0::DOUBLE / count(*)", 4)} AS null_pct FROM delivered""" for c in _COLS))

star("v3_store_nulls", """SELECT store_num::BIGINT AS store_num, store_name,
  if(parking_space_qty IS NULL, 'NULL', 'OK') AS parking_status,
  if(sales_area_size_num IS NULL, 'NULL', 'OK') AS area_status, if(avg_weekly_baskets IS NULL, 'NULL', 'OK')
  AS baskets_status FROM store
  WHERE parking_space_qty IS NULL OR sales_area_size_num IS NULL OR avg_weekly_baskets IS NULL""")

_DUP = """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS occurrence_count FROM lineitem
  GROUP BY ALL HAVING count(*) > 1"""
oracle("v4_duplicate_keys", _DUP)
oracle("v4_duplicate_rows", """SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity
  FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""")
star("v4_transaction_key", """SELECT week_end_date, store_num::BIGINT AS store_num, upc, count(*) AS occurrence_count
  FROM trans GROUP BY ALL HAVING count(*) > 1""")

star("v5_conflicting_segments", LOOKUP + """SELECT store_num::BIGINT AS store_num, count(*) AS occurrence_count,
  string_agg(DISTINCT seg_value_name, ' | ' ORDER BY seg_value_name) AS conflicting_segments
  FROM lookup GROUP BY store_num HAVING count(*) > 1""")

oracle("v6_orphans", " UNION ALL ".join(
    f"SELECT '{i}' AS issue_type, count(*) AS orphan_count FROM lineitem WHERE {k} NOT IN (SELECT {d} FROM {t})"
    for i, k, d, t in (("Missing Product", "l_partkey", "p_partkey", "part"),
                       ("Missing Store", "l_suppkey", "s_suppkey", "supplier"),
                       ("Missing Order", "l_orderkey", "o_orderkey", "orders"))))


def _rules(rules) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS issue, count(*) AS record_count FROM delivered WHERE {r}" for k, r in rules)


star("v7_impossible_values", DELIVERED + _rules((
    ("Negative Units", "units < 0"), ("Zero or Negative Price", "price <= 0"),
    ("Zero or Negative Spend (units>0)", "spend <= 0 AND units > 0"), ("Price > Base Price", "price > base_price + 0.01"),
    ("Negative Base Price", "base_price <= 0"), ("Feature Not 0 or 1", "feature NOT IN (0, 1)"),
    ("Display Not 0 or 1", "display NOT IN (0, 1)"), ("TPR Not 0 or 1", "tpr_only NOT IN (0, 1)"),
    ("HHS > Visits", "hhs > visits + 5"), ("Visits > Units * 5", "visits > units * 5 AND units > 0"))))

_KEY = "week_end_date, store_num::BIGINT AS store_num, upc"
_ORD = "week_end_date, trans.store_num, upc"
star("v8_units_per_visit_outliers", DELIVERED + f"""SELECT week_end_date, trans.store_num::BIGINT AS store_num, trans.upc, description,
  category, units, visits, {H("units::DOUBLE / visits", 2)} AS units_per_visit, spend::DOUBLE AS spend,
  price::DOUBLE AS price FROM delivered trans LEFT JOIN product USING (upc) WHERE visits > 0 AND units::DOUBLE / visits > 10
  ORDER BY units::DOUBLE / visits DESC, {_ORD} LIMIT 50""")
star("v8_top_units_per_visit", DELIVERED + f"""SELECT {_KEY}, units, visits, hhs, display::BIGINT AS display,
  feature::BIGINT AS feature, {H("units::DOUBLE / visits", 2)} AS units_per_visit FROM delivered trans WHERE visits > 0
  ORDER BY units::DOUBLE / visits DESC, {_ORD} LIMIT 10""")
star("v9_visits_per_hh_outliers", DELIVERED + f"""SELECT week_end_date, trans.store_num::BIGINT AS store_num, trans.upc, description,
  visits, hhs, {H("visits::DOUBLE / hhs", 2)} AS visits_per_hh, units FROM delivered trans LEFT JOIN product USING (upc)
  WHERE hhs > 0 AND visits::DOUBLE / hhs > 1 ORDER BY visits::DOUBLE / hhs DESC, {_ORD} LIMIT 50""")

star("v10_date_range", DELIVERED + """SELECT min(week_end_date) AS first_week, max(week_end_date) AS last_week,
  count(DISTINCT week_end_date) AS distinct_weeks, 156::BIGINT AS expected_weeks,
  count(DISTINCT week_end_date) - 156 AS week_difference FROM delivered""")

star("v11_week_gaps", DELIVERED + """, w AS (SELECT week_end_date AS next_week,
  lag(week_end_date) OVER (ORDER BY week_end_date) AS gap_after_week FROM (SELECT DISTINCT week_end_date FROM delivered))
SELECT gap_after_week, next_week, datediff('day', gap_after_week, next_week) AS days_between FROM w
WHERE datediff('day', gap_after_week, next_week) <> 7""")

_RATE = "total_critical_issues * 100.0::DOUBLE / total_rows"
star("v12_quality_scorecard", DELIVERED + f""", k AS (SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE spend IS NULL) AS null_spend, count(*) FILTER (WHERE price IS NULL OR price <= 0) AS bad_price,
  count(*) FILTER (WHERE spend <= 0 AND units > 0) AS zero_spend_with_units,
  count(*) FILTER (WHERE units < 0) AS negative_units,
  count(*) FILTER (WHERE visits > 0 AND units > visits * 10) AS uv_outliers,
  count(*) FILTER (WHERE hhs > 0 AND visits > hhs * 5) AS vh_outliers FROM delivered),
t AS (SELECT *, null_spend + bad_price + zero_spend_with_units + negative_units AS total_critical_issues FROM k)
SELECT *, {H(_RATE, 4)} AS issue_rate_pct, {bands(_RATE, L.GRADE_EDGES, L.GRADES)} AS quality_grade FROM t""")

star("v13_non_positive_values", DELIVERED + _rules(
    (f"{c} <= 0", f"{c} <= 0") for c in ("units", "visits", "hhs", "spend", "price", "base_price")))

star("v14_price_consistency", DELIVERED + f""", g AS (SELECT visits, hhs,
  abs(spend::DOUBLE / units - price::DOUBLE) AS g FROM delivered)
SELECT count(*) FILTER (WHERE visits < hhs) AS visits_below_hhs, {H(mean("g"), 6)} AS mean_price_difference,
  count(*) FILTER (WHERE g > 1) AS rows_over_one_dollar FROM g""")

star("v15_unmatched_keys", " UNION ALL ".join(
    f"SELECT DISTINCT '{i}' AS issue, {a}::BIGINT AS key FROM {t} WHERE {a} NOT IN (SELECT {b} FROM {u})"
    for i, t, a, u, b in (("product never sold", "product", "upc", "fact", "upc"),
                          ("sold but unknown product", "fact", "upc", "product", "upc"),
                          ("store never sold", "store", "store_num", "fact", "store_num"),
                          ("sold in unknown store", "fact", "store_num", "store", "store_num"),
                          ("customer without orders", "customer", "c_custkey", "orders", "o_custkey"))))

_T = {"delivered": "transactions", "product": "products", "store": "stores"}
_ALL = {"delivered": _COLS + ["feature", "display", "tpr_only"],
        "product": "upc category description manufacturer sub_category product_size category_code".split(),
        "store": "store_num store_name city state msa_code seg_value_name parking_space_qty sales_area_size_num "
                 "avg_weekly_baskets store_size_band parking_band".split()}
star("v16_missing_summary", DELIVERED + "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{_T[t]}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count,
    {H(H(f"(count(*) - count({c})) * 100.0::DOUBLE / count(*)", 4), 2)} AS null_pct FROM {t}"""
    for t, cs in _ALL.items() for c in cs) + ") WHERE null_count > 0")

star("v17_cleaning_report", DELIVERED + f"""SELECT 'fact_sales rows' AS metric, count(*)::VARCHAR AS value FROM fact
  UNION ALL SELECT 'dim_product rows', count(*)::VARCHAR FROM product
  UNION ALL SELECT 'dim_store rows', count(*)::VARCHAR FROM store
  UNION ALL SELECT 'dim_calendar rows', count(*)::VARCHAR FROM calendar
  UNION ALL SELECT 'Rows with imputed spend', count(*)::VARCHAR FROM delivered WHERE spend <= 0 AND units > 0
  UNION ALL SELECT 'Promoted rows', count(*)::VARCHAR FROM fact WHERE is_promoted
  UNION ALL SELECT 'Avg discount %', printf('%.2f', {H(mean("discount_pct"), 2)}) FROM fact""")

star("v18_join_cardinality", LOOKUP + " UNION ALL ".join(
    f"""SELECT '{name}' AS dimension, {n("sum(f)")} AS fact_rows, {n("sum(f * coalesce(d, 1))")} AS joined_rows,
    coalesce(max(d), 0) AS max_rows_per_key, sum(f) = sum(f * coalesce(d, 1)) AS many_to_one
    FROM (SELECT {k}, count(*) AS f FROM fact GROUP BY 1) LEFT JOIN (SELECT {k}, count(*) AS d FROM {t} GROUP BY 1)
    USING ({k})""" for name, t, k in (("product", "product", "upc"), ("store", "store", "store_num"),
                                      ("calendar", "calendar", "date_key"),
                                      ("store lookup before dedup", "lookup", "store_num"))))

_IMPOSSIBLE = (
    ("Negative Units", "units < 0"), ("Zero or Negative Price", "price <= 0"),
    ("Zero or Negative Spend (units>0)", "spend <= 0 AND units > 0"), ("Price > Base Price", "price > base_price + 0.01"),
    ("Negative Base Price", "base_price <= 0"), ("Feature Not 0 or 1", "feature NOT IN (0, 1)"),
    ("Display Not 0 or 1", "display NOT IN (0, 1)"), ("TPR Not 0 or 1", "tpr_only NOT IN (0, 1)"),
    ("HHS > Visits", "hhs > visits + 5"), ("Visits > Units * 5", "visits > units * 5 AND units > 0"))
_GATED = DELIVERED + ", gated AS (SELECT *, list_filter([" + ", ".join(
    f"CASE WHEN {c} THEN '{n}' END" for n, c in _IMPOSSIBLE) + "], lambda x: x IS NOT NULL) AS broken FROM delivered)"
_SHARE = "(count(*) FILTER (len(broken) > 0)) * 100.0::DOUBLE / count(*)"
star("v12_gate_report", _GATED + f""", total AS (SELECT count(*) AS total_rows, count(*) FILTER (len(broken) > 0) AS broken_rows,
  {bands(_SHARE, L.GRADE_EDGES, L.GRADES)} AS grade FROM gated)
""" + " UNION ALL ".join(f"SELECT '{n}' AS issue, (SELECT count(*) FROM delivered WHERE {c}) AS record_count, broken_rows, total_rows, grade FROM total"
                         for n, c in _IMPOSSIBLE))
star("v7_quarantined_rows", _GATED + """SELECT week_end_date, store_num::BIGINT AS store_num, upc, units, spend::DOUBLE AS spend,
  array_to_string(broken, ', ') AS broken_rules FROM gated WHERE len(broken) > 0""")
star("v12_rows_past_gate", _GATED + """SELECT count(*) AS row_count, sum(units)::BIGINT AS units, sum(spend)::DOUBLE AS spend
  FROM gated WHERE len(broken) = 0""")
