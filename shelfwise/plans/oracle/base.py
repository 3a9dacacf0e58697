"""Common SQL text: the star as CTEs and short builders for report columns."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Raw panel and star, straight from the order-line tables.
STAR = """WITH panel AS (
  SELECT CAST(date_trunc('week', l_shipdate) AS DATE) + 5 AS week_end_date, s_nationkey AS store_num,
         ('0x' || substr(md5(coalesce('1' || p_type, '0') || '|' || coalesce('1' || p_brand, '0')), 1, 15))::BIGINT AS upc,
         sum(round(l_quantity)::BIGINT)::BIGINT AS units,
         count(DISTINCT l_orderkey) AS visits, count(DISTINCT o_custkey) AS hhs,
         sum(round(l_extendedprice * 100)::BIGINT * (100 - round(l_discount * 100)::BIGINT))::BIGINT AS net,
         sum(round(l_extendedprice * 100)::BIGINT * 100)::BIGINT AS gross,
         max((l_returnflag = 'R')::INT) AS feature, max((l_linestatus = 'O')::INT) AS display,
         max((o_orderpriority = '1-URGENT')::INT) AS tpr_only
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
trans AS (
  SELECT week_end_date, store_num, upc, units, visits, hhs,
         (net::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) AS spend,
         (((2 * net + units) // (2 * units))::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) AS price,
         (((2 * gross + units) // (2 * units))::DECIMAL(18,0) * 0.0001::DECIMAL(5,4))::DECIMAL(18,4) AS base_price,
         feature, display, tpr_only
  FROM panel),
product AS (
  SELECT ('0x' || substr(md5(coalesce('1' || p_type, '0') || '|' || coalesce('1' || p_brand, '0')), 1, 15))::BIGINT AS upc, p_type AS category,
         p_type || ' ' || p_brand AS description, upper(p_brand) AS manufacturer,
         upper(p_type || ' ' || substr(p_brand, 1, 7)) AS sub_category, 'SIZE ' || max(p_size) AS product_size,
         'OTHR' AS category_code
  FROM part GROUP BY p_type, p_brand),
store AS (
  SELECT n_nationkey AS store_num, n_name AS store_name, 'CITY ' || n_name AS city, r_name AS state,
         n_regionkey AS msa_code,
         CASE WHEN coalesce(bal, 0) < 3000 THEN 'VALUE' WHEN bal < 6000 THEN 'MAINSTREAM' ELSE 'UPSCALE' END
           AS seg_value_name,
         CASE WHEN n_nationkey <> 7 THEN (200 + 20 * n_nationkey)::DECIMAL(8,2) END AS parking_space_qty,
         30000 + 1000 * n_nationkey AS sales_area_size_num,
         (5000 + 250 * n_nationkey)::DECIMAL(12,2) AS avg_weekly_baskets,
         CASE WHEN n_nationkey < 10 THEN 'Small' WHEN n_nationkey < 30 THEN 'Medium' ELSE 'Large' END
           AS store_size_band,
         CASE WHEN n_nationkey = 7 THEN 'Unknown' WHEN 200 + 20 * n_nationkey < 300 THEN 'Low'
              WHEN 200 + 20 * n_nationkey < 500 THEN 'Medium' ELSE 'High' END AS parking_band
  FROM nation JOIN region ON r_regionkey = n_regionkey
  LEFT JOIN (SELECT s_nationkey, sum(round(s_acctbal * 100)::BIGINT)::DOUBLE / 100 / count(*) AS bal
             FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey),
spine AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week_end_date
  FROM (SELECT min(week_end_date) AS lo, max(week_end_date) AS hi FROM trans)),
calendar AS (
  SELECT strftime(week_end_date, '%Y%m%d')::INT AS date_key, week_end_date, year(week_end_date) AS year,
         quarter(week_end_date) AS quarter, month(week_end_date) AS month,
         strftime(week_end_date, '%B') AS month_name, week(week_end_date) AS week_num,
         row_number() OVER (ORDER BY week_end_date) AS week_of_year,
         month(week_end_date) >= 11 AS is_holiday_season
  FROM spine),
fact AS (
  SELECT strftime(week_end_date, '%Y%m%d')::INT AS date_key, store_num, upc, units, visits, hhs, spend, price,
         base_price, feature, display, tpr_only,
         round(((base_price - price)::DOUBLE * 100 / base_price::DOUBLE)::DECIMAL(38,8), 4)::DECIMAL(12,4)
           AS discount_pct,
         (base_price - price)::DECIMAL(18,4) AS price_gap,
         round((spend::DOUBLE / visits)::DECIMAL(38,8), 4)::DECIMAL(18,4) AS revenue_per_visit,
         round((units::DOUBLE / hhs)::DECIMAL(38,8), 4)::DECIMAL(18,4) AS units_per_hh,
         round((spend::DOUBLE / hhs)::DECIMAL(38,8), 4)::DECIMAL(18,4) AS spend_per_hh,
         CASE feature * 100 + display * 10 + tpr_only
           WHEN 111 THEN 'COMBINED' WHEN 110 THEN 'FEATURE_DISPLAY' WHEN 101 THEN 'FEATURE_TPR'
           WHEN 11 THEN 'DISPLAY_TPR' WHEN 100 THEN 'FEATURE_ONLY' WHEN 10 THEN 'DISPLAY_ONLY'
           WHEN 1 THEN 'TPR_ONLY' ELSE 'NONE' END AS promo_type,
         feature + display + tpr_only > 0 AS is_promoted
  FROM trans),
ef AS (
  SELECT * FROM fact JOIN calendar USING (date_key) JOIN product USING (upc) JOIN store USING (store_num))
"""


def H(e: str, d: int) -> str:
    """Half-up rounding of a double expression."""
    return f"round(({e})::DOUBLE::DECIMAL(38,{d + 4}), {d})::DOUBLE"


def X(e: str, d: int) -> str:
    """Rounding of an exact decimal, shown as double."""
    return f"round({e}, {d})::DOUBLE"


def mean(c: str) -> str:
    return f"(sum({c})::DOUBLE / nullif(count({c}), 0))"


def mean_if(cond: str, c: str) -> str:
    return mean(f"CASE WHEN {cond} THEN {c} END")


def per(a: str, b: str) -> str:
    return f"(sum({a})::DOUBLE / nullif(sum({b}), 0)::DOUBLE)"


def rate(cond: str) -> str:
    return f"(count(*) FILTER (WHERE {cond}) * 100.0::DOUBLE / count(*))"


def growth(now: str, before: str, d: int = 2) -> str:
    return H(f"(({now})::DOUBLE - ({before})::DOUBLE) * 100.0::DOUBLE / nullif(({before})::DOUBLE, 0)", d)


def n(e: str) -> str:
    return f"({e})::BIGINT"


def case(c: str, names: dict, default: str | None = None) -> str:
    lit = lambda k: k if isinstance(k, int) else f"'{k}'"
    arms = " ".join(f"WHEN {lit(k)} THEN '{v}'" for k, v in names.items())
    return f"CASE {c} {arms}" + (f" ELSE '{default}'" if default else "") + " END"


def bands(c: str, edges, names, op: str = "<") -> str:
    arms = " ".join(f"WHEN {c} {op} {e} THEN '{v}'" for e, v in zip(edges, names))
    return f"CASE {arms} ELSE '{names[-1]}' END"


def share(num: str, part: str = "") -> str:
    over = f"PARTITION BY {part}" if part else ""
    return H(f"{num}::DOUBLE * 100.0::DOUBLE / sum({num}) OVER ({over})::DOUBLE", 2)


_M = {
    "total_revenue": (2, lambda d: X("sum(spend)", d)),
    "total_units": (0, lambda d: n("sum(units)")),
    "total_visits": (0, lambda d: n("sum(visits)")),
    "total_hhs": (0, lambda d: n("sum(hhs)")),
    "row_count": (0, lambda d: n("count(*)")),
    "avg_basket_value": (4, lambda d: H(per("spend", "visits"), d)),
    "avg_basket_size": (4, lambda d: H(per("units", "visits"), d)),
    "avg_revenue_per_hh": (4, lambda d: H(per("spend", "hhs"), d)),
    "avg_units_per_hh": (4, lambda d: H(per("units", "hhs"), d)),
    "avg_visits_per_hh": (4, lambda d: H(per("visits", "hhs"), d)),
    "hhs_per_visit": (4, lambda d: H(per("hhs", "visits"), d)),
    "avg_price": (4, lambda d: H(mean("price"), d)),
    "avg_base_price": (4, lambda d: H(mean("base_price"), d)),
    "avg_price_gap": (4, lambda d: H(mean("price_gap"), d)),
    "avg_discount_pct": (2, lambda d: H(mean("discount_pct"), d)),
    "avg_units": (2, lambda d: H(mean("units"), d)),
    "avg_revenue": (4, lambda d: H(mean("spend"), d)),
    "avg_row_basket_value": (4, lambda d: H(mean("revenue_per_visit"), d)),
    "avg_row_units_per_hh": (4, lambda d: H(mean("units_per_hh"), d)),
    "avg_row_spend_per_hh": (4, lambda d: H(mean("spend_per_hh"), d)),
    "max_row_basket_value": (4, lambda d: X("max(revenue_per_visit)", d)),
    "max_row_units_per_hh": (4, lambda d: X("max(units_per_hh)", d)),
    "min_price": (4, lambda d: X("min(price)", d)),
    "max_price": (4, lambda d: X("max(price)", d)),
    "price_range": (4, lambda d: X("max(price) - min(price)", d)),
    "max_discount_pct": (2, lambda d: X("max(discount_pct)", d)),
    "price_stddev": (4, lambda d: H("stddev_samp(price::DOUBLE)", d)),
    "price_cv_pct": (2, lambda d: H(f"stddev_samp(price::DOUBLE) * 100.0::DOUBLE / nullif({mean('price')}, 0)", d)),
    "min_spend": (4, lambda d: X("min(spend)", d)),
    "max_spend": (4, lambda d: X("max(spend)", d)),
    "promoted_rows": (0, lambda d: n("count(*) FILTER (WHERE is_promoted)")),
    "discounted_rows": (0, lambda d: n("count(*) FILTER (WHERE discount_pct > 0)")),
    "promo_rate_pct": (2, lambda d: H(rate("is_promoted"), d)),
    "feature_rate_pct": (2, lambda d: H(rate("feature = 1"), d)),
    "display_rate_pct": (2, lambda d: H(rate("display = 1"), d)),
    "tpr_rate_pct": (2, lambda d: H(rate("tpr_only = 1"), d)),
    "combined_promo_rate_pct": (2, lambda d: H(rate("promo_type = 'COMBINED'"), d)),
    "pct_rows_discounted": (2, lambda d: H(rate("discount_pct > 0"), d)),
    "feature_share": (4, lambda d: H(mean("feature"), d)),
    "display_share": (4, lambda d: H(mean("display"), d)),
    "tpr_share": (4, lambda d: H(mean("tpr_only"), d)),
    "promo_share": (4, lambda d: H(mean("is_promoted::INT"), d)),
    "feature_rows": (0, lambda d: n("sum(feature)")),
    "display_rows": (0, lambda d: n("sum(display)")),
    "tpr_rows": (0, lambda d: n("sum(tpr_only)")),
    "combined_rows": (0, lambda d: n("count(*) FILTER (WHERE promo_type = 'COMBINED')")),
    "store_count": (0, lambda d: n("count(DISTINCT store_num)")),
    "product_count": (0, lambda d: n("count(DISTINCT upc)")),
    "week_count": (0, lambda d: n("count(DISTINCT date_key)")),
    "category_count": (0, lambda d: n("count(DISTINCT category)")),
    "revenue_per_store": (2, lambda d: H("sum(spend)::DOUBLE / count(DISTINCT store_num)", d)),
    "revenue_per_week": (2, lambda d: H("sum(spend)::DOUBLE / count(DISTINCT date_key)", d)),
}


def m(*specs: str) -> str:
    """Select list for measure specs ``name[:digits][=alias]``."""
    out = []
    for spec in specs:
        body, _, alias = spec.partition("=")
        name, _, digits = body.partition(":")
        default, build = _M[name]
        out.append(f"{build(int(digits) if digits else default)} AS {alias or name}")
    return ", ".join(out)


REV = "sum(spend)"
REV_RANK = "rank() OVER (ORDER BY sum(spend) DESC)"


def oracle(name: str, sql: str) -> None:
    if name in ORACLE:
        raise ValueError(f"oracle {name} given twice")
    ORACLE[name] = sql


def star(name: str, sql: str) -> None:
    """Oracle over the star CTEs; ``sql`` starts with SELECT or ``, cte AS``."""
    oracle(name, STAR + sql)
