from shelfwise.plans.oracle.base import H, star

MASTER = """, mr AS (SELECT trans.*, category, manufacturer, store_name, state, seg_value_name
  FROM trans LEFT JOIN product USING (upc) LEFT JOIN store USING (store_num))
"""
_K = "week_end_date, store_num::BIGINT AS store_num, upc"
_W = "(PARTITION BY mr.store_num, mr.upc ORDER BY week_end_date {0})"


def lag(k: int) -> str:
    return f"lag(units::DOUBLE, {k}) OVER {_W.format('')}"


def frame(f: str, k: int) -> str:
    return H(f"{f}(units::DOUBLE) OVER {_W.format(f'ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING')}", 6)


DISCOUNT = H("(base_price - price)::DOUBLE * 100.0::DOUBLE / base_price::DOUBLE", 6)
RATIO = H("price::DOUBLE / base_price::DOUBLE", 6)
COUNT = "(feature + display + tpr_only)"
STD = f"coalesce({frame('stddev_samp', 4)}, 0)"

star("fe1_master", MASTER + f"""SELECT {_K}, units, spend::DOUBLE AS spend, category, manufacturer, store_name, state,
  seg_value_name FROM mr""")
star("fe2_price_features", MASTER + f"""SELECT {_K}, {DISCOUNT} AS discount_pct,
  (base_price - price)::DOUBLE AS price_gap, {RATIO} AS price_ratio, {H("ln(1 + price::DOUBLE)", 6)} AS log_price FROM mr""")
star("fe3_sales_features", MASTER + f"""SELECT {_K}, {H("spend::DOUBLE / visits", 6)} AS revenue_per_visit,
  {H("units::DOUBLE / hhs", 6)} AS units_per_hh, {H("spend::DOUBLE / hhs", 6)} AS spend_per_hh,
  {H("units::DOUBLE / visits", 6)} AS units_per_visit, {H("spend::DOUBLE / units", 6)} AS revenue_per_unit FROM mr""")
star("fe4_time_features", MASTER + f"""SELECT {_K}, year(week_end_date) AS year, month(week_end_date) AS month,
  strftime(week_end_date, '%B') AS month_name, quarter(week_end_date) AS quarter, week(week_end_date) AS week_number,
  CASE WHEN month(week_end_date) IN (12, 1, 2) THEN 'Winter' WHEN month(week_end_date) < 6 THEN 'Spring'
       WHEN month(week_end_date) < 9 THEN 'Summer' ELSE 'Fall' END AS season,
  (month(week_end_date) >= 11)::BIGINT AS holiday_season FROM mr""")
star("fe5_lags", MASTER + f"SELECT {_K}, " + ", ".join(f"{lag(k)} AS sales_last_{k}_week" for k in (1, 2, 4, 8)) + " FROM mr")
star("fe6_rolling", MASTER + f"""SELECT {_K}, {frame("avg", 4)} AS rolling_mean_4w, {STD} AS rolling_std_4w,
  {frame("avg", 8)} AS moving_avg_8w FROM mr""")
_NO = "datediff('day', DATE '1970-01-03', week_end_date) // 7"


def _range(f: str, first: int, last: int) -> str:
    return (f"{f}(units::DOUBLE) OVER (PARTITION BY mr.store_num, mr.upc ORDER BY {_NO} "
            f"RANGE BETWEEN {first} PRECEDING AND {last} PRECEDING)")


star("fe5_calendar_lags", MASTER + f"SELECT {_K}, " + ", ".join(
    f"{_range('max', k, k)} AS sales_last_{k}_week" for k in (1, 2, 4, 8)) + " FROM mr")
star("fe6_calendar_rolling", MASTER + f"""SELECT {_K}, {H(_range("avg", 4, 1), 6)} AS rolling_mean_4w,
  coalesce({H(_range("stddev_samp", 4, 1), 6)}, 0) AS rolling_std_4w, {H(_range("avg", 8, 1), 6)} AS moving_avg_8w FROM mr""")
star("fe7_filled_history", MASTER + f"SELECT {_K}, ({lag(1)} IS NOT NULL)::BIGINT AS has_history, " + ", ".join(
    f"coalesce({lag(k)}, 0) AS sales_last_{k}_week" for k in (1, 2, 4, 8))
    + f", coalesce({frame('avg', 4)}, 0) AS rolling_mean_4w FROM mr")
star("fe8_promo_features", MASTER + f"""SELECT {_K}, {COUNT}::BIGINT AS promotion_count,
  {H(f"{COUNT}::DOUBLE / 3", 6)} AS promotion_intensity,
  if(category IN ('ECONOMY', 'PROMO'), {COUNT}, 0)::BIGINT AS priority_promo_intensity FROM mr""")
star("fe9_encodings", MASTER + """, e AS (SELECT store_num, category, seg_value_name,
  dense_rank() OVER (ORDER BY store_num::VARCHAR) - 1 AS store_num_enc,
  dense_rank() OVER (ORDER BY category) - 1 AS category_enc,
  dense_rank() OVER (ORDER BY seg_value_name) - 1 AS seg_value_name_enc FROM mr)
SELECT DISTINCT store_num::BIGINT AS store_num, store_num_enc, category, category_enc, seg_value_name, seg_value_name_enc
FROM e""")

# Full model table; every input is a double.
FEAT = MASTER + f""", feat AS (SELECT week_end_date, mr.store_num::BIGINT AS store_num, mr.upc, category, seg_value_name,
  units::DOUBLE AS units, spend::DOUBLE AS spend, month(week_end_date)::DOUBLE AS month,
  quarter(week_end_date)::DOUBLE AS quarter, price::DOUBLE AS price, base_price::DOUBLE AS base_price,
  {DISCOUNT} AS discount_pct, {RATIO} AS price_ratio, feature::DOUBLE AS feature, display::DOUBLE AS display,
  tpr_only::DOUBLE AS tpr_only, {COUNT}::DOUBLE AS promotion_count, {H(f"{COUNT}::DOUBLE / 3", 6)} AS promotion_intensity,
  if(category IN ('ECONOMY', 'PROMO'), {COUNT}, 0)::DOUBLE AS priority_promo_intensity,
  (month(week_end_date) >= 11)::INT::DOUBLE AS holiday_season,
  (dense_rank() OVER (ORDER BY mr.store_num::VARCHAR) - 1)::DOUBLE AS store_num_enc,
  (dense_rank() OVER (ORDER BY category) - 1)::DOUBLE AS category_enc,
  (dense_rank() OVER (ORDER BY seg_value_name) - 1)::DOUBLE AS seg_value_name_enc,
  {", ".join(f"coalesce({lag(k)}, 0) AS sales_last_{k}_week" for k in (1, 2, 4, 8))},
  coalesce({frame("avg", 4)}, 0) AS rolling_mean_4w, {STD} AS rolling_std_4w,
  coalesce({frame("avg", 8)}, 0) AS moving_avg_8w, ({lag(1)} IS NOT NULL)::INT::DOUBLE AS has_history FROM mr)
"""
star("fe10_model_table", FEAT + "SELECT * FROM feat")
