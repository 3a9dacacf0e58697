from shelfwise.functions import labels as L
from shelfwise.operators.forecast import SMOOTHING
from shelfwise.plans.oracle.base import H, STAR, bands, m, mean, oracle, rate, star
from shelfwise.plans.oracle.feature_jobs import FEAT
from shelfwise.plans.oracle.ml import METRICS, SCORED, SMAPE

# Weekly units per category with the distance from the end of the series.
SERIES = FEAT + """, ws AS (SELECT category, week_end_date, sum(units) AS y FROM feat GROUP BY 1, 2),
wb AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY week_end_date DESC) AS back,
  lag(y, 52) OVER (PARTITION BY category ORDER BY week_end_date) AS last_year FROM ws)
"""
_AVG4 = H("avg(CASE WHEN back BETWEEN 13 AND 16 THEN y END) OVER (PARTITION BY category)", 4)
star("ts10_moving_average", SERIES + f""", p AS (SELECT *, {_AVG4} AS prediction FROM wb)
SELECT category, week_end_date, y AS actual, prediction FROM p WHERE back <= 12""")
star("ts10_moving_average_metrics", FEAT + f""", ws AS (SELECT week_end_date, sum(units) AS units,
  row_number() OVER (ORDER BY week_end_date DESC) AS back FROM feat GROUP BY 1),
p AS (SELECT *, {H("avg(CASE WHEN back BETWEEN 13 AND 16 THEN units END) OVER ()", 4)} AS prediction FROM ws)
SELECT {METRICS} FROM p WHERE back <= 12""")
star("ts13_seasonal_naive", SERIES + """SELECT category, week_end_date, y AS actual, last_year AS prediction FROM wb
  WHERE back <= 12 AND last_year IS NOT NULL""")

_GRID = ", ".join(f"({i}, {a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE)" for i, (a, b, c) in enumerate(SMOOTHING))
oracle("ts13_seasonal_smoothing", STAR.replace("WITH panel", "WITH RECURSIVE panel", 1) + FEAT + f""",
ws AS (SELECT category, week_end_date, sum(units) AS y FROM feat GROUP BY 1, 2),
wb AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY week_end_date DESC) AS back FROM ws),
ys AS (SELECT category, list(y ORDER BY week_end_date) AS ys FROM wb WHERE back > 12 GROUP BY 1 HAVING count(*) >= 104),
lev AS (SELECT category, ys, list_reduce(ys[:52], lambda a, b: a + b) / 52 AS l FROM ys),
fold AS (
  SELECT category, no, a, b, c, ys, 52 AS i, l, 0::DOUBLE AS t, list_transform(ys[:52], lambda x: x - l) AS s, 0::DOUBLE AS sse
  FROM lev, (VALUES {_GRID}) g(no, a, b, c)
  UNION ALL
  SELECT category, no, a, b, c, ys, i + 1, l + t + a * e, t + a * b * e,
    s[:i % 52] || [s[i % 52 + 1] + c * (1 - a) * e] || s[i % 52 + 2:], sse + e * e
  FROM (SELECT *, ys[i + 1] - (l + t + s[i % 52 + 1]) AS e FROM fold WHERE i < len(ys))),
best AS (SELECT * FROM fold WHERE i = len(ys) QUALIFY row_number() OVER (PARTITION BY category ORDER BY sse, no) = 1)
SELECT category, week_end_date, y AS actual, {H("l + (13 - back) * t + s[(i + 12 - back) % 52 + 1]", 4)} AS prediction
FROM best JOIN wb USING (category) WHERE back <= 12""")

star("cl1_store_profile", f""", p AS (SELECT ef.store_num::BIGINT AS store_num, seg_value_name, {m("total_revenue",
  "total_units")}, {H(mean("discount_pct"), 6)} AS avg_discount, {H(mean("(feature + display + tpr_only)"), 6)}
  AS avg_promotion, {H(mean("price"), 6)} AS avg_price, count(DISTINCT date_key) AS n_weeks_active,
  max(ef.sales_area_size_num)::BIGINT AS sales_area_size_num, max(ef.parking_space_qty)::DOUBLE AS parking
  FROM ef GROUP BY ef.store_num, seg_value_name)
SELECT * EXCLUDE (parking), coalesce(parking, (SELECT quantile_cont(parking, 0.5) FROM p)) AS parking_space_qty FROM p""")

_IT = {"feature": "feature_ad", "display": "in_store_display", "tpr_only": "temp_price_reduction"}
PB = ", pb AS (SELECT feature, display, tpr_only, count(*) OVER () AS tot FROM fact WHERE is_promoted)\n"
star("ar1_lever_activation", PB + " UNION ALL ".join(
    f"""SELECT '{t}' AS item, {H(rate(f"{c} = 1"), 2)} AS activation_rate_pct, count(*) AS baskets FROM pb"""
    for c, t in _IT.items()))


def _sets():
    cols = list(_IT)
    return [[c for i, c in enumerate(cols) if s >> i & 1] for s in range(1, 8)]


def _name(cs) -> str:
    return ", ".join(_IT[c] for c in cs)


def _sup(cs) -> str:
    return f"(count(*) FILTER (WHERE {' AND '.join(f'{c} = 1' for c in cs)})::DOUBLE / count(*))"


star("ar2_lever_itemsets", PB + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{_name(s)}' AS itemset, {len(s)}::BIGINT AS items, {H(_sup(s), 6)} AS support FROM pb" for s in _sets())
    + ") WHERE support >= 0.01")
RULES = "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{_name(a)}' AS antecedents, '{_name(c)}' AS consequents, {H(_sup(a + c), 6)} AS support,
    {H(f"{_sup(a + c)} / {_sup(a)}", 6)} AS confidence, {H(f"{_sup(a + c)} / ({_sup(a)} * {_sup(c)})", 6)} AS lift FROM pb"""
    for a in _sets() for c in _sets() if not set(a) & set(c)) + ") WHERE support >= 0.01"
star("ar3_lever_rules", PB + RULES)
star("ar3_top_rules", PB + f", r AS ({RULES})" + " UNION ALL ".join(
    f"(SELECT *, '{k}' AS ranked_by FROM r ORDER BY {k} DESC, antecedents, consequents LIMIT 5)"
    for k in ("lift", "confidence")))

# Every subset of every basket, grown by one larger item at a time.
_SUBSETS = """b AS MATERIALIZED ({baskets}),
sub AS (SELECT basket, [item] AS items, item AS last FROM b
  UNION ALL SELECT s.basket, list_append(s.items, b.item), b.item FROM sub s JOIN b ON b.basket = s.basket AND b.item > s.last),
tot AS (SELECT count(DISTINCT basket) AS total FROM b),
sets AS (SELECT items, count(*) AS n, any_value(total) AS total FROM sub, tot GROUP BY items HAVING count(*) >= 0.001 * any_value(total))
"""
_SETS = f"""SELECT array_to_string(items, ', ') AS itemset, len(items)::BIGINT AS items, {H("n::DOUBLE / total", 6)} AS support FROM sets"""
_ORDERS = "WITH RECURSIVE " + _SUBSETS.format(baskets="""SELECT DISTINCT l_orderkey AS basket, upper(p_brand) AS item
  FROM lineitem JOIN part ON p_partkey = l_partkey""")
oracle("ar2_basket_itemsets", _ORDERS + _SETS)
oracle("ar3_basket_rules", _ORDERS + f""", parts AS (SELECT z.n, z.total, a.n AS na, c.n AS nc, a.items AS x, c.items AS y
  FROM sets z JOIN sets a ON len(a.items) < len(z.items) AND list_has_all(z.items, a.items)
  JOIN sets c ON c.items = list_filter(z.items, lambda i: NOT list_contains(a.items, i)))
SELECT * FROM (SELECT array_to_string(x, ', ') AS antecedents, array_to_string(y, ', ') AS consequents,
  {H("n::DOUBLE / total", 6)} AS support, {H("(n::DOUBLE / total) / (na::DOUBLE / total)", 6)} AS confidence,
  {H("(n::DOUBLE / total) / ((na::DOUBLE / total) * (nc::DOUBLE / total))", 6)} AS lift FROM parts) WHERE lift >= 1""")
# Only items that are frequent by themselves can be in a frequent set.
oracle("ar2_store_week_itemsets", STAR.replace("WITH panel", "WITH RECURSIVE panel", 1) + ", " + _SUBSETS.format(
  baskets="""SELECT date_key * 1000000::BIGINT + store_num AS basket, upc::VARCHAR AS item FROM fact
    WHERE upc IN (SELECT upc FROM fact GROUP BY upc HAVING count(*) >= 0.001 * (SELECT count(DISTINCT (date_key, store_num)) FROM fact))""")
  .replace("SELECT count(DISTINCT basket) AS total FROM b", "SELECT count(DISTINCT (date_key, store_num)) AS total FROM fact")
  .replace("AND b.item > s.last", "AND b.item > s.last AND len(s.items) < 3") + _SETS)

ERR = SCORED + f""", err AS (SELECT *, units AS actual, prediction AS predicted, {H("units - prediction", 6)} AS error,
  {H("abs(units - prediction)", 6)} AS abs_error,
  {H("abs(units - prediction) / CASE WHEN units > 0 THEN units ELSE 1 END * 100", 6)} AS error_pct,
  {H(SMAPE, 6)} AS smape_error,
  CASE WHEN discount_pct > -1 AND discount_pct <= 100
       THEN {bands("discount_pct", L.ERROR_BUCKET_EDGES, L.ERROR_BUCKETS, "<=")} END AS discount_bucket FROM scored)
"""
_Q = lambda p, d: f"round(quantile_cont(abs_error, {p})::DECIMAL(38,{d + 4}), {d})::DOUBLE"
star("er1_error_rows", ERR + """SELECT week_end_date, store_num, upc, actual, predicted, error, abs_error, error_pct,
  smape_error FROM err""")
star("er1_error_summary", ERR + f"""SELECT {H("avg(abs_error)", 4)} AS mean_abs_error,
  {H("avg(smape_error)", 4)} AS overall_smape, {_Q(0.5, 4)} AS median_abs_error, {_Q(0.95, 4)} AS p95_abs_error FROM err""")
_BY = lambda k: f"""SELECT {k}, {H("avg(abs_error)", 2)} AS mean_abs_error, {_Q(0.5, 2)} AS median_abs_error,
  {H("avg(smape_error)", 2)} AS mean_smape, count(*) AS row_count FROM err WHERE {k} IS NOT NULL GROUP BY 1"""  # noqa: E731
star("er2_error_by_discount", ERR + _BY("discount_bucket"))
star("er2_error_by_category", ERR + _BY("category"))
star("er2_error_by_segment", ERR + _BY("seg_value_name"))
star("er3_largest_errors", ERR + """SELECT week_end_date, store_num, upc, category, actual, predicted, abs_error FROM err
  ORDER BY abs_error DESC, week_end_date, store_num, upc LIMIT 10""")
star("er3_extreme_groups", ERR + f""", g AS ({_BY("category")})
(SELECT 'worst' AS standing, category AS member, mean_smape FROM g ORDER BY mean_smape DESC, category LIMIT 1)
UNION ALL (SELECT 'best', category, mean_smape FROM g ORDER BY mean_smape, category LIMIT 1)""")
star("er4_risk_flags", ERR + """, f AS (SELECT discount_pct > 30 AS a, category = 'ECONOMY' AS b,
  predicted > 2 * rolling_mean_4w AS c FROM err), s AS (SELECT *, a::INT + b::INT + c::INT AS k FROM f)
SELECT CASE k WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS risk_level, k::BIGINT AS risk_score,
  k >= 2 AS high_uncertainty, count(*) AS row_count, count(*) FILTER (WHERE a) AS flag_high_discount,
  count(*) FILTER (WHERE b) AS flag_risky_category, count(*) FILTER (WHERE c) AS flag_demand_spike FROM s GROUP BY 1, 2, 3""")

star("er4_flagged_rows", ERR + """, f AS (SELECT week_end_date, store_num, upc, discount_pct > 30 AS flag_high_discount,
  category = 'ECONOMY' AS flag_risky_category, predicted > 2 * rolling_mean_4w AS flag_demand_spike FROM err),
s AS (SELECT *, (flag_high_discount::INT + flag_risky_category::INT + flag_demand_spike::INT)::BIGINT AS risk_score FROM f)
SELECT *, CASE risk_score WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' ELSE 'High' END AS risk_level FROM s""")

GM = FEAT + """, gm AS (SELECT category, seg_value_name, """ + ", ".join(
    f"round(avg({c})::DECIMAL(38,10), 6)::DOUBLE AS {c}" for c in ("price", "base_price")) + " FROM feat GROUP BY 1, 2)\n"
_DISC = H("greatest((base_price - p) * 100 / base_price, 0)", 6)
_ZONE = bands("discount_pct", L.DISCOUNT_ZONE_EDGES, L.DISCOUNT_ZONES)
star("sc1_price_grid", GM + f""", g AS (SELECT category, seg_value_name, base_price, c::DOUBLE AS price_change_pct,
  {H("price * (1 + c / 100.0::DOUBLE)", 6)} AS p FROM gm, (SELECT unnest([-5, 0, 5, 10, 15, 20, 25, 30]) AS c)),
d AS (SELECT *, {_DISC} AS discount_pct FROM g)
SELECT category, seg_value_name, price_change_pct, p AS price, discount_pct, {H("p / base_price", 6)} AS price_ratio,
  {_ZONE} AS discount_zone FROM d""")
_SC = "(VALUES " + ", ".join(f"('{s}', {a}, {b}, {c})" for s, a, b, c in L.PROMO_SCENARIOS) + ") v(scenario, f, d, t)"
star("sc3_promo_grid", GM + f"""SELECT category, seg_value_name, scenario, f::DOUBLE AS feature, d::DOUBLE AS display,
  t::DOUBLE AS tpr_only, (f + d + t)::DOUBLE AS promotion_count, {H("(f + d + t) / 3.0::DOUBLE", 6)} AS promotion_intensity,
  if(category IN ('ECONOMY', 'PROMO'), f + d + t, 0)::DOUBLE AS priority_promo_intensity FROM gm, {_SC}""")

_W = "(PARTITION BY store_num, upc ORDER BY week_end_date {0})"
NEXT = FEAT + f""", nx AS (SELECT *, units AS l1, coalesce(lag(units, 1) OVER {_W.format("")}, 0) AS l2,
  coalesce(lag(units, 3) OVER {_W.format("")}, 0) AS l4, coalesce(lag(units, 7) OVER {_W.format("")}, 0) AS l8,
  {H(f"avg(units) OVER {_W.format('ROWS BETWEEN 3 PRECEDING AND CURRENT ROW')}", 6)} AS r4 FROM feat),
latest AS (SELECT * FROM nx QUALIFY row_number() OVER (PARTITION BY store_num, category
  ORDER BY week_end_date DESC, upc DESC) = 1)
"""
star("rc1_next_week_rows", NEXT + """SELECT store_num, category, week_end_date, upc, base_price, l1 AS sales_last_1_week,
  l2 AS sales_last_2_week, l4 AS sales_last_4_week, l8 AS sales_last_8_week, r4 AS rolling_mean_4w FROM latest""")
_STEPS = "[" + ", ".join(str(round(0.6 + 0.05 * i, 2)) for i in range(12)) + "]"
star("rc1_price_grid", NEXT + f""", g AS (SELECT store_num, category, base_price, s::DOUBLE AS price_step, scenario,
  f + d + t AS k, {H("s::DOUBLE * base_price", 6)} AS p FROM latest, (SELECT unnest({_STEPS}) AS s), {_SC}),
d AS (SELECT *, {_DISC} AS discount_pct FROM g)
SELECT store_num, category, scenario, price_step, p AS price, discount_pct, {H("p / base_price", 6)} AS price_ratio,
  6::DOUBLE AS month, 2::DOUBLE AS quarter, 0::DOUBLE AS holiday_season, k::DOUBLE AS promotion_count,
  {_ZONE} AS discount_zone FROM d""")
