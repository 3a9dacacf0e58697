from shelfwise.functions import labels as L
from shelfwise.plans.oracle.base import REV, REV_RANK, X, growth, m, share, star

_T = m("total_revenue", "total_units", "total_visits", "total_hhs", "store_count=total_stores",
       "product_count=total_products", "week_count=total_weeks", "avg_basket_value", "avg_basket_size",
       "avg_revenue_per_hh", "avg_price=avg_selling_price", "avg_discount_pct:4", "promo_rate_pct",
       "feature_rate_pct", "display_rate_pct", "tpr_rate_pct")
_DIGITS = {"total_revenue": 2, "avg_basket_value": 4, "avg_basket_size": 4, "avg_revenue_per_hh": 4,
           "avg_selling_price": 4, "avg_discount_pct": 4, "promo_rate_pct": 2, "feature_rate_pct": 2,
           "display_rate_pct": 2, "tpr_rate_pct": 2, "yoy_revenue_growth_pct": 2}
_BEST = {"best_category": "category", "best_product": "description", "best_store": "store_name", "best_state": "state"}


def _value(k: str) -> str:
    if k in _BEST:
        c = _BEST[k]
        return f"(SELECT {c} FROM ef GROUP BY {c} ORDER BY sum(spend) DESC, {c} LIMIT 1)"
    return f"printf('%.{_DIGITS[k]}f', {k})" if k in _DIGITS else f"{k}::VARCHAR"


star("kd1_headline_metrics", f""", mx AS (SELECT max(year) AS y FROM calendar),
yy AS (SELECT coalesce(round(sum(spend) FILTER (WHERE year = y), 2), 0) AS a,
  coalesce(round(sum(spend) FILTER (WHERE year = y - 1), 2), 0) AS b FROM ef, mx),
t AS (SELECT {_T}, any_value({growth("a", "b")}) AS yoy_revenue_growth_pct FROM ef, yy)
""" + " UNION ALL ".join(f"SELECT '{k}' AS metric, {_value(k)} AS value, '{v}' AS label FROM t"
                         for k, v in L.DASHBOARD_LABELS.items()))

star("kd2_category_scorecard", f"""SELECT category, {m("total_revenue", "total_units", "total_visits", "total_hhs",
  "avg_price", "avg_discount_pct", "avg_basket_value", "avg_revenue_per_hh", "promo_rate_pct")},
  {share(REV)} AS revenue_share_pct, {REV_RANK} AS revenue_rank FROM ef GROUP BY 1""")

star("kd3_recent_weeks", f""", w AS (SELECT week_end_date, year, week_of_year, round(sum(spend), 2) AS r,
  {m("total_units=weekly_units", "avg_basket_value", "avg_discount_pct", "promo_rate_pct")} FROM ef GROUP BY ALL
  ORDER BY week_end_date DESC LIMIT 8)
SELECT * EXCLUDE (r), r::DOUBLE AS weekly_revenue, lag(r::DOUBLE) OVER (ORDER BY week_end_date) AS prev_week,
  {growth("r", "lag(r) OVER (ORDER BY week_end_date)")} AS wow_growth_pct FROM w""")

star("kd4_segment_scorecard", f"""SELECT seg_value_name, {m("store_count", "total_revenue", "revenue_per_store",
  "avg_basket_value", "avg_discount_pct", "promo_rate_pct")}, {share(REV)} AS revenue_share_pct FROM ef GROUP BY 1""")

star("kd5_product_movers", f""", p AS (SELECT description, category, manufacturer, sum(spend) AS r,
  {m("total_units")}, {share(REV)} AS portfolio_share_pct FROM ef GROUP BY description, category, manufacturer),
q AS (SELECT *, rank() OVER (ORDER BY r DESC) AS t, row_number() OVER (ORDER BY r DESC, description) AS tp,
  rank() OVER (ORDER BY r) AS b, row_number() OVER (ORDER BY r, description) AS bp FROM p)
SELECT 'TOP 10' AS group_label, t AS rank_pos, * EXCLUDE (r, t, tp, b, bp), {X("r", 2)} AS total_revenue
  FROM q WHERE tp <= 10
UNION ALL SELECT 'BOTTOM 5', b, * EXCLUDE (r, t, tp, b, bp), {X("r", 2)} FROM q WHERE bp <= 5""")
