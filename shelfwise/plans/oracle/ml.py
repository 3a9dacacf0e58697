from shelfwise.operators.features import FEATURES
from shelfwise.plans.oracle.base import H, star
from shelfwise.plans.oracle.feature_jobs import FEAT

# Weeks with position, and the split week at a fraction of them.
WEEKS = """, wk AS (SELECT week_end_date AS w, row_number() OVER (ORDER BY week_end_date) - 1 AS pos,
  count(*) OVER () AS nw FROM (SELECT DISTINCT week_end_date FROM feat))
"""


def cut(fraction: str) -> str:
    return f"(SELECT w FROM wk WHERE pos = floor(nw * {fraction}))"


# Hierarchical-mean predictions of the test weeks.
SPLIT = FEAT + WEEKS + f""", train AS (SELECT * FROM feat WHERE week_end_date < {cut("0.8::DOUBLE")}),
test AS (SELECT * FROM feat WHERE week_end_date >= {cut("0.8::DOUBLE")})
"""


def mean_model(train: str, test: str, name: str) -> str:
    return f""", {name} AS (SELECT t.*, round(coalesce(u.m, c.m, (SELECT avg(units) FROM {train}))::DECIMAL(38,10), 6)::DOUBLE
  AS prediction FROM {test} t LEFT JOIN (SELECT upc, avg(units) AS m FROM {train} GROUP BY 1) u USING (upc)
  LEFT JOIN (SELECT category, avg(units) AS m FROM {train} GROUP BY 1) c USING (category))
"""


SCORED = SPLIT + mean_model("train", "test", "scored")
SMAPE = "2 * abs(prediction - units) / CASE WHEN abs(units) + abs(prediction) = 0 THEN 1 ELSE abs(units) + abs(prediction) END * 100"
METRICS = f"""count(*) AS row_count, {H("avg(abs(units - prediction))", 4)} AS mae,
  {H("sqrt(avg((units - prediction) * (units - prediction)))", 4)} AS rmse, {H(f"avg({SMAPE})", 4)} AS smape_pct,
  {H("1 - avg((units - prediction) * (units - prediction)) / nullif(var_pop(units), 0)", 4)} AS r2"""

star("ml1_baseline_metrics", SCORED + f"SELECT {METRICS} FROM scored")
star("ml1_metrics_by_category", SCORED + f"SELECT category, {METRICS} FROM scored GROUP BY 1")
_S = "min(week_end_date) AS first_week, max(week_end_date) AS last_week, count(DISTINCT week_end_date) AS weeks, count(*) AS row_count"
star("ml2_time_split", SPLIT + f"SELECT 'train' AS part, {_S} FROM train UNION ALL SELECT 'test', {_S} FROM test")
star("ml3_hierarchical_mean", SCORED + "SELECT week_end_date, store_num, upc, units, prediction FROM scored")

LABELS = f""", med AS (SELECT category, round(quantile_cont(units, 0.5)::DECIMAL(38,8), 4)::DOUBLE AS med FROM feat
  WHERE week_end_date < {cut("0.8::DOUBLE")} GROUP BY 1),
lab AS (SELECT feat.*, (units > coalesce(med, 0))::BIGINT AS high_sales FROM feat LEFT JOIN med USING (category))
"""
star("ml5_high_sales_label", FEAT + WEEKS + LABELS + """SELECT category, count(*) AS row_count,
  sum(high_sales)::BIGINT AS high_rows FROM lab GROUP BY 1""")

star("ml5_labelled_rows", FEAT + WEEKS + LABELS + "SELECT week_end_date, store_num, upc, category, units, high_sales FROM lab")

star("ml7_roc_points", SPLIT + LABELS + f""", ltrain AS (SELECT * FROM lab WHERE week_end_date < {cut("0.8::DOUBLE")}),
ltest AS (SELECT * FROM lab WHERE week_end_date >= {cut("0.8::DOUBLE")})
""" + mean_model("ltrain", "ltest", "ls") + f""", r AS (SELECT min(prediction) AS lo, max(prediction) AS hi FROM ls),
b AS (SELECT least(floor((prediction - lo) / (hi - lo) * 200), 199)::BIGINT AS score_bin, sum(high_sales) AS p,
  count(*) - sum(high_sales) AS q FROM ls, r GROUP BY 1)
SELECT score_bin, {H("sum(q) OVER (ORDER BY score_bin DESC)::DOUBLE / sum(q) OVER ()::DOUBLE", 6)} AS fpr,
  {H("sum(p) OVER (ORDER BY score_bin DESC)::DOUBLE / sum(p) OVER ()::DOUBLE", 6)} AS tpr FROM b""")

FOLDS = WEEKS + """, fw AS (SELECT w, pos, CASE WHEN pos >= nw - 5 * (nw // 6)
  THEN (pos - (nw - 5 * (nw // 6))) // (nw // 6) + 1 ELSE 0 END AS fold FROM wk)
"""
star("ml8_fold_sizes", FEAT + FOLDS + f"SELECT fold::BIGINT AS fold, {_S} FROM feat JOIN fw ON w = week_end_date GROUP BY fw.fold")
star("ml8_baseline_cross_validation", FEAT + FOLDS + "".join(
    f""", tr{i} AS (SELECT feat.* FROM feat JOIN fw ON w = week_end_date WHERE fold < {i}),
te{i} AS (SELECT feat.* FROM feat JOIN fw ON w = week_end_date WHERE fold = {i})
""" + mean_model(f"tr{i}", f"te{i}", f"s{i}") for i in range(1, 6))
    + " UNION ALL ".join(f"SELECT {METRICS}, {i}::BIGINT AS fold FROM s{i}" for i in range(1, 6)))

star("ml10_variance_filter", SPLIT + "SELECT feature_name, variance, variance > 0.01 AS kept FROM ("
     + " UNION ALL ".join(f"SELECT '{c}' AS feature_name, {H(f'var_pop({c})', 4)} AS variance FROM train" for c in FEATURES)
     + ")")


def _cuts(c: str, where: str) -> str:
    return ", ".join(f"round(quantile_cont({c}, {i / 10})::DECIMAL(38,8), 4)::DOUBLE AS c{i}" for i in range(1, 10))


_BIN = lambda c, t: " + ".join(f"({c} > {t}.c{i})::INT" for i in range(1, 10))
star("ml11_mutual_information", SPLIT + f", yc AS (SELECT {_cuts('units', '')} FROM train)\n" + ", lf AS ("
     + " UNION ALL ".join(f"SELECT '{c}' AS f, {c} AS v, {_BIN('units', 'yc')} AS yb FROM train, yc" for c in FEATURES)
     + f"""), xc AS (SELECT f, {_cuts('v', '')} FROM lf GROUP BY f),
j AS (SELECT lf.f, {_BIN('v', 'xc')} AS xb, yb, count(*)::DOUBLE AS n FROM lf JOIN xc USING (f) GROUP BY 1, 2, 3),
t AS (SELECT f, n, sum(n) OVER (PARTITION BY f) AS tot, sum(n) OVER (PARTITION BY f, xb) AS px,
  sum(n) OVER (PARTITION BY f, yb) AS py FROM j)
SELECT f AS feature_name, {H("sum(n / tot * ln(n * tot / (px * py)))", 6)} AS mutual_information FROM t GROUP BY 1""")
