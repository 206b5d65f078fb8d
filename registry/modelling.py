"""Correlation, regression and the forest model, on lines joined to parts with a built label."""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import functions as F

from registry.common import SALES, query, role, rounded, table
from registry.testing import f_tail
from tidemark.operators import model, regress, shap
from tidemark.operators.forest import importances
from tidemark.session import written

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
PARTIAL = """SELECT CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS q, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_discount END AS d,
             l_extendedprice AS p, l_quantity * 0 + 1 AS one, l_quantity * l_tax AS t FROM {lineitem}"""


def _corr_cells() -> str:
    names = ["q", "d", "p", "t"]
    cells = []
    for x in [*names, "one"]:
        for y in [*names, "one"]:
            value = "MAX(CAST(NULL AS DOUBLE))" if "one" in (x, y) else f"round(corr({x}, {y}), 8)"
            cells.append(f"SELECT '{x}' AS x, '{y}' AS y, {value} AS r FROM ({PARTIAL}) l")
    return " UNION ALL ".join(cells)


@query("r1_corr_matrix", _corr_cells())
def corr_matrix(spark, sf):
    mapping = {c: c for c in ("q", "d", "p", "one", "t", "absent")}
    return rounded(regress.corr_matrix(role(spark, sf, PARTIAL), mapping), 8, "r")


GAPS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_linenumber = 4 THEN NULL ELSE p_type END AS p_type, CAST(NULL AS DOUBLE) AS blank FROM ({s}) s"


def _dummies(levels: list[str]) -> str:
    return ", ".join(f"CASE WHEN p_type = '{v}' THEN 1e0 ELSE 0e0 END AS p_type_{v}" for v in levels)


@query("r3_design_matrix", f"SELECT {', '.join(KEYS)}, l_quantity, {_dummies(TYPES[1:])} FROM ({GAPS.format(s=SALES)}) g")
def design_matrix(spark, sf):
    return regress.design_matrix(role(spark, sf, GAPS.format(s=SALES)), ["l_quantity", "p_type", "blank"], KEYS)[0]


OLS = f"""
    WITH s AS (SELECT l_quantity AS a, l_discount AS b, label AS y FROM ({SALES}) s WHERE label IS NOT NULL),
         m AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(a) AS ma, AVG(b) AS mb, AVG(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, var_pop(y) AS yy,
                      covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS byy FROM s),
         c AS (SELECT *, aa * bb - ab * ab AS det, (bb * ay - ab * byy) / (aa * bb - ab * ab) AS ca, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS cb FROM m),
         r AS (SELECT *, (ca * ay + cb * byy) / yy AS r2, (yy - ca * ay - cb * byy) * n / (n - 3) AS s2 FROM c)"""


@query("r4_ols", OLS + """
    SELECT 'const' AS term, round(my - ca * ma - cb * mb, 4) AS coefficient, round(sqrt(s2 / n + (ma * ma * s2 * bb / det - 2 * ma * mb * s2 * ab / det + mb * mb * s2 * aa / det) / n), 5) AS std_error FROM r
    UNION ALL SELECT 'l_quantity', round(ca, 4), round(sqrt(s2 * bb / det / n), 5) FROM r
    UNION ALL SELECT 'l_discount', round(cb, 4), round(sqrt(s2 * aa / det / n), 5) FROM r""")
def ols(spark, sf):
    fit = regress.ols(role(spark, sf, SALES), ["l_quantity", "l_discount"], "label")
    return rounded(rounded(fit.coefficients.select("term", "coefficient", "std_error"), 4, "coefficient"), 5, "std_error")


@query("r4_ols_summary", OLS + f"""
    SELECT 'label' AS target, CAST(n AS BIGINT) AS n_obs, (SELECT COUNT(*) FROM ({SALES}) s WHERE label IS NULL) AS dropped_rows, round(r2, 8) AS r_squared,
           round(1 - (1 - r2) * (n - 1) / (n - 3), 8) AS r_squared_adj, round({f_tail("(r2 / 2) / ((1 - r2) / (n - 3))", "2", "n - 3")}, 8) AS f_pvalue FROM r""")
def ols_summary(spark, sf):
    s = regress.price_regression(role(spark, sf, SALES), ["l_quantity", "l_discount"], "label").summary
    return rounded(s.select("target", "n_obs", "dropped_rows", "r_squared", "r_squared_adj", "f_pvalue"), 8, "r_squared", "r_squared_adj", "f_pvalue")


TERMS = ["l_quantity", "l_discount", "l_tax", "p_size", *(f"p_type_{t}" for t in TYPES[1:])]


@query("r4_ols_full", " UNION ALL ".join(f"SELECT '{t}' AS term, 0e0 AS rest, true AS bounded" for t in ["const", *TERMS]))
def ols_full(spark, sf):
    """What the residuals leave of each normal equation, relative to the label's size, and whether p and interval fit the coefficient."""
    rows = role(spark, sf, SALES)
    fit = regress.price_regression(rows, ["l_quantity", "l_discount", "l_tax", "p_size", "p_type"], "label").coefficients
    found = {r.term: r for r in fit.collect()}  # one row per term
    design, names, _ = regress.design_matrix(rows, ["l_quantity", "l_discount", "l_tax", "p_size", "p_type"], ["label"])
    design = design.dropna()
    fitted = sum((F.col(f"`{n}`") * found[n].coefficient for n in names), F.lit(found["const"].coefficient))
    e, scale = F.col("label") - fitted, F.avg(F.abs("label"))
    sums = design.agg(*[(F.avg(e * (F.lit(1.0) if t == "const" else F.col(f"`{t}`"))) / scale).alias(f"s{i}") for i, t in enumerate(["const", *names])])
    terms = [F.struct(F.lit(t).alias("term"), (F.round(F.col(f"s{i}"), 6) + 0.0).alias("rest"), F.lit(bool(found[t].std_error > 0 and 0 <= found[t].p_value <= 1)).alias("bounded")) for i, t in enumerate(["const", *names])]
    return sums.select(F.inline(F.array(*terms)))


@query("r5_vif", """
    WITH c AS (SELECT corr(l_quantity, l_extendedprice + l_quantity * 300) AS ab, corr(l_quantity, l_discount) AS ac, corr(l_extendedprice + l_quantity * 300, l_discount) AS bc FROM {lineitem}),
         d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM c)
    SELECT 'a' AS predictor, round((1 - bc * bc) / det, 7) AS vif, (1 - bc * bc) / det > 5 AS flagged FROM d
    UNION ALL SELECT 'b', round((1 - ac * ac) / det, 7), (1 - ac * ac) / det > 5 FROM d
    UNION ALL SELECT 'c', round((1 - ab * ab) / det, 7), (1 - ab * ab) / det > 5 FROM d""")
def vif(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("a"), (F.col("l_extendedprice") + F.col("l_quantity") * 300).alias("b"), F.col("l_discount").alias("c")
    )
    return rounded(regress.vif(rows, ["a", "b", "c"]), 7, "vif")


@query("m1_feature_matrix", f"SELECT {', '.join(KEYS)}, l_quantity, {_dummies(TYPES)} FROM ({GAPS.format(s=SALES)}) g")
def feature_matrix(spark, sf):
    rows = role(spark, sf, GAPS.format(s=SALES))
    return model.feature_matrix(rows, ["l_quantity", "blank", "absent"], ["p_type"], KEYS, leakage=["label"])[0]


# One row per sold part.
PARTS = """
SELECT p_partkey AS key, p_size, p_type, AVG(l_quantity) AS quantity, AVG(l_discount) AS discount,
       CAST(COUNT(*) AS DOUBLE) AS sales, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE SUM(l_quantity) * (10 + p_size) END AS label
FROM {part} JOIN {lineitem} ON l_partkey = p_partkey GROUP BY p_partkey, p_size, p_type
"""
FEATURES = ["p_size", "quantity", "discount", "sales"]
# Every line with a label, keyed by all that names a line; features as they are.
LINES = f"SELECT concat_ws('-', {', '.join(KEYS)}) AS key, l_quantity, l_discount, l_tax, p_size, p_retailprice, p_type, label FROM ({SALES}) s"
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
#: Attributions cost rows x nodes: those of the lines explain a forest whose leaves hold so many rows at least.
EXPLAINED_ROWS = 100

SPLIT = "CAST('0x' || substr(md5('42-' || CAST(key AS STRING)), 1, 8) AS BIGINT) % 100"


def _design(spark, sf, rows, numeric, label="label"):
    df = written(role(spark, sf, rows).withColumn("label", F.expr(label)), "rows")
    design, features, _ = model.feature_matrix(df, numeric, ["p_type"], ["key", "label"], leakage=["l_extendedprice"])
    return design.dropna(), features


@query("m2_split", f"SELECT key, label, CASE WHEN {SPLIT} < 80 THEN 'train' ELSE 'test' END AS part FROM ({PARTS}) p WHERE label IS NOT NULL")
def split(spark, sf):
    design, _ = _design(spark, sf, PARTS, FEATURES)
    train, test = model.split(design.select("key", "label"), "key")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def _fit(spark, sf, rows=PARTS, label="label", min_rows=1):
    """The forest at its full size (200 trees to pure leaves), fitted once for all queries of a session."""
    return _fitted(spark, sf, rows, label, min_rows)


@lru_cache(maxsize=8)
def _fitted(spark, sf, rows, label, min_rows):
    design, features = _design(spark, sf, rows, FEATURES if rows is PARTS else LINE_FEATURES, label)
    train, test = model.split(design, "key")
    return model.rf_regress(train, features, "label", min_rows=min_rows), train, test


def _scored(spark, sf, rows=PARTS, label="label", logged=False):
    """The test rows with their predictions, made once for all queries of a session."""
    return _predicted(spark, sf, rows, label, logged)


@lru_cache(maxsize=8)
def _predicted(spark, sf, rows, label, logged):
    forest, _, test = _fit(spark, sf, rows, label)
    return written(model.predict_back(model.predict(forest, test), logged), "scored")


def _test(rows: str) -> str:
    return f"(SELECT key, label FROM ({rows}) p WHERE label IS NOT NULL AND {SPLIT} >= 80)"


def _gain(rows: str) -> str:
    """What predicting the training mean costs; the forest's own errors are only compared with it."""
    mean = f"(SELECT AVG(label) FROM ({rows}) p WHERE {SPLIT} < 80)"
    return f"""SELECT COUNT(*) AS n, round(AVG(abs(label - base)), 4) AS baseline_mae, round(sqrt(AVG(pow(label - base, 2))), 4) AS baseline_rmse,
               true AS beats_mean, true AS explains FROM (SELECT label, {mean} AS base FROM {_test(rows)} t) t"""


def _judged(spark, sf, rows, least):
    _, train, test = _fit(spark, sf, rows)
    found = model.regression_metrics(_scored(spark, sf, rows), F.col("label"), F.col("predicted"))
    gain = model.improvement(found, model.mean_baseline(train, test, "label")).withColumn("r2", found.select("r2").scalar())
    gain = gain.select("n", "baseline_mae", "baseline_rmse", (F.col("mae") < F.col("baseline_mae")).alias("beats_mean"), (F.col("r2") > least).alias("explains"))
    return rounded(gain, 4, "baseline_mae", "baseline_rmse")


@query("m3_rf_regress", _gain(PARTS))
def rf_regress(spark, sf):
    return _judged(spark, sf, PARTS, 0.8)


@query("m3_rf_lines", _gain(LINES))
def rf_lines(spark, sf):
    """The forest on every line."""
    return _judged(spark, sf, LINES, 0.95)


@query("m3_rf_metrics")
def rf_metrics(spark, sf):
    return model.regression_metrics(_scored(spark, sf), F.col("label"), F.col("predicted"))


@query("m3_rf_lines_metrics")
def rf_lines_metrics(spark, sf):
    return model.regression_metrics(_scored(spark, sf, LINES), F.col("label"), F.col("predicted"))


@query("m3_whole_tree", f"SELECT key, round(label, 4) AS label, round(AVG(label) OVER (PARTITION BY {', '.join(LINE_FEATURES)}, p_type), 4) AS predicted FROM ({LINES}) l WHERE label IS NOT NULL")
def whole_tree(spark, sf):
    """One tree that draws every line once and splits as long as lines differ: each line gets the mean of its like."""
    design, features = _design(spark, sf, LINES, LINE_FEATURES)
    forest = model.rf_regress(design, features, "label", trees=1, bootstrap=False)
    return rounded(model.predict(forest, design, "predicted").select("key", "label", "predicted"), 4, "label", "predicted")


def _stump() -> str:
    """The split of all lines that lowers the squared error most, by trying every value of every feature."""
    one = "SELECT '{f}' AS feature, {k} AS k, v, SUM(c) OVER up AS lw, SUM(s) OVER up AS ls, SUM(c) OVER () AS w, SUM(s) OVER () AS s, LEAD(v) OVER (ORDER BY v) AS next FROM (SELECT v, COUNT(*) AS c, SUM(label) AS s FROM (SELECT {x} AS v, label FROM ({rows}) l WHERE label IS NOT NULL) a GROUP BY v) g WINDOW up AS (ORDER BY v)"
    features = {f: f for f in LINE_FEATURES} | {f"p_type_{t}": f"CASE WHEN p_type = '{t}' THEN 1e0 ELSE 0e0 END" for t in TYPES}
    every = " UNION ALL ".join(one.format(f=f, k=k, x=f"CAST({x} AS DOUBLE)", rows=LINES) for k, (f, x) in enumerate(features.items()))
    return f"""SELECT feature, round((v + next) / 2, 8) AS threshold, round(ls / lw, 4) AS left_value, round((s - ls) / (w - lw), 4) AS right_value, CAST(lw AS DOUBLE) AS left_rows
               FROM ({every}) e WHERE next IS NOT NULL ORDER BY ls * ls / lw + (s - ls) * (s - ls) / (w - lw) DESC, k, v LIMIT 1"""


@query("m3_first_split", _stump())
def first_split(spark, sf):
    """Feature, threshold and both means of a tree of one split."""
    design, features = _design(spark, sf, LINES, LINE_FEATURES)
    found = model.rf_regress(design, features, "label", trees=1, bootstrap=False, max_depth=1).first_splits()
    names = F.array(*map(F.lit, features))
    return rounded(rounded(found.select(names[F.col("feature")].alias("feature"), "threshold", "left_value", "right_value", "left_rows"), 4, "left_value", "right_value"), 8, "threshold")


def _scale(spark, sf, rows):
    """Whether predictions are on the label's scale: inside the training labels, and unchanged."""
    _, train, _ = _fit(spark, sf, rows)
    low, high = train.agg(F.min("label")).scalar(), train.agg(F.max("label")).scalar()
    fits = (F.col("predicted") == F.col("raw_prediction")) & F.col("predicted").between(low - 1e-6, high + 1e-6)
    return rounded(_scored(spark, sf, rows).select("key", "label", fits.alias("on_scale")), 6, "label")


def _log_scale(spark, sf, rows):
    _, train, _ = _fit(spark, sf, rows, "log10(label)")
    low, high = train.agg(F.min("label")).scalar(), train.agg(F.max("label")).scalar()
    fits = (F.abs(F.log10("predicted") - F.col("raw_prediction")) < 1e-9) & F.col("raw_prediction").between(low - 1e-6, high + 1e-6)
    return _scored(spark, sf, rows, "log10(label)", True).select("key", F.round("label", 9).alias("label"), fits.alias("on_scale"))


for _name, _rows in (("", PARTS), ("_lines", LINES)):
    query(f"m4_predict_back{_name}", f"SELECT key, round(label, 6) AS label, true AS on_scale FROM {_test(_rows)} t")(partial(_scale, rows=_rows))
    query(f"m4_predict_back_log{_name}", f"SELECT key, round(log10(label), 9) AS label, true AS on_scale FROM {_test(_rows)} t")(partial(_log_scale, rows=_rows))


GUESS = f"SELECT {', '.join(KEYS)}, l_linestatus, label, l_quantity * 9e2 AS guess FROM ({SALES}) s"


def _metrics(actual: str, predicted: str, source: str) -> str:
    return f"""SELECT COUNT({actual} - {predicted}) AS n, round(AVG(abs({actual} - {predicted})), 5) AS mae, round(sqrt(AVG(pow({actual} - {predicted}, 2))), 5) AS rmse,
               round(1 - AVG(pow({actual} - {predicted}, 2)) / var_pop({actual}), 8) AS r2 FROM {source}"""


def _round_metrics(df):
    return rounded(rounded(df, 5, "mae", "rmse"), 8, "r2")


@query("m5_regression_metrics", _metrics("label", "guess", f"({GUESS}) g"))
def regression_metrics(spark, sf):
    return _round_metrics(model.regression_metrics(role(spark, sf, GUESS), F.col("label"), F.col("guess")))


BASE = f"(SELECT label, (SELECT AVG(label) FROM ({GUESS}) t WHERE l_linestatus = 'O') AS base, guess FROM ({GUESS}) g WHERE l_linestatus = 'F') b"


def _by_status(spark, sf):
    rows = role(spark, sf, GUESS)
    return rows.where("l_linestatus = 'O'"), rows.where("l_linestatus = 'F'")


@query("m6_mean_baseline", _metrics("label", "base", BASE))
def mean_baseline(spark, sf):
    train, test = _by_status(spark, sf)
    return _round_metrics(model.mean_baseline(train, test, "label"))


@query("m6_improvement", f"""SELECT m.n, m.mae, m.rmse, b.mae AS baseline_mae, b.rmse AS baseline_rmse, round((b.mae - m.mae) / b.mae * 100, 4) AS mae_improvement_pct,
    round((b.rmse - m.rmse) / b.rmse * 100, 4) AS rmse_improvement_pct FROM ({_metrics("label", "guess", BASE)}) m, ({_metrics("label", "base", BASE)}) b""")
def improvement(spark, sf):
    train, test = _by_status(spark, sf)
    forest = model.regression_metrics(test, F.col("label"), F.col("guess"))
    out = model.improvement(forest, model.mean_baseline(train, test, "label"))
    return rounded(rounded(out, 5, "mae", "rmse", "baseline_mae", "baseline_rmse"), 4, "mae_improvement_pct", "rmse_improvement_pct")


@query("m7_largest_errors", f"""SELECT k, round(label, 6) AS label, guess, round(abs(label - guess), 6) AS abs_error FROM (
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS k, label, guess FROM ({GUESS}) g) q
    ORDER BY abs(label - guess) DESC NULLS LAST, k LIMIT 5""")
def largest_errors(spark, sf):
    rows = role(spark, sf, GUESS).withColumn("k", F.concat_ws("-", *KEYS))
    return rounded(model.largest_errors(rows, "k", "label", "guess"), 6, "label", "abs_error")


def _ranked(spark, sf, rows, main):
    """Ten features in order of importance: what all importances add up to, and whether a main one leads."""
    forest, _, _ = _fit(spark, sf, rows)
    ranked = model.importance_rank(forest)
    whole = importances(forest).agg(F.round(F.sum("importance"), 9)).scalar()
    order = F.transform(F.array_sort(F.collect_list(F.struct("rank", "importance"))), lambda r: r["importance"])
    return ranked.agg(
        F.count(F.lit(1)).cast("int").alias("n_features"), (order == F.sort_array(order, asc=False)).alias("descending"), F.min_by("feature", "rank").isin(*main).alias("main_first")
    ).select(whole.alias("total"), "*")


for _name, _rows, _main in (("", PARTS, ["sales", "p_size", "quantity"]), ("_lines", LINES, ["l_quantity"])):
    query(f"m8_importance_rank{_name}", "SELECT 1e0 AS total, 10 AS n_features, true AS descending, true AS main_first")(partial(_ranked, rows=_rows, main=_main))


def _least(rows):
    return 1 if rows is PARTS else EXPLAINED_ROWS


def _rest(spark, sf, rows):
    """Per row what base and attributions leave of the prediction, relative to it."""
    forest, _, test = _fit(spark, sf, rows, min_rows=_least(rows))
    raw = model.predict(forest, test).groupBy("key").agg(F.sum("raw_prediction").alias("raw"), F.count(F.lit(1)).alias("n"))
    values = shap.shap_values(forest, test, "key")
    whole = sum((F.col(f"`phi_{f}`") for f in forest.features), F.col("base"))
    sums = values.groupBy("key").agg(F.sum(whole).alias("whole"), F.count(F.lit(1)).alias("m"))
    return sums.join(raw, "key").select("key", "m", (F.round((F.col("whole") - F.col("raw")) / F.col("raw"), 8) + 0.0).alias("rest"))


def _drivers(spark, sf, rows, main):
    """Top attributions: how many, in order, and whether more of the main feature raises the label."""
    forest, _, test = _fit(spark, sf, rows, min_rows=_least(rows))
    ranked = shap.shap_rank(shap.shap_values(forest, test, "key"), forest.features)
    listed = F.collect_list(F.struct("mean_abs_shap", "feature", "direction"))
    raises = F.exists("r", lambda r: (r["feature"] == main) & (r["direction"] == "positive"))
    sizes = F.transform("r", lambda r: r["mean_abs_shap"])
    return ranked.agg(F.count(F.lit(1)).cast("int").alias("n"), listed.alias("r")).select("n", (sizes == F.reverse(F.array_sort(sizes))).alias("descending"), raises.alias("positive"))


for _name, _rows, _main in (("", PARTS, "sales"), ("_lines", LINES, "l_quantity")):
    query(f"m9_shap_values{_name}", f"SELECT key, COUNT(*) AS m, 0e0 AS rest FROM {_test(_rows)} t GROUP BY key")(partial(_rest, rows=_rows))
    query(f"m10_shap_rank{_name}", "SELECT 5 AS n, true AS descending, true AS positive")(partial(_drivers, rows=_rows, main=_main))
