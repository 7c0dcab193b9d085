"""Scaling, training, scoring and evaluation over the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators import evaluation as E
from lakeloom.operators import models as M
from lakeloom.operators import scaling as Z
from lakeloom.operators.anomaly import with_loss
from lakeloom.operators.rows import split_random
from lakeloom.plans.registry import Tables, hash_sql, near, near_all, near_sql, query, train_sql
from lakeloom.session import scratch_path

PRICE_SQL = "FROM customer, (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS mean, stddev_samp(c_acctbal) AS ss, stddev_pop(c_acctbal) AS sp FROM customer)"


def balances(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", "c_acctbal")


@query("minmax_scale", f"SELECT c_custkey, {near_sql('(c_acctbal - lo) / (hi - lo)')} AS c_acctbal {PRICE_SQL}")
def minmax_scale(t: Tables) -> DataFrame:
    return near_all(Z.minmax_scale(balances(t), ["c_acctbal"]))


@query("zscore", f"SELECT c_custkey, {near_sql('(c_acctbal - mean) / ss')} AS c_acctbal {PRICE_SQL}")
def zscore(t: Tables) -> DataFrame:
    return near_all(Z.zscore(balances(t), ["c_acctbal"]))


@query("standard_scale", f"SELECT c_custkey, {near_sql('(c_acctbal - mean) / sp')} AS c_acctbal {PRICE_SQL}")
def standard_scale(t: Tables) -> DataFrame:
    return near_all(Z.zscore(balances(t), ["c_acctbal"], population=True))


@query("impute_mean", f"""
WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer)
SELECT c_custkey, {near_sql('coalesce(balance, (SELECT avg(balance) FROM a))')} AS balance FROM a""")
def impute_mean(t: Tables) -> DataFrame:
    some = t.customer.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return near_all(Z.impute_mean(some, ["balance"]))


@query("fit_apply_preprocessor", f"""
WITH a AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance, CASE WHEN c_nationkey > 3 THEN c_nationkey END AS code FROM customer),
s AS (SELECT min(balance) AS lo, max(balance) AS hi, avg(balance) AS mean, avg(code) AS code_mean FROM a WHERE {train_sql("c_custkey")})
SELECT c_custkey, {near_sql('(coalesce(balance, mean) - lo) / (hi - lo)')} AS balance, {near_sql('coalesce(code, code_mean)')} AS code FROM a, s""")
def fit_apply_preprocessor(t: Tables) -> DataFrame:
    """Parameters fitted on the train part, saved, loaded and applied to all rows."""
    some = t.customer.select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_nationkey") > 3, F.col("c_nationkey")).alias("code"),
    )
    path = scratch_path(t.spark, "preprocessor")
    train = split_random(some, ["c_custkey"], 0.8).filter("is_train")
    Z.Preprocessor.fit(train, ["balance"], ["code"]).save(t.spark, path)
    return near_all(Z.Preprocessor.load(t.spark, path).apply(some))


# --- training and scoring --------------------------------------------------------------------------------

LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def returned_lines(t: Tables, *also: Column) -> DataFrame:
    """Line items with a 0/1 target, keyed and split by their whole row."""
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", *LINE_FEATURES, F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("label"), *also
    )
    scaled = Z.minmax_scale(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return split_random(scaled, ["l_orderkey", "l_partkey", "l_linenumber"], 0.8)


@query("logistic_score")
def logistic_score(t: Tables) -> DataFrame:
    """Accuracy of a logistic model of returned lines on the part held out."""
    rows = returned_lines(t)
    model = M.train_logistic(rows.filter("is_train"), LINE_FEATURES, "label")
    scored = M.score(model, rows.filter("NOT is_train"), "label")
    return near_all(E.classification_metrics(scored, "prediction", "label"))


@query("random_forest_importance")
def random_forest_importance(t: Tables) -> DataFrame:
    rows = returned_lines(t)
    model = M.train_random_forest(rows.filter("is_train"), LINE_FEATURES, "label", trees=20)
    return M.feature_importance(rows, model, LINE_FEATURES).orderBy(F.desc("importance"), "feature")


@query("svm_score")
def svm_score(t: Tables) -> DataFrame:
    """Counts of a three-class linear separation of the return flag (A, N, R)."""
    kind = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    rows = returned_lines(t, kind.alias("kind"))
    model = M.train_svm(rows.filter("is_train"), LINE_FEATURES, "kind")
    return E.confusion_matrix(M.score(model, rows.filter("NOT is_train"), "kind"), "prediction", "kind", (0.0, 1.0, 2.0))


@query("separable_accuracy", "SELECT true AS logistic_above_floor, true AS forest_above_floor, true AS svm_above_floor, true AS importances_sum_to_one")
def separable_accuracy(t: Tables) -> DataFrame:
    """Models on a class that their features tell apart: each must pass a floor of held-out accuracy."""
    rows = returned_lines(t).withColumn("high", F.when(F.col("l_quantity") + F.col("l_discount") > 1.0, 1.0).otherwise(0.0))
    train, test = rows.filter("is_train"), rows.filter("NOT is_train")

    def right(model, label: str = "high") -> float:
        return M.score(model, test, label).agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]

    forest = M.train_random_forest(train, LINE_FEATURES, "high", trees=10)
    total = M.feature_importance(rows, forest, LINE_FEATURES).agg(F.sum("importance")).first()[0]
    found = (
        right(M.train_logistic(train, LINE_FEATURES, "high")) > 0.95, right(forest) > 0.85,
        right(M.train_svm(train, LINE_FEATURES, "high")) > 0.9, abs(total - 1) < 1e-9,
    )
    names = ("logistic_above_floor", "forest_above_floor", "svm_above_floor", "importances_sum_to_one")
    return t.lineitem.limit(1).select(*[F.lit(bool(v)).alias(n) for n, v in zip(names, found)])


@query("saved_model_scores", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM lineitem")
def saved_model_scores(t: Tables) -> DataFrame:
    """A model trained, saved, loaded and used on every line: it scores like the one in memory."""
    rows = returned_lines(t)
    model = M.train_logistic(rows.filter("is_train"), LINE_FEATURES, "label")
    loaded = M.load_model(M.save_model(model, scratch_path(t.spark, "model")))
    once = M.score(model, rows, *LINE_FEATURES).withColumnRenamed("prediction", "first")
    both = M.score(loaded, once, "first")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") != F.col("prediction")).alias("different"))


@query("sweep_trials")
def sweep_trials(t: Tables) -> DataFrame:
    rows = returned_lines(t)
    trials = M.sweep(rows.filter("is_train"), rows.filter("NOT is_train"), LINE_FEATURES, "label", trees=5)
    return M.trial_table(rows, trials)


_KEY = ("l_orderkey", "l_partkey", "l_linenumber")


def _rung_sql(rung: int, trials: int) -> str:
    share = 2**48 // 2 ** (2 - rung)
    return (
        f"SELECT {rung} AS rung, CAST({trials} AS BIGINT) AS trials, CAST({max(1, trials // 2)} AS BIGINT) AS survivors, count(*) AS rows, "
        f"true AS least_loss_goes_on, true AS accurate FROM lineitem WHERE {train_sql(*_KEY)} AND {hash_sql(*_KEY, seed=5)} < {share}"
    )


@query("sweep_halving", " UNION ALL ".join(_rung_sql(r, n) for r, n in enumerate((4, 2, 1))))
def sweep_halving(t: Tables) -> DataFrame:
    """Three classes told apart by two features: trials, survivors and rows of each rung of a grid of four; survivors have the
    least loss of their rung, and the best trial of the last rung is right on nine of ten held-out lines."""
    rows = returned_lines(t).withColumn("kind", F.when(F.col("l_quantity") < 0.5, 0.0).when(F.col("l_discount") < 0.5, 1.0).otherwise(2.0))
    trace, _, _ = M.halving_sweep(
        rows.filter("is_train"), rows.filter("NOT is_train"), LINE_FEATURES, "kind", _KEY, (0.0, 1.0, 2.0), rates=(0.1, 0.5), depths=(1, 3), trees=3
    )
    lost, won = F.min(F.when(~F.col("survived"), F.col("logloss"))), F.max(F.when(F.col("survived"), F.col("logloss")))
    last = (F.col("rung") < 2) | F.coalesce(F.max(F.when(F.col("survived"), F.col("accuracy"))) > 0.9, F.lit(False))
    return trace.groupBy("rung").agg(
        F.count(F.lit(1)).alias("trials"), F.count_if("survived").alias("survivors"), F.max("rows").alias("rows"),
        F.coalesce(won <= lost, F.lit(True)).alias("least_loss_goes_on"), last.alias("accurate"),
    )


@query("linear_fit", f"""
SELECT {near_sql('regr_slope(l_extendedprice, l_quantity)')} AS slope, {near_sql('regr_intercept(l_extendedprice, l_quantity)')} AS intercept,
       {near_sql('regr_r2(l_extendedprice, l_quantity)')} AS r2 FROM lineitem""")
def linear_fit(t: Tables) -> DataFrame:
    return near_all(M.linear_fit(t.lineitem, "l_quantity", "l_extendedprice"))


@query("linear_model", f"""
SELECT feature, {near_sql('v', 4)} AS value FROM (
  SELECT 'l_quantity' AS feature, regr_slope(l_extendedprice, l_quantity) AS v FROM lineitem
  UNION ALL SELECT 'intercept', regr_intercept(l_extendedprice, l_quantity) FROM lineitem)""")
def linear_model(t: Tables) -> DataFrame:
    """Coefficients of the trained linear model."""
    model = M.train_linear(t.lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity"], "l_extendedprice").stages[-1]
    found = [("l_quantity", float(model.coefficients[0])), ("intercept", float(model.intercept))]
    return near_all(t.spark.createDataFrame(found, "feature string, value double"), 4)


WEIGHTS = {"l_quantity": 0.02, "l_discount": 3.0, "l_tax": -1.5}
SCORE_SQL = "0.1e0 + l_quantity * 0.02e0 + l_discount * 3.0e0 + l_tax * -1.5e0"


@query("score_linear", f"SELECT l_orderkey, l_partkey, {near_sql(SCORE_SQL)} AS score FROM lineitem")
def score_linear(t: Tables) -> DataFrame:
    return near_all(t.lineitem.select("l_orderkey", "l_partkey", M.linear_score(WEIGHTS, 0.1).alias("score")))


@query("reconstruction_loss")
def reconstruction_loss(t: Tables) -> DataFrame:
    """Loss of every line item under a two-component reconstruction fitted on the lines kept."""
    rows = returned_lines(t)
    model = M.Reconstruction.fit(rows.filter("is_train AND label = 0"), LINE_FEATURES, 2)
    hat = model.apply(rows)
    out = with_loss(hat, LINE_FEATURES, [c + "_hat" for c in LINE_FEATURES])
    return out.select("l_orderkey", "l_partkey", "l_linenumber", near("loss").alias("loss"))


# --- evaluation ------------------------------------------------------------------------------------------


@query("results_table", "SELECT doc_id, toxic AS \"Predicted\", quality AS \"Actual\", toxic = quality AS \"Validation\" FROM labels")
def results_table(t: Tables) -> DataFrame:
    return E.results_table(t.labels, "toxic", "quality", "doc_id")


_TP = "count(*) FILTER (WHERE quality = 1 AND guess = 1)"
_FP = "count(*) FILTER (WHERE quality = 0 AND guess = 1)"
_FN = "count(*) FILTER (WHERE quality = 1 AND guess = 0)"
GUESS_SQL = "g AS (SELECT doc_id, quality, CASE WHEN n_chars > 700 THEN 1 ELSE 0 END AS guess, n_chars / 50 AS s FROM labels JOIN documents USING (doc_id))"


def guesses(t: Tables) -> DataFrame:
    """Quality guessed from the text length."""
    joined = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    return joined.select(
        "doc_id", "quality", F.when(F.col("n_chars") > 700, 1).otherwise(0).alias("guess"), (F.col("n_chars") / 50).alias("s")
    )


@query("classification_metrics", f"""
WITH {GUESS_SQL}
SELECT {near_sql('avg(CASE WHEN quality = guess THEN 1.0e0 ELSE 0 END)')} AS accuracy, {near_sql(f'{_TP} / ({_TP} + {_FP})')} AS precision,
       {near_sql(f'{_TP} / ({_TP} + {_FN})')} AS recall, {near_sql(f'2 * {_TP} / (2 * {_TP} + {_FP} + {_FN})')} AS f1 FROM g""")
def classification_metrics(t: Tables) -> DataFrame:
    return near_all(E.classification_metrics(guesses(t), "guess", "quality"))


@query("confusion_matrix", f"""
WITH {GUESS_SQL} SELECT a.v AS actual, p.v AS predicted, count(g.doc_id) AS n
FROM (SELECT unnest([0, 1]) AS v) a CROSS JOIN (SELECT unnest([0, 1]) AS v) p LEFT JOIN g ON g.quality = a.v AND g.guess = p.v GROUP BY 1, 2""")
def confusion_matrix(t: Tables) -> DataFrame:
    return E.confusion_matrix(guesses(t), "guess", "quality")


STEPS_SQL = f"""
{GUESS_SQL},
d AS (SELECT s AS threshold, count(*) FILTER (WHERE quality = 1) AS pos, count(*) FILTER (WHERE quality <> 1) AS neg FROM g GROUP BY 1),
st AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM d)"""


@query("roc_curve", f"WITH {STEPS_SQL} SELECT {near_sql('threshold')} AS threshold, {near_sql('fp / n')} AS fpr, {near_sql('tp / p')} AS tpr FROM st")
def roc_curve(t: Tables) -> DataFrame:
    return near_all(E.roc_curve(guesses(t), "s", "quality"))


@query("roc_auc", f"WITH {STEPS_SQL} SELECT {near_sql('sum(neg * (2 * tp - pos)) / (2.0e0 * max(p) * max(n))')} AS auc FROM st")
def roc_auc(t: Tables) -> DataFrame:
    return near_all(E.roc_auc(guesses(t), "s", "quality"))


@query("roc_auc_lines", f"""
WITH g AS (SELECT {SCORE_SQL} AS s, l_returnflag = 'R' AS y FROM lineitem),
d AS (SELECT s, count(*) FILTER (WHERE y) AS pos, count(*) FILTER (WHERE NOT y) AS neg FROM g GROUP BY 1),
st AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM d)
SELECT {near_sql('sum(neg * (2 * tp - pos)) / (2.0e0 * max(p) * max(n))')} AS auc FROM st""")
def roc_auc_lines(t: Tables) -> DataFrame:
    """Area of a fixed linear score over all line items."""
    scored = t.lineitem.select(M.linear_score(WEIGHTS, 0.1).alias("s"), F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))
    return near_all(E.roc_auc(scored, "s", "y", rows_per_cut=1_000))


@query("pr_curve", f"WITH {STEPS_SQL} SELECT {near_sql('threshold')} AS threshold, {near_sql('tp / (tp + fp)')} AS precision, {near_sql('tp / p')} AS recall FROM st")
def pr_curve(t: Tables) -> DataFrame:
    return near_all(E.pr_curve(guesses(t), "s", "quality"))


@query("regression_metrics", """
WITH e AS (SELECT o_totalprice AS y, 250000e0 + 100 * (o_custkey % 7) AS p FROM orders)
SELECT round(avg((y - p) * (y - p)), 2) AS mse, round(avg(abs(y - p)), 2) AS mae, round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)), 4) AS mape,
       round(sqrt(avg((y - p) * (y - p))), 2) AS rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) AS r2 FROM e""")
def regression_metrics(t: Tables) -> DataFrame:
    guess = F.lit(250000.0) + F.lit(100) * (F.col("o_custkey") % 7)
    return E.regression_metrics(t.orders.select(F.col("o_totalprice").alias("y"), guess.alias("p")), "p", "y")


@query("chart_json", f"""
WITH {GUESS_SQL}, c AS (SELECT guess, count(*) AS n FROM g GROUP BY 1)
SELECT '{{"type":"bar","name":"predicted","x":[' || string_agg(guess, ',' ORDER BY n DESC, guess) || '],"y":[' || string_agg(n, ',' ORDER BY n DESC, guess) || ']}}' AS chart FROM c""")
def chart_json(t: Tables) -> DataFrame:
    return E.bar_chart(guesses(t), "guess", "predicted")


@query("chart_heatmap", f"""
WITH {GUESS_SQL}
SELECT '{{"type":"heatmap","name":"Confusion Matrix","x":["Predicted Negative","Predicted Positive"],"y":["Actual Negative","Actual Positive"],"z":[[' ||
  count(*) FILTER (WHERE quality = 0 AND guess = 0) || ',' || {_FP} || '],[' || {_FN} || ',' || {_TP} || ']]}}' AS chart FROM g""")
def chart_heatmap(t: Tables) -> DataFrame:
    return E.heatmap_chart(guesses(t), "guess", "quality")


@query("chart_curve", f"WITH {STEPS_SQL} SELECT 'scatter' AS type, 'ROC Curve' AS name, {near_sql('fp / n')} AS x, {near_sql('tp / p')} AS y FROM st")
def chart_curve(t: Tables) -> DataFrame:
    return near_all(E.curve_points(E.roc_curve(guesses(t), "s", "quality"), "fpr", "tpr", "ROC Curve"))
