import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.operators import anomaly as A
from lakeloom.operators import evaluation as E
from lakeloom.operators import models as M
from lakeloom.operators.scaling import minmax_scale
from lakeloom.sources.synthetic import synthetic_classes


def got(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def test_results_and_confusion(make):
    df = make("p int, a int", (0, 0), (1, 1), (0, 1), (1, 0))
    assert [r["Validation"] for r in E.results_table(df, "p", "a").collect()] == [True, True, False, False]
    assert sorted(got(E.confusion_matrix(df, "p", "a"))) == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1)]
    assert got(E.classification_metrics(df, "p", "a")) == [(0.5, 0.5, 0.5, 0.5)]
    assert '"z":[[1,1],[1,1]]' in E.heatmap_chart(df, "p", "a").first()[0]


def test_bar_chart(make):
    df = make("p string", ("b",), ("a",), ("b",))
    assert E.bar_chart(df, "p", "n").first()[0] == '{"type":"bar","name":"n","x":["b","a"],"y":[2,1]}'
    assert sorted(got(E.bar_points(df, "p", "n"))) == [("bar", "n", "a", 1), ("bar", "n", "b", 2)]
    many = make("p int", *[(i,) for i in range(1_001)])
    assert E.bar_chart(many, "p", "n").first()[0].count(",") == 2 + 2 * 1_000 + 1 and E.bar_points(many, "p", "n").count() == 1_001


def test_regression_metrics(make):
    r = E.regression_metrics(make("p double, y double", (1.0, 2.0), (3.0, 4.0), (5.0, 4.0), (None, 9.0)), "p", "y").first()
    assert (r["mse"], r["mae"], r["rmse"], r["mape"], r["r2"]) == (1.0, 1.0, 1.0, 0.3333, -0.125)


def test_threshold_and_flags(make):
    five = make("loss double", *[(float(i),) for i in range(1, 6)], (None,))
    t = {r["spread"]: r["threshold"] for r in A.thresholds(five, "loss").collect()}
    assert t[0.0] == 3 and t[1.0] == pytest.approx(3 + np.std([1, 2, 3, 4, 5])) and t[3.0] == pytest.approx(3 + 3 * math.sqrt(2))
    flagged = A.flag_anomalies(make("loss double", (1.0,), (2.0,), (3.0,), (4.0,), (None,)), "loss", 2.0)
    assert [r["prediction"] for r in flagged.collect()] == [0, 0, 1, 1, 1]


def test_sweep_against_brute_force(make):
    rng = np.random.default_rng(1)
    train = [(float(x),) for x in rng.exponential(size=200)]
    test = [(float(x) if i % 17 else None, bool(i % 3)) for i, x in enumerate(rng.exponential(size=150) * 1.5)]
    out = {round(r["std_scalar"], 2): r for r in A.threshold_sweep(make("l double", *train), make("l double, n boolean", *test), "l", "n").collect()}
    assert sorted(out) == [round(s, 2) for s in np.arange(1, 3.0, 0.15)]
    losses = np.array([t[0] for t in train])
    for k, r in out.items():
        limit = losses.mean() + k * losses.std()
        keep = [x is not None and x < limit for x, _ in test]
        tn = sum(p and y for p, (_, y) in zip(keep, test))
        fp = sum(not p and y for p, (_, y) in zip(keep, test))
        fn = sum(p and not y for p, (_, y) in zip(keep, test))
        tp = sum(not p and not y for p, (_, y) in zip(keep, test))
        assert (r["tn"], r["fp"], r["fn"], r["tp"]) == (tn, fp, fn, tp)
        assert r["accuracy"] == pytest.approx((tn + tp) / len(test)) and r["precision"] == pytest.approx(tn / (tn + fn))
    chosen = A.threshold_select(A.threshold_sweep(make("l double", *train), make("l double, n boolean", *test), "l", "n"), 5).first()
    assert chosen["std_scalar"] == max(k for k, r in out.items() if r["tp"] >= 5)


@pytest.fixture(scope="module")
def classes(spark):
    return synthetic_classes(spark.range(600), ["id"], 3, 1).withColumn("label", F.col("target").cast("double")).cache()


FEATURES = ["x0", "x1", "x2"]


@pytest.mark.parametrize("train", [M.train_logistic, M.train_svm, lambda *a: M.train_random_forest(*a, trees=5)])
def test_classifiers_learn(classes, train):
    scored = M.score(train(classes, FEATURES, "label"), classes, "label")
    assert E.classification_metrics(scored, "prediction", "label").first()["accuracy"] > 0.8


def test_linear_and_importance(classes):
    df = classes.withColumn("y", F.col("x0") * 2 + 1)
    model = M.train_linear(df, ["x0"], "y").stages[-1]
    assert model.coefficients[0] == pytest.approx(2) and model.intercept == pytest.approx(1)
    assert M.linear_fit(df, "x0", "y").first()["slope"] == pytest.approx(2)
    forest = M.train_random_forest(classes, FEATURES, "label", trees=5)
    assert sum(r["importance"] for r in M.feature_importance(classes, forest, FEATURES).collect()) == pytest.approx(1)


def test_sweep_orders_trials(classes):
    trials = M.sweep(classes.filter("id % 4 > 0"), classes.filter("id % 4 = 0"), FEATURES, "label", trees=3)
    table = M.trial_table(classes, trials).collect()
    assert len(table) == 2 and table[0]["logloss"] <= table[1]["logloss"] < 0.7


def test_halving_keeps_the_least_loss(spark):
    rows = spark.range(400).selectExpr("id", "cast(id % 20 as double) a", "cast(id % 7 as double) b")
    rows = rows.withColumn("y", F.expr("if(id = 3, null, if(a < 10, 0, if(b < 3, 1, 2)))"))
    parts = rows.filter("id % 4 > 0"), rows.filter("id % 4 = 0")
    trace, models, best = M.halving_sweep(*parts, ["a", "b"], "y", ["id"], (0.0, 1.0, 2.0), rates=(0.05, 0.5), depths=(1, 3), trees=3)
    out = trace.collect()
    by = {r: [x for x in out if x["rung"] == r] for r in (0, 1, 2)}
    assert [len(by[r]) for r in by] == [4, 2, 1] and by[2][0]["rows"] == 299 > by[1][0]["rows"] > by[0][0]["rows"] > 0
    for r in (0, 1):
        low = sorted(by[r], key=lambda x: (x["logloss"], x["trial"]))[:len(by[r + 1])]
        assert {x["trial"] for x in low} == {x["trial"] for x in by[r] if x["survived"]} == {x["trial"] for x in by[r + 1]}
    assert best == {"learning_rate": by[2][0]["learning_rate"], "max_depth": by[2][0]["max_depth"]} and by[2][0]["accuracy"] > 0.95
    scored = M.boosted_scores(models, M.assemble(["a", "b"]).transform(parts[1]), (0.0, 1.0, 2.0)).collect()
    assert all(sum(r["probability"]) == pytest.approx(1) and r["probability"][int(r["prediction"])] == max(r["probability"]) for r in scored)
    with pytest.raises(ValueError):
        M.halving_sweep(*parts, ["a"], "y", ["id"], (0.0, 1.0), rates=())


def test_halving_trains_on_counts(spark, monkeypatch):
    """Trials see a row for each set of bins, however many rows there are, and learn what they learn from the rows."""
    rows = spark.range(6_000).selectExpr("id", "cast(id % 20 as double) a", "cast(id * 7 % 11 as double) b")
    rows = rows.withColumn("y", F.expr("if(id % 13 = 0, 2, if(a < 10, 0, if(b < 3, 1, 2)))").cast("double"))
    parts = rows.filter("id % 4 > 0"), rows.filter("id % 4 = 0")
    seen, real = [], M.train_boosted
    monkeypatch.setattr(M, "train_boosted", lambda df, *a, **b: seen.append(df.count()) or real(df, *a, **b))
    trace, models, best = M.halving_sweep(*parts, ["a", "b"], "y", ["id"], (0.0, 1.0, 2.0), rates=(0.3, 0.6), depths=(2,), trees=3)
    assert max(seen) <= 20 * 11 * 3 and max(r["rows"] for r in trace.collect()) == 4_500
    raw = M.assemble(["a", "b"])
    plain = real(raw.transform(parts[0]), "y", (0.0, 1.0, 2.0), best["learning_rate"], best["max_depth"], 3)
    held = raw.transform(parts[1])
    got, want = ([r["probability"] for r in M.boosted_scores(m, held, (0.0, 1.0, 2.0)).orderBy("id").collect()] for m in (models, plain))
    assert np.allclose(got, want, atol=1e-9)


def test_reconstruction_with_all_components_is_exact(classes):
    scaled = minmax_scale(classes, FEATURES)
    hats = [c + "_hat" for c in FEATURES]
    full = A.with_loss(M.Reconstruction.fit(scaled, FEATURES, 3).apply(scaled), FEATURES, hats)
    part = A.with_loss(M.Reconstruction.fit(scaled, FEATURES, 1).apply(scaled), FEATURES, hats)
    assert full.agg(F.max("loss")).first()[0] < 1e-9 < part.agg(F.avg("loss")).first()[0]
