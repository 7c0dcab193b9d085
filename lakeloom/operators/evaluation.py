"""Results tables, classification and regression metrics, and ROC / precision-recall curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.aggregates import exact_sum
from lakeloom.functions.scalars import as_col
from lakeloom.operators.ordering import ROWS_PER_CUT, running
from lakeloom.session import materialize


def results_table(df: DataFrame, predicted: Column | str, actual: Column | str, *keep: str) -> DataFrame:
    return df.select(
        *keep,
        as_col(predicted).alias("Predicted"),
        as_col(actual).alias("Actual"),
        (as_col(predicted).eqNullSafe(as_col(actual))).alias("Validation"),
    )


def classification_metrics(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """Accuracy, precision, recall and F1 for 0/1 columns in one pass."""
    p, a = F.col(predicted), F.col(actual)
    counted = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(p == a).alias("hit"),
        F.count_if((p == 1) & (a == 1)).alias("tp"),
        F.count_if((p == 1) & (a == 0)).alias("fp"),
        F.count_if((p == 0) & (a == 1)).alias("fn"),
    )
    zero = F.lit(0.0)
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero)
    recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero)
    f1 = F.coalesce(F.try_divide(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")), zero)
    return counted.select(
        F.try_divide("hit", "n").alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def confusion_matrix(df: DataFrame, predicted: str, actual: str, labels: tuple = (0, 1)) -> DataFrame:
    """Counts for every pair of labels, pairs that never occur included; one pass, no shuffle of rows."""
    pairs = [(a, p) for a in labels for p in labels]
    one = df.agg(
        *[F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c{i}") for i, (a, p) in enumerate(pairs)]
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{i}").alias("n"))
                    for i, (a, p) in enumerate(pairs)
                ]
            )
        )
    )


def score_steps(df: DataFrame, score: str, actual: str, rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it (pos, neg) and so far (tp, fp).

    Rows are counted by score before anything is ordered, so a score shared by most rows costs one row.
    """
    counted = (
        df.filter(F.col(score).isNotNull() & F.col(actual).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) != 1).alias("neg"))
    )
    counted = materialize(counted, "score-counts")
    return running(
        counted, [], [F.col("threshold").desc()], -F.col("threshold"), {"tp": "pos", "fp": "neg"},
        rows_per_cut=rows_per_cut,
    )


def _totals(steps: DataFrame) -> Column:
    return steps.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()


def roc_curve(df: DataFrame, score: str, actual: str, rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """False and true positive rate at every distinct score (the start point (0, 0) is left out)."""
    steps = score_steps(df, score, actual, rows_per_cut)
    return steps.withColumn("t", _totals(steps)).select(
        "threshold",
        F.try_divide("fp", "t.n").alias("fpr"),
        F.try_divide("tp", "t.p").alias("tpr"),
    )


def roc_auc(df: DataFrame, score: str, actual: str, rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """Area by trapezoids: each step adds its negatives times the mean of positives before and after it."""
    steps = score_steps(df, score, actual, rows_per_cut)
    area = F.sum((F.col("neg") * (F.col("tp") * 2 - F.col("pos"))).cast("decimal(38,0)"))
    return steps.agg(
        F.try_divide(area.cast("double"), F.sum("pos").cast("double") * F.sum("neg").cast("double") * 2).alias("auc")
    )


def pr_curve(df: DataFrame, score: str, actual: str, rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """Precision and recall at every distinct score (the end point (1, 0) is left out)."""
    steps = score_steps(df, score, actual, rows_per_cut)
    return steps.withColumn("t", _totals(steps)).select(
        "threshold",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "t.p").alias("recall"),
    )


def regression_metrics(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """MSE, MAE, RMSE rounded to 2 places, MAPE and R2 to 4."""
    y, e = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    n = F.count(e)
    # shares of the value, with a floor as denominator so that a true 0 cannot divide
    ape = F.abs(e) / F.greatest(F.abs(y), F.lit(2.220446049250313e-16))
    one = df.filter(e.isNotNull()).agg(
        (exact_sum(e * e, 6) / n).alias("mse"),
        (exact_sum(F.abs(e), 6) / n).alias("mae"),
        F.avg(ape).alias("mape"),
        exact_sum(e * e, 6).alias("sse"),
        (F.var_pop(y) * n).alias("sst"),
    )
    return one.select(
        F.round("mse", 2).alias("mse"),
        F.round("mae", 2).alias("mae"),
        F.round("mape", 4).alias("mape"),
        F.round(F.sqrt("mse"), 2).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide("sse", "sst"), 4).alias("r2"),
    )


def bar_points(df: DataFrame, column: str, name: str) -> DataFrame:
    """A bar chart's bars as rows, for any number of values."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("y"))
    return counts.select(F.lit("bar").alias("type"), F.lit(name).alias("name"), F.col(column).alias("x"), "y")


def bar_chart(df: DataFrame, column: str, name: str) -> DataFrame:
    """JSON series of value counts, most frequent first. The document holds every value; ``bar_points`` has them as rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(column).alias("v"), "n")))
    return counts.agg(ranked.alias("r")).select(
        F.to_json(
            F.struct(
                F.lit("bar").alias("type"),
                F.lit(name).alias("name"),
                F.col("r.v").alias("x"),
                F.col("r.n").alias("y"),
            )
        ).alias("chart")
    )


def heatmap_chart(df: DataFrame, predicted: str, actual: str) -> DataFrame:
    """JSON series of the 2 x 2 confusion matrix."""
    def cell(a: int, p: int) -> Column:
        return F.count_if((F.col(actual) == a) & (F.col(predicted) == p))

    z = F.array(F.array(cell(0, 0), cell(0, 1)), F.array(cell(1, 0), cell(1, 1)))
    return df.agg(z.alias("z")).select(
        F.to_json(
            F.struct(
                F.lit("heatmap").alias("type"),
                F.lit("Confusion Matrix").alias("name"),
                F.array(F.lit("Predicted Negative"), F.lit("Predicted Positive")).alias("x"),
                F.array(F.lit("Actual Negative"), F.lit("Actual Positive")).alias("y"),
                F.col("z"),
            )
        ).alias("chart")
    )


def curve_points(curve: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """A curve's points as chart rows; a curve may have any number of them, so they stay rows."""
    return curve.select(F.lit("scatter").alias("type"), F.lit(name).alias("name"), F.col(x).alias("x"), F.col(y).alias("y"))
