"""Measures of scored rows.  Score and label stay in one frame, so they cannot get out of step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from billrisk.operators.ordering import row_numbers
from billrisk.schema import THRESHOLDS


def _ratio(top: Column, bottom: Column) -> Column:
    """0 where the ratio is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))


def threshold_metrics(
    df: DataFrame, score: str = "probability", label: str = "LatePmt2",
    thresholds: Sequence[float] = tuple(THRESHOLDS), op: str = ">", digits: int | None = None,
) -> DataFrame:
    """Accuracy, F1, recall and precision per threshold.

    One aggregate counts for all thresholds at once: rows are neither
    multiplied nor read again.  ``digits`` rounds the score first.
    """
    value = F.col(score) if digits is None else F.round(score, digits)
    positive = F.col(label) == 1
    compare = {">": lambda t: value > F.lit(t), ">=": lambda t: value >= F.lit(t)}[op]
    counts = [F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("pos")]
    for i, t in enumerate(thresholds):
        counts += [
            F.count_if(compare(t) & positive).alias(f"tp{i}"), F.count_if(compare(t)).alias(f"pp{i}"),
        ]
    rows = []
    for i, t in enumerate(thresholds):
        n, pos, tp, said = F.col("n"), F.col("pos"), F.col(f"tp{i}"), F.col(f"pp{i}")
        true_negative = n - pos - (said - tp)
        rows.append(F.struct(
            F.lit(float(t)).alias("Threshold"),
            _ratio(tp + true_negative, n).alias("Acc"),
            _ratio(2 * tp, said + pos).alias("F1"),
            _ratio(tp, pos).alias("Rec"),
            _ratio(tp, said).alias("Prec"),
        ))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Rows per (actual, predicted) pair."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """True and false negatives and positives of a 0/1 prediction, as one row."""
    a, p = F.col(actual) == 1, F.col(predicted) == 1
    return df.agg(
        F.count_if(~a & ~p).alias("tn"), F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"), F.count_if(a & p).alias("tp"),
    )


def confusion_matrix(df: DataFrame, classes: Sequence, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row per actual class, one column ``p<class>`` per predicted class."""
    pred = F.col(predicted)
    return df.groupBy(F.col(actual).alias("actual")).agg(*[
        F.count_if(pred == F.lit(c)).alias(f"p{c}") for c in classes
    ])


def confusion_normalized(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """The confusion table with each count as a share of its actual and of its predicted class.

    The windows run over the classes x classes table.
    """
    n = F.col("n")
    return confusion(df, actual, predicted).select(
        "actual", "predicted", "n",
        (n * 1.0 / F.sum("n").over(Window.partitionBy("actual"))).alias("recall_share"),
        (n * 1.0 / F.sum("n").over(Window.partitionBy("predicted"))).alias("precision_share"),
    )


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    same = (F.col(actual) == F.col(predicted)).cast("int")
    return df.agg((F.sum(same) * 1.0 / F.count(F.lit(1))).alias("accuracy"))


def assign_decile(
    df: DataFrame, score: str = "probability", key: str | Sequence[str] = "PIN", q: int = 10, out: str = "DecileRank",
) -> DataFrame:
    """Decile 1 holds the highest scores; equal scores are ordered by the key columns.

    Cuts are those of equal-frequency binning of the ranks 1..n.  The rank is
    exact and found by range partitioning, not by one window over all rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(score).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in keys]]
    ranked = row_numbers(df, order, "_rank", total="_rows")
    step = F.ceil(F.try_divide((F.col("_rank") - 1) * q, F.col("_rows") - 1))
    decile = F.greatest(F.lit(1), step)
    return ranked.withColumn(out, decile.cast("int")).drop("_rank", "_rows")


def gain_lift(
    df: DataFrame, score: str = "probability", label: str = "LatePmt2", key: str | Sequence[str] = "PIN", q: int = 10,
) -> DataFrame:
    """Late payments found per decile of the score, their share, running share and lift.

    Rows equal in score and key are ordered by label, so the table is the same
    for any partitioning.
    """
    keys = dict.fromkeys([*([key] if isinstance(key, str) else key), label])
    ranked = assign_decile(df.select(score, *keys), score, list(keys), q)
    table = ranked.groupBy("DecileRank").agg(
        F.count(label).alias("DecileN"), F.sum(label).alias("GainN"),
    )
    # From here on there are q rows.
    everything = Window.partitionBy()
    upto = Window.orderBy("DecileRank").rowsBetween(Window.unboundedPreceding, 0)
    late, rows = F.sum("GainN").over(everything), F.sum("DecileN").over(everything)
    running = F.sum("GainN").over(upto)
    rate = F.try_divide(F.col("GainN") * 100.0, F.col("DecileN"))
    return table.select(
        "DecileRank", "DecileN", "GainN", running.alias("CumulativeGainN"),
        F.round(rate, 3).alias("Late%ByDecile"),
        F.round(F.try_divide(F.col("GainN") * 100.0, late), 3).alias("GainN%"),
        F.round(F.try_divide(running * 100.0, late), 3).alias("CumulativeGain%"),
        F.round(F.try_divide(rate, F.try_divide(late * 100.0, rows)), 3).alias("Lift"),
    )


def regression_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """R squared and MAPE in percent, MAE, and the sums they come from, in one aggregate.

    The total sum of squares is the population variance times the row count,
    which Spark accumulates without a second pass for the mean.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = F.abs(y - p)
    sums = df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(error).alias("ae"), F.sum(error * error).alias("ssr"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("tss"),
        F.sum(F.try_divide(error, F.abs(y))).alias("ape"),
    )
    n = F.col("n")
    return sums.select(
        "n", F.round("ssr", 2).alias("ssr"), F.round("tss", 2).alias("tss"),
        F.round((1 - F.try_divide(F.col("ssr"), F.col("tss"))) * 100, 6).alias("r2_pct"),
        F.round(F.try_divide(F.col("ae"), n), 6).alias("mae"),
        F.round(F.try_divide(F.col("ape") * 100, n), 6).alias("mape_pct"),
    )


def error_by_true(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Mean absolute error per true value."""
    error = F.abs(F.col(predicted) - F.col(actual))
    return df.groupBy(F.col(actual).alias("actual")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(error), 6).alias("mean_abs_error"),
    )
