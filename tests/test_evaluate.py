import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from billrisk.operators import evaluate


@pytest.mark.parametrize("n", [1, 2, 11, 20, 23])
def test_deciles_are_those_of_quantile_cuts(spark, n):
    df = spark.createDataFrame([(i, (i * 7) % 5 / 10) for i in range(n)], "PIN int, probability double")
    got = [r["DecileRank"] for r in evaluate.assign_decile(df).orderBy("PIN").collect()]
    if n < 11:
        assert got[0] in range(1, 11) and len(got) == n
        return
    pdf = df.toPandas().sort_values(["probability", "PIN"], ascending=[False, True])
    pdf["want"] = pd.qcut(np.arange(1, n + 1), 10, labels=np.arange(1, 11)).astype(int)
    assert got == pdf.sort_values("PIN")["want"].tolist()


def test_deciles_of_equal_scores_follow_the_key(spark):
    df = spark.createDataFrame([(i, 0.5) for i in range(100)], "PIN int, probability double")
    out = evaluate.assign_decile(df).orderBy("PIN").collect()
    ranks = [r["DecileRank"] for r in out]
    assert ranks == sorted(ranks)
    assert {ranks.count(d) for d in range(1, 11)} == {10}


def test_gain_lift_totals(spark):
    df = spark.range(1000).select(F.col("id").alias("PIN"), (F.col("id") % 97 / 97).alias("probability"),
                                  (F.col("id") % 3 == 0).cast("int").alias("LatePmt2"))
    out = evaluate.gain_lift(df).orderBy("DecileRank").collect()
    assert sum(r["DecileN"] for r in out) == 1000 and max(r["DecileN"] for r in out) - min(r["DecileN"] for r in out) <= 1
    assert out[-1]["CumulativeGain%"] == 100.0 and out[-1]["CumulativeGainN"] == 334


def scores(spark):
    return spark.createDataFrame([(0.2, 1), (0.3, 0), (0.5, 1), (0.7, 0)], "probability double, LatePmt2 int")


def test_threshold_on_the_score_itself(spark):
    strict = evaluate.threshold_metrics(scores(spark), thresholds=[0.5]).first()
    loose = evaluate.threshold_metrics(scores(spark), thresholds=[0.5], op=">=").first()
    assert (strict["Acc"], strict["Prec"], strict["Rec"], strict["F1"]) == (0.25, 0.0, 0.0, 0.0)
    assert (loose["Acc"], loose["Prec"], loose["Rec"], loose["F1"]) == (0.5, 0.5, 0.5, 0.5)


def test_thresholds_without_positives(spark):
    none = evaluate.threshold_metrics(scores(spark).withColumn("LatePmt2", F.lit(0)), thresholds=[0.9]).first()
    assert tuple(none) == (0.9, 1.0, 0.0, 0.0, 0.0)


def test_confusion_adds_up(spark):
    said = scores(spark).withColumn("said", (F.col("probability") > 0.25).cast("int"))
    assert tuple(evaluate.confusion_counts(said, "LatePmt2", "said").first()) == (0, 2, 1, 1)
    shares = evaluate.confusion_normalized(said, "LatePmt2", "said").groupBy("actual").agg(F.sum("recall_share")).collect()
    assert all(abs(r[1] - 1) < 1e-12 for r in shares)


def test_regression_report(spark):
    y, p = np.array([10.0, 20.0, 40.0]), np.array([12.0, 18.0, 30.0])
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "actual double, predicted double")
    got = evaluate.regression_report(df).first()
    assert got["mae"] == pytest.approx(np.abs(y - p).mean(), abs=1e-6)
    assert got["mape_pct"] == pytest.approx(100 * (np.abs(y - p) / y).mean(), abs=1e-6)
    assert got["r2_pct"] == pytest.approx(100 * (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()), abs=1e-6)
