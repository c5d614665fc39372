"""Whole jobs on the smallest tables."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from billrisk.operators import model as forests
from billrisk.plans import BacktestSettings, ClassifierSettings, clean_bills, run_backtest, run_classifier
from billrisk.sources import load_model
from suite import views as V

SF = "/root/testdata/sf0.001"
SMALL = forests.ForestSettings(trees=5, depth=4)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def result(spark):
    settings = ClassifierSettings(current_year=V.TEST_YEAR, as_of=V.AS_OF, forest=SMALL)
    out = run_classifier(V.bills(spark, SF), V.due_dates(spark, SF), V.ledger(spark, SF), settings)
    yield out
    out.close()


def test_classifier_reports(result):
    n = result.scores.count()
    thresholds = result.thresholds().orderBy("Threshold").collect()
    assert [r["Threshold"] for r in thresholds] == [0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]
    assert all(0 <= r[c] <= 1 for r in thresholds for c in ("Acc", "F1", "Rec", "Prec"))
    gain = result.gain_lift().orderBy("DecileRank").collect()
    assert len(gain) == 10 and gain[-1]["CumulativeGain%"] == 100.0 and sum(r["DecileN"] for r in gain) == n
    assert sum(result.confusion().first()) == n


def test_key_year_and_label_are_not_features(result):
    assert not {"PIN", "TaxYear", "LatePmt2"} & set(result.features)
    assert {"WOE_Classification", "LatePmt2Sum", "PaymentCnt", "DiffPmt1"} <= set(result.features)
    importance = result.importance()
    assert importance.count() == len(result.features)
    assert abs(importance.agg(F.sum("Importance")).first()[0] - 1) < 1e-6
    assert result.importance(3).count() == 3


def test_stage_sizes_add_up(result):
    sizes = {r["stage"]: r["rows"] for r in result.sizes().collect()}
    assert sizes["train"] + sizes["test"] == sizes["features"] > 0


def test_export_and_reload(spark, result, tmp_path):
    result.export(str(tmp_path / "scores"))
    back = spark.read.csv(str(tmp_path / "scores"), header=True)
    assert back.columns == ["PIN", "probability", "prediction"] and back.count() == result.scores.count()
    result.save(str(tmp_path / "model"))
    assert load_model(str(tmp_path / "model")).stages[-1].getNumTrees == 5


def test_backtest_windows(spark):
    out = run_backtest(V.bills(spark, SF), V.due_dates(spark, SF), BacktestSettings(
        test_year=V.TEST_YEAR, train_years=3, as_of=V.AS_OF, forest=SMALL))
    years = {r[0] for r in out.stage("train").select("TaxYear").distinct().collect()}
    assert years == {V.TEST_YEAR - 3, V.TEST_YEAR - 2, V.TEST_YEAR - 1}
    assert {"TaxpayerMailingState_nonIL", "CofENumber_non0", "PastTaxSaleStatus_Y", "AreaFromPin_33",
            "AcquisitionStatus_1", "LatePmt1_0"} <= set(out.features)
    out.close()


def test_columns_of_the_second_instalment_never_become_features(spark):
    bills = V.bills(spark, SF).withColumns({"Surcharge2": F.lit("7"), "Refund2": F.lit(1.5)})
    place = bills.columns.index("Surcharge2")
    settings = ClassifierSettings(current_year=V.TEST_YEAR, as_of=V.AS_OF, policy="as_of")
    plain = clean_bills(bills, V.due_dates(spark, SF), settings).columns
    assert {"Surcharge2", "Refund2"} <= set(plain)
    for later in ({"later_positions": ((place, place + 2), (900, 910))}, {"later_columns": ("Surcharge2", "Refund2", "unknown", "PIN")}):
        left = clean_bills(bills, V.due_dates(spark, SF), dataclasses.replace(settings, **later)).columns
        assert set(plain) - set(left) == {"Surcharge2", "Refund2"}
