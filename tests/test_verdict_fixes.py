"""Mixed headers, results that do not depend on the partitioning, and defaults of the lateness jobs."""

import pytest
from pyspark.sql import functions as F

from billrisk import sources
from billrisk.operators import evaluate
from billrisk.operators.model import MULTICLASS, REGRESSOR
from billrisk.plans import ClassifierSettings, LatenessSettings, clean_bills, lateness
from billrisk.plans.classifier import history_table
from suite import views as V

SF = "/root/testdata/sf0.001"


def test_payments_are_found_by_name_in_each_file(spark, tmp_path):
    head = "PIN,TaxYear4,DatePaid,TotalPaid,{0},SourceID"
    from billrisk.schema import LEDGER_COLUMNS
    first = list(LEDGER_COLUMNS)
    (tmp_path / "a.csv").write_text(",".join(first) + "\n" + ",".join(f"a{i}" if c == "PIN" else "1" for i, c in enumerate(first)) + "\n")
    second = [*reversed(first), "Surplus"]
    (tmp_path / "b.csv").write_text(",".join(second) + "\n" + ",".join("b" if c == "PIN" else "1" for c in second) + "\n")
    got = {r["PIN"] for r in sources.read_payments(spark, str(tmp_path / "*.csv")).collect()}
    assert got == {f"a{first.index('PIN')}", "b"}
    (tmp_path / "c.csv").write_text(",".join(first[:-1]) + "\n")
    with pytest.raises(ValueError):
        sources.read_payments(spark, str(tmp_path / "*.csv"))


def test_history_does_not_depend_on_the_partitioning(spark):
    settings = ClassifierSettings(current_year=V.TEST_YEAR, as_of=V.AS_OF)
    cleaned = clean_bills(V.bills(spark, SF), V.due_dates(spark, SF), settings)
    one = history_table(cleaned, V.ledger(spark, SF), settings)
    two = history_table(cleaned.repartition(7, "TaxYear", "CostAmountDue1"), V.ledger(spark, SF), settings)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_gain_lift_of_ties_does_not_depend_on_the_partitioning(spark):
    df = spark.range(400).select(F.lit(0.5).alias("probability"), (F.col("id") % 3).cast("int").alias("LatePmt2"),
                                 (F.col("id") % 20).cast("string").alias("PIN"))
    runs = [sorted(map(tuple, evaluate.gain_lift(d).collect())) for d in (df, df.repartition(5, "LatePmt2"), df.orderBy(F.desc("id")))]
    assert runs[0] == runs[1] == runs[2]


def test_each_lateness_job_has_its_own_forest(monkeypatch):
    seen = []
    monkeypatch.setattr(lateness, "_run", lambda *a: seen.append(a[-1]) or (_ for _ in ()).throw(StopIteration))
    for job in (lateness.run_multiclass, lateness.run_days):
        with pytest.raises(StopIteration):
            job(None, None, LatenessSettings(target_year=2000))
    assert seen == [MULTICLASS, REGRESSOR]


def test_incomplete_scope(spark):
    bills = V.bills(spark, SF).withColumn("Elsewhere", F.when(F.col("TaxYear") % 2 == 0, "x"))
    small = lateness._prepare(bills, LatenessSettings(target_year=2000, incomplete_scope="all")).count()
    assert small < lateness._prepare(bills, LatenessSettings(target_year=2000)).count()
