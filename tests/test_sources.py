import pytest

from billrisk import session, sources
from billrisk.schema import text_schema


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_bill_lines_of_wrong_length(spark, tmp_path, rows):
    header = write(tmp_path / "h.rpt", "PIN|TaxYear|Segment")
    path = write(tmp_path / "2019.rpt", "0914|2019|PH", "0915|2019", "0916|2019|PH|more", "0917|2019|")
    schema = sources.schema_from_header(spark, header)
    assert schema.fieldNames() == ["PIN", "TaxYear", "Segment"]
    got = sources.read_bills(spark, path, schema, on_bad="drop", year_pattern=r"(\d{4})\.rpt")
    assert rows(got) == [("0914", "2019", "PH", 2019), ("0915", "2019", None, 2019), ("0917", "2019", None, 2019)]
    # Also when only one column is wanted, or none.
    assert got.select("PIN").count() == 3 and got.count() == 3
    assert sources.read_bills(spark, path, schema).count() == 4


def test_ledger_and_calendar_files(spark, tmp_path, rows):
    ledger = write(tmp_path / "TY2019.csv", "PIN,TaxType,TaxYear4,Payment,DatePaid,SourceID,TotalPaid",
                   "01,0,2019,P1,190305  ,428,10.50", "02,0,2019,P2,bad,,x")
    got = rows(sources.read_payments(spark, ledger), "PIN", "TaxYear4", "Payment", "SourceID", "TotalPaid")
    assert got == [("01", 2019, "P1", "428", 10.5), ("02", 2019, "P2", None, None)]
    dates = [str(r[0]) for r in sources.read_payments(spark, ledger).select("DatePaid").collect()]
    assert dates == ["2019-03-05", "None"]
    calendar = write(tmp_path / "dates.csv", "Year,Inst1,Inst2", "2016,2016-03-01,2016-08-01", "2022,2023-03-01,")
    assert [(r["Year"], str(r["PmtDue1"]), r["PmtDue2"]) for r in sources.read_due_dates(spark, calendar).collect()] == \
        [(2022, "2023-03-01", None)]


def test_scores_are_not_overwritten_silently(spark, tmp_path):
    scores = spark.createDataFrame([("1", 0.256, 0)], "PIN string, probability double, prediction int")
    path = str(tmp_path / "scores")
    sources.write_scores(scores, path)
    assert spark.read.csv(path, header=True).first()["probability"] == "0.26"
    with pytest.raises(Exception):
        sources.write_scores(scores, path)


def test_text_schema_and_scratch(spark):
    assert [f.dataType.simpleString() for f in text_schema(["a", "b"])] == ["string", "string"]
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
