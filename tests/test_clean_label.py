import datetime as dt

import pytest
from pyspark.sql import functions as F

from billrisk import functions as X
from billrisk.operators import clean, label, lookups, profile


def one(df):
    return df.first()[0]


def test_parse_date_gives_null_on_bad_text(spark):
    texts = ["00000000", "12312099", "02292019", "02292020", None, "3012019", "030120190", "ab012019", "03 12019"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(X.parse_date(F.col("t"), "MMddyyyy")).collect()]
    assert got == [None, dt.date(2099, 12, 31), None, dt.date(2020, 2, 29)] + [None] * 5


def test_parse_other_formats(spark):
    df = spark.createDataFrame([("210305", "2021-03-02"), ("21035", "2021-3-2")], "a string, b string")
    got = df.select(X.parse_date(F.col("a"), "yyMMdd"), X.parse_date(F.col("b"), "yyyy-MM-dd")).collect()
    assert tuple(got[0]) == (dt.date(2021, 3, 5), dt.date(2021, 3, 2)) and tuple(got[1]) == (None, None)


def test_casts_of_dirty_amounts(spark):
    df = spark.createDataFrame([("12.5",), ("abc",), ("",), (None,), ("7",)], "x string")
    assert [r[0] for r in df.select(X.as_int(F.col("x"))).collect()] == [12, None, None, None, 7]
    assert [r[0] for r in df.select(X.as_number(F.col("x"))).collect()] == [12.5, None, None, None, 7.0]


DAYS = [-3, 0, 1, 18, 19, 30, 31, 288, 289, 480, 481, 499, 500, 501, 679, None]


def test_late_class_is_right_closed(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d int")
    got = [r[0] for r in df.select(X.late_class(F.col("d"))).collect()]
    assert got == [1, 1, 1, 1, 2, 2, 2, 9, 10, 10, 10, 10, 10, 10, 10, None]


def test_late_interval_bins(spark):
    df = spark.createDataFrame([(d,) for d in DAYS], "d int")
    got = [r[0] for r in df.select(X.late_interval(F.col("d"))).collect()]
    assert got == [0, 0, 1, 1, 1, 1, 2, 10, 10, 16, 17, 17, 17, 18, 18, None]


def test_agents_and_unknown_sources_are_dropped(spark, rows):
    df = spark.createDataFrame([("a", None, "428"), ("b", "527", "428"), ("c", "428", "000"), ("d", "000", "830")],
                               "PIN string, LastPaymentSource1 string, LastPaymentSource2 string")
    assert rows(clean.exclude_sources(df), "PIN") == [("c",)]


def test_zero_bills(spark, rows):
    df = spark.createDataFrame([("both", 0.0, 0.0), ("one", 0.0, 5.0), ("none", 1.0, 5.0), ("null", None, 0.0)],
                               "PIN string, AdjustedAmountDue1 double, AdjustedTaxDue2 double")
    assert rows(clean.exclude_zero_bills(df), "PIN") == [("none",), ("one",)]
    assert rows(clean.exclude_zero_bills(df, "either"), "PIN") == [("none",)]


def bills(spark):
    data = [("unpaid", "2019", "03012019", "00000000"), ("on_day", "2019", "03012019", "08012019"),
            ("day_after", "2019", "03022019", "08022019"), ("no_calendar", "1990", "03012019", "08012019")]
    return spark.createDataFrame(data, "PIN string, TaxYear string, LastPaymentDate1 string, LastPaymentDate2 string")


def calendar(spark):
    return spark.createDataFrame([(2019, dt.date(2019, 3, 1), dt.date(2019, 8, 1))],
                                 "Year int, PmtDue1 date, PmtDue2 date")


@pytest.mark.parametrize("policy, as_of, late2, days2", [
    ("as_of", "2019-09-01", 1, 31), ("as_of", "2019-07-01", 0, -31), ("always_late", "2019-07-01", 1, -31),
    ("due_plus_1", None, 1, 1), ("null", None, 0, None), ("drop", None, None, None),
])
def test_missing_payment_policies(spark, policy, as_of, late2, days2):
    out = label.label_bills(bills(spark), calendar(spark), policy, as_of)
    got = {r["PIN"]: r for r in out.collect()}
    assert got["on_day"]["LatePmt2"] == 0 and got["day_after"]["LatePmt2"] == 1
    assert got["no_calendar"]["LatePmt2"] == 0 and got["no_calendar"]["DiffPmt2"] is None
    if policy == "drop":
        assert "unpaid" not in got
    else:
        unpaid = got["unpaid"]
        assert (unpaid["LatePmt2"], unpaid["DiffPmt2"], unpaid["BlankPmt2"]) == (late2, days2, 1)


def test_policy_must_be_named(spark):
    with pytest.raises(ValueError):
        label.missing_payment(bills(spark), "guess")
    with pytest.raises(ValueError):
        label.missing_payment(bills(spark), "as_of")


def test_unpaid_flag_comes_from_the_text(spark, rows):
    assert ("unpaid", 1) in rows(label.flag_unpaid(bills(spark)), "PIN", "TaxSale")


def test_funnel_is_monotone_and_matches_filters(spark):
    df = spark.range(100)
    got = [r["rows_left"] for r in profile.filter_funnel(df, {
        "even": F.col("id") % 2 == 0, "small": F.col("id") < 40, "none": F.lit(None).cast("boolean"),
    }).orderBy("step").collect()]
    assert got == [100, 50, 20, 0]


def test_ledger_rollup_and_membership(spark, rows):
    data = [("a", 2019, "P1", "x", 1.0), ("a", 2019, "P1", "x", 2.0), ("b", 2019, "P1", None, 1.5),
            ("c", 2019, "XX", "x", 1.0), ("d", 2019, "P1", "y", 1.0), ("d", 2019, "XX", "y", 1.0)]
    ledger = spark.createDataFrame(data, "PIN string, TaxYear4 int, Payment string, SourceID string, TotalPaid double")
    ledger = ledger.withColumn("DatePaid", F.lit("2019-03-01").cast("date"))
    got = rows(lookups.ledger_rollup(ledger), "PIN", "PaymentCnt", "SourceIDCnt", "TotalPaid")
    assert got == [("a", 0, 1, 3.0), ("b", 1, 0, 1.5), ("d", 1, 1, 1.0)]
    assert tuple(lookups.accounts_without_instalment(ledger).first()) == (2, 1)


def test_histogram_closes_the_last_bin(spark, rows):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 29, 30, 60, 61)], "x double")
    assert rows(profile.histogram_edges(df, "x", [0, 30, 60]), "bin", "n") == [(0, 2), (1, 2)]
    assert sum(r[1] for r in rows(profile.histogram_bins(df, "x", 4), "bin", "n")) == 6


def test_cleaning_runs_on_a_stream(spark, tmp_path):
    """Filters and labels are plain column expressions, so a stream can use them."""
    schema = "PIN string, SegmentCode string, TaxStatus string, LastPaymentDate1 string, LastPaymentDate2 string, " \
             "PmtDue1 date, PmtDue2 date"
    stream = spark.readStream.schema(schema).json(str(tmp_path))
    out = label.label_late(label.missing_payment(label.parse_paid_dates(
        clean.exclude_exempt(clean.keep_valid_rows(stream))), "null"))
    assert out.isStreaming and "LatePmt2" in out.columns
