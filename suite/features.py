"""Flags, encodings and running history."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from billrisk import functions as X
from billrisk.operators import clean, encode, history
from billrisk.plans import BacktestSettings, ClassifierSettings, LatenessSettings
from billrisk.plans import clean_bills, feature_table, labelled_and_target, one_hot_table
from billrisk.plans.classifier import history_table
from billrisk.schema import BINARY_COLUMNS, DUMMY_COLUMNS, LOG_COLUMNS, NO_CERTIFICATE_TEXT, ONE_HOT_VALUES, WOE_COLUMNS
from billrisk.session import written
from suite import views as V
from suite.registry import query


@query("flags", V.with_views("bills") + """
SELECT "PIN", "TaxYear",
       CASE WHEN trim("TaxpayerPropertyCity") = 'CHICAGO' THEN 1 ELSE 0 END AS city,
       CASE WHEN upper("TaxpayerMailingState") = 'IL' THEN 1 ELSE 0 END AS state,
       CASE WHEN "BillType" = '1' THEN 1 ELSE 0 END AS bill,
       CASE WHEN "PastTaxSaleStatus" = 'Y' THEN 1 ELSE 0 END AS sale,
       CASE WHEN "CofENumber" = '0000000' THEN 0 ELSE 1 END AS certificate
FROM bills""")
def flags(spark, d):
    return V.bills(spark, d).select(
        "PIN", "TaxYear",
        X.flag(F.trim("TaxpayerPropertyCity") == "CHICAGO").alias("city"),
        X.flag(F.upper("TaxpayerMailingState") == "IL").alias("state"),
        X.flag(F.col("BillType") == "1").alias("bill"),
        X.flag(F.col("PastTaxSaleStatus") == "Y").alias("sale"),
        X.flag(F.col("CofENumber") != NO_CERTIFICATE_TEXT).alias("certificate"),
    )


@query("binarize_map", V.with_views("bills") + "SELECT " + ", ".join(
    f'CASE WHEN CAST("{c}" AS INTEGER) > 0 THEN 1 ELSE CAST("{c}" AS INTEGER) END AS "{c}"' for c in BINARY_COLUMNS) + """,
       "PIN", CASE WHEN "PastTaxSaleStatus" = 'Y' THEN 1 WHEN "PastTaxSaleStatus" = 'N' THEN 0 END AS sale,
       CASE "AccountStatus" WHEN 'O' THEN 1 END AS open
FROM bills""")
def binarize_map(spark, d):
    return V.bills(spark, d).select(
        "PIN", *[X.binarize(X.as_int(F.col(c))).alias(c) for c in BINARY_COLUMNS],
        X.map_values(F.col("PastTaxSaleStatus"), {"Y": 1, "N": 0}).alias("sale"),
        X.map_values(F.col("AccountStatus"), {"O": 1}).alias("open"),
    )


@query("area_code", V.with_views("bills") + """
SELECT "PIN", substr("PIN", 1, 2) AS area, count(*) AS n FROM bills GROUP BY 1, 2""")
def area_code(spark, d):
    return V.bills(spark, d).groupBy("PIN", X.area_code(F.col("PIN")).alias("area")).agg(F.count(F.lit(1)).alias("n"))


@query("year_offset", V.with_views("bills") + """
SELECT "BillYear", greatest(CAST("BillYear" AS INTEGER) - 1997, 0) AS years, count(*) AS n FROM bills GROUP BY 1, 2""")
def year_offset(spark, d):
    rows = V.bills(spark, d).select("BillYear", X.year_offset(X.as_int(F.col("BillYear")), 1997).alias("years"))
    return rows.groupBy("BillYear", "years").agg(F.count(F.lit(1)).alias("n"))


@query("log_transform", V.with_views("labelled") + """
SELECT "PIN", "TaxYear", """ + ", ".join(
    f'round(ln("{c}" + 1), 9) AS "{c}"' for c in LOG_COLUMNS
) + """ FROM (SELECT * REPLACE (CASE WHEN "DiffPmt2" < 0 THEN 0 ELSE "DiffPmt2" END AS "DiffPmt2") FROM labelled)""")
def log_transform(spark, d):
    """All skewed amounts, and the days late on both instalments."""
    rows = encode.log_transform(V.labelled(spark, d, clip=(1, 2)), LOG_COLUMNS)
    return rows.select("PIN", "TaxYear", *[F.round(c, 9).alias(c) for c in LOG_COLUMNS])


@query("fill_zero", V.with_views("bills") + """
SELECT "PIN", coalesce("LastPaymentReceivedAmount2", 0) AS "LastPaymentReceivedAmount2" FROM bills""")
def fill_zero(spark, d):
    return clean.fill_zero(V.bills(spark, d).select("PIN", "LastPaymentReceivedAmount2"))


# ------------------------------------------------------ weight of evidence

WOE = WOE_COLUMNS


def _woe_sql(base: str, columns=WOE, strict: bool = False) -> str:
    """One table of weights per column, from the rows of ``base``."""
    tables = []
    for c in columns:
        usable = f'count(*) > sum("LatePmt2") AND sum("LatePmt2") > 0'
        ratio = ('((count(*) - sum("LatePmt2")) / CAST(count(*) AS DOUBLE))'
                 ' / (sum("LatePmt2") / CAST(count(*) AS DOUBLE))')
        tables.append(
            f'w_{c} AS (SELECT "{c}" AS v, CASE WHEN {usable} THEN round(ln({ratio}), 2) END AS w '
            f'FROM {base} {"WHERE " + chr(34) + c + chr(34) + " IS NOT NULL" if strict else ""} GROUP BY 1)'
        )
    return ", " + ", ".join(tables)


def _woe_joins(columns=WOE, strict: bool = False) -> str:
    if strict:
        return " ".join(f'JOIN w_{c} ON r."{c}" = w_{c}.v' for c in columns)
    return " ".join(f'LEFT JOIN w_{c} ON r."{c}" IS NOT DISTINCT FROM w_{c}.v' for c in columns)


def _woe_out(columns=WOE) -> str:
    return ", ".join(f'coalesce(w_{c}.w, 0) AS "WOE_{c}"' for c in columns)


@query("woe_encode", V.with_views("labelled") + _woe_sql("labelled") + f"""
SELECT r."PIN", r."TaxYear", {_woe_out()} FROM labelled r {_woe_joins()}""")
def woe_encode(spark, d):
    rows = V.labelled(spark, d).select("PIN", "TaxYear", "LatePmt2", *WOE)
    return encode.woe_encode(rows, WOE).drop("LatePmt2")


@query("woe_strict", V.with_views("labelled") + _woe_sql("labelled", strict=True) + f"""
SELECT r."PIN", r."TaxYear", {_woe_out()} FROM labelled r {_woe_joins(strict=True)}""")
def woe_strict(spark, d):
    rows = V.labelled(spark, d).select("PIN", "TaxYear", "LatePmt2", *WOE)
    return encode.woe_encode(rows, WOE, strict=True).drop("LatePmt2")


@query("woe_fit_apply", V.with_views("labelled") + f"""
, train AS (SELECT * FROM labelled WHERE "TaxYear" < {V.TEST_YEAR})""" + _woe_sql("train") + f"""
SELECT r."PIN", r."TaxYear", {_woe_out()} FROM labelled r {_woe_joins()} WHERE r."TaxYear" >= {V.TEST_YEAR}""")
def woe_fit_apply(spark, d):
    rows = V.labelled(spark, d).select("PIN", "TaxYear", "LatePmt2", *WOE)
    table = encode.fit_woe(rows.where(F.col("TaxYear") < V.TEST_YEAR), WOE)
    later = rows.where(F.col("TaxYear") >= V.TEST_YEAR)
    return encode.apply_woe(later, table, WOE).select("PIN", "TaxYear", *[f"WOE_{c}" for c in WOE])


@query("woe_large_table", V.with_views("labelled") + _woe_sql("labelled", [*WOE, "TaxCode"]) + f"""
SELECT r."PIN", r."TaxYear", {_woe_out([*WOE, "TaxCode"])} FROM labelled r {_woe_joins([*WOE, "TaxCode"])}""")
def woe_large_table(spark, d):
    """More categories than may be sent to the rows: the frequent ones are, the others meet them in one shuffle."""
    columns = [*WOE, "TaxCode"]
    rows = V.labelled(spark, d).select("PIN", "TaxYear", "LatePmt2", *columns)
    encoded = encode.apply_woe(rows, encode.fit_woe(rows, columns), columns, max_rows=20)
    return encoded.select("PIN", "TaxYear", *[f"WOE_{c}" for c in columns])


# ----------------------------------------------------------------- one-hot

# Codes that the one-hot model makes of a column before its levels are compared.
CODED_SQL = {
    "TaxpayerMailingState": """CASE WHEN upper("TaxpayerMailingState") = 'IL' THEN '1' ELSE '0' END""",
    "CofENumber": """CASE WHEN "CofENumber" = '0000000' THEN '0' ELSE '1' END""",
    "PastTaxSaleStatus": """CASE WHEN "PastTaxSaleStatus" = 'Y' THEN '1' ELSE '0' END""",
    "AreaFromPin": 'substr("PIN", 1, 2)',
    "LatePmt1": 'CAST("LatePmt1" AS VARCHAR)',
}


def _hot_sql() -> str:
    cells = []
    for c, levels in ONE_HOT_VALUES.items():
        source = CODED_SQL.get(c, f'"{c}"')
        suffixes = levels if isinstance(levels, dict) else {v: v for v in levels}
        cells += [f"""CASE WHEN {source} = '{v}' THEN 1 ELSE 0 END AS "{c}_{suffix}\"""" for v, suffix in suffixes.items()]
    return ", ".join(cells)


@query("one_hot", V.with_views("labelled") + f'SELECT "PIN", "TaxYear", {_hot_sql()} FROM labelled')
def one_hot(spark, d):
    """All categories of the one-hot model."""
    coded = V.labelled(spark, d).withColumns({
        "TaxpayerMailingState": X.flag(F.upper("TaxpayerMailingState") == "IL"),
        "CofENumber": X.flag(F.col("CofENumber") != NO_CERTIFICATE_TEXT),
        "PastTaxSaleStatus": X.flag(F.col("PastTaxSaleStatus") == "Y"),
        "AreaFromPin": X.area_code(F.col("PIN")),
    })
    return encode.one_hot(coded.select("PIN", "TaxYear", *ONE_HOT_VALUES), ONE_HOT_VALUES)


DISCOVER = {"BillType": ["1", "3"], "HomeownerExempt": ["0", "1", "2"], "TaxStatus": ["00", "01", "03"], "TaxType": ["0"],
            "AccountStatus": ["O", "P"]}


@query("one_hot_discover", V.with_views("bills") + 'SELECT "PIN", "TaxYear", ' + ", ".join(
    f"""CASE WHEN "{c}" = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}\"""" for c, vs in DISCOVER.items() for v in vs
) + " FROM bills")
def one_hot_discover(spark, d):
    """Columns with few categories: one new column each."""
    rows = V.bills(spark, d).select("PIN", "TaxYear", *DISCOVER)
    return encode.one_hot(rows, encode.discover_values(rows, list(DISCOVER)))


# The categories in text order, null after them.
@query("one_hot_vector", V.with_views("bills") + """
, coded AS (SELECT *, substr("PIN", 1, 2) AS "Location" FROM bills)
""" + "".join(f""", v_{c} AS (SELECT v, row_number() OVER (ORDER BY v NULLS LAST) - 1 AS i FROM (SELECT DISTINCT "{c}" AS v FROM coded))
""" for c in DUMMY_COLUMNS) + 'SELECT "PIN", "TaxYear", ' + ", ".join(
    f'CAST(v_{c}.i AS INTEGER) AS "{c}"' for c in DUMMY_COLUMNS) + " FROM coded " + " ".join(
    f'JOIN v_{c} ON coded."{c}" IS NOT DISTINCT FROM v_{c}.v' for c in DUMMY_COLUMNS))
def one_hot_vector(spark, d):
    """The place of the 1 in the vector of each category."""
    rows = V.bills(spark, d).withColumn("Location", X.area_code(F.col("PIN"))).select("PIN", "TaxYear", *DUMMY_COLUMNS)
    made = encode.one_hot_vector(rows, DUMMY_COLUMNS)
    return made.select("PIN", "TaxYear", *[
        (F.array_position(vector_to_array(f"{c}_encoded"), 1.0) - 1).cast("int").alias(c) for c in DUMMY_COLUMNS])


# ----------------------------------------------------------------- history

_BY = 'OVER (PARTITION BY "PIN" ORDER BY "TaxYear" '
HISTORY_SQL = V.with_views("acct_year") + f"""
SELECT "PIN", "TaxYear",
  CAST(sum("PastTaxSaleStatus") {_BY} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "PastTaxSaleStatusSum",
  CAST(coalesce(sum("LatePmt2") {_BY} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "LatePmt2Sum",
  CAST(sum("LatePmt1") {_BY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "LatePmt1Sum"
FROM acct_year"""
HISTORY = ["PIN", "TaxYear", "PastTaxSaleStatusSum", "LatePmt2Sum", "LatePmt1Sum"]


@query("history_sums", HISTORY_SQL)
def history_sums(spark, d):
    return history.history_sums(V.acct_year(spark, d)).select(*HISTORY)


@query("history_hot_accounts", HISTORY_SQL)
def history_hot_accounts(spark, d):
    """The same sums with every account of more than four years treated as too large for one task."""
    years = written(V.acct_year(spark, d), "account-years")  # read for the search for large accounts and for their rows
    return history.history_sums(years, max_rows_per_key=4).select(*HISTORY)


def _one_history(name):
    def run(spark, d):
        feature = {name: history.STANDARD_HISTORY[name]}
        return history.history_sums(V.acct_year(spark, d), feature).select("PIN", "TaxYear", name)
    return run


for _key, _column in (("history_range", "PastTaxSaleStatusSum"), ("history_prior", "LatePmt2Sum"),
                      ("history_rows", "LatePmt1Sum")):
    query(_key, f'SELECT "PIN", "TaxYear", "{_column}" FROM ({HISTORY_SQL})')(_one_history(_column))


@query("history_range_ties", V.with_views("labelled") + f"""
SELECT "PIN", "TaxYear", "LastPaymentDate2",
  CAST(sum("LatePmt2") {_BY} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS late2
FROM labelled""")
def history_range_ties(spark, d):
    """Bills of one account and year are peers."""
    rows = V.labelled(spark, d).select("PIN", "TaxYear", "LastPaymentDate2", "LatePmt2")
    return history.history_sums(rows, {"late2": history.HistorySum("LatePmt2", "range")}).drop("LatePmt2")


# ----------------------------------------------------- whole feature tables

_CLEAN = """"SegmentCode" = 'PH' AND CAST("TaxStatus" AS INTEGER) <> 1
  AND ("AdjustedAmountDue1" <> 0 OR "AdjustedTaxDue2" <> 0)
  AND "LastPaymentSource1" NOT IN ('527', '600', '800', '802', '830')
  AND "LastPaymentSource2" NOT IN ('527', '600', '800', '802', '830')"""
CLASSIFIER = ClassifierSettings(current_year=V.TEST_YEAR, as_of=V.AS_OF, policy="as_of")


@query("cleaned_bills", V.with_views("labelled") + f"""
SELECT "PIN", "TaxYear", "TaxStatus", "AdjustedAmountDue1", "LatePmt1", "LatePmt2", "DiffPmt1"
FROM labelled WHERE {_CLEAN} AND "DiffPmt2" < 500 AND "DiffPmt1" < 680""")
def cleaned_bills(spark, d):
    return clean_bills(V.bills(spark, d), V.due_dates(spark, d), CLASSIFIER).select(
        "PIN", "TaxYear", "TaxStatus", "AdjustedAmountDue1", "LatePmt1", "LatePmt2", "DiffPmt1"
    )


# Columns that order the bills of one account and year for the row-wise sums.
TIES = ", ".join(f'"{c}" NULLS FIRST' for c in [
    "AccountStatus", "AdjustedAmountDue1", "BillType", "BlankPmt1", "BlankPmt2", "Classification", "CostAmountDue1",
    "DiffPmt1", "DiffPmt2", "ExemptStatus", "HomeownerExempt", "HomeownerExemptAmount", "LastPaymentDate1",
    "LastPaymentDate2", "LastPaymentSource1", "LatePmt1", "LatePmt2", "LongtimeHomeownersExemptAmount",
    "PastTaxSaleStatus", "PmtDue1", "PmtDue2", "SeniorExempt", "SeniorFreezeExemptAmount", "TaxAmountDue1", "TaxCode",
    "TaxRate", "TaxStatus", "TaxpayerPropertyCity", "TaxpayerPropertySuffix", "TaxpayerPropertyTown"])
_PRIOR = f'OVER (PARTITION BY "PIN" ORDER BY "TaxYear", {TIES} ROWS BETWEEN UNBOUNDED PRECEDING AND '


@query("classifier_features", V.with_views("labelled", "ledger") + f"""
, kept AS (SELECT * REPLACE (CASE WHEN "BillType" = '1' THEN 1 ELSE 0 END AS "BillType",
                             CASE WHEN "PastTaxSaleStatus" = 'Y' THEN 1 ELSE 0 END AS "PastTaxSaleStatus",
                             CASE WHEN trim("TaxpayerPropertyCity") = 'CHICAGO' THEN 1 ELSE 0 END AS "TaxpayerPropertyCity")
           FROM labelled WHERE {_CLEAN} AND "DiffPmt2" < 500 AND "DiffPmt1" < 680),
told AS (SELECT *, CAST(sum("PastTaxSaleStatus") OVER (PARTITION BY "PIN" ORDER BY "TaxYear"
                         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS "PastTaxSaleStatusSum",
                CAST(coalesce(sum("LatePmt2") {_PRIOR} 1 PRECEDING), 0) AS BIGINT) AS "LatePmt2Sum",
                CAST(sum("LatePmt1") {_PRIOR} CURRENT ROW) AS BIGINT) AS "LatePmt1Sum" FROM kept),
paid AS (SELECT "PIN", "TaxYear4", CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS pc,
                CASE WHEN count(DISTINCT "SourceID") = 1 THEN 1 ELSE 0 END AS sc
         FROM ledger WHERE "Payment" = 'P1' GROUP BY 1, 2),
train AS (SELECT * FROM kept WHERE "TaxYear" <> {V.TEST_YEAR})""" + _woe_sql("train", WOE) + f"""
SELECT r."PIN", r."TaxYear", r."BillType", r."PastTaxSaleStatus", "AdjustedAmountDue1", "TaxAmountDue1", "CostAmountDue1", "TaxRate",
  "HomeownerExemptAmount", "SeniorFreezeExemptAmount",
  coalesce("LongtimeHomeownersExemptAmount", 0) AS "LongtimeHomeownersExemptAmount",
  CAST("HomeownerExempt" AS INTEGER) AS "HomeownerExempt", CAST("SeniorExempt" AS INTEGER) AS "SeniorExempt",
  CAST("ExemptStatus" AS INTEGER) AS "ExemptStatus", CAST("TaxCode" AS INTEGER) AS "TaxCode", r."TaxpayerPropertyCity",
  "LatePmt1", "LatePmt2", "DiffPmt1", "PastTaxSaleStatusSum", "LatePmt2Sum", "LatePmt1Sum",
  coalesce(pc, 0) AS "PaymentCnt", coalesce(sc, 0) AS "SourceIDCnt", {_woe_out(WOE)}
FROM told r LEFT JOIN paid ON r."PIN" = paid."PIN" AND r."TaxYear" = paid."TaxYear4"
{_woe_joins(WOE)}""")
def classifier_features(spark, d):
    """Every column that the forest is trained on, with key, year and label."""
    cleaned = clean_bills(V.bills(spark, d), V.due_dates(spark, d), CLASSIFIER)
    return feature_table(history_table(cleaned, V.ledger(spark, d), CLASSIFIER), CLASSIFIER)


BACKTEST = BacktestSettings(test_year=V.TEST_YEAR, as_of=V.AS_OF)


@query("backtest_features", V.with_views("labelled") + f"""
SELECT "PIN", "TaxYear", least("AdjustedAmountDue1", 3186751) AS "AdjustedAmountDue1", "TaxAmountDue1", "CostAmountDue1", "TaxRate",
  "HomeownerExemptAmount", "SeniorFreezeExemptAmount", "LongtimeHomeownersExemptAmount", "LatePmt2", "DiffPmt1", {_hot_sql()}
FROM labelled WHERE {_CLEAN} AND "DiffPmt1" < 680 AND greatest("DiffPmt2", 0) < 500 AND "DiffPmt2" IS NOT NULL""")
def backtest_features(spark, d):
    """Every column of the one-hot table."""
    return one_hot_table(V.bills(spark, d), V.due_dates(spark, d), BACKTEST)


LATENESS = LatenessSettings(target_year=V.TEST_YEAR, base_year=1996)


@query("lateness_rows", V.with_views("dated") + """
, days AS (SELECT *, CAST("LastPaymentDate1" - "PmtDue1" AS INTEGER) AS d1,
                  CAST("LastPaymentDate2" - "PmtDue2" AS INTEGER) AS d2 FROM dated
           WHERE CAST("TaxStatus" AS INTEGER) <> 1
             AND ("AdjustedAmountDue1" <> 0 OR "AdjustedTaxDue2" <> 0)
             AND "LastPaymentSource1" NOT IN ('527', '600', '800', '802', '830')
             AND "LastPaymentSource2" NOT IN ('527', '600', '800', '802', '830')
             AND "LastPaymentReceivedAmount2" IS NOT NULL AND "LongtimeHomeownersExemptAmount" IS NOT NULL)""" + f"""
SELECT 'known' AS part, "TaxYear", greatest(CAST("BillYear" AS INTEGER) - 1996, 0) AS "BillYear", count(*) AS n,
       CAST(sum(d2) AS BIGINT) AS days
FROM days WHERE "TaxYear" < {V.TEST_YEAR} AND d2 > 0 AND d2 < 500 AND d1 > 0 AND d1 < 680 GROUP BY 1, 2, 3
UNION ALL
SELECT 'target', "TaxYear", greatest(CAST("BillYear" AS INTEGER) - 1996, 0), count(*), CAST(sum(d1) AS BIGINT)
FROM days WHERE "TaxYear" = {V.TEST_YEAR} AND d1 > 0 AND d1 < 680 GROUP BY 1, 2, 3""")
def lateness_rows(spark, d):
    known, target = labelled_and_target(V.bills(spark, d), V.due_dates(spark, d), LATENESS)
    rows = known.select(F.lit("known").alias("part"), "TaxYear", "BillYear", F.col("DiffPmt2").alias("d")).unionByName(
        target.select(F.lit("target").alias("part"), "TaxYear", "BillYear", F.col("DiffPmt1").alias("d")))
    return rows.groupBy("part", "TaxYear", "BillYear").agg(
        F.count(F.lit(1)).alias("n"), F.sum("d").alias("days")
    )
