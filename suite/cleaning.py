"""Scans, projections, filters, joins and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from billrisk import functions as X
from billrisk.operators import clean, label, lookups, profile
from billrisk.schema import text_schema
from billrisk.session import scratch_path
from billrisk.sources import (
    load_years, read_bills, read_bills_parquet, read_due_dates, read_payments, read_source_lookup, read_years,
    scan_bills, schema_from_header, union_years, write_bills_parquet,
)
from suite import views as V
from suite.registry import query

BILL_KEYS = '"PIN", "TaxYear", "AdjustedAmountDue1", "AdjustedTaxDue2"'

# ------------------------------------------------------------------- scans

SCAN_COLUMNS = [
    "PIN", "TaxYear", "SegmentCode", "TaxStatus", "LastPaymentDate1", "LastPaymentDate2",
    "LastPaymentSource1", "LastPaymentSource2", "AdjustedAmountDue1", "AccountStatus",
]


def _write_bill_files(bills, base: str) -> None:
    """Headerless pipe files in one folder per year, and the header file."""
    spark = bills.sparkSession
    rows = bills.select(*[F.col(c).cast("string").alias(c) for c in SCAN_COLUMNS], F.col("TaxYear").alias("File"))
    rows.write.option("sep", "|").option("header", False).partitionBy("File").csv(f"{base}/bills")
    spark.createDataFrame([("|".join(SCAN_COLUMNS),)], "line string").write.text(f"{base}/header")


@query("scan_pipe_csv", V.with_views("bills") + f"""
SELECT {", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in SCAN_COLUMNS)},
       "TaxYear" AS "SourceYear"
FROM bills""")
def scan_pipe_csv(spark, d):
    base = scratch_path(spark, "pipe")
    bills = V.bills(spark, d)
    _write_bill_files(bills, base)
    # Lines with surplus fields, as many as there are bad segments.
    bad = bills.where(F.col("SegmentCode") == "XX").select(
        F.concat_ws("|", *SCAN_COLUMNS, F.lit("surplus"), F.lit("fields"), F.lit("here"), F.lit("too")),
        F.col("TaxYear").alias("File"),
    )
    bad.write.mode("append").partitionBy("File").text(f"{base}/bills")
    schema = schema_from_header(spark, f"{base}/header")
    return read_bills(spark, f"{base}/bills/File=*", schema, on_bad="drop", year_pattern=r"File=(\d{4})")


@query("scan_short_lines", V.with_views("bills") + """
SELECT "PIN", CAST("TaxYear" AS VARCHAR) AS "TaxYear", "SegmentCode",
       CAST(NULL AS VARCHAR) AS "TaxStatus"
FROM bills WHERE "SegmentCode" = 'XX'
UNION ALL
SELECT "PIN", CAST("TaxYear" AS VARCHAR), "SegmentCode", "TaxStatus" FROM bills""")
def scan_short_lines(spark, d):
    """Lines with too few fields are padded with nulls, and kept."""
    base = scratch_path(spark, "short")
    bills = V.bills(spark, d)
    bills.select(F.concat_ws("|", "PIN", "TaxYear", "SegmentCode", "TaxStatus")).write.text(base)
    short = bills.where(F.col("SegmentCode") == "XX").select(F.concat_ws("|", "PIN", "TaxYear", "SegmentCode"))
    short.write.mode("append").text(base)
    return read_bills(spark, base, text_schema(["PIN", "TaxYear", "SegmentCode", "TaxStatus"]), on_bad="drop")


def _write_ledger(ledger, base: str, sep: str) -> None:
    """Header line, two-digit years, blanks around dates, columns nobody needs."""
    ledger.select(
        "PIN", "TaxYear4", F.lit("0").alias("TaxType"), "Payment",
        F.concat(F.date_format("DatePaid", "yyMMdd"), F.lit("  ")).alias("DatePaid"), "SourceID",
        "TotalPaid", F.lit("none").alias("RefundNumber"),
    ).write.option("sep", sep).option("header", True).option("ignoreTrailingWhiteSpace", False).csv(base)


LEDGER_SQL = V.with_views("ledger", "due_dates") + """
SELECT "PIN", "TaxYear4", "Payment", "DatePaid", "SourceID", "TotalPaid",
       "DatePaid" - "PmtDue1" AS days_after_due
FROM (SELECT * REPLACE (CASE WHEN year("DatePaid") < 2000
                             THEN CAST("DatePaid" + INTERVAL 100 YEAR AS DATE)
                             ELSE "DatePaid" END AS "DatePaid") FROM ledger)
LEFT JOIN due_dates ON "TaxYear4" = "Year\""""


def _ledger_scan(spark, d, sep):
    base = scratch_path(spark, "ledger")
    _write_ledger(V.ledger(spark, d), f"{base}/ledger", sep)
    V.due_dates(spark, d).select(
        "Year", F.col("PmtDue1").alias("Inst1"), F.col("PmtDue2").alias("Inst2")
    ).write.option("header", True).csv(f"{base}/calendar")
    paid = read_payments(spark, f"{base}/ledger", sep=sep)
    due = read_due_dates(spark, f"{base}/calendar", min_year=1990)
    return paid.join(due, F.col("TaxYear4") == F.col("Year"), "left").select(
        *paid.columns, F.datediff("DatePaid", "PmtDue1").cast("bigint").alias("days_after_due")
    )


@query("scan_header_csv", LEDGER_SQL)
def scan_header_csv(spark, d):
    return _ledger_scan(spark, d, ",")


@query("scan_ledger_pipe", LEDGER_SQL)
def scan_ledger_pipe(spark, d):
    return _ledger_scan(spark, d, "|")


@query("scan_rejects", V.with_views("bills") + """
SELECT "TaxYear" AS "SourceYear", 'good' AS reason, count(*) AS n FROM bills GROUP BY 1
UNION ALL
SELECT "TaxYear", '3 surplus fields', count(*) FROM bills WHERE "SegmentCode" = 'XX' GROUP BY 1""")
def scan_rejects(spark, d):
    """Good lines and rejected ones, per file, add up to the lines read."""
    base = scratch_path(spark, "rejects")
    bills = V.bills(spark, d)
    _write_bill_files(bills, base)
    bad = bills.where(F.col("SegmentCode") == "XX").select(
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SCAN_COLUMNS], F.lit("a"), F.lit("b"), F.lit("c")),
        F.col("TaxYear").alias("File"),
    )
    bad.write.mode("append").partitionBy("File").text(f"{base}/bills")
    scan = scan_bills(spark, f"{base}/bills/File=*", schema_from_header(spark, f"{base}/header"))
    year = F.regexp_extract("file", r"File=(\d{4})", 1).cast("int")
    return scan.counts().groupBy(year.alias("SourceYear"), "reason").agg(F.sum("n").alias("n"))


@query("scan_ledger_mixed_headers", LEDGER_SQL)
def scan_ledger_mixed_headers(spark, d):
    """Files with quoted names, another order of columns, and nothing at all."""
    base = scratch_path(spark, "mixed")
    text = V.ledger(spark, d).select(
        "PIN", F.col("TaxYear4").cast("string").alias("TaxYear4"), F.lit("0").alias("TaxType"), "Payment",
        F.concat(F.date_format("DatePaid", "yyMMdd"), F.lit("  ")).alias("DatePaid"), "SourceID", "TotalPaid")
    odd = F.col("TaxYear4") % 2 == 1
    plain = {"header": True, "ignoreTrailingWhiteSpace": False}
    text.where(odd).write.options(**plain, quoteAll=True).csv(f"{base}/ledger")
    text.where(~odd).select(*reversed(text.columns)).write.mode("append").options(**plain).csv(f"{base}/ledger")
    spark.createDataFrame([], "line string").write.mode("append").text(f"{base}/ledger")
    V.due_dates(spark, d).select(
        F.col("PmtDue2").alias("Inst2"), "Year", F.col("PmtDue1").alias("Inst1")
    ).write.options(header=True, quoteAll=True).csv(f"{base}/calendar")
    paid = read_payments(spark, f"{base}/ledger")
    due = read_due_dates(spark, f"{base}/calendar", min_year=1990)
    return paid.join(due, F.col("TaxYear4") == F.col("Year"), "left").select(
        *paid.columns, F.datediff("DatePaid", "PmtDue1").cast("bigint").alias("days_after_due"))


@query("load_years", V.with_views("bills") + f"""
SELECT "TaxYear", count(*) AS n, sum(CASE WHEN "SegmentCode" = 'XX' THEN 1 ELSE 0 END)::BIGINT AS bad,
       CASE WHEN "TaxYear" = {V.TEST_YEAR} THEN 2 ELSE 1 END AS loads
FROM bills WHERE "TaxYear" <> {V.TEST_YEAR} OR "SegmentCode" <> 'XX' GROUP BY 1""")
def load_years_query(spark, d):
    """Loaded, loaded again, and once more after one year's files were corrected."""
    base = scratch_path(spark, "loads")
    bills = V.bills(spark, d).select("PIN", "TaxYear", "SegmentCode")
    layout = text_schema(["PIN", "TaxYear", "SegmentCode"])

    def read(paths):
        return read_bills(spark, paths, layout).withColumn("TaxYear", F.col("TaxYear").cast("int"))

    def file(name, rows):
        rows.write.option("sep", "|").csv(f"{base}/raw/{name}")

    years = F.col("TaxYear") == V.TEST_YEAR
    file("others", bills.where(~years))
    file("first", bills.where(years))
    target, raw = f"{base}/bills", [f"{base}/raw/others", f"{base}/raw/first"]
    loads = [load_years(spark, raw, target, read), load_years(spark, raw, target, read)]
    # the corrected year: the same files with other contents
    bills.where(years & (F.col("SegmentCode") != "XX")).write.mode("overwrite").option("sep", "|").csv(f"{base}/raw/first")
    loads.append(load_years(spark, raw, target, read))
    told = [load.where("rows > 0").select(F.col("year").alias("y"), F.lit(i).alias("load")) for i, load in enumerate(loads)]
    loaded = told[0].unionByName(told[1]).unionByName(told[2]).groupBy("y").agg(
        F.count_distinct("load").cast("int").alias("loads"))
    rows = read_years(spark, target)
    return rows.groupBy("TaxYear").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("SegmentCode") == "XX").alias("bad"),
    ).join(loaded, F.col("TaxYear") == F.col("y")).drop("y")


@query("bills_parquet_years", V.with_views("bills") + """
SELECT "TaxYear", count(*) AS n, round(sum("AdjustedAmountDue1"), 2) AS due
FROM bills WHERE "TaxYear" IN (1997, 1999) GROUP BY "TaxYear\"""")
def bills_parquet_years(spark, d):
    base = scratch_path(spark, "bills")
    write_bills_parquet(V.bills(spark, d).select("PIN", "TaxYear", "AdjustedAmountDue1"), base)
    rows = read_bills_parquet(spark, base, years=[1997, 1999])
    return rows.groupBy("TaxYear").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("AdjustedAmountDue1"), 2).alias("due")
    )


@query("union_years", V.with_views("bills") + """
SELECT "PIN", "TaxYear", "AdjustedAmountDue1" FROM bills
UNION ALL
SELECT "PIN", "TaxYear", "AdjustedAmountDue1" FROM bills WHERE "TaxYear" = (SELECT min("TaxYear") FROM bills)""")
def union_years_query(spark, d):
    rows = V.bills(spark, d).select("PIN", "TaxYear", "AdjustedAmountDue1")
    known = sorted(r["TaxYear"] for r in rows.select("TaxYear").distinct().collect())
    years = [rows.where(F.col("TaxYear") == y) for y in known]
    return union_years([union_years(years), years[0].toDF("a", "b", "c")], by_name=False)


# ------------------------------------------------------------- projections


@query("project_cast", V.with_views("bills") + """
SELECT "PIN", "TaxYear", CAST("BillType" AS INTEGER) AS "BillType",
       CAST("HomeownerExempt" AS INTEGER) AS "HomeownerExempt",
       "AdjustedAmountDue1", "TaxRate",
       CAST(try_strptime("LastPaymentDate2", '%m%d%Y') AS DATE) AS paid2,
       CAST(try_strptime(lpad(ltrim("LastPaymentDate1", '0'), 8, '0'), '%m%d%Y') AS DATE) AS paid1,
       TRY_CAST("AccountStatus" AS INTEGER) AS "AccountStatus"
FROM bills""")
def project_cast(spark, d):
    """Everything arrives as text, dates partly damaged by a float."""
    text = V.bills(spark, d)
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns])
    kept = clean.select_columns(text, [
        "PIN", "TaxYear", "BillType", "HomeownerExempt", "AdjustedAmountDue1", "TaxRate", "TaxType",
        "LastPaymentDate1", "LastPaymentDate2", "SegmentCode", "AccountStatus",
    ])
    typed = clean.cast_numeric(clean.drop_groups(kept, ["unrelated", "near_constant"]))
    damaged = F.concat(F.ltrim("LastPaymentDate1", F.lit("0")), F.lit(".0"))
    dated = typed.withColumns({
        "paid2": X.parse_date(F.col("LastPaymentDate2"), "MMddyyyy"),
        "paid1": X.parse_date(X.normalize_date_text(damaged), "MMddyyyy"),
    }).drop("LastPaymentDate1", "LastPaymentDate2")
    return clean.cast_strings_to_int(clean.cast_map(dated, {"TaxYear": "int"}), keep=("PIN",))


@query("column_types", V.with_views("bills") + """
SELECT "PIN", sum("CostAmountDue1") AS "CostAmountDue1", sum("CostAmountDue2") AS "CostAmountDue2",
       CAST(sum("TaxYear") AS BIGINT) AS "TaxYear"
FROM bills GROUP BY "PIN\"""")
def column_types(spark, d):
    """Sums of all numeric columns, the columns found by type."""
    rows = V.bills(spark, d).select("PIN", "TaxYear", "BillType", "CostAmountDue1", "CostAmountDue2")
    return rows.groupBy("PIN").agg(*[F.sum(c).alias(c) for c in clean.numeric_columns(rows)])


# ----------------------------------------------------------------- filters


@query("clean_valid_rows", V.with_views("bills") + """
SELECT "PIN", "TaxYear", "LastPaymentSource1", "LastPaymentSource2", "BankruptStatus" FROM bills
WHERE "SegmentCode" = 'PH' AND CAST("TaxStatus" AS INTEGER) <> 1
  AND "LastPaymentSource1" NOT IN ('527', '600', '800', '802', '830')
  AND "LastPaymentSource2" NOT IN ('527', '600', '800', '802', '830')
  AND CAST("BankruptStatus" AS INTEGER) < 3
  AND "AccountStatus" IS NOT NULL""")
def clean_valid_rows(spark, d):
    rows = clean.exclude_sources(clean.exclude_exempt(clean.keep_valid_rows(V.bills(spark, d))))
    rows = rows.where(X.as_int(F.col("BankruptStatus")) < 3)
    return clean.drop_incomplete(rows, ["AccountStatus"]).select(
        "PIN", "TaxYear", "LastPaymentSource1", "LastPaymentSource2", "BankruptStatus"
    )


@query("drop_incomplete", V.with_views("bills") + """
SELECT "PIN", "TaxYear", "LastPaymentSource1", "LastPaymentSource2", "LastPaymentReceivedAmount2" FROM bills
WHERE "LastPaymentSource1" IS NOT NULL AND "LastPaymentSource2" IS NOT NULL
  AND "LastPaymentReceivedAmount2" IS NOT NULL""")
def drop_incomplete(spark, d):
    return clean.drop_incomplete(V.bills(spark, d).select(
        "PIN", "TaxYear", "LastPaymentSource1", "LastPaymentSource2", "LastPaymentReceivedAmount2"
    ))


def _zero_bills(mode):
    def run(spark, d):
        return clean.exclude_zero_bills(V.bills(spark, d), mode).select(
            "PIN", "TaxYear", "AdjustedAmountDue1", "AdjustedTaxDue2"
        )
    return run


query("zero_bill_both", V.with_views("bills") + f"""
SELECT {BILL_KEYS} FROM bills
WHERE NOT ("AdjustedAmountDue1" = 0 AND "AdjustedTaxDue2" = 0)""")(_zero_bills("both"))
query("zero_bill_either", V.with_views("bills") + f"""
SELECT {BILL_KEYS} FROM bills
WHERE "AdjustedAmountDue1" <> 0 AND "AdjustedTaxDue2" <> 0""")(_zero_bills("either"))

DAYS = '"PIN", "TaxYear", "DiffPmt1", "DiffPmt2"'


@query("bounds_upper", V.with_views("labelled") + f"""
SELECT {DAYS} FROM labelled WHERE NOT ("DiffPmt2" >= 500) AND NOT ("DiffPmt1" >= 680)""")
def bounds_upper(spark, d):
    return clean.bound_days_late(V.labelled(spark, d)).select("PIN", "TaxYear", "DiffPmt1", "DiffPmt2")


@query("bounds_two_sided", V.with_views("labelled") + f"""
SELECT {DAYS} FROM labelled
WHERE "DiffPmt2" > 0 AND "DiffPmt2" < 500 AND "DiffPmt1" > 0 AND "DiffPmt1" < 680""")
def bounds_two_sided(spark, d):
    return clean.bound_days_late(V.labelled(spark, d), lower=1).select("PIN", "TaxYear", "DiffPmt1", "DiffPmt2")


_F1 = "\"SegmentCode\" = 'PH'"
_F2 = _F1 + ' AND CAST("TaxStatus" AS INTEGER) <> 1'
_F3 = _F2 + ' AND ("AdjustedAmountDue1" <> 0 OR "AdjustedTaxDue2" <> 0)'
_F4 = _F3 + " AND \"LastPaymentSource2\" NOT IN ('527','600','800','802','830')"
_F5 = _F4 + " AND \"LastPaymentSource1\" NOT IN ('527','600','800','802','830')"
_F6 = _F5 + ' AND "DiffPmt2" < 500'
_F7 = _F6 + ' AND "DiffPmt1" < 680'
FUNNEL = [("all", "true"), ("valid", _F1), ("not_exempt", _F2), ("billed", _F3), ("source2", _F4),
          ("source1", _F5), ("days2", _F6), ("days1", _F7)]


@query("filter_funnel", V.with_views("labelled") + " UNION ALL ".join(
    f"SELECT {i} AS step, '{name}' AS filter, count(*) AS rows_left FROM labelled WHERE {condition}"
    for i, (name, condition) in enumerate(FUNNEL)
))
def filter_funnel(spark, d):
    return profile.filter_funnel(V.labelled(spark, d), {
        "valid": clean.valid_row(),
        "not_exempt": clean.not_exempt(),
        "billed": clean.billed(),
        "source2": clean.not_agent(["LastPaymentSource2"]),
        "source1": clean.not_agent(["LastPaymentSource1"]),
        "days2": F.col("DiffPmt2") < 500,
        "days1": F.col("DiffPmt1") < 680,
    })


@query("stage_sizes", V.with_views("labelled") + f"""
SELECT 1 AS step, 'bills' AS stage, count(*) AS "rows", {len(V.BILL_NAMES)} AS "columns" FROM bills
UNION ALL SELECT 2, 'cleaned', count(*), {len(V.BILL_NAMES)} FROM bills WHERE {_F5}
UNION ALL SELECT 3, 'labelled', count(*), {len(V.BILL_NAMES) + 8} FROM labelled WHERE {_F7}""")
def stage_sizes(spark, d):
    """Stages that are subsets of the labelled bills, from one pass."""
    bills = V.bills(spark, d)
    cleaned = clean.valid_row() & clean.not_exempt() & clean.billed() & clean.not_agent(["LastPaymentSource1", "LastPaymentSource2"])
    bounded = cleaned & (F.col("DiffPmt2") < clean.MAX_DAYS_LATE_2) & (F.col("DiffPmt1") < clean.MAX_DAYS_LATE_1)
    width = {"bills": len(bills.columns), "cleaned": len(bills.columns)}
    return profile.stage_counts(V.labelled(spark, d), {"bills": F.lit(True), "cleaned": cleaned, "labelled": bounded}, width)


@query("stage_sizes_of_frames", V.with_views("bills", "ledger") + """
SELECT 1 AS step, 'bills' AS stage, count(*) AS "rows", 3 AS "columns" FROM bills
UNION ALL SELECT 2, 'ledger', count(*), 6 FROM ledger""")
def stage_sizes_of_frames(spark, d):
    """Stages without a common ancestor."""
    bills = V.bills(spark, d).select("PIN", "TaxYear", "TaxStatus")
    return profile.stage_sizes({"bills": bills, "ledger": V.ledger(spark, d)})


PIN_7 = "00055433"


@query("account_history", V.with_views("bills") + f"""
SELECT "PIN", "TaxYear", "LastPaymentDate1", "LastPaymentDate2", "AdjustedAmountDue1", "PastTaxSaleStatus"
FROM bills WHERE "PIN" = '{PIN_7}'""")
def account_history(spark, d):
    return clean.account_history(V.bills(spark, d), PIN_7, [
        "PIN", "TaxYear", "LastPaymentDate1", "LastPaymentDate2", "AdjustedAmountDue1", "PastTaxSaleStatus",
    ])


CHECKS_SQL = {
    "charged_nothing_due": '"AdjustedAmountDue1" <> 0 AND "TotalAmountDue1" = 0',
    "odd_rate": '"TaxRate" < 30 AND "TaxRate" > 0 AND "AdjustedTaxDue2" > 0',
    "due_not_received": '"AdjustedAmountDue1" <> "LastPaymentReceivedAmount1"',
    "past_sale": "\"PastTaxSaleStatus\" = 'Y'",
    "past_sale_and_sale": "\"PastTaxSaleStatus\" = 'Y' AND \"LastPaymentDate2\" = '00000000'",
    "past_sale_no_sale": "\"PastTaxSaleStatus\" = 'Y' AND \"LastPaymentDate2\" <> '00000000'",
}


@query("audit_counts", V.with_views("bills") + "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c}) AS {name}" for name, c in CHECKS_SQL.items()
) + " FROM bills")
def audit_counts(spark, d):
    return profile.audit_counts(label.flag_unpaid(V.bills(spark, d)), profile.bill_checks())


@query("audit_rates", V.with_views("labelled") + """
SELECT count(*) FILTER (WHERE "BlankPmt1" = 1 AND "AdjustedAmountDue1" > 0) * 100.0 / count(*) AS unpaid_charged_pct,
       100 - count(*) FILTER (WHERE "DiffPmt1" = 0) * 100.0 / count(*) AS late1_pct
FROM labelled""".replace("100.0 /", "CAST(100.0 AS DOUBLE) /"))
def audit_rates(spark, d):
    rates = profile.audit_rates(V.labelled(spark, d), {
        "unpaid_charged_pct": (F.col("BlankPmt1") == 1) & (F.col("AdjustedAmountDue1") > 0),
        "on_time": F.col("DiffPmt1") == 0,
    })
    return rates.select("unpaid_charged_pct", (100 - F.col("on_time")).alias("late1_pct"))


# ------------------------------------------------------------------- joins


@query("due_date_join", V.with_views("dated") + """
SELECT "PIN", "TaxYear", "LastPaymentDate1", "LastPaymentDate2", "PmtDue1", "PmtDue2" FROM dated""")
def due_date_join(spark, d):
    return V.dated(spark, d).select(
        "PIN", "TaxYear", "LastPaymentDate1", "LastPaymentDate2", "PmtDue1", "PmtDue2"
    )


@query("due_date_default", V.with_views("bills", "due_dates") + """
SELECT "TaxYear", coalesce("PmtDue2", DATE '2023-08-03') AS "PmtDue2", count(*) AS n
FROM bills LEFT JOIN (SELECT * FROM due_dates WHERE "Year" >= 1997) ON "TaxYear" = "Year"
GROUP BY 1, 2""")
def due_date_default(spark, d):
    calendar = V.due_dates(spark, d).where(F.col("Year") >= 1997)
    joined = label.attach_due_dates(V.bills(spark, d), calendar, default2="2023-08-03")
    return profile.group_counts(joined, ["TaxYear", "PmtDue2"], "n")


SOURCE_SQL = V.with_views("bills", "sources") + """
SELECT b."PIN", b."TaxYear", b."LastPaymentSource1", s1."PmtSrc", s1."PmtMethod",
       b."LastPaymentSource2", s2."PmtSrc" AS "PmtSrc2", s2."PmtDesc" AS "PmtDesc2"
FROM bills b LEFT JOIN sources s1 ON b."LastPaymentSource1" = s1."srcID"
LEFT JOIN sources s2 ON b."LastPaymentSource2" = s2."srcID\""""


def _with_sources(spark, d):
    """The lookup takes the way through its file."""
    path = scratch_path(spark, "sources")
    V.sources(spark, d).withColumnsRenamed({
        "srcID": "Source ID", "PmtDesc": "Payment Description", "PmtSrc": "Payment Source",
        "PmtMethod": "Payment Method",
    }).write.option("header", True).csv(path)
    lookup = read_source_lookup(spark, path)
    return lookups.attach_source(lookups.attach_source(V.bills(spark, d), lookup, 1), lookup, 2)


SOURCE_COLUMNS = ["PIN", "TaxYear", "LastPaymentSource1", "PmtSrc", "PmtMethod", "LastPaymentSource2",
                  "PmtSrc2", "PmtDesc2"]


@query("source_lookup_join", SOURCE_SQL)
def source_lookup_join(spark, d):
    return _with_sources(spark, d).select(*SOURCE_COLUMNS)


@query("source_lookup_filter", f"SELECT * FROM ({SOURCE_SQL}) WHERE \"PmtSrc2\" <> 'TPA'")
def source_lookup_filter(spark, d):
    rows = _with_sources(spark, d).select(*SOURCE_COLUMNS)
    return clean.exclude_sources(rows, ["PmtSrc2"], by_lookup=True)


ROLLUP_SQL = """
SELECT "PIN", "TaxYear4" AS "TaxYear", CASE WHEN count("Payment") = 1 THEN 1 ELSE 0 END AS "PaymentCnt",
       max("DatePaid") AS "LastPaid1", CASE WHEN count(DISTINCT "SourceID") = 1 THEN 1 ELSE 0 END AS "SourceIDCnt",
       round(sum("TotalPaid"), 2) AS "TotalPaid"
FROM ledger WHERE "Payment" = 'P1' GROUP BY "PIN", "TaxYear4\""""


@query("ledger_rollup", V.with_views("ledger") + ROLLUP_SQL)
def ledger_rollup(spark, d):
    return lookups.ledger_rollup(V.ledger(spark, d))


@query("ledger_join", V.with_views("bills", "ledger") + f"""
SELECT b."PIN", b."TaxYear", b."LastPaymentDate2", "PaymentCnt", "LastPaid1", "SourceIDCnt", "TotalPaid"
FROM bills b LEFT JOIN ({ROLLUP_SQL}) r ON b."PIN" = r."PIN" AND b."TaxYear" = r."TaxYear\"""")
def ledger_join(spark, d):
    joined = lookups.attach_ledger(V.bills(spark, d), lookups.ledger_rollup(V.ledger(spark, d)))
    return joined.select(
        "PIN", "TaxYear", "LastPaymentDate2", "PaymentCnt", "LastPaid1", "SourceIDCnt", "TotalPaid"
    )


@query("ledger_split", V.with_views("ledger") + """
SELECT CASE WHEN "Payment" IN ('P1', 'P2') THEN 'instalment' ELSE 'other' END AS kind, "Payment",
       count(*) AS n, count(DISTINCT "PIN") AS accounts
FROM ledger GROUP BY 1, 2""")
def ledger_split(spark, d):
    regular, other = lookups.ledger_split(V.ledger(spark, d))
    return regular.withColumn("kind", F.lit("instalment")).unionByName(
        other.withColumn("kind", F.lit("other"))
    ).groupBy("kind", "Payment").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("PIN").alias("accounts")
    )


@query("ledger_anti_join", V.with_views("ledger") + """
, other AS (SELECT "PIN" FROM ledger WHERE "Payment" NOT IN ('P1', 'P2'))
SELECT count(DISTINCT "PIN") AS with_other,
       count(DISTINCT "PIN") FILTER (WHERE "PIN" NOT IN
         (SELECT "PIN" FROM ledger WHERE "Payment" IN ('P1', 'P2'))) AS without_instalment
FROM other""")
def ledger_anti_join(spark, d):
    return lookups.accounts_without_instalment(clean.drop_incomplete(V.ledger(spark, d)))


# ------------------------------------------------------------------ labels

LABEL_COLUMNS = ["PIN", "TaxYear", "LastPaymentDate2", "BlankPmt1", "BlankPmt2", "LatePmt1", "LatePmt2",
                 "DiffPmt1", "DiffPmt2"]


def _label_sql(paid1: str, paid2: str, where: str = "true", late=('', '')) -> str:
    parts = []
    for n, paid in ((1, paid1), (2, paid2)):
        parts.append(f'CASE WHEN {paid} > "PmtDue{n}" {late[n - 1]} THEN 1 ELSE 0 END AS "LatePmt{n}"')
    return V.with_views("dated") + f"""
SELECT "PIN", "TaxYear", {paid2} AS "LastPaymentDate2",
       CASE WHEN "LastPaymentDate1" IS NULL THEN 1 ELSE 0 END AS "BlankPmt1",
       CASE WHEN "LastPaymentDate2" IS NULL THEN 1 ELSE 0 END AS "BlankPmt2",
       {", ".join(parts)},
       CASE WHEN {paid1} - "PmtDue1" < 0 THEN 0 ELSE CAST({paid1} - "PmtDue1" AS INTEGER) END AS "DiffPmt1",
       CAST({paid2} - "PmtDue2" AS INTEGER) AS "DiffPmt2"
FROM dated WHERE {where}"""


_P1, _P2 = '"LastPaymentDate1"', '"LastPaymentDate2"'
_A1, _A2 = (f"coalesce({p}, DATE '{V.AS_OF}')" for p in (_P1, _P2))
_D1, _D2 = (f'coalesce({p}, CAST("PmtDue{n}" + 1 AS DATE))' for n, p in ((1, _P1), (2, _P2)))
_NEVER = tuple(f'OR ({p} IS NULL AND "PmtDue{n}" IS NOT NULL)' for n, p in ((1, _P1), (2, _P2)))
POLICY_SQL = {
    "as_of": _label_sql(_A1, _A2),
    "always_late": _label_sql(_A1, _A2, late=_NEVER),
    "null": _label_sql(_P1, _P2),
    "drop": _label_sql(_P1, _P2, where=f"{_P1} IS NOT NULL AND {_P2} IS NOT NULL"),
    "due_plus_1": _label_sql(_D1, _D2),
}


def _policy(name):
    def run(spark, d):
        return V.labelled(spark, d, name).select(*LABEL_COLUMNS)
    return run


for _name, _sql in POLICY_SQL.items():
    query(f"label_policy_{_name}", _sql)(_policy(_name))


@query("label_late", V.with_views("labelled") + """
SELECT "TaxYear", "LatePmt1", "LatePmt2", count(*) AS n FROM labelled GROUP BY ALL""")
def label_late(spark, d):
    return profile.group_counts(V.labelled(spark, d), ["TaxYear", "LatePmt1", "LatePmt2"], "n")


@query("flag_unpaid", V.with_views("bills") + """
SELECT "TaxYear", CAST(sum(CASE WHEN "LastPaymentDate2" = '00000000' THEN 1 ELSE 0 END) AS BIGINT) AS unpaid
FROM bills GROUP BY "TaxYear\"""")
def flag_unpaid(spark, d):
    return profile.group_sums(label.flag_unpaid(V.bills(spark, d)), ["TaxYear"], {"unpaid": "TaxSale"})


EDGES = [18, 36, 72, 108, 144, 180, 216, 252, 288]
TEXTS = ["1 - 18 days late", "19 - 36 days late", "37 - 72 days late", "73 - 108 days late",
         "109 - 144 days late", "145 - 180 days late", "181 - 216 days late", "217 - 252 days late",
         "253 - 288 days late", "More than 288 days late"]
CLASS_SQL = "CASE " + " ".join(
    f'WHEN "DiffPmt2" <= {e} THEN {i}' for i, e in enumerate(EDGES, 1)
) + ' WHEN "DiffPmt2" > 288 THEN 10 END'


@query("late_interval", V.with_views("labelled") + """
SELECT "DiffPmt1", CASE WHEN "DiffPmt1" <= 0 THEN 0
  WHEN "DiffPmt1" <= 480 THEN CAST(ceil("DiffPmt1" / 30.0) AS INTEGER)
  WHEN "DiffPmt1" <= 500 THEN 17 WHEN "DiffPmt1" > 500 THEN 18 END AS "LateInterval1"
FROM labelled""")
def late_interval(spark, d):
    return V.labelled(spark, d).select("DiffPmt1", X.late_interval(F.col("DiffPmt1")).alias("LateInterval1"))


@query("late_class", V.with_views("labelled") + f"""
SELECT "DiffPmt2", {CLASS_SQL} AS "LateLabel" FROM labelled WHERE "DiffPmt2" > 0""")
def late_class(spark, d):
    late = V.labelled(spark, d).where(F.col("DiffPmt2") > 0)
    return late.select("DiffPmt2", X.late_class(F.col("DiffPmt2")).alias("LateLabel"))


@query("late_class_text", V.with_views("labelled") + f"""
SELECT "PredictionResult", count(*) AS n FROM (
  SELECT CASE {CLASS_SQL} {" ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TEXTS, 1))} END AS "PredictionResult"
  FROM labelled WHERE "DiffPmt2" > 0) GROUP BY 1""")
def late_class_text(spark, d):
    late = V.labelled(spark, d).where(F.col("DiffPmt2") > 0)
    text = X.late_class_text(X.late_class(F.col("DiffPmt2"))).alias("PredictionResult")
    return profile.group_counts(late.select(text), ["PredictionResult"], "n")


@query("cap_upper", V.with_views("bills") + """
SELECT "PIN", "TaxYear", CASE WHEN "AdjustedAmountDue1" > 40000 THEN 40000 ELSE "AdjustedAmountDue1" END
  AS "AdjustedAmountDue1" FROM bills""")
def cap_upper(spark, d):
    rows = V.bills(spark, d).select("PIN", "TaxYear", "AdjustedAmountDue1")
    return label.cap_upper(rows, "AdjustedAmountDue1", 40000.0)
