"""Counts, shares, rates, histograms, correlations, outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from billrisk import functions as X
from billrisk.operators import distinct, frequent, profile, quantiles
from billrisk.schema import EXEMPTION_AMOUNTS, NUMERIC_COLUMNS
from suite import views as V
from suite.registry import query

SHARE = "count(*) * CAST(100.0 AS DOUBLE) / (SELECT count(*) FROM bills)"


@query("univariate", V.with_views("bills") + f"""
SELECT "LastPaymentSource1", count(*) AS cnt, {SHARE} AS pct FROM bills GROUP BY 1""")
def univariate(spark, d):
    return profile.univariate(V.bills(spark, d), "LastPaymentSource1")


@query("top_categories", V.with_views("bills") + f"""
SELECT "Classification", count(*) AS cnt, {SHARE} AS pct FROM bills GROUP BY 1
ORDER BY cnt DESC, "Classification" LIMIT 10""")
def top_categories(spark, d):
    return profile.top_categories(V.bills(spark, d), "Classification", 10)


CONSTANT_COLUMNS = ["CondemnationStatus", "TaxType", "AcquisitionStatus", "AccountStatus", "BillType", "CofENumber"]


@query("near_constant", V.with_views("bills") + """
, counts AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, "{c}" AS value, count(*) AS n FROM bills GROUP BY "{c}\""""
    for c in CONSTANT_COLUMNS) + """)
SELECT feature, max(n) * CAST(1.0 AS DOUBLE) / sum(n) AS top_share,
       CASE WHEN max(n) * CAST(1.0 AS DOUBLE) / sum(n) > 0.95 THEN 1 ELSE 0 END AS near_constant
FROM counts GROUP BY feature""")
def near_constant(spark, d):
    return profile.near_constant(V.bills(spark, d), CONSTANT_COLUMNS, 0.95)


@query("group_counts", V.with_views("bills") + """
SELECT substr("PIN", 1, 2) AS area, "TaxStatus", count(*) AS cnt FROM bills GROUP BY 1, 2""")
def group_counts(spark, d):
    rows = V.bills(spark, d).select(X.area_code(F.col("PIN")).alias("area"), "TaxStatus")
    return profile.group_counts(rows, ["area", "TaxStatus"])


@query("group_sums", V.with_views("labelled") + """
SELECT "TaxpayerPropertyTown", round(sum("AdjustedAmountDue1"), 2) AS due,
       CAST(sum("LatePmt2") AS DOUBLE) AS late2
FROM labelled GROUP BY 1""")
def group_sums(spark, d):
    rows = V.labelled(spark, d).withColumn("late", F.col("LatePmt2").cast("double"))
    return profile.group_sums(
        rows, ["TaxpayerPropertyTown"], {"due": "AdjustedAmountDue1", "late2": "late"}, digits=2
    )


DISTINCT = ["PIN", "TaxCode", "TaxpayerPropertyCity", "LastPaymentSource1"]


@query("distinct_counts", V.with_views("bills") + "SELECT " + ", ".join(
    f'count(DISTINCT "{c}") AS "{c}"' for c in DISTINCT) + " FROM bills")
def distinct_counts(spark, d):
    return profile.distinct_counts(V.bills(spark, d), DISTINCT)


CATEGORIES = ["AccountStatus", "BillType", "LastPaymentSource1", "TaxStatus"]


@query("category_values", V.with_views("bills") + " UNION ".join(
    f"""SELECT '{c}' AS feature, "{c}" AS value FROM bills""" for c in CATEGORIES))
def category_values(spark, d):
    return profile.category_values(V.bills(spark, d), CATEGORIES)


NULLABLE = V.BILL_NAMES


@query("null_counts", V.with_views("bills") + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE "{c}" IS NULL) AS nulls FROM bills""" for c in NULLABLE))
def null_counts(spark, d):
    return profile.null_counts(V.bills(spark, d), NULLABLE)


@query("late_rate_by", V.with_views("labelled") + """
SELECT "TaxYear", substr("PIN", 1, 2) AS "P2", count(*) AS n,
       sum("LatePmt1") * CAST(100.0 AS DOUBLE) / count(*) AS late1_pct,
       sum("LatePmt2") * CAST(100.0 AS DOUBLE) / count(*) AS late2_pct
FROM labelled GROUP BY 1, 2""")
def late_rate_by(spark, d):
    rows = V.labelled(spark, d).withColumn("P2", X.area_code(F.col("PIN")))
    return profile.late_rate_by(rows, ["TaxYear", "P2"])


@query("histogram_edges", V.with_views("labelled") + """
, edges AS (SELECT CAST(range AS INTEGER) AS bin FROM range(22)),
binned AS (SELECT least(CAST(floor("DiffPmt2" / 30.0) AS INTEGER), 21) AS bin FROM labelled
           WHERE "DiffPmt2" > 0 AND "DiffPmt2" <= 660)
SELECT e.bin, e.bin * CAST(30.0 AS DOUBLE) AS low, e.bin * CAST(30.0 AS DOUBLE) + 30 AS high, count(b.bin) AS n
FROM edges e LEFT JOIN binned b ON e.bin = b.bin GROUP BY e.bin""")
def histogram_edges(spark, d):
    late = V.labelled(spark, d).where(F.col("DiffPmt2") > 0)
    return profile.histogram_edges(late, "DiffPmt2", list(range(0, 680, 30)))


@query("histogram_bins", V.with_views("bills") + """
, b AS (SELECT min("CostAmountDue1") AS lo, max("CostAmountDue1") AS hi FROM bills),
binned AS (SELECT least(CAST(floor(("CostAmountDue1" - lo) / ((hi - lo) / 10)) AS INTEGER), 9) AS bin FROM bills, b)
SELECT CAST(r.range AS INTEGER) AS bin, lo + r.range * ((hi - lo) / 10) AS low,
       lo + (r.range + 1) * ((hi - lo) / 10) AS high, count(binned.bin) AS n
FROM range(10) r CROSS JOIN b LEFT JOIN binned ON binned.bin = r.range GROUP BY r.range, lo, hi""")
def histogram_bins(spark, d):
    return profile.histogram_bins(V.bills(spark, d), "CostAmountDue1", 10)


NUMERIC = ["TaxYear", *[c for c in V.BILL_NAMES if c in {*NUMERIC_COLUMNS, *EXEMPTION_AMOUNTS}]]


def _corr_sql(columns, rows="bills") -> str:
    """All pairs in one aggregate, then one row per cell."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    sums = ", ".join(f'round(corr("{a}", "{b}"), 6) AS "{a}|{b}"' for a, b in pairs)
    cells = [f"SELECT '{c}' AS a, '{c}' AS b, CAST(1.0 AS DOUBLE) AS r" for c in columns]
    cells += [f"""SELECT '{x}', '{y}', "{a}|{b}" FROM m""" for a, b in pairs for x, y in ((a, b), (b, a))]
    return f", m AS MATERIALIZED (SELECT {sums} FROM {rows}) " + " UNION ALL ".join(cells)


@query("correlation_matrix", V.with_views("bills") + _corr_sql(NUMERIC))
def correlation_matrix(spark, d):
    """All numeric columns; each pair over the rows that know both."""
    return profile.correlation_matrix(V.bills(spark, d), NUMERIC)


@query("correlation_matrix_ml", V.with_views("bills") + ", complete AS (SELECT * FROM bills WHERE " + " AND ".join(
    f'"{c}" IS NOT NULL' for c in NUMERIC) + ")" + _corr_sql(NUMERIC, "complete"))
def correlation_matrix_ml(spark, d):
    """All numeric columns; rows without any null."""
    return profile.correlation_matrix(V.bills(spark, d), NUMERIC, nulls="complete")


PRUNE = ["AdjustedAmountDue1", "TotalAmountDue1", "TaxAmountDue1", "AdjustedTaxDue2", "TaxAmountDue2"]


# TotalAmountDue1 and TaxAmountDue1 follow AdjustedAmountDue1, TaxAmountDue2 follows AdjustedTaxDue2.
@query("prune_correlated", V.with_views("bills") + """
, c AS (SELECT corr("AdjustedAmountDue1", "TotalAmountDue1") AS ab, corr("AdjustedAmountDue1", "TaxAmountDue1") AS ac,
               corr("AdjustedAmountDue1", "AdjustedTaxDue2") AS ad, corr("AdjustedTaxDue2", "TaxAmountDue2") AS de,
               corr("AdjustedAmountDue1", "TaxAmountDue2") AS ae FROM bills)
SELECT 'AdjustedAmountDue1' AS kept FROM c
UNION ALL SELECT 'TotalAmountDue1' FROM c WHERE abs(ab) <= 0.5
UNION ALL SELECT 'TaxAmountDue1' FROM c WHERE abs(ac) <= 0.5
UNION ALL SELECT 'AdjustedTaxDue2' FROM c WHERE abs(ad) <= 0.5
UNION ALL SELECT 'TaxAmountDue2' FROM c WHERE abs(ae) <= 0.5 AND abs(de) <= 0.5""")
def prune_correlated(spark, d):
    table = profile.correlation_matrix(V.bills(spark, d), PRUNE)
    kept = profile.prune_correlated(table, PRUNE, 0.5)
    return spark.createDataFrame([(name,) for name in kept], "kept string")


@query("winsorize", V.with_views("bills") + ", q AS (SELECT " + ", ".join(
    f'quantile_cont("{c}", 0.01) AS "lo_{c}", quantile_cont("{c}", 0.99) AS "hi_{c}"' for c in NUMERIC) + """ FROM bills)
SELECT "PIN", """ + ", ".join(
    f"""round(CASE WHEN "{c}" < "lo_{c}" THEN "lo_{c}" WHEN "{c}" > "hi_{c}" THEN "hi_{c}" ELSE "{c}" END, 4)::DOUBLE AS "{c}\""""
    for c in NUMERIC) + " FROM bills, q")
def winsorize(spark, d):
    """All numeric columns at once."""
    rows = quantiles.winsorize(V.bills(spark, d).select("PIN", *NUMERIC), NUMERIC)
    return rows.select("PIN", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in NUMERIC])


TOP = ["TaxCode", "PIN", "LastPaymentSource1"]


@query("top_values", V.with_views("bills") + " UNION ALL ".join(f"""
SELECT '{c}' AS feature, CAST(row_number() OVER (ORDER BY cnt DESC, value NULLS FIRST) AS INTEGER) AS rank, value, cnt,
       cnt * CAST(100.0 AS DOUBLE) / total AS pct
FROM (SELECT "{c}" AS value, count(*) AS cnt, sum(count(*)) OVER () AS total FROM bills GROUP BY 1)
QUALIFY rank <= 10""" for c in TOP))
def top_values(spark, d):
    """Ten most frequent values of columns with many different ones."""
    return frequent.top_values(V.bills(spark, d), TOP, 10)


BY_AREA = ["TaxYear", "area"]
COUNTED = ["PIN", "TaxCode", "Classification", "LastPaymentSource1"]


@query("distinct_counts_by", V.with_views("bills") + " UNION ALL ".join(f"""
SELECT "TaxYear", substr("PIN", 1, 2) AS area, '{c}' AS feature, count(DISTINCT "{c}") AS n
FROM bills GROUP BY 1, 2 HAVING count("{c}") > 0""" for c in COUNTED))
def distinct_counts_by(spark, d):
    """Different values per year and area."""
    rows = V.bills(spark, d).withColumn("area", X.area_code(F.col("PIN")))
    return distinct.distinct_counts_by(rows, BY_AREA, COUNTED)


@query("late_rate_levels", V.with_views("labelled") + """
SELECT CASE (GROUPING("TaxYear") * 2 + GROUPING("P2")) WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS level,
       "TaxYear", "P2", count(*) AS n,
       sum("LatePmt1") * CAST(100.0 AS DOUBLE) / count(*) AS late1_pct,
       sum("LatePmt2") * CAST(100.0 AS DOUBLE) / count(*) AS late2_pct
FROM (SELECT *, substr("PIN", 1, 2) AS "P2" FROM labelled) GROUP BY CUBE ("TaxYear", "P2")""")
def late_rate_levels(spark, d):
    """Late rates by year and area, by year, by area, and of all bills, in one pass."""
    rows = V.labelled(spark, d).withColumn("P2", X.area_code(F.col("PIN")))
    return profile.late_rate_levels(rows, [["TaxYear", "P2"], ["TaxYear"], ["P2"], []])
