"""Bill-shaped views of the supplied tables, in Spark and in SQL.

Column names are those of the real bill files; codes and dates are text as
they are there, amounts are doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from billrisk.functions import flag
from billrisk.operators import label
from billrisk.session import compiled_methods

AS_OF = "2001-12-31"
TEST_YEAR = 2000

# --------------------------------------------------------------------------
# SQL
# --------------------------------------------------------------------------
_SQL = {
    "bills": """
SELECT lpad(CAST((o_custkey * 7919) % 100000000 AS VARCHAR), 8, '0') AS "PIN",
       CAST(year(l_shipdate) - (l_linenumber % 2) AS INTEGER) AS "TaxYear",
       CASE WHEN l_quantity = 47 THEN 'XX' ELSE 'PH' END AS "SegmentCode",
       CASE WHEN l_quantity = 49 THEN '01' WHEN l_quantity = 48 THEN '03' ELSE '00' END AS "TaxStatus",
       CASE WHEN l_linestatus = 'O' THEN '1' ELSE '3' END AS "BillType",
       CAST(year(l_shipdate) AS VARCHAR) AS "BillYear",
       '0' AS "TaxType",
       CASE WHEN l_returnflag = 'A' THEN 'O' WHEN l_returnflag = 'N' THEN 'P' END AS "AccountStatus",
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS "PastTaxSaleStatus",
       CASE WHEN l_quantity = 46 THEN '00000000'
            ELSE strftime(CAST(l_shipdate AS DATE) + CAST(l_partkey % 60 - 30 AS INTEGER), '%m%d%Y')
       END AS "LastPaymentDate1",
       CASE WHEN l_quantity = 50 THEN '00000000' ELSE strftime(l_shipdate, '%m%d%Y') END AS "LastPaymentDate2",
       CASE WHEN l_suppkey % 25 = 0 THEN '600' WHEN l_suppkey % 25 = 1 THEN '000'
            WHEN l_suppkey % 25 = 2 THEN NULL
            ELSE CAST(420 + l_suppkey % 25 AS VARCHAR) END AS "LastPaymentSource1",
       CASE WHEN l_linenumber = 7 THEN '527' WHEN l_linenumber = 6 THEN NULL
            ELSE CAST(400 + l_linenumber AS VARCHAR) END AS "LastPaymentSource2",
       CASE WHEN l_tax = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS "AdjustedAmountDue1",
       l_extendedprice * 0.5 AS "TaxAmountDue1",
       l_extendedprice * l_discount AS "InterestAmountDue1",
       l_quantity AS "CostAmountDue1",
       CASE WHEN l_quantity < 5 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice + l_quantity END AS "TotalAmountDue1",
       l_extendedprice * 0.25 AS "OriginalTaxDue2",
       l_discount AS "AdjustedTaxDue2",
       l_discount * 100 AS "TaxAmountDue2",
       l_tax * 10 AS "InterestAmountDue2",
       l_quantity * 2 AS "CostAmountDue2",
       l_extendedprice * 0.75 AS "TotalAmountDue2",
       o_totalprice AS "AssessedValuation",
       o_totalprice * 3 AS "EqualizedEvaluation",
       l_tax AS "TaxRate",
       CASE WHEN l_linenumber = 3 THEN l_extendedprice * 0.5 WHEN l_tax = 0 THEN CAST(0 AS DOUBLE)
            ELSE l_extendedprice END AS "LastPaymentReceivedAmount1",
       CASE WHEN l_linenumber = 5 THEN NULL ELSE l_discount END AS "LastPaymentReceivedAmount2",
       l_tax * 1000 AS "HomeownerExemptAmount",
       l_discount * 500 AS "SeniorExemptAmount",
       l_extendedprice * l_tax AS "SeniorFreezeExemptAmount",
       CASE WHEN l_linenumber = 4 THEN NULL ELSE l_quantity * 20 END AS "LongtimeHomeownersExemptAmount",
       l_extendedprice * 0.55 AS "TaxDueEstimated1",
       CAST(l_linenumber % 3 AS VARCHAR) AS "HomeownerExempt",
       CAST(l_suppkey % 3 AS VARCHAR) AS "SeniorExempt",
       CAST(l_partkey % 3 AS VARCHAR) AS "SeniorFreezeExempt",
       CAST(l_linenumber % 2 AS VARCHAR) AS "LongtimeHomeownersExempt",
       CAST(l_partkey % 4 AS VARCHAR) AS "VeteranExempt",
       CAST(l_orderkey % 3 AS VARCHAR) AS "ExemptStatus",
       CAST(l_orderkey % 5 AS VARCHAR) AS "BankruptStatus",
       CASE WHEN l_partkey % 40 = 0 THEN '1' ELSE '0' END AS "CondemnationStatus",
       CAST(l_suppkey % 2 AS VARCHAR) AS "MunicipalAcquisitionStatus",
       CASE WHEN l_partkey % 20 = 0 THEN '1' ELSE '0' END AS "AcquisitionStatus",
       CASE WHEN l_partkey % 30 = 0 THEN '1' ELSE '0' END AS "RefundStatus",
       CASE WHEN l_partkey % 50 = 0 THEN lpad(CAST(l_partkey AS VARCHAR), 7, '0') ELSE '0000000' END AS "CofENumber",
       o_orderpriority AS "TaxpayerPropertySuffix",
       CAST(l_suppkey % 30 AS VARCHAR) AS "TaxpayerPropertyTown",
       CAST(200 + l_partkey % 100 AS VARCHAR) AS "Classification",
       CAST(l_partkey % 600 AS VARCHAR) AS "Volume",
       CAST(10000 + l_suppkey AS VARCHAR) AS "TaxCode",
       CASE WHEN o_orderstatus = 'F' THEN 'CHICAGO     ' ELSE 'CICERO      ' END AS "TaxpayerPropertyCity",
       CASE WHEN l_partkey % 10 = 0 THEN 'IN' WHEN l_partkey % 10 = 1 THEN 'il' ELSE 'IL' END AS "TaxpayerMailingState"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "due_dates": """
SELECT y AS "Year", make_date(y, 3, 1) AS "PmtDue1", make_date(y, 8, 1) AS "PmtDue2"
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)""",
    "ledger": """
SELECT lpad(CAST((o_custkey * 7919) % 100000000 AS VARCHAR), 8, '0') AS "PIN",
       CAST(year(o_orderdate) AS INTEGER) AS "TaxYear4",
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'P1'
            WHEN o_orderpriority = '2-HIGH' THEN 'P2' ELSE 'XX' END AS "Payment",
       CAST(o_orderdate AS DATE) AS "DatePaid", o_orderstatus AS "SourceID", o_totalprice AS "TotalPaid"
FROM orders""",
    "scored": """
SELECT o_orderkey AS "RowKey", CAST(year(o_orderdate) AS INTEGER) AS "TaxYear",
       CAST((o_orderkey * 31 + o_custkey * 17) % 101 AS DOUBLE) / 100 AS score,
       CASE WHEN month(o_orderdate) >= 8 THEN 1 ELSE 0 END AS label,
       CAST((o_orderkey * 13) % 10 + 1 AS INTEGER) AS pred_class,
       CAST((o_custkey * 7) % 10 + 1 AS INTEGER) AS true_class,
       CAST((o_orderkey * 37) % 499 + 1 AS DOUBLE) AS true_days,
       CAST((o_custkey * 53) % 499 + 1 AS DOUBLE) AS pred_days
FROM orders""",
    # Source codes 400-424 from the nations; a few of them are agents.
    "sources": """
SELECT CAST(400 + n_nationkey AS VARCHAR) AS "srcID", n_name AS "PmtDesc",
       CASE WHEN n_regionkey = 0 THEN 'TPA' WHEN n_regionkey = 1 THEN 'BANK' ELSE 'MAIL' END AS "PmtSrc",
       CASE WHEN n_nationkey % 2 = 0 THEN 'CHECK' ELSE 'WIRE' END AS "PmtMethod"
FROM nation""",
    # Calendar joined, dates parsed, nothing decided about missing payments.
    "dated": """
SELECT * REPLACE (CAST(try_strptime("LastPaymentDate1", '%m%d%Y') AS DATE) AS "LastPaymentDate1",
                  CAST(try_strptime("LastPaymentDate2", '%m%d%Y') AS DATE) AS "LastPaymentDate2")
FROM bills LEFT JOIN due_dates ON "TaxYear" = "Year\"""",
    "filled": f"""
SELECT * REPLACE (coalesce("LastPaymentDate1", DATE '{AS_OF}') AS "LastPaymentDate1",
                  coalesce("LastPaymentDate2", DATE '{AS_OF}') AS "LastPaymentDate2"),
       CASE WHEN "LastPaymentDate1" IS NULL THEN 1 ELSE 0 END AS "BlankPmt1",
       CASE WHEN "LastPaymentDate2" IS NULL THEN 1 ELSE 0 END AS "BlankPmt2"
FROM dated""",
    # Labels under the as-of policy; DiffPmt1 clipped at 0, DiffPmt2 not.
    "labelled": """
SELECT *,
       CASE WHEN "LastPaymentDate1" > "PmtDue1" THEN 1 ELSE 0 END AS "LatePmt1",
       CASE WHEN "LastPaymentDate2" > "PmtDue2" THEN 1 ELSE 0 END AS "LatePmt2",
       CASE WHEN "LastPaymentDate1" - "PmtDue1" < 0 THEN 0
            ELSE CAST("LastPaymentDate1" - "PmtDue1" AS INTEGER) END AS "DiffPmt1",
       CAST("LastPaymentDate2" - "PmtDue2" AS INTEGER) AS "DiffPmt2"
FROM filled""",
    "acct_year": """
SELECT "PIN", "TaxYear", max("LatePmt1") AS "LatePmt1", max("LatePmt2") AS "LatePmt2",
       max(CASE WHEN "PastTaxSaleStatus" = 'Y' THEN 1 ELSE 0 END) AS "PastTaxSaleStatus"
FROM labelled GROUP BY "PIN", "TaxYear\"""",
}

_NEEDS = {
    "dated": ["bills", "due_dates"],
    "filled": ["dated"],
    "labelled": ["filled"],
    "acct_year": ["labelled"],
}


def with_views(*names: str, replace: str | None = None) -> str:
    """``WITH ...`` for the named views and all they are built on.

    ``replace`` puts other expressions in the place of some columns of the bills.
    """
    order: list[str] = []
    views = dict(_SQL)
    if replace is not None:
        views["bills"] = f"SELECT * REPLACE ({replace}) FROM ({_SQL['bills']})"

    def visit(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in order) + "\n"


# --------------------------------------------------------------------------
# Spark
# --------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PIN = "lpad(string((o_custkey * 7919) % 100000000), 8, '0') AS PIN"

_BILL_COLUMNS = [
    _PIN,
    "int(year(l_shipdate) - l_linenumber % 2) AS TaxYear",
    "if(l_quantity = 47, 'XX', 'PH') AS SegmentCode",
    "CASE l_quantity WHEN 49 THEN '01' WHEN 48 THEN '03' ELSE '00' END AS TaxStatus",
    "if(l_linestatus = 'O', '1', '3') AS BillType",
    "string(year(l_shipdate)) AS BillYear",
    "'0' AS TaxType",
    "CASE l_returnflag WHEN 'A' THEN 'O' WHEN 'N' THEN 'P' END AS AccountStatus",
    "if(l_returnflag = 'R', 'Y', 'N') AS PastTaxSaleStatus",
    "if(l_quantity = 46, '00000000', date_format(date_add(date(l_shipdate), int(l_partkey % 60 - 30)), 'MMddyyyy'))"
    " AS LastPaymentDate1",
    "if(l_quantity = 50, '00000000', date_format(l_shipdate, 'MMddyyyy')) AS LastPaymentDate2",
    "CASE l_suppkey % 25 WHEN 0 THEN '600' WHEN 1 THEN '000' WHEN 2 THEN NULL"
    " ELSE string(420 + l_suppkey % 25) END AS LastPaymentSource1",
    "CASE l_linenumber WHEN 7 THEN '527' WHEN 6 THEN NULL ELSE string(400 + l_linenumber) END AS LastPaymentSource2",
    "if(l_tax = 0, 0D, l_extendedprice) AS AdjustedAmountDue1",
    "l_extendedprice * 0.5D AS TaxAmountDue1",
    "l_extendedprice * l_discount AS InterestAmountDue1",
    "l_quantity AS CostAmountDue1",
    "if(l_quantity < 5, 0D, l_extendedprice + l_quantity) AS TotalAmountDue1",
    "l_extendedprice * 0.25D AS OriginalTaxDue2",
    "l_discount AS AdjustedTaxDue2",
    "l_discount * 100 AS TaxAmountDue2",
    "l_tax * 10 AS InterestAmountDue2",
    "l_quantity * 2 AS CostAmountDue2",
    "l_extendedprice * 0.75D AS TotalAmountDue2",
    "o_totalprice AS AssessedValuation",
    "o_totalprice * 3 AS EqualizedEvaluation",
    "l_tax AS TaxRate",
    "CASE WHEN l_linenumber = 3 THEN l_extendedprice * 0.5D WHEN l_tax = 0 THEN 0D ELSE l_extendedprice END"
    " AS LastPaymentReceivedAmount1",
    "if(l_linenumber = 5, NULL, l_discount) AS LastPaymentReceivedAmount2",
    "l_tax * 1000 AS HomeownerExemptAmount",
    "l_discount * 500 AS SeniorExemptAmount",
    "l_extendedprice * l_tax AS SeniorFreezeExemptAmount",
    "if(l_linenumber = 4, NULL, l_quantity * 20) AS LongtimeHomeownersExemptAmount",
    "l_extendedprice * 0.55D AS TaxDueEstimated1",
    "string(l_linenumber % 3) AS HomeownerExempt",
    "string(l_suppkey % 3) AS SeniorExempt",
    "string(l_partkey % 3) AS SeniorFreezeExempt",
    "string(l_linenumber % 2) AS LongtimeHomeownersExempt",
    "string(l_partkey % 4) AS VeteranExempt",
    "string(l_orderkey % 3) AS ExemptStatus",
    "string(l_orderkey % 5) AS BankruptStatus",
    "if(l_partkey % 40 = 0, '1', '0') AS CondemnationStatus",
    "string(l_suppkey % 2) AS MunicipalAcquisitionStatus",
    "if(l_partkey % 20 = 0, '1', '0') AS AcquisitionStatus",
    "if(l_partkey % 30 = 0, '1', '0') AS RefundStatus",
    "if(l_partkey % 50 = 0, lpad(string(l_partkey), 7, '0'), '0000000') AS CofENumber",
    "o_orderpriority AS TaxpayerPropertySuffix",
    "string(l_suppkey % 30) AS TaxpayerPropertyTown",
    "string(200 + l_partkey % 100) AS Classification",
    "string(l_partkey % 600) AS Volume",
    "string(10000 + l_suppkey) AS TaxCode",
    "if(o_orderstatus = 'F', 'CHICAGO     ', 'CICERO      ') AS TaxpayerPropertyCity",
    "CASE l_partkey % 10 WHEN 0 THEN 'IN' WHEN 1 THEN 'il' ELSE 'IL' END AS TaxpayerMailingState",
]
BILL_NAMES = [expr.rpartition(" AS ")[2] for expr in _BILL_COLUMNS]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for an input with fewer splits than cores; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def finely_shuffled(spark: SparkSession, df: DataFrame, per_split: int = 4) -> None:
    """Have shuffles begin with ``per_split`` partitions for each split of a larger input, if that is more than now.

    With a fixed number the rows that a task sorts, and the memory for it, grow
    with the input.  Adaptive execution puts small partitions together again.
    """
    wanted = per_split * df.rdd.getNumPartitions()
    if int(spark.conf.get(_FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")) < wanted:
        spark.conf.set(_FIRST_PARTITIONS, str(wanted))


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    compiled_methods(spark)
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    finely_shuffled(spark, lines)
    lines = spread(lines, "l_orderkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(*_BILL_COLUMNS)


def due_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").selectExpr("year(o_orderdate) AS Year").distinct()
    return years.selectExpr("Year", "make_date(Year, 3, 1) AS PmtDue1", "make_date(Year, 8, 1) AS PmtDue2")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        _PIN, "year(o_orderdate) AS TaxYear4",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2' ELSE 'XX' END AS Payment",
        "date(o_orderdate) AS DatePaid", "o_orderstatus AS SourceID", "o_totalprice AS TotalPaid",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS RowKey", "year(o_orderdate) AS TaxYear",
        "double((o_orderkey * 31 + o_custkey * 17) % 101) / 100 AS score",
        "if(month(o_orderdate) >= 8, 1, 0) AS label",
        "int((o_orderkey * 13) % 10 + 1) AS pred_class", "int((o_custkey * 7) % 10 + 1) AS true_class",
        "double((o_orderkey * 37) % 499 + 1) AS true_days", "double((o_custkey * 53) % 499 + 1) AS pred_days",
    )


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source codes 400-424 from the nations; a few of them are agents."""
    return table(spark, sf_dir, "nation").selectExpr(
        "string(400 + n_nationkey) AS srcID", "n_name AS PmtDesc",
        "CASE n_regionkey WHEN 0 THEN 'TPA' WHEN 1 THEN 'BANK' ELSE 'MAIL' END AS PmtSrc",
        "if(n_nationkey % 2 = 0, 'CHECK', 'WIRE') AS PmtMethod",
    )


def dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label.parse_paid_dates(label.attach_due_dates(bills(spark, sf_dir), due_dates(spark, sf_dir)))


def labelled(spark: SparkSession, sf_dir: str, policy: str = "as_of", clip=(1,)) -> DataFrame:
    return label.label_bills(
        bills(spark, sf_dir), due_dates(spark, sf_dir), policy,
        AS_OF if policy in ("as_of", "always_late") else None, clip=clip,
    )


def acct_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).groupBy("PIN", "TaxYear").agg(
        F.max("LatePmt1").alias("LatePmt1"), F.max("LatePmt2").alias("LatePmt2"),
        F.max(flag(F.col("PastTaxSaleStatus") == "Y")).alias("PastTaxSaleStatus"),
    )
