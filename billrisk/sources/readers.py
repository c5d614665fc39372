"""Delimited files, the calendar and the lookups.

All files are read with a declared text schema: no inference pass, one scan
for any number of yearly files, splits handled by Spark.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from billrisk.functions import as_int, as_number, parse_date
from billrisk.schema import DUE_DATE_FORMAT, FIRST_YEAR, LEDGER_COLUMNS, LEDGER_DATE_FORMAT, text_schema

CORRUPT = "_corrupt_line"


def schema_from_header(spark: SparkSession, path: str, sep: str = "|") -> T.StructType:
    """Names from the first line of a header file, every column as text."""
    first = spark.read.text(path).limit(1).collect()
    if not first or not first[0][0]:
        raise ValueError(f"no header line in {path}")
    return text_schema([name.strip().lstrip("﻿") for name in first[0][0].split(sep)])


def read_bills(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = "|",
    header: bool = False,
    on_bad: str = "keep",
    year_pattern: str | None = None,
) -> DataFrame:
    """Scan yearly bill files (paths, folders or globs) in one pass.

    ``on_bad="drop"`` removes lines with too many fields and pads short ones
    with null; ``"keep"`` keeps every line and ignores surplus fields.  For the
    test the raw line stays in the plan and lines are parsed in full, because
    Spark stops noticing bad lines once columns are pruned away.  ``year_pattern``, a regular expression
    with one group, adds ``SourceYear`` taken from the file path.
    """
    if on_bad not in ("keep", "drop"):
        raise ValueError("on_bad must be 'keep' or 'drop'")
    if on_bad == "drop":
        return scan_bills(spark, paths, schema, sep, header, year_pattern).rows
    df = spark.read.option("sep", sep).option("header", header).schema(schema).csv(
        paths if isinstance(paths, str) else list(paths))
    return df.select(*schema.fieldNames(), *_source_year(year_pattern))


@dataclass(frozen=True)
class BillScan:
    """``rows`` are the bills; ``rejects`` the lines that are none: (file, block, line, fields, reason).

    ``block`` is where the split that holds the line starts in its file.  Rows
    and rejects together are all lines that are not blank.
    """

    rows: DataFrame
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """(file, reason, n) of the rejects, and the good lines of each file under the reason ``good``."""
        good = self.rows.select(F.col("_metadata.file_path").alias("file"), F.lit("good").alias("reason"))
        return good.unionByName(self.rejects.select("file", "reason")).groupBy("file", "reason").agg(
            F.count(F.lit(1)).alias("n"))


def scan_bills(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    sep: str = "|",
    header: bool = False,
    year_pattern: str | None = None,
) -> BillScan:
    """Bills, and a table of the lines with too many fields; short lines are padded with null and stay."""
    names = schema.fieldNames()
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = (
        spark.read.option("sep", sep).option("header", header).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
        .schema(declared).csv(paths if isinstance(paths, str) else list(paths))
    )
    fields = F.size(F.split(F.col(CORRUPT), "\\Q" + sep + "\\E"))
    surplus = F.col(CORRUPT).isNotNull() & (fields > len(names))
    # Spark refuses to read the raw line alone, so a plain count must touch
    # a data column too; the condition is always true.
    first = F.col(names[0])
    touched = first.isNull() | (F.length(first) >= 0)
    rows = df.where(~surplus & touched).select(*names, *_source_year(year_pattern))
    rejects = df.where(surplus & touched).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col(CORRUPT).alias("line"), fields.alias("fields"),
        F.concat(fields - len(names), F.lit(" surplus fields")).alias("reason"))
    return BillScan(rows, rejects)


def _source_year(pattern: str | None) -> list[Column]:
    if pattern is None:
        return []
    return [F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).try_cast("int").alias("SourceYear")]


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file in any store that Spark reads, packed or not; no job is started."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        source = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine()
    finally:
        stream.close()


def _read_by_name(spark: SparkSession, paths: str | Sequence[str], sep: str, wanted: Sequence[str]) -> DataFrame:
    """Text columns of files with a header line each, by name.

    Spark gives all files of one scan the names of one of them, by position.
    So the header line of every file is read first, by the rules of CSV, and
    files with the same header are scanned together.  Empty files hold nothing.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file in spark.read.text(paths if isinstance(paths, str) else list(paths)).inputFiles():
        line = _first_line(spark, file)
        if line:
            names = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))
            layouts.setdefault(tuple(name.strip() for name in names), []).append(file)
    frames = []
    for names, files in sorted(layouts.items()):
        missing = [name for name in wanted if name not in names]
        if missing:
            raise ValueError(f"no column {missing} in {files}")
        frames.append(spark.read.option("sep", sep).option("header", True).option("enforceSchema", True)
                      .schema(text_schema(list(names))).csv(files).select(*wanted))
    if not frames:
        return spark.createDataFrame([], text_schema(wanted))
    return reduce(DataFrame.unionByName, frames)


def read_payments(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ",",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Payment ledger with a header line; comma or pipe separated.

    Columns are found by name in each file, whatever their order there; other
    columns are left out and a missing one is an error.  The date is ``yyMMdd``
    text padded with blanks.
    """
    wanted = list(columns or LEDGER_COLUMNS)
    raw = _read_by_name(spark, paths, sep, wanted)
    casts = {
        "TaxYear4": as_int(F.col("TaxYear4")) if "TaxYear4" in wanted else None,
        "DatePaid": parse_date(F.trim("DatePaid"), LEDGER_DATE_FORMAT) if "DatePaid" in wanted else None,
        "TotalPaid": as_number(F.col("TotalPaid")) if "TotalPaid" in wanted else None,
    }
    return raw.withColumns({k: v for k, v in casts.items() if v is not None})


def read_due_dates(spark: SparkSession, path: str, min_year: int = FIRST_YEAR) -> DataFrame:
    """Calendar ``Year, Inst1, Inst2`` as ``Year, PmtDue1, PmtDue2`` from ``min_year`` on."""
    raw = _read_by_name(spark, path, ",", ["Year", "Inst1", "Inst2"])
    return raw.select(
        as_int(F.col("Year")).alias("Year"),
        parse_date(F.col("Inst1"), DUE_DATE_FORMAT).alias("PmtDue1"),
        parse_date(F.col("Inst2"), DUE_DATE_FORMAT).alias("PmtDue2"),
    ).where(F.col("Year") >= min_year)


def read_source_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Payment-source codes with short column names, found by their long names."""
    names = {
        "Source ID": "srcID",
        "Payment Description": "PmtDesc",
        "Payment Source": "PmtSrc",
        "Payment Method": "PmtMethod",
    }
    return _read_by_name(spark, path, ",", list(names)).withColumnsRenamed(names)


def read_bills_parquet(spark: SparkSession, path: str, years: Sequence[int] | None = None) -> DataFrame:
    """Bills converted by ``write_bills_parquet``; ``years`` prunes whole folders."""
    df = spark.read.parquet(path)
    return df if years is None else df.where(F.col("TaxYear").isin([int(y) for y in years]))


def union_years(frames: Sequence[DataFrame], by_name: bool = True) -> DataFrame:
    """Bag union of yearly frames, by name or by position with the first frame's names."""
    first = frames[0]
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), frames)
    return reduce(lambda a, b: a.union(b.toDF(*first.columns)), frames)
