"""Yearly loads: each year in its own folder, and a manifest of the files behind it.

A load writes the years of the files it is given and replaces those years only,
so a corrected file takes the place of the first one and a rerun adds nothing.
Files that the manifest already knows (path, size and time of change) are not
read again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

MANIFEST = "_manifest"
_FILE = ["path", "size", "changed"]


def file_list(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, size, changed) of all files, from their metadata; their contents are not read."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """(path, size, changed, year, rows) of the files behind the table."""
    try:
        return spark.read.parquet(f"{target}/{MANIFEST}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, size long, changed timestamp, year int, rows long")


def load_years(
    spark: SparkSession, paths: str | Sequence[str], target: str, read: Callable[[list[str]], DataFrame], year: str = "TaxYear",
) -> DataFrame:
    """Write the years found in new or changed files; (path, size, changed, year, rows) of what was read comes back.

    ``read`` makes bills with the column ``year`` from a list of paths.  A year
    may come in several files.  If one of them is new or changed, all files that
    hold rows of that year by the manifest and are still there are read, and its
    folder is replaced as a whole; files that are gone are forgotten.  Rows
    without a year are an error.
    """
    known = manifest(spark, target).collect()  # one row per file and year
    found = [tuple(r) for r in file_list(spark, paths).select(*_FILE).collect()]  # one row per file
    there = {tuple(r[c] for c in _FILE) for r in known}
    fresh = [f for f in found if f not in there]
    columns = "path string, size long, changed timestamp, year int, rows long"
    if not fresh:
        return spark.createDataFrame([], columns)
    new = {f[0] for f in fresh}
    path = F.col("_metadata.file_path").alias("path")
    told = read(sorted(new)).select(path, F.col(year).cast("int").alias("year")).groupBy("path", "year").agg(
        F.count(F.lit(1)).alias("rows")).collect()  # one row per new file and year
    years = {r.year for r in told}
    if None in years:
        raise ValueError(f"rows without {year} in {sorted(new)}")
    years |= {r.year for r in known if r.path in new and r.year is not None}  # a corrected file may have lost a year
    others = {r.path for r in known if r.year in years and r.path not in new}
    partners = {p for p in others if p in {f[0] for f in found} or _exists(spark, p)}
    rows = read(sorted(new | partners)).where(F.col(year).isin(sorted(years)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(target)
    by_path = {_plain(f[0]): f for f in fresh}
    entries = [(*by_path[_plain(r.path)], r.year, r.rows) for r in told]
    entries += [(*f, None, 0) for f in fresh if _plain(f[0]) not in {_plain(r.path) for r in told}]  # files without rows
    rest = [tuple(r) for r in known if r.path not in new | (others - partners)]
    for lost in sorted(years - {e[3] for e in [*rest, *entries]}):  # no file holds rows of it any more
        rows.drop(year).limit(0).write.mode("overwrite").parquet(f"{target}/{year}={lost}")
    spark.createDataFrame([*rest, *entries], columns).coalesce(1).write.mode("overwrite").parquet(f"{target}/{MANIFEST}")
    return spark.createDataFrame(entries, columns)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _plain(path: str) -> str:
    """The same path whichever way the slashes after the scheme are written."""
    head, sep, tail = path.partition(":")
    return f"{head}:/{tail.lstrip('/')}" if sep else path


def read_years(spark: SparkSession, target: str, years: Sequence[int] | None = None, year: str = "TaxYear") -> DataFrame:
    """The loaded bills; ``years`` prunes whole folders."""
    df = spark.read.parquet(target)
    return df if years is None else df.where(F.col(year).isin([int(y) for y in years]))
