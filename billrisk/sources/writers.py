"""Sinks.  Every write is one file per task; nothing is squeezed into a single file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F


def write_scores(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    columns: Sequence[str] = ("PIN", "probability", "prediction"),
    sep: str = ",",
    mode: str = "error",
) -> None:
    """Export chosen result columns; a probability is rounded to two places."""
    out = df.select(*columns)
    if "probability" in columns:
        out = out.withColumn("probability", F.round("probability", 2))
    writer = out.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("sep", sep).csv(path)
    else:
        writer.format(fmt).save(path)


def write_bills_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    """Convert bills once to Parquet, one folder per tax year.

    Tasks write straight from their input splits: a year may hold a large part
    of all rows, so rows are not gathered by year first.
    """
    df.write.mode(mode).partitionBy("TaxYear").parquet(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
