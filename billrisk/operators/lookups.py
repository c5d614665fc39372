"""Joins with the payment-source lookup and the payment ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from billrisk.functions import as_int, flag
from billrisk.operators.sizing import small_side

INSTALMENTS = ("P1", "P2")


def attach_source(df: DataFrame, lookup: DataFrame, n: int = 1) -> DataFrame:
    """Left join of the source description; for the second instalment names end in 2."""
    suffix = "" if n == 1 else str(n)
    named = lookup.select(
        F.col("srcID").alias(f"srcID{suffix}"), F.col("PmtDesc").alias(f"PmtDesc{suffix}"),
        F.col("PmtSrc").alias(f"PmtSrc{suffix}"), F.col("PmtMethod").alias(f"PmtMethod{suffix}"),
    )
    return df.join(
        small_side(named), F.col(f"LastPaymentSource{n}") == F.col(f"srcID{suffix}"), "left"
    )


def ledger_split(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Instalment rows, and all other rows with a known kind."""
    regular = F.col("Payment").isin(*INSTALMENTS)
    return ledger.where(regular), ledger.where(~regular)


def ledger_rollup(ledger: DataFrame, kind: str = "P1") -> DataFrame:
    """One row per account and year for one instalment.

    ``PaymentCnt`` and ``SourceIDCnt`` are 1 when there was exactly one payment
    and exactly one known source.  One source means smallest equals largest,
    which needs a single shuffle where a distinct count needs two.
    """
    grouped = ledger.where(F.col("Payment") == kind).groupBy(
        "PIN", as_int(F.col("TaxYear4")).alias("TaxYear")
    )
    return grouped.agg(
        flag(F.count(F.lit(1)) == 1).alias("PaymentCnt"),
        F.max("DatePaid").alias("LastPaid1"),
        flag(F.min("SourceID") == F.max("SourceID")).alias("SourceIDCnt"),
        F.round(F.sum("TotalPaid"), 2).alias("TotalPaid"),
    )


def attach_ledger(df: DataFrame, rollup: DataFrame, by_account: bool = False) -> DataFrame:
    """Left join of the roll-up on account and year; both sides are large, so no hint.

    The roll-up has one row per key, and adaptive execution splits a hot key
    on the bill side.  ``by_account`` brings the years of an account in one row
    and picks the bill's year there, so that bills which a window has placed by
    account are not shuffled again; only for a roll-up without repeated keys.
    """
    year = as_int(F.col("TaxYear"))
    if not by_account:
        right = rollup.withColumnsRenamed({"PIN": "_pin", "TaxYear": "_year"})
        match = (F.col("PIN") == F.col("_pin")) & (year == F.col("_year"))
        return df.join(right, match, "left").drop("_pin", "_year")
    values = [c for c in rollup.columns if c not in ("PIN", "TaxYear")]
    years = rollup.where("PIN is not null and TaxYear is not null").groupBy(F.col("PIN").alias("_pin")).agg(
        F.collect_list(F.struct(F.col("TaxYear").alias("_year"), *values)).alias("_years"))
    joined = df.join(years, F.col("PIN") == F.col("_pin"), "left")
    found = joined.withColumn("_paid", F.get(F.filter("_years", lambda paid: paid["_year"] == year), F.lit(0)))
    return found.withColumns({c: F.col("_paid")[c] for c in values}).drop("_pin", "_years", "_paid")


def accounts_without_instalment(ledger: DataFrame) -> DataFrame:
    """Accounts that have other payments but none for an instalment, and how many there are.

    One aggregate per account answers both membership tests, with counts
    combined before the shuffle, in place of an anti-join.
    """
    regular = F.col("Payment").isin(*INSTALMENTS)
    accounts = ledger.where(F.col("PIN").isNotNull() & F.col("Payment").isNotNull()).groupBy("PIN").agg(
        F.max(regular).alias("has_regular"), F.max(~regular).alias("has_other"),
    )
    return accounts.agg(
        F.count_if("has_other").alias("with_other"),
        F.count_if(F.col("has_other") & ~F.col("has_regular")).alias("without_instalment"),
    )
