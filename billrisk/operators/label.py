"""Due dates, missing payments, late labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from billrisk.functions import as_int, clip_low, days_between, flag, parse_date
from billrisk.operators.sizing import small_side
from billrisk.schema import AMOUNT_CAP, PAID_DATE_FORMAT, UNPAID_TEXT

POLICIES = ("as_of", "always_late", "due_plus_1", "null", "drop")


def attach_due_dates(df: DataFrame, calendar: DataFrame, default2: dt.date | str | None = None) -> DataFrame:
    """Left join on the tax year.  ``default2`` stands in for an unknown second due date."""
    due = calendar.select(
        F.col("Year").alias("_year"), F.col("PmtDue1"), F.col("PmtDue2"),
    )
    if "_tax_year" in df.columns:
        raise ValueError("column _tax_year is reserved")
    out = df.join(small_side(due), as_int(F.col("TaxYear")) == F.col("_year"), "left").drop("_year")
    if default2 is not None:
        out = out.withColumn("PmtDue2", F.coalesce("PmtDue2", F.lit(str(default2)).cast("date")))
    return out


def flag_unpaid(df: DataFrame, paid_text: str = "LastPaymentDate2", out: str = "TaxSale") -> DataFrame:
    """1 when the instalment was never paid; taken from the raw text, before dates are parsed."""
    return df.withColumn(out, flag(F.col(paid_text) == UNPAID_TEXT))


def parse_paid_dates(df: DataFrame, numbers: tuple[int, ...] = (1, 2)) -> DataFrame:
    """``MMddyyyy`` text to dates; the unpaid mark and bad text give null."""
    names = [f"LastPaymentDate{n}" for n in numbers]
    return df.withColumns({c: parse_date(F.col(c), PAID_DATE_FORMAT) for c in names})


def missing_payment(
    df: DataFrame, policy: str, as_of: dt.date | str | None = None, numbers: tuple[int, ...] = (1, 2),
) -> DataFrame:
    """Decide what an unpaid instalment counts as, and mark it in ``BlankPmt<n>``.

    ``as_of``        paid on the given day
    ``always_late``  the same for day counts, and ``label_late`` is told to call it late
    ``due_plus_1``   paid one day after it was due
    ``null``         unknown (so never late)
    ``drop``         the row is removed
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if policy in ("as_of", "always_late") and as_of is None:
        raise ValueError(f"policy {policy!r} needs a date")
    paid = {n: F.col(f"LastPaymentDate{n}") for n in numbers}
    marks = {f"BlankPmt{n}": flag(paid[n].isNull()) for n in numbers}
    if policy == "drop":
        for n in numbers:
            df = df.where(paid[n].isNotNull())
        return df.withColumns(marks)
    if policy in ("as_of", "always_late"):
        stand_in = {n: F.lit(str(as_of)).cast("date") for n in numbers}
    elif policy == "due_plus_1":
        stand_in = {n: F.date_add(F.col(f"PmtDue{n}"), 1) for n in numbers}
    else:
        return df.withColumns(marks)
    filled = {f"LastPaymentDate{n}": F.coalesce(paid[n], stand_in[n]) for n in numbers}
    return df.withColumns({**marks, **filled})


def label_late(
    df: DataFrame, numbers: tuple[int, ...] = (1, 2), unpaid_is_late: bool = False,
) -> DataFrame:
    """``LatePmt<n>``: 1 when paid after the due date; an unknown date on either side gives 0.

    With ``unpaid_is_late`` an instalment marked in ``BlankPmt<n>`` is late
    whenever its due date is known, even if that day is still to come.
    """
    def late(n: int) -> Column:
        due = F.col(f"PmtDue{n}")
        after = F.col(f"LastPaymentDate{n}") > due
        if unpaid_is_late:
            after = after | ((F.col(f"BlankPmt{n}") == 1) & due.isNotNull())
        return flag(after)

    return df.withColumns({f"LatePmt{n}": late(n) for n in numbers})


def days_late(
    df: DataFrame, numbers: tuple[int, ...] = (1, 2), clip: tuple[int, ...] = (1,),
) -> DataFrame:
    """``DiffPmt<n>`` in whole days; early payments count 0 for the instalments in ``clip``."""
    def days(n: int) -> Column:
        raw = days_between(F.col(f"LastPaymentDate{n}"), F.col(f"PmtDue{n}"))
        return clip_low(raw) if n in clip else raw

    return df.withColumns({f"DiffPmt{n}": days(n) for n in numbers})


def label_bills(
    df: DataFrame, calendar: DataFrame, policy: str, as_of: dt.date | str | None = None,
    clip: tuple[int, ...] = (1,), default2: dt.date | str | None = None,
) -> DataFrame:
    """Calendar, policy, labels and day counts in the one order that is right."""
    out = parse_paid_dates(attach_due_dates(df, calendar, default2))
    out = missing_payment(out, policy, as_of)
    return days_late(label_late(out, unpaid_is_late=policy == "always_late"), clip=clip)


def cap_upper(df: DataFrame, column: str = "AdjustedAmountDue1", cap: float = AMOUNT_CAP) -> DataFrame:
    """Lower values above ``cap`` to it; null stays null."""
    return df.withColumn(column, F.when(F.col(column) > cap, F.lit(cap)).otherwise(F.col(column)))
