"""The one-hot model, tested on one year after training on the years before it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from billrisk.functions import area_code, flag
from billrisk.operators import clean, encode, label, model as forests, split
from billrisk.plans.results import BinaryResult
from billrisk.schema import EXEMPTION_AMOUNTS, NO_CERTIFICATE_TEXT, NUMERIC_COLUMNS, ONE_HOT_VALUES

KEY, YEAR, LABEL = "PIN", "TaxYear", "LatePmt2"

# Columns without a place in this model, mostly too many categories.
LEFT_OUT = [
    "Volume", "Classification", "RefundStatus", "TaxCode", "TaxpayerPropertySuffix",
    "TaxpayerPropertyTown", "TaxpayerPropertyCity", "LastPaymentDate1", "LastPaymentDate2",
    "PmtDue1", "PmtDue2", "BlankPmt1", "BlankPmt2", "DiffPmt2",
]


@dataclass(frozen=True)
class BacktestSettings:
    """``policy="drop"`` removes rows without a second payment and keeps ``LatePmt1`` out."""

    test_year: int
    train_years: int | None = 3
    as_of: dt.date | str | None = None
    policy: str = "as_of"
    forest: forests.ForestSettings = forests.ForestSettings(trees=20, depth=5)


def one_hot_table(bills: DataFrame, calendar: DataFrame, settings: BacktestSettings) -> DataFrame:
    """One row per bill: key, year, label, amounts and about a hundred 0/1 columns."""
    typed = clean.cast_numeric(bills, [*NUMERIC_COLUMNS, *EXEMPTION_AMOUNTS])
    rows = typed.where(
        clean.valid_row() & clean.not_exempt() & clean.billed()
        & clean.not_agent(["LastPaymentSource1", "LastPaymentSource2"])
    )
    dated = label.parse_paid_dates(label.attach_due_dates(rows, calendar))
    if settings.policy == "drop":
        dated = label.missing_payment(dated, "drop", numbers=(2,))
        dated = label.missing_payment(dated, "null", numbers=(1,))
    else:
        dated = label.missing_payment(dated, settings.policy, settings.as_of)
    labelled = label.days_late(
        label.label_late(dated, unpaid_is_late=settings.policy == "always_late"), clip=(1, 2)
    )
    if settings.policy != "drop":
        labelled = clean.bound_days_late(labelled)
    values = dict(ONE_HOT_VALUES)
    if settings.policy == "drop":
        values.pop("LatePmt1")
        labelled = labelled.drop("LatePmt1", "DiffPmt1")
    capped = label.cap_upper(labelled)
    coded = capped.withColumns({
        "TaxpayerMailingState": flag(F.upper("TaxpayerMailingState") == "IL"),
        "CofENumber": flag(F.coalesce(F.col("CofENumber") != NO_CERTIFICATE_TEXT, F.lit(True))),
        "PastTaxSaleStatus": flag(F.col("PastTaxSaleStatus") == "Y"),
        "AreaFromPin": area_code(F.col(KEY)),
    })
    groups = ["instalment_2", "unrelated", "near_constant", "correlated"]
    kept = clean.drop_groups(coded, groups, keep=[*values, LABEL]).drop(*LEFT_OUT)
    return encode.one_hot(kept, {c: v for c, v in values.items() if c in kept.columns})


def run_backtest(bills: DataFrame, calendar: DataFrame, settings: BacktestSettings) -> BinaryResult:
    # Only numbers can be features, so leftover text columns go before caching.
    table = one_hot_table(bills, calendar, settings)
    features = forests.feature_columns(table, exclude=[KEY, YEAR, LABEL])
    table = clean.fill_zero(table.select(KEY, YEAR, LABEL, *features), features).persist()
    members = split.year_members(settings.test_year, settings.train_years)
    fitted = forests.train_classifier(table.where(members["train"]), features, LABEL, settings.forest)
    scores = forests.score(fitted, table.where(members["test"]), positive=True).select(
        KEY, YEAR, LABEL, "probability", F.col("prediction").cast("int").alias("prediction")
    ).persist()
    return BinaryResult(
        fitted, scores, features, table, members, held=[scores, table],
    )
