"""Will the second instalment be late?  From raw tables to scores and reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from billrisk.functions import as_int, flag
from billrisk.operators import clean, encode, history, label, lookups, model as forests, split
from billrisk.plans.results import BinaryResult
from billrisk.schema import COLUMN_GROUPS, EXEMPTION_AMOUNTS, NUMERIC_COLUMNS, WOE_COLUMNS

KEY, YEAR, LABEL = "PIN", "TaxYear", "LatePmt2"


@dataclass(frozen=True)
class ClassifierSettings:
    """``split="year"`` tests on ``current_year``; ``"random"`` keeps a share of all rows for it.

    ``woe_from="train"`` fits the category weights on training rows;
    ``"all"`` on every row, which leaks the test labels.  ``later_columns`` and
    ``later_positions`` (stretches of the bill file, the end exclusive) say which
    further columns are known only after the second instalment; they never
    become features, whatever their names.
    """

    current_year: int
    as_of: dt.date | str | None = None
    policy: str = "always_late"
    default_due2: dt.date | str | None = None
    split: str = "year"
    train_years: int | None = None
    train_share: float = 0.8
    seed: int = 100
    woe_from: str = "train"
    later_columns: tuple[str, ...] = ()
    later_positions: tuple[tuple[int, int], ...] = ()
    woe_columns: tuple[str, ...] = tuple(WOE_COLUMNS)
    forest: forests.ForestSettings = forests.CLASSIFIER
    threshold_op: str = ">"
    score_digits: int | None = 2
    max_rows_per_key: int | None = history.MAX_ROWS_PER_KEY


def clean_bills(bills: DataFrame, calendar: DataFrame, settings: ClassifierSettings) -> DataFrame:
    """Types, filters, labels and bounds; columns no later step needs are dropped.

    The row filters come first and on raw columns, so the scan can apply them.
    """
    typed = clean.cast_numeric(bills, [*NUMERIC_COLUMNS, *EXEMPTION_AMOUNTS])
    rows = typed.where(
        clean.valid_row() & clean.not_exempt() & clean.billed()
        & clean.not_agent(["LastPaymentSource1", "LastPaymentSource2"])
    )
    labelled = label.label_bills(
        rows, calendar, settings.policy, settings.as_of, clip=(1,), default2=settings.default_due2,
    )
    bounded = clean.bound_days_late(labelled)
    groups = ["instalment_2", "unrelated", "near_constant", "correlated", "low_importance"]
    later = clean.named_columns(bills, settings.later_columns, settings.later_positions)
    return clean.drop_groups(bounded, groups).drop(*[c for c in later if c not in (KEY, YEAR)])


def simple_features(df: DataFrame) -> DataFrame:
    """City, bill type and past sale as flags, the status as a number."""
    flags = {
        "TaxpayerPropertyCity": flag(F.trim("TaxpayerPropertyCity") == "CHICAGO"),
        "BillType": flag(F.col("BillType") == "1"),
        "TaxStatus": as_int(F.col("TaxStatus")),
        "PastTaxSaleStatus": flag(F.col("PastTaxSaleStatus") == "Y"),
    }
    return df.withColumns({name: expr for name, expr in flags.items() if name in df.columns})


def history_table(cleaned: DataFrame, ledger: DataFrame, settings: ClassifierSettings) -> DataFrame:
    """Flags, running history and ledger roll-up, before any value is learnt from the labels.

    History comes first: its search for large accounts then reads the cleaned
    bills only, without the join.
    """
    rows = simple_features(cleaned)
    # bills of one account and year are ordered by all their values, so that row-wise sums do not
    # depend on the partitioning; rows without a difference may stand in any order
    ties = [c for c in sorted(rows.columns) if c not in (KEY, YEAR)]
    told = history.history_sums(rows, tie_break=ties, max_rows_per_key=settings.max_rows_per_key)
    return lookups.attach_ledger(told, lookups.ledger_rollup(ledger), by_account=True)


def _train_rows(settings: ClassifierSettings):
    if settings.split == "random":
        return F.col("is_train") == 1
    year = as_int(F.col(YEAR))
    if settings.train_years is None:
        return year != settings.current_year
    return (year < settings.current_year) & (year >= settings.current_year - settings.train_years)


def feature_table(table: DataFrame, settings: ClassifierSettings) -> DataFrame:
    """Weights of evidence in place of the categories; every feature numeric and known."""
    if settings.split == "random":
        table = split.mark_random(table, KEY, settings.train_share, settings.seed)
    train = _train_rows(settings) if settings.woe_from == "train" else None
    columns = [c for c in settings.woe_columns if c in table.columns]
    encoded = encode.woe_encode(table, columns, LABEL, train)
    narrow = encoded.drop(*COLUMN_GROUPS["dates_and_marks"])
    return clean.fill_zero(clean.cast_strings_to_int(narrow, keep=(KEY,)))


def run_classifier(
    bills: DataFrame, calendar: DataFrame, ledger: DataFrame, settings: ClassifierSettings,
) -> BinaryResult:
    """Train on earlier years, score the current one.

    One table is cached: it is read to fit the weights, to train and to score.
    """
    table = history_table(clean_bills(bills, calendar, settings), ledger, settings).persist()
    ready = feature_table(table, settings)
    members = {"train": _train_rows(settings), "test": split.is_test_year(settings.current_year, YEAR)}
    if settings.split == "random":
        members["test"] = F.col("is_train") == 0
    features = forests.feature_columns(ready, exclude=[KEY, YEAR, LABEL, "is_train"])
    fitted = forests.train_classifier(ready.where(members["train"]), features, LABEL, settings.forest)
    scores = forests.score(fitted, ready.where(members["test"]), positive=True).select(
        KEY, YEAR, LABEL, "probability", F.col("prediction").cast("int").alias("prediction")
    ).persist()
    return BinaryResult(
        fitted, scores, features, ready, members,
        settings.threshold_op, settings.score_digits, LABEL, [scores, table],
    )
