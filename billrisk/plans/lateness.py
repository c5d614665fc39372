"""How late?  Ten lateness classes, or days, for bills late on both instalments."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from billrisk.functions import (
    area_code, as_int, binarize, flag, late_class, late_class_text, map_values, year_offset,
)
from billrisk.operators import clean, evaluate, label, model as forests, split
from billrisk.schema import BINARY_COLUMNS, FIRST_YEAR, NUMERIC_COLUMNS, EXEMPTION_AMOUNTS, SIDE_MODEL_COLUMNS

KEY, YEAR = "PIN", "TaxYear"

# Columns dropped because they repeat another amount, or are
# known only after the second instalment.
REDUNDANT = [
    "EqualizedEvaluation", "TaxAmountDue1", "TaxAmountDue2", "OriginalTaxDue2", "SeniorFreezeExempt",
    "LastPaymentSource2", "LastPaymentReceivedAmount2",
]
DATES = ["LastPaymentDate1", "LastPaymentDate2", "PmtDue1", "PmtDue2"]


@dataclass(frozen=True)
class LatenessSettings:
    target_year: int
    base_year: int = FIRST_YEAR
    train_share: float = 0.8
    seed: int = 42
    forest: forests.ForestSettings | None = None  # by default that of the job: MULTICLASS or REGRESSOR
    incomplete_scope: str = "projected"  # rows with a null are dropped by the kept columns, or by "all"


@dataclass
class LatenessResult:
    """``tested`` has actual and predicted values of the test rows, ``scored`` the target year."""

    model: PipelineModel
    tested: DataFrame
    scored: DataFrame
    features: list[str]
    held: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        for df in self.held:
            df.unpersist()
        self.held.clear()


def _prepare(bills: DataFrame, settings: LatenessSettings) -> DataFrame:
    columns = [c for c in SIDE_MODEL_COLUMNS if c in bills.columns]
    if settings.incomplete_scope not in ("projected", "all"):
        raise ValueError("incomplete_scope is 'projected' or 'all'")
    if settings.incomplete_scope == "all":
        bills = clean.drop_incomplete(bills)
    rows = clean.drop_incomplete(bills.select(YEAR, *columns))
    typed = clean.cast_numeric(rows, [*NUMERIC_COLUMNS, *EXEMPTION_AMOUNTS])
    return typed.where(
        clean.not_exempt() & clean.billed()
        & clean.not_agent(["LastPaymentSource2", "LastPaymentSource1"])
    ).withColumn("Location", area_code(F.col(KEY)))


def _numbers(df: DataFrame, settings: LatenessSettings) -> DataFrame:
    """Codes as numbers: flags, 0/1 exemptions, years since the base year."""
    coded = {
        "PastTaxSaleStatus": map_values(F.col("PastTaxSaleStatus"), {"Y": 1, "N": 0}),
        "CofENumber": flag(F.col("CofENumber").try_cast("double") != 0),
        "BillYear": year_offset(as_int(F.col("BillYear")), settings.base_year),
    }
    coded.update({c: binarize(as_int(F.col(c))) for c in BINARY_COLUMNS})
    present = {name: expr for name, expr in coded.items() if name in df.columns}
    return clean.cast_strings_to_int(df.withColumns(present).drop(*REDUNDANT, *DATES), keep=(KEY,))


def labelled_and_target(
    bills: DataFrame, calendar: DataFrame, settings: LatenessSettings,
) -> tuple[DataFrame, DataFrame]:
    """(earlier years late on both instalments, target year late on the first)."""
    rows = _prepare(bills, settings)
    dated = label.parse_paid_dates(label.attach_due_dates(rows, calendar))
    days = label.days_late(dated, clip=())
    year = as_int(F.col(YEAR))
    paid1, paid2 = F.col("LastPaymentDate1").isNotNull(), F.col("LastPaymentDate2").isNotNull()
    first = F.col("DiffPmt1")
    known = days.where((year < settings.target_year) & paid1 & paid2 & clean.within_days(lower=1))
    target = days.where(
        (year == settings.target_year) & paid1 & (first > 0) & (first < clean.MAX_DAYS_LATE_1)
    ).drop("DiffPmt2")
    labelled = _numbers(known, settings).withColumn("LateLabel", late_class(F.col("DiffPmt2")))
    return labelled, _numbers(target, settings)


def _run(bills, calendar, settings, label_column, stratify, train, forest) -> LatenessResult:
    labelled, target = labelled_and_target(bills, calendar, settings)
    features = forests.feature_columns(labelled, exclude=[KEY, YEAR, "DiffPmt2", "LateLabel"])
    # The split is drawn by account, year and a hash of the row, so that bills
    # of one account and year have an order of their own.  It reads its input
    # more than once, so the narrow feature table is cached.
    bill = F.concat_ws("#", KEY, YEAR, F.xxhash64(*sorted(labelled.columns))).alias("_bill")
    wanted = dict.fromkeys([KEY, *features, label_column, stratify])
    table = clean.fill_zero(labelled.select(bill, *wanted), features).persist()
    marked = split.mark_stratified(table, stratify, "_bill", settings.train_share, settings.seed)
    train_rows, test_rows = split.parts(marked)
    fitted = train(train_rows, features, label_column, settings.forest or forest)
    tested = forests.score(fitted, test_rows).select(
        KEY, F.col(label_column).cast("double").alias("actual"), F.col("prediction").alias("predicted")
    ).persist()
    scored = forests.score(fitted, clean.fill_zero(target, features))
    return LatenessResult(fitted, tested, scored, features, [tested, table])


def run_multiclass(bills: DataFrame, calendar: DataFrame, settings: LatenessSettings) -> LatenessResult:
    """Class forest; target rows get the class and its text."""
    result = _run(bills, calendar, settings, "LateLabel", "LateLabel", forests.train_classifier, forests.MULTICLASS)
    late = F.col("prediction").cast("int")
    result.scored = result.scored.select(
        KEY, late.alias("PredictionClassLabel"), late_class_text(late).alias("PredictionResult")
    )
    return result


def run_days(bills: DataFrame, calendar: DataFrame, settings: LatenessSettings) -> LatenessResult:
    """Day forest; target rows get the predicted days late."""
    result = _run(bills, calendar, settings, "DiffPmt2", "DiffPmt2", forests.train_regressor, forests.REGRESSOR)
    result.scored = result.scored.select(KEY, F.col("prediction").alias("PredictionDaysLate"))
    return result


def confusion_reports(result: LatenessResult) -> tuple[DataFrame, DataFrame]:
    """Counts and shares per class pair, and the overall accuracy."""
    return evaluate.confusion_normalized(result.tested), evaluate.accuracy(result.tested)
