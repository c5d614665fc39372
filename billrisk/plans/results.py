"""What a model run gives back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from billrisk.operators import evaluate, model as forests
from billrisk.operators.profile import stage_counts
from billrisk.sources import save_model, write_scores


@dataclass
class BinaryResult:
    """A fitted late/not-late model with its scored test rows.

    ``scores`` is cached since every report reads it; ``close`` frees it.
    ``features`` are the columns, ``table`` holds them for all rows, and
    ``members`` says which of its rows train and which test.
    """

    model: PipelineModel
    scores: DataFrame
    features: list[str]
    table: DataFrame
    members: dict[str, Column]
    threshold_op: str = ">"
    score_digits: int | None = None
    label: str = "LatePmt2"
    held: list[DataFrame] = field(default_factory=list)

    def thresholds(self) -> DataFrame:
        return evaluate.threshold_metrics(
            self.scores, "probability", self.label, op=self.threshold_op, digits=self.score_digits,
        )

    def gain_lift(self) -> DataFrame:
        rows = self.scores
        if self.score_digits is not None:
            rows = rows.withColumn("probability", F.round("probability", self.score_digits))
        return evaluate.gain_lift(rows, "probability", self.label, ["PIN", "TaxYear"])

    def confusion(self, threshold: float = 0.5) -> DataFrame:
        said = (F.col("probability") > threshold).cast("int")
        return evaluate.confusion_counts(self.scores.withColumn("_said", said), self.label, "_said")

    def sizes(self) -> DataFrame:
        return stage_counts(self.table, {"features": F.lit(True), **self.members})

    def stage(self, name: str) -> DataFrame:
        """The rows of ``train`` or ``test``."""
        return self.table.where(self.members[name])

    def importance(self, k: int | None = None) -> DataFrame:
        return forests.feature_importance(self.model, k)

    def export(self, path: str, fmt: str = "csv", mode: str = "error") -> None:
        write_scores(self.scores, path, fmt, mode=mode)

    def save(self, path: str) -> None:
        save_model(self.model, path)

    def close(self) -> None:
        for df in self.held:
            df.unpersist()
        self.held.clear()
