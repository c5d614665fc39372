"""End-to-end jobs."""

from billrisk.plans.backtest import BacktestSettings, one_hot_table, run_backtest
from billrisk.plans.classifier import ClassifierSettings, clean_bills, feature_table, run_classifier
from billrisk.plans.lateness import LatenessSettings, labelled_and_target, run_days, run_multiclass

__all__ = [
    "BacktestSettings", "ClassifierSettings", "LatenessSettings", "clean_bills", "feature_table",
    "labelled_and_target", "one_hot_table", "run_backtest", "run_classifier", "run_days",
    "run_multiclass",
]
