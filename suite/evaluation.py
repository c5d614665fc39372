"""Splits, measures, models and sinks."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from billrisk.functions import row_hash
from billrisk.operators import evaluate, model as forests, split
from billrisk.plans import (
    BacktestSettings, ClassifierSettings, LatenessSettings, run_backtest, run_classifier, run_days,
    run_multiclass,
)
from billrisk.schema import LATE_CLASS_EDGES, LATE_CLASS_TEXT, THRESHOLDS, WOE_COLUMNS
from billrisk.session import scratch_path
from billrisk.sources import load_model, save_model, write_scores
from suite import views as V
from suite.registry import query

# ------------------------------------------------------------------ splits


@query("split_by_year", V.with_views("bills") + f"""
SELECT CASE WHEN "TaxYear" = {V.TEST_YEAR} THEN 'test' ELSE 'train' END AS part, "TaxYear", count(*) AS n
FROM bills GROUP BY 1, 2
UNION ALL
SELECT 'train3', "TaxYear", count(*) FROM bills
WHERE "TaxYear" BETWEEN {V.TEST_YEAR - 3} AND {V.TEST_YEAR - 1} GROUP BY 1, 2""")
def split_by_year(spark, d):
    bills = V.bills(spark, d).select("TaxYear")
    train, test = split.split_by_year(bills, V.TEST_YEAR)
    train3, _ = split.split_by_year(bills, V.TEST_YEAR, n_years=3)
    parts = [(train, "train"), (test, "test"), (train3, "train3")]
    frames = [df.withColumn("part", F.lit(name)) for df, name in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).groupBy("part", "TaxYear").agg(
        F.count(F.lit(1)).alias("n"))


def _hash_sql(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '#{seed}'), 1, 15) AS BIGINT)"


@query("split_random", V.with_views("scored") + f"""
SELECT "RowKey", CASE WHEN {_hash_sql('"RowKey"', 100)} < {int(0.8 * (1 << 60))} THEN 1 ELSE 0 END AS is_train
FROM scored""")
def split_random(spark, d):
    return split.mark_random(V.scored(spark, d).select("RowKey"), "RowKey")


def _stratified_sql(label: str) -> str:
    return V.with_views("scored") + f"""
SELECT "RowKey", {label},
  CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY {_hash_sql('"RowKey"', 42)}, "RowKey")
            <= ceil(count(*) OVER (PARTITION BY {label}) * CAST(0.8 AS DOUBLE)) THEN 1 ELSE 0 END AS is_train
FROM scored"""


@query("split_stratified", _stratified_sql("true_class"))
def split_stratified(spark, d):
    return split.mark_stratified(V.scored(spark, d).select("RowKey", "true_class"), "true_class", "RowKey")


@query("split_stratified_days", _stratified_sql("true_days"))
def split_stratified_days(spark, d):
    """A label with hundreds of values."""
    return split.mark_stratified(V.scored(spark, d).select("RowKey", "true_days"), "true_days", "RowKey")


# ---------------------------------------------------------------- measures


def _threshold_sql(op: str, views: str = V.with_views("scored")) -> str:
    values = ", ".join(f"(CAST({t} AS DOUBLE))" for t in THRESHOLDS)
    return views + f"""
, counts AS (
SELECT t AS "Threshold", count(*) AS n, CAST(sum(label) AS BIGINT) AS pos,
       count(*) FILTER (WHERE score {op} t AND label = 1) AS tp, count(*) FILTER (WHERE score {op} t) AS pp
FROM scored, (VALUES {values}) v(t) GROUP BY t)
SELECT "Threshold", (tp + (n - pos - (pp - tp))) / CAST(n AS DOUBLE) AS "Acc",
       coalesce(CAST(2 * tp AS DOUBLE) / nullif(pp + pos, 0), 0) AS "F1",
       coalesce(CAST(tp AS DOUBLE) / nullif(pos, 0), 0) AS "Rec",
       coalesce(CAST(tp AS DOUBLE) / nullif(pp, 0), 0) AS "Prec"
FROM counts"""


@query("threshold_metrics", _threshold_sql(">"))
def threshold_metrics(spark, d):
    return evaluate.threshold_metrics(V.scored(spark, d), "score", "label", digits=2)


@query("threshold_metrics_inclusive", _threshold_sql(">="))
def threshold_metrics_inclusive(spark, d):
    return evaluate.threshold_metrics(V.scored(spark, d), "score", "label", op=">=")


@query("confusion", V.with_views("scored") + """
SELECT true_class AS actual, pred_class AS predicted, count(*) AS n FROM scored GROUP BY 1, 2""")
def confusion(spark, d):
    return evaluate.confusion(V.scored(spark, d), "true_class", "pred_class")


@query("confusion_counts", V.with_views("scored") + """
SELECT count(*) FILTER (WHERE label = 0 AND score <= 0.5) AS tn, count(*) FILTER (WHERE label = 0 AND score > 0.5) AS fp,
       count(*) FILTER (WHERE label = 1 AND score <= 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp
FROM scored""")
def confusion_counts(spark, d):
    said = V.scored(spark, d).withColumn("said", (F.col("score") > 0.5).cast("int"))
    return evaluate.confusion_counts(said, "label", "said")


@query("confusion_matrix", V.with_views("scored") + "SELECT true_class AS actual, " + ", ".join(
    f"count(*) FILTER (WHERE pred_class = {c}) AS p{c}" for c in range(1, 11)) + " FROM scored GROUP BY 1")
def confusion_matrix(spark, d):
    return evaluate.confusion_matrix(V.scored(spark, d), range(1, 11), "true_class", "pred_class")


@query("confusion_normalized", V.with_views("scored") + """
, c AS (SELECT true_class AS actual, pred_class AS predicted, count(*) AS n FROM scored GROUP BY 1, 2)
SELECT actual, predicted, n, n * CAST(1.0 AS DOUBLE) / sum(n) OVER (PARTITION BY actual) AS recall_share,
       n * CAST(1.0 AS DOUBLE) / sum(n) OVER (PARTITION BY predicted) AS precision_share FROM c""")
def confusion_normalized(spark, d):
    return evaluate.confusion_normalized(V.scored(spark, d), "true_class", "pred_class")


@query("accuracy", V.with_views("scored") + """
SELECT sum(CASE WHEN true_class = pred_class THEN 1 ELSE 0 END) * CAST(1.0 AS DOUBLE) / count(*) AS accuracy FROM scored""")
def accuracy(spark, d):
    return evaluate.accuracy(V.scored(spark, d), "true_class", "pred_class")


def _deciles(views: str, order: str) -> str:
    return views + f"""
, ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, {order}) AS r, count(*) OVER () AS n FROM scored),
deciles AS (SELECT *, CAST(greatest(1, ceil((r - 1) * 10 / CAST(n - 1 AS DOUBLE))) AS INTEGER) AS "DecileRank" FROM ranked)
"""


DECILES = _deciles(V.with_views("scored"), '"RowKey"')


@query("decile_rank", DECILES + """SELECT "RowKey", score, "DecileRank" FROM deciles""")
def decile_rank(spark, d):
    return evaluate.assign_decile(V.scored(spark, d).select("RowKey", "score"), "score", "RowKey")


GAIN = """
, g AS (SELECT "DecileRank", count(*) AS n, CAST(sum(label) AS BIGINT) AS late FROM deciles GROUP BY 1),
t AS (SELECT *, sum(late) OVER (ORDER BY "DecileRank") AS running, sum(late) OVER () AS all_late,
             sum(n) OVER () AS all_n FROM g)
SELECT "DecileRank", n AS "DecileN", late AS "GainN", CAST(running AS BIGINT) AS "CumulativeGainN",
       round(late * CAST(100.0 AS DOUBLE) / n, 3) AS "Late%ByDecile",
       round(late * CAST(100.0 AS DOUBLE) / all_late, 3) AS "GainN%",
       round(running * CAST(100.0 AS DOUBLE) / all_late, 3) AS "CumulativeGain%",
       round((late * CAST(100.0 AS DOUBLE) / n) / (all_late * CAST(100.0 AS DOUBLE) / all_n), 3) AS "Lift"
FROM t"""


@query("gain_lift", DECILES + GAIN)
def gain_lift(spark, d):
    return evaluate.gain_lift(V.scored(spark, d), "score", "label", "RowKey")


@query("regression_report", V.with_views("scored") + """
, m AS (SELECT count(*) AS n, sum((true_days - pred_days) ** 2) AS ssr, var_pop(true_days) * count(*) AS tss,
               avg(abs(true_days - pred_days)) AS mae, avg(abs((true_days - pred_days) / true_days)) * 100 AS mape
        FROM scored)
SELECT n, round(ssr, 2) AS ssr, round(tss, 2) AS tss, round((1 - ssr / tss) * 100, 6) AS r2_pct,
       round(mae, 6) AS mae, round(mape, 6) AS mape_pct FROM m""")
def regression_report(spark, d):
    return evaluate.regression_report(V.scored(spark, d), "true_days", "pred_days")


@query("error_by_true", V.with_views("scored") + """
SELECT true_days AS actual, count(*) AS n, round(avg(abs(true_days - pred_days)), 6) AS mean_abs_error
FROM scored GROUP BY 1""")
def error_by_true(spark, d):
    return evaluate.error_by_true(V.scored(spark, d), "true_days", "pred_days")


# ------------------------------------------------------------------ models
# Two kinds of queries.  The first train forests of the declared size on the
# bills and compare which rows get scored, and that each carries its own label.
# The second know what a forest has to say: in their bills the second payment
# follows one column alone, all trees may look at every column, and bins are as
# fine as the values, so that each leaf is pure and SQL can predict every row.

_CLEAN = """"SegmentCode" = 'PH' AND CAST("TaxStatus" AS INTEGER) <> 1
  AND ("AdjustedAmountDue1" <> 0 OR "AdjustedTaxDue2" <> 0)
  AND "LastPaymentSource1" NOT IN ('527', '600', '800', '802', '830')
  AND "LastPaymentSource2" NOT IN ('527', '600', '800', '802', '830')
  AND "DiffPmt2" < 500 AND "DiffPmt1" < 680"""
CLASSIFIER = ClassifierSettings(current_year=V.TEST_YEAR, as_of=V.AS_OF, policy="as_of")


@query("train_score_classifier", V.with_views("labelled") + f"""
SELECT "PIN", "TaxYear", "LatePmt2", 1 AS in_range, 1 AS consistent FROM labelled
WHERE {_CLEAN} AND "TaxYear" = {V.TEST_YEAR}""")
def train_score_classifier(spark, d):
    """Every test row is scored once, next to its own label."""
    p = F.col("probability")
    result = run_classifier(V.bills(spark, d), V.due_dates(spark, d), V.ledger(spark, d), CLASSIFIER)
    return result.scores.select(
        "PIN", "TaxYear", "LatePmt2", p.between(0, 1).cast("int").alias("in_range"),
        ((p > 0.5) == (F.col("prediction") == 1)).cast("int").alias("consistent"),
    )


@query("first_model", V.with_views("labelled") + f"""
SELECT "PIN", "TaxYear", "LatePmt2" FROM labelled WHERE {_CLEAN} AND "TaxYear" = {V.TEST_YEAR}""")
def first_model(spark, d):
    """The first model: a hundred shallow trees, category weights from all rows."""
    settings = dataclasses.replace(CLASSIFIER, forest=forests.FIRST_MODEL, woe_from="all")
    result = run_classifier(V.bills(spark, d), V.due_dates(spark, d), V.ledger(spark, d), settings)
    return result.scores.select("PIN", "TaxYear", "LatePmt2")


@query("backtest_score", V.with_views("labelled") + f"""
SELECT "PIN", "TaxYear", "LatePmt2" FROM labelled WHERE {_CLEAN} AND "TaxYear" = {V.TEST_YEAR}""")
def backtest_score(spark, d):
    settings = BacktestSettings(test_year=V.TEST_YEAR, as_of=V.AS_OF)
    return run_backtest(V.bills(spark, d), V.due_dates(spark, d), settings).scores.select("PIN", "TaxYear", "LatePmt2")


_KNOWN = """CAST("TaxStatus" AS INTEGER) <> 1 AND ("AdjustedAmountDue1" <> 0 OR "AdjustedTaxDue2" <> 0)
  AND "LastPaymentSource1" NOT IN ('527', '600', '800', '802', '830')
  AND "LastPaymentSource2" NOT IN ('527', '600', '800', '802', '830')
  AND "LastPaymentReceivedAmount2" IS NOT NULL AND "LongtimeHomeownersExemptAmount" IS NOT NULL"""
_TARGET_SQL = V.with_views("dated") + f"""
SELECT "PIN", count(*) AS n FROM dated
WHERE {_KNOWN} AND "TaxYear" = {V.TEST_YEAR}
  AND "LastPaymentDate1" - "PmtDue1" > 0 AND "LastPaymentDate1" - "PmtDue1" < 680
GROUP BY "PIN\""""


def _lateness(forest) -> LatenessSettings:
    return LatenessSettings(target_year=V.TEST_YEAR, base_year=1996, forest=forest)


@query("train_score_multiclass", _TARGET_SQL)
def train_score_multiclass(spark, d):
    """Target rows with a class between 1 and 10 and its text, per account; 700 trees of depth 26 on all labelled rows."""
    settings = _lateness(forests.MULTICLASS)
    scored = run_multiclass(V.bills(spark, d), V.due_dates(spark, d), settings).scored
    valid = scored.where(F.col("PredictionClassLabel").between(1, 10) & F.col("PredictionResult").isNotNull())
    return valid.groupBy("PIN").agg(F.count(F.lit(1)).alias("n"))


@query("train_score_regressor", _TARGET_SQL)
def train_score_regressor(spark, d):
    """Target rows with predicted days inside the range of the training labels, per account; 200 trees of depth 26, all labelled rows."""
    settings = _lateness(forests.REGRESSOR)
    scored = run_days(V.bills(spark, d), V.due_dates(spark, d), settings).scored
    valid = scored.where(F.col("PredictionDaysLate").between(1, 499))
    return valid.groupBy("PIN").agg(F.count(F.lit(1)).alias("n"))


# -- forests that SQL can predict

_PURE = forests.ForestSettings(trees=20, depth=8, bins=64, subset="all")
_ODD_RATE = 0.045


def _planted(spark, d, turned):
    """Late on the second instalment exactly if ExemptStatus is 2, or the reverse where ``turned`` holds."""
    bills = V.bills(spark, d)
    due = F.make_date("TaxYear", F.lit(8), F.lit(1))
    paid = F.when((F.col("ExemptStatus") == "2") != turned, F.date_add(due, 30)).otherwise(F.date_sub(due, 10))
    return bills.withColumn("LastPaymentDate2", F.date_format(paid, "MMddyyyy"))


def _planted_sql(turned: str) -> str:
    return f"""strftime(CAST(make_date("TaxYear", 8, 1) + CASE WHEN ("ExemptStatus" = '2') <> ({turned}) THEN 30 ELSE -10 END AS DATE),
                     '%m%d%Y') AS "LastPaymentDate2\""""


# In the test year a part of the rows do not follow the rule, so predictions are partly wrong.
_TURNED_SQL = f'("TaxYear" = {V.TEST_YEAR} AND "TaxRate" > {_ODD_RATE})'
_PLANTED_VIEWS = V.with_views("labelled", replace=_planted_sql(_TURNED_SQL))
_SCORED = f"""
, scored AS (SELECT "PIN", "TaxYear", "LatePmt2" AS label, CASE WHEN "ExemptStatus" = '2' THEN 1.0::DOUBLE ELSE 0.0 END AS score
             FROM labelled WHERE {_CLEAN} AND "TaxYear" = {V.TEST_YEAR})"""


def _turned():
    return (F.col("TaxYear") == V.TEST_YEAR) & (F.col("TaxRate") > _ODD_RATE)


def _planted_classifier(spark, d):
    settings = dataclasses.replace(CLASSIFIER, forest=_PURE)
    return run_classifier(_planted(spark, d, _turned()), V.due_dates(spark, d), V.ledger(spark, d), settings)


@query("classifier_scores", _PLANTED_VIEWS + _SCORED + 'SELECT "PIN", "TaxYear", label AS "LatePmt2", score AS probability, score::INTEGER AS prediction FROM scored')
def classifier_scores(spark, d):
    """The probability of every test row."""
    return _planted_classifier(spark, d).scores


@query("classifier_thresholds", _threshold_sql(">", _PLANTED_VIEWS + _SCORED))
def classifier_thresholds(spark, d):
    return _planted_classifier(spark, d).thresholds()


@query("classifier_gain_lift", _deciles(_PLANTED_VIEWS + _SCORED, '"PIN", "TaxYear", label') + GAIN)
def classifier_gain_lift(spark, d):
    return _planted_classifier(spark, d).gain_lift()


@query("classifier_sizes", _PLANTED_VIEWS + f"""
, kept AS (SELECT * FROM labelled WHERE {_CLEAN})
SELECT 1 AS step, 'features' AS stage, count(*) AS "rows", 30 AS "columns" FROM kept
UNION ALL SELECT 2, 'train', count(*), 30 FROM kept WHERE "TaxYear" <> {V.TEST_YEAR}
UNION ALL SELECT 3, 'test', count(*), 30 FROM kept WHERE "TaxYear" = {V.TEST_YEAR}""")
def classifier_sizes(spark, d):
    """Rows and columns of the stages of a run."""
    return _planted_classifier(spark, d).sizes()


FEATURES = ["AdjustedAmountDue1", "BillType", "CostAmountDue1", "DiffPmt1", "ExemptStatus", "HomeownerExempt", "HomeownerExemptAmount",
            "LatePmt1", "LatePmt1Sum", "LatePmt2Sum", "LongtimeHomeownersExemptAmount", "PastTaxSaleStatus", "PastTaxSaleStatusSum",
            "PaymentCnt", "SeniorExempt", "SeniorFreezeExemptAmount", "SourceIDCnt", "TaxAmountDue1", "TaxCode", "TaxRate",
            "TaxpayerPropertyCity", *[f"WOE_{c}" for c in WOE_COLUMNS]]


@query("feature_importance", " UNION ALL ".join(
    f"""SELECT '{c}' AS "Features", CAST({1 if c == 'ExemptStatus' else 0} AS DOUBLE) AS "Importance\"""" for c in FEATURES))
def feature_importance(spark, d):
    return _planted_classifier(spark, d).importance()


@query("top_importances", """
SELECT 'ExemptStatus' AS "Features", CAST(1 AS DOUBLE) AS "Importance" UNION ALL
SELECT 'AdjustedAmountDue1', 0 UNION ALL SELECT 'BillType', 0""")
def top_importances(spark, d):
    """The three most important features; equal ones in the order of their names."""
    return _planted_classifier(spark, d).importance(3)


_PICKED_SQL = f"""({_hash_sql('"PIN"', 100)} >= {int(0.8 * (1 << 60))})"""


@query("classifier_random_split", _threshold_sql(">=", V.with_views("dated", replace=_planted_sql(
    f'({_PICKED_SQL} AND "TaxRate" > {_ODD_RATE})')) + f"""
, due AS (SELECT * REPLACE (coalesce("PmtDue2", DATE '2001-08-03') AS "PmtDue2",
                            coalesce("LastPaymentDate1", "PmtDue1" + 1) AS "LastPaymentDate1") FROM dated),
days AS (SELECT *, "LastPaymentDate2" - "PmtDue2" AS "DiffPmt2", "LastPaymentDate1" - "PmtDue1" AS "DiffPmt1" FROM due),
scored AS (SELECT CASE WHEN "LastPaymentDate2" > "PmtDue2" THEN 1 ELSE 0 END AS label,
                  CASE WHEN "ExemptStatus" = '2' THEN 1.0::DOUBLE ELSE 0.0 END AS score
           FROM days WHERE {_CLEAN} AND {_PICKED_SQL})"""))
def classifier_random_split(spark, d):
    """Due date + 1 day for unpaid rows, random test rows, inclusive thresholds."""
    settings = ClassifierSettings(
        current_year=V.TEST_YEAR, policy="due_plus_1", default_due2="2001-08-03", split="random",
        forest=_PURE, threshold_op=">=", score_digits=None,
    )
    turned = (row_hash(F.col("PIN"), 100) >= int(0.8 * (1 << 60))) & (F.col("TaxRate") > _ODD_RATE)
    result = run_classifier(_planted(spark, d, turned), V.due_dates(spark, d), V.ledger(spark, d), settings)
    return result.thresholds()


@query("backtest_thresholds", _threshold_sql(">", _PLANTED_VIEWS + f"""
, scored AS (SELECT "LatePmt2" AS label, CASE WHEN "ExemptStatus" = '2' THEN 1.0::DOUBLE ELSE 0.0 END AS score
             FROM labelled WHERE {_CLEAN.partition('AND "DiffPmt2"')[0]} AND "TaxYear" = {V.TEST_YEAR})"""))
def backtest_thresholds(spark, d):
    """Rows without a second payment left out; all other years for training."""
    settings = BacktestSettings(test_year=V.TEST_YEAR, as_of=V.AS_OF, policy="drop", train_years=None, forest=_PURE)
    return run_backtest(_planted(spark, d, _turned()), V.due_dates(spark, d), settings).thresholds()


# The days late follow the amount of the costs: nine days more with each unit.
_DAYS_SQL = """strftime(CAST(make_date("TaxYear", 8, 1) + CAST("CostAmountDue1" * 9 - 8 AS INTEGER) AS DATE), '%m%d%Y') AS "LastPaymentDate2",
               strftime(CAST(make_date("TaxYear", 3, 1) + CAST("CostAmountDue1" % 7 + 1 AS INTEGER) AS DATE), '%m%d%Y') AS "LastPaymentDate1\""""
_DEEP = forests.ForestSettings(trees=20, depth=26, bins=64, subset="all", cache_nodes=True)


def _planted_days(spark, d):
    def after(month, days):
        return F.date_format(F.date_add(F.make_date("TaxYear", F.lit(month), F.lit(1)), days.cast("int")), "MMddyyyy")

    cost = F.col("CostAmountDue1")
    return V.bills(spark, d).withColumns({"LastPaymentDate2": after(8, cost * 9 - 8), "LastPaymentDate1": after(3, cost % 7 + 1)})


_DAYS = V.with_views("dated", replace=_DAYS_SQL) + f"""
, days AS (SELECT *, CAST("CostAmountDue1" * 9 - 8 AS INTEGER) AS d FROM dated WHERE {_KNOWN} AND "PmtDue1" IS NOT NULL),
classed AS (SELECT *, CASE {' '.join(f'WHEN d <= {edge} THEN {i}' for i, edge in enumerate(LATE_CLASS_EDGES, 1))} ELSE 10 END AS c FROM days)
"""


@query("multiclass_confusion", _DAYS + f"""
, tested AS (SELECT c, count(*) - CAST(ceil(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n FROM classed WHERE "TaxYear" < {V.TEST_YEAR} GROUP BY c)
SELECT c::DOUBLE AS actual, c::DOUBLE AS predicted, n, 1.0::DOUBLE AS recall_share, 1.0::DOUBLE AS precision_share FROM tested WHERE n > 0""")
def multiclass_confusion(spark, d):
    """A forest that knows the rule makes no mistake: as many rows per class as the split left for testing."""
    forest = dataclasses.replace(_DEEP, impurity="entropy")
    tested = run_multiclass(_planted_days(spark, d), V.due_dates(spark, d), _lateness(forest)).tested
    return evaluate.confusion_normalized(tested)


@query("multiclass_scores", _DAYS + f"""
SELECT "PIN", c AS "PredictionClassLabel", CASE c {' '.join(f"WHEN {k} THEN '{t}'" for k, t in LATE_CLASS_TEXT.items())} END AS "PredictionResult"
FROM classed WHERE "TaxYear" = {V.TEST_YEAR}""")
def multiclass_scores(spark, d):
    """The class of every target row, and its text."""
    forest = dataclasses.replace(_DEEP, impurity="entropy")
    return run_multiclass(_planted_days(spark, d), V.due_dates(spark, d), _lateness(forest)).scored


@query("days_report", _DAYS + f"""
, tested AS (SELECT d, count(*) - CAST(ceil(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n FROM days WHERE "TaxYear" < {V.TEST_YEAR} GROUP BY d)
SELECT sum(n)::BIGINT AS n, 0.0::DOUBLE AS ssr, round(sum(n * d * d) - CAST(sum(n * d) AS DOUBLE) * sum(n * d) / sum(n), 2) AS tss,
       100.0::DOUBLE AS r2_pct, 0.0::DOUBLE AS mae, 0.0::DOUBLE AS mape_pct FROM tested""")
def days_report(spark, d):
    """Days predicted exactly: no error, and the spread of the test rows."""
    tested = run_days(_planted_days(spark, d), V.due_dates(spark, d), _lateness(_DEEP)).tested
    return evaluate.regression_report(tested)


@query("days_scores", _DAYS + f"""SELECT "PIN", d::DOUBLE AS "PredictionDaysLate" FROM days WHERE "TaxYear" = {V.TEST_YEAR}""")
def days_scores(spark, d):
    """The predicted days of every target row."""
    return run_days(_planted_days(spark, d), V.due_dates(spark, d), _lateness(_DEEP)).scored


# ------------------------------------------------------------------- sinks


@query("write_scores_roundtrip", V.with_views("scored") + """
SELECT CAST("RowKey" AS VARCHAR) AS "PIN", CAST(score AS VARCHAR) AS probability, CAST(pred_class AS VARCHAR) AS prediction
FROM scored""")
def write_scores_roundtrip(spark, d):
    path = scratch_path(spark, "scores")
    scores = V.scored(spark, d).select(
        F.col("RowKey").alias("PIN"), F.col("score").alias("probability"), F.col("pred_class").alias("prediction")
    )
    write_scores(scores, path, sep="|")
    return spark.read.option("header", True).option("sep", "|").csv(path)


@query("model_roundtrip", V.with_views("scored") + 'SELECT "RowKey", 1 AS same FROM scored')
def model_roundtrip(spark, d):
    """A saved and reloaded model gives the same probabilities."""
    rows = V.scored(spark, d).withColumn("TaxYear", F.col("TaxYear").cast("double"))
    fitted = forests.train_classifier(rows, ["score", "true_days", "pred_days", "true_class", "pred_class", "TaxYear"], "label")
    path = scratch_path(spark, "model")
    save_model(fitted, path)
    first = forests.score(fitted, rows, positive=True).withColumnRenamed("probability", "p1").drop("prediction")
    both = forests.score(load_model(path), first, positive=True)
    return both.select("RowKey", (F.col("p1") == F.col("probability")).cast("int").alias("same"))
