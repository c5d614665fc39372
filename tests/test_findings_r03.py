"""Findings of the third round."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from billrisk.llm import line_dedup
from billrisk.llm.common import FrequencyClasses
from billrisk.operators import clean, encode, history, model as forests, quantiles
from suite import evaluation


@pytest.mark.parametrize("name, run, declared", [
    ("train_score_multiclass", "run_multiclass", forests.MULTICLASS), ("train_score_regressor", "run_days", forests.REGRESSOR)])
def test_deep_forests_learn_from_all_labelled_rows(monkeypatch, name, run, declared):
    class Asked(Exception):
        pass

    def asked(bills, calendar, settings):
        raise Asked(settings)

    monkeypatch.setattr(evaluation, run, asked)
    for view in ("bills", "due_dates"):
        monkeypatch.setattr(evaluation.V, view, lambda spark, d: None)
    with pytest.raises(Asked) as seen:
        getattr(evaluation, name)(None, "")
    forest = seen.value.args[0].forest
    assert forest == declared and forest.max_rows is None


def _alike_lines(rng, n, times):
    """Lines of n words and one as far away as the similarity allows, edits spread evenly, over the rarest words too."""
    out = []
    for _ in range(times):
        words = [f"w{min(int(rng.expovariate(0.02)), 2000)}" for _ in range(n)]
        other, places = list(words), sorted(rng.sample(range(n), n // 5), reverse=True)
        for at in places:
            kind = rng.randrange(3)
            if kind == 0:
                other[at] = f"new{rng.randrange(10 ** 6)}"
            elif kind == 1:
                other.insert(at, f"new{rng.randrange(10 ** 6)}")
            else:
                del other[at]
        out.append((words, other))
    return out


def test_all_alike_lines_share_a_block_key():
    rng = random.Random(8)
    pairs = [(a, b) for n in (5, 6, 9, 10, 14, 15, 20, 30, 60, 120, 250) for a, b in _alike_lines(rng, n, 40) if line_dedup.alike(a, b, 0.8)]
    pairs += [("a b c d".split(), "a b c d e".split()), ("a b c d".split(), "a x b c d".split()), (["a"] * 5, ["a"] * 4 + ["b"])]
    # the four rarest words of a line replaced: what is left shares common words only
    common, rare = [f"w{i % 7}" for i in range(16)], [f"rare{i}" for i in range(4)]
    pairs.append((common + rare, common + [f"other{i}" for i in range(4)]))
    texts = [" ".join(x) for pair in pairs for x in pair]
    words = line_dedup._words_of(texts)[0]
    cells = np.bincount(FrequencyClasses.cells(words).astype(np.int64), minlength=1 << FrequencyClasses.BITS)
    classes = FrequencyClasses(np.log2(cells + 1).astype(np.uint8))
    owner, *_, of, keys = line_dedup.hash_lines(texts, classes)
    sets = [set(keys[owner[of] == i].tolist()) for i in range(len(texts))]
    assert len(pairs) > 150 and all(sets[i] & sets[i + 1] for i in range(0, len(texts), 2))


def test_lines_as_far_apart_as_allowed_are_found(spark):
    rng = random.Random(9)
    pairs = [(a, b) for n in (5, 10, 20, 40) for a, b in _alike_lines(rng, n, 20) if line_dedup.alike(a, b, 0.8) and a != b]
    pairs += [("one two three four".split(), "one two three four five".split())]
    rows = [(i, " ".join(x)) for i, x in enumerate(x for pair in pairs for x in pair)]
    lines = [x for pair in pairs for x in pair]
    root = list(range(len(lines)))
    for _ in lines:
        again = [min([root[j] for j in range(len(lines)) if line_dedup.alike(lines[i], lines[j], 0.8)]) for i in range(len(lines))]
        if again == root:
            break
        root = again
    _, removed = line_dedup.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in removed.collect()} == {i for i in range(len(lines)) if root[i] != i}


@pytest.mark.parametrize("many", [False, True])
def test_history_of_large_accounts_makes_its_input_twice_at_most(spark, monkeypatch, many):
    if many:
        monkeypatch.setattr(history, "fetch_small", lambda df, *_: None)
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = [(f"p{i % 7}" if i % 7 else None, 1990 + i // 7 % 4, i % 2, (i // 3) % 2, i % 5 == 0) for i in range(70)]
    rows += [("one", 2000, 1, 1, True), ("one", None, 0, 1, False)]
    plain = spark.createDataFrame([(p, y, a, b, int(c)) for p, y, a, b, c in rows],
                                  "PIN string, TaxYear int, LatePmt1 int, LatePmt2 int, PastTaxSaleStatus int")
    plain = plain.groupBy("PIN", "TaxYear").agg(*[F.max(c).alias(c) for c in plain.columns[2:]])
    n = plain.count()
    counted = plain.mapInArrow(count, plain.schema)
    got = history.history_sums(counted, max_rows_per_key=3).collect()
    want = history.history_sums(plain, max_rows_per_key=None).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and n <= made.value <= 2 * n


def test_steps_over_many_columns_are_compiled(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    rows, before = spark.range(3).selectExpr("id", "if(id = 1, null, id) AS x"), spark.conf.get(key)
    try:
        for run in (lambda: clean.drop_incomplete(rows), lambda: quantiles.exact_percentiles_of(rows, ["id", "x"], [0.5])):
            for given, wanted in (("65535", 8000), ("4000", 4000)):
                spark.conf.set(key, given)
                run()
                assert int(spark.conf.get(key)) == wanted
    finally:
        spark.conf.set(key, before)
    assert clean.drop_incomplete(rows).count() == 2


def _counted(spark, rows):
    """The rows, and how often one of them was made."""
    made = spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    return rows.withColumn("x", F.udf(count, "double")("x")), made


def test_training_rows_are_made_once(spark):
    rows, made = _counted(spark, spark.range(200).selectExpr("double(id) AS x", "double(id % 7) AS z", "int(id > 90) AS y"))
    model = forests.train_classifier(rows, ["x", "z"], "y", forests.ForestSettings(trees=3, depth=3))
    assert made.value == 200
    assert len(model.stages) == 2 and not spark.sparkContext._jsc.getPersistentRDDs()


def test_rows_are_counted_once_for_a_large_table_of_weights(spark):
    plain = spark.range(300).selectExpr("double(id % 40) AS x", "int(id % 3 = 0) AS y")
    fitted_on, made = _counted(spark, plain)
    table = encode.fit_woe(fitted_on, ["x"], "y")
    got = encode.apply_woe(plain, table, ["x"], max_rows=5)
    assert made.value == 300
    want = encode.apply_woe(plain, encode.fit_woe(plain, ["x"], "y"), ["x"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert not table.is_cached


def test_shuffles_of_a_larger_input_begin_with_more_partitions(spark, tmp_path):
    """With a fixed number the rows that a task sorts grow with the input (F22)."""
    from suite import views

    key, before = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", spark.conf.get("spark.sql.shuffle.partitions")
    known = spark.conf.get(key, None)
    path = str(tmp_path / "rows.parquet")
    spark.range(2000).repartition(40).write.parquet(path)
    rows = spark.read.parquet(path)
    try:
        spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        views.finely_shuffled(spark, rows)
        assert int(spark.conf.get(key)) == 4 * rows.rdd.getNumPartitions() > 4
        spark.conf.set(key, "5000")
        views.finely_shuffled(spark, rows)
        assert spark.conf.get(key) == "5000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(key, known) if known else spark.conf.unset(key)


def test_ledger_by_account_gives_the_rows_of_the_plain_join_without_another_shuffle(spark):
    """Bills that a window has placed by account stay where they are (F21)."""
    from pyspark.sql import Window

    from billrisk.operators import lookups

    bills = spark.createDataFrame([("a", 2000, 1), ("a", 2000, 2), ("a", 2001, 3), ("b", 2000, 4), (None, 2000, 5), ("c", None, 6), ("d", 1999, 7)],
                                  "PIN string, TaxYear int, n int")
    ledger = spark.createDataFrame(
        [("a", 2000, "P1", "x", 1.5), ("a", 2000, "P1", "y", 2.0), ("a", 2001, "P1", "x", 1.0), ("a", 2002, "P1", "x", 1.0),
         ("b", 2001, "P1", "x", 3.0), (None, 2000, "P1", "x", 4.0), ("c", None, "P1", "x", 5.0), ("d", 1999, "P1", None, None)],
        "PIN string, TaxYear4 int, Payment string, SourceID string, TotalPaid double").withColumn("DatePaid", F.lit("2000-01-01").cast("date"))
    told = bills.withColumn("sum", F.sum("n").over(Window.partitionBy("PIN").orderBy("n")))
    plain = lookups.attach_ledger(told, lookups.ledger_rollup(ledger))
    known = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        moved = lookups.attach_ledger(told, lookups.ledger_rollup(ledger), by_account=True)
        assert moved.columns == plain.columns
        assert sorted(map(str, moved.collect())) == sorted(map(str, plain.collect()))
        by_year = [any("Exchange hashpartitioning(PIN" in line and "TaxYear#" in line and "Payment" not in line
                       for line in df._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[-1].splitlines()[:4])
                   for df in (plain, moved)]
        assert not by_year[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", known)
