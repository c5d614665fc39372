"""Correlation states, percentiles, frequent values, distinct sketches, split joins, loads, rejects and scratch."""

import csv
import gzip
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from billrisk import sources
from billrisk.operators import correlation, distinct, encode, frequent, model as forests, profile, quantiles
from billrisk.schema import LEDGER_COLUMNS, text_schema
from billrisk.session import free, materialize, scratch, shared_dir, written

# ------------------------------------------------------------- correlation


def test_pairwise_correlations_are_those_of_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e9, 5, (400, 6))
    x[:, 1] = x[:, 0] * 2 + rng.normal(0, 3, 400)
    x[:, 2] = 7.5  # constant
    rows = [[None if rng.random() < 0.2 else float(v) for v in row] for row in x]
    rows[0][3], rows[1][3] = float("nan"), float("inf")
    names = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.a, r.b): r.r for r in correlation.pairwise_correlations(df, names).collect()}
    assert len(got) == 36
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None and math.isfinite(r[i]) and math.isfinite(r[j])]
            if i == j:
                assert got[a, b] == 1.0
            elif 2 in (i, j):
                assert got[a, b] is None
            else:
                assert abs(got[a, b] - np.corrcoef(np.array(both).T)[0, 1]) < 2e-6


def test_correlations_of_few_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    for few in (df, df.where("false")):
        assert {(r.a, r.b): r.r for r in profile.correlation_matrix(few).collect()} == \
            {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}


def test_the_plan_does_not_grow_with_the_columns(spark):
    wide = spark.range(50).select(*[(F.col("id") * (i + 1) % 17).cast("double").alias(f"c{i}") for i in range(200)])
    table = correlation.co_moments(wide, wide.columns)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert table.count() == 200 * 199 // 2 and plan.count("\n") < 12


# ------------------------------------------------------------- percentiles


def test_percentiles_of_many_columns(spark):
    rng = np.random.default_rng(2)
    n = 3000
    columns = {
        "even": rng.permutation(n).astype(float), "heavy": np.where(rng.random(n) < 0.97, 5.0, rng.normal(0, 100, n)),
        "few": rng.integers(0, 3, n).astype(float), "skewed": np.exp(rng.normal(0, 3, n)),
    }
    rows = [tuple(None if rng.random() < 0.1 else float(c[i]) for c in columns.values()) + (None,) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", nothing double").repartition(7)
    marks = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = quantiles.exact_percentiles_of(df, df.columns, marks)
    for i, c in enumerate(columns):
        known = [r[i] for r in rows if r[i] is not None]
        assert np.allclose(got[c], np.quantile(known, marks), rtol=1e-12)
    assert got["nothing"] == [None] * 6


def test_brackets_that_miss_are_made_good(spark, monkeypatch):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("x"), (-F.col("id") * 1.0).alias("y"))
    real = quantiles._merged
    monkeypatch.setattr(quantiles, "_merged", lambda intervals: real([(-5000.0, -4000.0) for _ in intervals]))
    assert quantiles.exact_percentiles_of(df, ["x", "y"], [0.25]) == {"x": [249.75], "y": [-749.25]}


def test_winsorize_several_columns(spark, rows):
    df = spark.createDataFrame([(float(i), i, None) for i in range(101)], "a double, b int, c double")
    out = quantiles.winsorize(df, ["a", "b", "c"], 0.1, 0.9)
    got = out.agg(F.min("a"), F.max("a"), F.min("b"), F.max("b"), F.count("c")).first()
    assert tuple(got) == (10.0, 90.0, 10.0, 90.0, 0)


# --------------------------------------------------------- frequent values


def brute_top(values, k):
    counts = Counter(values)
    order = sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]
    return [(v, n, n * 100.0 / len(values)) for v, n in order]


@pytest.mark.parametrize("tracked", [10_000, 64])
def test_top_values(spark, tracked):
    rng = random.Random(3)
    heavy = [rng.choice(["a", "b", None, "null", "=a"]) if rng.random() < 0.6 else f"x{rng.randrange(3000)}" for _ in range(4000)]
    flat = [f"k{i % 900}" for i in range(4000)]
    df = spark.createDataFrame(list(zip(heavy, flat, [None] * 4000)), "heavy string, flat string, none string").repartition(4)
    got = frequent.top_values(df, df.columns, 5, tracked).collect()
    for name, values in (("heavy", heavy), ("flat", flat), ("none", [None] * 4000)):
        mine = sorted((r.rank, r.value, r.cnt, r.pct) for r in got if r.feature == name)
        assert [m[1:] for m in mine] == brute_top(values, 5)
    assert frequent.top_values(df.where("false"), df.columns, 5).collect() == []


# --------------------------------------------------------- distinct values


def test_sketches_answer_unions_within_their_error(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 3).alias("year"), (F.col("id") * 7 % 20_011).alias("pin"), F.lit(None).cast("string").alias("none"))
    exact = {(r.year, r.feature): r.n for r in distinct.distinct_counts_by(df, ["year"], ["pin", "none"]).collect()}
    assert set(exact) == {(y, "pin") for y in range(3)}
    table = distinct.distinct_sketches(df, ["year"], ["pin", "none"])
    for r in distinct.estimate_distinct(table, ["year"]).collect():
        assert abs(r.n - exact[r.year, r.feature]) < 0.04 * exact[r.year, r.feature]
    union = df.where("year < 2").agg(F.count_distinct("pin")).first()[0]
    got = distinct.estimate_distinct(table, where=F.col("year") < 2).first()
    assert abs(got.n - union) < 0.04 * union


def test_levels_tell_a_null_key_from_one_left_out(spark):
    df = spark.createDataFrame([(1, None, 1, 0), (1, "a", 0, 1), (2, None, 1, 1)], "y int, p string, LatePmt1 int, LatePmt2 int")
    got = {(r.level, r.y, r.p): (r.n, r.late1_pct) for r in profile.late_rate_levels(df, [["y", "p"], ["p"], []]).collect()}
    assert got == {(0, 1, None): (1, 100.0), (0, 1, "a"): (1, 0.0), (0, 2, None): (1, 100.0),
                   (1, None, None): (2, 100.0), (1, None, "a"): (1, 0.0), (2, None, None): (3, 200.0 / 3)}
    with pytest.raises(ValueError):
        profile.late_rate_levels(df, [["y"], ["y"]])


def test_stage_counts_take_null_for_no(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    got = profile.stage_counts(df, {"all": F.lit(True), "small": F.col("x") < 2}, {"small": 9}).collect()
    assert [tuple(r) for r in got] == [(1, "all", 3, 1), (2, "small", 1, 9)]


# -------------------------------------------------------------- split join


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("missing", [0.0, None])
def test_large_weight_tables_give_the_same_rows(spark, strict, missing):
    rng = random.Random(4)
    made = [(i, rng.choice(["a", None, f"v{rng.randrange(40)}"]), f"w{int(rng.paretovariate(1)) % 60}", rng.randrange(2)) for i in range(800)]
    df = spark.createDataFrame(made, "id int, p string, q string, LatePmt2 int").repartition(6)
    table = encode.fit_woe(df.where("id < 500"), ["p", "q"], strict=strict)
    unseen = df.union(spark.createDataFrame([(900 + i, "new", "w1", 0) for i in range(300)], df.schema))
    small = encode.apply_woe(unseen, table, ["p", "q"], strict, missing)
    for limit in (0, 7):
        large = encode.apply_woe(unseen, table, ["p", "q"], strict, missing, max_rows=limit, salts=3)
        assert large.columns == small.columns
        assert sorted(large.collect(), key=repr) == sorted(small.collect(), key=repr)


# ------------------------------------------------------------------ files


def test_headers_quoted_packed_and_missing(spark, tmp_path):
    head = list(LEDGER_COLUMNS)

    def put(name, columns, pin, quoting):
        opener = gzip.open if name.endswith("gz") else open
        with opener(tmp_path / name, "wt", newline="") as file:
            out = csv.writer(file, quoting=quoting)
            out.writerow(columns)
            out.writerow([pin if c == "PIN" else "1" for c in columns])

    put("a.csv", head, "a", csv.QUOTE_ALL)
    put("b.csv", [*reversed(head), "Note, with comma"], "b", csv.QUOTE_MINIMAL)
    put("c.csv.gz", ["﻿X", *head], "c", csv.QUOTE_NONE)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "lookup.csv").write_text('"Payment Method","Source ID","Payment Source","Payment Description"\nWIRE,428,BANK,"By, wire"\n')
    got = sources.read_payments(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv.gz", "empty.csv")])
    assert sorted(r.PIN for r in got.collect()) == ["a", "b", "c"]
    assert sources.read_payments(spark, str(tmp_path / "empty.csv")).collect() == []
    lookup = sources.read_source_lookup(spark, str(tmp_path / "lookup.csv")).first()
    assert (lookup.srcID, lookup.PmtDesc, lookup.PmtSrc, lookup.PmtMethod) == ("428", "By, wire", "BANK", "WIRE")


def test_rows_and_rejects_are_all_lines(spark, tmp_path):
    (tmp_path / "2019.rpt").write_text("1|2|3\n4|5|6|7\n\n8|9\na|b|c|d|e\n")
    (tmp_path / "2020.rpt").write_text("x|y|z\n")
    scan = sources.scan_bills(spark, str(tmp_path), text_schema(["p", "q", "r"]), year_pattern=r"(\d{4})\.rpt")
    assert sorted(map(tuple, scan.rows.collect()), key=repr) == [("1", "2", "3", 2019), ("8", "9", None, 2019), ("x", "y", "z", 2020)]
    rejects = sorted((r.line, r.fields, r.reason, r.block) for r in scan.rejects.collect())
    assert rejects == [("4|5|6|7", 4, "1 surplus fields", 0), ("a|b|c|d|e", 5, "2 surplus fields", 0)]
    assert {(r.file[-8:], r.reason): r.n for r in scan.counts().collect()} == {
        ("2019.rpt", "good"): 2, ("2019.rpt", "1 surplus fields"): 1, ("2019.rpt", "2 surplus fields"): 1, ("2020.rpt", "good"): 1}


def test_loads_replace_years_and_repeat_nothing(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "table")
    raw.mkdir()

    def read(paths):
        return sources.read_bills(spark, paths, text_schema(["PIN", "TaxYear"])).withColumn("TaxYear", F.col("TaxYear").cast("int"))

    def load():
        return sorted((r.path.rpartition("/")[2], r.year, r.rows) for r in sources.load_years(spark, str(raw), target, read).collect())

    def rows():
        return sorted(map(tuple, sources.read_years(spark, target).select("PIN", "TaxYear").collect()))

    (raw / "a.rpt").write_text("1|2018\n2|2018\n3|2019\n")
    (raw / "b.rpt").write_text("4|2019\n")
    assert load() == [("a.rpt", 2018, 2), ("a.rpt", 2019, 1), ("b.rpt", 2019, 1)]
    assert load() == [] and rows() == [("1", 2018), ("2", 2018), ("3", 2019), ("4", 2019)]
    (raw / "b.rpt").write_text("5|2019\n6|2020\n")  # corrected: the other file of 2019 stays
    assert load() == [("b.rpt", 2019, 1), ("b.rpt", 2020, 1)]
    assert rows() == [("1", 2018), ("2", 2018), ("3", 2019), ("5", 2019), ("6", 2020)]
    (raw / "b.rpt").write_text("7|2021\n")  # two years lost
    assert load() == [("b.rpt", 2021, 1)] and rows() == [("1", 2018), ("2", 2018), ("3", 2019), ("7", 2021)]
    (raw / "a.rpt").unlink()
    (raw / "c.rpt").write_text("8|2019\n")  # in place of a file that is gone
    assert load() == [("c.rpt", 2019, 1)] and ("8", 2019) in rows() and ("3", 2019) not in rows()
    assert sources.read_years(spark, target, [2021]).count() == 1
    assert {r.path.rpartition("/")[2] for r in sources.manifest(spark, target).collect()} == {"b.rpt", "c.rpt"}
    (raw / "d.rpt").write_text("9|\n")
    with pytest.raises(ValueError):
        load()


# ------------------------------------------------------------------ scratch


def files(spark):
    import pathlib

    return sum(1 for p in pathlib.Path(shared_dir(spark).removeprefix("file:")).rglob("*") if p.is_file())


def test_nothing_is_left_of_what_was_written(spark):
    df = spark.range(100).withColumn("x", F.rand(1))
    before = files(spark)
    with scratch(spark):
        first = written(df, "first")
        second = materialize(first)
        assert first.count() == second.count() == 100 and files(spark) > before
        middle = files(spark)
        free(first, df)
        assert files(spark) < middle and second.count() == 100
        rows = quantiles.winsorize(df, "x").count()
        assert rows == 100
    assert files(spark) == before


# ------------------------------------------------------------------ forests


def test_training_rows_are_bounded_by_a_hash(spark):
    df = spark.range(5000).select("id", (F.col("id") % 2).alias("y"))
    some = forests.bounded_rows(df, 1000)
    assert 850 < some.count() < 1150 and some.exceptAll(forests.bounded_rows(df.repartition(9), 1000)).isEmpty()
    assert forests.bounded_rows(df, 5000).count() == 5000


def test_a_deep_forest_with_cached_nodes(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 * 3).cast("double").alias("y"))
    settings = forests.ForestSettings(trees=5, depth=26, subset="all", cache_nodes=True, checkpoint_every=2, row_share=0.9)
    model = forests.train_regressor(df, ["x"], "y", settings)
    assert forests.score(model, df).where("prediction <> y").isEmpty()
