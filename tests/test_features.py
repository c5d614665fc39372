import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from billrisk.operators import encode, history, ordering, profile, quantiles, sizing, split


def panel(spark):
    """Ties in 2018, a null key, and accounts of different sizes."""
    data = [("a", 2017, 1, 1), ("a", 2018, 0, 2), ("a", 2018, 1, 3), ("a", 2019, 1, 4), ("b", 2019, 1, 5),
            (None, 2018, 1, 6), (None, 2019, 1, 7)]
    data += [(f"z{i % 2}", 2000 + i % 7, i % 3 % 2, 100 + i) for i in range(60)]
    return spark.createDataFrame(data, "PIN string, TaxYear int, flag int, row int")


FEATURES = {
    "by_year": history.HistorySum("flag", "range"),
    "before": history.HistorySum("flag", include_current=False),
    "upto": history.HistorySum("flag"),
}


def test_history_frames_with_ties(spark, rows):
    out = history.history_sums(panel(spark), FEATURES, tie_break=["row"])
    got = rows(out.where("PIN = 'a'"), "row", "by_year", "before", "upto")
    assert got == [(1, 1, 0, 1), (2, 2, 1, 1), (3, 2, 1, 2), (4, 3, 2, 3)]


@pytest.mark.parametrize("limit", [1, 3, 10])
def test_large_accounts_give_the_same_history(spark, rows, limit):
    plain = history.history_sums(panel(spark), FEATURES, tie_break=["row"], max_rows_per_key=None)
    split_up = history.history_sums(panel(spark), FEATURES, tie_break=["row"], max_rows_per_key=limit)
    columns = ["PIN", "TaxYear", "row", *FEATURES]
    assert rows(split_up, *columns) == rows(plain, *columns)
    assert split_up.columns == plain.columns


def test_history_uses_one_exchange(spark):
    plan = history.history_sums(panel(spark), FEATURES, max_rows_per_key=None)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Python" not in text


def test_hot_keys(spark, rows):
    assert rows(sizing.hot_keys(panel(spark), ["PIN"], 29)) == [("z0",), ("z1",)]


def test_large_lookup_is_not_broadcast(spark):
    assert sizing.fetch_small(spark.range(11), 10) is None
    assert "ResolvedHint" not in sizing.small_side(spark.range(11), 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in sizing.small_side(spark.range(10), 10)._jdf.queryExecution().analyzed().toString()


def test_row_numbers_over_equal_rows(spark):
    """A third of the rows is one and the same: each still gets its own number."""
    df = spark.createDataFrame([(1,)] * 100 + [(i,) for i in range(200)], "v int")
    got = sorted((r["n"], r["v"]) for r in ordering.row_numbers(df, [F.col("v").asc()], "n").collect())
    assert [n for n, _ in got] == list(range(1, 301))
    assert [v for _, v in got] == sorted([1] * 100 + list(range(200)))


def test_row_numbers_within_groups(spark):
    df = spark.range(97).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    out = ordering.row_numbers(df, [F.col("id").desc()], "n", within=["g"], total="t").collect()
    for g in (None, 1, 2):
        group = sorted((r["n"], -r["id"], r["t"]) for r in out if r["g"] == g)
        assert [n for n, _, _ in group] == list(range(1, len(group) + 1))
        assert [i for _, i, _ in group] == sorted(i for _, i, _ in group)
        assert all(t == len(group) for _, _, t in group)


def test_exact_percentiles(spark):
    rnd = random.Random(3)
    values = [7.0] * 700 + [round(rnd.gauss(0, 50), 3) for _ in range(1300)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantiles.exact_percentiles(df, "x", [0.0, 0.01, 0.5, 0.99, 1.0])
    known = [v for v in values if v is not None]
    assert got == pytest.approx(list(np.percentile(known, [0, 1, 50, 99, 100])))
    empty = df.where("x > 1e9")
    assert quantiles.exact_percentiles(empty, "x", [0.5]) == [None]


def test_percentile_falls_back_when_a_bracket_misses(spark):
    values = spark.range(100).select(F.col("id").cast("double").alias("v"))
    assert quantiles._ranked(values, {"v": [(90.0, 95.0)]}, {"v": [10.0]}) == {}
    assert quantiles._ranked(values, {"v": [(0.0, 99.0)]}, {"v": [10.5]}) == {("v", 10): 10.0, ("v", 11): 11.0}
    assert quantiles.exact_percentiles(values, "v", [10.5 / 99]) == pytest.approx([10.5])


def woe_rows(spark):
    data = [("mixed", 1)] * 3 + [("mixed", 0)] + [("late", 1)] * 2 + [("never", 0)] * 2 + [(None, 1), (None, 0), (None, 0)]
    return spark.createDataFrame(data, "c string, y int")


def test_woe_edge_categories(spark, rows):
    table = dict((r["value"], r["woe"]) for r in encode.fit_woe(woe_rows(spark), ["c"], "y").collect())
    assert table == {"mixed": round(float(np.log(1 / 3)), 2), "late": None, "never": None, None: 0.69}
    unseen = spark.createDataFrame([("mixed",), ("new",), (None,)], "c string")
    got = rows(encode.apply_woe(unseen, encode.fit_woe(woe_rows(spark), ["c"], "y"), ["c"]), "c", "WOE_c")
    assert got == [("mixed", -1.1), ("new", 0.0), (None, 0.69)]


def test_woe_strict_loses_null_categories(spark):
    assert encode.woe_encode(woe_rows(spark), ["c"], "y", strict=True).count() == 8
    assert encode.woe_encode(woe_rows(spark), ["c"], "y").count() == 11


def test_one_hot_names_and_unknown_values(spark, rows):
    df = spark.createDataFrame([("a", 1), ("q", 0), (None, 1)], "c string, n int")
    out = encode.one_hot(df, {"c": ["a", "b"], "n": {"1": "Y", "0": "N"}})
    assert out.columns == ["c_a", "c_b", "n_Y", "n_N"]
    assert rows(out) == [(0, 0, 0, 1), (0, 0, 1, 0), (1, 0, 1, 0)]
    assert encode.discover_values(df, ["c"]) == {"c": ["a", "q"]}
    many = spark.range(3000).select(F.concat(F.lit("v"), "id").alias("c"))
    assert len(encode.discover_values(many, ["c"])["c"]) == 3000
    vector = encode.one_hot_vector(many.union(spark.createDataFrame([(None,)], "c string")), ["c"])
    assert vector.count() == 3001 and vector.first()["c_encoded"].size >= 3001


@pytest.mark.parametrize("share", [0.8, 0.5, 1.0])
def test_stratified_sizes_are_exact(spark, share):
    labels = [1] * 50 + [2] * 7 + [3] + [None] * 4
    df = spark.createDataFrame([(i, lab) for i, lab in enumerate(labels)], "k int, y int")
    out = split.mark_stratified(df, "y", "k", share)
    got = {r["y"]: (r["n"], r["t"]) for r in out.groupBy("y").agg(F.count("*").alias("n"), F.sum("is_train").alias("t")).collect()}
    assert got == {y: (n, int(np.ceil(n * share))) for y, n in ((1, 50), (2, 7), (3, 1), (None, 4))}


def test_stratified_split_of_copies_of_one_key(spark):
    df = spark.createDataFrame([("same", 1)] * 40 + [(str(i), 1) for i in range(60)], "k string, y int")
    out = split.mark_stratified(df, "y", "k", 0.8)
    assert out.count() == 100 and out.where("is_train = 1").count() == 80


def test_random_split_does_not_depend_on_partitions(spark, rows):
    df = spark.range(500)
    a, b = (rows(split.mark_random(df.repartition(n), "id"), "id", "is_train") for n in (1, 7))
    assert a == b and 350 < sum(t for _, t in a) < 450


def test_correlation_methods_agree_and_prune(spark, rows):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"),
                                 ((F.col("id") * 37) % 101).cast("double").alias("c"))
    pairwise = profile.correlation_matrix(df)
    assert rows(pairwise) == rows(profile.correlation_matrix(df, nulls="complete"))
    assert profile.prune_correlated(pairwise, ["a", "b", "c"]) == ["a", "c"]
