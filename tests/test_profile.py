from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from datamill.operators import profile


def pairs(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, matched boolean")


def dims():
    return {"a": F.col("a"), "b": F.col("b")}


def test_missing_stats_skips_null_and_nan(spark):
    df = pairs(spark, [(1.0, None, True), (3.0, math.nan, False), (None, None, True)])
    rows = {r.dim: r for r in profile.missing_stats(df, dims()).collect()}
    assert (rows["a"].n, rows["a"].mean, rows["a"].stdev, rows["a"]["min"], rows["a"]["max"], rows["a"].missing) == (
        2, 2.0, 1.0, 1.0, 3.0, 1,
    )
    assert (rows["b"].n, rows["b"].mean, rows["b"].missing) == (0, None, 3)


def test_missing_stats_of_no_rows_counts_zero(spark):
    rows = profile.missing_stats(pairs(spark, []), dims()).collect()
    assert [(r.n, r.missing) for r in rows] == [(0, 0), (0, 0)]


def test_flag_contrast(spark):
    df = pairs(spark, [(4.0, None, True), (1.0, 1.0, False), (3.0, 5.0, False)])
    rows = {r.dim: r for r in profile.flag_contrast(df, dims(), "matched").collect()}
    assert rows["a"].mean_gap == 2.0 and rows["a"].missing == 0
    assert rows["b"].mean_gap is None and rows["b"].missing == 1


def test_score_counts_only_flags_that_reach_the_threshold(spark):
    df = pairs(spark, [(4.0, None, True), (1.0, math.nan, False), (0.5, 1.5, False)])
    scored = df.select("matched", profile.total_score(list(dims().values())).alias("score"))
    rows = profile.threshold_contingency(scored, "score", "matched", [4.0, 2.0]).collect()
    assert {(r.matched, r.threshold, r.n) for r in rows} == {(True, 4.0, 1), (True, 2.0, 1), (False, 2.0, 1)}


def test_parse_fails_on_a_bad_line(spark):
    lines = spark.createDataFrame([("1,2,?,0.5,true",), ("x,2,1,1,true",)], "value string")
    good = profile.parse_pair_scores(lines.limit(1), 2).first()
    assert good.s0 is None and good.s1 == 0.5 and good.matched
    with pytest.raises(Exception):
        profile.parse_pair_scores(lines, 2).collect()


def test_counts(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), ("z",)], "k string")
    counts = profile.value_counts(df, "k", by_count=True)
    assert [tuple(r) for r in counts.collect()] == [("x", 2), ("y", 1), ("z", 1)]
    assert {tuple(r) for r in profile.count_of_counts(counts).collect()} == {(2, 1), (1, 2)}
    assert profile.distinct_counts(df, "k").first().n_distinct == 3
    assert [r.k for r in profile.top_counts(counts, 2, "k").collect()] == ["x", "y"]
