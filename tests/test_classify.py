from __future__ import annotations

import math

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from datamill.operators import classify as trees
from datamill.operators import sampling
from datamill.plans.standins import labelled_lines

SF_DIR = "/root/testdata/sf0.001"


def guesses(spark, rows):
    return spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label double, prediction double")


def test_metrics_are_zero_without_a_denominator(spark):
    rows = guesses(spark, [(0, 0), (0, 1), (1, 1), (2, 1)])
    got = {r.label: (r.precision, r.recall, r.accuracy) for r in trees.class_metrics(rows).collect()}
    assert got == {0.0: (1.0, 0.5, 0.5), 1.0: (1 / 3, 1.0, 0.5), 2.0: (0.0, 0.0, 0.5)}
    assert trees.accuracy(rows) == 0.5 and math.isnan(trees.accuracy(rows.limit(0)))
    cells = {(r.label, r.prediction): r.n for r in trees.confusion_matrix(rows).collect()}
    assert cells == {(0.0, 0.0): 1, (0.0, 1.0): 1, (1.0, 1.0): 1, (2.0, 1.0): 1}


def test_chance_accuracy_joins_on_the_class(spark):
    train = spark.createDataFrame([(0.0,), (0.0,), (1.0,), (2.0,)], "label double")
    held_out = spark.createDataFrame([(1.0,), (2.0,)], "label double")
    assert trees.chance_accuracy(train, held_out).first()[0] == 0.25 * 0.5 + 0.25 * 0.5


def test_block_index(spark):
    df = spark.createDataFrame([([9.0, 0.0, 1.0, 1.0],), ([9.0, 0.0, 0.0, 1.0],)], "v array<double>")
    assert [r[0] for r in df.select(trees.block_index(F.col("v"), 1, 2)).collect()] == [1.0, -1.0]


def test_labelled_features_shift_the_class(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "a double, b double, c int")
    row = trees.labelled_features(df, ["a", "b"], "c").select(vector_to_array("features").alias("v"), "label").first()
    assert row.v == [1.0, 2.0] and row.label == 2.0


def test_majority_class_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 0.0), ("h", 2.0)], "k string, label double")
    assert {r.k: r.prediction for r in trees.majority_class(df, ["k"]).collect()} == {"g": 0.0, "h": 2.0}


def test_splits_are_disjoint_and_whole(spark):
    df = spark.range(3000)
    parts = sampling.hash_split(df, F.col("id"), [0.8, 0.1, 0.1])
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 3000 and 2300 < sizes[0] < 2500
    assert sampling.union_all(parts[0], parts[1]).intersect(parts[2]).count() == 0
    assert sampling.on_splits(df, F.col("id"), lambda a, b, c: (a.count(), b.count(), c.count())) == tuple(sizes)
    assert 200 < sampling.hash_sample(df, F.col("id"), 0.1).count() < 400
    assert sum(p.count() for p in sampling.random_split(df, [0.9, 0.1], 1)) == 3000


def test_trees_learn_a_category(spark):
    df = spark.range(400).select(
        F.col("id"), (F.col("id") % 10).cast("double").alias("x"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("kind"),
        (F.col("id") % 4 == 2).cast("double").alias("label"),
    )
    data = trees.categorical_features(["kind"], ["x"]).fit(df).transform(df)
    train, held_out, test = sampling.hash_split(data, F.col("id"), [0.6, 0.2, 0.2])
    grid = trees.tree_grid(train, held_out, [trees.TreeSetting("gini", 1, 10), trees.TreeSetting("entropy", 4, 40)])
    assert grid.first().accuracy == 1.0
    best = trees.best_tree(train, held_out, test, setting=trees.TreeSetting("entropy", 4, 40)).first()
    assert best.test_accuracy == 1.0 and best.known_accuracy == 1.0
    forest = trees.train_forest(train, 5, trees.TreeSetting("entropy", 5, 40))
    assert trees.accuracy(forest.transform(test)) > 0.9


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_best_split_is_the_root_of_a_trained_tree(spark, impurity):
    names = ["l_quantity", "l_discount", "l_tax"]  # few different values: both sides try every one
    rows = trees.labelled_features(labelled_lines(spark, SF_DIR), names, "class_number", *names)
    tree = trees.train_tree(rows, trees.TreeSetting(impurity, 1, 100))
    root = tree._java_obj.rootNode()
    first = trees.best_split(rows, names, "label", 100, impurity).first()
    assert first.feature == names[root.split().featureIndex()]
    assert math.isclose(first.threshold, root.split().threshold()) and math.isclose(first.gain, root.gain(), rel_tol=1e-6)


def test_split_of_odd_values(spark):
    rows = [(1.0, None, "x", 0.0), (-0.0, 2.0, "y", 0.0), (0.0, float("nan"), "z", 1.0), (5.0, 2.0, None, 1.0), (None, 2.0, "w", 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, bin string, label double")
    found = {r.feature: r for r in trees.best_split(df, ["a", "b"]).collect()}
    assert set(found) == {"a"}  # b has one value and so no split
    assert (found["a"].n_left + found["a"].n_right) == 4 and found["a"].threshold == 3.0
    assert trees.best_split(df.limit(0), ["a", "b"]).count() == 0


def test_bins_of_many_values_have_like_sizes(spark):
    df = spark.range(10_000).select(F.sqrt("id").alias("v"), (F.col("id") % 3).cast("double").alias("label"))
    bins = trees.bin_histogram(df, ["v"], "label", 10).groupBy("bin").agg(F.sum("n").alias("n")).collect()
    assert sorted(r.bin for r in bins) == list(range(10)) and all(r.n == 1000 for r in bins)


def test_bags_hold_rows_once_on_average(spark):
    rows = spark.range(20_000).select("id")
    bags = trees.bootstrap(rows, F.col("id"), 3)
    stats = bags.groupBy("tree").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("held"), F.max("weight").alias("most")).collect()
    assert len(stats) == 3
    # Poisson of mean one: as many as rows, 63 % of the rows held, none very often.
    assert all(abs(r.n / 20_000 - 1) < 0.03 and abs(r.held / 20_000 - (1 - math.exp(-1))) < 0.02 and 4 < r.most < 12 for r in stats)
    assert trees.bootstrap(rows, F.col("id"), 3).exceptAll(bags).count() == 0


def test_bagged_trees_vote(spark):
    rows = spark.range(600).select(
        "id", array_to_vector(F.array(F.col("id") % 10 + 0.0, F.rand(3))).alias("features"), (F.col("id") % 10 >= 5).cast("double").alias("label")
    )
    models = trees.train_bagged(rows, F.col("id"), 3, trees.TreeSetting("gini", 2, 32))
    votes = trees.model_votes(models, rows, "id", "label")
    found = trees.majority_vote(votes, "id", "label").collect()
    assert len(found) == 600 and all(r.prediction == r.label and r.votes == 3 for r in found)


def test_tied_votes_go_to_the_lowest_class(spark):
    votes = spark.createDataFrame([(1, 2.0), (1, 1.0), (2, 3.0), (2, 3.0), (2, 0.0)], "id int, prediction double")
    assert {(r.id, r.prediction, r.votes) for r in trees.majority_vote(votes, "id").collect()} == {(1, 1.0, 1), (2, 3.0, 2)}


def test_a_draw_is_hashed_once(spark):
    rows = spark.range(50).withColumn("label", F.lit(0.0))
    plan = trees.bootstrap(rows, F.col("id"), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
