from __future__ import annotations

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from datamill.operators import classify as trees
from datamill.operators import subtrees
from datamill.plans import standins
from datamill.plans import trees as plans


def noisy(spark, n, classes, kinds):
    """Rows of noise: two numbers, one of few values, and two categories."""
    df = spark.range(n).select(
        F.col("id"), F.rand(1).alias("a"), F.floor(F.rand(2) * 7).cast("double").alias("b"),
        F.concat(F.lit("c"), F.floor(F.rand(3) * kinds).cast("string")).alias("kind"),
        F.when(F.rand(4) < 0.5, "F").otherwise("O").alias("status"),
        F.floor(F.rand(5) * classes).cast("double").alias("label"),
    )
    df = df.localCheckpoint()
    return trees.categorical_features(["kind", "status"], ["a", "b"]).fit(df).transform(df).select("id", "features", "label")


def solver(rows, setting):
    return DecisionTreeClassifier(impurity=setting.impurity, maxDepth=setting.depth, maxBins=setting.bins, seed=7).fit(rows)


def answers(model, rows):
    return {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}


# Of 21,000 rows two thirds are more than the sample that thresholds come from.
@pytest.mark.parametrize("impurity, n, classes, kinds", [("gini", 1500, 3, 4), ("gini", 1500, 2, 12), ("gini", 1500, 4, 25), ("gini", 21_000, 3, 4)])
def test_a_deep_tree_is_the_solvers(spark, impurity, n, classes, kinds, monkeypatch):
    monkeypatch.setattr(trees, "DEEP", 3)  # the rest of the levels is grown below the solver's top
    rows = noisy(spark, n, classes, kinds).persist()
    known, other = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    setting = trees.TreeSetting(impurity, 9, 40)
    tree = trees.train_tree(known, setting)
    assert isinstance(tree, subtrees.DeepTree) and tree.cuts and tree.nodes.count() > 100
    plain = solver(known, setting)
    for part in (known, other):
        assert answers(tree, part) == answers(plain, part)
    shallow = trees.TreeSetting(impurity, 6, 40)
    assert answers(tree.at(6), other) == answers(solver(known, shallow), other)


def test_a_leaf_of_too_many_rows_gets_a_top_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(trees, "DEEP", 2)
    monkeypatch.setattr(subtrees, "LOCAL_VALUES", 1200)
    rows = noisy(spark, 1200, 3, 4).persist()
    setting = trees.TreeSetting("entropy", 8, 40)
    tree = trees.train_tree(rows, setting)
    assert tree.top.below and not tree.cuts
    assert len(answers(tree, rows)) == 1200
    assert abs(trees.accuracy(tree.transform(rows)) - trees.accuracy(solver(rows, setting).transform(rows))) < 0.03


def test_rows_that_cannot_be_split_have_one_answer(spark, monkeypatch):
    monkeypatch.setattr(subtrees, "LOCAL_VALUES", 1)
    rows = noisy(spark, 60, 2, 3).withColumn("features", F.first("features").over(Window.partitionBy(F.lit(0))))
    tree = trees.train_tree(rows, trees.TreeSetting("gini", 20, 40))
    assert len(set(answers(tree, rows).values())) == 1


def test_the_grid_grows_trees_of_different_depths_once(spark, monkeypatch):
    monkeypatch.setattr(trees, "DEEP", 3)
    grown = []
    whole = trees.grow_tree
    monkeypatch.setattr(trees, "grow_tree", lambda *args: grown.append(args[3]) or whole(*args))
    rows = noisy(spark, 600, 3, 4).persist()
    known, other = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    settings = [trees.TreeSetting("gini", depth, 40) for depth in (2, 5, 8)]
    found = {r.depth: (r.train_accuracy, r.accuracy) for r in trees.tree_grid(known, other, settings).collect()}
    assert grown == [8]
    for setting in settings:
        plain = solver(known, setting)
        assert found[setting.depth] == (trees.accuracy(plain.transform(known)), trees.accuracy(plain.transform(other)))


def coarse(spark, n, classes, kinds):
    """Rows of few different values, so that many share the bins of all features."""
    df = spark.range(n).select(
        F.col("id"), F.floor(F.rand(1) * 9).alias("a"), (F.floor(F.rand(2) * 7) / 4 - 1).alias("b"),
        F.concat(F.lit("c"), F.floor(F.rand(3) * kinds).cast("string")).alias("kind"),
        F.floor(F.rand(5) * classes).cast("double").alias("label"),
    )
    df = df.localCheckpoint()
    return trees.categorical_features(["kind"], ["a", "b"]).fit(df).transform(df).select("id", "features", "label")


@pytest.mark.parametrize("impurity, classes, kinds, bins", [("gini", 3, 4, 40), ("entropy", 2, 3, 5), ("entropy", 4, 30, 32)])
def test_rows_that_share_bins_are_counted_first(spark, monkeypatch, impurity, classes, kinds, bins):
    monkeypatch.setattr(trees, "DEEP", 3)
    monkeypatch.setattr(subtrees, "ROWS_PER_CELL", 2)
    monkeypatch.setattr(subtrees, "JUDGED_CELLS", 64)  # several tasks judge
    monkeypatch.setattr(subtrees, "grow_top", None)  # no level is the solver's
    rows = coarse(spark, 24_000, classes, kinds).persist()
    known, other = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    tree = trees.train_tree(known, trees.TreeSetting(impurity, 8, bins))
    assert isinstance(tree, subtrees.CellTree) and tree.nodes.count() > 100
    shares = tree.right_shares([known, other], [3, 8])
    for depth in (3, 8):
        plain = solver(known, trees.TreeSetting(impurity, depth, bins))
        assert answers(tree.at(depth), other) == answers(plain, other)
        assert shares[depth] == [trees.accuracy(plain.transform(part)) for part in (known, other)]
    settings = [trees.TreeSetting(impurity, depth, bins) for depth in (2, 3, 8)]
    found = {r.depth: [r.train_accuracy, r.accuracy] for r in trees.tree_grid(known, other, settings).collect()}
    assert {d: found[d] for d in (3, 8)} == shares
    assert set(tree.transform(other.limit(0)).columns) == {"id", "features", "label", "prediction"}


def test_a_forest_answers_after_an_observed_job(spark):
    seen = Observation()
    rows = noisy(spark, 200, 2, 3)
    rows.observe(seen, F.count(F.lit(1)).alias("n")).count()
    assert seen.get["n"] == 200
    assert len(answers(trees.train_forest(rows, 2, trees.TreeSetting("gini", 3, 10)), rows)) == 200


def test_the_categorical_grid_ends_with_the_final_tree(spark, tmp_path):
    """Trained on training and validation lines, it is judged on the test lines."""
    lines = spark.range(600).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        *[F.floor(F.rand(i) * 6).cast("double").alias(c) for i, c in enumerate(standins.NUMERIC)],
        F.when(F.col("id") % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.when(F.rand(9) < 0.3, "A").when(F.col("id") % 2 == 0, "N").otherwise("R").alias("l_returnflag"),
    )
    lines.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = plans.tree_grid_categorical(spark, str(tmp_path)).collect()
    assert [r.judged_on for r in found] == ["validation"] * 12 + ["test"]
    final = found[-1]
    assert tuple(final)[:3] == ("entropy", 30, 300) and final.train_accuracy is None
    train, validation, test = plans.parts(spark, str(tmp_path))
    stages = trees.categorical_features(["l_linestatus"], standins.NUMERIC).fit(plans.labelled(spark, str(tmp_path)))
    plain = solver(stages.transform(train.unionByName(validation)), trees.TreeSetting("entropy", 30, 300))
    assert final.accuracy == trees.accuracy(plain.transform(stages.transform(test)))
