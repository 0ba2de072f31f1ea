"""Labelled records, class priors, prediction metrics, decision trees and forests."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from datamill.functions.buckets import BUCKETS, bucket
from datamill.functions.numbers import score_block
from datamill.operators.ranking import running_total
from datamill.operators.subtrees import Cells, DeepTree, grow_tree, right_share
from datamill.session import cut, ensure_checkpoint_dir, persisted


def labelled_features(df: DataFrame, features: Sequence[str], class_number: str, *keep: str) -> DataFrame:
    """A feature vector and a 0-based label from a class number that counts from 1."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return assembled.select(*keep, "features", (F.col(class_number) - 1).cast("double").alias("label"))


def block_index(values: Column, start: int, length: int) -> Column:
    """Position of the 1 inside a one-hot block of an array, -1 when there is none."""
    return F.array_position(F.slice(values, start + 1, length), F.lit(1.0)).cast("double") - 1


def sparse_block_index(vector: Column, start: int, length: int) -> Column:
    """The same for a sparse vector (size, indices, values), whose zeros are not looked at."""
    cells = F.arrays_zip(vector["indices"].alias("dim"), vector["values"].alias("value"))
    ones = F.filter(cells, lambda c: (c["dim"] >= start) & (c["dim"] < start + length) & (c["value"] == 1.0))
    return F.coalesce((F.array_min(F.transform(ones, lambda c: c["dim"])) - start).cast("double"), F.lit(-1.0))


def class_priors(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of each class. The window runs over the finished counts, one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.select(F.col(label).alias("label"), "n", (F.col("n") / total).alias("share"))


def chance_accuracy(train: DataFrame, held_out: DataFrame, label: str = "label") -> DataFrame:
    """Accuracy of guessing held-out classes by training shares: Σ share · share by class."""
    left = class_priors(train, label).select("label", F.col("share").alias("train_share"))
    right = class_priors(held_out, label).select("label", F.col("share").alias("held_share"))
    matched = left.join(right, "label")
    total = F.sum(F.col("train_share") * F.col("held_share"))
    return matched.agg(F.coalesce(total, F.lit(0.0)).alias("chance_accuracy"))


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Counts per (label, prediction) that occurs."""
    return predictions.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_metrics(predictions: DataFrame) -> DataFrame:
    """Precision and recall of each class, 0 where there is nothing to divide by, and the
    accuracy over all classes. Works on the confusion matrix, not on the rows."""
    cells = confusion_matrix(predictions)
    hit = F.col("label") == F.col("prediction")
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.lit(0).cast("bigint").alias("guessed"),
                         F.col("n").alias("actual"), F.when(hit, F.col("n")).otherwise(0).alias("hits")),
                F.struct(F.col("prediction").alias("class"), F.col("n").alias("guessed"),
                         F.lit(0).cast("bigint").alias("actual"), F.lit(0).cast("bigint").alias("hits")),
            )
        )
    )
    sums = sides.groupBy("class").agg(
        F.sum("guessed").alias("guessed"), F.sum("actual").alias("actual"), F.sum("hits").alias("hits")
    )
    whole = Window.partitionBy(F.lit(0))

    def ratio(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(F.lit(0.0))

    return sums.select(
        F.col("class").alias("label"),
        ratio(F.col("hits"), F.col("guessed")).alias("precision"),
        ratio(F.col("hits"), F.col("actual")).alias("recall"),
        (F.sum("hits").over(whole) / F.sum("actual").over(whole)).alias("accuracy"),
    )


def accuracy(predictions: DataFrame) -> float:
    """Share of right predictions, NaN for no rows."""
    return right_share(predictions)


def majority_class(train: DataFrame, group: Sequence[str], label: str = "label") -> DataFrame:
    """Most frequent label per group, the lowest on a tie."""
    counts = train.groupBy(*group, label).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label)))
    return counts.groupBy(*group).agg(best.alias("prediction"))


class TreeSetting(NamedTuple):
    impurity: str
    depth: int
    bins: int


# --- bootstrap and votes --------------------------------------------------------------------


def poisson_bounds(rate: float) -> list[int]:
    """Buckets from which on a Poisson draw of mean `rate` is at least 1, 2, 3, …"""
    bounds, reached, chance, k = [], 0.0, math.exp(-rate), 0
    while (bound := math.ceil((reached := reached + chance) * BUCKETS)) < BUCKETS and chance > 0:
        bounds.append(bound)
        k += 1
        chance *= rate / k
    return bounds


def bootstrap(rows: DataFrame, key: Column, trees: int, rate: float = 1.0) -> DataFrame:
    """Rows (…, tree, weight): how often each of `trees` bags holds a row, where it does.

    The weights are Poisson draws hashed from key and tree, so a bag needs no pass over the
    rows of its own and is the same when a lost task runs again. A draw is hashed once: the
    one-element `explode` keeps the optimizer from copying it into each bound and the filter.
    """
    bagged = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    draw = bucket(F.concat_ws(":", key, F.col("tree")), "bag")
    bagged = bagged.withColumn("_draw", F.explode(F.array(draw)))
    steps = [(F.col("_draw") >= bound).cast("bigint") for bound in poisson_bounds(rate)]
    weight = reduce(Column.__add__, steps, F.lit(0).cast("bigint"))
    return bagged.withColumn("weight", weight).drop("_draw").filter("weight > 0")


def bagged_majority(bags: DataFrame, group: Sequence[str], label: str = "label") -> DataFrame:
    """What each bag says: the heaviest label per (tree, group), the lowest on a tie."""
    weights = bags.groupBy("tree", *group, label).agg(F.sum("weight").alias("n"))
    best = F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label)))
    return weights.groupBy("tree", *group).agg(best.alias("prediction"))


def model_votes(models: Sequence[Model], rows: DataFrame, *keys: str) -> DataFrame:
    """(keys…, tree, prediction): the answer of each model for each row."""
    votes = [
        model.transform(rows).select(*keys, F.lit(tree).alias("tree"), "prediction") for tree, model in enumerate(models)
    ]
    return reduce(DataFrame.unionByName, votes)


def majority_vote(votes: DataFrame, *keys: str) -> DataFrame:
    """(keys…, prediction, votes): the answer that most trees give, the lowest on a tie."""
    counts = votes.groupBy(*keys, "prediction").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("n"), -F.col("prediction"))
    return counts.groupBy(*keys).agg(F.max_by("prediction", order).alias("prediction"), F.max("n").alias("votes"))


def train_bagged(
    train: DataFrame, key: Column, trees: int, setting: TreeSetting = TreeSetting("gini", 4, 100), seed: int = 7
) -> list[Model]:
    """One tree per bag; a row counts as often as its bag holds it."""
    ensure_checkpoint_dir(train.sparkSession)
    with persisted(bootstrap(train, key, trees).select("tree", "weight", "features", "label")) as (bags,):
        return [
            DecisionTreeClassifier(
                impurity=setting.impurity, maxDepth=setting.depth, maxBins=setting.bins, seed=seed, weightCol="weight"
            ).fit(bags.filter(F.col("tree") == tree))
            for tree in range(trees)
        ]


# --- trees ---------------------------------------------------------------------------------


def bin_histogram(rows: DataFrame, features: Sequence[str], label: str, bins: int) -> DataFrame:
    """Class counts per bin of each feature: (feature, bin, label, n, low, high), `low` and
    `high` being the bin's smallest and largest value.

    A feature of at most `bins` different values has a bin for each; others have about equal
    numbers of rows per bin, and equal values are never parted. Rows are counted per value
    before the shuffle, and the running totals over values are taken by score block, so no
    task orders a whole feature. Null and NaN values have no bin.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    long = rows.select(cells.alias("c"), F.col(label).cast("double").alias("label")).select("c.feature", "c.value", "label")
    # 0.0 + value makes -0.0 the same value as 0.0.
    long = long.filter("value is not null and not isnan(value) and label is not null").withColumn("value", F.lit(0.0) + F.col("value"))
    counts = cut(long.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("n")))
    values = counts.groupBy("feature", "value").agg(F.sum("n").alias("n")).withColumns(
        {"block": score_block(F.col("value"), 16), "one": F.lit(1).cast("bigint")}
    )
    ranked = running_total(values, ["feature"], ["value"], "n", "upto", "block")
    ranked = running_total(ranked, ["feature"], ["value"], "one", "place", "block")
    sizes = values.groupBy("feature").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("different"))
    number = F.when(F.col("different") <= bins, F.col("place") - 1).otherwise(
        F.expr(f"((upto - n) * {int(bins)}) div total")
    )
    # One row per feature.
    placed = ranked.join(F.broadcast(sizes), "feature").select("feature", "value", number.alias("bin"))
    joined = counts.join(placed, ["feature", "value"])
    return joined.groupBy("feature", "bin", "label").agg(
        F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


# Impurity of class counts c of a node of n rows: 1 - Σ c²/n², or ln n - Σ c·ln c / n. Both need
# the sum of a term per class only.
IMPURITY_TERMS = {
    "gini": lambda c: c.cast("double") * c,
    "entropy": lambda c: F.when(c > 0, c * F.log(c.cast("double"))).otherwise(0.0),
}
IMPURITIES = {
    "gini": lambda terms, n: 1 - terms / (n.cast("double") * n),
    "entropy": lambda terms, n: (F.log(n.cast("double")) - terms / n) / F.log(F.lit(2.0)),
}


def split_gains(histogram: DataFrame, impurity: str = "gini") -> DataFrame:
    """What a split behind each bin gains: (feature, bin, threshold, n_left, n_right, gain).

    The threshold lies half-way between the bin's largest value and the next one's smallest.
    Sums per class run over a class's own bins only: a bin adds to Σ term(count so far) what
    the counts of its classes change there, so absent classes need no rows.
    """
    term, worth = IMPURITY_TERMS[impurity], IMPURITIES[impurity]
    own = Window.partitionBy("feature", "label").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("feature", "label")
    upto, all_ = F.sum("n").over(own), F.sum("n").over(whole)
    steps = histogram.withColumns({"upto": upto, "all": all_}).select(
        "feature", "bin", "n", "low", "high",
        (term(F.col("upto")) - term(F.col("upto") - F.col("n"))).alias("left"),
        (term(F.col("all") - F.col("upto")) - term(F.col("all") - F.col("upto") + F.col("n"))).alias("right"),
        F.when(F.col("upto") == F.col("n"), term(F.col("all"))).otherwise(0.0).alias("whole"),
    )
    bins = steps.groupBy("feature", "bin").agg(
        *[F.sum(c).alias(c) for c in ("n", "left", "right", "whole")], F.min("low").alias("low"), F.max("high").alias("high")
    )
    # From here a feature has at most `bins` + 1 rows.
    along = Window.partitionBy("feature").orderBy("bin")
    before, every = along.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("feature")
    ran = bins.select(
        "feature", "bin", ((F.col("high") + F.lead("low").over(along)) / 2).alias("threshold"),
        F.sum("n").over(before).alias("n_left"), F.sum("n").over(every).alias("n"),
        F.sum("left").over(before).alias("left"), F.sum("right").over(before).alias("right"), F.sum("whole").over(every).alias("whole"),
    ).filter("threshold is not null")
    n, n_left = F.col("n"), F.col("n_left")
    n_right = n - n_left
    below = worth(F.col("left"), n_left) * n_left + worth(F.col("whole") + F.col("right"), n_right) * n_right
    gain = worth(F.col("whole"), n) - below / n
    return ran.select("feature", "bin", "threshold", "n_left", n_right.alias("n_right"), gain.alias("gain"))


def best_split(
    rows: DataFrame, features: Sequence[str], label: str = "label", bins: int = 100, impurity: str = "gini"
) -> DataFrame:
    """The best split of each feature, best first: the root a tree of depth 1 would take. Of
    splits that gain the same the lowest threshold is taken."""
    gains = split_gains(bin_histogram(rows, features, label, bins), impurity)
    first = Window.partitionBy("feature").orderBy(F.desc(F.round("gain", 12)), "bin")
    best = gains.withColumn("_place", F.row_number().over(first)).filter("_place = 1")
    return best.select("feature", "threshold", "n_left", "n_right", "gain").orderBy(F.desc("gain"), "feature")


FULL_GRID = [TreeSetting(*v) for v in itertools.product(["gini", "entropy"], [1, 20], [10, 300])]
FULL_CATEGORY_GRID = [TreeSetting(*v) for v in itertools.product(["gini", "entropy"], [10, 20, 30], [40, 300])]


def categorical_features(categories: Sequence[str], numeric: Sequence[str], invalid: str = "error") -> Pipeline:
    """Stages that index text categories and put them after the numeric features; the index
    columns carry nominal metadata, so trees split on categories and not on numbers."""
    indexed = [f"{name}_index" for name in categories]
    indexer = StringIndexer(
        inputCols=list(categories), outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid=invalid
    )
    return Pipeline(stages=[indexer, VectorAssembler(inputCols=[*numeric, *indexed], outputCol="features")])


# Deeper trees grow in tops of so many levels and branches below them; a forest's keep each
# row's node, checkpointed now and then, and do not walk down again.
DEEP = 10


def train_tree(
    train: DataFrame, setting: TreeSetting = TreeSetting("gini", 4, 100), seed: int = 7,
    known: dict[int, Cells | None] | None = None,
) -> Model | DeepTree:
    ensure_checkpoint_dir(train.sparkSession)

    def fit(rows: DataFrame, depth: int) -> Model:
        return DecisionTreeClassifier(
            impurity=setting.impurity, maxDepth=depth, maxBins=setting.bins, seed=seed, cacheNodeIds=depth > DEEP
        ).fit(rows)

    if setting.depth <= DEEP:
        return fit(train, setting.depth)
    return grow_tree(train, fit, setting.impurity, setting.depth, setting.bins, DEEP, seed, known)


def train_forest(
    train: DataFrame, trees: int = 20, setting: TreeSetting = TreeSetting("entropy", 30, 300), seed: int = 7
) -> Model:
    ensure_checkpoint_dir(train.sparkSession)
    forest = RandomForestClassifier(
        numTrees=trees, featureSubsetStrategy="auto", impurity=setting.impurity,
        maxDepth=setting.depth, maxBins=setting.bins, seed=seed, cacheNodeIds=setting.depth > DEEP,
    )
    # A copy has no training summary, whose session cannot be sent to tasks once it has observed a job.
    return forest.fit(train).copy()


def tree_grid(
    train: DataFrame, held_out: DataFrame, settings: Sequence[TreeSetting] = FULL_GRID, seed: int = 7
) -> DataFrame:
    """Training and held-out accuracy of one tree per setting, best held-out first.

    Deep trees that differ in depth alone are one tree, grown once, cut and judged together.
    """
    results, judged, cells = [], {}, {}
    depths = {}
    for setting in settings:
        depths.setdefault(setting[::2], set()).add(setting.depth)
    with persisted(train, held_out) as (known, other):
        for setting in settings:
            kind, deepest = setting[::2], max(depths[setting[::2]])
            if setting.depth >= DEEP and deepest > DEEP and kind not in judged:
                tree = train_tree(known, setting._replace(depth=deepest), seed, cells)
                asked = sorted(d for d in depths[kind] if d >= DEEP) if tree.cuts else [deepest]
                judged[kind] = tree.right_shares([known, other], asked)
            if kind in judged and setting.depth in judged[kind]:
                train_accuracy, held_accuracy = judged[kind][setting.depth]
            else:
                model = train_tree(known, setting, seed, cells)
                train_accuracy, held_accuracy = accuracy(model.transform(known)), accuracy(model.transform(other))
            results.append(Row(**setting._asdict(), train_accuracy=train_accuracy, accuracy=held_accuracy))
    schema = "impurity string, depth int, bins int, train_accuracy double, accuracy double"
    return train.sparkSession.createDataFrame(results, schema).orderBy(F.desc("accuracy"))


def final_tree(
    known: DataFrame, test: DataFrame, setting: TreeSetting = TreeSetting("entropy", 30, 300), seed: int = 7
) -> DataFrame:
    """The chosen setting trained once more on all rows known beforehand and its accuracy on the
    test rows, in the columns of a grid; the known rows are not judged."""
    with persisted(known) as (rows,):
        tree = train_tree(rows, setting, seed)
        row = Row(**setting._asdict(), train_accuracy=None, accuracy=accuracy(tree.transform(test)))
        schema = "impurity string, depth int, bins int, train_accuracy double, accuracy double"
        return known.sparkSession.createDataFrame([row], schema)


def best_tree(
    train: DataFrame, known: DataFrame, test: DataFrame,
    setting: TreeSetting = TreeSetting("entropy", 20, 300), seed: int = 7,
) -> DataFrame:
    """Accuracy of the chosen tree on the test rows and on the rows known beforehand."""
    model = train_tree(train, setting, seed)
    row = Row(test_accuracy=accuracy(model.transform(test)), known_accuracy=accuracy(model.transform(known)))
    return train.sparkSession.createDataFrame([row], "test_accuracy double, known_accuracy double")
