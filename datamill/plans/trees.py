"""Tree classification: labels, priors, metrics, splits, trees and forests."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import share
from datamill.operators import classify as trees
from datamill.operators import sampling
from datamill.operators.cluster import sparse_one_hot
from datamill.plans.registry import query
from datamill.plans.standins import LABELLED_SQL, NUMERIC, labelled_lines, sql_bucket, sql_split, table, vectors
from datamill.session import persisted

WEIGHTS = [0.8, 0.1, 0.1]


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = labelled_lines(spark, sf_dir)
    return lines.withColumn("label", F.col("class_number") - 1).drop("class_number")


def parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Training, validation and test lines."""
    return sampling.hash_split(labelled(spark, sf_dir), F.col("row_key"), WEIGHTS)


SPLIT_SQL = f"r as materialized (select *, {sql_split('row_key', WEIGHTS)} as split from ({LABELLED_SQL}))"


@query(
    "labeled_features",
    f"select row_key, l_quantity as f0, l_extendedprice as f1, l_discount as f2, l_tax as f3, label from ({LABELLED_SQL})",
)
def labeled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trees.labelled_features(labelled_lines(spark, sf_dir), NUMERIC, "class_number", "row_key")
    values = vector_to_array("features")
    return rows.select("row_key", *[values[i].alias(f"f{i}") for i in range(len(NUMERIC))], "label")


EVENT_TYPES_SQL = "select event_type, row_number() over (order by event_type) - 1 as place from (select distinct event_type from events)"


@query(
    "unonehot",
    f"""select event_id, cast(place as double) as event_index, value
    from events join ({EVENT_TYPES_SQL}) using (event_type)""",
)
def unonehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as a 0/1 block behind a number, then put back into one index."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    wide, sizes = sparse_one_hot(events, ["value"], ["event_type"], [], "numbers")
    return wide.select(
        "event_id",
        trees.sparse_block_index(F.col("numbers"), 1, sizes[0]).alias("event_index"),
        F.col("numbers.values")[0].alias("value"),
    )


@query("hash_split", f"with {SPLIT_SQL} select row_key, split from r")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_split(labelled(spark, sf_dir), F.col("row_key"), WEIGHTS).select("row_key", "split")


@query(
    "hash_sample",
    f"select row_key from ({LABELLED_SQL}) where {sql_bucket('row_key', 'sample')} < {share(0.1)}",
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(labelled(spark, sf_dir), F.col("row_key"), 0.1).select("row_key")


@query("split_union", f"with {SPLIT_SQL} select row_key, label from r where split in (0, 1)")
def split_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation, _ = parts(spark, sf_dir)
    return sampling.union_all(train, validation).select("row_key", "label")


def sql_priors(split: int) -> str:
    return f"select label, count(*) as n, count(*) / sum(count(*)) over () as share from r where split = {split} group by label"


@query("class_priors", f"with {SPLIT_SQL} select label, n, round(share, 9) as share from ({sql_priors(0)})")
def class_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.class_priors(parts(spark, sf_dir)[0]).withColumn("share", F.round("share", 9))


@query(
    "chance_accuracy",
    f"""with {SPLIT_SQL} select round(sum(a.share * b.share), 9) as chance_accuracy
    from ({sql_priors(0)}) a join ({sql_priors(1)}) b using (label)""",
)
def chance_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation, _ = parts(spark, sf_dir)
    return trees.chance_accuracy(train, validation).select(F.round("chance_accuracy", 9).alias("chance_accuracy"))


GROUP = ["l_linestatus", "l_linenumber"]

MAJORITY_SQL = f"""{SPLIT_SQL},
    votes as (select l_linestatus, l_linenumber, label, count(*) as n from r where split = 0 group by all),
    best as (
        select l_linestatus, l_linenumber, label as prediction
        from (select *, row_number() over (partition by l_linestatus, l_linenumber order by n desc, label) as place from votes)
        where place = 1),
    guesses as materialized (
        select r.label, best.prediction from r join best using (l_linestatus, l_linenumber) where split = 1)"""


def majority_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation lines with the most frequent training class of their group."""
    train, validation, _ = parts(spark, sf_dir)
    return validation.join(trees.majority_class(train, GROUP), GROUP).select("label", "prediction")


@query("confusion_matrix", f"with {MAJORITY_SQL} select label, prediction, count(*) as n from guesses group by all")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.confusion_matrix(majority_guesses(spark, sf_dir))


@query(
    "class_metrics",
    f"""with {MAJORITY_SQL},
    classes as (select label as class from guesses union select prediction from guesses)
    select class as label,
           round(coalesce(count(*) filter (where label = class and prediction = class)
                 / nullif(count(*) filter (where prediction = class), 0), 0), 9) as precision,
           round(coalesce(count(*) filter (where label = class and prediction = class)
                 / nullif(count(*) filter (where label = class), 0), 0), 9) as recall,
           round(avg(case when label = prediction then 1.0 else 0.0 end), 9) as accuracy
    from guesses cross join classes group by class""",
)
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = trees.class_metrics(majority_guesses(spark, sf_dir))
    return metrics.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "accuracy")])


def vector_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = vectors(spark, sf_dir).select(
        "vec_id", array_to_vector("point").alias("features"), F.col("label").cast("double").alias("label")
    )
    return sampling.hash_split(rows, F.col("vec_id"), WEIGHTS)


@query("tree_predictions")
def tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation, _ = vector_parts(spark, sf_dir)
    return trees.train_tree(train).transform(validation).select("vec_id", "label", "prediction")


@query("tree_grid")
def tree_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, validation, _ = vector_parts(spark, sf_dir)
    return trees.tree_grid(train, validation)


@query("tree_grid_categorical")
def tree_grid_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the line status as a category: the grid, judged on the validation lines,
    and the final tree of training and validation lines, judged on the test lines."""
    train, validation, test = parts(spark, sf_dir)
    # All lines tell the categories, as the surveyed job names them beforehand.
    stages = trees.categorical_features(["l_linestatus"], NUMERIC).fit(labelled(spark, sf_dir))

    def ready(rows: DataFrame) -> DataFrame:
        return stages.transform(rows).select("features", "label")

    grid = trees.tree_grid(ready(train), ready(validation), trees.FULL_CATEGORY_GRID)
    final = trees.final_tree(ready(sampling.union_all(train, validation)), ready(test))
    both = grid.withColumn("judged_on", F.lit("validation")).unionByName(final.withColumn("judged_on", F.lit("test")))
    return both.orderBy(F.desc("judged_on"), F.desc("accuracy"))


SPLIT_BINS = 100


def split_sql(impurity: str) -> str:
    """Every split point of every feature judged from the class counts on both sides."""
    long = " union all ".join(f"select '{c}' as feature, {c}::double as value, label from r where split = 0" for c in NUMERIC)
    if impurity == "gini":
        worth = lambda side: f"1 - sum(power({side}::double / n_{side}, 2))"
    else:
        worth = lambda side: f"-sum(case when {side} > 0 then {side} / n_{side} * log2({side} / n_{side}) else 0 end)"
    return f"""with {SPLIT_SQL}, long as ({long}),
    by_value as (
        select *, sum(n) over (partition by feature order by value) - n as before, sum(n) over (partition by feature) as total,
               row_number() over (partition by feature order by value) as place, count(*) over (partition by feature) as different
        from (select feature, value, count(*) as n from long group by all)),
    binned as (
        select feature, value,
               cast(case when different <= {SPLIT_BINS} then place - 1 else before * {SPLIT_BINS} // total end as bigint) as bin
        from by_value),
    edges as (
        select feature, bin, (high + lead(low) over (partition by feature order by bin)) / 2 as threshold
        from (select feature, bin, min(value) as low, max(value) as high from binned group by all)),
    hist as (select feature, bin, label, count(*) as n from long join binned using (feature, value) group by all),
    sides as (
        select e.feature, e.bin, threshold, label, sum(case when h.bin <= e.bin then n else 0 end) as lft, sum(n) as whole
        from edges e join hist h using (feature) where threshold is not null group by all),
    judged as (
        select *, whole - lft as rgt, sum(lft) over s as n_lft, sum(whole) over s as n_whole,
               sum(whole) over s - sum(lft) over s as n_rgt
        from sides window s as (partition by feature, bin)),
    gains as (
        select feature, bin, threshold, any_value(n_lft) as n_left, any_value(n_rgt) as n_right,
               {worth('whole')} - (any_value(n_lft) * ({worth('lft')}) + any_value(n_rgt) * ({worth('rgt')})) / any_value(n_whole) as gain
        from judged group by feature, bin, threshold)
    select feature, threshold, n_left::bigint as n_left, n_right::bigint as n_right, round(gain, 9) as gain
    from (select *, row_number() over (partition by feature order by round(gain, 12) desc, bin) as place from gains) where place = 1"""


@query("best_split", split_sql("gini"))
def best_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best split of each numeric feature of the training lines."""
    found = trees.best_split(parts(spark, sf_dir)[0], NUMERIC, "label", SPLIT_BINS)
    return found.withColumn("gain", F.round("gain", 9))


@query("best_split_entropy", split_sql("entropy"))
def best_split_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = trees.best_split(parts(spark, sf_dir)[0], NUMERIC, "label", SPLIT_BINS, "entropy")
    return found.withColumn("gain", F.round("gain", 9))


@query("tree_best")
def tree_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the chosen tree on the test vectors and on those known before."""
    train, validation, test = vector_parts(spark, sf_dir)
    return trees.best_tree(train, sampling.union_all(train, validation), test)


BAGS = 8

BAG_BOUNDS = trees.poisson_bounds(1.0)

BAGS_SQL = f"""{SPLIT_SQL},
    drawn as (
        select *, {sql_bucket("(row_key || ':' || tree)", 'bag')} as draw
        from (select *, unnest(range({BAGS}))::integer as tree from r where split = 0)),
    bags as materialized (
        select *, len(list_filter({BAG_BOUNDS}::bigint[], lambda bound: draw >= bound))::bigint as weight
        from drawn where draw >= {BAG_BOUNDS[0]})"""


@query("bootstrap_weights", f"with {BAGS_SQL} select row_key, tree, weight from bags")
def bootstrap_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each bag holds a training line."""
    return trees.bootstrap(parts(spark, sf_dir)[0], F.col("row_key"), BAGS).select("row_key", "tree", "weight")


@query(
    "bagged_votes",
    f"""with {BAGS_SQL},
    heard as (select tree, l_linestatus, l_linenumber, label, sum(weight) as n from bags group by all),
    says as (
        select tree, l_linestatus, l_linenumber, label as prediction
        from (select *, row_number() over (partition by tree, l_linestatus, l_linenumber order by n desc, label) as place from heard)
        where place = 1),
    votes as (
        select row_key, r.label, prediction, count(*) as votes
        from r join says using (l_linestatus, l_linenumber) where split = 1 group by all)
    select row_key, label, prediction, votes
    from (select *, row_number() over (partition by row_key, label order by votes desc, prediction) as place from votes) where place = 1""",
)
def bagged_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation lines by the majority of what the bags say of their group."""
    train, validation, _ = parts(spark, sf_dir)
    says = trees.bagged_majority(trees.bootstrap(train, F.col("row_key"), BAGS), GROUP)
    # A row per tree and group, of which there are few.
    votes = validation.select("row_key", "label", *GROUP).join(says, GROUP)
    return trees.majority_vote(votes, "row_key", "label")


FOREST = trees.TreeSetting("entropy", 30, 300)


@query("forest_predictions")
def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = vector_parts(spark, sf_dir)
    return trees.train_forest(train, 20, FOREST).transform(test).select("vec_id", "label", "prediction")


@query("forest_single")
def forest_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest's class for one record, here the mean of all vectors."""
    train, _, _ = vector_parts(spark, sf_dir)
    with persisted(train) as (rows,):
        model = trees.train_forest(rows, 20, FOREST)
    record = table(spark, sf_dir, "embeddings").select(
        array_to_vector(F.col("embedding").cast("array<double>")).alias("point")
    ).agg(Summarizer.mean(F.col("point")).alias("features"))
    return model.transform(record).select("prediction")
