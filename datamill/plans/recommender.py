"""Recommender: ratings with aliases, popularity baseline, mean AUC and factor models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import BUCKETS
from datamill.operators import recommend as rec
from datamill.operators import sampling
from datamill.plans.registry import query
from datamill.plans.standins import (
    ALIAS_SQL,
    RATINGS_SQL,
    SPLIT_RATINGS_SQL,
    alias_lines,
    name_lines,
    raw_ratings,
    sql_bucket,
    table,
)
from datamill.session import cut
from datamill.sources.text_files import parse_alias_lines, parse_name_lines

NAMES_SQL = "select p_partkey as item, trim(p_name) as name from part where p_partkey % 50 <> 0 and p_partkey % 70 <> 0"


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_alias_lines(alias_lines(spark, sf_dir))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_name_lines(name_lines(spark, sf_dir))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item"))
    return rec.canonical_ratings(raw_ratings(spark, sf_dir), aliases(spark, sf_dir), probe)


def splits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training ratings (0.9), held-out ratings (0.1) and the different items of both, all
    from one written table: joined, renamed and hashed once."""
    tagged = sampling.with_split(ratings(spark, sf_dir), F.col("row_key"), [0.9, 0.1])
    rows = cut(tagged.select("user", "item", "rating", "split"))
    return rows.filter("split = 0"), rows.filter("split = 1"), rows.select("item").distinct()


@query("alias_table", ALIAS_SQL)
def alias_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aliases(spark, sf_dir)


@query("lenient_id_name", NAMES_SQL)
def lenient_id_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names(spark, sf_dir)


@query("alias_ratings", f'select row_key, "user", item, rating from ({RATINGS_SQL})')
def alias_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir)


HEAVIEST_SQL = 'select "user" from r group by "user" order by sum(rating) desc, "user" limit 1'


@query(
    "user_history",
    f'with r as ({RATINGS_SQL}) select distinct "user", item from r where "user" = ({HEAVIEST_SQL})',
)
def user_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the heaviest user."""
    rows = cut(ratings(spark, sf_dir))
    return rec.user_history(rows, rec.heaviest_users(rows, 1))


@query(
    "semi_names",
    f"""with r as ({RATINGS_SQL})
    select item, name from ({NAMES_SQL}) where item in (select item from r where "user" = ({HEAVIEST_SQL}))""",
)
def semi_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.names_of(names(spark, sf_dir), user_history(spark, sf_dir))


@query("item_popularity", f"select item, sum(rating) as popularity from ({RATINGS_SQL}) group by item")
def item_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.item_popularity(ratings(spark, sf_dir))


POPULARITY_SQL = "pop as (select item, sum(rating) as popularity from r where split = 0 group by item)"


@query(
    "popularity_predict",
    f"""with r as ({SPLIT_RATINGS_SQL}), {POPULARITY_SQL}
    select "user", item, coalesce(popularity, 0.0) as score from r left join pop using (item) where split = 1""",
)
def popularity_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out, _ = splits(spark, sf_dir)
    return rec.popularity_scores(held_out.select("user", "item"), train)


@query(
    "user_item_sets",
    f"""select "user", cast(item // 4096 as bigint) as item_block, count(distinct item) as n_items,
        array_to_string(list_sort(list(distinct item)), ',') as items
    from ({RATINGS_SQL}) group by 1, 2""",
)
def user_item_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = rec.user_item_sets(ratings(spark, sf_dir))
    return sets.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


NEGATIVES_SQL = f"""
    r as materialized ({SPLIT_RATINGS_SQL}),
    own as materialized (select distinct "user", item from r where split = 1),
    items as (select distinct item from r),
    numbers as materialized (
        select item, row_number() over (order by {sql_bucket('item', 'number')} % 4096, item) - 1 as item_no
        from items),
    size as (select count(*) as n from numbers),
    needs as (select "user", count(*) as need from own group by "user"),
    draws as (select "user", need, unnest(range((select n from size))) as draw from needs),
    hits as (
        select "user", need, draw,
               ({sql_bucket('''("user" || ':' || draw)''', 'negative')} * (select n from size)) >> 32 as item_no
        from draws),
    fresh as (
        select "user", need, draw, item from hits join numbers using (item_no)
        where not exists (select 1 from own where own."user" = hits."user" and own.item = numbers.item)),
    negatives as materialized (
        select "user", draw, item
        from (select *, row_number() over (partition by "user" order by draw) as place from fresh)
        where place <= need)
"""


@query("negative_samples", f'with {NEGATIVES_SQL} select "user", draw, item from negatives')
def negative_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, held_out, items = splits(spark, sf_dir)
    return rec.negative_samples(held_out, items)


@query(
    "mean_auc_popularity",
    f"""with {NEGATIVES_SQL}, {POPULARITY_SQL},
    good as (select "user", coalesce(popularity, 0.0) as score from r left join pop using (item) where split = 1),
    bad as (select "user", coalesce(popularity, 0.0) as score from negatives left join pop using (item)),
    per_user as (
        select "user", avg(case when good.score > bad.score then 1.0 else 0.0 end) as auc
        from good join bad using ("user") group by "user")
    select round(avg(auc), 6) as mean_auc, count(*) as n_users from per_user""",
)
def mean_auc_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out, items = splits(spark, sf_dir)
    predict = lambda pairs: rec.popularity_scores(pairs, train)
    result = rec.mean_auc(held_out, items, predict)
    return result.withColumn("mean_auc", F.round("mean_auc", 6))


@query("mean_auc_als")
def mean_auc_als(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out, items = splits(spark, sf_dir)
    model = rec.train_factors(train)
    return rec.mean_auc(held_out, items, rec.factor_scores(model))


@query("als_train_factors")
def als_train_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rec.factor_table(rec.train_factors(ratings(spark, sf_dir)))


STEP_RANK, STEP_REG, STEP_ALPHA = 2, 0.01, 1.0

HALF_STEP_SQL = f"""
    r as materialized (select "user", item, sum(rating) as rating from ({RATINGS_SQL}) group by all),
    y as materialized (
        select item, {sql_bucket('item', 'factor0')} / {BUCKETS}.0::double as y0,
               {sql_bucket('item', 'factor1')} / {BUCKETS}.0::double as y1
        from (select distinct item from r)),
    gram as (select sum(y0 * y0) as g00, sum(y1 * y0) as g10, sum(y1 * y1) as g11 from y),
    sums as (
        select "user", sum({STEP_ALPHA} * rating * y0 * y0) as a00, sum({STEP_ALPHA} * rating * y1 * y0) as a10,
               sum({STEP_ALPHA} * rating * y1 * y1) as a11, sum((1 + {STEP_ALPHA} * rating) * y0) as b0,
               sum((1 + {STEP_ALPHA} * rating) * y1) as b1, {STEP_REG} * count(*) as ridge
        from r join y using (item) group by "user"),
    system as (
        select "user", a00 + g00 + ridge as p, a10 + g10 as q, a11 + g11 + ridge as s, b0, b1 from sums, gram),
    half_step as (
        select "user", (s * b0 - q * b1) / (p * s - q * q) as x0, (p * b1 - q * b0) / (p * s - q * q) as x1
        from system)
"""


def step(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summed ratings, hashed item factors and the user factors that fit them best."""
    rows = cut(rec.sum_ratings(ratings(spark, sf_dir)))
    items = cut(rec.hashed_factors(rows.select("item").distinct(), "item", STEP_RANK))
    return rows, items, rec.half_step(rows, items, STEP_RANK, STEP_REG, STEP_ALPHA)


@query(
    "als_half_step",
    f'with {HALF_STEP_SQL} select "user", round(x0, 6) as x0, round(x1, 6) as x1 from half_step',
)
def als_half_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User factors of rank 2 for hashed item factors, solved from each user's sums."""
    _, _, users = step(spark, sf_dir)
    return users.select("user", *[F.round(F.col("factor")[i], 6).alias(f"x{i}") for i in range(STEP_RANK)])


@query(
    "als_half_step_scores",
    f"""with {HALF_STEP_SQL}
    select "user", item, round(x0 * y0 + x1 * y1, 6) as score
    from r join y using (item) join half_step using ("user")""",
)
def als_half_step_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What those factors predict for every pair that was rated."""
    rows, items, users = step(spark, sf_dir)
    scored = rec.pair_scores(rows.select("user", "item"), cut(users), items)
    return scored.withColumn("score", F.round("score", 6))


@query("als_predict")
def als_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out, _ = splits(spark, sf_dir)
    return rec.factor_scores(rec.train_factors(train))(held_out.select("user", "item"))


@query("als_recommend_user")
def als_recommend_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five items for the heaviest user with their names, beside the names of its history."""
    rows = cut(ratings(spark, sf_dir))
    users = rec.heaviest_users(rows, 1)
    picks = rec.recommend(rec.train_factors(rows), users, 5)
    known = names(spark, sf_dir)
    history = rec.user_history(rows, users).select("user", F.lit("history").alias("kind"), "item")
    both = picks.select("user", F.lit("recommended").alias("kind"), "item").unionByName(history)
    return both.join(known, "item", "left").select("user", "kind", "item", "name")


@query("als_recommend_many")
def als_recommend_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five items as one line for each of the 100 heaviest users."""
    rows = cut(ratings(spark, sf_dir))
    model = rec.train_factors(rows)
    return rec.recommendation_lines(rec.recommend(model, rec.heaviest_users(rows, 100), 5))


@query("als_grid")
def als_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, held_out, items = splits(spark, sf_dir)
    return rec.factor_grid(train, held_out, items)
