"""Ratings, popularity, negative samples, mean AUC and implicit-feedback factor models."""

from __future__ import annotations

import itertools
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import BUCKETS, bucket
from datamill.functions.numbers import score_block
from datamill.operators.ranking import number_keys, running_total
from datamill.operators.skew import hot_keys, lookup
from datamill.session import cut, ensure_checkpoint_dir, persisted

# Draws of one user are ranked in blocks of this many.
DRAW_BLOCK = 4096

Predictor = Callable[[DataFrame], DataFrame]


def canonical_ratings(ratings: DataFrame, alias: DataFrame, probe: DataFrame | None = None) -> DataFrame:
    """Replace aliased items (bad_id → good_id), one level only; rows are kept as read."""
    table = alias.select(F.col("bad_id").alias("item"), "good_id")
    joined = lookup(ratings, table, "item", probe=probe)
    return joined.withColumn("item", F.coalesce("good_id", "item")).drop("good_id")


def sum_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per (user, item): the sum."""
    return ratings.groupBy("user", "item").agg(F.sum("rating").alias("rating"))


def heaviest_users(ratings: DataFrame, n: int) -> DataFrame:
    """The `n` users with the largest rating totals."""
    totals = ratings.groupBy("user").agg(F.sum("rating").alias("total"))
    return totals.orderBy(F.desc("total"), "user").limit(n).select("user")


def user_history(ratings: DataFrame, users: DataFrame) -> DataFrame:
    """Different items of the given users, after alias replacement."""
    return ratings.select("user", "item").join(users, "user", "left_semi").distinct()


def names_of(names: DataFrame, items: DataFrame) -> DataFrame:
    """Names (item, name) of the items in a set of ids."""
    return names.join(items.select("item").distinct(), "item", "left_semi")


def item_popularity(ratings: DataFrame) -> DataFrame:
    """Total rating per item."""
    return ratings.groupBy("item").agg(F.sum("rating").alias("popularity"))


def popularity_scores(pairs: DataFrame, train: DataFrame) -> DataFrame:
    """Score each (user, item) by the item's training total, 0 when it was never seen."""
    joined = lookup(pairs, item_popularity(train), "item", spread=["user"])
    return joined.withColumn("score", F.coalesce("popularity", F.lit(0.0))).drop("popularity")


def user_item_sets(ratings: DataFrame, block_items: int = 4096) -> DataFrame:
    """Different items per user as sorted lists, with the number of them.

    A list holds the items of one block of `block_items` neighbouring ids, so no row grows
    with the number of a user's items.
    """
    block = F.floor(F.col("item") / block_items).cast("bigint").alias("item_block")
    sets = ratings.groupBy("user", block).agg(F.sort_array(F.collect_set("item")).alias("items"))
    return sets.select("user", "item_block", F.size("items").cast("bigint").alias("n_items"), "items")


def _draws(needs: DataFrame, num_items: int) -> DataFrame:
    """Rows (user, need, draw, item_no) for draws `start` up to `stop` of each user, in
    blocks that are spread over tasks before they are opened."""
    last = F.col("stop") - 1
    blocks = needs.filter("stop > start").select(
        "user",
        "need",
        "start",
        "stop",
        F.explode(F.sequence(F.floor(F.col("start") / DRAW_BLOCK), F.floor(last / DRAW_BLOCK))).alias("block"),
    )
    first = F.greatest("start", F.col("block") * DRAW_BLOCK)
    final = F.least(last, (F.col("block") + 1) * DRAW_BLOCK - 1)
    drawn = blocks.repartition("user", "block").select(
        "user", "need", "block", F.explode(F.sequence(first, final)).alias("draw")
    )
    value = bucket(F.concat_ws(":", F.col("user"), F.col("draw")), "negative")
    return drawn.withColumn("item_no", F.shiftright(value * F.lit(num_items), 32))


def negative_samples(positives: DataFrame, items: DataFrame) -> DataFrame:
    """As many non-positive items per user as the user has different positive ones.

    A user draws items at random, with repeats, at most as often as there are items; draws
    that hit a positive are passed over and the first ones left are kept. Draws are hashed
    from (user, draw number). A first round makes enough draws for nearly all users and a
    second round gives the rest of the draws to users that are still short.
    """
    own = cut(positives.select("user", "item").distinct())
    numbers = cut(number_keys(items, "item", "item_no"))
    num_items = numbers.count()
    needs = own.groupBy("user").agg(F.count(F.lit(1)).alias("need"))
    # A draw is kept with chance 1 - need / num_items; twice the mean and some to spare.
    mean_draws = F.col("need") * num_items / F.greatest(F.lit(num_items) - F.col("need"), F.lit(1))
    enough = F.least(F.lit(num_items), F.ceil(2 * mean_draws) + 16).cast("bigint")
    needs = cut(needs.select("user", "need", F.lit(0).cast("bigint").alias("start"), enough.alias("stop")))

    def accepted(part: DataFrame) -> DataFrame:
        # Item numbers are drawn by hash, so no number is hot.
        drawn = _draws(part, num_items).join(numbers, "item_no")
        return drawn.join(own, ["user", "item"], "left_anti")

    kept = cut(accepted(needs))
    counts = kept.groupBy("user").agg(F.count(F.lit(1)).alias("kept"))
    short = needs.join(counts, "user", "left").filter(F.coalesce("kept", F.lit(0)) < F.col("need"))
    rest = cut(
        short.select("user", "need", F.col("stop").alias("start"), F.lit(num_items).cast("bigint").alias("stop"))
    )
    if not rest.filter("stop > start").isEmpty():
        kept = kept.unionByName(accepted(rest))
    big = needs.agg(F.max("need")).first()[0]
    ranked = running_total(
        kept.withColumn("one", F.lit(1).cast("bigint")),
        ["user"], ["draw"], "one", "place",
        block="block" if (big or 0) > DRAW_BLOCK else None,
    )
    return ranked.filter("place <= need").select("user", "draw", "item")


def user_auc(positives: DataFrame, negatives: DataFrame, small_table: int | None = None) -> DataFrame:
    """Per user, the share of (positive, negative) pairs where the positive scores higher.

    Scores are first counted per (user, score); a positive then beats the running total of
    negatives below it, so pairs are never built. Users that hold a large part of the rows
    are cut into blocks of neighbouring scores. Users without rows on one side drop out.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    rows = positives.select("user", "score", one.alias("pos"), zero.alias("neg")).unionByName(
        negatives.select("user", "score", zero.alias("pos"), one.alias("neg"))
    )
    counts = rows.groupBy("user", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    hot = hot_keys(positives, "user", small_table=small_table)
    block = None
    if hot:
        block = "block"
        in_hot = F.col("user").isin(hot)
        counts = counts.withColumn(block, F.when(in_hot, score_block(F.col("score"))).otherwise(F.lit(0)))
    ranked = running_total(counts, ["user"], ["score"], "neg", "so_far", block)
    totals = ranked.groupBy("user").agg(
        F.sum(F.col("pos") * (F.col("so_far") - F.col("neg")).cast("double")).alias("right"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )
    both = totals.filter("n_pos > 0 and n_neg > 0")
    return both.select("user", (F.col("right") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"))


def mean_auc(positives: DataFrame, items: DataFrame, predict: Predictor) -> DataFrame:
    """Mean over users of the AUC of held-out items against random other items.

    `predict` maps (user, item) rows to the same rows with a `score`.
    """
    pairs = positives.select("user", "item")
    negatives = negative_samples(pairs, items).select("user", "item")
    return user_auc(predict(pairs), predict(negatives)).agg(
        F.avg("auc").alias("mean_auc"), F.count(F.lit(1)).alias("n_users")
    )


# --- factor models ------------------------------------------------------------------------

# One block of the solver for so many ratings.
BLOCK_RATINGS = 4_000_000


# Iterations of the solver between two checkpoints.
CHECKPOINT_EVERY = 1
# Seconds between two sweeps.
SWEEP_SECONDS = 10.0


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Let the driver notice what nothing refers to any more while the block runs, so that the
    shuffle files of the solver's earlier steps go and do not wait for a full heap."""
    ended = threading.Event()

    def sweep() -> None:
        while not ended.wait(SWEEP_SECONDS):
            spark._jvm.System.gc()

    thread = threading.Thread(target=inheritable_thread_target(spark)(sweep), daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()


class Setting(NamedTuple):
    rank: int
    reg: float
    alpha: float


class DenseRatings(NamedTuple):
    """Summed ratings (user_no, item_no, rating) and the ids that the numbers stand for."""

    rows: DataFrame
    users: DataFrame
    items: DataFrame


class Factors(NamedTuple):
    """A model over user and item numbers and the ids that they stand for."""

    model: ALSModel
    users: DataFrame
    items: DataFrame


def dense_ratings(ratings: DataFrame) -> DenseRatings:
    """Ratings with users and items numbered 0, 1, …, as the solver takes 32-bit numbers
    only. Rows without a user or an item drop out."""
    known = cut(sum_ratings(ratings.filter("user is not null and item is not null")))
    users, items = (cut(number_keys(known, side, f"{side}_no")) for side in ("user", "item"))
    rows = lookup(known, users, "user", "inner", spread=["item"])
    rows = lookup(rows, items, "item", "inner", spread=["user"], probe=known)
    return DenseRatings(rows.select("user_no", "item_no", "rating"), users, items)


def fit_factors(
    dense: DenseRatings, rank: int, iterations: int, reg: float, alpha: float, seed: int, blocks: int | None = None
) -> Factors:
    """Implicit-feedback factors in `blocks` blocks, by default by the number of ratings."""
    ensure_checkpoint_dir(dense.rows.sparkSession)
    if blocks is None:
        blocks = max(10, -(-dense.rows.count() // BLOCK_RATINGS))
    als = ALS(
        userCol="user_no", itemCol="item_no", ratingCol="rating", implicitPrefs=True, coldStartStrategy="drop",
        rank=rank, maxIter=iterations, regParam=reg, alpha=alpha, seed=seed,
        numUserBlocks=blocks, numItemBlocks=blocks,
        # A checkpoint cuts the lineage, whose shuffle files nothing reads any more.
        checkpointInterval=CHECKPOINT_EVERY,
    )
    with swept(dense.rows.sparkSession):
        return Factors(als.fit(dense.rows), dense.users, dense.items)


def train_factors(
    ratings: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, alpha: float = 1.0, seed: int = 7,
    blocks: int | None = None,
) -> Factors:
    """Implicit-feedback factors of summed ratings; ids may have any type and width."""
    with persisted(*dense_ratings(ratings)) as kept:
        return fit_factors(DenseRatings(*kept), rank, iterations, reg, alpha, seed, blocks)


def factor_table(factors: Factors) -> DataFrame:
    """Factors of both sides under their own ids: (id, features, side)."""
    def named(vectors: DataFrame, numbers: DataFrame, side: str) -> DataFrame:
        joined = vectors.withColumnRenamed("id", f"{side}_no").join(numbers, f"{side}_no")
        return joined.select(F.col(side).alias("id"), "features", F.lit(side).alias("side"))

    users = named(factors.model.userFactors, factors.users, "user")
    return users.unionByName(named(factors.model.itemFactors, factors.items, "item"))


def factor_scores(factors: Factors) -> Predictor:
    """A predictor over the model; pairs with an unknown user or item drop out."""
    def predict(pairs: DataFrame) -> DataFrame:
        known = pairs.join(factors.users, "user").join(factors.items, "item")
        scored = factors.model.transform(known)
        return scored.select(*pairs.columns, F.col("prediction").cast("double").alias("score"))

    return predict


def recommend(factors: Factors, users: DataFrame, n: int) -> DataFrame:
    """The `n` best items of each given user: (user, place, item, score)."""
    chosen = factors.users.join(users.select("user"), "user", "left_semi").select("user_no")
    picks = factors.model.recommendForUserSubset(chosen, n)
    rows = picks.select("user_no", F.posexplode("recommendations").alias("place", "pick"))
    rows = rows.select("user_no", (F.col("place") + 1).alias("place"), "pick.item_no", F.col("pick.rating").alias("score"))
    named = rows.join(factors.users, "user_no").join(factors.items, "item_no")
    return named.select("user", "place", "item", "score")


def recommendation_lines(picks: DataFrame) -> DataFrame:
    """One text line per user: `user -> item, item, …` in order of preference."""
    lists = picks.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("place", "item"))).alias("picks"))
    items = F.array_join(F.transform("picks", lambda pick: pick["item"].cast("string")), ", ")
    return lists.select("user", F.concat(F.col("user").cast("string"), F.lit(" -> "), items).alias("line"))


# --- one half step, as a check of the solver and a way to fold in new users --------------------


def hashed_factors(keys: DataFrame, key: str, rank: int) -> DataFrame:
    """(key, factor): `rank` numbers from 0 up to 1 per key, made from hashes of it."""
    values = [bucket(F.col(key), f"factor{i}") / F.lit(float(BUCKETS)) for i in range(rank)]
    return keys.select(key, F.array(*values).alias("factor"))


def _products(rank: int) -> list[tuple[int, int]]:
    """The cells on and below the diagonal of a symmetric matrix, row by row."""
    return [(i, j) for i in range(rank) for j in range(i + 1)]


def factor_gram(factors: DataFrame, rank: int) -> list[float]:
    """The lower cells of Σ y·yᵀ over all factors y; one row of sums reaches the driver."""
    y = F.col("factor")
    sums = factors.agg(*[F.sum(y[i] * y[j]) for i, j in _products(rank)]).first()
    return [value or 0.0 for value in sums]


def normal_equations(
    ratings: DataFrame, factors: DataFrame, rank: int, reg: float, alpha: float, probe: DataFrame | None = None
) -> DataFrame:
    """Per user the equations A·x = b of its implicit-feedback factor, given those of the
    items: (user, cells, sums), `cells` being A's lower ones and `sums` b.

    Σ y·yᵀ over all items, plus α·|r|·y·yᵀ over the user's, plus λ times its positive ratings
    on the diagonal; b adds (1 + α·|r|)·y where r > 0. Items without a factor add nothing. The
    sums are partial before the shuffle, so a user with many ratings is no hot key.
    """
    gram = factor_gram(factors, rank)
    rows = lookup(ratings, factors, "item", "inner", spread=["user"], probe=probe)
    y, trust, liked = F.col("factor"), F.lit(float(alpha)) * F.abs("rating"), F.col("rating") > 0
    cells = [F.sum(trust * y[i] * y[j]).alias(f"a{i}_{j}") for i, j in _products(rank)]
    sums = [F.sum(F.when(liked, (1 + trust) * y[i]).otherwise(0.0)).alias(f"b{i}") for i in range(rank)]
    per_user = rows.groupBy("user").agg(*cells, *sums, F.sum(liked.cast("double")).alias("liked"))
    whole = [
        F.col(f"a{i}_{j}") + F.lit(gram[n]) + (F.lit(float(reg)) * F.col("liked") if i == j else F.lit(0.0))
        for n, (i, j) in enumerate(_products(rank))
    ]
    return per_user.select("user", F.array(*whole).alias("cells"), F.array(*[f"b{i}" for i in range(rank)]).alias("sums"))


def solve_equations(equations: DataFrame, rank: int) -> DataFrame:
    """(user, factor): the solutions, whole batches of users at a time. A system without a
    single solution gets the shortest of the best ones."""
    products = _products(rank)
    kind = equations.schema["user"].dataType.simpleString()

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cells = batch.column("cells").flatten().to_numpy().reshape(n, len(products))
            sums = batch.column("sums").flatten().to_numpy().reshape(n, rank)
            whole = np.empty((n, rank, rank))
            for at, (i, j) in enumerate(products):
                whole[:, i, j] = whole[:, j, i] = cells[:, at]
            try:
                factors = np.linalg.solve(whole, sums[..., None])[..., 0]
            except np.linalg.LinAlgError:
                factors = (np.linalg.pinv(whole, hermitian=True) @ sums[..., None])[..., 0]
            at = pa.array(np.arange(0, (n + 1) * rank, rank, dtype=np.int32))
            lists = pa.ListArray.from_arrays(at, pa.array(factors.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("user"), lists], names=["user", "factor"])

    return equations.mapInArrow(solved, f"user {kind}, factor array<double>")


def half_step(
    ratings: DataFrame, factors: DataFrame, rank: int, reg: float, alpha: float, probe: DataFrame | None = None
) -> DataFrame:
    """(user, factor): the best user factors for given item factors (item, factor), which is
    one half step of the factor model's training. `ratings` has one row per user and item."""
    return solve_equations(normal_equations(ratings, factors, rank, reg, alpha, probe), rank)


def pair_scores(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Score (user, item) rows by the product of their factors; pairs without one drop out."""
    rows = lookup(pairs, users.withColumnRenamed("factor", "_x"), "user", "inner", spread=["item"], probe=pairs)
    rows = lookup(rows, items.withColumnRenamed("factor", "_y"), "item", "inner", spread=["user"], probe=pairs)
    product = F.aggregate(F.zip_with("_x", "_y", lambda x, y: x * y), F.lit(0.0), lambda total, term: total + term)
    return rows.select(*pairs.columns, product.alias("score"))


# Settings fitted side by side where one is small: its blocks seldom fill all cores, above all at
# its end. Of more ratings than a block takes, one at a time keeps its factors on disk.
AT_ONCE = 3

FULL_GRID = [Setting(*values) for values in itertools.product([10, 50], [1.0, 0.0001], [1.0, 40.0])]


def factor_grid(
    train: DataFrame, held_out: DataFrame, items: DataFrame,
    settings: Sequence[Setting] = FULL_GRID, iterations: int = 10, seed: int = 7,
) -> DataFrame:
    """Mean AUC of one model per setting, best first. The negatives are drawn once."""
    spark = train.sparkSession
    pairs = held_out.select("user", "item")
    dense = dense_ratings(train)
    with persisted(dense.rows, pairs) as (rows, positive):
        dense = dense._replace(rows=rows)
        negative = cut(negative_samples(positive, items).select("user", "item"))

        def judged(setting: Setting) -> Row:
            predict = factor_scores(fit_factors(dense, setting.rank, iterations, setting.reg, setting.alpha, seed))
            auc = user_auc(predict(positive), predict(negative)).agg(F.avg("auc")).first()[0]
            return Row(**setting._asdict(), mean_auc=auc)

        ensure_checkpoint_dir(spark)
        with ThreadPool(AT_ONCE if rows.count() <= BLOCK_RATINGS else 1) as pool:
            results = pool.map(inheritable_thread_target(spark)(judged), settings, chunksize=1)
    schema = "rank int, reg double, alpha double, mean_auc double"
    return spark.createDataFrame(results, schema).orderBy(F.desc("mean_auc"))
