from __future__ import annotations

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from datamill.operators import recommend as rec


def test_alias_is_replaced_one_level_only(spark):
    ratings = spark.createDataFrame([(1, 10, 2.0), (1, 10, 3.0), (2, 12, 1.0)], "user bigint, item bigint, rating double")
    alias = spark.createDataFrame([(10, 11), (11, 12)], "bad_id bigint, good_id bigint")
    rows = rec.canonical_ratings(ratings, alias)
    assert sorted((r.user, r.item, r.rating) for r in rows.collect()) == [(1, 11, 2.0), (1, 11, 3.0), (2, 12, 1.0)]
    assert {(r.user, r.item): r.rating for r in rec.sum_ratings(rows).collect()} == {(1, 11): 5.0, (2, 12): 1.0}


def test_unseen_items_score_zero(spark):
    train = spark.createDataFrame([(1, 5, 2.0), (2, 5, 4.0)], "user bigint, item bigint, rating double")
    pairs = spark.createDataFrame([(1, 5), (1, 6)], "user bigint, item bigint")
    assert {r.item: r.score for r in rec.popularity_scores(pairs, train).collect()} == {5: 6.0, 6: 0.0}


def test_negative_samples_fill_up_and_avoid_positives(spark):
    items = spark.range(40).select(F.col("id").alias("item"))
    # User 1 likes few items, user 2 nearly all, user 3 all of them.
    liked = {1: range(3), 2: range(38), 3: range(40)}
    rows = [(u, i) for u, likes in liked.items() for i in likes]
    positives = spark.createDataFrame(rows, "user bigint, item bigint")
    drawn = rec.negative_samples(positives, items).collect()
    per_user = {u: [r.item for r in drawn if r.user == u] for u in liked}
    assert len(per_user[1]) == 3 and not set(per_user[1]) & set(range(3))
    assert set(per_user[2]) <= {38, 39} and len(per_user[2]) <= 38
    assert per_user[3] == []
    assert all(r.draw < 40 for r in drawn)
    again = rec.negative_samples(positives, items).collect()
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, again))


def test_negative_samples_in_small_blocks_are_the_same(spark, monkeypatch):
    items = spark.range(60).select(F.col("id").alias("item"))
    rows = [(u, i) for u in (1, 2) for i in range(20 * u)]
    positives = spark.createDataFrame(rows, "user bigint, item bigint")
    whole = sorted(map(tuple, rec.negative_samples(positives, items).collect()))
    monkeypatch.setattr(rec, "DRAW_BLOCK", 7)
    assert sorted(map(tuple, rec.negative_samples(positives, items).collect())) == whole


def test_user_item_sets_are_cut_by_item_block(spark):
    ratings = spark.createDataFrame([(1, 3), (1, 1), (1, 3), (1, 12)], "user bigint, item bigint")
    rows = rec.user_item_sets(ratings, block_items=10).collect()
    assert {(r.item_block, r.n_items, tuple(r["items"])) for r in rows} == {(0, 2, (1, 3)), (1, 1, (12,))}


@pytest.fixture(scope="module")
def taste(spark):
    """Two groups of users that buy from two halves of the items."""
    user, step = F.col("id") % 60, F.floor(F.col("id") / 60)
    return spark.range(60 * 12).select(
        user.alias("user"),
        ((step * 7 + user) % 20 + F.when(user < 30, 0).otherwise(20)).alias("item"),
        F.lit(1.0).alias("rating"),
    )


def test_factor_model_learns_the_groups(spark, taste):
    items = taste.select("item").distinct()
    model = rec.train_factors(taste, rank=4, iterations=5)
    result = rec.mean_auc(taste, items, rec.factor_scores(model)).first()
    assert 0.9 < result.mean_auc <= 1
    users = spark.createDataFrame([(0,), (45,)], "user bigint")
    picks = rec.recommend(model, users, 3).collect()
    assert all((r.item < 20) == (r.user == 0) for r in picks) and len(picks) == 6
    lines = sorted(r.line for r in rec.recommendation_lines(rec.recommend(model, users, 3)).collect())
    assert lines[0].startswith("0 -> ") and lines[0].count(",") == 2


def test_factor_grid_is_sorted(spark, taste):
    items = taste.select("item").distinct()
    grid = rec.factor_grid(taste, taste, items, [rec.Setting(2, 1.0, 1.0), rec.Setting(4, 0.01, 1.0)], iterations=2)
    values = [r.mean_auc for r in grid.collect()]
    assert values == sorted(values, reverse=True) and all(0 <= v <= 1 for v in values)


def test_grid_settings_are_fitted_side_by_side(spark, taste, monkeypatch):
    both, fit = threading.Barrier(2), rec.fit_factors

    def met(*args):
        both.wait(timeout=60)  # breaks where a fit waits for the one before
        return fit(*args)

    settings = [rec.Setting(2, 1.0, 1.0), rec.Setting(4, 0.01, 1.0)]
    items = taste.select("item").distinct()
    monkeypatch.setattr(rec, "fit_factors", met)
    assert {r.rank for r in rec.factor_grid(taste, taste, items, settings, iterations=1).collect()} == {2, 4}


def test_wide_ids_work_like_narrow_ones(spark, taste):
    def wide(name):
        return (F.col(name) + F.lit(2**40)).alias(name)

    model = rec.train_factors(taste.select(wide("user"), wide("item"), "rating"), rank=4, iterations=5)
    users = spark.createDataFrame([(2**40,), (2**40 + 45,), (7,)], "user bigint")
    picks = [(r.user - 2**40, r.item - 2**40) for r in rec.recommend(model, users, 3).collect()]
    assert len(picks) == 6 and all((item < 20) == (user == 0) for user, item in picks)
    assert {r.side: r.n for r in rec.factor_table(model).groupBy("side").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        "user": 60, "item": 40
    }
    pairs = taste.select(wide("user"), wide("item")).distinct()
    scored = rec.factor_scores(model)(pairs.unionByName(users.select("user", F.lit(1).cast("bigint").alias("item"))))
    assert scored.columns == ["user", "item", "score"] and scored.count() == pairs.count()


def test_ratings_without_a_user_or_an_item_drop_out(spark, taste):
    odd = spark.createDataFrame([(None, 1, 1.0), (1, None, 1.0)], taste.select("user", "item", "rating").schema)
    dense = rec.dense_ratings(taste.unionByName(odd))
    assert dense.users.count() == 60 and dense.items.count() == 40
    assert dense.rows.count() == taste.select("user", "item").distinct().count()


def test_half_step_is_the_solvers(spark):
    """The model's own user factors follow from its item factors, so the step must give them."""
    rng = np.random.default_rng(4)
    rows = [(u, i, float(rng.integers(1, 6))) for u in range(40) for i in range(30) if rng.random() < 0.3]
    rows += [(100, 3, 2.0), (101, 4, -1.0), (101, 5, 3.0), (102, 999, 0.0)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    for rank, reg, alpha in ((3, 0.1, 1.0), (5, 0.5, 40.0)):
        factors = rec.train_factors(ratings, rank, 3, reg, alpha)
        table = rec.factor_table(factors).withColumnRenamed("features", "factor").withColumn("factor", F.col("factor").cast("array<double>"))
        items = table.filter("side = 'item'").select(F.col("id").alias("item"), "factor")
        want = {r.id: r.factor for r in table.filter("side = 'user'").collect()}
        got = {r.user: r.factor for r in rec.half_step(ratings, items, rank, reg, alpha).collect()}
        assert all(np.allclose(got[u], want[u], rtol=2e-3, atol=2e-4) for u in want if u != 102)
        scores = {(r.user, r.item): r.score for r in rec.factor_scores(factors)(ratings.select("user", "item")).collect()}
        users = spark.createDataFrame(list(got.items()), "user int, factor array<double>")
        mine = rec.pair_scores(ratings.select("user", "item"), users, items).collect()
        assert all(abs(scores[r.user, r.item] - r.score) < 5e-3 for r in mine if (r.user, r.item) in scores)


def test_half_step_without_a_single_solution(spark):
    ratings = spark.createDataFrame([(1, 1, 2.0)], "user int, item int, rating double")
    items = spark.createDataFrame([(1, [1.0, 1.0])], "item int, factor array<double>")
    row = rec.half_step(ratings, items, 2, 0.0, 1.0).first()
    assert np.allclose(row.factor, [0.5, 0.5])
    assert rec.half_step(ratings.limit(0), items, 2, 0.0, 1.0).count() == 0


def test_half_step_scores_make_the_ratings_once(spark, monkeypatch):
    from datamill.plans import recommender

    made = []

    def ratings(session, sf_dir):
        made.append(sf_dir)
        rows = [(f"{u}:{i}", u, i, 1.0 + i) for u in range(4) for i in range(u + 1)]
        return session.createDataFrame(rows, "row_key string, user bigint, item bigint, rating double")

    monkeypatch.setattr(recommender, "ratings", ratings)
    scores = recommender.als_half_step_scores(spark, "none")
    assert scores.count() == 10 and made == ["none"]


def some_ratings(spark):
    return spark.range(400).select(
        (F.col("id") % 20).alias("user"), (F.col("id") * 7 % 31).alias("item"), (F.col("id") % 5 + 1.0).alias("rating")
    )


def test_files_of_earlier_solver_steps_go(spark, monkeypatch):
    monkeypatch.setattr(rec, "SWEEP_SECONDS", 0.05, raising=False)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    dense = rec.dense_ratings(some_ratings(spark))
    dense = dense._replace(rows=dense.rows.localCheckpoint())
    before = disk.getAllFiles().size()
    rec.fit_factors(dense, 3, 12, 0.1, 1.0, 7)
    # Twelve iterations write 24 shuffles of ten parts, an index and a data file each.
    assert disk.getAllFiles().size() - before < 300


def test_settings_of_many_ratings_are_fitted_one_at_a_time(spark, monkeypatch):
    pools = []
    real = rec.ThreadPool
    monkeypatch.setattr(rec, "ThreadPool", lambda n: pools.append(n) or real(n))
    rows = some_ratings(spark)
    settings = [rec.Setting(2, 0.1, 1.0), rec.Setting(2, 0.1, 5.0)]
    held_out = rows.filter("item % 4 = 0").select("user", "item").distinct()
    grids = []
    for most in (1_000_000, 100):
        monkeypatch.setattr(rec, "BLOCK_RATINGS", most)
        grids.append(rec.factor_grid(rows, held_out, rows.select("item").distinct(), settings, 2).collect())
    assert pools == [rec.AT_ONCE, 1] and grids[0] == grids[1]
