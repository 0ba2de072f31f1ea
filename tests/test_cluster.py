from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from datamill.operators import classify as trees
from datamill.operators import cluster as clu


def vectors(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id bigint, point array<double>")
    return df.withColumn("features", array_to_vector("point"))


def test_standardise_uses_population_deviation(spark):
    df = vectors(spark, [[1.0, 5.0, -3.0], [2.0, 5.0, 1.0], [6.0, 5.0, 0.5]])
    scaled = np.array([r.x for r in clu.standardise(df).orderBy("id").select(vector_to_array("features").alias("x")).collect()])
    points = np.array([[1.0, 5.0, -3.0], [2.0, 5.0, 1.0], [6.0, 5.0, 0.5]])
    spread = points.std(axis=0)
    assert np.allclose(scaled, (points - points.mean(axis=0)) / np.where(spread > 0, spread, 1))


def test_constant_dimension_is_only_centred_on_new_rows(spark):
    scale = clu.fit_standardiser(vectors(spark, [[1.0, 5.0], [3.0, 5.0]]))
    row = scale(vectors(spark, [[3.0, 9.0]])).select(vector_to_array("features").alias("x")).first().x
    assert np.allclose(row, [1.0, 4.0])


def test_one_hot_order_and_unseen_category(spark):
    df = spark.createDataFrame([(1.0, "b", 7.0), (2.0, "a", 8.0)], "x double, s string, y double")
    model = clu.one_hot_features(df, ["x"], ["s"], ["y"])
    rows = model.transform(df).select(vector_to_array("features").alias("v")).collect()
    assert [r.v for r in rows] == [[1.0, 0.0, 1.0, 7.0], [2.0, 1.0, 0.0, 8.0]]
    other = spark.createDataFrame([(1.0, "c", 7.0)], "x double, s string, y double")
    with pytest.raises(Exception):
        model.transform(other).collect()


def test_nearest_centre_takes_the_lowest_on_a_tie(spark):
    centres = spark.createDataFrame([(1, [2.0, 0.0]), (0, [0.0, 0.0]), (2, [9.0, 9.0])], "cluster int, centre array<double>")
    rows = clu.nearest_centre(vectors(spark, [[1.0, 0.0], [9.0, 8.0]]), "point", centres).orderBy("id").collect()
    assert [(r.cluster, r.distance) for r in rows] == [(0, 1.0), (2, 1.0)]


def test_entropy(spark):
    pure = spark.createDataFrame([(0, "a", 3), (1, "b", 4)], "cluster int, label string, n bigint")
    assert abs(clu.cluster_entropy(pure).first().entropy) < 1e-12
    mixed = spark.createDataFrame([(0, "a", 2), (0, "b", 2), (1, "b", 4)], "cluster int, label string, n bigint")
    assert abs(clu.cluster_entropy(mixed).first().entropy - math.log(2) / 2) < 1e-12


def test_threshold_and_outliers(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("distance"))
    assert clu.kth_largest(df, "distance", 3).first().threshold == 7.0
    assert sorted(r.distance for r in clu.outliers(df, "distance", 3).collect()) == [8.0, 9.0]
    assert clu.kth_largest(df, "distance", 99).first().threshold == 0.0


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in ((0, 0), (5, 5), (0, 9))])
    df = vectors(spark, points.tolist())
    return df.withColumn("label", F.floor(F.col("id") / 40))


def test_kmeans_finds_the_blobs(spark, blobs):
    model = clu.train_kmeans(blobs, 3, 1e-6)
    placed = clu.with_distance(model, blobs)
    assert abs(clu.cluster_entropy(clu.cluster_label_counts(placed)).first().entropy) < 1e-9
    assert placed.agg(F.max("distance")).first()[0] < 1
    scan = clu.distance_scan(blobs, [2, 3]).collect()
    assert [r.k for r in scan] == [2, 3] and scan[0].mean_distance > 5 * scan[1].mean_distance
    assert clu.entropy_scan(blobs, [3]).first().entropy < 1e-9


def test_models_of_a_scan_step_together(spark, blobs, monkeypatch):
    steps = []
    moved = clu.move_each

    def counted(points, models):
        steps.append(sorted(models))
        return moved(points, models)

    monkeypatch.setattr(clu, "move_each", counted)
    found = clu.fit_each(blobs.select("features"), [2, 3, 5], 1e-6, 7, 2)
    assert steps[0] == [2, 3, 5] and len(steps) <= 20
    for k, centres in found.items():
        alone = np.array(clu.train_kmeans(blobs, k, 1e-6).clusterCenters())
        assert np.allclose(centres.points, alone, atol=1e-9)


def test_detector_flags_the_far_point(spark):
    schema = "x double, s string, y double"
    df = spark.createDataFrame([(float(i % 5), "a" if i % 2 else "b", 0.0) for i in range(60)], schema)
    prepare = clu.one_hot_features(df, ["x"], ["s"], ["y"])
    scale = clu.fit_standardiser(prepare.transform(df))
    detect = clu.fit_detector(df, prepare, scale, k=2, place=2)
    assert detect(df).count() <= 1
    assert [r.x for r in detect(spark.createDataFrame([(500.0, "a", 0.0), (2.0, "b", 0.0)], schema)).collect()] == [500.0]


def test_sample_lines(spark, blobs):
    model = clu.train_kmeans(blobs, 3)
    lines = clu.sample_lines(blobs, model, 0.5).collect()
    assert 20 < len(lines) < 100 and all(len(r.value.split(",")) == 3 for r in lines)


def test_scaling_keeps_digits_far_from_zero(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    values = [1e9, 1e9 + 1, 1e9 + 5]
    rows = spark.createDataFrame([([v],) for v in values], "v array<double>")
    rows = rows.select(array_to_vector("v").alias("features"))
    got = [r[0] for r in clu.standardise(rows).select(vector_to_array("features")[0].alias("x")).orderBy("x").collect()]
    mean = sum(v - 1e9 for v in values) / 3
    spread = (sum((v - 1e9 - mean) ** 2 for v in values) / 3) ** 0.5
    assert all(abs(g - (v - 1e9 - mean) / spread) < 1e-7 for g, v in zip(got, values))


def test_nearest_centre_keeps_rows_and_digits(spark):
    """Far from zero the product form alone would mix up near centres; odd rows stay."""
    base = 1e8
    centres = spark.createDataFrame([(7, [base, base]), (9, [base + 1, base]), (8, [base + 1, base])], "cluster bigint, centre array<double>")
    rows = [(0, [base + 0.4, base], "a"), (1, [base + 0.6, base], None), (2, None, "c"), (3, [base + 0.5, base], "d")]
    df = spark.createDataFrame(rows, "id bigint, point array<double>, table string")
    placed = clu.nearest_centre(df, "point", centres)
    assert placed.columns == ["id", "point", "table", "cluster", "distance"]
    got = {r.id: (r.cluster, r.distance, r.table) for r in placed.collect()}
    assert [got[i][0] for i in range(4)] == [7, 8, None, 7] and abs(got[0][1] - 0.4) < 1e-6 and got[2][1:] == (None, "c")
    assert clu.nearest_centre(df, "point", centres.limit(0)).filter("cluster is null").count() == 4


def test_nearest_centre_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    points, table = rng.normal(size=(200, 5)), rng.normal(size=(17, 5))
    monkeypatch.setattr(clu, "CELLS_AT_ONCE", 300)
    centres = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(table)], "cluster int, centre array<double>")
    got = clu.nearest_centre(vectors(spark, points.tolist()).drop("features"), "point", centres).orderBy("id").collect()
    spans = np.sqrt(((points[:, None] - table) ** 2).sum(axis=2))
    assert [r.cluster for r in got] == spans.argmin(axis=1).tolist()
    assert np.allclose([r.distance for r in got], spans.min(axis=1), rtol=1e-14)


def test_scans_judge_all_models_in_one_pass(spark, blobs):
    models = clu.fit_each(blobs, [2, 3], 1e-4, 7, 2)
    sums = clu.assign_each(blobs, models, "label").collect()
    for k, centres in models.items():
        points = np.array([r.point for r in blobs.orderBy("id").collect()])
        spans = np.sqrt(((points[:, None] - centres.points) ** 2).sum(axis=2))
        assert abs(sum(r.distance for r in sums if r.k == k) - spans.min(axis=1).sum()) < 1e-9
        cells = {(r.cluster, int(r.label)): r.n for r in sums if r.k == k}
        want = {}
        for i, c in enumerate(spans.argmin(axis=1).tolist()):
            want[c, i // 40] = want.get((c, i // 40), 0) + 1
        assert cells == want


def test_a_million_categories_stay_in_tables(spark):
    """Numbered in their order, joined and opened without a list of them anywhere."""
    n = 1_000_000
    rows = spark.range(n).select("id", F.format_string("c%07d", F.col("id")).alias("s"), F.lit(0.0).alias("x"), (F.col("id") + 1.0).alias("y"))
    wide, sizes = clu.sparse_one_hot(rows, ["x"], ["s"], ["y"])
    assert sizes == [n]
    entries = clu.vector_entries(wide, "features", "id")
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert "vector_to_array" not in plan and "UDF" not in plan
    wrong = entries.filter(~(((F.col("dim") == F.col("id") + 1) & (F.col("value") == 1)) | ((F.col("dim") == n + 1) & (F.col("value") == F.col("id") + 1))))
    assert entries.count() == 2 * n and wrong.count() == 0
    back = wide.select("id", trees.sparse_block_index(F.col("features"), 1, sizes[0]).alias("i"))
    assert back.filter("i <> id").count() == 0


def test_sparse_blocks_of_odd_rows(spark):
    df = spark.createDataFrame([(1.0, "b", 7.0), (0.0, None, 0.0), (2.0, "a", None)], "x double, s string, y double")
    rows, sizes = clu.sparse_one_hot(df, ["x"], ["s"], ["y"])
    got = sorted((tuple(r.features.indices), tuple(r.features["values"])) for r in rows.collect())
    assert sizes == [2] and got == [((0, 1, 3), (2.0, 1.0, None)), ((0, 2, 3), (1.0, 1.0, 7.0)), ((0, 3), (0.0, 0.0))]
    assert sorted((r.dim, r.value) for r in clu.vector_entries(rows, "features").collect()) == [(0, 1.0), (0, 2.0), (1, 1.0), (2, 1.0), (3, 7.0)]
    index = rows.select(trees.sparse_block_index(F.col("features"), 1, 2).alias("i")).collect()
    assert sorted(r.i for r in index) == [-1.0, 0.0, 1.0]


def test_seeds_are_different_points(spark, blobs):
    with_twins = blobs.unionByName(blobs)
    seeds = clu.seed_centres(with_twins, "id", "point", 3).collect()
    assert sorted(r.key // 40 for r in seeds) == [0, 1, 2]  # one of each far group
    few = vectors(spark, [[1.0, 1.0]] * 5 + [[2.0, 2.0]])
    assert clu.seed_centres(few, "id", "point", 4).count() == 2
    assert clu.seed_centres(few.limit(0), "id", "point", 4).count() == 0

