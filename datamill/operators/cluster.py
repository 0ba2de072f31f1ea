"""Feature scaling, one-hot blocks, k-means, cluster quality and outliers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructType

from datamill.functions.buckets import BUCKETS, bucket
from datamill.operators.ranking import number_sorted
from datamill.operators.sampling import bernoulli_sample, hash_sample
from datamill.operators.skew import lookup
from datamill.session import cut, persisted, ship


# --- features ---------------------------------------------------------------------------------


def assemble(df: DataFrame, numeric: Sequence[str], out: str = "features") -> DataFrame:
    """The numeric columns as one vector; all other columns stay as they are."""
    return VectorAssembler(inputCols=list(numeric), outputCol=out).transform(df)


def one_hot_features(
    df: DataFrame, first: Sequence[str], symbolic: Sequence[str], rest: Sequence[str], invalid: str = "error"
) -> PipelineModel:
    """Fit the stages that turn symbolic columns into full 0/1 blocks, categories in
    alphabetical order, and place the blocks between the first and the other numerics.

    A category that was not there when fitting fails the job unless `invalid` is "keep".
    """
    index = [f"{name}_index" for name in symbolic]
    block = [f"{name}_block" for name in symbolic]
    indexer = StringIndexer(
        inputCols=list(symbolic), outputCols=index, stringOrderType="alphabetAsc", handleInvalid=invalid
    )
    encoder = OneHotEncoder(inputCols=index, outputCols=block, dropLast=False, handleInvalid=invalid)
    assembler = VectorAssembler(inputCols=[*first, *block, *rest], outputCol="features")
    return Pipeline(stages=[indexer, encoder, assembler]).fit(df)


def sparse_one_hot(
    df: DataFrame, first: Sequence[str], symbolic: Sequence[str], rest: Sequence[str], out: str = "features"
) -> tuple[DataFrame, list[int]]:
    """Add `out`, a sparse vector (size, indices, values) of the first numbers, a 0/1 block per
    symbolic column with its categories in alphabetical order, and the other numbers; and give
    the sizes of the blocks.

    Categories are numbered in tables of their own, which are joined, so their number is not
    bounded by a task or the driver. A null category has no 1 in its block.
    """
    sizes, placed = [], df
    # One pass finds the categories of all columns; only these are read to number them.
    kinds = cut(df.groupBy(*symbolic).agg(F.count(F.lit(1)).alias("_n")))
    total = kinds.agg(F.sum("_n")).first()[0] or 0
    for i, name in enumerate(symbolic):
        table = cut(number_sorted(kinds, name, f"_place{i}"))
        sizes.append(table.count())
        placed = lookup(placed, table, name, total=total, probe=df)
    starts = [len(first) + sum(sizes[:i]) for i in range(len(symbolic))]
    end = len(first) + sum(sizes)
    dims = [(F.lit(i), F.col(c)) for i, c in enumerate(first)]
    dims += [(F.col(f"_place{i}") + F.lit(start), F.lit(1.0)) for i, start in enumerate(starts)]
    dims += [(F.lit(end + i), F.col(c)) for i, c in enumerate(rest)]
    cells = F.array(*[F.struct(d.cast("bigint").alias("dim"), v.cast("double").alias("value")) for d, v in dims])
    kept = F.filter(cells, lambda cell: cell["dim"].isNotNull())
    vector = F.struct(
        F.lit(end + len(rest)).cast("bigint").alias("size"), F.transform(kept, lambda c: c["dim"]).alias("indices"),
        F.transform(kept, lambda c: c["value"]).alias("values"),
    )
    return placed.withColumn(out, vector).select(*[c for c in df.columns if c != out], out), sizes


def vector_entries(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Non-zero entries of a sparse vector in long form: (keys…, dim, value)."""
    cells = F.arrays_zip(F.col(f"{vector}.indices").alias("dim"), F.col(f"{vector}.values").alias("value"))
    rows = df.select(*keys, F.explode(cells).alias("cell"))
    return rows.select(*keys, F.col("cell.dim").cast("int").alias("dim"), "cell.value").filter("value <> 0")


def vector_moments(df: DataFrame, vector: str = "features") -> DataFrame:
    """Count, mean and population deviation of each dimension: (dim, n, mean, stdev)."""
    stats = Summarizer.metrics("count", "mean", "variance").summary(F.col(vector))
    row = df.agg(stats.alias("s")).select(
        F.col("s.count").alias("n"),
        F.posexplode(F.arrays_zip(vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v")))
        .alias("dim", "moment"),
    )
    # The summary gives the sample variance.
    population = F.sqrt(F.col("moment.v") * (F.col("n") - 1) / F.col("n"))
    return row.select("dim", "n", F.col("moment.m").alias("mean"), population.alias("stdev"))


def standardise(df: DataFrame, vector: str = "features", out: str = "features") -> DataFrame:
    """Centre each dimension and divide it by its population deviation; a dimension without
    spread is only centred."""
    return fit_standardiser(df, vector, out)(df)


def fit_standardiser(
    df: DataFrame, vector: str = "features", out: str = "features"
) -> Callable[[DataFrame], DataFrame]:
    """The scaling learned from `df` in one pass, to be used on other rows as well."""
    moments = vector_moments(df, vector).orderBy("dim").collect()
    mean = np.array([m["mean"] for m in moments])
    spread = np.array([m["stdev"] if m["stdev"] > 0 else 1.0 for m in moments])
    def apply(rows: DataFrame) -> DataFrame:
        values = vector_to_array(vector)
        centre, by = (F.array(*map(F.lit, row.tolist())) for row in (mean, spread))
        scaled = F.transform(values, lambda x, i: (x - F.get(centre, i)) / F.get(by, i))
        return rows.withColumn(out, array_to_vector(scaled))

    return apply


# --- fixed centres -------------------------------------------------------------------------------


def class_centres(df: DataFrame, point: str, label: str) -> DataFrame:
    """Mean point of each class: (cluster, centre)."""
    means = df.groupBy(label).agg(Summarizer.mean(array_to_vector(point)).alias("mean"))
    return means.select(F.col(label).alias("cluster"), vector_to_array("mean").alias("centre"))


class Centres(NamedTuple):
    """Named points, in the order of their names: the i-th row of `points` is `names[i]`."""

    names: list
    points: np.ndarray


def centre_table(centres: DataFrame) -> Centres:
    """The rows (cluster, centre). They are a model's parameters, k points in all."""
    rows = sorted(centres.collect(), key=lambda row: row.cluster)
    return Centres([row.cluster for row in rows], np.array([row.centre for row in rows], np.float64))


# Products with centres are taken for so many of them at once.
CELLS_AT_ONCE = 1 << 21
# |x|² - 2xc + |c|² loses digits: nearer than this part of |x|² + |c|², distances are taken anew.
SAME = 1e-9


def _places(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Row number of the nearest centre of each point, the first on a tie."""
    own, squares = (points * points).sum(axis=1), (centres * centres).sum(axis=1)
    # |c|² - 2xc as one product.
    spans = np.column_stack([points, np.ones(len(points))]) @ np.vstack([-2 * centres.T, squares])
    rows, place = np.arange(len(points)), spans.argmin(axis=1)
    best = spans[rows, place]
    spans[rows, place] = np.inf
    for row in np.flatnonzero(spans.min(axis=1) <= best + SAME * (own + squares.max())):
        place[row] = ((points[row] - centres) ** 2).sum(axis=1).argmin()
    return place


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number of the nearest centre, the first on a tie, and the distance to it."""
    place = _places(points, centres)
    return place, np.sqrt(((points - centres[place]) ** 2).sum(axis=1))


def _point_blocks(points: pa.Array, dims: int, rows: int) -> Iterator[tuple[slice, np.ndarray]]:
    """A list column as matrices of at most `rows` rows."""
    for low in range(0, len(points), rows):
        part = points.slice(low, rows)
        yield slice(low, low + len(part)), part.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def nearest_centre(df: DataFrame, point: str, centres: DataFrame | Centres) -> DataFrame:
    """Add the `cluster` of the nearest centre, the lowest on a tie, and the `distance`.

    The few centres come in with the task, so rows stay where they are, and whole Arrow
    batches are multiplied with them. Points that are null have neither.
    """
    if not isinstance(centres, Centres):
        kind = centres.schema["cluster"].dataType
        centres = centre_table(centres)
    else:
        kind = IntegerType()
    ship(df.sparkSession)
    table, whole = centres.points, [c for c in df.columns if c not in ("cluster", "distance")]
    at_once = max(1, CELLS_AT_ONCE // max(table.size, 1))
    names = pa.array(centres.names, to_arrow_type(kind))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column("_point")
            known = points.is_valid().to_numpy(zero_copy_only=False)
            place, distance = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, np.nan)
            rows = np.flatnonzero(known)
            for part, block in _point_blocks(points.drop_null(), table.shape[-1] if table.size else 1, at_once):
                if len(table):
                    place[rows[part]], distance[rows[part]] = _nearest(block, table)
            unknown = ~known | (len(table) == 0)
            cluster = names.take(pa.array(place, mask=unknown)) if len(names) else pa.nulls(batch.num_rows, names.type)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in whole], cluster, pa.array(distance, mask=unknown)],
                names=[*whole, "cluster", "distance"],
            )

    schema = StructType([*[df.schema[c] for c in whole]]).add("cluster", kind).add("distance", "double")
    return df.withColumn("_point", F.col(point).cast("array<double>")).mapInArrow(placed, schema)


def moved_centres(placed: DataFrame, point: str) -> DataFrame:
    """Mean of the points of each cluster, in long form: (cluster, n, dim, value)."""
    means = placed.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(array_to_vector(point)).alias("mean")
    )
    return means.select("cluster", "n", F.posexplode(vector_to_array("mean")).alias("dim", "value"))


def cluster_label_counts(placed: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    counts = placed.groupBy(F.col(cluster).alias("cluster"), F.col(label).alias("label"))
    return counts.agg(F.count(F.lit(1)).alias("n")).orderBy("cluster", "label")


def cluster_entropy(counts: DataFrame, *keys: str) -> DataFrame:
    """Label entropy (natural log) of the clusters, weighted by their sizes, from counts per
    (cluster, label); one number, or one for each value of `keys`."""
    # Σ_label -n·ln(n/size) = size·ln(size) - Σ n·ln(n), so one grouping by cluster is enough.
    per_cluster = counts.filter("n > 0").groupBy(*keys, "cluster").agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.log("n")).alias("spread")
    )
    weighted = F.sum(F.col("size") * F.log("size") - F.col("spread"))
    return per_cluster.groupBy(*keys).agg((weighted / F.sum("size")).alias("entropy"))


def kth_largest(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k-th largest value of a column, the smallest one when there are fewer rows."""
    return df.select(column).orderBy(F.desc(column)).limit(k).agg(F.min(column).alias("threshold"))


def outliers(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose value is above the k-th largest value."""
    return df.filter(F.col(column) > kth_largest(df, column, k).scalar())


# --- trained models -------------------------------------------------------------------------------


def train_kmeans(df: DataFrame, k: int = 2, tol: float = 1e-4, iterations: int = 20, seed: int = 7) -> KMeansModel:
    """k-means of the `features` vectors.

    The selection makes the input a new plan even if `df` is cached, so the solver keeps its
    own rows with their norms and does not decode the cached columns in every iteration.
    """
    kmeans = KMeans(k=k, tol=tol, maxIter=iterations, seed=seed, featuresCol="features", predictionCol="cluster")
    return kmeans.fit(df.select("features"))


def model_centres(model: KMeansModel) -> Centres:
    points = np.array(model.clusterCenters(), np.float64)
    return Centres(list(range(len(points))), points)


def with_distance(model: KMeansModel, df: DataFrame) -> DataFrame:
    """Add the `cluster` and the `distance` to its centre."""
    columns = df.columns
    rows = df.withColumn("_features", vector_to_array("features"))
    plain = rows.select(*[c for c in rows.columns if c != "features"])
    placed = nearest_centre(plain, "_features", model_centres(model))
    kept = [array_to_vector("_features").alias(c) if c == "features" else F.col(c) for c in columns]
    return placed.select(*kept, "cluster", "distance")


def assign_each(df: DataFrame, models: dict[int, Centres], label: str | None = None) -> DataFrame:
    """Every row placed by every model in one pass, as sums: (k, cluster, n, distance), with
    the `label` where one is named. `distance` is the sum over the cluster's rows."""
    ship(df.sparkSession)
    columns = [vector_to_array("features").alias("point"), *([F.col(label).cast("string").alias("label")] if label else [])]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("label").dictionary_encode() if label else None
            kinds = own.dictionary.to_pylist() if label else [None]
            codes = own.indices.fill_null(len(kinds)).to_numpy(zero_copy_only=False) if label else np.zeros(batch.num_rows, np.int64)
            kinds = [*kinds, None]
            rows = []
            for k, centres in models.items():
                dims, at_once = centres.points.shape[1], max(1, CELLS_AT_ONCE // centres.points.size)
                for part, block in _point_blocks(batch.column("point"), dims, at_once):
                    place, distance = _nearest(block, centres.points)
                    cell = place * len(kinds) + codes[part]
                    counts, sums = np.bincount(cell), np.bincount(cell, distance)
                    for c in np.flatnonzero(counts).tolist():
                        cluster, kind = divmod(c, len(kinds))
                        rows.append((k, centres.names[cluster], kinds[kind], int(counts[c]), float(sums[c])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.float64()))],
                    names=["k", "cluster", "label", "n", "distance"],
                )

    schema = "k int, cluster int, label string, n long, distance double"
    parts = df.filter("features is not null").select(*columns).mapInArrow(summed, schema)
    sums = parts.groupBy("k", "cluster", *(["label"] if label else []))
    return sums.agg(F.sum("n").alias("n"), F.sum("distance").alias("distance"))


# Cells of a product that stay near the processor while a step looks through them.
STEP_CELLS = 1 << 17
# Sums of the tasks are added in so many parts first, so that no group holds a row of every task.
SUM_PARTS = 64


def _add_sums(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(cells) for cells in table["cells"].to_pylist())
    return pa.table({"k": table["k"][:1].cast(pa.int32()), "cells": pa.array([total.tobytes()], pa.binary())})


def move_each(points: DataFrame, models: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The centres of each model moved to the mean of their points, all models in one pass
    over the `point` arrays. Only sums per centre are moved; a centre without points stays."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((centres.shape[1] + 1, len(centres))) for k, centres in models.items()}
        for batch in batches:
            for k, centres in models.items():
                for _, block in _point_blocks(batch.column("point"), centres.shape[1], max(1, STEP_CELLS // max(centres.shape))):
                    place = _places(block, centres)
                    sums[k][0] += np.bincount(place, minlength=len(centres))
                    for dim in range(centres.shape[1]):
                        sums[k][dim + 1] += np.bincount(place, block[:, dim], len(centres))
        yield pa.RecordBatch.from_pydict(
            {"k": pa.array(list(sums), pa.int32()), "cells": pa.array([s.tobytes() for s in sums.values()], pa.binary())}
        )

    schema = "k int, cells binary"
    part = F.pmod(F.xxhash64("cells"), F.lit(SUM_PARTS)).alias("part")
    some = points.mapInArrow(summed, schema).groupBy("k", part).applyInArrow(_add_sums, schema)
    moved = {}
    for row in some.groupBy("k").applyInArrow(_add_sums, schema).collect():
        centres = models[row.k]
        n, *sums = np.frombuffer(row.cells).reshape(centres.shape[1] + 1, len(centres))
        moved[row.k] = np.where(n[:, None] > 0, np.transpose(sums) / np.maximum(n, 1)[:, None], centres)
    return moved


def fit_each(
    df: DataFrame, ks: Sequence[int], tol: float, seed: int, parallel: int, iterations: int = 20
) -> dict[int, Centres]:
    """The centres of one model per k, as `train_kmeans` finds them.

    The solver draws the start centres, a few models at a time from driver threads. Then all
    models that have not settled yet take their steps in one pass over the rows, which are
    kept as plain arrays, so the rows are read once per step and not once per step and model.
    """
    ship(df.sparkSession)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        starts = pool.map(lambda k: train_kmeans(df, k, tol, 0, seed).clusterCenters(), ks)
        centres = {k: np.array(found, np.float64) for k, found in zip(ks, starts)}
    unsettled = list(centres)
    with persisted(df.select(vector_to_array("features").alias("point"))) as (points,):
        for _ in range(iterations):
            if not unsettled:
                break
            moved = move_each(points, {k: centres[k] for k in unsettled})
            unsettled = [k for k in unsettled if (((moved[k] - centres[k]) ** 2).sum(axis=1) > tol * tol).any()]
            centres.update(moved)
    return {k: Centres(list(range(len(found))), found) for k, found in centres.items()}


def distance_scan(
    df: DataFrame, ks: Sequence[int] = range(5, 41, 5), tol: float = 1e-4, seed: int = 7, parallel: int = 4
) -> DataFrame:
    """Mean distance to the nearest centre for each number of clusters: (k, mean_distance).
    All models are judged in one pass over the rows."""
    with persisted(df.select("features")) as (rows,):
        sums = assign_each(rows, fit_each(rows, list(ks), tol, seed, parallel))
        means = sums.groupBy("k").agg((F.sum("distance") / F.sum("n")).alias("mean_distance"))
        return cut(means.orderBy("k").coalesce(1))


def entropy_scan(
    df: DataFrame, ks: Sequence[int] = range(80, 161, 10), tol: float = 1e-6, seed: int = 7, parallel: int = 4
) -> DataFrame:
    """Weighted label entropy for each number of clusters: (k, entropy). All models are judged
    in one pass over the rows."""
    with persisted(df.select("features", "label")) as (rows,):
        counts = assign_each(rows, fit_each(rows, list(ks), tol, seed, parallel), "label")
        return cut(cluster_entropy(counts, "k").orderBy("k").coalesce(1))


def fit_detector(
    df: DataFrame, prepare: Transformer, scale: Callable[[DataFrame], DataFrame], k: int = 150, place: int = 100,
    tol: float = 1e-6, seed: int = 7,
) -> Callable[[DataFrame], DataFrame]:
    """Learn clusters of the scaled features and the `place`-th largest distance; the result
    keeps those rows of a frame that lie farther out than that."""

    def features(rows: DataFrame) -> DataFrame:
        return scale(prepare.transform(rows))

    with persisted(features(df)) as (known,):
        model = train_kmeans(known, k, tol, seed=seed)
        threshold = kth_largest(with_distance(model, known.select("features")), "distance", place).first()[0]

    def detect(rows: DataFrame) -> DataFrame:
        placed = with_distance(model, features(rows).select(*rows.columns, "features"))
        return placed.filter(F.col("distance") > threshold).select(*rows.columns, "cluster", "distance")

    return detect


def sample_lines(
    df: DataFrame, model: KMeansModel, fraction: float = 0.05, seed: int | None = 7, key: str | None = None
) -> DataFrame:
    """A sample of `cluster,f1,f2,…` lines for plotting elsewhere; with a `key` the same rows
    are taken in every run."""
    rows = hash_sample(df, F.col(key), fraction) if key else bernoulli_sample(df, fraction, seed)
    placed = model.transform(rows.select("features"))
    cells = vector_to_array("features").cast("array<string>")
    return placed.select(F.concat_ws(",", F.col("cluster").cast("string"), cells).alias("value"))


def seed_centres(df: DataFrame, key: str, point: str, k: int) -> DataFrame:
    """Start centres (place, key, point) by distance-weighted draws, as k-means++ takes them.

    Every row has a hashed number u per round; the row with the smallest -ln(u)/d² is taken,
    d being the distance to the nearest centre so far, which is a draw with weights d². A
    round is one pass with partial minima, and only the row that it takes reaches the driver.
    Fewer centres come out where fewer different points are there.
    """
    rows = df.filter(F.col(point).isNotNull()).select(F.col(key).alias("key"), F.col(point).cast("array<double>").alias("point"))
    names, found = [], []
    for place in range(k):
        u = (bucket(F.col("key"), f"seed{place}") + 1) / F.lit(float(BUCKETS))
        if found:
            centres = Centres(list(range(len(found))), np.array(found))
            far = nearest_centre(rows, "point", centres).filter("distance > 0")
            weighed = far.select("key", "point", (-F.log(u) / (F.col("distance") * F.col("distance"))).alias("draw"))
        else:
            weighed = rows.select("key", "point", u.alias("draw"))
        taken = weighed.agg(F.min_by(F.struct("key", "point"), F.struct("draw", "key")).alias("row")).first().row
        if taken is None:
            break
        names.append(taken.key)
        found.append(taken.point)
    kind = rows.schema["key"].dataType.simpleString()
    lines = [(place, name, row) for place, (name, row) in enumerate(zip(names, found))]
    return df.sparkSession.createDataFrame(lines, f"place int, key {kind}, point array<double>")
