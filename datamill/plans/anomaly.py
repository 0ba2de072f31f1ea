"""Anomaly detection: features, scaling, nearest centres, cluster quality, outliers."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import BUCKETS, share
from datamill.operators import cluster as clu
from datamill.operators.sampling import hash_sample
from datamill.plans.registry import query
from datamill.plans.standins import NUMERIC, SYMBOLIC, connection_records, sql_bucket, vectors
from datamill.session import cut, new_folder, persisted
from datamill.sources import text_files

KEYS = ["l_orderkey", "l_linenumber"]
OUTLIER_PLACE = 100

RECORDS_SQL = "lineitem join orders on l_orderkey = o_orderkey"


@query(
    "numeric_features",
    f"""select l_orderkey, l_linenumber, o_orderstatus as label, l_quantity as f0, l_extendedprice as f1,
        l_discount as f2, l_tax as f3 from {RECORDS_SQL}""",
)
def numeric_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clu.assemble(connection_records(spark, sf_dir).drop(*SYMBOLIC), NUMERIC)
    values = vector_to_array("features")
    features = [values[i].alias(f"f{i}") for i in range(len(NUMERIC))]
    return rows.select(*KEYS, F.col("o_orderstatus").alias("label"), *features)


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = connection_records(spark, sf_dir)
    return clu.one_hot_features(records, NUMERIC[:1], SYMBOLIC, NUMERIC[1:]).transform(records)


def sql_category(column: str) -> str:
    return f"select {column}, row_number() over (order by {column}) as place from (select distinct {column} from {RECORDS_SQL})"


def sql_one_hot() -> str:
    """Entries (dim, value) of each record: a number, three 0/1 blocks, further numbers."""
    names = [f"cat{i}" for i in range(len(SYMBOLIC))]
    ctes = ", ".join(f"{name} as ({sql_category(column)})" for name, column in zip(names, SYMBOLIC))
    sizes = [f"(select count(*) from {name})" for name in names]
    joins = " ".join(f"join {name} using ({column})" for name, column in zip(names, SYMBOLIC))
    entries = ["{'dim': 0, 'value': l_quantity}"]
    for i, name in enumerate(names):
        before = " + ".join(["0", *sizes[:i]])
        entries.append(f"{{'dim': {before} + {name}.place, 'value': 1.0}}")
    whole = " + ".join(sizes)
    for i, column in enumerate(NUMERIC[1:]):
        entries.append(f"{{'dim': {whole} + {i + 1}, 'value': {column}}}")
    return f"""with {ctes},
        dense as (
            select l_orderkey, l_linenumber, unnest([{', '.join(entries)}]) as e
            from {RECORDS_SQL} {joins})
        select l_orderkey, l_linenumber, cast(e.dim as integer) as dim, cast(e.value as double) as value
        from dense where e.value <> 0"""


@query("onehot_features", sql_one_hot())
def onehot_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = clu.sparse_one_hot(connection_records(spark, sf_dir), NUMERIC[:1], SYMBOLIC, NUMERIC[1:])
    return clu.vector_entries(rows, "features", *KEYS)


MOMENTS_SQL = f"""
    entries as ({sql_one_hot()}),
    total as (select count(*)::double as n from {RECORDS_SQL})
    select dim, (select cast(n as bigint) from total) as n,
           round(sum(value) / (select n from total), 8) as mean,
           round(sqrt(sum(power(value - m, 2)) / (select n from total)
                 + power(any_value(m), 2) * ((select n from total) - count(*)) / (select n from total)), 6) as stdev
    from entries join (select dim, sum(value) / (select n from total) as m from entries group by dim) using (dim)
    group by dim
"""


@query("vector_moments", f"with {MOMENTS_SQL}")
def vector_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = clu.vector_moments(one_hot(spark, sf_dir))
    return moments.withColumns({"mean": F.round("mean", 8), "stdev": F.round("stdev", 6)})


@query(
    "standardize",
    "select l_orderkey, l_linenumber, "
    + ", ".join(
        f"round(({c} - avg({c}) over ()) / nullif(stddev_pop({c}) over (), 0), 6) as z{i}"
        for i, c in enumerate(NUMERIC)
    )
    + f" from {RECORDS_SQL}",
)
def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clu.standardise(clu.assemble(connection_records(spark, sf_dir), NUMERIC))
    values = vector_to_array("features")
    return rows.select(*KEYS, *[F.round(values[i], 6).alias(f"z{i}") for i in range(len(NUMERIC))])


# --- fixed centres: the mean vector of each label ---------------------------------------------

PLACED_SQL = """
    points as (
        select vec_id, label, unnest(range(64)) as dim, unnest(embedding)::double as x from embeddings),
    centres as materialized (select label as cluster, dim, avg(x) as c from points group by all),
    spans as (
        select vec_id, p.label, cluster, sum(power(x - c, 2)) as square
        from points p join centres using (dim) group by all),
    placed as materialized (
        select vec_id, label, cluster, sqrt(square) as distance
        from (select *, row_number() over (partition by vec_id order by square, cluster) as place from spans)
        where place = 1)
"""


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark, sf_dir)
    # Written out, so that all branches of a plan see the very same centres.
    centres = cut(clu.class_centres(rows, "point", "label"))
    return clu.nearest_centre(rows, "point", centres)


@query("nearest_center", f"with {PLACED_SQL} select vec_id, cluster from placed")
def nearest_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).select("vec_id", "cluster")


@query(
    "centroid_distances",
    f"with {PLACED_SQL} select vec_id, cluster, round(distance, 6) as distance from placed",
)
def centroid_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(spark, sf_dir).select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


@query(
    "kmeans_lloyd_step",
    f"""with {PLACED_SQL}
    select cluster, count(*) as n, cast(dim as integer) as dim, round(avg(x), 6) as value
    from placed join points using (vec_id) group by cluster, dim""",
)
def kmeans_lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clu.moved_centres(placed(spark, sf_dir), "point").withColumn("value", F.round("value", 6))


@query("cluster_label_counts", f"with {PLACED_SQL} select cluster, label, count(*) as n from placed group by all")
def cluster_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clu.cluster_label_counts(placed(spark, sf_dir))


@query(
    "cluster_entropy",
    f"""with {PLACED_SQL},
    counts as (select cluster, label, count(*) as n from placed group by all),
    shares as (select cluster, n, sum(n) over (partition by cluster) as size from counts),
    per_cluster as (select size, -sum(n / size * ln(n / size)) as h from shares group by cluster, size)
    select round(sum(size * h) / sum(size), 6) as entropy from per_cluster""",
)
def cluster_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    entropy = clu.cluster_entropy(clu.cluster_label_counts(placed(spark, sf_dir)))
    return entropy.select(F.round("entropy", 6).alias("entropy"))


THRESHOLD_SQL = f"(select min(distance) from (select distance from placed order by distance desc limit {OUTLIER_PLACE}))"


@query("anomaly_threshold", f"with {PLACED_SQL} select round({THRESHOLD_SQL}, 6) as threshold")
def anomaly_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    threshold = clu.kth_largest(placed(spark, sf_dir), "distance", OUTLIER_PLACE)
    return threshold.select(F.round("threshold", 6).alias("threshold"))


@query(
    "anomalies",
    f"""with {PLACED_SQL}
    select vec_id, cluster, round(distance, 6) as distance from placed where distance > {THRESHOLD_SQL}""",
)
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clu.outliers(placed(spark, sf_dir), "distance", OUTLIER_PLACE)
    return found.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


# --- trained clusters ------------------------------------------------------------------------------


def vector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", array_to_vector("point").alias("features"), "label")


@query("kmeans_centers")
def kmeans_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    with persisted(vector_features(spark, sf_dir)) as (rows,):
        centres = clu.train_kmeans(rows, k=10).clusterCenters()
    entries = [(c, dim, float(x)) for c, centre in enumerate(centres) for dim, x in enumerate(centre)]
    return spark.createDataFrame(entries, "cluster int, dim int, value double")


@query("kmeans_k_scan")
def kmeans_k_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clu.distance_scan(vector_features(spark, sf_dir))


@query("kmeans_k_scan_fine")
def kmeans_k_scan_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan of larger k with a small tolerance, over the plain vectors."""
    return clu.distance_scan(vector_features(spark, sf_dir), range(30, 101, 10), 1e-6)


@query("kmeans_entropy_scan")
def kmeans_entropy_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy of clusters over the scaled one-hot records."""
    records = one_hot(spark, sf_dir).select("features", F.col("o_orderstatus").alias("label"))
    return clu.entropy_scan(clu.standardise(records))


SEEDS = 4


def seeds_sql() -> str:
    """A chain of rounds: the draw of each row against its distance to the centres so far."""
    draw = lambda i: f"({sql_bucket('vec_id', f'seed{i}')} + 1) / {BUCKETS}.0::double"
    rounds = [f"""chosen0 as materialized (
        select 0 as place, vec_id from embeddings where embedding is not null order by {draw(0)}, vec_id limit 1)"""]
    for i in range(1, SEEDS):
        rounds.append(f"""spans{i} as (
        select p.vec_id, c.place, sum(power(p.x - q.x, 2)) as square
        from points p cross join chosen{i - 1} c join points q on q.vec_id = c.vec_id and q.dim = p.dim group by all),
    nearest{i} as (select vec_id, min(square) as square from spans{i} group by vec_id),
    chosen{i} as materialized (
        select * from chosen{i - 1} union all
        select {i}, vec_id from (select vec_id from nearest{i} where square > 0 order by -ln({draw(i)}) / square, vec_id limit 1))""")
    return f"""with points as materialized (
        select vec_id, unnest(range(64)) as dim, unnest(embedding)::double as x from embeddings),
    {', '.join(rounds)}
    select cast(place as integer) as place, vec_id from chosen{SEEDS - 1}"""


@query("kmeans_seeds", seeds_sql())
def kmeans_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance-weighted start centres, as ids of the rows taken."""
    with persisted(vectors(spark, sf_dir)) as (rows,):
        return clu.seed_centres(rows, "vec_id", "point", SEEDS).select("place", F.col("key").alias("vec_id"))


@query("cluster_sample_export")
def cluster_sample_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample of lines, written as text files and read back from them."""
    with persisted(vector_features(spark, sf_dir)) as (rows,):
        model = clu.train_kmeans(rows, k=10, tol=1e-6)
        lines = clu.sample_lines(rows, model, key="vec_id")
        return text_files.exported(lines, ["value"], new_folder(spark))


@query("cluster_sample_ids", f"select vec_id from embeddings where {sql_bucket('vec_id', 'sample')} < {share(0.05)}")
def cluster_sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose lines are written."""
    return hash_sample(vectors(spark, sf_dir), F.col("vec_id"), 0.05).select("vec_id")
