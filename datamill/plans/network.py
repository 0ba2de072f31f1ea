"""Co-occurrence network: topic pairs, components, edge weights, clustering and paths."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.functions.buckets import topic_id
from datamill.operators import network as net
from datamill.operators import profile
from datamill.operators.pairs import pair_counts, record_pairs
from datamill.plans.registry import query
from datamill.plans.standins import TOPICS_SQL, in_bucket, sql_bucket, sql_topic_id, table, topic_rows
from datamill.session import discard, written

CHI_SQUARE_LIMIT = 19.5
SAMPLE_PARTS = 50

PAIRS_SQL = f"""
    rows as ({TOPICS_SQL}),
    once as (select record, topic, count(*) as times from rows group by all),
    pairs as (
        select a.record, a.topic as first, b.topic as second
        from once a join once b on a.record = b.record and a.topic < b.topic
        union all
        select record, topic, topic from once where times > 1)
"""

GRAPH_SQL = f"""
    {PAIRS_SQL},
    vertices as materialized (
        select {sql_topic_id('topic')} as id, topic as name from (select distinct topic from rows)),
    edges as materialized (
        select least(a.id, b.id) as src, greatest(a.id, b.id) as dst, count(*) as cnt
        from pairs join vertices a on first = a.name join vertices b on second = b.name group by 1, 2),
    sparse as materialized (select * from edges where cnt >= 2 and src <> dst)
"""

CHI_SQL = f"""
    {GRAPH_SQL},
    counts as (select {sql_topic_id('topic')} as id, count(*)::double as n from rows group by 1),
    margins as (
        select e.src, e.dst, e.cnt::double as seen, f.n as f, s.n as s,
               (select count(*) from orders)::double as t
        from edges e join counts f on e.src = f.id join counts s on e.dst = s.id),
    cells as (
        select src, dst, unnest([seen, f - seen, s - seen, t - f - s + seen]) as observed,
               unnest([f * s, f * (t - s), (t - f) * s, (t - f) * (t - s)]) / t as expected
        from margins),
    chi as materialized (
        select src, dst, case when min(expected) > 0
            then sum(pow(abs(observed - expected) - 0.5, 2) / nullif(expected, 0)) end as chi2
        from cells group by src, dst),
    strong as materialized (select src, dst, chi2 from chi where chi2 > {CHI_SQUARE_LIMIT})
"""


def sql_components(edges: str) -> str:
    return f"""
    links as (select src as a, dst as b from {edges} union select dst, src from {edges}),
    reach(id, root) as (
        select id, id from vertices
        union
        select links.b, reach.root from reach join links on reach.id = links.a
        where reach.root < links.b),
    components as materialized (select id, min(root) as component from reach group by id),
    sizes as (select component, count(*) as n from components group by component)
    """


@query("topic_counts", f"select topic, count(*) as n from ({TOPICS_SQL}) group by topic")
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.topic_counts(topic_rows(spark, sf_dir))


@query(
    "topic_top_counts",
    f"select topic, count(*) as n from ({TOPICS_SQL}) group by topic order by n desc, topic limit 10",
)
def topic_top_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_counts(topic_counts(spark, sf_dir), 10, "topic")


@query(
    "count_of_counts",
    f"""select n, count(*) as n_keys
    from (select topic, count(*) as n from ({TOPICS_SQL}) group by topic) group by n""",
)
def count_of_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.count_of_counts(topic_counts(spark, sf_dir))


@query(
    "topic_contains_counts",
    f"select topic, count(*) as n from ({TOPICS_SQL}) where contains(topic, 'part_19') group by topic",
)
def topic_contains_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.topic_counts(topic_rows(spark, sf_dir).filter(F.col("topic").contains("part_19")))


@query("topic_pairs", f"with {PAIRS_SQL} select record, first, second from pairs")
def topic_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_pairs(topic_rows(spark, sf_dir), "record", "topic")


@query("cooccurrence_counts", f"with {PAIRS_SQL} select first, second, count(*) as n from pairs group by all")
def cooccurrence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_counts(topic_pairs(spark, sf_dir))


@query(
    "cooccurrence_top",
    f"""with {PAIRS_SQL} select first, second, count(*) as n from pairs group by all
    order by n desc, first, second limit 10""",
)
def cooccurrence_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_counts(cooccurrence_counts(spark, sf_dir), 10, "first", "second")


@query(
    "topic_hash_ids",
    f"select distinct {sql_topic_id('topic')} as id, topic as name from ({TOPICS_SQL})",
)
def topic_hash_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.graph_vertices(topic_rows(spark, sf_dir))


@query("graph_edges", f"with {GRAPH_SQL} select src, dst, cnt from edges")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.graph_edges(topic_rows(spark, sf_dir))


@query(
    "graph_size",
    f"""with {GRAPH_SQL}
    select (select count(*) from orders) as n_records, (select count(*) from vertices) as n_vertices,
           (select count(*) from edges) as n_edges""",
)
def graph_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_records = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n"))
    n_vertices = topic_hash_ids(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    n_edges = graph_edges(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    return n_records.select(
        F.col("n").alias("n_records"),
        n_vertices.scalar().alias("n_vertices"),
        n_edges.scalar().alias("n_edges"),
    )


def sparse_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that share at least two records, without loops."""
    return graph_edges(spark, sf_dir).filter("cnt >= 2 and src <> dst")


def sparse_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.connected_components(topic_hash_ids(spark, sf_dir), sparse_edges(spark, sf_dir))


SPARSE_SQL = f"with recursive {GRAPH_SQL}, {sql_components('sparse')}"

# All edges: the least id spreads along them, one row per vertex, as the graph may be dense.
FULL_COMPONENTS_SQL = f"""with recursive {GRAPH_SQL},
    links as materialized (
        select src as a, dst as b from edges where src <> dst union all select dst, src from edges where src <> dst),
    reach(id, root) using key (id) as (
        select id, id from vertices
        union
        select links.b, min(reach.root) from reach join links on reach.id = links.a
        join recurring.reach as old on old.id = links.b
        where reach.root < old.root group by links.b),
    components as materialized (select id, root as component from reach)"""


def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components over all edges, pairs of one order included."""
    return net.connected_components(topic_hash_ids(spark, sf_dir), graph_edges(spark, sf_dir))


@query("connected_components", f"{FULL_COMPONENTS_SQL} select id, component from components")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(spark, sf_dir)


@query("component_sizes", f"{FULL_COMPONENTS_SQL} select component, count(*) as n from components group by component")
def component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.component_sizes(components(spark, sf_dir))


@query(
    "component_members",
    f"""{SPARSE_SQL}
    select id, name, component from components join vertices using (id)
    where component = (select component from sizes order by n desc, component limit 1 offset 1)""",
)
def component_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    components = sparse_components(spark, sf_dir)
    return net.component_members(components, topic_hash_ids(spark, sf_dir), place=1)


DEGREES_SQL = f"""with {GRAPH_SQL},
    degrees as (
        select id, count(*) as degree
        from (select src as id from sparse union all select dst from sparse) group by id)"""


@query("degrees", f"{DEGREES_SQL} select id, degree from degrees")
def degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.degrees(sparse_edges(spark, sf_dir))


@query(
    "top_degree_names",
    f"""{DEGREES_SQL} select id, name, degree from degrees join vertices using (id)
    order by degree desc, name limit 10""",
)
def top_degree_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.top_degree_names(degrees(spark, sf_dir), topic_hash_ids(spark, sf_dir), 10)


# The same over all edges, hubs and pairs of one order included.

FULL_DEGREES_SQL = f"""with {GRAPH_SQL},
    degrees as (
        select id, count(*) as degree
        from (select src as id from edges union all select dst from edges) group by id)"""


def full_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.degrees(graph_edges(spark, sf_dir))


@query(
    "degree_stats",
    f"""{FULL_DEGREES_SQL} select 'degree' as dim, count(*) as n, round(avg(degree), 6) as mean,
    round(stddev_pop(degree), 6) as stdev, min(degree)::double as "min", max(degree)::double as "max" from degrees""",
)
def degree_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.column_stats(full_degrees(spark, sf_dir), "degree"))


@query(
    "full_degree_stats",
    f"""{FULL_DEGREES_SQL} select 'degree' as dim, count(*) as n, round(avg(degree), 6) as mean,
    round(stddev_pop(degree), 6) as stdev, min(degree)::double as "min", max(degree)::double as "max" from degrees""",
)
def full_degree_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.column_stats(full_degrees(spark, sf_dir), "degree"))


@query(
    "full_top_degree_names",
    f"""{FULL_DEGREES_SQL} select id, name, degree from degrees join vertices using (id)
    order by degree desc, name limit 10""",
)
def full_top_degree_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.top_degree_names(full_degrees(spark, sf_dir), topic_hash_ids(spark, sf_dir), 10)


@query("full_component_sizes")
def full_component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.component_sizes(components(spark, sf_dir))


def rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"mean": F.round("mean", 6), "stdev": F.round("stdev", 6)})


def chi_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All edges with their chi-square; topics and edges are each hashed and counted once."""
    counts = topic_counts(spark, sf_dir).select(topic_id(F.col("topic")).alias("id"), "n")
    n_records = table(spark, sf_dir, "orders").count()
    return net.chi_square_edges(graph_edges(spark, sf_dir), counts, n_records)


def strong_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chi_edges(spark, sf_dir).filter(F.col("chi2") > CHI_SQUARE_LIMIT)


class Graph(NamedTuple):
    """The interesting network over numbers: vertices (id, no), one per topic, the numbers in
    the order of the ids, and edges (src, dst) between numbers. `names` has a row per number."""

    vertices: DataFrame
    names: DataFrame
    edges: DataFrame

    @property
    def numbers(self) -> DataFrame:
        return self.vertices.select(F.col("no").alias("id"))

    def named(self, rows: DataFrame, column: str) -> DataFrame:
        """`rows` with the id in place of the number in a column."""
        names = self.names.select(F.col("no").alias(column), F.col("id").alias("_id"))
        return rows.join(names, column, "left").withColumn(column, F.col("_id")).drop("_id")


def strong_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The edges of `strong_edges`, made over numbers, which take less room than hashed ids."""
    topics = topic_hash_ids(spark, sf_dir)
    names = net.vertex_numbers(topics)
    rows = net.numbered_rows(topic_rows(spark, sf_dir), names)
    counts = net.topic_counts(rows.withColumnRenamed("no", "topic")).withColumnRenamed("topic", "id")
    n_records = table(spark, sf_dir, "orders").count()
    chi = net.chi_square_edges(net.pair_edges(rows, "no"), counts, n_records)
    strong = written(chi.filter(F.col("chi2") > CHI_SQUARE_LIMIT).select("src", "dst"))
    discard(rows, *chi.made_from)
    return Graph(topics.select("id").join(names, "id", "left"), names, strong)


@query("chi_square_edges", f"with {CHI_SQL} select src, dst, round(chi2, 6) as chi2 from chi")
def chi_square_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chi_edges(spark, sf_dir).withColumn("chi2", F.round("chi2", 6))


@query(
    "chi_square_stats",
    f"""with {CHI_SQL} select 'chi2' as dim, count(chi2) as n, round(avg(chi2), 6) as mean,
    round(stddev_pop(chi2), 6) as stdev, round(min(chi2), 6) as "min", round(max(chi2), 6) as "max" from chi""",
)
def chi_square_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.column_stats(chi_edges(spark, sf_dir), "chi2")
    return rounded(stats).withColumns({"min": F.round("min", 6), "max": F.round("max", 6)})


@query("interesting_edges", f"with {CHI_SQL} select src, dst, round(chi2, 6) as chi2 from strong")
def interesting_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strong_edges(spark, sf_dir).withColumn("chi2", F.round("chi2", 6))


@query(
    "interesting_components",
    f"with recursive {CHI_SQL}, {sql_components('strong')} select component, n from sizes",
)
def interesting_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = strong_graph(spark, sf_dir)
    sizes = net.component_sizes(net.connected_components(graph.numbers, graph.edges))
    discard(graph.edges)
    return graph.named(sizes, "component").orderBy(F.desc("n"), "component")


TRIANGLES_SQL = f"""with {CHI_SQL},
    plain as (select src, dst from strong where src <> dst),
    tri as (
        select x.src as a, x.dst as b, y.dst as c
        from plain x join plain y on x.dst = y.src join plain z on z.src = x.src and z.dst = y.dst),
    corners as (select a as id from tri union all select b from tri union all select c from tri),
    triangles as (
        select id, count(corners.id) as triangles
        from vertices left join corners using (id) group by id),
    degrees as (
        select id, count(*) as degree
        from (select src as id from plain union all select dst from plain) group by id)"""


@query("triangle_counts", f"{TRIANGLES_SQL} select id, triangles from triangles")
def triangle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = strong_graph(spark, sf_dir)
    triangles = net.triangle_counts(graph.numbers, graph.edges)
    discard(graph.edges)
    return graph.named(triangles, "id")


@query(
    "avg_clustering",
    f"""{TRIANGLES_SQL}
    select round(sum(case when degree > 1 then triangles / (degree * (degree - 1) / 2.0) else 0.0 end)
           / (select count(*) from vertices), 6) as avg_clustering
    from triangles join degrees using (id)""",
)
def avg_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = strong_graph(spark, sf_dir)
    clustering = net.average_clustering(graph.numbers, graph.edges)
    return clustering.select(F.round("avg_clustering", 6).alias("avg_clustering"))


PATHS_SQL = f"""with recursive {CHI_SQL},
    links as (
        select src as a, dst as b from strong where src <> dst
        union select dst, src from strong where src <> dst),
    walk(source, spot, hops) using key (source, spot) as (
        select id, id, 0 from vertices where {sql_bucket('id', 'paths')} % {SAMPLE_PARTS} = 0
        union
        select walk.source, links.b, min(walk.hops + 1)
        from walk join links on walk.spot = links.a
        left join recurring.walk as old on old.source = walk.source and old.spot = links.b
        where old.hops is null or old.hops > walk.hops + 1
        group by walk.source, links.b),
    paths as materialized (
        select distinct least(source, spot) as src, greatest(source, spot) as dst, hops from walk)"""


def path_sources(graph: Graph) -> DataFrame:
    return graph.vertices.filter(in_bucket(F.col("id"), "paths", SAMPLE_PARTS)).select(F.col("no").alias("id"))


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = strong_graph(spark, sf_dir)
    pairs = net.sample_path_lengths(graph.edges, path_sources(graph), graph.names)
    discard(graph.edges)
    return pairs


def path_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = strong_graph(spark, sf_dir)
    counts = net.path_length_counts(graph.edges, path_sources(graph))
    discard(graph.edges)
    return counts


@query("sampled_paths", f"{PATHS_SQL} select src, dst, hops from paths")
def sampled_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paths(spark, sf_dir)


@query(
    "path_stats",
    f"""{PATHS_SQL} select 'hops' as dim, count(*) as n, round(avg(hops), 6) as mean,
    round(stddev_pop(hops), 6) as stdev, min(hops)::double as "min", max(hops)::double as "max"
    from paths where hops > 0""",
)
def path_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = path_counts(spark, sf_dir).filter("hops > 0")
    mean = F.sum(F.col("hops") * F.col("n")) / F.sum("n")
    square = F.sum(F.col("hops") * F.col("hops") * F.col("n")) / F.sum("n")
    stats = counts.agg(
        F.lit("hops").alias("dim"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"), mean.alias("mean"),
        F.sqrt(square - mean * mean).alias("stdev"),
        F.min("hops").cast("double").alias("min"), F.max("hops").cast("double").alias("max"),
    )
    return rounded(stats)


@query("path_length_histogram", f"{PATHS_SQL} select hops, count(*) as n from paths group by hops")
def path_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return path_counts(spark, sf_dir)
