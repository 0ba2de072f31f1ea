from __future__ import annotations

import hashlib
import itertools
import random
import struct
from collections import deque
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from datamill.operators import network as net
from datamill.session import cut


def graph(spark, n, edges):
    vertices = spark.range(n).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("name"))
    rows = [(a, b, 1) for a, b in edges]
    return vertices, spark.createDataFrame(rows, "src bigint, dst bigint, cnt bigint")


def neighbours(n, edges):
    near = {v: set() for v in range(n)}
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return near


def reach(near, start):
    hops, queue = {start: 0}, deque([start])
    while queue:
        v = queue.popleft()
        for w in near[v]:
            if w not in hops:
                hops[w] = hops[v] + 1
                queue.append(w)
    return hops


def random_graph(seed, n=60, m=55):
    draw = random.Random(seed)
    return sorted({tuple(sorted((draw.randrange(n), draw.randrange(n)))) for _ in range(m)})


def test_topic_id_is_little_endian_md5(spark):
    names = ["part_1", "Ünï", ""]
    df = spark.createDataFrame([(x,) for x in names], "topic string")
    got = {r.name: r.id for r in net.graph_vertices(df).collect()}
    assert got == {x: struct.unpack("<q", hashlib.md5(x.encode()).digest()[:8])[0] for x in names}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 14)), max_size=18, unique=True))
def test_component_is_named_by_its_lowest_vertex(spark, edges):
    vertices, frame = graph(spark, 15, edges)
    near = neighbours(15, edges)
    got = {r.id: r.component for r in net.connected_components(vertices, frame).collect()}
    assert got == {v: min(reach(near, v)) for v in range(15)}


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(300, i) for i in range(301, 400)]
    vertices, frame = graph(spark, 401, path + hub)
    sizes = net.component_sizes(net.connected_components(vertices, frame)).collect()
    assert [r.n for r in sizes[:2]] == [201, 100]
    members = net.component_members(net.connected_components(vertices, frame), vertices, place=1).collect()
    assert {r.id for r in members} == set(range(300, 400))


def test_degrees_count_a_loop_twice(spark):
    _, frame = graph(spark, 3, [(0, 0), (0, 1)])
    assert {r.id: r.degree for r in net.degrees(frame).collect()} == {0: 3, 1: 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_triangles_and_clustering(spark, seed):
    n, edges = 25, random_graph(seed, 25, 90)
    vertices, frame = graph(spark, n, edges)
    near = neighbours(n, edges)
    want = {v: sum(1 for a in near[v] for b in near[v] if a < b and b in near[a]) for v in near}
    assert {r.id: r.triangles for r in net.triangle_counts(vertices, frame).collect()} == want
    local = [want[v] / (len(near[v]) * (len(near[v]) - 1) / 2) if len(near[v]) > 1 else 0 for v in near]
    got = net.average_clustering(vertices, frame).first().avg_clustering
    assert abs(got - sum(local) / n) < 1e-12


def test_paths_from_more_than_64_sources(spark):
    n, edges = 90, random_graph(4, 90, 110)
    vertices, frame = graph(spark, n, edges)
    near = neighbours(n, edges)
    chosen = list(range(0, 80))
    sources = vertices.filter(F.col("id") < 80)
    want = {(min(s, v), max(s, v), h) for s in chosen for v, h in reach(near, s).items()}
    got = [tuple(r) for r in net.sample_path_lengths(frame, sources).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_paths_with_a_split_hub(spark, monkeypatch):
    edges = [(0, i) for i in range(1, 50)] + [(49, 50)]
    vertices, frame = graph(spark, 51, edges)
    monkeypatch.setattr(net, "hot_keys", lambda *args, **kwargs: [0])
    got = {tuple(r) for r in net.sample_path_lengths(frame, vertices.filter("id in (3, 50)")).collect()}
    near = neighbours(51, edges)
    assert got == {(min(s, v), max(s, v), h) for s in (3, 50) for v, h in reach(near, s).items()}


def test_chi_square_by_hand_and_zero_margin(spark):
    _, frame = graph(spark, 3, [(0, 1), (1, 2)])
    counts = spark.createDataFrame([(0, 4), (1, 5), (2, 20)], "id bigint, n bigint")
    rows = {(r.src, r.dst): r.chi2 for r in net.chi_square_edges(frame, counts, 20).collect()}
    # Cells of the table of 20 records: both, only one, only the other, neither.
    observed, expected = [1, 3, 4, 12], [1.0, 3.0, 4.0, 12.0]
    by_cells = sum((abs(o - e) - 0.5) ** 2 / e for o, e in zip(observed, expected))
    assert abs(rows[(0, 1)] - by_cells) < 1e-12
    assert rows[(1, 2)] is None


def test_triangles_of_a_clique_in_cells(spark):
    edges = [(i, j) for i in range(24) for j in range(i + 1, 24)]
    vertices, frame = graph(spark, 24, edges)
    got = {r.id: r.triangles for r in net.triangle_counts(vertices, frame, cell_items=4).collect()}
    assert got == {i: 23 * 22 // 2 for i in range(24)}


def test_counts_along_a_chain_equal_the_paths(spark):
    edges = [(i, i + 1) for i in range(39)]
    vertices, frame = graph(spark, 40, edges)
    sources = vertices.filter("id in (0, 7, 39)")
    paths = net.sample_path_lengths(frame, sources).groupBy("hops").count()
    counts = net.path_length_counts(frame, sources)
    assert {tuple(r) for r in counts.collect()} == {tuple(r) for r in paths.collect()}
    assert counts.agg({"hops": "max"}).first()[0] == 39


def test_full_graph_components_are_those_of_a_plain_search(spark):
    from datamill.plans import catalog

    edges = catalog.QUERIES["graph_edges"](spark, "/root/testdata/sf0.001").collect()
    root = {r.id: r.id for r in catalog.QUERIES["topic_hash_ids"](spark, "/root/testdata/sf0.001").collect()}

    def top(v):
        while root[v] != v:
            root[v] = v = root[root[v]]
        return v

    for e in edges:
        a, b = top(e.src), top(e.dst)
        root[max(a, b)] = min(a, b)
    sizes = {}
    for v in root:
        sizes[top(v)] = sizes.get(top(v), 0) + 1
    found = catalog.QUERIES["full_component_sizes"](spark, "/root/testdata/sf0.001").collect()
    assert {r.component: r.n for r in found} == sizes


def test_a_round_is_one_job_per_table(spark):
    """A chain needs several rounds; each writes two tables and starts no other job."""
    n = 64
    vertices = spark.range(n).select("id", F.col("id").cast("string").alias("name"))
    edges = cut(spark.range(n - 1).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("cnt")))
    context = spark.sparkContext
    context.setJobGroup("components", "components")
    wrote = []
    real = net.cut_observed
    net.cut_observed = lambda df, **m: wrote.append(1) or real(df, **m)
    try:
        components = net.connected_components(vertices, edges)
    finally:
        net.cut_observed = real
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup("components")]
    assert components.select("component").distinct().collect() == [(0,)]
    # Adaptive execution starts a job per shuffle stage; none of them reads a written table only to count it.
    assert len(wrote) >= 5 and len(jobs) <= 6 * len(wrote)


def test_triangles_move_no_wedges(spark):
    n, edges = 60, [(a, b) for a in range(60) for b in range(a + 1, 60) if (a * b) % 3]
    vertices, table = graph(spark, n, edges)
    near = neighbours(n, edges)
    expected = {v: sum(b in near[a] for a, b in itertools.combinations(sorted(near[v]), 2)) for v in range(n)}
    for cell in (50, 10_000):
        found = net.triangle_counts(vertices, table, cell)
        assert {r.id: r.triangles for r in found.collect()} == expected
    # The paths of two edges are looked up inside a task, so no join makes a row of each.
    plan = net.triangle_counts(vertices, table)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "low" not in plan


def test_paths_move_no_message_per_edge(spark, monkeypatch):
    """Components apart from each other, more sources than a word holds, cells of few edges
    and blocks of one word; the joins of a hop see merged sets, not a row per edge."""
    rng = random.Random(5)
    edges = [(60 * c + rng.randrange(60), 60 * c + rng.randrange(60)) for c in range(4) for _ in range(150)]
    vertices, frame = graph(spark, 240, edges)
    near = neighbours(240, edges)
    whole = {(min(s, v), max(s, v), h) for s in range(240) for v, h in reach(near, s).items()}
    joined = []
    real = net.cut_observed
    monkeypatch.setattr(net, "cut_observed", lambda df, **m: joined.append(df) or real(df, **m))
    got = [tuple(r) for r in net._path_pairs(*net.reached_sets(frame, vertices, 40, 200)).collect()]
    assert len(got) == len(set(got)) and set(got) == whole
    plans = [df._jdf.queryExecution().analyzed().toString() for df in joined]
    assert plans and all("next" not in plan and "FlatMapCoGroupsInArrow" in plan for plan in plans)
    # Neighbouring sources share words: a component of 60 lies in two words or so, not in four.
    reached, _ = net.reached_sets(frame, vertices)
    words = reached.groupBy("at").agg(F.countDistinct("word").alias("n")).agg(F.avg("n")).first()[0]
    assert words < 2.6


def test_a_dense_graph_is_small_before_its_first_star(spark):
    """Forty knots of 30 vertices in a row: far fewer edges than 17,400 reach the star steps."""
    edges = [(k * 30 + i, k * 30 + j) for k in range(40) for i in range(30) for j in range(i + 1, 30)]
    edges += [(k * 30 + 29, k * 30 + 30) for k in range(39)]
    vertices, frame = graph(spark, 1201, edges)
    wrote = []
    real = net._written
    net._written = lambda df: wrote.append(real(df)) or wrote[-1]
    try:
        components = net.connected_components(vertices, frame)
    finally:
        net._written = real
    assert wrote[0][1] == len(edges) and max(n for _, n, _ in wrote[1:]) <= 1200
    assert {(r.component, r.n) for r in net.component_sizes(components).collect()} == {(0, 1200), (1200, 1)}


def files(frame):
    """Bytes of the files in the folder that written tables and checkpoints go to."""
    folder = Path(frame.sparkSession.sparkContext.getCheckpointDir().removeprefix("file:"))
    return sum(f.stat().st_size for f in folder.rglob("*") if f.is_file())


def test_paths_leave_no_edges_on_disk(spark):
    """Each written table goes when the next one is there; only fronts and numbers stay."""
    n, edges = 2000, random_graph(8, 2000, 60_000)
    vertices, frame = graph(spark, n, edges)
    frame = cut(frame)
    before = files(frame)
    counts = net.path_length_counts(frame, vertices.filter("id < 3"))
    assert counts.agg(F.sum("n")).first()[0] > n
    assert files(frame) - before < 8 * len(edges)


def test_components_and_chi_square_over_numbers(spark):
    """Topics by the numbers of their ids give the edges and components that the ids give."""
    rows = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "b"), (2, "c"), (2, None), (3, "x"), (3, "y"), (3, "x"), (None, "a"), (4, "z")], "record bigint, topic string"
    )
    vertices = net.graph_vertices(rows)
    names = net.vertex_numbers(vertices)
    by_no = {r.no: r.id for r in names.collect()}
    assert sorted(by_no) == list(range(6)) and [by_no[i] for i in range(6)] == sorted(by_no.values())
    numbered = net.numbered_rows(rows, names)
    found = {(by_no[r.src], by_no[r.dst], r.cnt) for r in net.pair_edges(numbered, "no").collect()}
    assert found == {tuple(r) for r in net.graph_edges(rows).collect()}
    sources = names.select(F.col("no").alias("id"))
    pairs = net.sample_path_lengths(net.pair_edges(numbered, "no"), sources, names)
    plain = net.sample_path_lengths(net.graph_edges(rows), names.select("id"))
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, plain.collect()))
