"""Co-occurrence graphs as two tables: vertices (id, name) and edges (src, dst, cnt)."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from datamill.functions.buckets import topic_id
from datamill.operators.pairs import pair_counts, record_pairs
from datamill.operators.ranking import number_keys, number_sorted, running_total
from datamill.operators.skew import hot_keys, lookup  # noqa: F401 (a test replaces net.hot_keys)
from datamill.session import cut, cut_observed, discard, ship, written


def topic_rows(records: DataFrame, record: str, topics: str) -> DataFrame:
    """One row per topic of each record."""
    return records.select(F.col(record).alias("record"), F.explode(topics).alias("topic"))


def topic_counts(rows: DataFrame) -> DataFrame:
    """How often each topic is named."""
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def graph_vertices(rows: DataFrame) -> DataFrame:
    """Different topics with their hashed ids, written out so that no later filter on the id
    moves the hashing below the distinct."""
    names = rows.select("topic").distinct()
    return written(names.select(topic_id(F.col("topic")).alias("id"), F.col("topic").alias("name")))


def graph_edges(rows: DataFrame) -> DataFrame:
    """Edges between hashed topics, lower id first, with the number of shared records.

    The narrow id table is written out, so each topic name is hashed once.
    """
    return pair_edges(written(rows.select("record", topic_id(F.col("topic")).alias("id"))), "id")


def pair_edges(rows: DataFrame, vertex: str) -> DataFrame:
    """Edges between the vertices named in a record, lower one first, with the number of records."""
    counts = pair_counts(record_pairs(rows, "record", vertex))
    return counts.select(F.col("first").alias("src"), F.col("second").alias("dst"), F.col("n").alias("cnt"))


def vertex_numbers(vertices: DataFrame) -> DataFrame:
    """Numbers (id, no) of the different ids, in their order, so that what is lower stays lower.
    Edges between numbers take a third of the room of edges between hashes."""
    return written(number_sorted(vertices, "id", "no"))


def numbered_rows(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rows (record, no) with the numbers of the topics' ids; rows without a topic drop out."""
    ids = rows.select("record", topic_id(F.col("topic")).alias("id"))
    return written(lookup(ids, numbers, "id", "inner", spread=["record"]).select("record", "no"))


# --- components -------------------------------------------------------------------------


def _written(edges: DataFrame) -> tuple[DataFrame, int, tuple]:
    """The edges written out, their number, and a signature that changes with them."""
    rows, seen = cut_observed(
        edges, n=F.count(F.lit(1)), total=F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    )
    return rows, seen["n"], (seen["n"], seen["total"])


def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Tie every larger neighbour of a vertex to the least vertex next to it."""
    both = edges.select(F.col("high").alias("at"), F.col("low").alias("near")).unionByName(
        edges.select(F.col("low").alias("at"), F.col("high").alias("near"))
    )
    least = both.groupBy("at").agg(F.least(F.min("near"), F.col("at")).alias("least"))
    joined = lookup(both, least, "at", how="inner", total=2 * n_edges)
    return joined.filter("near > at").select(F.col("near").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Tie a vertex and its smaller neighbours to the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = lookup(edges, least, "high", how="inner", total=n_edges)
    moved = joined.filter("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    own = least.select("high", F.col("least").alias("low"))
    return moved.unionByName(own).distinct()


def _merged(stars: DataFrame, n_edges: int) -> tuple[DataFrame, DataFrame, int, tuple]:
    """Vertices tied to their least neighbour, (id, root), and the edges left between roots,
    written out like `stars`, which go.

    A root is the least vertex of those tied to it, so names of components stay what they were.
    One value per vertex is found from the edges, and chains of ties are followed in that table,
    which halves them each round; the edges themselves are only renamed, once at each end.
    """
    ends = stars.select(F.col("high").alias("id"), F.col("low").alias("near")).unionByName(
        stars.select(F.col("low").alias("id"), F.col("high").alias("near"))
    )
    ties, seen = cut_observed(
        ends.groupBy("id").agg(F.least(F.min("near"), F.col("id")).alias("root")),
        total=F.sum(F.col("root").cast("decimal(38,0)")),
    )
    while True:
        up = ties.select(F.col("id").alias("root"), F.col("root").alias("above"))
        total, last = seen["total"], ties
        ties, seen = cut_observed(
            lookup(ties, up, "root", how="inner").select("id", F.col("above").alias("root")),
            total=F.sum(F.col("root").cast("decimal(38,0)")),
        )
        discard(last)
        # Roots only fall, so an equal sum means that none has moved.
        if seen["total"] == total:
            break
    def renamed(edges: DataFrame, end: str) -> DataFrame:
        roots = ties.select(F.col("id").alias(end), F.col("root").alias("_root"))
        return lookup(edges, roots, end, how="inner", total=n_edges).drop(end).withColumnRenamed("_root", end)

    # One end at a time: the files of the first shuffle go before the second.
    half = written(renamed(stars, "high"))
    discard(stars)
    named = renamed(half, "low").filter("high <> low")
    left, n, seen = _written(named.select(F.greatest("high", "low").alias("high"), F.least("high", "low").alias("low")).distinct())
    discard(half)
    return ties, left, n, seen


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Component of each vertex (id, component), named by its lowest vertex id.

    First every vertex is tied to its least neighbour, which leaves few edges of a dense graph.
    Then alternating large-star and small-star steps: a logarithmic number of rounds, edges only
    shrink, and the neighbours of a vertex are never gathered in one place. Each step is
    checkpointed by one job, which also tells whether it changed anything; the loop ends when
    a round changes nothing.
    """
    stars = edges.select(F.greatest("src", "dst").alias("high"), F.least("src", "dst").alias("low"))
    stars, n, _ = _written(stars.filter("high <> low").distinct())
    ties, stars, n, seen = _merged(stars, n)
    while True:
        wide, n, _ = _written(_large_star(stars, n))
        discard(stars)
        stars, n, now = _written(_small_star(wide, n))
        discard(wide)
        if now == seen:
            tops = stars.select(F.col("high").alias("root"), F.col("low").alias("top"))
            roots = ties.join(tops, "root", "left").select("id", F.coalesce("top", "root").alias("root"))
            joined = vertices.select("id").join(roots, "id", "left")
            return joined.select("id", F.coalesce("root", "id").alias("component"))
        seen = now


def component_sizes(components: DataFrame) -> DataFrame:
    """Vertices per component, largest first."""
    sizes = components.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    return sizes.orderBy(F.desc("n"), "component")


def component_members(components: DataFrame, vertices: DataFrame, place: int) -> DataFrame:
    """Names in the component that takes `place` (0 = largest) by size."""
    chosen = component_sizes(components).offset(place).limit(1).select("component")
    members = components.join(F.broadcast(chosen), "component", "left_semi")
    return members.join(vertices, "id").select("id", "name", "component")


# --- degrees and edge weights -------------------------------------------------------------


def degrees(edges: DataFrame) -> DataFrame:
    """Edge ends per vertex; a loop counts twice, vertices without edges do not appear."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    return ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def top_degree_names(degree: DataFrame, vertices: DataFrame, n: int) -> DataFrame:
    """The `n` vertices of highest degree with their names. The n-th degree is found first;
    only vertices of at least that degree meet their names."""
    degree = cut(degree)
    least = degree.orderBy(F.desc("degree")).limit(n).agg(F.min("degree")).first()[0]
    high = degree.filter(F.col("degree") >= F.lit(least or 0))
    named = high.join(vertices, "id").select("id", "name", "degree")
    return named.orderBy(F.desc("degree"), "name").limit(n)


def chi_square(both: Column, first: Column, second: Column, total: Column) -> Column:
    """Chi-square with continuity correction for two topics; NULL when a margin is 0.

    `both` counts records with both topics, `first` and `second` those with each one. The
    determinant of their 2×2 table is total · both − first · second.
    """
    both, first, second, total = (value.cast("double") for value in (both, first, second, total))
    distance = F.abs(total * both - first * second) - total / 2
    spread = first * (total - first) * second * (total - second)
    return total * distance * distance / F.nullif(spread, F.lit(0.0))


def chi_square_edges(edges: DataFrame, counts: DataFrame, num_records: int) -> DataFrame:
    """Edges with their chi-square value; `counts` holds (id, n) per topic."""
    edges, seen = cut_observed(edges, n=F.count(F.lit(1)))
    counts, total = written(counts), seen["n"]
    at_src = counts.select(F.col("id").alias("src"), F.col("n").alias("n_src"))
    at_dst = counts.select(F.col("id").alias("dst"), F.col("n").alias("n_dst"))
    # One end at a time: the files of the first shuffle go before the second.
    half = written(lookup(edges, at_src, "src", "inner", total=total))
    discard(edges)
    triplets = lookup(half, at_dst, "dst", "inner", total=total)
    value = chi_square(F.col("cnt"), F.col("n_src"), F.col("n_dst"), F.lit(num_records))
    found = triplets.select("src", "dst", value.alias("chi2"))
    # For a caller that writes the result and discards what it was made from.
    found.made_from = (half, counts)
    return found


# --- triangles ----------------------------------------------------------------------------


def simple_edges(edges: DataFrame) -> DataFrame:
    """Undirected edges once each, without loops."""
    return (
        edges.filter("src <> dst")
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )


# Out-edges that a task of the triangle count holds at most, 4 bytes each.
CELL_EDGES = 64_000_000
# Ends of out-edges looked at in one step.
ENDS_AT_ONCE = 1 << 20


def triangle_counts(vertices: DataFrame, edges: DataFrame, cell_items: int = CELL_EDGES) -> DataFrame:
    """Triangles through each vertex (id, triangles), 0 where there are none.

    Every edge points from the end of lower degree to the one of higher degree. A vertex
    then has at most sqrt(2·edges) outgoing edges. The vertices are dealt into groups of at
    most about `cell_items` out-edges and, once more, into as many slices. A cell of a group
    and a slice holds the out-lists of the group and reads those of the slice that lead into
    it, so the paths of two edges, which a third one must close, are looked up and never
    moved; an out-list moves at most once per group and once per slice. Vertices are numbered, up to 2^31 of them.
    """
    plain, seen = cut_observed(simple_edges(edges), n=F.count(F.lit(1)))
    total = seen["n"]
    degree = written(degrees(plain))
    numbers = written(degree.join(number_keys(degree, "id", "no"), "id").select("id", "degree", F.col("no").cast("int").alias("no")))
    n_vertices = numbers.count()
    at_src = numbers.select(F.col("id").alias("src"), F.col("degree").alias("d_src"), F.col("no").alias("n_src"))
    at_dst = numbers.select(F.col("id").alias("dst"), F.col("degree").alias("d_dst"), F.col("no").alias("n_dst"))
    half = written(lookup(plain, at_src, "src", "inner", total=total).drop("src"))
    discard(plain, degree)
    known = lookup(half, at_dst, "dst", "inner", total=total)
    forward = F.struct("d_src", "n_src") < F.struct("d_dst", "n_dst")
    pointed = known.select(
        F.when(forward, F.col("n_src")).otherwise(F.col("n_dst")).alias("a"),
        F.when(forward, F.col("n_dst")).otherwise(F.col("n_src")).alias("b"),
    )
    lists = written(pointed.groupBy("a").agg(F.sort_array(F.collect_list("b")).alias("out")))
    discard(half)
    # Groups as the out-edges need them, and slices so that there are some cells per core: an
    # out-list is held once per slice and read once per group that it leads into.
    cores = edges.sparkSession.sparkContext.defaultParallelism
    dealt = max(-(-total // cell_items), math.isqrt(2 * cores))
    slices = max(1, -(-2 * cores // dealt))
    group = lambda vertex, salt, n: F.pmod(F.xxhash64(vertex, F.lit(salt)), F.lit(n)).cast("int")
    held = lists.select(
        group(F.col("a"), "group", dealt).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "a", "out"
    )
    # Only a vertex of two out-edges or more is the first of a triangle.
    read = lists.filter(F.size("out") > 1).select(
        F.explode(F.array_distinct(F.transform("out", lambda b: group(b, "group", dealt)))).alias("group"),
        group(F.col("a"), "slice", slices).alias("slice"), "a", "out",
    )
    ship(edges.sparkSession)
    cells = held.groupBy("group", "slice").cogroup(read.groupBy("group", "slice"))
    corners = cells.applyInArrow(lambda own, other: _closed(own, other, n_vertices), "no int, n long")
    counts = corners.groupBy("no").agg(F.sum("n").alias("triangles")).join(numbers, "no").select("id", "triangles")
    joined = vertices.select("id").join(counts, "id", "left")
    return joined.select("id", F.coalesce("triangles", F.lit(0)).alias("triangles"))


def _lists(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vertices of a cell, where their out-lists begin and end, and the lists in a row."""
    lists = pa.concat_arrays(table.column("out").chunks) if len(table) else pa.array([], pa.list_(pa.int32()))
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    return table.column("a").to_numpy(), ends, lists.flatten().to_numpy()


def _closed(held: pa.Table, read: pa.Table, n_vertices: int) -> pa.Table:
    """Corners of the triangles a→b→c, a→c with b's list held and a's list read: (no, n)."""
    own, begins, nexts = _lists(held)
    place = np.full(n_vertices, -1, np.int64)
    place[own] = np.arange(len(own))
    counts, marked = np.zeros(n_vertices, np.int64), np.zeros(n_vertices, bool)
    firsts, at, outs = _lists(read)
    for a, low, high in zip(firsts.tolist(), at[:-1].tolist(), at[1:].tolist()):
        out = outs[low:high]
        rows = place[out]
        rows = rows[rows >= 0]
        if not len(rows):
            continue
        marked[out] = True
        starts, sizes = begins[rows], begins[rows + 1] - begins[rows]
        step = max(1, ENDS_AT_ONCE // int(sizes.max()))
        for some in range(0, len(rows), step):
            first, size = starts[some : some + step], sizes[some : some + step]
            ran = np.cumsum(size)
            ends = nexts[np.arange(ran[-1]) + np.repeat(first - ran + size, size)]
            hits = np.flatnonzero(marked[ends])
            if len(hits):
                counts[a] += len(hits)
                # An end or a row may be hit more than once.
                np.add.at(counts, ends[hits], 1)
                np.add.at(counts, own[rows[some + np.searchsorted(ran, hits, "right")]], 1)
        marked[out] = False
    found = np.flatnonzero(counts)
    return pa.table({"no": pa.array(found, pa.int32()), "n": pa.array(counts[found])})


def average_clustering(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Mean over all vertices of triangles / possible triangles; 0 below two neighbours."""
    possible = F.col("degree") * (F.col("degree") - 1) / 2
    local = F.when(possible > 0, F.col("triangles") / possible).otherwise(F.lit(0.0))
    both = triangle_counts(vertices, edges).join(degrees(simple_edges(edges)), "id", "left")
    return both.agg(
        (F.sum(F.coalesce(local, F.lit(0.0))) / F.count(F.lit(1))).alias("avg_clustering")
    )


# --- path lengths ---------------------------------------------------------------------------


# So many hops of a search are united in one plan before they are written out.
HOPS_PER_WRITE = 16


def sample_path_lengths(edges: DataFrame, sources: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Hops between each source vertex (id) and every vertex it reaches, as unordered pairs
    (src, dst, hops), each source with itself at 0. `names` (id, no) has the ids of vertices
    that are numbers in the edges and sources."""
    reached, numbers = reached_sets(edges, sources)
    if names is not None:
        names = names.select(F.col("no").alias("at"), F.col("id").alias("_id"))
        reached = reached.join(names, "at").select(F.col("_id").alias("at"), "word", "bits", "hops")
        numbers = written(numbers.withColumnRenamed("id", "at").join(names, "at").select(F.col("_id").alias("id"), "no"))
    return _path_pairs(reached, numbers)


def path_length_counts(edges: DataFrame, sources: DataFrame) -> DataFrame:
    """Number of such pairs per length (hops, n), counted from the bit sets.

    A pair of two sources is reached from both ends at the same hop, so half of those count;
    at hop 0 each source meets itself once.
    """
    reached, numbers = reached_sets(edges, sources)
    size = F.sum(F.bit_count("bits"))
    every = reached.groupBy("hops").agg(size.alias("n"))
    among = reached.join(numbers.select(F.col("id").alias("at")), "at", "left_semi")
    twice = among.filter("hops > 0").groupBy("hops").agg(size.alias("twice"))
    once = F.col("n") - F.coalesce("twice", F.lit(0)) / 2
    return every.join(twice, "hops", "left").select("hops", once.cast("bigint").alias("n"))


# Edges that a cell of a search holds at most, 8 bytes each, and rows of its front, by two groups.
SEARCH_EDGES = 8_000_000
SEARCH_ROWS = 16_000_000
# Up to so many sources are sent to every task.
BROADCAST_SOURCES = 1_000_000
# Passes that name the neighbourhoods by which sources are put in order.
ORDER_ROUNDS = 2


def reached_sets(
    edges: DataFrame, sources: DataFrame, cell_edges: int = SEARCH_EDGES, cell_rows: int = SEARCH_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Which sources reach each vertex at which hop (at, word, bits, hops), and the numbers
    of the sources (id, no).

    Breadth first, one checkpointed job per hop. Sources are numbered, and the ones that
    reach a vertex travel as 64-bit sets, one row per vertex and 64 sources. Sources near
    each other are numbered one after another, so that their sets are full and few; the order
    changes no result. The vertices are dealt into groups, and a cell of two groups
    holds the edges between them. A hop sends each row of the front to the cells of its
    group, where the sets along all edges to a vertex merge, so messages along edges are
    never rows: a row moves once per group, there and back. Cells are cut by words as well
    where the fronts of two groups need it. A neighbour of a vertex at hop h lies at h-1, h
    or h+1, so a new front is held against the last two fronts only.
    """
    plain = written(simple_edges(edges))
    total = plain.count()
    ends = plain.select(F.col("src").alias("id")).union(plain.select("dst")).union(sources.select("id"))
    places = written(number_keys(ends.filter("id is not null"), "id", "spot"))
    n_vertices = places.count()
    cores = edges.sparkSession.sparkContext.defaultParallelism
    groups = max(math.isqrt(2 * total // cell_edges) + 1, 2 * math.isqrt(cores))
    ship(edges.sparkSession)
    half = written(_at_places(plain, places, "src", total).drop("src"))
    discard(plain)
    cells = written(_edge_cells(_at_places(half, places, "dst", total), groups))
    discard(half)
    numbers = written(_near_numbers(cells, places, sources, groups, n_vertices))
    one = F.lit(1).cast("bigint")
    begin = numbers.select(
        "id",
        F.floor(F.col("no") / 64).alias("word"),
        F.call_function("shiftleft", one, (F.col("no") % 64).cast("int")).alias("bits"),
    )
    words = -(-numbers.count() // 64)
    at_once = max(1, cell_rows * groups // (2 * max(n_vertices, 1)))
    blocks = max(1, -(-words // at_once))
    by_block = cells.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    front = written(begin.join(places, "id").select("spot", "word", "bits"))
    before = front.limit(0)
    reached = begin.select(F.col("id").alias("at"), "word", "bits", F.lit(0).alias("hops"))
    per_group = -(-n_vertices // groups)
    # Rows found so far that bear numbers of vertices in place of ids.
    waiting = None

    def named(rows: DataFrame) -> DataFrame:
        return rows.join(places, "spot").select(F.col("id").alias("at"), "word", "bits", "hops")

    for hops in itertools.count(1):
        block = F.floor(F.col("word") / at_once).cast("int").alias("block")
        step = _to_cells(front, groups, block, "word", "bits").groupBy("i", "j", "block")
        sent = by_block.groupBy("i", "j", "block").cogroup(step)
        found = sent.applyInArrow(lambda cell, rows: _spread(cell, rows, groups, per_group), "spot long, word long, bits long")
        known = front.unionByName(before).groupBy("spot", "word").agg(F.bit_or("bits").alias("known"))
        fresh = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("known", F.lit(0).cast("bigint"))))
        new = found.groupBy("spot", "word").agg(F.bit_or("bits").alias("bits")).join(known, ["spot", "word"], "left")
        new = new.select("spot", "word", fresh.alias("bits")).filter("bits <> 0")
        new, seen = cut_observed(new, n=F.count(F.lit(1)))
        if not seen["n"]:
            discard(cells, new)
            return (reached if waiting is None else reached.unionByName(named(waiting))), numbers
        here = new.withColumn("hops", F.lit(hops))
        waiting = here if waiting is None else waiting.unionByName(here)
        if hops % HOPS_PER_WRITE == 0:
            waiting = written(waiting)
        before, front = front, new


def _at_places(edges: DataFrame, places: DataFrame, end: str, total: int) -> DataFrame:
    """Edges with the number of one end, `at_src` or `at_dst`."""
    spots = places.select(F.col("id").alias(end), F.col("spot").alias(f"at_{end}"))
    return lookup(edges, spots, end, "inner", total=total)


def _edge_cells(edges: DataFrame, groups: int) -> DataFrame:
    """One row per cell (i, j, a, b), i <= j: the edges between groups i and j, as the places
    of their ends in the groups, in the order of b. Vertex `spot` has place spot // groups."""
    first, second = (F.struct((F.col(c) % groups).cast("int").alias("group"), F.expr(f"cast({c} div {groups} as int)").alias("place")) for c in ("at_src", "at_dst"))
    ends = edges.select(F.least(first, second).alias("x"), F.greatest(first, second).alias("y"))
    rows = ends.select(F.col("x.group").alias("i"), F.col("y.group").alias("j"), F.col("x.place").alias("a"), F.col("y.place").alias("b"))
    return rows.groupBy("i", "j").applyInArrow(_packed, "i int, j int, a binary, b binary")


def _packed(rows: pa.Table) -> pa.Table:
    a, b = (rows[c].to_numpy().astype(np.int32) for c in "ab")
    order = np.argsort(b, kind="stable")
    return pa.table({"i": rows["i"][:1], "j": rows["j"][:1], "a": [a[order].tobytes()], "b": [b[order].tobytes()]})


def _to_cells(rows: DataFrame, groups: int, *columns: Column | str) -> DataFrame:
    """Rows of vertices, once for each cell of their group; `side` tells which group it is."""
    own, other = (F.col("spot") % groups).cast("int"), F.col("other")
    sent = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    return sent.select(
        F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), (own > other).cast("int").alias("side"),
        F.expr(f"cast(spot div {groups} as int)").alias("place"), *columns,
    )


def _cell_edges(cell: pa.Table) -> tuple[int, int, np.ndarray, np.ndarray]:
    a, b = (np.frombuffer(cell[c][0].as_py(), np.int32) for c in "ab")
    return cell["i"][0].as_py(), cell["j"][0].as_py(), a, b


def _begins(ends: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))


def _spread(cell: pa.Table, rows: pa.Table, groups: int, per_group: int) -> pa.Table:
    """The sets of a front moved along the edges of a cell and merged: (spot, word, bits)."""
    out = [(np.empty(0, np.int64),) * 3]
    if len(cell) and len(rows):
        i, j, a, b = _cell_edges(cell)
        order = np.argsort(a, kind="stable")
        # Edges in the order of their b end and in the order of their a end.
        views = (a, b), (b[order], a[order])
        side, place, word, bits = (rows[c].to_numpy() for c in ("side", "place", "word", "bits"))
        by_word = np.argsort(word, kind="stable")
        held = np.zeros(per_group, np.int64)
        for here in np.split(by_word, _begins(word[by_word])[1:]):
            for way, group in ((0, j), (1, i)):
                own = here if i == j else here[side[here] == way]
                if not len(own):
                    continue
                held[place[own]] = bits[own]
                (starts, ends), (ends_of, begin) = views[way], views[1 - way]
                # A small front looks up its own edges, a large one goes along all of them.
                low, high = np.searchsorted(begin, place[own], "left"), np.searchsorted(begin, place[own], "right")
                size = high - low
                if 32 * size.sum() < len(begin):
                    at = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
                    to, sets = ends_of[at], np.repeat(bits[own], size)
                    sort = np.argsort(to, kind="stable")
                    to, sets = to[sort], sets[sort]
                else:
                    sets = held[starts]
                    some = np.flatnonzero(sets)
                    to, sets = ends[some], sets[some]
                held[place[own]] = 0
                if len(to):
                    at = _begins(to)
                    merged = np.bitwise_or.reduceat(sets, at)
                    out.append((to[at].astype(np.int64) * groups + group, np.full(len(at), word[own[0]]), merged))
    spot, word, bits = (np.concatenate(c) for c in zip(*out))
    return pa.table({"spot": spot, "word": word, "bits": bits})


def _near_numbers(cells: DataFrame, places: DataFrame, sources: DataFrame, groups: int, n_vertices: int) -> DataFrame:
    """Numbers of the sources (id, no), those of one neighbourhood one after another.

    A few passes give a vertex the least number that it finds near it, as far as each
    cell's own edges lead. In a close-knit component that is one number for all.
    """
    per_group = -(-n_vertices // groups)
    near = begun = places.select("spot", F.col("spot").alias("near"))
    for _ in range(ORDER_ROUNDS):
        sent = cells.groupBy("i", "j").cogroup(_to_cells(near, groups, "near").groupBy("i", "j"))
        found = sent.applyInArrow(lambda cell, rows: _least_near(cell, rows, groups, per_group), "spot long, near long")
        last, near = near, written(near.unionByName(found).groupBy("spot").agg(F.min("near").alias("near")))
        if last is not begun:
            discard(last)
    rows = sources.select("id").distinct().join(places.join(near, "spot").select("id", "near"), "id", "left")
    known = F.coalesce("near", F.lit(-1).cast("bigint"))
    rows = cut(rows.select("id", known.alias("near"), F.lit(0).alias("_all"), F.lit(1).cast("bigint").alias("_one")))
    discard(near)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("near"), F.lit(4096)))
    ranked = running_total(rows, ["_all"], ["near", "id"], "_one", "_rank", "_block")
    return ranked.select("id", (F.col("_rank") - 1).alias("no"))


def _least_near(cell: pa.Table, rows: pa.Table, groups: int, per_group: int) -> pa.Table:
    """The least number among those that the edges of a cell lead to, where it is a new one."""
    out = [(np.empty(0, np.int64),) * 2]
    if len(cell) and len(rows):
        i, j, a, b = _cell_edges(cell)
        side, place, number = (rows[c].to_numpy() for c in ("side", "place", "near"))
        least = np.zeros((2, per_group), np.int64)
        least[side, place] = number
        if i == j:
            least[1] = least[0]
        before, order = least.copy(), np.argsort(a, kind="stable")
        ways = [(0, a, 1, b, _begins(b)), (1, b[order], 0, a[order], _begins(a[order]))]
        # Close-knit parts agree within a few turns; a long chain is left to other orders.
        for _ in range(8):
            turn = least.copy()
            for start, starts, end, ends, at in ways:
                to = ends[at]
                least[end, to] = np.minimum(least[end, to], np.minimum.reduceat(least[start, starts], at))
            if i == j:
                least[:] = least.min(axis=0)
            if (turn == least).all():
                break
        for row, group in ((0, i), (1, j)):
            to = np.flatnonzero(least[row] < before[row])
            out.append((to * groups + group, least[row, to]))
    spot, near = (np.concatenate(c) for c in zip(*out))
    return pa.table({"spot": spot, "near": near})


def _path_pairs(reached: DataFrame, numbers: DataFrame) -> DataFrame:
    """Open the source sets into unordered pairs, each once.

    A pair of two sources is reached from both ends; it is kept from its lower end only, so
    the opened rows need no shuffle to become distinct.
    """
    ends = numbers.select(F.col("id").alias("at"), F.lit(True).alias("is_source"))
    opened = reached.join(ends, "at", "left").select(
        "at", "is_source", "word", "bits", "hops", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("bit")
    )
    is_set = F.call_function("shiftright", F.col("bits"), F.col("bit")).bitwiseAND(F.lit(1)) == 1
    rows = opened.filter(is_set).withColumn("no", F.col("word") * 64 + F.col("bit"))
    sources = numbers.withColumnRenamed("id", "source")
    if numbers.count() <= BROADCAST_SOURCES:
        # So that the opened rows, which are the result, stay where they are.
        named = rows.join(F.broadcast(sources), "no")
    else:
        named = lookup(rows, sources, "no", how="inner", spread=["at"])
    once = named.filter("is_source is null or source <= at")
    return once.select(F.least("source", "at").alias("src"), F.greatest("source", "at").alias("dst"), "hops")
