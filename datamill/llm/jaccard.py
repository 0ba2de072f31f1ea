"""Near duplicates: documents whose shingle sets have a Jaccard similarity of at least a
threshold, found by a grouped prefix join.

Every pair over the threshold shares shingles among the first few of both sets, once all
sets are put in one order; with each shingle that the prefixes are longer than they must be,
one more is shared, which keeps long documents from meeting by chance. Rare shingles come first, by counts over the whole corpus in a
table of fixed size. Documents with the same set are one class; classes with the same
prefix and size are one group, and only groups are joined on prefix shingles.

The result is a component per document, so links inside a component need not all be seen.
First each group is compared with one partner, and its members with the group's first one;
that joins nearly all copies. Then groups that share a prefix shingle but lie in different
components are paired, filtered by size and by what both have left to share around the
shingle, expanded to members, filtered by an exact bound
from 512-bit parity maps, and verified on their whole sets. No link between different
components is missed, and a large group of copies never meets itself pair by pair. Prefix
shingles that one group alone has are left out once, before both steps; of a run of shingles
that two groups share one after another only the ends become rows, and their places give
its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datamill.llm.tables import discard, ship, written
from datamill.llm.words import blocks, grams, mix, sequence_hash, word_hashes
from datamill.operators.network import connected_components
from datamill.operators.skew import lookup

COUNTERS = 1 << 18
CHUNK = 4096
# A chunk is summed in so many parts first, so that no group holds a row of every task.
PARTS = 64
# Vertices of rows without an id are at least this.
NAMELESS = 1 << 62
MAP_BITS = 512
MAPS = tuple(f"map_{i}" for i in range(MAP_BITS // 64))
PREFIXES = (
    "doc_id long, named boolean, n long, print_a long, print_b long, group_a long, group_b long, "
    + "".join(f"{m} long, " for m in MAPS)
    + "prefix binary"
)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of every text of a batch."""
    for rows, data, at in blocks(batch["text"]):
        words, first = word_hashes(data, at, lower=True)
        for i, row in enumerate(range(rows.start, rows.stop)):
            own = words[first[i] : first[i + 1]]
            if 0 < len(own) < k:
                yield row, mix(np.array([sequence_hash(own)], np.uint64))
            else:
                yield row, np.unique(grams(own, k))


def _count(k: int):
    """Sets per counter, over all texts of a task, in chunks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            found, held = [], 0
            for _, own in _sets(batch, k):
                found.append(own)
                held += len(own)
                if held > 1_000_000:
                    total += np.bincount((np.concatenate(found) % COUNTERS).astype(np.int64), minlength=COUNTERS)
                    found, held = [], 0
            if found:
                total += np.bincount((np.concatenate(found) % COUNTERS).astype(np.int64), minlength=COUNTERS)
        rows = [(c, total[c * CHUNK : (c + 1) * CHUNK]) for c in range(COUNTERS // CHUNK)]
        rows = [(c, n.tobytes()) for c, n in rows if n.any()]
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array([c for c, _ in rows], pa.int32()), "counts": pa.array([n for _, n in rows], pa.binary())}
        )

    return count


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x, np.int64) for x in table["counts"].to_pylist())
    return pa.table({"chunk": table["chunk"][:1].cast(pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def shingle_counts(documents: DataFrame, k: int) -> np.ndarray:
    """How many sets fall on each of 2^18 counters: two megabytes, however large the corpus."""
    schema = "chunk int, counts binary"
    tasks = documents.select("text").mapInArrow(_count(k), schema)
    part = F.pmod(F.xxhash64("counts"), F.lit(PARTS)).alias("part")
    some = tasks.groupBy("chunk", part).applyInArrow(_add, schema)
    chunks = some.groupBy("chunk").applyInArrow(_add, schema)
    total = np.zeros(COUNTERS, np.int64)
    for row in chunks.collect():
        total[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = np.frombuffer(row.counts, np.int64)
    return total


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, np.uint64).view(np.int64))


def _prefixes(k: int, percent: int, counts: np.ndarray):
    ranks = np.minimum(counts, np.iinfo(np.uint32).max).astype(np.uint32)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size, prefix = [], [], []
            prints: list[tuple[int, ...]] = []
            for row, own in _sets(batch, k):
                n = len(own)
                keep = n - -(-percent * n // 100) + _extra(n) if n else 0
                order = np.lexsort((own, ranks[(own % COUNTERS).astype(np.int64)]))[:keep]
                first = own[order]
                places = (own & np.uint64(MAP_BITS - 1)).astype(np.int64)
                parity = np.packbits((np.bincount(places, minlength=MAP_BITS) & 1).astype(np.uint8))
                other, step = mix(own + np.uint64(1)), np.uint64(n)
                prints.append(
                    (
                        sequence_hash(own), sequence_hash(other), sequence_hash(first + step), sequence_hash(mix(first) + step),
                        *parity.view(np.uint64).tolist(),
                    )
                )
                rows.append(row)
                size.append(n)
                prefix.append(first.tobytes())
            columns = [_signed([p[j] for p in prints]) for j in range(4 + len(MAPS))]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c].take(pa.array(rows, pa.int64())) for c in ("doc_id", "named")), pa.array(size, pa.int64()), *columns, pa.array(prefix, pa.binary())],
                names=["doc_id", "named", "n", "print_a", "print_b", "group_a", "group_b", *MAPS, "prefix"],
            )

    return make


def _extra(n):
    """Shingles that two prefixes must share, by the smaller set: one for each 64 members."""
    return 1 + n // 64 if isinstance(n, int) else F.lit(1) + F.floor(n / 64)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per prefix shingle of a group: shingle, its place in the order of the whole
    set, and the group's other columns."""
    for batch in batches:
        prefix = [np.frombuffer(p, np.int64) for p in batch["prefix"].to_pylist()]
        sizes = np.array([len(p) for p in prefix], np.int64)
        place = pa.array(np.repeat(np.arange(len(prefix)), sizes))
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        rest = [c for c in batch.schema.names if c != "prefix"]
        token = pa.array(np.concatenate(prefix) if prefix else np.empty(0, np.int64))
        columns = [token, pa.array(at, pa.int64()), *(batch[c].take(place) for c in rest)]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "at", *rest])


def _set_rows(k: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets = [], []
            for row, own in _sets(batch, k):
                rows.append(row)
                sets.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(sets, pa.binary())], names=["id", "members"]
            )

    return make


def _linked(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch["set_a"].to_pylist(), batch["set_b"].to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(a) + len(b) - len(np.union1d(a, b))
                good.append(bool(len(a)) and 100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return check


def _verified(documents: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets are similar enough."""
    needed = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = documents.select("doc_id", "text").join(needed, "doc_id")
    sets = written(texts.mapInArrow(_set_rows(k), "id long, members binary"))
    first, second = (sets.select(F.col("id").alias(c), F.col("members").alias(f"set_{c}")) for c in "ab")
    both = lookup(pairs, first, "a", how="inner", spread=["b"])
    both = lookup(both, second, "b", how="inner", spread=["a"], probe=pairs)
    links = written(both.select("a", "b", "set_a", "set_b").mapInArrow(_linked(percent), "a long, b long"))
    discard(sets)
    return links


def _fits(n: Column, m: Column, percent: int) -> Column:
    """Sizes so far apart that no such sets can be similar enough are no pair."""
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def _beyond(n: Column, percent: int) -> Column:
    """Members of a set of `n` that lie behind its prefix, as `_prefixes` cuts it."""
    return F.greatest(F.lit(0), F.ceil(F.lit(percent) * n / 100) - F.lit(1) - F.floor(n / 64))


def _within_reach(percent: int) -> Column:
    """An exact bound on sets a and b that share a shingle: of the members before it in the
    order of all sets, and of those behind it, they share at most what the poorer has left."""
    shared = F.least("nth_a", "nth_b") + F.least("later_a", "later_b")
    return F.lit(100 + percent) * shared >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))


def _near_enough(percent: int) -> Column:
    """An exact bound on sets a and b: a bit that differs between their parity maps stands
    for a shingle that only one of them has."""
    apart = sum((F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in MAPS), F.lit(0))
    both = F.col("n_a") + F.col("n_b")
    return F.lit(100) * (both - apart) >= F.lit(percent) * (both + apart)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of ids that sizes and parity maps leave possible."""
    known = classes.select("id", "n", *MAPS)
    for side in "ab":
        own = [F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", *MAPS)]]
        pairs = pairs.join(known.select(*own), side)
    fits = _fits(F.col("n_a"), F.col("n_b"), percent) & _near_enough(percent)
    return pairs.filter(fits).select("a", "b").distinct()


def near_duplicates(
    documents: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A document's set holds its distinct runs of `k` words, A-Z lower-cased; with fewer words
    the whole sequence is the one member. Two documents are linked when
    100 · |intersection| >= percent · |union|; `component_id` is the smallest id that links
    reach, the document's own included.

    A null or empty text has an empty set, size 0, and is linked with nothing. Rows that
    repeat an id are one document with several texts: each is returned, and they share a
    component. Rows without an id are returned too, and get the component their text
    reaches, or null where no row with an id is in it; each of their texts counts for itself. An empty table gives no rows. Other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    # A row without an id is a vertex named by its text.
    own = F.col(id_column).cast("bigint")
    by_text = F.lit(NAMELESS) + F.pmod(F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))), F.lit(NAMELESS))
    docs = documents.select(
        F.coalesce(own, by_text).alias("doc_id"), own.isNotNull().alias("named"), F.col(text_column).alias("text")
    )
    counts = shingle_counts(docs, k)
    found = written(docs.mapInArrow(_prefixes(k, percent, counts), PREFIXES))
    filled = found.filter("n > 0")
    classes = written(
        filled.groupBy("print_a", "print_b").agg(
            F.min("doc_id").alias("id"), F.min(F.when(F.col("named"), F.col("doc_id"))).alias("least_id"),
            *[F.first(c).alias(c) for c in ("n", "group_a", "group_b", *MAPS)],
        )
    )
    groups = written(
        filled.groupBy("group_a", "group_b").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix")
        )
    )
    rows = written(found.select("doc_id", "named", "n", "print_a", "print_b"))
    discard(found)
    tokens = groups.select("rep", "n", "prefix").mapInArrow(_tokens, "token long, at long, rep long, n long")

    # Shingles of more than one group, with the least group that has them.
    least = tokens.groupBy("token").agg(F.min(F.struct("rep", "n")).alias("least"), F.count(F.lit(1)).alias("m"))
    least = least.filter("m > 1").select("token", F.col("least.rep").alias("pivot"), F.col("least.n").alias("pivot_n"))
    repeated = written(tokens.join(least, "token"))

    # One partner per group: where its shingles lead most often.
    near = repeated.filter(F.col("pivot") < F.col("rep")).filter(_fits(F.col("n"), F.col("pivot_n"), percent))
    least_n = F.first(F.least("n", "pivot_n")).alias("least")
    near = near.groupBy("rep", "pivot").agg(F.count(F.lit(1)).alias("shared"), least_n)
    near = near.filter(F.col("shared") >= _extra(F.col("least")))
    near = near.groupBy("rep").agg(F.max_by("pivot", F.struct("shared", -F.col("pivot"))).alias("pivot"))
    group_of = classes.select("id", "group_a", "group_b").join(groups.select("group_a", "group_b", "rep"), ["group_a", "group_b"])
    pairs = near.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).union(
        group_of.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    )
    pairs = _plausible(pairs.distinct(), classes, percent)
    pairs = written(pairs)
    links = _verified(docs, pairs, k, percent)
    vertices = classes.select("id").distinct()
    joined = written(_components(vertices, links))
    used = [pairs, links, joined]

    # Every other pair of groups that share a shingle and lie in different components.
    cells = classes.join(joined, "id").join(groups.select("group_a", "group_b", "rep"), ["group_a", "group_b"])
    cells = written(cells.select("id", "rep", "component", "n", *MAPS))
    spread = cells.groupBy("rep", "component").agg(
        *[F.first(c).alias(c) for c in ("n", *MAPS)], (F.count(F.lit(1)) == 1).alias("single")
    )
    spread = written(spread)
    placed = repeated.select("token", "at", "rep").join(spread.select("rep", "component"), "rep")
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(mixed.filter("low < high").select("token"), "token")
    order = Window.partitionBy("rep", "component").orderBy("at")
    placed = placed.select(
        "token", "rep", "component", F.row_number().over(order).alias("nth"),
        F.lag("token").over(order).alias("before"), F.lead("token").over(order).alias("after"),
    )
    # What a set may share with one of another component: these shingles of its prefix and
    # the members behind the prefix. Sets that cannot share enough with any other are left out.
    whole = Window.partitionBy("rep", "component")
    placed = placed.join(spread, ["rep", "component"]).withColumn("most", F.count(F.lit(1)).over(whole) + _beyond(F.col("n"), percent))
    placed = placed.filter(F.lit(100) * F.col("most") >= F.lit(percent) * F.col("n"))
    placed = written(placed.withColumn("later", F.col("most") - F.col("nth")).drop("most"))
    used += [repeated, groups, cells, spread, placed]
    left = placed.select("token", *[F.col(c).alias(f"{c}_a") for c in placed.columns if c != "token"])
    right = placed.select("token", *[F.col(c).alias(f"{c}_b") for c in placed.columns if c != "token"])
    # Two groups of one member each are held against the members' bound at once.
    hopeful = ~F.col("single_a") | ~F.col("single_b") | _near_enough(percent)
    apart = (F.col("component_a") < F.col("component_b")) & _fits(F.col("n_a"), F.col("n_b"), percent) & hopeful
    starts, ends = (~F.coalesce(F.col(f"{c}_a") == F.col(f"{c}_b"), F.lit(False)) for c in ("before", "after"))
    length = F.when(ends, F.col("nth_a")).otherwise(0) - F.when(starts, F.col("nth_a") - 1).otherwise(0)
    group_pairs = (
        left.join(right, "token")
        .filter(apart & (starts | ends) & _within_reach(percent))
        .groupBy("rep_a", "component_a", "rep_b", "component_b")
        .agg(F.sum(length).alias("shared"), F.first(F.least("n_a", "n_b")).alias("least"))
        .filter(F.col("shared") >= _extra(F.col("least")))
        .drop("shared", "least")
    )
    # Members of one group that lie in different components share the whole prefix.
    own = [spread.select("rep", *[F.col(c).alias(f"{c}_{x}") for c in spread.columns if c != "rep"]) for x in "ab"]
    same = own[0].join(own[1], "rep").filter(apart)
    same = same.select(F.col("rep").alias("rep_a"), "component_a", F.col("rep").alias("rep_b"), "component_b")
    group_pairs = group_pairs.union(same)
    one = cells.select(*[F.col(c).alias(f"{c}_a") for c in cells.columns])
    two = cells.select(*[F.col(c).alias(f"{c}_b") for c in cells.columns])
    members = (
        group_pairs.join(one, ["rep_a", "component_a"])
        .join(two, ["rep_b", "component_b"])
        .filter(_near_enough(percent))
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    )
    open_pairs = written(members.distinct())
    used.append(open_pairs)
    if not open_pairs.isEmpty():
        more = _verified(docs, open_pairs, k, percent)
        used.append(more)
        bridges = more.join(joined.select(F.col("id").alias("a"), F.col("component").alias("from")), "a")
        bridges = bridges.join(joined.select(F.col("id").alias("b"), F.col("component").alias("to")), "b")
        bridges = bridges.select(F.col("from").alias("a"), F.col("to").alias("b")).distinct()
        roots = joined.select(F.col("component").alias("id")).distinct()
        merged = _components(roots, bridges).select(F.col("id").alias("component"), F.col("component").alias("root"))
        joined = joined.join(merged, "component").select("id", F.col("root").alias("component"))
    class_of = classes.select("print_a", "print_b", "id", "least_id").join(joined, "id")
    class_of = written(class_of.select("print_a", "print_b", "component", "least_id"))
    discard(classes, *used)
    # Components whose least vertex may have no id, and the least id in them, if any.
    doubtful = class_of.filter(F.col("component") >= NAMELESS).groupBy("component")
    doubtful = written(doubtful.agg(F.min("least_id").alias("reached")))
    reached = F.when(F.col("component") < NAMELESS, F.col("component")).otherwise(F.col("reached"))
    class_of = class_of.join(doubtful, "component", "left").select("print_a", "print_b", reached.alias("component"))
    own = F.when(F.col("named"), F.col("doc_id"))
    return rows.join(class_of, ["print_a", "print_b"], "left").select(
        own.alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", own).alias("component_id")
    )


def _components(vertices: DataFrame, links: DataFrame) -> DataFrame:
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    return connected_components(vertices, edges)
