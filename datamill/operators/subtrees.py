"""Deep decision trees: the solver grows the top, and rows that a top leaf holds meet in one
task, which grows the rest of that branch. Where many rows share the bins of all features, rows
are counted by them first, and one task grows the whole tree from the counts.

The solver moves a dense histogram per node and part of the rows, so the lower levels of a deep
tree, with many nodes of few rows, cost nodes times parts. Below the top a row moves once.
Thresholds, gains, ties and the order of categories are the solver's, and so is the tree.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from datamill.session import cut, cut_observed, ship

# Values (rows times features) of a top leaf that one task takes.
LOCAL_VALUES = 1 << 23
# Counts of categories that are held at once.
DENSE_CELLS = 1 << 22
EPSILON = 2.0**-52

NODES = "region bigint, node int, feature int, threshold double, categories binary, child int, prediction double"


class Rules(NamedTuple):
    """What the growing of a branch needs: per feature thresholds, or the number of categories."""

    impurity: str
    classes: int
    thresholds: dict[int, np.ndarray]
    arity: dict[int, int]
    unordered: frozenset[int]


# --- split candidates ------------------------------------------------------------------------


def category_sizes(rows: DataFrame) -> dict[int, int]:
    """Categories per nominal feature, from the metadata of the vectors."""
    attributes = rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attributes.get("nominal", []) if "vals" in a or "num_vals" in a}
    return nominal | {a["idx"]: 2 for a in attributes.get("binary", [])}


def _cuts(values: np.ndarray, bins: int, n: float) -> np.ndarray:
    """At most `bins` - 1 thresholds between different values, near equal shares of `n` rows,
    as many as were to be drawn; zeros are what the other values leave of them."""
    different, counts = np.unique(values[values != 0], return_counts=True)
    zeros = n - counts.sum()
    if zeros > EPSILON * len(values) * 100:
        at = np.searchsorted(different, 0.0)
        different, counts = np.insert(different, at, 0.0), np.insert(counts.astype(float), at, zeros)
    middle = (different[:-1] + different[1:]) / 2.0
    if len(middle) <= bins - 1:
        return middle
    upto, stride = np.cumsum(counts), n / bins
    found, target = [], stride
    for i in range(1, len(different)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(middle[i - 1])
            target += stride
    return np.array(found)


def _solvers_sample(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """The rows that the solver draws for its thresholds, by the same sampler and seed."""
    spark = rows.sparkSession
    drawn = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    some = rows._jdf.toJavaRDD().sample(False, share, drawn)
    return DataFrame(spark._jsparkSession.createDataFrame(some, rows._jdf.schema()), spark)


def thresholds(rows: DataFrame, n_rows: int, bins: int, features: list[int], seed: int) -> dict[int, np.ndarray]:
    """Thresholds per continuous feature, from the solver's own sample: bins² rows, 10,000 at
    least, all rows where there are no more."""
    if not features:
        return {}
    rows, wanted = rows.select("features"), max(bins * bins, 10_000)
    some = _solvers_sample(rows, wanted / n_rows, seed) if wanted < n_rows else rows
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col("_x")[f].alias("value")) for f in features])
    cells = some.select(vector_to_array("features").alias("_x")).select(F.inline(cells))

    def cuts(own: pa.Table) -> pa.Table:
        found = _cuts(own["value"].to_numpy(), min(bins, n_rows), float(min(wanted, n_rows)))
        return pa.table({"feature": own["feature"][:1].cast(pa.int32()), "cuts": pa.array([found], pa.list_(pa.float64()))})

    found = cells.groupBy("feature").applyInArrow(cuts, "feature int, cuts array<double>").collect()
    return {r.feature: np.array(r.cuts) for r in found}


def rules(rows: DataFrame, n_rows: int, n_features: int, classes: int, impurity: str, bins: int, seed: int) -> Rules:
    arity = category_sizes(rows)
    # Few categories of a problem of several classes are tried in all subsets.
    most = int(np.log(min(bins, n_rows) // 2 + 1) / np.log(2.0) + 1)
    unordered = frozenset(f for f, n in arity.items() if classes > 2 and n <= most)
    numeric = [f for f in range(n_features) if f not in arity]
    return Rules(impurity, classes, thresholds(rows, n_rows, bins, numeric, seed), arity, unordered)


# --- growing one branch ----------------------------------------------------------------------


def _impurity(kind: str, counts: np.ndarray) -> np.ndarray:
    """Impurity over the last axis, class after class, as rounding decides ties."""
    n = counts.sum(axis=-1)
    worth = np.ones(n.shape) if kind == "gini" else np.zeros(n.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(counts.shape[-1]):
            share = counts[..., c] / n
            if kind == "gini":
                worth -= share * share
            else:
                worth -= np.where(counts[..., c] > 0, share * (np.log(share) / np.log(2.0)), 0.0)
    return worth


def _gains(kind: str, whole: np.ndarray, worth: np.ndarray, left: np.ndarray) -> np.ndarray:
    """What splits gain; none where a side is empty."""
    right = whole - left
    n_left, n_right = left.sum(axis=-1), right.sum(axis=-1)
    n = n_left + n_right
    gain = worth - n_left / n * _impurity(kind, left) - n_right / n * _impurity(kind, right)
    return np.where((n_left > 0) & (n_right > 0), gain, -np.inf)


def _numeric_split(kind: str, at: np.ndarray, bins: np.ndarray, labels: np.ndarray, times, total: np.ndarray, worth: np.ndarray):
    """Per node the best gain and the bin it is behind; the lowest of equal ones."""
    nodes, classes = total.shape
    width = int(bins.max()) + 1
    cells = (at * width + bins) * classes + labels
    order = None if times is None else np.argsort(cells, kind="stable")
    cells = np.sort(cells) if order is None else cells[order]
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    counts = np.diff(first, append=len(cells)) if order is None else np.add.reduceat(times[order], first)
    places, inverse = np.unique(cells[first] // classes, return_inverse=True)
    table = np.zeros((len(places), classes), np.int64)
    table[inverse, cells[first] % classes] = counts
    node = places // width
    upto = np.cumsum(table, axis=0)
    start = np.searchsorted(node, np.arange(nodes))
    before = upto[start] - table[start]
    inside = np.flatnonzero(np.diff(node, append=-1) == 0)  # the last bin of a node splits nothing
    gain, where = np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
    if len(inside):
        own = node[inside]
        gains = _gains(kind, total[own], worth[own], upto[inside] - before[own])
        held, begin = np.unique(own, return_index=True)
        gain[held] = np.maximum.reduceat(gains, begin)
        best = np.flatnonzero(gains == gain[own])
        held, begin = np.unique(own[best], return_index=True)
        where[held] = (places % width)[inside[best[begin]]]
    return gain, where


def _count(cells: np.ndarray, times: np.ndarray | None, size: int) -> np.ndarray:
    """Rows per cell; whole numbers stay exact in the doubles that weights give."""
    return np.bincount(cells, times, minlength=size).astype(np.int64)


def _category_split(rules: Rules, feature: int, at, values, labels, times, total, worth):
    """Per node the best gain and the categories that go left, as bits."""
    arity, classes, nodes = rules.arity[feature], rules.classes, len(total)
    gain, sets = np.full(nodes, -np.inf), np.zeros((nodes, arity), bool)
    order = np.argsort(at, kind="stable")
    bounds = np.searchsorted(at[order], np.arange(nodes + 1))
    step = max(1, DENSE_CELLS // (arity * classes))
    for low in range(0, nodes, step):
        high = min(nodes, low + step)
        own = order[bounds[low] : bounds[high]]
        cells = ((at[own] - low) * arity + values[own]) * classes + labels[own]
        own_times = None if times is None else times[own]
        counts = _count(cells, own_times, (high - low) * arity * classes).reshape(high - low, arity, classes)
        whole, whole_worth = total[low:high], worth[low:high]
        if feature in rules.unordered:
            for subset in range(1, 1 << (arity - 1)):
                picked = np.array([subset >> c & 1 for c in range(arity)], bool)
                gains = _gains(rules.impurity, whole, whole_worth, counts[:, picked].sum(axis=1))
                better = np.flatnonzero(gains > gain[low:high])
                gain[low + better], sets[low + better] = gains[better], picked
            continue
        score = _impurity(rules.impurity, counts) if classes > 2 else counts[..., 1].astype(float)
        ranked = np.argsort(np.where(counts.sum(axis=-1) > 0, score, np.inf), axis=1, kind="stable")
        left = np.cumsum(np.take_along_axis(counts, ranked[..., None], axis=1), axis=1)[:, :-1]
        if not left.shape[1]:
            continue
        gains = _gains(rules.impurity, whole[:, None], whole_worth[:, None], left)
        best = np.argmax(gains, axis=1)
        gain[low:high] = gains[np.arange(high - low), best]
        np.put_along_axis(sets[low:high], ranked, np.arange(arity) <= best[:, None], axis=1)
    return gain, sets


class Nodes(NamedTuple):
    """A branch: the split of each node, -1 for none, its left child (the right one follows)
    and its own most frequent class."""

    feature: np.ndarray
    threshold: np.ndarray
    categories: list[bytes]
    child: np.ndarray
    prediction: np.ndarray


def grow(x: np.ndarray, labels: np.ndarray, rules: Rules, steps: int, times: np.ndarray | None = None) -> Nodes:
    """The branch of at most `steps` levels below a node that holds these rows, each as many
    `times` as told."""
    columns = [
        x[:, f].astype(np.int64) if f in rules.arity else np.searchsorted(rules.thresholds[f], x[:, f])
        for f in range(x.shape[1])
    ]
    levels: list[Nodes] = []
    rows, at, n_nodes, made = np.arange(len(x)), np.zeros(len(x), np.int64), 1, 1
    for step in range(steps + 1):
        often = None if times is None else times[rows]
        total = _count(at * rules.classes + labels[rows], often, n_nodes * rules.classes).reshape(n_nodes, -1)
        level = Nodes(
            np.full(n_nodes, -1, np.int32), np.zeros(n_nodes), [b""] * n_nodes, np.full(n_nodes, -1, np.int32),
            np.argmax(total, axis=1).astype(float),
        )
        levels.append(level)
        worth = _impurity(rules.impurity, total)
        mixed = np.flatnonzero(np.abs(worth) >= EPSILON)
        if step == steps or not len(mixed):
            break
        # Rows of pure nodes are done.
        place = np.full(n_nodes, -1)
        place[mixed] = np.arange(len(mixed))
        open_rows = place[at] >= 0
        rows, at, total, worth = rows[open_rows], place[at[open_rows]], total[mixed], worth[mixed]
        often = None if times is None else times[rows]
        gain, feature = np.zeros(len(mixed)), np.full(len(mixed), -1)
        where, sets = np.zeros(len(mixed), np.int64), {}
        for f, column in enumerate(columns):
            if f in rules.arity:
                own, sets[f] = _category_split(rules, f, at, column[rows], labels[rows], often, total, worth)
                spot = where
            else:
                own, spot = _numeric_split(rules.impurity, at, column[rows], labels[rows], often, total, worth)
            better = own > gain
            gain, feature, where = np.where(better, own, gain), np.where(better, f, feature), np.where(better, spot, where)
        split = np.flatnonzero(feature >= 0)
        if not len(split):
            break
        child = np.full(len(mixed), -1)
        child[split] = np.arange(len(split)) * 2
        left = np.zeros(len(rows), bool)
        for f, column in enumerate(columns):
            own = np.flatnonzero(feature[at] == f)
            if f in rules.arity:
                left[own] = sets[f][at[own], column[rows[own]]]
            else:
                left[own] = column[rows[own]] <= where[at[own]]
        level.feature[mixed] = feature
        level.child[mixed[split]] = child[split] + made
        for i in split:
            if feature[i] in rules.arity:
                level.categories[mixed[i]] = np.packbits(sets[feature[i]][i]).tobytes()
            else:
                level.threshold[mixed[i]] = rules.thresholds[feature[i]][where[i]]
        on = child[at] >= 0
        rows, at = rows[on], child[at[on]] + ~left[on]
        n_nodes = 2 * len(split)
        made += n_nodes
    return Nodes(*(np.concatenate([getattr(lv, c) for lv in levels]) if c != "categories" else sum((lv.categories for lv in levels), []) for c in Nodes._fields))


def walk(x: np.ndarray, nodes: Nodes, steps: int) -> np.ndarray:
    """The class that a branch, cut after `steps` levels, gives each row."""
    at = np.zeros(len(x), np.int64)
    nominal = np.flatnonzero([len(c) > 0 for c in nodes.categories])
    place = np.zeros(len(nodes.feature), np.int64)
    place[nominal] = np.arange(len(nominal))
    wide = max((len(nodes.categories[i]) for i in nominal), default=1)
    bits = np.array([list(nodes.categories[i].ljust(wide, b"\0")) for i in nominal], np.uint8).reshape(-1, wide)
    is_nominal = np.zeros(len(nodes.feature), bool)
    is_nominal[nominal] = True
    for _ in range(steps):
        rows = np.flatnonzero(nodes.feature[at] >= 0)
        if not len(rows):
            break
        own = at[rows]
        value = x[rows, nodes.feature[own]]
        left = value <= nodes.threshold[own]
        by_set = np.flatnonzero(is_nominal[own])
        category = value[by_set].astype(np.int64)
        left[by_set] = bits[place[own[by_set]], category >> 3] >> (7 - (category & 7)).astype(np.uint8) & 1
        at[rows] = nodes.child[own] + ~left
    return nodes.prediction[at]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# --- the whole tree --------------------------------------------------------------------------


class Top(NamedTuple):
    """A shallow tree whose leaves are numbered from `first`, the levels left below each leaf
    (0: nothing to grow) and the tops that follow leaves of too many rows. A `solved` one is
    whole, however deep."""

    model: Model
    first: int
    left: list[int]
    below: dict[int, Any]
    solved: bool = False

    def placed(self, rows: DataFrame) -> DataFrame:
        """`rows` with `_region` and the top's own answer `_top`."""
        found = self.model.transform(rows).select(*rows.columns, "_leaf", F.col("prediction").alias("_top"))
        here = found.withColumn("_region", (F.col("_leaf") + self.first).cast("bigint")).drop("_leaf")
        if not self.below:
            return here
        here = here.filter(~(F.col("_region") - self.first).isin(list(self.below)))
        for leaf, top in self.below.items():
            here = here.unionByName(top.placed(found.filter(F.col("_leaf") == leaf).select(*rows.columns)))
        return here

    def levels(self) -> dict[int, int]:
        """Levels left per region that still grows."""
        own = {self.first + leaf: n for leaf, n in enumerate(self.left) if n and leaf not in self.below}
        for top in self.below.values():
            own |= top.levels()
        return own

    def count(self) -> int:
        return len(self.left) + sum(top.count() for top in self.below.values())


def leaf_depths(model: Model) -> list[int]:
    """Depth of each leaf, from left to right."""
    lines = re.findall(r"^( *)Predict:", model.toDebugString, re.MULTILINE)
    return [len(indent) - 2 for indent in lines]


def grow_top(rows: DataFrame, fit: Callable[[DataFrame, int], Model], depth: int, step: int, first: int = 0) -> Top:
    """Tops of at most `step` levels each, until leaves are small enough for a task, are pure or
    `depth` is reached. What a top does not split is grown to the end by the solver."""
    model = fit(rows, min(step, depth)).setLeafCol("_leaf")
    depths = leaf_depths(model)
    own = model.transform(rows).groupBy("_leaf").agg(
        F.count(F.lit(1)).alias("n"), (F.min("label") < F.max("label")).alias("mixed")
    )
    sizes = {int(r._leaf): r for r in own.collect()}  # one row per leaf of the top
    left = [depth - d if leaf in sizes and sizes[leaf].mixed else 0 for leaf, d in enumerate(depths)]
    top = Top(model, first, left, {})
    large = [leaf for leaf, n in enumerate(left) if n and sizes[leaf].n * model.numFeatures > LOCAL_VALUES]
    if large and len(depths) == 1:
        model = fit(rows, depth).setLeafCol("_leaf")
        return Top(model, first, [0] * len(leaf_depths(model)), {}, True)
    found = model.transform(rows)
    for leaf in large:
        part = found.filter(F.col("_leaf") == leaf).select(*rows.columns)
        top.below[leaf] = grow_top(part, fit, left[leaf], step, first + top.count())
    return top


def right_share(predictions: DataFrame) -> float:
    """Share of right predictions, NaN for no rows."""
    share = predictions.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    return float("nan") if share is None else share


class DeepTree:
    """A tree as tops and, in a table of nodes, the branches below their leaves."""

    def __init__(self, top: Top, nodes: DataFrame | None, depth: int, whole: int) -> None:
        self.top, self.nodes, self.depth, self.whole = top, nodes, depth, whole

    @property
    def cuts(self) -> bool:
        """Whether `at` can be asked: not of tops that follow each other or that the solver grew
        to the end, which have answers at their own leaves only."""
        return not self.top.below and not self.top.solved

    def at(self, depth: int) -> DeepTree:
        """The tree as it was when it had `depth` levels, no fewer than a top has."""
        return DeepTree(self.top, self.nodes, depth, self.whole)

    def right_shares(self, parts: Sequence[DataFrame], depths: Sequence[int]) -> dict[int, list[float]]:
        """Per depth the share of right answers in each of the parts, NaN for no rows."""
        return {depth: [right_share(self.at(depth).transform(part)) for part in parts] for depth in depths}

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows` with a `prediction`."""
        placed = self.top.placed(rows)
        spare = self.whole - self.depth
        levels = {region: n - spare for region, n in self.top.levels().items() if n > spare}
        growing = F.col("_region").isin(list(levels))
        done = placed.filter(~growing) if levels else placed
        done = done.select(*rows.columns, F.col("_top").alias("prediction"))
        if not levels:
            return done
        columns = [c for c in rows.columns if c != "features"]
        flat = placed.filter(growing).select(*columns, "_region", vector_to_array("features").alias("_x"))
        schema = flat.drop("_region").withColumn("prediction", F.lit(0.0)).schema

        def judged(own: pa.Table, nodes: pa.Table) -> pa.Table:
            if not own.num_rows:
                return own.drop_columns(["_region"]).append_column("prediction", pa.array([], pa.float64()))
            found = walk(_matrix(own["_x"]), _branch(nodes), levels[own["_region"][0].as_py()])
            return own.drop_columns(["_region"]).append_column("prediction", pa.array(found, pa.float64()))

        nodes = self.nodes.filter(F.col("region").isin(list(levels)))
        found = flat.groupBy("_region").cogroup(nodes.groupBy("region")).applyInArrow(judged, schema)
        features = array_to_vector("_x").alias("features", metadata=rows.schema["features"].metadata)
        return done.unionByName(found.select(*columns, features, "prediction"))


# --- trees of rows that share bins -----------------------------------------------------------

# Values (cells times features) from which one task grows a whole tree.
CELL_VALUES = 1 << 24
# Cells are used where so many rows share one on average.
ROWS_PER_CELL = 4
# Cells that a task judges.
JUDGED_CELLS = 1 << 19


class Cells(NamedTuple):
    """Training rows counted by the bins of all their features and the class, (key, n), and
    how many cells there are. Growing asks for bins only, so equal ones are one row."""

    rules: Rules
    counts: DataFrame
    total: int

    @property
    def sizes(self) -> list[int]:
        return bin_counts(self.rules)

    def count(self, rows: DataFrame) -> DataFrame:
        """Other rows counted by the same cells."""
        return _counted(rows, self.rules)

    def matrix(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A value in each bin, its upper bound, and the classes of cells."""
        keys, labels = np.divmod(keys, self.rules.classes)
        sizes = self.sizes
        x = np.empty((len(keys), len(sizes)))
        for f in reversed(range(len(sizes))):
            keys, bins = np.divmod(keys, sizes[f])
            x[:, f] = bins if f in self.rules.arity else np.append(self.rules.thresholds[f], np.inf)[bins]
        return x, labels


def bin_counts(rules: Rules) -> list[int]:
    features = len(rules.arity) + len(rules.thresholds)
    return [rules.arity[f] if f in rules.arity else len(rules.thresholds[f]) + 1 for f in range(features)]


def _counted(rows: DataFrame, rules: Rules) -> DataFrame:
    sizes = bin_counts(rules)
    ship(rows.sparkSession)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(pa.chunked_array([batch.column("_x")]))
            key = np.zeros(len(x), np.int64)
            for f, size in enumerate(sizes):
                key = key * size + (x[:, f].astype(np.int64) if f in rules.arity else np.searchsorted(rules.thresholds[f], x[:, f]))
            key = key * rules.classes + batch.column("label").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(key)], names=["key"])

    flat = rows.select(vector_to_array("features").alias("_x"), F.col("label").cast("int").alias("label"))
    return flat.mapInArrow(keys, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def count_cells(rows: DataFrame, bins: int, seed: int) -> Cells | None:
    """The cells of training rows; none where rows share too few of them, where one task could
    not hold them, or where the solver has to judge the input."""
    seen = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max("label").alias("most"), F.max(F.size(vector_to_array("features"))).alias("width"),
        F.bool_and((F.col("label") >= 0) & (F.col("label") == F.floor("label"))).alias("whole"),
    ).first()
    arity = category_sizes(rows)
    if not seen.whole or rows.schema["label"].metadata.get("ml_attr") or any(n > bins for n in arity.values()):
        return None
    # A cell's number has to fit 63 bits.
    width = max(seen.width, 1)
    if width > 16 or (min(bins, seen.n) + 1) ** (width - len(arity)) * np.prod([float(n) for n in arity.values()]) * (seen.most + 1) >= 2.0**62:
        return None
    # Two classes at least, as the solver has it.
    found = rules(rows, seen.n, width, max(int(seen.most) + 1, 2), "", bins, seed)
    if len(found.thresholds) + len(found.arity) != width:
        return None
    counts, told = cut_observed(_counted(rows, found), n=F.count(F.lit(1)))
    if told["n"] * width > CELL_VALUES or told["n"] * ROWS_PER_CELL > seen.n:
        return None
    return Cells(found, counts, told["n"])


class CellTree(DeepTree):
    """A whole tree grown from cells in one task, as one table of nodes."""

    def __init__(self, cells: Cells, nodes: DataFrame, depth: int, whole: int) -> None:
        super().__init__(Top(None, 0, [whole], {}), nodes, depth, whole)
        self.cells = cells

    def at(self, depth: int) -> CellTree:
        return CellTree(self.cells, self.nodes, depth, self.whole)

    def _everywhere(self, groups: int) -> DataFrame:
        """The nodes once for each of the groups that rows are dealt into."""
        return self.nodes.withColumn("_region", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).groupBy("_region")

    def right_shares(self, parts: Sequence[DataFrame], depths: Sequence[int]) -> dict[int, list[float]]:
        """Judged by cells; the first of the parts is the training rows."""
        counts = [self.cells.counts, *[self.cells.count(part) for part in parts[1:]]]
        every = reduce(DataFrame.unionByName, [c.withColumn("part", F.lit(i)) for i, c in enumerate(counts)])
        groups = max(1, self.cells.total // JUDGED_CELLS)
        dealt = every.withColumn("_region", F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int"))
        cells, depths = self.cells._replace(counts=None), list(depths)

        def judged(own: pa.Table, nodes: pa.Table) -> pa.Table:
            x, labels = cells.matrix(own["key"].to_numpy())
            part, n = own["part"].to_numpy(), own["n"].to_numpy()
            branch, rows = _branch(nodes), []
            for depth in depths:
                right = walk(x, branch, depth) == labels
                for i in np.unique(part):
                    here = part == i
                    rows.append((int(i), depth, int(n[here].sum()), int(n[here & right].sum())))
            return pa.table(dict(zip(("part", "depth", "n", "right"), map(list, zip(*rows))))) if rows else pa.table(
                {c: pa.array([], pa.int64()) for c in ("part", "depth", "n", "right")}
            )

        found = dealt.groupBy("_region").cogroup(self._everywhere(groups))
        found = found.applyInArrow(judged, "part long, depth long, n long, right long")
        sums = found.groupBy("part", "depth").agg(F.sum("n").alias("n"), F.sum("right").alias("right")).collect()
        told = {(r.depth, r.part): r.right / r.n for r in sums}
        return {depth: [told.get((depth, i), float("nan")) for i in range(len(parts))] for depth in depths}

    def transform(self, rows: DataFrame) -> DataFrame:
        groups = rows.sparkSession.sparkContext.defaultParallelism
        columns, depth = [c for c in rows.columns if c != "features"], self.depth
        flat = rows.select(*columns, vector_to_array("features").alias("_x"))
        schema = flat.withColumn("prediction", F.lit(0.0)).schema
        flat = flat.withColumn("_region", F.pmod(F.xxhash64("_x"), F.lit(groups)).cast("int"))

        def judged(own: pa.Table, nodes: pa.Table) -> pa.Table:
            found = walk(_matrix(own["_x"]), _branch(nodes), depth) if own.num_rows else np.empty(0)
            return own.drop_columns(["_region"]).append_column("prediction", pa.array(found, pa.float64()))

        found = flat.groupBy("_region").cogroup(self._everywhere(groups)).applyInArrow(judged, schema)
        features = array_to_vector("_x").alias("features", metadata=rows.schema["features"].metadata)
        return found.select(*columns, features, "prediction")


def _branch(nodes: pa.Table) -> Nodes:
    nodes = nodes.sort_by("node")
    return Nodes(*(nodes[c].to_pylist() if c == "categories" else nodes[c].to_numpy() for c in Nodes._fields))


def _node_table(region: int, nodes: Nodes) -> pa.Table:
    n = len(nodes.feature)
    return pa.table(
        {
            "region": pa.array(np.full(n, region)), "node": pa.array(np.arange(n, dtype=np.int32)), "feature": pa.array(nodes.feature),
            "threshold": pa.array(nodes.threshold), "categories": pa.array(nodes.categories, pa.binary()),
            "child": pa.array(nodes.child), "prediction": pa.array(nodes.prediction),
        }
    )


def grow_from_cells(cells: Cells, impurity: str, depth: int) -> CellTree:
    own = cells._replace(counts=None, rules=cells.rules._replace(impurity=impurity))
    ship(cells.counts.sparkSession)

    def whole(table: pa.Table) -> pa.Table:
        x, labels = own.matrix(table["key"].to_numpy())
        return _node_table(0, grow(x, labels, own.rules, depth, table["n"].to_numpy()))

    nodes = cut(cells.counts.groupBy(F.lit(0).alias("_all")).applyInArrow(whole, NODES))
    return CellTree(cells, nodes, depth, depth)


def grow_tree(
    rows: DataFrame, fit: Callable[[DataFrame, int], Model], impurity: str, depth: int, bins: int, step: int, seed: int,
    known: dict[int, Cells | None] | None = None,
) -> DeepTree:
    """A tree of `depth` levels over (features, label); `fit` makes tops of at most `step`.

    Where many rows share the bins of all features, the tree is grown from their counts.
    `known` holds the cells per number of bins for further trees of the same rows.
    """
    known = {} if known is None else known
    if bins not in known:
        known[bins] = count_cells(rows.select("features", "label"), bins, seed)
    if known[bins] is not None:
        return grow_from_cells(known[bins], impurity, depth)
    ship(rows.sparkSession)
    top = grow_top(rows.select("features", "label"), fit, depth, step)
    levels = top.levels()
    if not levels:
        return DeepTree(top, None, depth, depth)
    n_rows = rows.count()
    rule = rules(rows, n_rows, top.model.numFeatures, top.model.numClasses, impurity, bins, seed)
    placed = top.placed(rows.select("features", "label")).filter(F.col("_region").isin(list(levels)))
    flat = placed.select("_region", vector_to_array("features").alias("_x"), F.col("label").cast("int").alias("label"))

    def branch(own: pa.Table) -> pa.Table:
        region = own["_region"][0].as_py()
        return _node_table(region, grow(_matrix(own["_x"]), own["label"].to_numpy().astype(np.int64), rule, levels[region]))

    return DeepTree(top, cut(flat.groupBy("_region").applyInArrow(branch, NODES)), depth, depth)
