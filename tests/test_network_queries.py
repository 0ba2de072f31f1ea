"""The network queries over small tables of their own, beside their SQL."""

from __future__ import annotations

import duckdb
import pytest

from datamill.plans import catalog
from tools.check import differences

# Parts of orders: 1 and 2 share two orders, all other pairs one; 6 stands alone, 9 is named twice.
ORDERS = {1: [1, 2], 2: [1, 2, 3], 3: [3, 4], 4: [5, 7], 5: [6], 6: [8, 9, 9]}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    lines = [(order, part) for order, parts in ORDERS.items() for part in parts]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(o,) for o in ORDERS], "o_orderkey bigint").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.fixture(scope="module")
def connection(tables):
    connection = duckdb.connect()
    for name in ("lineitem", "orders"):
        connection.execute(f"create view {name} as select * from '{tables}/{name}.parquet/*.parquet'")
    return connection


def both(spark, tables, connection, name):
    """The rows of a query, equal to those of its SQL."""
    frame = catalog.QUERIES[name](spark, tables).toPandas()
    problem = differences(frame, connection.execute(catalog.ORACLES[name]).df())
    assert problem is None or problem.startswith("OK"), problem
    return frame


def test_component_sizes_follow_pairs_of_one_order(spark, tables, connection):
    sizes = both(spark, tables, connection, "component_sizes")
    assert sorted(sizes.n) == [1, 2, 2, 4]


def test_components_are_joined_by_pairs_of_one_order(spark, tables, connection):
    found = both(spark, tables, connection, "connected_components")
    names = {r.id: r.name for r in catalog.QUERIES["topic_hash_ids"](spark, tables).collect()}
    together = {}
    for row in found.itertuples():
        together.setdefault(row.component, set()).add(names[row.id])
    parts = [{f"part_{i}" for i in some} for some in ([1, 2, 3, 4], [5, 7], [6], [8, 9])]
    assert sorted(map(sorted, together.values())) == sorted(map(sorted, parts))
    assert all(component == min(i for i in found.id[found.component == component]) for component in together)


def test_degree_stats_count_pairs_of_one_order(spark, tables, connection):
    stats = both(spark, tables, connection, "degree_stats").iloc[0]
    # Degrees 2, 2, 3, 1 and 1, 1; part 9 has an edge and a loop, which counts twice, part 8 an edge.
    assert (stats.n, stats["max"], stats["min"]) == (8, 3.0, 1.0) and abs(stats["mean"] - 14 / 8) < 1e-6
