"""Hot keys: the split ways must give the same rows as the plain ones."""

from __future__ import annotations

import itertools
import random

from pyspark.sql import functions as F

from datamill.operators import pairs
from datamill.operators.pairs import pair_counts, record_pairs
from datamill.operators.ranking import number_keys, running_total, top_per_group
from datamill.operators.recommend import user_auc
from datamill.operators.skew import hot_keys, lookup


def skewed(spark, n=6000):
    """A third of the rows on key 7, the others spread."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 2000).cast("bigint")
    return spark.range(n).select(F.col("id").alias("row"), key.alias("key"))


def test_hot_keys_finds_the_heavy_key_only(spark):
    assert hot_keys(skewed(spark), "key", small_table=0) == [7]
    assert hot_keys(skewed(spark), "key") == []


def test_lookup_gives_the_same_rows_with_a_hot_key(spark):
    rows = skewed(spark)
    table = spark.range(500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    for how in ("left", "inner"):
        plain = {tuple(r) for r in lookup(rows, table, "key", how).select("row", "key", "twice").collect()}
        split = lookup(rows, table, "key", how, spread=["row"], small_table=0).select("row", "key", "twice")
        assert split.count() == len(plain) and {tuple(r) for r in split.collect()} == plain


def test_running_total_in_blocks(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"),
        F.floor(F.col("id") / 50).alias("block"),
    )
    whole = {(r.g, r.o): r.t for r in running_total(rows, ["g"], ["o"], "v", "t").collect()}
    parts = {(r.g, r.o): r.t for r in running_total(rows, ["g"], ["o"], "v", "t", "block").collect()}
    assert whole == parts


def test_number_keys_is_a_numbering(spark):
    keys = spark.range(300).union(spark.range(100))
    numbers = number_keys(keys, "id", "no", blocks=16).collect()
    assert sorted(r.no for r in numbers) == list(range(300))
    assert sorted(r.id for r in numbers) == list(range(300))


def test_top_per_group_limits_before_the_shuffle(spark):
    top = top_per_group(skewed(spark), ["key"], [F.desc("row")], 2, "place")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert top.filter("key = 7").count() == 2


def expected_pairs(records):
    out = set()
    for record, items in records.items():
        for a, b in itertools.combinations(sorted(items), 2):
            out.add((record, a, b))
    return out


def test_record_pairs_with_cells_for_big_records(spark):
    draw = random.Random(3)
    records = {r: [f"t{draw.randrange(60)}" for _ in range(4)] for r in range(30)}
    records[99] = [f"t{n}" for n in range(60)] + ["t5", "t5"]
    rows = [(r, t) for r, items in records.items() for t in items]
    df = spark.createDataFrame(rows, "record bigint, topic string")
    want = expected_pairs(records)
    for cell_items in (1024, 8):
        got = [tuple(r) for r in record_pairs(df, "record", "topic", cell_items).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    counts = {(r.first, r.second): r.n for r in pair_counts(record_pairs(df, "record", "topic", 8)).collect()}
    assert counts[("t5", "t5")] == sum(("t5", "t5") == (a, b) for _, a, b in want)


def test_user_auc_against_all_pairs(spark):
    draw = random.Random(5)
    pos = [(draw.choice([1, 1, 1, 2, 3]), draw.choice([-2.5, 0.0, 0.25, 3.0, 1e9])) for _ in range(200)]
    neg = [(draw.choice([1, 1, 1, 2, 4]), draw.choice([-2.5, 0.0, 0.25, 3.0, 1e9])) for _ in range(200)]
    want = {}
    for user in {u for u, _ in pos} & {u for u, _ in neg}:
        pairs = [(p, n) for u, p in pos if u == user for v, n in neg if v == user]
        want[user] = sum(p > n for p, n in pairs) / len(pairs)
    schema = "user bigint, score double"
    a, b = spark.createDataFrame(pos, schema), spark.createDataFrame(neg, schema)
    for small_table in (10**6, 0):
        got = {r.user: r.auc for r in user_auc(a, b, small_table=small_table).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[u] - want[u]) < 1e-12 for u in want)


def test_pairs_are_spread_by_their_number(spark, monkeypatch):
    rows = [(r, i) for r in range(60) for i in range(10)]
    table = spark.createDataFrame(rows, "record bigint, item bigint").coalesce(1)
    monkeypatch.setattr(pairs, "PAIRS_PER_TASK", 100)
    found = pairs.record_pairs(table, "record", "item")
    # 60 records of at most 55 pairs; the rows alone would fit into one task.
    assert found.filter("first < second").groupBy(F.spark_partition_id()).count().count() > 8
    assert found.count() == 60 * 45
    cells = pairs.record_pairs(table, "record", "item", cell_items=4)
    assert cells.exceptAll(found).isEmpty() and cells.count() == 60 * 45
    assert pairs.pair_parts(0.0, 3) == 3 and pairs.pair_parts(1e18, 3) == pairs.MOST_PARTS
