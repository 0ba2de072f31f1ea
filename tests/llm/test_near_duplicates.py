"""Components of edited texts against all pairs compared plainly."""

import random

import pytest
from pyspark.sql import functions as F

from datamill.llm import jaccard
from datamill.llm.jaccard import near_duplicates


def _edited(rng, words, share):
    return [f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


def _texts(seed):
    """Families of edited texts around the threshold, some with a passage that all families share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for family, length in enumerate((20, 90, 300, 700, 1500)):
        base = [f"f{family}w{rng.randrange(length)}" for _ in range(length)]
        for share in (0, 0, 0.01, 0.015, 0.02, 0.03, 0.05, 0.1):
            # Edits of edits make chains, whose ends need not be linked.
            words = _edited(rng, base, share)
            texts.append(words)
            texts.append(_edited(rng, words, share))
            texts.append(words + passage)
    rng.shuffle(texts)
    return [" ".join(words) for words in texts]


def _plain(texts, k, percent):
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                high, low = sorted((find(i), find(j)), reverse=True)
                root[high] = low
    return {i: (len(sets[i]), find(i)) for i in range(len(texts))}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_of_edited_texts(spark, k, percent):
    texts = _texts(k)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = near_duplicates(docs, k, percent).collect()
    expected = _plain(texts, k, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    found = {component for _, component in expected.values()}
    assert 5 < len(found) < len(texts) - 20


def test_chance_meetings_are_out_of_reach(spark):
    # Two sets of 10,000 that share the last of few known shingles, and two that share nearly all.
    rows = [("far", 10_000, 40, 8_000, 10_000, 50, 8_100), ("near", 10_000, 40, 9_000, 9_900, 41, 8_950)]
    df = spark.createDataFrame(rows, "kind string, n_a long, nth_a long, later_a long, n_b long, nth_b long, later_b long")
    assert [r.kind for r in df.filter(jaccard._within_reach(80)).collect()] == ["near"]


@pytest.mark.parametrize("percent", [80, 90])
def test_members_behind_a_prefix(spark, percent):
    found = spark.range(1, 3000).select("id", jaccard._beyond(F.col("id"), percent).alias("n")).collect()
    for r in found:
        keep = r.id - -(-percent * r.id // 100) + jaccard._extra(r.id)
        assert r.n == r.id - min(keep, r.id)
