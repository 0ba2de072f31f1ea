"""Line maps and ranked search on odd rows, beside plain versions."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from datamill.llm import treap
from datamill.llm.lines import drop_common_lines, line_bitmaps
from datamill.llm.treap import Treap, rank_documents, terms_of

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
HEAD = "This line stands in many of the documents"
LONG = "\n".join(HEAD if i % 3 == 0 else f"own line number {i} of a long text" for i in range(5000))
ROWS = [
    (1, f"{HEAD}\nfirst"), (2, f"  {HEAD.upper()}\r\nsecond\n{HEAD}"), (3, f"{HEAD}\n{HEAD}"), (3, f"third again\n{HEAD}"), (4, None), (5, ""),
    (6, "\n\n"), (None, f"x\n{HEAD}"), (None, f"y\n{HEAD}"), (7, LONG), (7, LONG), (8, "short\nshort"), (9, "É" * 25), (10, "é" * 25), (11, "É" * 25), (12, "é" * 25 + "\n" + "É" * 25),
    (13, "é" * 25), (14, f"{HEAD} "),
]


def plain_lines(rows):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            held[key(line)].add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        own = -1 if doc is None else doc
        gone = lambda line: len(k := key(line)) >= 20 and len(held[k]) >= 3 and own != max(held[k])
        kept = [line for line in lines if not gone(line)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [1 / 256, 2.0])
def test_lines_of_odd_rows(spark, monkeypatch, share):
    """With and without hashes that count as hot."""
    monkeypatch.setattr("datamill.operators.skew.HOT_SHARE", share)
    docs = spark.createDataFrame([(d, t, 1, "p", 0) for d, t in ROWS], "doc_id bigint, text string, pos int, print string, h1 int")
    found = drop_common_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, found), key=repr) == plain_lines(ROWS)
    assert drop_common_lines(docs.limit(0)).count() == 0


def test_line_maps_hold_only_words_with_a_drop(spark):
    docs = spark.createDataFrame([*ROWS, (99, HEAD)], "doc_id bigint, text string")
    maps = {r.doc_id: r.dropped for r in line_bitmaps(docs).filter("doc_id in (1, 7)").collect()}
    assert [tuple(w) for w in maps[1]] == [(0, 1)]
    assert len(maps[7]) == -(-5000 // 64)
    assert sum(bin(w.bits & (2**64 - 1)).count("1") for w in maps[7]) == -(-5000 // 3)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 40), st.integers(1, 70), st.integers(1, 12))
def test_treap_finds_the_best_columns(seed, n_rows, n_columns, k):
    rng = np.random.default_rng(seed)
    grid = rng.integers(0, 4, (n_rows, n_columns)) * (rng.random((n_rows, n_columns)) < 0.4)
    rows, columns = np.nonzero(grid)
    # Some rows of the item have no cell, and may lie beyond the grid.
    own = rng.permutation(2 * n_rows)[: rng.integers(1, n_rows + 1)].astype(np.int64)
    weights = rng.integers(0, 3, len(own))
    scores = weights @ np.vstack([grid, np.zeros_like(grid)])[own]
    ids = rng.permutation(n_columns)
    want = [c for c in np.lexsort((ids, -scores)) if scores[c] > 0][:k]
    if len(rows):
        at, found = Treap(rows, columns, grid[rows, columns]).best(own, weights, k, ids)
        order = np.lexsort((ids[at], -found))
        assert at[order].tolist() == want and found[order].tolist() == scores[want].tolist()


DOCS = [
    (1, "Red fish blue fish"), (2, "red FISH"), (2, "red FISH"), (3, None), (4, " -,. "), (5, "fish " * 3000 + "red"), (None, "red fish"), (None, "blue"),
    (6, "Éclair éclair red"), (7, "x y red"), (8, "red fish"),
]
ITEMS = [(1, "red fish"), (1, "blue blue red"), (2, None), (3, "?"), (None, "éclair"), (4, "x y"), (5, "nowhere"), (6, "red " * 500)]


def plain_ranks(docs, items, k):
    texts = [(d, Counter(w), len(w)) for d, t in docs if (w := terms_of((t or "").encode()))]
    n_docs, n_terms = len(texts), sum(n for *_, n in texts)
    df = Counter(t for _, own, _ in texts for t in own)
    out = []
    for item, text in items:
        rows = []
        for d, own, n in texts:
            m = 75 + 25 * n * n_docs // n_terms
            score = 0
            for t, times in Counter(terms_of((text or "").encode())).items():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += times * w * (10**9 * own[t] // (1000 * own[t] + 12 * m))
            if score > 0:
                rows.append((-score, d is None, d))
        out += [(item, place + 1, d, -s) for place, (s, _, d) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("cells, terms", [(1 << 20, 1 << 18), (3, 2)])
def test_ranks_of_odd_rows(spark, monkeypatch, cells, terms):
    """As one treap and block, and as many."""
    monkeypatch.setattr(treap, "TREAP_CELLS", cells)
    monkeypatch.setattr(treap, "BLOCK_TERMS", terms)
    docs = spark.createDataFrame([(d, t, 1, "s") for d, t in DOCS], "doc_id bigint, text string, n int, terms string")
    items = spark.createDataFrame([(i, t, 9) for i, t in ITEMS], "item_id bigint, text string, item_no int")
    for k in (3, 20):
        assert sorted(map(tuple, rank_documents(docs, items, k).collect()), key=repr) == plain_ranks(DOCS, ITEMS, k)
    if cells > 3:
        assert rank_documents(docs.limit(0), items).count() == rank_documents(docs, items.limit(0)).count() == 0
