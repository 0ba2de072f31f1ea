"""Registered queries beside their SQL, or a plain version where SQL has none."""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from datamill.llm.queries import ORACLES, QUERIES
from tools.check import database

SF_DIR = "/root/testdata/sf0.001"


def plain(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(tuple, frame.where(frame.notna(), None).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    twin = database(SF_DIR).execute(ORACLES[name]).df()
    frame = QUERIES[name](spark, SF_DIR).toPandas()
    assert sorted(frame.columns) == sorted(twin.columns)
    assert plain(frame) == plain(twin)


def test_neighbours_reach_the_recall(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    ids, points = rows.vec_id.to_numpy(), np.stack(rows.embedding).astype(float)
    found = QUERIES["op7_nearest_neighbours"](spark, SF_DIR).toPandas()
    hits = 0
    for query, own in found.groupby("query_id"):
        gap = np.sqrt(((points - points[ids == query][0]) ** 2).sum(axis=1))
        best = [int(ids[i]) for i in np.lexsort((ids, gap)) if ids[i] != query][:10]
        hits += len(set(best) & set(own.vec_id))
        near = dict(zip(ids.tolist(), gap.tolist()))
        assert all(abs(near[v] - s) < 1e-9 for v, s in zip(own.vec_id, own.score))
        assert list(own.sort_values("rank").score) == sorted(own.score)
    assert hits >= 0.9 * len(found) and len(found) == 10 * (ids % 100 == 0).sum()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, value: str) -> bool:
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_base(text: str | None) -> list[str]:
    found = [
        (m.start(), i, f"{kind}:{m.start()}:{m.end()}")
        for i, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return [name for _, _, name in sorted(found)]


def test_personal_data_holds_all_strict_spans(spark):
    from datamill.llm.pii import digest, personal_data

    odd = [
        "a@b.cc_d@e.f x@y 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0004",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
        "+1 (605) 555-9305 4078918989542222 +49 30 1234567 ++12 3",
        "é+1 (605) 555-9305 ü me@é.de you@x.y.z.",
        "1" * 20_000 + " " + "a" * 20_000 + "@" + ".b" * 5_000 + " 1.2" * 5_000,
        None,
        "",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1 - i, t) for i, t in enumerate(odd)], "doc_id bigint, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in digest(personal_data(docs)).collect():
        base = plain_base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), (r.doc_id, base, r.spans)
        assert set(base) <= set(filter(None, r.spans.split(",")))
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b.startswith(k) for b in base) for k in PATTERNS)


STRICT_ALONE = {
    "email": ["me@x.org"],
    "ip": ["10.0.0.1", "see 1.2.3.4"],
    "card": ["378 282 246 310 005", "378282246310005", "3-7-8-2-8-2-2-4-6-3-1-0-0-0-5", "4 111 111 111 111 111"],
    "phone": ["Call +442071234567, thanks", "+442071234567", "+1(605)555-9305", "a+4420.7123-4567x"],
}
LOOSE_ALONE = {
    "email": ["me [at] x [dot] org", "me(AT)x.org", "me@x"],
    "ip": ["10[.]0[.]0[.]1 ", "10(.)0(.)0(.)1", "10,0,0,1", "10.0.0.1"],
    "card": ["4111.1111.1111.1111", "4111_1111/1111-1", "4111111111111"],
    "phone": ["605)555)9305", "(605) 555-9305", "605/555/9305", "605.555.93", "+44 20 71"],
}


def test_each_format_is_found_in_a_text_of_its_own(spark):
    from datamill.llm.pii import base_spans, candidates

    for kind in PATTERNS:
        for values, find in ((STRICT_ALONE, base_spans), (LOOSE_ALONE, candidates)):
            texts = spark.createDataFrame([(v,) for v in values[kind]], "text string")
            missed = [r.text for r in texts.select("text", find(texts["text"], kind).alias("found")).collect() if not r.found]
            assert not missed, (kind, missed)
    for text in STRICT_ALONE["card"] + STRICT_ALONE["phone"]:
        assert plain_base(text), text


def test_every_kind_has_a_threshold_and_a_rare_one_its_spans(spark):
    from datamill.llm.pii import _choose, candidates, thresholds

    assert thresholds({}) == {0: 0.95, 1: 0.95, 2: 0.95, 3: 0.95}
    many = thresholds({(0, 19): (1000, 1000), (0, 15): (0, 500), (2, 19): (10, 1000), (2, 20): (500, 500)})
    assert many[0] == 0.8 and many[2] == 1.0

    # 4,000 phones, good and bad, and 8 addresses.
    phones = [f"call ({200 + i % 700}) {100 + i % 899}-{1000 + i}" if i % 2 else f"n {i % 90 + 10}-{10 + i % 89}/{i % 80 + 10}" for i in range(4000)]
    texts = phones + [f"write to user{i} [at] host{i} [dot] org today" for i in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("print", F.xxhash64("text"))
    loose = F.concat(candidates(F.col("text"), "email"), candidates(F.col("text"), "phone"))
    found = docs.select("doc_id", "print", F.explode(loose).alias("c")).select("doc_id", "print", "c.*")
    chosen = {(r.doc_id, r.kind) for r in _choose(found).collect()}
    assert {(4000 + i, 0) for i in range(8)} <= chosen
    assert not any(k == 3 and d % 2 == 0 for d, k in chosen)


def test_packing_keeps_capacity_and_conflicts(spark):
    rows = QUERIES["op9_best_fit_packing"](spark, SF_DIR).toPandas()
    bins = rows.groupby(["group", "bin"])
    assert bins["size"].sum().max() <= 2048
    assert rows.groupby(["group", "bin", "source"]).size().max() <= 2
    assert rows.groupby(["group", "bin", "cluster"]).size().max() == 1
    texts = {r.doc_id: len((r.text or "").encode().split()) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert rows.groupby("doc_id")["size"].sum().to_dict() == texts


def test_best_fit_takes_the_tightest_compatible_bin():
    from datamill.llm.packing import best_fit

    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(1, 60, 300))[::-1]
    sources, clusters = rng.integers(0, 4, 300), rng.integers(0, 150, 300)
    got = best_fit(sizes, sources, clusters, 100, 2)
    left, held, seen, want = [], [], [], []
    bit = {c: sorted(k for k in set(clusters) if (clusters == k).sum() > 1).index(c) % 64 for c in set(clusters) if (clusters == c).sum() > 1}
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [
            (left[b], b) for b in range(len(left))
            if left[b] >= size and held[b].count(source) < 2 and (cluster not in bit or bit[cluster] not in seen[b])
        ]
        if not fits:
            left.append(100), held.append([]), seen.append([])
            want.append(len(left) - 1)
        else:
            want.append(got[len(want)])
            assert left[want[-1]] == min(fits)[0]
        b = want[-1]
        assert got[len(want) - 1] == b
        left[b] -= size
        held[b].append(source)
        if cluster in bit:
            seen[b].append(bit[cluster])


def test_toxicity_learns(spark):
    from datamill.llm.toxicity import toxicity_scores

    bad, fine = ["scum", "idiot", "moron"], ["tree", "river", "cloud", "stone"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        rows.append((i, " ".join([fine[i % 4], fine[(i // 4) % 4], "word%d" % (i % 50)] + [bad[i % 3]] * toxic)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = toxicity_scores(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).toPandas()
    own = found[found.held_out]
    assert len(own) > 100 and ((own.predicted == 1) == (own.doc_id % 4 == 0)).all()


def test_a_term_of_one_example_is_enough(spark):
    from datamill.llm.toxicity import held_out, toxicity_scores

    rows = [(i, f"tree{'abc'[i % 3]} river cloud") for i in range(40)]
    labels = [(i, 1, 0) for i in range(40)]
    ids = spark.range(40, 80).select("id", held_out(F.col("id")).alias("h")).collect()
    train, test = [r.id for r in ids if not r.h][:2], [r.id for r in ids if r.h][:2]
    rows += [(train[0], "scum"), (train[1], "moron"), (test[0], "scum scum"), (test[1], "stone")]
    labels += [(i, 1, 1) for i in train]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in toxicity_scores(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()}
    assert found[test[0]].evidence == [train[0]] and abs(found[test[0]].cosines[0] - 1) < 1e-9
    assert found[test[1]].evidence == [] and found[0].evidence


def dense_neighbours(examples, idf, query, k):
    """Cosines of the k + 1 nearest distinct vectors, from dense rows."""
    distinct = {(t.tobytes(), n.tobytes()): (t, n) for _, _, t, n in examples}
    rows = np.zeros((len(distinct) + 1, len(idf)))
    for row, (t, n) in zip(rows, [*distinct.values(), query]):
        row[t] = (1 + np.log(n)) * idf[t]
        row /= np.linalg.norm(row)
    cosines = np.sort(rows[:-1] @ rows[-1])[::-1][: k + 1]
    return cosines[cosines > 0]


@pytest.mark.parametrize("words, size, k", [(30, (1, 8), 7), (3000, (1, 40), 15), (700, (60, 90), 50), (40, (1, 3), 5)])
def test_block_max_search_is_exact(words, size, k):
    from datamill.llm.toxicity import Index

    rng = np.random.default_rng(words)
    common = 1 / (1 + np.arange(words))
    sets = [np.sort(rng.choice(words, min(words, rng.integers(*size)), replace=False, p=common / common.sum())).astype(np.int32) for _ in range(1500)]
    examples = [(i, i % 2, t, rng.integers(1, 5, len(t)).astype(np.int32)) for i, t in enumerate(sets)]
    idf = rng.random(words) + 0.5
    index = Index(examples, idf, np.ones(words), {0: 1.0, 1: 1.0}, k)
    sent = pickle.loads(pickle.dumps(index))
    queries = [examples[i][2:] for i in range(0, 1500, 23)]
    for query, got, again in zip(queries, index.nearest(queries), sent.nearest(queries)):
        assert np.allclose(got[1], dense_neighbours(examples, idf, query, k), atol=1e-9)
        assert np.allclose(got[1], got[2]) and all(np.array_equal(x, y) for x, y in zip(got, again))
        alone = index.nearest([query])[0]  # a batch changes nothing
        assert all(np.array_equal(x, y) for x, y in zip(got, alone))


def test_the_driver_sends_words_and_examples_unopened():
    from datamill.llm.toxicity import Index, Vocabulary

    words = pa.array(["a", "b", "c"])
    mine = Vocabulary(words)
    assert not hasattr(mine, "numbers") and pickle.loads(pickle.dumps(mine)).numbers == {"a": 0, "b": 1, "c": 2}
    assert pickle.loads(pickle.dumps(Vocabulary(words[:0]))).numbers == {}
    examples = [(i, i % 2, np.array([i % 5], np.int32), np.ones(1, np.int32)) for i in range(20)]
    index = Index(examples, np.ones(5), np.ones(5), {0: 1.0, 1: 1.0}, 3)
    assert index.blocks is None and not hasattr(index, "exact")
    assert pickle.loads(pickle.dumps(index)).blocks is not None


def test_neighbours_do_not_hang_on_the_order_of_examples():
    from datamill.llm.toxicity import Index

    examples = [(i, i % 3 == 0, np.array([i % 5, 9], np.int32), np.ones(2, np.int32)) for i in range(60)]
    shuffled = [(999 - d, y, t, n) for d, y, t, n in reversed(examples)]
    query = [(np.array([9], np.int32), np.ones(1, np.int32))]
    found = [Index(e, np.ones(10), np.ones(10), {0: 1.0, 1: 1.0}, 3) for e in (examples, shuffled)]
    one, two = (index.nearest(query)[0] for index in found)
    assert np.array_equal(one[0], two[0]) and np.array_equal(found[0].toxic, found[1].toxic)


def test_an_own_label_has_no_vote():
    from datamill.llm.toxicity import Index, _voted

    terms, ones = np.arange(4, dtype=np.int32), np.ones(4, np.int32)
    others = [(10 + i, 0, np.array([i, 5], np.int32), np.ones(2, np.int32)) for i in range(4)]
    scores = []
    for own in (0, 1):
        examples = [(1, own, terms, ones), (2, 1, terms, ones), *others]
        index = Index(examples, np.ones(6), np.ones(6), {0: 1.0, 1: 1.0}, 3)
        index.prior = 0.5
        (mine, rows, _), (other, _, _) = _voted(index, [(1, terms, ones), (7, terms, ones)], {})
        scores.append((mine, other))
        assert index.weight[rows[0]] == 2
    assert scores[0][0] == scores[1][0] and scores[0][1] < scores[1][1]


def test_toxicity_query_against_brute_force(spark):
    """Every score, from dense cosines with all examples, for the examples the query takes."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if r.toxic is not None}
    texts = {r.doc_id: [w for w in re.findall(r"[^\W\d_]+", (r.text or "").lower())] for r in docs}
    out = {d for d in texts if zlib.crc32(str(d).encode()) % 4 == 2}
    train = sorted(d for d in labels if d in texts and d not in out)
    held = {d: set(w) for d, w in texts.items()}
    words = sorted(set().union(*(held[d] for d in train)))
    at = {w: i for i, w in enumerate(words)}
    df = np.bincount([at[w] for d in held for w in held[d] if w in at], minlength=len(words))
    idf = np.log((1 + len(docs)) / (1 + df)) + 1

    def row(d):
        own = np.bincount([at[w] for w in texts[d] if w in at], minlength=len(words))
        w = np.where(own > 0, 1 + np.log(np.maximum(own, 1)), 0) * idf
        return w / max(np.linalg.norm(w), 1e-300)

    rows = {d: row(d) for d in texts}
    kinds = {}
    for d in train:
        kinds.setdefault(np.round(rows[d], 12).tobytes(), []).append(d)
    found = {r.doc_id: r for r in QUERIES["op1_toxicity"](spark, SF_DIR).collect()}
    assert found.keys() == texts.keys()
    for d, r in found.items():
        assert r.held_out == (d in out) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
        # One neighbour per vector; one that only the document itself has is left out.
        cosines = [float(rows[d] @ rows[own[0]]) for own in kinds.values() if own != [d]]
        want = sorted((c for c in cosines if c > 1e-12), reverse=True)[:50]
        assert np.allclose(r.cosines, want, atol=1e-9), d
        for example, cosine in zip(r.evidence, r.cosines):
            assert abs(rows[d] @ rows[example] - cosine) < 1e-9


def test_lookup_table_is_even_and_stable():
    from datamill.llm.sharding import lookup_table

    shards = {f"s{i}": 1.0 + (i == 0) for i in range(9)}
    table = lookup_table(shards, 5003)
    counts = {s: table.count(s) for s in shards}
    assert abs(counts["s0"] - 1000.6) < 5 and all(abs(counts[f"s{i}"] - 500.3) < 5 for i in range(1, 9))
    less = lookup_table({s: w for s, w in shards.items() if s != "s4"}, 5003)
    moved = sum(a != b for a, b in zip(table, less) if a != "s4")
    assert moved < 0.1 * 5003


def test_sharding_follows_the_table(spark):
    from datamill.llm.queries import SHARDS
    from datamill.llm.sharding import SLOTS, lookup_table

    table = lookup_table(SHARDS)
    for r in QUERIES["op8_sharding"](spark, SF_DIR).collect():
        at = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:15], 16) % SLOTS
        assert (r.slot, r.shard) == (at, table[at])


def test_ablations_count_by_bits(spark):
    from datamill.llm.rules import RULE_NAMES, Policy, ablations

    rows = spark.createDataFrame([(b,) for b in (0, 0, 1, 2, 3, 4, 6)], "failed bigint")
    found = {r.rule: r for r in ablations(rows, (Policy("two", RULE_NAMES[:2]),)).collect()}
    assert [(found[r].documents, found[r].rejected, found[r].failing, found[r].sole) for r in RULE_NAMES[:2]] == [
        (7, 4, 2, 1), (7, 4, 3, 2),
    ]
