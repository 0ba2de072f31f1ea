from __future__ import annotations

import math

import numpy as np

from pyspark.sql import functions as F

from datamill.functions import text as words
from datamill.operators import lowrank
from datamill.operators import terms as ops
from datamill.plans import concepts

TEXTS = [
    (1, "The Cat sat; the cat, abc123 won't run 42 cats!"),
    (2, "cat dog dog bird"),
    (3, "bird dog tree Tree"),
    (4, "only"),
    (5, "tree house garden garden"),
]


def docs(spark):
    return spark.createDataFrame(TEXTS, "id bigint, text string")


def test_kept_terms(spark):
    rows = {r.doc: r.terms for r in ops.doc_terms(docs(spark), "id", "text").collect()}
    assert rows[1] == ["cat", "sat", "cat", "run", "cats"]
    assert 4 not in rows


def test_texts_are_tokenised_once(spark):
    plan = ops.term_frequency(ops.doc_terms(docs(spark), "id", "text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_extract_all(") == 1


def test_weights_by_hand(spark):
    terms = ops.doc_terms(docs(spark), "id", "text")
    tf = ops.term_frequency(terms)
    df = {r.term: r.df for r in ops.doc_frequency(tf).collect()}
    assert df["dog"] == 2 and df["tree"] == 2
    vocab = ops.vocabulary(ops.doc_frequency(tf), 3)
    assert [r.term for r in vocab.collect()] == ["bird", "cat", "dog"]
    idf = ops.inverse_doc_frequency(ops.term_ids(vocab), terms.count())
    weights = {(r.doc, r.term): r.weight for r in ops.tf_idf(tf, idf).collect()}
    assert math.isclose(weights[(2, "dog")], math.log(4 / 2) * 2 / 4)
    assert (5, "garden") not in weights and all(w >= 0 for w in weights.values())


def test_concepts_match_a_plain_decomposition(spark):
    terms = ops.doc_terms(docs(spark), "id", "text")
    found = ops.latent_concepts(terms, num_terms=6, k=2)
    vocab = ops.term_ids(ops.vocabulary(ops.doc_frequency(ops.term_frequency(terms)), 6))
    idf = ops.inverse_doc_frequency(vocab, terms.count())
    names = [r.term for r in idf.orderBy("term_id").collect()]
    ids = [r.doc for r in terms.select("doc").orderBy("doc").collect()]
    matrix = np.zeros((len(ids), len(names)))
    for r in ops.tf_idf(ops.term_frequency(terms), idf).collect():
        matrix[ids.index(r.doc), names.index(r.term)] = r.weight
    u, s, vt = np.linalg.svd(matrix, full_matrices=False)
    values = [r.singular_value for r in found.singular_values.orderBy("concept").collect()]
    assert np.allclose(values, s[:2])
    weights = {(r.concept, r.term): r.weight for r in found.terms.collect()}
    got = np.array([[weights[(c, t)] for t in names] for c in range(2)])
    assert np.allclose(np.abs(got), np.abs(vt[:2]))
    assert all(row[np.abs(row).argmax()] > 0 for row in got)
    doc = {(r.concept, r.doc): r.weight for r in found.docs.collect()}
    got_u = np.array([[doc.get((c, d), 0.0) for d in ids] for c in range(2)])
    assert np.allclose(np.abs(got_u), np.abs(u[:, :2].T))
    assert ops.top_terms(found, 2).count() == 4 and ops.top_docs(found, 1).count() == 2


def test_articles_and_tags(spark):
    pages = spark.createDataFrame(
        [("A", "x", False), ("B (disambiguation)", "x", False), ("C", "", False), ("D", "x", True), (None, "x", False)],
        "title string, content string, redirect boolean",
    )
    assert [r.title for r in ops.keep_articles(pages, "title", "content", is_redirect="redirect").collect()] == ["A"]
    html = spark.createDataFrame([('<html class="x" lang="de"><p>one\n</p><p id="2">two <b>x</b></p><pre>no</pre>',)], "h string")
    row = html.select(
        words.tag_fragments(F.col("h"), "p").alias("f"), words.tag_attribute(F.col("h"), "html", "lang").alias("l"),
        words.strip_tags(words.between_tags(F.col("h"), "p")).alias("t"),
    ).first()
    assert row.f == ["<p>one\n</p>", '<p id="2">two <b>x</b></p>'] and row.l == "de" and row.t == "one"


def test_concepts_without_arrow(spark):
    rows = spark.createDataFrame([(i, ["sun", "moon", "star", "rain"][: 2 + i % 3]) for i in range(12)], "doc bigint, terms array<string>")
    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        found = ops.latent_concepts(rows, 10, 2)
        assert found.docs.select("doc").distinct().count() == 12
    finally:
        spark.conf.set(key, before)


def entries_of(spark, matrix):
    at = [(int(r), int(c), float(matrix[r, c])) for r, c in zip(*np.nonzero(matrix))]
    return lowrank.whole_rows(spark.createDataFrame(at, "row bigint, column bigint, value double"), len(at))


def test_product_with_the_gram_matrix(spark):
    rng = np.random.default_rng(3)
    matrix = rng.random((300, 1100)) * (rng.random((300, 1100)) < 0.05)
    block = rng.standard_normal((1100, 7))
    assert np.allclose(lowrank.times_gram(entries_of(spark, matrix), block), matrix.T @ (matrix @ block))


def test_decomposition_of_a_wide_matrix(spark):
    """Blocks far smaller than the matrix: values, and how well each pair solves AᵀAv = s²v."""
    rng = np.random.default_rng(5)
    matrix = rng.standard_normal((150, 40)) * 0.8 ** np.arange(40) @ rng.standard_normal((40, 400))
    matrix += 0.01 * rng.standard_normal(matrix.shape)
    found = lowrank.decompose(entries_of(spark, matrix), 400, k=10, spare=5)
    values = np.linalg.svd(matrix, compute_uv=False)[:10]
    assert np.allclose(found.values, values, rtol=1e-2) and np.allclose(found.values[:4], values[:4], rtol=1e-4)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(10), atol=1e-9)
    off = matrix.T @ (matrix @ found.vectors) - found.vectors * found.values**2
    assert (np.linalg.norm(off, axis=0)[:4] < 0.02 * found.values[:4] ** 2).all()
    placed = {r.row: r.weights for r in lowrank.place_rows(entries_of(spark, matrix), found.vectors / found.values).collect()}
    u = np.array([placed[i] for i in sorted(placed)])
    assert np.allclose(u * found.values, matrix[sorted(placed)] @ found.vectors)
    assert np.allclose(np.diag(u.T @ u), 1)


def test_decomposition_of_a_small_rank(spark):
    matrix = np.outer([1.0, 2.0, 0.0, 3.0], np.arange(1, 201.0))
    found = lowrank.decompose(entries_of(spark, matrix), 200, k=5, spare=3)
    assert len(found.values) == 1 and np.allclose(found.values, np.linalg.svd(matrix, compute_uv=False)[:1])


def test_rows_are_cut_at_row_ends(spark, monkeypatch):
    monkeypatch.setattr(lowrank, "AT_ONCE", 5)
    rng = np.random.default_rng(8)
    matrix = rng.random((40, 30)) * (rng.random((40, 30)) < 0.4)
    block = rng.standard_normal((30, 3))
    assert np.allclose(lowrank.times_gram(entries_of(spark, matrix), block), matrix.T @ (matrix @ block))


def test_concepts_of_the_documents(spark):
    """The leading values of the whole table beside a dense decomposition."""
    kept = concepts.kept(spark, "/root/testdata/sf0.001")
    entries, idf, total = ops.weight_entries(kept, 3000)
    rows = entries.toPandas()
    docs = {d: i for i, d in enumerate(sorted(set(rows["row"])))}
    matrix = np.zeros((len(docs), idf.count()))
    matrix[rows["row"].map(docs), rows["column"]] = rows["value"]
    found = lowrank.decompose(lowrank.whole_rows(entries, total), idf.count(), k=20, spare=10)
    values = np.linalg.svd(matrix, compute_uv=False)[:20]
    assert np.allclose(found.values[:10], values[:10], rtol=1e-3) and np.allclose(found.values, values, rtol=2e-2)


def test_empty_collection_has_no_concepts(spark):
    none = spark.createDataFrame([], "doc bigint, terms array<string>")
    found = ops.latent_concepts(none, 10, 2)
    assert found.singular_values.count() == found.terms.count() == found.docs.count() == 0


def test_best_rows_are_a_few_of_each_place(spark):
    rows = spark.range(0, 4000, 1, 2).select(
        F.col("id").alias("row"), F.array((F.col("id") % 97).cast("double"), -F.col("id").cast("double")).alias("weights")
    )
    found = lowrank.best_rows(rows, 5)
    assert found.count() < 1000
    for place, key in ((0, lambda i: (-(i % 97), i)), (1, lambda i: (i, i))):
        best = found.filter(F.col("place") == place).orderBy(F.desc("weight"), "row").limit(5).collect()
        assert [r.row for r in best] == sorted(range(4000), key=key)[:5]
    # Fewer rows than asked for are all given.
    assert lowrank.best_rows(rows.limit(3), 5).count() == 6


def test_frequencies_stay_where_they_are_for_a_vocabulary(spark, monkeypatch):
    tf = ops.cut(ops.term_frequency(ops.doc_terms(docs(spark), "id", "text")))
    idf = ops.inverse_doc_frequency(ops.vocabulary(ops.doc_frequency(tf), 6), 4)
    weights = ops.tf_idf(tf, idf)
    assert "Exchange hashpartitioning" not in weights._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ops, "BROADCAST_TERMS", 0)
    plain = ops.tf_idf(tf, idf)
    assert plain.columns == weights.columns and plain.exceptAll(weights).isEmpty() and plain.count() == weights.count() > 0
