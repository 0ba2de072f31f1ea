"""Every operator and stage on nulls, empty and long texts, repeats, clashing columns, no rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from datamill.llm.alignment import align_tokenizers
from datamill.llm.jaccard import near_duplicates
from datamill.llm.lines import drop_common_lines
from datamill.llm.mixing import copies, mix_sources
from datamill.llm.neighbours import nearest_neighbours
from datamill.llm.packing import pack_documents
from datamill.llm.pii import digest, personal_data
from datamill.llm.rules import ledger
from datamill.llm.sharding import place
from datamill.llm.substrings import repeated_passages
from datamill.llm.toxicity import toxicity_scores
from datamill.llm.warc import archive_pages

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _id int, size string, print string, target int"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))
PROSE = " ".join(f"word{i}" for i in range(40))


@pytest.fixture(scope="module")
def messy(spark):
    rows = [
        (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, PROSE, None, "b"), (3, None, "en", None), (4, "", "en", "a"),
        (None, PROSE + " more", "en", "b"), (None, "other " * 30, "en", None), (5, LONG, "en", "a"), (6, LONG + " x", "de", "a"),
        (7, " \t\n", "en", "c"), (8, "one two", "en", "c"), (9, "One TWO", "en", "c"), (10, "mail me@x.org now", "en", "c"),
    ]
    return spark.createDataFrame([(*r, 0, 7, "s", "p", 1) for r in rows], DOCS)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


OPERATORS = {
    "toxicity": lambda spark, docs: toxicity_scores(docs, labels(spark)),
    "rules": lambda spark, docs: ledger(docs),
    "mixing": lambda spark, docs: mix_sources(docs),
    "pii": lambda spark, docs: digest(personal_data(docs)),
    "jaccard": lambda spark, docs: near_duplicates(docs, 3, 90),
    "substrings": lambda spark, docs: repeated_passages(docs),
    "lines": lambda spark, docs: drop_common_lines(docs),
    "alignment": lambda spark, docs: align_tokenizers(docs),
    "sharding": lambda spark, docs: place(docs, "doc_id", {"x": 1.0, "y": 2.0}, 101),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_per_document(spark, messy, name):
    assert OPERATORS[name](spark, messy).count() == messy.count()
    assert OPERATORS[name](spark, messy.limit(0)).count() == 0


def test_values_on_messy_rows(spark, messy):
    found = {r.doc_id: r for r in near_duplicates(messy, 3, 90).collect()}
    assert found[2].component_id == 1 and found[6].component_id == 5 and found[9].component_id == 8
    assert found[3].n_shingles == 0 and found[3].component_id == 3
    cut = {r.doc_id: r for r in repeated_passages(messy).collect()}
    assert cut[2].n_removed == 40 and cut[1].n_removed == 0 and cut[6].kept_text.split()[-1] == "x"
    mixed = mix_sources(messy)
    for r in mixed.groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 1
    rows = copies(messy, mixed)
    assert rows.columns == messy.columns and rows.filter("_id <> 7").count() == 0
    assert digest(personal_data(messy)).filter("doc_id = 10").first().spans == "email:5:13"


def test_rows_without_an_id_join_no_other_texts(spark):
    five, nine = PROSE, " ".join(f"term{i}" for i in range(40))
    high = " ".join(f"high{i}" for i in range(40))
    rows = [(5, five), (9, nine), (None, five + " more"), (None, nine + " more"), (None, "other " * 30), (None, None),
            (2**63 - 1, high), (2**63 - 2, high + " x"), (None, high + " more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_duplicates(docs, 3, 90).collect()
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == {
        5: 5, 9: 9, 2**63 - 1: 2**63 - 2, 2**63 - 2: 2**63 - 2,
    }
    assert sorted((r.component_id for r in found if r.doc_id is None), key=repr) == [5, 9, 2**63 - 2, None, None]


def test_clean_texts_that_share_an_id_all_stay(spark):
    texts = [" ".join(f"{c}{i}" for i in range(40)) for c in "abc"]
    rows = [(1, t) for t in texts] + [(1, texts[0] + " x"), (1, texts[1]), (2, texts[2] + " x"), (None, texts[2]), (None, "odd"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id for r in kept), key=repr) == [1, 1, 1, 3, None]
    assert {r.text.split()[0] for r in kept if r.doc_id == 1} == {"a0", "b0", "c0"}


def test_packing_messy_rows(spark, messy):
    packed = pack_documents(messy, capacity=100)
    assert packed.filter("doc_id = 5").agg({"size": "sum"}).first()[0] == 30_000
    assert packed.filter("doc_id = 3").count() == 1
    assert pack_documents(messy.limit(0)).count() == 0


def test_pages_come_back(spark):
    body = "<p>" + "é" * 100 + "</p>"
    rows = [(2, "http://a/ü\r\nX: y", body), (1, None, body), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", body)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, record_type string")
    found = {r.page_id: r for r in archive_pages(pages).collect()}
    assert (found[1].record_type, found[2].refers_to, found[None].refers_to) == ("response", 1, 1)
    assert found[3].payload_bytes == 0 and found[5].record_type == "response" and found[2].payload_bytes == 207
    assert archive_pages(pages.limit(0)).count() == 0


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [2.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (0, [1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = nearest_neighbours(vectors, vectors["vec_id"] % 100 == 0, k=10).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 1, 0.0), (0, 2, 8, 0.0), (0, 3, 7, 1.0)]
    assert nearest_neighbours(vectors.limit(0), vectors["vec_id"] % 100 == 0).count() == 0


def test_stages_on_messy_rows(spark, messy, tmp_path):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs = messy
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, messy.limit(0), str(tmp_path))
        assert empty.count() == 0, name
        after = stage(spark, docs, str(tmp_path))
        if name == "near duplicates":
            ids = sorted(r.doc_id for r in after.collect() if r.doc_id is not None)
            assert ids == [1, 3, 4, 5, 7, 8, 10]
        if name == "personal data":
            assert after.filter("doc_id = 10").first().text == "mail [EMAIL] now"
        if name != "packing":
            assert after.columns == messy.columns, name
        docs = corpus_pipeline.written(after)
    assert docs.count() > 0
