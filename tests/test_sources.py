"""Small files in the formats of the jobs, and each job run over such files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from datamill.operators import classify, recommend
from datamill.plans import jobs
from datamill.sources import markup, text_files


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_pair_score_files_have_a_header_each(spark, tmp_path):
    header = "id_1,id_2,a,b,is_match\n"
    write(tmp_path / "d" / "1.csv", header + "1,2,?,0.5,TRUE\n")
    write(tmp_path / "d" / "2.csv", header + "3,4,1,?,FALSE\n")
    rows = text_files.read_pair_scores(spark, str(tmp_path / "d"), scores=2).orderBy("id1").collect()
    assert [tuple(r) for r in rows] == [(1, 2, None, 0.5, True), (3, 4, 1.0, None, False)]
    bad = write(tmp_path / "bad.csv", header + "x,4,1,1,FALSE\n")
    with pytest.raises(Exception):
        text_files.read_pair_scores(spark, bad, scores=2).collect()


def test_alias_and_name_lines(spark, tmp_path):
    alias = write(tmp_path / "alias.tsv", "1\t10\n\t11\n2\t20\n2\t21\n")
    rows = text_files.parse_alias_lines(text_files.read_lines(spark, alias)).collect()
    assert {(r.bad_id, r.good_id) for r in rows} == {(1, 10), (2, 21)}
    names = write(tmp_path / "names.tsv", "1\t One\tmore \nx\tBad\n3\n 5 \tBlank\n+6\tSix\n")
    rows = text_files.parse_name_lines(text_files.read_lines(spark, names)).collect()
    assert {(r.item, r.name) for r in rows} == {(1, "One\tmore"), (6, "Six")}


def test_frequency_file_round_trip(spark, tmp_path):
    table = spark.createDataFrame([("cat", 2), ('"q', 5), ("ant", 2)], "term string, df bigint")
    path = str(tmp_path / "df")
    text_files.write_doc_frequencies(table, path)
    rows = text_files.read_doc_frequencies(spark, path).collect()
    assert sorted(map(tuple, rows)) == sorted([("cat", 2), ('"q', 5), ("ant", 2)])
    stops = write(tmp_path / "stop.txt", "the\nours\tourselves\n\na\n")
    assert text_files.read_stop_words(spark, stops) == ["a", "ours", "ourselves", "the"]


def test_elements_and_marked_names(spark, tmp_path):
    body = "".join(
        f'<MedlineCitation Owner="{i}"><L><DescriptorName MajorTopicYN="{y}">T{i}</DescriptorName>'
        f'<DescriptorName MajorTopicYN="Y">All</DescriptorName></L>\n</MedlineCitation>\n'
        for i, y in enumerate("YN")
    )
    text = f'<Set>\n{body}<MedlineCitation Owner="z"><L/></MedlineCitation></Set>'
    path = write(tmp_path / "m.xml", text)
    rows = markup.read_citation_topics(spark, path).collect()
    assert [r.topics for r in rows] == [["T0", "All"], ["All"], []]


def test_pages(spark, tmp_path):
    path = write(
        tmp_path / "wiki.xml",
        "<mediawiki><page><title>A</title><ns>0</ns><revision><text xml:space=\"preserve\">cat dog</text></revision></page>"
        "<page><title>B</title><ns>0</ns><redirect title=\"A\"/><revision><text>x</text></revision></page>"
        "<page><title>Talk:C</title><ns>1</ns><revision><text>y</text></revision></page></mediawiki>",
    )
    rows = {r.title: (r.content, r.is_article, r.is_redirect) for r in markup.read_pages(spark, path).collect()}
    assert rows == {"A": ("cat dog", True, False), "B": ("x", True, True), "Talk:C": ("y", False, False)}


def test_linkage_job(spark, tmp_path):
    path = write(tmp_path / "p.csv", "id_1,id_2,a,b,m\n1,2,3,?,TRUE\n1,3,1,2,FALSE\n")
    found = jobs.linkage(spark, path, scores=2, chosen=(0, 1))
    assert {(r.matched, r.threshold) for r in found["thresholds"].collect()} == {(True, 2.0), (False, 2.0)}
    assert found["match_counts"].count() == 2 and found["stats_by_match"].count() == 4


def test_recommender_job(spark, tmp_path):
    draw = random.Random(1)
    lines = [f"{u} {draw.randrange(10) + 10 * (u % 2)} {draw.randrange(1, 9)}" for u in range(40) for _ in range(12)]
    ratings = write(tmp_path / "r.txt", "\n".join(lines))
    names = write(tmp_path / "n.tsv", "\n".join(f"{i}\titem {i}" for i in range(20)))
    alias = write(tmp_path / "a.tsv", "3\t4\n")
    grid = [recommend.Setting(2, 1.0, 1.0)]
    found = jobs.recommender(spark, ratings, names, alias, user=4, grid=grid, rank=3, iterations=2)
    assert 0 <= found["popularity_auc"].first().mean_auc <= 1
    assert found["picks"].count() == found["first_picks"].count() == 5 and found["pick_lines"].count() == 40 and found["grid"].count() == 1
    assert 3 not in {r.item for r in found["history"].collect()}


def test_trees_job(spark, tmp_path):
    lines = []
    for i in range(300):
        block = [0, 0, 0]
        block[i % 3] = 1
        lines.append(",".join(map(str, [i, i % 7, *block, i % 3 + 1])))
    path = write(tmp_path / "t.csv", "\n".join(lines))
    plain, category = [classify.TreeSetting("gini", 4, 10)], [classify.TreeSetting("entropy", 4, 40)]
    found = jobs.trees(spark, path, numeric=2, blocks=(3,), grid=plain, category_grid=category, forest_trees=3, record="4,3,2")
    assert found["record_class"].first().class_number == 3.0
    assert found["grid"].first().accuracy == 1.0 and found["category_grid"].first().accuracy == 1.0
    assert abs(found["chance_accuracy"].first()[0] - 1 / 3) < 0.05


def test_anomaly_job(spark, tmp_path):
    draw = random.Random(2)
    lines = [f"{draw.random()},{'tu'[i % 2]},s{i % 3},f,{draw.random() + 9 * (i % 2)},{'ab'[i % 2]}." for i in range(90)]
    path = write(tmp_path / "k.csv", "\n".join(lines))
    found = jobs.anomaly(
        spark, path, numeric_after=1, ks=[2], scaled_ks=[2], entropy_ks=[2, 3], k=3, place=5,
        sample_path=str(tmp_path / "sample"), fine_ks=[3, 4],
    )
    assert [r.k for r in found["plain_scan_fine"].collect()] == [3, 4]
    assert found["label_counts"].count() == 2 and found["entropy_scan"].count() == 2
    assert found["outliers"].count() <= 5
    assert spark.read.text(str(tmp_path / "sample")).filter(F.col("value").contains(",")).count() < 90


def test_concepts_job(spark, tmp_path):
    draw = random.Random(3)
    themes = (["cat", "dog", "bird", "fish"], ["iron", "gold", "zinc", "lead"])
    pages = "".join(
        f"<page><title>P{i}</title><ns>0</ns><revision><text>{' '.join(draw.choices(themes[i % 2], k=12))}</text></revision></page>"
        for i in range(40)
    )
    path = write(tmp_path / "w.xml", f"<m>{pages}</m>")
    found = jobs.concepts(spark, path, fraction=1.0, num_terms=8, k=2, num_concepts=2, frequencies_path=str(tmp_path / "df"))
    assert found["singular_values"].count() == 2 and found["top_docs"].count() == 20
    assert text_files.read_doc_frequencies(spark, str(tmp_path / "df")).count() == 8


def test_topics_job(spark, tmp_path):
    draw = random.Random(4)
    records = "".join(
        "<MedlineCitation X=\"1\">"
        + "".join(f'<DescriptorName MajorTopicYN="Y">t{draw.randrange(12)}</DescriptorName>' for _ in range(3))
        + "</MedlineCitation>\n"
        for _ in range(40)
    )
    path = write(tmp_path / "m.xml", records)
    found = jobs.topics(spark, path, limit=0.1, fraction=0.5, contains="t1")
    assert {r.topic for r in found["containing"].collect()} <= {"t1", "t10", "t11"}
    assert found["second_component"].count() == 0 or found["components"].count() > 1
    assert found["topic_counts"].count() == 10 and found["components"].first().n <= 12
    assert 0 <= found["clustering"].first()[0] <= 1
    assert found["path_histogram"].count() >= 1


def test_lines_are_written_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    back = text_files.exported(df, ["n", "s"], str(tmp_path / "out"))
    assert sorted(r.value for r in back.collect()) == ["1,a", "2"]
    assert (tmp_path / "out" / "_SUCCESS").exists()
    with pytest.raises(Exception):
        text_files.exported(df, ["n", "s"], str(tmp_path / "out"))
