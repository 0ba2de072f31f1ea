"""Token alignment beside a version that encodes whole texts and counts in dictionaries."""

from __future__ import annotations

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from datamill.llm.alignment import BYTE_LEVEL, PIECES, TOKENIZERS, Aligner, align_tokenizers
from datamill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (1, None), (2, ""), (3, "héý 😀  漢字\n a <|endoftext|> </s> <0x41>"), (4, "a▁b and more"), (5, " x  y"), (6, "x "), (7, "\n\n x \t\n y  z 　 q"),
    (8, "a\x00b c"), (None, "the cat"), (None, "the cat"), (9, "👩‍👩‍👧 é"), (9, "  "), (10, "don't we'll 12345 ... !?  " * 50), (11, "漢字かな交じり文" * 300),
    (12, "a\r\n b\x85 c\x1c d"), (13, "é naïve ﬁ " * 20), (14, " "), (15, " ".join(f"w{i}" for i in range(20_000))),
]


def byte_alphabet() -> dict[str, int]:
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    alphabet, extra = {}, 256
    for b in range(256):
        if b in printable:
            alphabet[chr(b)] = b
        else:
            alphabet[chr(extra)] = b
            extra += 1
    return alphabet


def plain(rows):
    """Whole texts, ends by running sums of the decoded bytes, all counts in dictionaries."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{TOKENIZERS}/{BYTE_LEVEL}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/{PIECES}")
    back = byte_alphabet()
    told, counts = [], Counter()
    for doc, text in rows:
        a_ids = a.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_own = [bytes(back[c] for c in a.id_to_token(i)) for i in a_ids]
        b_own = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_own) != whole or b"".join(b_own) != whole:
            told.append((doc, [], [], [], []))
            continue
        a_at = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in a_own]))}
        b_at = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in b_own]))}
        cuts = [end for end in a_at if end in b_at]
        groups, i, j = [], 0, 0
        for end in cuts:
            groups.append((a_ids[i : a_at[end] + 1], b_ids[j : b_at[end] + 1]))
            i, j = a_at[end] + 1, b_at[end] + 1
        links = [(a_ids[a_at[end]], b_ids[b_at[end]]) for end in cuts]
        counts.update(links)
        told.append((doc, a_ids, b_ids, groups, links))
    top: dict[int, int] = {}
    for (_, y), n in counts.items():
        top[y] = max(n, top.get(y, 0))
    out = []
    for doc, a_ids, b_ids, groups, links in told:
        name = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((
            doc, len(a_ids), len(b_ids), len(groups), len(links), sum(counts[p] == top[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(name.encode()).hexdigest() if a_ids else "",
        ))
    return sorted(out, key=repr)


def got(frame):
    return sorted((tuple(row[c] for c in COLUMNS) for row in frame.collect()), key=repr)


def test_query_is_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert got(QUERIES["op13_tokenizer_alignment"](spark, SF_DIR)) == plain([(r.doc_id, r.text) for r in docs])


@pytest.mark.parametrize("memo", [1, 100_000])
def test_odd_texts(spark, memo):
    rows = [(d, t, 5, "x", 7) for d, t in ODD]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int, pairs string, n int")
    assert got(align_tokenizers(docs, memo=memo)) == plain(ODD)
    assert align_tokenizers(docs.limit(0)).count() == 0


def test_pairs_are_joined_by_a_shuffle_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr("datamill.llm.alignment.BROADCAST_PAIRS", 0)
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string")
    assert got(align_tokenizers(docs)) == plain(ODD)


def test_spans_and_bytes_give_the_ends():
    # Three tokens of one character of four bytes, then a token of two characters.
    begin, end, lengths = np.array([0, 0, 0, 4]), np.array([4, 4, 4, 6]), np.array([1, 1, 2, 2])
    assert Aligner.ends(begin, end, lengths).tolist() == [1, 2, 4, 6]


def test_units_end_where_no_tokenizer_joins():
    aligner = Aligner(f"{TOKENIZERS}/{BYTE_LEVEL}", f"{TOKENIZERS}/{PIECES}")
    assert aligner.unit.findall(" a  b c\n d ") == [" a", "  b", " c\n d "]
    assert aligner.unit.findall("   ") == ["   "]
