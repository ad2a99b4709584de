"""Token counts against an unaltered tokenizer, with chunks so short that texts are huge."""

import random

import pytest
from ordermill.llm import queries, token_counts
from ordermill.llm.packing import byte_bpe_path
from tokenizers import Tokenizer

PARTS = ["<|endoftext|>", " ", "  ", "\n\n", "\r", " ", "'ll", "'re", "'r", "'", "e", "word ", " 123", "日本語。", "é", "!!", "<|endof", "text|>", "\t"]
SCHEMA = "doc_id bigint, text string, n_tokens string, n_bytes int, row int, part int"


def plain(texts):
    tokenizer = Tokenizer.from_file(byte_bpe_path())
    return [len(tokenizer.encode(text or "", add_special_tokens=False).ids) for text in texts]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    made = [None, "", " ", "a", "x" * 3000, " " * 2500 + "end", "<|endoftext|>" * 200, "日" * 900]
    made += ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(1, 250))) for _ in range(120)]
    # One word that is longer than the overlaps of two rounds, within text that aligns.
    made.append("some words " * 200 + "y" * 700 + " and more" * 200)
    return made


@pytest.mark.parametrize(("chunk", "overlap"), [(128, 40), (1000, 90)])
def test_spliced_counts(spark, texts, chunk, overlap):
    rows = [(i, t, "clash", 1, 2, 3) for i, t in enumerate(texts)] + [(None, texts[-1], "", 0, 0, 0), (5, texts[-1], "", 0, 0, 0)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in token_counts.token_counts(table, chunk=chunk, overlap=overlap, limit=500).collect()]
    counts = plain([r[1] for r in rows])
    want = [(r[0], len((r[1] or "").encode()), n, n > 500) for r, n in zip(rows, counts, strict=True)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table_and_bad_overlap(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_counts.token_counts(empty).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert token_counts.token_counts(empty).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        token_counts.token_counts(empty, chunk=100, overlap=60)


def test_chunks_cover_the_text():
    for length in (101, 160, 161, 999):
        starts = token_counts.chunk_starts(length, 100, 40)
        assert starts[-1] + 100 >= length and all(b - a == 60 for a, b in zip(starts, starts[1:], strict=False))
        assert all(s + 100 <= length for s in starts[:-1]) and length - starts[-1] > 40


def test_query_counts_every_document(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.over_limit) for r in queries.op13_token_counts(spark, small).collect()}
    assert got == {r.doc_id: (n, n > 1024) for r, n in zip(documents, plain([r.text for r in documents]), strict=True)}
