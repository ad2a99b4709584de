"""Periodic runs against a search by every distance."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from ordermill.llm import periodic_runs, queries

SCHEMA = "doc_id bigint, text string, n_runs int, key string, runs string"


def plain_runs(words):
    """(start, length, smallest period) of all runs, by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    """The contract's row, word by word."""
    words = [w for w in (text or "").encode().translate(bytes(32 if b in range(9, 14) else b for b in range(256))).split(b" ") if w]
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    first = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_words(rnd, n):
    letters, words = rnd.choice([1, 2, 3, 5, 40]), []
    while len(words) < n:
        if rnd.random() < 0.5:
            part = [rnd.randrange(letters) for _ in range(rnd.randint(1, max(1, n // 4)))]
            words += part * rnd.randint(2, 7) + part[: rnd.randint(0, len(part))]
        else:
            words.append(rnd.randrange(letters))
    return words[:n]


@pytest.mark.parametrize("most", [1 << 20, 16])
def test_runs_of_random_words(monkeypatch, most):
    # Transforms of at most 16 numbers: long blocks are judged by beginnings, windows in tiles.
    monkeypatch.setattr(periodic_runs, "MOST_SIZE", most)
    rnd = random.Random(most)
    for _ in range(400):
        texts = [random_words(rnd, rnd.choice([0, 1, 5, 6, 30, 150, 400])) for _ in range(rnd.randint(1, 4))]
        found = periodic_runs.runs_of_texts([" ".join(map(str, t)).encode() for t in texts], [None] * len(texts))
        assert [one.runs for one in found] == [plain_runs(t) for t in texts]


def test_transform_is_exact():
    rng = np.random.Generator(np.random.PCG64(1))
    for size in (2, 64, 128, 1024):
        x = rng.integers(0, periodic_runs.PRIME, (3, size))
        root = pow(periodic_runs.GENERATOR, (periodic_runs.PRIME - 1) // size, periodic_runs.PRIME)
        got = periodic_runs.transform(x.astype(float), root)
        for row in range(3):
            for k in (0, 1, size // 2, size - 1):
                want = sum(int(v) * pow(root, i * k, periodic_runs.PRIME) for i, v in enumerate(x[row])) % periodic_runs.PRIME
                assert int(got[row, k]) == want


def test_long_texts_in_bounded_time():
    nested = ((["x"] * 500 + ["y"]) * 8 + ["z"]) * 40
    for words, runs in ((["a"] * 200_000, [(0, 200_000, 1)]), ((["a"] * 50 + ["b"]) * 2000, None), (nested, None)):
        (found,) = periodic_runs.runs_of_texts([" ".join(words).encode()], [None])
        if runs:
            assert found.runs == runs and found.collapsed == b"a"
        else:
            longest = max(found.runs, key=lambda r: r[1])
            assert longest[1] == len(words) and longest[2] in (51, 4009)


def test_rows_of_odd_tables(spark):
    rnd = random.Random(8)
    texts = [None, "", " \n\t\x0b ", "a", "a a a a a a", "a a a a a", "A a A a A a A a A", "  x\x0bx\x0cx\tx\nx\rx y", "é é é é é é é"]
    texts += [" ".join(map(str, random_words(rnd, rnd.randint(1, 300)))) for _ in range(80)]
    rows = [(i, t, 7, "k", "r") for i, t in enumerate(texts)] + [(None, "b b b b b b b", None, None, None), (5, "c c c c c c c", 1, "", "")]
    rows += [rows[4], rows[4]]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, periodic_runs.run_digests(table).collect()), key=str)
    assert got == sorted((plain_row(i, t) for i, t, *_ in rows), key=str)
    listed = {r.doc_id: r for r in periodic_runs.text_runs(table).where("doc_id = 6").collect()}
    assert [tuple(x) for x in listed[6].runs] == [(0, 9, 2)] and listed[6].collapsed == "A a"
    empty = periodic_runs.run_digests(table.limit(0))
    assert empty.count() == 0 and empty.columns == periodic_runs.run_digests(table).columns


def test_query_on_the_small_table(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, small).collect()))
    assert got == sorted(plain_row(r.doc_id, r.text) for r in documents)
    assert sum(r[1] for r in got) > 5
