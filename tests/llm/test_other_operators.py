"""URL reputation and neighbours against plain Python, and the queries against their SQL."""

import math
import random

import pytest
from ordermill.llm import neighbours, queries, url_reputation
from ordermill.llm.pieces import PieceEncoder


def test_urls_and_rules(spark):
    urls = {
        1: "http://A.Example.NET/en/x?y#z", 2: "https://example.net?x", 3: "x://m.foo.org/fr/a#b", 4: "no scheme", 5: None, 6: "",
        7: "http://a.example.com/de/", 8: "http://example.com/en/", 9: "http://net/", 10: "http://badnet/x", 11: "a://b://c/d",
    }
    pages = spark.createDataFrame([(*x, "old") for x in urls.items()], "page_id bigint, url string, verdict string")
    got = {r.page_id: r for r in url_reputation.judge(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2].host, got[2].path, got[2].rule) == ("example.net", "", None)
    assert (got[3].rule, got[3].verdict) == ("org/fr/", "allow")
    assert [(got[i].host, got[i].path) for i in (4, 5, 6)] == [("", "")] * 3
    assert (got[7].rule, got[7].verdict) == ("example.com/de/", "block")
    assert (got[9].rule, got[10].rule, got[11].host) == ("net/", None, "b:")
    assert all(r.verdict in ("allow", "block") for r in got.values())
    assert url_reputation.judge(pages.limit(0)).count() == 0


def test_reputation_shrinks_to_the_domain(spark):
    rows = [("a.bad.x", 1)] * 40 + [("b.bad.x", 1)] * 30 + [("c.good.x", 0)] * 50 + [("d.good.x", 0)] * 20 + [("e.good.x", 1)]
    fitted = url_reputation.host_reputation(spark.createDataFrame(rows, "host string, bad int"))
    rate = {r.host: r.rate for r in fitted["hosts"].collect()}
    assert rate["a.bad.x"] > 0.9 > 0.1 > rate["c.good.x"]
    assert rate["c.good.x"] < rate["e.good.x"]


def test_neighbours_against_all_pairs(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(8)], 1) for i in range(300)]
    rows += [(i, rows[40][1], 1) for i in range(300, 360)]
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [math.nan] + [1.0] * 7, 1), (403, [None] + [1.0] * 7, 1), (404, [1.0], 1), (420, [math.inf] * 8, 1), rows[20], (None, [1.0] * 8, 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    good = {r.vec_id: r.embedding for r in table.where("vec_id < 400").collect()}
    got = {}
    for r in neighbours.nearest(table, leaf=32, times=30).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in good if i % 20 == 0}
    for query, found in got.items():
        want = sorted((-math.fsum(a * b for a, b in zip(good[query], v, strict=True)), i) for i, v in good.items() if i != query)[:20]
        assert [x[0] for x in sorted(found)] == list(range(1, 21))
        assert [x[1] for x in sorted(found)] == [i for _, i in want]
        assert [x[2] for x in sorted(found)] == pytest.approx([-s for s, _ in want], abs=1e-12)
    few = neighbours.nearest(table.where("vec_id < 3 or vec_id = 20")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(q, k) for q in (0, 20) for k in (1, 2, 3)]
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_domains_under_suffixes_of_two_labels(spark):
    from pyspark.sql import functions as F

    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.com", "com", "", "m.gov.ng"]
    table = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", *url_reputation.levels(F.col("host")))
    want = [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("y.com", "com"), ("com", "com"), ("", ""), ("m.gov.ng", "gov.ng")]
    assert [tuple(r)[1:] for r in table.collect()] == want


def test_pages_are_read_twice(spark, medium, monkeypatch):
    written = []
    real = url_reputation.Scratch.keep
    monkeypatch.setattr(url_reputation.Scratch, "keep", lambda self, frame: written.append(frame) or real(self, frame))
    plan = queries.op8_url_reputation(spark, medium)._jdf.queryExecution().optimizedPlan().toString()
    assert len(written) == 1 and plan.count("url#") > 0
    assert sum("Relation [" in line and "url#" in line for line in plan.splitlines()) == 1


def recall(ids, points, found):
    import numpy as np

    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        best = [j for j in np.argsort(-(points @ points[i]))[:21] if j != i][:20]
        hits += sum((ids[i], ids[j]) in found for j in best)
        total += 20
    return hits / total


def test_recall_on_the_table(spark, medium):
    import numpy as np

    rows = spark.read.parquet(f"{medium}/embeddings.parquet").collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {(r.query_id, r.vec_id) for r in neighbours.nearest(spark.read.parquet(f"{medium}/embeddings.parquet")).collect()}
    assert recall(ids, points, found) >= 0.9


@pytest.mark.parametrize("slices", [1, 3])
def test_recall_with_the_shipped_settings(spark, monkeypatch, slices):
    import numpy as np
    import pandas as pd

    # No structure at all: the hardest case. The leaves hold about 0.7 of the classes, with repeats.
    points = np.random.default_rng(3).normal(size=(12_000, 64))
    points /= np.linalg.norm(points, axis=1)[:, None]
    assert neighbours.visits(12_000) < 0.75 * 12_000
    frame = pd.DataFrame({"vec_id": range(12_000), "embedding": points.tolist()})
    table = spark.createDataFrame(frame, "vec_id bigint, embedding array<double>").repartition(8)
    monkeypatch.setattr(neighbours, "slices_of", lambda *_: slices)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 64)
    found = {(r.query_id, r.vec_id) for r in neighbours.nearest(table).collect()}
    assert recall(np.arange(12_000), points, found) >= 0.9


def test_work_grows_slower_than_all_pairs():
    pairs = [neighbours.visits(n) * n / 20 for n in (10_000, 50_000, 1_000_000_000)]
    assert pairs[1] / pairs[0] < 17 < 25
    assert neighbours.visits(10**9) < 0.05 * 10**9
    # However many queries there are, a task gets a bounded part of those that visit its leaf.
    n = 10**9
    assert n / 20 * neighbours.visits(n) / (10 * n) / neighbours.slices_of(n // 20, n, neighbours.visits(n), 10) <= neighbours.MOST_QUERIES


def test_buckets_hold_leaves_that_lie_together():
    import numpy as np

    sizes = [np.array([3.0, 4.0, 2.0, 25.0, 5.0, 5.0, 1.0]), np.array([9.0]), np.array([10.0, 0.0, 10.0])]
    buckets = neighbours.buckets_of(sizes, 10)
    # A leaf of 25 is dealt over three; no bucket has leaves of two trees.
    assert buckets.bucket.tolist() == [0, 0, 0, 1, 4, 4, 5, 6, 7, 8, 8] and buckets.pieces.tolist() == [1, 1, 1, 3, *[1] * 7]
    assert buckets.bases.tolist() == [0, 7, 8, 11]


def test_a_query_is_sent_once_to_a_bucket(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    points = np.random.default_rng(8).normal(size=(700, 16))
    points[7:60] = points[6]
    frame = pd.DataFrame({"vec_id": range(700), "embedding": points.tolist()})
    table = spark.createDataFrame(frame, "vec_id bigint, embedding array<double>").repartition(3)
    roots, real = [], neighbours.scratch_path
    monkeypatch.setattr(neighbours, "scratch_path", lambda *a: roots.append(real(*a)) or roots[-1])
    order = lambda rows: sorted(tuple(r) for r in rows)
    want = order(neighbours.nearest(table, leaf=16).collect())
    # A row for each query and tree, whatever the number of leaves visited; before, each leaf had one with the query's vector.
    probes = spark.read.parquet(f"{roots[0]}/probes")
    asked = 35 - 1
    assert probes.count() <= neighbours.TREES * asked
    lists = [np.concatenate([r.early, r.late]) for r in probes.collect()]
    assert sum(map(len, lists)) > 5 * len(lists) and max(map(len, (r.early for r in probes.collect()))) <= neighbours.FIRST_LEAVES
    # Small buckets, leaves dealt over several, and small blocks change nothing.
    deal = neighbours.buckets_of
    monkeypatch.setattr(neighbours, "buckets_of", lambda sizes: deal(sizes, 11))
    monkeypatch.setattr(neighbours, "slices_of", lambda *_: 2)
    for name, value in (("BLOCK", 5), ("QUERY_BLOCK", 7), ("SOME_QUERIES", 3), ("SOME_VISITS", 4), ("TASK_QUERIES", 20), ("HELD_PAIRS", 50)):
        monkeypatch.setattr(neighbours, name, value)
    got = order(neighbours.nearest(table, leaf=16).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want] and [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-12)
    # Numbers in single precision are scored in double precision.
    single = neighbours.nearest(table.selectExpr("vec_id", "cast(embedding as array<float>) embedding"), leaf=16).where("query_id = 100").collect()
    exact = points.astype(np.float32).astype(float)
    assert [r.score for r in single] == pytest.approx([float(exact[100] @ exact[r.vec_id]) for r in single], abs=1e-12)


@pytest.mark.parametrize(("file", "spaced"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_give_the_tokenizers_own_ids(file, spaced):
    import numpy as np
    import public_tokenizers

    from tokenizers import Tokenizer

    encoder, rnd = PieceEncoder(public_tokenizers.path(file), spaced), random.Random(1)
    plain = Tokenizer.from_file(public_tokenizers.path(file))
    texts = ["".join(rnd.choice(" \n\t'sdtrevml1a2é!.,AÉœß×\r<|>") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["it's 'S we'll'd", "日本 text", "x" * 5000]
    # Literals of added tokens are tokens; beginnings of them, other cases of letters and halves in two texts are not.
    texts += ["a <|endoftext|> b", "<|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "x<|startoftext|", "<<|endoftext|>>"]
    texts += ["".join(rnd.choice(["<|endoftext|>", "<|startoftext|>", "<|", "a ", "é"]) for _ in range(rnd.randint(0, 9))) for _ in range(300)]
    data = [t.encode() for t in texts]
    ids, begins = encoder.encode(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), 9)
    for i, text in enumerate(texts):
        want = plain.encode(text, add_special_tokens=False).ids + [9]
        assert ids[begins[i] : begins[i + 1]].tolist() == want


def test_reputation_query_uses_no_python(spark, medium):
    plan = queries.op8_url_reputation(spark, medium)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, medium, name):
    from checks.compare import connect, differences

    assert differences(queries.QUERIES[name](spark, medium), connect(medium), queries.ORACLE_SQL[name]) == []
