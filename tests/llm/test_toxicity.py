"""Toxicity by compression distance against plain Python, and how much of planted words it learns."""

import collections
import math
import random
import zlib

import pytest
from ordermill.llm import toxicity
from ordermill.llm.common import Scratch
from pyspark.sql import functions as F


def soup(rnd, n):
    return ["".join(rnd.choice(["th", "er", "an", "ti", "on", "re", "he", "in"]) for _ in range(rnd.randint(1, 4))) for _ in range(n)]


def is_held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def planted(words, each, rnd, hot=None):
    """Documents of which a third are toxic, each of those with one of the words, and every other one with the hot word too."""
    rows = []
    for i in range(3 * each * len(words)):
        text = soup(rnd, rnd.randint(30, 80))
        if i % 3 == 0:
            own = words[i // 3 % len(words)] if i // 3 % 2 or not hot else hot
            for _ in range(rnd.randint(1, 3)):
                text.insert(rnd.randrange(len(text)), own)
        rows.append((i, " ".join(text), int(i % 3 == 0)))
    return rows


def caught(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int").repartition(8)
    labels = docs.select("doc_id", "toxic")
    scored = toxicity.toxicity(docs.drop("toxic"), labels).join(labels, "doc_id").where("held_out")
    found = {r.toxic: r.rate for r in scored.groupBy("toxic").agg(F.avg("predicted").alias("rate")).collect()}
    return found[1], found[0]


@pytest.mark.parametrize("hot", [None, "hotinsult"])
def test_rare_words_are_learned_beside_a_hot_one(spark, hot):
    rnd = random.Random(3)
    rare = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(6, 9))) for _ in range(100)]
    found, false = caught(spark, planted(rare, 24 if hot is None else 48, rnd, hot))
    assert found >= 0.95 and false < 0.01


def test_copies_of_one_document_tell_nothing(spark):
    rnd = random.Random(4)
    rows = planted(["realinsult"], 60, rnd)
    base = soup(rnd, 60) + ["accident", "happened", "yesterday"]
    for i in range(300):
        near = list(base)
        near[rnd.randrange(50)] = f"other{rnd.randrange(10**6)}"
        rows.append((1000 + i, " ".join(near), 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    real = toxicity.pick_strings
    picked = []
    toxicity.pick_strings = lambda scored, *size: picked.extend(real(scored, *size)) or picked
    try:
        toxicity.train_dictionaries(docs, docs.select("doc_id", "toxic"))
    finally:
        toxicity.pick_strings = real
    assert any(b"realinsult".startswith(p.strip()) for p in picked)
    assert not any(word.startswith(p.strip()) for p in picked for word in (b"accident", b"happened", b"yesterday"))


def test_counts_of_strings(spark):
    rnd = random.Random(5)
    lines = [soup(rnd, rnd.randint(0, 12)) for _ in range(40)]
    lines += [lines[3], lines[4] + ["more"], ["one"], ["one"] * 4]
    rows = [(n, n % 3 == 0, line) for n, line in enumerate(lines)]
    words = spark.createDataFrame([(n, int(bad), [w.encode() for w in line]) for n, bad, line in rows], "row bigint, toxic int, words array<binary>")
    totals, counted = toxicity.telling_counts(words.repartition(3), Scratch(spark, "test"))
    owner, sizes = {}, {}
    for n, _, line in rows:
        triples = {(a, b, c) for a, b, c in zip(["", *line], line, [*line[1:], ""], strict=False)}
        sizes[n] = len(triples)
        for triple in triples:
            owner.setdefault(triple, n)
    own = collections.defaultdict(set)
    for triple, n in owner.items():
        own[n].add(triple)
    want, want_totals = collections.defaultdict(lambda: [0, 0]), collections.Counter()
    for n, bad, _ in rows:
        if own[n]:
            want_totals[int(bad)] += len(own[n]) / sizes[n]
            for string in toxicity.strings_of(" ".join({w for _, w, _ in own[n]}).encode()):
                want[string][1 - int(bad)] += 1
    assert totals == pytest.approx(dict(want_totals))
    assert {bytes(r.string): [r.bad, r.good] for r in counted.collect()} == {s: c for s, c in want.items() if sum(c) > 1}


def test_scores_equal_a_plain_count(spark):
    rnd = random.Random(6)
    rows = planted(["nastyword", "vilepest"], 70, rnd)
    rows += [(5000, " ".join(soup(rnd, 30_000) + ["nastyword"]), 1), (5001, "", 0), (5002, None, 0), (5003, "nastyword " * 3000, 1), (7, rows[7][1], 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    toxic, ordinary = toxicity.train_dictionaries(docs, labels)
    distance = toxicity.Distance(toxic, ordinary)
    known = {key: max(r[2] for r in rows if r[0] == key) for key in {r[0] for r in rows} if not is_held_out(key)}

    def place(hits, windows):
        return hits if hits < 4 else 2 + int(math.log2(hits)), math.ceil(math.log2(windows + 1))

    measured = []
    for key, text, _ in rows:
        gains = [distance.gain(word) for word in toxicity.normalise(text).split()]
        measured.append((key, [place(sum(g >= t for g in gains), len(gains)) for t in toxicity.THRESHOLDS]))
    best = None
    for at, _ in enumerate(toxicity.THRESHOLDS):
        counts = collections.defaultdict(lambda: [0, 0])
        for key, places in measured:
            if key in known:
                counts[places[at]][1 - known[key]] += 1
        table = tuple(sorted((*where, *c) for where, c in counts.items()))
        likely = sum(c[2] * math.log(toxicity.score_of(c[0], c[1], table)) + c[3] * math.log(1 - toxicity.score_of(c[0], c[1], table)) for c in table)
        if best is None or likely > best[0] + 1e-9:
            best = likely, at, table
    want = [(key, is_held_out(key), toxicity.score_of(*places[best[1]], best[2])) for key, places in measured]
    got = sorted((r.doc_id, r.held_out, r.score) for r in toxicity.toxicity(docs.drop("toxic"), labels).collect())
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in sorted(want)])
    assert {r[0] for r in got if r[0] in (5000, 5003) and r[2] < 0.3} == set()


def test_more_hits_than_ever_seen_count_as_the_most_seen():
    counts = ((0, 3, 1, 90), (1, 3, 20, 2), (4, 5, 30, 0))
    assert toxicity.score_of(60, 5, counts) == toxicity.score_of(4, 5, counts) > 0.9
    assert toxicity.score_of(0, 64, counts) < 0.3
    assert toxicity.score_of(3, 3, counts) == toxicity.score_of(1, 3, counts)
    assert toxicity.score_of(5, 5, ()) == pytest.approx(0.1)


def test_dictionaries_hold_all_that_is_telling_up_to_their_size():
    rnd = random.Random(9)
    strings = sorted({" {} ".format("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))).encode() for _ in range(3000)})
    assert toxicity.pick_strings(strings) == strings
    assert toxicity.pick_strings([b" idiot", b" idiot ", b" idi", b" other"]) == [b" idiot", b" other"]
    assert len(toxicity.pick_strings(strings, 2000)) == 100
    content = b"".join(map(toxicity.placed, strings))
    distance = toxicity.Distance(content, b"")
    assert all(distance.gain(s.strip()) >= 4 for s in strings)
    assert distance.gain(b"nothing") < 3


def test_columns_of_any_name_stay(spark):
    rows = [(i, f"text {i} " + ("insult " if i % 2 else "kind ") * 3, 5, 6, 7) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, hits int, windows int, _hits int")
    kept = toxicity.drop_toxic(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {r for r in rows if r[0] % 2 == 0}
