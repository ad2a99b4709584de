"""The manifest against a plain tree in Python; its query is held against SQL with the others."""

import hashlib
import random
import zlib

import pytest
from ordermill.llm import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars int, text string, leaf int, n string, at int, key int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    out = []
    for level in levels[:-1]:
        begin = at // 16 * 16
        run = level[begin : begin + 16]
        out.append(("".join(run[: at - begin]), "".join(run[at - begin + 1 :])))
        at //= 16
    return out


def plain(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for leaves in by_source.values():
        leaves.sort(key=lambda x: x[:3])
    trees = {s: tree([x[2] for x in leaves]) for s, leaves in by_source.items()}
    top = tree([trees[s][-1][0] for s in sources])
    for number, source in enumerate(sources):
        for at, (_, _, leaf, row) in enumerate(by_source[source]):
            steps = path(trees[source], at) + path(top, number)
            end = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                low = None if row[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
                end = leaf_of((*row[:4], low))
            for left, right in steps:
                end = sha(left + end + right)
            root = top[-1][0]
            yield (row[0], leaf, trees[source][-1][0], root, sha("".join(a + b for a, b in steps)), end, end == root)


def cases():
    rnd = random.Random(3)

    def rows(n, sources, ids=None):
        values = [None, "", "Some Text", "low é", "X" * 50, "É", "long " * 20_000]
        for i in range(n):
            key = rnd.choice(ids) if ids else i * rnd.choice([1, 40_000, 1 << 40]) - 50_000
            yield (key, rnd.choice(sources), rnd.choice([None, "en", "é"]), rnd.choice([None, 5, -7]), rnd.choice(values), 1, "n", 2, 3)

    yield "a hot source, sparse and negative keys", list(rows(700, ["a", "b", None, "", "é", "a:b"] + ["hot"] * 8))
    yield "repeated and missing keys", list(rows(300, ["a"] * 9 + ["b"], [*range(40), *[None] * 20]))
    yield "one row", list(rows(1, ["x"]))
    yield "a run of sixteen and one", list(rows(17, [None]))
    yield "many sources", list(rows(300, [str(i) for i in range(300)]))
    yield "one row many times", list(rows(1, ["x"])) * 40


@pytest.mark.parametrize(("name", "rows"), list(cases()), ids=lambda x: x if isinstance(x, str) else "")
def test_proofs(spark, name, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, manifest.digest(manifest.manifest(table)).collect()), key=str)
    assert got == sorted(plain(rows), key=str)


def test_ranks_without_python_or_sorted_windows(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    proofs = manifest.manifest(documents)
    plan = proofs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Window" not in plan
    assert proofs.where("size(path) < 2").count() == 0


def test_empty_table_and_other_keys(spark):
    empty = manifest.digest(manifest.manifest(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0 and empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    with pytest.raises(ValueError, match="whole number"):
        manifest.manifest(spark.createDataFrame([], SCHEMA.replace("doc_id bigint", "doc_id string")))
