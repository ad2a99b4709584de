"""The corpus pipeline, stage by stage, against plain Python on planted cases."""

import random

import corpus_pipeline
import pytest
from test_text_operators import plain_components, plain_contamination, words

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rnd = random.Random(12)
    folder = tmp_path_factory.mktemp("pipeline")
    texts, labels = [], []
    for i in range(400):
        own = words(rnd, 60, "abcdeghio").split()
        if i % 6 == 0:
            own[rnd.randrange(60)] = rnd.choice(["nastyword", "vilepest"])
        texts.append(" ".join(own))
        labels.append((i, int(i % 6 == 0)))
    items = [(1, words(rnd, 25, "klmnop")), (2, None)]
    texts[11] += " " + items[0][1] + " after"
    texts[13] = texts[14].upper()
    texts[15] = texts[16] + " one more"
    texts[17] += ' token = "0123456789abcdef0123456789" done'
    texts += [None, "", "  ", "a b"]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[20])
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, items


def test_every_stage(spark, table):
    folder, rows, items = table
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    def after(name, given):
        frame = stages[name](spark, spark.createDataFrame(given, COLUMNS), folder)
        assert frame.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        return sorted(map(tuple, frame.collect()))

    clean = after("toxicity", rows)
    assert clean == sorted(r for r in rows if r[0] % 6 or r[0] >= 400)
    single = after("near_duplicates", clean)
    groups = {key: least for key, _, least in plain_components([r[:2] for r in clean])}
    # Rows without words are no group: each stays.
    assert single == sorted({r for r in clean if groups[r[0]] == r[0]})
    assert {14, 16} & {r[0] for r in single} == set()
    unseen = after("decontamination", single)
    assert unseen == [r for r in single if not plain_contamination(r[1], [(str(i), t) for i, t in items])[1]]
    assert 11 not in {r[0] for r in unseen}
    safe = after("secrets", unseen)
    assert [r for r in safe if r[0] != 17] == [r for r in unseen if r[0] != 17]
    text = next(r[1] for r in safe if r[0] == 17)
    assert text.endswith('[secret]" done') and next(r[4] for r in safe if r[0] == 17) == len(text)
    pieces = stages["packing"](spark, spark.createDataFrame(safe, COLUMNS), folder).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in safe}
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(p[:5] for p in whole) == sorted(p[:5] for p in pieces)


def test_empty_tables(spark, table, tmp_path):
    folder, _, _ = table
    nothing = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, folder).count() == 0


def test_near_duplicates_of_eighty_percent_are_dropped(spark, table):
    rnd = random.Random(31)
    base = words(rnd, 104, "abcdeghio").split()
    near, far = list(base), list(base)
    # Two words away from each other change 10 of 100 shingles (90 of 110 are common), three 15 (85 of 115).
    for at in (20, 60):
        near[at] = f"changed{at}"
    for at in (10, 40, 80):
        far[at] = f"other{at}"
    rows = [(1, " ".join(base), "en", "s", 1), (2, " ".join(near), "en", "s", 1), (3, " ".join(far), "en", "s", 1)]
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, spark.createDataFrame(rows, COLUMNS), table[0])
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_rows_without_an_id_are_judged_by_their_texts(spark, table):
    rnd = random.Random(32)
    text, other = words(rnd, 90, "abcdeghio"), words(rnd, 90, "abcdeghio")
    rows = [(7, text, "en", "s", 1), (None, text, "en", "s", 1), (None, text + " more", "de", "t", 2), (3, text, "en", "s", 1)]
    rows += [(None, other, "en", "s", 1), (None, other, "en", "s", 1), (None, None, "en", "s", 1), (None, "", "en", "s", 1)]
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    kept = sorted(map(tuple, stage(spark, spark.createDataFrame(rows, COLUMNS), table[0]).collect()), key=str)
    assert kept == sorted([rows[3], rows[4], rows[6], rows[7]], key=str)


def test_stages_keep_columns_of_any_name(spark, table):
    folder, rows, _ = table
    names = ["_id", "items", "hits", "n_words", "spans", "blob_id", "_found", "row", "set_id", "component_id", "windows", "Hits_", "kept", "_text"]
    extra = [(*row, *(f"{name} {row[0]}" for name in names)) for row in rows if row[0] is not None]
    given = spark.createDataFrame(extra, COLUMNS + "".join(f", `{name}` string" for name in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, given, folder)
        assert found.columns == given.columns, name
        got = found.collect()
        assert got and all(tuple(r)[5:] == tuple(f"{c} {r.doc_id}" for c in names) for r in got), name
    assert corpus_pipeline.STAGES[-1][1](spark, given, folder).count() > 0
