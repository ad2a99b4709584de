from pathlib import Path

from ordermill.session import input_bytes, scratch_path, shuffle_partitions_for, size_shuffles


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions_for(0) == 1
    assert shuffle_partitions_for(1) == 1
    assert shuffle_partitions_for(2**30) == 16
    assert shuffle_partitions_for(2**30, "csv") == 4
    assert shuffle_partitions_for(2**40) == 16_384
    assert shuffle_partitions_for(100 * 10**12) == shuffle_partitions_for(100 * 10**12, "csv") == 50_000


def test_input_bytes(spark, small):
    files = [Path(small) / f"{name}.parquet" for name in ("orders", "part")]
    assert input_bytes(spark, *map(str, files)) == sum(f.stat().st_size for f in files)
    assert input_bytes(spark, f"{small}/*.parquet") == sum(
        f.stat().st_size for f in Path(small).glob("*.parquet")
    )


def test_shuffles_are_only_ever_raised(spark, small, with_conf, monkeypatch):
    with_conf(spark__sql__shuffle__partitions="8")
    assert size_shuffles(spark, f"{small}/orders.parquet") == 8
    monkeypatch.setattr("ordermill.session.BYTES_PER_SHUFFLE_PARTITION", 4096)
    raised = size_shuffles(spark, f"{small}/orders.parquet")
    assert raised > 8 and spark.conf.get("spark.sql.shuffle.partitions") == str(raised)


def test_scratch_paths_are_fresh_and_in_the_shared_folder(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert first.startswith(root.rstrip("/") + "/x-")
