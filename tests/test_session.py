"""Session helpers: sizes, the shared folder, spreading small inputs."""

import pyarrow as pa
import pytest

from millrace.session import batches_within, broadcast_limit, estimated_bytes, fits_broadcast, is_local, new_folder, shared_root, sized, spread


@pytest.mark.parametrize(
    "text, want", [("-1", -1), ("10485760", 10485760), ("10MB", 10 << 20), ("64k", 64 << 10), ("1g", 1 << 30), ("5b", 5)]
)
def test_broadcast_limit(spark, text, want):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
    try:
        assert broadcast_limit(spark) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_batches_end_with_the_row_that_reaches_their_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    counted = spark.range(0, 6, 1, 1).selectExpr("repeat('x', 30000) AS text").mapInArrow(
        lambda batches: (pa.RecordBatch.from_pylist([{"n": b.num_rows}]) for b in batches), "n bigint"
    )
    with batches_within(spark, 50_000):
        assert max(r["n"] for r in counted.collect()) < 6
        with batches_within(spark, 1 << 30):
            assert spark.conf.get(key) == "50000"
    assert spark.conf.get(key) == before
    with pytest.raises(ZeroDivisionError), batches_within(spark, 1):
        1 / 0
    assert spark.conf.get(key) == before


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x") != new_folder(spark, "x")
    assert new_folder(spark, "x").startswith(shared_root(spark))


def test_a_side_of_unknown_size_is_settled(spark, folder):
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(10)]), "id bigint")
    assert not fits_broadcast(unknown)
    known = sized(unknown, "t")
    assert fits_broadcast(known) and known.count() == 10
    spark.range(10).write.parquet(f"{folder}/t")
    small = spark.read.parquet(f"{folder}/t")
    assert estimated_bytes(small) < 10_000 and broadcast_limit(spark) == 10 << 20
    assert sized(small, "t") is small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sized(unknown, "t") is unknown
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_spread_shuffles_small_inputs_only(spark, folder):
    spark.range(10).coalesce(1).write.parquet(f"{folder}/t")
    small = spark.read.parquet(f"{folder}/t")
    assert spread(small).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    huge = small.crossJoin(small).crossJoin(small).crossJoin(small).crossJoin(small).crossJoin(small)
    assert estimated_bytes(huge) > 1 << 40 and spread(huge) is huge


def test_only_one_process_is_local():
    assert all(map(is_local, ("local", "local[4]", "local[*]", "local[2,3]")))
    assert not any(map(is_local, ("local-cluster[3,2,1024]", "yarn", "spark://h:7077", "k8s://https://h")))
