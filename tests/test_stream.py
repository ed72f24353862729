"""Stream-fed upsert: equals the batch result, and replays are harmless."""

import uuid

from pyspark.sql import functions as F

from conftest import rows
from tidewater.session import scratch_path
from tidewater.streaming.upsert_stream import stream_upsert

SF = "/root/testdata/sf0.001"


def test_stream_upsert_is_idempotent_under_replay(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    base = scratch_path(spark, f"tests/stream_replay-{uuid.uuid4().hex[:8]}")
    target = f"{base}/target"
    stale = events.filter(F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")) \
        .withColumn("value", F.col("value") * 2).withColumn("day", F.to_date("ts").cast("string"))
    stale.write.mode("overwrite").partitionBy("day").parquet(target)
    derive = {"day": F.to_date("ts").cast("string")}

    def run(checkpoint):
        stream_upsert(spark, SF, events.schema, target, checkpoint, unique_key="event_id",
                      partition_by=["day"], derive=derive, path_glob="events.parquet")
        return rows(spark.read.parquet(target).select(*events.columns))

    want = rows(events)
    assert run(f"{base}/ckpt") == want          # stream result = source table
    assert run(f"{base}/ckpt") == want          # same checkpoint: nothing new to apply
    assert run(f"{base}/ckpt-replay") == want   # full replay: keyed upserts change nothing
