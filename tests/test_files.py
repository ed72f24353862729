"""File sources and sinks: empty results keep their schema, formats from suffixes."""

import uuid

from conftest import rows
from tidewater.session import scratch_path
from tidewater.sources import files as S


def test_empty_external_result_keeps_schema(spark):
    empty = spark.createDataFrame([], "a bigint, b string")
    loc = scratch_path(spark, f"tests/files-{uuid.uuid4().hex[:8]}/empty.parquet")
    S.write_external(empty, loc)
    back = S.read_external(spark, loc)
    assert back.dtypes == [("a", "bigint"), ("b", "string")] and back.count() == 0


def test_formats_from_suffix_and_partitioned_csv(spark):
    assert S.format_from_location("x/y.csv") == "csv" and S.format_from_location("x/y.json") == "json"
    assert S.format_from_location("x/y") == "parquet"
    df = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, v string, part string")
    loc = scratch_path(spark, f"tests/files-{uuid.uuid4().hex[:8]}/out.csv")
    S.write_external(df, loc, partition_by=["part"])
    back = S.read_external(spark, loc)
    assert rows(back.select("k", "v", "part")) == [(1, "a", "p"), (2, "b", "q")]
    seed = scratch_path(spark, f"tests/files-{uuid.uuid4().hex[:8]}/seed.csv")
    S.write_seed(df, seed, delimiter=";")
    assert rows(S.load_seed(spark, seed, {"k": "bigint"}, delimiter=";").select("k", "v")) == [(1, "a"), (2, "b")]
