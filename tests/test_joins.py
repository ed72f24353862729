"""Join helpers: literal maps, prefer-merge."""

from conftest import rows
from tidewater.operators import joins


def test_literal_map_and_prefer_merge(spark):
    m = joins.literal_frame(spark, {"BOS": "East", "LAL": "West"}, "team", "conference")
    assert rows(m) == [("BOS", "East"), ("LAL", "West")]
    left = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, v string, w string")
    right = spark.createDataFrame([(2, "B", "y"), (3, "C", None)], "k int, v string, w string")
    assert rows(joins.merge_prefer(left, right, "k", ["v", "w"])) == [(1, "a", "x"), (2, "B", "y"), (3, "C", None)]
    assert rows(joins.merge_prefer(left, right, "k", ["v", "w"], prefer="left")) == \
        [(1, "a", "x"), (2, "b", "y"), (3, "C", None)]
