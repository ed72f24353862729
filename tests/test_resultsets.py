"""JSON result-set payloads: all shapes, name fallback, duplicate headers, malformed text."""

from pyspark.sql import functions as F

from conftest import rows
from tidewater.sources import resultsets as R


def _payloads(spark, items):
    return spark.createDataFrame(items, "payload_id bigint, payload string")


SHAPES = [
    (1, '{"resultSets":[{"name":"Other","headers":["A"],"rowSet":[["z"]]},'
        '{"name":"Main","headers":["GAME_ID","W/L %","PTS"],"rowSet":[["001",0.5,10],["002",null,"7"]]}]}'),
    (2, '{"resultSets":{"headers":["GAME_ID","W/L %","PTS"],"rowSet":[["003",1,3]]}}'),
    (3, '{"resultSet":{"headers":["GAME_ID","W/L %","PTS"],"rowSet":[["004",0,1]]}}'),
    (4, "{}"),
    (5, '{"resultSets": [ {"name": '),
]


def test_all_shapes_and_quarantine(spark):
    rs, bad = R.decode_payloads(_payloads(spark, SHAPES), name="Main")
    table = R.rows_to_table(rs, types={"pts": "bigint", "w_l": "double"})
    assert table.columns == ["game_id", "w_l", "pts"]
    assert rows(table) == [("001", 0.5, 10), ("002", None, 7), ("003", 1.0, 3), ("004", 0.0, 1)]
    assert [r["payload_id"] for r in bad.collect()] == [5]


def test_missing_name_falls_back_unless_strict(spark):
    p = _payloads(spark, SHAPES[:1])
    rs, _ = R.decode_payloads(p, name="Absent", index=0)
    assert rows(R.rows_to_table(rs)) == [("z",)]
    strict, _ = R.decode_payloads(p, name="Absent", strict=True)
    assert strict.count() == 0


def test_duplicate_headers_are_suffixed(spark):
    p = _payloads(spark, [(1, '{"resultSet":{"headers":["PTS","Pts","PTS"],"rowSet":[[1,2,3]]}}')])
    rs, _ = R.decode_payloads(p)
    t = R.rows_to_table(rs)
    assert t.columns == ["pts", "pts_1", "pts_2"] and rows(t) == [("1", "2", "3")]
    df = spark.createDataFrame([(["W/L%", "Team Name", "", "Team-Name"],)], "h array<string>")
    assert df.select(R.normalize_names_col(F.col("h"))).first()[0] == ["w_l", "team_name", "unknown", "team_name_1"]
    auto = R.rows_to_table(rs)                      # columns from the distinct header lists
    assert auto.columns == ["pts", "pts_1", "pts_2"]


def test_lineage_tags(spark):
    df = R.tag_lineage(spark.createDataFrame([(1,)], "x int"), "2026", "Playoffs")
    assert rows(df) == [(1, "2026", "2025-26", "Playoffs")]
