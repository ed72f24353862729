"""Mixing: raked sums meet the targets, the scale meets the fraction, edges."""

import pytest
from pyspark.sql import functions as F

from tidewater.llm import mixing as m


def docs(spark):
    rows = []
    for i in range(600):
        rows.append((i, "word " * (5 + i % 40) + ("| a | b | c" if i % 5 == 0 else ""), f"s{i % 3 if i % 2 else 0}", ["en", "fr"][i % 7 == 0], "t"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")


def test_targets_and_fraction(spark):
    shares = {"lang": {"en": 0.5, "fr": 0.5}}
    got = m.mix(docs(spark), fraction=0.3, shares=shares)
    total = got.agg(F.sum("tokens")).first()[0]
    raked = {r.lang: r.w for r in got.groupBy("lang").agg((F.sum(F.col("tokens") * F.col("weight")) / total).alias("w")).collect()}
    assert raked["en"] == pytest.approx(0.5, abs=2e-3) and raked["fr"] == pytest.approx(0.5, abs=2e-3)
    expected = got.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0]
    assert expected == pytest.approx(0.3 * total, rel=1e-3)
    drawn = got.where("sampled").agg(F.sum("tokens")).first()[0]
    assert drawn == pytest.approx(0.3 * total, rel=0.25)
    assert got.count() == 600 and got.agg(F.max("probability")).first()[0] <= 1


def test_edges(spark):
    rows = [(1, None, None, None, "x"), (2, "", "s", "en", "x"), (2, "", "s", "en", "x"), (None, "a b c", "s", None, "x"),
            (3, "a " * 50000, "s", "en", "x")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, weight string")
    got = m.mix(odd).collect()
    assert len(got) == 5 and all(0 <= r.probability <= 1 for r in got)
    assert [r.tokens for r in got if r.doc_id == 1] == [0]
    twice = [r.sampled for r in got if r.doc_id == 2]
    assert twice[0] == twice[1]
    kept = m.draw(odd)
    assert kept.columns == odd.columns and kept.count() <= 5
    assert m.mix(odd.limit(0)).count() == 0 and m.draw(odd.limit(0)).count() == 0


def test_words_are_counted_and_topics_are_patterns(spark):
    texts = {"\n\n\n": (0, "prose"), "\t\t": (0, "prose"), "a\tb\tc": (3, "prose"), "  a   b ": (2, "prose"), "call +49 (30) now": (4, "contact"),
             "at @ home": (3, "prose"), "me x1@mail.org": (2, "contact"), "LICENSED UNDER x": (3, "licence"), "a | b": (3, "prose"),
             "a | b | c": (5, "table"), "x ### y": (3, "markup"), "": (0, "prose")}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.n, r.topic) for r in df.select("t", m.tokens_of(df.t).alias("n"), m.topic_of(df.t).alias("topic")).collect()}
    assert got == texts


def test_sql_has_the_same_rules(spark, tmp_path):
    import duckdb

    from tidewater.llm import queries_sql
    rows = [(i, t, f"s{i // 12 % 4}", ["en", None, "de"][i // 48]) for i, t in enumerate(
        ["a\tb\tc", "\n\n", None, "", "call +49 (30) 1", "LICENSED UNDER x", "me x1@mail.org", "a @ b", "p | q", "p | q | r", "x $$$ y", "plain words here"] * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = sorted(con.sql(queries_sql.MIXING).fetchall())
    assert sorted(map(tuple, m.mix(docs).collect())) == want


def test_raking_ends_at_the_targets(spark):
    cells = spark.createDataFrame([(f"s{i % 3}", f"l{i // 3 % 3}", f"t{i // 9}", 10 + i * i % 7) for i in range(18)],
                                  "source string, lang string, topic string, tokens long")
    goals = {d: m.targets(cells, d, None) for d in m.DIMENSIONS}
    raked = m.rake(cells, goals)
    assert max(m.deviations(raked, goals).values()) <= m.TOLERANCE
    # targets that no weights meet (one cell holds both names): it ends, and says so
    two = spark.createDataFrame([("a", "x", "t", 5), ("b", "y", "t", 5)], "source string, lang string, topic string, tokens long")
    apart = {"source": m.targets(two, "source", {"a": 0.9}), "lang": m.targets(two, "lang", {"x": 0.2})}
    assert max(m.deviations(m.rake(two, apart, rounds=3), apart).values()) > 0.1


def test_clashing_names(spark):
    odd = docs(spark).limit(40).selectExpr("*", "'q' as _source", "1 as _mix_topic", "2 as _mix__cell_lang", "3 as _tokens")
    kept = m.draw(odd)
    assert kept.columns == odd.columns and {r._source for r in kept.collect()} <= {"q"}


def test_few_cells_need_no_jobs_and_many_give_the_same(spark, monkeypatch):
    cells = m._cells(m._described(docs(spark), "text", "_p_"), "_p_")
    goals = {d: m.materialize(m.targets(cells, d, None), f"test-{d}") for d in m.DIMENSIONS}
    rows = lambda df: {tuple(r[:3]): (r.tokens, r.w) for r in df.collect()}
    written = []
    monkeypatch.setattr(m, "materialize", lambda df, name, real=m.materialize: (written.append(name), real(df, name))[1])
    few = rows(m.rake(cells, goals))
    assert not written                     # a round used to write a table of joins
    monkeypatch.setattr(m, "CELLS", 3)
    many = rows(m.rake(cells, goals))
    assert len(written) > 1 and few.keys() == many.keys() and len(few) > 3
    for k, (tokens, w) in many.items():
        assert few[k][0] == tokens and few[k][1] == pytest.approx(w, rel=1e-9)
