"""Quality rules: base measures by brute force, line rules, and the defined edge cases."""

import re

from pyspark.sql import types as T

from tidewater.llm import quality_rules as q

PROSE = "The quick brown fox jumps over the lazy dog near the river bank."
SCHEMA = "doc_id long, text string, kept string, n_words string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
            len(words) < 10 or 100 * len(covered) > 20 * len(words))


TEXTS = [None, "", " \t\n\x0b", "one two", PROSE, "\n".join([PROSE] * 3), PROSE + "\n" + "a b c d e " * 3,
         "x y z w v " * 40, "Home | About | Contact | Help | Login | More\n" + PROSE, "word### next$$$ this%%% that&&& " * 8,
         "THIS IS A VERY LOUD LINE!! WITH NO END!! AT ALL!! SAYS EVERYONE!!\n" + PROSE + " " + PROSE[4:],
         "a b c d e f g h i j k l", "nul\x00byte " + PROSE, PROSE * 400,
         "Licensed under the Apache License, Version 2.0.\n" + PROSE + "\n" + "And then another sentence follows it here."]


def test_measures_match_brute_force():
    for t in TEXTS:
        assert q.judge(t)[:6] == brute(t), t and t[:60]


def test_verdicts():
    kept = lambda t: q.judge(t)[6]
    assert kept(PROSE) and kept(TEXTS[-1]) and not kept(None) and not kept("")
    assert not kept("Home | About | Contact | Help | Login | More | Again | Even | More")
    assert not kept("word### next$$$ this%%% that&&& one### two$$$ three%%% four&&& five### six$$$ seven%%%")
    assert not kept("This This This That That That one one one two two two") and kept(PROSE + " " + PROSE[4:].upper()[:9])
    assert q.judge(TEXTS[-1])[-1].startswith("The quick") and "Licensed" not in q.judge(TEXTS[-1])[-1]


def test_operator_edges(spark):
    rows = [(i, t, "theirs", "theirs") for i, t in enumerate(TEXTS)] + [(None, PROSE, "x", "x"), (4, PROSE, "x", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = q.clean_lines(docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), *q.judge(r[1])) for r in rows)
    assert sorted((str(g[0]), *g[1:]) for g in got) == want
    carried = q.clean_lines(docs, carry=tuple(docs.columns), results=("kept",), prefix="_q_")
    assert carried.columns == [*docs.columns, "_q_kept"] and carried.count() == len(rows)
    assert q.clean_lines(docs.limit(0)).count() == 0
    assert isinstance(q.clean_lines(docs).schema["kept"].dataType, T.BooleanType)


def test_a_phrase_does_not_fail_a_long_line():
    words = [f"{a}{b}" for a in ("river", "stone", "cloud", "field", "house") for b in ("side", "work", "land", "mark", "ward", "line")]
    body = " ".join(f"The {a} lies {i} steps from the {b}." for i, (a, b) in enumerate(zip(words, reversed(words))))
    for phrase in ("click here", "terms of service", "Privacy Policy", "released under the"):
        text = f"{body} To read the {phrase} is up to you. {body.upper().lower().replace('steps', 'miles')}"
        got = q.judge(text)
        assert got[6] and got[8:10] == (0, 0) and got[-1] == text
    assert all(q.line_fails(x, x.split(), len(x.replace(" ", ""))) for x in (
        "click here", "Please click here to go on with the next of all our many pages", "Read our privacy policy and the terms of use"))


def test_sql_takes_a_phrase_by_its_share_of_the_line(spark, tmp_path):
    import duckdb

    from tidewater.llm import queries_sql
    from tidewater.llm.quality_rules import clean_lines
    lines = [" ".join(f"word{i}x" for i in range(n)) + " Click HERE" for n in (1, 5, 10, 11, 12, 13, 14, 20, 540)]
    rows = [(i, line) for i, line in enumerate(lines)] + [(50 + i, line + "\n" + "fine words of a line that is kept " + str(i)) for i, line in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    rel = con.sql(queries_sql.QUALITY_RULES)
    got = clean_lines(docs, results=tuple(c for c in rel.columns if c != "doc_id")).select(*rel.columns).collect()
    want = sorted(rel.fetchall())
    assert sorted(map(tuple, got)) == want
    assert {r[rel.columns.index("lost_chars")] > 0 for r in want} == {True, False}
