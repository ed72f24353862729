"""Secret scan: the forest on held-out findings, planted secrets, redaction, edges."""

import pytest
from pyspark.sql import functions as F

from tidewater.llm import secret_scan as s

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


@pytest.fixture(scope="module")
def forest(spark):
    return s.train(spark)


def vote(tree, row):
    while not isinstance(tree, float):
        k, bound, low, high = tree
        tree = low if row[k] <= bound else high
    return tree


def test_held_out_findings(spark, forest):
    rows = (s.labelled_findings(spark, 3 * s.FINDINGS).where(F.pmod(F.hash("token"), F.lit(2)) == 0)
            .withColumn("value", s._value(F.col("token"))))
    f = s.features(F.col("token"), F.col("value"), F.col("before"))
    got = rows.select("label", F.array(*f).alias("f")).collect()
    hit = [(sum(vote(t, r.f) for t in forest) / len(forest) >= s.CUT) == (r.label > 0) for r in got]
    assert sum(hit) / len(hit) > 0.97


CASES = [
    (1, f'prose here token = "{HEX}" and more', [HEX]),
    (2, f'LOUD!! TOKEN = "{HEX.upper()}"!! MORE', [HEX.upper()]),
    (3, f'symbols### token = "{HEX}"### $$$', [HEX]),
    (4, "a card 9807915762804490 and +1 (017) 555-7713 or 97.51.17.173", []),
    (5, f"fixed in commit {HEX} yesterday", []),
    (6, "see https://www.example.com/abc/0123456789abcdef0123/index.html now", []),
    (7, "plain words only, nothing else", []),
    (8, None, []), (9, "", []), (10, " \n\t ", []), (None, f'token = "{HEX}"', [HEX]),
    (11, f'token = "{HEX}" then again token = "{HEX}"', [HEX, HEX]),
    (12, "ab " * 20000 + f'token = "{HEX}"', [HEX]), (13, "x1" * 60000, []),
]


def test_findings_and_redaction(spark, forest):
    docs = spark.createDataFrame([(i, t, "w", 5) for i, t, _ in CASES], "doc_id long, text string, word string, n_chars long")
    found = {}
    for r in s.findings(docs, forest=forest).where("is_secret").orderBy("word").collect():
        found.setdefault(r.doc_id, []).append(r.value)
    assert found == {i: v for i, _, v in CASES if v}
    clean = {r.doc_id: r for r in s.redact(docs, forest=forest).collect()}
    for i, t, values in CASES:
        want = t
        for v in values:
            want = want.replace(v, s.MARK)
        assert clean[i].text == want and clean[i].word == "w"
        assert clean[i].n_chars == (None if t is None else len(want))
    assert s.findings(docs.limit(0), forest=forest).count() == 0 and s.redact(docs.limit(0), forest=forest).count() == 0


def test_column_votes_equal_plain_votes(spark, forest):
    docs = spark.createDataFrame([(i, t) for i, t, _ in CASES], "doc_id long, text string")
    rows = s.findings(docs, forest=forest)
    f = F.array(*s.features(F.col("token"), F.col("value"), F.col("before")))
    for r in rows.select("probability", f.alias("f")).collect():
        assert r.probability == pytest.approx(round(sum(vote(t, r.f) for t in forest) / len(forest), 6))


AKIA, PATHS = "AKIA" + HEX[:16].upper(), "https://api.example.com/v1/data"
LAYOUTS = [
    ('see {"aws_secret_key":"%s"} there', [AKIA]), ('{"client_id":"0123456789abcdef0123456789abcdef","client_secret":"%s"}', [HEX]),
    ('{"token":"%s","password":"hunter2xyzq"}', [HEX, "hunter2xyzq"]), (PATHS + "?access_token=%s", [HEX]), (PATHS + "?id=7&access_token=%s&x=1", [HEX]),
    ('SECRET_KEY_2="%s"', [AKIA]), ('os.environ["API_SECRET_KEY"]="%s"', [HEX]), ("so password=%s it is", ["hunter2xyzq"]),
    ('so password="%s" it is', ["hunter2xyzq"]), ('password = "%s"', ["P@ssw0rd!2"]), ("password: %s and more", ["hunter2xyzq"]),
    ('{"password": "%s"}', ["hunter2xyzq"]), ('token = "%s"', ["kQzRvWnTbXjLmPdGhYcSfKwZ"]), ("api_key=%s,", ["kQzRvWnTbXjLmPdGhYcSfKwZ"]),
    ("%s:%s", [AKIA, HEX]),
]


def test_every_run_and_value_of_a_word_is_judged(spark, forest):
    docs = spark.createDataFrame([(i, t % tuple(v[:t.count("%s")])) for i, (t, v) in enumerate(LAYOUTS)], "doc_id long, text string")
    found = {}
    for r in s.findings(docs, forest=forest).collect():
        found.setdefault(r.doc_id, []).append((r.value, r.is_secret))
    missing = [t for i, (t, v) in enumerate(LAYOUTS) if not set(v) <= {x for x, _ in found.get(i, [])}]
    assert not missing
    secret = {i: sorted(x for x, yes in found[i] if yes) for i in found}
    wrong = [(t, v, found[i]) for i, (t, v) in enumerate(LAYOUTS) if not set(v[:1] if t == "%s:%s" else v) <= set(secret[i])]
    assert not wrong
    clean = {r.doc_id: r.text for r in s.redact(docs, forest=forest).collect()}
    assert all(x not in clean[i] for i in secret for x in secret[i])


def test_long_words_and_addresses_are_no_secrets(spark, forest):
    plain = ["an internationalization question", "see https://www.example.com/some/where/page.html?id=12345678", "password: required by the form",
             "the AbstractServiceRequestFactoryManager class", "a well-known/unknown-authors list", "access: unlimited for everyone"]
    docs = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    assert [(r.token, r.probability) for r in s.findings(docs, forest=forest).where("is_secret").collect()] == []


def test_findings_that_did_not_train(spark, forest):
    rows = s.labelled_findings(spark, s.FINDINGS, start=s.FINDINGS).withColumn("value", s._value(F.col("token")))
    f = s.features(F.col("token"), F.col("value"), F.col("before"))
    got = rows.select("label", F.array(*f).alias("f")).collect()
    hit = [(sum(vote(t, r.f) for t in forest) / len(forest) >= s.CUT) == (r.label > 0) for r in got]
    print("accuracy", len(hit), sum(hit) / len(hit))
    assert len(hit) == s.FINDINGS and sum(hit) / len(hit) > 0.97


def test_no_tail_of_a_longer_secret_is_left(spark):
    h = "a94a8fe5ccb19ba61c4c0873d391e987982fbbd3"
    text = f'token = "{h}" and secret_key = "{h}ab12cd34ef56ab78" end'
    docs = spark.createDataFrame([(1, text, "w", 7)], "doc_id long, text string, _scan_words string, _scan_found int")
    got = s.redact(docs).first()
    assert got.text == 'token = "[SECRET]" and secret_key = "[SECRET]" end'
    assert (got._scan_words, got._scan_found) == ("w", 7)


def test_credentials_in_addresses(spark):
    texts = {"use postgres://admin:S3cr3tPassw0rd9@host/db now": "use postgres://admin:[SECRET]@host/db now",
             "see https://docs.example.com/guide:intro and http://host:8080/x@y": None,
             "set amqp://user:your_password@localhost first": None}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in s.redact(docs).collect()}
    for i, (t, want) in enumerate(texts.items()):
        assert got[i] == (want or t)


def test_labelled_findings_compile(spark, capsys):
    """The rules' plan is compiled as one method of legal size, not given up after a large attempt on the driver."""
    import re

    s.labelled_findings(spark, 60).explain("codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", capsys.readouterr().out)]
    assert sizes and all(0 < x < 65_536 for x in sizes)
