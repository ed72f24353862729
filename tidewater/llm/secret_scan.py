"""Secret scan with a random forest against false positives (operator 2).

DataFrame functions only.  Candidates are all long runs of a word, all its values
after a name that asks for a secret (``name=``, ``"name":``, ``["name"]=``), and
values that stand, quoted or after such a name, behind an assignment, and the password
in the ``user:password@`` of an address.  A candidate is part of one word: pass phrases
of several words are not found, and a name counts with its last 80 characters.  Each gets features: its length, character transitions and
shares, dictionary coverage, path look, and the words around it.  A random
forest trained on labelled findings removes the false positives; its trees are
read once and become one column expression, so scanning is a single narrow pass
without a shuffle, and redaction happens in the row that holds the text.

The labelled findings are a table of ``FINDINGS`` rows that Spark derives from
rules (below): credentials in their usual places, and look-alikes (digests,
commits, identifiers, card numbers, placeholders, paths, words).

Defined results: null, empty and blank texts have no findings.  A value found
several times gives one finding per word that holds it; a word may hold several.  Repeated rows give
repeated findings.  A null id is carried through.  ``findings`` reads the id and
the text only; ``redact`` replaces the text (and ``n_chars`` if there) and keeps
all other columns as they are.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import free_prefix, materialize, words_of

FINDINGS = 5600          # rows of the labelled table
TREES, DEPTH, SEED = 25, 6, 11
CUT = 0.5                # share of trees that must call a candidate a secret
MARK = "[SECRET]"

# fixed patterns
_NAME = r"""([A-Za-z_][A-Za-z0-9_.\-]{1,79})["'\])]{0,3}[=:]{1,2}"""
_LOOSE = r"""[^"'&,;<>(){}\[\]|?=:]"""
HEAD = rf"^{_NAME}"
NAMED = rf"""{_NAME}(?:["'][^"']{{8,}}["']?|{_LOOSE}{{8,}}={{0,2}})"""
LONG_RUN = r"[A-Za-z0-9][A-Za-z0-9_+/\-.]{15,}={0,2}"
ADDRESS = r"://[^\s/@:\"'<>]*:[^\s/@\"'<>]{8,}@"        # user:password@ of an address
BARE = rf"""(?:base64,)?["']?{LONG_RUN}["']?"""
QUOTED = r"""^[\"'][^\"']{8,}"""
ASSIGNED = r"[=:]$"
VALUE = r"""[A-Za-z0-9_+/\-.]{8,}={0,2}"""
DICTIONARY = ("example", "sample", "dummy", "test", "your", "here", "change", "placeholder", "insert", "token",
              "secret", "password", "key", "user", "name", "default", "value", "string", "index", "image", "file",
              "lib", "python", "site", "packages", "http", "www", "com", "state", "art", "edition", "version",
              "get", "set", "factory", "manager", "service", "request", "response", "the", "and", "for", "with",
              "this", "that", "xxxx", "1234", "abcd", "none", "null", "todo", "fixme")
ASKING = "token|secret|passw|pwd|api_?key|apikey|auth|bearer|credential|private|access|client_?secret"
HARMLESS = ("commit|sha1|sha256|sha512|md5|checksum|digest|hash|revision|uuid|guid|etag|blob|version|isbn|card|"
            "number|phone|tracking|integrity|image|build")
ISSUED = "^(AKIA|ASIA|ghp_|gho_|glpat-|sk_live_|sk-|xox[abprs]-|AIza|eyJ|npm_|pypi-)"


def _value(token: Column) -> Column:
    """The value inside a word or a part of it: without a leading ``name=`` and without quotes or marks around it."""
    rest = F.regexp_replace(token, rf"""^[^A-Za-z0-9_"']*(?:{_NAME})?(?://)?""", "")
    quoted = F.regexp_extract(rest, r"""^["']+([^"']{8,})""", 1)
    run = F.regexp_extract(F.regexp_replace(rest, "^[^A-Za-z0-9]+", ""), VALUE, 0)
    loose = F.regexp_extract(rest, rf"^{_LOOSE}{{7,}}[A-Za-z0-9]={{0,2}}", 0)
    inside = F.regexp_extract(token, r"^://[^/@:]*:([^/@]{8,})@$", 1)
    return (F.when(inside != "", inside).when(quoted != "", quoted).when(token.rlike(HEAD) & (loose != ""), loose)
            .when(run != "", run).otherwise(loose))


def _asks(name: Column) -> Column:
    return F.lower(name).rlike(ASKING)


def _parts(word: Column, previous: Column, before: Column) -> Column:
    """Array of structs (token, value): the candidates inside a word, whose ``previous`` word and words ``before`` are given."""
    shape = lambda t: F.struct(t.alias("token"), _value(t).alias("value"))
    long_run = lambda v: v.rlike(LONG_RUN)
    named = F.filter(F.transform(F.regexp_extract_all(word, F.lit(NAMED), F.lit(0)), shape),
                     lambda c: _asks(F.regexp_extract(c["token"], HEAD, 1)) | long_run(c["value"]))
    after = F.coalesce(previous.rlike(ASSIGNED), F.lit(False)) & (word.rlike(QUOTED) | _asks(before)) & ~word.rlike(NAMED)
    whole = F.when(after, F.array(shape(word))).otherwise(F.filter(F.array(shape(word)), lambda c: F.lit(False)))
    address = F.transform(F.regexp_extract_all(word, F.lit(ADDRESS), F.lit(0)), shape)
    known = F.concat(address, named, whole)
    bare = F.filter(F.transform(F.regexp_extract_all(word, F.lit(BARE), F.lit(0)),
                                lambda t: F.struct(t.alias("token"), F.regexp_extract(F.regexp_replace(t, "^base64,", ""), LONG_RUN, 0).alias("value"))),
                    lambda b: ~F.exists(known, lambda c: F.contains(c["value"], b["value"]) | (
                        F.startswith(c["token"], b["value"]) & ~b["value"].rlike("[0-9]"))))
    return F.array_distinct(F.concat(known, bare))


def _candidate_column(words: Column) -> Column:
    """Array of structs (word, token, value, before): the candidates of a text, in order."""
    at = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))

    def wanted(i):
        w = F.get(words, i)
        return w.rlike(LONG_RUN) | w.rlike(NAMED) | w.rlike(ADDRESS) | (F.coalesce(F.get(words, i - 1).rlike(ASSIGNED), F.lit(False)) & (F.length(w) >= 8))

    def inside(i):
        before = F.lower(F.concat_ws(" ", F.get(words, i - 3), F.get(words, i - 2), F.get(words, i - 1)))
        near = F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1))
        return F.transform(_parts(F.get(words, i), F.get(words, i - 1), near), lambda c: F.struct(
            i.alias("word"), c["token"].alias("token"), c["value"].alias("value"), before.alias("before")))

    return F.filter(F.flatten(F.transform(F.filter(at, wanted), inside)), lambda c: F.length(c["value"]) >= 8)


def features(token: Column, value: Column, before: Column) -> list[Column]:
    """The forest's features, all doubles, in a fixed order."""
    n = F.length(value).cast("double")
    low = F.lower(value)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    changes = F.regexp_count(value, F.lit("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"))
    own = F.lower(F.regexp_extract(token, HEAD, 1))
    near = F.concat_ws(" ", before, own)
    return [
        n,
        changes.cast("double") / n,
        F.regexp_count(value, F.lit("[0-9]")).cast("double") / n,
        F.regexp_count(value, F.lit("[A-Z]")).cast("double") / n,
        F.size(F.array_distinct(F.split(value, ""))).cast("double") / F.least(n, F.lit(32.0)),
        flag(value.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        (n - F.length(F.regexp_replace(low, "|".join(DICTIONARY), "")).cast("double")) / n,
        F.regexp_count(low, F.lit("[aeiou]")).cast("double") / n,
        flag(token.rlike(r"[/\\][A-Za-z0-9_.\-]+[/\\]|://|\.[a-z]{2,4}$")),
        flag(near.rlike(ASKING)),
        flag(near.rlike(HARMLESS)),
        flag(before.rlike(ASSIGNED) | token.rlike(HEAD)),
        flag(token.rlike("[\"']")),
        flag(value.rlike(ISSUED)),
        flag(value.rlike(r"(.)\1{3}")),
        flag(value.rlike("^[0-9]+$")),
        F.regexp_count(value, F.lit(r"[_\-./]")).cast("double") / n,
        flag(token.rlike("^://")),
    ]


def labelled_findings(spark: SparkSession, n: int = FINDINGS, start: int = 0) -> DataFrame:
    """Columns token, value-bearing context ``before``, and label (1: a credential), made from rules."""
    word = lambda salt, k: F.substring(f"word_{salt}", 1, k)
    h40, h32, h64, b64, digits, prose, tail, short, odd, letters, issued = map(F.col, (
        "h40", "h32", "h64", "b64", "digits", "prose", "tail", "short", "odd", "letters", "issued"))
    i = F.col("id").cast("string")
    # what the kinds share becomes columns, step by step: written out in each kind, the plan is too large to be compiled
    rows = (spark.range(start, start + n)
            .select("id", F.sha1(i).alias("h40"), F.md5(i).alias("h32"), F.sha2(i, 256).alias("h64"),
                    F.element_at(F.array(*[F.lit(x) for x in ("", "", "###", "%%%", "&&&", "$$$", "***", "!!", ",", ".")]),
                                 (F.pmod(F.hash(i), F.lit(10)) + 1).cast("int")).alias("tail"),
                    *[F.translate(F.md5(F.concat(i, F.lit(salt))), "0123456789", "aeioulnrst").alias(f"word_{salt}") for salt in "abcpqu"])
            .select("*", F.regexp_replace(F.base64(F.unhex("h64")), "=", "").alias("b64"),
                    F.concat_ws(" ", word("p", 6), word("q", 4)).alias("prose"),
                    F.substring(F.regexp_replace("h64", "[a-f]", ""), 1, 16).alias("digits"))
            .select("*", F.concat(word("a", 6), F.substring(digits, 1, 1), word("b", 4)).alias("short"),
                    F.concat(F.initcap(word("a", 4)), F.lit("@"), word("b", 3), F.substring(digits, 1, 1), F.lit("!"),
                             F.substring(digits, 2, 1)).alias("odd"),
                    F.translate(F.substring(b64, 1, 24), "0123456789+/", "abcdefghijkl").alias("letters"),
                    F.concat(F.lit("AKIA"), F.upper(F.substring(h40, 1, 16))).alias("issued")))
    quoted = lambda v: F.concat(F.lit('"'), v, F.lit('"'), tail)
    said = lambda *w: F.concat_ws(" ", word("p", 6), *[F.lit(x) for x in w])
    named = lambda name, v: F.concat(F.lit(name), v, F.lit('"' if name.endswith('"') else ""))
    kinds = [
        # credentials
        (said("token", "="), quoted(h40), 1), (said("TOKEN", "="), F.upper(quoted(h40)), 1),
        (said("api_key", "="), quoted(h32), 1), (said("secret:"), F.concat(F.lit("'"), b64, F.lit("'")), 1),
        (said("password", "="), quoted(F.substring(b64, 1, 16)), 1), (prose, F.concat(F.lit("AKIA"), F.upper(F.substring(h40, 1, 16))), 1),
        (said("client_secret", "="), quoted(b64), 1), (prose, F.concat(F.lit("ghp_"), F.substring(b64, 1, 36)), 1),
        (said("Authorization:", "Bearer"), F.concat(F.lit("eyJ"), b64), 1), (prose, F.concat(F.lit("auth_token="), h40, tail), 1),
        (said("access", "key"), F.concat(F.lit("sk_live_"), F.substring(b64, 1, 24)), 1),
        (said("token", "="), F.concat(F.lit('"'), h40, F.lit('"')), 1), (said("private", "token:"), F.concat(h40, tail), 1),
        (said("apikey", "="), F.concat(F.substring(b64, 1, 32), tail), 1),
        (prose, named("password=", short), 1), (prose, named('db_password="', short), 1), (said("password:"), short, 1),
        (said("password", "="), quoted(odd), 1), (prose, named("password=", odd), 1), (prose, named('SECRET_KEY_2="', issued), 1),
        (prose, named('API_SECRET_KEY"]="', h40), 1), (prose, named('client_secret":"', h40), 1),
        (prose, named('aws_secret_key":"', issued), 1), (prose, named("access_token=", b64), 1),
        (said("token", "="), quoted(letters), 1), (prose, named("secret_key=", letters), 1),
        (prose, F.concat(F.lit("://"), word("u", 5), F.lit(":"), short, F.lit("@")), 1),
        (prose, F.concat(F.lit("://"), word("u", 5), F.lit(":"), F.substring(b64, 1, 14), F.lit("@")), 1),
        (said("url", "="), F.concat(F.lit("://"), word("u", 5), F.lit(":"), odd, F.lit("1@")), 1),
        # look-alikes
        (prose, F.concat(F.lit("://"), word("u", 5), F.lit(":password@")), 0), (prose, F.lit("://user:your_password@"), 0),
        (prose, F.concat(F.lit("://"), word("u", 5), F.lit(":changeme_"), word("a", 3), F.lit("@")), 0),
        (said("password:"), word("a", 10), 0), (prose, named("password=", word("a", 9)), 0), (prose, named('client_id":"', h32), 0),
        (prose, F.concat_ws("_", word("a", 7), word("b", 6), word("c", 5)), 0), (prose, named("commit=", h40), 0),
        (prose, F.concat(*[F.initcap(word(k, 6)) for k in "abc"]), 0), (prose, word("a", 20), 0),
        (prose, F.upper(F.concat_ws("_", word("a", 6), F.lit("KEY"), F.substring(digits, 1, 1), word("b", 8))), 0),
        (prose, F.concat(F.lit("https://api.example.com/v1/"), word("u", 8)), 0), (prose, F.concat(F.lit("base64,"), b64), 0),
        (prose, F.concat_ws("-", word("a", 8), word("b", 6), word("c", 7)), 0), (prose, F.concat(word("a", 9), F.lit("/"), word("b", 9)), 0),
        (prose, named('password="', F.concat(F.lit("changeme_"), word("a", 4))), 0), (said("token:"), F.concat_ws("_", word("a", 6), word("b", 6)), 0),
        (said("commit"), h40, 0), (said("md5", "checksum"), h32, 0), (said("sha256", "digest:"), h64, 0),
        (prose, F.concat_ws("-", F.substring(h32, 1, 8), F.substring(h32, 9, 4), F.substring(h32, 13, 4), F.substring(h32, 17, 12)), 0),
        (prose, F.concat(digits, tail), 0), (said("card", "number"), digits, 0),
        (said("token", "="), quoted(F.concat(F.lit("your_token_here_"), F.substring(digits, 1, 4))), 0),
        (said("password", "="), quoted(F.concat(F.lit("changeme_example_"), F.substring(digits, 1, 2))), 0),
        (prose, F.concat(F.lit("https://www.example.com/"), word("u", 6), F.lit("/"), h32, F.lit("/index.html")), 0),
        (said("integrity"), F.concat(F.lit("sha512-"), b64), 0),
        (said("version"), F.concat(F.lit("2023"), F.substring(digits, 1, 10), F.lit("-"), F.substring(h40, 1, 12)), 0),
        (prose, F.concat_ws("-", word("a", 5), F.lit("of"), F.lit("the"), word("b", 6), F.substring(digits, 1, 4), F.lit("edition")), 0),
        (said("api_key", "="), quoted(F.concat(F.lit("xxxxxxxxxxxxxxxx"), F.substring(digits, 1, 4))), 0),
        (prose, F.concat(F.lit("/usr/lib/python3/site-packages/"), word("a", 7), F.lit("_"), word("b", 5)), 0),
        (prose, F.concat(F.lit("getUser"), F.initcap(word("a", 6)), F.lit("By"), F.initcap(word("b", 7)), F.lit("2Factory")), 0),
        (prose, h40, 0), (said("blob"), F.concat(F.lit("data:image/png;base64,"), b64), 0),
        (said("tracking", "number:"), F.concat(digits, F.substring(digits, 1, 6)), 0),
    ]
    at = F.col("id") % len(kinds)
    pick = lambda k: F.coalesce(*[F.when(at == j, kind[k] if k < 2 else F.lit(float(kind[2]))) for j, kind in enumerate(kinds)])
    return rows.select(F.lower(pick(0)).alias("before"), pick(1).alias("token"), pick(2).alias("label"))


def train(spark: SparkSession) -> list:
    """Fit the forest; returns its trees as nested (feature, threshold, left, right) or a vote 0.0 / 1.0.

    Findings and features are written and read again, in one file that keeps their order: each job of the fit
    then has a plan of one scan, and the driver compiles the rules and the patterns once.
    """
    rows = materialize(labelled_findings(spark).withColumn("value", _value(F.col("token"))).coalesce(1), "secret-findings")
    rows = rows.select("label", *[c.alias(f"f{k}") for k, c in
                                  enumerate(features(F.col("token"), F.col("value"), F.col("before")))])
    rows = materialize(rows.coalesce(1), "secret-features")
    names = rows.columns[1:]
    data = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features").coalesce(1)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64).fit(data)
    return [_tree(t.toDebugString) for t in forest.trees]


def _tree(described: str):
    """Nested splits out of a tree's printed form (If / Else / Predict lines)."""
    lines = iter([x.strip() for x in described.splitlines()[1:] if x.strip()])

    def node():
        line = next(lines)
        if line.startswith("Predict"):
            return float(line.split(":")[1])
        feature, bound = re.match(r"If \(feature (\d+) <= ([-0-9.eE]+)\)", line).groups()
        low = node()
        next(lines)                        # the Else line
        return (int(feature), float(bound), low, node())

    return node()


def _vote(tree, f) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    k, bound, low, high = tree
    return F.when(f(k) <= bound, _vote(low, f)).otherwise(_vote(high, f))


def probability(forest: list, f) -> Column:
    """Share of the trees that vote for a secret; ``f(k)`` gives feature k."""
    total = F.lit(0.0)
    for tree in forest:
        total = total + _vote(tree, f)
    return F.round(total / len(forest), 6)


def _scored(words: Column, forest: list) -> Column:
    """Array of structs (word, token, value, before, probability) of a text whose words are ``words``."""
    shaped = F.transform(_candidate_column(words), lambda c: F.struct(
        c["word"].alias("word"), c["token"].alias("token"), c["value"].alias("value"), c["before"].alias("before"),
        F.array(*features(c["token"], c["value"], c["before"])).alias("f")))
    return F.transform(shaped, lambda c: F.struct(
        c["word"].alias("word"), c["token"].alias("token"), c["value"].alias("value"), c["before"].alias("before"),
        probability(forest, lambda k: F.get(c["f"], F.lit(k))).alias("probability")))


def _holds_candidate(text: Column) -> Column:
    """Whether a text can hold a candidate at all; most texts are left alone after this one look."""
    return F.coalesce(text.rlike(LONG_RUN) | (F.contains(text, F.lit("://")) & text.rlike(ADDRESS)) | text.rlike(rf"""[=:][\x20\x09-\x0D]+[\"'][^\"']{{8}}""")
                      | text.rlike(rf"""(?i)(?:{ASKING})[^\x20\x09-\x0D=:]{{0,80}}[=:]""")
                      | text.rlike(rf"""(?i)(?:{ASKING})[^\x20\x09-\x0D]*[\x20\x09-\x0D]+[=:]"""), F.lit(False))


def findings(docs: DataFrame, id_col: str = "doc_id", text: str = "text", forest: list | None = None) -> DataFrame:
    """One row per candidate: ``id_col``, word, token, value, before, probability, is_secret."""
    forest = forest or train(docs.sparkSession)
    t = docs.select(docs[id_col], docs[text].alias("_t")).where(_holds_candidate(F.col("_t")))
    cut = t.select(id_col, words_of(F.col("_t")).alias("_w"))
    return (cut.select(id_col, F.explode(_scored(F.col("_w"), forest)).alias("c"))
            .select(id_col, "c.word", "c.token", "c.value", "c.before", "c.probability",
                    (F.col("c.probability") >= CUT).alias("is_secret")))


def redact(docs: DataFrame, text: str = "text", forest: list | None = None) -> DataFrame:
    """``docs`` with every value that the forest calls a secret replaced by MARK in its text."""
    forest = forest or train(docs.sparkSession)
    prefix = free_prefix(docs.columns, "_scan_")
    words, cands = f"{prefix}words", f"{prefix}found"
    looked = docs.withColumn(words, F.when(_holds_candidate(docs[text]), words_of(docs[text])))
    scored = looked.withColumn(cands, F.when(F.col(words).isNotNull(), F.array_distinct(F.transform(
        F.filter(_scored(F.col(words), forest), lambda c: c["probability"] >= CUT),
        lambda c: c["value"])))).drop(words)
    # longest first: a value that is part of another one must not hide it
    ordered = F.reverse(F.array_sort(F.transform(cands, lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))))
    clean = F.when(F.size(F.coalesce(F.col(cands), F.array().cast("array<string>"))) > 0,
                   F.aggregate(ordered, F.col(text), lambda t, c: F.replace(t, c["v"], F.lit(MARK)))).otherwise(F.col(text))
    out = scored.withColumn(text, clean).drop(cands)
    return out.withColumn("n_chars", F.length(text).cast("long")) if "n_chars" in docs.columns else out
