"""Mixing sources to target weights by raking (operator 3).

DataFrame functions work on the rows.  Tokens are summed per cell (source, language, topic).
Iterative proportional fitting scales the cells until their sums meet the target
shares of every source, every language and every topic in turn.  A cell's raked
weight over its own share gives its documents' sampling probability, calibrated
by one scale so that the expected tokens are ``fraction`` of all (a probability
stops at 1, the scale makes up for it).  A document is drawn when a uniform
number from a digest of its id lies below its probability.

Only one narrow pass reads texts; raking works on the cells, one row per
combination, however many documents a source has.  A hot source is pre-aggregated
in the map tasks, and its rows meet the small cell table.  A text's tokens are its
words.  Up to ``CELLS`` cells are raked as arrays on the driver, which needs no jobs; more
of them stay in Spark, where a dimension's sums are aggregates that are joined back to the
cells, so millions of cells of one language are no one task's.  Both follow the same rounds.
Raking goes on until every sum is within ``TOLERANCE`` of its target, or until a round brings hardly anything because
no weights of the cells there are meet all targets; ``deviations`` says what is left.

Targets: per dimension either shares given by name (names that are missing get
the remaining share in proportion to their tokens; if nothing remains, as little
as ``FLOOR`` of their own share), or tempered shares, tokens ** alpha.

Defined results: null sources, languages and texts count as ''; an empty or blank
text has no tokens, weight 1 and the probability of its cell; an empty table gives
an empty result; repeated rows with one id are drawn together.  ``mix`` reads four
columns; ``draw`` keeps the columns of the table as they are, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import free_prefix, materialize, words_of

DIMENSIONS = ("source", "lang", "topic")
ALPHA = {"source": 0.5, "lang": 0.7, "topic": 0.7}
FRACTION = 0.6            # of all tokens, expected in the sample
TOLERANCE = 1e-9          # largest difference of a raked share from its target
STALLED = 0.99            # a round that leaves more than this part of the difference is the last
MAX_ROUNDS = 40           # of raking over all dimensions
SCALE_STEPS = 12          # of calibrating the scale
FLOOR = 1e-6
CELLS = 20_000            # cells that are raked on the driver; the rounds of more of them are Spark's

# the default topics, fixed patterns tried in this order, each with marks one of which a match holds
TOPICS = (("licence", ("licensed under", "public license"), None),
          ("contact", ("@",), r"[a-z0-9.]+@[a-z0-9]+[.][a-z]+"),
          ("contact", ("+",), r"[+][0-9]+ [(][0-9]+[)]"),
          ("table", (" | ",), r"[^ ]+ [|] [^ ]+ [|] [^ ]+"),
          ("markup", ("###", "$$$", "%%%", "&&&"), None))
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    """The first topic whose pattern is in the text; patterns run only where a mark is.  Licences in any case."""
    out = F.lit(OTHER_TOPIC)
    for name, marks, pattern in reversed(TOPICS):
        where = F.lower(text) if name == "licence" else text
        holds = F.lit(False)
        for mark in marks:
            holds = holds | F.contains(where, F.lit(mark))
        out = F.when(holds & text.rlike(pattern) if pattern else holds, name).otherwise(out)
    return out


def tokens_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def uniform(id_col: Column) -> Column:
    """A number in [0, 1) that only the id decides."""
    digest = F.md5(F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _described(docs: DataFrame, text: str, prefix: str) -> DataFrame:
    """``docs`` with source, lang, topic and tokens under names that begin with ``prefix``."""
    t = F.coalesce(docs[text], F.lit(""))
    return docs.select("*", F.coalesce(docs["source"].cast("string"), F.lit("")).alias(f"{prefix}source"),
                       F.coalesce(docs["lang"].cast("string"), F.lit("")).alias(f"{prefix}lang"),
                       topic_of(t).alias(f"{prefix}topic"), tokens_of(t).alias(f"{prefix}tokens"))


def targets(cells: DataFrame, dim: str, shares: dict[str, float] | None) -> DataFrame:
    """(name, target): the share of all tokens that each name of a dimension shall have."""
    per = cells.groupBy(F.col(dim).alias("name")).agg(F.sum("tokens").cast("double").alias("t"))
    if shares is None:
        per = per.withColumn("u", F.pow("t", F.lit(ALPHA[dim])))
    else:
        given = F.coalesce(*[F.when(F.col("name") == k, F.lit(float(v))) for k, v in shares.items()], F.lit(None).cast("double"))
        rest = max(1.0 - sum(shares.values()), FLOOR)
        per = per.withColumn("g", given)
        free = per.agg(F.sum(F.when(F.col("g").isNull(), F.col("t"))).alias("f")).first().f or 1.0
        per = per.withColumn("u", F.coalesce("g", F.col("t") / F.lit(free) * F.lit(rest)))
    total = per.agg(F.sum("u").alias("s")).first().s or 1.0
    return per.select("name", (F.col("u") / F.lit(total)).alias("target"))


def deviations(cells: DataFrame, goals: dict[str, DataFrame]) -> dict[str, float]:
    """Per dimension the largest difference of a share (sum of ``w``) from its target."""
    out = None
    for dim, goal in goals.items():
        sums = cells.groupBy(F.col(dim).alias("name")).agg(F.sum("w").alias("s")).join(goal, "name")
        one = sums.agg(F.max(F.abs(F.col("s") - F.col("target"))).alias("d")).select(F.lit(dim).alias("dim"), "d")
        out = one if out is None else out.unionByName(one)
    return {r.dim: r.d or 0.0 for r in out.collect()}


def _goes_on(now: float, before: float, tolerance: float) -> bool:
    return now > tolerance and now <= STALLED * before


def _raked_few(table: pa.Table, goals: dict[str, DataFrame], tolerance: float, rounds: int) -> np.ndarray:
    """What ``rake`` gives, of cells that fit an array."""
    places, wanted = [], []
    for dim, goal in goals.items():
        names = table.column(dim).combine_chunks().dictionary_encode()
        target = {r.name: r.target for r in goal.collect()}
        places.append(names.indices.to_numpy())
        wanted.append(np.array([target[name] for name in names.dictionary.to_pylist()]))
    w, before = table.column("tokens").to_numpy().astype(np.float64), float("inf")
    for _ in range(rounds if len(w) else 0):
        now = 0.0
        for place, target in zip(places, wanted):
            sums = np.bincount(place, weights=w, minlength=len(target))
            w = w * np.divide(target, sums, out=np.zeros(len(target)), where=sums > 0)[place]
            now = max(now, float(np.abs(sums - target).max()))
        if not _goes_on(now, before, tolerance):
            break
        before = now
    return w


def rake(cells: DataFrame, goals: dict[str, DataFrame], tolerance: float = TOLERANCE, rounds: int = MAX_ROUNDS) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``w``: shares that meet the goals of every dimension in turn.

    In Spark a cell carries the largest difference that its names' sums had from their targets
    in the round, so one look at the written cells tells whether to go on.
    """
    table = cells.limit(CELLS + 1).toArrow()
    if len(table) <= CELLS:
        few = table.append_column("w", pa.array(_raked_few(table, goals, tolerance, rounds)))
        return cells.sparkSession.createDataFrame(few, T.StructType([*cells.schema.fields, T.StructField("w", T.DoubleType())]))
    cur, before = cells.withColumn("w", F.col("tokens").cast("double")), float("inf")
    for _ in range(rounds):
        cur = cur.select(*cells.columns, "w", F.lit(0.0).alias("off"))
        for dim, goal in goals.items():
            sums = cur.groupBy(F.col(dim).alias("name")).agg(F.sum("w").alias("s")).join(goal, "name")
            factor = sums.select(F.col("name").alias(dim), F.when(F.col("s") > 0, F.col("target") / F.col("s")).otherwise(0.0).alias("factor"),
                                 F.abs(F.col("s") - F.col("target")).alias("e"))
            cur = cur.join(factor, dim).select(*cells.columns, (F.col("w") * F.col("factor")).alias("w"), F.greatest("off", "e").alias("off"))
        cur = materialize(cur, "mixing-raked")
        now = cur.agg(F.max("off").alias("o")).first().o or 0.0
        if not _goes_on(now, before, tolerance):
            break
        before = now
    return cur.select(*cells.columns, "w")


def cell_probabilities(cells: DataFrame, fraction: float, shares: dict[str, dict[str, float]] | None) -> DataFrame:
    """``cells`` with ``weight`` (raked share over own share) and ``probability``."""
    shares = shares or {}
    goals = {d: materialize(targets(cells, d, shares.get(d)), f"mixing-{d}") for d in DIMENSIONS}
    total = cells.agg(F.sum("tokens").alias("t")).first().t or 0
    raked = rake(cells, goals)
    ratio = F.when(F.col("tokens") > 0, F.col("w") * F.lit(float(total)) / F.col("tokens")).otherwise(1.0)
    weighed = materialize(raked.withColumn("weight", ratio), "mixing-cells")
    scale = float(fraction)
    for _ in range(SCALE_STEPS):      # grows to its fixed point in a few steps
        clipped = F.col("weight") * F.lit(scale) >= 1
        got = weighed.agg(F.sum(F.when(clipped, F.col("tokens")).otherwise(0)).alias("full"),
                          F.sum(F.when(clipped, 0.0).otherwise(F.col("tokens") * F.col("weight"))).alias("open")).first()
        if not got.open:
            break
        new = (fraction * total - got.full) / got.open
        if new <= scale:
            break
        scale = new
    return weighed.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))


def _cells(described: DataFrame, prefix: str) -> DataFrame:
    return materialize(described.groupBy(*[F.col(f"{prefix}{d}").alias(d) for d in DIMENSIONS])
                       .agg(F.sum(f"{prefix}tokens").alias("tokens")), "mixing-counts")


def _with_probability(described: DataFrame, cells: DataFrame, prefix: str) -> DataFrame:
    c = cells.select(*[F.col(d).alias(f"{prefix}cell_{d}") for d in DIMENSIONS], F.round("weight", 6).alias(f"{prefix}weight"),
                     F.round("probability", 6).alias(f"{prefix}probability"))
    on = [F.col(f"{prefix}{d}") == F.col(f"{prefix}cell_{d}") for d in DIMENSIONS]
    return described.join(c, on)


def mix(docs: DataFrame, fraction: float = FRACTION, shares: dict | None = None, id_col: str = "doc_id",
        text: str = "text") -> DataFrame:
    """One row per document: id, source, lang, topic, tokens, weight, probability, sampled."""
    p = "_mix_"
    described = _described(docs.select(docs[id_col].alias("id"), docs[text].alias("text"), "source", "lang"), "text", p)
    narrow = materialize(described.select("id", *[f"{p}{d}" for d in DIMENSIONS], f"{p}tokens"), "mixing-docs")
    both = _with_probability(narrow, cell_probabilities(_cells(narrow, p), fraction, shares), p)
    return both.select(F.col("id").alias(id_col), *[F.col(f"{p}{d}").alias(d) for d in DIMENSIONS],
                       F.col(f"{p}tokens").alias("tokens"), F.col(f"{p}weight").alias("weight"),
                       F.col(f"{p}probability").alias("probability"),
                       (uniform(F.col("id")) < F.col(f"{p}probability")).alias("sampled"))


def draw(docs: DataFrame, fraction: float = FRACTION, shares: dict | None = None, id_col: str = "doc_id",
         text: str = "text") -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    p = free_prefix(docs.columns, "_mix_")
    described = _described(docs, text, p)
    both = _with_probability(described, cell_probabilities(_cells(described, p), fraction, shares), p)
    return both.where(uniform(F.col(id_col)) < F.col(f"{p}probability")).select(*docs.columns)
