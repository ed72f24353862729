"""Line-first quality cleaning (operator 10).

Every line of a text is judged on its own by punctuation, navigation and
boilerplate rules; failing lines are removed; a document is rejected when the
base measures fail or when the removed lines held too much of its text.  The
work is one narrow pass over the documents: no shuffle, whole texts, one text
in memory at a time.

Defined results: a null or empty text has no words, so ``base_failed`` is true
and ``kept`` false, its clean text is empty.  Lines without a word are dropped
from the clean text and count as nothing.  Repeated documents are judged alike.
A null id is carried through.  Only the id, the text and the columns named in
``carry`` are read; a carried column whose name clashes with a result column
loses to the result column.
"""

from __future__ import annotations

import re
from operator import eq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater.llm.common import map_slices

# fixed values of the base measures and the line rules
MIN_WORDS = 10                 # fewer words: base fails
REPEAT_PERCENT = 20            # more repeated words than this share: base fails
WINDOW = 5                     # words in a repeated window
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|>»›•·"
SYMBOL_PERCENT = 10            # symbols per word character in a line
SEPARATOR_PERCENT = 20         # separator words per word in a line
EXCLAIM_PERCENT = 10           # exclamation marks per word character in a line
CAPITAL_PERCENT = 70           # ASCII capitals per ASCII letter in a line of 20 letters or more
STUTTER_PERCENT = 40           # words equal to the word before them in a line
BOILER_PERCENT = 10            # word characters of boilerplate phrases per word character in a line
LOST_PERCENT = 50              # more removed word characters than this share: rejected
BOILERPLATE = ("licensed under", "all rights reserved", "public license", "terms of service", "terms of use",
               "privacy policy", "cookie policy", "enable javascript", "click here", "subscribe to our newsletter",
               "released under the", "permission is hereby granted")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BOILER = re.compile("|".join(BOILERPLATE), re.IGNORECASE | re.ASCII)
_CAPITAL, _SMALL = re.compile("[A-Z]+"), re.compile("[a-z]+")

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("n_lines", T.LongType()),
    T.StructField("n_removed_lines", T.LongType()), T.StructField("lost_chars", T.LongType()),
    T.StructField("clean_text", T.StringType()),
])


def repeated_words(words: list[str]) -> int:
    """Words that stand in a window of WINDOW words found twice or more in ``words``, the first place included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(grams)) == n:
        return 0
    first: dict[tuple, int] = {}
    hit = [False] * n
    for i, g in enumerate(grams):
        j = first.setdefault(g, i)
        if j != i:
            hit[i] = hit[j] = True
    covered, end = 0, 0
    for i, h in enumerate(hit):
        if h:
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
    return covered


def line_fails(line: str, words: list[str], chars: int) -> bool:
    """The punctuation, navigation and boilerplate rules for one line with words."""
    if 100 * sum(map(line.count, SYMBOLS)) > SYMBOL_PERCENT * chars:
        return True
    if 100 * line.count("!") > EXCLAIM_PERCENT * chars:
        return True
    if 100 * sum(w in SEPARATORS for w in words if len(w) == 1) >= SEPARATOR_PERCENT * len(words):
        return True
    if 100 * sum(map(eq, words, words[1:])) > STUTTER_PERCENT * len(words):
        return True
    capitals = len(line) - len(_CAPITAL.sub("", line))
    if capitals >= 20 * CAPITAL_PERCENT // 100:
        letters = capitals + len(line) - len(_SMALL.sub("", line))
        if letters >= 20 and 100 * capitals > CAPITAL_PERCENT * letters:
            return True
    phrases = _BOILER.findall(line)
    return bool(phrases) and 100 * sum(len(p) - p.count(" ") for p in phrases) >= BOILER_PERCENT * chars


def judge(text: str | None) -> tuple:
    """All result columns for one text."""
    text = text or ""
    n_words = word_chars = n_dup = n_lines = removed = lost = 0
    every: list[str] = []
    seen: set[str] = set()
    good = []
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if not words:
            continue
        chars = sum(map(len, words))
        n_lines += 1
        word_chars += chars
        every += words
        again = line in seen
        seen.add(line)
        n_dup += again
        if again or line_fails(line, words, chars):
            removed += 1
            lost += chars
        else:
            good.append(line)
    n_words = len(every)
    n_repeat = repeated_words(every)
    base = n_words < MIN_WORDS or 100 * n_repeat > REPEAT_PERCENT * n_words
    kept = not base and 100 * lost <= LOST_PERCENT * word_chars
    return (n_words, word_chars, sum(map(text.count, SYMBOLS)), n_dup, n_repeat, base, kept,
            n_lines, removed, lost, "\n".join(good))


def clean_lines(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
                results: tuple[str, ...] | None = None, prefix: str = "") -> DataFrame:
    """``carry`` columns of ``docs`` plus the result columns (all of RESULT, or those named), one row per document.

    ``prefix`` goes before the result columns' names.
    """
    wanted = [T.StructField(prefix + f.name, f.dataType) for f in RESULT.fields if results is None or f.name in results]
    names = {f.name for f in wanted}
    kept_cols = [c for c in carry if c not in names]
    place = [RESULT.fieldNames().index(f.name.removeprefix(prefix)) for f in wanted]
    read = docs.select(*[docs[c] for c in kept_cols], docs[text].alias("_judged"))
    schema = T.StructType([read.schema[c] for c in kept_cols] + wanted)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        rows = [judge(t) for t in frame["_judged"]]
        out = {c: frame[c] for c in kept_cols}
        for f, at in zip(wanted, place):
            out[f.name] = [r[at] for r in rows]
        return pd.DataFrame(out, columns=schema.fieldNames())

    return map_slices(read, lambda: one, schema)
