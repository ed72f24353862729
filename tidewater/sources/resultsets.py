"""Landed JSON API responses -> tables.

A response holds one or more result sets as ``headers`` + ``rowSet`` in one of
three shapes (``resultSets`` list, ``resultSets`` object, ``resultSet``
object; anything else has no rows).  ``from_json`` decodes all three with
cells read as text, malformed payloads are split off into a quarantine, and
``explode`` turns rows into records keyed by normalised header names.
Everything runs JVM-side; only the names of the output columns reach the
driver, and only when the caller does not give them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.exprs import season_label

_SET = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StringType())),
    T.StructField("rowSet", T.ArrayType(T.ArrayType(T.StringType()))),
])
# Outer parse: the two possible members as raw JSON text, plus malformed input.
_OUTER = T.StructType([T.StructField("resultSets", T.StringType()), T.StructField("resultSet", T.StringType()),
                       T.StructField("_corrupt", T.StringType())])


# Fixed patterns of the name rule: non-word characters, runs of whitespace
# (``(?U)``: Unicode classes, as in the loader's own rule).
NON_WORD = r"(?U)[^\w\s]"
WHITESPACE_RUN = r"(?U)\s+"


def snake_case_col(c: Column) -> Column:
    """S3 name rule: non-word characters become spaces, whitespace runs
    become ``_``, lower case; an empty result is ``'unknown'``."""
    s = F.regexp_replace(c, NON_WORD, " ")
    s = F.lower(F.regexp_replace(F.trim(s), WHITESPACE_RUN, "_"))
    return F.when(s == "", F.lit("unknown")).otherwise(s)


def _numbered_names(base: Column) -> Column:
    """Repeated names get ``_1``, ``_2``, ... in order."""
    def dedupe(x, i):
        seen = F.size(F.filter(F.slice(base, 1, i), lambda y: y == x))
        return F.when(seen == 0, x).otherwise(F.concat(x, F.lit("_"), seen.cast("string")))

    return F.transform(base, dedupe)


def normalize_names_col(headers: Column) -> Column:
    """S3 as a column expression over an array of header names."""
    return _numbered_names(F.transform(headers, lambda h: snake_case_col(h)))


def decode_payloads(payloads: DataFrame, payload_col: str = "payload", id_col: str = "payload_id",
                    name: str | None = None, index: int = 0, strict: bool = False,
                    columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """S2 + S22: ``(rows, quarantine)``.

    With ``columns``, ``rows`` is ``(payload_id, row_no, cells)`` with the cells in
    that order: where each column stands is found once per payload, before its rows
    are exploded, and no header travels with a row.  Without, it is
    ``(payload_id, headers, names, row_no, cells)`` of the chosen result
    set of each payload (by ``name``, else position ``index``; a missing
    name falls back to ``index`` unless ``strict``).  ``quarantine``: the
    payloads that are not valid JSON objects, with the raw text.
    """
    raw = F.col(payload_col)
    outer = F.from_json(raw, _OUTER, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    p = payloads.select(F.col(id_col).alias("payload_id"), raw.alias("_raw"), outer.alias("_o"))
    valid = F.col("_o._corrupt").isNull() & F.col("_raw").isNotNull()
    quarantine = p.filter(~valid).select("payload_id", F.col("_raw").alias("payload"),
                                         F.lit("malformed json").alias("error"))
    # Inner parse: only the member that is present, with the schema of its shape.
    text = F.ltrim(F.col("_o.resultSets"))
    is_list = text.startswith("[")
    sets = F.from_json(F.when(is_list, text), T.ArrayType(_SET))
    single = F.from_json(F.coalesce(F.when(~is_list, text), F.col("_o.resultSet")), _SET)
    if name is not None:
        named = F.filter(sets, lambda s: s["name"] == F.lit(name))
        by_name = F.get(named, 0)
        chosen_list = by_name if strict else F.coalesce(by_name, F.get(sets, index))
    else:
        chosen_list = F.get(sets, index)
    chosen = F.coalesce(chosen_list, single)
    good = p.filter(valid).select("payload_id", chosen.alias("rs"))
    # names are normalised once per payload, before the rows are exploded
    good = good.select("payload_id", F.col("rs.headers").alias("headers"), F.col("rs.rowSet").alias("_rowset"))
    good = good.withColumn("_base", F.transform("headers", lambda h: snake_case_col(h)))
    good = good.withColumn("names", _numbered_names(F.col("_base")))
    rowset = F.coalesce(F.col("_rowset"), F.array().cast("array<array<string>>"))
    if columns is None:
        return good.select("payload_id", "headers", "names", F.posexplode(rowset).alias("row_no", "cells")), quarantine
    at = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.array_position("names", c).cast("int"))
    each = good.select("payload_id", at.alias("_at"), F.posexplode(rowset).alias("row_no", "_cells"))
    cells = F.transform("_at", lambda p: F.when(p > 0, F.get(F.col("_cells"), p - 1)))
    return each.select("payload_id", "row_no", cells.alias("cells")), quarantine


def cells_to_table(rows: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None,
                   keep_ids: bool = False) -> DataFrame:
    """Rows of ``decode_payloads(..., columns=columns)`` as one column each, cast with ``try_cast``."""
    types = dict(types or {})
    out = [F.get("cells", i) for i in range(len(columns))]
    out = [(v.try_cast(types[c]) if c in types else v).alias(c) for c, v in zip(columns, out)]
    return rows.select(*(["payload_id", "row_no"] if keep_ids else []), *out)


def header_names(rows: DataFrame) -> list[str]:
    """The union of all header names, by first position and then name.

    An aggregate over single names (combined map-side): what reaches the driver is one
    row per output column, however many payloads and header lists there are.
    """
    names = F.col("names") if "names" in rows.columns else normalize_names_col(F.col("headers"))
    found = (rows.select(F.posexplode(names).alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"))
             .orderBy("at", "name").collect())
    return [r["name"] for r in found]


def rows_to_table(rows: DataFrame, columns: Sequence[str] | None = None,
                  types: Mapping[str, str] | None = None, keep_ids: bool = False) -> DataFrame:
    """Records with one column per normalised header.

    ``columns`` fixes the output columns (default: the union of all header
    names, see ``header_names``); a payload without a column gives NULL there.
    ``types`` casts text cells with ``try_cast``.  Where the columns are known
    beforehand, ``decode_payloads(columns=...)`` and ``cells_to_table`` are cheaper.
    """
    if columns is None:
        columns = header_names(rows)
    # A cell is found by the position of its normalised header name (names
    # were normalised once per payload); a column missing from a payload's
    # headers, or a short row, gives NULL.
    types = dict(types or {})
    names = F.col("names") if "names" in rows.columns else normalize_names_col(F.col("headers"))
    out = []
    for c in columns:
        p = F.array_position(names, F.lit(c)).cast("int")
        v = F.when(p > 0, F.get(F.col("cells"), p - 1))
        out.append((v.try_cast(types[c]) if c in types else v).alias(c))
    ids = ["payload_id", "row_no"] if keep_ids else []
    return rows.select(*ids, *out)


def tag_lineage(df: DataFrame, season: str, season_type: str | None = None) -> DataFrame:
    """Add ``season``, ``season_label`` ('2025-26' for 2026) and ``season_type``."""
    cols = {"season": F.lit(str(int(season))), "season_label": season_label(F.lit(str(int(season))))}
    if season_type is not None:
        cols["season_type"] = F.lit(season_type)
    return df.withColumns(cols)
