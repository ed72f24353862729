"""Merkle manifest of a dataset by a tree of SHA-256 midstates (operator 13).

Every row is a leaf; per group (language) the leaves are ordered by id, and every
``ARITY`` consecutive nodes become the hash of their digests until one is left, the
group's subroot.  The subroots, ordered by group, make the root in the same way.

A parent is hashed once, child by child, and the hash state before each child slot is
copied and kept.  To fold another value into the tree, for instance a leaf that somebody
changed, the state before its slot is resumed with the replacement and the siblings to
its right only; the left ones are in the state already.

On Spark:

* Leaves are hashed by SQL functions, range-partitioned and sorted by (group, id), so
  a place in the group is the place in the partition plus the counts of the partitions
  before; no group is sorted in one task.
* Up: blocks of ``ARITY ** DEPTH`` consecutive nodes are one task group each and become
  one node of the next table, which is that much smaller, until each group is one block.
* Down: a block hands each of its nodes its way to the root: per level the digests to
  its left and to its right.  At the bottom each leaf folds through its block's kept
  states, then through the states that its block shares.

Hash states cannot be sent between tasks, so a block is hashed again on the way down;
what is written between tasks are digests.

Defined results: a null field is written ``-``.  A null group is a group and comes first;
a null id comes first in its group.  Rows with equal ids are ordered by their leaves, so
repeated rows are leaves side by side.  Empty and long texts are fields like any other.
An empty table has no leaves, subroots or root: an empty result.  Columns other than the
given fields are neither read nor hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import in_order, lower_ascii, materialize

ARITY = 8
DEPTH = 4                # levels that one task group builds: blocks of 8^4 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"      # digests beside a node, from its own level up


# -- leaves ----------------------------------------------------------------


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*[field_text(v) for v in values]), "UTF-8"), 256)


def group_key(group: Column) -> Column:
    """Text that sorts like the group with null first, and that is never null itself."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


# -- one block of nodes, in a task -----------------------------------------


@dataclass
class Level:
    """The parents over one level: kept states before each child, and the digests to its right."""

    states: list
    right: list[str]
    left: list[str] | None
    parents: list[str]


def build_level(nodes: Sequence[str], with_left: bool = False) -> Level:
    """Hash every ``ARITY`` nodes to a parent, keeping a copy of the state before each child."""
    states, right, left, parents = [], [], [] if with_left else None, []
    for lo in range(0, len(nodes), ARITY):
        run = nodes[lo:lo + ARITY]
        state = hashlib.sha256()
        for slot, child in enumerate(run):
            states.append(state.copy())
            right.append("".join(run[slot + 1:]))
            if with_left:
                left.append("".join(run[:slot]))
            state.update(child.encode())
        parents.append(state.hexdigest())
    return Level(states, right, left, parents)


def build(nodes: Sequence[str], depth: int | None, with_left: bool = False) -> list[Level]:
    """All levels over a block: ``depth`` of them, or (None) until one node is left."""
    levels: list[Level] = []
    while (len(levels) < depth) if depth is not None else len(nodes) > 1:
        levels.append(build_level(nodes, with_left))
        nodes = levels[-1].parents
    return levels


def resume(state, digest: str, right: str) -> str:
    """The parent's digest with ``digest`` in the slot that ``state`` was copied before."""
    state = state.copy()
    state.update(digest.encode())
    state.update(right.encode())
    return state.hexdigest()


def path_states(path: Sequence[dict]) -> list[tuple]:
    """States before a node's slot, level by level, of a path that many nodes share."""
    return [(hashlib.sha256(p["left"].encode()), p["right"]) for p in path]


# -- the tree, up and down -------------------------------------------------


def _sorted_by(table: pa.Table, column: str) -> pa.Table:
    return table.sort_by(column)


def up(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Tables of nodes (group, place, digest), each a block of the one before, until every group is one node."""
    def tops(table: pa.Table) -> pa.Table:
        table = _sorted_by(table, "place")
        digests = table.column("digest").to_pylist()
        whole, own = build(digests, DEPTH), build(digests, None)
        last = lambda levels: levels[-1].parents[0] if levels else digests[0]
        return pa.table({"group": [table.column("group")[0].as_py()], "place": [table.column("block")[0].as_py()],
                         "whole": [last(whole)], "own": [last(own)]})

    out = [nodes]
    while True:
        blocks = out[-1].select("group", "place", "digest", F.floor(F.col("place") / ARITY**DEPTH).alias("block"))
        made = materialize(blocks.groupBy("group", "block").applyInArrow(
            tops, "group string, place long, whole string, own string"), name)
        several = made.groupBy("group").agg((F.count("*") > 1).alias("several"))
        out.append(materialize(
            made.join(several, "group").select("group", "place", F.when(F.col("several"), F.col("whole"))
                                               .otherwise(F.col("own")).alias("digest"), "several"), name))
        if out[-1].where("several").isEmpty():
            return out


def down(tables: list[DataFrame], tops: DataFrame, each: Callable | None, schema: str, name: str) -> DataFrame:
    """From the ways to the root of each group's last node (``tops``: group, subroot, root, path) to every first node.

    ``each(nodes, levels, subroot, root, path)`` makes the rows of a bottom block, in
    ``schema``; without it the rows are (group, place, subroot, root, path).
    """
    paths = "group string, place long, subroot string, root string, path " + PATH

    def spread(nodes: pa.Table, way: pa.Table) -> pa.Table:
        return _spread(nodes, way, None, None)

    def finish(nodes: pa.Table, way: pa.Table) -> pa.Table:
        return _spread(nodes, way, each, schema)

    way = tops.withColumn("place", F.lit(0).cast("long"))
    for i in range(len(tables) - 2, -1, -1):
        bottom = i == 0 and each is not None
        blocks = tables[i].withColumn("block", F.floor(F.col("place") / ARITY**DEPTH))
        # a block has whole depth if its group has several at this level
        above = way.join(tables[i + 1].select("group", "place", "several"), ["group", "place"]).withColumnRenamed("place", "block")
        below = blocks.groupBy("group", "block").cogroup(above.groupBy("group", "block"))
        if bottom:
            return below.applyInArrow(finish, schema)
        way = materialize(below.applyInArrow(spread, paths), name)
    return way


def _spread(nodes: pa.Table, way: pa.Table, each, schema) -> pa.Table:
    nodes, own = _sorted_by(nodes, "place"), way.to_pylist()[0]
    levels = build(nodes.column("digest").to_pylist(), DEPTH if own["several"] else None, with_left=True)
    if each is not None:
        return each(nodes, levels, own["subroot"], own["root"], own["path"])
    rows = []
    for i in range(nodes.num_rows):
        path, at = [], i
        for level in levels:
            path.append({"left": level.left[at], "right": level.right[at]})
            at //= ARITY
        rows.append(path + own["path"])
    n = nodes.num_rows
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    return pa.table({"group": nodes.column("group"), "place": nodes.column("place"), "subroot": pa.array([own["subroot"]] * n),
                     "root": pa.array([own["root"]] * n), "path": pa.array(rows, kind)})


def group_paths(tables: list[DataFrame], name: str) -> DataFrame:
    """(group, subroot, root, path): the tree over the subroots, in the order of their groups."""
    subroots = tables[-1].select(F.lit("").alias("group"), F.col("group").alias("member"), "digest")
    ordered = materialize(in_order(subroots, ["member"], name), name)
    over = up(ordered.select("group", "place", "digest"), name)
    top = over[-1].select("group", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                          F.array().cast(PATH).alias("path"))
    ways = down(over, top, None, "", name)
    return materialize(
        ordered.join(ways.select("place", "root", "path"), "place")
        .select(F.col("member").alias("group"), F.col("digest").alias("subroot"), "root", "path"), name)


FOLDED = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


def _fold_leaves(nodes: pa.Table, levels: list[Level], subroot: str, root: str, path) -> pa.Table:
    """Every leaf's proof, and the root with its replacement (if any) folded in."""
    shared = path_states(path)
    upper = "".join(p["left"] + p["right"] for p in path)
    proofs, folded = [], []
    for i, (leaf, other) in enumerate(zip(nodes.column("digest").to_pylist(), nodes.column("replacement").to_pylist())):
        digest, at, proof = leaf if other is None else other, i, hashlib.sha256()
        for level in levels:
            proof.update((level.left[at] + level.right[at]).encode())
            digest = resume(level.states[at], digest, level.right[at])
            at //= ARITY
        proof.update(upper.encode())
        for state, right in shared:
            digest = resume(state, digest, right)
        proofs.append(proof.hexdigest())
        folded.append(digest)
    n = nodes.num_rows
    return pa.table({"doc_id": nodes.column("doc_id"), "leaf": nodes.column("digest"), "subroot": pa.array([subroot] * n),
                     "root": pa.array([root] * n), "proof_sha256": proofs, "folded_root": folded,
                     "verified": [f == root for f in folded]})


def fold(leaves: DataFrame, order: Sequence[str] = ("doc_id", "digest", "replacement")) -> DataFrame:
    """Tree over ``leaves`` (group, doc_id, digest, replacement) and each leaf folded into it.

    Returns doc_id, leaf, subroot, root, proof_sha256 (all of the untouched tree),
    folded_root (with the replacement, or the leaf itself where that is null) and verified.
    """
    placed = materialize(in_order(leaves, order, "manifest-order"), "manifest-leaves")
    tables = up(placed, "manifest-up")
    tops = group_paths(tables, "manifest-top")
    return down(tables, tops, _fold_leaves, FOLDED, "manifest-down")


def roots(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group: str = "lang") -> DataFrame:
    """The manifest alone: (group, n_leaves, subroot, root), one row per group."""
    leaves = docs.select(docs[group].alias("value"), group_key(docs[group]).alias("group"), docs[id_col].alias("doc_id"),
                         leaf_hash([docs[c] for c in fields]).alias("digest"))
    leaves = materialize(leaves, "manifest-digests")
    tables = up(materialize(in_order(leaves.drop("value"), ["doc_id", "digest"], "manifest-order"), "manifest-leaves"), "manifest-up")
    names = leaves.groupBy("group").agg(F.first("value").alias("value"), F.count("*").alias("n_leaves"))
    return (group_paths(tables, "manifest-top").join(names, "group")
            .select(F.col("value").alias("group"), "n_leaves", "subroot", "root"))


def tamper_check(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group: str = "lang",
                 text: str = "text") -> DataFrame:
    """The manifest's proof of every row, checked against rows some of which were changed.

    Where 3 divides the checksum of the id, the row was tampered with: its text's A-Z are lower case.
    """
    changed = F.crc32(F.encode(docs[id_col].cast("string"), "UTF-8")) % 3 == 0
    other = leaf_hash([lower_ascii(docs[c]) if c == text else docs[c] for c in fields])
    leaves = docs.select(group_key(docs[group]).alias("group"), docs[id_col].cast("long").alias("doc_id"),
                         leaf_hash([docs[c] for c in fields]).alias("digest"),
                         F.when(changed, other).alias("replacement"))
    return fold(materialize(leaves, "manifest-digests"))
