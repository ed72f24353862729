"""Merkle manifest: digests, proofs and folded roots against a plain tree; blocks; edges."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import manifest as m

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def leaf(doc_id, text, lang, source, n_chars):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def climb(nodes, at):
    """(root, [siblings left of the way, right of it] per level) of a plain tree."""
    path = []
    while len(nodes) > 1:
        lo = at // 8 * 8
        path.append((nodes[lo:at], nodes[at + 1:lo + 8]))
        nodes = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        at //= 8
    return nodes[0], path


def lower(t):
    return t and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subroots = [climb([x[1] for x in groups[g]], 0)[0] for g in order]
    out = []
    for k, g in enumerate(order):
        for i, (doc_id, own, r) in enumerate(groups[g]):
            subroot, path = climb([x[1] for x in groups[g]], i)
            root, more = climb(subroots, k)
            path = path + more
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
            folded = leaf(r[0], lower(r[1]), *r[2:]) if changed else own
            for left, right in path:
                folded = H("".join([*left, folded, *right]))
            out.append((doc_id, own, subroot, root, H("".join("".join(a + b) for a, b in path)), folded, folded == root))
    return sorted(out, key=str)


def check(spark, rows):
    got = m.tamper_check(spark.createDataFrame(rows, COLUMNS))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


EDGES = [(1, "Text", "en", "s", 4), (2, None, None, None, None), (3, "", "", "", 0), (4, "É A", "de", "x", 3), (None, "No id", "en", "s", 5),
         (5, "Twice", "en", "s", 5), (5, "Twice", "en", "s", 5), (5, "Other", "en", "s", 5), (6, "W " * 50_000, "en", "s", 1), (-7, "a:b-", "-", "1:", 2)]


def test_edges(spark):
    check(spark, EDGES)


@pytest.mark.parametrize("n", [1, 8, 9, 65])
def test_one_group_of_any_size(spark, n):
    check(spark, [(i * 3, f"Doc {i}", "en", "s", i) for i in range(n)])


def test_blocks_of_blocks_and_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(m, "DEPTH", 1)              # blocks of 8: three tables for the hot group, one for others
    check(spark, [(i, f"Doc {i}", "en" if i % 3 else f"l{i % 30}", "s", i) for i in range(330)])


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(m, "DEPTH", 1)
    check(spark, [(i, f"T{i}", f"g{i:03d}", None, i) for i in range(70)])


def test_empty_table(spark):
    assert m.tamper_check(spark.createDataFrame([], COLUMNS)).collect() == []


def test_only_the_fields_count(spark):
    plain = spark.createDataFrame(EDGES, COLUMNS)
    extra = plain.selectExpr("*", "'z' as leaf", "1 as group", "2 as place", "'q' as digest")
    assert sorted(map(tuple, m.tamper_check(extra).collect()), key=str) == brute(EDGES)


def test_manifest_alone(spark):
    got = {r.group: (r.n_leaves, r.subroot, r.root) for r in m.roots(spark.createDataFrame(EDGES, COLUMNS)).collect()}
    want = {}
    for r in EDGES:
        want.setdefault(r[2], 0)
        want[r[2]] += 1
    assert {g: v[0] for g, v in got.items()} == want
    assert {v[1:] for v in got.values()} == {x[2:4] for x in brute(EDGES)}


DIGESTS = st.lists(st.text("0123456789abcdef", min_size=4, max_size=4), min_size=1, max_size=100)


@settings(max_examples=100, deadline=None)
@given(DIGESTS, st.data())
def test_resuming_a_state_is_hashing_anew(nodes, data):
    at = data.draw(st.integers(0, len(nodes) - 1))
    changed = [*nodes[:at], "beef", *nodes[at + 1:]]
    levels, digest, place = m.build(nodes, None), "beef", at
    for level in levels:
        digest = m.resume(level.states[place], digest, level.right[place])
        place //= m.ARITY
    assert digest == climb(changed, at)[0]
    assert (levels[-1].parents[0] if levels else nodes[0]) == climb(nodes, 0)[0]
