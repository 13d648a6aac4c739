from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfguard.llm import manifest as m
from shelfguard.llm.ranks import numbered_in_groups

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _h(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def _leaf(r):
    doc_id, text, lang, source, n_chars = r
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def _tree(leaves):
    """Levels bottom-up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_h("".join(low[k : k + 3])) for k in range(0, len(low), 3)])
    return levels


def _steps(levels, i):
    out = []
    for low in levels[:-1]:
        first = i - i % 3
        out.append((low[first:i], low[i + 1 : first + 3]))
        i //= 3
    return out


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[s] = _tree([_leaf(r) for r in by_source[s]])
    top = _tree([trees[s][-1][0] for s in order])
    out = []
    for at, s in enumerate(order):
        for i, r in enumerate(by_source[s]):
            steps = _steps(trees[s], i) + _steps(top, at)
            cheat = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = _leaf((r[0], r[1].replace("\n", ""), *r[2:]) if cheat else r)
            for before, after in steps:
                node = _h("".join([*before, node, *after]))
            proof = _h("".join("".join(before + after) for before, after in steps))
            out.append((r[0], _leaf(r), trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


def _got(spark, rows, depth):
    return sorted((tuple(r) for r in m.op12_merkle_manifest(spark.createDataFrame(rows, DOCS), depth).collect()), key=str)


def test_positions_are_those_of_a_postorder_walk():
    for n in range(1, 120):
        levels = m.levels_of(n)
        log = m.Segment(levels)
        wanted = _tree([f"{i:064x}" for i in range(n)])
        for digest in wanted[0]:
            log.append(bytes.fromhex(digest))
        nodes = log.close()
        assert len(nodes) == 32 * sum(map(len, wanted))
        for level, row in enumerate(wanted):
            for i, digest in enumerate(row):
                at = 32 * m.node_position(level, i, n)
                assert nodes[at : at + 32].hex() == digest


@pytest.mark.parametrize(("depth", "n"), [(1, 40), (2, 100), (6, 100)])
def test_equals_brute_force(spark, depth, n):
    rng = random.Random(n + depth)
    sources = [None, "", "hot", "hot", "hot", "ä", "z", "Z", "-", *[f"s{k}" for k in range(12)]]
    text = lambda: rng.choice([None, "", "a\nb", "x", "\n\n", "ü\r\n" * 9, "long " * 5000 + "\n"])
    rows = [(i, text(), rng.choice([None, "en", ""]), rng.choice(sources), rng.choice([None, 0, -5, 77])) for i in range(n)]
    rows += [rows[3], rows[3], (rows[4][0], "other", "en", rows[4][3], 1), (None, "a\nb", None, "hot", None), (None, None, None, None, None), (-9, "m\n", "en", "hot", 2)]
    got = _got(spark, rows, depth)
    assert got == brute(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_one_document_no_document_and_clashing_columns(spark):
    row = (4, "one\ntwo", "en", "s", 7)
    assert _got(spark, [row], 6) == brute([row])
    assert _got(spark, [], 6) == []
    df = spark.createDataFrame([row], DOCS)
    for c in ("g", "idx", "n", "leaf", "digest", "root", "segment", "path"):
        df = df.withColumn(c, F.lit("mine"))
    assert [tuple(r) for r in m.op12_merkle_manifest(df).collect()] == brute([row])


def test_proofs_reject_what_is_not_in_the_dataset(spark):
    rows = [(i, f"t{i}\n", "en", f"s{i % 3}", i) for i in range(30)]
    made = m.merkle_manifest(
        spark.createDataFrame(rows, DOCS).select("doc_id", "source", m.leaf_digest(*[F.col(c) for c in m.LEAF_COLUMNS]).alias("digest")), "source", "doc_id", 2
    )
    for r in made.proofs().collect():
        assert m.fold(bytes(r.leaf), bytes(r.path)) == made.root
        assert m.fold(b"\0" * 32, bytes(r.path)) != made.root
    assert set(made.leaves.columns) == {"g", "doc_id", "digest", "n", "idx"}


def test_a_hot_group_is_numbered_over_many_ranges(spark):
    rows = [("hot", i % 50, i) for i in range(400)] + [(f"g{i % 7}", i, i) for i in range(60)] + [("hot", None, 999)]
    df = spark.createDataFrame(rows, "g string, k long, v long").repartition(9)
    got = numbered_in_groups(df, "g", ["k", "v"], "t").collect()
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        found = sorted((r for r in got if r.g == g), key=lambda r: r.idx)
        assert [(r.g, r.k, r.v) for r in found] == own and [r.idx for r in found] == list(range(len(own))) and {r.n for r in found} == {len(own)}
