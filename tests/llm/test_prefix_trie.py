from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from shelfguard.llm import prefix_trie as pt

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in own.values():
        turns.sort()
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = [t[1:] for t in own.get(base, [])[:h]] + [t[1:] for t in turns[h:]]
    members = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members.setdefault(tuple(built[c][:d]), []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, own_members in members.items():
        gain = (len(own_members) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += gain
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def _got(spark, rows, *shard):
    return sorted(tuple(r) for r in pt.op13_prefix_trie(spark.createDataFrame(rows, TURNS), *shard).collect())


def _some(seed, convs, turns=12):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 400), convs):
        for t in range(rng.randint(1, turns)):
            rows.append((c, rng.choice([t, t, t, None, t - 1]), rng.choice(["user", "system", None, ""]), rng.choice([None, "", "hi", "ü", "a" * 70 + "x", "a" * 70 + "y"])))
    return rows


@pytest.mark.parametrize("shard", [(1024, 65536), (3, 65536), (1024, 5), (1, 1)])
def test_equals_brute_force(spark, shard):
    rows = _some(sum(shard), 60)
    rows += [(c, t, "user", "same") for c in range(500, 540) for t in range(9)]  # a large group of copies
    rows += [(c, t, "system" if t == 0 else "user", "hot" if t == 0 else str(c * t)) for c in range(600, 640) for t in range(4)]
    rows += [(None, 0, "user", "x"), (1000, 0, "user", "alone"), (1001, 1, "user", "b"), (1001, 1, "user", "b"), (1001, 1, "user", "a")]
    assert _got(spark, rows, *shard) == brute(rows)


def test_long_conversations_go_on_in_the_next_shard(spark):
    rng = random.Random(9)
    long = [(t, "user", rng.choice("ab")) for t in range(300)]
    rows = [(c, *x) for c in (5, 6, 7, 8) for x in long] + [(9, *x) for x in long[:150]] + [(3, 0, "u", "t")]
    assert _got(spark, rows, 1024, 40) == brute(rows)


def test_edges(spark):
    assert _got(spark, []) == [] and _got(spark, [(None, 1, "a", "b")]) == []
    rows = [(c, 0, None, None) for c in range(12)]  # some end up without turns
    assert _got(spark, rows) == brute(rows)
    df = spark.createDataFrame(_some(4, 8), TURNS)
    wanted = sorted(tuple(r) for r in pt.op13_prefix_trie(df).collect())
    for c in ("path", "depth", "idx", "pos", "bytes", "h", "base", "n_convs"):
        df = df.withColumn(c, F.lit("mine"))
    assert sorted(tuple(r) for r in pt.op13_prefix_trie(df).collect()) == wanted


def test_a_shard_gives_popcounts_and_end_lists():
    shard = pt.Shard()
    for conv, turns in ((3, b"ab"), (5, b"ab"), (8, b"a"), (9, b"ac")):
        shard.begin(conv, 0, pt.ROOT)
        for t in turns:
            shard.add(bytes([t]), 10)
    nodes = {n[0]: n[2:] for n in shard.nodes()}
    a = pt.step(pt.ROOT, b"a")
    assert nodes[pt.ROOT] == (0, 0, 4, 3, 0, None, None) and nodes[a] == (1, 10, 4, 3, 1, "8", 8)
    assert nodes[pt.step(a, b"b")] == (2, 10, 2, 3, 2, "3,5", 3) and nodes[pt.step(a, b"c")] == (2, 10, 1, 9, 1, "9", 9)
