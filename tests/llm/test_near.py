from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import near_dedup
from shelfguard.llm.components import connected_components


def _near(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None)


def _expected(rows):
    found = brute.near({i: t for i, t in rows}.items())
    return sorted((i, found[i][0], found[i][1], found[i][1] == i) for i, _ in rows)


def _texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(3, 80))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = word()
            rows.append(" ".join(own).upper() if rng.random() < 0.2 else "  ".join(own))
    rows += rows[:5] + ["", None, " \n", "one", "One", "one two three", "one two three four", "ONE\ttwo  three four"]
    rng.shuffle(rows)
    return [(1000 - 3 * i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [2, near_dedup.BLOCK])
def test_equals_brute_force(docs_of, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = _texts(block)
    assert _near(near_dedup.op4_near_dedup(docs_of(rows))) == _expected(rows)


def test_members_that_link_with_each_other_but_not_with_their_leader(docs_of):
    """The smallest id is the farthest copy: links among the others must still be found."""
    words = [f"w{i}" for i in range(100)]
    changed = lambda at: " ".join("x" if i in at else w for i, w in enumerate(words))
    rows = [(1, changed({3, 20, 40, 60, 80})), (2, changed({90})), (3, changed({91, 95})), (4, changed({10, 30})), (5, changed({50}))]
    assert _near(near_dedup.op4_near_dedup(docs_of(rows))) == _expected(rows)


def test_exactly_the_threshold(docs_of):
    # 4-word shingles: 8 of 10 in common link, 7 of 9 do not.
    a = [f"a{i}" for i in range(12)]
    rows = [(1, " ".join(a)), (2, " ".join([*a[:-1], "z"])), (3, " ".join([*a[1:], "z"])), (4, " ".join(a[:10]))]
    assert _near(near_dedup.op4_near_dedup(docs_of(rows))) == _expected(rows)


def test_repeats_null_ids_empty_table_and_extra_columns(docs_of):
    text = "one two three four five six seven eight"
    rows = [(7, text), (7, text), (5, text), (None, text), (6, None), (8, "other words that stand alone here now"), (8, text)]
    df = docs_of(rows).withColumn("component_id", F.lit("mine")).withColumn("key", F.lit(1))
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_dedup.op4_near_dedup(df).collect())
    assert got == [("5", 5, True), ("6", 6, True), ("7", 5, False), ("7", 5, False), ("8", 5, False), ("8", 8, True), ("None", None, True)]
    kept = sorted((str(r.doc_id), str(r.text)) for r in near_dedup.keep_one_of_each(docs_of([*rows, (5, text)])).collect())
    assert kept == sorted([("5", text), ("6", "None"), ("8", rows[5][1]), ("None", text)])
    assert near_dedup.op4_near_dedup(docs_of([])).count() == 0


def test_every_text_of_an_id_is_compared(docs_of):
    """One id is the smallest of several sets: each set still finds its copies and near copies."""
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = [(1, t) for t in texts] + [(9 + i, t) for i, t in enumerate(texts)] + [(20 + i, t + " more") for i, t in enumerate(texts)]
    got = near_dedup.op4_near_dedup(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == sorted((i, 1, i == 1) for i, _ in rows)
    assert sorted(r.text for r in near_dedup.keep_one_of_each(docs_of(rows)).collect()) == texts


def test_bit_counts_estimate_the_similarity():
    rng = np.random.default_rng(5)
    common, own = rng.integers(0, 1 << 63, 4000, dtype=np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    m = near_dedup.MinHash()
    a, b = m.minima(np.concatenate([common, own[:500]])), m.minima(np.concatenate([common, own[500:]]))
    z = m.packed(a) ^ m.packed(b)
    equal = near_dedup.HASHES - int(np.bitwise_count((z | (z >> np.uint64(1))) & near_dedup._LOW).sum())
    chance = 0.5**near_dedup.BITS
    assert abs((equal / near_dedup.HASHES - chance) / (1 - chance) - 0.8) < 0.15
    assert near_dedup.least_matches(80) < equal


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(7, 7), (9, 8), (8, 9), (8, 9)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(80)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == brute.components(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
