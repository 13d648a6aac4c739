from __future__ import annotations

import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import decontaminate as dc
from shelfguard.llm import quality
from shelfguard.llm.queries import QUERIES


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in QUERIES["op5_quality"](spark, "/root/testdata/sf0.01").collect()}


def test_held_out_accuracy(spark, scored):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(scored[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in scored)
    right = sum(scored[i].predicted == labels[i] for i in held) / len(held)
    lost = sum(not scored[i].predicted for i in held if labels[i]) / max(1, sum(labels[i] for i in held))
    assert right >= 0.93 and lost <= 0.03


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.train(docs, labels) == quality.train(docs, turned)).all()


def test_scores_with_edges(spark, docs_of):
    rows = [(i, "good plain words here and there") for i in range(30)] + [(100 + i, "BUY!! NOW!! BUY!! NOW!!") for i in range(30)]
    rows += [(None, "plain words"), (500, None), (501, ""), (502, "words " * 40_000), (0, rows[0][1])]
    labels = [(i, int(i < 100), 0) for i, _ in rows[:60]] + [(None, 1, 0), (500, None, 0), (3, 0, 0), (3, 1, 0)]
    df = docs_of(rows).withColumn("score", F.lit("mine")).withColumn("label", F.lit(5))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))
    out = quality.classify(df, table).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    by = {r.doc_id: r.score for r in out}
    assert by[1] > 0.5 > by[101]
    got = {r.doc_id: r.held_out for r in quality.op5_quality(docs_of(rows), table).collect()}
    assert got[None] is True and got[0] is (zlib.crc32(b"0") % 3 == 1)
    nothing = quality.op5_quality(docs_of(rows), table.where("false")).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality.op5_quality(docs_of([]), table).count() == 0


def test_ftrl_learns_a_linear_rule():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(400):
        cols = np.unique(rng.integers(1, 50, 8)).astype(np.int32)
        rows.append((cols, np.full(len(cols), 0.3), float((cols < 25).sum() > len(cols) / 2)))
    w = quality.ftrl(rows, 60, epochs=40)
    assert np.mean([(w[c] @ v > 0) == (y == 1) for c, v, y in rows]) > 0.95


def _check(rows, items, window=10, **kw):
    found = dc.contaminate_rows([t for _, t in rows], dc.Windows(items, window), **kw)
    for (n, spans, own), (_, words, hit, names) in zip(found, brute.leaks(rows, items, window), strict=True):
        flags = [False] * n
        for a, b in spans:
            flags[a:b] = [True] * (b - a)
        assert (n, flags, set(own)) == (words, hit, names)


@pytest.mark.parametrize("seed", range(30))
def test_index_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = "abcde"[: rng.randint(1, 5)]
    text = lambda n, of: " ".join(rng.choice(of) for _ in range(n))
    rows = [(i, text(rng.randint(0, 60), letters + "z")) for i in range(8)] + [(9, None), (10, "")]
    rows.append((11, rows[0][1]))
    items = [(i, text(rng.randint(0, 14), letters)) for i in range(5)]
    _check(rows, items, rng.choice([3, 10]), shard_words=rng.choice([5, 100, 10**6]))


def test_long_repeats_and_words_of_other_scripts():
    _check([(1, "a " * 3000), (2, "a " * 2999 + "b"), (3, "Ünï-Cöde 漢字, x9")], [(1, "a " * 12), (2, "A b"), (3, "ünï cöde 漢字 X9"), (4, "...")])


def test_frames_blocks_and_removal(spark, docs_of):
    passage = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(1, f"Start, {passage}! The end."), (2, "nothing to see"), (3, None), (4, ""), (1, f"Start, {passage}! The end."), (None, passage.upper()), (5, "one; TWO")]
    items = [(10, passage), (2, "one two"), (2, "one two"), (3, None), (4, "--"), (None, "see")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("spans", F.lit(0))
    df = docs_of(rows).withColumn("spans", F.lit("mine"))
    wanted = sorted((str(i), n, sum(h), len(o), brute.sha(",".join(sorted(map(str, o)))), any(h)) for i, n, h, o in brute.leaks(rows, items))
    got = sorted((str(r.doc_id), *r[1:]) for r in dc.op9_decontaminate(df, bench).collect())
    assert got == wanted
    for block in (dc.BLOCK_BYTES, 20):
        found = dc.remove_spans(dc.find_contamination(df, bench, block_bytes=block))
        clean = sorted((str(r.doc_id), str(r.clean_text), r.n_words, len(r.items)) for r in found.collect())
        assert clean[0][:2] == ("1", "Start, ! The end.") and ("None", "", 11, 1) in clean and len(clean) == len(rows)
        assert ("5", "", 2, 1) in clean and ("3", "None", 0, 0) in clean and ("2", "nothing to ", 3, 0) in clean
    assert dc.op9_decontaminate(docs_of([]), bench).count() == 0
    assert not any(r.contaminated for r in dc.op9_decontaminate(df, bench.where("false")).collect())
