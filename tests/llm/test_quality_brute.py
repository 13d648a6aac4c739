"""The classifier's scores recomputed plainly: one feature and one weight at a time."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from shelfguard.llm import quality as q

WORD = 1 << 64
MIX = 0x9E3779B97F4A7C15


def _column(h):
    return ((h * MIX) % WORD >> (64 - q.BITS)) + 1


def _features(text):
    """column -> value."""
    tokens = re.findall(r"[^\W_]+|(?:_|[^\w\s])+", text or "")
    words = [xxh64_intdigest(t.lower(), 1) for t in tokens]
    shapes = [xxh64_intdigest(q._shape(t), 2) for t in tokens]
    pairs = [[((a ^ (b >> 7)) * MIX + b) % WORD for a, b in zip(s, s[1:], strict=False)] for s in (words, shapes)]
    out = [(0, 1.0)]
    grams = Counter(((h * MIX) % WORD) >> (64 - q.BITS) for h in [*words, *shapes, *pairs[0], *pairs[1]])
    values = {g + 1: 1.0 + math.log(n) for g, n in grams.items()}
    norm = math.sqrt(max(1.0, sum(v * v for v in values.values())))
    out += [(c, v / norm) for c, v in values.items()]
    if tokens:
        marks = []
        for h, n in Counter([*shapes, *pairs[1]]).items():
            level = math.floor(2 * math.log2(n / len(shapes) * 1024 + 1))
            marks.append((h ^ ((level + 1) * MIX) % WORD) * MIX % WORD)
        near = [any(i >= d and words[i] == words[i - d] for d in range(1, 5)) for i in range(len(words))]
        shares = [1 - len(set(x)) / max(1, len(x)) for x in (words, pairs[0])] + [sum(near) / len(near)]
        for k, share in enumerate(shares):
            step = (10_007 * (k + 1) + int(20 * share)) * MIX % WORD
            marks.append(step ^ min(10, len(words).bit_length()) if k < 2 else step)
        norm = math.sqrt(max(1.0, len(marks)))
        out += [(_column(m), 1 / norm) for m in marks]
    return out


def _weight(z, n):
    return 0.0 if abs(z) <= q.L1 else -(z - math.copysign(q.L1, z)) / ((q.BETA + math.sqrt(n)) / q.ALPHA + q.L2)


def _plain_ftrl(rows):
    z, n = {}, {}
    for _ in range(q.EPOCHS):
        for features, label in rows:
            w = [_weight(z.get(c, 0.0), n.get(c, 0.0)) for c, _ in features]
            p = 1 / (1 + math.exp(-sum(a * v for a, (_, v) in zip(w, features, strict=True))))
            before = [(z.get(c, 0.0), n.get(c, 0.0)) for c, _ in features]
            for (c, v), a, (z0, n0) in zip(features, w, before, strict=True):
                g = (p - label) * v
                z[c] = z.get(c, 0.0) + g - (math.sqrt(n0 + g * g) - math.sqrt(n0)) / q.ALPHA * a
                n[c] = n.get(c, 0.0) + g * g
    return {c: _weight(z[c], n[c]) for c in z}


TEXTS = [None, "", "x", "One plain sentence, with a comma.", "BUY NOW!!! www.x.com 100% 100% 100%", "a a a a b b", "Zwölf Äpfel, 12 Birnen_und 3 Nüsse."] + [f"word{i % 7} and thing{i} of {i * 37} words go on. " * (i % 5 + 1) for i in range(40)]


@pytest.mark.parametrize("text", TEXTS)
def test_features_equal_plain_ones(text):
    cols, values = q.Featurizer()([text])[0]
    assert sorted((c, round(v, 9)) for c, v in zip(cols.tolist(), values.tolist(), strict=True)) == sorted((c, round(v, 9)) for c, v in _features(text))


def test_scores_equal_a_plain_recomputation(spark, docs_of):
    rows = list(enumerate(TEXTS))
    labels = [(i, int(i % 3 == 0)) for i in range(0, len(TEXTS), 1)]
    docs = docs_of(rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("toxic", F.lit(0))
    shard = {r.doc_id: (r.s, r.rank) for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", "text"), F.lit(q.SHARDS)).alias("s"), F.xxhash64("text", "doc_id").alias("rank")).collect()}
    learned = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    model = {}
    for s in range(q.SHARDS):
        own = sorted((shard[i][1], i, TEXTS[i] or "") for i in learned if shard[i][0] == s)
        # Values are kept as 32-bit floats while training.
        part = _plain_ftrl([([(c, float(np.float32(v))) for c, v in _features(t)], dict(labels)[i]) for _, i, t in own])
        for c, w in part.items():
            model[c] = model.get(c, 0.0) + w / q.SHARDS
    got = {r.doc_id: r for r in q.op5_quality(docs, marks).collect()}
    assert len(got) == len(TEXTS) and any(model.values())
    for i, text in rows:
        wanted = 1 / (1 + math.exp(-sum(model.get(c, 0.0) * v for c, v in _features(text))))
        assert got[i].score == pytest.approx(wanted, abs=2e-3)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and got[i].predicted == int(got[i].score >= 0.5)
