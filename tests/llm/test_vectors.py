from __future__ import annotations

import brute
import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import vector_dedup as vd

SCHEMA = "vec_id long, embedding array<float>, label int"


def _expected(rows, threshold=0.95):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    links, count = [], {}
    for a, (i, x) in enumerate(good):
        for b, (j, y) in enumerate(good):
            if a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links.append((i, j))
                count[i] = count.get(i, 0) + 1
    part = brute.components([i for i, _ in rows], links)
    return sorted((i, count.get(i, 0), part[i], part[i] == i) for i, _ in rows)


def _got(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted(tuple(r) for r in vd.near_vectors(df, **kw).collect())


@pytest.mark.parametrize("chunk", [8, vd.CHUNK])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(vd, "CHUNK", chunk)
    monkeypatch.setattr(vd, "QUERIES", 4 * chunk)
    rng = np.random.default_rng(chunk)
    x = rng.normal(size=(60, 16))
    near = np.repeat(x[:10], 8, axis=0) + rng.normal(size=(80, 16)) * rng.choice([0.05, 0.2, 0.3], size=(80, 1))
    rows = [(3 * i + 1, v.tolist()) for i, v in enumerate(np.concatenate([x, near, x[:3], x[:3], 4 * x[5:7], -x[8:9]]))]
    got, wanted = _got(spark, rows, sigmas=16.0), _expected(rows)
    assert got == wanted and sum(r[1] for r in got) > 100


def test_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v), (2, v), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 2.0]), (7, [1.0, float("nan"), 2.0]), (8, [1.0, float("inf"), 2.0])]
    rows += [(9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (11, [1e-30, 2e-30, 3e-30]), (12, [3e37, 6e37, 9e37]), (13, [3.0, -1.0, 0.0])]
    got = {r[0]: r for r in _got(spark, rows)}
    assert {i: (got[i][1], got[i][2]) for i in (1, 2, 9, 11, 12)} == {i: (4, 1) for i in (1, 2, 9, 11, 12)}
    assert all(got[i] == (i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 10, 13))
    again = spark.createDataFrame([(1, v, 0), (1, v, 0), (None, v, 0)], SCHEMA).withColumn("rep", F.lit(9)).withColumn("n_links", F.lit("x"))
    assert sorted(map(str, vd.near_vectors(again).collect())) == sorted(
        ["Row(vec_id=1, n_links=1, component_id=1, kept=True)"] * 2 + ["Row(vec_id=None, n_links=0, component_id=None, kept=True)"]
    )
    assert _got(spark, []) == [] and _got(spark, [(1, None)]) == [(1, 0, 1, True)]


@pytest.mark.parametrize("chunk", [8, vd.CHUNK])
def test_every_length_is_compared_as_in_the_sql(spark, monkeypatch, chunk):
    monkeypatch.setattr(vd, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(12, 16)), rng.normal(size=(10, 6))
    y = np.concatenate([y, y[:2], y[:2], 2 * y[2:4], y[4:6] + 0.05 * rng.normal(size=(2, 6))])
    rows = list(enumerate([*np.concatenate([x, x[:5]]).tolist(), *y.tolist(), [1.0, 2.0], [2.0, 4.0], [3.0]], 1))
    got = _got(spark, rows, sigmas=16.0)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert got == sorted(con.execute(vd.SQL).fetchall()) == _expected(rows)
    assert sum(r[1] > 0 for r in got[17:]) >= 12


@pytest.fixture
def searches(monkeypatch):
    """How often the index was searched."""
    seen, search = [], vd._search
    monkeypatch.setattr(vd, "_search", lambda *a: seen.append(1) or search(*a))
    return seen


def _recall(df, rows):
    x = np.array([r.embedding for r in rows], dtype=float)
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    wanted = np.concatenate([(x[at : at + 2048] @ x.T >= 0.95).sum(axis=1) - 1 for at in range(0, len(x), 2048)])
    got = {r.vec_id: r.n_links for r in vd.op6_vector_dedup(df).collect()}
    found = np.array([got[r.vec_id] for r in rows])
    assert (found <= wanted).all()
    return found.sum(), wanted.sum()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, searches, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    found, wanted = _recall(df, df.collect())
    assert searches and found >= 0.99 * wanted


def test_recall_on_twenty_thousand_vectors(spark, searches):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(400, 32))
    x = np.repeat(centre, 30, axis=0) + 0.35 * rng.normal(size=(12000, 32))  # clusters about as wide as the threshold
    x = np.concatenate([x, rng.normal(size=(8000, 32))])
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.astype(np.float32).tolist()}), "vec_id long, embedding array<float>")
    found, wanted = _recall(df, df.collect())
    assert searches and wanted > 5_000 and found >= 0.99 * wanted


def test_two_vectors_of_one_id_are_two_nodes(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a), (1, b), (2, [1.0, 0.01, 0.0]), (3, [0.01, 1.0, 0.0]), (9, [0.0, 0.0, 1.0])]
    assert _got(spark, rows) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (9, 0, 9, True)]


def test_doubles_beyond_the_range_of_floats(spark):
    rows = [(1, [1e200, 2e200], 0), (2, [1e200, 2e200], 0), (3, [2e-300, 4e-300], 0), (4, [1e200, -2e200], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(tuple(r) for r in vd.near_vectors(df).collect()) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (4, 0, 4, True)]


def test_quantised_products_stay_within_their_error():
    rng = np.random.default_rng(2)
    x = vd.unit(rng.normal(size=(500, 24))).astype(np.float32)
    index = vd.Index(x, 12)
    cell, codes, error = index.encode(x)
    for c in range(12):
        own = cell == c
        if own.any():
            close = index.products(x, c, codes[own])
            assert (np.abs(close - x[own] @ x.T) <= error[own][:, None] + 1e-4).all()


@pytest.mark.parametrize(("dim", "rank"), [(384, 6), (768, 4), (768, 10), (1024, 8)])
def test_wide_vectors_of_few_directions_keep_their_links(dim, rank):
    rng = np.random.default_rng(rank)
    x = vd.unit(rng.normal(size=(5000, rank)) @ rng.normal(size=(rank, dim))).astype(np.float32)
    index = vd.Index(x, 71)
    cell = vd.nearest(x, index.centre)
    probed = np.zeros((len(x), 71), dtype=bool)
    probed[index.probes(x, cell)] = True
    a, b = np.nonzero(np.triu(x @ x.T >= vd.THRESHOLD, 1))
    low, high = np.where(cell[a] <= cell[b], a, b), np.where(cell[a] <= cell[b], b, a)
    assert len(a) > 20 and probed[low, cell[high]].mean() >= 0.999
