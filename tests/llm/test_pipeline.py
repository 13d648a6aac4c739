from __future__ import annotations

import re

import brute
import corpus_pipeline as cp
from pyspark.sql import functions as F

from shelfguard.llm import pieces, quality

PASSAGE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
LINE = "This very line stands in a good many of the documents here"


def _write(spark, path, docs, labels, bench):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def _brute(rows, scores, items):
    """The pipeline's texts by plain Python; the classifier's verdicts are given."""
    rows = [(i, t) for i, t in rows if scores[i]]
    said = re.compile(r"\S")
    rows = [(i, None if t is None else kept) for (i, t), (_, _, _, kept) in zip(rows, brute.lines(rows), strict=True) if not (t and said.search(t)) or said.search(kept)]
    groups = brute.near(rows, k=5)
    rows = sorted((i, t) for i, t in dict(rows).items() if groups[i][1] == i)
    out = {}
    for (i, t), (_, _, hit, _) in zip(rows, brute.leaks(rows, items), strict=True):
        at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
        for k in range(len(hit) - 1, -1, -1):
            if hit[k]:
                last = k
                while k and hit[k - 1]:
                    k -= 1
                if last == len(hit) - 1 or not hit[last + 1]:
                    t = t[: at[k][0]] + t[at[last][1] :]
                    hit[k : last + 1] = [False] * (last + 1 - k)
        if any(h is None for h in hit) or not (at and not said.search(t)):
            out[i] = t
    return out


def test_equals_brute_force(spark, tmp_path):
    path = str(tmp_path)
    filler = lambda i: " ".join(f"plain{(i * 37 + k * 11) % 97} words{k % 13}" for k in range(20))
    docs = [(i, f"{filler(i)}\n{LINE}\nA tail of {i}", "en", "s", 0) for i in range(12)]
    docs += [(20, docs[3][1], "de", "s", 0), (21, docs[3][1] + " x", "de", "s", 0), (22, f"Before it {PASSAGE}, and after.", "en", "s", 0), (23, PASSAGE, "en", "s", 0)]
    docs += [(30 + i, f"BUY!! NOW!! WIN{i}!! BUY!! NOW!! WIN!!", "en", "s", 0) for i in range(12)] + [(60, None, None, None, None), (61, "", "en", "s", 0), (62, LINE, "en", "s", 0), (63, LINE, "en", "s", 0)]
    labels = [(d[0], int(not (d[1] or "").startswith("BUY")), 0) for d in docs if d[0] < 60]
    items = [(1, PASSAGE), (2, "plain99 words99")]
    _write(spark, path, docs, labels, items)
    table = spark.read.parquet(f"{path}/documents.parquet")
    scores = {r.doc_id: r.predicted for r in quality.classify(table, spark.read.parquet(f"{path}/labels.parquet")).collect()}
    out = cp.run(spark, path).collect()
    got = {r.doc_id: r.text for r in out}
    assert got == _brute([(d[0], d[1]) for d in docs], scores, items) and len(got) == len(out)
    assert got[22] == "Before it , and after." and 23 not in got and 21 not in got and not any(30 <= i < 42 for i in got)
    decoder = pieces.Decoder(pieces.MODEL)
    assert all(r.text is None or decoder.decode(r.ids) == r.text and r.round_trip and r.n_chars == len(r.text) for r in out)


def test_stages_keep_the_columns_and_empty_tables(spark, tmp_path, small):
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination", "SentencePiece encoding"]
    for base in (spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 25"), spark.read.parquet(f"{small}/documents.parquet").where("false")):
        docs = base.withColumn("spans", F.lit("mine")).withColumn("kept", F.lit("mine"))
        for k, (_, step) in enumerate(cp.STAGES):
            out = step(spark, docs, small)
            assert out.columns[:5] == list(cp.COLUMNS) and (k == 4 or len(out.columns) == 5)
            assert out.count() <= base.count()
