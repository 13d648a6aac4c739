"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL.

Features. A text is cut into words (runs of letters and digits) and marks (runs of
other visible characters). Each token gives its lower-cased surface and its shape
(upper, lower, title, digits, mark with its character); single tokens and pairs of
neighbours of both streams are hashed into ``2 ** BITS`` columns. A column's value is
``1 + log(count)``, and the vector is scaled to length 1, so texts of any length are
comparable. A second block of columns, scaled alike, hashes each shape (and shape pair)
with its share of the text, and the share of word n-grams that are repeats, in steps. Only the text is read: no id, language, source or label is an input.

Training. At most ``MAX_SAMPLE`` labelled documents (a documented bound; chosen by a
hash of the id) with crc32(doc_id) mod 3 other than 1 are dealt into ``SHARDS`` parts.
Each part runs follow-the-regularised-leader (per-coordinate rates, L1 and L2) over
its documents in hash order, ``EPOCHS`` times, as one Spark task; the parts' weights are
averaged. What reaches the driver is the model, ``2 ** BITS`` numbers at most.

Scoring is a sparse dot product and the logistic function, in one pass over all
documents without a shuffle.

Defined results: a null or empty text has only the bias column; rows with a null id are scored
and count as held out; labels with a null quality are ignored, and a document with
contradicting labels is not trained on; without any label all scores are 0.5. Repeated rows are scored alike.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import give_back, in_small_batches, tidy

BITS = 18
MAX_SAMPLE = 20_000
SHARDS = 4
EPOCHS = 5
#: Learning rate, its offset, L1 and L2 of follow-the-regularised-leader.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
#: Tokens a worker remembers before it starts anew.
CACHE = 400_000

_TOKEN = re.compile(r"[^\W_]+|(?:_|[^\w\s])+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(token: str) -> str:
    if not token[0].isalnum():
        return token[:3] if len(token) > 1 else token
    if token.isdigit():
        return "9" * min(len(token), 5)
    if token.isupper():
        return "XX" if len(token) > 1 else "X"
    return "Xx" if token[0].isupper() else "x"


class _Tokens(dict):
    """Numbers tokens as they come and hashes their surface and shape."""

    def __init__(self):
        self.surface, self.shape = array("Q"), array("Q")

    def __missing__(self, token: str) -> int:
        from xxhash import xxh64_intdigest

        k = self[token] = len(self.surface)
        self.surface.append(xxh64_intdigest(token.lower(), 1))
        self.shape.append(xxh64_intdigest(_shape(token), 2))
        return k


class Featurizer:
    def __init__(self, bits: int = BITS, cache: int = CACHE):
        self.shift, self.cache = np.uint64(64 - bits), cache
        self.tokens = _Tokens()

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(columns, values) of each text; column 0 is the bias."""
        if len(self.tokens) > self.cache:
            self.tokens = _Tokens()
        tokens = self.tokens
        rows = [np.array([tokens[t] for t in _TOKEN.findall(x)] if x else [], dtype=np.int64) for x in texts]
        surface, shape = np.array(tokens.surface, dtype=np.uint64), np.array(tokens.shape, dtype=np.uint64)
        return [self._row(surface[r], shape[r]) for r in rows]

    def _row(self, surface: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = [(s[:-1] ^ (s[1:] >> np.uint64(7))) * _MIX + s[1:] for s in (surface, shape)]
        grams = (np.concatenate([surface, shape, *pairs]) * _MIX) >> self.shift
        grams, counts = np.unique(grams, return_counts=True)
        values = [1.0 + np.log(counts)]
        blocks = [grams]
        if len(shape):
            shapes, counts = np.unique(np.concatenate([shape, pairs[1]]), return_counts=True)
            steps = np.floor(2 * np.log2(counts / len(shape) * 1024 + 1)).astype(np.uint64)
            shares = (shapes ^ (steps + np.uint64(1)) * _MIX) * _MIX
            blocks.append((np.concatenate([shares, self._repeats(surface, pairs[0])]) * _MIX) >> self.shift)
            values.append(np.ones(len(blocks[-1])))
        cols = np.concatenate([np.zeros(1, dtype=np.int32), *[b.astype(np.int32) + 1 for b in blocks]])
        return cols, np.concatenate([np.ones(1), *[v / np.sqrt(max(1.0, (v * v).sum())) for v in values]])

    @staticmethod
    def _repeats(words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """One hash for each of: share of repeated words, of repeated pairs, of words like one of the four before."""
        near = np.zeros(len(words), dtype=bool)
        for d in range(1, 5):
            near[d:] |= words[d:] == words[:-d]
        shares = [1 - len(np.unique(x)) / max(1, len(x)) for x in (words, pairs)] + [near.mean()]
        length = np.uint64(min(10, len(words).bit_length()))
        steps = np.array([10_007 * (k + 1) + int(20 * s) for k, s in enumerate(shares)], dtype=np.uint64) * _MIX
        steps[:2] ^= length
        return steps


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, float]], size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over (columns, values, label) rows."""
    z, n = np.zeros(size), np.zeros(size)

    def weights(cols) -> np.ndarray:
        zc = z[cols]
        w = -(zc - np.sign(zc) * L1) / ((BETA + np.sqrt(n[cols])) / ALPHA + L2)
        w[np.abs(zc) <= L1] = 0.0
        return w

    for _ in range(epochs):
        for cols, values, label in rows:
            values = values.astype(np.float64)
            w = weights(cols)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            g2 = g * g
            sigma = (np.sqrt(n[cols] + g2) - np.sqrt(n[cols])) / ALPHA
            z[cols] += g - sigma * w
            n[cols] += g2
    return weights(np.arange(size))


def training_sample(docs: DataFrame, labels: DataFrame, target: str = "quality", max_sample: int = MAX_SAMPLE) -> DataFrame:
    """(doc_id, text, label) of at most about ``max_sample`` documents that may be learned from."""
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
        .where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
        .groupBy("doc_id")
        .agg(F.min(target).alias("label"), F.max(target).alias("other"))
        .where("label = other")
        .select("doc_id", F.col("label").cast("double").alias("label"))
    )
    spread = 1 << 30
    limit = min(spread, int(spread * max_sample / max(1, usable.count())))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < limit)
    # At most about max_sample rows of 16 bytes: a proven bound for the broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", max_sample: int = MAX_SAMPLE) -> np.ndarray:
    size = (1 << BITS) + 1
    sample = training_sample(docs, labels, target, max_sample).withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(SHARDS)))

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(text=part["text"].fillna("")).sort_values(["rank", "doc_id", "text"])
        rows, featurizer = [], Featurizer()
        for at in range(0, len(part), 256):
            rows += [(c, v.astype(np.float32)) for c, v in featurizer(part["text"].iloc[at : at + 256].tolist())]
        w = ftrl([(c, v, y) for (c, v), y in zip(rows, part["label"], strict=True)], size)
        used = np.flatnonzero(w)
        del rows, featurizer, part
        give_back()
        return pd.DataFrame({"feature": used, "weight": w[used]})

    parts = (
        sample.withColumn("rank", F.xxhash64("text", "doc_id")).groupBy("shard").applyInPandas(fit, "feature int, weight double")
    )
    # Sorted before the sum: the same model from the same rows, in any task order.
    merged = parts.groupBy("feature").agg(F.sort_array(F.collect_list("weight")).alias("w"))
    merged = merged.select("feature", F.aggregate("w", F.lit(0.0), lambda a, x: a + x).alias("weight"))
    model = np.zeros(size)
    for feature, weight in merged.collect():
        model[feature] = weight / SHARDS
    return model


def score(docs: DataFrame, model: np.ndarray, text: str = "text", to: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    @tidy
    def logistic(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, w = Featurizer(), shared.value
        for batch in batches:
            out = []
            for at in range(0, len(batch), 256):
                texts = [x if isinstance(x, str) else None for x in batch.iloc[at : at + 256]]
                out += [1.0 / (1.0 + np.exp(-np.clip(w[c] @ v, -35, 35))) for c, v in features(texts)]
            yield pd.Series(out, dtype="float64")

    return in_small_batches(docs).withColumn(to, logistic(F.col(text)))


def classify(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """``docs`` with score and predicted, by a model trained on ``labels``."""
    rows = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])
    out = score(rows, train(docs, labels, max_sample=max_sample))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = classify(docs.select("doc_id", "text"), labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(True))
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")
