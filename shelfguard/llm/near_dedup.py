r"""MinHash near-dedup with b-bit signatures.

A text's words are ``[^\x20\x09-\x0D]+`` after A-Z is lower-cased; its set are the distinct
``k``-word shingles (a shorter text: its whole sequence as one). Documents link when
``100 * intersection >= percent * union``; a component keeps its smallest doc_id.

Method.

1. One pass over the texts gives each document its set's size and digest, ``BANDS`` band
   keys of ``ROWS`` minima each, and the low ``BITS`` bits of all minima, packed.
2. Equal sets meet by digest in a map-side combined grouping and go on as one
   representative (the row of the smallest doc_id, under a number of its own), however many
   copies there are.
3. Representatives meet by band key. Each bucket's smallest is a leader and paired with all others:
   as many pairs as members, not their square. A pair whose signatures' equal bits, corrected
   for chance, estimate a similarity more than ``SLACK`` standard errors below the
   threshold is left out; the others are confirmed on their full sets.
4. Two members may link with each other but not with their leader. Buckets of
   three or more (equal ones once) go in blocks of at most ``2 * BLOCK`` members, every two chunks
   of a large bucket meeting in one block. Blocks first drop members without a likely
   partner, by bit counts; where the rest is not yet connected, an inverted
   index over the block's full sets gives exact intersections, and the block
   returns a spanning set of links, never all pairs.
5. Connected components over the links, each named by its smallest doc_id; every copy gets its
   representative's.

At similarity 0.8 a pair shares no band with probability ``(1 - 0.8 ** 5) ** 32``, 3 in a million.

Defined results: null, empty and word-less texts have an empty set and link with nothing; a row
without doc_id is not compared (no component, kept). Rows of one doc_id with different texts are
judged each by its own text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches, stage, tidy
from shelfguard.llm.components import connected_components

SHINGLE, PERCENT = 5, 80
BANDS, ROWS, BITS = 32, 5, 2
HASHES = BANDS * ROWS
#: Standard errors of the estimate by which a pair may fall short of the threshold.
SLACK = 5.0
BLOCK = 1024
#: Words a worker remembers before it starts anew.
CACHE = 400_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_LOW = np.uint64(0x5555555555555555)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        h = self[word] = xxh64_intdigest(word)
        return h


class Shingler:
    """Sorted 64-bit hashes of a text's distinct shingles."""

    def __init__(self, k: int = SHINGLE):
        self.k, self.words = k, _Words()

    def __call__(self, text: str | None) -> np.ndarray:
        known = self.words
        if len(known) > CACHE:
            known.clear()
        w = np.array([known[x] for x in text.encode("utf-8", "replace").lower().split()] if text else [], dtype=np.uint64)
        k = min(self.k, len(w))
        if not k:
            return w
        h = np.full(len(w) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            h = h * _M1 + w[i : len(w) - k + 1 + i]
        return np.unique(_mixed(h))


class MinHash:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = rng.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        low = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
        for at in range(0, len(x), 512):
            part = x[at : at + 512] * self.a
            part += self.b
            np.minimum(low, part.min(axis=1), out=low)
        return low

    @staticmethod
    def packed(minima: np.ndarray) -> np.ndarray:
        """The low bits, 64 // BITS minima to a word."""
        per = 64 // BITS
        bits = np.zeros(-(-HASHES // per) * per, dtype=np.uint64)
        bits[:HASHES] = minima & np.uint32((1 << BITS) - 1)
        shifts = np.arange(per, dtype=np.uint64) * np.uint64(BITS)
        return np.bitwise_or.reduce(bits.reshape(-1, per) << shifts, axis=1)

    @staticmethod
    def bands(minima: np.ndarray) -> np.ndarray:
        h = np.arange(1, BANDS + 1, dtype=np.uint64)
        for row in minima.reshape(BANDS, ROWS).T.astype(np.uint64):
            h = _mixed(h * _M2 + row)
        return h


def least_matches(percent: int) -> int:
    """Equal minima below which a pair of that similarity is ``SLACK`` standard errors away."""
    chance = 0.5**BITS
    p = percent / 100 * (1 - chance) + chance
    return int(np.floor(HASHES * p - SLACK * np.sqrt(HASHES * p * (1 - p))))


def features(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_id, n_shingles, set_id, sig, bands); the last three null for empty sets."""
    result = T.StructType(
        [
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_id", T.BinaryType()),
            T.StructField("sig", T.ArrayType(T.LongType())),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    @F.pandas_udf(result)
    @tidy
    def signature(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler, minhash = Shingler(k), MinHash()
        for batch in batches:
            n, ids, sigs, bands = [], [], [], []
            for text in batch:
                s = shingler(text if isinstance(text, str) else None)
                n.append(len(s))
                if not len(s):
                    ids.append(None), sigs.append(None), bands.append(None)
                    continue
                low = minhash.minima(s)
                ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sigs.append(minhash.packed(low).view(np.int64))
                bands.append(minhash.bands(low).view(np.int64))
            yield pd.DataFrame({"n_shingles": np.array(n, dtype=np.int64), "set_id": ids, "sig": pd.Series(sigs, dtype=object), "bands": pd.Series(bands, dtype=object)})

    return in_small_batches(docs).select("doc_id", F.xxhash64("text").alias("text_id"), signature("text").alias("f")).select("doc_id", "text_id", "f.*")


def _matches(x: str, y: str) -> Column:
    """Equal minima of two packed signatures (padding counts as equal)."""

    def differ(p: Column, q: Column) -> Column:
        z = p.bitwiseXOR(q)
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return F.lit(HASHES) - F.aggregate(F.zip_with(x, y, differ), F.lit(0), lambda n, d: n + d)


def _similar_size(n: str, m: str, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def leader_pairs(reps: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """(a, b): each bucket's leader with its other members, where the estimate allows a link."""
    members = reps.select("rep", F.explode("bands").alias("key"))
    pairs = members.join(leaders, "key").where("rep <> leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    own = reps.select("rep", "n_shingles", "sig")
    both = pairs.join(own.toDF("a", "na", "sa"), "a").join(own.toDF("b", "nb", "sb"), "b")
    return both.where(_similar_size("na", "nb", percent) & (_matches("sa", "sb") >= least_matches(percent))).select("a", "b")


def crowd_blocks(reps: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """(key, i, j, rep): members of blocks that have a likely partner in the block."""
    members = reps.select("rep", "n_shingles", "sig", F.explode("bands").alias("key"))
    crowds = leaders.where("n >= 3")
    # Buckets of the same members are looked at once.
    content = members.join(crowds.select("key"), "key").groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("xor")
    )
    crowds = stage(content.groupBy("n", "sum", "xor").agg(F.min("key").alias("key")).select("key", "n"), "crowds")
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = members.join(crowds, "key").withColumn("chunks", chunks)
    rows = rows.withColumn("c", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"), "rep", "n_shingles", "sig")
    least = least_matches(percent)

    def likely(block: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        sig = np.stack(block["sig"]).astype(np.int64).view(np.uint64)
        size = block["n_shingles"]
        found = np.zeros(len(size), dtype=bool)
        for x in range(len(size) - 1):
            z = sig[x + 1 :] ^ sig[x]
            equal = HASHES - np.bitwise_count((z | (z >> np.uint64(1))) & _LOW).sum(axis=1)
            small, large = np.minimum(size[x], size[x + 1 :]), np.maximum(size[x], size[x + 1 :])
            hit = (equal >= least) & (small * 100 >= large * percent)
            found[x] |= hit.any()
            found[x + 1 :] |= hit
        return {c: block[c][found] for c in ("key", "i", "j", "rep")}

    return _by_block(rows, likely, "key long, i int, j int, rep long")


def _by_block(rows: DataFrame, f, schema: str) -> DataFrame:
    """``f`` over the columns of every (key, i, j): one sorted stream a task, not one call a block."""
    keys = ["key", "i", "j"]

    @tidy
    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict] = []
        last = None

        def close() -> dict:
            whole = held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}
            held.clear()
            return f(whole)

        for batch in batches:
            columns = {c: batch[c].to_numpy() for c in batch.columns}
            if not len(batch):
                continue
            k = np.stack([columns[c] for c in keys], axis=1)
            edges = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
            out = []
            for at, end in zip(edges[:-1], edges[1:], strict=True):
                if held and last != tuple(k[at]):
                    out.append(close())
                held.append({c: v[at:end] for c, v in columns.items()})
                last = tuple(k[at])
            if out:
                yield pd.DataFrame({c: np.concatenate([o[c] for o in out]) for c in out[0]})
        if held:
            yield pd.DataFrame(close())

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(stream, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    @F.pandas_udf(T.BooleanType())
    @tidy
    def linked(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shingler = Shingler(k)
        last, left = None, None
        for a, x, y in batches:
            out = []
            for key, own, other in zip(a, x, y, strict=True):
                if key != last:  # rows of one leader come together
                    last, left = key, shingler(own)
                right = shingler(other)
                common = len(np.intersect1d(left, right, assume_unique=True))
                out.append(100 * common >= percent * (len(left) + len(right) - common))
            yield pd.Series(out, dtype=bool)

    rows = pairs.join(texts.toDF("b", "y"), "b").join(texts.toDF("a", "x"), "a")
    return rows.where(linked("a", "x", "y")).select("a", "b")


def crowd_links(blocks: DataFrame, texts: DataFrame, parts: DataFrame, k: int, percent: int) -> DataFrame:
    """Spanning links of the blocks that are not connected yet. ``parts``: (node, component) so far."""
    rows = blocks.join(parts.withColumnRenamed("node", "rep"), "rep", "left").withColumn("part", F.coalesce("component", "rep"))
    rows = stage(rows.select("key", "i", "j", "rep", "part"), "crowd-parts")
    open_ = rows.groupBy("key", "i", "j").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("key", "i", "j")
    rows = rows.join(open_, ["key", "i", "j"]).join(texts.toDF("rep", "text"), "rep")
    shingler = None

    def links(block: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        nonlocal shingler
        shingler = shingler or Shingler(k)
        reps = block["rep"]
        sets = [shingler(t) for t in block["text"]]
        size = np.array([len(s) for s in sets])
        # Inverted index: shingle number -> members; one count of postings gives
        # a member's exact intersections with all others.
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        member = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(number, kind="stable")
        posting, first = member[order], np.searchsorted(number[order], np.arange(number.max() + 2))
        cut = np.concatenate([[0], np.cumsum(size)])
        root = np.unique(block["part"], return_inverse=True)[1]  # members known to be connected
        found = []
        for x in range(len(sets)):
            if (root == root[x]).all():
                continue
            own = number[cut[x] : cut[x + 1]]
            lens = first[own + 1] - first[own]
            at = np.repeat(first[own] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
            common = np.bincount(posting[at], minlength=len(sets))
            near = np.flatnonzero(100 * common >= percent * (size + size[x] - common))
            for y in near:
                if root[y] != root[x]:
                    found.append((reps[x], reps[y]))
                    root[root == root[y]] = root[x]
        pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
        return {"a": pairs[:, 0], "b": pairs[:, 1]}

    return _by_block(rows.select("key", "i", "j", "rep", "part", "text"), links, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each of ``docs`` (doc_id, text): doc_id, text_id (a hash), n_shingles, component_id, kept."""
    found = stage(features(docs.select("doc_id", "text"), k), "near-features")
    sets = found.where("doc_id is not null and set_id is not null")
    rest = ["text_id", "n_shingles", "sig", "bands"]
    reps = sets.groupBy("set_id").agg(F.min(F.struct("doc_id", *rest)).alias("r"))
    # One doc_id may be the smallest of several sets (rows of different texts), so each set gets a number.
    reps = reps.select(F.monotonically_increasing_id().alias("rep"), "set_id", "r.doc_id", *[f"r.{c}" for c in rest])
    reps = stage(reps, "near-reps")
    buckets = reps.select("rep", F.explode("bands").alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("leader"))
    leaders = stage(buckets.where("n >= 2"), "near-leaders")
    pairs = stage(leader_pairs(reps, leaders, percent), "near-pairs")
    blocks = stage(crowd_blocks(reps, leaders, percent), "near-blocks")
    ids = [pairs.select(F.col("a").alias("rep")), pairs.select(F.col("b").alias("rep")), blocks.select("rep")]
    wanted = reps.select("rep", "doc_id", "text_id").join(ids[0].unionByName(ids[1]).unionByName(ids[2]).distinct(), "rep", "left_semi")
    # The only time that texts are shuffled; rows without a likely partner stay behind.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_id")).join(wanted, ["doc_id", "text_id"])
    texts = stage(texts.dropDuplicates(["doc_id", "text_id"]).select("rep", "text"), "near-texts")
    links = stage(confirmed(pairs, texts, k, percent), "near-links")
    parts = connected_components(links)
    more = crowd_links(blocks, texts, parts, k, percent)
    parts = connected_components(parts.toDF("a", "b").unionByName(more))
    nodes = stage(parts.withColumnRenamed("node", "rep").join(reps.select("rep", "doc_id"), "rep"), "near-nodes")
    least = stage(nodes.groupBy("component").agg(F.min("doc_id").alias("component_id")), "near-least")
    nodes = nodes.join(least, "component").select("rep", "component_id")
    groups = reps.select("set_id", "rep", "doc_id").join(nodes, "rep", "left")
    groups = stage(groups.select("set_id", F.coalesce("component_id", "doc_id").alias("component_id")), "near-groups")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    found = found.select("doc_id", "text_id", "n_shingles", "set_id").join(groups, "set_id", "left")
    return found.select(
        "doc_id", "text_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each component of ``docs``: its smallest doc_id's. Rows without doc_id stay."""
    key = ["doc_id", "_text_id"]
    judged = near_duplicates(docs, k, percent).where("kept and doc_id is not null").select("doc_id", F.col("text_id").alias("_text_id"))
    rows = docs.withColumn("_text_id", F.xxhash64("text"))
    # The join already deals the rows by the key that repeats are dropped on.
    one = rows.where("doc_id is not null").join(judged.distinct(), key, "left_semi").dropDuplicates(key)
    return one.unionByName(rows.where("doc_id is null")).select(*docs.columns)


def op4_near_dedup(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"), k=4).select("doc_id", "n_shingles", "component_id", "kept")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(x, y) AS (SELECT doc_id, doc_id FROM w UNION SELECT x, b FROM reach JOIN e ON a = y),
comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""
