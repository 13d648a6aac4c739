"""Embedding near-dedup: inverted lists with product-quantised residuals, exact rerank.

Vectors link when their cosine, in double precision, is at least ``threshold``; a component
keeps its smallest vec_id.

Method. Equal vectors first become one representative with a number of copies, by a map-side
combined grouping; each distinct vector is a node under a number of its own, whatever ids it has.
Vectors of different lengths never link, so each length gets an index of its own, one after
the other, however many vectors it has. On a bounded sample (``SAMPLE`` vectors, one
task) k-means gives coarse centroids, as many as the square root of the vectors (``LISTS`` at most), and a codebook
for each of ``PARTS`` subspaces of the residuals. Every vector is indexed: its list, its
residual codes, and the length of its quantisation error.

Search. Two unit vectors of that cosine are at most ``d = sqrt(2 - 2 * threshold)`` apart. If a
vector's partner is nearer to centroid c than to the vector's own, the vector is at most d
from the plane half-way between both. How far a difference of length d reaches across such
planes depends on the data: in ``n`` directions alike its standard deviation is ``d / sqrt(n)``,
but embeddings of a wide model may differ in few directions. The sample tells: ``PILOT`` of its
vectors are compared with all others, and the margin is ``SIGMAS`` times the largest of that
value, of the spread of near neighbours and of the spread of linked pairs along the normals of
the nearest borders, at least ``SAFETY`` times what any linked pair of the sample needed, and d at
most. Every list within the margin is probed (``SIGMAS = sqrt(n)`` or more loses no pair at all). Each pair of lists is probed
from the lower side only and counts for both vectors. In a block, asymmetric table
look-ups give approximate products; those that reach the threshold less the stored error
length are reranked by exact cosines, so quantisation loses nothing.

A list is dealt in chunks of about ``CHUNK`` vectors, its queries in parts of about
``QUERIES``, both from counts per list; a block returns a count for each vector and
spanning links, never pairs. Centroids, codebooks and counts per list are bounded by the parameters;
the driver holds one length's at a time, and a count for each length.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link
with nothing (component: their own id); all others with those of their own length. Components
are floats where the column holds floats, else doubles. Every row is a vector of its own: rows that
repeat a vector link with each other, also under one vec_id, and two vectors of one vec_id are
judged each by itself. A row without vec_id links with nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfguard.llm.common import stage
from shelfguard.llm.components import connected_components

THRESHOLD = 0.95
SAMPLE, LISTS, PARTS, CODES = 32_768, 2_048, 8, 256
SIGMAS = 4.0
#: The margin is measured on so many vectors of the sample, each with so many neighbours and borders.
PILOT, AROUND, SAFETY = 1_024, 8, 1.25
CHUNK, QUERIES = 2_048, 16_384
ROUNDS = 8


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    centre = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    for _ in range(ROUNDS):
        near = nearest(x, centre)
        order = np.argsort(near, kind="stable")
        used, first = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        centre[used] = sums / np.diff([*first, len(x)])[:, None]
    return centre


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    half = (centre * centre).sum(axis=1) / 2
    out = np.empty(len(x), dtype=np.int64)
    for at in range(0, len(x), 4096):
        out[at : at + 4096] = (x[at : at + 4096] @ centre.T - half).argmax(axis=1)
    return out


class Index:
    """Centroids and codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float = THRESHOLD, sigmas: float = SIGMAS, seed: int = 11):
        dim = sample.shape[1]
        self.centre = k_means(sample, lists, seed).astype(np.float32)
        rest = sample - self.centre[nearest(sample, self.centre)]
        cuts = np.linspace(0, dim, min(PARTS, dim) + 1).astype(int)
        self.parts = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        self.book = [k_means(np.ascontiguousarray(rest[:, a:b]), CODES, seed + 1 + i).astype(np.float32) for i, (a, b) in enumerate(self.parts)]
        self.apart = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        gap = self.centre[:, None, :] - self.centre[None, :, :] if len(self.centre) <= 256 else None
        if gap is not None:
            self.gap = np.sqrt((gap * gap).sum(axis=2))
        else:
            sq = (self.centre * self.centre).sum(axis=1)
            self.gap = np.sqrt(np.maximum(sq[:, None] + sq[None, :] - 2 * self.centre @ self.centre.T, 0))
        self.half = (self.centre * self.centre).sum(axis=1) / 2
        self.margin = self.apart if sigmas >= np.sqrt(dim) else self._measured(sample, threshold, sigmas, seed)

    def _measured(self, x: np.ndarray, threshold: float, sigmas: float, seed: int) -> float:
        """The distance from a border up to which the list behind it is probed."""
        rng = np.random.default_rng(seed)
        cell = nearest(x, self.centre)
        spread, need = 1 / x.shape[1], 0.0
        sums = np.zeros((2, 2))  # squares along normals and their number: of neighbours, of linked pairs
        pilots = rng.permutation(len(x))[:PILOT]
        around, borders = min(AROUND, len(x) - 1), min(AROUND, len(self.centre) - 1)
        if not around or not borders:
            return self.apart
        for at in range(0, len(pilots), 128):
            p = pilots[at : at + 128]
            close = x[p] @ x.T
            close[np.arange(len(p)), p] = -2
            near = np.argpartition(close, -around, axis=1)[:, -around:].ravel()
            own = np.repeat(p, around)
            same = cell[own] == cell[near]
            i, j = np.nonzero(close >= threshold)
            some = rng.permutation(len(i))[:2048]
            for kind, (a, b) in enumerate([(own[same], near[same]), (p[i[some]], j[some])]):
                if len(a):
                    squares, crossing = self._across(x, a, b, cell, borders)
                    sums[kind] += squares.sum(), squares.size
                    if kind and len(crossing):
                        need = max(need, float(crossing.max()))
        spread = np.sqrt(max([spread, *[total / n for total, n in sums if n]]))
        return min(self.apart, max(self.apart * sigmas * spread, SAFETY * need))

    def _across(self, x: np.ndarray, a: np.ndarray, b: np.ndarray, cell: np.ndarray, borders: int) -> tuple[np.ndarray, np.ndarray]:
        """Squares of the unit differences of pairs along the normals of the nearest borders; the margins
        that pairs of two lists need."""
        rows = np.arange(len(a))
        score, other = x[a] @ self.centre.T - self.half, x[b] @ self.centre.T - self.half
        home, gap = cell[a], np.maximum(self.gap[cell[a]], 1e-9)
        to_border = (score[rows, home][:, None] - score) / gap
        to_border[rows, home] = np.inf
        to = np.argpartition(to_border, borders - 1, axis=1)[:, :borders]
        moved = other - score
        along = (np.take_along_axis(moved, to, 1) - moved[rows, home][:, None]) / np.take_along_axis(gap, to, 1)
        length = np.sqrt(((x[a] - x[b]) ** 2).sum(axis=1))
        two = np.flatnonzero(cell[a] < cell[b])
        return (along / np.maximum(length, 1e-9)[:, None]) ** 2, to_border[two, cell[b[two]]]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, length of the quantisation error) of unit vectors."""
        cell = nearest(x, self.centre)
        rest = x - self.centre[cell]
        codes = np.empty((len(x), len(self.parts)), dtype=np.uint8)
        error = np.zeros(len(x))
        for i, (a, b) in enumerate(self.parts):
            codes[:, i] = nearest(np.ascontiguousarray(rest[:, a:b]), self.book[i])
            off = rest[:, a:b] - self.book[i][codes[:, i]]
            error += (off * off).sum(axis=1)
        return cell, codes, np.sqrt(error)

    def probes(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list from each vector's own upwards whose border is within the margin."""
        score = x @ self.centre.T - self.half
        to_border = score[np.arange(len(x)), cell][:, None] - score
        hit = to_border <= (self.margin + 1e-5) * self.gap[cell]
        hit &= np.arange(len(self.centre))[None, :] >= cell[:, None]
        hit[np.arange(len(x)), cell] = True
        return np.nonzero(hit)

    def products(self, x: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Approximate products, list vectors by queries."""
        out = np.broadcast_to((x @ self.centre[cell])[None, :], (len(codes), len(x))).copy()
        for i, (a, b) in enumerate(self.parts):
            out += (self.book[i] @ x[:, a:b].T)[codes[:, i]]
        return out


def vectors(column: np.ndarray, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype=kind) for v in column])


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    # Scaled by the largest component first: squares of very large or small ones stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked_pairs(index: Index, cell: int, listed: dict, queries: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(list row, query row) of the pairs of a block that reach the threshold."""
    x = queries["unit"].astype(np.float32)
    close = index.products(x, cell, listed["codes"])
    row, query = np.nonzero(close >= (threshold - listed["error"] - 1e-4)[:, None])
    # In its own list a pair comes twice: once from either side.
    once = (queries["cell"][query] != cell) | (queries["rep"][query] < listed["rep"][row])
    row, query = row[once], query[once]
    good = np.zeros(len(row), dtype=bool)
    for at in range(0, len(row), 1 << 16):
        s = slice(at, at + (1 << 16))
        good[s] = np.einsum("ij,ij->i", listed["unit"][row[s]], queries["unit"][query[s]]) >= threshold
    return row[good], query[good]


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For links (a, b): each node with the smallest one it reaches by them."""
    nodes, both = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = both[: len(a)], both[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _kind(embeddings: DataFrame) -> tuple[str, str]:
    """The components' type in Spark and in numpy: floats stay floats, all else is double."""
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    return ("float", "f4") if element == "float" else ("double", "f8")


def _sound(embeddings: DataFrame, v: Column) -> DataFrame:
    """(vec_id, v) of the rows that can link."""
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return embeddings.where("vec_id is not null").where(F.coalesce(sound, F.lit(False))).select("vec_id", v.alias("v"))


def fit(reps: DataFrame, n: int, threshold: float, sigmas: float, kind: str) -> Index:
    """Trained in one task on at most ``SAMPLE`` of the ``n`` vectors, chosen by a hash of the vector."""
    lists = int(min(LISTS, np.ceil(np.sqrt(n))))
    spread = 1 << 30
    share = min(spread, -(-spread * SAMPLE // n))
    sample = reps.where(F.pmod(F.xxhash64("k1", F.lit(3)), F.lit(spread)) < share).select("k1", "k2", "vec")

    def train(part: pd.DataFrame) -> pd.DataFrame:
        x = unit(vectors(part.sort_values(["k1", "k2"])["vec"].to_numpy(), kind)).astype(np.float32)
        return pd.DataFrame({"index": [pickle.dumps(Index(x, lists, threshold, sigmas))]})

    found = sample.groupBy(F.lit(1).alias("one")).applyInPandas(train, "index binary").first()
    if found is None:  # a tiny table whose hashes all fall outside the sample
        found = reps.select("k1", "k2", "vec").limit(SAMPLE).groupBy(F.lit(1).alias("one")).applyInPandas(train, "index binary").first()
    return pickle.loads(found[0])


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, sigmas: float = SIGMAS) -> DataFrame:
    """One row for each of ``embeddings`` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    embeddings = embeddings.select("vec_id", "embedding")
    element, kind = _kind(embeddings)
    v = F.col("embedding").cast(f"array<{element}>")
    key = [F.size("v").alias("dim"), F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(5), "v").alias("k2")]
    # Of equal vectors one travels on, with the smallest id and their number.
    reps = _sound(embeddings, v).groupBy(*key).agg(F.min(F.struct("vec_id", "v")).alias("r"), F.count("*").alias("copies"))
    reps = reps.select("dim", "k1", "k2", F.col("r.vec_id").alias("vec_id"), "copies", F.col("r.v").alias("v"), F.monotonically_increasing_id().alias("rep"))

    def as_bytes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="v").assign(vec=[np.asarray(x, dtype=kind).tobytes() for x in b["v"]])

    # Written once: the numbers stay.
    reps = stage(reps.mapInPandas(as_bytes, "dim int, k1 long, k2 long, vec_id long, copies long, rep long, vec binary"), "vec-reps")
    # One row a length.
    sizes = dict(reps.groupBy("dim").count().collect())
    found = []
    for d in sorted(sizes):
        own = reps.where(F.col("dim") == d)
        found.append(_search(spark, own, fit(own, sizes[d], threshold, sigmas, kind), threshold, kind))
    groups = _groups(reps, found)
    out = embeddings.withColumns({"dim": F.size(v), "k1": F.xxhash64(v), "k2": F.xxhash64(F.lit(5), v), "sound": F.col("vec_id").isNotNull()})
    out = out.join(stage(groups.withColumn("sound", F.lit(True)), "vec-groups"), ["dim", "k1", "k2", "sound"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


def tally(a: np.ndarray, b: np.ndarray, copies_a: np.ndarray, copies_b: np.ndarray) -> pd.DataFrame:
    """(node, n, to) of the links (a, b): how many vectors each node links with, and spanning links."""
    if not len(a):
        return pd.DataFrame({"node": [], "n": [], "to": []})
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    counts = np.bincount(at, weights=np.concatenate([copies_b, copies_a])).astype(np.int64)
    child, root = spanning(a, b)
    link = pd.Series(root, index=child).reindex(ids).fillna(pd.Series(ids, index=ids)).astype(np.int64)
    return pd.DataFrame({"node": ids, "n": counts, "to": link.to_numpy()})


def _groups(reps: DataFrame, found: list[DataFrame]) -> DataFrame:
    """(dim, k1, k2, n_links, component_id) of every distinct vector, from what the searches found."""
    if not found:
        return reps.select("dim", "k1", "k2", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    links = reduce(DataFrame.unionByName, found)
    counts = links.groupBy(F.col("node").alias("rep")).agg(F.sum("n").alias("n"))
    parts = connected_components(links.where("node <> to").select(F.col("node").alias("a"), F.col("to").alias("b")))
    out = reps.drop("vec").join(counts, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    out = stage(out.withColumn("component", F.coalesce("component", "rep")), "vec-parts")
    # Ids only here: a component is named by the smallest of its vectors' ids.
    names = out.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return out.join(names, "component").select("dim", "k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")


def _search(spark, reps: DataFrame, index: Index, threshold: float, kind: str) -> DataFrame:
    """(node, n, to) of the links between representatives of one length."""
    shared = spark.sparkContext.broadcast(index)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                cell, codes, error = shared.value.encode(unit(vectors(b["vec"].to_numpy(), kind)).astype(np.float32))
                yield b[["rep", "copies", "vec"]].assign(cell=cell, codes=[c.tobytes() for c in codes], error=error)

    indexed = stage(reps.mapInPandas(encode, "rep long, copies long, vec binary, cell long, codes binary, error double"), "vec-index")

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 512):
                b = whole.iloc[at : at + 512]
                x = unit(vectors(b["vec"].to_numpy(), kind)).astype(np.float32)
                row, cell = shared.value.probes(x, b["cell"].to_numpy())
                yield b[["rep", "copies", "vec", "cell"]].iloc[row].assign(probe=cell)

    probes = indexed.mapInPandas(probe, "rep long, copies long, vec binary, cell long, probe long")
    # At most LISTS rows each.
    chunks = {c: -(-n // CHUNK) for c, n in indexed.groupBy("cell").count().collect()}
    parts = {c: -(-n // QUERIES) for c, n in probes.groupBy("probe").count().collect()}
    number = lambda of, c: F.coalesce(F.create_map(*[F.lit(x) for kv in of.items() for x in kv])[c], F.lit(1))
    to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    own = lambda c, n: F.pmod(F.xxhash64("rep"), n).cast("int")  # noqa: E731, ARG005
    listed = indexed.select("rep", "copies", "vec", "cell", "codes", "error", F.col("cell").alias("probe"))
    listed = listed.withColumn("chunk", own("cell", number(chunks, F.col("probe")))).withColumn("part", to(number(parts, F.col("probe"))))
    asked = probes.withColumn("part", own("cell", number(parts, F.col("probe")))).withColumn("chunk", to(number(chunks, F.col("probe"))))
    asked = asked.withColumns({"codes": F.lit(None).cast("binary"), "error": F.lit(None).cast("double")})
    columns = ["probe", "chunk", "part", "rep", "copies", "vec", "cell", "codes", "error"]
    blocks = listed.select(*columns).unionByName(asked.select(*columns)).withColumn("asks", F.col("codes").isNull())

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each block the list's vectors come first, then its queries as a stream."""
        held, block = [], None  # the list's rows, the block they belong to
        listed: dict | None = None

        def answer(q: pd.DataFrame) -> pd.DataFrame:
            queries = {"unit": unit(vectors(q["vec"].to_numpy(), kind)), "cell": q["cell"].to_numpy(), "rep": q["rep"].to_numpy()}
            row, query = linked_pairs(shared.value, block[0], listed, queries, threshold)
            return tally(listed["rep"][row], queries["rep"][query], listed["copies"][row], q["copies"].to_numpy()[query])

        for batch in batches:
            keys = batch[["probe", "chunk", "part"]].to_numpy()
            if not len(keys):
                continue
            asks = batch["asks"].to_numpy()
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1) | (asks[1:] != asks[:-1])) + 1
            for at, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                rows, here = batch.iloc[at:end], tuple(keys[at].tolist())
                if here != block:
                    held, listed, block = [], None, here
                if not asks[at]:
                    held.append(rows)
                    continue
                if listed is None and held:
                    own = pd.concat(held)
                    listed = {"unit": unit(vectors(own["vec"].to_numpy(), kind)), "rep": own["rep"].to_numpy(), "copies": own["copies"].to_numpy(), "error": own["error"].to_numpy()}
                    listed["codes"] = np.stack([np.frombuffer(c, dtype=np.uint8) for c in own["codes"]])
                if listed is not None:
                    for k in range(0, len(rows), 2048):
                        yield answer(rows.iloc[k : k + 2048])

    order = ["probe", "chunk", "part", "asks"]
    found = blocks.repartition("probe", "chunk", "part").sortWithinPartitions(*order).mapInPandas(compare, "node long, n long, to long")
    return stage(found, "vec-found")


def op6_vector_dedup(embeddings: DataFrame) -> DataFrame:
    return near_vectors(embeddings)


SQL = """
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS (
  SELECT r, CAST(embedding AS DOUBLE[]) AS x FROM e
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (
  SELECT p.r AS a, q.r AS b FROM v p JOIN v q ON p.r <> q.r AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= CAST(0.95 AS DOUBLE)),
n AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a),
reach(x, y) AS (SELECT r, r FROM e UNION SELECT x, b FROM reach JOIN l ON a = y),
comp AS (SELECT x AS r, min(vec_id) AS component_id FROM reach JOIN e ON e.r = y GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN comp USING (r) LEFT JOIN n USING (r)
"""
