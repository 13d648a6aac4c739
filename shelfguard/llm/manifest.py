r"""Merkle manifest of a dataset: postorder append logs, proofs by position.

A row's leaf is the SHA-256 of its columns (``-`` for a null, else UTF-8 byte count, ``:``,
value). Inside a group (a source) leaves ascend by key; every three consecutive nodes (the last run: fewer, even
one) have the SHA-256 of their hex digests as parent until one node remains, the
group's subroot. Subroots, ordered by group, make a tree likewise: its top is the root.

Method. Leaves are numbered by ranges (``ranks``) and cut into aligned segments of
``3 ** DEPTH``. One builder per segment appends its leaves in order, and each inner node as soon as
its run is complete: a log in completion order, which is postorder. A node's place
in the log needs no index: before leaf ``j`` stand ``j`` leaves and ``j // 3 + j // 9 + ...``
completed subtrees, and node ``i`` of level ``l`` stands ``l`` places after its last leaf
(``node_position``). Segment tops are the leaves of the next tier of segments, and so on. A
proof reads the siblings of each level at their closed-form places in its segment's log;
above the segment it is the segment's own proof, found once for all of its leaves.

The log has a row per (group, segment): ``nodes`` holds the digests end to end, the last one is the top. A
builder or a proof task holds one segment. A tree of n leaves has ``log(n) / log(3 ** DEPTH)`` tiers, each a job.

A proof is a path: per level a byte with the node's place in its run, a byte with the
run's length, and the digests of the others from left to right.

Defined results: leaves equal in doc_id (repeated rows, or none) are ordered by their digest; rows
without doc_id come first in their source and aren't tampered with. A missing source is a
group of its own, before the empty one. Texts of any length are hashed whole. An empty table has no rows and no root. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches, stage
from shelfguard.llm.ranks import numbered_in_groups

FAN = 3
#: Levels of a segment: 729 leaves, some 35 kB of log.
DEPTH = 6
SIZE = 32
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Segments sent on together.
TOGETHER = 16


def parent(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def levels_of(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def leaf_position(j: int) -> int:
    """Place of leaf ``j`` in the log: all leaves before it, and every subtree they completed."""
    place, size = j, FAN
    while size <= j:
        place += j // size
        size *= FAN
    return place


def node_position(level: int, i: int, n: int) -> int:
    """Place of node ``i`` of ``level`` in the log of ``n`` leaves: it follows its last leaf and the levels below."""
    return leaf_position(min((i + 1) * FAN**level, n) - 1) + level


class Segment:
    """Builder of one segment's log: nodes are appended in completion order."""

    def __init__(self, levels: int):
        self.levels, self.nodes = levels, []
        self.open: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def append(self, digest: bytes, level: int = 0) -> None:
        self.nodes.append(digest)
        run = self.open[level]
        run.append(digest)
        if level < self.levels and len(run) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        done, self.open[level] = self.open[level], []
        self.append(parent(done), level + 1)

    def close(self) -> bytes:
        for level in range(self.levels):
            if self.open[level]:
                self._complete(level)
        return b"".join(self.nodes)


class Reader:
    """Proofs out of one segment's log."""

    def __init__(self, nodes: bytes, n: int, levels: int, above: bytes):
        self.nodes, self.n, self.levels = nodes, n, levels
        self._paths: dict[tuple[int, int], bytes] = {}
        self.above = above

    def node(self, level: int, i: int) -> bytes:
        at = SIZE * node_position(level, i, self.n)
        return self.nodes[at : at + SIZE]

    def path(self, level: int, i: int) -> bytes:
        """The path from node ``i`` of ``level`` to the root; nodes of a run share what is above them."""
        if level == self.levels:
            return self.above
        known = self._paths.get((level, i))
        if known is None:
            first = i - i % FAN
            run = range(first, min(first + FAN, -(-self.n // FAN**level)))
            others = b"".join([self.node(level, k) for k in run if k != i])
            known = bytes([i - first, len(run)]) + others + self.path(level + 1, i // FAN)
            if level:
                self._paths[level, i] = known
        return known


def steps(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """(place in the run, the others) of each level."""
    at = 0
    while at < len(path):
        place, run = path[at], path[at + 1]
        at += 2
        yield place, [path[at + SIZE * k : at + SIZE * (k + 1)] for k in range(run - 1)]
        at += SIZE * (run - 1)


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    for place, others in steps(path):
        leaf = parent([*others[:place], leaf, *others[place:]])
    return leaf


def leaf_digest(*columns: Column) -> Column:
    """Digest of values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _tier(rows: DataFrame, depth: int) -> DataFrame:
    """Segment logs over numbered nodes (g, idx, n, digest)."""
    span = FAN**depth

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, key, segment, count, total = [], None, None, 0, 0
        for batch in batches:
            for g, s, n, digest in zip(*[batch.column(c).to_pylist() for c in ("g", "segment", "n", "digest")], strict=True):
                if (g, s) != key:
                    if key is not None:
                        done.append((*key, total, count, segment.levels, segment.close()))
                    key, count, total, segment = (g, s), 0, n, Segment(min(depth, levels_of(n)))
                segment.append(digest)
                count += 1
            if len(done) >= TOGETHER:
                yield _rows(done)
                done = []
        if key is not None:
            done.append((*key, total, count, segment.levels, segment.close()))
        if done:
            yield _rows(done)

    names, kinds = ["g", "segment", "n", "leaves", "levels", "nodes"], [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)

    cut = rows.select("g", F.floor(F.col("idx") / span).cast("long").alias("segment"), "idx", "n", "digest")
    dealt = cut.repartition("g", "segment").sortWithinPartitions("g", "segment", "idx")
    return dealt.mapInArrow(build, "g string, segment long, n long, leaves int, levels int, nodes binary")


def _top() -> Column:
    return F.substring("nodes", F.octet_length("nodes") - SIZE + 1, F.lit(SIZE)).alias("digest")


def build_tiers(rows: DataFrame, depth: int, name: str) -> list[DataFrame]:
    """The segment logs of every tier, the leaves' first; ``rows`` are (g, idx, n, digest)."""
    span, tiers = FAN**depth, []
    while True:
        log = stage(_tier(rows, depth), f"{name}-log")
        tiers.append(log)
        if (log.agg(F.max("n")).first()[0] or 0) <= span:
            return tiers
        rows = log.where(F.col("n") > span).select("g", F.col("segment").alias("idx"), F.ceil(F.col("n") / span).cast("long").alias("n"), _top())


def tops(tiers: list[DataFrame], depth: int) -> DataFrame:
    """(g, digest): the top of each group."""
    return reduce(DataFrame.unionByName, [t.where(F.col("n") <= FAN**depth).select("g", _top()) for t in tiers])


def _extract(log: DataFrame, requests: DataFrame, depth: int) -> DataFrame:
    """``requests`` (g, idx, more) with their ``leaf`` and ``path``, and the ``subroot`` of their group.

    ``log`` has the path ``above`` each segment. Each segment's log comes first in the order, then its requests.
    """
    span = FAN**depth
    carried = [f for f in requests.schema.fields if f.name not in ("g", "idx")]
    asked = requests.withColumn("segment", F.floor(F.col("idx") / span).cast("long"))
    together = log.withColumn("idx", F.lit(-1).cast("long")).unionByName(asked, allowMissingColumns=True)
    dealt = together.repartition("g", "segment").sortWithinPartitions("g", "segment", "idx")
    names = ["g", "idx", *[f.name for f in carried]]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reader, subroot = None, None, None
        for batch in batches:
            leaves, paths, subroots = [], [], []
            where = batch.column("idx").to_pylist()
            for r, (g, s, i) in enumerate(zip(batch.column("g").to_pylist(), batch.column("segment").to_pylist(), where, strict=True)):
                if i < 0:
                    value = lambda c: batch.column(c)[r].as_py()  # noqa: B023, E731
                    key, reader, subroot = (g, s), Reader(value("nodes"), value("leaves"), value("levels"), value("above")), value("subroot")
                    continue
                if key != (g, s):
                    raise ValueError(f"segment {s} of group {g!r} has no log")
                k = i - s * span
                leaves.append(reader.node(0, k))
                paths.append(reader.path(0, k))
                subroots.append(subroot)
            if leaves:
                own = batch.filter(pa.compute.greater_equal(batch.column("idx"), 0))
                made = [pa.array(x, pa.binary()) for x in (leaves, paths, subroots)]
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in names], *made], [*names, "leaf", "path", "subroot"])

    made = [T.StructField(c, T.BinaryType()) for c in ("leaf", "path", "subroot")]
    own = [T.StructField("g", T.StringType()), T.StructField("idx", T.LongType()), *carried]
    return dealt.mapInArrow(extract, T.StructType([*own, *made]))


def prove(tiers: list[DataFrame], requests: DataFrame, above: DataFrame, depth: int) -> DataFrame:
    """``requests`` (g, idx, more) with ``leaf``, ``path`` to the root and ``subroot``.

    ``above`` has (g, above, subroot): the path from each group's top to the root.
    """
    span, known = FAN**depth, None
    for t in reversed(range(len(tiers))):
        log = tiers[t]
        ends = log.where(F.col("n") <= span).join(above, "g").select("g", "segment", "above", "subroot")
        if known is not None:
            ends = ends.unionByName(known)
        log = log.join(ends, ["g", "segment"])
        if t == 0:
            return _extract(log, requests, depth)
        below = tiers[t - 1].where(F.col("n") > span).select("g", F.col("segment").alias("idx"))
        known = _extract(log, below, depth).select("g", F.col("idx").alias("segment"), F.col("path").alias("above"), "subroot")
        known = stage(known, "merkle-paths")


@dataclass
class Manifest:
    """Logs of the groups (``tiers``) and of the tree over them (``catalogue``); ``root`` is None without rows."""

    leaves: DataFrame
    tiers: list[DataFrame]
    catalogue: list[DataFrame]
    subroots: DataFrame
    root: bytes | None
    depth: int

    def proofs(self) -> DataFrame:
        """Every leaf's carried columns with ``leaf``, ``path`` and ``subroot``."""
        nothing = self.subroots.select(F.lit("").alias("g"), F.lit(b"").alias("above"), F.lit(self.root or b"").alias("subroot")).limit(1)
        groups = prove(self.catalogue, self.subroots.select("g", "idx", "group"), nothing, self.depth)
        above = groups.select(F.col("group").alias("g"), F.col("path").alias("above"), F.col("leaf").alias("subroot"))
        return prove(self.tiers, self.leaves.drop("n", "digest"), stage(above, "merkle-above"), self.depth)


def merkle_manifest(leaves: DataFrame, group: str, key: str, depth: int = DEPTH) -> Manifest:
    """Manifest of ``leaves``: ``digest`` (binary), the nullable text column ``group``, ``key`` for the order, more.

    Other columns are carried to the proofs.
    """
    if not 1 <= depth <= 10:
        raise ValueError("a segment has 3 to 59,049 leaves")
    # '' for no group, '+' before a name: null first, then bytewise, and never null.
    rows = leaves.withColumn("g", F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))).drop(group)
    ranked = numbered_in_groups(stage(rows, "merkle-leaves"), "g", [key, "digest"], "merkle")
    tiers = build_tiers(ranked.select("g", "idx", "n", "digest"), depth, "merkle")
    subroots = tops(tiers, depth).select(F.lit("").alias("g"), F.col("g").alias("group"), "digest")
    subroots = stage(numbered_in_groups(subroots, "g", ["group"], "merkle-groups"), "merkle-subroots")
    catalogue = build_tiers(subroots.select("g", "idx", "n", "digest"), depth, "merkle-catalogue")
    top = tops(catalogue[-1:], depth).first()
    return Manifest(ranked, tiers, catalogue, subroots, None if top is None else bytes(top["digest"]), depth)


def verify(claim: str, path: str) -> Column:
    """proof_sha256 and folded_root of a claimed leaf and its path (binary columns)."""

    @F.pandas_udf("proof_sha256 string, folded_root string")
    def check(claims: pd.Series, paths: pd.Series) -> pd.DataFrame:
        proof = [hashlib.sha256("".join([d.hex() for _, others in steps(p) for d in others]).encode()).hexdigest() for p in paths]
        return pd.DataFrame({"proof_sha256": proof, "folded_root": [fold(c, p).hex() for c, p in zip(claims, paths, strict=True)]})

    return check(claim, path)


def op12_merkle_manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Leaf, subroot, root, proof digest and folded root of every document; some leaves are tampered with."""
    original = leaf_digest(*[F.col(c) for c in LEAF_COLUMNS])
    # Only line ends go; a document without any keeps its leaf.
    tampered = leaf_digest(*[F.translate("text", "\n", "") if c == "text" else F.col(c) for c in LEAF_COLUMNS])
    chosen = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select("doc_id", "source", original.alias("digest"), F.when(chosen, tampered).alias("claim"))
    manifest = merkle_manifest(leaves, "source", "doc_id", depth)
    found = in_small_batches(manifest.proofs()).withColumn("_claim", F.coalesce("claim", "leaf"))
    found = found.withColumn("_v", verify("_claim", "path"))
    text = lambda c: F.lower(F.hex(c))
    root = F.lit((manifest.root or b"").hex())
    return found.select(
        "doc_id", text("leaf").alias("leaf"), text("subroot").alias("subroot"), root.alias("root"),
        "_v.proof_sha256", "_v.folded_root", (F.col("_v.folded_root") == root).alias("verified"),
    )


#: Unsigned CRC-32 of a decimal: the bytes one by one, eight bits each.
CRC32 = """xor(list_reduce(list_prepend(4294967295, [ascii(x) for x in string_split(CAST({0} AS VARCHAR), '')]),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""
_PART = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_LEAF = "sha256(" + " || ".join(_PART.format(c) for c in LEAF_COLUMNS) + ")"
_OTHER = "sha256(" + " || ".join(_PART.format("replace(text, chr(10), '')" if c == "text" else c) for c in LEAF_COLUMNS) + ")"
SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('+' || source, '') AS g, {_LEAF} AS leaf,
         CASE WHEN {CRC32.format("coalesce(doc_id, 0)")} % 2 = 0 AND doc_id IS NOT NULL THEN {_OTHER} ELSE {_LEAF} END AS claim
  FROM documents
),
r AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d),
node AS (
  SELECT g, 0 AS level, i, n, leaf AS h FROM r
  UNION ALL
  SELECT g, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY g, level, n, i // 3
),
s AS (SELECT g, h AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
cat AS (
  SELECT 0 AS level, i, n, subroot AS h FROM s
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM cat WHERE n > 1 GROUP BY level, n, i // 3
),
steps AS (
  SELECT r.doc_id, r.g, r.i, node.level AS nth,
         coalesce(string_agg(h, '' ORDER BY node.i) FILTER (node.i < r.i // (3 ** node.level)::BIGINT), '') AS pre,
         coalesce(string_agg(h, '' ORDER BY node.i) FILTER (node.i > r.i // (3 ** node.level)::BIGINT), '') AS post
  FROM r JOIN node ON node.g = r.g AND node.n > 1 AND node.i // 3 = r.i // (3 ** (node.level + 1))::BIGINT
  GROUP BY r.doc_id, r.g, r.i, node.level
  UNION ALL
  SELECT r.doc_id, r.g, r.i, 100 + cat.level,
         coalesce(string_agg(h, '' ORDER BY cat.i) FILTER (cat.i < s.i // (3 ** cat.level)::BIGINT), ''),
         coalesce(string_agg(h, '' ORDER BY cat.i) FILTER (cat.i > s.i // (3 ** cat.level)::BIGINT), '')
  FROM r JOIN s ON s.g = r.g JOIN cat ON cat.n > 1 AND cat.i // 3 = s.i // (3 ** (cat.level + 1))::BIGINT
  GROUP BY r.doc_id, r.g, r.i, cat.level
),
path AS (SELECT g, i, list([pre, post] ORDER BY nth) AS p, string_agg(pre || post, '' ORDER BY nth) AS proof FROM steps GROUP BY g, i),
f AS (
  SELECT r.doc_id, r.leaf, s.subroot, (SELECT h FROM cat WHERE n = 1) AS root, sha256(coalesce(path.proof, '')) AS proof_sha256,
         CASE WHEN path.p IS NULL THEN r.claim ELSE
           list_reduce(list_prepend([r.claim, ''], path.p), lambda x, y: [sha256(y[1] || x[1] || y[2]), ''])[1] END AS folded_root
  FROM r JOIN s ON s.g = r.g LEFT JOIN path ON path.g = r.g AND path.i = r.i
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM f
"""
