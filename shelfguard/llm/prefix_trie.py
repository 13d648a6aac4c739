r"""Prefix trie of conversations by vertical bitmaps.

A conversation is its turns in order; each distinct sequence of first ``d`` turns is a node of depth ``d``,
from the empty root on. Per node: its members (conversations that start with it), the
smallest of them, children, childless nodes below, members that end there, and what storing
shared prefixes once saves.

Method. Turns travel as digests with their size. Conversations come in ranges of ids, and
a range is cut into shards of at most ``SHARD_CONVS`` conversations or ``SHARD_TURNS`` turns. A shard indexes (position,
turn) to the bitset of its conversations with that turn there, and walks depth first:
a node's bitset, less those that end, is intersected with the posting of its lowest member's next
turn; that is a child, and what remains goes on. Each node gives its popcount, its lowest member
and the list of members that end there, as text. A node is named by the digest of its path, so the shards'
nodes meet in one map-side combined grouping: a first turn that a third of all conversations share
is one row per shard.

A conversation longer than a shard goes on in the next one from the path it has reached, so a
worker holds a bounded number of turns whatever the lengths.

Subtree sums. Nodes with one member are the rest of one conversation: one leaf, nothing
saved. For the others, sums double their reach each round (a node adds what its descendants
at distance ``2 ** k`` have gathered): log2(depth) rounds of a join on the ancestor and a
map-side combined sum.

End lists are hashed as one stream per node, over one text per shard in the order of ids. SHA-256 has
to read a node's list from front to back, so a node at which very many conversations end is
one task's stream; the shards' texts are all it reads, one at a time.

Defined results: turns are ordered by turn (null first), then role and text; null role or text is empty. Rows without conv_id are left out. A
conversation without turns is a member of the root. An empty table has no nodes. Repeated rows
are turns of their own. Other columns aren't read. Texts of any length are digested whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches, stage, tidy
from shelfguard.llm.manifest import CRC32
from shelfguard.llm.ranks import numbered_in_groups

#: A shard is full at so many conversations or turns.
SHARD_CONVS = 1024
SHARD_TURNS = 65_536
#: Path of the root.
ROOT = b""
#: Nodes sent on together.
TOGETHER = 4096
NODE = "path binary, parent binary, depth long, bytes long, n_convs long, conv_id long, n_ends long, ends string, first_end long"


def step(path: bytes, turn: bytes) -> bytes:
    """Path of the child that ``turn`` leads to."""
    return hashlib.sha256(path + turn).digest()


class Shard:
    """Some conversations in the order of their ids, and their trie."""

    def __init__(self):
        self.convs: list[int] = []
        self.turns: list[list[bytes]] = []
        self.start: list[tuple[int, bytes]] = []
        self.ended: list[bool] = []
        self.size: dict[bytes, int] = {}
        self.held = 0

    def begin(self, conv: int, depth: int, path: bytes) -> None:
        self.convs.append(conv)
        self.turns.append([])
        self.start.append((depth, path))
        self.ended.append(True)

    def add(self, turn: bytes, size: int) -> None:
        self.turns[-1].append(turn)
        self.size[turn] = size
        self.held += 1

    def _postings(self) -> dict[tuple[int, bytes], int]:
        """(position, turn) to the bitset of the conversations that have it there."""
        members: dict[tuple[int, bytes], list[int]] = {}
        for i, (own, (depth, _)) in enumerate(zip(self.turns, self.start, strict=True)):
            for k, turn in enumerate(own, depth + 1):
                members.setdefault((k, turn), []).append(i)
        out, width = {}, (len(self.convs) + 7) // 8
        for key, rows in members.items():
            if len(rows) == 1:
                out[key] = 1 << rows[0]
            else:
                bits = np.zeros(8 * width, dtype=np.uint8)
                bits[rows] = 1
                out[key] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        return out

    def nodes(self) -> Iterator[tuple]:
        """(path, parent, depth, bytes of the last text, members, smallest, those that end, their ids as text, the first); sets ``reached``."""
        postings = self._postings()
        self.reached = [path for _, path in self.start]
        finish = [depth + len(own) for own, (depth, _) in zip(self.turns, self.start, strict=True)]
        roots: dict[tuple[int, bytes], int] = {}
        for i, at in enumerate(self.start):
            roots[at] = roots.get(at, 0) | 1 << i
        stack = [(path, None, depth, None, bits) for (depth, path), bits in roots.items()]
        while stack:
            path, parent, depth, turn, bits = stack.pop()
            ends, rest = [], bits
            if bits & (bits - 1) == 0:  # one member: nothing to intersect
                i = bits.bit_length() - 1
                self.reached[i] = path
                if finish[i] > depth:
                    nxt = self.turns[i][depth - self.start[i][0]]
                    stack.append((step(path, nxt), path, depth + 1, nxt, bits))
                elif self.ended[i]:
                    ends.append(self.convs[i])
            else:
                while rest:
                    low = rest & -rest
                    i = low.bit_length() - 1
                    if finish[i] == depth:
                        self.reached[i] = path
                        if self.ended[i]:
                            ends.append(self.convs[i])
                        rest ^= low
                        continue
                    nxt = self.turns[i][depth - self.start[i][0]]
                    child = bits & postings[depth + 1, nxt]
                    stack.append((step(path, nxt), path, depth + 1, nxt, child))
                    rest &= ~child
            # A path carried over from the shard before was a node of that one.
            if turn is not None or depth == 0:
                lowest = self.convs[(bits & -bits).bit_length() - 1]
                yield path, parent, depth, 0 if turn is None else self.size[turn], bits.bit_count(), lowest, len(ends), ",".join(map(str, ends)) if ends else None, ends[0] if ends else None
            elif ends:
                yield path, None, depth, None, 0, None, len(ends), ",".join(map(str, ends)), ends[0]


def _shard_nodes(turns: DataFrame, convs: int, limit: int) -> DataFrame:
    """Nodes of every shard of ``turns`` (conv_id, pos, turn, bytes; pos 0 has no turn), dealt by ranges of conv_id."""

    @tidy
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, conv, depth = Shard(), None, 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = []
            for node in shard.nodes():
                rows.append(node)
                if len(rows) == TOGETHER:
                    yield _rows(rows)
                    rows = []
            if rows:
                yield _rows(rows)

        for batch in batches:
            for c, turn, size in zip(*[batch.column(x).to_pylist() for x in ("conv_id", "turn", "bytes")], strict=True):
                if c != conv:
                    if len(shard.convs) >= convs or shard.held >= limit:
                        yield from flush()
                        shard = Shard()
                    conv, depth = c, 0
                    shard.begin(c, 0, ROOT)
                elif shard.held >= limit and turn is not None:
                    shard.ended[-1] = False
                    yield from flush()
                    reached = shard.reached[-1]
                    shard = Shard()
                    shard.begin(c, depth, reached)
                if turn is not None:
                    shard.add(turn, size)
                    depth += 1
        if shard.convs:
            yield from flush()

    fields = T._parse_datatype_string(NODE).fields
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f.name for f in fields])

    dealt = in_small_batches(turns).repartitionByRange("conv_id").sortWithinPartitions("conv_id", "pos")
    return dealt.mapInArrow(build, T.StructType(fields))


def _end_digests(nodes: DataFrame) -> DataFrame:
    """(path, ends_sha256): the shards' lists joined by commas in the order of ids, hashed as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, state, out = None, None, []
        for batch in batches:
            for p, text in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if p != path:
                    if path is not None:
                        out.append((path, state.hexdigest()))
                    path, state = p, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if len(out) >= TOGETHER:
                yield _rows(out)
                out = []
        if path is not None:
            out.append((path, state.hexdigest()))
        if out:
            yield _rows(out)

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])], ["path", "ends_sha256"])

    lists = nodes.where(F.col("ends").isNotNull()).select("path", "first_end", "ends")
    dealt = lists.repartition("path").sortWithinPartitions("path", "first_end")
    return dealt.mapInArrow(digest, "path binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``turns``: (conv_id, pos, turn, bytes).

    ``turn`` is a turn's digest, ``bytes`` its text's size; rows with a null turn (at ``pos`` 0) make a
    conversation known that may have no turns.
    """
    local = stage(_shard_nodes(turns, shard_convs, shard_turns), "trie-shards")
    nodes = local.groupBy("path").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("bytes").alias("bytes"),
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_ends").alias("n_ends"),
    )
    nodes = stage(nodes, "trie-nodes")
    # Nodes with several members; all else is the rest of one conversation.
    shared = nodes.where("n_convs > 1")
    above = shared.select(F.col("path").alias("parent"), F.col("conv_id").alias("_parent_conv"))
    placed = nodes.join(above, "parent", "left")
    placed = stage(placed.withColumn("top", F.col("_parent_conv").isNotNull()), "trie-placed")
    children = placed.where("top").groupBy(F.col("parent").alias("path")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("_singles")
    )
    inner = placed.where("n_convs > 1").join(children, "path", "left")
    inner = inner.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("_singles")).cast("long")
    inner = inner.withColumn("n_leaves", leaves).withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("bytes")).drop("_singles")
    inner = stage(inner, "trie-inner")

    deepest, reach = inner.agg(F.max("depth")).first()[0] or 0, 1
    sums = inner.select("path", "depth", F.col("parent").alias("jump"), "n_leaves", "saved_tokens")
    while reach <= deepest:
        # What the nodes at distance ``reach`` have gathered goes to their ancestor there.
        got = sums.where(F.col("depth") >= reach).groupBy(F.col("jump").alias("path")).agg(F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s"))
        hops = sums.select(F.col("path").alias("jump"), F.col("jump").alias("_next"))
        far = sums.where(F.col("depth") >= 2 * reach).join(hops, "jump").select("path", "_next")
        more = sums.join(got, "path", "left").join(far, "path", "left")
        sums = stage(
            more.select(
                "path", "depth", F.col("_next").alias("jump"),
                (F.col("n_leaves") + F.coalesce("_l", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("_s", F.lit(0))).alias("saved_tokens"),
            ),
            "trie-sums",
        )
        reach *= 2
    inner = inner.drop("n_leaves", "saved_tokens").join(sums.select("path", "n_leaves", "saved_tokens"), "path")
    single = placed.where("n_convs = 1").select(
        "*", (1 - F.col("n_ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens")
    )
    ends = _end_digests(local)
    out = inner.unionByName(single).join(ends, "path", "left")
    parent = F.when(F.col("depth") > 0, F.coalesce("_parent_conv", "conv_id"))
    return out.select(
        "path", "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def digest_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, turn, bytes): every turn's place in its conversation, the digest of (role, text), the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_at"), role.alias("_role"), text.alias("_text"), F.left(text, F.lit(64)).alias("_front"),
    )
    turn = F.unhex(F.sha2(F.concat(F.octet_length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256))
    # Texts decide between turns of one number; they travel once and are digested where they arrive.
    return numbered_in_groups(
        rows, "conv_id", ["_at", "_role", "_text"], "trie", deal=["_at", "_role", "_front"],
        keep=["conv_id", turn.alias("turn"), F.octet_length("_text").cast("long").alias("bytes")],
    ).select("conv_id", "idx", "turn", "bytes")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation c anew: the first h turns of conversation c - c % 5, then its own after its first h.

    h is the CRC-32 of c in decimal, modulo 9. A row at ``pos`` 0 makes each conversation known.
    """
    keep = F.crc32(F.col("conv_id").cast("string")) % 9
    convs = turns.where("idx = 0").select("conv_id", keep.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    heads = turns.where("idx < 8").select(F.col("conv_id").alias("base"), "idx", "turn", "bytes")
    head = convs.join(heads, "base").where(F.col("idx") < F.col("h"))
    own = turns.where(F.col("idx") >= keep)
    known = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("bytes"))
    placed = lambda rows: rows.select("conv_id", (F.col("idx") + 1).alias("pos"), "turn", "bytes")
    return known.unionByName(placed(head)).unionByName(placed(own))


def op13_prefix_trie(conversations: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    turns = stage(digest_turns(conversations), "trie-numbered")
    trie = prefix_trie(stage(rebuilt(turns), "trie-rebuilt"), shard_convs, shard_turns)
    return trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {CRC32.format("conv_id")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
x AS (
  SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, t.i, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.i > c.h
),
r AS (SELECT conv_id, list(sha256(strlen(role) || ':' || role || text) ORDER BY i) AS p, list(strlen(text) ORDER BY i) AS b FROM x GROUP BY conv_id),
a AS (SELECT c.conv_id, coalesce(p, []) AS p, coalesce(b, []) AS b, coalesce(len(p), 0) AS n FROM c LEFT JOIN r ON r.conv_id = c.conv_id),
m AS (SELECT conv_id, n, d, sha256(array_to_string(list_slice(p, 1, d), '')) AS path, CASE WHEN d > 0 THEN b[d] ELSE 0 END AS size,
             CASE WHEN d > 0 THEN sha256(array_to_string(list_slice(p, 1, d - 1), '')) END AS parent
      FROM (SELECT *, unnest(range(0, n + 1)) AS d FROM a)),
node AS (SELECT path, d AS depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(size) AS size,
                coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends FROM m GROUP BY path, d),
kids AS (SELECT parent AS path, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON kids.path = node.path),
pairs AS (
  SELECT DISTINCT up.path AS above, low.path AS path
  FROM m AS up JOIN m AS low ON up.conv_id = low.conv_id AND low.d >= up.d
),
sums AS (
  SELECT above AS path, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((f.n_convs - 1) * f.size) AS saved
  FROM pairs JOIN full_node AS f ON f.path = pairs.path GROUP BY above
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
       CAST(s.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_node AS f JOIN sums AS s ON s.path = f.path LEFT JOIN node AS p ON p.path = f.parent
"""
