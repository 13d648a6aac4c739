"""Token ids in training order: a keyed permutation of all sequences, in fixed-stride shards.

Method.

1. Texts are tokenised where they are scanned (byte-level BPE), each followed by the end
   mark, and written as packs: the compressed ids of some hundred documents with the
   task that made them and their place in that task's stream. Tasks' streams, end to
   end, are one token stream, cut into sequences of ``seq_len`` ids; a sum per task (one small
   row each) gives every pack its place in it.
2. A Feistel network over the smallest even number of bits that holds all sequence
   numbers, keyed by ``key``, permutes the numbers; a value beyond the last one is
   permuted again until it falls inside (cycle-walking). So every sequence has one global
   slot, computed anywhere without a table, and ``sequence_of`` inverts it.
3. Pieces of sequences go to ranges of slots, whole shards to a range, sorted by slot; each task
   writes its shards one after the other: record i of a shard starts at byte ``i * stride``.
   A shard is written under a task's own name and then renamed, so a lost or doubled task leaves whole shards.

Reading takes a range of slots: a reader that stopped at slot s goes on at shard
``s // shard_size``, byte ``s % shard_size * stride``.

The order of the stream is that of the scan; the same files, split alike, give the same shards.

Defined results: null and empty texts are documents of no ids, the end mark alone; the last sequence is
filled up with ``PAD``; a table without rows has no shards. Repeated rows are documents
of their own. Only the text column is read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfguard.llm.common import in_small_batches, stage
from shelfguard.session import scratch_path

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's texts are cut before merging; fixed with the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEQ_LEN = 2048
#: Sequences of a shard: 16 MB at 4096 bytes each.
SHARD_SIZE = 4096
PAD = 0xFFFF
KEY = 20_240_101
ROUNDS = 6
PACK = 256
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Feistel:
    """A keyed permutation of 0..n-1."""

    def __init__(self, n: int, key: int = KEY):
        self.n = n
        self.half = np.uint64(max(1, -(-max(1, (n - 1).bit_length()) // 2)))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little")) for r in range(ROUNDS)]

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * _M1
        x = (x ^ (x >> np.uint64(30))) * _M2
        return (x ^ (x >> np.uint64(31))) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        if back:
            for key in reversed(self.keys):
                left, right = right ^ self._mix(left, key), left
        else:
            for key in self.keys:
                left, right = right, left ^ self._mix(right, key)
        return (left << self.half) | right

    def _walk(self, x, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x).astype(np.uint64), back)
        while (out := x >= self.n).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slot_of(self, sequence) -> np.ndarray:
        return self._walk(sequence, False)

    def sequence_of(self, slot) -> np.ndarray:
        return self._walk(slot, True)


def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), max(ranks.values()) + 1


def packs(docs: DataFrame, ranks: str = RANKS, text: str = "text") -> DataFrame:
    """(task, start, n, ids): compressed ids of neighbouring documents, and where they stand in the task's stream."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoding, end = _encoding(ranks)
        if end >= PAD:
            raise ValueError("ids of this vocabulary do not fit two bytes")
        squeeze = zstandard.ZstdCompressor(level=6)
        task, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, PACK):
                own = []
                for x in batch.column(0).slice(at, PACK).to_pylist():
                    own += [np.array(encoding.encode_ordinary(x) if x else [], dtype="<u2"), np.array([end], dtype="<u2")]
                ids = np.concatenate(own)
                yield pa.RecordBatch.from_pydict(
                    {"task": pa.array([task], pa.int64()), "start": pa.array([start], pa.int64()), "n": pa.array([len(ids)], pa.int64()), "ids": [squeeze.compress(ids.tobytes())]}
                )
                start += len(ids)

    return in_small_batches(docs).select(text).mapInArrow(pack, "task long, start long, n long, ids binary")


def write_shards(docs: DataFrame, path: str, ranks: str = RANKS, seq_len: int = SEQ_LEN, shard_size: int = SHARD_SIZE, key: int = KEY) -> dict:
    """Write the shards of ``docs`` under ``path``; returns the manifest that is stored with them."""
    spark = docs.sparkSession
    packed = stage(packs(docs, ranks), "token-packs", compression="uncompressed")
    # One row a task.
    sums = sorted((r[0], r[1]) for r in packed.groupBy("task").agg(F.sum("n")).collect())
    base, total = {}, 0
    for task, n in sums:
        base[task] = total
        total += n
    n_seq = -(-total // seq_len)
    n_shards = -(-n_seq // shard_size)
    manifest = {"n_tokens": total, "n_sequences": n_seq, "seq_len": seq_len, "shard_size": shard_size, "n_shards": n_shards, "stride": 2 * seq_len, "key": key}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    if not n_seq:
        return manifest
    order = Feistel(n_seq, key)
    ranges = min(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_, squeeze = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=6)
        for batch in batches:
            for task, start, ids in zip(batch["task"].to_pylist(), batch["start"].to_pylist(), batch["ids"], strict=True):
                ids = np.frombuffer(open_.decompress(ids.as_py()), dtype="<u2")
                first = base[task] + start
                cuts = np.arange(first // seq_len + 1, (first + len(ids) - 1) // seq_len + 1) * seq_len - first
                edges = [0, *cuts.tolist(), len(ids)]
                sequence = (first + np.array(edges[:-1])) // seq_len
                slot = order.slot_of(sequence)
                yield pa.RecordBatch.from_pydict(
                    {
                        "slot": pa.array(slot, pa.int64()),
                        "at": pa.array((first + np.array(edges[:-1])) % seq_len, pa.int64()),
                        "ids": [squeeze.compress(ids[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:], strict=True)],
                        "range": pa.array(slot // shard_size * ranges // n_shards, pa.int32()),
                    }
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs

        open_ = zstandard.ZstdDecompressor()
        files, root = fs.FileSystem.from_uri(path)
        files.create_dir(f"{root}/shards", recursive=True)
        shard, out, name, slot, record = -1, None, "", -1, None

        def put() -> None:
            if record is not None:
                out.write(record.tobytes())

        def close() -> None:
            if out is not None:
                out.close()
                final = f"{root}/shards/{shard:08d}.bin"
                if files.get_file_info(final).type != fs.FileType.NotFound:
                    files.delete_file(final)  # an earlier attempt's
                files.move(name, final)

        done = 0
        for batch in batches:
            for s, at, ids in zip(batch["slot"].to_pylist(), batch["at"].to_pylist(), batch["ids"], strict=True):
                if s != slot:
                    put()
                    record = None
                    if s // shard_size != shard:
                        close()
                        shard, done = s // shard_size, done + 1
                        name = f"{root}/shards/.{shard:08d}-{uuid.uuid4().hex}"
                        out = files.open_output_stream(name)
                    slot, record = s, np.full(seq_len, PAD, dtype="<u2")
                ids = np.frombuffer(open_.decompress(ids.as_py()), dtype="<u2")
                record[at : at + len(ids)] = ids
        put()
        close()
        yield pa.RecordBatch.from_pydict({"shards": pa.array([done], pa.int64())})

    cut = packed.mapInArrow(pieces, "slot long, at long, ids binary, range int")
    dealt = cut.repartitionById(ranges, "range").sortWithinPartitions("slot", "at")
    written = dealt.select("slot", "at", "ids").mapInArrow(write, "shards long").agg(F.sum("shards")).first()[0]
    if written != n_shards:
        raise RuntimeError(f"{written} shards were written, {n_shards} are due")
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()[0])


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Records of the slots first..last-1: slot, shard, byte_offset, sequence, n_tokens, ids (little-endian bytes)."""
    m = read_manifest(spark, path)
    last = m["n_sequences"] if last is None else min(last, m["n_sequences"])
    size, stride = m["shard_size"], m["stride"]
    schema = "slot long, shard long, byte_offset long, sequence long, n_tokens long, ids binary"
    if first >= last:
        return spark.createDataFrame([], schema)
    order = Feistel(m["n_sequences"], m["key"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                low, high = max(first, shard * size), min(last, (shard + 1) * size)
                with files.open_input_file(f"{root}/shards/{shard:08d}.bin") as f:
                    f.seek((low - shard * size) * stride)
                    for at in range(low, high, 256):
                        slot = np.arange(at, min(at + 256, high))
                        raw = f.read(len(slot) * stride)
                        ids = np.frombuffer(raw, dtype="<u2").reshape(len(slot), -1)
                        yield pa.RecordBatch.from_pydict(
                            {
                                "slot": pa.array(slot, pa.int64()),
                                "shard": pa.array(np.full(len(slot), shard), pa.int64()),
                                "byte_offset": pa.array((slot - shard * size) * stride, pa.int64()),
                                "sequence": pa.array(order.sequence_of(slot), pa.int64()),
                                "n_tokens": pa.array((ids != PAD).sum(axis=1), pa.int64()),
                                "ids": [raw[k * stride : (k + 1) * stride] for k in range(len(slot))],
                            }
                        )

    shards = spark.range(first // size, (last - 1) // size + 1)
    return shards.mapInArrow(read, schema)


def op7_token_shards(docs: DataFrame) -> DataFrame:
    """Every sequence as read back from the shards, with the digest of its record."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    write_shards(docs, path)
    return read_slots(spark, path).select("slot", "shard", "byte_offset", "sequence", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))
