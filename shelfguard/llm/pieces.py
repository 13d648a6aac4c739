r"""SentencePiece encoding and decoding with exact N-best segmentation.

A text is normalised as the model asks (spaces become ``▁``, one is put before
the text) and segmented into vocabulary pieces so that the sum of piece scores is
largest. A character that no piece covers costs ``lowest score - 10`` and is
written as its UTF-8 bytes (byte fallback). ``decode`` turns ids back into text.

Method. Forward Viterbi over the piece lattice gives every position its best
score from the start. A-star from the end backwards uses those scores as its
heuristic; they are exact, so segmentations leave the agenda in order of their
score and the first N are the N best. Two facts make it affordable:

* ``▁`` occurs in pieces only at the front (checked on load), so no piece crosses
  the start of a ``▁`` run; the lattice of a text is a chain of chunk lattices.
  Viterbi runs once per different chunk, for thousands of chunks at a time in
  numpy, and gives each chunk's best path and the loss of its second best one.
* The N best paths of the chain change at most N-1 chunks, and only those with
  the smallest losses; A-star runs on these few chunk lattices, and a table of the N
  least sums (``chain_n_best``) merges their losses, chunk by chunk, into the N best of the text.

Equal scores: within a chunk, the best path takes the shorter last piece first
(and so on backwards); whole texts with equal scores are ordered by the list of
(chunk number, rank in the chunk) of their changed chunks.

Defined results: a null text gives null ids and no segmentations; an empty text
gives no ids and one empty segmentation. Texts of any length are encoded whole.
Repeated rows are encoded alike. Columns named like an output are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
MARK = "▁"
#: Penalty below the lowest piece score for a character outside the vocabulary.
UNKNOWN_LOSS = 10.0
#: Chunks a worker remembers before it starts anew.
CACHE = 120_000
#: Cells (position, chunk) searched together: what a search holds beside its results is some 100 bytes a cell.
CELLS = 1 << 16
_MULT = np.uint64(0x9E3779B97F4A7C15)


def spans(start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices start, start+1 ... of each span, end to end."""
    return np.repeat(start - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


class _Numbers(dict):
    """Numbers chunks as they come."""

    def __init__(self, chunks: list[str]):
        self.chunks = chunks

    def __missing__(self, chunk: str) -> int:
        k = self[chunk] = len(self.chunks)
        self.chunks.append(chunk)
        return k


class _Partial:
    """An agenda entry: minus the whole score, position, score behind, last piece, entry behind,
    and one farther behind, by which two paths are compared in few steps."""

    __slots__ = ("behind", "depth", "jump", "pid", "pos", "score", "whole")

    def __init__(self, whole: float, pos: int, score: float, pid: int, behind: _Partial | None):
        self.whole, self.pos, self.score, self.pid, self.behind = whole, pos, score, pid, behind
        if behind is None:
            self.depth, self.jump = 0, self
        else:
            far = behind.jump
            self.depth = behind.depth + 1
            self.jump = far.jump if behind.depth - far.depth == far.depth - far.jump.depth else behind

    def __lt__(self, other: _Partial) -> bool:
        if self.whole != other.whole:
            return self.whole < other.whole
        # Ties: by the piece lengths from the end. The first that differs follows the last common entry.
        a, b = self.up_to(other.depth), other.up_to(self.depth)
        if a is b:
            return self.depth < other.depth
        while a.behind is not b.behind:
            a, b = (a.jump, b.jump) if a.jump is not b.jump else (a.behind, b.behind)
        return a.pos > b.pos

    def up_to(self, depth: int) -> _Partial:
        at = self
        while at.depth > depth:
            at = at.jump if at.jump.depth >= depth else at.behind
        return at


class Lattice:
    """Piece lookup and search over chunk lattices of one model."""

    def __init__(self, pieces: list[str], scores: list[float], ids: list[int], byte_ids: list[int]):
        self.piece = dict(zip(pieces, zip(ids, scores, strict=True), strict=True))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece holds the space mark behind another character")
        self.byte_ids = byte_ids
        self.unknown = min(scores, default=0.0) - UNKNOWN_LOSS
        self.longest = max(map(len, pieces), default=1)
        chars = {c for p in pieces for c in p}
        #: White space that no piece holds stands alone, so chunks stay short.
        alone = re.escape("".join(c for c in "\n\r\t" if c not in chars))
        self.chunk = re.compile(f"[{alone}]|{MARK}*[^{MARK}{alone}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        keys = np.array([self._hash(np.array([ord(c) for c in p], dtype=np.uint64)) for p in pieces], dtype=np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("piece hashes collide")
        self.key_ids = np.array(ids, dtype=np.int64)[order]
        self.key_scores = np.array(scores, dtype=np.float64)[order]
        # First key of each 20-bit hash prefix; few keys share one.
        top = (self.keys >> np.uint64(44)).astype(np.int64)
        self.first = np.searchsorted(top, np.arange((1 << 20) + 1)).astype(np.int32)
        self.chain = int(np.diff(self.first).max(initial=1))

    @staticmethod
    def load(path: str) -> Lattice:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        byte = {sp.id_to_piece(i): i for i in range(n) if sp.is_byte(i)}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        return Lattice(
            [sp.id_to_piece(i) for i in plain], [sp.get_score(i) for i in plain], plain,
            [byte[f"<0x{b:02X}>"] for b in range(256)],
        )

    @staticmethod
    def _hash(codes: np.ndarray) -> np.uint64:
        h = np.zeros(1, dtype=np.uint64)
        for c in codes:
            h = (h ^ (c + np.uint64(1))) * _MULT
            h ^= h >> np.uint64(29)
        return h[0]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash among the keys, or -1."""
        at = self.first[(h >> np.uint64(44)).astype(np.int64)]
        found = np.full(len(h), -1, dtype=np.int64)
        for step in range(self.chain):
            i = np.minimum(at + step, len(self.keys) - 1)
            found = np.where(self.keys[i] == h, i, found)
        return found

    def viterbi(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best ids of all chunks end to end, and for each chunk their number, the best
        score and the loss of the second best path (inf: none)."""
        lengths = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        order = np.argsort(lengths, kind="stable")
        parts, at = [], 0
        while at < len(order):  # chunks of like length together; a block holds at most CELLS cells
            widest = 2 * lengths[order[at]] + 4
            end = min(np.searchsorted(lengths[order], widest, "right"), at + max(1, CELLS // widest))
            block = order[at:end]
            parts.append(self._block([chunks[i] for i in block], int(lengths[block[-1]])))
            at = end
        ids, lens, score, loss = (np.concatenate(x) for x in zip(*parts, strict=True))
        # From the order of lengths back to that of the chunks.
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        start = (np.cumsum(lens) - lens)[back]
        lens, score, loss = lens[back], score[back], loss[back]
        return ids[spans(start, lens)], lens, score, loss

    def _block(self, chunks: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        rows = len(chunks)
        n = np.fromiter(map(len, chunks), dtype=np.int64, count=rows)
        flat = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        # Cells are (position, row), so that every step reads whole lines of memory.
        code = np.zeros((width, rows), dtype=np.uint64)
        row = np.repeat(np.arange(rows), n)
        code[np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n), row] = flat
        inside = np.arange(width)[:, None] < n
        forward = np.full((width + 1, rows), -np.inf)
        forward[0] = 0.0
        back_len = np.zeros((width + 1, rows), dtype=np.int16)
        back_id = np.full((width + 1, rows), -1, dtype=np.int32)
        edges = []  # (start, length, rows, score)
        found: list[list] = [[] for _ in range(width + 1)]
        h = np.zeros((width, rows), dtype=np.uint64)
        for size in range(1, min(self.longest, width) + 1):
            starts = width - size + 1
            h = (h[:starts] ^ (code[size - 1 :] + np.uint64(1))) * _MULT
            h ^= h >> np.uint64(29)
            cells = np.flatnonzero(inside[size - 1 :].ravel())
            k = self._find(h.ravel()[cells])
            hit = k >= 0
            s, r = np.divmod(cells[hit], rows)
            if size == 1:  # what no piece covers alone
                s0, r0 = np.divmod(cells[~hit], rows)
                s, r = np.concatenate([s, s0]), np.concatenate([r, r0])
                sc = np.concatenate([self.key_scores[k[hit]], np.full(len(s0), self.unknown)])
                pid = np.concatenate([self.key_ids[k[hit]], np.full(len(s0), -1)])
                o = np.argsort(s, kind="stable")
                s, r, sc, pid = s[o], r[o], sc[o], pid[o]
            else:
                sc, pid = self.key_scores[k[hit]], self.key_ids[k[hit]]
            cut = np.searchsorted(s, np.arange(starts + 1))
            for start in range(starts):
                a, b = cut[start], cut[start + 1]
                if b > a:
                    found[start + size].append((size, r[a:b], sc[a:b], pid[a:b]))
        for end in range(1, width + 1):
            for size, r, sc, pid in found[end]:  # shorter pieces first: they win ties
                total = forward[end - size, r] + sc
                better = total > forward[end, r]
                w = r[better]
                forward[end, w] = total[better]
                back_len[end, w], back_id[end, w] = size, pid[better]
                edges.append((end, size, r, sc))
        best = forward[n, np.arange(rows)]
        # Backward scores; an edge off the best path loses best - through(edge).
        onward = np.full((width + 1, rows), -np.inf)
        onward[n, np.arange(rows)] = 0.0
        taken = np.zeros((width + 1, rows), dtype=np.int16)  # length of the best path's piece that ends here
        pos, ids_rev, lens = n.copy(), [], np.zeros(rows, dtype=np.int64)
        live = np.flatnonzero(pos > 0)
        while len(live):
            size = back_len[pos[live], live]
            taken[pos[live], live] = size
            ids_rev.append((live, pos[live], back_id[pos[live], live]))
            lens[live] += 1
            pos[live] -= size
            live = live[pos[live] > 0]
        second = np.full(rows, -np.inf)
        for end, size, r, sc in reversed(edges):
            through = onward[end, r] + sc
            whole = np.where(taken[end, r] == size, -np.inf, through + forward[end - size, r])
            second[r] = np.maximum(second[r], whole)
            onward[end - size, r] = np.maximum(onward[end - size, r], through)
        r, p, i = (np.concatenate([x[k] for x in ids_rev])[::-1] for k in range(3))
        o = np.argsort(r, kind="stable")
        r, p, i = r[o], p[o], i[o]
        unknown = np.flatnonzero(i < 0)
        if len(unknown):  # written as bytes
            own = [[self.byte_ids[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in code[p[unknown] - 1, r[unknown]].tolist()]
            times = np.ones(len(i), dtype=np.int64)
            times[unknown] = [len(x) for x in own]
            at = np.cumsum(times) - times
            i = np.repeat(i, times)
            i[spans(at[unknown], times[unknown])] = np.concatenate(own)
            lens = np.bincount(r, weights=times, minlength=rows).astype(np.int64)
        return i.astype(np.int32), lens, best, best - second

    def _bytes(self, chunk: str, ids, ends) -> np.ndarray:
        out: list[int] = []
        for i, end in zip(ids, ends, strict=True):
            if i >= 0:
                out.append(int(i))
            else:
                out += [self.byte_ids[b] for b in chunk[end - 1].encode("utf-8", "surrogatepass")]
        return np.array(out, dtype=np.int32)

    def edges_to(self, chunk: str) -> list[list[tuple[int, float, int]]]:
        """By end position: (start, score, id or -1)."""
        into: list[list] = [[] for _ in range(len(chunk) + 1)]
        for end in range(1, len(chunk) + 1):
            for size in range(1, min(self.longest, end) + 1):
                hit = self.piece.get(chunk[end - size : end])
                if hit:
                    into[end].append((end - size, hit[1], hit[0]))
                elif size == 1:
                    into[end].append((end - 1, self.unknown, -1))
        return into

    def n_best(self, chunk: str, n: int) -> list[tuple[float, np.ndarray]]:
        """The n best segmentations by backward A-star under the forward Viterbi scores."""
        into = self.edges_to(chunk)
        forward = [0.0] + [-np.inf] * len(chunk)
        for end in range(1, len(chunk) + 1):
            forward[end] = max(forward[start] + s for start, s, _ in into[end])
        # An entry holds its last piece and the entry behind it; whole paths are never copied.
        agenda = [_Partial(-forward[-1], len(chunk), 0.0, -1, None)]
        out = []
        while agenda and len(out) < n:
            top = heapq.heappop(agenda)
            pos = top.pos
            if pos == 0:
                ids, ends, at = [], [], top
                while at.behind is not None:
                    ids.append(at.pid)
                    ends.append(at.behind.pos)
                    at = at.behind
                out.append((-top.whole, self._bytes(chunk, ids, ends)))
                continue
            for start, s, pid in into[pos]:
                heapq.heappush(agenda, _Partial(-(forward[start] + s + top.score), start, top.score + s, pid, top))
        return out


def chain_n_best(options: list[tuple[int, list[float]]], n: int) -> list[tuple[float, tuple[tuple[int, int], ...]]]:
    """The n smallest total losses over a chain of chunks.

    ``options``: (chunk number, losses of its 2nd, 3rd ... best path). Returns
    (loss, changed chunks as (number, rank)), in order.
    """
    best = [(0.0, ())]
    for number, losses in sorted(options):
        more = [(total + x, (*changed, (number, rank))) for total, changed in best for rank, x in enumerate(losses, 1)]
        best = sorted(best + more)[:n]
    return best


class Encoder:
    """Encodes texts, remembering chunks."""

    def __init__(self, lattice: Lattice, n_best: int = N_BEST, cache: int = CACHE):
        self.lattice, self.n, self.cache = lattice, n_best, cache
        self._reset()

    def _reset(self) -> None:
        self.chunks: list[str] = []
        self.number = _Numbers(self.chunks)
        self.ids = np.zeros(0, dtype=np.int32)
        self.start = np.zeros(1, dtype=np.int64)
        self.score = np.zeros(0)
        self.loss = np.zeros(0)
        self.paths: dict[str, list] = {}

    def _learn(self) -> None:
        new = self.chunks[len(self.score) :]
        if new:
            ids, lens, score, loss = self.lattice.viterbi(new)
            self.ids = np.concatenate([self.ids, ids])
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lens)])
            self.score, self.loss = np.concatenate([self.score, score]), np.concatenate([self.loss, loss])

    def encode(self, texts: list[str | None]) -> list[tuple | None]:
        """(ids, [(score, [(chunk's first token, tokens replaced, new ids), ...]), ...]) of each text."""
        if len(self.chunks) > self.cache:
            self._reset()
        number, cut = self.number, self.lattice.chunk.findall
        rows = [
            None if text is None else np.array([number[w] for w in cut(MARK + text.replace(" ", MARK))] if text else [], dtype=np.int64)
            for text in texts
        ]
        self._learn()
        return [None if r is None else self._row(r) for r in rows]

    def _row(self, row: np.ndarray) -> tuple:
        start = self.start[row]
        lens = self.start[row + 1] - start
        first = np.cumsum(lens) - lens
        ids = self.ids[spans(start, lens)]
        best = float(self.score[row].sum())
        if self.n == 1:
            return ids, [(best, [])]
        loss = self.loss[row]
        # A changed chunk loses its second-best loss at least: beyond the n-1
        # smallest (and earliest, at ties) no chunk changes among the n best.
        least = np.lexsort((np.arange(len(row)), loss))[: self.n - 1] if len(row) <= 4 * self.n else self._smallest(loss)
        options = []
        for k in least:
            if np.isfinite(loss[k]):
                paths = self._paths(self.chunks[row[k]])
                options.append((int(k), [paths[0][0] - p[0] for p in paths[1:]]))
        out = []
        for total, changed in chain_n_best(options, self.n):
            edits = [(int(first[k]), int(lens[k]), self._paths(self.chunks[row[k]])[rank][1]) for k, rank in changed]
            out.append((best - total, edits))
        return ids, out

    def _smallest(self, loss: np.ndarray) -> np.ndarray:
        kth = np.partition(loss, self.n - 2)[self.n - 2]
        near = np.flatnonzero(loss <= kth)
        return near[np.argsort(loss[near], kind="stable")[: self.n - 1]]

    def _paths(self, chunk: str) -> list:
        hit = self.paths.get(chunk)
        if hit is None:
            hit = self.paths[chunk] = self.lattice.n_best(chunk, self.n)
        return hit


def apply_edits(ids: np.ndarray, edits) -> np.ndarray:
    parts, at = [], 0
    for first, count, new in edits:
        parts += [ids[at:first], new]
        at = first + count
    return np.concatenate([*parts, ids[at:]]).astype(np.int32)


class Decoder:
    """ids to text: pieces joined, ``▁`` a space, the space in front dropped, byte runs read as UTF-8."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        text = []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                text.append(bytes([int(p[3:5], 16)]))
            else:
                text.append(b"" if sp.is_control(i) or sp.is_unknown(i) else p.replace(MARK, " ").encode())
        self.bytes = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.lens = np.array([len(x) for x in text], dtype=np.int64)
        self.start = np.cumsum(self.lens) - self.lens

    def decode(self, ids) -> str:
        ids = np.asarray(ids, dtype=np.int64)
        out = self.bytes[spans(self.start[ids], self.lens[ids])].tobytes().decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out


#: Texts encoded together and sent on together: bounds what a worker holds.
TOGETHER = 256

EDIT = T.StructType(
    [
        T.StructField("first", T.IntegerType()),
        T.StructField("replaced", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)
PATH = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(EDIT))])


def _lists(counts: list[int | None], values: pa.Array) -> pa.ListArray:
    """A list for each count (None: a null) over ``values`` end to end."""
    ends = np.cumsum([c or 0 for c in counts])
    missing = pa.array([c is None for c in counts]) if None in counts else None
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values, mask=missing)


def _encoded(rows: list[tuple | None]) -> tuple[pa.ListArray, pa.ListArray]:
    """The ids and n_best columns of some encoded rows."""
    there = [r for r in rows if r is not None]
    ids = _lists([None if r is None else len(r[0]) for r in rows], pa.array(np.concatenate([np.zeros(0, np.int32), *[r[0] for r in there]])))
    paths = [p for r in there for p in r[1]]
    edits = [e for _, own in paths for e in own]
    changed = _lists([len(e[2]) for e in edits], pa.array(np.concatenate([np.zeros(0, np.int32), *[e[2] for e in edits]])))
    edit = pa.StructArray.from_arrays(
        [pa.array([e[0] for e in edits], pa.int32()), pa.array([e[1] for e in edits], pa.int32()), changed], ["first", "replaced", "ids"]
    )
    path = pa.StructArray.from_arrays([pa.array([x for x, _ in paths], pa.float64()), _lists([len(own) for _, own in paths], edit)], ["score", "edits"])
    return ids, _lists([None if r is None else len(r[1]) for r in rows], path)


def sentencepiece_encode(docs: DataFrame, model: str = MODEL, n_best: int = N_BEST, text: str = "text", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (the best segmentation) and ``n_best`` (each as edits of ``ids``).

    ``decoded`` names a column for the text that the ids stand for, made in the same pass.
    """
    own = ["ids", "n_best", *([decoded] if decoded else [])]
    rows = in_small_batches(docs).select(*[c for c in docs.columns if c not in own])

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(Lattice.load(model), n_best), Decoder(model) if decoded else None
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                found = encoder.encode(part.column(text).to_pylist())
                columns = [*part.columns, *_encoded(found)]
                if decoder:
                    columns.append(pa.array([None if r is None else decoder.decode(r[0]) for r in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *own])

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_best", T.ArrayType(PATH))]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    return rows.mapInArrow(encode, T.StructType([*rows.schema.fields, *fields]))


def sentencepiece_decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text that ``ids`` stand for."""
    rows = in_small_batches(encoded).select(*[c for c in encoded.columns if c != to])

    @tidy
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                out = [None if not x.is_valid else decoder.decode(x.values.to_numpy(zero_copy_only=False)) for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, to])

    return rows.mapInArrow(decode, T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())]))


def op1_sentencepiece(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, the best ids, the scores of the N best with their edits, and whether decoding gives the text back."""
    # ▁ in a text reads as a space: the model writes both the same way.
    own = F.sha2(F.translate("text", MARK, " "), 256).alias("own")
    out = sentencepiece_encode(docs.select("doc_id", "text", own), model, decoded="decoded")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.transform("n_best", lambda x: x["score"]).alias("scores"),
        F.transform("n_best", lambda x: x["edits"]).alias("edits"),
        (F.sha2("decoded", 256) == F.col("own")).alias("round_trip"),
    )
