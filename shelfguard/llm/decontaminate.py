r"""Benchmark decontamination by an FM-index per training shard.

Words are the runs ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z is lower-cased. A
window is 10 consecutive words of a benchmark item; an item of fewer words, but not
none, is one window. Every document word inside an occurrence of a window is hit.

Method. Each task takes the documents of its partition in shards of about
``SHARD_WORDS`` words and builds one FM-index per shard over word numbers: suffix
array, Burrows-Wheeler transform, a wavelet matrix with popcount ranks, and every
``SAMPLE``-th suffix position. All windows are searched backwards together, each
step two ranks of the wavelet matrix. Occurrences are located by walking to a
sampled suffix, and overlapping ones merge into removal spans (word positions).

Words that no window holds can be part of no occurrence: they only break the text
into runs, and runs shorter than the shortest window are not indexed. This loses
nothing. A text that stands several times in a shard is indexed once.

There is no shuffle: documents stay in their partitions. The benchmark's windows
travel to the tasks in blocks of at most ``BLOCK_BYTES`` of item text; a larger
benchmark takes several passes whose spans are merged by document.

Defined results: null or empty texts have no words and no hits; items without words
have no windows; an item_id that occurs twice counts once; windows of an item with a null id
hit words but name no item. Repeated document rows each get the same answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches, tidy

WINDOW = 10
SHARD_WORDS = 1 << 19
SAMPLE = 8
BLOCK_BYTES = 16 << 20

#: A-Z to a-z; everything that is no word character to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_FOLD).split() if text else []


def spans(start: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())


class Windows:
    """The distinct windows of some items, with the items that each belongs to."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        at: dict[tuple[int, ...], int] = {}
        owners: list[set] = []
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 1) for w in words(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                key = tuple(ids[i : i + window])
                k = at.setdefault(key, len(at))
                if k == len(owners):
                    owners.append(set())
                if item is not None:
                    owners[k].add(item)
        self.lens = np.array([len(k) for k in at], dtype=np.int64)
        #: Word numbers from the last word backwards, 0 beyond the first.
        self.back = np.zeros((len(at), window), dtype=np.int64)
        for row, key in zip(self.back, at, strict=True):
            row[: len(key)] = key[::-1]
        self.owners = [sorted(o) for o in owners]
        self.shortest = int(self.lens.min(initial=1))


class WaveletMatrix:
    """Ranks and symbols of a sequence over 0..size-1."""

    def __init__(self, seq: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.words, self.ones, self.zeros = [], [], []
        seq = seq.astype(np.int64)
        for level in range(self.bits - 1, -1, -1):
            one = ((seq >> level) & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view(np.uint64)
            counts = np.bitwise_count(packed).astype(np.int64)
            self.words.append(packed)
            self.ones.append(np.cumsum(counts) - counts)
            self.zeros.append(len(seq) - int(one.sum()))
            seq = np.concatenate([seq[~one], seq[one]])
        #: Where each symbol's block starts behind the last level.
        self.start = self._down(np.zeros(size, dtype=np.int64), np.arange(size))

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        w, low = i >> 6, (i & 63).astype(np.uint64)
        below = self.words[level][w] & ((np.uint64(1) << low) - np.uint64(1))
        return self.ones[level][w] + np.bitwise_count(below)

    def _down(self, i: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for level in range(self.bits):
            one = self._rank1(level, i)
            i = np.where((symbol >> (self.bits - 1 - level)) & 1 == 1, self.zeros[level] + one, i - one)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before position i."""
        return self._down(i, symbol) - self.start[symbol]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at i, and how often it stands before."""
        symbol = np.zeros(len(i), dtype=np.int64)
        for level in range(self.bits):
            one = self._rank1(level, i)
            bit = (self.words[level][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1
            symbol = symbol * 2 + bit
            i = np.where(bit, self.zeros[level] + one, i - one)
        return symbol, i - self.start[symbol]


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Suffixes of ``text`` (symbols below ``size``) in order; 0 ends a suffix, and
    equal suffixes up to their 0 are ordered by position. The last symbol is 0."""
    n = len(text)
    each = max(1, int(size - 1).bit_length())
    depth = max(1, 62 // each)
    key, open_ = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for k in range(depth):  # the first symbols in one number, nothing behind a 0
        symbol = np.where(open_, np.concatenate([text[k:], np.zeros(min(k, n), dtype=text.dtype)])[:n], 0)
        open_ &= symbol > 0
        key = (key << each) | symbol
    order = np.argsort(key, kind="stable")
    sa = order.copy()
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]]) | ~open_[order]
    rank = np.empty(n, dtype=np.int64)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = first
    single = new & np.concatenate([new[1:], [True]])
    slots = np.flatnonzero(~single)  # only suffixes still tied are sorted again
    while len(slots):
        pos = sa[slots]
        group, behind = rank[pos], rank[pos + depth]
        o = np.lexsort((behind, group))
        pos, group, behind = pos[o], group[o], behind[o]
        sa[slots] = pos
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])])
        first = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[pos] = first
        slots = slots[~(new & np.concatenate([new[1:], [True]]))]
        depth *= 2
    return sa


class FMIndex:
    """Search and locate in a text whose runs end in 0."""

    def __init__(self, text: np.ndarray, size: int, sample: int = SAMPLE):
        sa = suffix_array(text, size)
        before = text[sa - 1]  # of the suffix at 0: the closing 0
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.wavelet = WaveletMatrix(before, size)
        # Run starts are sampled too, so no walk crosses a 0.
        kept = (sa % sample == 0) | (before == 0)
        self.kept, self.sampled = kept, sa[kept]
        self.kept_rank = np.cumsum(kept) - 1
        self.rows = len(text)

    def search(self, back: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which patterns occur, and their first and last+1 rows. ``back``: symbols from the last one backwards."""
        live = np.arange(len(back))
        lo, hi = np.zeros(len(back), dtype=np.int64), np.full(len(back), self.rows, dtype=np.int64)
        for step in range(back.shape[1]):
            go = live[lens[live] > step]
            if not len(go):
                break
            symbol = back[go, step]
            lo[go] = self.counts[symbol] + self.wavelet.rank(symbol, lo[go])
            hi[go] = self.counts[symbol] + self.wavelet.rank(symbol, hi[go])
            live = live[lo[live] < hi[live]]
        return live, lo[live], hi[live]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, steps = np.empty(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            at = rows[todo]
            done = self.kept[at]
            out[todo[done]] = self.sampled[self.kept_rank[at[done]]] + steps[todo[done]]
            todo = todo[~done]
            symbol, rank = self.wavelet.access_rank(rows[todo])
            rows[todo] = self.counts[symbol] + rank
            steps[todo] += 1
        return out


def search_shard(texts: list[list[int]] | list[np.ndarray], windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, window) of every occurrence in a shard of numbered texts."""
    none = np.zeros(0, dtype=np.int64)
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.concatenate([*texts, none])
    if not len(flat) or not len(windows.lens):
        return none, none, none
    # Runs of window words within one text.
    first = np.cumsum(lens) - lens
    known = flat > 0
    starts = known.copy()
    starts[1:] &= ~known[:-1]
    starts[first[lens > 0]] |= known[first[lens > 0]]
    ends = known.copy()
    ends[:-1] &= ~known[1:] | starts[1:]
    a, b = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = b - a >= windows.shortest
    a, b = a[long], b[long]
    if not len(a):
        return none, none, none
    # The index's text: each run with a 0 behind it; ``place`` leads back.
    place = spans(a, b - a + 1)
    text = np.where(place < np.repeat(b, b - a + 1), flat[np.minimum(place, len(flat) - 1)], 0)
    symbols, text = np.unique(text, return_inverse=True)  # 0 stays 0
    back = np.searchsorted(symbols, windows.back)
    back = np.where((windows.back > 0) & (back < len(symbols)), back, 0)
    there = (symbols[back] == windows.back).all(axis=1)
    index = FMIndex(text, len(symbols))
    which = np.flatnonzero(there)
    live, lo, hi = index.search(back[which], windows.lens[which])
    found = np.repeat(which[live], hi - lo)
    at = place[index.locate(spans(lo, hi - lo))]
    owner = np.searchsorted(first, at, "right") - 1
    return owner, at - first[owner], found


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping or touching spans become one."""
    out: list[list[int]] = []
    for a, b in sorted(zip(start.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def contaminate_rows(texts: list[str | None], windows: Windows, shard_words: int = SHARD_WORDS) -> list[tuple[int, list, list]]:
    """(number of words, merged spans, items) of each text."""
    number: dict[str | None, int] = {}
    which = [number.setdefault(x, len(number)) for x in texts]
    get = windows.number.get
    answers: list[tuple[int, list, list]] = []
    shard: list[np.ndarray] = []

    def close() -> None:
        owner, first, found = search_shard(shard, windows)
        o = np.argsort(owner, kind="stable")
        owner, first, found = owner[o], first[o], found[o]
        cut = np.searchsorted(owner, np.arange(len(shard) + 1))
        for k, ids in enumerate(shard):
            a, b = cut[k], cut[k + 1]
            if a == b:
                answers.append((len(ids), [], []))
                continue
            items = {i for w in np.unique(found[a:b]).tolist() for i in windows.owners[w]}
            answers.append((len(ids), merged(first[a:b], first[a:b] + windows.lens[found[a:b]]), sorted(items)))
        shard.clear()

    held = 0
    for text in number:
        shard.append(np.array([get(w, 0) for w in words(text)], dtype=np.int32))
        held += len(shard[-1])
        if held >= shard_words:
            close()
            held = 0
    close()
    return [answers[k] for k in which]


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))


def _pass(docs: DataFrame, items: list[tuple], item_type: T.DataType) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Windows(items))
    result = T.StructType(
        [T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(item_type))]
    )

    @F.pandas_udf(result)
    @tidy
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        windows = shared.value
        for batch in batches:
            rows = contaminate_rows([x if isinstance(x, str) else None for x in batch], windows)
            yield pd.DataFrame(
                {
                    "n_words": np.array([r[0] for r in rows], dtype=np.int64),
                    "spans": pd.Series([[{"first": a, "last": b - 1} for a, b in r[1]] for r in rows], dtype=object),
                    "items": pd.Series([r[2] for r in rows], dtype=object),
                }
            )

    return in_small_batches(docs).withColumn("_hits", search(F.col("text")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, spans (merged, first and last word) and items."""
    rows = docs.select(*[c for c in docs.columns if c not in ("n_words", "spans", "items", "_hits")])
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    item_type = items.schema["item_id"].dataType
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))

    def block(k: int) -> list[tuple]:
        return sorted(((r[0], r[1]) for r in items.where(part == k).collect()), key=str)

    if blocks == 1:
        return _pass(rows, block(0), item_type).select(*rows.columns, "_hits.*")
    # Several passes: their answers meet by the text itself.
    texts = rows.select("text").where("text is not null").distinct()
    found = None
    for k in range(blocks):
        one = _pass(texts, block(k), item_type).select(F.xxhash64("text").alias("_id"), F.length("text").alias("_n"), "_hits.*")
        found = one if found is None else found.unionByName(one)

    @F.pandas_udf(SPANS)
    def join_spans(parts: pd.Series) -> pd.Series:
        out = []
        for p in parts:
            a = np.array([x["first"] for x in p], dtype=np.int64)
            b = np.array([x["last"] for x in p], dtype=np.int64) + 1
            out.append([{"first": x, "last": y - 1} for x, y in merged(a, b)])
        return pd.Series(out, dtype=object)

    found = found.groupBy("_id", "_n").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    found = found.withColumn("spans", join_spans("spans"))
    out = rows.withColumns({"_id": F.xxhash64("text"), "_n": F.length("text")}).join(found, ["_id", "_n"], "left")
    empty = {"n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast(T.ArrayType(item_type))}
    return out.select(*rows.columns, *[F.coalesce(c, e).alias(c) for c, e in empty.items()])


def remove_spans(found: DataFrame, to: str = "clean_text") -> DataFrame:
    """The text without its spans (from the first word's start to the last word's end)."""

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series, spans_: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, spans_, strict=True):
            if text is None or own is None or not len(own):
                out.append(text)
                continue
            at = [m.span() for m in _WORD.finditer(text)]
            parts, here = [], 0
            for s in own:
                parts.append(text[here : at[s["first"]][0]])
                here = at[s["last"]][1]
            out.append("".join([*parts, text[here:]]))
        return pd.Series(out, dtype=object)

    return found.withColumn(to, cut("text", "spans"))


def op9_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM bw WHERE len(ws) > 0)),
m AS (SELECT DISTINCT m FROM win),
grams AS (
  SELECT doc_id, i, m.m, array_to_string(ws[i:i + m.m - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) JOIN m ON i + m.m - 1 <= len(ws)),
hits AS (SELECT doc_id, i, win.m, item_id FROM grams JOIN win ON grams.m = win.m AND grams.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
