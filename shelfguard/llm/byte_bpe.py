r"""Byte-level BPE encoding and decoding by a prefix-sharing trie of words.

A text is cut at added tokens and then into words, as the tokenizer file's byte-level
splitter does; every word is encoded by itself with the file's merges (lowest rank
first, leftmost first). ``decode`` joins the tokens' bytes and reads them as UTF-8.

Method. For each prefix of a word, BPE's result ends in exactly one token: the token
``t`` at its end that is *compatible* with the last token of what stands before ``t``
(encoding the two side by side gives just these two). So a prefix's state is one token.
Each task keeps a trie of the words it has met. New distinct words of a batch are
inserted in sorted order, a depth-first walk: the states on the way down are those of
the current word's prefixes, a node's state follows from them, and a prefix that words
share is worked out once. A word's tokens are read backwards along its path.

Compatible. Undo the merges on both sides of the seam, latest first. If the
two tokens that touch have a merge of their own, it would have come before the merge
just undone (by its rank; equal ranks go to the left), so the pair isn't compatible.

Bounds. Trie and memory of words are started anew at ``NODES`` nodes; results
do not depend on it. A word of n bytes takes time in proportion to n times the longest run
of bytes at its end that also ends a token. No text, word or batch of texts is cut.

The splitter's classes of characters (letter, number, space) are those of the installed
tokenizers library: a character that the fast pattern treats otherwise (newer or older
Unicode tables) is found by asking the library once, and texts that hold one are
split by the library's own splitter.

Defined results: a null text gives null ids (the query reads it as empty), an empty
one no ids. Repeated rows are encoded alike. Columns named like an output are replaced,
others stay.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator
from itertools import islice
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfguard.llm.common import in_small_batches, tidy
from shelfguard.llm.pieces import spans

MODEL_NAME = "byte_bpe_50k.json"
#: Trie nodes that a worker holds before it starts anew.
NODES = 700_000
#: Pairs whose compatibility a worker remembers.
PAIRS = 400_000
#: Words of one text split and encoded together.
WORDS = 100_000
#: Texts encoded together and sent on together.
TOGETHER = 256


def model_path(name: str = MODEL_NAME) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the file: printable Latin-1 itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, merges by rank, and what each token was merged from."""

    def __init__(self, model: dict):
        if model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("not a plain byte-level BPE model")
        letters = byte_letters()
        self.ids = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        self.length = {i: len(b) for i, b in self.bytes.items()}
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank = dict.fromkeys(self.bytes, -1)
        vocab = model["vocab"]
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if whole in self.parts or max(self.rank[left], self.rank[right]) >= rank:
                raise ValueError("merges don't build tokens one by one")
            self.merges[left, right], self.parts[whole], self.rank[whole] = rank, (left, right), rank
        self.pairs: dict[int, bool] = {}
        # Every end of every token, with the token itself where it is one that BPE gives for its own bytes.
        self.ends: dict[bytes, int] = {}
        for i, b in sorted(self.bytes.items(), key=lambda x: len(x[1])):
            for k in range(1, len(b)):
                self.ends.setdefault(b[k:], -1)
            self.ends[b] = i if i not in self.parts or self._stays_whole(i) else -1

    def _quiet(self, left: int, right: int, before: int, strict: bool) -> bool:
        """No merge across the seam of ``left`` and ``right`` comes before rank ``before``.

        ``strict`` says that ``before`` is a merge to the left of the seam, which goes first at equal rank.
        """
        while True:
            seam = self.merges.get((left, right))
            if seam is not None and (seam < before or (seam == before and not strict)):
                return False
            a, b = self.rank[left], self.rank[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                left, before, strict = self.parts[left][1], a, True
            else:
                right, before, strict = self.parts[right][0], b, False

    def _stays_whole(self, token: int) -> bool:
        left, right = self.parts[token]
        # Its halves are shorter and were judged before; at its own rank the two do merge.
        if -1 in (self.ends[self.bytes[left]], self.ends[self.bytes[right]]):
            return False
        return self._quiet(left, right, self.rank[token], True)

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._quiet(left, right, len(self.merges), True)
        return known


class WordTrie:
    """Words met so far; each node holds the last token of its prefix's encoding."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.last = [-1]

    def __len__(self) -> int:
        return len(self.last)

    def _grow(self, word: bytes, depth: int, path: list[int]) -> int:
        """A node for ``word[:depth]``; ``path`` has the nodes of all shorter prefixes."""
        ends, last, pairs = self.vocabulary.ends.get, self.last, self.vocabulary.pairs
        start, found = depth - 1, []
        token = ends(word[start:depth])
        while token is not None:
            if token >= 0:
                found.append(token)
                found.append(start)
            start -= 1
            token = ends(word[start:depth]) if start >= 0 else None
        while found:  # the longest is the likeliest
            start, token = found.pop(), found.pop()
            if not start:
                last.append(token)
                return len(last) - 1
            left = last[path[start]]
            fits = pairs.get(left << 32 | token)
            if fits or (fits is None and self.vocabulary.compatible(left, token)):
                last.append(token)
                return len(last) - 1
        raise ValueError(f"the vocabulary has no token for the byte {word[depth - 1]}")

    def encode(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each word with its tokens. Words come sorted, so the walk is depth-first."""
        child, last, length = self.child, self.last, self.vocabulary.length
        path, previous = [0], b""
        for word in words:
            shared = len(commonprefix((previous, word)))
            del path[shared + 1 :]
            node = path[-1]
            for depth in range(shared, len(word)):
                edge = node << 8 | word[depth]
                node = child.get(edge)
                if node is None:
                    node = child[edge] = self._grow(word, depth + 1, path)
                path.append(node)
            previous, at, tokens = word, len(word), []
            while at:
                token = last[path[at]]
                tokens.append(token)
                at -= length[token]
            tokens.reverse()
            yield word, tokens


class Splitter:
    """Words of a text as the tokenizers library's byte-level splitter cuts them."""

    def __init__(self, config: dict):
        import regex
        from tokenizers import Tokenizer

        pre = config.get("pre_tokenizer") or {}
        if config.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("not the plain byte-level splitter")
        # FIXED VALUE: the byte-level splitter's pattern.
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.library = Tokenizer.from_str(json.dumps({**config, "truncation": None, "padding": None})).pre_tokenizer
        self.same = set(map(chr, range(128)))
        self.other: set[str] = set()

    def _by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def _agrees(self, text: str) -> bool:
        for c in set(text) - self.same:
            if c not in self.other:
                probe = f"a{c}1{c}! {c} {c}{c}"
                (self.same if self.pattern.findall(probe) == self._by_library(probe) else self.other).add(c)
            if c in self.other:
                return False
        return True

    def words(self, text: str) -> Iterator[list[str]]:
        """The words in order, some at a time."""
        if not self._agrees(text):
            yield self._by_library(text)
        elif len(text) <= 4 * WORDS:
            yield self.pattern.findall(text)
        else:
            found = (m.group() for m in self.pattern.finditer(text))
            while some := list(islice(found, WORDS)):
                yield some


class Encoder:
    """Texts to packed ids (little-endian unsigned 32-bit integers)."""

    def __init__(self, path: str, nodes: int = NODES):
        import regex

        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.trie = WordTrie(Vocabulary(config["model"]))
        self.split = Splitter(config)
        self.nodes = nodes
        self.words: dict[str, bytes] = {}
        self.packed = {i: i.to_bytes(4, "little") for i in self.trie.vocabulary.bytes}
        self.added = {}
        for token in config.get("added_tokens") or []:
            if token.get("lstrip") or token.get("rstrip") or token.get("single_word"):
                raise ValueError(f"added token {token['content']!r} isn't plain text")
            self.added[token["content"]] = token["id"].to_bytes(4, "little")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.added else None

    def _learn(self, texts: list[list[str]]) -> None:
        """Insert the distinct words that aren't known yet."""
        new = set().union(*texts).difference(self.words)
        if new and len(self.trie) > self.nodes:
            self.trie.clear()
            self.words.clear()
            new = set().union(*texts)
        for word, tokens in self.trie.encode(sorted(w.encode() for w in new)):
            self.words[word.decode()] = b"".join([self.packed[t] for t in tokens])

    def _parts(self, text: str) -> Iterator[tuple[bytes | None, list[str]]]:
        """The text's added tokens and runs of words, in order."""
        cut = self.cut.split(text) if self.cut and any(t in text for t in self.added) else [text]
        for x in cut:
            if x in self.added:
                yield self.added[x], []
            elif x:
                for words in self.split.words(x):
                    yield None, words

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes | None]:
        """Packed ids of each text. Words of many texts are learnt at once, of very long ones in turn."""
        out, waiting, held = [], [], 0

        def settle():
            self._learn([words for _, _, words in waiting])
            known = self.words.__getitem__
            for i, token, words in waiting:
                out[i].append(token or b"".join(map(known, words)))
            waiting.clear()

        for i, text in enumerate(texts):
            out.append(None if text is None else [])
            for token, words in self._parts(text or ""):
                waiting.append((i, token, words))
                held += len(words)
                if held > WORDS:
                    settle()
                    held = 0
        settle()
        return [None if x is None else b"".join(x) for x in out]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


class Decoder:
    """Packed ids to text: the tokens' bytes read as UTF-8, added tokens as they are written."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        letters = byte_letters()
        tokens = {i: bytes(letters[c] for c in t) for t, i in config["model"]["vocab"].items()}
        tokens |= {t["id"]: t["content"].encode() for t in config.get("added_tokens") or []}
        table = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.bytes = np.frombuffer(b"".join(table), dtype=np.uint8)
        self.lens = np.array([len(b) for b in table], dtype=np.int64)
        self.start = np.cumsum(self.lens) - self.lens

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
        return self.bytes[spans(self.start[ids], self.lens[ids])].tobytes().decode("utf-8", "replace")


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    """A worker serves many tasks: it reads a file's tables once."""
    return Encoder(path)


@functools.lru_cache(maxsize=1)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def _as_lists(packed: list[bytes | None]) -> pa.ListArray:
    ends = np.cumsum([0, *[len(p) // 4 if p else 0 for p in packed]])
    values = np.frombuffer(b"".join(p for p in packed if p), dtype="<u4").astype(np.int32)
    missing = pa.array([p is None for p in packed]) if None in packed else None
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=missing)


def bpe_encode(
    docs: DataFrame, model: str | None = None, text: str = "text", ids: str = "ids", packed: bool = False, decoded: str | None = None
) -> DataFrame:
    """``docs`` with ``ids``: an array of token ids, or with ``packed`` their little-endian 32-bit bytes.

    ``decoded`` names a column for the text that the ids stand for, made in the same pass.
    """
    path = model or model_path()
    own = [ids, *([decoded] if decoded else [])]
    rows = in_small_batches(docs).select(*[c for c in docs.columns if c not in own])

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(path), _decoder(path) if decoded else None
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                found = encoder.encode_all(part.column(text).to_pylist())
                columns = [*part.columns, pa.array(found, pa.binary()) if packed else _as_lists(found)]
                if decoder:
                    columns.append(pa.array([None if x is None else decoder.decode(x) for x in found], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *own])

    fields = [T.StructField(ids, T.BinaryType() if packed else T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    return rows.mapInArrow(encode, T.StructType([*rows.schema.fields, *fields]))


def bpe_decode(encoded: DataFrame, model: str | None = None, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text that ``ids`` (an array, or packed) stand for."""
    path = model or model_path()
    rows = in_small_batches(encoded).select(*[c for c in encoded.columns if c != to])

    @tidy
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in batches:
            out = []
            for x in batch.column(ids):
                if x.is_valid and isinstance(x, pa.ListScalar):
                    out.append(decoder.decode(x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()))
                else:
                    out.append(decoder.decode(x.as_py()) if x.is_valid else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, to])

    return rows.mapInArrow(decode, T.StructType([*rows.schema.fields, T.StructField(to, T.StringType())]))


def op11_byte_bpe(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = bpe_encode(rows, packed=True, decoded="decoded")
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
