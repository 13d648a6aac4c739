from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import byte_bpe
from shelfguard.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(byte_bpe.model_path())


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.model_path())


def _ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


def _by_ranks(word, merges):
    """One merge at a time: lowest rank first, leftmost first."""
    while len(word) > 1:
        rank, at = min((merges.get((a, b), 10**9), i) for i, (a, b) in enumerate(zip(word, word[1:], strict=False)))
        if rank == 10**9:
            break
        word[at : at + 2] = [256 + rank]
    return word


def test_trie_of_random_merges_equals_merging_one_by_one():
    letter = {b: c for c, b in byte_bpe.byte_letters().items()}
    for seed in range(30):
        rng = random.Random(seed)
        alphabet = b"abc"[: rng.randint(1, 3)]
        names, merges, ranks = {b: letter[b] for b in range(256)}, [], {}
        while len(merges) < 25:
            pool = [*alphabet, *range(256, 256 + len(merges))]
            a, b = rng.choice(pool), rng.choice(pool)
            if names[a] + names[b] not in names.values() and (a, b) not in ranks:
                ranks[a, b] = len(merges)
                names[256 + len(merges)] = names[a] + names[b]
                merges.append([names[a], names[b]])
        vocabulary = byte_bpe.Vocabulary({"type": "BPE", "vocab": {n: i for i, n in names.items()}, "merges": merges})
        trie = byte_bpe.WordTrie(vocabulary)
        for _ in range(3):  # later batches meet prefixes that earlier ones left
            words = sorted({bytes(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(150)})
            assert all(tokens == _by_ranks(list(word), ranks) for word, tokens in trie.encode(words))


ODD = [
    "", " ", "\n\n  x", "I'll don't 'S we've", "a  b   c\t\td ", "éà ÄÖ straße", "日本語のテキスト", "🙂🙃 👩‍👩‍👧", "x<|endoftext|>y <|endoftext|><|endoftext|>", "<|endoftext|>",
    "\x1c\x1d\x1e\x1f a\x85b c d", "٣٤٥ ½ Ⅷ", "͸՘࢏₏꟎\U000107bb a", "áë", "﻿bom", "\x00\x01\x7f", "-" * 300, " " * 700, "ab" * 3000, "zq" * 50 + "'s",
]


def test_texts_equal_the_library(encoder, library):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab '.\n\t1é日🙂stelr") for _ in range(rng.randint(1, 200))) for _ in range(500)]
    texts += ["".join(chr(rng.choice([*range(0x300), *range(0x2000, 0x2100), *range(0x1F600, 0x1F640)])) for _ in range(60)) for _ in range(200)]
    decoder = byte_bpe.Decoder(byte_bpe.model_path())
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert _ids(packed) == ids, text
        assert decoder.decode(packed) == library.decode(ids, skip_special_tokens=False) == text


def test_any_ids_decode_as_in_the_library(library):
    rng = random.Random(4)
    decoder = byte_bpe.Decoder(byte_bpe.model_path())
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(20)]
        assert decoder.decode(np.array(ids, dtype="<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)


def test_every_character_is_split_as_in_the_library(encoder, library):
    for first in range(0, 0x20000, 64):
        text = "".join(f"a{chr(c)}1{chr(c)} " for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        if text:
            assert [w for some in encoder.split.words(text) for w in some] == encoder.split._by_library(text)


def test_small_tries_give_the_same_ids(encoder):
    tiny = byte_bpe.Encoder(byte_bpe.model_path(), nodes=5)
    texts = ["the cat sat on the mat", "then there were three", "thethethe", "x" * 2000]
    assert [tiny.encode(t) for t in texts] == [encoder.encode(t) for t in texts]


def test_very_long_texts(encoder, library):
    rng = random.Random(5)
    spaced = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(150_000))
    unspaced = "".join(rng.choices("abcdefgh日本", k=100_000))
    for text in (spaced, unspaced):
        assert _ids(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_models_of_another_kind_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({"type": "WordPiece", "vocab": {}, "merges": []})
    with pytest.raises(ValueError):
        byte_bpe.Splitter({"pre_tokenizer": {"type": "Whitespace"}})


def test_query_equals_the_library_on_the_given_documents(spark, small, library):
    wanted = {}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op11_byte_bpe"](spark, small).collect()}
    assert got == wanted


def test_edges_of_the_operator(docs_of, spark):
    df = docs_of([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x" * 9)]).withColumn("ids", F.lit("mine")).withColumn("extra", F.lit(7))
    rows = sorted(byte_bpe.bpe_encode(df, decoded="decoded").collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.ids is None for r in rows] == [True, False, False, False, False] and rows[1].ids == [] and rows[2].ids == rows[3].ids
    assert [r.decoded for r in rows] == [None, "", "a b", "a b", "x" * 9] and {r.extra for r in rows} == {7}
    for packed in (True, False):
        again = byte_bpe.bpe_decode(byte_bpe.bpe_encode(df.withColumn("decoded", F.lit(0)), packed=packed))
        assert [r.text for r in again.collect()] == [r.decoded for r in again.collect()]
    empty = byte_bpe.op11_byte_bpe(docs_of([]))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    null = byte_bpe.op11_byte_bpe(docs_of([(1, None)])).first()
    assert null.n_tokens == 0 and null.ids_sha256 == null.decoded_sha256 == hashlib.sha256(b"").hexdigest()
