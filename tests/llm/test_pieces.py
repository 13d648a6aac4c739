from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfguard.llm import pieces


@pytest.fixture(scope="module")
def lattice():
    return pieces.Lattice.load(pieces.MODEL)


def every_path(lattice, text):
    """(score, ids) of all segmentations, best first."""
    into, out = lattice.edges_to(text), []

    def back(pos, score, lengths, path):
        if not pos:
            ids, ends = [p for _, p in path[::-1]], [e for e, _ in path[::-1]]
            out.append((-score, lengths, lattice._bytes(text, ids, ends).tolist()))
            return
        for start, s, pid in into[pos]:
            back(start, score + s, (*lengths, pos - start), [*path, (pos, pid)])

    back(len(text), 0.0, (), [])
    return [(-s, ids) for s, _, ids in sorted(out, key=lambda x: x[:2])]


@pytest.mark.parametrize("text", ["Hello wor", "a  bß\nxé", "über", "   ", "x", "\n\n", "日本a", "aa aa aa", "the the", "\U0001f600 x", "▁a"])
@pytest.mark.parametrize("n", [1, 2, 5])
def test_n_best_equals_all_paths(lattice, text, n):
    ids, best = pieces.Encoder(lattice, n).encode([text])[0]
    wanted = every_path(lattice, "▁" + text.replace(" ", "▁"))[:n]
    got = [(s, pieces.apply_edits(ids, e).tolist()) for s, e in best]
    assert [s for s, _ in got] == pytest.approx([s for s, _ in wanted])
    assert len({tuple(i) for _, i in got}) == len(got)
    assert got[0][1] == ids.tolist() == wanted[0][1]
    decoder = pieces.Decoder(pieces.MODEL)
    assert all(decoder.decode(i) == text.replace("▁", " ") for _, i in got)


def test_decoder_is_the_library_s(lattice):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    decoder = pieces.Decoder(pieces.MODEL)
    for text in ("Hello  world\n foo", " x ", "Straße ½", "日本 語\t"):
        ids = sp.encode(text)
        assert decoder.decode(ids) == sp.decode(ids) == text


def test_small_cache_gives_the_same(lattice):
    texts = ["one two", "two three\nfour", None, "", "one two " * 50]
    big, tiny = pieces.Encoder(lattice), pieces.Encoder(lattice, cache=1)
    for t in texts:
        a, b = big.encode([t])[0], tiny.encode([t])[0]
        assert (a is None) == (b is None)
        if a:
            assert a[0].tolist() == b[0].tolist() and [s for s, _ in a[1]] == [s for s, _ in b[1]]


def test_a_tiny_model_with_ties():
    m = pieces.Lattice(["▁", "a", "b", "ab", "ba", "▁a"], [-1.0, -1.0, -1.0, -2.0, -2.0, -2.0], [10, 11, 12, 13, 14, 15], list(range(256, 512)))
    ids, best = pieces.Encoder(m, 20).encode(["abab z"])[0]
    wanted = every_path(m, "▁abab▁z")
    assert [s for s, _ in best] == pytest.approx([s for s, _ in wanted][:20]) and len(best) == min(20, len(wanted))
    assert ids.tolist() == wanted[0][1]


def test_frames_with_edges(docs_of):
    long = "Wort word 12 ä " * 9000
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (4, long), (None, "x"), (5, " lead\nand trail ")]
    df = docs_of(rows).withColumn("ids", F.lit("mine"))
    out = pieces.sentencepiece_decode(pieces.sentencepiece_encode(df))
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert len(got) == 6 and out.count() == 7
    assert got[(2, None)].ids is None and got[(2, None)].n_best is None and got[(2, None)].decoded is None
    assert got[(3, "")].ids == [] and len(got[(3, "")].n_best) == 1
    assert all(r.decoded == t for (_, t), r in got.items())
    assert sorted(map(str, pieces.sentencepiece_encode(df, decoded="decoded").collect())) == sorted(map(str, out.collect()))
    flags = {r.doc_id: r.round_trip for r in pieces.op1_sentencepiece(docs_of(rows)).collect()}
    assert flags == {1: True, 2: None, 3: True, 4: True, None: True, 5: True}
    assert pieces.op1_sentencepiece(docs_of([])).count() == 0


def test_long_chunks_share_blocks_with_short_ones(lattice):
    chunks = ["▁a", "▁" + "x" * 5000, "▁the", "▁" + "the" * 300]
    ids, lens, score, loss = lattice.viterbi(chunks)
    cut = np.concatenate([[0], np.cumsum(lens)])
    for k, c in enumerate(chunks):
        one = lattice.viterbi([c])
        assert one[0].tolist() == ids[cut[k] : cut[k + 1]].tolist() and one[2][0] == score[k] and one[3][0] == loss[k]


def test_ties_of_whole_paths_keep_their_order():
    m = pieces.Lattice(["▁", "a", "b", "ab", "ba", "▁a"], [-1.0, -1.0, -1.0, -2.0, -2.0, -2.0], [10, 11, 12, 13, 14, 15], list(range(256, 512)))
    chunk = "▁abab"
    got = [(s, i.tolist()) for s, i in m.n_best(chunk, 100)]
    assert got == every_path(m, chunk) and len(got) > len({s for s, _ in got})


def test_unspaced_texts_of_any_length(docs_of):
    rng = np.random.default_rng(3)
    rows = [(1, "".join(rng.choice([*"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"], 100_000)))]
    rows += [(2, "".join(rng.choice([*"日本語中文字的是", "the", "on"], 50_000)))]
    got = {r.doc_id: r for r in pieces.sentencepiece_decode(pieces.sentencepiece_encode(docs_of(rows))).collect()}
    assert all(got[i].decoded == text and len(got[i].n_best) == pieces.N_BEST for i, text in rows)


def test_the_search_of_a_long_chunk_needs_memory_linear_in_its_length(lattice):
    chunk = "".join(np.random.default_rng(4).choice([*"abcdefghijklmnop"], 4000))
    tracemalloc.start()
    lattice.n_best(chunk, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000 * len(chunk)


def test_a_search_holds_few_cells_at_once():
    rng = random.Random(5)
    chunks = [pieces.MARK + "".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 12))) for _ in range(30_000)]
    lattice = pieces.Lattice.load(pieces.MODEL)
    tracemalloc.start()
    ids, lens, _, _ = lattice.viterbi(chunks)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(lens) == len(chunks) and lens.sum() == len(ids)
    assert most < 12e6, most
