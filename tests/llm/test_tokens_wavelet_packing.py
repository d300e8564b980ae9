"""Token ids, wavelet shards and curve packing against the plain tokenizer."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from paneltide.llm import curve_packing, store, tokens, wavelet
from tests.llm.conftest import edge_rows

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def plain(name):
    t = Tokenizer.from_file(tokens.tokenizer_path(name))
    return lambda text: t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_memo_gives_the_tokenizers_ids(name):
    r = random.Random(1)
    pool = "aAbB 's\n\t.,!?éÉ́ΣİΑ1٣²_   \x1c漢'<|>lvt"
    texts = ["", " ", "a  b", " lead", "trail ", "don't stop 'tis !'t  a's", "<|endoftext|> a <|startoftext|>b", "x" * 5000]
    texts += ["".join(r.choice(pool) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    enc, ids = tokens.Encoder(tokens.tokenizer_path(name), limit=500), plain(name)
    for _ in range(2):  # the second time from the memo
        for text, got in zip(texts, enc.encode(texts)):
            assert np.frombuffer(got, "<u4").tolist() == ids(text), repr(text)


def test_memo_stays_small_among_ever_new_words():
    """Words that never recur fill a fifth of a million places, not more; what
    comes later is encoded right."""
    enc, ids = tokens.Encoder(tokens.tokenizer_path(FILES[1])), plain(FILES[1])
    name = lambda k: "".join(chr(97 + k // 26**p % 26) for p in range(5))
    for first in range(0, 300_000, 20_000):
        text = " ".join(name(7919 * k % 26**5) for k in range(first, first + 20_000))
        got = enc.encode([text])[0]
    assert len(enc.memo) <= 220_000 and len(enc.chunks) <= 220_000
    assert np.frombuffer(got, "<u4").tolist() == ids(text)


def test_wavelet_matrix_against_numpy():
    r = np.random.default_rng(0)
    for n in (0, 1, 8, 511, 512, 513, 4000):
        a = r.integers(0, 300, n).astype(np.uint16)
        m = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(a).to_bytes())
        assert (m.decode() == a).all()
        assert (m.access(np.arange(n)) == a).all()
        for c in (0, 7, 299, 1 << 20):
            where = np.flatnonzero(a == c)
            assert m.occurrences(c).tolist() == where.tolist()
            assert m.count(c, n // 3, n) == (a[n // 3:] == c).sum()
            assert m.rank(c, n // 2) == (a[: n // 2] == c).sum()
            assert m.select(c, 0) == (where[0] if len(where) else -1)


@pytest.mark.parametrize("stretch", (1, 64, 700))
def test_wavelet_matrix_is_parted_stretch_by_stretch(monkeypatch, stretch):
    monkeypatch.setattr(wavelet, "_STRETCH", stretch)
    for n, top in ((1, 2), (640, 300), (1001, 1 << 17)):
        a = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
        m, kept = wavelet.WaveletMatrix.build(a), a.copy()
        assert (m.decode() == a).all() and (m.access(np.arange(n)) == a).all() and (a == kept).all()


def test_shards_round_trip(spark, edge):
    ids = plain(FILES[0])
    path = store.scratch(spark, "t")
    wavelet.write_shards(edge, path, tokens.tokenizer_path(FILES[0]), end_id=1, shard_tokens=300)
    rows = wavelet.digests(spark, path).collect()
    key = lambda d: -(1 << 70) if d is None else d
    want = {}
    for d, text, *_ in edge_rows():
        seq = np.array(ids(text or "") + [1], "<u4")
        want.setdefault(key(d), []).append((len(seq), zlib.crc32(seq.tobytes())))
    got = {}
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        got.setdefault(key(r["doc_id"]), []).append((r["n_tokens"], r["ids_crc32"]))
    assert list(got) == sorted(got)  # ascending ids, nulls first
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    whole = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in wavelet.documents(spark, path).filter("doc_id = 3").collect()])
    assert whole.tolist() == ids(next(t for d, t, *_ in edge_rows() if d == 3)) + [1]
    found = wavelet.lookup(spark, path, 1).collect()
    assert sum(r["n"] for r in found) >= len(rows)
    ends = sorted(r["start"] + r["n_tokens"] - 1 for r in rows)
    assert set(ends) <= {p for r in found for p in r["positions"]}


def test_no_documents(spark, empty):
    path = store.scratch(spark, "t")
    wavelet.write_shards(empty, path, tokens.tokenizer_path(FILES[0]), end_id=1)
    assert wavelet.digests(spark, path).count() == 0
    assert curve_packing.pack(empty, tokens.tokenizer_path(FILES[1]), end_id=0).count() == 0


def test_hilbert_curve_visits_neighbours():
    axis = np.arange(8)
    points = np.array(np.meshgrid(axis, axis, axis)).reshape(3, -1).T
    key = curve_packing.hilbert_key(points, 3)
    assert sorted(key) == list(range(512))
    assert (abs(np.diff(points[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_packing(spark, edge):
    ids = plain(FILES[1])
    pieces = curve_packing.pack(edge, tokens.tokenizer_path(FILES[1]), end_id=0, length=64)
    rows = pieces.collect()
    total = sum(len(ids(t or "")) + 1 for _, t, *_ in edge_rows())
    used = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used.get(r["sequence_id"], 0)
        used[r["sequence_id"]] = r["offset"] + r["length"]
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    assert sum(used.values()) == total and max(used.values()) == 64
    assert all(n & (n - 1) == 0 for n in used.values())  # no padding at all
    text = next(t for d, t, *_ in edge_rows() if d == 3)
    mine = sorted((r["start"], r["ids"]) for r in rows if r["doc_id"] == 3)
    assert np.frombuffer(b"".join(i for _, i in mine), "<u4").tolist() == ids(text) + [0]
    again = {(r["doc_id"], r["start"], r["ids_crc32"], r["sequence_id"]) for r in curve_packing.pack(edge, tokens.tokenizer_path(FILES[1]), end_id=0, length=64).collect()}
    assert again == {(r["doc_id"], r["start"], r["ids_crc32"], r["sequence_id"]) for r in rows}
    seqs = curve_packing.sequences(pieces).collect()
    assert {s["sequence_id"]: len(s["ids"]) // 4 for s in seqs} == used


def test_similar_documents_are_neighbours():
    keys = curve_packing.curve_keys([b"one and the same text of words " * 20, b"one and the same text of words " * 20 + b"x", b"0123456789 " * 80])
    assert abs(int(keys[0]) - int(keys[1])) < abs(int(keys[0]) - int(keys[2]))


@pytest.mark.parametrize("name", FILES)
def test_recurring_pieces_are_looked_up_once(name):
    """80,000 pieces, 40 of them distinct, in two texts of one call."""
    asked = []

    class Memo(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    enc, ids = tokens.Encoder(tokens.tokenizer_path(name)), plain(name)
    enc.memo = Memo()
    r = random.Random(3)
    words = ["".join(r.choice("abcdeé") for _ in range(6)) + end for end in ("", ",", ".\nNew", "7") for _ in range(10)]
    texts = [" ".join(r.choice(words) for _ in range(40_000)) for _ in range(2)] + ["", "one", "tab\tinside it", "it has a\ttab", "\n\nX y"]
    got = enc.encode(texts)
    assert len(asked) <= 100
    for text, b in zip(texts, got):
        assert np.frombuffer(b, "<u4").tolist() == ids(text)


def test_hashed_vector_counts_four_grams():
    r = random.Random(4)
    for n in (0, 1, 3, 4, 5, 9, 2000):
        b = bytes(r.choice(b"abcd \n\xc3\xa9\xff") for _ in range(n))
        padded, counts = b + b"\0" * (4 - n), [0] * curve_packing.BUCKETS
        for i in range(len(padded) - 3):
            h = 0
            for c in padded[i: i + 4]:
                h = h * 0x9E3779B1 + c
            counts[h * 0x85EBCA6B % (1 << 32) >> 24] += 1
        want = np.log1p(counts)
        assert np.allclose(curve_packing.hashed_vector(b) * np.sqrt(want @ want), want)
