from __future__ import annotations

import functools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from lendlens.llm import _bytes as B
from lendlens.llm import _shared as S
from lendlens.llm import _tokens as T
from lendlens.llm import arrow_tokens, packing

from .texts import awkward, prose


@functools.cache
def library():
    return Tokenizer.from_file(T.default_tokenizer())


def library_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def encoded(texts):
    enc, out = T.encoder(T.default_tokenizer()), []
    for _, _, data, offsets in B.blocks(pa.array(texts, pa.string()), limit=64):
        ids, counts = enc.encode(data, offsets)
        out += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    return out


PIECES = st.sampled_from([" ", "  ", "\n", "\t", "\r\n", "a", "the", "é", "É", "×", "÷", "'s", "'", ".", ",", "!", "1",
                          "23", "²", "½", "_", " ", " ", "　", "\u0085", "日", "😀", "<|endoftext|>", "\x00",
                          "\x1c", "ª", "ß", "-", " ", "​", "à", "Å"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=1, max_size=4))
def test_pieces_give_the_librarys_ids(texts):
    assert encoded(texts) == [library_ids(t) for t in texts]


SPECIAL = st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", "|>", " ", "  ", "a", "the", "\n", ".", "é"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(SPECIAL, max_size=12).map("".join), min_size=1, max_size=5))
def test_special_strings_are_the_librarys_tokens(texts):
    assert encoded(texts) == [library_ids(t) for t in texts]


def test_special_string_beside_words():
    assert encoded(["hello <|endoftext|> world"]) == [[31373, 220, 50256, 995]]


@pytest.mark.parametrize("flags", [{}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}])
def test_other_added_tokens(tmp_path, flags):
    """Tokens that reach beyond their string, and ones that begin alike."""
    tokenizer = Tokenizer.from_file(T.default_tokenizer())
    tokenizer.add_tokens([AddedToken("<x>", **flags), AddedToken("<x><y>", **flags), AddedToken("ab", **flags)])
    path = str(tmp_path / "tokenizer.json")
    tokenizer.save(path)
    texts = ["go <x> on", "<x><y><x>", "cab ab abab", "  <x>  ", "ab", "plain text here", "<x", "><y>", ""]
    enc, got = T.PieceEncoder(path), []
    for _, _, data, offsets in B.blocks(pa.array(texts), limit=20):
        ids, counts = enc.encode(data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_of_a_family_that_polynomials_confuse():
    a = thue_morse(2048)
    b = a.translate(str.maketrans("ab", "ba"))
    assert encoded([a, b, f"x {b} {a}"]) == [library_ids(t) for t in (a, b, f"x {b} {a}")]
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    hashes = B.words(data, np.array([0, len(data)]), B.table(B.SPACE, lower=False))[2]
    assert len(set(hashes.tolist())) == 2


def test_colliding_hashes_cost_no_ids(monkeypatch):
    """With a hash of three values every piece's bytes still decide."""
    real = B.run_hashes
    monkeypatch.setattr(B, "run_hashes", lambda *a: real(*a) % np.uint64(3))
    rng = random.Random(5)
    texts = [prose(rng, 40) for _ in range(12)] + ["", "a <|endoftext|> b", "x" * 300]
    enc, got = T.PieceEncoder(T.default_tokenizer()), []
    for _, _, data, offsets in B.blocks(pa.array(texts), limit=400):
        ids, counts = enc.encode(data, offsets)
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [library_ids(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab \x00é", max_size=30), min_size=1, max_size=4))
def test_run_hashes_tell_words_apart(texts):
    data = np.frombuffer(" ".join(texts).encode(), np.uint8)
    starts, ends, hashes, _ = B.words(data, np.array([0, len(data)]), B.table(B.SPACE, lower=False))
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist())))


def expected(rows):
    return {i: [*library_ids(t), 0] for i, t in rows}


def test_arrow_round_trip(spark, make_docs):
    rows = [r for r in awkward(1) if r[0] is not None]
    uri = S.shared_folder(spark, "test-arrow")
    manifest = arrow_tokens.write_tokens(make_docs(rows), uri, shards=3)
    got = sorted(map(tuple, arrow_tokens.read_tokens(spark, uri, manifest).collect()), key=lambda r: r[1])
    at = 0
    for (doc, start, n, check), (i, text) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or "")), strict=True):
        ids = [*library_ids(text), 0]
        assert (doc, start, n, check) == (i, at, len(ids), crc(ids))
        at += n
    S.remove(uri)


def test_random_access_is_zero_copy(spark, make_docs):
    rng = random.Random(3)
    rows = [(i, prose(rng, 300)) for i in range(60)]
    uri = S.shared_folder(spark, "test-arrow")
    manifest = arrow_tokens.write_tokens(make_docs(rows), uri, seq_len=16, shards=1)
    whole = sum((expected(rows)[i] for i in range(60)), [])
    access = arrow_tokens.RandomAccess(manifest[0][1])
    last = (len(whole) - 1) // 16
    assert last > 2 * arrow_tokens.ROWS
    for i in (0, 1, arrow_tokens.ROWS - 1, arrow_tokens.ROWS, last - 1):
        ids, mask = access[i]
        assert ids.tolist() == whole[16 * i:16 * i + 16] and all(mask.to_pylist())
        assert not ids.flags.owndata and not ids.flags.writeable
    ids, mask = access[last]
    assert ids[mask.to_numpy(zero_copy_only=False)].tolist() == whole[16 * last:]
    S.remove(uri)


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_arrow_small_tables(spark, make_docs, rows):
    uri = S.shared_folder(spark, "test-arrow")
    manifest = arrow_tokens.write_tokens(make_docs(rows), uri, shards=2)
    assert [tuple(r) for r in arrow_tokens.read_tokens(spark, uri, manifest).collect()] == [
        (i, 0, 1, crc([0])) for i, _ in rows]
    S.remove(uri)


def check_packed(pieces, rows, window):
    ids_of = {}
    for i, t in rows:
        ids_of.setdefault(i, []).append([*library_ids(t), 0])
    sequences, covered = {}, {}
    for p in pieces:
        whole = ids_of[p.doc_id][0]
        assert p.doc_tokens == len(whole) and p.ids_crc32 == crc(whole[p.start:p.start + p.length])
        assert np.frombuffer(p.ids, "<u4").tolist() == whole[p.start:p.start + p.length]
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        covered.setdefault(p.doc_id, []).extend(range(p.start, p.start + p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    for i, copies in ids_of.items():
        assert sorted(covered[i]) == sorted(list(range(len(copies[0]))) * len(copies))
    return 1 - sum(len(c) for c in covered.values()) / (window * len(sequences))


def test_packing_places_every_id_once(make_docs):
    rows = awkward(2)
    pieces = packing.pack(make_docs(rows), window=64, open_windows=4).collect()
    assert check_packed(pieces, rows, 64) < 0.01


def test_packing_pads_little(make_docs):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(1, 90))) for i in range(300)]
    pieces = packing.pack(make_docs(rows), window=128, open_windows=8).collect()
    assert check_packed(pieces, rows, 128) < 0.02
    assert packing.pack(make_docs(rows), keep_ids=False).columns == [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_packing_empty(make_docs):
    assert packing.pack(make_docs([])).count() == 0
