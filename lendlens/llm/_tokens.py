"""Byte-level BPE ids of whole texts with the tokenizers library.

Encoding is the costliest step, and most words repeat. A text is cut where
the byte-level pre-tokeniser always cuts (before a run of white space, and
between a letter and following punctuation) and around the strings of added
tokens, each different piece is encoded once by the library, and the ids of a
text are put together from those of its pieces. Pieces seen before are kept in a
bounded table per Python worker: it is searched by hash, and every piece's bytes
are compared with the entry found, so a collision costs time, not a wrong id.

Strings of added tokens in a text are what the library makes of them (their own
ids). Added tokens that take in their surroundings (stripping, whole words only,
normalised) can't be cut around; texts that hold such a string are encoded whole.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from . import _bytes as B

CACHE_PIECES, CACHE_BYTES = 1_500_000, 1 << 26  # kept per worker before the table starts anew


@functools.cache
def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _safe_end(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each position surely isn't white space."""
    last = data[at - 1]
    before = data[np.maximum(at - 2, 0)]
    third = data[np.maximum(at - 3, 0)]
    two = (before >= 0xC3) & (before <= 0xDF)
    more = (before >= 0x80) & (before <= 0xBF) & ((third >= 0xE4) | ((third >= 0x80) & (third <= 0xBF)))
    return ((last >= 0x21) & (last <= 0x7E)) | ((last >= 0x80) & (two | more))


class PieceEncoder:
    """Encodes blocks of texts; one per Python worker and tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        plain = [t.content for t in added if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        # the library takes the leftmost, then the longest one
        self.added = self._any_of(t.content for t in added)
        self.cuttable = len(plain) == len(added)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        # byte-level vocabularies write every byte as one character
        self.id_bytes = np.zeros(size, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.id_bytes[i] = len(token)
        self._clear()

    @staticmethod
    def _any_of(contents) -> re.Pattern | None:
        names = sorted({c.encode("utf-8") for c in contents if c}, key=lambda c: (-len(c), c))
        return re.compile(b"|".join(map(re.escape, names))) if names else None

    def _clear(self):
        self.raw = np.empty(0, np.uint8)
        self.raw_at = np.empty(0, np.int64)
        self.raw_size = np.empty(0, np.int64)
        self.keys = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.length = np.empty(0, np.int32)
        self.ids = np.empty(0, self.dtype)

    def _encode(self, texts: list[bytes], joinable: np.ndarray) -> list[np.ndarray]:
        """Ids of each different piece. Pieces that start with white space and
        end in another character are encoded as one long text, which is cut
        between them anyway; the byte lengths of the ids tell them apart."""
        out: list = [None] * len(texts)
        joined = np.flatnonzero(joinable)
        if len(joined):
            whole = b"".join([texts[i] for i in joined]).decode("utf-8")
            got = self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids
            got = np.array(got, np.int64)
            byte_end = np.cumsum(self.id_bytes[got])
            ends = np.cumsum([len(texts[i]) for i in joined])
            cut = np.searchsorted(byte_end, ends, "left") + 1
            if byte_end[-1] != ends[-1] or (byte_end[cut - 1] != ends).any():
                raise ValueError("the tokenizer isn't byte-level: ids don't add up to the text")
            begin = 0
            got = got.astype(self.dtype)
            for i, end in zip(joined.tolist(), cut.tolist()):
                out[i] = got[begin:end]
                begin = end
        single = np.flatnonzero(~joinable).tolist()
        if single:
            for i, e in zip(single, self.tokenizer.encode_batch_fast(
                    [texts[i].decode("utf-8") for i in single], add_special_tokens=False)):
                out[i] = np.array(e.ids, self.dtype)
        return out

    def _added_spans(self, data: np.ndarray, offsets: np.ndarray):
        """Spans that must not be cut: strings of added tokens, or whole texts."""
        if self.added is None:
            return
        texts = set()  # that a string touches, looked at one by one
        for m in self.added.finditer(data.tobytes()):
            texts.update(range(int(np.searchsorted(offsets, m.start(), "right")) - 1,
                               int(np.searchsorted(offsets, m.end(), "left"))))
        for t in sorted(texts):
            yield from self._spans_of(data, int(offsets[t]), int(offsets[t + 1]))

    def _spans_of(self, data: np.ndarray, start: int, end: int):
        for m in self.added.finditer(data[start:end].tobytes()):
            yield (start + m.start(), start + m.end()) if self.cuttable else (start, end)

    def _collided(self, data, starts, ends, entry) -> np.ndarray:
        """Pieces whose bytes aren't those of the table's entry."""
        sizes = ends - starts
        wrong = self.raw_size[entry] != sizes
        source = np.repeat(self.raw_at[entry] - starts, sizes) + np.arange(len(data))
        differs = self.raw[np.minimum(source, len(self.raw) - 1)] != data
        if differs.any():
            wrong[np.searchsorted(starts, np.flatnonzero(differs), "right") - 1] = True
        return np.flatnonzero(wrong)

    def _with_collisions(self, data, offsets, starts, ends, entry, wrong) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, the pieces ``wrong`` encoded one by one."""
        raw = data.tobytes()
        own = dict(zip(wrong.tolist(), self._encode(
            [raw[a:b] for a, b in zip(starts[wrong].tolist(), ends[wrong].tolist())], np.zeros(len(wrong), bool))))
        parts = [own[i] if i in own else self.ids[self.at[k]:self.at[k] + self.length[k]]
                 for i, k in enumerate(entry.tolist())]
        of_piece = np.append(0, np.cumsum([len(p) for p in parts]))
        return np.concatenate(parts), np.diff(of_piece[np.searchsorted(starts, offsets)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        n = len(data)
        if not n:
            return np.empty(0, self.dtype), np.zeros(len(offsets) - 1, np.int64)
        white = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
        punct = ((data >= 0x21) & (data <= 0x7E) & ~letter
                 & ~((data >= 0x30) & (data <= 0x39)) & (data != 0x27))
        cut = np.zeros(n, bool)
        spots = np.flatnonzero(white[1:] & ~white[:-1]) + 1
        cut[spots[_safe_end(data, spots)]] = True
        cut[1:] |= punct[1:] & letter[:-1]
        accented = np.flatnonzero(punct[2:] & (data[:-2] == 0xC3)) + 2
        cut[accented[(data[accented - 1] != 0x97) & (data[accented - 1] != 0xB7)]] = True
        borders = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[borders] = True
        joinable = np.ones(n, bool)
        for a, b in self._added_spans(data, offsets):
            cut[a:b] = False
            cut[a] = True
            cut[b:b + 1] = True
            joinable[a:b + 1] = False  # neither a piece of its own nor what follows it
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], n)
        keys = B.run_hashes(data, starts, ends)
        different, where, back = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE_PIECES or len(self.raw) > CACHE_BYTES:
            self._clear()
        spot = np.searchsorted(self.keys, different)
        known = np.zeros(len(different), bool)
        inside = spot < len(self.keys)
        known[inside] = self.keys[spot[inside]] == different[inside]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            s, e = starts[where[new]], ends[where[new]]
            texts = [raw[a:b] for a, b in zip(s.tolist(), e.tolist())]
            got = self._encode(texts, white[s] & joinable[s] & _safe_end(data, e))
            lengths = np.array([len(x) for x in got], np.int32)
            at = len(self.ids) + np.cumsum(lengths, dtype=np.int64) - lengths
            self.ids = np.concatenate([self.ids, *got])
            raw_at = len(self.raw) + np.cumsum(e - s) - (e - s)
            self.raw = np.concatenate([self.raw, np.frombuffer(b"".join(texts), np.uint8)])
            put = np.searchsorted(self.keys, different[new])
            self.keys = np.insert(self.keys, put, different[new])
            self.at = np.insert(self.at, put, at)
            self.length = np.insert(self.length, put, lengths)
            self.raw_at = np.insert(self.raw_at, put, raw_at)
            self.raw_size = np.insert(self.raw_size, put, e - s)
            spot = np.searchsorted(self.keys, different)
        wrong = self._collided(data, starts, ends, spot[back])
        if len(wrong):
            return self._with_collisions(data, offsets, starts, ends, spot[back], wrong)
        lengths = self.length[spot][back]
        ends_out = np.cumsum(lengths, dtype=np.int64)
        total = int(ends_out[-1])
        source = np.repeat(self.at[spot][back] - (ends_out - lengths), lengths) + np.arange(total)
        ids = self.ids[source]
        of_piece = np.append(0, ends_out)
        return ids, np.diff(of_piece[np.searchsorted(starts, offsets)])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)
