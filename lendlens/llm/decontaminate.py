"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items go into one suffix automaton.
Training words are streamed through it; at every word the walk knows the
longest match with any item that ends there. Where that length reaches
``window`` words (or an item shorter than a window is matched whole) the
matching words are hit. The automaton's first levels are evaluated for a
whole block of text at once: only where a run of words occurs in some item
is the automaton walked word by word, elsewhere the match is known to be
shorter than any window.

The automaton is built from at most ``ITEM_WORDS`` words; a larger benchmark
is worked off in blocks of items, each a pass over the documents, so what a
task holds is bounded whatever the benchmark's size.

Defined cases: null or empty texts have no words, no hits and stay as they
are; items without words never occur; equal items occur together; rows
that repeat an id get a row each; hits of an item without id count as hits
but name no item; an empty benchmark hits nothing; item ids that aren't whole
numbers are taken as texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from . import _bytes as B
from . import _shared as S

WINDOW = 10
MAX_COVERAGE = 0.5  # a document of which more is hit is dropped whole
ITEM_WORDS = 100_000  # about 150 MB as Python objects in each worker
_LEVEL = 4  # words matched by table before the automaton is walked

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _normal(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())  # bytes.lower() changes A-Z only


class SuffixAutomaton:
    """Generalised suffix automaton over the words of many items."""

    def __init__(self, items: Sequence[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        ends = []
        for _, words in items:
            last, path = 0, []
            for w in words:
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
                path.append(last)
            ends.append(path)
        self.items: list[set] = [set() for _ in self.length]
        self.whole: dict[int, dict[int, set]] = {}  # state -> {length: ids} of items below a window
        for k, ((item, words), path) in enumerate(zip(items, ends)):
            for state in path:  # an item occurs in every suffix state of its prefixes
                while state > 0 and (k, item) not in self.items[state]:
                    self.items[state].add((k, item))
                    state = self.link[state]
            if words and len(words) < window:
                state = self._state_of(words)
                self.whole.setdefault(state, {}).setdefault(len(words), set()).add(item)
        self.items = [{item for _, item in s} for s in self.items]
        sizes = [len(words) for _, words in items if words]
        self.shortest = min([window, *sizes]) if sizes else 0
        self.level = min(_LEVEL, self.shortest)
        codes = B.table(B.NON_ALNUM, lower=True)
        grams = []
        for _, words in items:
            raw = b" ".join(words)
            _, _, hashes, _ = B.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), codes)
            if self.level:
                grams.append(B.grams(hashes, self.level))
        self.grams = np.unique(np.concatenate(grams)) if grams else np.empty(0, np.uint64)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def _state(self, length: int, link: int, next_: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(next_)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:  # the prefix occurs in an earlier item
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        state = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return state

    def _state_of(self, words: list[bytes]) -> int:
        state = 0
        for w in words:
            state = self.next[state][self.vocabulary[w]]
        return state

    def known_runs(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, first word, end word) of the runs in which every
        ``level`` consecutive words occur in some item."""
        if not self.level:
            return []
        grams = B.grams(hashes, self.level)
        known = np.flatnonzero(self.sieve[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        spot = np.minimum(np.searchsorted(self.grams, grams[known]), len(self.grams) - 1)
        known = known[self.grams[spot] == grams[known]]
        text = np.searchsorted(first, known, "right") - 1
        inside = known + self.level <= first[text + 1]
        known, text = known[inside], text[inside]
        if not len(known):
            return []
        fresh = np.append(True, (known[1:] != known[:-1] + 1) | (text[1:] != text[:-1]))
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(known)) - 1
        long = known[end] - known[begin] + self.level >= self.shortest
        return list(zip(text[begin[long]].tolist(), known[begin[long]].tolist(),
                        (known[end[long]] + self.level).tolist()))

    def walk(self, words: list[bytes]) -> Iterator[tuple[int, int, set]]:
        """Stream words; yields (first, end, items) of every window that occurs."""
        state = matched = 0
        for i, w in enumerate(words):
            c = self.vocabulary.get(w)
            while state > 0 and c not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if c in self.next[state]:
                state, matched = self.next[state][c], matched + 1
            else:
                matched = 0
            at, reach = state, matched
            while at > 0 and reach >= self.shortest:
                low = self.length[self.link[at]]
                if low < self.window <= reach:
                    yield i + 1 - self.window, i + 1, self.items[at]
                for length, ids in self.whole.get(at, {}).items():
                    if length <= reach:
                        yield i + 1 - length, i + 1, ids
                at, reach = self.link[at], low


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


_SPANS = t.ArrayType(t.StructType([
    t.StructField("first_word", t.LongType()), t.StructField("end_word", t.LongType()),
    t.StructField("start_byte", t.LongType()), t.StructField("end_byte", t.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()),
                                   ("start_byte", pa.int64()), ("end_byte", pa.int64())]))


def _hits(item_type: t.DataType) -> t.StructType:
    return t.StructType([t.StructField("n_words", t.LongType()), t.StructField("spans", _SPANS),
                         t.StructField("items", t.ArrayType(item_type))])


def _item_type(items: DataFrame, id_col: str) -> t.DataType:
    """Whole numbers stay numbers, any other id is its text."""
    return t.LongType() if isinstance(items.schema[id_col].dataType, t.IntegralType) else t.StringType()


def _scan(batches, automaton: SuffixAutomaton, text_at: int, item_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    codes = B.table(B.NON_ALNUM, lower=True)
    kind = pa.struct([("n_words", pa.int64()), ("spans", _ARROW_SPANS), ("items", pa.list_(item_type))])
    for batch in batches:
        for a, b, data, offsets in B.blocks(batch.column(text_at)):
            starts, ends, hashes, first = B.words(data, offsets, codes)
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            for text, begin, end in automaton.known_runs(hashes, first):
                raw = [data[s:e].tobytes().lower() for s, e in
                       zip(starts[begin:end].tolist(), ends[begin:end].tolist())]
                for s, e, ids in automaton.walk(raw):
                    spans.setdefault(text, []).append((begin + s, begin + e))
                    items.setdefault(text, set()).update(ids)
            rows = [None] * (b - a)
            counts = np.diff(first).tolist()
            base, origin = first.tolist(), offsets.tolist()
            for i in range(b - a):
                hit = [{"first_word": s - base[i], "end_word": e - base[i],
                        "start_byte": int(starts[s]) - origin[i], "end_byte": int(ends[e - 1]) - origin[i]}
                       for s, e in _merge(spans[i])] if i in spans else []
                named = sorted(x for x in items.get(i, ()) if x is not None)
                rows[i] = {"n_words": counts[i], "spans": hit, "items": named}
            part = batch.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(rows, kind)], names=[*part.schema.names, "hits"])


def _item_blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list]:
    """Items in blocks of at most ``most`` words, streamed through the driver."""
    block, size = [], 0
    for item, text in items.select(F.col(id_col).cast(_item_type(items, id_col)), text_col).toLocalIterator():
        words = _normal((text or "").encode("utf-8"))
        if block and size + len(words) > most:
            yield block
            block, size = [], 0
        block.append((item, words))
        size += len(words)
    yield block


def find_hits(df: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
              item_text_col: str = "text", window: int = WINDOW, item_words: int = ITEM_WORDS) -> DataFrame:
    """``df`` with a column ``hits``: n_words, hit spans (word and byte
    positions, merged) and the ids of the items that occur. A column of that
    name in ``df`` is replaced."""
    return _pass(df, items, text_col, item_id_col, item_text_col, window, item_words, lambda rows: rows)


def _pass(df, items, text_col, item_id_col, item_text_col, window, item_words, finish) -> DataFrame:
    """Scan with every block of items, then ``finish`` the Arrow batches (in
    the same Python pass where one block holds all items)."""
    out = df.drop("hits")
    text_at = out.columns.index(text_col)
    spark = df.sparkSession
    blocks = _item_blocks(items, item_id_col, item_text_col, item_words)
    block, n, item_type = next(blocks), 0, _item_type(items, item_id_col)
    arrow_type = pa.int64() if isinstance(item_type, t.LongType) else pa.string()
    while block is not None:
        following = next(blocks, None)
        automaton = spark.sparkContext.broadcast(SuffixAutomaton(block, window))
        alone = n == 0 and following is None
        source = out if n == 0 else S.materialised(out, "decontaminate").withColumnRenamed("hits", "earlier")
        schema = t.StructType([*source.schema.fields, t.StructField("hits", _hits(item_type))])

        def scan(rows, auto=automaton, last=alone):
            found = _scan(rows, auto.value, text_at, arrow_type)
            return finish(found) if last else found

        out = source.mapInArrow(scan, schema)
        if n:
            out = out.withColumn("hits", F.struct(
                F.col("hits.n_words").alias("n_words"),
                _merged(F.concat("earlier.spans", "hits.spans")).alias("spans"),
                F.array_sort(F.array_union("earlier.items", "hits.items")).alias("items"))).drop("earlier")
        block, n = following, n + 1
    return out if alone else out.mapInArrow(finish, out.schema)


def _merged(spans):
    """Merge overlapping spans of several blocks of items."""
    def step(acc, x):
        last = F.element_at(acc, -1)
        joined = F.struct(last["first_word"].alias("first_word"),
                          F.greatest(last["end_word"], x["end_word"]).alias("end_word"),
                          last["start_byte"].alias("start_byte"),
                          F.greatest(last["end_byte"], x["end_byte"]).alias("end_byte"))
        apart = (F.size(acc) == 0) | (x["first_word"] > F.try_element_at(acc, F.lit(-1))["end_word"])
        return F.when(apart, F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined)))
    return F.aggregate(F.array_sort(spans), F.filter(spans, lambda x: F.lit(False)), step)


def n_hit():
    """Hit words of a row of ``find_hits``."""
    return F.aggregate("hits.spans", F.lit(0).cast("long"),
                       lambda acc, x: acc + x["end_word"] - x["first_word"])


def _cut(batches, text_at: int, max_coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = batch.column(batch.schema.get_field_index("hits"))
        spans, n_words = hits.field("spans"), hits.field("n_words").to_pylist()
        columns, texts, keep = list(batch.columns), None, np.ones(batch.num_rows, bool)
        for i in np.flatnonzero(pc.list_value_length(spans).to_numpy(zero_copy_only=False)).tolist():
            texts = texts or columns[text_at].to_pylist()
            own = spans[i].as_py()
            keep[i] = sum(x["end_word"] - x["first_word"] for x in own) <= max_coverage * n_words[i]
            raw, at, kept = texts[i].encode("utf-8"), 0, []
            for span in own:
                kept.append(raw[at:span["start_byte"]])
                at = span["end_byte"]
            texts[i] = b"".join([*kept, raw[at:]]).decode("utf-8")
        if texts:
            columns[text_at] = pa.array(texts, columns[text_at].type)
        out = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
        yield out if keep.all() else out.filter(pa.array(keep))


def decontaminate(df: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, item_words: int = ITEM_WORDS,
                  max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``df`` with hit spans cut out of the text; documents of whose words
    more than ``max_coverage`` are hit are dropped. Adds ``hits``."""
    text_at = df.drop("hits").columns.index(text_col)
    return _pass(df, items, text_col, item_id_col, item_text_col, window, item_words,
                 lambda rows: _cut(rows, text_at, max_coverage))
