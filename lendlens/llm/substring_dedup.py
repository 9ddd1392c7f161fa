"""Repeated passages: exact windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document; its minimiser is
the first of its ``MINIMISER``-word sequences in an order by hash that has the
common ones last. Common are those that would be the minimiser of more than an
average bucket in a bounded sample of ``SAMPLE`` documents: a phrase that many
texts hold between words of their own is a minimiser only of windows that hold
nothing rarer. The order depends on a window's words alone, so equal windows
meet whatever the sample says; it only spreads them. Consecutive windows
that share a minimiser (a super-k-mer) travel as one packed string to the
bucket of that minimiser, so equal windows always meet, at about three times
the text instead of 35 times. In its bucket every window is counted exactly:
windows are sorted by hash and equal neighbours compared word by word.

Hot passages: a task first counts the windows of its own block of text.
Windows that repeat there are known to be repeated, and only their first
occurrence is sent on, so a passage that a third of all documents hold
arrives once per block and not once per document. A bucket that still
exceeds ``BUCKET_BYTES`` isn't held: its windows go on, one row each, to a
count by 128-bit window fingerprint (two independent hashes of the words) that
Spark aggregates map-side.

Packed strings are sent in one compressed record per block and bucket.

Defined cases: null, empty and blank texts have no words; texts with fewer
words than a window lose nothing; rows that repeat an id and text lose every
window; a null id is an id of its own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _shared as S

WINDOW = 35
MINIMISER = 5
BUCKETS_PER_PARTITION = 8
BUCKET_BYTES = 64 << 20
SAMPLE = 16_384    # documents looked at for common minimisers
SEEN = 16          # times a minimiser must be seen there to count as common
_OTHER_HASH = 0x632BE59BD9B4E019

_RUNS = np.dtype([("doc_id", "<i8"), ("key", "<i8"), ("start", "<i8"), ("windows", "<i4"),
                  ("bytes", "<i4"), ("null_id", "?")])
_PACKED = "bucket int, runs binary, words binary"
_FOUND = "doc_id long, key long, start long, end long, win1 long, win2 long"


def _normalised(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words one after another, each followed by one space: (bytes, word starts and end)."""
    size = ends - starts
    at = np.append(0, np.cumsum(size + 1))
    out = np.full(at[-1], 0x20, np.uint8)
    shift = np.cumsum(size) - size
    inside = np.arange(size.sum())
    out[inside + np.repeat(at[:-1] - shift, size)] = data[inside + np.repeat(starts - shift, size)]
    return out, at


def _word_ids(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for every word, equal exactly for equal words."""
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(text)])
    return array.dictionary_encode().indices.to_numpy()


def _first_equal(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """For each window of ``n`` words at word ``at``: the index (into ``at``)
    of the first equal window. Equal hashes are confirmed word by word."""
    hashes = B.grams(B.mix(ids.astype(np.uint64)), n)[at]
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    pair = np.flatnonzero(sorted_[1:] == sorted_[:-1])
    a, b = at[order[pair]], at[order[pair + 1]]
    equal = np.ones(len(pair), bool)
    for k in range(n):
        equal &= ids[a + k] == ids[b + k]
    same = np.zeros(len(order), bool)
    same[pair + 1] = True
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    first = np.empty(len(order), np.int64)
    first[order] = order[lead]
    if not equal.all():  # different windows under one hash: tell them apart by their words
        for h in np.unique(sorted_[pair[~equal]]):
            seen: dict[bytes, int] = {}
            for i in order[np.searchsorted(sorted_, h, "left"):np.searchsorted(sorted_, h, "right")]:
                first[i] = seen.setdefault(ids[at[i]:at[i] + n].tobytes(), i)
    return first


def _runs(start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of runs of consecutive starts with equal ``same`` values."""
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cut = start[1:] != start[:-1] + 1
    for s in same:
        cut |= s[1:] != s[:-1]
    begin = np.append(0, np.flatnonzero(cut) + 1)
    return begin, np.append(begin[1:], len(start))


def _minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum over ``width`` values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _minimisers(hashes: np.ndarray, window: int, minimiser: int, common: np.ndarray) -> np.ndarray:
    """Minimiser of the window at each word: its sequences by hash, those whose
    hash is in the sorted ``common`` after all others."""
    order = B.mix(B.grams(hashes, minimiser)) >> np.uint64(1)
    if len(common):
        spot = np.minimum(np.searchsorted(common, order), len(common) - 1)
        order |= (common[spot] == order).astype(np.uint64) << np.uint64(63)
    return _minimum(order, window - minimiser + 1)


def _common(keyed: DataFrame, window: int, minimiser: int, buckets: int, sample: int) -> np.ndarray:
    """Sorted minimisers that more super-k-mers of the sample share than an
    average bucket holds (at most as many as there are buckets)."""
    n = keyed.count()
    part = min(1 << 32, sample * (1 << 32) // max(n, 1))
    chosen = keyed.where(F.pmod(F.xxhash64("doc_id", "key"), F.lit(1 << 32)) < part).select("text")
    nothing = np.empty(0, np.uint64)

    def count(batches):
        codes = B.table(B.SPACE, lower=False)
        for batch in batches:
            for a, b, data, offsets in B.blocks(batch.column(0)):
                _, _, hashes, first = B.words(data, offsets, codes)
                at, text = B.within(first, window)
                if not len(at):
                    continue
                least = _minimisers(hashes, window, minimiser, nothing)[at]
                begin, _ = _runs(at, text, least)
                values, many = np.unique(least[begin], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(many)], names=["m", "many"])

    counts = chosen.mapInArrow(count, "m long, many long").groupBy("m").agg(F.sum("many").alias("many"))
    # what is seen often enough is few rows, at most the sample's super-k-mers / SEEN
    often = S.materialised(counts, "minimisers")
    all_ = often.agg(F.coalesce(F.sum("many"), F.lit(0))).first()[0]
    rows = often.where((F.col("many") >= SEEN) & (F.col("many") * buckets > all_)).select("m").collect()
    return np.sort(np.array([r["m"] for r in rows], np.int64).view(np.uint64))


def _pack(batches, window: int, minimiser: int, buckets: int, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    codes = B.table(B.SPACE, lower=False)
    squeeze = zstandard.ZstdCompressor(level=3)
    turn = TaskContext.get().partitionId() * 7919
    for batch in batches:
        doc = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        key = batch.column(1).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in B.blocks(batch.column(2)):
            starts, ends, hashes, first = B.words(data, offsets, codes)
            at, text = B.within(first, window)
            if not len(at):
                continue
            packed, byte_at = _normalised(data, starts, ends)
            lead = _first_equal(_word_ids(packed, byte_at), at, window)
            own = lead == np.arange(len(at))
            least = _minimisers(hashes, window, minimiser, common)[at]

            def runs(begin, end, start, text):
                out = np.zeros(len(begin), _RUNS)
                row = a + text[begin]
                out["doc_id"], out["key"], out["null_id"] = doc[row], key[row], null[row]
                out["start"] = start[begin] - first[text[begin]]
                out["windows"] = end - begin
                return out

            rows = []
            twice = np.zeros(len(at), bool)
            twice[~own] = True
            twice[lead[~own]] = True
            if twice.any():  # repeated inside this block: already decided
                begin, end = _runs(at[twice], text[twice])
                turn += 1
                rows.append((turn % buckets, runs(begin, end, at[twice], text[twice]).tobytes(), None))
            start, text, least = at[own], text[own], least[own]
            begin, end = _runs(start, text, least)
            sent = runs(begin, end, start, text)
            left, right = byte_at[start[begin]], byte_at[start[end - 1] + window]
            sent["bytes"] = right - left
            bucket = (least[begin] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            raw = packed.tobytes()
            left, right = left.tolist(), right.tolist()
            for part in np.split(order, cuts):
                words = b"".join([raw[left[i]:right[i]] for i in part.tolist()])
                rows.append((int(bucket[part[0]]), sent[part].tobytes(), squeeze.compress(words)))
            buckets_, runs_, words_ = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets_, pa.int32()), pa.array(runs_, pa.binary()),
                 pa.array(words_, pa.binary())], names=["bucket", "runs", "words"])


def _found(runs: np.ndarray, start: np.ndarray, end: np.ndarray, win=None) -> pa.RecordBatch:
    n = len(runs)
    wins = [pa.array(w.view(np.int64)) for w in win] if win else [pa.nulls(n, pa.int64())] * 2
    return pa.RecordBatch.from_arrays(
        [pa.array(runs["doc_id"], mask=runs["null_id"]), pa.array(runs["key"]),
         pa.array(start), pa.array(end), *wins],
        names=["doc_id", "key", "start", "end", "win1", "win2"])


def _windows(runs: np.ndarray, text: bytes, window: int, twice: bool = False):
    """Words of packed runs: (bytes, word positions in them, hashes (and with
    ``twice`` independent second ones), index of each window's first word, run of each window, window's number in its run)."""
    data = np.frombuffer(text, np.uint8)
    borders = np.append(0, np.cumsum(runs["bytes"], dtype=np.int64))
    starts, ends, hashes, first = B.words(data, borders, B.table(B.SPACE, lower=False))
    at, run = B.within(first, window)
    other = B.run_hashes(B.table(B.SPACE, lower=False)[data], starts, ends, _OTHER_HASH) if twice else None
    return data, np.append(starts, len(data)), (hashes, other), at, run, at - first[run]


def _count(runs: np.ndarray, text: bytes, window: int) -> pa.RecordBatch:
    """The runs' windows that occur more than once in their bucket."""
    data, word_at, _, at, run, number = _windows(runs, text, window)
    lead = _first_equal(_word_ids(data, word_at), at, window)
    again = lead != np.arange(len(at))
    twice = again.copy()
    twice[lead[again]] = True
    at, run, number = at[twice], run[twice], number[twice]
    begin, end = _runs(at, run)
    out = runs[run[begin]]
    start = out["start"] + number[begin]
    return _found(out, start, start + (end - begin) + window - 1)


def _spill(runs: np.ndarray, text: bytes, window: int) -> pa.RecordBatch:
    """One row per window, with a 128-bit fingerprint of its words."""
    _, _, hashes, at, run, number = _windows(runs, text, window, twice=True)
    out = runs[run]
    start = out["start"] + number
    win = [B.mix(B.grams(h, window))[at] for h in hashes]
    return _found(out, start, start + window, win)


def _reduce(batches, window: int, most: int) -> Iterator[pa.RecordBatch]:
    """Buckets arrive one after another (rows are sorted by bucket)."""
    expand = zstandard.ZstdDecompressor()
    now, runs, texts, size, large = None, [], [], 0, False

    def close():
        if runs:
            yield (_spill if large else _count)(np.concatenate(runs), b"".join(texts), window)

    for batch in batches:
        for bucket, own, words in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = np.frombuffer(own, _RUNS)
            if words is None:
                yield _found(own, own["start"], own["start"] + own["windows"] + (window - 1))
                continue
            if bucket != now:
                yield from close()
                now, runs, texts, size, large = bucket, [], [], 0, False
            text = expand.decompress(words)
            runs.append(own)
            texts.append(text)
            size += len(text)
            if size > most:  # more than is held at once: hand the windows on
                large = True
                yield from close()
                runs, texts, size = [], [], 0
    yield from close()


def _remove(batches) -> Iterator[pa.RecordBatch]:
    codes = B.table(B.SPACE, lower=False)
    for batch in batches:
        for a, b, data, offsets in B.blocks(batch.column(1)):
            starts, ends, _, first = B.words(data, offsets, codes)
            spans = batch.column(2).slice(a, b - a)
            change = np.zeros(len(starts) + 1, np.int64)
            if spans.null_count < len(spans):
                flat = spans.flatten()
                counts = pc.fill_null(pc.list_value_length(spans), 0).to_numpy()
                base = np.repeat(first[:-1], counts)
                np.add.at(change, base + flat.field("start").to_numpy(), 1)
                np.add.at(change, base + flat.field("end").to_numpy(), -1)
            keep = np.cumsum(change[:-1]) == 0
            packed, at = _normalised(data, starts[keep], ends[keep])
            kept = np.append(0, np.cumsum(keep))
            left, right = at[kept[first[:-1]]], at[kept[first[1:]]]
            raw = packed.tobytes()
            texts = [raw[x:max(x, y - 1)] for x, y in zip(left.tolist(), right.tolist())]
            n_words, n_kept = np.diff(first), np.diff(kept[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(n_words), pa.array(n_words - n_kept),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "text"])


def remove_repeated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, minimiser: int = MINIMISER, buckets: int | None = None,
                    bucket_bytes: int = BUCKET_BYTES, sample: int = SAMPLE) -> DataFrame:
    """doc_id, n_words, n_removed and text (kept words joined by one space)
    for every row. ``buckets`` defaults to eight per shuffle partition."""
    parts = S.partitions(df.sparkSession)
    buckets = buckets or BUCKETS_PER_PARTITION * parts
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    common = _common(keyed, window, minimiser, buckets, sample)
    packed = keyed.mapInArrow(lambda it: _pack(it, window, minimiser, buckets, common), _PACKED)
    found = S.materialised(
        packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
        .mapInArrow(lambda it: _reduce(it, window, bucket_bytes), _FOUND), "repeated-windows")
    loose = found.where("win1 is not null")
    again = (loose.groupBy("win1", "win2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("win1", "win2"))
    hits = (found.where("win1 is null").unionByName(loose.join(again, ["win1", "win2"]))
            .groupBy("doc_id", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
            .select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"), "spans"))
    return (keyed.join(hits, keyed.doc_id.eqNullSafe(hits.hit_id) & (keyed.key == hits.hit_key), "left")
            .select("doc_id", "text", "spans")
            .mapInArrow(_remove, "doc_id long, n_words long, n_removed long, text string"))
