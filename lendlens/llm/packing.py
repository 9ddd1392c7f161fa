"""Packing documents into training windows: bounded-space online best fit.

Each partition streams its documents once and keeps a fixed number of open
windows. A document's ids (with its end id) fill whole windows first; the
rest goes to the open window it fits best. When it fits none, the fullest
window is topped up with the first part of the rest and emitted, and what is
left opens a window in its place. The windows still open at the end of a
partition are leftovers; leftovers of up to ``MERGE`` partitions meet in one
task (``MERGE * open_windows * window`` ids at most, whatever the input) and
are laid one after another, so that only the last window of each such task
is padded.

Defined cases: null or empty text is a document of the end id alone; equal
rows are packed each on its own; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from . import _shared as S
from . import _tokens as T

WINDOW = 1024
OPEN_WINDOWS = 64
MERGE = 64  # partitions whose leftovers one task merges

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.binary()]


class Packer:
    """Open windows of one partition and the pieces emitted so far."""

    def __init__(self, window: int, open_windows: int, first_id: int, keep_ids: bool):
        self.window, self.most, self.keep_ids = window, open_windows, keep_ids
        self.sequence = first_id
        self.free: list[tuple[int, int]] = []  # (free ids, slot), sorted
        self.open: dict[int, list] = {}  # slot -> pieces (doc, start, ids, doc_tokens)
        self.slots = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            raw = ids.astype("<u4").tobytes()
            self.out.append((doc, start, len(ids), zlib.crc32(raw), total, self.sequence, offset,
                             raw if self.keep_ids else None))
            offset += len(ids)
        self.sequence += 1

    def add(self, doc, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.window:
            self._emit([(doc, at, ids[at:at + self.window], total)])
            at += self.window
        while at < total:
            need = total - at
            k = bisect.bisect_left(self.free, (need, -1))
            if k < len(self.free):
                room, slot = self.free.pop(k)
            elif len(self.free) < self.most:
                room, slot = self.window, self.slots
                self.slots += 1
                self.open[slot] = []
            else:
                room, slot = self.free.pop(0)  # the fullest
                need = room
            self.open[slot].append((doc, at, ids[at:at + need], total))
            at += need
            if room == need:
                self._emit(self.open.pop(slot))
            else:
                bisect.insort(self.free, (room - need, slot))

    def leftovers(self) -> list[tuple]:
        """Pieces of the windows still open, with their ids."""
        return [(doc, start, len(ids), None, total, None, None, ids.astype("<u4").tobytes())
                for slot in sorted(self.open) for doc, start, ids, total in self.open[slot]]

    def take(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def _rows(rows: list[tuple], extra: list[tuple[str, pa.Array]] = []) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)] if rows else \
        [pa.array([], t) for t in _TYPES]
    return pa.RecordBatch.from_arrays(columns + [a for _, a in extra],
                                      names=_NAMES + [n for n, _ in extra])


def _pack_partition(batches, tokenizer, window, open_windows, end_id, keep_ids
                    ) -> Iterator[pa.RecordBatch]:
    enc = T.encoder(tokenizer)
    part = TaskContext.get().partitionId()
    packer = Packer(window, open_windows, part << 33, keep_ids)

    def out(rows, left):
        return _rows(rows, [("merge", pa.array([part // MERGE if left else None] * len(rows), pa.int64()))])

    for batch in batches:
        ids_of = batch.column(0).to_pylist()
        for a, b, data, offsets in B.blocks(batch.column(1)):
            ids, counts = enc.encode(data, offsets)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            ends = (ends + np.arange(1, b - a + 1)).tolist()
            begin = 0
            for doc, end in zip(ids_of[a:b], ends):
                packer.add(doc, ids[begin:end])
                begin = end
            yield out(packer.take(), False)
    yield out(packer.leftovers(), True)


def _merge(key, table: pa.Table, window: int, keep_ids: bool) -> pa.Table:
    """Lay leftovers one after another; a piece is cut at a window's end."""
    packer = Packer(window, 1, (1 << 62) | (key[0].as_py() << 33), keep_ids)
    table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
    pieces, used = [], 0
    for doc, start, raw, total in zip(*(table.column(c).to_pylist() for c in
                                        ("doc_id", "start", "ids", "doc_tokens"))):
        ids = np.frombuffer(raw, "<u4")
        while len(ids):
            part = ids[:window - used]
            pieces.append((doc, start, part, total))
            used, start, ids = used + len(part), start + len(part), ids[len(part):]
            if used == window:
                packer._emit(pieces)
                pieces, used = [], 0
    if pieces:
        packer._emit(pieces)
    return pa.Table.from_batches([_rows(packer.take())])


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         tokenizer: str | None = None, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
         end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """Pieces of packed sequences: doc_id, start (ids of the document before
    it), length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``keep_ids`` the piece's ids (binary, little-endian 32 bit).

    The tokenised and packed partitions are written once to the shared folder;
    the result reads them.
    """
    path = tokenizer or T.default_tokenizer()
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed = S.materialised(rows.mapInArrow(
        lambda it: _pack_partition(it, path, window, open_windows, end_id, keep_ids),
        PIECES + ", merge long"), "packing")
    left = packed.where(F.col("merge").isNotNull())
    merged = left.groupBy("merge").applyInArrow(
        lambda key, t: _merge(key, t, window, keep_ids), PIECES)
    whole = packed.where(F.col("merge").isNull()).drop("merge").unionByName(merged)
    return whole if keep_ids else whole.drop("ids")
