"""Token ids as Arrow stream files of fixed-size-list batches.

Documents are sorted by id over range partitions; each partition becomes one
shard of two Arrow stream files:

* ``part-NNNNN.arrow``: record batches of ``ROWS`` rows; a row holds
  ``input_ids: fixed_size_list<uint16 or uint32>[seq_len]`` and ``mask:
  fixed_size_list<bool>[seq_len]`` (bit-packed; false marks padding, which
  only the shard's last row has). All full batches have the same byte length,
  so ``RandomAccess`` finds any sequence by arithmetic in a memory map and
  hands out a view without copying.
* ``part-NNNNN.index.arrow``: (doc_id, start in the shard, n_tokens).

A shard is written under a name of its attempt and renamed when complete, so
lost executors and repeated tasks leave whole shards only.

Defined cases: null or empty text has just the end id; equal doc_ids are
ordered by text and keep a row each; an empty table writes no shard and
reads back as no rows; other columns are ignored. Null doc_ids come first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _bytes as B
from . import _shared as S
from . import _tokens as T

SEQ_LEN = 1024
ROWS = 256  # sequences per record batch

MANIFEST = "shard int, path string, docs long, tokens long"
READ_BACK = "doc_id long, shard int, local_start long, n_tokens long, ids_crc32 long"


def _schema(dtype: np.dtype, seq_len: int) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)),
                      ("mask", pa.list_(pa.bool_(), seq_len))])


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _batch(ids: np.ndarray, seq_len: int, schema: pa.Schema) -> pa.RecordBatch:
    """Whole rows from ids; a rest is padded with 0 under a false mask."""
    pad = -len(ids) % seq_len
    mask = np.ones(len(ids) + pad, bool)
    if pad:
        mask[len(ids):] = False
        ids = np.append(ids, np.zeros(pad, ids.dtype))
    return pa.RecordBatch.from_arrays(
        [pa.FixedSizeListArray.from_arrays(pa.array(ids), seq_len),
         pa.FixedSizeListArray.from_arrays(pa.array(mask), seq_len)], schema=schema)


def _write_shard(texts: Iterator[pa.RecordBatch], uri: str, tokenizer: str, seq_len: int,
                 end_id: int) -> Iterator[pa.RecordBatch]:
    enc = T.encoder(tokenizer)
    where, folder = S.filesystem(uri)
    shard = TaskContext.get().partitionId()
    path = f"{folder}/part-{shard:05d}"
    first = next(texts, None)
    while first is not None and not first.num_rows:
        first = next(texts, None)
    if first is None:
        return
    schema = _schema(enc.dtype, seq_len)
    full, docs, tokens = ROWS * seq_len, 0, 0
    held: list[np.ndarray] = []
    n_held = 0
    with (S.committed(where, f"{path}.arrow") as out, pa.ipc.new_stream(out, schema) as rows,
          S.committed(where, f"{path}.index.arrow") as index_out,
          pa.ipc.new_stream(index_out, INDEX) as index):
        while first is not None:
            for a, b, data, offsets in B.blocks(first.column(1)):
                ids, counts = enc.encode(data, offsets)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                counts = counts + 1
                starts = tokens + np.cumsum(counts) - counts
                index.write_batch(pa.RecordBatch.from_arrays(
                    [first.column(0).slice(a, b - a).cast(pa.int64()), pa.array(starts),
                     pa.array(counts)], schema=INDEX))
                docs, tokens = docs + b - a, tokens + len(ids)
                held.append(ids)
                n_held += len(ids)
                if n_held >= full:
                    whole = np.concatenate(held)
                    for k in range(0, n_held - n_held % full, full):
                        rows.write_batch(_batch(whole[k:k + full], seq_len, schema))
                    held = [whole[n_held - n_held % full:].copy()]
                    n_held %= full
            first = next(texts, None)
        if n_held:
            rows.write_batch(_batch(np.concatenate(held), seq_len, schema))
    yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()),
                                      "path": [f"{path}.arrow"], "docs": [docs], "tokens": [tokens]})


def write_tokens(df: DataFrame, uri: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, seq_len: int = SEQ_LEN, end_id: int = 0,
                 shards: int | None = None) -> list[tuple[int, str, int, int]]:
    """Write shards of tokens in ascending id order under the folder ``uri``.

    Returns the manifest, one (shard, path, docs, tokens) per shard in order;
    its length is bounded by ``shards`` (default: the session's number of
    shuffle partitions), whatever the number of documents.
    """
    path = tokenizer or T.default_tokenizer()
    S.make(uri)
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = (rows.repartitionByRange(shards or S.partitions(df.sparkSession), "doc_id")
             .sortWithinPartitions("doc_id", "text"))
    manifest = parts.mapInArrow(lambda it: _write_shard(it, uri, path, seq_len, end_id), MANIFEST)
    return sorted(tuple(r) for r in manifest.collect())


def _read_shard(path: str, where, shard: int) -> Iterator[pa.RecordBatch]:
    index_path = path.removesuffix(".arrow") + ".index.arrow"
    with where.open_input_stream(path, compression=None) as data, \
            where.open_input_stream(index_path, compression=None) as idx:
        rows = pa.ipc.open_stream(data)
        held, begin = np.empty(0, np.uint32), 0  # ids from position ``begin`` of the shard on

        def more() -> np.ndarray:
            batch = rows.read_next_batch()
            ids = batch.column(0).flatten().to_numpy()
            return ids[batch.column(1).flatten().to_numpy(zero_copy_only=False)]

        for batch in pa.ipc.open_stream(idx):
            starts, counts = (batch.column(i).to_numpy() for i in (1, 2))
            crc = np.empty(len(starts), np.int64)
            for i, (s, n) in enumerate(zip(starts.tolist(), counts.tolist())):
                if s + n > begin + len(held):
                    got, have = [held[s - begin:]], begin + len(held)
                    while have < s + n:
                        got.append(more())
                        have += len(got[-1])
                    held, begin = np.concatenate(got), s
                crc[i] = zlib.crc32(held[s - begin:s - begin + n].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(starts), shard, np.int32)),
                 batch.column(1), batch.column(2), pa.array(crc)],
                names=["doc_id", "shard", "local_start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, uri: str, manifest: list[tuple[int, str, int, int]]) -> DataFrame:
    """Read the shards back: one row per document with its position in the
    whole token sequence and the checksum of its ids (little-endian 32 bit)."""
    def read(batches):
        where, _ = S.filesystem(uri)
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _read_shard(path, where, shard)

    bases, base = [], 0
    for shard, path, _, tokens in manifest:
        bases.append((shard, path, base))
        base += tokens
    # one small row per shard; the number of shards is a setting, not the data's size
    files = spark.createDataFrame(bases, "shard int, path string, base long")
    rows = (files.select("shard", "path").repartition(max(1, len(bases)))
            .mapInArrow(read, READ_BACK))
    return (rows.join(F.broadcast(files.select("shard", "base")), "shard")
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"),
                    "n_tokens", "ids_crc32"))


class RandomAccess:
    """Zero-copy access to the sequences of one shard on a mounted file system.

    All full batches of a shard have one byte length, so sequence ``i`` lies
    in batch ``i // ROWS`` at a known place; only that batch's header is read.
    """

    def __init__(self, path: str):
        self.map = pa.memory_map(path)
        reader = pa.ipc.open_stream(self.map)
        self.schema = reader.schema
        self.origin = self.map.tell()
        first = reader.read_next_batch()
        self.stride, self.rows = self.map.tell() - self.origin, first.num_rows

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """(ids as a view into the file, mask) of sequence ``i``."""
        self.map.seek(self.origin + (i // self.rows) * self.stride)
        batch = pa.ipc.read_record_batch(pa.ipc.read_message(self.map), self.schema)
        row = i % self.rows
        width = self.schema.field("input_ids").type.list_size
        ids = batch.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[row * width:(row + 1) * width], batch.column(1)[row].values
