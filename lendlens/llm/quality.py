"""Document quality by regularised quadratic discriminant analysis.

Every text is described by transformed statistics of its bytes, words and
lines. For each class the mean and covariance of these are computed over all
labelled documents (sums that Spark adds up; a few numbers per class reach
the driver). Each covariance is shrunk towards the pooled one and that
towards its diagonal; the Cholesky factors are computed once and cached in
the model. A document's score is the difference of the two classes'
Mahalanobis log-densities, mapped to 0..1 by a logistic curve that is fitted
to the labelled documents by Newton steps.

Defined cases: null and empty texts have a score like any other text (their
statistics are those of no words); labels that are null, not 0 or 1, or of
unknown documents are ignored; a document labelled more than once counts as
often; with one class or none labelled every score is that class's rate (one
without labels); rows that repeat an id get a row each; other columns of the
documents are passed on or ignored, never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B

THRESHOLD = 0.3
SHRINK_TO_POOLED = 0.3
SHRINK_TO_DIAGONAL = 0.1

FEATURES = ("words", "word_bytes", "word_bytes_spread", "letters", "upper", "digits", "stops",
            "bars", "marks", "symbols", "lines", "distinct", "top", "same_next", "pairs",
            "line_repeats", "capitalised", "ends_in_mark", "one_off", "entropy")

_KIND = np.zeros(256, np.uint8)  # 1 lower-case or non-ASCII, 2 upper, 3 digit, 4 stop, 5 bar, 6 mark, 7 symbol
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3
_KIND[list(b".,;:")] = 4
_KIND[list(b"|")] = 5
_KIND[list(b"!?")] = 6
_KIND[list(b"#$%&*+/<=>@\\^_`~{}[]")] = 7


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums over each text's slice of ``values``."""
    sums = np.append(0.0, np.cumsum(values, dtype=np.float64))
    return sums[first[1:]] - sums[first[:-1]]


def _different(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """(different values, most frequent's count, values that occur once, sum of n ln n) of each text."""
    n = len(first) - 1
    text = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    bits = np.uint64(max(1, int(n).bit_length()))
    key = (text << (np.uint64(64) - bits)) | (hashes >> bits)
    key.sort()
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.append(begin, len(key)))
    border = np.searchsorted(begin, first)
    top = np.zeros(n)
    full = np.flatnonzero(np.diff(border))
    if len(full):
        top[full] = np.maximum.reduceat(count, border[:-1][full])
    return (np.diff(border), top, _per_text(count == 1, border), _per_text(count * np.log(count), border))


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics for every text of a block."""
    codes = B.table(B.SPACE, lower=False)
    starts, ends, hashes, first = B.words(data, offsets, codes)
    size = np.diff(offsets).astype(float)
    n_words = np.diff(first).astype(float)
    kind = _KIND[data]
    share = [_per_text(kind == k, offsets) / np.maximum(size, 1) for k in range(1, 8)]
    length = (ends - starts).astype(float)
    per_word = np.maximum(n_words, 1)
    mean = _per_text(length, first) / per_word
    spread = np.sqrt(np.maximum(_per_text(length ** 2, first) / per_word - mean ** 2, 0))
    different, top, once, nlogn = _different(hashes, first)
    inner = np.ones(max(len(hashes) - 1, 0), bool)
    inner[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(hashes))] - 1] = False
    same = np.append((hashes[1:] == hashes[:-1]) & inner, False)[:len(hashes)]
    pair_at, _ = B.within(first, 2)
    pair_first = np.append(0, np.cumsum(np.maximum(np.diff(first) - 1, 0)))
    pairs = _different(B.grams(hashes, 2)[pair_at], pair_first)[0]
    n_pairs = np.diff(pair_first)
    line_codes = B.table(b"\n", lower=False)
    _, _, line_hashes, line_first = B.words(data, offsets, line_codes)
    n_lines = np.diff(line_first)
    lines = _different(line_hashes, line_first)[0]
    head = kind[starts] == 2 if len(starts) else np.empty(0, bool)
    tail = (kind[ends - 1] >= 5) if len(starts) else np.empty(0, bool)
    entropy = np.log(per_word) - nlogn / per_word

    def odds(x, soft=0.003):
        return np.log((x + soft) / (1 - x + soft))

    return np.column_stack([
        np.log1p(n_words), np.log1p(mean), np.log1p(spread),
        odds(share[0]), odds(share[1]), odds(share[2]), odds(share[3]), odds(share[4]), odds(share[5]),
        odds(share[6]), np.log1p(n_lines) - np.log1p(n_words), odds(different / per_word),
        odds(top / per_word), odds(_per_text(same, first) / per_word), odds(pairs / np.maximum(n_pairs, 1)),
        odds(1 - lines / np.maximum(n_lines, 1)), odds(_per_text(head, first) / per_word),
        odds(_per_text(tail, first) / per_word), odds(once / per_word), entropy])


@dataclass(frozen=True)
class Model:
    """Means, Cholesky factors and log-determinants of the classes, and the
    logistic curve over their log-density difference."""

    means: np.ndarray
    factors: np.ndarray  # inverse lower Cholesky factors
    log_dets: np.ndarray
    slope: float
    offset: float
    rate: float | None = None  # set when there was no second class

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, per feature."""
        out = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            z = (x - mean) @ factor.T
            out.append(-0.5 * (np.einsum("ij,ij->i", z, z) + log_det))
        return (out[1] - out[0]) / x.shape[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.rate is not None:
            return np.full(len(x), self.rate)
        t = np.clip(self.slope * squash(self.difference(x)) + self.offset, -40, 40)
        return 1 / (1 + np.exp(-t))


def squash(d: np.ndarray) -> np.ndarray:
    """Log-density differences have long tails; keep their order, bound their pull."""
    return np.sign(d) * np.log1p(np.abs(d))


def _classes(moments: list[tuple[float, np.ndarray, np.ndarray]], to_pooled: float, to_diagonal: float):
    """(means, inverse Cholesky factors, log-determinants) from (n, sum, sum of products)."""
    means = [s / n for n, s, _ in moments]
    scatter = [p - n * np.outer(m, m) for (n, _, p), m in zip(moments, means)]
    pooled = sum(scatter) / max(1.0, sum(n for n, _, _ in moments) - 2)
    factors, log_dets = [], []
    for (n, _, _), s in zip(moments, scatter):
        c = (1 - to_pooled) * s / max(1.0, n - 1) + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c))
        c += np.eye(len(c)) * 1e-3
        low = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * np.log(np.diag(low)).sum())
    return np.array(means), np.array(factors), np.array(log_dets)


def describe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the transformed statistics of every text."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in B.blocks(batch.column(1)):
                x = statistics(data, offsets)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(b - a + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists],
                                                 names=["doc_id", "x"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(FEATURES))


def held_out(id_col: str = "doc_id"):
    """Documents whose labels are never learnt from: a fifth, by checksum of the id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def _moments(batches) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        x, y = _matrix(batch.column(0)), batch.column(1).to_numpy()
        for k in (0, 1):
            own = x[y == k]
            if len(own):
                part = np.concatenate([[len(own)], own.sum(0), (own.T @ own).reshape(-1)])
                sums[k] = sums.get(k, 0) + part
    for k, part in sums.items():
        yield pa.RecordBatch.from_pydict({"label": pa.array(np.full(len(part), k, np.int32)),
                                          "at": pa.array(np.arange(len(part), dtype=np.int32)),
                                          "value": pa.array(part)})


def _curve(d: np.ndarray, ones: np.ndarray, zeros: np.ndarray) -> tuple[float, float]:
    """Logistic curve over binned differences; a small ridge keeps it finite
    where the classes are apart."""
    a = np.zeros(2)
    rows = np.column_stack([d, np.ones(len(d))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ a, -30, 30)))
        weight = (ones + zeros) * p * (1 - p) + 1e-9
        ridge = np.array([1.0, 0.01])
        step = np.linalg.solve(rows.T @ (rows * weight[:, None]) + np.diag(ridge),
                               rows.T @ (ones - (ones + zeros) * p) - ridge * a)
        a += step
        if np.abs(step).max() < 1e-9:
            break
    return float(a[0]), float(a[1])


def fit(described: DataFrame, labels: DataFrame, label_col: str = "quality",
        to_pooled: float = SHRINK_TO_POOLED, to_diagonal: float = SHRINK_TO_DIAGONAL) -> Model:
    """Fit on all labelled rows of ``described`` that aren't held out. Only
    sums (a fixed number per class) and a histogram come to the driver."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"),
                          F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    rows = (described.where(~held_out()).join(known, F.col("doc_id") == F.col("label_id"))
            .select("x", "y"))
    size = len(FEATURES)
    got = np.zeros((2, 1 + size + size * size))
    for label, at, value in (rows.mapInArrow(_moments, "label int, at int, value double")
                             .groupBy("label", "at").agg(F.sum("value")).collect()):
        got[label, at] = value
    if not got[:, 0].all():
        total = got[:, 0].sum()
        return Model(*(np.empty(0),) * 3, 0.0, 0.0, rate=float(got[1, 0] / total) if total else 1.0)
    means, factors, log_dets = _classes(
        [(g[0], g[1:size + 1], g[size + 1:].reshape(size, size)) for g in got], to_pooled, to_diagonal)
    raw = Model(means, factors, log_dets, 1.0, 0.0)

    def differences(batches):
        for batch in batches:
            d = squash(raw.difference(_matrix(batch.column(0))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.round(d * 64).astype(np.int64)), batch.column(1)], names=["bin", "y"])

    bins = (rows.mapInArrow(differences, "bin long, y int")
            .groupBy("bin").agg(F.sum("y"), F.sum(1 - F.col("y"))).collect())
    d, ones, zeros = np.array(bins, float).T
    slope, offset = _curve(d / 64, ones, zeros)
    return Model(means, factors, log_dets, slope, offset)


def score(described: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) from stored statistics."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.score(_matrix(batch.column(1))))], names=["doc_id", "score"])

    return described.mapInArrow(run, "doc_id long, score double")


def keep_good(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text scores at least ``threshold``; one pass, no shuffle."""
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in B.blocks(batch.column(at)):
                good = model.score(statistics(data, offsets)) >= threshold
                yield batch.slice(a, b - a).filter(pa.array(good))

    return df.mapInArrow(run, df.schema)
